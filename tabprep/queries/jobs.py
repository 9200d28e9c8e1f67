"""Registered queries: whole jobs at the boundary -- CSV with malformed rows
(S01), two-phase publish (S07-S09) and the scoring stream's accounting (V12).
Each writes what it reads from the given tables below the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators.partitioning import materialize
from tabprep.plans.score import prepare_records
from tabprep.registry import CORE, CORE_CUR, curated, raw, register, with_ctes
from tabprep.session import ensure_checkpoint_dir
from tabprep.sources import io
from tabprep.streaming.score_stream import score_stream


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabprep-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ S01-S03
FILES = 8


@register("csv_rejected_rows", with_ctes() + """
    SELECT CASE WHEN record_id % 30 = 4 THEN 'too few fields' WHEN record_id % 30 = 9 THEN 'too many fields' ELSE 'read' END AS outcome,
        count(*) AS rows, sum(CASE WHEN record_id % 30 = 4 THEN 16 WHEN record_id % 30 = 9 THEN 18 ELSE 17 END)::BIGINT AS n_fields,
        count(*) FILTER (WHERE record_id % 30 NOT IN (4, 9) AND trim(age) <> '') AS with_age FROM raw GROUP BY ALL""")
def q_csv_rejected_rows(spark, sf):
    """The source as headed CSV files, some rows a field short or long; what is
    read and what is rejected add up."""
    path = _folder(spark)
    text = F.to_csv(F.struct(*K.CONTRACT_COLUMNS), {"emptyValue": ""})
    short = F.to_csv(F.struct(*K.CONTRACT_COLUMNS[:-1]), {"emptyValue": ""})
    kind = F.col("record_id") % 30
    line = F.when(kind == 4, short).when(kind == 9, F.concat(text, F.lit(",x"))).otherwise(text)
    file = F.pmod(F.xxhash64("record_id", "copy_no"), F.lit(FILES)).alias("file")
    rows = raw(spark, sf).select(line.alias("value"), file, F.lit(1).alias("at"))
    heads = spark.range(FILES).select(F.lit(",".join(K.CONTRACT_COLUMNS)).alias("value"), F.col("id").alias("file"), F.lit(0).alias("at"))
    lines = rows.unionByName(heads).repartition(FILES, "file").sortWithinPartitions("file", "at")
    lines.select("value", "file").write.partitionBy("file").text(path)
    read, rejected = io.read_checked_csv(spark, path, recursiveFileLookup="true")
    good = read.agg(F.lit("read").alias("outcome"), F.count(F.lit(1)).alias("rows"),
                    (F.count(F.lit(1)) * len(read.columns)).alias("n_fields"), F.count_if(F.trim("age") != "").alias("with_age"))
    bad = rejected.groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_fields").alias("n_fields"), F.lit(0).cast("long").alias("with_age"))
    return good.unionByName(bad)


# ------------------------------------------------------------------ S07-S09
@register("publish_versions", CORE_CUR + f"""
    SELECT 'first' AS step, (SELECT count(*) FROM curated WHERE age IS NOT NULL) AS rows, {len(K.CURATED_COLUMNS) + 1}::BIGINT AS n_columns, 1::BIGINT AS versions
    UNION ALL SELECT 'failed', (SELECT count(*) FROM curated WHERE age IS NOT NULL), {len(K.CURATED_COLUMNS) + 1}, 1
    UNION ALL SELECT 'second', (SELECT count(*) FROM curated), {len(K.CURATED_COLUMNS) + 1}, 2
    UNION ALL SELECT 'third', (SELECT count(*) FROM curated), 2, 2""")
def q_publish_versions(spark, sf):
    """What readers of the name see after a first version, after one that fails
    its check, after a second and after a third with other columns."""
    name = f"tabprep_publish.curated_{uuid.uuid4().hex[:12]}"
    rows = materialize(curated(spark, sf))
    seen = []

    def look(step: str) -> None:
        table = spark.table(name)
        seen.append((step, table.count(), len(table.columns), len(io.versions(spark, name))))

    def refuse(_):
        raise io.PublishError("refused by its check")

    try:
        io.publish_version(rows.where("age IS NOT NULL"), name)
        look("first")
        try:
            io.publish_version(rows, name, check=refuse)
        except io.PublishError:
            look("failed")
        io.publish_version(rows, name)
        look("second")
        io.publish_version(rows.select("sex", "age"), name)
        look("third")
    finally:
        io.withdraw(spark, name)
    return spark.createDataFrame(seen, "step string, rows long, n_columns long, versions long")


# ---------------------------------------------------------------------- V12
@register("stream_accounting", CORE + """,
    req AS (SELECT record_id // 40 AS g, count(*) AS n, sum(age)::BIGINT AS ages FROM clean GROUP BY 1)
    SELECT CASE g % 10 WHEN 3 THEN 'not a request in JSON' WHEN 5 THEN 'records are empty' WHEN 7 THEN 'unknown model' ELSE 'scored' END AS outcome,
        sum(CASE WHEN g % 10 IN (3, 5, 7) THEN 1 ELSE n END)::BIGINT AS rows,
        sum(CASE WHEN g % 10 IN (3, 5, 7) THEN NULL ELSE ages END)::BIGINT AS ages FROM req GROUP BY ALL""")
def q_stream_accounting(spark, sf):
    """Requests of about forty records, some cut off, empty or for an unknown
    model, through the stream: records scored and requests rejected, by reason."""
    path = _folder(spark)
    group = F.floor(F.col("record_id") / 40)
    records = raw(spark, sf).groupBy(group.alias("g")).agg(
        F.collect_list(F.struct(*K.CONTRACT_COLUMNS)).alias("records"))
    kind = F.col("g") % 10
    model = F.when(kind == 7, F.lit("nobody")).otherwise(F.lit(" Fixed"))
    whole = F.to_json(F.struct(model.alias("model"), "records"))
    text = F.when(kind == 3, F.substring(whole, 1, 100)).when(kind == 5, F.lit('{"model": "fixed", "records": []}')).otherwise(whole)
    records.select(text.alias("value")).write.text(f"{path}/in")
    query = score_stream(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", None, "fixed", models=["fixed"], multi_line=False,
                         scorer=lambda r: prepare_records(r, keep=["model"]).select("model", "age"))
    query.awaitTermination()
    scored = spark.read.parquet(f"{path}/out").agg(F.lit("scored").alias("outcome"), F.count(F.lit(1)).alias("rows"),
                                                   F.sum("age").cast("long").alias("ages"))
    bad = spark.read.schema("reason string, source_file string, model string, request string, batch_id long").parquet(f"{path}/out_rejected")
    return scored.unionByName(bad.groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("ages")))
