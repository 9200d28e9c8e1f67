"""Malformed CSV rows, two-phase publish and the stream's dead letters."""
import json
import os

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tabprep.plans.score import prepare_records
from tabprep.registry import raw
from tabprep.sources import io
from tabprep.streaming.score_stream import score_stream


def test_checked_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "odd")
    os.makedirs(path)
    for k, text in enumerate(['a,b,c\n1,2,3\n4,5\n"x,1",y,"z \\"q\\" ,"\n', 'a,b,c\n6,7,8,9\n"p,q",r,s,t\n,,\n7\n', "a,b,c\n"]):
        with open(os.path.join(path, f"{k}.csv"), "w") as f:
            f.write(text)
    rows, rejected = io.read_checked_csv(spark, path)
    assert rows.columns == ["a", "b", "c"]
    assert sorted(r.a or "" for r in rows.collect()) == ["", "1", "x,1"]
    got = sorted((r.line, r.n_fields, r.reason) for r in rejected.collect())
    assert got == [('"p,q",r,s,t', 4, "too many fields"), ("4,5", 2, "too few fields"), ("6,7,8,9", 4, "too many fields"),
                   ("7", 1, "too few fields")]
    assert rows.select("b").count() == 3 and rejected.where("source_file LIKE '%/1.csv'").count() == 3
    blank, _ = io.read_checked_csv(spark, path, keep_blank=True)
    assert blank.where("a = ''").count() == 1


def test_publish_in_two_phases(spark):
    name = "tabprep_jobs.target"
    df = raw(spark, SF001).select("record_id", "age")
    n = io.publish_version(df, name)
    assert n == df.count() == spark.table(name).count()

    def refuse(table):
        assert table.count() == 5
        raise io.PublishError("no")

    with pytest.raises(io.PublishError):
        io.publish_version(df.limit(5), name, check=refuse)
    with pytest.raises(Exception):  # a job that dies while it writes
        io.publish_version(df.withColumn("x", F.raise_error(F.lit("dies"))), name)
    assert spark.table(name).count() == n and len(io.versions(spark, name)) == 1
    begun = spark.table(name)  # a reader of the version before
    io.publish_version(df.limit(7).select("age"), name)
    assert spark.table(name).count() == 7 and spark.table(name).columns == ["age"] and begun.count() == n
    for k in range(3):
        io.publish_version(df.limit(k), name)
    assert len(io.versions(spark, name)) == 2 and spark.table(name).count() == 2
    io.withdraw(spark, name)
    assert not spark.catalog.tableExists(name) and io.versions(spark, name) == []
    io.publish(df, "tabprep_jobs.plain")
    with pytest.raises(io.PublishError, match="is a table"):
        io.publish_version(df, "tabprep_jobs.plain")


def test_dead_letters_and_restart(spark, tmp_dir):
    at = {k: os.path.join(tmp_dir, k) for k in ("in", "out", "dead", "ck")}
    os.makedirs(at["in"])
    record = {"age": "39", "Sex": "Male"}

    def put(name, text):
        with open(os.path.join(at["in"], name), "w") as f:
            f.write(text if isinstance(text, str) else json.dumps(text))

    def run():
        score_stream(spark, at["in"], at["out"], at["ck"], None, "m", reject_dir=at["dead"], models=["m", "n"],
                     scorer=lambda r: prepare_records(r, keep=["model"]).select("model", "age")).awaitTermination(120)
        return (spark.read.parquet(at["out"]).count(),
                sorted((r.reason, r.n) for r in spark.read.parquet(at["dead"]).groupBy("reason").agg(F.count("*").alias("n")).collect()))

    put("1.json", {"model": " M ", "records": [record, record, {}]})
    put("2.json", '{"model": "m", "records": [{"age"')
    put("3.json", {"model": "m", "records": []})
    put("4.json", {"model": "m"})
    put("5.json", {"model": "other", "records": [record]})
    put("6.json", {"records": [record]})
    put("7.json", {"model": "m", "records": [record, None]})
    want = [("a record is null", 1), ("not a request in JSON", 1), ("records are empty", 2), ("unknown model", 1)]
    assert run() == (4, want)
    assert run() == (4, want)  # nothing new: nothing is answered twice
    put("8.json", "not json at all")
    put("9.json", {"model": "n", "records": [record]})
    assert run() == (5, [want[0], ("not a request in JSON", 2), *want[2:]])
    dead = {r.source_file.rsplit("/", 1)[1]: r.request for r in spark.read.parquet(at["dead"]).collect()}
    assert dead["8.json"] == "not json at all" and json.loads(dead["5.json"])["records"][0]["age"] == "39"
    # a replayed batch replaces its own folders
    spark.read.parquet(os.path.join(at["out"], "batch_id=0")).limit(0).write.mode("overwrite").parquet(os.path.join(tmp_dir, "x"))
    last = max(os.listdir(os.path.join(at["ck"], "commits")), key=lambda f: int(f) if f.isdigit() else -1)
    for file in (last, f".{last}.crc"):
        os.remove(os.path.join(at["ck"], "commits", file))
    assert run()[0] == 5


def test_models_can_be_applied_after_a_publish(spark):
    """Publishing leaves nothing in the session that keeps a fitted model from
    being shipped to executors."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    name = "tabprep_jobs.before_fit"
    try:
        io.publish_version(spark.range(10).toDF("a"), name)
        rows = spark.range(40).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
                                      (F.col("id") > 20).cast("double").alias("label"))
        model = LogisticRegression(maxIter=2).fit(rows)
        assert model.transform(rows).groupBy("prediction").count().count() >= 1
    finally:
        io.withdraw(spark, name)
