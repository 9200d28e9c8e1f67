"""Micro-batch scoring of arriving record-batch requests.

Stateless: ``readStream`` over a folder of request JSON files (schema given,
no inference) -> check of each request -> explode records -> the same
:func:`tabprep.plans.score.score` -> parquet.  Requests that cannot be answered
go to a dead-letter folder with the reason and their text; nothing is silently
NULL or lost.  Each micro-batch writes folders of its own, ``batch_id=<n>``, and
replaces them when Spark replays it after a failure, so every request is
answered exactly once across restarts.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabprep.plans.score import score
from tabprep.sources.io import REQUEST_SCHEMA, check_requests, explode_records

CORRUPT = "_corrupt_record"


def score_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, model: PipelineModel | None,
                 model_name: str, available_now: bool = True, max_files_per_trigger: int | None = None,
                 scorer=None, reject_dir: str | None = None, models=None, multi_line: bool = True) -> StreamingQuery:
    """``scorer``: records -> scored rows, such as ``ServiceModel.score``; by
    default ``model`` with the core cleaning.  ``out_dir`` and ``reject_dir``
    (``<out_dir>_rejected`` if not given) are partitioned by ``batch_id``;
    rejected rows are ``reason, source_file, model, request``, one per request.
    ``models``: names that requests may ask for.  ``multi_line``: one request
    a file, else one a line."""
    reader = spark.readStream.schema(f"{REQUEST_SCHEMA}, {CORRUPT} string").option("multiLine", str(multi_line).lower())
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    requests = reader.json(in_dir).select("*", F.col("_metadata.file_path").alias("source_file"))
    rejects = reject_dir or f"{out_dir.rstrip('/')}_rejected"

    def answer(batch: DataFrame, batch_id: int) -> None:
        checked = check_requests(batch, models).persist()  # read once for both sinks
        try:
            records = explode_records(checked.where("reason IS NULL").select("model", "records"))
            scored = scorer(records) if scorer else score(records, model, model_name)
            scored.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")
            text = F.coalesce(CORRUPT, F.to_json(F.struct("model", "records")))
            checked.where("reason IS NOT NULL").select("reason", "source_file", "model", text.alias("request")).write.mode(
                "overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            checked.unpersist()

    writer = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
