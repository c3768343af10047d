"""Incremental runs: a stream of record texts, routed batch by batch to accepted, review and log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scriva import sinks
from scriva.plans import metrics
from scriva.plans.pipeline import staged
from scriva.plans.quarantine import parted
from scriva.shared import stored

SCHEMA = "record_id long, image_name string, text string, confidence double"


def write_batch(records: DataFrame, number: int, target: str) -> None:
    """Routes the records of one batch and writes what came of them under its number."""
    good, failed = parted(records)
    _, _, done = staged(good, stored)
    review = sinks.review(done).unionByName(sinks.failed_review(failed))
    log = sinks.log(done).unionByName(sinks.failed_log(failed))
    for name, rows in (("accepted", sinks.accepted(done)), ("review", review), ("log", log)):
        rows.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
    # causes are read from what was written; counters come last, so that a batch that has them is whole
    metrics.counters(done, failed, records.sparkSession.read.parquet(f"{target}/review/batch={number}")).coalesce(1).write.mode("overwrite").parquet(f"{target}/counters/batch={number}")


def counted(spark: SparkSession, target: str) -> DataFrame:
    """The counters of all batches so far; recovery_of, summary_of and root_causes_of of `metrics` add them up."""
    return spark.read.parquet(f"{target}/counters").drop("batch")


def route(spark: SparkSession, source: str, target: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Reads Parquet record texts as they arrive under source; appends to target/accepted, review and log. Records that have no
    text go to review, blank, and to the log as errors.

    Records are independent, so there is no state and no watermark. Each batch writes under its own number: a batch that is run
    again after a failure replaces what it wrote, its counters (see `metrics.counters`) included, so that `counted` never counts a
    batch twice.
    """
    stream = spark.readStream.schema(SCHEMA)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def batch(df: DataFrame, number: int) -> None:
        write_batch(df, number, target)

    return stream.parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", f"{target}/_checkpoint").trigger(availableNow=True).start()
