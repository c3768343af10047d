"""Counters of an incremental run: parts add up to the whole, and a batch that runs again is counted once."""

from pyspark.sql import functions as F

from scriva import sinks
from scriva.plans import fixtures, metrics, pipeline, quarantine
from scriva.streaming import route

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_counters_of_batches(spark, tmp_path):
    records = fixtures.record_text(spark, SF).where("record_id % 3 = 0").withColumn("text", F.when(F.col("record_id") % 7 != 1, F.col("text")))
    records = fixtures.stored(records, "stream-test")
    parts = [records.where(f"pmod(record_id, 2) = {k}") for k in (0, 1)]
    route.write_batch(parts[0], 0, str(tmp_path))
    route.write_batch(parts[1].limit(5), 1, str(tmp_path))  # breaks off, and runs again
    route.write_batch(parts[1], 1, str(tmp_path))
    counted = route.counted(spark, str(tmp_path))

    good, failed = quarantine.parted(records)
    done = pipeline.staged(good, fixtures.stored)[2]
    review = sinks.review(done).unionByName(sinks.failed_review(failed))
    assert rows_of(metrics.recovery_of(counted)) == rows_of(metrics.recovery_metrics(done))
    assert rows_of(metrics.summary_of(counted)) == rows_of(metrics.summary(done, failed))
    assert metrics.root_causes_of(counted).collect() == metrics.root_causes(review).collect()
    assert metrics.summary_of(counted).first()["total"] == records.count()
    assert tuple(metrics.summary_of(counted.limit(0)).first()) == (0, 0, 0) and metrics.recovery_of(counted.limit(0)).count() == 0
