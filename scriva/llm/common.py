"""Helpers that the corpus operators share: stored intermediate tables, size-checked broadcasts, bounded Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a broadcast side of narrow rows may have; beyond it, joins shuffle.
BROADCAST_ROWS = 300_000
#: Broadcasts of that size that one scan of the documents may probe one after another, so that their texts stay where they are.
PARTS = 8
#: Bytes of an Arrow batch between the JVM and Python. Spark's 64 MB, doubled while a batch grows, for each task at once, stay
#: in the JVM's pool of direct memory for good.
ARROW_BYTES = "4m"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; on a single machine a new one where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-scriva-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df once to the shared folder and reads it back, which cuts the lineage and survives lost executors."""
    return Scratch(df.sparkSession).stored(df, name)


class Scratch:
    """Stored tables of one piece of work; on leaving it, those that nothing reads any more are deleted.

    with Scratch(spark) as scratch:
        big = scratch.stored(...)
        return stored(small_result_of(big), ...)

    Tables lie in a folder of the application, so that what a crash leaves behind can be deleted by its id.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(self.spark).rstrip('/')}/{self.spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, failed: type | None, *rest: object) -> None:
        if not failed:
            self.drop()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if it has at most that many rows (df should be a stored table), and whether it has."""
    fits = df.limit(rows + 1).count() <= rows
    return (F.broadcast(df) if fits else df), fits


def broadcast_parts(side: DataFrame, keys: list[str], most: int = BROADCAST_ROWS, weight: Column | None = None) -> list[DataFrame] | None:
    """side (a stored table) as up to PARTS broadcasts of about `most` rows, or units of weight, each; None if it is larger."""
    total = side.agg(F.count("*") if weight is None else F.sum(weight)).first()[0] or 0
    n = max(1, -(-total // most))
    if n > PARTS:
        return None
    return [F.broadcast(side if n == 1 else side.where(F.pmod(F.xxhash64(*keys), F.lit(n)) == k)) for k in range(n)]


def without(docs: DataFrame, gone: DataFrame, keys: list[str], same: Callable[[DataFrame, DataFrame], Column]) -> DataFrame:
    """The rows of docs for which `same` holds with no row of gone. Texts move only if gone is too large for PARTS broadcasts."""
    for part in broadcast_parts(gone, keys) or [gone]:
        docs = docs.join(part, same(docs, part), "left_anti")
    return docs


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, of which whole texts go to Python. Bounds the bytes of an Arrow batch for the session, unless the user has set a bound."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) in ("67108864b", "64m", "64MB"):
        conf.set(key, ARROW_BYTES)
    return df


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Texts without other letters take the built-in that works on bytes."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
