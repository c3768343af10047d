"""Sinks: accepted and review tables, log, statistics, root causes, artefact names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex
from scriva.plans.pipeline import unpacked

CSV = {"sep": "|", "header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}
STATS = ["METRIC_TYPE", "NAME", "EXTRACTED_OR_VALUE", "RECOVERED_BY_ENGINE", "FAILED"]


def accepted(done: DataFrame) -> DataFrame:
    return unpacked(done.where("status = 'PASS'"))


def review(done: DataFrame) -> DataFrame:
    rows = done.where("status <> 'PASS'")
    return rows.select("record_id", *[F.coalesce(F.col(f"{lex.field(c)}.value"), F.lit("")).alias(c) for c in lex.COLUMNS], F.array_join("errors", "; ").alias("VALIDATION_ERRORS"))


def failed_review(failed: DataFrame) -> DataFrame:
    """Review rows of records that failed: every column is blank, the message stands with the errors."""
    return failed.select("record_id", *[F.lit("").alias(c) for c in lex.COLUMNS], F.col("message").alias("VALIDATION_ERRORS"))


def _stamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("TIMESTAMP")


def failed_log(failed: DataFrame) -> DataFrame:
    """Log rows of records that failed."""
    return failed.select("record_id", _stamp(), F.col("record_no").alias("RECORD_NO"), F.col("image_name").alias("IMAGE_NAME"), F.lit("ERROR").alias("STATUS"), F.col("message").alias("ERRORS"))


def log(done: DataFrame) -> DataFrame:
    """(record_id, TIMESTAMP, RECORD_NO, IMAGE_NAME, STATUS, ERRORS); one timestamp for a batch."""
    no = F.coalesce("record_no.value", F.concat(F.lit("rec_"), F.col("record_id").cast("string")))
    return done.select("record_id", _stamp(), no.alias("RECORD_NO"), F.col("image_name.value").alias("IMAGE_NAME"), F.col("status").alias("STATUS"), F.array_join("errors", "; ").alias("ERRORS"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.drop("record_id").write.mode(mode).options(**CSV).csv(path)


def artefact_name(record_no: Column, merge_type: Column, passed: Column) -> Column:
    safe = F.regexp_replace(record_no, r'[\\/*?:"<>|]', "_")
    return F.concat(safe, F.when(merge_type != "none", "Merged").otherwise(""), F.when(passed, "").otherwise("-review"), F.lit(".png"))
