"""The whole way of a record: extract, validate, recover, validate, fill, validate.

Recovery and fallback run only on rows that don't pass: rows are branched by status, so passing rows skip their expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriva.functions import fields as x
from scriva.functions import lexicons as lex
from scriva.plans import extract, fallback, recover, validate

MIN_LINES = 3


def enough_lines(records: DataFrame, least: int = MIN_LINES) -> DataFrame:
    """Rows whose text has enough lines that aren't blank; the others are artefacts of the layout."""
    return records.where(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda s: F.trim(s) != "")) >= least)


def snapshot(rows: DataFrame, k: int, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    return store(validate.validate(rows).withColumn(f"valid_{k}", F.col("validity")), f"bills-{k}")


def first_stage(extracted: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The validated fields as extracted, with valid_1."""
    return snapshot(extracted, 1, store)


def second_stage(first: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(the fields after recovery, with valid_2; those of them that went through it)."""
    mended = snapshot(recover.recover(first.where("not valid"), store).drop(*validate.RESULT), 2, store)
    return first.where("valid").withColumn("valid_2", F.col("valid_1")).unionByName(mended.select(*first.columns, "valid_2")), mended


def third_stage(second: DataFrame, mended: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The fields at the end, with valid_3."""
    filled = snapshot(fallback.fill(mended.where("not valid")).drop(*validate.RESULT), 3, store)
    return second.where("valid").withColumn("valid_3", F.col("valid_2")).unionByName(filled.select(*second.columns, "valid_3"))


def staged(records: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The validated fields at first, after recovery and at the end, with valid_1, valid_2 and valid_3.

    Each stage is written by `store` and read again: 43 structs through ten stages of rules would be one huge expression tree
    otherwise. Passing rows have no bad or empty field, so recovery and fallback don't change them; only the others go through
    these and are written again, and the later snapshots are unions of what was written.
    """
    first = first_stage(extract.extract(enough_lines(records), store), store)
    second, mended = second_stage(first, store)
    return first, second, third_stage(second, mended, store)


def unpacked(df: DataFrame) -> DataFrame:
    """(record_id, the 43 output columns as plain text, "" for missing)."""
    return df.select("record_id", *[F.coalesce(F.col(f"{lex.field(c)}.value"), F.lit("")).alias(c) for c in lex.COLUMNS])


def word_total(df: DataFrame) -> DataFrame:
    return df.withColumn("n_words", x.word_count(F.col("text")))
