"""Exact dedup by progressive refinement: length, then a hash of the first characters, then a hash of the whole.

Texts are equal when they are the same once the characters of ``[\\x20\\x09-\\x0D]`` are deleted. Of equal texts the row with
the most code points in the original text stays, then the smallest doc_id (null ids last), then one row of those that are
repeated whole.

Defined cases: a null text counts as empty; empty texts are equal to one another; doc_ids may be null or repeated (rows are
told apart by a row number that is stored with the facts); an empty table gives an empty result; further columns of the
input, whatever their names, are not read by ``mark_copies`` and are kept as they are by ``drop_copies``.

Texts stay where they are: what moves is one narrow row for each document that may have an equal. With more groups of equal
length and prefix than a few broadcasts hold (``PARTS * OPEN_GROUPS``), every row is hashed in place, which costs less than
moving texts to their groups and gives the same result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, broadcast_parts, small, stored, without

BLANKS = " \t\n\x0b\f\r"
PREFIX_CHARS = 64
#: Groups of equal length and prefix in one broadcast (two numbers each).
OPEN_GROUPS = 500_000


def normalised(text: Column) -> Column:
    # Six passes of `replace`, which works on bytes, take less time than one of `translate`, which works on characters.
    return functools.reduce(lambda left, blank: F.replace(left, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, full_hash.

    full_hash (sha256, hex) is null for rows that the length or the prefix already tells apart, unless digests is set.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    clean = rows.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_code"), normalised(F.col("text")).alias("norm"))
    keyed = clean.withColumns({"n_norm": F.octet_length("norm"), "head": F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))})

    # Lengths, then prefixes, that more than one row has. Both counts combine before they shuffle.
    with Scratch(docs.sparkSession) as scratch:
        heads = scratch.stored(keyed.groupBy("n_norm", "head").count(), "exact-heads")
        lengths = heads.groupBy("n_norm").agg(F.sum("count").alias("of_length")).where("of_length > 1")
        open_keys = scratch.stored(heads.where("count > 1").join(lengths, "n_norm", "left_semi").select("n_norm", "head"), "exact-open")
        parts = broadcast_parts(open_keys, ["n_norm", "head"], OPEN_GROUPS)
        is_open = F.lit(parts is None)
        for k, part in enumerate(parts or []):
            keyed = keyed.join(part.withColumn(f"open_{k}", F.lit(True)), ["n_norm", "head"], "left")
            is_open = is_open | F.coalesce(f"open_{k}", F.lit(False))
        digest = F.sha2("norm", 256)
        full_hash = (digest if digests else F.when(is_open, digest)).alias("full_hash")
        facts = stored(keyed.select("doc_id", "n_code", is_open.alias("open"), full_hash, F.monotonically_increasing_id().alias("row")), "exact-facts")

    best = F.struct((-F.col("n_code")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = facts.where("open").groupBy("full_hash").agg(F.count("*").alias("group_size"), F.min(best).alias("best")).where("group_size > 1")
    groups = groups.select("full_hash", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    # Read from its table, this side leaves the other free to be split where many rows have one hash.
    groups, _ = small(stored(groups, "exact-groups"))
    joined = facts.where("open").join(groups, "full_hash", "left")
    alone = F.col("keep_row").isNull()
    dup = joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "full_hash",
    )
    single = facts.where("not open").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "full_hash")
    return single.unionByName(dup)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    marked = mark_copies(docs, id_col, text_col)
    gone = marked.where("not kept").select(F.col("doc_id").alias("__id"), F.col("full_hash").alias("__hash"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("__again"))
    losers = stored(gone.groupBy("__id", "__hash").agg(F.max("__again").alias("__again")), "exact-losers")

    def same(rows: DataFrame, side: DataFrame) -> Column:
        return rows[id_col].eqNullSafe(side["__id"]) & (F.sha2(normalised(rows[text_col]), 256) == side["__hash"])

    left = without(docs, losers, ["__id", "__hash"], same)
    if losers.where("__again").isEmpty():
        return left
    # Some row is repeated under one id: of such rows one stays.
    digest = "scriva full hash"
    again, _ = small(losers.where("__again"))
    rows = docs.join(again, same(docs, again), "left_semi")
    return left.unionByName(rows.withColumn(digest, F.sha2(normalised(F.col(text_col)), 256)).dropDuplicates([id_col, digest]).drop(digest))
