"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked. The rank divided by the size of the source is a
fractional position in [0, 1); ordering all rows by it interleaves the sources in proportion, so that each contiguous cut of
that order has the mixture of the whole. The cuts are at equal row counts (law ``rows``: counts differ by one at most). The
shuffle is by a hash of the text, so equal texts follow one another within a source and have nearly the same fraction in
others: they mostly come to one shard, as far as the law allows.

Ranks need no task that holds a whole source: rows are counted in hash ranges of bounded size, a running sum over those
counts gives each range its first rank, and only the inside of a range is sorted. The second ranking, over fractions, works
alike. Only narrow rows move (id, size, checksum, source), never texts.

Defined cases: a null text has 0 bytes and checksum 0; a null source is a source of its own; null and repeated doc_ids are
allowed (rows equal in all that is read are interchangeable); an empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriva.llm.common import stored

#: Rows that one range should hold; the number of ranges grows with the input.
RANGE_ROWS = 20_000


def assign_shards(docs: DataFrame, n_shards: int = 24, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, source, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    facts = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    # Equal texts have one place in the shuffle of every source, so that they mostly come to one shard.
    facts = stored(facts.withColumns({"h": F.xxhash64(F.lit(seed), "text_crc32", "size"), "g": F.xxhash64(F.lit(seed), "doc_id", "source")}), "shard-facts")
    total = facts.count()
    n_ranges = max(1, -(-total // RANGE_ROWS))
    # The hash is uniform over the signed longs; its upper 31 bits choose the range.
    ranged = facts.withColumn("r", F.floor((F.shiftrightunsigned("h", 33) * F.lit(n_ranges)) / F.lit(1 << 31)).cast("int"))

    # A range that one frequent text fills is cut again, by a hash of the id.
    def part(hash_col: str, n: Column) -> Column:
        return F.floor((F.shiftrightunsigned(hash_col, 33) * n) / F.lit(1 << 31)).cast("int")

    source = F.col("source")
    full = stored(ranged.groupBy("source", "r").count().where(F.col("count") > 2 * RANGE_ROWS), "shard-full")
    full = full.select(F.col("source").alias("f_source"), F.col("r").alias("f_r"), F.ceil(F.col("count") / RANGE_ROWS).alias("parts"))
    ranged = ranged.join(F.broadcast(full), source.eqNullSafe(F.col("f_source")) & (F.col("r") == F.col("f_r")), "left")
    ranged = ranged.withColumn("p", part("g", F.coalesce("parts", F.lit(1)))).drop("f_source", "f_r", "parts")
    counts = ranged.groupBy("source", "r", "p").count()
    in_source = Window.partitionBy("source")
    counts = counts.select("source", "r", "p", (F.sum("count").over(in_source.orderBy("r", "p")) - F.col("count")).alias("before"), F.sum("count").over(in_source).alias("n_source"))
    counts = stored(counts, "shard-counts")
    in_range = Window.partitionBy("source", "r", "p").orderBy("h", "g", "doc_id", "size", "text_crc32")
    ranked = ranged.withColumn("k", F.row_number().over(in_range))
    c = counts.select(F.col("source").alias("c_source"), F.col("r").alias("c_r"), F.col("p").alias("c_p"), "before", "n_source")
    ranked = ranked.join(c, source.eqNullSafe(F.col("c_source")) & (F.col("r") == F.col("c_r")) & (F.col("p") == F.col("c_p")))
    # Twice the rank less one over twice the size: the middle of the row's share, never 0 or 1.
    fraction = (2 * (F.col("before") + F.col("k")) - 1) / (2 * F.col("n_source"))
    placed = ranked.select("doc_id", "source", "size", "text_crc32", "h", "g", fraction.alias("f"))
    placed = stored(placed.withColumn("q", F.least(F.floor(F.col("f") * n_ranges), F.lit(n_ranges - 1)).cast("int")), "shard-placed")
    quota = placed.groupBy("q").count().select("q", (F.sum("count").over(Window.orderBy("q")) - F.col("count")).alias("first"))
    in_cut = Window.partitionBy("q").orderBy("f", "source", "h", "g", "doc_id", "size", "text_crc32")
    at = placed.withColumn("j", F.row_number().over(in_cut)).join(F.broadcast(quota) if n_ranges <= 1_000_000 else quota, "q")
    position = (F.col("first") + F.col("j") - 1).cast("long")
    at = at.withColumn("position", position)
    shard = F.expr(f"int(position * {n_shards} div {max(total, 1)})")
    start = F.expr(f"(shard * bigint({total}) + {n_shards - 1}) div {n_shards}")
    return at.withColumn("shard", shard).select("doc_id", "source", "size", "text_crc32", "shard", (F.col("position") - start).cast("long").alias("slot"))
