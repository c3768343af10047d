"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). A document contains a window
only if it contains every shingle of it, so one shingle is a sufficient prefix: the one that the documents hold least often.
Steps:

1. every document position whose shingle (``shingle`` words, hashed) occurs in the benchmark is kept, with the few words
   around it that any window over that shingle could need;
2. shingles are ordered by how often the documents hold them; windows with a shingle that none holds are out, the others
   keep their rarest shingle as the prefix;
3. positions join windows on the prefix; a match must start at or after the first word and end by the last one (positional
   and length bounds), and its words must equal the window's.

Document texts are read once and never shuffled. What moves grows with the benchmark passages found, not with the words of
the corpus. The benchmark's shingles are up to ``PARTS`` broadcasts of ``BROADCAST_ROWS``; only a benchmark of more shingles
than that makes the positions (a hash and a block of words each) move.

Defined cases: null and empty texts have no words and are clean; items without words have no windows; a null item_id marks
words but is not listed; repeated item_ids are one item; repeated doc_ids stay apart (rows are told apart by a stored row
number, in ``drop_leaks`` by a hash of their text); an empty benchmark leaves all clean; further columns are not read by
``contamination`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriva.llm.common import ascii_lower, broadcast_parts, small, stored, without

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 5
#: Positions of a text that go on together.
BLOCK = 48


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_A_WORD), "")


def shingle_hashes(length: int) -> Column:
    """The hash of the shingle at each of a block's BLOCK positions (which begin at place `at` of its words w); null where words run out."""
    parts = ", ".join(f"get(w, i + {k})" for k in range(length))
    return F.expr(f"transform(sequence(at, at + {BLOCK - 1}), i -> if(i + {length} <= size(w), xxhash64({length}, {parts}), cast(null as bigint)))")


def item_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item_id, w: the words of a window), one row for each."""
    words = items.select(F.col(item_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    starts = F.expr(f"sequence(0, greatest(size(w) - {window}, 0))")
    return words.withColumn("s", F.explode(starts)).select("item_id", F.expr(f"slice(w, s + 1, {window})").alias("w"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, row, n_words, n_hit, item_ids (array<string>, sorted)."""
    of_items = stored(item_windows(items, window, item_col, item_text_col), "leak-items")
    sequences = stored(of_items.select("w").distinct().withColumn("wid", F.monotonically_increasing_id()), "leak-windows")
    lengths = sorted(r[0] for r in sequences.select(F.least(F.size("w"), F.lit(shingle))).distinct().collect())  # at most `shingle` numbers

    tokens = [F.expr(f"transform(filter(sequence(0, size(w) - 1), i -> size(w) >= {n} and i + {n} <= size(w) and {n} = least(size(w), {shingle})), i -> struct({n} as n, i as off, xxhash64({n}, {', '.join(f'get(w, i + {k})' for k in range(n))}) as token))") for n in lengths]
    every = F.concat(*tokens) if tokens else F.expr("cast(array() as array<struct<n:int,off:int,token:bigint>>)")
    of_window = stored(sequences.withColumn("t", F.explode(every)).select("wid", "w", "t.n", "t.off", "t.token"), "leak-tokens")
    known = stored(of_window.select(F.col("token").alias("known")).distinct(), "leak-known")

    # A text goes on in blocks that carry the words that windows over their positions could need, so that work grows with its length.
    left = max(window - min(lengths, default=0), 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words")).withColumn("row", F.monotonically_increasing_id())
    cut = F.expr(f"transform(sequence(0, greatest(size(words) - 1, 0), {BLOCK}), k -> struct(k, least(k, {left}) as at, slice(words, greatest(k - {left}, 0) + 1, least(k, {left}) + {BLOCK + window}) as w))")
    blocks = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.explode(cut).alias("b")).select("row", "doc_id", "n_words", "b.*")
    # Entry 0 of the first block stands for the document itself, entries from 1 for positions, once for each shingle length.
    entries = F.concat(F.array(F.lit(0).cast("long")), *[shingle_hashes(n) for n in lengths])
    found = blocks.select("row", "doc_id", "n_words", "k", "at", "w", F.posexplode(entries).alias("entry", "token")).where("if(entry = 0, k = 0, token is not null)")
    is_known = F.col("entry") == 0
    for k, part in enumerate(broadcast_parts(known, ["known"]) or [known]):
        found = found.join(part.select(F.col("known").alias(f"known_{k}")), (F.col("token") == F.col(f"known_{k}")) & (F.col("entry") > 0), "left")
        is_known = is_known | F.col(f"known_{k}").isNotNull()
    place = f"at + (entry - 1) % {BLOCK}"
    around = F.expr(f"if(entry = 0, null, slice(w, greatest({place} - {left}, 0) + 1, least({place}, {left}) + {window}))")
    pos = F.expr(f"if(entry = 0, null, cast(k + (entry - 1) % {BLOCK} as int))")
    found = found.where(is_known).select("row", "doc_id", "n_words", F.when(F.col("entry") > 0, F.col("token")).alias("token"), pos.alias("pos"), around.alias("around"))
    found = stored(found, "leak-found")
    heads, hits = found.where("pos is null"), found.where("pos is not null")

    often = hits.groupBy("token").agg(F.count("*").alias("often"))
    rarity = of_window.join(often, "token", "left")
    prefix = rarity.groupBy("wid").agg(F.min("w").alias("w"), F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "off", "token")).alias("p")).where("p.often > 0")
    prefix, _ = small(stored(prefix.select("wid", "w", F.size("w").alias("len"), F.col("p.off").alias("off"), F.col("p.token").alias("token")), "leak-prefix"))

    match = hits.join(prefix, "token").withColumn("start", F.col("pos") - F.col("off"))
    match = match.where("start >= 0 and start + len <= n_words").where(f"slice(around, start - greatest(pos - {left}, 0) + 1, len) = w")
    match = stored(match.select("row", "wid", "start", "len").distinct(), "leak-match")

    before = F.coalesce(F.max(F.col("start") + F.col("len")).over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = F.col("start") + F.col("len")
    new = F.greatest(end - F.greatest(F.col("start"), before), F.lit(0))
    hit = match.select("row", "start", "len").distinct().select("row", new.alias("new")).groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))
    ids = match.select("row", "wid").distinct().join(of_items.join(sequences, "w").select("wid", F.col("item_id").cast("string").alias("item_id")).distinct(), "wid")
    ids = ids.select("row", "item_id").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    out = heads.select("row", "doc_id", "n_words").join(hit.join(ids, "row", "left"), "row", "left")
    return out.select("doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs whose text has no benchmark window, with all their columns."""
    digest = F.sha2(F.col(text_col), 256)
    rows = docs.select(F.struct(F.col(id_col).alias("id"), digest.alias("hash")).alias("doc_id"), F.col(text_col).alias("text"))
    leaked = contamination(rows, items, **options).where("n_hit > 0")
    gone = stored(leaked.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.hash").alias("__hash")).distinct(), "leak-ids")
    # An id alone may be null or stand for several texts.
    return without(docs, gone, ["__id", "__hash"], lambda d, side: d[id_col].eqNullSafe(side["__id"]) & (F.sha2(d[text_col], 256) == side["__hash"]))
