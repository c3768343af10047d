"""Source divergence audit: how far the word use of the sources of a language lies apart, by three-dimensional cube partitioning.

Documents are counted by (language, source, term) once, whole texts, with partial sums in the tasks that read them. Terms in at
least ``min_docs`` documents of a language are its kept terms; every count of one becomes a smoothed whole-number share
p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

Divergences of all pairs of sources are computed in cells: the sources of a language are cut into blocks of ``GROUPS``, its
kept terms into blocks of about ``TERMS``, and the task of a cell (source block, source block, term block) holds the slices of its
two source blocks for its term block, compares each source of the one with each of the other, and emits partial divergences that
are added up along the term axis. A slice goes to one cell for each other source block of its language, so that no task ever
holds more than 2 x GROUPS sources by one block of terms, whatever the number of sources and terms.

Defined cases: null text, language and source count as ''; a (language, source) group without any term occurs all the same, with
all counts 0; a language without kept terms has divergence 0 for all pairs and no term rows; a language of one source has no pairs;
ids are not read, repeated rows count each; an empty table gives an empty result; further columns are not read. Equal values rank
by the bytes of their items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, bounded_batches, small, stored

#: Runs of letters: ASCII letters and every byte of a character outside ASCII.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE, SMOOTH = 1_000_000_000, 5
MIN_DOCS, TOP = 30, 50
#: Sides of a cell: sources of a block, kept terms of a block (about, as terms are placed by hash).
GROUPS, TERMS = 64, 1_024
#: Different (group, term) pairs that a counting task holds before it hands them on; bytes of a text that are cut into terms together.
HELD, PIECE = 300_000, 1 << 20
#: In a counting task n occurrences in d documents are the number n + d * ONE_DOC.
ONE_DOC = 1 << 40


def terms_of(raw: bytes) -> Counter[bytes]:
    """The terms of a text, A-Z lower-cased, and how often each occurs."""
    if len(raw) <= PIECE:
        return Counter(TERM.findall(raw.lower()))
    found, at = Counter(), 0
    while at < len(raw):
        end = at + PIECE
        while end < len(raw) and TERM.match(raw, end):  # a piece ends where no term goes on
            end = TERM.match(raw, end, end + PIECE).end()
        found.update(TERM.findall(raw[at:end].lower()))
        at = end
    return found


def count_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): partial counts; each group that occurs also has rows with a null term."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def table(held: dict[tuple[str, str], Counter[bytes]]) -> pa.RecordBatch:
        keys = [k for k, c in held.items() for _ in range(len(c) + 1)]
        terms = [t for c in held.values() for t in (None, *c)]
        sums = np.array([n for c in held.values() for n in (0, *c.values())], np.int64)
        langs, sources = (pa.array([k[i] for k in keys], pa.string()) for i in (0, 1))
        columns = [langs, sources, pa.array(terms, pa.binary()).view(pa.string()), pa.array(sums % ONE_DOC), pa.array(sums // ONE_DOC)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Counter[bytes]] = {}
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                sums = held.setdefault((lang, source), Counter())
                for term, n in terms_of(text.as_buffer().to_pybytes()).items():
                    sums[term] += n + ONE_DOC
            if sum(map(len, held.values())) > HELD:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    return bounded_batches(rows).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 kept)), exact; 0 without kept terms."""
    wide = "decimal(20,0)"
    part = F.call_function("div", F.lit(SCALE).cast(wide) * (n + SMOOTH).cast(wide), (total + SMOOTH * kept).cast(wide))
    return F.when(kept > 0, part + 1).otherwise(F.lit(0)).cast("long")


def kept_counts(docs: DataFrame, scratch: Scratch, min_docs: int = MIN_DOCS, **columns: str) -> tuple[DataFrame, DataFrame]:
    """counts (lang, source, term, n, lang_n: of the term in the language) of kept terms, and groups (lang, source, total, kept,
    lang_total, place).

    Counts are partitioned by term and language alone, so that the sums of a group and of its language take one shuffle."""
    by = ["lang", "term"]
    each = count_terms(docs, **columns).repartition(*by).groupBy(*by, "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy(*by)
    each = each.withColumns({"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole)}).where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
    each = scratch.stored(each.drop("lang_docs"), "audit-counts")
    counts = each.where(F.col("term").isNotNull())
    terms = each.select("lang", "term", "lang_n").distinct()
    langs = terms.groupBy("lang").agg(F.count("term").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = totals.join(langs, "lang").withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return counts, scratch.stored(groups, "audit-groups")


def term_block() -> Column:
    return F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / TERMS)).cast("int")


def cells(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, block, g, source, place, term, p, p0, here): the slices of every cell; g is the source block of a row.

    A row with a term has the share of a source for it; a row without one says that the source is there, with its share p0 of a term
    that it lacks and the number of kept terms of the block."""
    facts = groups.select("lang", "source", "place", "total", "kept", F.floor(F.col("place") / GROUPS).cast("int").alias("g"))
    langs = small(groups.groupBy("lang").agg(F.first("kept").alias("kept"), F.floor(F.max("place") / GROUPS).cast("int").alias("last")))[0]
    blocks = counts.select("lang", "term").distinct().join(langs, "lang").groupBy("lang", term_block().alias("block")).agg(F.count("*").alias("here"))
    there = facts.join(blocks, "lang", "left").select("lang", "g", F.coalesce("block", F.lit(0)).alias("block"), "source", "place", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), share(F.lit(0), F.col("total"), F.col("kept")).alias("p0"), F.coalesce("here", F.lit(0)).alias("here"))
    shares = counts.join(small(facts)[0], ["lang", "source"]).select("lang", "g", term_block().alias("block"), F.lit(None).cast("string").alias("source"), "place", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), F.lit(None).cast("long").alias("p0"), F.lit(None).cast("long").alias("here"))
    slices = there.unionByName(shares).join(langs.drop("kept"), "lang")
    to = F.transform(F.sequence(F.lit(0), F.col("last")), lambda h: F.struct(F.least("g", h).alias("i"), F.greatest("g", h).alias("j")))
    return slices.select("*", F.explode(to).alias("cell")).select("lang", "cell.i", "cell.j", "block", "g", "source", "place", "term", "p", "p0", "here")


def compare(cell: pa.Table) -> pa.Table:
    """The partial divergence of each pair (a before b) of a cell: over its terms, also those that neither source has."""
    there, shares = cell.filter(cell.column("term").is_null()), cell.filter(cell.column("term").is_valid())
    order = np.argsort(there.column("place").to_numpy())
    places = there.column("place").to_numpy()[order]
    names = there.column("source").take(pa.array(order)).to_pylist()
    p0 = there.column("p0").to_numpy()[order]
    here = there.column("here")[0].as_py()
    coded = shares.column("term").combine_chunks().dictionary_encode()
    p = np.repeat(p0[:, None], max(1, len(coded.dictionary)), 1)
    if len(shares):
        p[np.searchsorted(places, shares.column("place").to_numpy()), coded.indices.to_numpy()] = shares.column("p").to_numpy()
    unseen = here - len(coded.dictionary)
    i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
    of = there.column("g").to_numpy()[order]
    a_rows, b_rows = np.flatnonzero(of == i), np.flatnonzero(of == j)
    one, other, value = [], [], []
    for a in a_rows:
        later = b_rows[b_rows > a]
        if len(later):
            seen = np.abs(p[later] - p[a]).sum(1) if len(shares) else 0
            one += [names[a]] * len(later)
            other += [names[b] for b in later]
            value.append(seen + unseen * np.abs(p0[later] - p0[a]))
    lang = cell.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "a": pa.array(one, pa.string()), "b": pa.array(other, pa.string()), "part": pa.array(np.concatenate(value) if value else [], pa.int64())})


def ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("int"))
    return rows.where(F.col("rank") <= top) if top else rows


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language all others by divergence (part 'pair'), and the `top`
    terms that it uses more than its language does (part 'term')."""
    with Scratch(docs.sparkSession) as scratch:
        counts, groups = kept_counts(docs, scratch, min_docs, **columns)
        parts = cells(counts, groups).groupBy("lang", "i", "j", "block").applyInArrow(compare, "lang string, a string, b string, part long")
        pairs = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
        both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
        pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
        known = counts.join(small(groups)[0], ["lang", "source"])
        over = share(F.col("n"), F.col("total"), F.col("kept")) - share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
        terms = known.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value")).where("value > 0")
        return stored(ranked(pairs).unionByName(ranked(terms, top)), "audit")


def sql() -> str:
    """The audit as one DuckDB statement over `documents`."""
    share = lambda n, total: f"CAST(1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * kept) AS BIGINT)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, count(*) AS kept, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(kept, 0) AS kept, coalesce(lang_total, 0) AS lang_total, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)),
p AS (SELECT lang, source, term, lang_n, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'total')} AS p, {share('lang_n', 'lang_total')} AS q
    FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pair AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM u WHERE part = 'pair' OR rank <= 50"""
