"""Passages that occur more than once: what substring dedup and suffix-array dedup share.

A text is a sequence of elements (bytes or words). A window is ``length`` consecutive elements of one text. An element is
repeated when some window over it also starts anywhere else. The search is exact and its work grows with the input:

1. Winnowing: the anchor of a window is its smallest k-gram (the leftmost of equals). Equal windows have equal anchors at the
   same place, and the windows of one anchor are consecutive. For each anchor a scan notes the hash of its k-gram (the seed),
   and the hash of its reach, which is all elements of its windows. This is a few numbers for every ``length / 2`` elements.
2. Seeds are joined over all texts by counting. A reach that occurs twice is repeated whole, so copies need no more work,
   however many there are. A reach that occurs once is open if others share its seed, else it is unique.
3. One copy of each reach that shares its seed with an open one is fetched and sent to the task of its seed, where a matcher
   parts all windows into classes of equal ones. A seed with more than SEED_REACHES reaches is split into blocks, each with a
   task and classes of its own; a class then stands in every block for all of its windows there, and classes of several blocks
   are joined by the hash of a window.
4. Repeated stretches are united and go back to their texts by id.

Texts stay where they are while the table of stretches fits PARTS broadcasts; beyond that they move once for each of steps 3
and 4. Nothing is dropped, capped or sampled. Seeds and reaches are 64-bit hashes each, and reaches count as equal if both are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, bounded_batches, broadcast_parts, stored
from scriva.llm.hashing import BYTE_VALUE, Rolling
from scriva.llm.jaccard import BATCH_BYTES, SAME, runs, texts_of, word_hashes

#: Bytes of text that are scanned at a time, and bytes of contents that are matched at a time (more only where one text or one group
#: has more). Either takes some hundred bytes of memory for each byte.
SCAN_BYTES, MATCH_BYTES = 1 << 18, 1 << 20

#: Reaches of one seed that are matched together (800 bytes each at most, 3 MB in all); a seed with more is split.
SEED_REACHES = 4_000
#: Stretches that one broadcast may carry.
BROADCAST_STRETCHES = 1_000_000

Scan = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def split_elements(raws: list[np.ndarray], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The elements of several texts as hashes, one after another, and where each text starts (with the end as a last entry)."""
    if not words:
        starts = np.cumsum([0, *map(len, raws)])
        return BYTE_VALUE[np.concatenate(raws)] if raws else np.empty(0, np.uint64), starts
    space = np.full(1, 32, np.uint8)
    buffer = np.concatenate([x for r in raws for x in (r, space)]) if raws else np.empty(0, np.uint8)
    hashes, first, _ = word_hashes(buffer, SAME)
    return hashes, np.searchsorted(first, np.cumsum([0, *(len(r) + 1 for r in raws)]))


def least_in_windows(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of x[i : i + w] for each i, from running minima over blocks of w to either side."""
    n = len(x) - w + 1
    full = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(elements: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Scan:
    """(text, first window, last window, seed, reach hash) of each anchor; window numbers count from the start of the text."""
    n = len(elements)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    roll = Rolling(elements)
    at = np.arange(n - gram + 1)
    grams = roll.of(at, at + gram)
    least = least_in_windows((grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64), length - gram + 1)
    inside = np.zeros(len(least) + 1, np.int32)
    long_enough = np.flatnonzero(np.diff(starts) >= length)
    np.add.at(inside, starts[long_enough], 1)
    np.add.at(inside, starts[long_enough + 1] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:-1]))
    owner = np.searchsorted(starts, window, side="right") - 1
    place = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.append(new[1:], len(window)) - 1
    lo, hi = window[new], window[last]
    owner = owner[new]
    return owner, lo - starts[owner], hi - starts[owner], grams[place[new]], roll.of(lo, hi + length)


def _scan(docs: DataFrame, words: bool, length: int, gram: int) -> DataFrame:
    """(id columns, seed, reach, lo, span): one row for each anchor."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
            for a, b in runs(sizes, SCAN_BYTES):
                elements, starts = split_elements(texts_of(batch.column("text").slice(a, b - a)), words)
                owner, lo, hi, seed, reach = anchors(elements, starts, length, gram)
                who = pa.array(owner + a)
                columns = [batch.column("doc_id").take(who), batch.column("text_key").take(who), pa.array(seed.view(np.int64)), pa.array(reach.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array((hi - lo).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "seed", "reach", "lo", "span"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_key long, seed long, reach long, lo int, span int")


def _fetch(docs: DataFrame, words: bool, length: int) -> DataFrame:
    """docs with `wanted`, an array of (lo, span, seed, reach, open, split, block) -> (seed, block, split, reach, open, content)."""
    names = ["seed", "block", "split", "reach", "open"]
    schema = pa.schema([("seed", pa.int64()), ("block", pa.int32()), ("split", pa.bool_()), ("reach", pa.int64()), ("open", pa.bool_()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for text, wanted in zip(texts_of(batch.column("text")), batch.column("wanted"), strict=True):
                content = split_elements([text], True)[0] if words else text
                for w in wanted.as_py():
                    rows.append({c: w[c] for c in names} | {"content": content[w["lo"] : w["lo"] + w["span"] + length].tobytes()})
                    held += len(rows[-1]["content"])
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.mapInArrow(run, "seed long, block int, split boolean, reach long, open boolean, content binary")


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


#: (content, start, class) of every window of some contents, in order; equal windows have equal classes, which are numbers from 0 and
#: below that of windows.
Classes = tuple[np.ndarray, np.ndarray, np.ndarray]
#: contents and their groups, in order; the length of a window -> classes. Windows of different groups are never equal.
Matcher = Callable[[list[np.ndarray], np.ndarray, int], Classes]


def _match(reaches: DataFrame, words: bool, length: int, matcher: Matcher) -> DataFrame:
    """(seed, block, split, reach, open, content) dealt by seed and block -> (seed, reach, a, b, open, window).

    Without a window, elements a to b of an open reach are repeated. Blocks of a split seed also hand on the windows that they
    have once (with their hash, and whether their reach is open) and a hash of each window that they have more often.
    """

    names = ["seed", "reach", "a", "b", "open", "window"]

    def work(part: pa.Table) -> pa.RecordBatch:
        contents = [np.frombuffer(c.as_buffer(), np.uint64 if words else np.uint8) for c in part.column("content")]
        seed, block, reach, opened, split = (part.column(c).to_numpy() for c in ("seed", "block", "reach", "open", "split"))
        groups = np.cumsum(np.concatenate(([0], (seed[1:] != seed[:-1]) | (block[1:] != block[:-1]))))
        owner, start, kind = matcher(contents, groups, length)
        times = np.bincount(kind)
        hit = (times[kind] > 1) & opened[owner]
        who, first = owner[hit], start[hit]
        new = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (first[1:] != first[:-1] + 1)))) if len(who) else np.empty(0, np.int64)
        last = np.append(new, len(who))[1:] - 1
        # One window of each class of a split seed.
        some = np.flatnonzero(split[owner])
        some = some[np.sort(np.unique(kind[some], return_index=True)[1])]
        elements = (np.concatenate(contents) if words else BYTE_VALUE[np.concatenate(contents)]) if len(some) else np.empty(0, np.uint64)
        at = np.cumsum([0, *map(len, contents)])[owner[some]] + start[some]
        hashes = Rolling(elements).of(at, at + length).view(np.int64) if len(some) else np.empty(0, np.int64)
        whose = np.append(who[new], owner[some])
        columns = [
            pa.array(seed[whose]), pa.array(reach[whose]), pa.array(np.append(first[new], start[some]).astype(np.int32)),
            pa.array((np.append(first[last], start[some]) + length).astype(np.int32)),
            pa.array(np.append(np.ones(len(new), bool), opened[owner[some]] & (times[kind[some]] == 1))),
            pa.array(np.append(np.zeros(len(new), np.int64), hashes), mask=np.arange(len(whose)) < len(new)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def pieces(whole: pa.Table) -> Iterator[pa.Table]:
        """whole, cut into tables of whole groups and about MATCH_BYTES of contents each."""
        seed, block = (whole.column(c).to_numpy() for c in ("seed", "block"))
        edges = np.flatnonzero(np.concatenate(([True], (seed[1:] != seed[:-1]) | (block[1:] != block[:-1]))))
        sizes = np.add.reduceat(np.asarray(pc.binary_length(whole.column("content")), np.int64), edges)
        edges = np.append(edges, len(whole))
        yield from (whole.slice(edges[a], edges[b] - edges[a]).combine_chunks() for a, b in runs(sizes, MATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted by seed and block; the last ones of a batch may go on in the next
            if not len(batch):
                continue
            held.append(batch)
            seed, block = (batch.column(c).to_numpy() for c in ("seed", "block"))
            at = int(np.flatnonzero((seed == seed[-1]) & (block == block[-1]))[0])
            if len(held) > 1 and not at and (held[0].column("seed")[-1].as_py(), held[0].column("block")[-1].as_py()) == (seed[-1], block[-1]):
                continue
            whole = pa.Table.from_batches(held)
            if done := len(whole) - len(batch) + at:
                yield from map(work, pieces(whole.slice(0, done)))
            held = [batch.slice(at)]
        if held:
            yield from map(work, pieces(pa.Table.from_batches(held)))

    dealt = reaches.repartition("seed", "block").sortWithinPartitions("seed", "block")
    return dealt.mapInArrow(run, "seed long, reach long, a int, b int, open boolean, window long")


def stretches(docs: DataFrame, words: bool, length: int, gram: int, matcher: Matcher, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts: doc_id, text_key, text; found: w_id, w_key, spots: array of (a, b), disjoint and in order).

    Where ids are repeated, text_key is a hash of the text, and texts are known by both.
    """
    with Scratch(docs.sparkSession) as scratch:
        texts = bounded_batches(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
        again = _repeats_ids(texts)
        texts = texts.withColumn("text_key", F.xxhash64("text") if again else F.lit(0).cast("long"))
        spots = scratch.stored(_scan(texts, words, length, gram), "repeat-anchors")
        # The four firsts come from the same row, as one aggregation sees its rows in one order.
        first = [F.first(c).alias(c) for c in ("doc_id", "text_key", "lo", "span")]
        by_reach = scratch.stored(spots.groupBy("seed", "reach").agg(F.count("*").alias("n"), *first), "repeat-reaches")
        by_seed = by_reach.groupBy("seed").agg(F.count("*").alias("reaches"), F.count_if(F.col("n") == 1).alias("single"))
        by_seed = by_seed.where("reaches > 1 and single > 0")
        blocks = F.ceil(F.col("reaches") / SEED_REACHES).cast("int")
        shared = by_reach.join(by_seed, "seed").select("seed", "reach", (F.col("n") == 1).alias("open"), F.struct("doc_id", "text_key", "lo", "span").alias("one"), (blocks > 1).alias("split"), F.pmod(F.xxhash64("reach"), blocks).cast("int").alias("block"))
        shared = scratch.stored(shared, "repeat-shared")

        # Fetch one copy of each reach that a seed's open ones must be held against.
        wanted = F.struct(F.col("one.lo").alias("lo"), F.col("one.span").alias("span"), "seed", "reach", "open", "split", "block")
        wanted = shared.groupBy(F.col("one.doc_id").alias("w_id"), F.col("one.text_key").alias("w_key")).agg(F.collect_list(wanted).alias("wanted"))
        contents = _fetch(_beside(texts, scratch.stored(wanted, "repeat-wanted"), "wanted", "inner").select("text", "wanted"), words, length)
        contents = scratch.stored(contents.dropDuplicates(["seed", "reach"]) if again else contents, "repeat-contents")
        matched = scratch.stored(_match(contents, words, length, matcher), "repeat-matched")
        part = matched.where("window is null").select("seed", "reach", "a", "b")
        across = matched.where("window is not null")
        if not across.isEmpty():
            # Blocks of a split seed have their own classes: windows of several blocks meet by hash, one row for each block.
            twice = across.groupBy("window").count().where("count > 1").select("window")
            part = part.unionByName(across.where("open").join(twice, "window").select("seed", "reach", "a", "b"))

        open_found = part.join(shared.where("open").select("seed", "reach", "one"), ["seed", "reach"])
        open_found = open_found.select("one.doc_id", "one.text_key", (F.col("one.lo") + F.col("a")).alias("a"), (F.col("one.lo") + F.col("b")).alias("b"))
        twice = by_reach.where("n > 1").select("seed", "reach")
        sure = spots.join(twice, ["seed", "reach"]).select("doc_id", "text_key", F.col("lo").alias("a"), (F.col("lo") + F.col("span") + length).alias("b"))
        found = _united(sure.unionByName(open_found)).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spots"))
        return texts, stored(found.select(F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key"), "spots"), "repeat-found")


def _united(spots: DataFrame) -> DataFrame:
    """(doc_id, text_key, a, b): overlapping and touching stretches of a text as one each."""
    text = Window.partitionBy("doc_id", "text_key").orderBy("a", "b")
    before = F.max("b").over(text.rowsBetween(Window.unboundedPreceding, -1))
    new = spots.withColumn("new", (before.isNull() | (F.col("a") > before)).cast("int"))
    of = new.withColumn("stretch", F.sum("new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    return of.groupBy("doc_id", "text_key", "stretch").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("stretch")


def _repeats_ids(texts: DataFrame) -> bool:
    """Whether some id is on several rows (then one text may be fetched twice)."""
    return not texts.groupBy("doc_id").count().where("count > 1").isEmpty()


def _beside(texts: DataFrame, side: DataFrame, column: str, how: str) -> DataFrame:
    """texts with the column (an array) that side, a stored table, has for them. Texts move only if side is too large for broadcasts."""
    parts, kept = broadcast_parts(side, ["w_id", "w_key"], BROADCAST_STRETCHES, F.size(column)) or [side], texts.columns
    for k, part in enumerate(parts):
        part = part.select(F.col("w_id").alias(f"w_id_{k}"), F.col("w_key").alias(f"w_key_{k}"), F.col(column).alias(f"{column}_{k}"))
        same = F.col("doc_id").eqNullSafe(F.col(f"w_id_{k}")) & (F.col("text_key") == F.col(f"w_key_{k}"))
        texts = texts.join(part, same, "left" if len(parts) > 1 else how)
    texts = texts.select(*kept, F.coalesce(*[f"{column}_{k}" for k in range(len(parts))]).alias(column))
    return texts.where(F.col(column).isNotNull()) if how == "inner" else texts


def cut(docs: DataFrame, words: bool, length: int, gram: int, matcher: Matcher, id_col: str = "doc_id", text_col: str = "text", passages: DataFrame | None = None) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept: the words, by spaces, or the bytes that are not repeated, n_passage_words).

    passages: the stretches of words (second result of `stretches`) that n_passage_words counts; without them it is null.
    """
    texts, found = stretches(docs, words, length, gram, matcher, id_col, text_col)
    both, counted = _beside(texts, found, "spots", "left"), F.lit(None).cast("long")
    if passages is not None:
        both = _beside(both, passages.withColumnRenamed("spots", "passages"), "passages", "left")
        counted = F.coalesce(F.expr("aggregate(passages, 0L, (n, s) -> n + s.b - s.a)"), F.lit(0).cast("long"))
    both = both.select("doc_id", "text", F.expr("transform(spots, s -> s.a)").alias("a"), F.expr("transform(spots, s -> s.b)").alias("b"), counted.alias("n_passage_words"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, a, b = (batch.column(c) for c in ("text", "a", "b"))
            counts: tuple[list[int], list[int], list[int]] = [], [], []
            kept: list[bytes] = []
            for i in range(len(texts)):
                raw = texts[i].as_buffer().to_pybytes()
                items = raw.split() if words else np.frombuffer(raw, np.uint8)
                n, gone = len(items), 0
                spans: list[tuple[int, int]] = []
                if a[i].is_valid:
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, np.array(a[i].values), 1)
                    np.add.at(change, np.array(b[i].values), -1)
                    out = np.cumsum(change[:-1]) > 0
                    spans, gone = ranges(out), int(out.sum())
                    if gone:
                        items = [w for w, o in zip(items, out.tolist(), strict=True) if not o] if words else items[~out]
                for column, value in zip(counts, (n, gone, len(spans)), strict=True):
                    column.append(value)
                kept.append(b" ".join(items) if words else raw if not gone else items.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(kept, pa.binary()), batch.column("n_passage_words")], names=["doc_id", "n", "n_removed", "n_spans", "kept", "n_passage_words"])

    return both.mapInArrow(run, f"doc_id {kind}, n long, n_removed long, n_spans long, kept binary, n_passage_words long")
