"""N-gram Jaccard join: all documents whose sets of word shingles are alike, as components of the links.

A document's set is its distinct shingles of ``words`` words, as sorted 64-bit hashes. Two sets link when
100 * |A and B| >= percent * |A or B|.

1. Equal sets (by size and two fingerprints) become one numbered class, so copies never meet one another. One text stands for
   it, found again by its doc_id and a 64-bit hash of the text.
2. Size-banded tiles: sizes are cut into bands; a pair that links has sizes in one band or at the edge of the next. For a band
   whose largest size is u, at most d = (100 - p) / (100 + p) * 2u elements differ. The hash space is dealt into n bins, in r
   independent ways; a (band, way, bin, contents) is a tile of every set with these contents there. The d elements leave n * r *
   (1 - 1/n)^d bins untouched on average; n and r make these MISS or more (empty bins not counted), so that a linking pair shares
   no tile with a chance of about e^-MISS, less than that of two unequal shingles with the same 64-bit hash in a large corpus. A
   set near the top of its band also gets the tiles of the next.
3. Tiles that two sets share tie them into clusters, each within one band. Every set of a cluster has a bitmap signature with
   about as many bits as the set has elements: bit k is the parity of the number of elements that hash to k, so the bits in
   which two signatures differ are at most the elements in which the sets differ, which bounds the overlap from above. Pairs
   that pass make smaller clusters; only the sets of these are fetched and decided by exact intersection of sorted arrays.
4. A cluster too large for a task is cut into blocks, which are compared within; a few sets of the cluster are in all blocks,
   so that copies of one text hang together. Only sets that are not in the largest part so found are compared with the other
   blocks. What a task hands on is a spanning forest of the links it found, never all pairs.

Components come from repeated neighbour minima over the link table. Nothing is dropped or capped.

Defined cases: null, empty and blank texts have an empty set, no links and themselves as component; a text of fewer words than
a shingle is one shingle; links are between sets, so different texts under a repeated or null doc_id are told apart and each
has its own links; a component has null as its name only if no text in it has an id; ``one_of_each`` keeps the text with the
smallest id (null last), once, and all texts without a shingle; further columns are not read by ``components`` and kept by
``one_of_each``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, bounded_batches, small, stored, without
from scriva.llm.graph import connected
from scriva.llm.hashing import BYTE_VALUE, Rolling, mix

SHINGLE, PERCENT = 3, 90
#: Growth of the size bands.
BAND = 1.3
#: Average number of tiles that the least alike pair that links shares, at least.
MISS = 40
#: Tiles of a set in one band, unless MISS takes more: the more tiles, the more elements in each, the fewer false ties.
TILES = 128
LEAST_BITS = 512
#: What one task should hold of one block of a cluster: sets by elements, signatures by bits.
BLOCK_ELEMENTS = 1_500_000
BLOCK_BITS = 16_000_000
#: Sets of a cluster of several blocks that each of its blocks holds, on average.
HUBS = 32
BATCH_BYTES = 1 << 20

#: Salts of the two fingerprints of a set.
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def word_hashes(raw: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word (run without white space) of a buffer of bytes."""
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    return Rolling(BYTE_VALUE[fold[raw]]).of(first, end), first, end


def shingle_sets(raws: list[np.ndarray], n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, given as bytes."""
    space = np.full(1, 32, np.uint8)
    buffer = np.concatenate([x for r in raws for x in (r, space)]) if raws else np.empty(0, np.uint8)
    hashes, first, _ = word_hashes(buffer)
    cuts = np.searchsorted(first, np.cumsum([0, *(len(r) + 1 for r in raws)]))
    factors = [mix(np.array([k + 11], np.uint64))[0] | np.uint64(1) for k in range(n)]
    whole = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for k in range(n):
        whole += hashes[k : len(hashes) - n + 1 + k] * factors[k]
    whole = mix(whole)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        elif b > a:
            out.append(mix(np.array([sum(int(h) * int(f) for h, f in zip(hashes[a:b], factors, strict=False)) + int(b - a) & (1 << 64) - 1], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def texts_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint8) if t.is_valid else np.empty(0, np.uint8) for t in column]


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `most` bytes each."""
    group = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def band_of(size: int) -> int:
    return int(np.floor(np.log(size) / np.log(BAND) + 1e-9))


def band_top(band: int) -> int:
    """The largest size in the band."""
    top = int(np.ceil(BAND ** (band + 1))) + 1
    while band_of(top) > band:
        top -= 1
    return top


@functools.cache
def ranges_of(band: int, percent: int) -> tuple[int, int]:
    """(bins, ways) of a band; (0, 0) if only equal sets link."""
    top = band_top(band)
    d = (100 - percent) * 2 * top // (100 + percent)
    if not d:
        return 0, 0
    # A linking pair with its larger set in the band has so many elements in common.
    common = max(-(-percent * (band_top(band - 1) + 1 if band else 1) // 100), 1)
    n = np.arange(2, 4 * d + 64, dtype=float)
    untouched = n * (1 - 1 / n) ** d * (1 - (1 - 1 / n) ** common)
    ways = np.ceil(MISS / np.maximum(untouched, 1e-9))
    cost = n * ways
    best = int(np.argmax(cost <= max(TILES, cost.min())))
    return int(n[best]), int(ways[best])


def bands_of(size: int, percent: int) -> list[int]:
    """The bands in which a set of that size looks for partners: its own, and the next if a set of that can link with it."""
    own = band_of(size)
    return [own, own + 1] if 100 * size >= percent * (band_top(own) + 1) else [own]


def tiles_of(elements: np.ndarray, band: int, percent: int = PERCENT) -> np.ndarray:
    """The keys of the tiles of a band that a set belongs to."""
    n, ways = ranges_of(band, percent)
    if not n:
        return np.empty(0, np.uint64)
    dealt = mix(elements[None, :] ^ mix(np.arange(1, ways + 1, dtype=np.uint64))[:, None])
    place = ((dealt >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64) + np.arange(ways)[:, None] * n
    sums = np.zeros(n * ways, np.uint64)
    np.add.at(sums, place.ravel(), mix(dealt).ravel())
    filled = np.flatnonzero(sums)
    return mix(sums[filled] + mix(filled.astype(np.uint64) + np.uint64(band) * np.uint64(1 << 40)))


def nodes_of(f1: np.ndarray, band: np.ndarray) -> np.ndarray:
    """The names of sets, known by their fingerprints, in bands."""
    return mix(f1.view(np.uint64) + band.astype(np.uint64)).view(np.int64)


def signature(elements: np.ndarray, size: int) -> np.ndarray:
    """Bit k is the parity of the number of elements whose low bits are k; the bits are the power of two from `size` on."""
    bits = 1 << (max(size, LEAST_BITS) - 1).bit_length()
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(signs: list[np.ndarray]) -> np.ndarray:
    """The signatures, all as short as the shortest: those of half as many bits are the two halves added."""
    least = min(map(len, signs))
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, least), axis=0) for s in signs])


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, as signed numbers."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, full = np.concatenate([np.empty(0, np.uint64), *sets]), sizes > 0
    starts, sums = (np.cumsum(sizes) - sizes)[full], np.zeros((2, len(sets)), np.uint64)
    if len(flat):
        sums[0, full] = np.add.reduceat(mix(flat ^ SALTS[0]), starts)
        sums[1, full] = np.add.reduceat(mix(flat + SALTS[1]), starts)
    return mix(sums[0] + sizes.astype(np.uint64)).view(np.int64), sums[1].view(np.int64)


def _scan(words: int, docs: DataFrame, schema: str, rows: Callable[[pa.RecordBatch, list[np.ndarray]], list[pa.Array]]) -> DataFrame:
    """What `rows` makes of some documents and their sets at a time."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
            for a, b in runs(sizes, BATCH_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(rows(part, shingle_sets(texts_of(part.column("text")), words)), names=names)

    return docs.mapInArrow(run, schema)


def _facts(words: int, kind: str, docs: DataFrame) -> DataFrame:
    """(doc_id, hash, n, f1, f2): the text's hash, size and fingerprint of each document's set."""

    def rows(part: pa.RecordBatch, sets: list[np.ndarray]) -> list[pa.Array]:
        return [part.column("doc_id"), part.column("hash"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, fingerprints(sets))]

    return _scan(words, docs, f"doc_id {kind}, hash long, n long, f1 long, f2 long", rows)


def shared_in_chunk(nodes: np.ndarray, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (node, tile) for which a tile that several nodes here share is handed on for the least of them only.

    They are tied to one another by a tile of their own, so that a tile that very many sets share doesn't meet in one place.
    """
    order = np.lexsort((nodes, tiles))
    nodes, tiles = nodes[order], tiles[order]
    new = np.ones(len(tiles), bool)
    new[1:] = (tiles[1:] != tiles[:-1]) | (nodes[1:] != nodes[:-1])
    nodes, tiles = nodes[new], tiles[new]
    first = np.ones(len(tiles), bool)
    first[1:] = tiles[1:] != tiles[:-1]
    shared = ~first
    shared[:-1] |= ~first[1:]
    # The same rows give the same names when a task runs again.
    own = mix(tiles[shared] ^ mix(np.array([len(tiles)], np.uint64) + np.sum(tiles, dtype=np.uint64)))
    return np.append(nodes[first], nodes[shared]), np.append(tiles[first], own)


def _tiles(percent: int, words: int, docs: DataFrame) -> DataFrame:
    """(node, tile): a row for every tile of every document, which has a node in each of its bands."""

    def rows(part: pa.RecordBatch, sets: list[np.ndarray]) -> list[pa.Array]:
        found = [(k, band, tiles_of(s, band, percent)) for k, s in enumerate(sets) if len(s) for band in bands_of(len(s), percent)]
        at, bands = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        nodes = np.repeat(nodes_of(fingerprints(sets)[0][at], bands), [len(t) for *_, t in found])
        nodes, keys = shared_in_chunk(nodes, np.concatenate([np.empty(0, np.uint64), *(t for *_, t in found)]))
        return [pa.array(nodes), pa.array(keys.view(np.int64))]

    return _scan(words, docs, "node long, tile long", rows)


def _nodes(percent: int, classes: DataFrame) -> DataFrame:
    """(class, node) of the classes, as their tiles name them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bands_of(n, percent) for n in batch.column("n").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            nodes = nodes_of(batch.column("f1").to_numpy()[at], np.array([x for f in found for x in f], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("class").take(pa.array(at)), pa.array(nodes)], names=["class", "node"])

    return classes.select("class", "n", "f1").mapInArrow(run, "class long, node long")


def _contents(words: int, docs: DataFrame, content: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(class, size, content) of the texts given, (class, text): at most once in a task, however often the text is repeated."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = [not (c in seen or seen.add(c)) for c in batch.column("class").to_pylist()]
            batch = batch.filter(pa.array(new, pa.bool_()))
            sizes = np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
            for a, b in runs(sizes, BATCH_BYTES) if len(sizes) else ():
                part = batch.slice(a, b - a)
                sets = shingle_sets(texts_of(part.column("text")), words)
                yield pa.RecordBatch.from_arrays([part.column("class"), pa.array([len(s) for s in sets], pa.int64()), pa.array([content(s) for s in sets], pa.binary())], names=["class", "size", "content"])

    return docs.mapInArrow(once, "class long, size long, content binary")


def _sets(words: int, docs: DataFrame) -> DataFrame:
    """The sorted elements of the texts given."""
    return _contents(words, docs, lambda s: s.tobytes())


def _signatures(words: int, docs: DataFrame) -> DataFrame:
    """The bitmap signatures of the texts given."""
    return _contents(words, docs, lambda s: signature(s, len(s)).tobytes())


def link_forest(size: np.ndarray, sign: np.ndarray, sets: list[np.ndarray] | None, side: np.ndarray, across: bool, percent: int) -> list[tuple[int, int]]:
    """Links that connect all that the links among these sets connect; without the sets, all whose signatures don't exclude a link.

    across: only pairs from different sides are looked at.
    """
    order = np.argsort(size, kind="stable")
    size, sign, side = size[order], sign[order], side[order]
    label = np.arange(len(size))
    links = []
    for i in range(len(size)):
        # Later sets are no smaller: sizes up to size / p can link.
        last = np.searchsorted(size, size[i] * 100 // percent, side="right")
        if last <= i + 1:
            continue
        near = np.arange(i + 1, last)
        near = near[label[near] != label[i]]
        if across:
            near = near[side[near] != side[i]]
        if not len(near):
            continue
        differ = np.bitwise_count(sign[near] ^ sign[i]).sum(1, dtype=np.int64)
        both = size[near] + size[i]
        near = near[(100 + percent) * (both - differ) >= 2 * percent * both]
        for j in near:
            if label[j] == label[i]:
                continue
            if sets is not None:
                a, b = sets[order[i]], sets[order[j]]
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared = int((b[at] == a).sum())
                if 100 * shared < percent * (len(a) + len(b) - shared):
                    continue
            links.append((int(order[i]), int(order[j])))
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label[label == old] = new
    return links


def _compared(dealt: DataFrame, exact: bool, percent: int) -> DataFrame:
    """(a, b): for each (cluster, i, j) a forest of the links among its sets, or, if j is not null, between its two sides."""

    def decide(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        _, one = np.unique(rows.column("class").to_numpy(), return_index=True)
        rows = rows.take(pa.array(np.sort(one))).combine_chunks()
        held, size = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("content")], rows.column("size").to_numpy()
        sign = np.stack([signature(x, int(size.min())) for x in held]) if exact else folded(held)
        found = link_forest(size, sign, held if exact else None, rows.column("side").to_numpy(), key[2].as_py() >= 0, percent)
        ids, ends = rows.column("class").to_numpy(), np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(ids[ends[:, 0]], pa.int64()), "b": pa.array(ids[ends[:, 1]], pa.int64())})

    # A count of its own keeps the adaptive planner from putting many small groups, each of which takes a while, into one task.
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "cluster", "i", "j").groupBy("cluster", "i", "j").applyInArrow(decide, "a long, b long")


def _decided(rows: DataFrame, most: int, exact: bool, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): a forest of the links in each cluster. rows: (cluster, class, size, content).

    A block holds sets of about `most` in size. Sets of a cluster of several blocks are first compared within their block, to
    which HUBS sets of the cluster are added, so that the parts of a large group of copies hang together by these. Then only
    sets outside the largest part are compared with the other blocks.
    """
    rows = scratch.stored(bounded_batches(rows), "jaccard-rows")
    blocks = rows.groupBy("cluster").agg(F.ceil(F.sum("size") / most).cast("int").alias("blocks"), F.count("*").alias("sets"))
    blocks = scratch.stored(blocks, "jaccard-blocks")
    side, _ = small(blocks)
    placed = rows.join(side, "cluster").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    key, held = ["cluster", "i", "j", "side"], ["class", "size", "content"]
    first = placed.select("cluster", F.col("block").alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"), *held)
    wide = blocks.where("blocks > 1")
    if wide.isEmpty():
        return scratch.stored(_compared(first, exact, percent), "jaccard-links")
    placed_wide = placed.where("blocks > 1")
    hubs = placed_wide.where(F.pmod(F.xxhash64(F.lit("hub"), "class"), F.col("sets")) < HUBS).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    hubs = hubs.where("i <> block").select("cluster", "i", F.lit(-1).alias("j"), F.lit(0).alias("side"), *held)
    found = scratch.stored(_compared(first.unionByName(hubs), exact, percent), "jaccard-links")

    parts = scratch.stored(connected(found, scratch), "jaccard-parts")
    of_set = placed_wide.select("cluster", "class", "size", "blocks").distinct().join(parts.withColumnRenamed("node", "class"), "class", "left")
    of_set = scratch.stored(of_set.withColumn("component", F.coalesce("component", "class")), "jaccard-of-set")
    largest = of_set.groupBy("cluster", "component").count().groupBy("cluster").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    apart = scratch.stored(of_set.join(largest, "cluster").where("component <> largest").select("cluster", "class", "size"), "jaccard-apart")
    if apart.isEmpty():
        return found
    some = apart.groupBy("cluster").agg(F.ceil(F.sum("size") / most).cast("int").alias("others"))
    side, _ = small(scratch.stored(some, "jaccard-others"))
    every = placed_wide.join(side, "cluster")
    one = every.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select("cluster", F.col("block").alias("i"), "j", F.lit(0).alias("side"), *held)
    keys, _ = small(apart.select("class"))
    other = every.join(keys, "class", "left_semi").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("i <> block")
    other = other.withColumn("j", F.pmod(F.xxhash64(F.lit("apart"), "class"), F.col("others")).cast("int")).select("cluster", "i", "j", F.lit(1).alias("side"), *held)
    assert one.columns == other.columns == [*key, *held]
    return found.unionByName(scratch.stored(_compared(one.unionByName(other), exact, percent), "jaccard-links"))


def links(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str, kept: Scratch, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: doc_id, hash, n, class; classes: class, doc_id, hash of the text that stands for it; links: a, b between classes).

    Members of a class have equal sets; its doc_id is their smallest. Members without a shingle have no class. Members and
    classes are read from tables in kept, links from those in scratch.
    """
    texts = bounded_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("hash")))
    kind = texts.schema["doc_id"].dataType.simpleString()
    facts = kept.stored(_facts(words, kind, texts), "jaccard-facts")
    full = facts.where("n > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash"))
    classes = full.groupBy("n", "f1", "f2").agg(best.alias("best"))
    classes = kept.stored(classes.select(F.monotonically_increasing_id().alias("class"), "n", "f1", "f2", "best.doc_id", "best.hash"), "jaccard-classes")
    key = ["n", "f1", "f2"]
    members = full.join(classes.select("class", *key), key).select("doc_id", "hash", "n", "class")
    members = members.unionByName(facts.where("n = 0").select("doc_id", "hash", "n", F.lit(None).cast("long").alias("class")))

    # A tile ties its sets to the least of them. A second scan is cheaper than keeping all tiles.
    tiles = _tiles(percent, words, texts.select("text"))
    tiles = tiles.select("node", F.min("node").over(Window.partitionBy("tile")).alias("pivot"))
    ties = tiles.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    tied = connected(scratch.stored(ties, "jaccard-ties"), scratch)
    tied = scratch.stored(_nodes(percent, classes).join(tied, "node").select("class", F.col("component").alias("cluster")), "jaccard-clusters")

    def held(scan: Callable[[int, DataFrame], DataFrame], clusters: DataFrame) -> DataFrame:
        side, fits = small(clusters)
        wanted = classes.select("class", F.col("doc_id").alias("__id"), F.col("hash").alias("__hash")).join(clusters.select("class").distinct(), "class", "left_semi")
        chosen = texts.join(F.broadcast(wanted) if fits else wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash")))
        return scan(words, chosen.select("class", "text")).join(side, "class")

    near = _decided(held(_signatures, tied), BLOCK_BITS, False, percent, scratch)
    near = scratch.stored(connected(near, scratch).select(F.col("node").alias("class"), F.col("component").alias("cluster")), "jaccard-near")
    return members, classes.select("class", "doc_id", "hash"), _decided(held(_sets, near), BLOCK_ELEMENTS, True, percent, scratch)


def _grouped(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str, kept: Scratch) -> tuple[DataFrame, DataFrame]:
    """(members as of links; places: class, best), best being the text (no_id, doc_id, hash) that stands for the class's component."""
    with Scratch(docs.sparkSession) as scratch:
        members, classes, found = links(docs, percent, words, id_col, text_col, kept, scratch)
        best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")
        reached = scratch.stored(connected(found, scratch), "jaccard-components")
        side, _ = small(reached)
        linked = scratch.stored(classes.join(side, F.col("class") == F.col("node")).select("class", "component", best.alias("best")), "jaccard-linked")
        roots = linked.groupBy("component").agg(F.min("best").alias("root"))
        alone = classes.join(side, F.col("class") == F.col("node"), "left_anti").select("class", best.alias("best"))
        return members, kept.stored(alone.unionByName(linked.join(roots, "component").select("class", F.col("root").alias("best"))), "jaccard-places")


def components(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs; component_id is the smallest doc_id that links reach."""
    members, places = _grouped(docs, percent, words, id_col, text_col, Scratch(docs.sparkSession))
    side, _ = small(places)
    out = members.join(side, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of docs, with all its columns: that of the smallest doc_id, null last."""
    with Scratch(docs.sparkSession) as scratch:
        members, places = _grouped(docs, percent, words, id_col, text_col, scratch)
        side, _ = small(places)
        stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("hash") == F.col("best.hash"))
        marked = members.where("class is not null").join(side, "class").select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), stays.alias("__stays"))
        marked = marked.groupBy("__id", "__hash").agg(F.max("__stays").alias("__stays"), F.count("*").alias("__times")).where("not __stays or __times > 1")
        gone = stored(marked, "jaccard-gone")

    def same(rows: DataFrame, side: DataFrame) -> Column:
        return rows[id_col].eqNullSafe(side["__id"]) & (F.xxhash64(rows[text_col]) == side["__hash"])

    left = without(docs, gone, ["__id", "__hash"], same)
    again = gone.where("__stays")
    if again.isEmpty():
        return left
    # The row that stays is repeated under its id: once is enough.
    digest = "scriva text hash"
    again, _ = small(again)
    rows = docs.join(again, same(docs, again), "left_semi").withColumn(digest, F.xxhash64(F.col(text_col))).dropDuplicates([id_col, digest]).drop(digest)
    return left.unionByName(rows)
