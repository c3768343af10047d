"""Quality classifier: supervised subword embeddings.

Every word (a run of bytes without white space), every pair of neighbouring words and every byte n-gram of a word, with the white
space beside it, is hashed to a bucket that has a learned vector. A pair is hashed by the difference of its words' hashes, so that
a word said twice is one feature, whatever the word. A document's vector is the mean over all of its features, a softmax layer makes probabilities
of it. Vectors and layer are trained in numpy by stochastic gradient descent, one document a step, on a bounded sample of
labelled documents; what is broadcast is the product of vectors and layer, as the mean of the products is the product of the
mean. Whole texts are read, in training and in scoring.

The sample has at most ``sample_docs`` documents of each label, chosen by a hash of the id, and ends where its documents have
``SAMPLE_FEATURES`` distinct features together. The shares of the labels among all labelled ids are put back into the layer's
bias, so that scores are probabilities at these shares.

Only the text is an input of a score; labels, languages, sources and ids are not.

Defined cases: a null or empty text has no features and gets the score of the bias; without labelled rows of both labels all
scores are the share of label 1 (0.5 without any labelled row). Labels other than 0 and 1 and labels of null ids are not learned; equal
(id, label) rows count once, an id with both labels counts for both. Null ids count as held out and, like repeated ones,
are scored row by row; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import Scratch, bounded_batches, small
from scriva.llm.langid import held_out

BITS, DIM, GRAMS = 17, 8, (2, 3, 4)
#: Bounds of the training sample: documents of a label, distinct features of all of its documents together.
SAMPLE_DOCS, SAMPLE_FEATURES = 1_000, 8_000_000
EPOCHS, RATE = 6, 3.0
#: Bytes that are hashed together; longer texts go on in pieces, cut after white space where there is some (the pair of words
#: across a cut is no feature).
PIECE, CHUNK = 1 << 20, 1 << 21
NONE = 1 << BITS  # the bucket of what is no feature; its vector is zero

_rng = np.random.default_rng(3)
#: Random numbers for each place in a feature and byte: features are hashed by adding them up.
PLACES = 32
TABLE = _rng.integers(0, 1 << 63, (PLACES, 256), np.uint64) * np.uint64(2) + np.uint64(1)
SALT = _rng.integers(0, 1 << 63, PLACES, np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _bucket(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def features(raw: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """Buckets of bytes that start and end with white space: for each n of GRAMS one at each place (NONE where no n-gram of a
    word starts), and for words and pairs one at each start of a word (NONE elsewhere)."""
    blank = SPACE[raw]
    codes = np.where(blank, np.uint8(32), raw)
    out, n = [], len(raw)
    sums = TABLE[0][codes]
    inner = np.ones(n, bool)  # what lies between the ends of the n-gram at a place is no white space
    for k in range(1, max(GRAMS)):
        sums = sums[:-1] + TABLE[k][codes[k:]]
        inner = inner[:-1] if k == 1 else inner[:-1] & ~blank[k - 1 : n - 1]
        if k + 1 in GRAMS:
            whole = inner & ~(blank[: n - k] & blank[k:]) if k == 1 else inner
            out.append(np.append(np.where(whole, _bucket(sums ^ SALT[k]), NONE), np.full(k, NONE, np.int32)))
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    words, pairs = np.full((2, n), NONE, np.int32)
    if len(starts):
        since = np.arange(n)
        first = np.zeros(n, np.int64)
        first[starts] = starts
        place = (since - np.maximum.accumulate(first)) % PLACES
        each = np.where(blank, np.uint64(0), TABLE[place, codes])
        hashes = np.add.reduceat(each, starts)
        words[starts] = _bucket(hashes)
        pairs[starts[1:]] = _bucket((hashes[1:] - hashes[:-1]) ^ SALT[0])
        pairs[starts[np.unique(np.searchsorted(starts, begins[begins <= starts[-1]]))]] = NONE  # a first word has none before it
    return [*out, words, pairs]


def pieces(texts: Iterable[bytes | memoryview | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Groups of about CHUNK bytes of pieces of texts, with the number of the text that each is of."""
    of: list[int] = []
    group: list[np.ndarray] = []
    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text, np.uint8)
        at = 0
        while at < len(raw):
            end = min(at + PIECE, len(raw))
            if end < len(raw) and (blanks := np.flatnonzero(SPACE[raw[at:end]])).size:
                end = at + int(blanks[-1]) + 1
            of.append(i)
            group.append(raw[at:end])
            held += end - at
            at = end
            if held >= CHUNK:
                yield of, group
                of, group, held = [], [], 0
    if of:
        yield of, group


def joined(group: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces with a space before, between and behind them, and where each begins."""
    gap = np.full(1, 32, np.uint8)
    parts = [gap]
    for piece in group:
        parts += [piece, gap]
    begins = np.cumsum([0, *(len(p) + 1 for p in group[:-1])])
    return np.concatenate(parts), begins


def counted(text: bytes | memoryview | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each occurs."""
    total = np.zeros(NONE + 1, np.int64)
    for _, group in pieces([text]):
        for found in features(*joined(group)):
            total += np.bincount(found, minlength=NONE + 1)
    ids = np.flatnonzero(total[:NONE]).astype(np.int32)
    return ids, total[ids]


class SubwordClassifier:
    """Vectors of all buckets, averaged, and a softmax layer over labels 0 and 1."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / DIM, 1 / DIM, (NONE + 1, DIM))
        self.vectors[NONE] = 0
        self.layer = np.zeros((DIM, 2))
        self.bias = np.zeros(2)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], shares: tuple[float, float], seed: int = 13) -> SubwordClassifier:
        """rows: buckets, counts, label. shares: of the labels among all labelled rows."""
        rng = np.random.default_rng(seed)
        number = np.bincount([y for _, _, y in rows], minlength=2)
        weight = len(rows) / 2 / np.maximum(number, 1)
        steps, step = EPOCHS * len(rows), 0
        for _ in range(EPOCHS):
            for k in rng.permutation(len(rows)):
                ids, counts, y = rows[k]
                rate = RATE * (1 - step / steps)
                step += 1
                part = counts / max(counts.sum(), 1)
                mean = part @ self.vectors[ids]
                x = mean @ self.layer + self.bias
                p = np.exp(x - x.max())
                p /= p.sum()
                p[y] -= 1
                p *= weight[y]
                back = self.layer @ p
                self.layer -= rate * np.outer(mean, p)
                self.bias -= 0.01 * rate * p
                self.vectors[ids] -= rate * part[:, None] * back
        self.bias = self.bias + np.log(np.array(shares))
        return self

    def table(self) -> np.ndarray:
        """What a feature of each bucket adds to the difference of the two logits, before averaging."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0])

    def shift(self) -> float:
        return float(self.bias[1] - self.bias[0])


def scores(table: np.ndarray, shift: float, texts: Iterable[bytes | memoryview | None], n: int) -> np.ndarray:
    """The probability of label 1 for each of n texts."""
    sums, times = np.zeros(n), np.zeros(n)
    for of, group in pieces(texts):
        raw, begins = joined(group)
        each, times_each = np.zeros(len(raw)), np.zeros(len(raw))
        for found in features(raw, begins):
            each += table[found]
            times_each += found != NONE
        np.add.at(sums, of, np.add.reduceat(each, begins))
        np.add.at(times, of, np.add.reduceat(times_each, begins))
    return 1 / (1 + np.exp(-np.clip(sums / np.maximum(times, 1) + shift, -700, 700)))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> SubwordClassifier | float:
    """A model fitted on a sample of labelled documents; without documents of both labels, the share of label 1."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    number = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(number.values())
    if not total:
        return 0.5
    share = F.when(F.col("y") == 1, min(1.0, 1.2 * sample_docs / max(1, number.get(1, 0)))).otherwise(min(1.0, 1.2 * sample_docs / max(1, number.get(0, 0))))
    with Scratch(docs.sparkSession) as scratch:
        asked = scratch.stored(known.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / (1 << 20) < share), "quality-labels")
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(small(asked)[0], "id")
        found = scratch.stored(sample_features(rows), "quality-sample")
        taken, left, held = [], {0: sample_docs, 1: sample_docs}, 0
        for r in found.select("o", "y", F.length("ids").alias("b")).orderBy("o", "y", "b").limit(4 * sample_docs).collect():
            if held + r["b"] // 4 > SAMPLE_FEATURES:
                break
            if left[r["y"]]:
                left[r["y"]] -= 1
                held += r["b"] // 4
                taken.append(r["o"])
        chosen = found.where(F.col("o") <= (taken[-1] if taken else 0)).orderBy("o", "y", F.length("ids"), "ids", "counts").limit(4 * sample_docs)
        fitted, left = [], {0: sample_docs, 1: sample_docs}
        for r in chosen.collect() if taken else []:
            if left[r["y"]]:
                left[r["y"]] -= 1
                fitted.append((np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32), r["y"]))
    if len({y for _, _, y in fitted}) < 2:
        return number.get(1, 0) / total
    return SubwordClassifier().fit(fitted, (number[0] / total, number[1] / total))


def sample_features(rows: DataFrame) -> DataFrame:
    """(o, y, ids, counts): the features of labelled texts (id, text, y), and their place in the order of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [counted(t.as_buffer() if t.is_valid else None) for t in batch.column("text")]
            ids, counts = ([x[k].astype(np.int32).tobytes() for x in each] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("y"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["o", "y", "ids", "counts"])

    placed = rows.select(F.xxhash64(F.lit("order"), "id").alias("o"), "y", "text")
    return bounded_batches(placed).mapInArrow(run, "o long, y int, ids binary, counts binary")


def predict(docs: DataFrame, model: SubwordClassifier | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score), one row per row of docs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if not isinstance(model, SubwordClassifier):
        return rows.select("doc_id", F.lit(float(model)).alias("score"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast((model.table(), model.shift()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = sent.value
        for batch in batches:
            texts = (t.as_buffer() if t.is_valid else None for t in batch.column("text"))
            found = scores(table, shift, texts, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return bounded_batches(rows).mapInArrow(run, f"doc_id {kind}, score double")
