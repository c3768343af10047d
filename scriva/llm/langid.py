"""Language ID by a byte convolutional network.

Windows of ``WINDOW`` bytes of the UTF-8 text pass through a byte embedding, convolutions of several widths, a rectifier, max
pooling over the window and a softmax layer. The network is trained in numpy on windows of a bounded sample of labelled
documents (at most ``sample_docs`` for each language, chosen by a hash of the id) and applied to windows that cover the whole
of every text; a document's probabilities are the mean over its windows. Every language among the labels is learned.

Only text and lang of training rows are learned from; lang, source and doc_id are no inputs of a prediction.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with no labelled training row all are ``und``;
null ids count as held out and, like repeated ones, are allowed; an empty table gives an empty result; further columns are not read by ``predict`` and are kept by
``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import bounded_batches

WINDOW, EMBED = 128, 8
WIDTHS, FILTERS = (2, 3, 4), 8
#: Bounds of the training sample: documents of a language, documents in all (with more languages than this allows in full, each
#: has its equal part, but one at least), windows of a document.
SAMPLE_DOCS, SAMPLE_ALL, SAMPLE_WINDOWS = 1_000, 100_000, 2
EPOCHS, BATCH, RATE = 6, 128, 0.01
CHUNK_WINDOWS = 2_048


class ByteConvNet:
    """All widths are computed as one matrix product: narrower filters have zero rows."""

    def __init__(self, langs: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs, span, n = langs, max(WIDTHS), len(WIDTHS) * FILTERS
        self.mask = np.zeros((span, EMBED, n), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(span * EMBED, n)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "conv": (rng.normal(0, 0.3, (span * EMBED, n)).astype(np.float32) * self.mask),
            "bias": np.zeros(n, np.float32),
            "out": rng.normal(0, 0.3, (n, len(langs))).astype(np.float32),
            "shift": np.zeros(len(langs), np.float32),
        }

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, span * EMBED): the embedded bytes under each position of a filter."""
        e = self.p["embed"][windows]
        view = np.lib.stride_tricks.sliding_window_view(e, max(WIDTHS), axis=1)
        return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(windows), view.shape[1], -1)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self.columns(windows)
        conv = (cols.reshape(-1, cols.shape[2]) @ self.p["conv"]).reshape(len(windows), cols.shape[1], -1)
        return cols, conv, np.maximum(conv.max(1) + self.p["bias"], 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for a in range(0, len(windows), CHUNK_WINDOWS // 8):
            x = self.pooled(windows[a : a + CHUNK_WINDOWS // 8])[2] @ self.p["out"] + self.p["shift"]
            x = np.exp(x - x.max(1, keepdims=True))
            out.append(x / x.sum(1, keepdims=True))
        return np.concatenate(out)

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        n = len(windows)
        cols, conv, hidden = self.pooled(windows)
        x = hidden @ self.p["out"] + self.p["shift"]
        x = np.exp(x - x.max(1, keepdims=True))
        d = x / x.sum(1, keepdims=True)
        d[np.arange(n), target] -= 1
        d /= n
        back = (d @ self.p["out"].T) * (hidden > 0)
        best = conv.argmax(1)  # (n, filters)
        under = np.take_along_axis(cols, best[:, :, None], 1)  # (n, filters, span * EMBED)
        d_cols = back[:, :, None] * self.p["conv"].T[None]
        d_embed = np.zeros_like(self.p["embed"])
        place = best[:, :, None] + np.arange(max(WIDTHS))
        np.add.at(d_embed, np.take_along_axis(windows, place.reshape(n, -1), 1).ravel(), d_cols.reshape(-1, EMBED))
        return {"out": hidden.T @ d, "shift": d.sum(0), "bias": back.sum(0), "conv": np.einsum("nf,nfk->kf", back, under) * self.mask, "embed": d_embed}

    def fit(self, windows: np.ndarray, target: np.ndarray, seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        m, v, step = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), BATCH):
                step += 1
                for k, g in self.gradients(windows[order[a : a + BATCH]], target[order[a : a + BATCH]]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteConvNet | None:
    """A network fitted on at most sample_docs documents of each language; None without labelled rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(~held_out(F.col("id")) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    sample_docs = max(1, min(sample_docs, SAMPLE_ALL // len(counts)))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.1 * sample_docs / n)))])
    place = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.where(F.col("text").isNotNull() & (place < F.element_at(share, F.col("lang"))))
    raw = F.col("text").cast("binary")
    spread = [F.substring(raw, F.lit(1) + F.pmod(F.xxhash64(F.lit(k), "id"), F.greatest(F.length(raw) - WINDOW + 1, F.lit(1))).cast("int"), F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]
    found = chosen.select("lang", F.xxhash64(F.lit("order"), "id").alias("o"), F.array(*spread).alias("w")).orderBy("o", "lang").limit(len(counts) * sample_docs).collect()
    langs = sorted(counts)
    windows = [(np.frombuffer(bytes(w).ljust(WINDOW, b" "), np.uint8), langs.index(r["lang"])) for r in found for w in r["w"] if w]
    if not windows:
        return None
    return ByteConvNet(langs).fit(np.stack([w for w, _ in windows]), np.array([k for _, k in windows]))


def labels(net: ByteConvNet | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language and score of each text of a batch; null stands for a text without a letter."""
    names: list[str] = ["und"] * len(texts)
    scores = np.zeros(len(texts))
    todo: list[tuple[int, np.ndarray]] = []
    held = 0

    def work(todo: list[tuple[int, np.ndarray]]) -> None:
        p = net.probabilities(np.concatenate([w for _, w in todo]))
        at = np.cumsum([0, *(len(w) for _, w in todo)])
        logs = np.add.reduceat(np.log(p + 1e-9), at[:-1])
        means = np.add.reduceat(p, at[:-1]) / np.diff(at)[:, None]
        for (i, _), best, mean in zip(todo, logs.argmax(1), means, strict=True):
            names[i], scores[i] = net.langs[best], min(1.0, max(0.0, float(mean[best])))

    for i, text in enumerate(texts):
        if net is None or not text.is_valid:
            continue
        raw = np.frombuffer(text.as_buffer(), np.uint8)
        if len(raw) < WINDOW:
            raw = np.append(raw, np.full(WINDOW - len(raw), 32, np.uint8))
        step = WINDOW - max(WIDTHS) + 1
        starts = np.unique(np.append(np.arange(0, len(raw) - WINDOW + 1, step), len(raw) - WINDOW))
        view = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[starts]
        todo.append((i, view))
        held += len(view)
        if held >= CHUNK_WINDOWS:
            work(todo)
            todo, held = [], 0
    if todo:
        work(todo)
    return names, scores


def lettered(text: Column) -> Column:
    """The text, or null if it has no letter."""
    return F.when(text.rlike(r"\p{L}"), text)


def predict(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of docs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), lettered(F.col(text_col)).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = labels(net, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return bounded_batches(rows).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs in which some language is recognised, with all their columns.

    Each row is decided where it stands, so that ids need not tell rows apart.
    """

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        return pa.array([name != "und" for name in labels(net, texts)[0]], pa.bool_())

    return bounded_batches(docs).where(known(lettered(docs[text_col])))
