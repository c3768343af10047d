"""Quality scores, the source divergence audit and whitening, against plain computations."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scriva.llm import divergence, quality, whitening

SF = "/root/testdata/sf0.01"


def plain_features(text):
    """Buckets of a text by loops over its bytes."""
    raw = b" " + bytes(32 if quality.SPACE[b] else b for b in text) + b" "
    one = lambda h: int(quality._bucket(np.array([h], np.uint64))[0])
    add = lambda part: sum(int(quality.TABLE[k % quality.PLACES][b]) for k, b in enumerate(part)) % (1 << 64)
    out = Counter()
    for n in quality.GRAMS:
        for i in range(len(raw) - n + 1):
            part = raw[i : i + n]
            if 32 not in part[1:-1] and part != b"  ":
                out[one(add(part) ^ int(quality.SALT[n - 1]))] += 1
    hashes = [add(w) for w in raw.split()]
    out.update(one(h) for h in hashes)
    out.update(one((b - a) % (1 << 64) ^ int(quality.SALT[0])) for a, b in zip(hashes, hashes[1:]))
    return out


@pytest.mark.parametrize("text", ["", "a", " \n", "one two two", "Été  straße\tx", "ab " * 40 + "a" * 90])
def test_features(text):
    ids, counts = quality.counted(text.encode())
    assert dict(zip(ids.tolist(), counts.tolist())) == plain_features(text.encode())


def test_scores_are_the_mean_of_vectors_through_softmax():
    rng = np.random.default_rng(2)
    rows = [(*quality.counted(t.encode()), y) for t, y in [("good plain words here", 1), ("BAD!! BAD!! BAD!!", 0)] * 4]
    model = quality.SubwordClassifier().fit(rows, (0.25, 0.75))
    texts = ["good words", "BAD!! x", "", None, "words " * 500, "x" * 3000]
    want = []
    for t in texts:
        found = plain_features((t or "").encode())
        mean = sum((n * model.vectors[k] for k, n in found.items()), np.zeros(quality.DIM)) / max(1, sum(found.values()))
        x = mean @ model.layer + model.bias
        want.append(np.exp(x[1]) / np.exp(x).sum())
    raws = [None if t is None else t.encode() for t in texts]
    assert np.allclose(quality.scores(model.table(), model.shift(), raws, len(raws)), want, atol=1e-12)
    shuffled = rng.permutation(len(raws))
    again = quality.scores(model.table(), model.shift(), [raws[k] for k in shuffled], len(raws))
    assert np.allclose(again, np.array(want)[shuffled], atol=1e-12)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{k % 50}" for k in range(4000)).encode()
    whole = dict(zip(*map(np.ndarray.tolist, quality.counted(text))))
    monkeypatch.setattr(quality, "PIECE", 1000)
    monkeypatch.setattr(quality, "CHUNK", 3000)
    cut = dict(zip(*map(np.ndarray.tolist, quality.counted(text))))
    assert sum(whole.values()) - sum(cut.values()) <= len(text) // 900 + 1  # pairs across the cuts
    assert set(cut) <= set(whole) | {k for k in cut}
    assert sum(len(g) for _, group in quality.pieces([text, None, b""]) for g in group) == len(text)


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.predict(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    test = [(r["doc_id"], r["quality"]) for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum((got[d] >= 0.3) == bool(y) for d, y in test) >= 0.97 * len(test)
    # labels of held-out rows, and columns other than the text, change nothing
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.train(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}), turned)
    assert np.array_equal(model.vectors, other.vectors) and np.array_equal(model.bias, other.bias)


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, "good plain words", "a"), (2, "BAD!! BAD!!", "b"), (2, None, "c"), (None, "", "d"), (3, "good words again", "e"), (4, "x" * 200_000, "f")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    for model in (quality.train(docs, labels), quality.train(docs, labels.where("quality = 1")), quality.train(docs, labels.limit(0)), quality.train(docs.limit(0), labels)):
        got = quality.predict(docs, model).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.train(docs, labels.limit(0)) == 0.5 and quality.predict(docs.limit(0), 0.5).count() == 0


AUDIT = "doc_id long, text string, lang string, source string, term string, n long, item string"


def audited(rows, least, top):
    """The audit by loops."""
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))) for r in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: Counter(t for d in docs if d[:2] == (lang, s) for t in d[2]) for s in {d[1] for d in docs if d[0] == lang}}
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s), key=lambda x: (-x[0], x[1].encode()))
            terms = sorted(((p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out |= {(lang, s, part, o, v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, o) in enumerate(found)}
    return out


@pytest.mark.parametrize("sides", [(64, 1024), (2, 3)])
def test_audit(spark, monkeypatch, sides):
    monkeypatch.setattr(divergence, "GROUPS", sides[0])
    monkeypatch.setattr(divergence, "TERMS", sides[1])
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = random.Random(8)
    words = ["The", "of", "été", "ÉTÉ", "Straße", "x1y", "zz-top"] + ["".join(rng.choice("abcd") for _ in range(3)) for _ in range(25)]
    rows = [(k % 50, rng.choice([None, "", "12 !"]) if rng.random() < 0.1 else " ".join(rng.choice(words[: 8 + k % 20]) for _ in range(rng.randrange(30))), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "a", "ü", None, "c", "d", "e"]), "t", 5, "i") for k in range(300)]
    rows += [(None, None, "xx", "lonely", "t", 1, "i"), (None, None, "yy", "p", "t", 1, "i"), (None, "only here", "yy", "q", "t", 1, "i")]
    rows += [(7, "the the The", "en", "a", "t", 1, "i")] * 60 + [(8, "word " * 5000, "en", "b", "t", 1, "i")]
    got = divergence.audit(spark.createDataFrame(rows, AUDIT).repartition(5), min_docs=12, top=4).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == audited(rows, 12, 4)
    assert divergence.audit(spark.createDataFrame([], AUDIT)).count() == 0


def test_terms_of_long_texts(monkeypatch):
    text = ("Word été " * 300 + "a" * 5000 + " end").encode()
    whole = divergence.terms_of(text)
    monkeypatch.setattr(divergence, "PIECE", 100)
    assert divergence.terms_of(text) == whole and whole[b"a" * 5000] == 1


def dense(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + whitening.SHIFT
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    values, found = np.linalg.eigh(c.T @ c / n)
    return x, n, s, c, values[::-1], found[:, ::-1]


@pytest.mark.parametrize("d", [5, 40, 90])
def test_whitening(spark, d):
    rng = np.random.default_rng(d)
    good = (rng.normal(size=(600, d)) @ np.diag(np.linspace(3, 0.5, d)) @ np.linalg.qr(rng.normal(size=(d, d)))[0]).astype(np.float32)
    good = np.vstack([good, np.repeat(good[:1], 200, 0)])  # many copies of one vector
    rows = [(k % 700, v.tolist(), "x", 1) for k, v in enumerate(good)]
    bad = [(None, None), (1, [None] * d), (2, [float("nan")] * d), (3, [float("inf")] + [0.0] * (d - 1)), (4, [1e30] * d), (5, [1.0] * (d + 1)), (6, [])]
    table = spark.createDataFrame(rows + [(i, v, "x", 1) for i, v in bad], "vec_id long, embedding array<float>, component string, n int").repartition(4)
    got = whitening.whiten(table).collect()
    x, n, s, c, values, found = dense(good)
    k = min(32, d)
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    whole = c @ found[:, :k] / np.sqrt(values[:k])
    want = Counter((i % 700, int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)))) for i, row in enumerate(x) for _ in range(k))
    assert Counter((r["vec_id"], r["deviation"]) for r in got) == want
    of = {i % 700: row for i, row in enumerate(whole) if i < 700 and i >= 100}
    mine = {i: np.zeros(k) for i in of}
    for r in got:
        if r["vec_id"] in mine:
            mine[r["vec_id"]][r["component"] - 1] = r["whitened"]
    a, b = np.array([mine[i] for i in of]), np.array([of[i] for i in of])
    assert np.abs(a * np.sign((a * b).sum(0)) - b).max() < 1e-8
    explained = {r["component"]: r["explained"] for r in got}
    assert all(abs(explained[j + 1] / (values[j] / values.sum()) - 1) < 1e-9 for j in range(k))
    assert max(r["identity_error"] for r in got) < 1e-9


def test_vectors_in_few_dimensions(spark):
    """90 entries, but only 20 directions with variance: the others have whitened 0 and are no part of identity_error."""
    rng = np.random.default_rng(4)
    base = rng.integers(-3, 4, (300, 20)) @ rng.integers(-2, 3, (20, 90))
    got = whitening.whiten(spark.createDataFrame([(k, (v / 64).tolist()) for k, v in enumerate(base)], "vec_id long, embedding array<double>")).collect()
    assert len(got) == 300 * 32 and {r["whitened"] for r in got if r["component"] > 20} == {0.0}
    assert max(r["identity_error"] for r in got) < 1e-9 and max(r["explained"] for r in got if r["component"] > 20) < 1e-12


def test_whitening_cases(spark):
    schema = "vec_id string, embedding array<double>"
    one = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema))
    assert one([]).count() == 0 and one([("a", None), ("b", [])]).count() == 0
    alone = one([(None, [1.0, 2.0])]).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in sorted(alone, key=lambda r: r["component"])] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    flat = one([("a", [1.0, 5.0]), ("b", [2.0, 5.0]), ("b", [3.0, 5.0])]).collect()
    assert len(flat) == 6 and {r["explained"] for r in flat if r["component"] == 1} == {1.0} and {r["whitened"] for r in flat if r["component"] == 2} == {0.0}
    large = one([("a", [2.0**50, 1.0]), ("b", [0.0, 2.0]), ("c", [1.0, 4.0])]).collect()  # deviations beyond a long
    assert len(large) == 6 and all(r["deviation"] is None for r in large)
    wide = one([(str(k), [float(k), 1.0, 2.0 * k]) for k in range(5)] + [("z", [1.0] * 4)]).collect()
    assert {r["vec_id"] for r in wide} == set("01234")


def test_exact_sums_where_longs_overflow():
    y = np.array([[2**61, 1], [2**61, 2], [2**61, 3], [2**61, 4]])
    assert whitening.total(y) == [2**63, 10]
    assert whitening.spread(y, 4, [2**63, 10]).tolist() == [[0, -6], [0, -2], [0, 2], [0, 6]]


def test_language_by_plain_loops():
    """The network's prediction against loops over windows, filters and bytes."""
    import pyarrow as pa

    from scriva.llm import langid

    net = langid.ByteConvNet(["de", "en", "fr"], seed=9)
    texts = ["short", "Straße und Brücke", "a" * 128, "x y z " * 60]
    names, scores = langid.labels(net, pa.array([*texts, None]))
    span = max(langid.WIDTHS)
    conv = net.p["conv"].reshape(span, langid.EMBED, -1).astype(float)
    for text, name, score in zip(texts, names, scores):
        raw = text.encode().ljust(langid.WINDOW, b" ")
        starts = sorted({*range(0, len(raw) - langid.WINDOW + 1, langid.WINDOW - span + 1), len(raw) - langid.WINDOW})
        each = []
        for s in starts:
            e = [net.p["embed"][b].astype(float) for b in raw[s : s + langid.WINDOW]]
            best = [max(sum(float(e[p + k] @ conv[k, :, f]) for k in range(span)) for p in range(langid.WINDOW - span + 1)) for f in range(conv.shape[2])]
            hidden = np.maximum(np.array(best) + net.p["bias"], 0)
            x = hidden @ net.p["out"] + net.p["shift"]
            each.append(np.exp(x - x.max()) / np.exp(x - x.max()).sum())
        p = np.array(each)
        k = int(np.log(p + 1e-9).sum(0).argmax())
        assert name == net.langs[k] and abs(score - p[:, k].mean()) < 1e-4
    assert names[-1] == "und" and scores[-1] == 0


def test_pipeline_cases(spark, tmp_path):
    """Null and repeated ids, null and empty texts, repeated rows, an empty table; tokens by the library itself."""
    import hashlib

    import tokenizers

    import corpus_pipeline

    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    near, leak = prose(80), prose(12)
    rows = [(None, prose(30)), (None, prose(30)), (1, None), (2, ""), (3, "12 34 !"), (4, "One two."), (4, "One two."), (5, "One  two."), (6, near), (7, near + " end"), (7, "other words here"), (8, f"{prose(9)} {leak} {prose(9)}")]
    table = spark.createDataFrame([(d, t, "en", None, 0, "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string").repartition(3)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    coder = tokenizers.Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    coder.no_truncation()
    coder.no_padding()
    want = []
    for d, t in [rows[0], rows[1], (5, "One  two."), (6, near), (7, "other words here")]:
        ids = coder.encode(t, add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
    table.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
