"""Corpus operators against brute force on small tables with nulls, empties, copies, long texts and clashing columns."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriva.llm import bpe, chat, decontaminate, exact, hashing, jaccard, langid, licences, repeats, shards, substrings, suffix_dedup
from scriva.llm.suffixes import suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, words string, __id long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT_SPACE = r"[^\x20\x09-\x0D]+"


def corpus():
    rng = random.Random(7)
    words = ["the", "of", "and", "thon", "erat", "ble", "été", "Straße", "10", "x1"] + ["".join(rng.choice("abcdeth") for _ in range(6)) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, item = prose(90), prose(24)
    texts = [None, "", "  \n", "one", "two words", "The the THE the", passage, passage, f"{prose(40)} {passage}\n{prose(30)}", f"{prose(5)} {passage} {prose(5)} {passage}", f"{prose(20)} {item.upper()} {prose(9)}", "ab" * 700, "ab" * 500, "é" * 450]
    texts += [prose(n) for n in (3, 12, 60, 400, 3000)]
    base = [prose(120).split() for _ in range(4)]
    for b in base:
        for k in (0, 1, 2, 9):
            c = list(b)
            for _ in range(k):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(" ".join(c))
            texts.append("\t".join(c) + "\n")
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "a", "b", "a")[i % 4], 0, "r", "w", 5) for i, t in enumerate(texts)]
    return rows, [(1, item), (2, " ".join(passage.split()[10:22])), (3, None), (None, "one"), (4, "zzz yyy")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus()[0], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(corpus()[1], "item_id long, text string")


TEXTS = {r[0]: r[1] for r in corpus()[0]}


def test_decontaminate(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = [(i, w[k : k + 10]) for i, t in corpus()[1] for w in [words(t)] if w for k in range(max(len(w) - 9, 1))]
    want = {}
    for d, t in TEXTS.items():
        w, hit, ids = words(t), set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    ids |= {str(i)} if i is not None else set()
        want[d] = (len(w), len(hit), sorted(ids))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == want
    assert {r["doc_id"] for r in decontaminate.drop_leaks(docs, items).collect()} == {d for d, v in want.items() if not v[1]}


def test_rows_are_rejected_one_by_one(items, spark):
    net = langid.ByteConvNet(["en", "de"])
    rows = [(None, "12 !", "a"), (None, "one word", "b"), (None, None, "c"), (7, "...", "d"), (7, "two words", "e"), (7, "...", "f")]
    table = spark.createDataFrame(rows, "doc_id long, text string, __id string").repartition(2)
    kept = langid.keep_known(table, net)
    assert kept.columns == table.columns and sorted(r["__id"] for r in kept.collect()) == ["b", "e"]
    assert langid.keep_known(table, None).count() == 0
    leak = corpus()[1][0][1]
    rows = [(None, leak, "a"), (None, "clean words", "b"), (None, None, "c"), (7, f"x {leak}", "d"), (7, "two words", "e"), (8, "", "f")]
    table = spark.createDataFrame(rows, "doc_id long, text string, __id string").repartition(2)
    kept = decontaminate.drop_leaks(table, items)
    assert kept.columns == table.columns and sorted(r["__id"] for r in kept.collect()) == ["b", "c", "e", "f"]


@pytest.mark.parametrize("words", [True, False])
def test_repeats(docs, words):
    length = 35 if words else 400
    seqs = {d: tuple((t or "").encode().split()) if words else (t or "").encode() for d, t in TEXTS.items()}
    times = Counter(s[i : i + length] for s in seqs.values() for i in range(len(s) - length + 1))
    want = {}
    for d, s in seqs.items():
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if times[s[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(s, gone) if not g]
        want[d] = (len(s), sum(gone), b" ".join(kept) if words else bytes(kept))
    done = substrings.remove_repeats(docs) if words else suffix_dedup.remove_repeats(docs, passage_words=20)
    rows = done.collect()
    assert {r["doc_id"]: (r["n"], r["n_removed"], bytes(r["kept"])) for r in rows} == want
    if not words:  # passages are counted in words, whatever their bytes
        seqs = {d: tuple((t or "").encode().split()) for d, t in TEXTS.items()}
        times = Counter(s[i : i + 20] for s in seqs.values() for i in range(len(s) - 19))
        covered = {d: len({i + k for i in range(len(s) - 19) if times[s[i : i + 20]] > 1 for k in range(20)}) for d, s in seqs.items()}
        assert {r["doc_id"]: r["n_passage_words"] for r in rows} == covered


def doubled(s, t, times):
    """Two strings that differ everywhere, and that a polynomial modulo a power of two doesn't tell apart once they are long enough."""
    for _ in range(times):
        s, t = s + t, t + s
    return s, t


def test_long_words_are_told_apart(spark):
    """Words of 512 to 4,096 letters, alone (op3, op10), and as whole texts and repeated passages (op2)."""
    pairs = [doubled(*x, k) for x in ("ab", "tu", "K]", "xz", "0p") for k in (9, 10, 12)]
    rows = [(2 * k + i, f"x{k} y " + w) for k, pair in enumerate(pairs) for i, w in enumerate(pair)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.components(table).collect()} == {d: d for d, _ in rows}
    lead = " ".join(f"w{k}" for k in range(34))
    rows = [(2 * k + i, f"{lead} v{k} " + " ".join(["z"] * 34) + " " + w) for k, pair in enumerate(pairs) for i, w in enumerate(pair)]
    words = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_removed"], r["kept"].decode()) for r in substrings.remove_repeats(words).collect()}
    seqs = {d: t.split() for d, t in rows}
    times = Counter(tuple(s[i : i + 35]) for s in seqs.values() for i in range(len(s) - 34))
    for d, s in seqs.items():
        gone = {i + k for i in range(len(s) - 34) if times[tuple(s[i : i + 35])] > 1 for k in range(35)}
        assert got[d] == (len(gone), " ".join(w for k, w in enumerate(s) if k not in gone))
    texts = [(2 * k + i, w) for k, pair in enumerate(doubled(*x, k) for x in ("ab", "tu", "0p") for k in (8, 9, 10)) for i, w in enumerate(pair)]
    times = Counter(t[i : i + 400] for _, t in texts for i in range(len(t) - 399))
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for d, t in texts:
        assert got[d] == len({i + k for i in range(len(t) - 399) if times[t[i : i + 400]] > 1 for k in range(400)})


def test_ranges_hash():
    """Equal ranges have equal hashes and others don't, at every place of a sequence."""
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 3000).astype(np.uint8)
    roll = hashing.Rolling(hashing.BYTE_VALUE[raw])
    for width in (1, 7, 12, 900):
        at = np.arange(len(raw) - width + 1)
        found = roll.of(at, at + width)
        strings = [raw[i : i + width].tobytes() for i in at]
        assert len(set(strings)) == len(set(found.tolist())) == len(set(zip(strings, found.tolist())))


@pytest.mark.parametrize("words", [True, False])
def test_window_classes(words):
    """The classes that a matcher gives against the windows themselves."""
    rng = random.Random(11)
    length = 35 if words else 400
    unit = ["aa ", "ab ", "b", "q.", "xyz ", "\u00e9\u00e8 "] if words else ["aa ", "ab ", "b", "q.", "xyz ", "\u00e9\u00e8", "ccccc", "\u4f60\u597d"]
    passage = "".join(rng.choice(unit) for _ in range(900))
    contents, groups = [], []
    for g in range(4):
        core = passage[200 * g : 200 * g + (330 if words else 700)]
        for _ in range(12):
            a, b = rng.randrange(40), rng.randrange(40)
            text = "".join(rng.choice(unit) for _ in range(rng.randrange(9))) + core[a : len(core) - b] + "".join(rng.choice(unit) for _ in range(rng.randrange(9)))
            raw = np.frombuffer(text.encode(), np.uint8)
            contents.append(repeats.split_elements([raw], True)[0] if words else raw)
            groups.append(g)
    if not words:  # no token starts at all, and one far into the text
        for text in ("ab" * 300, "ab" * 290, "k" * 500 + "." + "k" * 300, "k" * 450 + "." + "k" * 320):
            contents.append(np.frombuffer(text.encode(), np.uint8))
            groups.append(4)
    kept = [k for k, c in enumerate(contents) if len(c) >= length]
    contents, groups = [contents[k] for k in kept], np.array([groups[k] for k in kept])
    if words:  # a seed must be the smallest k-gram of the first window of all contents of its group, as reaches are
        places = substrings.seed_places(np.concatenate(contents), np.cumsum([0, *map(len, contents)]), length) - np.cumsum([0, *map(len, contents)])[:-1]
        groups = np.unique([contents[k][p : p + substrings.GRAM].tobytes() for k, p in enumerate(places)], return_inverse=True)[1]
        order = np.argsort(groups, kind="stable")
        contents, groups, places = [contents[k] for k in order], groups[order], places[order]
        contents = [c[max(0, p - length + substrings.GRAM) : p + length] for c, p in zip(contents, places)]
        whole = [k for k, c in enumerate(contents) if len(c) >= length]
        contents, groups = [contents[k] for k in whole], groups[whole]
        places = substrings.seed_places(np.concatenate(contents), np.cumsum([0, *map(len, contents)]), length) - np.cumsum([0, *map(len, contents)])[:-1]
    owner, start, kind = (substrings.extend if words else suffix_dedup.match)(contents, groups, length)
    assert len(owner) == (sum(sum(1 for s in range(len(c) - length + 1) if s <= p <= s + length - substrings.GRAM) for c, p in zip(contents, places)) if words else sum(len(c) - length + 1 for c in contents))
    by_window, by_class = {}, {}
    for o, s, k in zip(owner.tolist(), start.tolist(), kind.tolist()):
        key = (int(groups[o]) if words else 0, contents[o][s : s + length].tobytes())
        offset = int(places[o]) - s if words else 0
        by_window.setdefault((key, offset), set()).add(k)
        by_class.setdefault(k, set()).add((key, offset))
    assert all(len(x) == 1 for x in by_window.values()) and all(len(x) == 1 for x in by_class.values())
    assert len(by_class) < len(owner)


@pytest.mark.parametrize("words", [True, False])
def test_repeats_of_split_seeds(spark, monkeypatch, words):
    """A passage that many texts share, with seeds of more reaches than a block holds."""
    monkeypatch.setattr(repeats, "SEED_REACHES", 3)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(110))
    texts = [" ".join([*(word() for _ in range(rng.randrange(30))), passage[rng.randrange(60) :], *(word() for _ in range(rng.randrange(30)))]) for _ in range(40)]
    texts += [None, "", texts[0], texts[1] + " x", " ".join(word() for _ in range(300))]
    rows = [(None if k % 9 == 0 else k % 30, t) for k, t in enumerate(texts)]
    length = 35 if words else 400
    seqs = [tuple((t or "").encode().split()) if words else (t or "").encode() for _, t in rows]
    times = Counter(s[i : i + length] for s in seqs for i in range(len(s) - length + 1))
    want = []
    for (d, _), s in zip(rows, seqs):
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if times[s[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = [x for x, g in zip(s, gone) if not g]
        want.append((-1 if d is None else d, len(s), sum(gone), spans, b" ".join(kept) if words else bytes(kept)))
    done = (substrings if words else suffix_dedup).remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in done.collect()]
    assert sorted(got) == sorted(want)


class Batches:
    """Stands for a table, and gives the function that its batches go through."""

    schema = {"doc_id": T.StructField("doc_id", T.LongType())}

    def repartition(self, *keys):
        return self

    def sortWithinPartitions(self, *keys):
        return self

    def mapInArrow(self, function, schema):
        return function


def peak_mb(function, batch):
    """The rows that function makes of a batch, and the most MB that Python and numpy held meanwhile."""
    tracemalloc.start()
    try:
        out = [r for b in function(iter([batch])) for r in b.to_pylist()]
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_repeats_in_bounded_memory():
    """A batch of many texts, or of many seeds, is worked on piece by piece: 22 and 98 MB, all at once 98 and 271."""
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, k).astype(np.uint8)) for k in rng.integers(2, 9, 500)]
    text = lambda n: b" ".join(words[k] for k in rng.integers(0, 500, n))[:n]
    texts = [text(4_000) for _ in range(250)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(250), pa.int64()), "text": pa.array(texts, pa.binary()).cast("string"), "text_key": pa.array([0] * 250, pa.int64())})
    found, mb = peak_mb(repeats._scan(Batches(), False, 400, 64), batch)
    assert mb < 50
    alone = [r for k in (0, 99, 249) for r in peak_mb(repeats._scan(Batches(), False, 400, 64), batch.slice(k, 1))[0]]
    assert [r for r in found if r["doc_id"] in (0, 99, 249)] == alone

    rows = []
    for seed in range(60):  # pairs of contents that share 500 of their 800 bytes
        for pair in range(30):
            common = text(500)
            rows += [{"seed": seed, "block": 0, "split": seed == 7, "reach": 2 * pair + k, "open": True, "content": text(300) + common if k else common + text(300)} for k in range(2)]
    schema = pa.schema([("seed", pa.int64()), ("block", pa.int32()), ("split", pa.bool_()), ("reach", pa.int64()), ("open", pa.bool_()), ("content", pa.binary())])
    run = repeats._match(Batches(), False, 400, suffix_dedup.match)
    found, mb = peak_mb(run, pa.RecordBatch.from_pylist(rows, schema))
    assert mb < 150
    spans = {(r["seed"], r["reach"]): (r["a"], r["b"]) for r in found if r["window"] is None}
    assert set(spans) == {(s, r) for s in range(60) for r in range(60)}
    assert all((a <= 300 and b == 800) if r % 2 else (a == 0 and b >= 500) for (_, r), (a, b) in spans.items())
    alone = [r for s in (0, 7, 59) for r in run(iter([pa.RecordBatch.from_pylist([x for x in rows if x["seed"] == s], schema)])) for r in r.to_pylist()]
    assert [r for r in found if r["seed"] in (0, 7, 59)] == alone


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(300):
        x = [rng.randrange(1, 4) for _ in range(rng.randrange(25))] + [0]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_exact(docs, spark):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for d, t in TEXTS.items():
        groups.setdefault(norm(t), []).append((-len(t or ""), d))
    want = {d: (min(groups[norm(t)])[1], len(groups[norm(t)]), min(groups[norm(t)])[1] == d) for d, t in TEXTS.items()}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact.mark_copies(docs).collect()}
    assert got == want
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {d for d, v in want.items() if v[2]}
    twice = docs.union(docs.where("doc_id in (3, 20)"))
    assert exact.mark_copies(twice).where("kept").count() == len(groups) and exact.drop_copies(twice).count() == len(groups)


@pytest.mark.parametrize("rows", [20_000, 50])
def test_shards(docs, spark, monkeypatch, rows):
    monkeypatch.setattr(shards, "RANGE_ROWS", rows)
    many = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("source"))
    got = shards.assign_shards(many, 24).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append((r["slot"], r["source"]))
    assert sorted(by) == list(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for rows in by.values():
        assert sorted(s for s, _ in rows) == list(range(len(rows)))
        assert abs(sum(s == "hot" for _, s in rows) - len(rows) * 334 / 1000) <= 2
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in shards.assign_shards(docs, 24).collect()}
    assert sizes == {d: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in TEXTS.items()}


def test_shards_keep_equal_texts(spark):
    rows = [(k, f"text {k % 400}", "abc"[k % 3]) for k in range(1200)]
    got = shards.assign_shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), 4).collect()
    of_text = {}
    for r in got:
        of_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert len(of_text) == 400 and sum(len(x) == 1 for x in of_text.values()) > 340


def test_ids_of_all_kinds(spark, items):
    """Null and repeated ids, repeated rows, texts without words, and columns with the names that results have."""
    leak = corpus()[1][0][1]
    rows = [(None, leak), (None, "clean words"), (None, None), (7, f"x {leak}"), (7, "All rights reserved."), (7, "All rights reserved."), (8, " \n")]
    table = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], "doc_id long, text string, row string, n_hit int, lang string, source string").repartition(2)
    bag = lambda df, *cols: sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*cols).collect())
    assert bag(decontaminate.contamination(table, items), "doc_id", "n_words", "n_hit") == [(-1, 0, 0), (-1, 2, 0), (-1, 24, 24), (7, 3, 0), (7, 3, 0), (7, 25, 24), (8, 0, 0)]
    assert bag(licences.scan(table), "doc_id", "licence") == [(-1, "none")] * 3 + [(7, "all-rights-reserved")] * 2 + [(7, "none"), (8, "none")]
    assert bag(langid.predict(table, None), "doc_id", "lang_pred", "score") == sorted((-1 if d is None else d, "und", 0.0) for d, _ in rows)
    assert bag(shards.assign_shards(table, 3), "doc_id", "size") == sorted((-1 if d is None else d, len((t or "").encode()) + 8) for d, t in rows)
    assert sorted(r["slot"] for r in shards.assign_shards(table, 1).collect()) == list(range(7))
    assert bag(bpe.encode(table.select("doc_id", "text")).selectExpr("doc_id", "size(ids) as n"), "doc_id", "n")[:1] == [(-1, 0)]
    kept = jaccard.one_of_each(table)
    assert kept.columns == table.columns and bag(kept, "doc_id", F.coalesce("text", F.lit(""))) == sorted([(-1, ""), (-1, "clean words"), (7, "All rights reserved."), (7, f"x {leak}"), (8, " \n")])


def test_stages_of_empty_tables(docs, items, spark):
    none = docs.limit(0)
    for df in (exact.drop_copies(none), jaccard.one_of_each(none), decontaminate.drop_leaks(none, items), langid.keep_known(none, langid.ByteConvNet(["en"]))):
        assert df.columns == docs.columns and df.count() == 0
    assert decontaminate.drop_leaks(docs, items.limit(0)).count() == docs.count()


def test_many_languages_are_learned(spark):
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} " * 40, f"l{k % 300}") for k in range(1500)]
    net = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=2)
    assert len(net.langs) == 300


@pytest.mark.parametrize("percent,words", [(90, 3), (80, 5)])
def test_jaccard(docs, percent, words):
    sets = {}
    for d, t in TEXTS.items():
        w = re.findall(TEXT_SPACE, (t or "").translate(LOW))
        sets[d] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    up = {d: d for d in sets}
    find = lambda d: d if up[d] == d else find(up[d])
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(docs, percent, words).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_links_of_null_and_repeated_ids(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(9999)}" for _ in range(150)] for _ in range(3)]
    one, two, three = (" ".join(b) for b in base)
    near = lambda b, k: " ".join([*b[:k], "other", *b[k + 1 :]])
    # Each of 5's texts has its own near copy; 5 has one text twice; null ids bridge and are copies of one another.
    rows = [(5, one, "a"), (5, two, "b"), (5, two, "c"), (3, near(base[0], 0), "d"), (8, near(base[1], 149), "e"), (None, three, "f"), (None, near(base[2], 0), "g"), (None, "", "h"), (None, None, "i"), (9, "alone", "j")]
    table = spark.createDataFrame(rows, "doc_id long, text string, __id string").repartition(3)
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in jaccard.components(table).collect())
    assert got == sorted([("5", "3"), ("5", "5"), ("5", "5"), ("3", "3"), ("8", "5"), ("9", "9")] + [("None", "None")] * 4)
    left = jaccard.one_of_each(table)
    kept = sorted(r["__id"] for r in left.collect())
    assert left.columns == table.columns and len(kept) == 6 and {"d", "h", "i", "j"} < set(kept)
    assert len({"b", "c"} & set(kept)) == 1 and len({"f", "g"} & set(kept)) == 1
    bridge = [(1, " ".join(base[0]), "a"), (None, near(base[0], 0), "b"), (2, " ".join(["other", *base[0][1:146], "v", "x", "y", "z"]), "c")]
    table = spark.createDataFrame(bridge, "doc_id long, text string, __id string")
    assert [r["__id"] for r in jaccard.one_of_each(table, 94).collect()] == ["a"]


def test_link_forest_over_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[: 400 - k], rng.integers(0, 1 << 63, k, dtype=np.uint64)))) for k in (0, 4, 8, 15, 90)]
    size = np.array([len(s) for s in sets])
    sign = jaccard.folded([jaccard.signature(s, 512 << i % 2) for i, s in enumerate(sets)])
    assert (sign == np.stack([jaccard.signature(s, 300) for s in sets])).all()
    assert len(jaccard.link_forest(size, sign, sets, np.zeros(5, int), False, 90)) == 3
    assert len(jaccard.link_forest(size, sign, sets, np.array([0, 0, 1, 1, 1]), True, 90)) >= 2
    assert len(jaccard.link_forest(size, sign, None, np.zeros(5, int), False, 90)) >= 3


def test_jaccard_of_a_cluster_of_many_blocks(spark, monkeypatch):
    """Copies of one text in all blocks, and a bridge between two groups that only one text makes."""
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", 900)
    monkeypatch.setattr(jaccard, "BLOCK_BITS", 4096)
    monkeypatch.setattr(jaccard, "HUBS", 2)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(130)]
    rows = []
    for k in range(60):
        c = list(base)
        for _ in range(rng.randrange(0, 5)):
            c[rng.randrange(len(c))] = word()
        rows.append((k, " ".join(c)))
    chain = list(base)
    for k in range(60, 80):  # each differs a little from the one before, so that the last is far from the first
        chain[(k - 60) * 6] = word()
        rows.append((k, " ".join(chain)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    sets = {d: {tuple(w[i : i + 3]) for i in range(len(w) - 2)} for d, t in rows for w in [t.split()]}
    up = {d: d for d in sets}
    find = lambda d: d if up[d] == d else find(up[d])
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and find(a) != find(b):
                up[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {d: find(d) for d in sets} and len(set(got.values())) < len(got)


def test_tiles_shared_within_a_chunk():
    nodes, tiles = np.array([5, 3, 9, 3, 7], np.int64), np.array([1, 1, 1, 1, 2], np.uint64)
    n, t = jaccard.shared_in_chunk(nodes, tiles)
    assert sorted(n[t == 1]) == [3] and sorted(n[t == 2]) == [7]
    own = set(t.tolist()) - {1, 2}
    assert len(own) == 1 and sorted(n[t == own.pop()]) == [3, 5, 9]


@pytest.mark.parametrize("percent", [80, 90])
def test_linking_sets_share_tiles(percent):
    rng = np.random.default_rng(5)
    for size in [*range(1, 80), 250, 900, 5000]:
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        swap = size * (100 - percent) // (100 + percent)
        while swap and 100 * (size - swap) < percent * (size + swap):
            swap -= 1
        for b in (np.concatenate((a[swap:], rng.integers(0, 1 << 63, swap, dtype=np.uint64))), a[: -(-percent * size // 100)]):
            if np.array_equal(a, b):
                continue
            shared = [np.intersect1d(jaccard.tiles_of(a, k, percent), jaccard.tiles_of(b, k, percent)) for k in set(jaccard.bands_of(len(a), percent)) & set(jaccard.bands_of(len(b), percent))]
            assert any(len(s) > 0 for s in shared), (size, len(b))


def test_bpe(docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    for r in bpe.encode(docs.select("doc_id", "text")).collect():
        want = library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    for text in ("a<|endoftext|>b's \x1cΣας İ ½ 你好 😀!!", "x" * 1000):
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode_batch(pa.array([text]))[0].to_pylist() == [want]


def test_bpe_of_every_code_point():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    points = [k for k in range(1, 0x110000) if not 0xD800 <= k < 0xE000]
    texts = ["\n".join(f"a{chr(k)}B {chr(k)}1" for k in points[i : i + 64]) for i in range(0, len(points), 64)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode_batch(pa.array(texts))[0].to_pylist() == want


def test_bpe_of_mixed_texts():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    rng = random.Random(3)
    parts = [*"abIXé'’s.1²٣ßΣσςKÅ \n\t-re<|>lvdm", "\u0307", "\u0323", "\u0301", "\u0898", "ǅ", "ﬁ", "<|endoftext|>", "\x00", "\x1c", "\u2003", "\u0130", "你"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(4000)]
    ids, decoded = coder.encode_batch(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.to_pylist() == want and decoded.to_pylist() == [library.decode(w, skip_special_tokens=False) for w in want]
    coder.forget()
    assert coder.encode_batch(pa.array(texts[:9]))[0].to_pylist() == want[:9]


def test_fingerprints_of_many_sets():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 3, 1, 0, 0, 50, 0)]
    one, two = jaccard.fingerprints(sets)
    for k, s in enumerate(sets):
        alone = jaccard.fingerprints([s])
        assert (one[k], two[k]) == (alone[0][0], alone[1][0])
    assert len({*one.tolist()}) == 4 and two[0] == two[3] == 0 and len(jaccard.fingerprints([])[0]) == 0
    assert jaccard.nodes_of(one[[1, 1, 2]], np.array([4, 5, 4])).tolist() == [jaccard.nodes_of(one[[k]], np.array([b]))[0] for k, b in ((1, 4), (1, 5), (2, 4))]


def test_bpe_merges_a_piece_once(monkeypatch):
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    rng = random.Random(4)
    words = list({"".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(110_000)})
    first, second = (pa.array([" ".join(words[k : k + 500]) for k in range(a, len(words), 500)]) for a in (0, 50_000))
    coder.encode_batch(first)
    merged, whole = [], coder.merge_rounds
    monkeypatch.setattr(coder, "merge_rounds", lambda *a: (found := whole(*a), merged.append(len(found[1])))[0])
    again = coder.encode_batch(second)[0].to_pylist()
    assert sum(merged) == 0
    coder.encode_batch(pa.array(["zzzyyyxxx " + words[0]]))
    assert sum(merged) == 1
    coder.forget()
    assert coder.encode_batch(second)[0].to_pylist() == again


def test_bpe_of_long_pieces_among_others():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    texts = ["x" * 700, "b " + "xyz" * 300 + " c " + "yx" * 350 + "d' e", "", None, "the b " + "yx" * 350, "x" * 700 + "1 " + "q" * 301 + "z" * 300]
    for some in (texts, texts[2:], texts[2:4]):
        assert coder.encode_batch(pa.array(some, pa.string()))[0].to_pylist() == [library.encode(t or "", add_special_tokens=False).ids for t in some]


def test_bpe_columns(spark):
    rows = [(1, "a b", "x", 5), (None, None, "y", 6), (1, "", "z", 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int")
    got = bpe.encode(table, keep_text=True)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted((r["text"] is None, r["text"] or "", len(r["ids"])) for r in got.collect()) == [(False, "", 0), (False, "a b", 2), (True, "", 0)]


def test_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(table, sample_docs=300)
    got = langid.predict(table, net).join(table, "doc_id").where(langid.held_out(F.col("doc_id")))
    n, right = got.count(), got.where("lang_pred = lang").count()
    assert right >= 0.97 * n
    odd = spark.createDataFrame([(1, None), (None, "12 !"), (3, "")], "doc_id long, text string")
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(odd, net).collect()} == {("und", 0.0)}
    assert langid.keep_known(odd, net).count() == 0 and langid.train(table.limit(0)) is None


def test_chat(spark):
    def cheapest(roles):  # all legal repairs by search
        best, todo = {}, [(0, "", 0)]
        while todo:
            cost, state, k = todo.pop()
            if best.get((state, k), 1 << 30) <= cost:
                continue
            best[state, k] = cost
            if k < len(roles):
                todo += [(cost + c, after, k + 1) for c, after, _ in chat.steps_from(state, roles[k])]
        return min(best[s, len(roles)] + e for s, e in (("assistant", 0), ("user", chat.INSERT), ("system", 2 * chat.INSERT)) if (s, len(roles)) in best)

    rng = random.Random(2)
    for _ in range(200):
        roles = [rng.choice([*chat.ROLES, None]) for _ in range(rng.randrange(1, 8))]
        cost, steps, close = chat.repair(roles)
        turns = [r for r, _ in chat.apply(["t"] * len(roles), steps, close)]
        assert cost == cheapest(roles)
        body = turns[turns[0] == "system" :]
        assert len(body) % 2 == 0 and body == ["user", "assistant"] * (len(body) // 2)
    rows = [(1, 0, "User ", "a"), (1, 1, "user", None), (None, 0, None, "x"), (2, 0, "assistant", "y")]
    got = {r["conv_id"]: (r["n_turns"], r["n_out"], r["n_merged"]) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {1: (2, 2, 0), None: (1, 2, 0), 2: (1, 2, 0)}


def test_chat_cases(spark):
    """Repeated turn numbers, null turns and roles, clashing columns, a very long conversation, an empty table."""
    schema = "conv_id string, turn long, role string, text string, cost string, rendered int"
    rows = [("a", 1, "user", "q2"), ("a", 1, "user", "q1"), ("a", 1, "assistant", "r"), ("a", None, "user", "first"), (None, 1, "robot", None), ("b", 0, "USER", "x")]
    rows += [("long", k, ("user", "assistant")[k % 2], "t") for k in range(6000)]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame([(*r, "c", 1) for r in rows], schema).repartition(3)).collect()}
    assert got["a"]["rendered"] == chat.render([("user", "first"), ("assistant", "r"), ("user", "q1"), ("assistant", "q2")])
    assert (got[None]["n_turns"], got[None]["n_out"]) == (1, 2) and got["b"]["n_inserted"] == 1
    assert (got["long"]["n_turns"], got["long"]["n_out"], got["long"]["n_inserted"]) == (6000, 6000, 0)
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


def test_licences(spark):
    rows = [(1, "x.\nReleased under the MIT License. Licensed under the Apache License, Version 2.0."), (2, None), (3, "All rights reserved."), (4, "")]
    got = {r["doc_id"]: (r["sentence_ids"], r["licence"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (["mit", "apache-2"], "dual-mit-apache"), 2: ([], "none"), 3: (["reserved"], "all-rights-reserved"), 4: ([], "none")}


def test_licence_notices(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
    bsd = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
    apache = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""

    def gnu(what, name, mark, version):
        return f"""This {what} is free software{':' if mark == ',' else ';'} you can redistribute it and/or modify
it under the terms of the GNU {name} Public License as published by
the Free Software Foundation{mark} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY."""

    mpl = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    texts = {
        "mit": mit, "bsd": bsd, "isc": isc, "apache-2.0": apache, "mpl-2.0": mpl,
        "gpl-3.0": gnu("program", "General", ",", "3"), "gpl-2.0": gnu("program", "General", ";", "2"),
        "lgpl-2.1": gnu("library", "Lesser General", ";", "2.1"), "lgpl-3.0": gnu("program", "Lesser General", ",", "3"), "agpl-3.0": gnu("program", "Affero General", ",", "3"),
    }
    forms = {"plain": lambda t: t, "one line": lambda t: t.replace("\n\n", "\0").replace("\n", " ").replace("\0", "\n\n"), "comment": lambda t: "/*\n" + "\n".join(f" * {x}".rstrip() for x in t.split("\n")) + "\n */\nint x;", "hash": lambda t: "\r\n".join(f"# {x}" for x in t.split("\n"))}
    rows = [(f"{name}/{form}", f"Some code.\n\n{change(t)}\n") for name, t in texts.items() for form, change in forms.items()]
    got = {r["doc_id"]: r["licence"] for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {d: d.split("/")[0] for d, _ in rows}
    near = [(1, "The software is provided as is to friends.\nAll rights reserved for the band\n\nby nobody"), (2, "We permit use; all rights\nreserved.")]
    got = {r["doc_id"]: (r["sentence_ids"], r["licence"]) for r in licences.scan(spark.createDataFrame(near, "doc_id long, text string")).collect()}
    assert got == {1: ([], "none"), 2: (["reserved"], "all-rights-reserved")}
    for known in licences.KNOWN:
        assert any(cue in known for cue in licences.CUES) and licences.normal(known) == known, known


def test_licences_in_markup(spark):
    rows = [(1, "_All rights reserved._"), (2, "__Released under the MIT License__. x"), (3, "All_rights_reserved"), (4, "small rights reserved")]
    got = {r["doc_id"]: r["licence"] for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "all-rights-reserved", 2: "mit", 3: "all-rights-reserved", 4: "none"}


def test_licences_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    texts = [
        None, "", "// SPDX-License-Identifier: MIT\nint x;", "/* SPDX-License-Identifier: GPL-2.0-or-later */", "# spdx-license-identifier: Apache-2.0 OR MIT", "SPDX-License-Identifier: mpl-2.0",
        "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "**Released under the MIT License.** Licensed under CC BY-NC-ND 4.0!", "_All rights\nreserved._\nAll rights reserved",
        "Some prose. This is free and unencumbered software released into the\n   public domain.", "; Licensed under the GNU Lesser General\n; Public License v2.1; see LICENSE", "Licensed under\n\nthe MIT License", "MIT License\n\nCopyright (c) 2020\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\")",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n 3. Neither the name of the copyright holder nor the names of its\n contributors may be used to endorse or promote products derived from\n this software without specific prior written permission.",
        "\u0130 all rights reserved \u00e9. all rights reserved", "word " * 20000 + "\nReleased under the MIT License.\n" + "word. " * 20000, "All rights reserved.\r\nReleased under the MIT License\r\n", "licensed under cc by 4.0? (licensed under cc by sa 4.0) [all rights reserved]",
    ]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    want = {r[0]: r[1:] for r in con.execute(licences.sql()).fetchall()}
    rows = spark.createDataFrame([(k, t, "x", ["y"]) for k, t in enumerate(texts)], "doc_id long, text string, licence string, sentence_ids array<string>")
    got = {r["doc_id"]: (len(r["sentence_ids"]), ",".join(r["sentence_ids"]), r["licence"], r["kind"]) for r in licences.scan(rows).collect()}
    assert got == want
    assert [got[k][2] for k in range(2, 14)] == ["mit", "gpl-2.0", "dual-apache-mit", "mpl-2.0", "cc-by-sa-4.0", "cc-by-nc-nd-4.0", "all-rights-reserved", "unlicense", "lgpl-2.1", "mit", "mit", "bsd-3-clause"]


def test_empty_tables(docs, items, spark):
    none, no_items = docs.limit(0), items.limit(0)
    for df in (decontaminate.contamination(none, items), exact.mark_copies(none), exact.drop_copies(none), shards.assign_shards(none), jaccard.components(none), substrings.remove_repeats(none), suffix_dedup.remove_repeats(none), bpe.encode(none.select("doc_id", "text")), langid.predict(none, None), licences.scan(none)):
        assert df.count() == 0
    assert decontaminate.contamination(docs, no_items).where("n_hit > 0").count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    kept = [(d, t) for d, t in rows if t and re.search(r"[^\W\d_]", t)]
    groups = {}
    for d, t in kept:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), d, t))
    kept = sorted(min(g)[1:] for g in groups.values())
    sets = {}
    for d, t in kept:
        w = re.findall(TEXT_SPACE, t.translate(LOW))
        sets[d] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    up = {d: d for d in sets}
    find = lambda d: d if up[d] == d else find(up[d])
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                up[max(find(a), find(b))] = min(find(a), find(b))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOW))
    windows = {tuple(w[k : k + 10]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [words(r["text"])] if w for k in range(max(len(w) - 9, 1))}
    clean = [(d, t) for d, t in kept if find(d) == d for w in [words(t)] if not any(tuple(w[k : k + 10]) in windows for k in range(len(w)))]
    coder = bpe.WordBPE(open(bpe.default_path(), "rb").read())
    want = {}
    for d, t in clean:
        got = coder.encode_batch(pa.array([t]))[0].to_pylist()[0]
        want[d] = (len(got), hashlib.sha256(" ".join(map(str, got)).encode()).hexdigest())
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, sf).collect()} == want
