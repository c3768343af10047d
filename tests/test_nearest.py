"""Nearest names against all distances, with a list of 100,000 names."""

import random

from pyspark.sql import functions as F

from scriva.operators import nearest
from scriva.plans import recover


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return None
    if a == b:
        return 0
    if len(a) == len(b):
        return 1 if sum(x != y for x, y in zip(a, b)) == 1 else None
    short, long = sorted((a, b), key=len)
    return 1 if any(long[:i] + long[i + 1 :] == short for i in range(len(long))) else None


def test_large_list(spark):
    rng = random.Random(1)
    names = list(dict.fromkeys("".join(rng.choice("ABCDE") for _ in range(rng.randrange(5, 12))) for _ in range(110_000)))[:100_000]
    words = [n[:-1] + "Z" for n in names[:15]] + [n[1:] for n in names[20:35]] + [n[:3] + "X" + n[3:] for n in names[40:50]] + names[60:70] + ["QQQQQ", "", "A"]
    table = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, place int").repartition(4)
    got = {r["word"]: (r["d"], r["place"], r["name"]) for r in nearest.nearest_names(spark.createDataFrame([(w,) for w in [*words, None, words[0]]], "word string"), table).collect()}
    want = {}
    for w in words:
        near = [(d, k, n) for k, n in enumerate(names) if abs(len(n) - len(w)) < 2 and (d := within_one(w, n)) is not None]
        if near:
            want[w] = min(near)
    assert got == want
    plan = nearest.nearest_names(spark.range(5).select(F.col("id").cast("string").alias("word")), table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and plan.count("Join Inner, (") == 1


def test_rows_and_texts(spark):
    rows = [(1, "x ALIUM and XANAXX", True), (1, "x ALIUM and XANAXX", True), (None, "VALIUM, alium", True), (2, "VALIUM", False), (3, None, True), (4, "nothing here", True), (5, "CLONAZAPEM of (clonazepan)", True), (6, "DIA ZEP", True)]
    table = spark.createDataFrame(rows, "id int, text string, bad boolean")
    got = recover.with_fuzzy_medicine(table, "text", F.col("bad"))
    assert got.columns == ["id", "text", "bad", "fuzzy"]
    assert sorted((str(r["id"]), r["fuzzy"]) for r in got.collect() if r["fuzzy"]) == [("1", "VALIUM"), ("1", "VALIUM"), ("5", "CLONAZAPAM"), ("None", "VALIUM")]
    assert got.count() == len(rows) and recover.with_fuzzy_medicine(table.limit(0), "text", F.col("bad")).count() == 0


def test_a_text_of_many_rows_is_no_hot_key(spark):
    kept = []
    table = spark.range(1000).select("id", F.when(F.col("id") >= 0, "x ALIUM y").alias("text"))
    got = recover.with_fuzzy_medicine(table, "text", F.col("id") >= 0, store=lambda df, name: kept.append(name) or df.localCheckpoint())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert kept == ["nearest"] and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {(r["fuzzy"], r["n"]) for r in got.groupBy("fuzzy").agg(F.count("*").alias("n")).collect()} == {("VALIUM", 1000)}
