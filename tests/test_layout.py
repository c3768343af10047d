"""Box and layout operators against plain loops, on keys of many rows."""

import bisect
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scriva import queries
from scriva.operators import boxes, layout


def snapped(ys, anchor, reach=25, shift=8):
    t = anchor - shift
    near = [y for y in ys[max(0, bisect.bisect_left(ys, t - reach)) : bisect.bisect_right(ys, t + reach)]]
    return min(near, key=lambda y: (abs(y - t), y), default=t)


def test_snap_to_lines_of_one_large_key(spark):
    rng = random.Random(3)
    ys = sorted(rng.sample(range(3_000_000), 100_000))
    lines = spark.createDataFrame([(1, y) for y in ys] + [(2, 50), (2, 50), (None, 10), (3, None)], "page int, y int").repartition(4)
    asked = [(1, rng.randrange(3_000_100)) for _ in range(3000)] + [(1, y + 8) for y in ys[:50]] + [(1, ys[7] + 33), (1, ys[7] + 34), (2, 33), (2, 58), (2, 58), (2, 84), (3, 20), (None, 18), (4, 7)]
    points = spark.createDataFrame(asked, "page int, anchor_y int")
    found = layout.snap_nearest(points, lines, ["page"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    got = {(r["page"], r["anchor_y"]): r["divider"] for r in found.collect()}
    of = {1: ys, 2: [50]}
    assert got == {(p, a): snapped(of.get(p, []), a) for p, a in asked}


def test_snap_ties_and_nulls(spark):
    lines = spark.createDataFrame([(1, 90), (1, 110)], "page int, y int")
    points = spark.createDataFrame([(1, 108), (1, None)], "page int, anchor_y int")
    assert {r["anchor_y"]: r["divider"] for r in layout.snap_nearest(points, lines, ["page"]).collect()} == {108: 90, None: None}
    assert layout.snap_nearest(points.limit(0), lines, ["page"]).count() == 0
    assert {r["divider"] for r in layout.snap_nearest(points.limit(1), lines.limit(0), ["page"]).collect()} == {100}


def grouped(rows):
    """Lines of the boxes of one page, every box held against every line."""
    lines = []
    for b in sorted(rows, key=lambda b: (b["center_y"], b["n"])):
        at = None
        for line in lines:
            low = min(b["y_max"] - b["y_min"], line["hi"] - line["lo"])
            if low > 0 and min(b["y_max"], line["hi"]) - max(b["y_min"], line["lo"]) >= 0.5 * low:
                at = line
        if at is None:
            at = {"lo": b["y_min"], "hi": b["y_max"], "of": []}
            lines.append(at)
        at["lo"], at["hi"] = min(at["lo"], b["y_min"]), max(at["hi"], b["y_max"])
        at["of"].append(b)
    return [" ".join(b["text"] for b in sorted(line["of"], key=lambda b: (b["x_min"], b["n"])) if b["text"] is not None) for line in lines]


def test_boxes_to_lines(spark):
    rng = random.Random(5)
    rows = []
    for page in [*range(40), None]:
        for n in range(rng.choice([1, 2, 30, 400])):
            top = rng.choice([rng.uniform(0, 300), 20.0 * rng.randrange(8) + rng.random()])
            low = top + rng.choice([0, 3, 10, 10, 60])
            rows.append({"page": page, "n": n, "x_min": float(rng.randrange(20)), "y_min": top, "y_max": low, "center_y": (top + low) / 2, "text": rng.choice(["a", "bb", None, "c"]), "confidence": 0.5})
    schema = "page int, n long, x_min double, y_min double, y_max double, center_y double, text string, confidence double"
    table = spark.createDataFrame(rows, schema).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = {r["page"]: r for r in boxes.group_lines(table, "page").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {r["page"] for r in rows}
    for page, r in got.items():
        want = grouped([b for b in rows if b["page"] == page])
        assert r["lines"] == want and r["text"] == "\n".join(want) and r["mean_confidence"] == 0.5
    odd = spark.createDataFrame([{"page": 1, "n": k, "x_min": None, "y_min": None, "y_max": 3.0, "center_y": None, "text": "t", "confidence": None} for k in range(2)], schema)
    assert [(r["lines"], r["mean_confidence"]) for r in boxes.group_lines(odd, "page").collect()] == [(["t", "t"], None)]
    assert boxes.group_lines(table.limit(0), "page").count() == 0


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_boxes_that_spark_makes_are_not_broadcast(spark):
    for name in ("seg_anchor_check", "seg_merge_rule", "err_quarantine", "snap_bounds", "box_own_columns"):
        assert "Broadcast" not in planned(queries.QUERIES[name](spark, "/root/testdata/sf0.001")), name


def test_columns_of_page_sizes_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("box_column_join", "box_anchor_pick"):
            assert "SortMergeJoin" not in planned(queries.QUERIES[name](spark, "/root/testdata/sf0.001")), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whitespace_of_equal_worth_goes_to_the_first_row(spark):
    ink = {49: 50, 50: 30, 51: 20, 52: 26}  # 100 / 3 at 50, and 76 / 3 + 8 at 51
    profile = spark.createDataFrame([(1, r, ink.get(r, 500)) for r in range(100)], "image_id int, row int, ink int")
    points = spark.createDataFrame([(1, 50), (2, 7)], "image_id int, y int")
    assert {(r["image_id"], r["snapped"]) for r in layout.snap_whitespace(profile, points).collect()} == {(1, 50), (2, 7)}


def test_plain_lines_are_not_swept_box_by_box(monkeypatch):
    rows = [(p, 20.0 * ln + w % 3, 20.0 * ln + w % 3 + 10, 10.0 * w, 100 * ln + w, None if w == 2 else f"w{w}", 0.5) for p in (1, 2) for ln in range(4) for w in range(5)]
    rows.sort(key=lambda r: (r[0], r[1] + r[2], r[4]))
    table = pa.table(dict(zip(("page", "y_min", "y_max", "x_min", "n", "text", "confidence"), map(list, zip(*rows)))))
    swept_rows = []
    whole = boxes.line_numbers
    monkeypatch.setattr(boxes, "line_numbers", lambda low, high: swept_rows.append(len(low)) or whole(low, high))
    got = boxes.swept(table, ("page",), [0, 20]).to_pylist()
    assert got == [{"page": p, "lines": ["w0 w1 w3 w4"] * 4, "mean_confidence": 0.5} for p in (1, 2)] and swept_rows == []
    low, high = np.array([0.0, 20, 30, 0, 31]), np.array([10.0, 30, 30, 60, 41])  # a tall box behind one that begins below all before it
    assert boxes.lines_of_keys(np.zeros(5, int), low, high, [0])[0].tolist() == whole(low.tolist(), high.tolist()) and swept_rows
