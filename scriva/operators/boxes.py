"""Operators over OCR boxes: bounds, columns, reading lines, anchors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column edges on a page 750 wide, row bands as shares of the height, what a record's anchor begins with.
EDGES, PAGE_W, PAGE_H = [77, 271, 475, 670], 750.0, 1000.0
ANCHOR = r"^\s*\|?\s*\d{5}"
BANDS = [(0.10, 0.35), (0.35, 0.65), (0.60, 0.90)]


def scaled(fixed: int | float, scale: Column) -> Column:
    """A length at the page's scale, cut to a whole number."""
    return F.floor(F.lit(float(fixed)) * scale).cast("int")


def edges(width: Column) -> list[Column]:
    return [scaled(e, width / PAGE_W) for e in EDGES]


def bounds(df: DataFrame, polygon: str = "polygon") -> DataFrame:
    """df with x_min, x_max, y_min, y_max and center_y of its polygons (array<struct<x,y>>)."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    df = df.withColumns({"x_min": F.array_min(xs), "x_max": F.array_max(xs), "y_min": F.array_min(ys), "y_max": F.array_max(ys)})
    return df.withColumn("center_y", (F.col("y_min") + F.col("y_max")) / 2)


def within(rows: DataFrame, at: Column, intervals: DataFrame, keys: list[str], out: str, strip: float = 64.0, few: bool = False) -> DataFrame:
    """rows with `out`: the numbers of the intervals (keys, no, low, high) of a row's keys that hold its place `at`, in order.

    An interval join by strips: an interval is in every strip that it touches, a row in one, and both meet by keys and strip. The
    intervals of a strip are one row, so that rows are neither multiplied nor grouped again. An interval holds both its ends; rows
    that meet none have an empty array, and null keys, places and ends meet nothing. few: the intervals are those of page sizes, a
    bounded number, and are broadcast; others, whose size Spark can't tell before they are made, are sorted and merged.
    """
    touched = F.sequence(F.floor(F.col("low") / strip), F.floor(F.col("high") / strip))
    known = intervals.where("low <= high").select(*keys, F.explode(touched).alias("_strip"), F.struct("no", "low", "high").alias("_one"))
    known = known.groupBy(*keys, "_strip").agg(F.array_sort(F.collect_list("_one")).alias("_held"))
    met = rows.withColumns({"_at": at, "_strip": F.floor(at / strip)}).join(known.hint("broadcast" if few else "merge"), [*keys, "_strip"], "left")
    hits = F.transform(F.filter(F.coalesce("_held", F.array().cast("array<struct<no:int,low:double,high:double>>")), lambda i: F.col("_at").between(i["low"], i["high"])), lambda i: i["no"])
    return met.withColumn(out, hits).select(*rows.columns, out)


def usual_columns(pages: DataFrame) -> DataFrame:
    """(width, no, low, high): the three columns of each different page width."""
    e = edges(F.col("width"))
    each = F.array(*[F.struct(F.lit(c).alias("no"), e[c].cast("double").alias("low"), e[c + 1].cast("double").alias("high")) for c in range(3)])
    return pages.select("width").distinct().select("width", F.inline(each))


def usual_bands(pages: DataFrame) -> DataFrame:
    """(height, no, low, high): the row bands of each different page height; they overlap."""
    each = F.array(*[F.struct(F.lit(k).alias("no"), (lo * F.col("height")).alias("low"), (hi * F.col("height")).alias("high")) for k, (lo, hi) in enumerate(BANDS)])
    return pages.select("height").distinct().select("height", F.inline(each))


def cut_columns(cuts: DataFrame, key: str = "page_idx") -> DataFrame:
    """(key, no, low, high) from cuts (key, cuts: array), as layout.columns finds them: pages with columns of their own."""
    pairs = F.zip_with(F.slice("cuts", F.lit(1), F.size("cuts") - 1), F.slice("cuts", F.lit(2), F.size("cuts")), lambda a, b: F.struct(a.cast("double").alias("low"), b.cast("double").alias("high")))
    each = cuts.select(key, F.posexplode(F.when(F.size("cuts") > 1, pairs)).alias("no", "_pair"))
    return each.select(key, "no", "_pair.low", "_pair.high")


def in_columns(boxes: DataFrame, columns: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """boxes with col: the first column that holds the box's centre, or null. columns: those of the boxes' keys, else the usual ones."""
    few = columns is None
    columns, keys = (usual_columns(boxes), ["width"]) if few else (columns, keys or ["page_idx"])
    return within(boxes, (F.col("x_min") + F.col("x_max")) / 2, columns, keys, "_cols", few=few).withColumn("col", F.get("_cols", F.lit(0))).drop("_cols")


def group_lines(boxes: DataFrame, *keys: str) -> DataFrame:
    """(keys, lines, text, mean_confidence): boxes put on lines by vertical overlap.

    In the order of their centres, each box joins the most recent line that it overlaps by half of the lower height or more, else
    it opens a new one; a line's extent grows with its boxes. Boxes are dealt by key and sorted once; a task sweeps over them and
    holds the boxes of one key at a time, which a page bounds. A box without bounds is a line of its own; null texts are skipped.
    """
    sorted_by = ["center_y", "n", "x_min", "y_min", "y_max", "text"]
    rows = boxes.select(*keys, *sorted_by, "confidence").repartition(*keys).sortWithinPartitions(*keys, *sorted_by)
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the rows of the last key, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            cuts = key_starts(table, keys)
            if len(cuts) > 1:
                yield swept(table.slice(0, cuts[-1]), keys, cuts[:-1])
            held = table.slice(cuts[-1])
        if held is not None:
            yield swept(held, keys, [0])

    found = rows.mapInArrow(run, f"{kinds}, lines array<string>, mean_confidence double")
    return found.withColumn("text", F.array_join("lines", "\n"))


def key_starts(table: pa.Table, keys: tuple[str, ...]) -> list[int]:
    """The rows at which a new key begins."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new).tolist()


def swept(table: pa.Table, keys: tuple[str, ...], cuts: list[int]) -> pa.RecordBatch:
    """One row for each key of a table that is sorted by key, centre and number."""
    n = table.num_rows
    key = np.repeat(np.arange(len(cuts)), np.diff([*cuts, n]))
    low, high = floats(table, "y_min"), floats(table, "y_max")
    line, firsts = lines_of_keys(key, low, high, cuts)
    left, number = floats(table, "x_min"), table.column("n").combine_chunks()
    no_number = np.asarray(number.is_null())
    order = np.lexsort((number.fill_null(0).to_numpy(zero_copy_only=False), ~no_number, np.nan_to_num(left), ~np.isnan(left), line))
    text = table.column("text").combine_chunks().take(pa.array(order))
    some = np.asarray(text.is_valid())
    words = np.concatenate([[0], np.cumsum(np.bincount(line[order][some], minlength=firsts[-1]))]).astype(np.int32)
    said = pc.binary_join(pa.ListArray.from_arrays(pa.array(words), text.filter(pa.array(some)).cast(pa.string())), " ")
    lines = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), said)
    confidence = floats(table, "confidence")
    known = ~np.isnan(confidence)
    count = np.bincount(key[known], minlength=len(cuts))
    total = np.bincount(key[known], confidence[known], minlength=len(cuts))
    means = pa.array(total / np.maximum(count, 1), mask=count == 0)
    out = [table.column(k).combine_chunks().take(pa.array(cuts)) for k in keys]
    return pa.RecordBatch.from_arrays([*out, lines, means], names=[*keys, "lines", "mean_confidence"])


def floats(table: pa.Table, column: str) -> np.ndarray:
    """A column of numbers, nan where it is null."""
    return table.column(column).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)


def lines_of_keys(key: np.ndarray, low: np.ndarray, high: np.ndarray, cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(the line of each box, numbered through all keys; the first line of each key, and how many there are).

    Where a box and all behind it on its page begin after all boxes before it have ended, none of them meets an earlier line. Between
    two such places there is mostly one line, which all boxes overlap as they should; where not, these boxes are swept one by one.
    """
    rank = np.unique(high, return_inverse=True)[1].astype(np.int64)
    step = len(high) + 1
    reach = np.maximum.accumulate(rank + key * step) - key * step  # the rank of the lowest end so far on the page
    ends = np.empty_like(high)
    ends[rank] = high
    _, up = np.unique(-low, return_inverse=True)
    tops = np.empty_like(low)
    tops[up] = low
    back = (len(cuts) - 1 - key[::-1]) * step
    ahead = tops[(np.maximum.accumulate(up[::-1].astype(np.int64) + back) - back)[::-1]]  # the top of all boxes from here on
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ahead[1:] >= ends[reach[:-1]])
    block = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    # What the line of a block, if it is one, has reached before each box.
    top = tops[np.maximum.accumulate(up.astype(np.int64) + block * step) - block * step]
    bottom = ends[np.maximum.accumulate(rank + block * step) - block * step]
    inside = ~new
    inside[1:] &= ~new[1:]
    i = np.flatnonzero(inside)
    least = np.minimum(high[i] - low[i], bottom[i - 1] - top[i - 1])
    joins = (least > 0) & (np.minimum(high[i], bottom[i - 1]) - np.maximum(low[i], top[i - 1]) >= 0.5 * least)
    odd = np.zeros(len(at), bool)
    odd[block[i[~joins]]] = True
    # A page with a box without bounds is swept as a whole.
    unknown = np.zeros(len(cuts), bool)
    unknown[key[np.isnan(low) | np.isnan(high)]] = True
    within = np.zeros(len(key), np.int64)  # the line of a box in its block
    lines = np.ones(len(at), np.int64)  # the lines of each block
    stop = np.append(at[1:], len(key))
    for b in np.flatnonzero(odd & ~unknown[key[at]]).tolist():
        numbers = line_numbers(low[at[b] : stop[b]].tolist(), high[at[b] : stop[b]].tolist())
        within[at[b] : stop[b]] = numbers
        lines[b] = max(numbers) + 1
    first = np.cumsum(lines) - lines
    line = within + first[block]
    per_key = np.bincount(key[at], lines, minlength=len(cuts)).astype(np.int64)
    if unknown.any():
        starts = np.cumsum(per_key) - per_key
        line -= starts[key]
        ends_at = [*cuts[1:], len(key)]
        for k in np.flatnonzero(unknown).tolist():
            a, b = cuts[k], ends_at[k]
            bounds_of = [[None if v != v else v for v in side[a:b].tolist()] for side in (low, high)]
            line[a:b] = line_numbers(*bounds_of)
            per_key[k] = line[a:b].max() + 1
        line += (np.cumsum(per_key) - per_key)[key]
    return line, np.concatenate([[0], np.cumsum(per_key)])


def line_numbers(low: list[float | None], high: list[float | None]) -> list[int]:
    """The line of each box (its upper and lower bound), boxes in the order of their centres.

    Lines that end above all boxes still to come are left behind, so that a box is compared with the few that are open.
    """
    ahead = [math.inf] * (len(low) + 1)
    for i in range(len(low) - 1, -1, -1):
        ahead[i] = min(ahead[i + 1], math.inf if low[i] is None else low[i])
    out: list[int] = []
    opened: list[list[float]] = []  # top, bottom, number
    count = 0
    for i, (top, bottom) in enumerate(zip(low, high, strict=True)):
        if top is None or bottom is None:
            out.append(count)
            count += 1
            continue
        for line in reversed(opened):
            least = min(bottom - top, line[1] - line[0])
            if least > 0 and min(bottom, line[1]) - max(top, line[0]) >= 0.5 * least:
                line[0], line[1] = min(top, line[0]), max(bottom, line[1])
                out.append(line[2])
                break
        else:
            if opened and opened[0][1] <= ahead[i]:
                opened = [line for line in opened if line[1] > ahead[i]]
            opened.append([top, bottom, count])
            out.append(count)
            count += 1
    return out


def is_record_anchor(text: Column, x_min: Column, left: Column, tolerance: Column) -> Column:
    return text.rlike(ANCHOR) & (x_min - left <= tolerance)


def is_available(text: Column) -> Column:
    return F.lower(text).rlike("avai|valable|lable")


def anchors(boxes: DataFrame, columns: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """(page_idx, col, band, anchor_y): the topmost record anchor of each column and row band.

    boxes: page_idx, width, height, x_min, x_max, y_min, text; columns (keys, no, low, high): those of the pages, else the usual
    ones. Bands overlap, so a box may count in two.
    """
    few = columns is None
    marked = boxes.where(F.col("text").rlike(ANCHOR))
    placed = in_columns(marked, columns, keys).where("col is not null")
    columns, keys = (usual_columns(marked), ["width"]) if few else (columns, keys or ["page_idx"])
    left = columns.select(*keys, F.col("no").alias("col"), F.col("low").alias("_left"))
    found = placed.join(left.hint("broadcast" if few else "merge"), [*keys, "col"]).where(is_record_anchor(F.col("text"), F.col("x_min"), F.col("_left"), scaled(40, F.col("width") / PAGE_W)))
    each = within(found, F.col("y_min"), usual_bands(marked), ["height"], "_bands", few=True).withColumn("band", F.explode("_bands"))
    return each.groupBy("page_idx", "col", "band").agg(F.min("y_min").alias("anchor_y"))
