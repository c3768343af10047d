"""Operators over page layouts: clustering and snapping of lines, dividers, projection islands, segment plans, crop checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriva.operators.boxes import PAGE_H, PAGE_W, edges, is_available, scaled

#: Default dividers on a page 1000 high.
DEFAULTS = (144, 422, 700)


def cluster_1d(lines: DataFrame, *keys: str, y: str = "y", gap: int = 12) -> DataFrame:
    """(keys, y): distinct values chained while the step is at most `gap`; each chain becomes its mean, cut to a whole number."""
    w = Window.partitionBy(*keys).orderBy(y)
    df = lines.select(*keys, y).distinct().withColumn("_new", (F.coalesce(F.col(y) - F.lag(y).over(w), F.lit(gap + 1)) > gap).cast("int"))
    df = df.withColumn("_chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*keys, "_chain").agg(F.floor(F.avg(y)).cast("int").alias("y")).drop("_chain")


def snap_nearest(points: DataFrame, lines: DataFrame, keys: list[str], reach: int = 25, shift: int = 8) -> DataFrame:
    """points (keys, anchor_y) with divider: the nearest line within reach of anchor_y - shift (the lower y of equals), or that itself.

    An as-of join with a tolerance: points and lines are sorted together, and each point sees the last line up to it and the first
    from it on. A key's range is cut into strips, each a partition of its own, so that a key of very many lines is no hot task;
    lines within reach of a strip's border are in both strips. Points are distinct; a null key has no lines, a null anchor_y no divider.
    """
    width = 64 * max(reach, 1)

    def strip(y: Column) -> Column:
        return F.floor(y / width)

    marks = lines.select(*keys, F.col("y").alias("_at"), F.col("y").alias("_line")).dropna(subset=[*keys, "_at"])
    marks = marks.withColumn("_strip", F.explode(F.array_distinct(F.array(*[strip(F.col("_at") + d) for d in (-reach, 0, reach)]))))
    asked = points.select(*keys, (F.col("anchor_y") - shift).cast("int").alias("_at"), F.lit(None).cast("int").alias("_line"), "anchor_y").distinct()
    both = marks.withColumn("anchor_y", F.lit(None).cast(points.schema["anchor_y"].dataType)).withColumn("_asked", F.lit(False))
    both = both.unionByName(asked.withColumns({"_strip": strip(F.col("_at")), "_asked": F.lit(True)}))
    part = Window.partitionBy(*keys, "_strip")
    seen = [F.last("_line", ignorenulls=True).over(part.orderBy(o, "_asked").rowsBetween(Window.unboundedPreceding, 0)) for o in (F.asc("_at"), F.desc("_at"))]
    near = both.withColumns({"_low": seen[0], "_high": seen[1]}).where("_asked")
    low, high = (F.when(F.abs(F.col(c) - F.col("_at")) <= reach, F.col(c)) for c in ("_low", "_high"))
    best = F.when(high - F.col("_at") < F.col("_at") - low, high).otherwise(F.coalesce(low, high))
    return near.select(*keys, "anchor_y", F.coalesce(best, "_at").alias("divider"))


def interpolated(y1: Column, y2: Column, y3: Column) -> tuple[Column, Column, Column]:
    """One missing divider of three from the two others."""
    third = F.when(y3.isNull(), 2 * y2 - y1)
    first = F.when(y1.isNull() & y3.isNotNull(), 2 * y2 - y3)
    second = F.when(y2.isNull(), F.floor((y1 + y3) / 2).cast("int"))
    return F.coalesce(y1, first), F.coalesce(y2, second), F.coalesce(y3, third)


def filled(ys: list[Column], height: Column) -> list[Column]:
    """Missing dividers from the first known one by the default spacing; all defaults if none is known."""
    d = [scaled(v, height / PAGE_H) for v in DEFAULTS]
    shift = F.coalesce(*[y - d[k] for k, y in enumerate(ys)], F.lit(0))
    return [F.coalesce(y, d[k] + shift).cast("int") for k, y in enumerate(ys)]


def islands(profile: DataFrame, key: str, at: str, good: Column, least: int = 1) -> DataFrame:
    """(key, start, stop, mid): runs of consecutive positions for which `good` holds, of at least that many."""
    w = Window.partitionBy(key).orderBy(at)
    runs = profile.where(good).withColumn("_g", F.col(at) - F.row_number().over(w))
    out = runs.groupBy(key, "_g").agg(F.min(at).alias("start"), F.max(at).alias("stop"), F.count("*").alias("_n")).where(F.col("_n") >= least)
    return out.select(key, "start", "stop", F.floor((F.col("start") + F.col("stop")) / 2).cast("int").alias("mid"))


def valleys(profile: DataFrame, key: str = "image_id", ratio: float = 0.03, least: int = 10) -> DataFrame:
    return islands(profile, key, "row", F.col("white_frac") >= 1.0 - ratio, least)


def columns(profile: DataFrame, widths: DataFrame, key: str = "image_id", ratio: float = 0.15) -> DataFrame:
    """(key, cuts): 0, the middles of white strips, and the width; thirds where no strip is found."""
    strips = islands(profile, key, "row", F.col("white_frac") >= 1.0 - ratio).groupBy(key).agg(F.collect_list("mid").alias("mids"))
    w = F.col("width")
    thirds = F.array(F.lit(0), F.floor(w / 3).cast("int"), F.floor(2 * w / 3).cast("int"), w)
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), F.col("mids"), F.array(w))))
    return widths.join(strips, key, "left").select(key, F.when(F.col("mids").isNull(), thirds).otherwise(cuts).alias("cuts"))


def three_rows(ink: str, *keys: str, at: str = "row") -> Column:
    """The sum of a row and its two neighbours; rows beyond the edge count as 0."""
    return F.sum(ink).over(Window.partitionBy(*keys).orderBy(at).rowsBetween(-1, 1))


def moving_mean(ink: str, *keys: str, at: str = "row") -> Column:
    """Three-row centred mean; rows beyond the edge count as 0."""
    return three_rows(ink, *keys, at=at) / 3.0


def snap_whitespace(profile: DataFrame, points: DataFrame, key: str = "image_id", reach: int = 12) -> DataFrame:
    """points (key, y) with snapped: the row within reach that has least smoothed ink plus 8 for each row of distance."""
    near = points.join(profile, key).where((F.col("row") >= F.col("y") - reach) & (F.col("row") < F.col("y") + reach))
    # Three times the mean and the distance, so that whole numbers are summed and equal rows are equal: thirds are rounded.
    near = near.withColumn("_s", three_rows("ink", key, "y") + 24 * F.abs(F.col("row") - F.col("y")))
    best = near.groupBy(key, "y").agg(F.min(F.struct("_s", "row")).alias("_b"))
    return points.join(best, [key, "y"], "left").select(key, "y", F.coalesce("_b.row", "y").alias("snapped"))


def snap_bounds(segments: DataFrame, boxes: DataFrame) -> DataFrame:
    """segments (page_idx, seg_id, x1, y1, x2, y2, width, height, white_top, white_bottom) with top and bottom.

    Top goes to the first record box within reach, bottom to the lowest "available" box, else to the white rows given; where that
    crosses, the old bounds return; both stay on the page.
    """
    sx, sy = F.col("width") / PAGE_W, F.col("height") / PAGE_H
    b = boxes.select("page_idx", F.col("x_min").alias("bx1"), F.col("x_max").alias("bx2"), F.col("y_min").alias("by1"), F.col("y_max").alias("by2"), F.trim("text").alias("btext"))
    # Boxes of other texts can't be a bound. No broadcast: Spark takes boxes that it makes itself for few.
    b = b.where(F.col("btext").rlike(r"\b\d{5}\b") | is_available(F.col("btext")))
    j = segments.join(b.hint("merge"), "page_idx", "left")
    inside = ((F.col("bx1") + F.col("bx2")) / 2).between(F.col("x1") - scaled(10, sx), F.col("x2") + scaled(10, sx))
    rec = inside & F.col("btext").rlike(r"\b\d{5}\b") & (F.col("bx1") - F.col("x1") <= scaled(50, sx)) & (F.abs(F.col("by1") - F.col("y1")) <= scaled(50, sy))
    avail = inside & is_available(F.col("btext")) & (F.abs(F.col("by2") - F.col("y2")) <= scaled(50, sy))
    out = j.groupBy(*segments.columns).agg(F.min(F.when(rec, F.col("by1"))).alias("_t"), F.max(F.when(avail, F.col("by2"))).alias("_b"))
    out = out.withColumns({"_t": F.coalesce(F.floor("_t").cast("int"), F.col("white_top")), "_b": F.coalesce(F.floor(F.col("_b") + scaled(2, sy)).cast("int"), F.col("white_bottom"))})
    crossed = F.col("_b") <= F.col("_t")
    top, bottom = F.when(crossed, F.col("y1")).otherwise(F.col("_t")), F.when(crossed, F.greatest(F.col("y1") + 5, F.col("y2"))).otherwise(F.col("_b"))
    return out.select(*segments.columns, F.greatest(F.lit(0), top).alias("top"), F.least(F.col("height"), bottom).alias("bottom"))


def nearest_column(x: Column, width: Column) -> Column:
    d = F.array(*[F.abs(x - e) for e in edges(width)[:3]])
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def segment_anchors(segments: DataFrame, boxes: DataFrame) -> DataFrame:
    """segments (page_idx, record_no, seg_no, x1, y1, x2, y2, width, height) with has_rec and has_avail."""
    sx, sy = F.col("width") / PAGE_W, F.col("height") / PAGE_H
    e = F.array(*edges(F.col("width")))
    b = boxes.select("page_idx", ((F.col("x_min") + F.col("x_max")) / 2).alias("bx"), F.col("y_min").alias("by1"), F.col("y_max").alias("by2"), F.trim("text").alias("btext"))
    # Boxes of other texts are no anchors. No broadcast: Spark takes boxes that it makes itself for few.
    b = b.where(F.col("btext").rlike(r"\b\d{5}\b") | is_available(F.col("btext")))
    j = segments.withColumn("_c", nearest_column(F.col("x1"), F.col("width"))).join(b.hint("merge"), "page_idx", "left")
    inside = F.col("bx").between(F.get(e, F.col("_c")) - scaled(15, sx), F.get(e, F.col("_c") + 1) + scaled(15, sx))
    rec = inside & F.col("btext").rlike(r"\b\d{5}\b") & (F.abs(F.col("by1") - F.col("y1")) <= scaled(60, sy))
    low = (F.col("by2") > F.col("y1") + scaled(100, sy)) & (F.col("by2") <= F.col("y2") + scaled(10, sy))
    avail = inside & is_available(F.col("btext")) & ((F.abs(F.col("by2") - F.col("y2")) <= scaled(60, sy)) | low)
    return j.groupBy(*segments.columns).agg(F.coalesce(F.bool_or(rec), F.lit(False)).alias("has_rec"), F.coalesce(F.bool_or(avail), F.lit(False)).alias("has_avail"))


def plan_segments(pages: DataFrame, include_orphan: bool = False) -> DataFrame:
    """Pages (page_idx, image_path, width, height, y: 3 x 3 array of dividers by column) -> one row per record.

    (page_idx, record_no, merge_type, segments: array<struct<image_path, x1, y1, x2, y2>>). The last column's fourth row goes on at
    the top of the next page's first column; page numbers are consecutive, so the next page is a join on page_idx, not a global sort.
    """
    e = edges(F.col("width"))
    sy = F.col("height") / PAGE_H
    top, bottom = scaled(80, sy), scaled(980, sy)
    first = F.struct(F.col("image_path").alias("image_path"), e[0].alias("x1"), top.alias("y1"), e[1].alias("x2"), F.col("y")[0][0].alias("y2"))
    nxt = pages.select((F.col("page_idx") - 1).alias("page_idx"), first.alias("next"))
    j = pages.join(nxt, "page_idx", "left")

    def seg(c: int, a: Column, b: Column) -> Column:
        return F.struct(F.col("image_path").alias("image_path"), e[c].alias("x1"), a.alias("y1"), e[c + 1].alias("x2"), b.alias("y2"))

    def record(name: str | Column, merge: str | Column, segments: Column) -> Column:
        no = F.concat(F.lit("rec_"), F.col("page_idx").cast("string"), F.lit(name) if isinstance(name, str) else name)
        return F.struct(no.alias("record_no"), (F.lit(merge) if isinstance(merge, str) else merge).alias("merge_type"), segments.alias("segments"))

    y, rows = F.col("y"), []
    for c in range(3):
        rows.append(record(f"_{c + 1}_row2", "none", F.array(seg(c, y[c][0], y[c][1]))))
        rows.append(record(f"_{c + 1}_row3", "none", F.array(seg(c, y[c][1], y[c][2]))))
        last = seg(c, y[c][2], bottom)
        if c < 2:
            rows.append(record(f"_{c + 1}_row4_horiz", "horizontal", F.array(last, seg(c + 1, top, y[c + 1][0]))))
        else:
            goes_on = F.col("next").isNotNull()
            rows.append(record(F.when(goes_on, "_3_row4_vert").otherwise("_3_row4_tail"), F.when(goes_on, "vertical").otherwise("none"), F.when(goes_on, F.array(last, F.col("next"))).otherwise(F.array(last))))
    out = j.select("page_idx", F.inline(F.array(*rows)))
    if include_orphan:
        out = out.unionByName(pages.where("page_idx = 1").select("page_idx", F.lit("rec_000_orphan").alias("record_no"), F.lit("none").alias("merge_type"), F.array(first).alias("segments")))
    return out


def merge_rule(records: DataFrame, ignore_anchors: bool = False) -> DataFrame:
    """Records (merge_type, anchors: array of (has_rec, has_avail) by segment) with n_kept, merge_type and anchor_error."""
    a, n = F.col("anchors"), F.size("anchors")
    whole = (n == 2) & a[0]["has_rec"] & a[0]["has_avail"]
    last = F.when(n == 2, F.get(a, F.lit(1))["has_avail"]).otherwise(a[0]["has_avail"])
    no_rec = F.when(n == 2, "missing Record Number anchor in Segment 1.").otherwise("missing Record Number anchor.")
    no_avail = F.when(n == 2, "missing 'Available' anchor in Segment 2.").otherwise("missing 'Available' anchor.")
    error = F.when(F.lit(ignore_anchors) | whole, None).when(~a[0]["has_rec"], no_rec).when(~last, no_avail)
    return records.withColumns({"n_kept": F.when(whole, 1).otherwise(n), "merge_type": F.when(whole, "none").otherwise(F.col("merge_type")), "anchor_error": error})


def stitch_text(pieces: DataFrame, *keys: str) -> DataFrame:
    """(keys, text): the pieces of a record from top to bottom."""
    parts = F.array_sort(F.collect_list(F.struct("seg_no", "text")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def crop_qa(crops: DataFrame) -> DataFrame:
    """Crops (height, width, n_words, page_h, page_w, bottoms: array<int>, h_lines: array<int>) with score, suspicious and reasons."""
    h = F.col("page_h")
    least_h = F.greatest(F.lit(40), F.floor(h * 0.04).cast("int"))
    gap, lo, hi = F.floor(h * 0.08).cast("int"), F.floor(h * 0.2).cast("int"), F.floor(h * 0.8).cast("int")
    middle = F.filter("h_lines", lambda y: y.between(lo, hi))

    def off(b: Column) -> Column:
        lines = F.when(b.between(lo, hi), middle).otherwise(F.col("h_lines"))
        return F.coalesce(F.array_min(F.transform(lines, lambda y: F.abs(b - y))) > gap, F.lit(False))

    bad = F.size(F.filter("bottoms", off))
    height = F.when(F.col("height") > 0, F.least(F.lit(1.0), F.col("height") / F.greatest(least_h, F.col("height")))).otherwise(0.0)
    words = F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.col("n_words") / F.greatest(F.lit(4), F.col("n_words")))).otherwise(0.0)
    base = 0.4 * height + 0.3 * F.least(F.lit(1.0), F.col("width") / F.col("page_w")) + 0.3 * words
    reasons = F.array_compact(F.array(F.when(F.col("height") < least_h, "too_short"), F.when(F.col("n_words") < 4, "low_word_count"), F.when(bad > 0, "misaligned_with_dividers")))
    return crops.withColumns({"score": F.bround(F.greatest(F.lit(0.0), base - 0.15 * bad), 3), "reasons": reasons, "suspicious": F.size(reasons) > 0})


