"""Page catalogs: listing, size filter, natural order, numbering and ranges; review files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex
from scriva.shared import stored


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, width, height) of the readable images under a path."""
    df = spark.read.format("image").option("dropInvalid", True).load(path)
    return catalog(df.select(F.col("image.origin").alias("image_path"), F.col("image.width").alias("width"), F.col("image.height").alias("height")))


def catalog(files: DataFrame) -> DataFrame:
    return files.where(F.lower("image_path").rlike(r"\.(png|jpe?g)$"))


def large_enough(pages: DataFrame, least: int = 500) -> DataFrame:
    return pages.where((F.col("height") > least) & (F.col("width") > least))


def natural_key(name: Column) -> Column:
    """Orders page_2 before page_10: digit runs as padded numbers, other runs in lower case; a leading number is preceded by ""."""
    parts = F.transform(F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0)), lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(F.lower(p)))
    return F.when(name.rlike(r"^\d"), F.concat(F.array(F.lit("")), parts)).otherwise(parts)


def number(pages: DataFrame) -> DataFrame:
    """pages with page_idx from 1 in natural order.

    The pages are sorted by ranges; a row's number is its place in its range and the rows of the ranges before. Ranges are few,
    so the running sum over them is one small task.
    """
    kept = pages.columns
    ranged = pages.orderBy(natural_key(F.col("image_path")), "image_path").select("*", F.monotonically_increasing_id().alias("_id"))
    ranged = stored(ranged, "pages-sorted").select(*kept, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_place"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    return ranged.join(F.broadcast(before), "_range").select(*kept, (F.col("_before") + F.col("_place") + 1).cast("long").alias("page_idx"))


def limit(pages: DataFrame, n: int | None) -> DataFrame:
    return pages if n is None else pages.where(F.col("page_idx") <= n)


def between(pages: DataFrame, start: int, end: int) -> DataFrame:
    return pages.where(F.col("page_idx").between(max(start, 1), end))


def last_only(pages: DataFrame) -> DataFrame:
    top = pages.agg(F.max("page_idx").alias("page_idx"))
    return pages.join(F.broadcast(top), "page_idx", "left_semi")


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """The review file; an empty table if there is none."""
    schema = ", ".join(f"`{c}` string" for c in [*lex.COLUMNS, "VALIDATION_ERRORS"])
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], schema)
    return spark.read.options(sep="|", header=True, quote='"', escape='"', emptyValue="").schema(schema).csv(path).fillna("")
