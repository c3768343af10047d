"""The listed name nearest to the words of a text, by an index of deletion neighbourhoods.

Two words within one edit (a letter inserted, dropped or replaced) have a key in common among themselves and what is left of them
without one letter. Words and names meet by equal keys, and only those that meet are compared, so that the work for a word does
not grow with the list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deletions(word: Column) -> Column:
    """The word, and the word without each of its letters."""
    n = F.length(word)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))
    return F.array_distinct(F.concat(F.array(word), cut))


def nearest_names(words: DataFrame, names: DataFrame) -> DataFrame:
    """(word, d, place, name): for each different word of `words` (word) the name of `names` (name, place) within one edit: the
    least distance d, then the first place. Words without one are not returned."""
    index = names.select("name", "place", F.explode(deletions(F.col("name"))).alias("key"))
    asked = words.select("word").where("word is not null").distinct().select("word", F.explode(deletions(F.col("word"))).alias("key"))
    met = asked.join(index, "key").select("word", F.levenshtein(F.col("word"), F.col("name"), 1).alias("d"), "place", "name").where("d >= 0")
    return met.groupBy("word").agg(F.min(F.struct("d", "place", "name")).alias("best")).select("word", "best.*")


#: Texts with a name that are broadcast, at most: 64 letters of a key and a name each.
FEW = 200_000


def with_nearest(rows: DataFrame, text: str, wanted: Column, clean: Column, names: DataFrame, out: str, least: int = 4, store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """rows with the name nearest to a word of the column `text`, for rows that want one: least distance, then first word, then place.

    clean: the words of the text to compare, as an array. What is nearest depends on the text alone, so that equal texts are looked
    up once and rows need no id. Rows that want none meet nothing and are spread over all tasks. With store, which writes a table
    and reads it back, texts with a name are counted: few of them are broadcast, as a text may be that of very many rows.
    """
    key = F.when(wanted, F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).otherwise(F.concat(F.lit("-"), F.xxhash64(text).cast("string")))
    keyed = rows.withColumn("_key", key)
    texts = rows.where(wanted).select(key.alias("_key"), clean.alias("_words")).dropDuplicates(["_key"])
    each = texts.select("_key", F.posexplode("_words").alias("i", "word")).where(F.length("word") >= least)
    best = each.join(nearest_names(each, names), "word").groupBy("_key").agg(F.min(F.struct("d", "i", "place", "name")).alias("best"))
    found = best.select("_key", F.col("best.name").alias(out))
    if store:
        found = store(found, "nearest")
        found = found.hint("broadcast" if found.count() <= FEW else "merge")
    return keyed.join(found, "_key", "left").drop("_key")
