"""Fallback: fields that are still empty take their section's raw line, marked so that the record goes to review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import fields as x
from scriva.functions import lexicons as lex
from scriva.plans.validate import value

CONFIDENCE, LONGEST = 0.3, 100


def raw_line(section: Column, k: int) -> Column:
    """The line of that number, or the last one; null for an empty section or a line that says "available"."""
    line = F.get(section, F.least(F.lit(k), F.size(section) - 1))
    return F.when(~F.contains(F.lower(line), F.lit("available")), F.substring(line, 1, LONGEST))


def fitted(column: str, line: Column) -> Column:
    """What of a line may stand in the field; null if nothing."""
    if column in ("ZIP_1", "ZIP_2"):
        return x.first_match(line, lex.ZIP, 1)
    if column in ("D BIRTH", "DOB", "D_B_LIFE_ASSURE"):
        return x.first_match(line, lex.DATE, 1)
    if column in ("SEX_1", "SEX_2"):
        return F.when(F.contains(F.upper(line), F.lit("FEMALE")), "FEMALE").when(F.contains(F.upper(line), F.lit("MALE")), "MALE")
    if column == "EMAIL ADDRESS":
        return x.first_match(line, lex.EMAIL)
    if column == "NAME_P_HOLDER":
        clean = F.btrim(F.regexp_replace(x.clean_holder(line), r"\d+", ""), F.lit(" ,.-_"))
        return F.when(F.length(F.regexp_replace(clean, r"\P{L}", "")) >= 3, clean)
    return line


def fill(df: DataFrame) -> DataFrame:
    new = {}
    for column, (section, k) in lex.FALLBACK.items():
        name = lex.field(column)
        found = x.nonempty(F.trim(fitted(column, raw_line(F.col(section), k))))
        filled = F.struct(found.alias("value"), F.lit(CONFIDENCE).alias("confidence"), F.lit("fallback").alias("source"))
        new[name] = F.when((value(column) == "") & found.isNotNull(), filled).otherwise(F.col(name))
    return df.withColumns(new)
