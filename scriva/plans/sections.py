"""Splitting a record's lines into customer, shipper, policy and medication sections.

The split only goes forward, at most one step a line, so it is three chained minima over line numbers. Patterns are looked for in
the text of all lines at once; the line is what line breaks stand before the first that is found.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex
from scriva.functions.fields import bare_name, name_parts, once, real_parts, repeats
from scriva.functions.normalize import in_line

#: A blood group that a line shows; the section after it is the shipper's.
BLOOD_SHOWN = r"(?i)\b[ABO0ab]{1,2}\s*[+\-](?!\w)"
NAMES = ("customer", "shipper", "policy", "medication")
#: The state of a shipper, and what shows a policy; in capitals or as it is.
SHIP_STATE = r"\bCA\b"
POLICY_UPPER = "SR10|SR_|SR |BAX_|BAX "
POLICY_SHOWN = [r"\b(SR|5R|sR|Sr)[_0-9a-zA-Z]*\b", "(?i:" + in_line(lex.STAMP) + ")", "@"]
#: A premium; it counts on a line that shows a dollar sign.
PREMIUM = r"(?:100|150|200|250|300)\.00"
#: What shows a medication by itself, and what does so together; all in capitals.
MEDICATION_UPPER = "|".join(re.escape(a) + "(?:" + "|".join(re.escape(w[1:]) for w in [*lex.CARD_WORDS, *lex.MEDICINES] if w[0] == a) + ")" for a in sorted({w[0] for w in [*lex.CARD_WORDS, *lex.MEDICINES]}))
DOSE_UPPER = [r"\b\d+(?:\.\d+)?[^\S\n]*MG\b", r"(?<![-/])\b(30|50|60|90|120|180)\b(?![-/])"]
PRICE_UPPER = r"\$\d+|RATE|COST|TOTAL"


def ship_shown(lines: Column, line: Column, i: Column) -> Column:
    """Whether the shipper's section begins at a line, whatever the customer's name."""
    before = F.coalesce(F.get(lines, i - 1), F.lit("")).rlike(BLOOD_SHOWN)
    return ((i > 0) & before) | F.upper(line).rlike(SHIP_STATE)


def ship_trigger(lines: Column, line: Column, i: Column, repeated: Column) -> Column:
    """repeated: whether the line repeats the customer's name."""
    return ship_shown(lines, line, i) | ((i >= 2) & repeated)


def policy_trigger(line: Column) -> Column:
    premium = F.contains(line, F.lit("$")) & line.rlike(PREMIUM)
    return line.rlike("|".join(POLICY_SHOWN)) | F.upper(line).rlike(POLICY_UPPER) | premium


def medication_trigger(line: Column) -> Column:
    up = F.upper(line)
    return up.rlike(MEDICATION_UPPER) | (up.rlike("|".join(DOSE_UPPER)) & up.rlike(PRICE_UPPER))


def ahead(text: str, pattern: str) -> Column:
    """The text in front of the first place that shows the pattern, all of it if there is none."""
    return F.regexp_replace(text, f"(?s:(?:{pattern}).*)", "")


def line_behind(ahead: str, text: str) -> Column:
    """The number of the line that begins or goes on where `ahead` ends; null if that is the whole text."""
    return F.when(F.col(ahead) != F.col(text), F.length(ahead) - F.length(F.replace(F.col(ahead), F.lit("\n"))))


def boundaries(df: DataFrame, lines: str = "lines", name: str = "name") -> DataFrame:
    """df with i_ship, i_pol and i_med: the first line of each later section, or null. Lines hold no line breaks."""
    kept, n = df.columns, F.size(lines)

    def rest(i: str) -> Column:
        """The lines behind line i."""
        return F.call_function("substring_index", F.col("_text"), F.lit("\n"), F.col(i) + 1 - n)

    df = df.withColumn("_text", once(F.array_join(lines, "\n")))
    df = df.withColumn("_up", F.upper("_text"))
    df = df.withColumns({"_blood": ahead("_text", in_line(BLOOD_SHOWN)), "_state": ahead("_up", SHIP_STATE)})
    behind_blood = line_behind("_blood", "_text") + 1
    df = df.withColumn("_shown", once(F.least(F.when(behind_blood < n, behind_blood), line_behind("_state", "_up"))))
    # Names are compared on the lines before the first that shows the section by itself. What they are compared by is worked out
    # once for each line, not once for each place where it is used.
    df = df.withColumn("_head", F.slice(lines, F.lit(3), F.greatest(F.coalesce("_shown", n) - 2, F.lit(0))))
    df = df.withColumns({"_bare": once(F.transform("_head", bare_name)), "_parts": once(F.transform("_head", name_parts)), "_name": once(bare_name(F.col(name))), "_real": once(real_parts(name_parts(F.col(name))))})
    named = F.array_min(F.transform("_head", lambda x, i: F.when(repeats(F.get("_bare", i), F.get("_parts", i), F.col("_name"), F.col("_real")), i + 2)))
    df = df.select(*kept, "_text", once(F.least("_shown", named)).alias("i_ship"))
    df = df.withColumn("_rest", once(rest("i_ship")))
    df = df.withColumn("_up", F.upper("_rest"))
    shown = "|".join([*POLICY_SHOWN, rf"\$[^\n]*{PREMIUM}", rf"{PREMIUM}[^\n]*\$"])
    df = df.withColumns({"_policy": ahead("_rest", shown), "_upper": ahead("_up", POLICY_UPPER)})
    df = df.select(*kept, "_text", "i_ship", once(F.col("i_ship") + 1 + F.least(line_behind("_policy", "_rest"), line_behind("_upper", "_up"))).alias("i_pol"))
    df = df.withColumn("_up", once(F.upper(rest("i_pol"))))
    df = df.withColumn("_listed", once(ahead("_up", MEDICATION_UPPER)))
    # A dose and a price on one line, ahead of the first that shows a medication by itself: then the lines are looked at one by one.
    both = F.col("_listed").rlike("|".join(DOSE_UPPER)) & F.col("_listed").rlike(PRICE_UPPER)
    each = F.array_min(F.transform(lines, lambda x, i: F.when((i > F.col("i_pol")) & medication_trigger(x), i)))
    return df.select(*kept, "i_ship", "i_pol", F.when(both, each).otherwise(F.col("i_pol") + 1 + line_behind("_listed", "_up")).alias("i_med"))


def assign(df: DataFrame, lines: str = "lines") -> DataFrame:
    """df with the four section arrays, from the boundaries."""
    end = F.size(lines)
    ship, pol, med = F.coalesce("i_ship", end), F.coalesce("i_pol", end), F.coalesce("i_med", end)
    cuts = [(F.lit(0), ship), (ship, pol), (pol, med), (med, end)]
    return df.withColumns({n: F.slice(lines, a + 1, F.greatest(b - a, F.lit(0))) for n, (a, b) in zip(NAMES, cuts, strict=True)})


def split_into_sections(df: DataFrame, lines: str = "lines", name: str = "name") -> DataFrame:
    return assign(boundaries(df, lines, name), lines)
