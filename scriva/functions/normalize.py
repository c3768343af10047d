"""Text cleanup: one function for each rule, and the ordered composition that counts corrections.

Rules are scalar expressions over a line. White space in them never spans a line break, so that they hold for a whole text of
lines as well: the composition runs each rule once over the text of a record, one projection a rule, in generated code and without
a shuffle. Lines and tokens are only taken apart in records that a rule has changed (to count corrections) or whose text shows
that a token rule may apply.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex

#: Stands for a stamp while the other rules run; no rule touches it.
HIDDEN = "\ue000"
ANY_STATE = "(?i:" + "|".join(lex.STATES) + ")"
STAMP = "(?i)" + lex.STAMP


def split_lines(text: Column) -> Column:
    """Trimmed lines without blank ones, white space collapsed."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.filter(lines, lambda x: x != "")


def drop_div0(line: Column) -> Column:
    return F.regexp_replace(line, in_line(lex.DIV0), "")


def split_zip_country(line: Column) -> Column:
    return F.regexp_replace(line, lex.ZIP_COUNTRY, "$1 $2")


def where(line: Column, shows: list[str], changed: Column) -> Column:
    """The changed line if the line shows one of the patterns without which nothing changes, and that are cheap to look for."""
    return F.when(reduce(lambda a, b: a | b, [line.rlike(p) for p in shows]), changed).otherwise(line)


def in_line(pattern: str) -> str:
    """The pattern, with white space that is no line break."""
    return pattern.replace(r"\s", r"[^\S\n]")


def split_zip_phone(line: Column) -> Column:
    return F.regexp_replace(line, in_line(lex.ZIP_PHONE), "$1 $2")


def fix_slashes(line: Column) -> Column:
    return where(line, ["//", r"\\"], F.regexp_replace(F.regexp_replace(line, "/+", "/"), r"\\+", "/"))


def stamp_of(line: Column) -> Column:
    """The first stamp of a line, rewritten as prefix_name_code; "" if there is none."""
    part = [F.regexp_extract(line, STAMP, k) for k in (1, 2, 3)]
    return F.when(line.rlike(STAMP), F.concat_ws("_", *part)).otherwise("")


def hide_stamp(line: Column) -> Column:
    hidden = F.regexp_replace(line, r"(?is)^(.*?)" + lex.STAMP + "(.*)$", f"$1 {HIDDEN} $5")
    return F.trim(F.regexp_replace(hidden, r"\s+", " "))


def show_stamp(line: Column, stamp: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(line, F.lit(HIDDEN), stamp), r"\s+", " "))


def rewrite_stamp(line: Column) -> Column:
    return show_stamp(hide_stamp(line), stamp_of(line))


def split_state_zip(line: Column) -> Column:
    return where(line, [r"[A-Za-z]\d{5}\b"], F.regexp_replace(line, rf"\b({ANY_STATE})(\d{{5}})\b", "$1 $2"))


def split_city_state(line: Column) -> Column:
    """AnaheimcA 65847 -> Anaheim CA 65847. Ordinary words, all capitals or title case, are left alone."""
    word = rf"^(.*?\b)((?![A-Z]+$)(?![A-Z][a-z]+$)[A-Za-z]{{2,}})((?=.?[A-Z]){ANY_STATE})$"
    tokens = F.split(line, " ")

    def one(t: Column, i: Column) -> Column:
        goes_on = F.coalesce(F.get(tokens, i + 1), F.lit("")).rlike(r"^\d{5}\b")
        found = [F.regexp_extract(t, word, k) for k in (1, 2, 3)]
        return F.when(goes_on & (found[2] != ""), F.concat(found[0], found[1], F.lit(" "), F.upper(found[2]))).otherwise(t)

    return F.array_join(F.transform(tokens, one), " ")


def split_camel(line: Column) -> Column:
    return F.regexp_replace(line, "([a-z])([A-Z])", "$1 $2")


def close_dates(line: Column) -> Column:
    closed = line
    for pattern, new in lex.DATE_GAPS:
        closed = F.regexp_replace(closed, in_line(pattern), new)
    return where(line, [in_line(p) for p in (r"\b\d\s+\d/", r"/\d\s+\d/", r"\d\s+/", r"/\s+\d")], closed)


def split_dosage(line: Column) -> Column:
    return F.regexp_replace(line, in_line(lex.GLUED_MG), "$1 ")


def isolate_dates(line: Column) -> Column:
    isolated = line
    for pattern, new in lex.DATE_EDGES:
        isolated = F.regexp_replace(isolated, pattern, new)
    return where(line, [r"/\d{2,4}[^\s\d/]", r"/(?<=[^\s\d/]\d{1,2}/)\d"], isolated)


def split_alpha_digit(line: Column) -> Column:
    return where(line, [r"[A-Za-z]{2}\d"], F.regexp_replace(line, lex.GLUED_DIGITS, "$1 "))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def phone_token(t: Column) -> Column:
    d = digits_of(t)
    good = t.rlike(r"[\d\(][\d\)\-\.\s]{6,}\d") & (F.length(d) == 10)
    return F.when(good, F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))).otherwise(t)


def zip_token(t: Column) -> Column:
    """Nine digits -> zip+4, only if the token is nothing but digits and hyphens."""
    d = digits_of(t)
    return F.when(t.rlike(r"^[\d-]+$") & (F.length(d) == 9), F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4))).otherwise(t)


def mixed_token(t: Column) -> Column:
    """Digits inside short tokens that also have letters become the letters they resemble."""
    skip = t.rlike(r"\d{1,2}/\d{1,2}/\d{2,4}") | t.rlike(r"^\d+(?:\.\d+)?[Mm][Gg]$") | (F.length(digits_of(t)) == 5)
    mixed = t.rlike(r"\d") & t.rlike(r"\p{L}") & (F.length(t) <= 12)
    return F.when(mixed & ~skip, F.translate(t, *lex.DIGITS_TO_LETTERS)).otherwise(t)


def state_token(t: Column) -> Column:
    """Two-character tokens with a letter are upper-cased, digits read as letters."""
    return F.when(t.rlike(r"^[A-Za-z0-9]{2}$") & t.rlike("[A-Za-z]"), F.translate(F.upper(t), *lex.DIGITS_TO_LETTERS)).otherwise(t)


def tidy_punctuation(line: Column) -> Column:
    for pattern, new in lex.LOOSE_SIGNS:
        line = F.regexp_replace(line, in_line(pattern), new)
    return line


def factor(corrections: Column) -> Column:
    return F.greatest(F.lit(0.75), 1.0 - F.least(F.lit(5), corrections) * 0.05)


def per_line(rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda text: F.array_join(F.transform(F.split(text, "\n"), rule), "\n")


def per_token(rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return per_line(lambda line: F.array_join(F.transform(F.split(line, " "), rule), " "))


def where_it_looks(rule: Callable[[Column], Column], looks: str) -> Callable[[Column], Column]:
    """A token rule over a text, if it changes a token that looks so."""

    def over(text: Column) -> Column:
        some = F.regexp_extract_all(text, F.lit(rf"(?<!\S)(?:{looks})(?!\S)"), F.lit(0))
        return F.when(F.exists(some, lambda t: rule(t) != t), per_token(rule)(text)).otherwise(text)

    return over


def city_states(text: Column) -> Column:
    """split_city_state for each line, if four letters, which may be a word and a state, stand before a ZIP somewhere."""
    return where(text, [r"[A-Za-z]{4} \d{5}\b"], per_line(split_city_state)(text))


#: Rules before the stamp is hidden, and after; True if a changed line counts as a correction.
EARLY = [(drop_div0, False), (split_zip_country, True), (split_zip_phone, True), (fix_slashes, True)]
LATE = [(lambda x: city_states(split_state_zip(x)), True), (split_camel, True), (close_dates, True), (split_dosage, True), (isolate_dates, True), (split_alpha_digit, True)]
#: Token rules, and what a token must look like for one to change it.
TOKEN = [
    (phone_token, r"(?=(?:[^\d\s]*+\d){10})\S+"),
    (zip_token, r"[\d-]{9,}"),
    (mixed_token, r"(?=[^\d\s]*+\d)(?=[^\p{L}\s]*+\p{L})\S{2,12}"),
    (state_token, "(?=.?[a-z0-9])(?=.?[A-Za-z])[A-Za-z0-9]{2}"),
]


#: A stamp as the rules leave it, that stands alone and that no token rule reads.
SETTLED_STAMP = r"[BSbs](?<!\S.)aX_[A-Za-z]+_\d{5}(?!\S)"
#: What a text shows, its settled stamps hidden, if any rule may change it: each rule finds something only where one of these does.
UNSETTLED = [
    r"[\t\x0B\f\r#\\]|[ \n](?:[ \n]|\z|(?<=\A[ \n]))|\A\z",  # white space of split_lines, blank lines; drop_div0; fix_slashes
    r"/(?:/|[^\S\n]+\d|\d{2,4}[^\s\d/]|(?<=[^\s\d/]\d{1,2}/)\d)",  # fix_slashes, close_dates, isolate_dates
    r"\d(?:[^\S\n]+\d?/|\d{4}(?:[A-Za-z]{2}|\d{3}))",  # close_dates, split_zip_country, split_zip_phone, zip_token
    r"\d(?=\S{8})(?:[\d-]{8}|(?:[^\d\s]*+\d){9})",  # zip_token, phone_token
    r"\d{5}\b(?<=[A-Za-z]\d{5}|[A-Za-z]{4} \d{5})",  # split_state_zip, split_city_state
    r"[a-z][A-Z]|[A-Za-z]\d(?:(?<=[A-Za-z]{2}\d)|[\d.]*[^\S\n]*[Mm][Gg])|[Xx](?<=[BSbs5][Aa][Xx])",  # split_camel, split_alpha_digit, split_dosage, other stamps
    r"(?<!\S)(?=[^\d\s]*+\d)(?=[^\p{L}\s]*+\p{L})(?!\d+(?:\.\d+)?[Mm][Gg](?!\S))(?!(?:[^\d\s]*+\d){5}[^\d\s]*+(?!\S))\S{2,12}(?!\S)",  # mixed_token
    r"(?<!\S)(?=.?[a-z0-9])(?=.?[A-Za-z])[A-Za-z0-9]{2}(?!\S)",  # state_token
    rf" [,.:;\-]|\$ |{HIDDEN}[^\n]*{HIDDEN}",  # tidy_punctuation; the rules hide one stamp of a line
]


def is_settled(text: Column) -> Column:
    """Whether no rule changes a text of lines; False where that is not plain to see."""
    hidden = F.regexp_replace(text, SETTLED_STAMP, HIDDEN)
    return ~F.contains(text, F.lit(HIDDEN)) & ~reduce(lambda a, b: a | b, [hidden.rlike(p) for p in UNSETTLED])


def normalize(df: DataFrame, lines: str = "lines") -> DataFrame:
    """df with the array column `lines` normalised, and corrections (int) and norm_factor (double). A text that is settled goes by
    all rules: for them it is null."""
    kept = [c for c in df.columns if c not in (lines, "corrections", "norm_factor")] + ["_done"]

    def step(df: DataFrame, rule: Callable[[Column], Column], count: Callable[[Column, Column], Column] | None) -> DataFrame:
        """Runs a rule over the text so far. What it changed is counted by the next step, from the text before and after."""
        new = df.select(*kept, "_stamps", "_n", F.col("_x").alias("_old"), rule(F.col("_x")).alias("_x"))
        if count is None:
            return new
        return new.select(*kept, "_stamps", (F.col("_n") + count(F.col("_old"), F.col("_x"))).alias("_n"), F.lit(None).cast("string").alias("_old"), "_x")

    def restamp(df: DataFrame, text: Column, stamps: Column) -> DataFrame:
        return df.select(*kept, stamps.alias("_stamps"), "_n", "_old", text.alias("_x"))

    out = df.select(*kept[:-1], F.array_join(lines, "\n").alias("_x"))
    out = out.select("*", is_settled(F.col("_x")).alias("_settled"))
    out = out.select(*kept[:-1], F.when(F.col("_settled"), F.col("_x")).alias("_done"), F.lit(None).cast("array<string>").alias("_stamps"), F.lit(0).alias("_n"), F.lit(None).cast("string").alias("_old"), F.when(~F.col("_settled"), F.col("_x")).alias("_x"))
    for rule, counts in EARLY:
        out = step(out, rule, lines_changed if counts else None)
    x, stamps, has = F.col("_x"), F.col("_stamps"), F.col("_x").rlike(STAMP)
    out = restamp(out, F.when(has, per_line(lambda ln: F.when(ln.rlike(STAMP), hide_stamp(ln)).otherwise(ln))(x)).otherwise(x), F.when(has, F.transform(F.split(x, "\n"), stamp_of)))
    for rule, counts in LATE:
        out = step(out, rule, lines_changed if counts else None)
    shown = F.array_join(F.zip_with(F.split(x, "\n"), stamps, lambda ln, s: F.when(s == "", ln).otherwise(show_stamp(ln, s))), "\n")
    out = restamp(out, F.when(stamps.isNull(), x).otherwise(shown), F.lit(None).cast("array<string>"))
    for rule, looks in TOKEN:
        out = step(out, where_it_looks(rule, looks), tokens_changed)
    tidy = F.filter(F.split(tidy_punctuation(x), "\n"), lambda ln: F.trim(ln) != "")
    done = F.col("_done").isNotNull()
    out = out.select(*kept[:-1], F.when(done, F.split("_done", "\n")).otherwise(tidy).alias(lines), F.when(done, 0).otherwise(F.col("_n")).alias("corrections"))
    return out.select("*", factor(F.col("corrections")).alias("norm_factor"))


def lines_changed(old: Column, new: Column) -> Column:
    """How many lines of a text a rule changed."""
    differ = F.zip_with(F.split(old, "\n"), F.split(new, "\n"), lambda a, b: a != b)
    return F.when(old == new, 0).otherwise(F.size(F.filter(differ, lambda d: d)))


def tokens_changed(old: Column, new: Column) -> Column:
    """How many tokens of a text a token rule changed."""
    each = F.zip_with(F.split(old, "\n"), F.split(new, "\n"), _tokens_changed)
    return F.when(old == new, 0).otherwise(F.aggregate(each, F.lit(0), lambda s, v: s + v))


def _tokens_changed(old: Column, new: Column) -> Column:
    """How many tokens a token rule changed. A phone becomes two tokens: then the tokens it is made of count once."""
    a, b = F.split(old, " "), F.split(new, " ")
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    return F.when(old == new, 0).otherwise(F.when(F.size(a) == F.size(b), same).otherwise(F.size(b) - F.size(a)))


def clean_available(lines: Column) -> Column:
    return F.filter(lines, lambda x: ~F.lower(x).isin(lex.AVAILABLE))


#: An @ that is not part of an email; without one no line is broken.
LOOSE_AT = r"@(?:(?<![a-zA-Z0-9_.+-]@)|(?![a-zA-Z0-9-]+\.[a-zA-Z0-9.-]))"


def join_split_email(lines: Column) -> Column:
    """Joins an email that is broken over two lines; what else is on the second line stays there."""
    return F.when(F.array_join(lines, "\n").rlike(LOOSE_AT), _joined_emails(lines)).otherwise(lines)


def _joined_emails(lines: Column) -> Column:
    mail, ends = lex.EMAIL, r"(?i)\.(com|net|org|co)$"
    start = F.struct(F.expr("cast(array() as array<string>)").alias("out"), F.lit(None).cast("string").alias("open"))

    def first(x: Column) -> Column:
        return F.regexp_extract(x, r"^(\S+)", 1)

    def broken(x: Column) -> Column:
        return F.contains(x, F.lit("@")) & ~x.rlike(mail) & ~x.rlike(ends)

    def take(acc: Column, x: Column) -> Column:
        whole = F.concat(acc["open"], first(x))
        joins = acc["open"].isNotNull() & whole.rlike(mail)
        rest = F.when(joins, F.trim(F.substring(x, F.length(first(x)) + 1, 1 << 30))).otherwise(x)
        out = F.when(acc["open"].isNull(), acc["out"]).when(joins, F.concat(acc["out"], F.array(whole))).otherwise(F.concat(acc["out"], F.array(acc["open"])))
        goes_on = broken(rest)
        out = F.when(goes_on | (rest == ""), out).otherwise(F.concat(out, F.array(rest)))
        return F.struct(out.alias("out"), F.when(goes_on, rest).alias("open"))

    return F.aggregate(lines, start, take, lambda acc: F.when(acc["open"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["open"]))))
