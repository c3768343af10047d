"""Scalar pieces of extraction: column expressions over strings and arrays of words or lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex

EDGE = ",.() "


def round2(v: Column) -> Column:
    """Two places, rounded by the number's binary value: up from half, but exact halves (eighths) to the even neighbour."""
    r = v * 100
    low = F.floor(r)
    exact = v * 8 == F.floor(v * 8)
    up = (r - low > 0.5) | ((r - low == 0.5) & (~exact | (low % 2 == 1)))
    return (low + F.when(up, 1).otherwise(0)) / 100.0


def nonempty(x: Column) -> Column:
    return F.when(x != "", x)


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """The first match, or null."""
    return nonempty(F.regexp_extract(text, pattern, group))


def all_matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def strip(text: Column, chars: str = EDGE) -> Column:
    return F.btrim(text, F.lit(chars))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text, F.lit(""))))


def name_words(name: Column) -> Column:
    """The lower-case words of a name, and of the capitalised parts of glued ones."""
    parts = F.filter(F.split(F.coalesce(name, F.lit("")), r"[\s_.\-@]+"), lambda w: w != "")

    def camel(w: Column) -> Column:
        found = all_matches(w, "[A-Z][a-z]*")
        return F.when(F.size(found) > 1, found).otherwise(F.expr("cast(array() as array<string>)"))

    every = F.concat(parts, F.flatten(F.transform(parts, camel)))
    return F.array_distinct(F.filter(F.transform(every, lambda w: F.btrim(F.lower(w), F.lit(".,()[]-"))), lambda w: w != ""))


def fix_email(mail: Column) -> Column:
    """Completes known domains and repairs misread ones; the first known domain that occurs decides."""
    x = F.trim(mail)
    for part, whole in lex.DOMAIN_ENDS:
        x = F.regexp_replace(x, rf"(?i)@{part}$", f"@{whole}")
    tries = []
    for raw, right in lex.DOMAINS:
        at = F.instr(F.lower(x), raw)
        user = F.btrim(F.substring(x, F.lit(1), at - 1), F.lit(" \t@_.-"))
        tries.append(F.when((at > 0) & (user != ""), F.concat(user, F.lit("@" + right))))
    return F.coalesce(*tries, x)


def fix_phone(phone: Column) -> Column:
    return F.regexp_replace(phone, r"^\(S", "(8")


def fix_stamp_code(code: Column) -> Column:
    return F.translate(code, *lex.CODE_LETTERS)


def fix_state(word: Column) -> Column:
    """A state code from a word as read, or null."""
    x = F.translate(F.upper(strip(word)), *lex.STATE_DIGITS)
    x = F.when(x == "ON", "OH").otherwise(x)
    return F.when(x.isin(lex.STATES), x)


def gender(text: Column) -> Column:
    up = F.upper(text)
    return F.coalesce(*[F.when(up.rlike(p), name) for name, p in lex.GENDER])


def bare_name(x: Column) -> Column:
    """Letters and digits in lower case, without titles in front."""
    front = "".join(f"(?:{t}(?=.{{3}}))?" for t in lex.TITLES)
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]", ""), f"^{front}", "")


def name_parts(x: Column) -> Column:
    return F.split(F.lower(x), r"[\s\-_,.]+")


def real_parts(parts: Column) -> Column:
    return F.filter(parts, lambda w: (F.length(w) > 2) & ~w.isin(lex.TITLES))


def repeats_name(line: Column, name: Column) -> Column:
    """Whether a line repeats a name, misreadings allowed."""
    return repeats(bare_name(line), name_parts(line), bare_name(name), real_parts(name_parts(name)))


def repeats(ln: Column, line_parts: Column, c: Column, name_real: Column) -> Column:
    """As repeats_name, from the bare line, its parts, the bare name and its real parts."""
    low = F.length(c)

    def near_word(w: Column) -> Column:
        bare = F.regexp_replace(w, "[^a-z0-9]", "")
        return (F.length(bare) >= 3) & (F.levenshtein(c, bare, 1) >= 0)

    short_hit = F.contains(ln, c) | ((low >= 3) & F.exists(line_parts, near_word))
    prefix = [(low + d <= F.length(ln)) & (F.levenshtein(c, F.substring(ln, F.lit(1), low + d), 2) >= 0) for d in (-1, 0, 1)]
    near = F.exists(real_parts(line_parts), lambda b: F.exists(name_real, lambda a: F.levenshtein(a, b, 1) >= 0))
    hit = F.when(low <= 4, short_hit).otherwise(reduce(lambda a, b: a | b, prefix) | near)
    return F.coalesce((c != "") & (ln != "") & hit, F.lit(False))


def once(x: Column) -> Column:
    """x, worked out once a row: the optimizer folds nothing that may differ from call to call into lambdas, where it would be worked
    out for every word. The index is always 0; x itself is under no condition, so that equal parts of it are worked out once."""
    return F.get(F.array(x), (F.monotonically_increasing_id() < 0).cast("int"))


def record_no(lines: Column, joined: Column) -> Column:
    """The likeliest of the isolated five-digit runs: not a ZIP, not a stamp code, at the start of a line. joined: the lines, by
    spaces; lines: at least those that show five digits."""
    runs, points = all_matches(joined, r"(?<!\d)\d{5}(?!\d)"), lex.RECORD_SCORES

    def score(run: Column, k: Column) -> Column:
        before = F.rtrim(F.call_function("substring_index", joined, run, F.lit(1)))
        tail = F.substring(before, -15, 15)
        state = F.when(F.upper(F.regexp_extract(tail, lex.BEHIND_STATE, 1)).isin(lex.STATES), points["state"]).otherwise(0)
        stamp = F.when(tail.rlike(lex.BEHIND_STAMP), points["stamp"]).otherwise(0)

        def in_line(x: Column) -> Column:
            at = F.instr(x, run)
            rest = F.trim(F.substring(x, at + 5, F.length(x)))
            good = (rest != "") & ~rest.rlike(r"^\d") & ~F.upper(rest).rlike(lex.NOT_A_NAME)
            return F.when(at == 0, 0).otherwise(F.when(at == 1, points["first"]).otherwise(0) + F.when(good, points["name"]).otherwise(0))

        return F.struct((points["start"] + state + stamp + F.aggregate(F.transform(F.filter(lines, lambda x: F.contains(x, run)), in_line), F.lit(0), lambda s, v: s + v)).alias("score"), (-k).alias("back"), run.alias("run"))

    return F.array_max(F.transform(runs, score))["run"]


def int_between(word: Column, lo: int, hi: int) -> Column:
    """The digits of a word if they are three and the number lies between lo and hi, else null."""
    d = F.regexp_replace(word, r"\D", "")
    return F.when((F.length(d) == 3) & d.cast("int").between(lo, hi), d.cast("int").cast("string"))


def body_numbers(line: Column) -> Column:
    return F.array_compact(F.transform(words_of(line), lambda w: int_between(w, 100, 250)))


def yes_no(words: Column) -> Column:
    """YES and NO tokens in order, common misreadings included."""

    def one(w: Column) -> Column:
        x = F.regexp_replace(F.upper(w), "[^A-Z0-9]", "")
        return F.when(x.isin(lex.YES), "YES").when(x.isin(lex.NO), "NO")

    return F.array_compact(F.transform(words, one))


def card_name(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), name) for name, p in lex.CARDS])


def medicine_in(text: Column) -> Column:
    """The first of the sought list that occurs."""
    up = F.upper(text)
    return F.coalesce(*[F.when(F.contains(up, F.lit(m)), m) for m in lex.MEDICINES_SOUGHT])


def unglue(text: Column) -> Column:
    """Parts a medicine and its dose, and two prices."""
    parted = F.regexp_replace(text, r"(?i)(" + "|".join(lex.MEDICINES_SOUGHT) + ")" + lex.GLUED_DOSE, "$1 $2")
    return F.regexp_replace(F.when(text.rlike(r"[A-Za-z]\d+(?:\.\d+)?\s*[Mm][Gg]"), parted).otherwise(text), lex.GLUED_PRICES, "$1 $2")


def dosage(text: Column) -> Column:
    raw = F.upper(F.regexp_replace(first_match(text, lex.DOSE, 1), r"\s+", " "))
    return F.when(F.startswith(raw, F.lit(".")), F.concat(F.lit("0"), raw)).otherwise(raw)


def partial_dosage(text: Column) -> Column:
    return F.concat(F.ltrim(F.regexp_replace(first_match(text, lex.PART_OF_DOSE, 1), r"^\.+", "")), F.lit("MG"))


def tablets(text: Column) -> Column:
    """The first standalone number of two or three digits."""
    return first_match(text, r"(?<!\S)(\d{2,3})(?!\S)", 1)


def amounts(text: Column) -> Column:
    """Money amounts as decimals, dosages left out."""
    rest = F.regexp_replace(text, r"(?i)\b\d+(?:\.\d+)?\s*MG\b", "")
    return F.transform(all_matches(rest, lex.MONEY, 1), lambda x: x.cast("decimal(12,2)"))


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), amount.cast("decimal(12,2)").cast("string"))


def clean_holder(text: Column) -> Column:
    """A policy holder's name without dates, money, policy numbers, stamps and mail."""
    for pattern in lex.HOLDER_NOISE:
        text = F.trim(F.regexp_replace(text, pattern, ""))
    return text
