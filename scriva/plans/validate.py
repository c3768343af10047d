"""Validation: rules over the 43 fields -> status, errors, missing and malformed fields."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex

NOISE = r"Available|Availabie|Not|\.png|\.jpg"
RESULT = ["status", "valid", "errors", "missing_fields", "format_errors", "validity"]


@dataclass(frozen=True)
class Rule:
    column: str
    broken: Column  # for a value that is not empty
    message: Column


def value(column: str) -> Column:
    return F.trim(F.coalesce(F.col(f"{lex.field(column)}.value"), F.lit("")))


def _says(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def phone_broken(v: Column) -> Column:
    return v.rlike("[a-zA-Z]") | (F.length(F.regexp_replace(v, r"\D", "")) < 7)


def money_broken(v: Column) -> Column:
    return ~F.replace(v, F.lit(","), F.lit("")).rlike(r"^\$?\d+(\.\d{1,2})?$")


def name_broken(v: Column) -> Column:
    """Noise, more than two digits, or any digit beside fewer than two words with letters."""
    digits = F.regexp_count(v, F.lit(r"\d"))
    words = F.size(F.filter(F.split(v, r"[\s\-_,.]+"), lambda w: w.rlike(r"\p{L}")))
    return v.rlike(r"\$|\||" + NOISE) | (digits > 2) | ((digits > 0) & (words < 2))


def address_broken(v: Column) -> Column:
    return v.rlike(NOISE + "|/")


def rules() -> list[Rule]:
    out: list[Rule] = []

    def add(column: str, broken: Column, *says: str | Column) -> None:
        out.append(Rule(column, broken, _says(*says)))

    v = value("RECORD NO")
    add("RECORD NO", ~v.rlike(r"^\d{5}$"), "Invalid Record Number format '", v, "': must be exactly 5 digits.")
    v = value("EMAIL ADDRESS")
    add("EMAIL ADDRESS", ~v.rlike("^" + lex.EMAIL) | F.contains(v, F.lit(" ")), "Invalid Email format '", v, "'.")
    for c in ("ZIP_1", "ZIP_2"):
        v = value(c)
        add(c, ~v.rlike(r"^\d{5}$"), f"Invalid {c} format '", v, "': must be exactly 5 digits.")
    v = value("PH_NO1")
    add("PH_NO1", phone_broken(v), "Invalid PH_NO1 '", v, F.when(v.rlike("[a-zA-Z]"), "': contains alphabetical characters.").otherwise("': must contain at least 7 digits."))
    for c in ("D BIRTH", "D_B_LIFE_ASSURE", "DOB"):
        v = value(c)
        add(c, ~v.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}$"), f"Invalid date format for {c} '", v, "': must match MM/DD/YY(YY).")
    for c in ("SEX_1", "SEX_2"):
        v = F.upper(value(c))
        add(c, ~v.isin("MALE", "FEMALE"), f"Invalid sex format for {c} '", v, "': must be MALE or FEMALE.")
    v = F.upper(value("BLOOD GP"))
    add("BLOOD GP", ~v.isin(lex.BLOOD_GROUPS), "Invalid blood group '", v, "': must be A/B/AB/O with +/-.")
    v = F.upper(value("MEDICINE"))
    add("MEDICINE", ~v.isin(lex.MEDICINES), "Invalid medicine name '", v, "'.")
    for c in ("HEIGHT", "WEIGHT", "TABLETS"):
        v = value(c)
        add(c, ~v.rlike(r"^\d+$"), f"Invalid integer format for {c} '", v, "'.")
    for c in ("PILL RATE", "COST", "TOTAL AMT"):
        v = value(c)
        add(c, money_broken(v), f"Invalid currency format for {c} '", v, "'.")
    for c in ("CUSTOMER NAME", "BILLER NAME", "SHIPPER NAME", "NAME_P_HOLDER"):
        v = value(c)
        add(c, name_broken(v), f"Arbitrary value in {c} '", v, "'.")
    for c in ("RES_ADDRESS", "CITY_1", "CITY_2"):
        v = value(c)
        add(c, address_broken(v), f"Arbitrary value in {c} '", v, "'.")
    return out


def bits(flags: list[Column]) -> Column:
    """Flags as the bits of one long, the first one lowest; a flag that is null is not set."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, f in enumerate(flags)])


def bit(number: Column, k: int) -> Column:
    return number.bitwiseAND(F.lit(1 << k)) != 0


def named(number: Column, names: list[str]) -> Column:
    """The names whose bits are set, in order."""
    return F.array_compact(F.array(*[F.when(bit(number, k), F.lit(c)) for k, c in enumerate(names)]))


def validate(df: DataFrame) -> DataFrame:
    """df with status, valid, errors, missing_fields, format_errors and validity.

    validity has a bit for each mandatory field, in their order, that is set if the field is there and well formed: a snapshot of a
    record is one number, by which records are counted.
    """
    some = rules()
    # Empty fields and broken rules are noted as bits, so that each rule is evaluated once.
    df = df.select("*", bits([value(c) == "" for c in lex.MANDATORY]).alias("_empty"), bits([(value(r.column) != "") & r.broken for r in some]).alias("_broken"))
    of_column = {c: reduce(int.__or__, [1 << k for k, r in enumerate(some) if r.column == c], 0) for c in lex.MANDATORY}
    malformed = bits([F.col("_broken").bitwiseAND(F.lit(of_column[c])) != 0 if of_column[c] else F.lit(False) for c in lex.MANDATORY])
    marked = F.array_compact(F.array(*[F.when(F.col(f"{lex.field(c)}.source") == "fallback", F.lit(c)) for c in lex.COLUMNS]))
    says = F.array_compact(F.array(*[F.when(bit(F.col("_broken"), k), r.message) for k, r in enumerate(some)]))
    every = F.lit((1 << len(lex.MANDATORY)) - 1)
    df = df.withColumns({"missing_fields": named(F.col("_empty"), lex.MANDATORY), "format_errors": named(F.col("_broken"), [r.column for r in some]), "validity": F.bitwise_not(F.col("_empty").bitwiseOR(malformed)).bitwiseAND(every)})
    empty = F.transform("missing_fields", lambda c: F.concat(F.lit("Mandatory field '"), c, F.lit("' is missing or empty.")))
    filled = F.transform(marked, lambda c: F.concat(F.lit("Field '"), c, F.lit("' populated by raw OCR fallback for manual review.")))
    # Each bit and each mark is one message or more, so that the status needs no messages.
    some_error = reduce(lambda a, b: a | b, [F.col(f"{lex.field(c)}.source").eqNullSafe(F.lit("fallback")) for c in lex.COLUMNS], (F.col("_empty") != 0) | (F.col("_broken") != 0))
    status = status_of(value("RECORD NO"), value("CUSTOMER NAME"), F.when(some_error, 1).otherwise(0))
    out = df.withColumns({"errors": F.concat(empty, says, filled), "status": status}).drop("_empty", "_broken")
    return out.withColumn("valid", F.col("status") == "PASS")


def status_of(record_no: Column, name: Column, n_errors: Column) -> Column:
    return F.when((record_no == "") | (name == ""), "FAIL").when(n_errors > 0, "REVIEW").otherwise("PASS")
