"""Recovery: ordered repairs of missing and malformed fields from the rest of the record.

A repair writes base * factor, where base is the record's best confidence, and takes the field off the repair list, so later
stages see it as good. Each stage is one projection over the row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriva.functions import fields as x
from scriva.functions import lexicons as lex
from scriva.operators.nearest import with_nearest
from scriva.plans.extract import FLAGS, locate
from scriva.plans.validate import value

#: The state that each side's ZIPs are taken to be in, first digits for which that is likely, and the factors.
ZIP_STATES = {"1": ("TN", "3", 0.95, 0.8), "2": ("CA", "26789", 0.95, 0.8)}
#: Tokens of a policy number glued to a date.
GLUED = r"\b([S5s][Rr8][\w-]*?)(\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4})\b"


def base_confidence() -> Column:
    """The greatest confidence of any field but the image name; 0.9 if none is above 0."""
    best = F.greatest(*[F.coalesce(F.col(f"{f}.confidence"), F.lit(0.0)) for f in lex.FIELDS if f != "image_name"])
    return F.when(best > 0, best).otherwise(0.9)


def is_bad(column: str) -> Column:
    return (value(column) == "") | F.array_contains("to_repair", column) | (F.coalesce(F.col(f"{lex.field(column)}.confidence"), F.lit(0.0)) < 0.2)


def repair(df: DataFrame, repairs: dict[str, list[tuple[Column, float | Column]]]) -> DataFrame:
    """Writes to each bad field the first of its values that is neither null nor empty."""
    new, done = {}, []
    for column, tries in repairs.items():
        every = F.array(*[F.struct(F.trim(v).alias("value"), x.round2(F.col("base") * f).alias("confidence"), F.lit("recovered").alias("source")) for v, f in tries])
        pick = F.get(F.filter(every, lambda t: t["value"] != ""), F.lit(0))
        new[lex.field(column)] = F.when(is_bad(column), F.coalesce(pick, F.col(lex.field(column)))).otherwise(F.col(lex.field(column)))
        done.append(F.when(is_bad(column) & pick.isNotNull(), F.lit(column)))
    new["to_repair"] = F.array_except("to_repair", F.array_compact(F.array(*done)))
    return df.withColumns(new)


def good_dates(text: Column) -> Column:
    """All m/d/y with a possible month and day, padded."""
    parts = [x.all_matches(text, r"(\d{1,2})[/\.-](\d{1,2})[/\.-](\d{2,4})", k) for k in (1, 2, 3)]
    every = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, "mdy", strict=True)])
    real = F.filter(every, lambda t: t["m"].cast("int").between(1, 12) & t["d"].cast("int").between(1, 31))
    return F.transform(real, lambda t: F.concat_ws("/", F.lpad(t["m"], 2, "0"), F.lpad(t["d"], 2, "0"), t["y"]))


def partial_dates(text: Column) -> Column:
    m, d = (x.all_matches(text, r"\b(\d{1,2})/(\d{1,2})\b", k) for k in (1, 2))
    real = F.filter(F.arrays_zip(m.alias("m"), d.alias("d")), lambda t: t["m"].cast("int").between(1, 12) & t["d"].cast("int").between(1, 31))
    return F.transform(real, lambda t: F.concat_ws("/", F.lpad(t["m"], 2, "0"), F.lpad(t["d"], 2, "0")))


def glued_date(text: Column) -> Column:
    return F.get(good_dates(x.first_match(text, GLUED, 2)), F.lit(0))


def glued_policy(text: Column) -> Column:
    return F.btrim(x.first_match(text, GLUED, 1), F.lit("(),.-_"))


def state_from_zip(side: str, zip_value: Column) -> tuple[Column, Column]:
    state, likely, high, low = ZIP_STATES[side]
    return F.when(F.length(zip_value) == 5, state), F.when(zip_value.rlike(f"^[{likely}]"), high).otherwise(low)


def repaired_email(text: Column) -> Column:
    mail = x.first_match(text, r"\b\S+@\S+\b")
    for pattern, new in lex.MAIL_REPAIRS:
        mail = F.regexp_replace(mail, pattern, new)
    return mail


def default_dose(medicine: Column) -> Column:
    return F.coalesce(*[F.when(F.upper(medicine) == m, d) for m, d in lex.DOSES.items()])


def glued_medicine(words: Column) -> tuple[Column, Column]:
    """Medicine and dose of the first token such as MED10MG."""
    token = F.get(F.filter(words, lambda w: w.rlike(r"^[A-Za-z]{3,}\d+(?:\.\d+)?[Mm][Gg]$")), F.lit(0))
    return F.upper(F.regexp_extract(token, "^([A-Za-z]{3,})", 1)), F.upper(F.regexp_extract(token, r"(\d+(?:\.\d+)?[Mm][Gg])$", 1))


def medicine_names(spark: SparkSession) -> DataFrame:
    """(name, place) of the listed medicines."""
    return spark.createDataFrame([(m, k) for k, m in enumerate(lex.MEDICINES)], "name string, place int")


def bare_words(text: Column) -> Column:
    """The words of a text in capitals, letters only."""
    return F.transform(x.words_of(text), lambda w: F.regexp_replace(F.upper(w), "[^A-Z]", ""))


def with_fuzzy_medicine(rows: DataFrame, text: str, wanted: Column, out: str = "fuzzy", names: DataFrame | None = None, store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """rows with the listed medicine within distance 1 of a word of four letters or more: least distance, then first word, then list order."""
    names = medicine_names(rows.sparkSession) if names is None else names
    return with_nearest(rows, text, wanted, bare_words(F.col(text)), names, out, store=store)


def medicine_before_dose(words: Column) -> Column:
    def one(w: Column, i: Column) -> Column:
        before = F.btrim(F.get(words, i - 1), F.lit(".,;()[]-"))
        return F.when((i > 0) & w.rlike(r"^\d+(?:\.\d+)?[Mm][Gg]$") & before.rlike(r"^\p{L}{4,}$"), F.upper(before))

    return F.get(F.array_compact(F.transform(words, one)), F.lit(0))


def repaired_phone(text: Column) -> Column:
    """The digits of the first ten-digit phone, a leading S read as 8; null if there is none."""
    raw = F.regexp_replace(x.first_match(text, lex.TEN_DIGITS), "^[Ss]", "8")
    digits = F.regexp_replace(raw, r"\D", "")
    return F.when(F.length(digits) == 10, digits)


def card_trace(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(*[F.when(low.rlike("|".join(traces)), name) for name, traces in lex.CARD_TRACES])


def repaired_blood(v: Column) -> Column:
    up = F.upper(v)
    letters, sign = F.substring(up, F.lit(1), F.length(up) - 1), F.right(up, F.lit(1))
    letters = F.when(letters.isin(lex.BLOOD_LETTERS["O"]), "O").when(letters.isin(lex.BLOOD_LETTERS["B"]), "B").otherwise(letters)
    new = F.concat(letters, sign)
    return F.when(new.isin(lex.BLOOD_GROUPS), new)


def sex_of_name(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.rlike("|".join(lex.FEMALE)), "FEMALE").when(low.rlike("|".join(lex.MALE)), "MALE")


def plain_number(v: Column) -> Column:
    bare = F.trim(F.regexp_replace(v, r"[$,]", ""))
    return F.when(bare.rlike(r"^\d+(\.\d+)?$"), bare.try_cast("decimal(14,4)"))


def recover(df: DataFrame, store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """df (with missing_fields and format_errors of a validation) with its bad fields repaired. store cuts the plan half way."""
    kept = df.columns
    df = df.withColumns({"base": base_confidence(), "to_repair": F.array_union("missing_fields", "format_errors")})
    df = with_fuzzy_medicine(df, "joined", is_bad("MEDICINE"), store=store).withColumn("words", x.words_of(F.col("joined")))
    text = F.array_join("lines", "\n")
    df = df.withColumns({"dates": good_dates(text), "parts": partial_dates(text), "policy_date": glued_date(text), "policy_part": glued_policy(text)})

    df = repair(df, {f"STATE_{k}": [state_from_zip(k, value(f"ZIP_{k}"))] for k in "12"})
    df = repair(df, {c: [(F.col("policy_date"), 0.95), (F.get("dates", F.lit(k)), 0.9), (F.get("dates", F.lit(0)), 0.8), (F.get("parts", F.lit(0)), 0.4)] for k, c in enumerate(["D BIRTH", "D_B_LIFE_ASSURE", "DOB"])})
    df = repair(df, {"EMAIL ADDRESS": [(repaired_email(F.col("joined")), 0.9)]})

    df = repair(df, {"DOSAGE": [(default_dose(value("MEDICINE")), 0.9)]})
    medicine, dose = glued_medicine(F.col("words"))
    df = repair(df, {"MEDICINE": [(medicine, 0.95)], "DOSAGE": [(dose, 0.95)]})
    # The list comes before the word in front of a dose, which would take a misspelt medicine as it is.
    df = repair(df, {"MEDICINE": [(F.col("fuzzy"), 0.85), (medicine_before_dose(F.col("words")), 0.8)]})

    df = locate(df.withColumn("_zip", value("ZIP_1")), "r", "words", "_zip", lex.CITIES_RECOVERY)
    head = F.slice("words", F.lit(1), F.greatest(F.col("r_end"), F.lit(0)))
    mail_at = F.array_min(F.transform(head, lambda w, i: F.when(F.contains(w, F.lit("@")), i + 1)))
    start = F.coalesce(F.when(value("EMAIL ADDRESS") != "", mail_at), F.lit(0))
    address = x.strip(F.array_join(F.slice("words", start + 1, F.greatest(F.col("r_end") - start, F.lit(0))), " "))
    df = df.withColumn("_address", F.when(F.col("r_end").isNotNull(), address))
    df = repair(df, {"STATE_1": [(F.col("r_state"), 0.9)], "CITY_1": [(F.col("r_city"), 0.85)], "RES_ADDRESS": [(F.col("_address"), 0.85)], "POLICY NO": [(F.col("policy_part"), 0.95)]})

    df = store(df, "bills-half") if store else df
    phone = repaired_phone(text)
    shown = F.concat(F.lit("("), F.substring(phone, 1, 3), F.lit(") "), F.substring(phone, 4, 3), F.lit("-"), F.substring(phone, 7, 4))
    df = repair(df, {"PH_NO1": [(shown, 0.9)], "PH_NO2": [(phone, 0.9)], "CARD NAME": [(card_trace(text), 0.9)], "BLOOD GP": [(repaired_blood(value("BLOOD GP")), 0.9)]})

    customer, holder = F.lower(value("CUSTOMER NAME")), F.lower(value("NAME_P_HOLDER"))
    same = (customer != "") & (holder != "") & (F.contains(holder, customer) | F.contains(customer, holder))
    for mine, other, name in (("SEX_1", "SEX_2", customer), ("SEX_2", "SEX_1", holder)):
        copied = F.when(~is_bad(other) & same & F.upper(value(other)).isin("MALE", "FEMALE"), F.upper(value(other)))
        df = repair(df, {mine: [(sex_of_name(name), 0.9), (copied, 0.75)]})

    df = price_algebra(df)
    ship = F.filter(F.flatten(F.transform("shipper", x.words_of)), lambda w: w != "")
    df = locate(df.withColumns({"_ship": ship, "_zip": value("ZIP_2")}), "t", "_ship", "_zip", lex.CITIES_RECOVERY)
    flags = x.yes_no(x.words_of(F.concat_ws(" ", F.array_join("shipper", " "), F.get("policy", F.lit(0)))))
    columns = [c for c in lex.COLUMNS if lex.field(c) in FLAGS]
    df = repair(df, {"STATE_2": [(F.col("t_state"), 0.9)], "CITY_2": [(F.col("t_city"), 0.85)]} | {c: [(F.get(flags, F.lit(k)), 0.9)] for k, c in enumerate(columns)})
    return df.select(*kept)


def solve_prices(rate: Column, cost: Column, ship: Column, total: Column, tabs: Column) -> dict[str, Column]:
    """What the equations cost = rate * tablets and total = cost + shipping give for the values that are null, in fixed order."""
    out = {"COST": F.when(cost.isNull(), rate * tabs)}
    cost = F.coalesce(cost, out["COST"])
    count = F.when(rate > 0, F.bround(cost / rate, 0).cast("int"))
    out["TABLETS"] = F.when(tabs.isNull() & count.isin(lex.TABLET_COUNTS), count)
    tabs = F.coalesce(tabs, count)
    out["PILL RATE"] = F.when(rate.isNull() & (tabs > 0), cost / tabs)
    out["TOTAL AMT"] = F.when(total.isNull(), cost + ship)
    total = F.coalesce(total, out["TOTAL AMT"])
    rest = total - cost
    out["SHIPPING CO"] = F.when(ship.isNull() & (rest >= 0), rest)
    late = total - ship
    out["COST"] = F.coalesce(out["COST"], F.when(cost.isNull() & (late >= 0), late))
    return out


def price_algebra(df: DataFrame) -> DataFrame:
    names = ["PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT"]
    df = df.withColumns({f"_{k}": plain_number(value(c)) for k, c in enumerate(names)} | {"_t": F.when(value("TABLETS").rlike(r"^\d+$"), value("TABLETS").try_cast("int"))})
    solved = solve_prices(*[F.col(f"_{k}") for k in range(4)], F.col("_t"))
    return repair(df, {c: [(v.cast("string") if c == "TABLETS" else x.dollars(F.bround(v.cast("decimal(16,6)"), 2)), 0.98)] for c, v in solved.items()})


def prices_agree() -> Column:
    """Whether the four prices and the tablets satisfy both equations (null if one is missing)."""
    rate, cost, ship, total = (plain_number(value(c)) for c in ("PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT"))
    return (F.abs(rate * value("TABLETS").try_cast("int") - cost) < 0.01) & (F.abs(cost + ship - total) < 0.01)
