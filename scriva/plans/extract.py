"""Record text -> 43 fields, each a struct of value, confidence and source.

One narrow projection a step: lines, normalisation, record number, sections, joined texts, places of ZIP, state and city, and
then all fields. Nothing is shuffled. Only lines and the bounds of sections are stored: what fields are read from is worked out
where a query asks for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import fields as x
from scriva.functions import lexicons as lex
from scriva.functions import normalize as norm
from scriva.plans.sections import assign, boundaries

TYPE = "struct<value:string,confidence:double,source:string>"
FLAGS = ["alcoholic", "smoker", "past_surg", "diabetic", "allergiesed"]


def empty_field() -> Column:
    return F.struct(F.lit(None).cast("string").alias("value"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("source"))


def confidence(factor: Column, ocr: Column, norm_factor: Column) -> Column:
    return x.round2(F.least(F.lit(1.0), factor * ocr * norm_factor))


def chosen(*tries: tuple[Column, float]) -> Column:
    """The first value that is neither null nor empty, with the confidence of its rule. Each value occurs once in the plan, and is
    worked out only if there is none before it."""

    def one(v: Column, f: float) -> Column:
        return F.get(F.filter(F.array(F.struct(F.trim(v).alias("value"), F.lit(float(f)).alias("factor"))), lambda t: t["value"] != ""), F.lit(0))

    return F.coalesce(*[one(v, f) for v, f in tries])


def finished(pick: Column) -> Column:
    found = F.struct(pick["value"].alias("value"), confidence(pick["factor"], F.col("confidence"), F.col("norm_factor")).alias("confidence"), F.lit("extracted").alias("source"))
    return F.when(pick.isNotNull(), found).otherwise(empty_field())


def prepare(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, image_name, confidence, lines, norm_factor, ...) from (record_id, image_name, text, confidence, ...)."""
    df = records.withColumn("lines", x.once(norm.clean_available(norm.split_lines(F.col("text")))))
    df = df.select("record_id", "image_name", "confidence", *keep, x.once(norm.join_split_email(F.col("lines"))).alias("lines"))
    return norm.normalize(df).drop("corrections")


def divide(df: DataFrame) -> DataFrame:
    """df with rec_no and the first lines of the later sections."""
    kept = df.columns
    df = df.withColumns({"joined": x.once(F.array_join("lines", " ")), "_numbered": x.once(F.filter("lines", lambda ln: ln.rlike(r"\d{5}")))})
    df = df.withColumn("rec_no", x.once(x.record_no(F.col("_numbered"), F.col("joined"))))
    holding = F.get(F.filter(F.slice("lines", 1, 3), lambda ln: F.contains(ln, F.col("rec_no"))), F.lit(0))
    name = F.btrim(F.replace(holding, F.col("rec_no"), F.lit("")), F.lit(" \t,-_"))
    df = df.withColumn("name", F.coalesce(x.nonempty(name), F.get("lines", F.lit(0)), F.lit("")))
    return boundaries(df).select(*kept, "rec_no", "i_ship", "i_pol", "i_med")


def texts(df: DataFrame) -> DataFrame:
    """df with its sections and the texts that fields are read from."""
    df = assign(df.withColumn("joined", x.once(F.array_join("lines", " "))))
    first_named = F.get(F.filter("customer", lambda ln: F.contains(ln, F.col("rec_no"))), F.lit(0))
    return df.withColumns({
        "cust8": x.once(F.array_join(F.slice("lines", 1, 8), " ")),
        "ship_text": x.once(F.array_join("shipper", " ")), "pol_text": x.once(F.array_join("policy", " ")), "med_text": x.once(x.unglue(F.array_join("medication", " "))),
        "p_name": x.once(chosen((F.btrim(F.replace(first_named, F.col("rec_no"), F.lit("")), F.lit(" \t,-_")), 1.0), (F.get("customer", F.lit(0)), 0.8), (F.get("lines", F.lit(0)), 0.6))),
    })


def locate(df: DataFrame, p: str, words: str, zip_col: str, cities: list[str]) -> DataFrame:
    """df with p_state and p_city, read backwards from the ZIP, and p_end: the number of words before the city (null without ZIP)."""
    at = F.array_position(F.col(words), F.col(zip_col))
    df = df.withColumn(f"{p}_at", F.when(at > 0, at - 1))  # words before the ZIP
    df = df.withColumn(f"{p}_state", x.fix_state(F.get(words, F.col(f"{p}_at") - 1)))
    df = df.withColumn(f"{p}_n", F.col(f"{p}_at") - F.when(F.col(f"{p}_state").isNotNull(), 1).otherwise(0))
    n = F.col(f"{p}_n")

    def last(k: int) -> Column:
        return F.array_join(F.slice(words, n - (k - 1), F.lit(k)), " ")

    known = [F.when((n >= k) & F.btrim(F.lower(F.when(n >= k, last(k))), F.lit(" ,.()")).isin(cities), k) for k in (3, 2)]
    df = df.withColumn(f"{p}_k", F.coalesce(*known, F.when(n >= 1, 1)))
    k = F.col(f"{p}_k")
    return df.withColumns({f"{p}_city": F.when(k.isNotNull(), x.strip(F.array_join(F.slice(words, n - k + 1, k), " "))), f"{p}_end": n - F.coalesce(k, F.lit(0))})


def places(df: DataFrame) -> DataFrame:
    """df with emails, ZIPs, and what lies before them in the customer and shipper sections."""
    df = df.withColumns({"cust_words": x.once(x.words_of(F.col("cust8"))), "ship_words": x.once(x.words_of(F.col("ship_text"))), "email": x.once(x.fix_email(x.first_match(F.col("cust8"), lex.EMAIL)))})
    no_mail = [F.regexp_replace(c, r"\S+@\S+", "") for c in ("cust8", "ship_text")]
    df = df.withColumn("zip1", x.once(F.get(F.filter(x.all_matches(no_mail[0], lex.ZIP, 1), lambda z: ~z.eqNullSafe(F.col("rec_no"))), F.lit(0))))
    df = df.withColumn("zip2", x.once(F.get(F.filter(x.all_matches(no_mail[1], lex.ZIP, 1), lambda z: ~z.eqNullSafe(F.col("rec_no")) & ~z.eqNullSafe(F.col("zip1"))), F.lit(0))))
    df = locate(df, "c", "cust_words", "zip1", lex.CITIES)
    df = locate(df, "s", "ship_words", "zip2", lex.CITIES)
    cust_name = F.coalesce(F.col("p_name.value"), F.lit(""))
    # Columns of their own, as they would be worked out again for each word that is compared with them.
    df = df.withColumns({
        "name_set": x.once(F.transform(x.words_of(cust_name), lambda w: F.btrim(F.lower(w), F.lit(".,()[]-")))), "known": x.once(x.name_words(cust_name)),
        "city_words": x.once(F.transform(F.split(F.coalesce("s_city", F.lit("")), r"[\s_.\-@]+"), lambda w: F.btrim(F.lower(w), F.lit(".,()[]-")))),
    })
    name_set, known, city_words = F.col("name_set"), F.col("known"), F.col("city_words")
    head = F.slice("cust_words", F.lit(1), F.greatest(F.col("c_end"), F.lit(0)))
    mail_at = F.array_min(F.transform(head, lambda w, i: F.when(F.contains(w, F.lit("@")), i + 1)))
    name_at = F.array_max(F.transform(head, lambda w, i: F.when(F.array_contains(name_set, F.btrim(F.lower(w), F.lit(".,()[]-"))), i + 1)))
    start = F.coalesce(F.when(F.col("email").isNotNull(), mail_at), name_at, F.lit(0))
    address = F.slice("cust_words", start + 1, F.greatest(F.col("c_end") - start, F.lit(0)))
    address = F.filter(address, lambda w, i: ~((i == 0) & w.eqNullSafe(F.col("rec_no"))))

    def is_shipper(w: Column) -> Column:
        clean = F.btrim(w, F.lit(".,()[]-"))
        low = F.lower(clean)
        of_customer = F.array_contains(known, low) | ((F.length(low) >= 4) & F.exists(known, lambda c: F.levenshtein(low, c, 1) >= 0))
        place = F.array_contains(city_words, low) | low.eqNullSafe(F.lower("s_state"))
        return ~(of_customer | place | clean.rlike(r"^\d{3}$") | clean.rlike(r"(?i)^(AB[+-]|[ABO0][+-])$") | clean.isin("+", "-"))

    ahead = F.slice("ship_words", F.lit(1), F.greatest(F.coalesce("s_end", F.lit(0)), F.lit(0)))
    return df.withColumns({"address": x.once(F.when(F.col("c_end").isNotNull(), x.strip(F.array_join(address, " ")))), "ship_name": x.once(F.when(F.col("zip2").isNotNull(), x.strip(F.array_join(F.filter(ahead, is_shipper), " "))))})


def body_parts(df: DataFrame) -> DataFrame:
    """df with what height, weight and blood group are read from."""
    lines8 = F.slice("lines", 1, 8)

    def lone(ln: Column) -> Column:
        words = x.words_of(ln)
        pairs = F.zip_with(words, F.slice(words, 2, 1 << 20), lambda a, b: F.when(a.rlike(r"^\d+$") & x.int_between(a, 100, 250).isNotNull(), F.when(b.isin("+", "-"), F.concat(F.lit("B"), b)).when(F.upper(b).isin("A", "B", "O", "AB"), F.concat(F.upper(b), F.lit("+")))))
        return F.get(F.array_compact(pairs), F.lit(0))

    # What stands in for something is worked out only where that is not there.
    df = df.withColumn("blood_line", x.once(F.get(F.filter(lines8, lambda ln: ln.rlike("(?i)" + lex.BLOOD)), F.lit(0))))
    df = df.withColumn("lones", x.once(F.when(F.col("blood_line").isNull(), F.transform(lines8, lone))))
    df = df.withColumn("lone_at", x.once(F.array_min(F.transform("lones", lambda v, i: F.when(v.isNotNull(), i)))))
    df = df.withColumns({"lone": F.get("lones", F.col("lone_at")), "shown": x.once(F.coalesce("blood_line", F.get("lines", F.col("lone_at"))))})
    street = r"(?i)@|lane|ln|drive|dr|street|st|road|rd|court|ct"
    loose = F.filter(F.flatten(F.transform(F.filter(lines8, lambda ln: ~ln.rlike(street)), x.body_numbers)), lambda v: ~v.eqNullSafe(F.col("zip1")))
    before = F.get("lines", F.array_position("lines", F.col("shown")).cast("int") - 2)
    df = df.withColumns({"on_line": x.once(x.body_numbers(F.col("shown"))), "on_previous": x.once(x.body_numbers(before))})
    two = F.coalesce(F.size("on_line") == 2, F.lit(False))
    return df.withColumn("loose", x.once(F.when(~two, loose)))


def customer_fields(df: DataFrame) -> dict[str, Column]:
    third = F.get("customer", F.lit(2))
    by_line = (F.size("customer") >= 3) & (F.coalesce("address", F.lit("")) == "")
    line_state = F.when(by_line, x.first_match(third, r"\b([A-Z]{2})\b", 1))
    state = F.coalesce("c_state", line_state)
    line_city = F.when(by_line & F.contains(third, state), x.strip(F.call_function("substring_index", third, state, F.lit(1))))
    two, one = F.size("on_line") == 2, F.size("on_line") == 1
    blood_line, on_line, loose = F.col("blood_line"), F.col("on_line"), F.col("loose")
    blood = F.regexp_replace(F.replace(F.upper(F.regexp_extract(blood_line, "(?i)" + lex.BLOOD, 1)), F.lit(" "), F.lit("")), r"^0([+-])$", "O$1")
    on_previous = F.when(one, F.get("on_previous", F.size("on_previous") - 1))
    country = F.upper(x.first_match(F.col("cust8"), r"(?i)(?:\b|[\d-])(US|USA)\b", 1))
    return {
        "record_no": chosen((F.col("rec_no"), 1.0)),
        "customer_name": F.col("p_name"),
        "biller_name": F.col("p_name"),
        "email_address": chosen((F.col("email"), 1.0)),
        "zip_1": chosen((F.col("zip1"), 1.0), (F.when(by_line, x.first_match(third, lex.ZIP, 1)), 0.8)),
        "state_1": chosen((F.col("c_state"), 0.9), (line_state, 0.8)),
        "city_1": chosen((F.when(~by_line | line_city.isNull(), F.col("c_city")), 0.85), (line_city, 0.8)),
        "res_address": chosen((F.col("address"), 0.85), (F.when(by_line, F.get("customer", F.lit(1))), 0.8)),
        "ph_no1": chosen((x.fix_phone(x.first_match(F.col("cust8"), lex.PHONE)), 1.0)),
        "country_1": chosen((country, 1.0), (F.when(F.col("zip1").isNotNull(), "US"), 0.6)),
        "sex_1": chosen((x.gender(F.col("cust8")), 1.0)),
        "d_birth": chosen((x.first_match(F.col("cust8"), lex.DATE, 1), 1.0)),
        "height": chosen((F.coalesce(F.when(two, F.get(on_line, F.lit(0))), on_previous, F.get(loose, F.lit(0))), 1.0)),
        "weight": chosen((F.coalesce(F.when(two, F.get(on_line, F.lit(1))), F.when(one, F.get(on_line, F.lit(0))), F.get(loose, F.lit(1))), 1.0)),
        "blood_gp": chosen((F.when(blood_line.isNotNull(), blood), 1.0), (F.when(blood_line.isNull(), F.col("lone")), 0.8)),
    }


def shipper_fields(df: DataFrame) -> dict[str, Column]:
    first, name = F.get("shipper", F.lit(0)), F.coalesce(F.col("p_name.value"), F.lit(""))
    same = (name != "") & (F.length(first) >= 3) & (F.contains(F.lower(name), F.lower(first)) | F.contains(F.lower(first), F.lower(name)))
    country = F.upper(x.first_match(F.col("ship_text"), r"(?i)(?:\b|[\d-])(US|USA)\b", 1))
    flags = F.col("flags")
    out = {
        "shipper_name": chosen((F.col("ship_name"), 0.9), (F.when(same, F.get("shipper", F.lit(1))), 0.8), (F.when(~same, first), 0.9)),
        "city_2": chosen((F.col("s_city"), 0.85)),
        "state_2": chosen((F.col("s_state"), 0.9)),
        "zip_2": chosen((F.col("zip2"), 1.0)),
        "country_2": chosen((country, 1.0), (F.when(F.col("zip2").isNotNull(), "US"), 0.6)),
        "ph_no2": chosen((x.fix_phone(x.first_match(F.col("ship_text"), lex.PHONE)), 1.0)),
    }
    return out | {f: chosen((F.get(flags, F.lit(k)), 1.0)) for k, f in enumerate(FLAGS)}


def policy_parts(df: DataFrame) -> DataFrame:
    """df with what other policy fields are cut by: dates, premium, stamp."""
    stamp = "(?i)" + lex.STAMP
    source = F.when(F.col("pol_text").rlike(stamp), F.col("pol_text")).when(F.col("joined").rlike(stamp), F.col("joined"))
    df = df.withColumns({
        "pol_dates": x.once(x.all_matches(F.col("pol_text"), lex.DATE, 1)), "premium": x.once(F.get(x.all_matches(F.col("pol_text"), lex.MONEY, 1), F.lit(0)).cast("decimal(12,2)")),
        "stamp": x.once(x.first_match(source, stamp)), "stamp_code": x.once(x.first_match(source, stamp, 3)),
    })

    def between(text: Column, mark: Column) -> Column:
        """What lies between a mark and the stamp behind it."""
        at = F.instr(text, mark)
        rest = F.substring(text, at + F.length(mark), F.length(text))
        return F.when((at > 0) & F.contains(rest, F.col("stamp")) & rest.rlike(r"^\s"), F.trim(F.call_function("substring_index", rest, F.col("stamp"), F.lit(1))))

    amount, day = F.col("premium").cast("string"), F.get("pol_dates", F.lit(0))
    raw = [F.coalesce(between(F.col(t), amount), between(F.col(t), day)) for t in ("pol_text", "joined")]

    def holder(text: Column) -> Column:
        clean = F.regexp_replace(x.clean_holder(text), r"\s+[A-Z]{2,3}$", "")
        clean = F.btrim(F.array_join(F.slice(x.words_of(clean), 1, 4), " "), F.lit(" ,.-_$"))
        return F.when((F.length(F.regexp_replace(clean, r"\P{L}", "")) >= 3) & ~clean.rlike(r"^\d"), clean)

    df = df.withColumn("_held", x.once(raw[0]))
    return df.withColumns({"holder_1": x.once(holder(F.col("_held"))), "holder_2": x.once(F.when(F.col("_held").isNull(), holder(raw[1])))})


def policy_fields(df: DataFrame) -> dict[str, Column]:
    def policy_no(text: Column) -> Column:
        return F.btrim(x.first_match(text, lex.POLICY), F.lit("(),.-_"))

    dob = F.coalesce(F.get("pol_dates", F.lit(1)), F.get("pol_dates", F.lit(0)))
    after_stamp = F.when(F.contains(F.col("pol_text"), F.col("stamp")), F.substring(F.col("pol_text"), F.instr("pol_text", F.col("stamp")) + F.length("stamp"), F.length("pol_text")))
    after_dob = F.substring(F.col("pol_text"), F.instr("pol_text", dob) + F.length(dob), F.length("pol_text"))
    up = F.upper("pol_text")
    return {
        "policy_no": chosen((policy_no(F.col("pol_text")), 1.0), (policy_no(F.col("joined")), 0.7)),
        "d_b_life_assure": chosen((F.get("pol_dates", F.lit(0)), 1.0)),
        "p_inst": chosen((x.dollars(F.col("premium")), 1.0)),
        "name_p_holder": chosen((F.col("holder_1"), 1.0), (F.col("holder_2"), 0.7)),
        "stm_name": chosen((F.col("stamp"), 1.0)),
        "stm_code": chosen((x.fix_stamp_code(F.col("stamp_code")), 1.0)),
        "dob": chosen((dob, 1.0)),
        "sex_2": chosen(
            (F.upper(x.first_match(after_stamp, r"(?i)\d{2}/\d{2}/\d{2,4}\s+(FEMALE|MALE)\b", 1)), 1.0), (F.upper(x.first_match(after_dob, r"(?i)^\s+(FEMALE|MALE)\b", 1)), 1.0),
            (F.when(F.contains(up, F.lit("FEMALE")), "FEMALE").when(F.contains(up, F.lit("MALE")), "MALE"), 0.8),
        ),
    }


def medication_fields(df: DataFrame) -> dict[str, Column]:
    med, every = F.col("med_text"), F.col("joined")
    card, amounts = F.col("card"), F.col("amounts")
    at = F.instr(F.lower(med), F.lower(card["value"]))
    behind = F.when(at > 0, F.substring(med, at + F.length(card["value"]), F.length(med)))
    after_card = F.upper(x.first_match(behind, r"^\s+(?:[A-Za-z]{1,15}\s+){0,2}([A-Za-z]{4,20})\b", 1))
    n = F.size(amounts)

    def price(k: int) -> Column:
        return x.dollars(F.get(amounts, F.lit(k)))

    def by_count(four: int | None, three: int | str | None, two: int | str | None, one: int | None) -> Column:
        tries = []
        for holds, k, f in ((n >= 4, four, 1.0), (n == 3, three, 0.8), (n == 2, two, 0.8), (n == 1, one, 0.7)):
            if k is not None:
                tries.append((F.when(holds, F.lit(k) if isinstance(k, str) else price(k)), f))
        return chosen(*tries)

    return {
        "card_name": card,
        "medicine": chosen((after_card, 1.0), (x.medicine_in(med), 1.0), (x.medicine_in(every), 0.7)),
        "dosage": chosen((x.dosage(med), 1.0), (x.partial_dosage(med), 0.9), (x.dosage(every), 0.7)),
        "tablets": chosen((x.tablets(med), 1.0), (x.tablets(every), 0.7)),
        "pill_rate": by_count(0, 0, None, None),
        "cost": by_count(1, 1, 0, None),
        "shipping_co": by_count(2, "$20.00", "$20.00", None),
        "total_amt": by_count(3, 2, 1, 0),
    }


def extract(records: DataFrame, store: Callable[[DataFrame, str], DataFrame] | None = None, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, the texts and sections that later steps read, and the 43 fields).

    store writes an intermediate table and reads it back: the lines, and then with them the bounds of sections.
    """
    df = prepare(records, keep)
    df = divide(store(df, "bills-prepared") if store else df)
    df = texts(store(df, "bills-placed") if store else df)
    df = body_parts(policy_parts(places(df))).withColumns({
        "card": x.once(chosen((x.card_name(F.col("med_text")), 1.0), (x.card_name(F.col("joined")), 0.7))), "amounts": x.once(x.amounts(F.col("med_text"))),
        "flags": x.once(x.yes_no(x.words_of(F.concat_ws(" ", F.col("ship_text"), F.get("policy", F.lit(0)))))),
    })
    picks = customer_fields(df) | shipper_fields(df) | policy_fields(df) | medication_fields(df)
    base = ["record_id", "lines", "joined", "customer", "shipper", "policy", "medication", "norm_factor", "confidence", *keep]
    df = df.select(*base, F.col("image_name").alias("_image"), *[v.alias(f"_{f}") for f, v in picks.items()])
    some = F.size("lines") > 0
    image = F.struct(F.col("_image").alias("value"), F.lit(1.0).alias("confidence"), F.lit("file").alias("source")).alias("image_name")
    rows = [image if f == "image_name" else F.when(some, finished(F.col(f"_{f}"))).otherwise(empty_field()).alias(f) for f in lex.FIELDS]
    return df.select(*[F.col(c).alias("ocr_confidence") if c == "confidence" else c for c in base], *rows)
