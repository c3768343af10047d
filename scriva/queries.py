"""The registered queries of the record engine, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriva import sinks
from scriva.functions import fields as x
from scriva.functions import lexicons as lex
from scriva.functions import normalize as norm
from scriva.operators import boxes, layout
from scriva.plans import extract, fallback, fixtures, metrics, pipeline, quarantine, recover, sections, validate
from scriva.plans.fixtures import cents, num, pick, table
from scriva.shared import shared_dir, store
from scriva.sources import pages as src
from scriva.streaming import route

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str) -> None:
    QUERIES[name], SQL[name] = query, sql


# ---- scalar rules over strings composed from order keys

KEYS = "SELECT o_orderkey AS k, o_custkey AS c FROM {orders}"


def scalar(name: str, made: str, rule: Callable[[Column], Column], expected: str) -> None:
    """made: SQL for the input x from k and c, valid in Spark and DuckDB; expected: DuckDB SQL over x, k and c."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.sql(f"SELECT k, {made} AS x FROM ({KEYS}) o", orders=table(spark, sf_dir, "orders"))
        return rows.select(F.col("k").alias("record_id"), rule(F.col("x")).alias("y"))

    register(name, query, f"SELECT k AS record_id, {expected} AS y FROM (SELECT k, c, {made} AS x FROM ({KEYS.format(orders='orders')}) o) t")


def replaced(*pairs: tuple[str, str], over: str = "x") -> str:
    for pattern, new in pairs:
        over = f"regexp_replace({over}, '{pattern}', '{new}', 'g')"
    return over


Z5, D2, STATE_LIST = num("k % 100000", 5), num("k % 90 + 10"), ", ".join(f"'{s}'" for s in lex.STATES)
DAY = f"{num('1 + k % 12', 2)} || '/' || {num('1 + k % 28', 2)} || '/' || {num('1940 + k % 60')}"

scalar("norm_div0", f"'#DIV/0$' || {D2} || '.00 #div 0 ! end'", norm.drop_div0, replaced((r"(?i)#\s*DIV\s*/?\s*0\s*!?\s*", "")))
scalar("norm_zip_country", f"{Z5} || 'US ' || {Z5} || 'x ' || {Z5}", norm.split_zip_country, replaced((r"\b(\d{5})([A-Za-z]{2,})\b", r"\1 \2")))
scalar("norm_zip_phone", f"{Z5} || '423351-' || {num('k % 10000', 4)} || ' x'", norm.split_zip_phone, replaced((r"\b(\d{5})(\d{3}\s*-?\s*\d{3}-?\d{4})\b", r"\1 \2")))
scalar("norm_slashes", f"{D2} || '//07/' || CASE WHEN k % 2 = 0 THEN '/1955' ELSE concat(chr(92), chr(92), '1955') END", norm.fix_slashes, replaced(("/+", "/"), (r"\\+", "/")))
scalar("norm_stamp", f"'Mary baX' || {pick(' _ ,-, ,_', 'k')} || {pick('Ruth,Carol,Al', 'k')} || {pick(' ,_,-', 'c')} || {num('70000 + k % 20000')} || ' end'", norm.rewrite_stamp, f"'Mary baX_' || {pick('Ruth,Carol,Al', 'k')} || '_' || {num('70000 + k % 20000')} || ' end'")
scalar("norm_state_zip", f"'in ' || {pick('CA,TN,QQ,tx,Nv', 'k')} || {Z5} || ' x'", norm.split_state_zip, f"CASE WHEN {pick('CA,TN,QQ,tx,Nv', 'k')} = 'QQ' THEN x ELSE 'in ' || {pick('CA,TN,QQ,tx,Nv', 'k')} || ' ' || {Z5} || ' x' END")
scalar("norm_city_state_zip", f"'at ' || {pick('AnaheimcA,DallastX,Miami,LANE,RenoNv', 'k')} || ' ' || {Z5}", norm.split_city_state, f"'at ' || {pick('Anaheim CA,Dallas TX,Miami,LANE,Reno NV', 'k')} || ' ' || {Z5}")
scalar("norm_camel", f"{pick('George,Ann,jo', 'k')} || 'UGriffin' || {pick('Lee,lee', 'c')}", norm.split_camel, replaced(("([a-z])([A-Z])", r"\1 \2")))
scalar("norm_date_spaces", f"'0 7/' || {num('1 + k % 28')} || '/49 and 1' || '0/1 2/' || {num('50 + k % 49')} || ' or 3 / ' || {D2}", norm.close_dates, replaced((r"\b(\d)\s+(\d/\d{1,2}/\d{2,4})\b", r"\1\2"), (r"\b(\d{1,2}/\d)\s+(\d/\d{2,4})\b", r"\1\2"), (r"(\d)\s*/\s*(\d)", r"\1/\2")))
scalar("norm_dosage_split", f"{pick('DIDREX,Valium', 'k')} || {pick('2.5,10,0.25', 'c')} || 'MG x' || {D2}", norm.split_dosage, f"{pick('DIDREX,Valium', 'k')} || ' ' || {pick('2.5,10,0.25', 'c')} || 'MG x' || {D2}")
scalar("norm_date_isolate", f"'born' || {DAY} || 'MALE ' || {DAY}", norm.isolate_dates, f"'born ' || {DAY} || ' MALE ' || {DAY}")
scalar("norm_alpha_digit", f"'POLICY' || {num('k')} || ' a' || {D2}", norm.split_alpha_digit, f"'POLICY ' || {num('k')} || ' a' || {D2}")
PHONE_IN = f"CASE WHEN k % 3 = 0 THEN {num('2000000000 + k')} ELSE '200-' || {num('200 + k % 700')} || '-' || {num('k % 10000', 4)} END"
scalar("norm_phone_token", PHONE_IN, norm.phone_token, "'(' || substr(replace(x, '-', ''), 1, 3) || ') ' || substr(replace(x, '-', ''), 4, 3) || '-' || substr(replace(x, '-', ''), 7, 4)")
scalar("norm_zip_token", f"CASE WHEN k % 2 = 0 THEN {num('200000000 + k')} ELSE 'A' || {num('200000000 + k')} END", norm.zip_token, "CASE WHEN k % 2 = 0 THEN substr(x, 1, 5) || '-' || substr(x, 6, 4) ELSE x END")
scalar("norm_token_subst", f"CASE k % 4 WHEN 0 THEN 'A' || {num('k % 1000', 3)} WHEN 1 THEN 'A' || {Z5} WHEN 2 THEN {D2} || 'MG' ELSE {num('k')} END", norm.mixed_token, "CASE WHEN k % 4 = 0 THEN translate(x, '40152867', 'AOISZBGT') ELSE x END")
scalar("norm_state_token", pick("ca,T4,30,0k,tn1,90,Ab", "k"), norm.state_token, pick("CA,TA,30,OK,tn1,90,AB", "k"))
scalar("norm_punct", f"'cost $ ' || {D2} || ' , then . ' || {D2} || ' - end'", norm.tidy_punctuation, replaced((r"\s+([,.:;\-])", r"\1"), (r"(\$)\s+", r"\1")))
scalar("norm_factor", "k % 9", norm.factor, "greatest(0.75::DOUBLE, 1.0::DOUBLE - least(5, x)::DOUBLE * 0.05::DOUBLE)")
scalar("clean_available", f"'John' || chr(10) || {pick('Available,not available,AVALABE,Availability', 'k')} || chr(10) || {D2}", lambda t: F.array_join(norm.clean_available(norm.split_lines(t)), "|"), f"CASE WHEN k % 4 = 3 THEN 'John|Availability|' ELSE 'John|' END || {D2}")
scalar("clean_split_email", f"'John' || chr(10) || 'john.b' || {num('k')} || '@' || chr(10) || 'aol.com 12 Elm' || chr(10) || 'x@' || chr(10) || 'y@' || chr(10) || {D2}", lambda t: F.array_join(norm.join_split_email(norm.split_lines(t)), "|"), f"'John|john.b' || {num('k')} || '@aol.com|12 Elm|x@|y@|' || {D2}")
scalar("fix_email_domain", f"'jo' || {num('k')} || '@' || {pick('aol,ac1.com,A0L.COM,hotmail,gmail.com,usa,other.org,comcast.netx', 'k')}", x.fix_email, f"'jo' || {num('k')} || '@' || {pick('aol.com,aol.com,aol.com,hotmail.com,gmail.com,usa.net,other.org,comcast.net', 'k')}")
scalar("fix_phone_area", f"{pick('(S,(8,S', 'k')} || {D2} || ') 1'", x.fix_phone, "CASE WHEN k % 3 = 0 THEN '(8' || substr(x, 3) ELSE x END")
scalar("fix_stamp_code", f"{pick('IlO,oSs,ZzB', 'k')} || {pick('gT,A4,b7', 'c')}", x.fix_stamp_code, "translate(x, 'IliOoSsZzBbGgTtAa', '11100552288667744')")
scalar("fix_state_word", pick("CA,(tn),0K,ON,XX,5C,C4.", "k"), x.fix_state, f"nullif({pick('CA,TN,OK,OH,,SC,CA', 'k')}, '')")
scalar("words_name_set", f"{pick('GeorgeUGriffin,Mary Ann,J. P. Lee', 'k')} || ' ' || {num('k')}", lambda n: F.array_join(F.array_sort(x.name_words(n)), "|"), f"array_to_string(list_sort(string_split({pick('george|georgeugriffin|griffin|u,ann|mary,j|lee|p', 'k')} || '|' || {num('k')}, '|')), '|')")
scalar("edit_distance", f"{pick('VALIUM,XANAX,AMBIEN', 'k')} || {num('k % 7')}", lambda w: F.levenshtein(w, F.lit("ALIUM1")), "CAST(levenshtein(x, 'ALIUM1') AS INT)")
scalar("word_count", f"'a  b ' || {pick('c,c d, ', 'k')}", x.word_count, f"CAST({pick('3,4,2', 'k')} AS INT)")
scalar("pred_gender", pick("is FEMAL x,a Male,MAL,none,a FEMALE and MALE,Malta", "k"), x.gender, f"nullif({pick('FEMALE,MALE,MALE,,FEMALE,', 'k')}, '')")
scalar("pred_available", pick("Available,not avaiable,valable,LABLE x,absent", "k"), boxes.is_available, f"{pick('1,1,1,1,0', 'k')} = '1'")
scalar("pred_record_anchor", f"{pick('| ,,x ', 'k')} || {Z5} || ' John'", lambda t: boxes.is_record_anchor(t, F.length(t), F.lit(0), F.lit(40)), "k % 3 <> 2")
scalar("pred_name_repeat", pick("John Baker,Mr John Bakr,JohnBakerX,Elm Lane,Bakes shop,jo", "k"), lambda t: x.repeats_name(t, F.lit("John Baker")), f"{pick('1,1,1,0,1,0', 'k')} = '1'")
scalar("setop_zip_exclude", f"{Z5} || ' 37201 x ' || {Z5} || ' 12345'", lambda t: F.array_join(F.filter(x.all_matches(t, lex.ZIP, 1), lambda z: ~z.isin("37201", "10001")), ","), f"CASE WHEN {Z5} IN ('37201', '10001') THEN '12345' ELSE {Z5} || ',' || {Z5} || ',12345' END")
scalar("snk_artifact_name", f"'a/b:' || {num('k')} || '?'", lambda t: sinks.artefact_name(t, F.when(F.length(t) % 2 == 0, "none").otherwise("vertical"), F.endswith(t, F.lit("0?"))), "'a_b_' || k || '_' || CASE WHEN length(x) % 2 = 0 THEN '' ELSE 'Merged' END || CASE WHEN k % 10 = 0 THEN '' ELSE '-review' END || '.png'")
scalar("ext_unglue", f"'Visa VALIUM' || {D2} || 'MG $2.87$' || {D2} || '.00'", x.unglue, f"'Visa VALIUM ' || {D2} || 'MG $2.87 $' || {D2} || '.00'")
scalar("val_email", f"'a' || {num('k')} || {pick('@b.co,@b,@b.co x,b.co', 'k')}", lambda v: ~v.rlike("^" + lex.EMAIL) | F.contains(v, F.lit(" ")), f"{pick('0,1,1,1', 'k')} = '1'")
scalar("val_phone", pick("(615) 423-1077,555-12,61S-423-1077", "k"), validate.phone_broken, f"{pick('0,1,1', 'k')} = '1'")
scalar("val_currency", pick("$12.50,1234.5,$1.234,x,$7", "k"), validate.money_broken, f"{pick('0,0,1,1,0', 'k')} = '1'")
scalar("val_name_noise", pick("John Baker,J0hn Baker,J0hn,Not Me,A$ B,J0hn 12 Baker", "k"), validate.name_broken, f"{pick('0,0,1,1,1,1', 'k')} = '1'")
scalar("val_address_noise", pick("12 Elm Lane,12/Elm,Nottingham,x.png", "k"), validate.address_broken, f"{pick('0,1,1,1', 'k')} = '1'")
scalar("val_status", "k % 4", lambda n: validate.status_of(F.when(n == 0, "").otherwise("10001"), F.when(n == 1, "").otherwise("John"), F.when(n == 2, 1).otherwise(0)), "CASE x WHEN 0 THEN 'FAIL' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'REVIEW' ELSE 'PASS' END")
scalar("rec_parse_dates", f"'x ' || {num('1 + k % 20')} || '-' || {num('1 + k % 40')} || '-55 and 3/4/1960'", lambda t: F.array_join(recover.good_dates(t), ","), f"CASE WHEN 1 + k % 20 <= 12 AND 1 + k % 40 <= 31 THEN {num('1 + k % 20', 2)} || '/' || {num('1 + k % 40', 2)} || '/55,' ELSE '' END || '03/04/1960'")
scalar("rec_state_from_zip", Z5, lambda z: F.concat_ws(" ", recover.state_from_zip("1", z)[0], recover.state_from_zip("2", z)[0], F.format_string("%.2f", recover.state_from_zip("1", z)[1]), F.format_string("%.2f", recover.state_from_zip("2", z)[1])), "'TN CA ' || CASE WHEN x LIKE '3%' THEN '0.95' ELSE '0.80' END || ' ' || CASE WHEN substr(x, 1, 1) IN ('2','6','7','8','9') THEN '0.95' ELSE '0.80' END")
scalar("rec_email", f"'to jo' || {num('k')} || '@' || {pick('yah,gma1,hotmial.com,netzero,gmailcom,aol', 'k')} || ' now'", recover.repaired_email, f"'jo' || {num('k')} || '@' || {pick('yahoo.com,gmail.com,hotmial.com,netzero.net,gmail.com,aol.com', 'k')}")
scalar("rec_default_dosage", pick("valium,XANAX,REDUX,ADIPEX", "k"), recover.default_dose, f"nullif({pick('1MG,0.25MG,,37.5MG', 'k')}, '')")
scalar("rec_glued_med_dose", f"'x VALIUM' || {D2} || 'mg y'", lambda t: F.concat_ws("|", *recover.glued_medicine(x.words_of(t))), f"'VALIUM|' || {D2} || 'MG'")
scalar("rec_med_before_dose", f"{pick('ab 5MG,x (Valum) 10mg,7MG', 'k')}", lambda t: recover.medicine_before_dose(x.words_of(t)), f"nullif({pick(',VALUM,', 'k')}, '')")
FUZZY_IN = f"{pick('ALIUM,XANAXX,AMBIN,none,clonazepan,VALIUM', 'k')} || ' of ' || {D2}"


def _fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(f"SELECT k AS record_id, {FUZZY_IN} AS x FROM ({KEYS}) o", orders=table(spark, sf_dir, "orders"))
    return recover.with_fuzzy_medicine(rows, "x", F.lit(True), "y").select("record_id", "y")


register("rec_fuzzy_medicine", _fuzzy, f"SELECT k AS record_id, nullif({pick('VALIUM,XANAX,AMBIEN,,CLONAZEPAM,VALIUM', 'k')}, '') AS y FROM ({KEYS.format(orders='orders')}) o")
scalar("rec_policy_no", f"'x SR_' || {num('k')} || 'A' || {DAY}", recover.glued_policy, f"'SR_' || {num('k')} || 'A'")
scalar("rec_phone", f"{pick('S15,615', 'k')} || '-423-' || {num('k % 10000', 4)}", recover.repaired_phone, f"{pick('815,615', 'k')} || '423' || {num('k % 10000', 4)}")
scalar("rec_card", pick("a V1SX card,McX,disc,amex,by gas,none", "k"), recover.card_trace, f"nullif({pick('Visa,MasterCard,Discover,American Express,Gas,', 'k')}, '')")
scalar("rec_blood", pick("C+,8-,0+,AB+,X+,E-", "k"), recover.repaired_blood, f"nullif({pick('O+,B-,O+,AB+,,B-', 'k')}, '')")
scalar("rec_gender_by_name", f"{pick('Carol,John,Zed,Frank', 'k')} || ' Xu'", recover.sex_of_name, f"nullif({pick('FEMALE,MALE,,MALE', 'k')}, '')")
scalar("agg_root_cause_class", pick("bad ZIP_2,BLOOD,Policy 1,SR 5,other", "k"), metrics.root_cause, pick("zip_missing,blood_group_error,policy_holder_parse,policy_holder_parse,other", "k"))


def _norm_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = norm.split_lines(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(lines).alias("n_lines"), F.md5(F.array_join(lines, "|")).alias("lines_md5"))


LINES_SQL = r"list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '')"
register("norm_lines", _norm_lines, f"SELECT doc_id, CAST(len({LINES_SQL}) AS INT) AS n_lines, md5(array_to_string({LINES_SQL}, '|')) AS lines_md5 FROM documents")
register("flt_min_lines", lambda s, d: pipeline.enough_lines(table(s, d, "documents")).select("doc_id"), "SELECT doc_id FROM documents WHERE len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: trim(s) <> '')) >= 3")
register("topk_first_n_lines", lambda s, d: table(s, d, "documents").select("doc_id", F.md5(F.array_join(F.slice(norm.split_lines(F.col("text")), 1, 8), " ")).alias("first_md5")), f"SELECT doc_id, md5(array_to_string(list_slice({LINES_SQL}, 1, 8), ' ')) AS first_md5 FROM documents")

# ---- bills: every stage is made once per input, if a query asks for it or a later one


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the bills as extracted, not validated: a query of some fields makes only these from the stored texts and places."""
    return fixtures.kept(spark, sf_dir, "bills-0", lambda: extract.extract(pipeline.enough_lines(fixtures.record_text(spark, sf_dir)), fixtures.stored))


def bill_stage(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The validated bills at first (0), after recovery (1) or at the end (2)."""

    def first() -> DataFrame:
        return fixtures.kept(spark, sf_dir, "bills-1", lambda: pipeline.first_stage(extracted(spark, sf_dir), fixtures.stored))

    def second() -> tuple[DataFrame, DataFrame]:
        return fixtures.kept(spark, sf_dir, "bills-2", lambda: pipeline.second_stage(first(), fixtures.stored))

    def third() -> DataFrame:
        return fixtures.kept(spark, sf_dir, "bills-3", lambda: pipeline.third_stage(*second(), fixtures.stored))

    return (first, lambda: second()[0], third)[k]()


def bills(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(bill_stage(spark, sf_dir, k) for k in range(3))


R = f"({fixtures.parts_sql()}) r"


def of_field(name: str, *columns: str, stage: int = 0, truth: dict[str, str] = fixtures.TRUTH) -> None:
    """One query for the values of some output columns at a stage."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = bill_stage(spark, sf_dir, stage) if stage else extracted(spark, sf_dir)
        return rows.select("record_id", *[F.coalesce(F.col(f"{lex.field(c)}.value"), F.lit("")).alias(lex.field(c)) for c in columns])

    register(name, query, f"SELECT k AS record_id, {', '.join(f'{truth[c]} AS {lex.field(c)}' for c in columns)} FROM {R}")


of_field("ext_record_no", "RECORD NO")
of_field("ext_customer_name", "CUSTOMER NAME", "BILLER NAME")
of_field("ext_email", "EMAIL ADDRESS")
of_field("ext_zip1", "ZIP_1")
of_field("ext_state1", "STATE_1")
of_field("ext_city1", "CITY_1")
of_field("ext_res_address", "RES_ADDRESS")
of_field("ext_phone1", "PH_NO1")
of_field("ext_phone2", "PH_NO2")
of_field("ext_country1", "COUNTRY_1")
of_field("ext_country2", "COUNTRY_2")
of_field("ext_sex1", "SEX_1")
of_field("ext_birth_date", "D BIRTH")
of_field("ext_blood_group", "BLOOD GP")
of_field("ext_height_weight", "HEIGHT", "WEIGHT")
of_field("ext_zip2", "ZIP_2")
of_field("ext_state2_city2", "STATE_2", "CITY_2")
of_field("ext_shipper_name", "SHIPPER NAME")
of_field("ext_medical_flags", "ALCOHOLIC", "SMOKER", "PAST SURG", "DIABETIC", "ALLERGIESED")
of_field("ext_policy_no", "POLICY NO")
of_field("ext_policy_dates", "D_B_LIFE_ASSURE", "DOB")
of_field("ext_premium", "P_INST")
of_field("ext_stamp", "STM NAME", "STM CODE")
of_field("ext_policy_holder", "NAME_P_HOLDER")
of_field("ext_sex2", "SEX_2")
of_field("ext_card", "CARD NAME")
of_field("ext_medicine", "MEDICINE")
of_field("ext_dosage", "DOSAGE")
of_field("ext_tablets", "TABLETS")
of_field("ext_prices", "PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT")
of_field("recovered_fields", "EMAIL ADDRESS", "SEX_1", "MEDICINE", "DOSAGE", stage=1, truth=fixtures.FINAL)
of_field("snk_unpack", *lex.MANDATORY, stage=2, truth=fixtures.FINAL)
of_field("fb_line_map", "PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT", stage=2, truth=fixtures.FINAL)


def stage_query(name: str, stage: int, shape: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda s, d: shape(bill_stage(s, d, stage)), sql)


def arr(*items: str) -> str:
    return "[" + ", ".join(items) + "]"


PRICES = ["PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT"]
MISSING = f"""CASE dmg WHEN 6 THEN 'DOSAGE' WHEN 7 THEN '{','.join(PRICES)}' WHEN 8 THEN 'EMAIL ADDRESS' WHEN 9 THEN 'SEX_1' ELSE '' END"""
WRONG = "CASE WHEN dmg = 5 THEN 'MEDICINE' ELSE '' END"
FIRST_ERRORS = f"""CASE WHEN dmg = 5 THEN 'Invalid medicine name ''' || med_read || '''.' WHEN {MISSING} = '' THEN '' ELSE array_to_string(list_transform(string_split({MISSING}, ','), lambda f: 'Mandatory field ''' || f || ''' is missing or empty.'), '; ') END"""
LAST_ERRORS = "CASE WHEN dmg <> 7 THEN '' ELSE " + " || '; ' || ".join([f"'Invalid currency format for {c} ''' || {fixtures.FILLED} || '''.'" for c in PRICES if c != "SHIPPING CO"] + [f"'Field ''{c}'' populated by raw OCR fallback for manual review.'" for c in PRICES]) + " END"

stage_query("val_required", 0, lambda d: d.select("record_id", F.array_join("missing_fields", ",").alias("missing")), f"SELECT k AS record_id, {MISSING} AS missing FROM {R}")
stage_query("val_medicine", 0, lambda d: d.select("record_id", F.array_join("format_errors", ",").alias("malformed")), f"SELECT k AS record_id, {WRONG} AS malformed FROM {R}")
stage_query("validation_first", 0, lambda d: d.select("record_id", "status", "valid", F.array_join("errors", "; ").alias("errors")), f"SELECT k AS record_id, CASE WHEN dmg >= 5 THEN 'REVIEW' ELSE 'PASS' END AS status, dmg < 5 AS valid, {FIRST_ERRORS} AS errors FROM {R}")
stage_query("flt_needs_recovery", 0, lambda d: d.where("status <> 'PASS'").select("record_id"), f"SELECT k AS record_id FROM {R} WHERE dmg >= 5")
stage_query("val_fallback_mark", 2, lambda d: d.where(F.exists(F.array(*[F.col(f"{f}.source") for f in lex.FIELDS]), lambda s: s.eqNullSafe(F.lit("fallback")))).select("record_id", F.size("errors").alias("n_errors")), f"SELECT k AS record_id, 7 AS n_errors FROM {R} WHERE dmg = 7")
stage_query("fb_confidence", 2, lambda d: d.where("cost.source = 'fallback'").select("record_id", F.col("cost.confidence").alias("confidence")), f"SELECT k AS record_id, 0.3::DOUBLE AS confidence FROM {R} WHERE dmg = 7")
register("ext_confidence", lambda s, d: extracted(s, d).select("record_id", F.col("record_no.confidence").alias("c_record"), F.col("state_1.confidence").alias("c_state"), F.col("city_2.confidence").alias("c_city"), F.col("dosage.confidence").alias("c_dosage")), f"SELECT k AS record_id, 0.9::DOUBLE AS c_record, 0.81::DOUBLE AS c_state, 0.77::DOUBLE AS c_city, CASE WHEN dmg = 6 THEN 0 ELSE 0.9 END::DOUBLE AS c_dosage FROM {R}")
stage_query("val_field_validity", 0, lambda d: d.select("record_id", F.bit_count("valid_1").alias("n_valid")), f"SELECT k AS record_id, CASE WHEN dmg < 5 THEN 42 WHEN dmg = 7 THEN 38 ELSE 41 END AS n_valid FROM {R}")
stage_query("flt_is_bad", 0, lambda d: d.withColumn("to_repair", F.array_union("missing_fields", "format_errors")).select("record_id", recover.is_bad("DOSAGE").alias("dose_bad"), recover.is_bad("MEDICINE").alias("medicine_bad")), f"SELECT k AS record_id, dmg = 6 AS dose_bad, dmg = 5 AS medicine_bad FROM {R}")


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = {"EMAIL ADDRESS": "(k % 10) / 10.0", "ZIP_1": "((k * 3) % 10) / 10.0", "IMAGE NAME": "1.0"}
    return fixtures.fields(spark, sf_dir, {}, of).select("record_id", recover.base_confidence().alias("base"))


register("agg_max_confidence", _best, "SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 10 = 0 THEN 0.9 ELSE greatest(o_orderkey % 10, (o_orderkey * 3) % 10) / 10.0 END::DOUBLE AS base FROM orders")
stage_query("distinct_values", 0, lambda d: d.select(F.explode(F.array_union("missing_fields", "format_errors")).alias("field")).distinct(), f"SELECT DISTINCT unnest(string_split({MISSING} || {WRONG}, ',')) AS field FROM {R} WHERE dmg >= 5")


def broken(name: str, columns: list[str], values: list[str], bad: tuple[int, ...], says: str, upper: bool = False) -> None:
    """One rule on good and bad values: the columns that it marks, and what it says. {c} stands for the column, {v} for the value."""
    picked = {c: pick(",".join(values), f"k + {i}") for i, c in enumerate(columns)}

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        done = validate.validate(fixtures.fields(spark, sf_dir, picked))
        return done.select("record_id", F.array_join("format_errors", ",").alias("malformed"), F.array_join("errors", "; ").alias("says"), "status")

    hit = [f"(k + {i}) % {len(values)} IN ({', '.join(map(str, bad))})" for i in range(len(columns))]
    shown = [f"trim({'upper' if upper else ''}({picked[c]}))" for c in columns]
    message = ["'" + says.replace("'", "''").replace("{c}", c).replace("{v}", f"' || {v} || '") + "'" for c, v in zip(columns, shown, strict=True)]
    listed = ["array_to_string(list_filter([" + ", ".join(f"CASE WHEN {h} THEN {e} ELSE '' END" for h, e in zip(hit, of, strict=True)) + f"], lambda v: v <> ''), '{sep}')" for of, sep in (([f"'{c}'" for c in columns], ","), (message, "; "))]
    register(name, query, f"SELECT k AS record_id, {listed[0]} AS malformed, {listed[1]} AS says, CASE WHEN {' OR '.join(hit)} THEN 'REVIEW' ELSE 'PASS' END AS status FROM ({KEYS.format(orders='orders')}) o")


broken("val_record_no", ["RECORD NO"], ["12345", "1234", "123456", "12a45", " 54321 "], (1, 2, 3), "Invalid Record Number format '{v}': must be exactly 5 digits.")
broken("val_zip", ["ZIP_1", "ZIP_2"], ["37201", "3720", "37201-1234", "3720a", " 84101"], (1, 2, 3), "Invalid {c} format '{v}': must be exactly 5 digits.")
broken("val_date", ["D BIRTH", "D_B_LIFE_ASSURE", "DOB"], ["01/02/1950", "1/2/50", "13/45/1950", "1-2-50", "01/02/19501", "01/02", "1950"], (3, 4, 5, 6), "Invalid date format for {c} '{v}': must match MM/DD/YY(YY).")
broken("val_sex", ["SEX_1", "SEX_2"], ["MALE", "female", "F", "MALES", "Female "], (2, 3), "Invalid sex format for {c} '{v}': must be MALE or FEMALE.", upper=True)
broken("val_blood", ["BLOOD GP"], ["A+", "ab-", "C+", "A", "O +", "0+", "O-"], (2, 3, 4, 5), "Invalid blood group '{v}': must be A/B/AB/O with +/-.", upper=True)
broken("val_integer", ["HEIGHT", "WEIGHT", "TABLETS"], ["150", "15O", "15.0", "-15", "007"], (1, 2, 3), "Invalid integer format for {c} '{v}'.")
for _name, _field, _dmg, _conf in (("rec_email_stage", "email_address", 8, 0.81), ("rec_sex_stage", "sex_1", 9, 0.81), ("rec_dose_stage", "dosage", 6, 0.81), ("rec_medicine_stage", "medicine", 5, 0.77)):
    stage_query(_name, 1, lambda d, f=_field: d.where(F.col(f"{f}.source") == "recovered").select("record_id", F.col(f"{f}.value").alias("value"), F.col(f"{f}.confidence").alias("confidence")), f"SELECT k AS record_id, {fixtures.FINAL[{'email_address': 'EMAIL ADDRESS', 'sex_1': 'SEX_1', 'dosage': 'DOSAGE', 'medicine': 'MEDICINE'}[_field]]} AS value, {_conf}::DOUBLE AS confidence FROM {R} WHERE dmg = {_dmg}")


def _first(rule: Callable[[Column, Column, Column], Column]) -> Callable[[Column], Column]:
    """The number of the first line for which the rule holds."""

    def first(text: Column) -> Column:
        lines = F.split(text, "\n")
        return F.array_min(F.transform(lines, lambda ln, i: F.when(rule(lines, ln, i), i)))

    return first


def cases(*texts: str) -> str:
    """Texts by key, | between their lines."""
    return "replace(" + pick(",".join(texts), "k") + ", '|', chr(10))"


def answers(*values: int | None) -> str:
    return f"try_cast(nullif({pick(','.join('' if v is None else str(v) for v in values), 'k')}, '') AS INT)"


scalar("sec_ship_trigger", cases("aa|bb|150 120 A+|dd|ee", "aa|bb|Fresno CA 93000|dd", "aa|John Baker|cc|John Bakr|ee", "aa|bb|cc", "CA aa|bb", "aa O-|bb", "aa|bb|LOCAL cab", "AB +|x"), _first(lambda lines, ln, i: sections.ship_trigger(lines, ln, i, x.repeats_name(ln, F.lit("John Baker")))), answers(3, 2, 3, None, 0, 1, None, 1))
scalar("sec_policy_trigger", cases("aa|SR_123 x", "aa|bb|BAX Ruth_70001", "jo@a.co|x", "aa|pay $150.00", "pay $175.00|aa", "aa 5R99|bb", "150.00|aa", "aa|baX_Al_70001|SR_1", "USR_1|BAXTER"), _first(lambda lines, ln, i: sections.policy_trigger(ln)), answers(1, 2, 0, 1, None, 0, None, 1, 0))
scalar("sec_med_trigger", cases("aa|bb|Visa x", "valium|x", "10MG|10 mg $5.00", "90 pills|90 COST 5", "aa-90 RATE|bb", "rate 12|bb", "60-1 TOTAL|60 total", "5mg|120 $3"), _first(lambda lines, ln, i: sections.medication_trigger(ln)), answers(2, 0, 1, 1, None, None, 1, 1))
#: A text of 1 to 3 lines more than its trigger in each section, and of fewer sections for some keys.
SECTION_LINES = ["'John Baker|xx|' || rpad('', cast(3 * (k % 3) as int), 'aa|')", "'Fresno CA 93000|' || rpad('', cast(3 * (k % 4) as int), 'bb|')", "CASE WHEN k % 7 = 3 THEN '' ELSE 'SR_10 x|' || rpad('', cast(3 * (c % 3) as int), 'cc|') END", "CASE WHEN k % 5 = 1 THEN '' ELSE 'Visa VALIUM|' || rpad('', cast(3 * (c % 4) as int), 'dd|') END"]


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(f"SELECT k, rtrim('|', {' || '.join(SECTION_LINES)}) AS x FROM ({KEYS}) o", orders=table(spark, sf_dir, "orders"))
    found = sections.split_into_sections(rows.select("k", F.split("x", r"\|").alias("lines"), F.lit("John Baker").alias("name")))
    return found.select(F.col("k").alias("record_id"), *[F.size(n).alias(n) for n in sections.NAMES])


register("sec_assign", _sections, f"""SELECT k AS record_id, CAST(2 + k % 3 AS INT) AS customer, CAST(s + CASE WHEN p = 0 THEN m ELSE 0 END AS INT) AS shipper, CAST(CASE WHEN p = 0 THEN 0 ELSE p END AS INT) AS policy, CAST(CASE WHEN p = 0 THEN 0 ELSE m END AS INT) AS medication
FROM (SELECT k, 1 + k % 4 AS s, CASE WHEN k % 7 = 3 THEN 0 ELSE 1 + c % 3 END AS p, CASE WHEN k % 5 = 1 THEN 0 ELSE 1 + c % 4 END AS m FROM ({KEYS.format(orders='orders')}) o) q""")

# ---- recovery prices, fallback filters and empty records on rows of their own


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixtures.parts(spark, sf_dir)
    v = {n: (F.col(e) / 100).cast("decimal(14,4)") for n, e in (("rate", "rate_c"), ("cost", "cost_c"))}
    gap = F.col("k") % 5
    args = [F.when(gap != 0, v["rate"]), F.when(gap != 1, v["cost"]), F.when(gap != 2, F.lit(20).cast("decimal(14,4)")), F.when(gap != 3, v["cost"] + 20), F.when(gap != 4, F.col("tabs").cast("int"))]
    solved = recover.solve_prices(*args)
    return p.select(F.col("k").alias("record_id"), *[x.dollars(solved[c]).alias(lex.field(c)) if c != "TABLETS" else solved[c].cast("string").alias("tablets") for c in (*PRICES, "TABLETS")])


def _when_gap(g: int, e: str) -> str:
    return f"CASE WHEN k % 5 = {g} THEN {e} END"


register("rec_price_algebra", _prices, f"SELECT k AS record_id, {_when_gap(0, cents('rate_c'))} AS pill_rate, {_when_gap(1, cents('cost_c'))} AS cost, {_when_gap(2, cents('2000'))} AS shipping_co, {_when_gap(3, cents('cost_c + 2000'))} AS total_amt, {_when_gap(4, 'tabs')} AS tablets FROM {R}")
scalar("fb_type_filter", f"'Zip ' || {Z5} || ' 01/02/1960 male jo@a.co'", lambda t: F.concat_ws("|", *[fallback.fitted(c, t) for c in ("ZIP_1", "DOB", "SEX_1", "EMAIL ADDRESS", "COST")]), f"{Z5} || '|01/02/1960|MALE|jo@a.co|' || x")
scalar("fb_skip_and_trim", f"{pick('Not Available,short,', 'k')} || rpad('', 120, 'x')", lambda t: fallback.raw_line(F.array(t), 3), "CASE WHEN k % 3 = 0 THEN NULL ELSE substr(x, 1, 100) END")





def mended(spark: SparkSession, sf_dir: str, values: dict[str, str], text: str = "''", shipper: str = "''", policy: str = "''") -> DataFrame:
    """Records with the given values (SQL) after the whole recovery, which reads the given text and sections."""
    made = fixtures.fields(spark, sf_dir, values, dict.fromkeys([c for c in lex.COLUMNS if values.get(c) != fixtures.NOTHING], "1.0"), _text=text, _shipper=shipper, _policy=policy)
    made = made.withColumns({"lines": norm.split_lines(F.col("_text")), "shipper": norm.split_lines(F.col("_shipper")), "policy": norm.split_lines(F.col("_policy"))})
    return recover.recover(validate.validate(made.withColumn("joined", F.array_join("lines", " "))), fixtures.stored)


def shown(d: DataFrame, *columns: str) -> DataFrame:
    """The values and confidences of some columns, "" and 0 where there is none."""
    return d.select("record_id", *[e for c in columns for e in (F.coalesce(F.col(f"{lex.field(c)}.value"), F.lit("")).alias(lex.field(c)), F.col(f"{lex.field(c)}.confidence").alias(f"{lex.field(c)}_c"))])


def mended_query(name: str, columns: dict[str, tuple[str, str]], **given) -> None:
    """columns: what each column should hold and with which confidence, as SQL."""
    register(name, lambda s, d: shown(mended(s, d, **given), *columns), f"SELECT k AS record_id, {', '.join(f'{v} AS {lex.field(c)}, CAST({f} AS DOUBLE) AS {lex.field(c)}_c' for c, (v, f) in columns.items())} FROM ({KEYS.format(orders='orders')}) o")


NONE, CITY_IN = fixtures.NOTHING, pick("Provo,Lake City,West Valley City", "k")
ZIP_IN = f"CASE WHEN k % 2 = 0 THEN {num('84000 + k % 1000')} ELSE {num('8400 + k % 100')} END"
mended_query(
    "rec_reverse_address", {"STATE_1": ("CASE WHEN k % 2 = 0 THEN 'TN' ELSE 'UT' END", "CASE WHEN k % 2 = 0 THEN 0.8 ELSE 0.9 END"), "CITY_1": (CITY_IN, "0.85"), "RES_ADDRESS": ("'12 Elm Lane'", "0.85")},
    values={"STATE_1": NONE, "CITY_1": NONE, "RES_ADDRESS": NONE, "ZIP_1": ZIP_IN}, text=f"'John jo@aol.com 12 Elm Lane ' || {CITY_IN} || ' UT ' || {ZIP_IN}",
)
SHIP_CITY, SHIP_ZIP = pick("Fresno,San Benito,Lake City", "k"), f"CASE WHEN k % 3 = 0 THEN {num('93000 + k % 900')} WHEN k % 3 = 1 THEN {num('10000 + k % 900')} END"
mended_query(
    "rec_shipper_address", {"STATE_2": ("CASE WHEN k % 3 = 2 THEN '' ELSE 'CA' END", "CASE k % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.8 ELSE 0 END"), "CITY_2": (f"CASE WHEN k % 3 = 2 THEN '' ELSE {SHIP_CITY} END", "CASE WHEN k % 3 = 2 THEN 0 ELSE 0.85 END")},
    values={"STATE_2": NONE, "CITY_2": NONE, "ZIP_2": SHIP_ZIP}, shipper=f"'Oscar Zimmer' || chr(10) || {SHIP_CITY} || ' NY ' || coalesce({SHIP_ZIP}, 'none')",
)
_DAY2 = f"'07/1' || {num('k % 10')} || '/1971'"
mended_query(
    "rec_dates",
    {
        "D BIRTH": (f"CASE k % 4 WHEN 2 THEN '04/05/1960' WHEN 3 THEN '06/07' ELSE {DAY} END", "CASE k % 4 WHEN 2 THEN 0.95 WHEN 3 THEN 0.4 ELSE 0.9 END"),
        "D_B_LIFE_ASSURE": (f"CASE k % 4 WHEN 0 THEN {_DAY2} WHEN 2 THEN '04/05/1960' WHEN 3 THEN '06/07' ELSE {DAY} END", "CASE k % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.8 WHEN 2 THEN 0.95 ELSE 0.4 END"),
        "DOB": (f"CASE k % 4 WHEN 0 THEN '09/08/70' WHEN 2 THEN '04/05/1960' WHEN 3 THEN '06/07' ELSE {DAY} END", "CASE k % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.8 WHEN 2 THEN 0.95 ELSE 0.4 END"),
    },
    values={"D BIRTH": NONE, "D_B_LIFE_ASSURE": NONE, "DOB": NONE},
    text=f"CASE k % 4 WHEN 0 THEN 'on ' || {DAY} || ' and ' || {_DAY2} || ' to 9/8/70' WHEN 1 THEN 'on ' || {DAY} || ' 55/66/1999' WHEN 2 THEN {DAY} || ' SR_77A4/5/1960' ELSE 'on 6/7 or 13/45' END",
)
mended_query(
    "rec_medical_flags", {c: (v, f) for c, v, f in (("ALCOHOLIC", "CASE WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END", "0.9"), ("SMOKER", "'NO'", "0.9"), ("PAST SURG", "'NO'", "1.0"), ("DIABETIC", pick("NO,YES", "c"), "0.9"), ("ALLERGIESED", "CASE WHEN k % 3 = 0 THEN '' ELSE 'YES' END", "CASE WHEN k % 3 = 0 THEN 0 ELSE 0.9 END"))},
    values={"ALCOHOLIC": NONE, "SMOKER": NONE, "DIABETIC": NONE, "ALLERGIESED": NONE}, shipper=f"'Oscar' || chr(10) || {pick('YE5,N0', 'k')} || ' NOI maybe no'", policy=f"{pick('INO,Y1S', 'c')} || CASE WHEN k % 3 = 0 THEN '' ELSE ' x YES' END || chr(10) || 'NO'",
)
mended_query("rec_policy_stage", {"POLICY NO": (f"'SR_' || {num('k')} || 'A'", "0.95"), "DOB": ("'05/06/1960'", "1.0")}, values={"POLICY NO": NONE}, text=f"'x SR_' || {num('k')} || 'A' || {DAY}")
PHONE_READ, PHONE_END = pick("S15,615", "k"), f"'-423-' || {num('k % 10000', 4)}"
mended_query(
    "rec_phone_stage", {"PH_NO1": (f"'(' || {pick('815,615', 'k')} || ') 423-' || {num('k % 10000', 4)}", "0.9"), "PH_NO2": (f"{pick('815,615', 'k')} || '423' || {num('k % 10000', 4)}", "0.9")},
    values={"PH_NO1": NONE, "PH_NO2": NONE}, text=f"'call ' || {PHONE_READ} || {PHONE_END} || ' now'",
)
mended_query("rec_card_stage", {"CARD NAME": (pick("Visa,MasterCard,Discover,American Express,Gas,", "k"), "CASE WHEN k % 6 = 5 THEN 0 ELSE 0.9 END")}, values={"CARD NAME": NONE}, text=pick("a V1SX card,McX,disc,amex,by gas,none", "k"))
mended_query("rec_blood_stage", {"BLOOD GP": (pick("O+,B-,O+,AB+,X+,B-", "k"), "CASE WHEN k % 6 IN (3, 4) THEN 1.0 ELSE 0.9 END")}, values={"BLOOD GP": pick("C+,8-,0+,AB+,X+,E-", "k")})
mended_query("rec_glued_stage", {"MEDICINE": (pick("VALIUM,XANAX", "c"), "0.95"), "DOSAGE": (f"{D2} || 'MG'", "0.95")}, values={"MEDICINE": NONE, "DOSAGE": NONE}, text=f"'x ' || {pick('VALIUM,Xanax', 'c')} || {D2} || 'mg y'")
mended_query("rec_before_dose_stage", {"MEDICINE": (pick(",QWERTY,VALIUM", "k"), "CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.8 ELSE 0.85 END"), "DOSAGE": ("'5MG'", "1.0")}, values={"MEDICINE": NONE}, text=pick("ab 5MG,x (Qwerty) 10mg,Qwerty 10mg Valum", "k"))
GAPS = {"PILL RATE": "'$1.00'", "COST": "'$90.00'", "SHIPPING CO": "'$20.00'", "TOTAL AMT": "'$110.00'", "TABLETS": "'90'"}
mended_query("rec_price_stage", {c: (v, f"CASE WHEN k % 5 = {g} THEN 0.98 ELSE 1.0 END") for g, (c, v) in enumerate(GAPS.items())}, values={c: f"CASE WHEN k % 5 <> {g} THEN {v} END" for g, (c, v) in enumerate(GAPS.items())})
mended_query(
    "rec_sex_copied", {"SEX_1": ("CASE WHEN k % 2 = 0 THEN 'FEMALE' ELSE '' END", "CASE WHEN k % 2 = 0 THEN 0.75 ELSE 0 END"), "SEX_2": ("'FEMALE'", "1.0")},
    values={"SEX_1": NONE, "CUSTOMER NAME": "'Zed Xu'", "NAME_P_HOLDER": pick("Zed Xu Qi,Quux Bo", "k")},
)
scalar("rec_flag_words", f"'N0 yes ' || {pick('NO,YE5,NOI', 'k')} || ' x INO'", lambda t: F.array_join(x.yes_no(x.words_of(t)), ","), f"'NO,YES,' || {pick('NO,YES,NO', 'k')} || ',NO'")
scalar("rec_date_finder", f"'on ' || {DAY} || ' and 1/2/1950 9/8/70'", lambda t: F.concat_ws("|", *[F.get(recover.good_dates(t), F.lit(i)) for i in range(3)]), f"{DAY} || '|01/02/1950|09/08/70'")


def _empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"CASE k % 3 WHEN 0 THEN 'available' || chr(10) || ' ' || chr(10) || 'Not Available' WHEN 1 THEN '' ELSE {num('10000 + k % 20000')} || ' ' || {pick('Mary Turner,John Baker', 'c')} END"
    rows = spark.sql(f"SELECT k AS record_id, 'p.png' AS image_name, {text} AS text, cast(0.9 as double) AS confidence FROM ({KEYS}) o", orders=table(spark, sf_dir, "orders"))
    out = extract.extract(rows, fixtures.stored)
    empty = F.coalesce(*[F.col(f"{f}.value") for f in lex.FIELDS if f != "image_name"]).isNull()
    return out.select("record_id", F.col("image_name.value").alias("image_name"), empty.alias("all_empty"), F.coalesce("record_no.value", F.lit("")).alias("record_no"), F.coalesce("customer_name.value", F.lit("")).alias("customer_name"), F.col("record_no.confidence").alias("confidence"))


register("ext_empty_record", _empty, f"SELECT k AS record_id, 'p.png' AS image_name, k % 3 <> 2 AS all_empty, CASE WHEN k % 3 = 2 THEN {num('10000 + k % 20000')} ELSE '' END AS record_no, CASE WHEN k % 3 = 2 THEN {pick('Mary Turner,John Baker', 'c')} ELSE '' END AS customer_name, CASE WHEN k % 3 = 2 THEN 0.9 ELSE 0 END::DOUBLE AS confidence FROM ({KEYS.format(orders='orders')}) o")

# ---- lesser rules, on bills with other lines
FEWER_PRICES = {13: f"CASE k % 4 WHEN 0 THEN {cents('rate_c')} || ' ' || {cents('cost_c')} || ' $20.00 ' || {cents('cost_c + 2000')} WHEN 1 THEN {cents('rate_c')} || ' ' || {cents('cost_c')} || ' ' || {cents('cost_c + 2000')} WHEN 2 THEN {cents('cost_c')} || ' ' || {cents('cost_c + 2000')} ELSE {cents('cost_c + 2000')} END"}
NO_COUNTRY = {4: "CASE WHEN dmg = 9 THEN '' ELSE sex || ' ' END || born", 7: "city2 || ' CA ' || zip2", 11: "sex2 || ' ' || dob"}


def lesser(name: str, lines: dict[int, str], columns: dict[str, tuple[str, str]]) -> None:
    """Some fields, with their confidences, of bills of which some lines are other ones."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(extract.extract(fixtures.record_text(spark, sf_dir, lines), fixtures.stored), *columns)

    register(name, query, f"SELECT k AS record_id, {', '.join(f'{v} AS {lex.field(c)}, CAST({f} AS DOUBLE) AS {lex.field(c)}_c' for c, (v, f) in columns.items())} FROM {R}")


lesser("ext_prices_few", FEWER_PRICES, {
    "PILL RATE": (f"CASE WHEN k % 4 < 2 THEN {cents('rate_c')} ELSE '' END", "CASE k % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.72 ELSE 0 END"), "COST": (f"CASE WHEN k % 4 < 3 THEN {cents('cost_c')} ELSE '' END", "CASE k % 4 WHEN 0 THEN 0.9 WHEN 3 THEN 0 ELSE 0.72 END"),
    "SHIPPING CO": ("CASE WHEN k % 4 < 3 THEN '$20.00' ELSE '' END", "CASE k % 4 WHEN 0 THEN 0.9 WHEN 3 THEN 0 ELSE 0.72 END"), "TOTAL AMT": (cents("cost_c + 2000"), "CASE k % 4 WHEN 0 THEN 0.9 WHEN 3 THEN 0.63 ELSE 0.72 END"),
})
lesser("ext_defaults", NO_COUNTRY, {"COUNTRY_1": ("'US'", "0.54"), "COUNTRY_2": ("'US'", "0.54"), "SEX_2": ("sex2", "0.72"), "D BIRTH": ("born", "0.9")})

lesser("ext_medication_anywhere", {8: "phone2 || ' ' || flag0 || ' ' || flag1 || ' ' || card || ' ' || med || ' ' || dose", 12: "''", 13: "''"}, {"CARD NAME": ("card", "0.63"), "MEDICINE": ("med", "0.63"), "DOSAGE": ("dose", "0.63"), "TOTAL AMT": ("''", "0")})
lesser("ext_policy_anywhere", {1: "mail || ' ' || policy", 9: "insured || ' $' || premium"}, {"POLICY NO": ("policy", "0.63"), "STM NAME": ("stamp", "0.9")})
lesser("ext_blood_lone", {5: f"height || ' ' || weight || ' ' || {pick('+,A,O', 'k')}"}, {"BLOOD GP": (pick("B+,A+,O+", "k"), "0.72"), "HEIGHT": ("height", "0.9"), "WEIGHT": ("weight", "0.9")})

# ---- metrics, routing and sinks
FAILED_FIELDS = "('PILL RATE', 'COST', 'SHIPPING CO', 'TOTAL AMT')"
FIELD_ROWS = ", ".join(f"({k}, '{c}')" for k, c in enumerate(lex.MANDATORY))
COUNTS = f"(SELECT count(*) AS n, count(*) FILTER (dmg = 5) AS d5, count(*) FILTER (dmg = 6) AS d6, count(*) FILTER (dmg = 7) AS d7, count(*) FILTER (dmg = 8) AS d8, count(*) FILTER (dmg = 9) AS d9 FROM {R}) n"
RECOVERED = "CASE field WHEN 'MEDICINE' THEN d5 WHEN 'DOSAGE' THEN d6 WHEN 'EMAIL ADDRESS' THEN d8 WHEN 'SEX_1' THEN d9 ELSE 0 END"
METRICS = f"(SELECT ord, field, n - failed - recovered AS extracted, recovered, failed FROM (SELECT ord, field, n, {RECOVERED} AS recovered, CASE WHEN field IN {FAILED_FIELDS} THEN d7 ELSE 0 END AS failed FROM (VALUES {FIELD_ROWS}) f(ord, field), {COUNTS}) q) m"
stage_query("agg_recovery_metrics", 2, metrics.recovery_metrics, f"SELECT field, extracted, recovered, failed FROM {METRICS}")
stage_query("agg_summary", 2, metrics.summary, f"SELECT n AS total, n - d7 AS passed, d7 AS failed FROM {COUNTS}")


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = {"BLOOD GP": f"CASE k % 4 WHEN 0 THEN 'C+' WHEN 1 THEN {fixtures.NOTHING} ELSE 'A+' END", "SHIPPER NAME": f"CASE k % 5 WHEN 0 THEN {fixtures.NOTHING} WHEN 1 THEN 'N0t 12' ELSE 'Oscar Quist' END", "TABLETS": f"CASE k % 6 WHEN 0 THEN {fixtures.NOTHING} WHEN 1 THEN '9x' ELSE '90' END", "DOB": "CASE WHEN k % 7 = 0 THEN '1950' ELSE '05/06/1960' END", "D BIRTH": f"CASE WHEN k % 14 = 0 THEN {fixtures.NOTHING} ELSE '01/02/1950' END", "ZIP_2": "CASE WHEN k % 8 = 0 THEN '123' ELSE '93701' END", "CITY_1": "CASE WHEN k % 9 = 0 THEN 'Not/It' ELSE 'Provo' END"}
    return metrics.review_categories(validate.validate(fixtures.fields(spark, sf_dir, bad)))


register("agg_review_categories", _categories, f"SELECT category, n FROM (SELECT " + ", ".join(f"count(*) FILTER (WHERE {w}) AS \"{c}\"" for c, w in (("Missing blood group", "k % 4 < 2"), ("Missing shipper name", "k % 5 = 0"), ("Missing tablets", "k % 6 = 0"), ("Date errors", "k % 7 = 0"), ("Address errors", "k % 8 = 0 OR k % 9 = 0"))) + f" FROM ({KEYS.format(orders='orders')}) o) q UNPIVOT (n FOR category IN (COLUMNS(*)))")
stage_query("agg_root_cause", 0, lambda d: metrics.root_causes(sinks.review(d)).select("cause", "n"), f"""SELECT cause, count(*) AS n FROM (SELECT CASE WHEN {FIRST_ERRORS} LIKE '%EMAIL%' THEN 'email_parse' ELSE 'other' END AS cause FROM {R} WHERE dmg >= 5) q GROUP BY cause""")
stage_query("snk_root_cause_json", 2, lambda d: metrics.root_cause_json(metrics.root_causes(sinks.review(d))), f"SELECT '{{\"other\":' || d7 || '}}' AS json FROM {COUNTS}")
stage_query("snk_stats", 2, metrics.stats, f"""SELECT * FROM (SELECT unnest([0, 1, 2]) AS ord, 'SUMMARY' AS "METRIC_TYPE", unnest(['Total Records Processed', 'Successful Records (PASS)', 'Failed Records (Review Required)']) AS "NAME", CAST(unnest([n, n - d7, d7]) AS VARCHAR) AS "EXTRACTED_OR_VALUE", 'N/A' AS "RECOVERED_BY_ENGINE", 'N/A' AS "FAILED" FROM {COUNTS}
UNION ALL SELECT CAST(ord + 3 AS INT), 'RECOVERY', field, CAST(extracted AS VARCHAR), CAST(recovered AS VARCHAR), CAST(failed AS VARCHAR) FROM {METRICS}) u""")
stage_query("setop_route", 2, lambda d: d.select("record_id", F.when(F.col("valid"), "accepted").otherwise("review").alias("to")), f"SELECT k AS record_id, CASE WHEN dmg = 7 THEN 'review' ELSE 'accepted' END AS to FROM {R}".replace(" AS to ", ' AS "to" '))
stage_query("snk_log", 2, lambda d: sinks.log(d).select("record_id", "RECORD_NO", "IMAGE_NAME", "STATUS", "ERRORS"), f"""SELECT k AS record_id, rec AS "RECORD_NO", 'page_' || (k % 500) || '.png' AS "IMAGE_NAME", CASE WHEN dmg = 7 THEN 'REVIEW' ELSE 'PASS' END AS "STATUS", {LAST_ERRORS} AS "ERRORS" FROM {R}""")


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows appended by two runs, all 43 columns read again."""
    done, path = bill_stage(spark, sf_dir, 2), _place(spark, "extracted")
    for k in (0, 1):
        sinks.write_csv(sinks.accepted(done.where(F.col("record_id") % 2 == k)), path, "append")
    found = spark.read.options(**sinks.CSV).csv(path)
    return found.select(F.col("RECORD NO").alias("record_no"), F.col("TOTAL AMT").alias("total_amt"), F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in lex.COLUMNS])).alias("row_md5"))


ALL_FINAL = fixtures.FINAL | {"IMAGE NAME": "'page_' || (k % 500) || '.png'"}
register("snk_extracted", _extracted, f"SELECT rec AS record_no, {cents('cost_c + 2000')} AS total_amt, md5({" || '|' || ".join(f'({ALL_FINAL[c]})' for c in lex.COLUMNS)}) AS row_md5 FROM {R} WHERE dmg <> 7")


def _reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new run replaces what two runs before it have appended."""
    done, path = bill_stage(spark, sf_dir, 2), _place(spark, "reset")
    for mode in ("append", "append", "overwrite"):
        sinks.write_csv(sinks.accepted(done), path, mode)
    return src.read_review(spark, path).select(F.col("RECORD NO").alias("record_no"), F.col("POLICY NO").alias("policy_no"))


register("snk_reset", _reset, f"SELECT rec AS record_no, policy AS policy_no FROM {R} WHERE dmg <> 7")


def _review(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, path = bill_stage(spark, sf_dir, 2), _place(spark, "review")
    sinks.write_csv(sinks.review(done), path)
    return spark.read.options(**sinks.CSV).csv(path).select(F.col("RECORD NO").alias("record_no"), F.col("POLICY NO").alias("policy_no"), F.col("TOTAL AMT").alias("total_amt"), "VALIDATION_ERRORS")


register("snk_review", _review, f'SELECT rec AS record_no, policy AS policy_no, {fixtures.FILLED} AS total_amt, {LAST_ERRORS} AS "VALIDATION_ERRORS" FROM {R} WHERE dmg = 7')


def _review_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review file of reviewed and of failed records, and one that isn't there."""
    done, path = bill_stage(spark, sf_dir, 2), _place(spark, "review")
    failed = done.where("record_id % 13 = 0").select("record_id", F.lit("x").alias("record_no"), F.lit("p").alias("image_name"), F.concat(F.lit("lost "), F.col("record_id").cast("string")).alias("message"))
    sinks.write_csv(sinks.review(done).unionByName(sinks.failed_review(failed)), path, "append")
    both = src.read_review(spark, path).unionByName(src.read_review(spark, path + "-none"))
    return both.select(F.col("RECORD NO").alias("record_no"), F.col("ZIP_1").alias("zip_1"), "VALIDATION_ERRORS")


register("src_review_csv", _review_read, f"""SELECT rec AS record_no, zip1 AS zip_1, {LAST_ERRORS} AS "VALIDATION_ERRORS" FROM {R} WHERE dmg = 7 UNION ALL SELECT '', '', 'lost ' || k FROM {R} WHERE k % 13 = 0""")


def _log_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log appended by two runs, with its time."""
    done, path = bill_stage(spark, sf_dir, 2), _place(spark, "log")
    for _ in range(2):
        sinks.write_csv(sinks.log(done), path, "append")
    found = spark.read.options(**sinks.CSV).csv(path)
    return found.groupBy(F.col("RECORD_NO").alias("record_no"), F.col("IMAGE_NAME").alias("image_name"), F.col("STATUS").alias("status")).agg(F.count("*").alias("n"), F.bool_and(F.col("TIMESTAMP").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).alias("stamped"))


register("snk_log_append", _log_twice, f"""SELECT rec AS record_no, 'page_' || (k % 500) || '.png' AS image_name, CASE WHEN dmg = 7 THEN 'REVIEW' ELSE 'PASS' END AS status, 2 * count(*) AS n, true AS stamped FROM {R} GROUP BY ALL""")


# ---- pages, boxes and layouts, derived from pages, orders and events

PAGES = f"SELECT page_id AS n, 'scan_' || {num('page_id')} || {pick('.png,.JPG,.jpeg,.txt', 'page_id')} AS image_path, cast(400 + (page_id * 37) % 900 as int) AS width, cast(450 + (page_id * 53) % 1100 as int) AS height FROM {{pages}}"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGES, pages=table(spark, sf_dir, "pages"))


IMAGES = f"(SELECT * FROM ({PAGES.format(pages='pages')}) p WHERE n % 4 <> 3)"
LARGE = f"(SELECT *, row_number() OVER (ORDER BY n) AS page_idx FROM {IMAGES} i WHERE width > 500 AND height > 500)"


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.number(src.large_enough(src.catalog(files(spark, sf_dir))))


def page_query(name: str, shape: Callable[[DataFrame], DataFrame], sql: str) -> None:
    register(name, lambda s, d: shape(numbered(s, d)).select("image_path", "page_idx"), f"SELECT image_path, page_idx FROM {LARGE} l {sql}")


register("src_page_catalog", lambda s, d: src.catalog(files(s, d)).select("image_path", "width", "height"), f"SELECT image_path, width, height FROM {IMAGES} i")
register("src_page_size_filter", lambda s, d: src.large_enough(src.catalog(files(s, d))).select("image_path"), f"SELECT image_path FROM {LARGE} l")
NATURAL = f"SELECT {pick('Vol,vol', 'page_id')} || (page_id % 13) || '/' || {pick('scan_,SCAN_', 'page_id')} || page_id || 'b' || (page_id % 3) || '.png' AS image_path, page_id FROM {{pages}}"
register("src_natural_sort", lambda s, d: src.number(s.sql(NATURAL, pages=table(s, d, "pages"))).select("page_id", "page_idx"), f"SELECT page_id, row_number() OVER (ORDER BY page_id % 13, page_id) AS page_idx FROM ({NATURAL.format(pages='pages')}) n")
page_query("src_page_number", lambda p: p, "")
page_query("src_page_limit", lambda p: src.limit(p, 40), "WHERE page_idx <= 40")
page_query("src_page_range", lambda p: src.between(src.limit(p, 40), 0, 25), "WHERE page_idx <= 25")
page_query("src_last_page", src.last_only, f"WHERE page_idx = (SELECT count(*) FROM {LARGE} m)")

#: Ten boxes per order: page (order), number, place and text. The text of every fifth is a record number, of every seventh a marker.
BOXES = f"""SELECT k AS page_idx, j AS n, cast(60 + (k * 13 + j * 67) % 600 as double) AS x_min, cast(40 + (k * 7 + j * 97) % 900 as double) AS y_min,
  cast(20 + (k + j) % 40 as double) AS w, cast(10 as double) AS h, CASE WHEN j % 5 = 0 THEN {num('10000 + k % 90000')} || ' x' WHEN j % 7 = 0 THEN 'Available' ELSE 'word' END AS text,
  cast((50 + (k + j) % 50) / 100.0 as double) AS confidence, 750 AS width, 1000 AS height
FROM (SELECT o_orderkey AS k, {{ten}} AS j FROM {{orders}}) o"""
BOX_SQL = f"(SELECT *, x_min + w AS x_max, y_min + h AS y_max FROM ({BOXES.format(orders='orders', ten='unnest(range(10))')}) q)"
COLUMN_SQL = "CASE WHEN x_min + w / 2 BETWEEN 77 AND 271 THEN 0 WHEN x_min + w / 2 BETWEEN 271 AND 475 THEN 1 WHEN x_min + w / 2 BETWEEN 475 AND 670 THEN 2 END"


def box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as polygons, reduced to their bounds."""
    raw = spark.sql(BOXES.replace("{ten}", "explode(sequence(0, 9))"), orders=table(spark, sf_dir, "orders"))
    a, b, c, e = F.col("x_min"), F.col("x_min") + F.col("w"), F.col("y_min"), F.col("y_min") + F.col("h")
    corner = [F.struct(px.alias("x"), py.alias("y")) for px, py in ((b, c), (a, c), (a, e), (b, e))]
    return boxes.bounds(raw.select("page_idx", "n", "text", "confidence", "width", "height", F.array(*corner).alias("polygon")))


register("src_ocr_boxes", lambda s, d: box_rows(s, d).select("page_idx", "n", "x_min", "x_max", "y_min", "y_max", "center_y", "text", "confidence"), f"SELECT page_idx, n, x_min, x_max, y_min, y_max, (y_min + y_max) / 2 AS center_y, text, confidence FROM {BOX_SQL} b")
register("box_column_join", lambda s, d: boxes.in_columns(box_rows(s, d)).select("page_idx", "n", "col"), f"SELECT page_idx, n, {COLUMN_SQL} AS col FROM {BOX_SQL} b")
#: Pages with columns of their own: two to four, of different widths.
CUTS = "SELECT page_idx, CASE page_idx % 3 WHEN 0 THEN {a}0, 300, 750{z} WHEN 1 THEN {a}40, 260, 500, 720{z} ELSE {a}0, 150, 400, 401, 700{z} END AS cuts FROM {pages}"


def _own_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = box_rows(spark, sf_dir)
    cuts = spark.sql(CUTS.replace("{a}", "array(").replace("{z}", ")"), pages=rows.select("page_idx").distinct())
    return boxes.in_columns(rows, boxes.cut_columns(cuts)).select("page_idx", "n", "col")


register("box_own_columns", _own_columns, f"""SELECT b.page_idx, b.n, CAST((SELECT min(i) FROM range(1, 5) r(i) WHERE i < len(cuts) AND x_min + w / 2 BETWEEN cuts[i] AND cuts[i + 1]) - 1 AS INT) AS col
FROM {BOX_SQL} b JOIN ({CUTS.replace('{a}', '[').replace('{z}', ']').replace('{pages}', '(SELECT DISTINCT page_idx FROM ' + BOX_SQL + ' q)')}) c ON b.page_idx = c.page_idx""")
register("box_mean_conf", lambda s, d: box_rows(s, d).groupBy("page_idx").agg(F.bround(F.avg("confidence"), 6).alias("mean_confidence")), f"SELECT page_idx, round(avg(confidence), 6) AS mean_confidence FROM {BOX_SQL} b GROUP BY page_idx")
register("agg_group_min_max", lambda s, d: box_rows(s, d).groupBy("page_idx").agg(F.min("y_min").alias("top"), F.max("y_max").alias("bottom"), F.avg("center_y").alias("middle")), f"SELECT page_idx, min(y_min) AS top, max(y_max) AS bottom, avg((y_min + y_max) / 2) AS middle FROM {BOX_SQL} b GROUP BY page_idx")
ANCHOR_SQL = f"""(SELECT page_idx, col, band, min(y_min) AS anchor_y FROM (SELECT *, {COLUMN_SQL} AS col FROM {BOX_SQL} b) c JOIN (VALUES (0, 0.10, 0.35), (1, 0.35, 0.65), (2, 0.60, 0.90)) v(band, lo, hi) ON y_min BETWEEN CAST(lo * 1000 AS INT) AND CAST(hi * 1000 AS INT)
WHERE n % 5 = 0 AND x_min - CASE col WHEN 0 THEN 77 WHEN 1 THEN 271 ELSE 475 END <= 40 AND col IS NOT NULL GROUP BY page_idx, col, band)"""
register("box_anchor_pick", lambda s, d: boxes.anchors(box_rows(s, d)), f"SELECT * FROM {ANCHOR_SQL} a")
register("win_row_number", lambda s, d: boxes.anchors(box_rows(s, d)).groupBy("page_idx").agg(F.min_by("col", F.struct("anchor_y", "col", "band")).alias("first_col")), f"SELECT page_idx, first_col FROM (SELECT page_idx, col AS first_col, row_number() OVER (PARTITION BY page_idx ORDER BY anchor_y, col, band) AS r FROM {ANCHOR_SQL} a) q WHERE r = 1")
register("sort_boxes", lambda s, d: box_rows(s, d).groupBy("page_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("center_y", "x_min", "n"))), lambda b: b["n"].cast("string")), ",").alias("order")), f"SELECT page_idx, string_agg(n, ',' ORDER BY y_min, x_min, n) AS \"order\" FROM {BOX_SQL} b GROUP BY page_idx")


def word_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for every word of every bill: y from the line, x from the word, with jitter below half a box."""
    rows = fixtures.record_text(spark, sf_dir).select("record_id", F.posexplode(norm.split_lines(F.col("text"))).alias("line", "words"))
    rows = rows.select("record_id", "line", F.posexplode(F.split("words", " ")).alias("word", "text"))
    y = 20.0 * F.col("line") + (F.col("record_id") + 3 * F.col("word")) % 4
    return rows.select("record_id", (F.col("line") * 100 + F.col("word")).cast("long").alias("n"), (10.0 * F.col("word")).alias("x_min"), y.alias("y_min"), (y + 10).alias("y_max"), (y + 5).alias("center_y"), "text", F.lit(0.9).alias("confidence"))


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes.group_lines(word_boxes(spark, sf_dir), "record_id")


TEXT_SQL = f"({fixtures.records_sql()}) t"
register("box_line_group", lambda s, d: _grouped(s, d).select("record_id", F.size("lines").alias("n_lines")), f"SELECT record_id, CAST(len({LINES_SQL}) AS INT) AS n_lines FROM {TEXT_SQL}")
register("box_line_text", lambda s, d: _grouped(s, d).select("record_id", F.md5("text").alias("text_md5")), f"SELECT record_id, md5(array_to_string({LINES_SQL}, chr(10))) AS text_md5 FROM {TEXT_SQL}")

#: Lines of a user's page: y from the event id; two profiles, and dividers with gaps.
LINES_OF = "SELECT user_id, cast((event_id * 7) % 1000 as int) AS y FROM {events}"
CHAINS = f"(SELECT user_id, CAST(floor(avg(y)) AS INT) AS y FROM (SELECT user_id, y, sum(new) OVER (PARTITION BY user_id ORDER BY y) AS g FROM (SELECT user_id, y, CASE WHEN y - lag(y) OVER (PARTITION BY user_id ORDER BY y) <= 12 THEN 0 ELSE 1 END AS new FROM (SELECT DISTINCT user_id, y FROM ({LINES_OF.format(events='events')}) l) d) s) c GROUP BY user_id, g)"


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINES_OF, events=table(spark, sf_dir, "events"))


register("line_cluster_1d", lambda s, d: layout.cluster_1d(lines_of(s, d), "user_id"), f"SELECT user_id, y FROM {CHAINS} c")


def _snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(spark, sf_dir)
    points = lines.groupBy("user_id").agg((F.min("y") + 31).alias("anchor_y"))
    return layout.snap_nearest(points, layout.cluster_1d(lines, "user_id"), ["user_id"])


POINTS = f"(SELECT user_id, min(y) + 31 AS anchor_y FROM ({LINES_OF.format(events='events')}) l GROUP BY user_id)"
register("line_snap_nearest", _snapped, f"SELECT p.user_id, p.anchor_y, coalesce((SELECT arg_min(c.y, abs(c.y - (p.anchor_y - 8)) * 10000 + c.y) FROM {CHAINS} c WHERE c.user_id = p.user_id AND abs(c.y - (p.anchor_y - 8)) <= 25), p.anchor_y - 8) AS divider FROM {POINTS} p")

DIVS = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE cast(140 + o_orderkey % 9 as int) END AS a, CASE WHEN o_orderkey % 4 = 1 OR o_orderkey % 7 = 0 THEN NULL ELSE cast(420 + o_orderkey % 5 as int) END AS b, CASE WHEN o_orderkey % 4 = 2 OR o_orderkey % 7 = 0 THEN NULL ELSE cast(700 + o_orderkey % 3 as int) END AS c FROM {orders}"


def _dividers(fill: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = spark.sql(DIVS, orders=table(spark, sf_dir, "orders"))
        ys = list(layout.interpolated(F.col("a"), F.col("b"), F.col("c")))
        ys = layout.filled(ys, F.lit(1000.0)) if fill else ys
        return d.select(F.col("k").alias("page_idx"), *[y.cast("int").alias(f"y{i + 1}") for i, y in enumerate(ys)])

    return query


INTER = f"(SELECT k, coalesce(a, 2 * b - c) AS a, coalesce(b, CAST(floor((a + c) / 2) AS INT)) AS b, coalesce(c, 2 * b - a) AS c FROM ({DIVS.format(orders='orders')}) d)"
register("div_interpolate", _dividers(False), f"SELECT k AS page_idx, a AS y1, b AS y2, c AS y3 FROM {INTER} i")
register("div_default_fill", _dividers(True), f"SELECT k AS page_idx, coalesce(a, 144 + s) AS y1, coalesce(b, 422 + s) AS y2, coalesce(c, 700 + s) AS y3 FROM (SELECT *, coalesce(a - 144, b - 422, c - 700, 0) AS s FROM {INTER} i) j")

#: A profile of 150 rows for every 150 customers: ink from the nation and the row, white in bands of 14 rows.
PROFILE = "SELECT cast(floor(c_custkey / 150) as int) AS image_id, cast(c_custkey % 150 as int) AS row, cast((c_nationkey * 31 + c_custkey % 150 * 17 + floor(c_custkey % 150 / 13) * 29) % 100 as int) AS ink FROM {customer}"
FULL_PROFILE = "SELECT image_id, row, ink, CASE WHEN (image_id + cast(floor(row / 14) as int)) % 2 = 0 THEN cast(0.99 as double) ELSE cast(0.5 as double) END AS white_frac FROM ({p}) p"


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FULL_PROFILE.format(p=PROFILE), customer=table(spark, sf_dir, "customer"))


PROFILE_SQL = f"({FULL_PROFILE.format(p=PROFILE.format(customer='customer'))})"
RUNS = f"(SELECT image_id, min(row) AS a, max(row) AS b, count(*) AS n FROM (SELECT image_id, row, row - row_number() OVER (PARTITION BY image_id ORDER BY row) AS g FROM {PROFILE_SQL} p WHERE white_frac >= 0.97) q GROUP BY image_id, g)"
register("valley_islands", lambda s, d: layout.valleys(profile(s, d)).select("image_id", "mid"), f"SELECT image_id, CAST(floor((a + b) / 2) AS INT) AS mid FROM {RUNS} r WHERE n >= 10")


#: The images of the profiles, and as many without one.
WIDTHS = "SELECT image_id, 150 AS width FROM (SELECT DISTINCT cast(floor(c_custkey / 150) as int) AS image_id FROM {customer}) i UNION ALL SELECT -1 - image_id, 150 FROM (SELECT DISTINCT cast(floor(c_custkey / 150) as int) AS image_id FROM {customer}) i"


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.columns(profile(spark, sf_dir), spark.sql(WIDTHS, customer=table(spark, sf_dir, "customer")))
    return found.select("image_id", F.array_join(F.col("cuts").cast("array<string>"), ",").alias("cuts"))


register("column_islands", _columns, f"SELECT i.image_id, CASE WHEN m IS NULL THEN '0,50,100,150' ELSE array_to_string(list_sort(list_distinct(list_concat([0, 150], m))), ',') END AS cuts FROM ({WIDTHS.format(customer='customer')}) i LEFT JOIN (SELECT image_id, list(CAST(floor((a + b) / 2) AS INT)) AS m FROM {RUNS} r GROUP BY image_id) q ON i.image_id = q.image_id")
register("win_moving_mean", lambda s, d: profile(s, d).select("image_id", "row", F.bround(layout.moving_mean("ink", "image_id"), 6).alias("mean")), f"SELECT image_id, row, round(sum(ink) OVER (PARTITION BY image_id ORDER BY row ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3.0, 6) AS mean FROM {PROFILE_SQL} p")


def _white(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = profile(spark, sf_dir).select("image_id", (F.lit(30) + F.col("image_id") % 80).cast("int").alias("y")).distinct()
    return layout.snap_whitespace(profile(spark, sf_dir), points)


register("snap_whitespace", _white, f"""SELECT i.image_id, i.y, coalesce(z.snapped, i.y) AS snapped FROM (SELECT DISTINCT image_id, CAST(30 + image_id % 80 AS INT) AS y FROM {PROFILE_SQL} p) i LEFT JOIN (SELECT image_id, row AS snapped, row_number() OVER (PARTITION BY image_id ORDER BY s3 + 24 * abs(row - 30 - image_id % 80), row) AS r
  FROM (SELECT image_id, row, coalesce(lag(ink) OVER w, 0) + ink + coalesce(lead(ink) OVER w, 0) AS s3 FROM {PROFILE_SQL} p WHERE row >= 18 + image_id % 80 AND row < 42 + image_id % 80 WINDOW w AS (PARTITION BY image_id ORDER BY row)) q) z ON i.image_id = z.image_id AND z.r = 1""")

SEGS = "SELECT o_orderkey AS page_idx, 1 AS seg_id, 77 AS x1, cast(100 + o_orderkey % 300 as int) AS y1, 271 AS x2, cast(500 + o_orderkey % 400 as int) AS y2, 750 AS width, 1000 AS height, cast(95 + o_orderkey % 300 as int) AS white_top, cast(505 + o_orderkey % 400 as int) AS white_bottom FROM {orders}"


def segs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SEGS, orders=table(spark, sf_dir, "orders"))


SEG_SQL = f"({SEGS.format(orders='orders')})"
register("snap_bounds", lambda s, d: layout.snap_bounds(segs(s, d), box_rows(s, d)).select("page_idx", "top", "bottom"), f"""SELECT page_idx, greatest(0, CASE WHEN b <= t THEN y1 ELSE t END) AS top, least(1000, CASE WHEN b <= t THEN greatest(y1 + 5, y2) ELSE b END) AS bottom FROM (SELECT s.page_idx, y1, y2,
  CAST(coalesce(floor(min(b.y_min) FILTER (b.n % 5 = 0 AND b.x_min - x1 <= 50 AND abs(b.y_min - y1) <= 50)), any_value(white_top)) AS INT) AS t, CAST(coalesce(floor(max(b.y_max) FILTER (b.text = 'Available' AND abs(b.y_max - y2) <= 50) + 2), any_value(white_bottom)) AS INT) AS b
  FROM {SEG_SQL} s LEFT JOIN {BOX_SQL} b ON s.page_idx = b.page_idx AND b.x_min + b.w / 2 BETWEEN x1 - 10 AND x2 + 10 GROUP BY s.page_idx, y1, y2) q""")
register("seg_nearest_column", lambda s, d: box_rows(s, d).select("page_idx", "n", layout.nearest_column(F.col("x_min"), F.col("width")).alias("col")), f"SELECT page_idx, n, CAST(CASE WHEN abs(x_min - 77) <= abs(x_min - 271) AND abs(x_min - 77) <= abs(x_min - 475) THEN 0 WHEN abs(x_min - 271) <= abs(x_min - 475) THEN 1 ELSE 2 END AS INT) AS col FROM {BOX_SQL} b")
ANCHORED = f"""(SELECT s.page_idx, coalesce(bool_or(b.n % 5 = 0 AND abs(b.y_min - y1) <= 60), false) AS has_rec, coalesce(bool_or(b.text = 'Available' AND (abs(b.y_max - y2) <= 60 OR (b.y_max > y1 + 100 AND b.y_max <= y2 + 10))), false) AS has_avail
  FROM {SEG_SQL} s LEFT JOIN {BOX_SQL} b ON s.page_idx = b.page_idx AND b.x_min + b.w / 2 BETWEEN 77 - 15 AND 271 + 15 GROUP BY s.page_idx)"""
register("seg_anchor_check", lambda s, d: layout.segment_anchors(segs(s, d), box_rows(s, d)).select("page_idx", "has_rec", "has_avail"), f"SELECT * FROM {ANCHORED} a")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.segment_anchors(segs(spark, sf_dir), box_rows(spark, sf_dir))
    one, two = F.struct("has_rec", "has_avail"), F.struct((~F.col("has_rec")).alias("has_rec"), (F.col("page_idx") % 2 == 0).alias("has_avail"))
    pairs = found.select("page_idx", F.when(F.col("page_idx") % 3 == 0, F.array(one)).otherwise(F.array(one, two)).alias("anchors"), F.when(F.col("page_idx") % 3 == 0, "none").otherwise("horizontal").alias("merge_type"))
    return layout.merge_rule(pairs).select("page_idx", "n_kept", "merge_type", "anchor_error")


MERGED = f"""(SELECT page_idx, CASE WHEN page_idx % 3 = 0 THEN 1 WHEN has_rec AND has_avail THEN 1 ELSE 2 END AS n_kept, CASE WHEN page_idx % 3 = 0 OR (has_rec AND has_avail) THEN 'none' ELSE 'horizontal' END AS merge_type,
  CASE WHEN page_idx % 3 = 0 THEN CASE WHEN NOT has_rec THEN 'missing Record Number anchor.' WHEN NOT has_avail THEN 'missing ''Available'' anchor.' END
  ELSE CASE WHEN has_rec AND has_avail THEN NULL WHEN NOT has_rec THEN 'missing Record Number anchor in Segment 1.' WHEN page_idx % 2 <> 0 THEN 'missing ''Available'' anchor in Segment 2.' END END AS anchor_error FROM {ANCHORED} a)"""
register("seg_merge_rule", _merged, f"SELECT * FROM {MERGED} m")


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the plan, of which some have an anchor error and some no text."""
    rows = _merged(spark, sf_dir).select(F.col("page_idx").alias("record_id"), F.concat(F.lit("rec_"), F.col("page_idx").cast("string"), F.lit("_1_row2")).alias("record_no"), F.lit("p.png").alias("image_name"), F.when(F.col("page_idx") % 11 != 5, "text").alias("text"), F.col("anchor_error").alias("error"))
    return quarantine.parted(rows)[1]


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _failed(spark, sf_dir)
    blank = F.size(F.filter(F.array(*[F.col(f"`{c}`") for c in lex.COLUMNS]), lambda v: v == ""))
    review = sinks.failed_review(failed).select("record_id", blank.alias("n_blank"), "VALIDATION_ERRORS")
    log = sinks.failed_log(failed).select("record_id", F.col("RECORD_NO").alias("record_no"), F.col("STATUS").alias("status"), F.col("ERRORS").alias("errors"), F.col("TIMESTAMP").rlike(STAMP_FORM).alias("stamped"))
    return log.join(review.hint("merge"), "record_id")


STAMP_FORM = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"
FAILED = f"(SELECT page_idx AS record_id, coalesce(anchor_error, 'no text was read') AS message FROM {MERGED} m WHERE anchor_error IS NOT NULL OR page_idx % 11 = 5)"
register("err_quarantine", _quarantined, f"""SELECT record_id, 'rec_' || record_id || '_1_row2' AS record_no, 'ERROR' AS status, message AS errors, true AS stamped, CAST(43 AS INT) AS n_blank, message AS "VALIDATION_ERRORS" FROM {FAILED} f""")
register("err_summary", lambda s, d: metrics.summary(bill_stage(s, d, 2), _failed(s, d)), f"SELECT n + m AS total, n - d7 AS passed, d7 + m AS failed FROM {COUNTS}, (SELECT count(*) AS m FROM {FAILED} f) e")


def _pages3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in key order as pages, with dividers from the key."""
    p = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("page_idx"))
    y = F.array(*[F.array(*[(F.lit(v + c) + F.col("page_idx") % 20).cast("int") for v in layout.DEFAULTS]) for c in range(3)])
    return p.select("page_idx", F.concat(F.lit("p"), F.col("page_idx").cast("string")).alias("image_path"), F.lit(750).alias("width"), F.lit(1000).alias("height"), y.alias("y"))


def _plan(orphan: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = layout.plan_segments(_pages3(spark, sf_dir), include_orphan=orphan)
        shown = F.array_join(F.transform("segments", lambda s: F.concat_ws(" ", s["image_path"], s["x1"].cast("string"), s["y1"].cast("string"), s["x2"].cast("string"), s["y2"].cast("string"))), ";")
        return out.select("page_idx", "record_no", "merge_type", shown.alias("segments"))

    return query


def _segment(page: str, c: int, top: str, bottom: str) -> str:
    edge = (77, 271, 475, 670)
    return f"'p' || {page} || ' {edge[c]} ' || ({top}) || ' {edge[c + 1]} ' || ({bottom})"


_rows = []
for _c in range(3):
    _y = [f"{v + _c} + p % 20" for v in layout.DEFAULTS]
    _rows += [f"SELECT p AS page_idx, 'rec_' || p || '_{_c + 1}_row2' AS record_no, 'none' AS merge_type, {_segment('p', _c, _y[0], _y[1])} AS segments FROM pg", f"SELECT p, 'rec_' || p || '_{_c + 1}_row3', 'none', {_segment('p', _c, _y[1], _y[2])} FROM pg"]
    if _c < 2:
        _rows.append(f"SELECT p, 'rec_' || p || '_{_c + 1}_row4_horiz', 'horizontal', {_segment('p', _c, _y[2], '980')} || ';' || {_segment('p', _c + 1, '80', f'{145 + _c} + p % 20')} FROM pg")
_rows.append(f"SELECT p, 'rec_' || p || CASE WHEN nxt THEN '_3_row4_vert' ELSE '_3_row4_tail' END, CASE WHEN nxt THEN 'vertical' ELSE 'none' END, {_segment('p', 2, '702 + p % 20', '980')} || CASE WHEN nxt THEN ';' || {_segment('(p + 1)', 0, '80', '144 + (p + 1) % 20')} ELSE '' END FROM pg")
PLAN_SQL = "WITH pg AS (SELECT o_orderkey + 1 AS p, o_orderkey + 1 IN (SELECT o_orderkey FROM orders) AS nxt FROM orders) " + " UNION ALL ".join(_rows)
register("seg_plan", _plan(False), PLAN_SQL)
register("seg_orphan", _plan(True), f"{PLAN_SQL} UNION ALL SELECT p, 'rec_000_orphan', 'none', {_segment('p', 0, '80', '144 + p % 20')} FROM pg WHERE p = 1")
register("win_next_page", lambda s, d: layout.plan_segments(_pages3(s, d)).where("merge_type = 'vertical'").select("page_idx", F.col("segments")[1]["y2"].alias("next_y")), "SELECT o_orderkey + 1 AS page_idx, CAST(144 + (o_orderkey + 2) % 20 AS INT) AS next_y FROM orders WHERE o_orderkey + 1 IN (SELECT o_orderkey FROM orders)")
register("seg_text_stitch", lambda s, d: layout.stitch_text(table(s, d, "conversations").select("conv_id", F.col("turn").alias("seg_no"), "text"), "conv_id").select("conv_id", F.md5("text").alias("text_md5")), "SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS text_md5 FROM conversations GROUP BY conv_id")

CROPS = "SELECT o_orderkey AS k, cast(20 + o_orderkey % 300 as int) AS height, cast(194 as int) AS width, cast(o_orderkey % 9 as int) AS n_words, 1000 AS page_h, 750 AS page_w, cast(150 + o_orderkey % 700 as int) AS b FROM {orders}"


def _crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.sql(CROPS, orders=table(spark, sf_dir, "orders"))
    out = layout.crop_qa(c.withColumns({"bottoms": F.array("b"), "h_lines": F.array(F.lit(150), F.lit(420), F.lit(700))}))
    return out.select(F.col("k").alias("record_id"), F.round("score", 3).alias("score"), "suspicious", F.array_join("reasons", ",").alias("reasons"))


register("crop_qa", _crops, f"""SELECT record_id, round_even(greatest(0::DOUBLE, 0.4::DOUBLE * hs + 0.3::DOUBLE * (194::DOUBLE / 750::DOUBLE) + 0.3::DOUBLE * ws - 0.15::DOUBLE * bad), 3) AS score, low OR few OR bad > 0 AS suspicious,
  array_to_string(list_filter([CASE WHEN low THEN 'too_short' ELSE '' END, CASE WHEN few THEN 'low_word_count' ELSE '' END, CASE WHEN bad > 0 THEN 'misaligned_with_dividers' ELSE '' END], lambda r: r <> ''), ',') AS reasons
FROM (SELECT k AS record_id, least(1::DOUBLE, height::DOUBLE / greatest(40, height)::DOUBLE) AS hs, CASE WHEN n_words > 0 THEN n_words::DOUBLE / greatest(4, n_words)::DOUBLE ELSE 0::DOUBLE END AS ws, height < 40 AS low, n_words < 4 AS few,
  CASE WHEN (b BETWEEN 200 AND 800 AND least(abs(b - 420), abs(b - 700)) > 80) OR (b NOT BETWEEN 200 AND 800 AND least(abs(b - 150), abs(b - 420), abs(b - 700)) > 80) THEN 1 ELSE 0 END AS bad FROM ({CROPS.format(orders='orders')}) c) q""")


# ---- consistency of prices, and the incremental run
stage_query("prices_agree", 2, lambda d: d.select("record_id", recover.prices_agree().alias("agree")), f"SELECT k AS record_id, CASE WHEN dmg <> 7 THEN true END AS agree FROM {R}")


def _streamed(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> str:
    """Record texts, some of them missing, arrive as files and are routed by a stream; the place of what it wrote."""
    rows = fixtures.record_text(spark, sf_dir).withColumn("text", F.when(F.col("record_id") % 41 != 7, F.col("text")))
    place = store(rows, "stream-source")
    route.route(spark, place, place + "-out", files_per_batch).awaitTermination()
    return place + "-out"


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each record went, and its status in the log."""
    out = _streamed(spark, sf_dir)
    parts = [spark.read.parquet(f"{out}/{name}").select("record_id", F.lit(name).alias("sink")) for name in ("accepted", "review")]
    log = spark.read.parquet(f"{out}/log").select("record_id", F.col("STATUS").alias("status"))
    return parts[0].unionByName(parts[1]).join(log, "record_id")


register("stream_route", _stream, f"SELECT k AS record_id, CASE WHEN dmg = 7 OR k % 41 = 7 THEN 'review' ELSE 'accepted' END AS sink, CASE WHEN k % 41 = 7 THEN 'ERROR' WHEN dmg = 7 THEN 'REVIEW' ELSE 'PASS' END AS status FROM {R}")


def _stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of a stream of several batches, from the counters of its batches: fields, summary and root causes."""
    n_files = 4
    counted = route.counted(spark, _streamed(spark, sf_dir, n_files))
    fields = metrics.recovery_of(counted).select(F.lit("field").alias("of"), F.col("field").alias("name"), "extracted", "recovered", "failed")
    totals = metrics.summary_of(counted).select(F.lit("records").alias("of"), F.lit("all").alias("name"), F.col("passed").alias("extracted"), F.lit(0).cast("long").alias("recovered"), "failed")
    causes = metrics.root_causes_of(counted).select(F.lit("cause").alias("of"), F.col("cause").alias("name"), F.lit(0).cast("long").alias("extracted"), F.lit(0).cast("long").alias("recovered"), F.col("n").alias("failed"))
    return fields.unionByName(totals).unionByName(causes)


READ_COUNTS = COUNTS.replace(f"FROM {R}", f"FROM {R} WHERE k % 41 <> 7")
register("stream_metrics", _stream_metrics, f"""SELECT 'field' AS "of", field AS name, extracted, recovered, failed FROM {METRICS.replace(COUNTS, READ_COUNTS)}
UNION ALL SELECT 'records', 'all', n - d7, 0, d7 + lost FROM {READ_COUNTS}, (SELECT count(*) AS lost FROM {R} WHERE k % 41 = 7) l
UNION ALL SELECT 'cause', 'other', 0, 0, count(*) FROM {R} WHERE dmg = 7 OR k % 41 = 7""")
