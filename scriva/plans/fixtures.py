"""Tables that queries derive from the given ones: bills composed from orders, boxes of their words, pages, lines, profiles.

The SQL is valid in Spark and in DuckDB, so that an oracle starts from the same rows. Every tenth kind of bill is damaged in
one way; what should be read is kept beside the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriva.functions import lexicons as lex
from scriva.shared import store, stored

__all__ = ["store", "stored"]

FIRST = "John,Mary,David,Linda,James,Susan,Peter,Karen,Frank,Laura"
LAST = "Baker,Turner,Cooper,Foster,Parker,Hughes,Morgan,Bennett"
SHIP_FIRST, SHIP_LAST = "Oscar,Nadia,Victor,Ingrid,Felix", "Zimmer,Quist,Vargas,Lindqvist,Okafor,Ibsen"
STREETS, CITIES, SHIP_CITIES = "Elm Lane,Oak Drive,Mill Road,Hill Court", "Nashville,Memphis,Knoxville,Salt Lake City", "Fresno,Oakland,San Benito,Burbank"
DOMAINS, MEDS, DOSES, CARDS = "aol.com,hotmail.com,gmail.com,comcast.net,netzero.net", "VALIUM,XANAX,DIAZEPAM,AMBIEN,MERIDIA", "5MG,10MG,37.5MG,0.25MG", "Visa,Discover,Retail,Bank"
USUAL = "1MG,0.25MG,0.25MG,10MG,15MG"
HOLDER_FIRST, HOLDER_LAST = "Ruth,Harold,Helen,Walter", "Jones,Lewis,Reed"


def pick(values: str, k: str) -> str:
    return f"split_part('{values}', ',', cast(1 + ({k}) % {values.count(',') + 1} as int))"


def cents(c: str) -> str:
    return f"'$' || cast(cast(floor(({c}) / 100) as bigint) as string) || '.' || lpad(cast(({c}) % 100 as string), 2, '0')"


def num(x: str, width: int = 0) -> str:
    return f"lpad(cast({x} as string), {width}, '0')" if width else f"cast({x} as string)"


FLAG = ["k % 2 = 0", "k % 3 = 0", "k % 5 = 0", "k % 7 = 0", "k % 4 = 0"]
TABS = "30,50,60,90,120,180"

#: One row per order: the parts of its bill. dmg: 5 misspelt medicine, 6 no dose, 7 no prices, 8 broken email, 9 no sex.
PARTS = f"""
SELECT k, k % 10 AS dmg, {num('10000 + k % 20000')} AS rec, {pick(FIRST, 'c')} || ' ' || {pick(LAST, 'c + k')} AS name,
  lower({pick(FIRST, 'c')}) || '.' || lower({pick(LAST, 'c + k')}) AS mail_user, {pick(DOMAINS, 'c')} AS mail_domain,
  {num('10 + k % 80')} || ' ' || {pick(STREETS, 'k')} AS street, {pick(CITIES, 'c')} AS city, {num('37000 + (k * 7) % 200')} AS zip1,
  '(615) ' || {num('200 + k % 700')} || '-' || {num('k % 10000', 4)} AS phone1, CASE WHEN c % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END AS sex,
  {num('1 + k % 12', 2)} || '/' || {num('1 + k % 28', 2)} || '/' || {num('1940 + k % 50')} AS born,
  {num('150 + k % 50')} AS height, {num('100 + k % 150')} AS weight, {pick('A+,A-,B+,B-,AB+,AB-,O+,O-', 'k')} AS blood,
  {pick(SHIP_FIRST, 'k')} || ' ' || {pick(SHIP_LAST, 'c')} AS shipper, {pick(SHIP_CITIES, 'k')} AS city2, {num('93000 + (k * 11) % 600')} AS zip2,
  '(818) ' || {num('300 + k % 600')} || '-' || {num('(k * 3) % 10000', 4)} AS phone2,
  {', '.join(f"CASE WHEN {f} THEN 'YES' ELSE 'NO' END AS flag{i}" for i, f in enumerate(FLAG))},
  'SR_' || {num('40000 + (k * 13) % 30000')} AS policy, {num('1 + k % 9', 2)} || '/' || {num('10 + k % 18')} || '/' || {num('2001 + k % 20')} AS insured,
  {num('100 + k % 400')} || '.50' AS premium, {pick(HOLDER_FIRST, 'k')} || ' ' || {pick(HOLDER_LAST, 'c')} AS holder,
  'BaX_' || {pick(HOLDER_FIRST, 'k')} || '_' || {num('70000 + (k * 17) % 20000')} AS stamp, {num('70000 + (k * 17) % 20000')} AS code,
  {num('1 + k % 12', 2)} || '/' || {num('1 + k % 27', 2)} || '/' || {num('1930 + k % 60')} AS dob, CASE WHEN k % 4 IN (0, 2) THEN 'FEMALE' ELSE 'MALE' END AS sex2,
  {pick(CARDS, 'k')} AS card, {pick(MEDS, 'c')} AS med, {pick(USUAL, 'c')} AS usual, {pick(DOSES, 'k')} AS dose, {pick(TABS, 'k')} AS tabs,
  100 + k % 300 AS rate_c, (100 + k % 300) * cast({pick(TABS, 'k')} as bigint) AS cost_c
FROM (SELECT o_orderkey AS k, o_custkey AS c FROM {{orders}}) o"""

READ = """
SELECT *, CASE WHEN dmg = 8 THEN mail_user || '@yah' ELSE mail_user || '@' || mail_domain END AS mail, CASE WHEN dmg = 5 THEN substr(med, 2) ELSE med END AS med_read,
  CASE WHEN dmg = 6 THEN '' ELSE dose END AS dose_read FROM ({parts}) p"""

NL = "chr(10)"
LINES = [
    "rec || ' ' || name", "mail", "street", "city || ' TN ' || zip1 || ' ' || phone1", "'US ' || CASE WHEN dmg = 9 THEN '' ELSE sex || ' ' END || born",
    "height || ' ' || weight || ' ' || blood", "shipper", "city2 || ' CA ' || zip2 || ' US'", "phone2 || ' ' || flag0 || ' ' || flag1 || ' ' || flag2 || ' ' || flag3 || ' ' || flag4",
    "policy || ' ' || insured || ' $' || premium", "holder || ' ' || stamp", "dob || ' ' || sex2",
    "card || ' ' || med_read || ' ' || CASE WHEN dmg = 6 THEN '' ELSE dose || ' ' END || tabs",
    f"CASE WHEN dmg = 7 THEN '' ELSE {cents('rate_c')} || ' ' || {cents('cost_c')} || ' ' || {cents('2000')} || ' ' || {cents('cost_c + 2000')} END", "'Available'",
]
RECORD_TEXT = f"SELECT k AS record_id, 'page_' || cast(k % 500 as string) || '.png' AS image_name, {f' || {NL} || '.join(LINES)} AS text, cast(0.9 as double) AS confidence FROM ({{read}}) r"

#: What each output column should hold after extraction, and at the end where that differs.
TRUTH = {
    "RECORD NO": "rec", "CUSTOMER NAME": "name", "EMAIL ADDRESS": "CASE WHEN dmg = 8 THEN '' ELSE mail END",
    "RES_ADDRESS": "CASE WHEN dmg = 8 THEN mail || ' ' || street ELSE street END", "CITY_1": "city", "STATE_1": "'TN'", "ZIP_1": "zip1", "PH_NO1": "phone1", "COUNTRY_1": "'US'",
    "SEX_1": "CASE WHEN dmg = 9 THEN '' ELSE sex END", "D BIRTH": "born", "HEIGHT": "height", "WEIGHT": "weight", "BLOOD GP": "blood", "BILLER NAME": "name",
    "SHIPPER NAME": "shipper", "CITY_2": "city2", "STATE_2": "'CA'", "ZIP_2": "zip2", "COUNTRY_2": "'US'", "PH_NO2": "phone2", "ALCOHOLIC": "flag0", "SMOKER": "flag1",
    "PAST SURG": "flag2", "DIABETIC": "flag3", "ALLERGIESED": "flag4", "POLICY NO": "policy", "D_B_LIFE_ASSURE": "insured", "P_INST": "'$' || premium", "NAME_P_HOLDER": "holder",
    "STM NAME": "stamp", "STM CODE": "code", "DOB": "dob", "SEX_2": "sex2", "CARD NAME": "card", "MEDICINE": "med_read", "DOSAGE": "dose_read", "TABLETS": "tabs",
    **{c: f"CASE WHEN dmg = 7 THEN '' ELSE {cents(v)} END" for c, v in (("PILL RATE", "rate_c"), ("COST", "cost_c"), ("SHIPPING CO", "2000"), ("TOTAL AMT", "cost_c + 2000"))},
}
FILLED = "card || ' ' || med || ' ' || dose || ' ' || tabs"
FINAL = TRUTH | {
    "EMAIL ADDRESS": "CASE WHEN dmg = 8 THEN mail_user || '@yahoo.com' ELSE mail END", "SEX_1": "sex", "MEDICINE": "med", "DOSAGE": "CASE WHEN dmg = 6 THEN usual ELSE dose END",
    **{c: f"CASE WHEN dmg = 7 THEN {FILLED} ELSE {cents(v)} END" for c, v in (("PILL RATE", "rate_c"), ("COST", "cost_c"), ("SHIPPING CO", "2000"), ("TOTAL AMT", "cost_c + 2000"))},
}


def parts_sql(orders: str = "orders") -> str:
    """The composed parts, for DuckDB (table orders) or for spark.sql with a frame named orders."""
    return READ.format(parts=PARTS.format(orders=orders))


def records_sql(orders: str = "orders", lines: dict[int, str] | None = None) -> str:
    """The texts of the bills; lines: other expressions for some of their lines."""
    text = RECORD_TEXT
    for k, new in (lines or {}).items():
        text = text.replace(LINES[k], new)
    return text.format(read=parts_sql(orders))


#: A good value of every column, for records that are made without a text.
GOOD = {
    "RECORD NO": "'12345'", "IMAGE NAME": "'p.png'", "CUSTOMER NAME": "'John Baker'", "EMAIL ADDRESS": "'jo@aol.com'", "RES_ADDRESS": "'12 Elm Lane'", "CITY_1": "'Provo'",
    "STATE_1": "'UT'", "ZIP_1": "'84601'", "PH_NO1": "'(615) 423-1077'", "COUNTRY_1": "'US'", "SEX_1": "'MALE'", "D BIRTH": "'01/02/1950'", "HEIGHT": "'170'", "WEIGHT": "'150'",
    "BLOOD GP": "'A+'", "BILLER NAME": "'John Baker'", "SHIPPER NAME": "'Oscar Quist'", "CITY_2": "'Fresno'", "STATE_2": "'CA'", "ZIP_2": "'93701'", "COUNTRY_2": "'US'",
    "PH_NO2": "'(818) 423-1077'", **dict.fromkeys(["ALCOHOLIC", "SMOKER", "PAST SURG", "DIABETIC", "ALLERGIESED"], "'NO'"), "POLICY NO": "'SR_12345'", "D_B_LIFE_ASSURE": "'03/04/2001'",
    "P_INST": "'$150.50'", "NAME_P_HOLDER": "'Ruth Jones'", "STM NAME": "'BaX_Ruth_70001'", "STM CODE": "'70001'", "DOB": "'05/06/1960'", "SEX_2": "'FEMALE'", "CARD NAME": "'Visa'",
    "MEDICINE": "'VALIUM'", "DOSAGE": "'5MG'", "TABLETS": "'90'", "PILL RATE": "'$1.00'", "COST": "'$90.00'", "SHIPPING CO": "'$20.00'", "TOTAL AMT": "'$110.00'",
}
NOTHING = "cast(null as string)"


def fields(spark: SparkSession, sf_dir: str, values: dict[str, str], confidence: dict[str, str] | str = "0.9", **more: str) -> DataFrame:
    """One record per order: good fields but for the values given, as SQL over k and c; more: further columns."""
    of = {c: confidence if isinstance(confidence, str) else confidence.get(c, "0.0") for c in lex.COLUMNS}
    each = [f"named_struct('value', {(GOOD | values)[c]}, 'confidence', cast({of[c]} as double), 'source', 'extracted') AS {lex.field(c)}" for c in lex.COLUMNS]
    each += [f"{e} AS {name}" for name, e in more.items()]
    return spark.sql(f"SELECT k AS record_id, {', '.join(each)} FROM (SELECT o_orderkey AS k, o_custkey AS c FROM {{orders}}) o", orders=spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task in which each makes a bill or a record.
TASK_ROWS = 20_000


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, and over tasks of some thousand rows: rows of a file may lie in one split, however many there are, and each
    makes a bill that takes a while to read. The rows are counted from the footers of the files."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


def record_text(spark: SparkSession, sf_dir: str, lines: dict[int, str] | None = None) -> DataFrame:
    """(record_id, image_name, text, confidence): one bill per order."""
    return spark.sql(records_sql("{orders}", lines), orders=spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(parts_sql("{orders}"), orders=table(spark, sf_dir, "orders"))


_kept: dict[tuple[str, str, str], object] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, make):
    """What several queries start from, made once per application and input: frames over tables in the shared checkpoint folder."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]
