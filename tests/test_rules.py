"""Single rules on literal cases, and every scalar query against its SQL."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from scriva import queries as q
from scriva.functions import fields as x
from scriva.functions import normalize as norm
from scriva.plans import recover, sections

SF = "/root/testdata/sf0.001"

CASES = [
    (norm.close_dates, "0 7/11/49", "07/11/49"),
    (norm.split_state_zip, "CA26728", "CA 26728"),
    (norm.split_city_state, "AnaheimcA 65847", "Anaheim CA 65847"),
    (norm.split_city_state, "Miami 33101", "Miami 33101"),
    (norm.drop_div0, "#DIV/0$258.00", "$258.00"),
    (norm.split_zip_country, "68489US", "68489 US"),
    (norm.split_zip_phone, "37874423351-1077", "37874 423351-1077"),
    (norm.fix_slashes, "04//07/1955", "04/07/1955"),
    (norm.split_dosage, "DIDREX2.5MG", "DIDREX 2.5MG"),
    (norm.isolate_dates, " 04/07/55", " 04/07/55"),
    (norm.state_token, "30", "30"),
    (recover.repaired_email, "a@yah", "a@yahoo.com"),
    (x.fix_email, "jo@acl.com", "jo@aol.com"),
    (x.tablets, "Visa X 37.5MG 90 $2.87", "90"),
]


def test_literal_cases(spark):
    rows = spark.range(1).select(*[rule(F.lit(given)).alias(f"c{k}") for k, (rule, given, _) in enumerate(CASES)]).first()
    assert list(rows) == [want for _, _, want in CASES]


def test_rules_of_null(spark):
    row = spark.range(1).select(norm.split_lines(F.lit(None).cast("string")).alias("a"), x.word_count(F.lit(None).cast("string")).alias("b")).first()
    assert row["a"] == [] and row["b"] == 0


def canon(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


SOME = ["norm_stamp", "norm_token_subst", "clean_split_email", "fix_state_word", "val_name_noise", "line_cluster_1d", "line_snap_nearest", "div_default_fill", "seg_plan", "seg_merge_rule", "crop_qa", "snap_bounds", "box_line_text", "src_natural_sort", "val_date", "sec_assign", "agg_review_categories", "err_quarantine", "rec_reverse_address", "column_islands", "rec_fuzzy_medicine", "box_column_join", "box_anchor_pick", "box_own_columns", "val_field_validity", "stream_metrics", "rec_price_algebra", "agg_recovery_metrics", "fb_line_map", "rec_policy_stage", "rec_phone_stage", "rec_card_stage", "rec_blood_stage", "rec_glued_stage", "rec_before_dose_stage", "rec_price_stage", "rec_sex_copied", "ext_medication_anywhere", "ext_policy_anywhere", "ext_blood_lone"]


@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    cur = duck.execute(q.SQL[name])
    names = [c[0] for c in cur.description]
    assert set(names) == set(df.columns)
    got = df.select(*[f"`{n}`" for n in names]).collect()
    assert repr(canon(map(tuple, got))) == repr(canon(cur.fetchall()))


def test_names_are_compared_ahead_of_the_shown_section(spark):
    rows = [(["aa", "bb", "John Bakr", "x CA y", "John Baker"], 2), (["aa", "x CA y", "John Baker"], 1), (["John Baker", "John Baker", "cc", "John Baker"], 3), (["aa", "O+", "John Baker"], 2), (["aa"], None), ([], None)]
    table = spark.createDataFrame([(ls, "John Baker", want) for ls, want in rows], "lines array<string>, name string, want int")
    found = sections.boundaries(table)
    assert found.columns == ["lines", "name", "want", "i_ship", "i_pol", "i_med"]
    assert found.where("not (i_ship <=> want)").count() == 0


def test_settled_texts_are_those_that_no_rule_changes(spark):
    settled = ["12345 John Baker\nNashville TN 37001 (615) 423-1077\nUS 01/02/1950", "SR_40013 $100.50\nRuth Jones BaX_Ruth_70001\nVisa VALIUM 2.5MG 30"]
    other = ["#DIV/0$2.00", "68489US", "37874423351-1077", "04//07", "CA26728", "AnaheimcA 65847", "GeorgeUGriffin", "0 7/11/49", "3 /4", "X2.5MG", "born01/02/1950", "01/02/1950x", "ab1", "6154231077", "200-200000", "123456789", "A12", "ca", "x , y", "$ 2", "baX Ruth 70001", "BaX_Ruth_7000A", "BaX_Al_70001 BaX_Bo_70002", "a  b", " a", "a\n\nb", "a\tb", ""]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(settled + other)], "k int, t string")
    found = rows.select("k", norm.is_settled(F.col("t")).alias("s")).collect()
    assert sorted(k for k, s in found if s) == [0, 1]
    done = norm.normalize(rows.select("k", "t", F.split("t", "\n").alias("lines"))).where("k < 2")
    assert [(r.t, r.corrections, r.norm_factor) for r in done.select(F.array_join("lines", "\n").alias("t"), "corrections", "norm_factor").orderBy("k").collect()] == [(t, 0, 1.0) for t in settled]
