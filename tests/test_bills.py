"""Composed bills end to end, against what they were composed from."""

import pytest
from pyspark.sql import functions as F

from scriva import queries as q
from scriva.functions import lexicons as lex
from scriva.plans import extract, fixtures, metrics, pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark):
    return q.bills(spark, SF)


def test_final_values(spark, done):
    truth = fixtures.parts(spark, SF).selectExpr("k as record_id", *[f"{e} as `{lex.field(c)}`" for c, e in fixtures.FINAL.items()])
    got = done[2].select("record_id", *[F.coalesce(F.col(f"{lex.field(c)}.value"), F.lit("")).alias(lex.field(c)) for c in fixtures.FINAL])
    assert got.exceptAll(truth.select(*got.columns)).count() == 0 and got.count() == truth.count()


def test_pass_has_no_errors(done):
    assert done[2].where("status = 'PASS' and size(errors) > 0").isEmpty()


def test_metrics_add_up(done):
    n = done[2].count()
    assert metrics.recovery_metrics(done[2]).where(F.col("extracted") + F.col("recovered") + F.col("failed") != n).isEmpty()


def test_a_query_makes_only_the_stages_that_it_reads(spark, monkeypatch):
    made = []
    monkeypatch.setattr(fixtures, "_kept", {})
    monkeypatch.setattr(fixtures, "stored", lambda df, name: made.append(name) or df.limit(0))
    monkeypatch.setattr(pipeline, "second_stage", lambda *a: made.append("second"))
    q.QUERIES["ext_birth_date"](spark, SF)
    assert made == ["bills-prepared", "bills-placed"]
    q.QUERIES["distinct_values"](spark, SF)
    assert made == ["bills-prepared", "bills-placed", "bills-1"]


def test_rows_are_spread_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    sizes = [n for n, in fixtures.spread(spark.range(0, 1500, 1, 6)).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 15 and max(sizes) <= 150


def test_what_a_query_does_not_read_is_not_stored(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(fixtures, "_kept", {})
    monkeypatch.setattr(fixtures, "stored", lambda df, name: made.setdefault(name, df.columns) and df.limit(0))
    q.QUERIES["ext_birth_date"](spark, SF)
    lines = ["record_id", "image_name", "confidence", "lines", "norm_factor"]
    assert made == {"bills-prepared": lines, "bills-placed": [*lines, "rec_no", "i_ship", "i_pol", "i_med"]}


def test_a_value_behind_the_first_is_not_worked_out(spark):
    never = F.raise_error(F.lit("worked out")).cast("string")
    row = spark.range(1).select(F.lit("a").alias("v")).select(extract.chosen((F.col("v"), 0.5), (never, 0.4)).alias("pick")).first()
    assert tuple(row["pick"]) == ("a", 0.5)
