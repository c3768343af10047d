"""Aggregates over processed records: recovery metrics, summary, error categories, root causes, statistics rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.functions import lexicons as lex

DATES = ["D BIRTH", "D_B_LIFE_ASSURE", "DOB"]
ADDRESS = ["RES_ADDRESS", "CITY_1", "STATE_1", "ZIP_1", "CITY_2", "STATE_2", "ZIP_2"]


def snapshots(done: DataFrame) -> DataFrame:
    """(valid_1, valid_2, valid_3, n): how many records have each three snapshots of validity. Counts of parts add up."""
    return done.groupBy("valid_1", "valid_2", "valid_3").agg(F.count("*").alias("n"))


def recovery_metrics(done: DataFrame) -> DataFrame:
    """(field, extracted, recovered, failed) from the three snapshots of validity, each a long with a bit for each field."""
    return of_snapshots(snapshots(done))


def of_snapshots(counted: DataFrame) -> DataFrame:
    """The recovery metrics of counted snapshots: records alike in all three are one row before their 42 fields are looked at."""
    each = counted.select("n", "valid_1", "valid_2", "valid_3", F.posexplode(F.array(*[F.lit(c) for c in lex.MANDATORY])).alias("k", "field"))
    a, b, c = (F.expr(f"(shiftright(valid_{i}, k) & 1) = 1") for i in (1, 2, 3))
    kind = F.when(~c, "failed").when(a, "extracted").when(b, "recovered").otherwise("failed")
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in ("extracted", "recovered", "failed")]
    return each.select("field", "n", kind.alias("kind")).groupBy("field").agg(*sums)


def summary(done: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """(total, passed, failed); records that failed before they were read count as failed."""
    done = done.select("status")
    if failed is not None:
        done = done.unionByName(failed.select(F.lit("ERROR").alias("status")))
    return done.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") != "PASS").alias("failed"))


def review_categories(done: DataFrame) -> DataFrame:
    """(category, n) among records for review; a record may count in several."""
    both = F.array_union("missing_fields", "format_errors")

    def hits(columns: list[str], where: Column = both) -> Column:
        return F.arrays_overlap(where, F.array(*[F.lit(c) for c in columns]))

    missing = F.col("missing_fields")
    cases = {"Missing blood group": hits(["BLOOD GP"]), "Missing shipper name": hits(["SHIPPER NAME"], missing), "Missing tablets": hits(["TABLETS"], missing), "Date errors": hits(DATES), "Address errors": hits(ADDRESS)}
    one = done.where("status <> 'PASS'").agg(*[F.count_if(v).alias(k) for k, v in cases.items()])
    return one.unpivot([], list(cases), "category", "n")


def root_cause(errors: Column) -> Column:
    up = F.upper(errors)
    listed = [F.when(F.contains(up, F.lit(word)), cause) for word, cause in lex.CAUSES]
    return F.coalesce(*listed, F.when(up.rlike(r"\d") & up.rlike("SR|POLICY"), "policy_holder_parse"), F.lit("other"))


def root_causes(review: DataFrame, errors: str = "VALIDATION_ERRORS", order: str = "record_id") -> DataFrame:
    """(cause, n, first), most frequent first, ties by first row."""
    out = review.select(root_cause(F.coalesce(errors, F.lit(""))).alias("cause"), F.col(order).alias("_o"))
    return out.groupBy("cause").agg(F.count("*").alias("n"), F.min("_o").alias("first")).orderBy(F.desc("n"), "first")


def counters(done: DataFrame, failed: DataFrame, review: DataFrame) -> DataFrame:
    """(kind, name, valid_1, valid_2, valid_3, n, first): what all metrics of some records come from.

    Rows of kind 'snapshot' count records by their three snapshots, 'status' by status (ERROR for those that failed before they
    were read) and 'cause' review rows by root cause, with the first record of each. Counters of disjoint parts of the records add
    up, so that each part of an incremental run keeps its own.
    """
    number, name = F.lit(None).cast("long"), F.lit(None).cast("string")
    shots = snapshots(done).select(F.lit("snapshot").alias("kind"), name.alias("name"), "valid_1", "valid_2", "valid_3", "n", number.alias("first"))
    statuses = done.select("status").unionByName(failed.select(F.lit("ERROR").alias("status"))).groupBy("status").agg(F.count("*").alias("n"))
    statuses = statuses.select(F.lit("status").alias("kind"), F.col("status").alias("name"), *[number.alias(f"valid_{k}") for k in (1, 2, 3)], "n", number.alias("first"))
    causes = root_causes(review).select(F.lit("cause").alias("kind"), F.col("cause").alias("name"), *[number.alias(f"valid_{k}") for k in (1, 2, 3)], "n", F.col("first").cast("long").alias("first"))
    return shots.unionByName(statuses).unionByName(causes)


def recovery_of(counted: DataFrame) -> DataFrame:
    """recovery_metrics from counters."""
    return of_snapshots(counted.where("kind = 'snapshot'"))


def summary_of(counted: DataFrame) -> DataFrame:
    """summary from counters."""
    rows = counted.where("kind = 'status'")
    passed = F.coalesce(F.sum(F.when(F.col("name") == "PASS", F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return rows.agg(total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"))


def root_causes_of(counted: DataFrame) -> DataFrame:
    """root_causes from counters."""
    rows = counted.where("kind = 'cause'").groupBy(F.col("name").alias("cause"))
    return rows.agg(F.sum("n").alias("n"), F.min("first").alias("first")).orderBy(F.desc("n"), "first")


def root_cause_json(causes: DataFrame) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "first", "cause", "n")))
    return causes.agg(F.to_json(F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["cause"], p["n"])))).alias("json"))


def stats(done: DataFrame) -> DataFrame:
    """The statistics rows in order: (ord, METRIC_TYPE, NAME, EXTRACTED_OR_VALUE, RECOVERED_BY_ENGINE, FAILED)."""
    na = F.lit("N/A")
    labels = [("Total Records Processed", "total"), ("Successful Records (PASS)", "passed"), ("Failed Records (Review Required)", "failed")]
    head = summary(done).select(F.inline(F.array(*[F.struct(F.lit(k).alias("ord"), F.lit("SUMMARY").alias("METRIC_TYPE"), F.lit(n).alias("NAME"), F.col(c).cast("string").alias("EXTRACTED_OR_VALUE"), na.alias("RECOVERED_BY_ENGINE"), na.alias("FAILED")) for k, (n, c) in enumerate(labels)])))
    place = F.array_position(F.array(*[F.lit(c) for c in lex.MANDATORY]), F.col("field")) + 2
    rows = recovery_metrics(done).select(place.cast("int").alias("ord"), F.lit("RECOVERY").alias("METRIC_TYPE"), F.col("field").alias("NAME"), *[F.col(a).cast("string").alias(b) for a, b in (("extracted", "EXTRACTED_OR_VALUE"), ("recovered", "RECOVERED_BY_ENGINE"), ("failed", "FAILED"))])
    return head.unionByName(rows).orderBy("ord")
