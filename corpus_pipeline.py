"""A corpus pipeline of five stages over the documents table.

Each stage reads all that the one before kept; all but the last return the columns of documents. Stages are written to the
shared folder as Parquet and read again, so a lost executor costs the tasks of one stage at most.

Defined cases: a row is decided by itself or by its text, so that null and repeated doc_ids are allowed. Null and empty texts and
texts without a letter go in the stage language. Of equal texts the one with the most code points stays, then the least doc_id; of
near copies the least doc_id (null last), once. An empty table gives an empty result. Further columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriva.llm import bpe, decontaminate, exact, jaccard, langid
from scriva.llm.common import documents, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is recognised (no letter at all) go."""
    return langid.keep_known(docs, langid.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more) stays."""
    return jaccard.one_of_each(docs, percent=80, words=5)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)"""
    done = bpe.encode(docs.select("doc_id", "text"))
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("exact", exact_copies), ("near", near_copies), ("decontaminate", leaks), ("bpe", tokens)]
#: SQL cannot express the language model; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
