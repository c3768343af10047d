"""The registered queries of the corpus operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriva.llm import bpe, chat, decontaminate, divergence, exact, jaccard, langid, licences, quality, shards, substrings, suffix_dedup, whitening
from scriva.llm.common import documents


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(documents(spark, sf_dir), items)
    joined = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), joined.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact.mark_copies(documents(spark, sf_dir), digests=True)
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(documents(spark, sf_dir), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS c, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
h AS (SELECT doc_id, c, sha256(norm) AS text_sha256 FROM n)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY c DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY c DESC, doc_id) = 1 AS kept, text_sha256
FROM h""",
    "op1_decontaminate": rf"""
WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
i AS (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, s + 1, s + 10) AS win FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0)),
ns AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT doc_id, s, n, list_slice(w, s + 1, s + n) AS win FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, ns WHERE len(w) >= n)),
m AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""",
}

QUERIES = {"op1_decontaminate": op1_decontaminate, "op4_exact_dedup": op4_exact_dedup, "op5_shards": op5_shards}


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"))
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES |= {"op7_bpe": op7_bpe, "op9_language": op9_language}


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir))


QUERIES |= {"op10_jaccard": op10_jaccard}


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return done.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(documents(spark, sf_dir))
    return done.select("doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES |= {"op2_suffix_dedup": op2_suffix_dedup, "op3_substring_dedup": op3_substring_dedup}


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return done.select("conv_id", "n_turns", "n_out", "n_merged", "n_relabelled", "n_inserted", "cost", F.sha2("rendered", 256).alias("rendered_sha256"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), "licence", "kind")


SQL["op8_licences"] = licences.sql()
QUERIES |= {"op6_chat": op6_chat, "op8_licences": op8_licences}


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = quality.predict(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


SQL["op12_divergence"] = divergence.sql()
QUERIES |= {"op11_quality": op11_quality, "op12_divergence": op12_divergence}


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES |= {"op13_whitening": op13_whitening}
QUERIES = dict(sorted(QUERIES.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))
