"""The queries of the training-data operators: each applies its operator to its whole table and digests the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import sql
from tidemark.llm.bpe import encode_texts
from tidemark.llm.chat_format import expand, format_conversations, read_turns
from tidemark.llm.common import load
from tidemark.llm.decontaminate import NEAR_SLACK, find_contamination
from tidemark.llm.html_extract import extract_pages
from tidemark.llm.lm_score import score_texts
from tidemark.llm.ngram_join import ngram_jaccard_join
from tidemark.llm.quality_rules import judge
from tidemark.llm.secret_scan import find_secrets
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.url_filter import filter_urls


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_proximity_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact query's columns are those of its SQL; this one has the proximity matches beside them."""
    found = find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), slack=NEAR_SLACK)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.size("near").cast("long").alias("n_near"), F.sha2(F.array_join("near", ","), 256).alias("near_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(load(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return filter_urls(load(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


CONTROL = "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    rows = expand(format_conversations(turns)).groupBy("conv_id").agg(F.max("formatted").alias("formatted"), F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "target")))).alias("examples"))
    out = rows.select("conv_id", read_turns(F.col("formatted")).alias("turns"), F.array_join(F.transform("examples", lambda x: x["target"]), "").alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_texts(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), keep_ids=False)
    return out.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(load(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *[f"verdict.measures.{c}" for c in m], "verdict.base_failed", "verdict.kept")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(load(spark, sf_dir, "documents"), across_words=True).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(load(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_benchmark_decontamination, op2_proximity_matches, op3_secret_scans, op4_url_filters, op5_chat_formatting, op6_bpe_encoding,
    op7_token_counts, op8_quality_rules, op9_lm_scoring, op10_html_extraction, pipeline,
)}
ORACLE_SQL = sql.ORACLE_SQL
