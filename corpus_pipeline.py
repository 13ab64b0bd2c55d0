"""A corpus pipeline of five of the training-data operators. Counted as part of tidemark.llm.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode_texts
from tidemark.llm.common import cut, load
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.ngram_join import keep_one_of_each
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.secret_scan import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity of 5-word shingles of 0.8 or more): the least doc_id's."""
    return keep_one_of_each(docs, width=5, num=80, den=100)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of their texts (and n_chars counted anew)."""
    out = redact_secrets(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the decoded text."""
    out = encode_texts(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("secrets", secrets), ("tokens", tokens)]

#: Stages 2, 4 and 5 are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
