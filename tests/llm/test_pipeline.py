"""The pipeline against a plain version of its stages."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_hits, brute_quality, jaccard_components
from tidemark.llm import bpe, quality_rules, secret_scan
from tidemark.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_leaks", "secrets", "tokens"]


def test_run_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    stop = set(quality_rules.STOP_WORDS)
    rows = []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        n, chars, symbols, dup, _, failed = brute_quality(r.text)
        lines = [x for x in r.text.split("\n") if x.strip(" \t\n\v\f\r")]
        words = r.text.split()
        if not failed and 2 <= chars / n <= 20 and symbols / n <= 0.3 and sum(w in stop for w in words) / n >= 0.02 and dup / max(len(lines), 1) <= 0.5:
            rows.append(r)
    _, labels = jaccard_components([r.text for r in rows], 5, 80)
    rows = [r for i, r in enumerate(rows) if labels[i] == i]
    rows = [r for r in rows if not brute_hits(r.text, items, 10)[1]]
    tok = bpe.Tokenizer(open(tokenizer_path("word_bpe_49k.json"), "rb").read())
    want = {}
    for r in rows:
        ids, decoded = tok.encode(secret_scan.redact_text(r.text))
        want[r.doc_id] = (len(ids), ids, hashlib.sha256(" ".join(decoded).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(spark, k):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the of and to " * 30, "en", "s", 1), (3, "the of and to " * 30, "en", "s", 1), (None, "the of and to a b c d e f g h i j k l m n o p q r", "en", "s", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit(True))
    out = corpus_pipeline.STAGES[k][1](spark, d, FOLDER)
    out.count()
    if k < 4:
        assert out.columns == d.columns
    assert corpus_pipeline.STAGES[k][1](spark, d.limit(0), FOLDER).count() == 0


def test_near_duplicates_are_five_words_and_four_fifths(spark):
    """Two words changed apart from each other: 5-word shingles share (n - 14) / (n + 6), 4-word ones (n - 11) / (n + 5)."""

    def pair(n, name):
        a = [f"{name}{i}" for i in range(n)]
        b = list(a)
        b[n // 3] = b[2 * n // 3] = "changed" + name
        return [" ".join(a), " ".join(b)]

    texts = pair(94, "x") + pair(93, "y") + pair(120, "z")  # 0.8 (4 words: 0.838), 0.798, 0.841
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()) == [0, 2, 3, 4]
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id in (1, 255, 582, 875, 709, 944)")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, found, FOLDER).collect()) == [1, 582, 709]
