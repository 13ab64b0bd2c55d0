"""op9 looks a part's (context, byte) keys up once each, and broadcasts words by their counts, without a sort of all words."""

import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_lm_contexts import plain_grams
from tidemark.llm import lm_score


def test_text_values_are_sums_over_bytes():
    rng = np.random.default_rng(5)
    texts = [[], [b"a"], [b"\xff\xfe", b"zz"]] + [[bytes(rng.integers(97, 100, int(rng.integers(1, 6))).astype(np.uint8)) for _ in range(int(rng.integers(0, 40)))] for _ in range(60)]
    keys, sizes = lm_score.text_grams(texts)
    plain = [plain_grams(b"".join(w + b" " for w in t) + b"\n") for t in texts]
    assert sizes.tolist() == [len(p) for p in plain]
    assert keys.tolist() == [g for p in plain for g in p]
    known = np.unique(keys)
    values = rng.normal(size=len(known))
    got = lm_score.text_values(keys, sizes, (known, values))
    by_key = dict(zip(known.tolist(), values))
    assert np.allclose(got, [sum(by_key[g] for g in p) for p in plain])


def test_parts_hold_no_more_texts_than_their_numbers(monkeypatch):
    monkeypatch.setattr(lm_score, "TEXT_BITS", 3)
    parts = list(lm_score._parts_of([[] for _ in range(21)]))
    assert [b - a for a, b in parts] == [8, 8, 5] and parts[-1][1] == 21


def test_frequent_words_are_bounded(spark, monkeypatch):
    rows = [(f"w{i}".encode(), c) for i, c in enumerate([0, 0, 1, 1, 1, 2, 5, 5, 900])]
    words = spark.createDataFrame(rows, "word binary, c long")
    for limit, least in ((0, None), (1, 900), (2, 900), (3, 5), (4, 2), (6, 2), (7, 1), (9, 0), (100, 0)):
        monkeypatch.setattr(lm_score, "FREQUENT", limit)
        assert lm_score.least_frequent(words) == least
        assert least is None or words.where(F.col("c") >= least).count() <= limit
