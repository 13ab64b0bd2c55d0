"""op9 beyond its table of (context, byte) values: the most frequent ones stay in the table, only the others are joined."""

import numpy as np
import pytest

from tests.llm.test_operators import DOCS
from tidemark.llm import lm_score


@pytest.mark.parametrize("limit, share", [(100, 0.05), (30, 0.9)])
def test_only_rare_bytes_leave_the_texts(spark, monkeypatch, limit, share):
    rng = np.random.default_rng(23)
    junk = lambda: "".join(rng.choice(list("bcdfghjklmnp"), 6))
    texts = [None, "", junk()] + ["the cat sat on the mat and the dog sat on the cat " * 4 + (junk() if i % 9 == 0 else "") for i in range(90)]
    docs, kept = spark.createDataFrame(list(enumerate(texts)), DOCS), {}
    whole = {r.doc_id: r.score for r in lm_score.score_texts(docs, across_words=True).collect()}
    cut = lm_score.cut
    monkeypatch.setattr(lm_score, "cut", lambda df, label, *a, **b: kept.setdefault(label, cut(df, label, *a, **b)))
    monkeypatch.setattr(lm_score, "GRAM_LIMIT", limit)
    some = {r.doc_id: r.score for r in lm_score.score_texts(docs, across_words=True).collect()}
    assert some == pytest.approx(whole, abs=1e-9)
    assert kept["gram-scores"].count() > limit
    every = sum(len(np.unique(lm_score.text_grams([lm_score.words_of(t)])[0])) for t in texts)
    assert 0 < kept["parts"].where("gram is not null").count() < share * every


def test_text_values_tells_the_keys_that_are_missing():
    texts = [[b"ab", b"ab"], [], [b"zz"]]
    keys, sizes = lm_score.text_grams(texts)
    values = dict(zip(np.unique(keys).tolist(), range(1, 99)))
    for n in (0, 1, 4, len(values)):
        table = np.array([*list(values)[:n], lm_score.BEYOND]), np.array([*list(values.values())[:n], 0.0])
        missed = []
        got = lm_score.text_values(keys, sizes, table, missed)
        assert len(missed) == (n < len(values))
        for i, key, m in missed:
            assert not set(key.tolist()) & set(table[0].tolist())
            got = got + np.bincount(i, m * np.array([values[k] for k in key.tolist()]), len(texts))
        assert got.tolist() == [sum(values[k] for k in g.tolist()) for g in np.split(keys, np.cumsum(sizes)[:-1])]
