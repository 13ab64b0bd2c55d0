"""op9's contexts are of the whole text: words are scored by what stands before them."""

import zlib

import numpy as np
import pytest

from tests.llm.test_operators import DOCS, brute_ctw
from tidemark.llm import lm_score


def plain_grams(text: bytes) -> list[int]:
    padded = b" " * lm_score.DEPTH + text
    return [int.from_bytes(padded[i : i + lm_score.DEPTH + 1], "big") for i in range(len(padded) - lm_score.DEPTH)]


@pytest.mark.parametrize("limit, coded", [(4_000_000, 1 << 20), (4_000_000, 40), (0, 100)])
def test_whole_text_scores_equal_brute_force(spark, monkeypatch, limit, coded):
    monkeypatch.setattr(lm_score, "GRAM_LIMIT", limit)
    monkeypatch.setattr(lm_score, "CODED", coded)
    rng = np.random.default_rng(16)
    texts = [None, "", "a", " ab\tA  b\n"] + [" ".join("".join(rng.choice(list("abcé"), int(rng.integers(1, 4)))) for _ in range(int(rng.integers(0, 20)))) for _ in range(30)]
    whole = [b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n" for t in texts]
    train: dict[bytes, int] = {t: 0 for t in whole}
    for i, t in enumerate(whole):
        train[t] += zlib.crc32(str(i).encode()) % 10 != 0
    got = {r.doc_id: r.score for r in lm_score.score_texts(spark.createDataFrame(list(enumerate(texts)), DOCS), across_words=True).collect()}
    monkeypatch.setattr(lm_score, "grams_of", plain_grams)
    plain = brute_ctw(train, set(whole))
    for i, t in enumerate(whole):
        assert got[i] == pytest.approx(plain[t], abs=1e-7)


def test_the_query_scores_words_in_their_order(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    texts = ["the cat sat on the mat"] * 30 + ["the cat sat on the mat", "mat the on sat cat the"]
    spark.createDataFrame(list(enumerate(texts)), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    r = {x.doc_id: x for x in QUERIES["op9_lm_scoring"](spark, str(tmp_path)).collect()}
    assert r[30].base_score == pytest.approx(r[31].base_score)
    assert r[30].score > r[31].score + 1
