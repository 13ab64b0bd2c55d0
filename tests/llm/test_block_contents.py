"""op1's blocks are known by their members: unrelated sets meet in hardly any, sets that link meet in two."""

import numpy as np

from tidemark.llm import ngram_join as J


def keys_of(members, bands):
    return np.unique(np.concatenate(J.block_keys(members, bands)))


def test_unrelated_sets_share_hardly_a_block():
    rng, bands = np.random.default_rng(3), J.Bands(80, 100)
    keys = np.concatenate([keys_of(np.unique(rng.integers(0, 1 << 64, 300, np.uint64)), bands) for _ in range(1500)])
    _, company = np.unique(keys, return_counts=True)
    # what is left are pairs of neighbouring blocks with one member or none in all
    assert company[company > 1].sum() < len(keys) / 200


def test_sets_that_link_agree_in_two_blocks():
    rng = np.random.default_rng(4)
    for num in (80, 85):
        bands, linked = J.Bands(num, 100), 0
        for _ in range(1500):
            a = np.unique(rng.integers(0, 1 << 64, int(rng.integers(5, 300)), np.uint64))
            gone, come = rng.integers(0, len(a) // 7 + 2, 2)
            b = np.unique(np.concatenate([a[np.sort(rng.permutation(len(a))[gone:])], rng.integers(0, 1 << 64, int(come), np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both == len(a) == len(b) or 100 * both < num * (len(a) + len(b) - both):
                continue
            linked += 1
            assert np.intersect1d(keys_of(a, bands), keys_of(b, bands)).size
            pairs = []
            for s in (a, b):
                key, part, count = J.successors(s, bands)
                finer = set(zip(np.repeat(key, count).tolist(), part.tolist()))
                pairs.append(finer | {(k, None) for k in np.setdiff1d(keys_of(s, bands), key).tolist()})
            assert pairs[0] & pairs[1]
        assert linked > 300


def test_documents_without_an_open_block(spark):
    from pyspark.sql import functions as F

    from tests.llm.test_operators import DOCS

    docs = spark.createDataFrame([(d, " ".join(f"w{d}x{i}" for i in range(100))) for d in range(3)], DOCS)
    classes = J.set_ids(docs, 4).groupBy("h1", "h2").agg(F.min(F.xxhash64("doc_id")).alias("rep"))
    opened = classes.select(F.lit(1).cast("long").alias("key"), "h1", F.struct("h1", "h2").alias("label")).localCheckpoint()
    assert J.open_blocks(docs, classes, opened, 4, 85, 100).count() == 0
    assert J.finer_rows(docs, classes, opened, 4, 85, 100).select("key").collect() == [(1,)] * 3
