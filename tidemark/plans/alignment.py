"""Queries of joins and alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import align
from tidemark.operators import kernels as K
from tidemark.operators.robust import guarded_corr
from tidemark.plans.registry import query
from tidemark.tables import load, micros

HOUR = 3_600_000_000
DAY = 24 * HOUR


def _events(spark, d, *kinds) -> DataFrame:
    e = load(spark, d, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("us"))
    return e.where(F.col("event_type").isin(*kinds)) if kinds else e


@query("JN-01", sql=f"""
WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase'),
r AS (SELECT event_id AS view_id, user_id, epoch_us(ts) AS vus FROM events WHERE event_type = 'view'),
m AS (SELECT l.event_id, view_id, abs(us - vus) AS d, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(us - vus), vus, view_id) AS k
  FROM l JOIN r ON l.user_id = r.user_id AND abs(us - vus) <= {6 * HOUR})
SELECT l.event_id, l.user_id, coalesce(m.view_id, -1) AS view_id, m.d AS error_us FROM l LEFT JOIN m ON l.event_id = m.event_id AND m.k = 1
""")  # fmt: skip
def asof_nearest_events(spark: SparkSession, d: str) -> DataFrame:
    """The nearest view of each purchase of the same user, within six hours; ties to the earlier."""
    left = _events(spark, d, "purchase").select("event_id", "user_id", "us")
    right = _events(spark, d, "view").select("user_id", "us", F.struct(F.col("event_id").alias("view_id")).alias("row"))
    out = align.nearest(left, right, ["user_id"], "us", DAY, 6 * HOUR)
    return out.select("event_id", "user_id", F.coalesce("match.row.view_id", F.lit(-1)).alias("view_id"), F.col("distance").alias("error_us"))


@query("JN-02", sql=f"""
WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'view'),
lo AS (SELECT l.event_id, max(r.us) AS us FROM l JOIN r ON l.user_id = r.user_id AND r.us < l.us GROUP BY 1),
up AS (SELECT l.event_id, min(r.us) AS us FROM l JOIN r ON l.user_id = r.user_id AND r.us >= l.us GROUP BY 1),
b AS (SELECT l.*, lo.us AS lus, up.us AS uus, a.value AS lv, c.value AS uv FROM l LEFT JOIN lo USING (event_id) LEFT JOIN up USING (event_id)
  LEFT JOIN r a ON a.user_id = l.user_id AND a.us = lo.us LEFT JOIN r c ON c.user_id = l.user_id AND c.us = up.us)
SELECT event_id, coalesce(uus - lus <= {2 * DAY}, false) AS interpolated,
  round(CASE WHEN uus - lus <= {2 * DAY} THEN (1 - (us - lus) / (uus - lus)) * lv + (us - lus) / (uus - lus) * uv
    WHEN uus IS NULL OR us - lus <= uus - us THEN lv ELSE uv END, 6) AS value,
  CASE WHEN uus - lus <= {2 * DAY} THEN 0 WHEN uus IS NULL OR us - lus <= uus - us THEN us - lus ELSE uus - us END AS error_us,
  round(CASE WHEN uus - lus <= {2 * DAY} THEN least(lv, uv) WHEN uus IS NULL OR us - lus <= uus - us THEN lv ELSE uv END, 6) AS confidence
FROM b
""")  # fmt: skip
def bracket_interpolate(spark: SparkSession, d: str) -> DataFrame:
    """Value at each purchase between the user's views around it, where they are at most two days apart; else the
    nearest one's value, however far, with its error. An exact hit brackets with the row before it."""
    left = _events(spark, d, "purchase").select("event_id", "user_id", "us")
    right = _events(spark, d, "view").select("user_id", "us", F.struct("value").alias("row"))
    n = align.neighbours(left, right, ["user_id"], "us", DAY)
    span = F.col("upper.at") - F.col("lower.at")
    inside = F.coalesce((span > 0) & (span <= 2 * DAY), F.lit(False))
    alpha = F.try_divide((F.col("us") - F.col("lower.at")).cast("double"), span.cast("double"))
    below, above = F.col("us") - F.col("lower.at"), F.col("upper.at") - F.col("us")
    low = F.col("upper").isNull() | (F.col("lower").isNotNull() & (below <= above))
    near, error = F.when(low, F.col("lower.row.value")).otherwise(F.col("upper.row.value")), F.when(low, below).otherwise(above)
    between = align.bracketed(alpha, F.col("lower.row.value"), F.col("upper.row.value"))
    return n.select(
        "event_id", inside.alias("interpolated"), F.round(F.when(inside, between).otherwise(near), 6).alias("value"), F.when(inside, F.lit(0)).otherwise(error).cast("long").alias("error_us"),
        F.round(F.when(inside, F.least("lower.row.value", "upper.row.value")).otherwise(near), 6).alias("confidence"),
    )


_MODEL = "CASE WHEN user_id % 3 = 0 THEN 'CLOCK_DRIFT_DETECTED' WHEN user_id % 3 = 1 THEN 'CONSTANT_OFFSET' ELSE 'STABLE' END"


@query("JN-03", sql=f"""
WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us FROM events),
span AS (SELECT user_id, min(us) AS a, max(us) AS b, {_MODEL} AS kind, (user_id % 7) * 1000000 AS offset_us, (user_id % 5) * 100 AS drift_ppm FROM e GROUP BY user_id),
l AS (SELECT e.event_id, e.user_id, us + CASE WHEN kind = 'STABLE' THEN 0 ELSE offset_us END
    + CASE WHEN kind = 'CLOCK_DRIFT_DETECTED' THEN CAST(floor(drift_ppm * (us - a - (b - a) / 2) / 1000000) AS BIGINT) ELSE 0 END AS us FROM e JOIN span USING (user_id) WHERE event_type = 'click'),
r AS (SELECT event_id AS other, user_id, us AS rus FROM e WHERE event_type = 'view'),
m AS (SELECT l.event_id, l.us, other, abs(us - rus) AS d, row_number() OVER (PARTITION BY event_id ORDER BY abs(us - rus), rus, other) AS k FROM l JOIN r USING (user_id))
SELECT event_id, us AS corrected_us, other, d AS error_us FROM m WHERE k = 1
""".replace("(b - a) / 2", "(b - a) // 2").replace("/ 1000000)", "/ 1000000.0)"))  # fmt: skip
def drift_corrected_pairing(spark: SparkSession, d: str) -> DataFrame:
    """Each click, moved by its user's offset and, in the drift class only, by the drift around the middle of the
    series, is paired with the nearest view, however far."""
    e = _events(spark, d)
    kind = F.expr(_MODEL)
    model = e.groupBy("user_id").agg(F.min("us").alias("a"), F.max("us").alias("b")).withColumn("kind", kind)
    model = model.withColumn("offset_us", F.expr("(user_id % 7) * 1000000")).withColumn("ppm", F.expr("(user_id % 5) * 100"))
    move = F.when(F.col("kind") != "STABLE", F.col("offset_us")).otherwise(0) + F.when(F.col("kind") == "CLOCK_DRIFT_DETECTED", F.expr("cast(floor(ppm * (us - a - (b - a) div 2) / 1000000D) as bigint)")).otherwise(0)
    left = e.where("event_type = 'click'").join(model, "user_id").select("event_id", "user_id", (F.col("us") + move).alias("us"))
    right = e.where("event_type = 'view'").select("user_id", "us", F.struct(F.col("event_id").alias("other")).alias("row"))
    out = align.nearest(left, right, ["user_id"], "us", DAY)
    return out.where("match is not null").select("event_id", F.col("us").alias("corrected_us"), F.col("match.row.other").alias("other"), F.col("distance").alias("error_us"))


@query("JN-04", sql=f"""
WITH l AS (SELECT event_id, user_id, value, epoch_us(ts) AS us FROM events WHERE event_type = 'signup'),
r AS (SELECT event_id AS other, user_id, value AS v, epoch_us(ts) AS rus FROM events WHERE event_type = 'click'),
m AS (SELECT l.event_id, other, abs(value - v) AS cost, row_number() OVER (PARTITION BY event_id ORDER BY abs(value - v), other) AS k
  FROM l JOIN r ON l.user_id = r.user_id AND rus BETWEEN us - {12 * HOUR} AND us + {12 * HOUR}),
t AS (SELECT a.event_id, a.other, a.cost, b.cost - a.cost AS margin FROM m a LEFT JOIN m b ON a.event_id = b.event_id AND b.k = 2 WHERE a.k = 1)
SELECT event_id, other, round(cost, 6) AS cost, round(margin, 6) AS margin, round(coalesce(least(greatest(margin / 100, 0), 1), 1), 6) AS confidence FROM t
""")  # fmt: skip
def band_join_topmargin(spark: SparkSession, d: str) -> DataFrame:
    """Of a user's clicks within twelve hours of a signup the one closest in value, its margin over the runner-up and a
    confidence from it."""
    left, right = _events(spark, d, "signup").select("event_id", "user_id", "us", "value"), _events(spark, d, "click").select("event_id", "user_id", "us", "value")
    pairs = align.band(left, right, ["user_id"], "us", 12 * HOUR).select(F.col("l.event_id").alias("event_id"), F.col("r.event_id").alias("other"), F.abs(F.col("l.value") - F.col("r.value")).alias("cost"))
    w = W.partitionBy("event_id").orderBy("cost", "other")
    top = pairs.withColumn("k", F.row_number().over(w)).withColumn("margin", F.lead("cost").over(w) - F.col("cost")).where("k = 1")
    confidence = F.coalesce(F.least(F.greatest(F.col("margin") / 100, F.lit(0.0)), F.lit(1.0)), F.lit(1.0))
    return top.select("event_id", "other", F.round("cost", 6).alias("cost"), F.round("margin", 6).alias("margin"), F.round(confidence, 6).alias("confidence"))


@query("JN-05", sql="""
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS mapped FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")  # fmt: skip
def lookup_with_fill(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = load(spark, d, "documents").select("doc_id"), load(spark, d, "labels").withColumn("hit", F.lit(True))
    out = docs.join(labels, "doc_id", "left")
    return out.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), F.col("hit").isNotNull().alias("mapped"))


@query("JN-06", "AG-13", sql=r"""
WITH f AS (
  SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END + CASE WHEN coalesce(l.quality, 1) = 0 THEN 2 ELSE 0 END + CASE WHEN coalesce(l.toxic, 0) = 1 THEN 4 ELSE 0 END
    + CASE WHEN n_chars < 400 THEN 8 ELSE 0 END + CASE WHEN b.doc_id IS NOT NULL THEN 16 ELSE 0 END AS mask
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN (SELECT conv_id AS doc_id FROM conversations GROUP BY 1 HAVING count(*) >= 6) b ON b.doc_id = d.doc_id)
SELECT source, count(*) AS frames, count(*) FILTER (WHERE mask = 0) AS passed, count(*) FILTER (WHERE mask <> 0) AS review, CAST(bit_or(mask) AS BIGINT) AS seen,
  count(*) FILTER (WHERE mask & 1 <> 0) AS b0, count(*) FILTER (WHERE mask & 2 <> 0) AS b1, count(*) FILTER (WHERE mask & 4 <> 0) AS b2, count(*) FILTER (WHERE mask & 8 <> 0) AS b3, count(*) FILTER (WHERE mask & 16 <> 0) AS b4
FROM f GROUP BY source
""")  # fmt: skip
def star_quality(spark: SparkSession, d: str) -> DataFrame:
    """Evidence bits of each document from three sources, OR-ed and counted by source."""
    from tidemark.functions.status import bitmask

    docs, labels = load(spark, d, "documents").select("doc_id", "source", "n_chars"), load(spark, d, "labels").withColumn("known", F.lit(True))
    long = load(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).count().where("count >= 6").select("doc_id", F.lit(True).alias("long"))
    j = docs.join(labels, "doc_id", "left").join(long, "doc_id", "left")
    mask = bitmask(F.col("known").isNull(), F.coalesce("quality", F.lit(1)) == 0, F.coalesce("toxic", F.lit(0)) == 1, F.col("n_chars") < 400, F.col("long").isNotNull())
    j = j.withColumn("mask", mask)
    bits = [F.count_if(F.col("mask").bitwiseAND(1 << i) != 0).alias(f"b{i}") for i in range(5)]
    return j.groupBy("source").agg(F.count("*").alias("frames"), F.count_if(F.col("mask") == 0).alias("passed"), F.count_if(F.col("mask") != 0).alias("review"), F.bit_or("mask").alias("seen"), *bits)


@query("JN-07", sql="""
SELECT a.l_orderkey, a.l_linenumber AS i, b.l_linenumber AS j, round(abs(a.l_extendedprice - b.l_extendedprice), 4) AS gap
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
""")  # fmt: skip
def pair_selfjoin(spark: SparkSession, d: str) -> DataFrame:
    """Unordered pairs of lines within an order."""
    x = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    a, b = x.alias("a"), x.alias("b")
    return a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_linenumber") < F.col("b.l_linenumber"))).select(
        F.col("a.l_orderkey").alias("l_orderkey"), F.col("a.l_linenumber").alias("i"), F.col("b.l_linenumber").alias("j"), F.round(F.abs(F.col("a.l_extendedprice") - F.col("b.l_extendedprice")), 4).alias("gap"),
    )


@query("JN-08", sql="""
WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance FROM p a JOIN p b ON a.vec_id < b.vec_id
WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.05
""")  # fmt: skip
def radius_join(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return align.radius_pairs(p, "vec_id", ["x", "y"], 0.05).withColumn("distance", F.round("distance", 6))


@query("JN-08", sql="""
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
d AS (SELECT a.vec_id AS a, b.vec_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS s FROM p a JOIN p b ON a.label = b.label AND a.vec_id < b.vec_id)
SELECT a, b, round(s, 6) AS distance FROM d WHERE s <= 0.15
""")  # fmt: skip
def ball_query(spark: SparkSession, d: str) -> DataFrame:
    """Pairs within a ball in three dimensions, inside a label."""
    e = F.col("embedding")
    p = load(spark, d, "embeddings").select("vec_id", "label", *[e[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    return align.radius_pairs(p, "vec_id", ["x", "y", "z"], 0.15, ["label"]).withColumn("distance", F.round("distance", 6))


@query("JN-09", "SO-05", sql="""
WITH d AS (SELECT a.vec_id AS a, b.vec_id AS b, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))) AS s
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s, b) AS r FROM d),
g AS (SELECT x.a, x.b, x.s, y.s AS s2 FROM k x JOIN k y ON x.a = y.a AND y.r = 2 WHERE x.r = 1 AND x.s < 0.95 * y.s),
u AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY s, a) AS q FROM g)
SELECT a, b, round(s, 5) AS distance, round(s2, 5) AS second FROM u WHERE q = 1
""")  # fmt: skip
def knn2_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Nearest vector of the same label where it passes the ratio test against the second; one match for each target."""
    k = align.nearest_vectors(load(spark, d, "embeddings"), "vec_id", "embedding", ["label"], 2)
    two = k.groupBy("a").agg(F.min_by("b", "rank").alias("b"), F.min("distance").alias("s"), F.max(F.when(F.col("rank") == 2, F.col("distance"))).alias("s2"))
    good = two.where("s < 0.95 * s2")
    best = good.groupBy("b").agg(F.min_by(F.struct("a", "s", "s2"), F.struct("s", "a")).alias("m"))
    return best.select("m.a", "b", F.round("m.s", 5).alias("distance"), F.round("m.s2", 5).alias("second"))


@query("JN-10", sql="SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_orders(spark: SparkSession, d: str) -> DataFrame:
    done = load(spark, d, "orders").where("o_orderstatus = 'F'")
    return load(spark, d, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("JN-11", sql="SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_orders(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").join(load(spark, d, "orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("JN-12", sql="""
WITH a AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'OPEN' ELSE o_orderstatus END AS status, o_custkey % 7 AS owner FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_custkey % 7 END AS owner FROM orders WHERE o_orderkey % 17 <> 0),
j AS (SELECT coalesce(a.k, b.k) AS k, a.k AS ak, b.k AS bk, a.status AS s1, b.status AS s2, a.owner AS o1, b.owner AS o2 FROM a FULL JOIN b ON a.k = b.k)
SELECT k, 'MISSING_RIGHT' AS reason FROM j WHERE bk IS NULL UNION ALL SELECT k, 'MISSING_LEFT' FROM j WHERE ak IS NULL
UNION ALL SELECT k, 'MISMATCH_status' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND s1 IS DISTINCT FROM s2
UNION ALL SELECT k, 'MISMATCH_owner' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND o1 IS DISTINCT FROM o2
""")  # fmt: skip
def full_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Two inventories made from the orders (with planted losses and changes) compared; a row for each fault."""
    from tidemark.operators.contracts import reconcile

    o = load(spark, d, "orders")
    a = o.where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("k"), F.expr("case when o_orderstatus = 'P' then 'OPEN' else o_orderstatus end").alias("status"), F.expr("o_custkey % 7").alias("owner"))
    b = o.where("o_orderkey % 17 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.expr("case when o_orderkey % 13 = 0 then 0L else o_custkey % 7 end").alias("owner"))
    return reconcile(a, b, ["k"], ["status", "owner"])


@query("JN-14", sql="""
WITH clip AS (SELECT conv_id, min(turn) + 1 AS s, least(min(turn) + 3, max(turn)) AS e FROM conversations GROUP BY 1)
SELECT c.conv_id, c.turn, coalesce(c.turn BETWEEN clip.s AND clip.e, false) AS marked FROM conversations c LEFT JOIN clip ON c.conv_id = clip.conv_id
""")  # fmt: skip
def range_mark(spark: SparkSession, d: str) -> DataFrame:
    """Turns inside a conversation's clip [start, end], clamped to the conversation."""
    c = load(spark, d, "conversations").select("conv_id", "turn")
    clip = c.groupBy("conv_id").agg((F.min("turn") + 1).alias("s"), F.least(F.min("turn") + 3, F.max("turn")).alias("e")).where("s <= e")
    marked = clip.select("conv_id", F.explode(F.sequence("s", "e")).alias("turn"), F.lit(True).alias("hit"))
    return c.join(marked, ["conv_id", "turn"], "left").select("conv_id", "turn", F.col("hit").isNotNull().alias("marked"))


_WINDOWS = """
span AS (SELECT user_id, min(us) AS a, max(us) AS b FROM e GROUP BY 1),
win AS (SELECT user_id, i, CAST(floor(a + (b - a) * (i + 0.5) / 7 - greatest((b - a) / 3, 1) / 2) AS BIGINT) AS s, CAST(floor(a + (b - a) * (i + 0.5) / 7 + greatest((b - a) / 3, 1) / 2) AS BIGINT) AS t FROM span, (SELECT unnest(range(7)) AS i))
"""


@query("WN-12", "JN-15", sql=f"""
WITH e AS (SELECT event_id, user_id, value, epoch_us(ts) AS us FROM events), {_WINDOWS}
SELECT win.user_id, CAST(win.i AS INTEGER) AS i, count(e.event_id) AS n, round(avg(value), 6) AS mean FROM win LEFT JOIN e ON e.user_id = win.user_id AND us >= s AND us < t GROUP BY 1, 2
""")  # fmt: skip
def window_membership(spark: SparkSession, d: str) -> DataFrame:
    """Seven evenly spaced overlapping windows over each user's series, a third of it wide, and the samples in [start, end)."""
    e = _events(spark, d).select("user_id", "us", "value")
    span = e.groupBy("user_id").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    i = span.select("user_id", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"))
    half = F.expr("greatest((b - a) / 3D, 1D) / 2")
    mid = F.expr("a + (b - a) * (i + 0.5D) / 7")
    win = i.select("user_id", "i", F.floor(mid - half).cast("long").alias("s"), F.floor(mid + half).cast("long").alias("t"))
    pairs = align.points_in_intervals(e, win, ["user_id"], "us", "s", "t", 5 * DAY, closed=False).select("i.user_id", "i.i", "p.value")
    got = pairs.groupBy("user_id", "i").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return win.select("user_id", "i").join(got, ["user_id", "i"], "left").select("user_id", "i", F.coalesce("n", F.lit(0)).alias("n"), F.round("mean", 6).alias("mean"))


@query("JN-16", "AG-16", sql="""
WITH day AS (SELECT DISTINCT epoch_us(ts) // 86400000000 AS k FROM events), ser AS (SELECT event_type, epoch_us(ts) // 86400000000 AS k, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
x AS (SELECT d.k, coalesce(a.n, 0) AS v FROM day d LEFT JOIN ser a ON a.k = d.k AND a.event_type = 'view'), y AS (SELECT d.k, coalesce(a.n, 0) AS v FROM day d LEFT JOIN ser a ON a.k = d.k AND a.event_type = 'purchase'),
p AS (SELECT lag, x.v AS a, y.v AS b FROM (SELECT unnest(range(-6, 7)) AS lag) l JOIN x ON true JOIN y ON y.k = x.k + lag)
SELECT CAST(lag AS INTEGER) AS lag, count(*) AS n, round(CASE WHEN var_pop(a) > 1e-12 AND var_pop(b) > 1e-12 THEN (avg(a * b) - avg(a) * avg(b)) / sqrt(var_pop(a) * var_pop(b)) ELSE 0 END, 6) AS r FROM p GROUP BY 1
""")  # fmt: skip
def lag_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of daily views and purchases at every lag of -6 to 6 days."""
    e = _events(spark, d).select("event_type", F.expr("us div 86400000000").alias("k"))
    wide = e.groupBy("k").agg(F.count_if(F.col("event_type") == "view").cast("double").alias("a"), F.count_if(F.col("event_type") == "purchase").cast("double").alias("b"))
    x = wide.select("a", F.explode(F.sequence(F.lit(-6), F.lit(6))).alias("lag"), "k").select("lag", "a", (F.col("k") + F.col("lag")).alias("k"))
    return x.join(wide.select("k", "b"), "k").groupBy("lag").agg(F.count("*").alias("n"), F.round(guarded_corr("a", "b"), 6).alias("r"))


@query("JN-17", sql="""
SELECT a.s_suppkey, a.s_nationkey, round(CASE WHEN m = 0 AND a.s_acctbal = 0 THEN 1 WHEN m = 0 THEN NULL ELSE a.s_acctbal / m END, 6) AS ratio
FROM supplier a LEFT JOIN (SELECT x.s_suppkey, median(y.s_acctbal) AS m FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey AND x.s_suppkey <> y.s_suppkey GROUP BY 1) p ON p.s_suppkey = a.s_suppkey
""")  # fmt: skip
def peer_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Own balance over the median of the other suppliers of the nation. The median of the others is read off the
    group's ranks, so that no pairs are made."""
    s = load(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    w = W.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey")
    r = s.withColumn("k", F.row_number().over(w)).withColumn("n", F.count("*").over(W.partitionBy("s_nationkey")))
    at = r.select("s_nationkey", F.col("k").alias("place"), F.col("s_acctbal").alias("v"))
    # places of the middle values once the own row is left out
    lo, hi = F.expr("(n - 1 + 1) div 2"), F.expr("(n - 1 + 2) div 2")
    skip = lambda p: p + F.when(p >= F.col("k"), 1).otherwise(0)
    asked = r.where("n > 1").select("s_suppkey", "s_nationkey", F.explode(F.array(skip(lo), skip(hi))).alias("place"))
    med = asked.join(at, ["s_nationkey", "place"]).groupBy("s_suppkey").agg(F.avg("v").alias("m"))
    ratio = F.when((F.col("m") == 0) & (F.col("s_acctbal") == 0), 1.0).otherwise(F.try_divide("s_acctbal", "m"))
    return s.join(med, "s_suppkey", "left").select("s_suppkey", "s_nationkey", F.round(ratio, 6).alias("ratio"))


@query("JN-18", "JN-19", sql="""
WITH dev AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3),
c AS (SELECT c_custkey, c_nationkey, coalesce(n_name, 'UNKNOWN') AS device, coalesce(r_name, 'UNKNOWN') AS region, c_mktsegment FROM customer LEFT JOIN dev ON c_nationkey = n_nationkey)
SELECT device, region, count(*) AS n, count(DISTINCT c_mktsegment) AS segments, count(DISTINCT c_mktsegment) > 1 AS conflict FROM c GROUP BY 1, 2
""")  # fmt: skip
def enrich_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Dimension lookups with UNKNOWN for misses, and whether a device stands for several segments."""
    dev = load(spark, d, "nation").where("n_nationkey <> 3").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    c = load(spark, d, "customer").join(dev, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    g = c.groupBy(F.coalesce("n_name", F.lit("UNKNOWN")).alias("device"), F.coalesce("r_name", F.lit("UNKNOWN")).alias("region"))
    return g.agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("segments"), (F.count_distinct("c_mktsegment") > 1).alias("conflict"))


@query("JN-20", sql="""
WITH c AS (SELECT c_custkey AS ord, c_nationkey AS g, CAST(round(c_acctbal) AS BIGINT) AS x, c_custkey * 7919 % 1000 AS y FROM customer)
SELECT b.ord, count(*) AS dominates FROM c a JOIN c b ON a.g = b.g AND a.ord < b.ord AND b.x <= a.x AND b.y <= a.y AND (b.x < a.x OR b.y < a.y) GROUP BY 1
""")  # fmt: skip
def dominance(spark: SparkSession, d: str) -> DataFrame:
    """Earlier queue items of a nation that a later one dominates in both costs."""
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_nationkey").alias("g"), F.round("c_acctbal").cast("long").alias("x"), F.expr("c_custkey * 7919 % 1000").alias("y"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ord": pdf["ord"], "n": K.earlier_dominating(*(pdf[k].to_numpy(np.int64) for k in ("ord", "x", "y")))})

    counts = K.grouped(c.dropna(), ["g"], run, "ord long, n long").where("n > 0")
    return counts.groupBy("ord").agg(F.sum("n").alias("dominates"))


@query("JN-21", "CN-11", sql="""
WITH a AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding) AS v FROM embeddings), b AS (SELECT vec_id, i, CASE WHEN vec_id % 50 = 0 AND i = 3 THEN v + CAST(0.5 AS FLOAT) ELSE v END AS v FROM a WHERE NOT (vec_id % 40 = 0 AND i = 63))
SELECT coalesce(a.vec_id, b.vec_id) AS vec_id, count(*) FILTER (WHERE a.v IS DISTINCT FROM b.v) AS unequal, round(max(abs(CAST(a.v AS DOUBLE) - b.v)), 6) AS most, bool_and(a.v IS NOT DISTINCT FROM b.v) AS equal
FROM a FULL JOIN b ON a.vec_id = b.vec_id AND a.i = b.i GROUP BY 1
""")  # fmt: skip
def cell_equality(spark: SparkSession, d: str) -> DataFrame:
    """Two array sets compared cell by cell; missing cells and NaN count as values."""
    e = load(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    b = e.where("not (vec_id % 40 = 0 and i = 63)").withColumn("v", F.when(F.expr("vec_id % 50 = 0 and i = 3"), F.col("v") + F.lit(0.5).cast("float")).otherwise(F.col("v")))
    j = e.withColumnRenamed("v", "a").join(b.withColumnRenamed("v", "b"), ["vec_id", "i"], "full")
    same = F.col("a").eqNullSafe(F.col("b"))
    return j.groupBy("vec_id").agg(F.count_if(~same).alias("unequal"), F.round(F.max(F.abs(F.col("a").cast("double") - F.col("b"))), 6).alias("most"), F.bool_and(same).alias("equal"))


@query("JN-22", sql=f"""
WITH a AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'click'), b AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'view'),
m AS (SELECT a.user_id, a.value AS v, b.value AS w, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.us - b.us), b.us) AS k FROM a JOIN b ON a.user_id = b.user_id AND abs(a.us - b.us) <= {6 * HOUR})
SELECT user_id, count(*) AS n, round(median(abs(v - w)), 6) AS distance FROM m WHERE k = 1 GROUP BY 1
""")  # fmt: skip
def aligned_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Values compared only at matched sample pairs: count and median distance."""
    left = _events(spark, d, "click").select("user_id", "us", "value")
    right = _events(spark, d, "view").select("user_id", "us", F.struct("value").alias("row"))
    m = align.nearest(left, right, ["user_id"], "us", DAY, 6 * HOUR).where("match is not null")
    return m.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.percentile(F.abs(F.col("value") - F.col("match.row.value")), 0.5), 6).alias("distance"))


@query("JN-23", "AG-16", "ST-02", sql="""
WITH s AS (SELECT event_type, epoch_us(ts) // 86400000000 AS k, sum(value) AS v FROM events GROUP BY 1, 2),
p AS (SELECT a.event_type AS a, b.event_type AS b, a.v AS x, b.v AS y FROM s a JOIN s b ON a.k = b.k AND a.event_type < b.event_type)
SELECT a, b, count(*) AS n, round(CASE WHEN var_pop(x) > 1e-12 AND var_pop(y) > 1e-12 THEN (avg(x * y) - avg(x) * avg(y)) / sqrt(var_pop(x) * var_pop(y)) ELSE 0 END, 5) AS r FROM p GROUP BY 1, 2 HAVING count(*) >= 20
""")  # fmt: skip
def shared_key_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Series of daily sums paired on shared days; pairs with under 20 shared days are left out."""
    s = _events(spark, d).groupBy("event_type", F.expr("us div 86400000000").alias("k")).agg(F.sum("value").alias("v"))
    a, b = s.select("k", F.col("event_type").alias("a"), F.col("v").alias("x")), s.select("k", F.col("event_type").alias("b"), F.col("v").alias("y"))
    return a.join(b, "k").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"), F.round(guarded_corr("x", "y"), 5).alias("r")).where("n >= 20")


@query("JN-24", "FN-25", sql="""
WITH r AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_linenumber) AS v FROM lineitem GROUP BY 1)
SELECT k, CAST(k % 3 AS BIGINT) AS wanted, v[k % 3 + 1] AS got, len(v) > k % 3 AS inside FROM r
""")  # fmt: skip
def gather_by_index(spark: SparkSession, d: str) -> DataFrame:
    """Ragged rows gathered by an index into their slice; an index beyond the slice is told. Lines of one number, whose
    order the SQL leaves open, are in the order of the file; places are counted from the end where an index is negative."""
    at = ["l_linenumber", "_metadata.file_path", "_metadata.row_index"]
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", *[F.col(c).alias(f"at{i}") for i, c in enumerate(at)])
    first = W.partitionBy("l_orderkey").orderBy(F.asc_nulls_last("at0"), "at1", "at2")
    x = lines.withColumn("i", F.row_number().over(first) - 1)
    wanted = F.col("l_orderkey") % 3
    g = x.groupBy(F.col("l_orderkey").alias("k")).agg(F.max(F.when(F.col("i") == wanted, F.col("l_partkey"))).alias("got"), F.max_by("l_partkey", "i").alias("last"), F.count("*").alias("n"))
    got = F.when(F.col("k") % 3 == -2, F.col("last")).otherwise(F.col("got"))
    return g.select("k", (F.col("k") % 3).alias("wanted"), got.alias("got"), (F.col("n") > F.col("k") % 3).alias("inside"))


@query("JN-25", sql="""
WITH v AS (SELECT user_id, event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) - 1 AS f FROM events),
n AS (SELECT user_id, min(c) AS c FROM (SELECT user_id, event_type, count(*) AS c FROM v GROUP BY 1, 2) GROUP BY 1 HAVING count(*) = 5),
a AS (SELECT v.user_id, v.f, count(*) FILTER (WHERE value_ok) AS visible, max(us) - min(us) AS spread FROM (SELECT *, us % 3 <> 0 AS value_ok FROM v) v JOIN n ON n.user_id = v.user_id AND v.f < n.c GROUP BY 1, 2)
SELECT visible, count(*) AS frames, max(spread) AS spread FROM a GROUP BY 1
""")  # fmt: skip
def cross_view_visibility(spark: SparkSession, d: str) -> DataFrame:
    """Series of all five kinds aligned by place and cut to the shortest: how many are visible, and the spread of time."""
    v = _events(spark, d).withColumn("f", F.row_number().over(W.partitionBy("user_id", "event_type").orderBy("us")) - 1)
    n = v.groupBy("user_id", "event_type").count().groupBy("user_id").agg(F.min("count").alias("c"), F.count("*").alias("m")).where("m = 5")
    a = v.join(n, "user_id").where("f < c").groupBy("user_id", "f").agg(F.count_if(F.col("us") % 3 != 0).alias("visible"), (F.max("us") - F.min("us")).alias("spread"))
    return a.groupBy("visible").agg(F.count("*").alias("frames"), F.max("spread").alias("spread"))
