"""Queries of aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import status
from tidemark.operators import robust
from tidemark.plans.registry import query
from tidemark.tables import load, micros


def _events(spark, d) -> DataFrame:
    return load(spark, d, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("us"))


_FAMILY = "CASE WHEN s LIKE 'PASS%' THEN 'PASS' WHEN s LIKE 'REVIEW%' THEN 'REVIEW' WHEN s LIKE 'FAIL%' OR s LIKE 'NO_GO%' THEN 'FAIL' WHEN s LIKE 'INCOMPLETE%' THEN 'INCOMPLETE' ELSE 'UNKNOWN' END"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'REVIEW_' || o_orderpriority WHEN 'P' THEN 'NO_GO_TRIANGULATION' ELSE 'x' END"


@query("AG-01", sql=f"SELECT family, count(*) AS n FROM (SELECT {_FAMILY} AS family FROM (SELECT {_STATUS} AS s FROM orders)) GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy(status.family(F.expr(_STATUS)).alias("family")).agg(F.count("*").alias("n"))


@query("AG-14", sql=f"""
SELECT o_custkey, CASE max(CASE f WHEN 'PASS' THEN 0 WHEN 'REVIEW' THEN 1 ELSE 2 END) WHEN 0 THEN 'PASS' WHEN 1 THEN 'REVIEW' ELSE 'FAIL' END AS status
FROM (SELECT o_custkey, {_FAMILY} AS f FROM (SELECT o_custkey, {_STATUS} AS s FROM orders)) GROUP BY 1
""")  # fmt: skip
def worst_status(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.sequences import worst

    f = load(spark, d, "orders").select("o_custkey", status.family(F.expr(_STATUS)).alias("f"))
    return f.groupBy("o_custkey").agg(worst(F.col("f"), {"PASS": 0, "REVIEW": 1, "FAIL": 2}, {0: "PASS", 1: "REVIEW", 2: "FAIL"}).alias("status"))


@query("AG-02", sql="SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1, 2")
def percentiles_linear(spark: SparkSession, d: str) -> DataFrame:
    p = F.percentile("l_extendedprice", F.array(F.lit(0.5), F.lit(0.95)))
    return load(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(p.alias("p"), F.round(F.avg("l_quantity"), 6).alias("mean")).select("l_returnflag", "l_linestatus", F.round(F.col("p")[0], 4).alias("p50"), F.round(F.col("p")[1], 4).alias("p95"), "mean")


@query("AG-03", sql="SELECT l_returnflag, quantile_disc(l_extendedprice, 0.9) AS p90 FROM lineitem GROUP BY 1")
def percentile_nearest_rank(spark: SparkSession, d: str) -> DataFrame:
    """sorted[ceil(0.9 n) - 1]."""
    return load(spark, d, "lineitem").groupBy("l_returnflag").agg(F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY l_extendedprice)").alias("p90"))


@query("AG-04", sql="""
WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1), a AS (SELECT e.event_type, med, median(abs(value - med)) AS mad FROM events e JOIN m USING (event_type) GROUP BY 1, 2)
SELECT e.event_type, round(med, 6) AS median, round(mad, 6) AS mad, count(*) FILTER (WHERE value > med + 5 * 1.4826 * greatest(mad, 1e-9)) AS outliers FROM events e JOIN a USING (event_type) GROUP BY 1, 2, 3
""")  # fmt: skip
def mad_outliers(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    t = robust.mad(e, ["event_type"], "value")
    return e.join(t, "event_type").groupBy("event_type", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad")).agg(F.count_if(F.col("value") > F.col("threshold")).alias("outliers"))


@query("AG-05", sql="""
WITH v AS (SELECT l_returnflag, l_extendedprice AS p, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2), r AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY p) AS run, sum(w) OVER (PARTITION BY l_returnflag) AS a FROM v)
SELECT l_returnflag, min(p) AS weighted_median FROM r WHERE run * 2 >= a GROUP BY 1
""")  # fmt: skip
def weighted_median(spark: SparkSession, d: str) -> DataFrame:
    return robust.weighted_median(load(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")


@query("AG-06", sql="""
WITH p AS (SELECT l_shipmode_k AS g, x, y, greatest(w, 0.05) * greatest(w, 0.05) AS w FROM (SELECT l_suppkey % 10 AS l_shipmode_k, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 10 AS w FROM lineitem)),
s AS (SELECT g, count(*) AS n, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy, sum(w * y * y) AS syy FROM p GROUP BY 1),
l AS (SELECT *, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS b FROM s), k AS (SELECT *, (sy - b * sx) / sw AS a FROM l)
SELECT g, n, round(b, 6) AS slope, round(a, 5) AS intercept, round(1 - greatest(syy - a * sy - b * sxy, 0) / (syy - sy * sy / sw), 6) AS r2, round(sqrt(greatest(syy - a * sy - b * sxy, 0) / sw), 5) AS rmse FROM k
""")  # fmt: skip
def weighted_line(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "lineitem").select(F.expr("l_suppkey % 10").alias("g"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), F.pow(F.greatest(F.col("l_discount") * 10, F.lit(0.05)), 2).alias("w"))
    out = robust.weighted_line(p, ["g"], F.col("x"), F.col("y"), F.col("w"))
    return out.select("g", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("r2", 6).alias("r2"), F.round("rmse", 5).alias("rmse"))


@query("AG-07", sql="SELECT vec_id, round(list_median(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS med FROM embeddings".replace("list_median(", "list_aggregate(").replace("AS DOUBLE)))", "AS DOUBLE)), 'median')"))
def array_row_median(spark: SparkSession, d: str) -> DataFrame:
    """Median of each row's array: sorted in place, no rows are made."""
    s = F.array_sort(F.transform("embedding", lambda x: x.cast("double")))
    e = load(spark, d, "embeddings").select("vec_id", s.alias("s"))
    n = F.size("s")
    return e.select("vec_id", F.round((F.get("s", ((n - 1) / 2).cast("int")) + F.get("s", (n / 2).cast("int"))) / 2, 6).alias("med"))


@query("AG-07", sql="""
WITH v AS (SELECT label, i, x FROM (SELECT label, vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) WHERE NOT (vec_id + i) % 5 = 0)
SELECT label, CAST(i AS INTEGER) AS i, round(median(x), 6) AS consensus, count(*) AS views FROM v GROUP BY 1, 2
""")  # fmt: skip
def view_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Median of each component over the views that are valid."""
    v = load(spark, d, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "x")).where("not (vec_id + i) % 5 = 0")
    return v.groupBy("label", "i").agg(F.round(F.percentile(F.col("x").cast("double"), 0.5), 6).alias("consensus"), F.count("*").alias("views"))


@query("AG-08", sql="""
WITH u AS (SELECT s_nationkey AS camera, 'acctbal' AS metric, s_acctbal AS v FROM supplier UNION ALL SELECT s_nationkey, 'key', CAST(s_suppkey AS DOUBLE) FROM supplier)
SELECT metric, coalesce(camera, -1) AS camera, round(min(v), 4) AS lo, round(median(v), 4) AS med, round(quantile_cont(v, 0.95), 4) AS p95, round(max(v), 4) AS hi FROM u GROUP BY GROUPING SETS ((metric), (metric, camera))
""")  # fmt: skip
def metric_distribution(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "supplier").select(F.col("s_nationkey").alias("camera"), F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").cast("double").alias("key"))
    u = s.unpivot(["camera"], ["acctbal", "key"], "metric", "v")
    g = u.groupingSets([["metric"], ["metric", "camera"]], "metric", "camera")
    p = F.percentile("v", F.array(F.lit(0.5), F.lit(0.95)))
    out = g.agg(F.min("v").alias("lo"), p.alias("p"), F.max("v").alias("hi"))
    r = lambda c: F.round(c, 4)
    return out.select("metric", F.coalesce("camera", F.lit(-1)).alias("camera"), r("lo").alias("lo"), r(F.col("p")[0]).alias("med"), r(F.col("p")[1]).alias("p95"), r("hi").alias("hi"))


@query("AG-09", sql="""
WITH s AS (SELECT c_mktsegment AS exercise, c_custkey, count(*) AS n, quantile_cont(o_totalprice, 0.9) AS p90, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2),
a AS (SELECT coalesce(exercise, 'DATASET') AS scope, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS frames, CAST(sum(f) AS BIGINT) AS failed, round(quantile_cont(p90, 0.9), 3) AS p90_of_p90 FROM s GROUP BY GROUPING SETS ((), (exercise))),
b AS (SELECT coalesce(c_mktsegment, 'DATASET') AS scope, round(quantile_cont(o_totalprice, 0.9), 3) AS pooled FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY GROUPING SETS ((), (c_mktsegment)))
SELECT a.*, b.pooled FROM a JOIN b USING (scope)
""")  # fmt: skip
def dataset_rollup(spark: SparkSession, d: str) -> DataFrame:
    """One row for all and one for each group: counts, percentile of percentiles and pooled percentile."""
    j = load(spark, d, "customer").join(load(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_mktsegment").alias("exercise"), "c_custkey", "o_totalprice", "o_orderstatus")
    s = j.groupBy("exercise", "c_custkey").agg(F.count("*").alias("n"), F.percentile("o_totalprice", 0.9).alias("p90"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    scope = F.when(F.grouping("exercise") == 1, "DATASET").otherwise(F.col("exercise")).alias("scope")
    a = s.groupingSets([[], ["exercise"]], "exercise").agg(scope, F.count("*").alias("sequences"), F.sum("n").alias("frames"), F.sum("f").alias("failed"), F.round(F.percentile("p90", 0.9), 3).alias("p90_of_p90")).drop("exercise")
    b = j.groupingSets([[], ["exercise"]], "exercise").agg(scope, F.round(F.percentile("o_totalprice", 0.9), 3).alias("pooled")).drop("exercise")
    return a.join(b, "scope")


@query("AG-10", "AG-12", sql="""
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS above, bool_and(value > 0) AS all_positive, bool_or(value > 400) AS any_large, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0 END), 6) AS fraction,
  round(avg(value), 5) AS mean, round(quantile_cont(value, 0.9), 5) AS p90, round(quantile_cont(value, 0.95), 5) AS p95, round(max(value), 5) AS most, count(DISTINCT user_id) AS subjects FROM events GROUP BY 1
""")  # fmt: skip
def group_summaries(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    p = F.percentile("value", F.array(F.lit(0.9), F.lit(0.95)))
    out = _events(spark, d).groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(v > 50).alias("above"), F.bool_and(v > 0).alias("all_positive"), F.bool_or(v > 400).alias("any_large"), F.round(F.avg((v > 50).cast("double")), 6).alias("fraction"),
        F.round(F.avg(v), 5).alias("mean"), p.alias("p"), F.round(F.max(v), 5).alias("most"), F.count_distinct("user_id").alias("subjects"),
    )
    return out.withColumn("p90", F.round(F.col("p")[0], 5)).withColumn("p95", F.round(F.col("p")[1], 5)).drop("p")


@query("AG-11", "WN-01", sql="""
WITH x AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS s FROM events)
SELECT user_id, count(s) AS n, round(median(s), 4) AS med, round(quantile_cont(s, 0.05), 4) AS p05, round(quantile_cont(s, 0.95), 4) AS p95, count(*) FILTER (WHERE s <= 1e-9) AS duplicates, round(1 / median(s), 9) AS fps,
  CASE WHEN max(s) - min(s) <= greatest(2e-6, 0.005 * median(s)) THEN 'CFR' ELSE 'VFR' END AS cadence FROM x GROUP BY 1
""")  # fmt: skip
def cadence(spark: SparkSession, d: str) -> DataFrame:
    x = _events(spark, d).withColumn("s", (F.col("us") - F.lag("us").over(W.partitionBy("user_id").orderBy("us"))) / 1e6)
    p = F.percentile("s", F.array(F.lit(0.5), F.lit(0.05), F.lit(0.95)))
    a = x.groupBy("user_id").agg(F.count("s").alias("n"), p.alias("p"), F.count_if(F.col("s") <= 1e-9).alias("duplicates"), (F.max("s") - F.min("s")).alias("range"))
    med = F.col("p")[0]
    cls = F.when(F.col("range") <= F.greatest(F.lit(2e-6), 0.005 * med), "CFR").otherwise("VFR")
    return a.select("user_id", "n", F.round(med, 4).alias("med"), F.round(F.col("p")[1], 4).alias("p05"), F.round(F.col("p")[2], 4).alias("p95"), "duplicates", F.round(F.try_divide(F.lit(1.0), med), 9).alias("fps"), cls.alias("cadence"))


@query("AG-15", sql="SELECT p_brand, round(stddev_pop(p_retailprice) / avg(p_retailprice), 8) AS cv, round(median(p_size), 4) AS size, round(median(p_size) / median(p_retailprice), 8) AS ratio FROM part GROUP BY 1")
def cv_ratio(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "part").groupBy("p_brand").agg(F.try_divide(F.stddev_pop("p_retailprice"), F.avg("p_retailprice")).alias("cv"), F.percentile("p_size", 0.5).alias("size"), F.percentile("p_retailprice", 0.5).alias("ref"))
    return g.select("p_brand", F.round("cv", 8).alias("cv"), F.round("size", 4).alias("size"), F.round(F.try_divide("size", "ref"), 8).alias("ratio"))


@query("AG-17", "FN-27", sql="""
WITH e AS (SELECT event_type AS seq, user_id AS track, epoch_us(ts) // 86400000000 AS f, max(value) AS area, max(CAST(epoch_us(ts) % 1000 AS DOUBLE) / 1000) AS score FROM events GROUP BY 1, 2, 3),
w AS (SELECT *, lag(f) OVER t AS pf, lag(area) OVER t AS pa FROM e WINDOW t AS (PARTITION BY seq, track ORDER BY f)),
o AS (SELECT *, CASE WHEN pf IS NULL THEN 1.0 ELSE exp(-0.12 * (f - pf - 1)) * exp(-abs(ln(greatest(area, 1e-9) / greatest(pa, 1e-9))) / 0.5) END AS aff FROM w),
span AS (SELECT seq, max(f) - min(f) + 1 AS n, min(f) AS a, greatest(12, least(90, round_even((max(f) - min(f) + 1) * 0.1, 0))) AS win FROM e GROUP BY 1), big AS (SELECT seq, f, max(area) AS m FROM e GROUP BY 1, 2),
g AS (SELECT o.seq, o.track, any_value(n) AS n, count(*) AS k, min(o.f) AS lo, max(o.f) AS hi, least(count(*) FILTER (WHERE o.f - a < win) / any_value(win), 1) AS ini, least(count(*) FILTER (WHERE o.f - a >= greatest(0, n - win)) / any_value(win), 1) AS ter,
  coalesce(median(aff) FILTER (WHERE aff < 1), 0) AS con, median(area / nullif(m, 0)) AS rel, median(score) AS sc, median(exp(-abs(score - 0.5) / 0.45)) AS loc, arg_max(aff, o.f) AS local, arg_max(score, o.f) AS own FROM o JOIN span USING (seq) JOIN big ON big.seq = o.seq AND big.f = o.f GROUP BY 1, 2),
c AS (SELECT *, 0.30 * k / n + 0.10 * (hi - lo + 1) / n + 0.16 * ini + 0.04 * ter + 0.16 * con + 0.12 * rel + 0.07 * sc + 0.05 * loc AS q, k / n AS cover FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY round(q, 9) DESC, track) AS place, round(q, 9) - lead(round(q, 9)) OVER (PARTITION BY seq ORDER BY round(q, 9) DESC, track) AS margin FROM c)
SELECT seq, track, CAST(place AS INTEGER) AS place, round(q, 6) AS quality, round(margin, 6) AS margin, CASE WHEN margin < 0.02 THEN 'AMBIGUOUS' ELSE 'TARGET' END AS status,
  round(least(CASE WHEN margin < 0.02 THEN 0.44 ELSE 1 END, 0.45 * least(margin / 0.2, 1) + 0.30 * local + 0.15 * own + 0.10 * cover), 6) AS confidence FROM r WHERE place = 1
""")  # fmt: skip
def track_score(spark: SparkSession, d: str) -> DataFrame:
    """Eight weighted components of each track (user) of a sequence (event type), one observation a day as a frame:
    coverage, span, coverage of the initial and the terminal window (a tenth of the frames, 12 to 90), continuity (median
    affinity of all but births), area beside the frame's largest, score and location. The best track, its margin and the
    selector's confidence at its last frame (margin, local affinity, score, coverage), capped where it is ambiguous."""
    from tidemark.operators.sequences import rank_margin

    e = _events(spark, d).select(F.col("event_type").alias("seq"), F.col("user_id").alias("track"), F.expr("us div 86400000000").alias("f"), F.col("value").alias("area"), (F.expr("us % 1000") / 1000).alias("score"))
    e = e.groupBy("seq", "track", "f").agg(F.max("area").alias("area"), F.max("score").alias("score"))
    order = W.partitionBy("seq", "track").orderBy("f")
    gap, change = F.col("f") - F.lag("f").over(order) - 1, F.abs(F.ln(F.greatest("area", F.lit(1e-9)) / F.greatest(F.lag("area").over(order), F.lit(1e-9))))
    o = e.withColumn("aff", F.when(F.lag("f").over(order).isNull(), 1.0).otherwise(F.exp(-0.12 * gap) * F.exp(-change / 0.5)))
    n = F.max("f") - F.min("f") + 1
    span = e.groupBy("seq").agg(n.alias("n"), F.min("f").alias("a"), F.greatest(F.lit(12), F.least(F.lit(90), F.bround(n * F.lit(0.1), 0))).alias("win"))
    big = e.groupBy("seq", "f").agg(F.max("area").alias("m"))
    share = lambda c: F.least(F.count(F.when(c, 1)) / F.first("win"), F.lit(1.0))
    g = o.join(big, ["seq", "f"]).join(span, "seq").groupBy("seq", "track").agg(
        F.first("n").alias("n"), F.count("*").alias("k"), F.min("f").alias("lo"), F.max("f").alias("hi"), share(F.col("f") - F.col("a") < F.col("win")).alias("ini"), share(F.col("f") - F.col("a") >= F.greatest(F.lit(0), F.col("n") - F.col("win"))).alias("ter"),
        F.coalesce(F.percentile(F.when(F.col("aff") < 1, F.col("aff")), 0.5), F.lit(0.0)).alias("con"), F.percentile(F.try_divide("area", "m"), 0.5).alias("rel"), F.percentile("score", 0.5).alias("sc"),
        F.percentile(F.exp(-F.abs(F.col("score") - 0.5) / 0.45), 0.5).alias("loc"), F.max_by("aff", "f").alias("local"), F.max_by("score", "f").alias("own"),
    )
    q = F.expr("0.30D * k / n + 0.10D * (hi - lo + 1) / n + 0.16D * ini + 0.04D * ter + 0.16D * con + 0.12D * rel + 0.07D * sc + 0.05D * loc")
    c = g.select("seq", "track", F.round(q, 9).alias("q"), (F.col("k") / F.col("n")).alias("cover"), "local", "own")
    best = rank_margin(c, ["seq"], "q", "track", 1)
    close = F.coalesce(F.col("margin") < 0.02, F.lit(False))
    conf = F.least(F.when(close, 0.44).otherwise(1.0), 0.45 * F.least(F.col("margin") / 0.2, F.lit(1.0)) + 0.30 * F.col("local") + 0.15 * F.col("own") + 0.10 * F.col("cover"))
    return best.select("seq", "track", F.col("rank").alias("place"), F.round("q", 6).alias("quality"), F.round("margin", 6).alias("margin"), F.when(close, "AMBIGUOUS").otherwise("TARGET").alias("status"), F.round(conf, 6).alias("confidence"))


@query("AG-20", sql="""
WITH j AS (SELECT vec_id, label, i // 3 AS j, i % 3 AS c, v FROM (SELECT vec_id, label, unnest(range(63)) AS i, CAST(unnest(embedding[1:63]) AS DOUBLE) AS v FROM embeddings)),
t AS (SELECT label, j, c, avg(v) AS t FROM j GROUP BY 1, 2, 3),
r AS (SELECT j.vec_id, j.j, j.c, v - first_value(v) OVER (PARTITION BY vec_id, j.c ORDER BY j.j) AS p, t - first_value(t) OVER (PARTITION BY vec_id, j.c ORDER BY j.j) AS t FROM j JOIN t USING (label, j, c)),
s AS (SELECT vec_id, sum(p * t) / sum(p * p) AS s FROM r GROUP BY 1),
e AS (SELECT vec_id, j, sqrt(sum((p - t) * (p - t))) AS e1, sqrt(sum((s * p - t) * (s * p - t))) AS e2 FROM r JOIN s USING (vec_id) GROUP BY 1, 2)
SELECT vec_id, round(avg(e1) * 1000, 4) AS mpjpe, round(avg(e2) * 1000, 4) AS n_mpjpe FROM e GROUP BY 1
""")  # fmt: skip
def pose_error(spark: SparkSession, d: str) -> DataFrame:
    """21 joints of each vector against its label's mean pose, both rooted at joint 0: plain and scale-aligned error."""
    j = load(spark, d, "embeddings").select("vec_id", "label", F.posexplode(F.slice("embedding", 1, 63)).alias("i", "v"))
    j = j.select("vec_id", "label", F.expr("i div 3").alias("j"), F.expr("i % 3").alias("c"), F.col("v").cast("double").alias("v"))
    t = j.groupBy("label", "j", "c").agg(F.avg("v").alias("t"))
    x = j.join(t, ["label", "j", "c"])
    root = x.where("j = 0").select("vec_id", "c", F.col("v").alias("v0"), F.col("t").alias("t0"))
    x = x.join(root, ["vec_id", "c"]).select("vec_id", "j", (F.col("v") - F.col("v0")).alias("p"), (F.col("t") - F.col("t0")).alias("t"))
    s = x.groupBy("vec_id").agg(F.try_divide(F.sum(F.col("p") * F.col("t")), F.sum(F.col("p") * F.col("p"))).alias("s"))
    sq = lambda a: F.sqrt(F.sum((a - F.col("t")) * (a - F.col("t"))))
    e = x.join(s, "vec_id").groupBy("vec_id", "j").agg(sq(F.col("p")).alias("e1"), sq(F.col("s") * F.col("p")).alias("e2"))
    return e.groupBy("vec_id").agg(F.round(F.avg("e1") * 1000, 4).alias("mpjpe"), F.round(F.avg("e2") * 1000, 4).alias("n_mpjpe"))


@query("AG-22", "AG-23", "FN-24", sql="""
WITH o AS (SELECT l_orderkey AS k, count(*) AS support, avg(1 - l_discount) AS conf, median(l_quantity) AS err, max(l_tax) * 100 AS angle, max(l_linenumber) AS lag, avg(l_extendedprice) AS geo FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey AS k, o_totalprice AS prior, CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END AS views FROM orders)
SELECT k, round(conf * least(support, 3) / 3 * exp(-err / 10) * least(1, angle / 5) * exp(-lag / 33.3), 8) AS quality,
  CASE WHEN o.k IS NOT NULL AND p.k IS NOT NULL THEN 3 WHEN o.k IS NOT NULL THEN 1 WHEN views >= 2 THEN 2 ELSE 0 END AS evidence,
  round(CASE WHEN o.k IS NOT NULL AND p.k IS NOT NULL THEN (geo * conf + prior * 0.25) / (conf + 0.25) WHEN o.k IS NOT NULL THEN geo WHEN views >= 2 THEN prior END, 6) AS fused,
  round(10 * CASE WHEN o.k IS NULL THEN 1 ELSE 0 END + coalesce(err / 25, 0) + coalesce(angle / 8, 0), 6) AS severity
FROM o FULL JOIN p USING (k)
""")  # fmt: skip
def fuse_quality(spark: SparkSession, d: str) -> DataFrame:
    """Joint quality, fusion of measurement and prior with evidence codes (a prior alone needs two views), severity."""
    o = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.count("*").alias("support"), F.avg(1 - F.col("l_discount")).alias("conf"), F.percentile("l_quantity", 0.5).alias("err"), (F.max("l_tax") * 100).alias("angle"), F.max("l_linenumber").alias("lag"), F.avg("l_extendedprice").alias("geo"),
    ).withColumn("m", F.lit(True))
    p = load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("prior"), F.when(F.col("o_orderstatus") == "F", 3).otherwise(1).alias("views"))
    j = o.join(p, "k", "full")
    quality = F.expr("conf * least(support, 3) / 3 * exp(-err / 10) * least(1D, angle / 5) * exp(-lag / 33.3D)")
    measured, prior = F.col("m").isNotNull(), F.col("prior").isNotNull()
    evidence = F.when(measured & prior, 3).when(measured, 1).when(F.col("views") >= 2, 2).otherwise(0)
    fused = F.when(measured & prior, F.expr("(geo * conf + prior * 0.25D) / (conf + 0.25D)")).when(measured, F.col("geo")).when(F.col("views") >= 2, F.col("prior"))
    severity = 10 * F.when(measured, 0).otherwise(1) + F.coalesce(F.col("err") / 25, F.lit(0.0)) + F.coalesce(F.col("angle") / 8, F.lit(0.0))
    return j.select("k", F.round(quality, 8).alias("quality"), evidence.alias("evidence"), F.round(fused, 6).alias("fused"), F.round(severity, 6).alias("severity"))


@query("AG-24", sql="SELECT label, CAST(i AS INTEGER) AS i, round(median(v), 6) AS med FROM (SELECT label, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY 1, 2")
def vector_median(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    return v.groupBy("label", "i").agg(F.round(F.percentile(F.col("v").cast("double"), 0.5), 6).alias("med"))


_GATING = """
WITH s AS (SELECT c_nationkey AS camera, c_custkey % 8 AS sample, count(*) AS support, median(c_acctbal) AS med, quantile_cont(c_acctbal, 0.9) AS p90, avg(CASE WHEN c_acctbal < 5000 THEN 1.0 ELSE 0 END) AS inlier FROM customer GROUP BY 1, 2),
q AS (SELECT quantile_cont(med, 0.25) AS q1, quantile_cont(med, 0.75) AS q3 FROM s),
g AS (SELECT n_nationkey AS camera, k AS sample FROM nation, (SELECT unnest(range(8)) AS k)),
j AS (SELECT g.camera, CAST(g.sample AS BIGINT) AS sample, coalesce(support, 0) AS support, med, inlier, q3 + 1.5 * (q3 - q1) AS lim FROM g LEFT JOIN s ON s.camera = g.camera AND s.sample = g.sample CROSS JOIN q)
SELECT camera, sample, support, CASE WHEN support < 3 OR inlier < 0.2 THEN 'REJECT' WHEN med > lim OR inlier < 0.5 THEN 'DOWNWEIGHT' ELSE 'GOOD' END AS class,
  CASE WHEN support < 3 OR inlier < 0.2 THEN 0.0 WHEN med > lim OR inlier < 0.5 THEN 0.25 ELSE 1.0 END AS weight,
  concat_ws(',', CASE WHEN support < 3 THEN 'SUPPORT' END, CASE WHEN inlier < 0.2 THEN 'INLIER' END, CASE WHEN med > lim THEN 'MEDIAN' END) AS reasons FROM j
"""


@query("AG-25", sql=_GATING.replace("0.0 WHEN", "CAST(0 AS DOUBLE) WHEN").replace("THEN 0.25 ELSE 1.0", "THEN CAST(0.25 AS DOUBLE) ELSE CAST(1 AS DOUBLE)"))
def sample_gating(spark: SparkSession, d: str) -> DataFrame:
    """Samples of a camera grid judged by support, median against an IQR limit and inlier share; empty cells count."""
    c = load(spark, d, "customer")
    s = c.groupBy(F.col("c_nationkey").alias("camera"), F.expr("c_custkey % 8").alias("sample")).agg(F.count("*").alias("support"), F.percentile("c_acctbal", 0.5).alias("med"), F.avg((F.col("c_acctbal") < 5000).cast("double")).alias("inlier"))
    lim = robust.iqr_limit(s, [], "med").select("limit")
    grid = load(spark, d, "nation").select(F.col("n_nationkey").alias("camera"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("sample")).withColumn("sample", F.col("sample").cast("long"))
    j = grid.join(s, ["camera", "sample"], "left").crossJoin(F.broadcast(lim)).withColumn("support", F.coalesce("support", F.lit(0)))  # one row
    reject, down = (F.col("support") < 3) | F.coalesce(F.col("inlier") < 0.2, F.lit(False)), F.coalesce((F.col("med") > F.col("limit")) | (F.col("inlier") < 0.5), F.lit(False))
    why = status.reasons(("SUPPORT", F.col("support") < 3), ("INLIER", F.col("inlier") < 0.2), ("MEDIAN", F.col("med") > F.col("limit")))
    return j.select("camera", "sample", "support", F.when(reject, "REJECT").when(down, "DOWNWEIGHT").otherwise("GOOD").alias("class"), F.when(reject, 0.0).when(down, 0.25).otherwise(1.0).alias("weight"), F.array_join(why, ",").alias("reasons"))


@query("AG-26", "AG-38", sql="""
WITH t AS (SELECT l_suppkey AS track, median(l_quantity) AS med, quantile_cont(l_quantity, 0.9) AS p90, avg(CASE WHEN l_quantity <= 40 THEN 1.0 ELSE 0 END) AS inl FROM lineitem GROUP BY 1),
m AS (SELECT median(med) AS m FROM t), a AS (SELECT median(abs(med - m)) AS mad FROM t, m), l AS (SELECT least(m + 3 * 1.4826 * greatest(mad, 1e-9), 40) AS lim FROM m, a)
SELECT track, round(med, 4) AS med, round(p90, 4) AS p90, med <= lim AND p90 <= 48 AND inl >= 0.6 AS kept, (SELECT round(sqrt(power(quantile_cont(l_extendedprice, 0.95) - quantile_cont(l_extendedprice, 0.05), 2) + power(quantile_cont(l_quantity, 0.95) - quantile_cont(l_quantity, 0.05), 2)), 3) FROM lineitem) AS extent FROM t, l
""")  # fmt: skip
def track_gate_and_extent(spark: SparkSession, d: str) -> DataFrame:
    """Tracks within capped robust limits, and the extent of the scene from the 5th to the 95th percentile of its axes."""
    x = load(spark, d, "lineitem")
    p = F.percentile("l_quantity", F.array(F.lit(0.5), F.lit(0.9)))
    t = x.groupBy(F.col("l_suppkey").alias("track")).agg(p.alias("p"), F.avg((F.col("l_quantity") <= 40).cast("double")).alias("inl")).select("track", F.col("p")[0].alias("med"), F.col("p")[1].alias("p90"), "inl")
    lim = robust.mad(t, [], "med", 3.0).select(F.least("threshold", F.lit(40.0)).alias("lim"))
    ends = F.array(F.lit(0.05), F.lit(0.95))
    ext = x.agg(F.percentile("l_extendedprice", ends).alias("a"), F.percentile("l_quantity", ends).alias("b")).select(F.round(F.expr("sqrt(pow(a[1] - a[0], 2) + pow(b[1] - b[0], 2))"), 3).alias("extent"))
    j = t.crossJoin(F.broadcast(lim)).crossJoin(F.broadcast(ext))  # one row each
    return j.select("track", F.round("med", 4).alias("med"), F.round("p90", 4).alias("p90"), ((F.col("med") <= F.col("lim")) & (F.col("p90") <= 48) & (F.col("inl") >= 0.6)).alias("kept"), "extent")


@query("AG-27", sql="""
WITH c AS (SELECT l_returnflag AS g, CAST(least(floor(l_quantity / 12.75), 3) AS INTEGER) AS x, CAST(least(floor(l_discount / 0.0275), 3) AS INTEGER) AS y, l_tax AS e FROM lineitem),
m AS (SELECT g, x, y, median(e) AS med FROM c GROUP BY 1, 2, 3 HAVING count(*) >= 3) SELECT g, count(*) AS cells, round(max(med) - min(med), 6) AS spread FROM m GROUP BY 1
""")  # fmt: skip
def grid_residual(spark: SparkSession, d: str) -> DataFrame:
    """A 4x4 grid of cell medians (three members at least) and their spread."""
    c = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("g"), F.least(F.floor(F.col("l_quantity") / 12.75), F.lit(3)).alias("x"), F.least(F.floor(F.col("l_discount") / 0.0275), F.lit(3)).alias("y"), F.col("l_tax").alias("e"))
    m = c.groupBy("g", "x", "y").agg(F.percentile("e", 0.5).alias("med"), F.count("*").alias("n")).where("n >= 3")
    return m.groupBy("g").agg(F.count("*").alias("cells"), F.round(F.max("med") - F.min("med"), 6).alias("spread"))


@query("AG-28", "AG-40", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1), c AS (SELECT e.*, CASE WHEN value <= q1 THEN 'STATIC' WHEN value >= q3 THEN 'FAST' ELSE 'MODERATE' END AS cls FROM events e JOIN q USING (event_type))
SELECT user_id, round(quantile_cont(value, 0.95) FILTER (WHERE cls = 'STATIC'), 5) AS static_p95, round(quantile_cont(value, 0.95) FILTER (WHERE cls = 'FAST'), 5) AS fast_p95, round(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0 END), 6) AS success,
  round(stddev_pop(value) / avg(value), 6) AS cv, concat_ws(',', CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 15 THEN 'FAILURES' END, CASE WHEN stddev_pop(value) / avg(value) > 1 THEN 'DISPERSION' END) AS flags FROM c GROUP BY 1
""")  # fmt: skip
def class_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of a metric by motion class, success share, dispersion and review flags of each series."""
    e = _events(spark, d)
    q = e.groupBy("event_type").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    v = F.col("value")
    c = e.join(q, "event_type").withColumn("cls", F.when(v <= F.col("q")[0], "STATIC").when(v >= F.col("q")[1], "FAST").otherwise("MODERATE"))
    cv = F.try_divide(F.stddev_pop("value"), F.avg("value"))
    p95 = lambda k: F.round(F.percentile(F.when(F.col("cls") == k, v), 0.95), 5)
    flags = status.reasons(("FAILURES", F.col("errors") > 15), ("DISPERSION", F.col("raw") > 1))
    g = c.groupBy("user_id").agg(p95("STATIC").alias("static_p95"), p95("FAST").alias("fast_p95"), F.round(F.avg((F.col("event_type") != "error").cast("double")), 6).alias("success"), cv.alias("raw"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return g.select("user_id", "static_p95", "fast_p95", "success", F.round("raw", 6).alias("cv"), F.array_join(flags, ",").alias("flags"))


@query("AG-29", "WN-15", sql="""
WITH e AS (SELECT user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS k FROM events), a AS (SELECT user_id, count(*) AS done, 200 - count(*) AS remaining, (max(us) - min(us)) / 1e6 AS sec FROM e GROUP BY 1),
r AS (SELECT user_id, (count(*) - 1) / ((max(us) - min(us)) / 1e6) AS rate FROM e WHERE k <= 6 GROUP BY 1 HAVING count(*) > 1)
SELECT user_id, done, remaining, round((done - 1) / nullif(sec, 0) * 86400, 6) AS average_per_day, round(rate * 86400, 6) AS recent_per_day, round(remaining / rate / 3600, 3) AS eta_hours FROM a LEFT JOIN r USING (user_id)
""")  # fmt: skip
def throughput_eta(spark: SparkSession, d: str) -> DataFrame:
    """Average and recent rate of each series towards 200 items, and the time left at the recent rate."""
    from tidemark.operators.sequences import recent_rate

    e = _events(spark, d).withColumn("one", F.lit(1))
    a = e.groupBy("user_id").agg(F.count("*").alias("done"), (200 - F.count("*")).alias("remaining"), ((F.max("us") - F.min("us")) / 1e6).alias("sec"))
    r = recent_rate(e, ["user_id"], "us", "one").where("n > 1").select("user_id", "rate")
    return a.join(r, "user_id", "left").select(
        "user_id", "done", "remaining", F.round(F.try_divide((F.col("done") - 1).cast("double"), F.col("sec")) * 86400, 6).alias("average_per_day"), F.round(F.col("rate") * 86400, 6).alias("recent_per_day"),
        F.round(F.try_divide(F.col("remaining").cast("double"), F.col("rate")) / 3600, 3).alias("eta_hours"),
    )


@query("AG-31", sql="""
WITH b AS (SELECT l_linestatus AS cond, l_returnflag AS mode, sum(l_extendedprice) / 1e6 AS sec, sum(l_quantity) AS frames, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT mode, sum(CASE WHEN cond = 'F' THEN sec / frames END) AS control, sum(CASE WHEN cond = 'O' THEN sec / frames END) AS severe FROM b GROUP BY 1)
SELECT mode, round(1000 * least(coalesce(control, severe), coalesce(severe, control)), 6) AS best, round(1000 * (0.75 * coalesce(control, severe) + 0.25 * coalesce(severe, control)), 6) AS expected, round(1000 * greatest(coalesce(control, severe), coalesce(severe, control)), 6) AS worst FROM r
""")  # fmt: skip
def scenario_projection(spark: SparkSession, d: str) -> DataFrame:
    """Seconds for a thousand frames from measured rates by condition: best, weighted by prevalence, worst."""
    b = load(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("mode")).pivot("l_linestatus", ["F", "O"]).agg((F.sum("l_extendedprice") / 1e6 / F.sum("l_quantity")).alias("r"))
    c, s = F.coalesce("F", "O"), F.coalesce("O", "F")
    return b.select("mode", F.round(1000 * F.least(c, s), 6).alias("best"), F.round(1000 * (0.75 * c + 0.25 * s), 6).alias("expected"), F.round(1000 * F.greatest(c, s), 6).alias("worst"))


@query("AG-32", "AG-03", sql="""
WITH b AS (SELECT o_custkey AS seq, count(*) AS frames, CAST(sum(round(o_totalprice)) AS BIGINT) AS bytes FROM orders GROUP BY 1), r AS (SELECT quantile_disc(bytes / frames, 0.9) AS p90, median(bytes / frames) AS med FROM b),
o AS (SELECT seq, sum(bytes) OVER (ORDER BY seq) AS run FROM b)
SELECT o.seq, CAST(run AS BIGINT) AS build_bytes, CAST(sum(run) OVER (ORDER BY o.seq) AS BIGINT) AS cumulative_bytes, round(med, 3) AS median_rate, round(p90, 3) AS p90_rate, round(p90 * 1000, 2) AS remaining_bytes FROM o, r
""")  # fmt: skip
def storage_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative immutable builds by running sums of running sums, and the p90 rate times what remains.

    The order is over all sequences: sums of blocks of keys come first, so that no window holds them all.
    """
    b = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("seq")).agg(F.count("*").alias("frames"), F.sum(F.round("o_totalprice")).cast("long").alias("bytes"))
    rate = b.agg(F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY bytes / frames)").alias("p90"), F.percentile(F.col("bytes") / F.col("frames"), 0.5).alias("med"))
    width = 4096
    b = b.withColumn("blk", F.floor(F.col("seq") / width))
    inside = W.partitionBy("blk").orderBy("seq")
    b = b.withColumn("r1", F.sum("bytes").over(inside)).withColumn("i", F.row_number().over(inside)).withColumn("r2", F.sum("r1").over(inside))
    blocks = b.groupBy("blk").agg(F.max("i").alias("n"), F.max_by("r1", "i").alias("t1"), F.max_by("r2", "i").alias("t2"))
    w = W.orderBy("blk").rowsBetween(W.unboundedPreceding, -1)  # a row for each 4,096 keys
    blocks = blocks.withColumn("b1", F.coalesce(F.sum("t1").over(w), F.lit(0)))
    blocks = blocks.withColumn("b2", F.coalesce(F.sum(F.col("t2") + F.col("b1") * F.col("n")).over(w), F.lit(0)))
    j = b.join(blocks.select("blk", "b1", "b2"), "blk").crossJoin(F.broadcast(rate))  # one row
    return j.select("seq", (F.col("b1") + F.col("r1")).alias("build_bytes"), (F.col("b2") + F.col("b1") * F.col("i") + F.col("r2")).alias("cumulative_bytes"), F.round("med", 3).alias("median_rate"), F.round("p90", 3).alias("p90_rate"), F.round(F.col("p90") * 1000, 2).alias("remaining_bytes"))


@query("AG-34", sql="""
SELECT o_custkey, sha256(string_agg(CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus || ':' || o_orderpriority, chr(10) ORDER BY o_orderkey)) AS signature FROM orders GROUP BY 1
""")  # fmt: skip
def dependency_signature(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.contracts import signature

    return signature(load(spark, d, "orders"), ["o_custkey"], "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("AG-35", sql="""
WITH f AS (SELECT user_id, event_type AS ev, count(*) AS n, regr_slope(value, epoch_us(ts) / 1e9) AS slope, least(1, count(*) / 15) AS conf FROM events GROUP BY 1, 2),
e AS (SELECT *, sign(slope) AS s FROM f WHERE n >= 5 AND slope IS NOT NULL),
r AS (SELECT *, sum(conf) OVER (PARTITION BY user_id ORDER BY slope) AS run, sum(conf) OVER (PARTITION BY user_id) AS a FROM e),
m AS (SELECT user_id, min(slope) AS med FROM r WHERE run * 2 >= a - 1e-12 GROUP BY 1)
SELECT e.user_id, round(med, 5) AS drift, count(DISTINCT ev) FILTER (WHERE s = sign(med)) AS agreeing, round(sum(conf * conf) / sum(conf), 6) AS confidence FROM e JOIN m USING (user_id) GROUP BY 1, med
""")  # fmt: skip
def fused_drift(spark: SparkSession, d: str) -> DataFrame:
    """Slopes of several modalities reduced to a weighted lower median, how many agree in sign, weighted confidence."""
    f = _events(spark, d).groupBy("user_id", F.col("event_type").alias("ev")).agg(F.count("*").alias("n"), F.regr_slope("value", F.col("us") / 1e9).alias("slope")).where("n >= 5 and slope is not null")
    f = f.withColumn("conf", F.least(F.lit(1.0), F.col("n") / 15))
    w = W.partitionBy("user_id")
    r = f.withColumn("run", F.sum("conf").over(w.orderBy("slope"))).withColumn("a", F.sum("conf").over(w))
    r = r.withColumn("med", F.min(F.when(F.col("run") * 2 >= F.col("a") - 1e-12, F.col("slope"))).over(w))
    g = r.groupBy("user_id", "med").agg(F.count_if(F.signum("slope") == F.signum("med")).alias("agreeing"), F.round(F.sum(F.col("conf") * F.col("conf")) / F.sum("conf"), 6).alias("confidence"))
    return g.select("user_id", F.round("med", 5).alias("drift"), "agreeing", "confidence")


@query("AG-36", sql="""
WITH v AS (SELECT user_id AS st, event_type AS c, avg(value) AS m FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2),
p AS (SELECT a.st, a.c AS x, b.c AS y, abs(a.m - b.m) > 20 AS drift FROM v a JOIN v b ON a.st = b.st AND a.c < b.c),
n AS (SELECT st, count(*) FILTER (WHERE drift) AS k FROM p GROUP BY 1 HAVING count(*) = 3), e AS (SELECT st, x AS c, drift FROM p UNION ALL SELECT st, y, drift FROM p),
w AS (SELECT st, c FROM e WHERE drift GROUP BY 1, 2 HAVING count(*) = 2)
SELECT n.st, CASE WHEN k = 0 THEN 'NONE' WHEN k = 2 THEN w.c ELSE 'UNRESOLVED' END AS attributed FROM n LEFT JOIN w ON w.st = n.st AND n.k = 2
""")  # fmt: skip
def topology_attribution(spark: SparkSession, d: str) -> DataFrame:
    """The camera that is in both drifting pairs while the third pair is clean."""
    v = _events(spark, d).where("event_type in ('view', 'click', 'purchase')").groupBy(F.col("user_id").alias("st"), F.col("event_type").alias("c")).agg(F.avg("value").alias("m"))
    a, b = v.select("st", F.col("c").alias("x"), F.col("m").alias("m1")), v.select("st", F.col("c").alias("y"), F.col("m").alias("m2"))
    p = a.join(b, "st").where("x < y").select("st", "x", "y", (F.abs(F.col("m1") - F.col("m2")) > 20).alias("drift"))
    n = p.groupBy("st").agg(F.count_if("drift").alias("k"), F.count("*").alias("pairs")).where("pairs = 3")
    e = p.select("st", F.explode(F.array("x", "y")).alias("c"), "drift").where("drift").groupBy("st", "c").count().where("count = 2").select("st", "c")
    j = n.join(e.join(n.where("k = 2"), "st", "left_semi"), "st", "left")
    return j.select("st", F.when(F.col("k") == 0, "NONE").when(F.col("k") == 2, F.col("c")).otherwise("UNRESOLVED").alias("attributed"))


@query("AG-37", sql="""
WITH r AS (SELECT p_brand AS g, p_size AS batch, avg(p_retailprice) AS rate FROM part GROUP BY 1, 2), m AS (SELECT g, max(rate) AS top FROM r GROUP BY 1)
SELECT r.g, min(batch) AS batch FROM r JOIN m USING (g) WHERE rate >= 0.99 * top GROUP BY 1
""")  # fmt: skip
def plateau_choice(spark: SparkSession, d: str) -> DataFrame:
    """The smallest batch within 99 % of the fastest."""
    r = load(spark, d, "part").groupBy(F.col("p_brand").alias("g"), F.col("p_size").alias("batch")).agg(F.avg("p_retailprice").alias("rate"))
    return r.join(r.groupBy("g").agg(F.max("rate").alias("top")), "g").where("rate >= 0.99 * top").groupBy("g").agg(F.min("batch").alias("batch"))
