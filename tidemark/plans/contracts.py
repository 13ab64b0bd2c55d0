"""Queries of contracts, state, recovery, graphs and the timing audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import status
from tidemark.operators import contracts, graph, robust
from tidemark.operators.sequences import islands, merged_intervals
from tidemark.plans.registry import query
from tidemark.tables import load, micros

DAY_US = 86_400_000_000


def _events(spark, d) -> DataFrame:
    return load(spark, d, "events").select("event_id", "user_id", "event_type", "value", micros("ts").alias("us"))


@query("CN-04", "CN-05", "CN-11", sql="""
WITH l AS (SELECT l_orderkey AS k, count(*) AS n, max(l_linenumber) AS last, min(l_linenumber) AS first, sum(l_extendedprice) AS total, bool_and(l_shipdate >= DATE '1992-01-01') AS dated FROM lineitem GROUP BY 1),
m AS (SELECT k, bool_and(ok) AS rising FROM (SELECT l_orderkey AS k, coalesce(l_shipdate >= lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate), true) AS ok FROM lineitem) GROUP BY 1),
c AS (SELECT o_orderkey, coalesce(n, 0) AS n, list_sort(list_filter([CASE WHEN NOT coalesce(first = 1, false) THEN 'starts_at_one' END, CASE WHEN NOT coalesce(last = n, false) THEN 'contiguous' END, CASE WHEN NOT coalesce(dated, false) THEN 'dates' END,
  CASE WHEN NOT coalesce(rising, false) THEN 'increasing' END, CASE WHEN NOT coalesce(total <= 1000000, false) THEN 'total' END, CASE WHEN NOT coalesce(o_orderstatus <> 'P' OR n >= 2, false) THEN 'accepted_implies_valid' END], lambda x: x IS NOT NULL)) AS f
  FROM orders LEFT JOIN l ON l.k = o_orderkey LEFT JOIN m ON m.k = o_orderkey)
SELECT o_orderkey, n, array_to_string(f, ',') AS failed, len(f) = 0 AS valid FROM c
""")  # fmt: skip
def named_checks(spark: SparkSession, d: str) -> DataFrame:
    """Named checks of a stage against the stage before it; the names of those that fail, sorted and joined."""
    x = load(spark, d, "lineitem")
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_shipdate")
    x = x.withColumn("ok", F.coalesce(F.col("l_shipdate") >= F.lag("l_shipdate").over(w), F.lit(True)))
    a = x.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.max("l_linenumber").alias("last"), F.min("l_linenumber").alias("first"), F.sum("l_extendedprice").alias("total"), F.bool_and(F.col("l_shipdate") >= F.lit("1992-01-01").cast("timestamp_ntz")).alias("dated"), F.bool_and("ok").alias("rising"))
    j = load(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(a, "o_orderkey", "left")
    failed = contracts.failed_checks(starts_at_one=F.col("first") == 1, contiguous=F.col("last") == F.col("n"), dates=F.col("dated"), increasing=F.col("rising"), total=F.col("total") <= 1_000_000, accepted_implies_valid=(F.col("o_orderstatus") != "P") | (F.col("n") >= 2))
    return j.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n"), failed.alias("failed"), (failed == "").alias("valid"))


@query("CN-06", "JN-12", "ST-04", "AG-34", sql="""
WITH man AS (SELECT doc_id % 20 AS build, doc_id AS path, n_chars AS bytes FROM documents WHERE doc_id % 37 <> 0), tree AS (SELECT doc_id % 20 AS build, doc_id AS path, CASE WHEN doc_id % 41 = 0 THEN n_chars + 1 ELSE n_chars END AS bytes FROM documents WHERE doc_id % 43 <> 0),
j AS (SELECT coalesce(m.build, t.build) AS build, m.path AS mp, t.path AS tp, m.bytes AS mb, t.bytes AS tb FROM man m FULL JOIN tree t ON m.path = t.path),
s AS (SELECT build, sha256(string_agg(CAST(path AS VARCHAR) || ':' || bytes, chr(10) ORDER BY path)) AS h, sum(bytes) AS total FROM man GROUP BY 1)
SELECT j.build, count(*) FILTER (WHERE tp IS NULL) AS missing, count(*) FILTER (WHERE mp IS NULL) AS unlisted, count(*) FILTER (WHERE mb <> tb) AS changed, CAST(any_value(total) AS BIGINT) AS bytes, any_value(h) AS signature,
  count(*) FILTER (WHERE tp IS NULL OR mp IS NULL OR mb <> tb) = 0 AS valid FROM j JOIN s ON s.build = j.build GROUP BY 1
""")  # fmt: skip
def build_verifier(spark: SparkSession, d: str) -> DataFrame:
    """A build's manifest against its tree: missing, unlisted and changed files, totals and an order-sensitive signature."""
    docs = load(spark, d, "documents").select(F.expr("doc_id % 20").alias("build"), F.col("doc_id").alias("path"), F.col("n_chars").alias("bytes"))
    man, tree = docs.where("path % 37 <> 0"), docs.where("path % 43 <> 0").withColumn("bytes", F.expr("case when path % 41 = 0 then bytes + 1 else bytes end"))
    faults = contracts.reconcile(man, tree, ["build", "path"], ["bytes"]).groupBy("build").agg(F.count_if(F.col("reason") == "MISSING_RIGHT").alias("missing"), F.count_if(F.col("reason") == "MISSING_LEFT").alias("unlisted"), F.count_if(F.col("reason") == "MISMATCH_bytes").alias("changed"))
    s = contracts.signature(man, ["build"], "path", ["bytes"]).join(man.groupBy("build").agg(F.sum("bytes").alias("bytes")), "build")
    j = s.join(faults, "build", "left").na.fill(0, ["missing", "unlisted", "changed"])
    return j.select("build", "missing", "unlisted", "changed", "bytes", "signature", (F.col("missing") + F.col("unlisted") + F.col("changed") == 0).alias("valid"))


@query("STM-03", sql="""
WITH m AS (SELECT user_id AS seq, event_type AS label, max(epoch_us(ts)) AS mtime, max(epoch_us(ts)) + user_id * 1000000 AS ctime FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2)
SELECT seq, count(*) AS markers, CASE WHEN count(*) = 3 AND max(greatest(mtime, ctime)) <= 1706572800000000 THEN 'ELIGIBLE' ELSE 'INCOMPLETE' END AS status,
  concat_ws(',', CASE WHEN count(*) <> 3 THEN 'MISSING' END, CASE WHEN max(mtime) > 1706572800000000 THEN 'LATE_MTIME' END, CASE WHEN max(ctime) > 1706572800000000 THEN 'LATE_CTIME' END) AS reasons FROM m GROUP BY 1
""")  # fmt: skip
def eligibility_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """Eligible only with all three markers, and both times of each at or before the cutoff."""
    cutoff = 1_706_572_800_000_000
    m = _events(spark, d).where("event_type in ('view', 'click', 'purchase')").groupBy(F.col("user_id").alias("seq"), "event_type").agg(F.max("us").alias("mtime")).withColumn("ctime", F.col("mtime") + F.col("seq") * 1_000_000)
    g = m.groupBy("seq").agg(F.count("*").alias("markers"), F.max("mtime").alias("m"), F.max("ctime").alias("c"))
    why = status.reasons(("MISSING", F.col("markers") != 3), ("LATE_MTIME", F.col("m") > cutoff), ("LATE_CTIME", F.col("c") > cutoff))
    return g.select("seq", "markers", F.when(F.size(why) == 0, "ELIGIBLE").otherwise("INCOMPLETE").alias("status"), F.array_join(why, ",").alias("reasons"))


@query("STM-08", "WN-02", "WN-16", sql="""
WITH days AS (SELECT unnest(range(19723, 19753)) AS day), seen AS (SELECT DISTINCT user_id, epoch_us(ts) // 86400000000 AS day FROM events), u AS (SELECT DISTINCT user_id FROM events),
miss AS (SELECT user_id, day FROM u, days WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.day = days.day)),
g AS (SELECT user_id, min(day) AS s, count(*) AS n FROM (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM miss) GROUP BY user_id, k)
SELECT user_id, max(n) AS longest, count(*) FILTER (WHERE n >= 3) AS confirmed, least(count(*) FILTER (WHERE n >= 3), 2) AS restarts FROM g GROUP BY 1
""")  # fmt: skip
def absence_confirm(spark: SparkSession, d: str) -> DataFrame:
    """Runs of days without an event; three in a row confirm an absence; restarts are capped at two."""
    seen = _events(spark, d).select("user_id", F.expr(f"us div {DAY_US}").alias("day")).distinct()
    miss = seen.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(19723).cast("long"), F.lit(19752).cast("long"))).alias("day")).join(seen, ["user_id", "day"], "left_anti")
    return islands(miss, ["user_id"], "day").groupBy("user_id").agg(F.max("length").alias("longest"), F.count_if(F.col("length") >= 3).alias("confirmed"), F.least(F.count_if(F.col("length") >= 3), F.lit(2)).alias("restarts"))


@query("STM-09", "STM-16", sql="""
WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, max(epoch_us(ts)) AS last, max(value) AS top FROM events GROUP BY 1)
SELECT user_id, 'ERRORS' AS code, 'HIGH' AS severity, errors || ' errors' AS message FROM u WHERE errors > 15 UNION ALL SELECT user_id, 'IDLE', 'MEDIUM', 'idle since ' || last FROM u WHERE last < 1706486400000000
UNION ALL SELECT user_id, 'SPARSE', 'LOW', n || ' events' FROM u WHERE n < 60 UNION ALL SELECT user_id, 'SPIKE', 'LOW', 'value over 300' FROM u WHERE top > 300
""")  # fmt: skip
def attention_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules over joined state, a row for each that applies."""
    u = _events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("us").alias("last"), F.max("value").alias("top"))
    rule = lambda c, code, sev, msg: F.when(c, F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"), msg.alias("message")))
    rules = F.array(
        rule(F.col("errors") > 15, "ERRORS", "HIGH", F.concat(F.col("errors"), F.lit(" errors"))), rule(F.col("last") < 1_706_486_400_000_000, "IDLE", "MEDIUM", F.concat(F.lit("idle since "), F.col("last"))),
        rule(F.col("n") < 60, "SPARSE", "LOW", F.concat(F.col("n"), F.lit(" events"))), rule(F.col("top") > 300, "SPIKE", "LOW", F.lit("value over 300")),
    )
    return u.select("user_id", F.explode(F.array_compact(rules)).alias("r")).select("user_id", "r.*")


@query("STM-07", sql="""
WITH g AS (SELECT user_id, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 21600000000 THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, us, sum(fresh) OVER (PARTITION BY user_id ORDER BY us) AS k FROM g) SELECT user_id, min(us) AS start_us, max(us) + 21600000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, k
""")  # fmt: skip
def sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with a gap of six hours, by session_window."""
    e = load(spark, d, "events").select("user_id", F.timestamp_micros(micros("ts")).alias("t"))
    s = e.groupBy("user_id", F.session_window("t", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n")


@query("STM-07", "WN-12", sql="""
SELECT event_type, (epoch_us(ts) // 86400000000) * 86400000000 AS start_us, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2
""")  # fmt: skip
def tumbling_windows(spark: SparkSession, d: str) -> DataFrame:
    """Days as tumbling windows (a Spark-native addition)."""
    e = load(spark, d, "events").select("event_type", "value", F.timestamp_micros(micros("ts")).alias("t"))
    s = e.groupBy("event_type", F.window("t", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return s.select("event_type", F.unix_micros("w.start").alias("start_us"), "n", "total")


@query("STM-07", sql="""
SELECT event_type, s * 43200000000 AS start_us, count(*) AS n FROM (SELECT event_type, unnest([epoch_us(ts) // 43200000000, epoch_us(ts) // 43200000000 - 1]) AS s FROM events) GROUP BY 1, 2
""")  # fmt: skip
def sliding_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of a day every half day (a Spark-native addition)."""
    e = load(spark, d, "events").select("event_type", F.timestamp_micros(micros("ts")).alias("t"))
    return e.groupBy("event_type", F.window("t", "1 day", "12 hours").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.unix_micros("w.start").alias("start_us"), "n")


@query("STM-17", sql="""
WITH s AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, round(avg(value), 6) AS eta, count(DISTINCT event_type) AS code FROM events GROUP BY 1, 2), l AS (SELECT *, lag(eta) OVER w AS p, lag(code) OVER w AS pc, lag(day) OVER w AS pd FROM s WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, day, concat_ws(',', CASE WHEN eta - p > 60 THEN 'ETA_WORSE' END, CASE WHEN code <> pc THEN 'CODE_DRIFT' END, CASE WHEN day - pd > 2 THEN 'STALE' END) AS rules FROM l
""")  # fmt: skip
def snapshot_regression(spark: SparkSession, d: str) -> DataFrame:
    """Each snapshot against the one before it."""
    s = _events(spark, d).groupBy("user_id", F.expr(f"us div {DAY_US}").alias("day")).agg(F.round(F.avg("value"), 6).alias("eta"), F.count_distinct("event_type").alias("code"))
    w = W.partitionBy("user_id").orderBy("day")
    rules = status.reasons(("ETA_WORSE", F.col("eta") - F.lag("eta").over(w) > 60), ("CODE_DRIFT", F.col("code") != F.lag("code").over(w)), ("STALE", F.col("day") - F.lag("day").over(w) > 2))
    return s.select("user_id", "day", F.array_join(rules, ",").alias("rules"))


@query("STM-01", "STM-02", sql="""
SELECT user_id, count(DISTINCT event_type) AS arrived, count(DISTINCT event_type) = 5 AS ready, CASE WHEN count(DISTINCT event_type) = 5 THEN max(f) END AS ready_us FROM (SELECT user_id, event_type, min(epoch_us(ts)) AS f FROM events GROUP BY 1, 2) GROUP BY 1
""")  # fmt: skip
def readiness(spark: SparkSession, d: str) -> DataFrame:
    """When the last of five required artifacts had arrived: the batch twin of the readiness stream."""
    f = _events(spark, d).groupBy("user_id", "event_type").agg(F.min("us").alias("f"))
    return f.groupBy("user_id").agg(F.count("*").alias("arrived"), (F.count("*") == 5).alias("ready"), F.when(F.count("*") == 5, F.max("f")).alias("ready_us"))


@query("STM-12", "SNK-09", "JN-11", sql="""
WITH s AS (SELECT o_custkey AS k, sha256(string_agg(CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus, chr(10) ORDER BY o_orderkey)) AS sig FROM orders GROUP BY 1),
old AS (SELECT o_custkey AS k, sha256(string_agg(CAST(o_orderkey AS VARCHAR) || ':' || CASE WHEN o_orderkey % 29 = 0 THEN 'X' ELSE o_orderstatus END, chr(10) ORDER BY o_orderkey)) AS sig FROM orders WHERE o_custkey % 8 <> 5 GROUP BY 1)
SELECT s.k, s.sig FROM s WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.k = s.k AND old.sig = s.sig)
""")  # fmt: skip
def idempotent_resume(spark: SparkSession, d: str) -> DataFrame:
    """Items whose finished result is missing or was made from something else."""
    o = load(spark, d, "orders")
    now = contracts.signature(o, ["o_custkey"], "o_orderkey", ["o_orderstatus"])
    old = contracts.signature(o.where("o_custkey % 8 <> 5").withColumn("o_orderstatus", F.expr("case when o_orderkey % 29 = 0 then 'X' else o_orderstatus end")), ["o_custkey"], "o_orderkey", ["o_orderstatus"])
    return contracts.not_yet_done(now, old, ["o_custkey"], "signature").select(F.col("o_custkey").alias("k"), F.col("signature").alias("sig"))


@query("STM-04", sql="""
WITH d AS (SELECT user_id, count(DISTINCT event_type) FILTER (WHERE epoch_us(ts) <= 1704412800000000) AS a, count(DISTINCT event_type) FILTER (WHERE epoch_us(ts) <= 1704672000000000) AS b, count(DISTINCT event_type) FILTER (WHERE epoch_us(ts) <= 1704931200000000) AS c FROM events GROUP BY 1)
SELECT user_id, CASE WHEN a = 5 THEN 1 WHEN b = 5 THEN 2 ELSE 3 END AS attempt, CASE WHEN greatest(a, b, c) = 5 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS published FROM d
""")  # fmt: skip
def deferred_publish(spark: SparkSession, d: str) -> DataFrame:
    """Up to three attempts at growing times; the last publishes what there is, truthfully incomplete."""
    at = [1_704_412_800_000_000, 1_704_672_000_000_000, 1_704_931_200_000_000]
    f = _events(spark, d).groupBy("user_id", "event_type").agg(F.min("us").alias("f"))
    g = f.groupBy("user_id").agg(*[F.count_if(F.col("f") <= t).alias(c) for t, c in zip(at, "abc")])
    return g.select("user_id", F.when(F.col("a") == 5, 1).when(F.col("b") == 5, 2).otherwise(3).alias("attempt"), F.when(F.greatest("a", "b", "c") == 5, "COMPLETE").otherwise("INCOMPLETE").alias("published"))


_EDGES = "SELECT DISTINCT p_partkey AS a, l_suppkey + 1000000000 AS b FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49 AND l_discount >= 0.09"


@query("GR-01", sql=f"""
WITH RECURSIVE e AS ({_EDGES}), bw AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS c FROM bw UNION SELECT bw.b, r.c FROM r JOIN bw ON bw.a = r.id)
SELECT id, min(c) AS component FROM r GROUP BY 1
""")  # fmt: skip
def components(spark: SparkSession, d: str) -> DataFrame:
    """Components of the graph of parts and suppliers over their largest, most discounted lines."""
    e = load(spark, d, "lineitem").where("l_quantity >= 49 and l_discount >= 0.09").join(load(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_partkey").alias("a"), (F.col("l_suppkey") + 1_000_000_000).alias("b")).distinct()
    return graph.connected_components(e.select(F.explode(F.array("a", "b")).alias("id")), e)


@query("GR-01")
def components_whole(spark: SparkSession, d: str) -> DataFrame:
    """Components of the graph of all parts and suppliers with a line, and which of them one part and one supplier make.

    There is no SQL: a recursive one holds every pair of connected nodes.
    """
    e = load(spark, d, "lineitem").join(load(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_partkey").alias("a"), (F.col("l_suppkey") + 1_000_000_000).alias("b")).distinct()
    members = e.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("camera", F.when(F.col("id") < 1_000_000_000, "part").otherwise("supplier"))
    labels = graph.connected_components(members, e)
    return labels.join(graph.accepted_components(labels, members), "component").select("id", "component", "members", "status")


@query("GR-03", sql="""
WITH t AS (SELECT l_suppkey AS track, count(*) AS views, min(l_tax) AS depth, stddev_pop(l_discount) AS parallax, median(l_quantity) AS med, CAST(floor(avg(l_extendedprice) / 100) AS BIGINT) AS cell, max(l_extendedprice) AS q FROM lineitem GROUP BY 1),
lim AS (SELECT m + 3 * 1.4826 * greatest((SELECT median(abs(t.med - x.m)) FROM t, (SELECT median(med) AS m FROM t) x), 1e-9) AS v FROM (SELECT median(med) AS m FROM t)),
r AS (SELECT t.*, CASE WHEN views < 560 THEN 'VIEWS' WHEN depth < 0 THEN 'CHEIRALITY' WHEN parallax < 0.031 THEN 'PARALLAX' WHEN med > v THEN 'RESIDUAL' WHEN row_number() OVER (PARTITION BY cell, views < 560 OR depth < 0 OR parallax < 0.031 OR med > v ORDER BY q DESC, track) > 1 THEN 'NEAR_DUPLICATE' ELSE 'KEPT' END AS reason FROM t, lim)
SELECT reason, count(*) AS n FROM r GROUP BY 1
""")  # fmt: skip
def reject_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Counts by the first test that a track fails; the best of each cell stays."""
    t = load(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("track")).agg(
        F.count("*").alias("views"), F.min("l_tax").alias("depth"), F.stddev_pop("l_discount").alias("parallax"), F.percentile("l_quantity", 0.5).alias("med"), F.floor(F.avg("l_extendedprice") / 100).alias("cell"), F.max("l_extendedprice").alias("q"),
    )
    t = t.crossJoin(F.broadcast(robust.mad(t, [], "med", 3.0).select(F.col("threshold").alias("v"))))  # one row
    first = F.when(F.col("views") < 560, "VIEWS").when(F.col("depth") < 0, "CHEIRALITY").when(F.col("parallax") < 0.031, "PARALLAX").when(F.col("med") > F.col("v"), "RESIDUAL")
    t = t.withColumn("first", first)
    place = F.row_number().over(W.partitionBy("cell", F.col("first").isNull()).orderBy(F.desc("q"), "track"))
    return t.select(F.coalesce("first", F.when(place > 1, "NEAR_DUPLICATE").otherwise("KEPT")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SO-04", "WN-02", sql="""
WITH s AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE value > 150), i AS (SELECT user_id, us - 7200000000 AS a, us + 7200000000 AS b FROM s),
m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM i), g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY a, b) AS k FROM m)
SELECT user_id, min(a) AS start, max(b) AS "end" FROM g GROUP BY user_id, k
""")  # fmt: skip
def padded_clips(spark: SparkSession, d: str) -> DataFrame:
    """Candidates padded by two hours on both sides and merged into clips."""
    s = _events(spark, d).where("value > 150").select("user_id", (F.col("us") - 7_200_000_000).alias("a"), (F.col("us") + 7_200_000_000).alias("b"))
    return merged_intervals(s, ["user_id"], "a", "b")


@query("AG-35", "AG-06", "FN-10", "AG-14", "AG-36", "FN-22", sql="""
WITH v AS (SELECT user_id AS st, event_type AS c, epoch_us(ts) // 86400000000 AS day, avg(value) AS m, count(*) AS n FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2, 3),
o AS (SELECT a.st, a.c AS x, b.c AS y, a.day, a.m - b.m AS off, greatest(least(1, (a.n + b.n) / 6), 0.05) AS cf FROM v a JOIN v b ON a.st = b.st AND a.day = b.day AND a.c < b.c),
s AS (SELECT st, x, y, count(*) AS n, sum(cf * cf) AS sw, sum(cf * cf * day) AS sx, sum(cf * cf * off) AS sy, sum(cf * cf * day * day) AS sxx, sum(cf * cf * day * off) AS sxy, max(day) - min(day) AS span FROM o GROUP BY 1, 2, 3),
l AS (SELECT *, CASE WHEN n >= 3 AND sw * sxx - sx * sx > 1e-6 THEN (sw * sxy - sx * sy) / (sw * sxx - sx * sx) END AS slope FROM s),
p AS (SELECT st, x, y, n, round(slope, 4) AS slope, CASE WHEN slope IS NULL OR span < 3 THEN 'INSUFFICIENT' WHEN abs(slope * span) > 60 THEN 'CLOCK_DRIFT_DETECTED' WHEN abs(sy / sw) > 30 THEN 'CONSTANT_OFFSET' ELSE 'STABLE' END AS class FROM l)
SELECT st, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS measurements, CASE max(CASE class WHEN 'STABLE' THEN 0 WHEN 'CONSTANT_OFFSET' THEN 1 WHEN 'CLOCK_DRIFT_DETECTED' THEN 2 ELSE 3 END) WHEN 0 THEN 'STABLE' WHEN 1 THEN 'CONSTANT_OFFSET' WHEN 2 THEN 'CLOCK_DRIFT_DETECTED' ELSE 'INSUFFICIENT' END AS worst,
  count(*) FILTER (WHERE class = 'CLOCK_DRIFT_DETECTED') AS drifting FROM p GROUP BY 1
""")  # fmt: skip
def full_timing_audit(spark: SparkSession, d: str) -> DataFrame:
    """Offsets of channel pairs by day, a weighted line through them, a class for each pair and the worst for the set."""
    from tidemark.operators.sequences import worst

    v = _events(spark, d).where("event_type in ('view', 'click', 'purchase')").groupBy(F.col("user_id").alias("st"), F.col("event_type").alias("c"), F.expr(f"us div {DAY_US}").alias("day")).agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    a, b = v.select("st", "day", F.col("c").alias("x"), F.col("m").alias("m1"), F.col("n").alias("n1")), v.select("st", "day", F.col("c").alias("y"), F.col("m").alias("m2"), F.col("n").alias("n2"))
    o = a.join(b, ["st", "day"]).where("x < y").select("st", "x", "y", "day", (F.col("m1") - F.col("m2")).alias("off"), F.greatest(F.least(F.lit(1.0), (F.col("n1") + F.col("n2")) / 6), F.lit(0.05)).alias("cf"))
    w = F.col("cf") * F.col("cf")
    s = o.groupBy("st", "x", "y").agg(F.count("*").alias("n"), (F.max("day") - F.min("day")).alias("span"), *[c.alias(k) for k, c in robust.line_sums(F.col("day"), F.col("off"), w).items()])
    det = F.expr("sw * sxx - sx * sx")
    s = s.withColumn("slope", F.when((F.col("n") >= 3) & (det > 1e-6), F.expr("sw * sxy - sx * sy") / det))
    cls = F.when(F.col("slope").isNull() | (F.col("span") < 3), "INSUFFICIENT").when(F.abs(F.col("slope") * F.col("span")) > 60, "CLOCK_DRIFT_DETECTED").when(F.abs(F.col("sy") / F.col("sw")) > 30, "CONSTANT_OFFSET").otherwise("STABLE")
    order = ["STABLE", "CONSTANT_OFFSET", "CLOCK_DRIFT_DETECTED", "INSUFFICIENT"]
    p = s.withColumn("class", cls)
    return p.groupBy("st").agg(F.count("*").alias("pairs"), F.sum("n").alias("measurements"), worst(F.col("class"), {k: i for i, k in enumerate(order)}, dict(enumerate(order))).alias("worst"), F.count_if(F.col("class") == "CLOCK_DRIFT_DETECTED").alias("drifting"))


@query("SRC-11", "SRC-13", "SRC-14", "WN-18", sql="""
WITH c AS (SELECT l_suppkey % 10 AS seq, l_linenumber AS chunk, count(*) AS frames, bool_and(l_quantity > 0) AS valid FROM lineitem GROUP BY 1, 2), e AS (SELECT s AS seq, k AS chunk FROM (SELECT unnest(range(10)) AS s), (SELECT unnest(range(1, 9)) AS k))
SELECT CAST(e.seq AS BIGINT) AS seq, CAST(sum(coalesce(frames, 0)) AS BIGINT) AS frames, count(*) FILTER (WHERE c.chunk IS NULL) AS missing, count(c.chunk) = 7 AND bool_and(coalesce(valid, true)) AS complete FROM e LEFT JOIN c ON c.seq = e.seq AND c.chunk = e.chunk GROUP BY 1
""")  # fmt: skip
def chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Expected chunks against those there are; a sequence counts only with all of its valid chunks."""
    c = load(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("seq"), F.col("l_linenumber").alias("chunk")).agg(F.count("*").alias("frames"), F.bool_and(F.col("l_quantity") > 0).alias("valid"))
    e = spark.range(10).select(F.col("id").alias("seq"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("chunk"))
    j = e.join(c.withColumn("hit", F.lit(1)), ["seq", "chunk"], "left")
    return j.groupBy("seq").agg(F.sum(F.coalesce("frames", F.lit(0))).alias("frames"), F.count_if(F.col("hit").isNull()).alias("missing"), ((F.count("hit") == 7) & F.bool_and(F.coalesce("valid", F.lit(True)))).alias("complete"))


@query("SRC-09", "SNK-03", sql="""
SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY lpad(CAST(event_id AS VARCHAR), 9, '0')) - 1 AS frame_index, CASE WHEN user_id % 10 < 7 THEN 'train' WHEN user_id % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM events
""")  # fmt: skip
def frame_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Frames in the order of their names, numbered within each series, with the split of their group."""
    e = _events(spark, d)
    w = W.partitionBy("user_id", "event_type").orderBy(F.lpad(F.col("event_id").cast("string"), 9, "0"))
    k = F.col("user_id") % 10
    return e.select("user_id", "event_type", "event_id", (F.row_number().over(w) - 1).cast("long").alias("frame_index"), F.when(k < 7, "train").when(k < 9, "val").otherwise("test").alias("split"))
