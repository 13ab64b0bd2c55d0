"""Queries of projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import boxes, scalars, status
from tidemark.plans.registry import query
from tidemark.tables import load, micros


def _events(spark, d) -> DataFrame:
    return load(spark, d, "events")


@query("PF-01", "PF-02", "FN-07", "FN-08", sql=r"""
WITH k AS (SELECT event_id, value, TRY_CAST(props::JSON ->> '$.k' AS DOUBLE) AS k, CASE event_id % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN (event_id % 97) || '/' || (event_id % 7) WHEN 2 THEN ' ' || event_id || ' ' WHEN 3 THEN '' ELSE 'inf' END AS raw FROM events),
v AS (SELECT *, CASE event_id % 5 WHEN 1 THEN CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 97) / (event_id % 7) END WHEN 2 THEN CAST(event_id AS DOUBLE) END AS num FROM k)
SELECT event_id, CAST(k AS BIGINT) AS k, round(num, 9) AS num, round_even(num, 1) AS rounded, CASE WHEN k >= 75 THEN 'HIGH' WHEN k >= 45 THEN 'MEDIUM' ELSE 'LOW' END AS band,
  round(least(greatest((value - 10) / 190, 0), 1) * CASE WHEN k < 5 THEN 0.25 ELSE 1 END, 6) AS confidence FROM v
""")  # fmt: skip
def coerce_bands(spark: SparkSession, d: str) -> DataFrame:
    """Texts to numbers (fractions, blanks, N/A, infinities), half-even rounding, confidence bands and clipped ramps."""
    raw = F.expr("case event_id % 5 when 0 then 'N/A' when 1 then concat(event_id % 97, '/', event_id % 7) when 2 then concat(' ', event_id, ' ') when 3 then '' else 'inf' end")
    k = F.get_json_object("props", "$.k").try_cast("double")
    e = _events(spark, d).select("event_id", "value", k.alias("k"), scalars.to_number(raw).alias("num"))
    conf = status.ramp(F.col("value"), 10, 200) * F.when(F.col("k") < 5, 0.25).otherwise(1.0)
    return e.select("event_id", F.col("k").cast("long").alias("k"), F.round("num", 9).alias("num"), scalars.rounded(F.col("num"), 1).alias("rounded"), status.confidence_level(F.col("k") / 100).alias("band"), F.round(conf, 6).alias("confidence"))


@query("PF-03", "PF-05", "STM-14", sql=r"""
WITH t AS (SELECT event_id, lower(event_type) AS kind, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'dev' || event_id % 4 END AS stream, 'c' || event_id % 6 AS container FROM events)
SELECT event_id, coalesce(nullif(stream, ''), container, 'UNKNOWN') AS device, kind || ';' || coalesce(nullif(stream, ''), container) AS merged, 'kind=' || kind AS kept FROM t
""")  # fmt: skip
def tag_maps(spark: SparkSession, d: str) -> DataFrame:
    """Tags of two sources with folded keys, the later one overriding, a priority list of keys, and ignored keys dropped."""
    e = _events(spark, d)
    stream = F.when(F.expr("event_id % 3 = 0"), F.lit("")).otherwise(F.concat(F.lit("dev"), F.expr("event_id % 4")))
    container = F.transform_keys(F.create_map(F.lit("Device"), F.concat(F.lit("c"), F.expr("event_id % 6")), F.lit("KIND"), F.lower("event_type")), lambda k, v: F.lower(k))
    own = F.map_filter(F.create_map(F.lit("device"), stream), lambda k, v: v != "")
    only_container = F.map_filter(container, lambda k, v: ~F.map_contains_key(own, "device") | (k != "device"))
    merged = F.map_concat(only_container, own)
    kept = F.map_filter(merged, lambda k, v: ~F.array_contains(F.array(F.lit("device")), k))
    pairs = F.array_join(F.transform(F.map_entries(kept), lambda x: F.concat_ws("=", x["key"], x["value"])), ",")
    return e.select("event_id", F.coalesce(F.try_element_at(merged, F.lit("device")), F.lit("UNKNOWN")).alias("device"), F.concat_ws(";", F.try_element_at(merged, F.lit("kind")), F.try_element_at(merged, F.lit("device"))).alias("merged"), pairs.alias("kept"))


@query("PF-04", "FN-02", "FN-14", sql=r"""
SELECT p_partkey, (CAST(p_size AS BIGINT) * 90 - 360) % 360 + CASE WHEN (CAST(p_size AS BIGINT) * 90 - 360) % 360 < 0 THEN 360 ELSE 0 END AS rotation, CASE WHEN p_size % 4 IN (1, 3) THEN 1080 ELSE 1920 END AS width, CASE WHEN p_size % 4 IN (1, 3) THEN 1920 ELSE 1080 END AS height,
  regexp_replace(replace(p_name, ' ', '_'), '_[^_]*$', '') AS exercise, regexp_extract(p_brand, '([0-9])([0-9])', 1) AS maker FROM part
""")  # fmt: skip
def derive_case(spark: SparkSession, d: str) -> DataFrame:
    """Rotation into [0, 360), sides swapped at 90 and 270, names without their last part, digits of a brand."""
    rot = scalars.rotation_degrees(F.col("p_size").cast("double") * 90 - 360)
    p = load(spark, d, "part").withColumn("rotation", rot)
    side = F.when(F.col("rotation").isin(90, 270), F.struct(F.lit(1080).alias("w"), F.lit(1920).alias("h"))).otherwise(F.struct(F.lit(1920).alias("w"), F.lit(1080).alias("h")))
    return p.select("p_partkey", "rotation", side["w"].alias("width"), side["h"].alias("height"), scalars.without_last_part(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("exercise"), F.regexp_extract("p_brand", "([0-9])([0-9])", 1).alias("maker"))


@query("PF-06", "PF-10", "PF-12", "PF-14", "FN-01", "FN-03", "FN-04", sql=r"""
WITH a AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN ['python', 'run.py', '--out', url] WHEN 1 THEN ['python', 'run.py', '--out=' || url] WHEN 2 THEN ['python', 'other.py'] ELSE ['run.py', '--resume'] END AS argv,
  CASE page_id % 5 WHEN 0 THEN 'a.json.tmp' WHEN 1 THEN '.hidden' WHEN 2 THEN 'x.Lock' WHEN 3 THEN 'a/b' ELSE 'clip_01.mp4' END AS name, ' cam1, ,cam' || page_id % 3 || ',' AS csv FROM pages)
SELECT page_id, contains(url, 'blog') OR contains(url, '/de/') AS wanted, page_id % 5 < 3 AS transient, page_id % 5 <> 3 AS safe, array_to_string(list_filter(list_transform(string_split(csv, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items, page_id % 3 = 1 AS repeated,
  CASE WHEN page_id % 4 < 2 THEN url END AS out, page_id % 4 IN (0, 1, 3) AS valid, replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped,
  printf('%dh %02dm %02ds', page_id * 37 // 3600, page_id * 37 % 3600 // 60, page_id * 37 % 60) AS duration FROM a
""")  # fmt: skip
def string_predicates(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "pages").select("page_id", "url")
    argv = F.expr("case page_id % 4 when 0 then array('python', 'run.py', '--out', url) when 1 then array('python', 'run.py', concat('--out=', url)) when 2 then array('python', 'other.py') else array('run.py', '--resume') end")
    name = F.expr("case page_id % 5 when 0 then 'a.json.tmp' when 1 then '.hidden' when 2 then 'x.Lock' when 3 then 'a/b' else 'clip_01.mp4' end")
    items = scalars.list_of(F.concat(F.lit(" cam1, ,cam"), F.expr("page_id % 3"), F.lit(",")))
    wanted = F.exists(F.array(F.lit("blog"), F.lit("/de/")), lambda t: F.contains(F.col("url"), t))
    seconds = F.col("page_id") * 37
    return p.select(
        "page_id", wanted.alias("wanted"), scalars.transient_name(name).alias("transient"), scalars.safe_component(name).alias("safe"), F.array_join(items, "|").alias("items"), (F.size(items) != F.size(F.array_distinct(items))).alias("repeated"),
        scalars.option(argv, "--out").alias("out"), F.exists(argv, lambda a: a == "run.py").alias("valid"), scalars.xml_escape(F.col("url")).alias("escaped"), scalars.human_duration(seconds).alias("duration"),
    )


@query("PF-07", "FN-15", "CN-01", sql="""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, vec_id % 9 <> 0 AS valid FROM embeddings)
SELECT vec_id, valid AND list_bool_and(list_transform(e, lambda x: isfinite(x))) AND abs(e[1]) >= 0.05 AS usable, CASE WHEN valid THEN list_bool_and(list_transform(e, lambda x: isfinite(x))) ELSE true END AS contract,
  concat_ws(',', CASE WHEN len(e) <> 64 THEN 'SHAPE' END, CASE WHEN label NOT BETWEEN 0 AND 8 THEN 'DOMAIN' END, CASE WHEN NOT valid THEN 'INVALID' END) AS reasons FROM v
""".replace("list_bool_and(", "list_aggregate(").replace("isfinite(x))", "isfinite(x)), 'bool_and'"))  # fmt: skip
def finite_contract(spark: SparkSession, d: str) -> DataFrame:
    """Usable rows, valid => all finite and invalid => all missing, and a contract's reasons."""
    e = load(spark, d, "embeddings").withColumn("valid", F.expr("vec_id % 9 <> 0"))
    e = e.withColumn("v", F.when(F.col("valid"), F.col("embedding")).otherwise(F.transform("embedding", lambda x: F.lit(float("nan")).cast("float"))))
    fin = F.forall("v", lambda x: scalars.finite(x.cast("double")))
    contract = F.when(F.col("valid"), fin).otherwise(F.forall("v", lambda x: F.isnan(x)))
    why = status.reasons(("SHAPE", F.size("v") != 64), ("DOMAIN", ~F.col("label").between(0, 8)), ("INVALID", ~F.col("valid")))
    return e.select("vec_id", (F.col("valid") & fin & (F.abs(F.col("embedding")[0]) >= 0.05)).alias("usable"), contract.alias("contract"), F.array_join(why, ",").alias("reasons"))


_BOXES = """
b AS (SELECT vec_id, i, least(e[4 * i + 1], e[4 * i + 3]) AS x1, least(e[4 * i + 2], e[4 * i + 4]) AS y1, greatest(e[4 * i + 1], e[4 * i + 3]) AS x2, greatest(e[4 * i + 2], e[4 * i + 4]) AS y2
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, unnest(range(16)) AS i FROM embeddings)),
p AS (SELECT a.vec_id, a.i, b.i AS j, a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1, b.y1, b.x2, b.y2, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS n,
  (a.x2 - a.x1) * (a.y2 - a.y1) AS s, (b.x2 - b.x1) * (b.y2 - b.y1) AS t FROM b a JOIN b ON a.vec_id = b.vec_id AND {on}),
g AS (SELECT *, CASE WHEN s + t - n <> 0 THEN n / (s + t - n) ELSE 0 END AS iou, CASE WHEN least(s, t) <> 0 THEN n / least(s, t) ELSE 0 END AS con, greatest(ax2 - ax1, 1e-6) * greatest(ay2 - ay1, 1e-6) AS aa, greatest(x2 - x1, 1e-6) * greatest(y2 - y1, 1e-6) AS ba,
  greatest(ax2 - ax1, 1e-6) / greatest(ay2 - ay1, 1e-6) AS ar, greatest(x2 - x1, 1e-6) / greatest(y2 - y1, 1e-6) AS br, sqrt(power((ax1 + ax2) / 2 - (x1 + x2) / 2, 2) + power((ay1 + ay2) / 2 - (y1 + y2) / 2, 2)) AS dist FROM p)
"""


def _boxes(spark, d) -> DataFrame:
    b = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), boxes.from_corners(F.col("embedding"), 4 * i).alias("box")) for i in range(16)]))
    return load(spark, d, "embeddings").select("vec_id", b.alias("b")).select("vec_id", "b.i", "b.box")


def _box_pairs(spark, d, both: bool = False) -> DataFrame:
    b = _boxes(spark, d)
    a, o = b.select("vec_id", F.col("i"), F.col("box").alias("a")), b.select("vec_id", F.col("i").alias("j"), F.col("box").alias("o"))
    return a.join(o, "vec_id").where("i <> j" if both else "i < j")


@query("FN-12", "PF-08", "JN-07", sql=f"""
WITH {_BOXES.format(on="a.i < b.i")}
SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(iou, 6) AS iou, round(con, 6) AS containment, iou >= 0.65 OR (con >= 0.8 AND CASE WHEN greatest(s, t) <> 0 THEN least(s, t) / greatest(s, t) ELSE 0 END >= 0.2) AS duplicate FROM g
""")  # fmt: skip
def box_iou_matrix(spark: SparkSession, d: str) -> DataFrame:
    a, o = F.col("a"), F.col("o")
    return _box_pairs(spark, d).select("vec_id", "i", "j", F.round(boxes.iou(a, o), 6).alias("iou"), F.round(boxes.containment(a, o), 6).alias("containment"), boxes.duplicate(a, o).alias("duplicate"))


@query("PF-09", sql=f"""
WITH {_BOXES.format(on="a.i <> b.i")}
SELECT vec_id, CAST(i AS INTEGER) AS i, bool_or(iou >= 0.05 OR con >= 0.15 OR dist <= 0.65 * sqrt(aa)) AS risk FROM g GROUP BY 1, 2
""")  # fmt: skip
def occlusion_flag(spark: SparkSession, d: str) -> DataFrame:
    return _box_pairs(spark, d, True).groupBy("vec_id", "i").agg(F.bool_or(boxes.occludes(F.col("a"), F.col("o"))).alias("risk"))


@query("FN-13", sql=f"""
WITH {_BOXES.format(on="b.i = a.i + 1")}
SELECT vec_id, CAST(i AS INTEGER) AS i, round(CASE WHEN iou < 0.005 AND dist > 0.16 + 0.06 * (i % 4) OR abs(ln(greatest(ba, 1e-9) / greatest(aa, 1e-9))) > 1.35 + 0.15 * (i % 4) THEN 0 ELSE exp(-0.12 * (i % 4)) * (0.5 * iou + 0.25 * exp(-power(dist / (0.1 + 0.04 * (i % 4 + 1)), 2))
  + 0.15 * exp(-abs(ln(greatest(ba, 1e-9) / greatest(aa, 1e-9))) / 0.5) + 0.1 * exp(-abs(ln(greatest(br, 1e-9) / greatest(ar, 1e-9))) / 0.55)) END, 6) AS affinity FROM g
""")  # fmt: skip
def affinity(spark: SparkSession, d: str) -> DataFrame:
    b = _boxes(spark, d)
    n = b.select("vec_id", (F.col("i") - 1).alias("i"), F.col("box").alias("o"))
    return b.withColumnRenamed("box", "a").join(n, ["vec_id", "i"]).select("vec_id", "i", F.round(boxes.affinity(F.col("a"), F.col("o"), F.col("i") % 4 + 1), 6).alias("affinity"))


@query("FN-14", "JN-19", sql="""
WITH j AS (SELECT vec_id, i AS j, e[3 * i + 1] AS x, abs(e[3 * i + 2]) AS q, e[3 * i + 3] > -0.1 AS valid FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, unnest(range(21)) AS i FROM embeddings)),
m(name, a, b) AS (VALUES ('pelvis', 0, 1), ('neck', 5, 6), ('mid', 11, 12)), u AS (
SELECT vec_id, 'joint' || j AS name, x, q, valid FROM j UNION ALL SELECT p.vec_id, m.name, (p.x + r.x) / 2, least(p.q, r.q), p.valid AND r.valid FROM m JOIN j p ON p.j = m.a JOIN j r ON r.j = m.b AND r.vec_id = p.vec_id)
SELECT vec_id, name, round(x, 6) AS x, round(q, 6) AS q, valid FROM u
""")  # fmt: skip
def midpoint_derived(spark: SparkSession, d: str) -> DataFrame:
    """Direct joints and joints derived as midpoints: mean of the values, both valid, the lesser quality."""
    e = F.col("embedding")
    j = load(spark, d, "embeddings").select("vec_id", F.explode(F.array(*[F.struct(F.lit(i).alias("j"), e[3 * i].cast("double").alias("x"), F.abs(e[3 * i + 1].cast("double")).alias("q"), (e[3 * i + 2].cast("double") > -0.1).alias("valid")) for i in range(21)])).alias("s")).select("vec_id", "s.*")
    m = spark.createDataFrame([("pelvis", 0, 1), ("neck", 5, 6), ("mid", 11, 12)], "name string, a int, b int")
    at = lambda c, p: j.select("vec_id", F.col("j").alias(c), *[F.col(x).alias(p + x) for x in ("x", "q", "valid")])
    made = F.broadcast(m).join(at("a", "p_"), "a").join(at("b", "r_"), ["vec_id", "b"])  # three rows
    derived = made.select("vec_id", "name", ((F.col("p_x") + F.col("r_x")) / 2).alias("x"), F.least("p_q", "r_q").alias("q"), (F.col("p_valid") & F.col("r_valid")).alias("valid"))
    return j.select("vec_id", F.concat(F.lit("joint"), F.col("j")).alias("name"), "x", "q", "valid").unionByName(derived).select("vec_id", "name", F.round("x", 6).alias("x"), F.round("q", 6).alias("q"), "valid")


@query("FN-16", "FN-23", sql="""
WITH j AS (SELECT vec_id, i AS j, e[3 * i + 1] AS x, e[3 * i + 2] AS y, e[3 * i + 3] + 5 AS z FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, unnest(range(21)) AS i FROM embeddings)),
c AS (SELECT *, 0.8 * x - 0.6 * z + 3 AS cx, y AS cy, 0.6 * x + 0.8 * z AS cz FROM j), p AS (SELECT *, (1000 * cx + 320 * cz) / cz AS u, (1000 * cy + 240 * cz) / cz AS v FROM c)
SELECT vec_id, CAST(j AS INTEGER) AS j, round(u, 6) AS u, round(v, 6) AS v, round(cz, 6) AS depth, round(sqrt(power(u - 320, 2) + power(v - 240, 2)), 6) AS residual FROM p
""")  # fmt: skip
def reprojection(spark: SparkSession, d: str) -> DataFrame:
    """Points carried by a 3x4 pose and a 3x3 camera to pixels, and their distance from the image centre."""
    k, e = F.array(*[F.lit(float(x)) for x in (1000, 0, 320, 0, 1000, 240, 0, 0, 1)]), F.array(*[F.lit(float(x)) for x in (0.8, 0, -0.6, 3, 0, 1, 0, 0, 0.6, 0, 0.8, 0)])
    v = F.col("embedding")
    j = load(spark, d, "embeddings").select("vec_id", F.explode(F.array(*[F.struct(F.lit(i).alias("j"), v[3 * i].cast("double").alias("x"), v[3 * i + 1].cast("double").alias("y"), (v[3 * i + 2].cast("double") + 5).alias("z")) for i in range(21)])).alias("s")).select("vec_id", "s.*")
    u, w, depth = scalars.project(k, e, F.col("x"), F.col("y"), F.col("z"))
    p = j.select("vec_id", "j", u.alias("u"), w.alias("v"), depth.alias("depth"))
    return p.select("vec_id", "j", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"), F.round("depth", 6).alias("depth"), F.round(F.hypot(F.col("u") - 320, F.col("v") - 240), 6).alias("residual"))


@query("FN-05", "FN-06", sql=r"""
WITH e AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+09:00' ELSE '' END AS raw FROM events)
SELECT event_id, event_id % 3 <> 2 AS has_zone, CASE event_id % 3 WHEN 0 THEN epoch_us(date_trunc('second', ts)) WHEN 1 THEN epoch_us(date_trunc('second', ts)) - 32400000000 END AS utc_us,
  CAST(date_trunc('second', ts) + INTERVAL 9 HOUR AS VARCHAR) AS kst, epoch_us(ts) * 1000 + 1 <= 1705276800000000000 AS in_time FROM e
""")  # fmt: skip
def dates(spark: SparkSession, d: str) -> DataFrame:
    """ISO times with a mandatory zone, a view in another zone, and a cutoff at nanoseconds."""
    e = _events(spark, d)
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.expr("case event_id % 3 when 0 then 'Z' when 1 then '+09:00' else '' end"))
    utc = F.when(scalars.has_zone(raw), F.unix_micros(F.try_to_timestamp(raw)))
    kst = F.date_format(F.date_trunc("second", F.col("ts")) + F.expr("interval 9 hours"), "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", scalars.has_zone(raw).alias("has_zone"), utc.alias("utc_us"), kst.alias("kst"), (micros("ts") * 1000 + 1 <= 1_705_276_800_000_000_000).alias("in_time"))


@query("FN-09", "FN-11", "STM-10", "STM-15", "CN-10", sql="""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, median(l_quantity) AS med, quantile_cont(l_quantity, 0.9) AS p90, count(*) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)
SELECT o_orderkey, CASE WHEN med IS NULL OR p90 IS NULL OR med > 40 OR p90 > 200 OR o_custkey % 9 = 0 THEN 'NO_GO_TRIANGULATION' WHEN med <= 20 AND p90 <= 60 AND o_custkey % 9 <> 1 THEN 'PASS' ELSE 'REVIEW_POSE_CAMERA_CONSISTENCY' END AS gate,
  CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN n > 6 THEN 'AMBIGUOUS' WHEN n = 6 THEN 'HEALTHY' WHEN n < 3 THEN 'CONFIRMING' WHEN o_custkey % 5 = 0 THEN 'INVALID_COMMAND' WHEN o_custkey % 4 >= 3 THEN 'RESTART_LIMIT' ELSE 'RESTART' END AS action,
  CASE WHEN o_orderstatus = 'P' OR n * 100 >= 300 THEN 'ESCALATE' ELSE 'GRACE' END AS grace, o_orderstatus = 'F' AND n >= 1 AS complete,
  CASE WHEN o_orderstatus = 'F' THEN 'DONE' WHEN med IS NULL THEN 'POSE' WHEN med > 30 THEN 'GEOMETRY' WHEN p90 > 45 THEN 'BODY' ELSE 'QUALITY' END AS stage FROM o
""")  # fmt: skip
def decision_tables(spark: SparkSession, d: str) -> DataFrame:
    """Consistency gate, recovery action, grace before escalation, completion and the first unmet stage."""
    p = F.percentile("l_quantity", F.array(F.lit(0.5), F.lit(0.9)))
    o = load(spark, d, "orders").join(load(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey", "o_custkey", "o_orderstatus").agg(p.alias("p"), F.count("*").alias("n"))
    med, p90, n, s = F.get("p", F.lit(0)), F.get("p", F.lit(1)), F.col("n"), F.col("o_orderstatus")
    alive = F.when(n > 6, 2).when(n == 6, 1).otherwise(0)
    action = status.recovery_action(alive, s == "F", n, 3, F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 4, 3)
    stage = F.when(s == "F", "DONE").when(med.isNull(), "POSE").when(med > 30, "GEOMETRY").when(p90 > 45, "BODY").otherwise("QUALITY")
    return o.select("o_orderkey", status.consistency(med, p90, F.when(F.col("o_custkey") % 9 == 0, "FAIL").when(F.col("o_custkey") % 9 == 1, "REVIEW").otherwise("PASS"), F.lit(20.0)).alias("gate"), action.alias("action"), F.when((s == "P") | (n * 100 >= 300), "ESCALATE").otherwise("GRACE").alias("grace"), ((s == "F") & (n >= 1)).alias("complete"), stage.alias("stage"))


@query("FN-10", sql="""
WITH q AS (SELECT l_suppkey AS seq, avg(CASE WHEN l_returnflag <> 'N' THEN 1.0 ELSE 0 END) AS valid, avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0 END) AS aligned, quantile_cont(l_quantity, 0.95) AS p95, stddev_pop(l_tax) / avg(l_tax) AS cv FROM lineitem GROUP BY 1)
SELECT seq, CASE WHEN valid < 0.48 OR p95 > 49 THEN 'FAIL' WHEN aligned < 0.5 OR cv > 0.65 THEN 'REVIEW' ELSE 'PASS' END AS status, concat_ws(',', CASE WHEN valid < 0.48 THEN 'VALID_FRACTION' END, CASE WHEN p95 > 49 THEN 'DISPLACEMENT' END) AS fails,
  concat_ws(',', CASE WHEN aligned < 0.5 THEN 'ALIGNMENT' END, CASE WHEN cv > 0.65 THEN 'BONE_VARIATION' END) AS reviews FROM q
""")  # fmt: skip
def body_gate(spark: SparkSession, d: str) -> DataFrame:
    """Fail and review reasons against thresholds of a one-row configuration."""
    config = spark.createDataFrame([(0.48, 49.0, 0.5, 0.65)], "min_valid double, max_p95 double, min_aligned double, max_cv double")
    q = load(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("seq")).agg(
        F.avg((F.col("l_returnflag") != "N").cast("double")).alias("valid"), F.avg((F.col("l_linestatus") == "F").cast("double")).alias("aligned"), F.percentile("l_quantity", 0.95).alias("p95"), F.try_divide(F.stddev_pop("l_tax"), F.avg("l_tax")).alias("cv"),
    ).crossJoin(F.broadcast(config))
    fails = status.reasons(("VALID_FRACTION", F.col("valid") < F.col("min_valid")), ("DISPLACEMENT", F.col("p95") > F.col("max_p95")))
    reviews = status.reasons(("ALIGNMENT", F.col("aligned") < F.col("min_aligned")), ("BONE_VARIATION", F.col("cv") > F.col("max_cv")))
    return q.select("seq", status.gate(fails, reviews).alias("status"), F.array_join(fails, ",").alias("fails"), F.array_join(reviews, ",").alias("reviews"))


@query("PF-11", sql=r"""
WITH p AS (SELECT 'document' AS kind, doc_id AS id, text, coalesce(length(text), 0) AS size FROM documents UNION ALL SELECT 'page', page_id, html, coalesce(length(html), 0) FROM pages)
SELECT kind, id, concat_ws(',', CASE WHEN size > 12000 THEN 'SIZE' END, CASE WHEN regexp_matches(text, '(?i)(password|secret|token)\s*[:=]') THEN 'SECRET' END, CASE WHEN regexp_matches(text, 'AKIA[0-9A-Z]{16}') THEN 'ACCESS_KEY' END,
  CASE WHEN regexp_matches(text, '[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]+') THEN 'EMAIL' END, CASE WHEN kind = 'page' AND regexp_matches(text, '<script') THEN 'SCRIPT' END) AS reasons FROM p
""")  # fmt: skip
def publication_safety(spark: SparkSession, d: str) -> DataFrame:
    """All reasons why a text can't be published."""
    docs = load(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = load(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    t = F.col("text")
    why = status.reasons(
        ("SIZE", F.coalesce(F.length(t), F.lit(0)) > 12000), ("SECRET", t.rlike(r"(?i)(password|secret|token)\s*[:=]")), ("ACCESS_KEY", t.rlike("AKIA[0-9A-Z]{16}")), ("EMAIL", t.rlike(r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]+")), ("SCRIPT", (F.col("kind") == "page") & t.rlike("<script")),
    )
    return docs.unionByName(pages).select("kind", "id", F.array_join(why, ",").alias("reasons"))


@query("PF-13", "PF-15", sql="""
WITH r AS (SELECT doc_id, quality, toxic, doc_id % 10 = 3 AS twice FROM labels UNION ALL SELECT doc_id, quality, toxic, true FROM labels WHERE doc_id % 10 = 3),
f AS (SELECT doc_id, concat_ws(',', CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN 'DUPLICATE' END, CASE WHEN toxic = 1 THEN 'NOT_EXPORTABLE' END, CASE WHEN quality = 0 THEN 'FAILED' END) AS reasons, toxic FROM r)
SELECT doc_id, reasons, count(*) AS n, bool_and(toxic = 1 AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = f.doc_id AND d.lang = 'en')) AS unrecovered FROM f GROUP BY 1, 2
""")  # fmt: skip
def readiness_rows(spark: SparkSession, d: str) -> DataFrame:
    """Reasons against each readiness row, repeated rows told by a window, and failures that nothing stronger recovers."""
    labels = load(spark, d, "labels")
    r = labels.unionByName(labels.where("doc_id % 10 = 3"))
    many = F.count("*").over(W.partitionBy("doc_id")) > 1
    why = F.array_join(status.reasons(("DUPLICATE", many), ("NOT_EXPORTABLE", F.col("toxic") == 1), ("FAILED", F.col("quality") == 0)), ",")
    f = r.select("doc_id", why.alias("reasons"), "toxic")
    strong = load(spark, d, "documents").where("lang = 'en'").select("doc_id").distinct().withColumn("strong", F.lit(True))
    return f.join(strong, "doc_id", "left").groupBy("doc_id", "reasons").agg(F.count("*").alias("n"), F.bool_and((F.col("toxic") == 1) & F.col("strong").isNull()).alias("unrecovered"))


@query("FN-18", sql="""
WITH c AS (SELECT user_id, event_type, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events GROUP BY 1, 2), o AS (SELECT user_id, max(a) AS lo, min(b) AS hi, count(*) AS n FROM c GROUP BY 1),
p AS (SELECT o.*, hi - lo AS span, least(CAST(floor((hi - lo) * 0.35) AS BIGINT), 172800000000) AS zone FROM o WHERE hi > lo)
SELECT p.user_id, p.lo AS start_us, p.hi AS end_us, count(*) FILTER (WHERE epoch_us(ts) BETWEEN lo AND lo + zone) AS head, count(*) FILTER (WHERE epoch_us(ts) BETWEEN hi - zone AND hi) AS tail FROM p JOIN events e USING (user_id) GROUP BY 1, 2, 3
""")  # fmt: skip
def plan_window(spark: SparkSession, d: str) -> DataFrame:
    """The overlap of a set's clips and the anchors in its head and tail zones (35 %, two days at most)."""
    e = _events(spark, d).select("user_id", "event_type", micros("ts").alias("us"))
    c = e.groupBy("user_id", "event_type").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    p = c.groupBy("user_id").agg(F.max("a").alias("lo"), F.min("b").alias("hi")).where("hi > lo").withColumn("zone", F.least(F.floor((F.col("hi") - F.col("lo")) * 0.35), F.lit(172_800_000_000)))
    us = F.col("us")
    return e.join(p, "user_id").groupBy("user_id", F.col("lo").alias("start_us"), F.col("hi").alias("end_us")).agg(F.count_if((us >= F.col("lo")) & (us <= F.col("lo") + F.col("zone"))).alias("head"), F.count_if((us >= F.col("hi") - F.col("zone")) & (us <= F.col("hi"))).alias("tail"))


@query("FN-19", "FN-21", "FN-22", sql="""
SELECT event_id, '{"k":' || CAST(props::JSON ->> '$.k' AS VARCHAR) || ',"type":"' || event_type || '"}' AS encoded, event_type IN ('view', 'click') AS drifted, 'MOTION' AS evidence, round_even(value, 3) AS value, CAST(NULL AS DOUBLE) AS peak FROM events
""")  # fmt: skip
def json_and_records(spark: SparkSession, d: str) -> DataFrame:
    """Nested values as JSON, loaded and current code hashes compared key by key, and one wide row for all evidence."""
    loaded = F.create_map(F.lit("view"), F.lit("a"), F.lit("click"), F.lit("b"), F.lit("error"), F.lit("c"))
    current = F.create_map(F.lit("view"), F.lit("x"), F.lit("click"), F.lit("y"), F.lit("error"), F.lit("c"))
    differing = F.map_filter(F.map_zip_with(loaded, current, lambda k, a, b: ~a.eqNullSafe(b)), lambda k, v: v)
    rec = F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.col("event_type").alias("type"))
    return _events(spark, d).select("event_id", F.to_json(rec).alias("encoded"), F.map_contains_key(differing, F.col("event_type")).alias("drifted"), F.lit("MOTION").alias("evidence"), F.bround("value", 3).alias("value"), F.lit(None).cast("double").alias("peak"))


@query("FN-20", "JN-21", sql="SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_digest_dupes(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")


@query("SRC-04", "FN-02", sql=r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/(\d+)', ['scheme', 'host', 'lang', 'num']) AS r FROM pages)
SELECT coalesce(nullif(r.scheme, ''), 'UNRECOGNISED') AS scheme, r.lang, count(*) AS n, count(DISTINCT r.host) AS hosts, min(TRY_CAST(r.num AS BIGINT)) AS first FROM p GROUP BY 1, 2
""")  # fmt: skip
def url_parse(spark: SparkSession, d: str) -> DataFrame:
    """Names parsed by pattern; those that don't match are kept apart, not dropped."""
    part = lambda i: F.regexp_extract("url", r"^(https?)://([^/]+)/([a-z]{2})/(\d+)", i)
    p = load(spark, d, "pages").select(F.coalesce(F.nullif(part(1), F.lit("")), F.lit("UNRECOGNISED")).alias("scheme"), part(3).alias("lang"), part(2).alias("host"), part(4).try_cast("long").alias("num"))
    return p.groupBy("scheme", "lang").agg(F.count("*").alias("n"), F.count_distinct("host").alias("hosts"), F.min("num").alias("first"))
