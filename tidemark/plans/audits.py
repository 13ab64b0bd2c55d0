"""Queries of audits, inventories, telemetry and totals over outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import audits, contracts
from tidemark.operators.graph import shared_folder
from tidemark.plans.registry import query
from tidemark.tables import load

# A customer is a sequence, its orders are the frames, their lines the candidates. Some orders carry a fault each.
_TARGET = "case when o % 101 = 0 then n when o % 7 = 0 or n = 0 then -1 else o % n end"


@query("CN-03", sql="""
WITH l AS (SELECT l_orderkey AS o, l_extendedprice AS box, l_discount AS score, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount) - 1 AS c FROM lineitem),
k AS (SELECT o, c, CASE WHEN o % 89 = 0 AND c = 0 THEN box + 1 ELSE box END AS box, CASE WHEN o % 97 = 0 AND c = 0 THEN score + 1 ELSE score END AS score FROM l WHERE NOT (o % 79 = 0 AND c = 1)),
f AS (SELECT o_custkey AS s, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, coalesce(n, 0) AS n FROM orders LEFT JOIN (SELECT o, count(*) AS n FROM l GROUP BY 1) ON o = o_orderkey),
g AS (SELECT *, CASE WHEN o % 101 = 0 THEN n WHEN o % 7 = 0 OR n = 0 THEN -1 ELSE o % n END AS t FROM f),
h AS (SELECT *, n + CASE WHEN o % 83 = 0 THEN 1 ELSE 0 END AS said, n - CASE WHEN t >= 0 THEN 1 ELSE 0 END AS others FROM g),
r AS (SELECT *, said - CASE WHEN t >= 0 THEN 1 ELSE 0 END + CASE WHEN o % 127 = 0 THEN 1 ELSE 0 END AS said_others, coalesce(sum(others) OVER w, 0) + CASE WHEN o % 131 = 0 THEN 1 ELSE 0 END AS b, coalesce(sum(n) OVER w, 0) + CASE WHEN o % 137 = 0 THEN 1 ELSE 0 END AS a FROM h WHERE o % 139 <> 0 WINDOW w AS (PARTITION BY s ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT *, lead(a) OVER v AS a2, lead(b) OVER v AS b2, lead(i) OVER v AS i2, 'f' || lpad(CAST(o AS VARCHAR), 12, '0') || CASE WHEN o % 109 = 0 THEN 'x' ELSE '' END AS name FROM r WINDOW v AS (PARTITION BY s ORDER BY i)),
x AS (SELECT s, count(*) AS frames, sum(said) AS candidates, count(*) FILTER (WHERE t >= 0) AS targets, bool_and(o % 109 <> 0) AS names, bool_and(o % 113 <> 0) AS times, bool_and(said = n) AS counts,
  bool_and((i > 0 OR a = 0) AND (coalesce(i2, -1) <> i + 1 OR a2 = a + n)) AND max(CASE WHEN coalesce(i2, -1) <> i + 1 THEN a + n END) = any_value(total) AS offs, bool_and(t < 0 OR t < said) AS bounds, bool_and(NOT (t >= 0 AND o % 11 = 0 AND o % 5 = 0)) AS unforced,
  bool_and(t < 0 OR o % 103 <> 0) AS accepted, bool_and(said_others = said - CASE WHEN t >= 0 THEN 1 ELSE 0 END) AS background,
  bool_and((i > 0 OR b = 0) AND (coalesce(i2, -1) <> i + 1 OR b2 = b + said_others)) AND max(CASE WHEN coalesce(i2, -1) <> i + 1 THEN b + said_others END) = any_value(total_others) AS ooffs, min(i) = 0 AND max(i) = count(*) - 1 AS dense
  FROM q JOIN (SELECT s, sum(n) AS total FROM f GROUP BY 1) USING (s) JOIN (SELECT s, sum(greatest(others, 0)) AS total_others FROM h WHERE o % 139 <> 0 GROUP BY 1) USING (s) GROUP BY s),
lost AS (SELECT o_custkey AS s, bool_and(l.box IS NOT DISTINCT FROM k.box AND k.o IS NOT NULL) AS boxes, bool_and(l.score IS NOT DISTINCT FROM k.score AND k.o IS NOT NULL) AS scores FROM l JOIN orders ON o_orderkey = l.o LEFT JOIN k ON k.o = l.o AND k.c = l.c GROUP BY 1),
z AS (SELECT src.s, coalesce(frames, 0) AS frames, CAST(coalesce(candidates, 0) AS BIGINT) AS candidates, coalesce(targets, 0) AS targets, array_to_string(list_sort(list_filter([CASE WHEN NOT whole THEN 'frame_count_matches_source' END, CASE WHEN NOT (whole AND coalesce(dense, false)) THEN 'frame_index_matches_source' END,
  CASE WHEN NOT (whole AND coalesce(names, false)) THEN 'frame_name_matches_source' END, CASE WHEN NOT (whole AND coalesce(times, false)) THEN 'timestamps_finite' END, CASE WHEN NOT coalesce(counts, false) THEN 'candidate_counts_match_detector' END, CASE WHEN NOT coalesce(offs, false) THEN 'candidate_offsets_match_detector' END,
  CASE WHEN NOT coalesce(boxes, true) THEN 'candidate_boxes_lossless' END, CASE WHEN NOT coalesce(scores, true) THEN 'candidate_scores_lossless' END, CASE WHEN NOT coalesce(bounds, false) THEN 'target_indices_in_bounds' END, CASE WHEN NOT coalesce(unforced, false) THEN 'no_forced_abstention' END,
  CASE WHEN NOT coalesce(accepted, false) THEN 'accepted_status_is_target' END, CASE WHEN NOT coalesce(background, false) THEN 'background_counts_consistent' END, CASE WHEN NOT coalesce(ooffs, false) THEN 'background_offsets_consistent' END], lambda v: v IS NOT NULL)), ',') AS errors
  FROM (SELECT s, count(*) AS ns, count(*) = count(*) FILTER (WHERE o % 139 <> 0) AS whole FROM f GROUP BY 1) src LEFT JOIN x ON x.s = src.s LEFT JOIN lost ON lost.s = src.s)
SELECT s, frames, candidates, targets, errors, CASE WHEN errors = '' THEN 'PASS' ELSE 'FAIL' END AS status FROM z
""")  # fmt: skip
def selection_audit(spark: SparkSession, d: str) -> DataFrame:
    """Thirteen named checks of what was chosen in a sequence against its source frames and detected candidates."""
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    line = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_extendedprice").alias("box"), F.col("l_discount").alias("score"), (F.row_number().over(order) - 1).alias("candidate"))
    f = load(spark, d, "orders").select(F.col("o_custkey").alias("s"), F.col("o_orderkey").alias("o"), (F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("frame"))
    f = f.join(line.groupBy("o").agg(F.count("*").alias("n")), "o", "left").na.fill(0, ["n"]).withColumn("target", F.expr(_TARGET))
    detected = f.select("s", "o", "frame", "target").join(line, "o")
    kept = detected.where("not (o % 79 = 0 and candidate = 1)").select("s", "frame", "candidate", F.expr("if(o % 89 = 0 and candidate = 0, box + 1, box)").alias("box"), F.expr("if(o % 97 = 0 and candidate = 0, score + 1, score)").alias("score"))
    before = W.partitionBy("s").orderBy("frame").rowsBetween(W.unboundedPreceding, -1)
    sub = F.expr("n - if(target >= 0, 1, 0)")
    name = F.concat(F.lit("f"), F.lpad(F.col("o").cast("string"), 12, "0"))
    chosen = f.where("o % 139 <> 0").select(
        "s", "frame", F.concat(name, F.expr("if(o % 109 = 0, 'x', '')")).alias("frame_name"), F.expr("if(o % 113 = 0, double('nan'), frame / 30D)").alias("pts"), F.expr("n + if(o % 83 = 0, 1, 0)").alias("n_candidates"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) + F.expr("if(o % 137 = 0, 1, 0)")).alias("candidate_offset"), "target", F.expr("target >= 0 and o % 11 = 0 and o % 5 = 0").alias("ambiguous"), F.expr("target < 0").alias("missing"),
        F.expr("if(target >= 0 and o % 103 <> 0, 'TARGET', 'REVIEW')").alias("status"), F.expr("n + if(o % 83 = 0, 1, 0) - if(target >= 0, 1, 0) + if(o % 127 = 0, 1, 0)").alias("n_others"),
        (F.coalesce(F.sum(sub).over(before), F.lit(0)) + F.expr("if(o % 131 = 0, 1, 0)")).alias("other_offset"),
    )
    # one row is left out for the target, also where its number is out of bounds
    others = detected.where("o % 139 <> 0 and (target < 0 or candidate <> if(o % 101 = 0, 0, target))").select("s", "frame")
    return audits.selection_faults(["s"], f.select("s", name.alias("frame_name")), chosen, detected.select("s", "frame", "candidate", "box", "score"), kept, others)


@query("CN-07", sql="""
WITH p AS (SELECT vec_id, vec_id % 5 = 0 AS gauge, CASE WHEN vec_id % 5 = 0 AND vec_id % 35 <> 0 THEN 0 ELSE CAST(embedding[1] AS DOUBLE) END AS a, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE CAST(embedding[2] AS DOUBLE) END AS t, CASE WHEN vec_id % 13 = 0 THEN 1e-6 ELSE 0 END AS e, CASE WHEN vec_id % 17 = 0 THEN 1.001 ELSE 1 END AS k FROM embeddings),
m AS (SELECT vec_id, gauge, [CAST(x AS DOUBLE) FOR x IN [cos(a) * k, -sin(a) * k, 0, t, sin(a) * k, cos(a) * k, 0, 2 * t, 0, 0, k, 3 * t, 0, 0, 0, 1]] AS m, [CAST(x AS DOUBLE) FOR x IN [cos(a), sin(a), 0, -(cos(a) * t + sin(a) * 2 * t) + e, -sin(a), cos(a), 0, -(-sin(a) * t + cos(a) * 2 * t), 0, 0, 1, -3 * t, 0, 0, 0, 1]] AS v FROM p),
d AS (SELECT vec_id, gauge, list_max([abs(list_sum([m[4 * (x // 4) + n] * v[4 * (n - 1) + x % 4 + 1] FOR n IN [1, 2, 3, 4]]) - CASE WHEN x // 4 = x % 4 THEN 1 ELSE 0 END) FOR x IN range(16)]) AS inv,
  list_max([abs(list_sum([m[4 * (x // 3) + n] * m[4 * (x % 3) + n] FOR n IN [1, 2, 3]]) - CASE WHEN x // 3 = x % 3 THEN 1 ELSE 0 END) FOR x IN range(9)]) AS orth,
  m[1] * (m[6] * m[11] - m[7] * m[10]) - m[2] * (m[5] * m[11] - m[7] * m[9]) + m[3] * (m[5] * m[10] - m[6] * m[9]) AS det, list_max([abs(m[x + 1] - CASE WHEN x // 4 = x % 4 THEN 1 ELSE 0 END) FOR x IN range(16)]) AS g FROM m)
SELECT vec_id, array_to_string(list_filter([CASE WHEN abs(det - 1) > 1e-10 THEN 'determinant' END, CASE WHEN gauge AND g > 1e-12 THEN 'identity_gauge' END, CASE WHEN inv > 1e-10 THEN 'inverse' END, CASE WHEN orth > 1e-10 THEN 'orthogonal' END], lambda x: x IS NOT NULL), ',') AS failed, round(det, 6) AS determinant FROM d
""")  # fmt: skip
def camera_validation(spark: SparkSession, d: str) -> DataFrame:
    """Poses against what is stored as their inverses: product, orthogonality, determinant, and the identity of first cameras."""
    p = load(spark, d, "embeddings").select(
        "vec_id", F.expr("vec_id % 5 = 0").alias("gauge"), F.expr("if(vec_id % 5 = 0 and vec_id % 35 <> 0, 0, double(embedding[0]))").alias("a"), F.expr("if(vec_id % 5 = 0, 0, double(embedding[1]))").alias("t"),
        F.expr("if(vec_id % 13 = 0, 1e-6, 0)").alias("e"), F.expr("if(vec_id % 17 = 0, double(1.001), double(1))").alias("k"),
    )
    pose = F.expr("array(cos(a) * k, -sin(a) * k, 0D, t, sin(a) * k, cos(a) * k, 0D, 2 * t, 0D, 0D, k, 3 * t, 0D, 0D, 0D, 1D)")
    inverse = F.expr("array(cos(a), sin(a), 0D, -(cos(a) * t + sin(a) * 2 * t) + e, -sin(a), cos(a), 0D, -(-sin(a) * t + cos(a) * 2 * t), 0D, 0D, 1D, -3 * t, 0D, 0D, 0D, 1D)")
    m = p.select("vec_id", "gauge", pose.alias("pose"), inverse.alias("inverse"))
    x = m.select("vec_id", "gauge", *[c.alias(n) for n, c in audits.rigid_errors(F.col("pose"), F.col("inverse")).items()])
    failed = contracts.failed_checks(finite=F.col("finite"), inverse=F.col("inverse_error") <= 1e-10, orthogonal=F.col("orthogonality_error") <= 1e-10, determinant=F.abs(F.col("determinant") - 1) <= 1e-10, identity_gauge=~F.col("gauge") | (F.col("gauge_error") <= 1e-12))
    return x.select("vec_id", failed.alias("failed"), F.round("determinant", 6).alias("determinant"))


@query("AG-30", sql="""
WITH r AS (SELECT source, doc_id % 19 <> 0 AS here, doc_id % 5 AS files, n_chars AS bytes, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE doc_id % 3 END AS transient, doc_id % 2 AS links, CASE WHEN doc_id % 11 = 0 THEN 2 ELSE 0 END AS errors FROM documents),
s AS (SELECT source AS scope, false AS overall, * FROM r UNION ALL SELECT NULL, true, * FROM r)
SELECT scope, overall, count(*) AS path_count, count(*) FILTER (WHERE here) AS existing, CAST(coalesce(sum(files), 0) AS BIGINT) AS file_count, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS logical_bytes, coalesce(sum(bytes), 0) / 1073741824.0 AS gib, CAST(coalesce(sum(transient), 0) AS BIGINT) AS transient, CAST(coalesce(sum(links), 0) AS BIGINT) AS symlinks, CAST(coalesce(sum(errors), 0) AS BIGINT) AS scan_errors FROM s GROUP BY 1, 2
""")  # fmt: skip
def inventory_totals(spark: SparkSession, d: str) -> DataFrame:
    """Paths, files, bytes and what was left out, by source and over all."""
    rows = load(spark, d, "documents").select(
        "source", F.expr("doc_id % 19 <> 0").alias("exists"), F.expr("doc_id % 5").alias("file_count"), F.col("n_chars").alias("logical_bytes"), F.expr("if(doc_id % 6 = 0, null, doc_id % 3)").alias("transient"), F.expr("doc_id % 2").alias("symlinks"),
        F.expr("case when doc_id % 11 = 0 then array('stat', 'read') when doc_id % 2 = 0 then array() end").alias("errors"),
    )
    return audits.inventory_totals(rows, "source")


_TELEMETRY = ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(quantile_cont({m}, 0.9), 6) AS {m}_p90, round(quantile_cont({m}, 0.95), 6) AS {m}_p95, round(max({m}), 6) AS {m}_max" for m in ("load", "memory"))


@query("AG-33", sql=f"""
WITH e AS (SELECT event_type AS phase, event_id % 4 AS batch, CASE WHEN event_id % 10 <> 0 THEN value END AS load, CASE WHEN event_id % 4 <> 3 THEN value * (event_id % 7) END AS memory FROM events)
SELECT phase, batch, count(*) AS sample_count, {_TELEMETRY} FROM e GROUP BY 1, 2
""")  # fmt: skip
def telemetry_summary(spark: SparkSession, d: str) -> DataFrame:
    """Mean, p90, p95 and maximum of each measure by phase and batch size; samples without a reading don't count in it."""
    e = load(spark, d, "events").select(F.col("event_type").alias("phase"), F.expr("event_id % 4").alias("batch"), F.expr("if(event_id % 10 <> 0, value, null)").alias("load"), F.expr("if(event_id % 4 <> 3, value * (event_id % 7), null)").alias("memory"))
    t = audits.telemetry(e, ["phase", "batch"], ["load", "memory"])
    return t.select(*[F.round(c, 6).alias(c) if c.startswith(("load", "memory")) else c for c in t.columns])


@query("AG-39", "SRC-02", sql="""
WITH q AS (SELECT doc_id, n_chars, CASE WHEN doc_id % 37 = 0 THEN 'LOST' WHEN doc_id % 5 = 0 THEN 'REVIEW' WHEN doc_id % 50 = 1 THEN 'FAIL' ELSE 'PASS' END AS status FROM documents WHERE doc_id % 29 <> 0 AND doc_id % 31 <> 0 AND doc_id % 37 <> 0 AND doc_id % 41 <> 0)
SELECT count(*) AS sequences, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS frames, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'REVIEW') AS review, count(*) FILTER (WHERE status = 'FAIL') AS failed, CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM q
""")  # fmt: skip
def output_totals(spark: SparkSession, d: str) -> DataFrame:
    """Two batches of outputs, one after the other, and the totals over both; what doesn't parse, has another stage, an
    unknown status or no number of frames is passed over."""
    path = f"{shared_folder(spark)}/outputs-{uuid.uuid4().hex}"
    docs = load(spark, d, "documents")
    body = F.to_json(F.struct(F.expr("if(doc_id % 31 = 0, 'other', 'quality')").alias("stage"), F.col("doc_id").alias("sequence"), F.expr("case when doc_id % 37 = 0 then 'LOST' when doc_id % 5 = 0 then 'REVIEW' when doc_id % 50 = 1 then 'FAIL' else 'PASS' end").alias("status"), F.expr("if(doc_id % 41 = 0, null, n_chars)").alias("frame_count")))
    text = docs.select("doc_id", F.when(F.expr("doc_id % 29 = 0"), F.substring(body, 1, 20)).otherwise(body).alias("value"))
    for part in (0, 1):
        text.where(f"doc_id % 2 = {part}").select("value").write.mode("append").text(path)
    back = spark.read.schema("stage string, sequence long, status string, frame_count long").option("mode", "PERMISSIVE").json(path)
    return audits.output_totals(back, "quality")


def _stage_sql(name: str, gone: int, off: int, bad: int, forced: int) -> str:
    return f"""{name} AS (SELECT s, list_filter([CASE WHEN count(q) = 0 THEN '{name}:missing' END, CASE WHEN count(q) BETWEEN 1 AND count(*) - 1 THEN '{name}:frame_count' END, CASE WHEN count(q) BETWEEN 1 AND count(*) - 1 THEN '{name}:frame_index' END,
  CASE WHEN bool_or(q % {off} = 0) THEN '{name}:pts' END, CASE WHEN bool_or(q % {bad} = 0) THEN '{name}:finite' END, CASE WHEN bool_or(q % {forced} = 0 AND q % 3 = 0) THEN '{name}:forced' END], lambda x: x IS NOT NULL) AS r
  FROM (SELECT o_custkey AS s, CASE WHEN o_orderkey % {gone} <> 0 AND o_custkey % {gone} <> 0 THEN o_orderkey END AS q FROM orders) GROUP BY s)"""


@query("CN-02", sql=f"""
WITH {_stage_sql("pose", 61, 53, 47, 43)}, {_stage_sql("prior", 67, 71, 73, 59)}
SELECT pose.s, array_to_string(list_sort(list_concat(pose.r, prior.r)), ',') AS reasons, CASE WHEN len(pose.r) + len(prior.r) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM pose JOIN prior ON prior.s = pose.s
""")  # fmt: skip
def stage_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Two stages' frames, times, values and acceptance against the frames that they were made from."""
    base = load(spark, d, "orders").select(F.col("o_custkey").alias("s"), F.col("o_orderkey").alias("frame"), F.expr("o_orderkey / 30D").alias("pts"), F.col("o_totalprice").alias("v"))

    def stage(gone: int, off: int, bad: int, forced: int) -> DataFrame:
        left = base.where(f"frame % {gone} <> 0 and s % {gone} <> 0")
        # every second frame is invalid: its value has to be NaN, but where it is bad
        value = f"case when frame % 2 = 0 then if(frame % {bad} = 0, double('inf'), v) else if(frame % {bad} = 0, v, double('nan')) end"
        return left.select("s", "frame", F.expr(f"if(frame % {off} = 0, pts + 1, pts)").alias("pts"), F.expr(value).alias("value"), F.expr("frame % 2 = 0").alias("valid"), F.expr(f"frame % {forced} = 0").alias("accepted"), F.expr("frame % 3 <> 0").alias("target_valid"))

    return audits.stage_faults(["s"], base.select("s", "frame", "pts"), {"pose": stage(61, 53, 47, 43), "prior": stage(67, 71, 73, 59)})
