"""Queries of sources, sinks and what is made for readers: round trips through the shared folder, reports and plans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.graph import shared_folder
from tidemark.plans.registry import query
from tidemark.sources import readers, sinks
from tidemark.tables import load, micros


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/io-{name}-{uuid.uuid4().hex}"


@query("SRC-01", "SNK-01", "SNK-02", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows as text with a header, read again as text and coerced."""
    t, path = load(spark, d, "customer"), _place(spark, "csv")
    sinks.write_csv([t], path)
    back = readers.read_rows(spark, path, t.columns, ("c_acctbal",))
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment")


@query("SNK-04", "SRC-11", sql="SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def partitioned_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows in ranges of their order below a folder for each key, read again."""
    path = _place(spark, "parts")
    sinks.write_partitioned(load(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"), path, ["l_returnflag"], "l_orderkey")
    return spark.read.parquet(path)


@query("SNK-05", "CN-06", sql="SELECT o_orderkey, o_orderstatus FROM orders")
def published_build(spark: SparkSession, d: str) -> DataFrame:
    """Written to a staging folder, verified there, renamed in one step, and read."""
    t, path = load(spark, d, "orders").select("o_orderkey", "o_orderstatus"), _place(spark, "build")
    want = t.count()
    sinks.publish(t, f"{path}-staging", path, lambda b: [] if b.count() == want else ["COUNT"])
    return spark.read.parquet(path)


@query("SRC-05", "SRC-12", "SNK-06", sql="SELECT DISTINCT l_returnflag AS part, true AS has_bytes, true AS digest_ok FROM lineitem")
def build_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The files of a build by partition, without reading them, and their digests against the bytes."""
    path = _place(spark, "inventory")
    sinks.write_partitioned(load(spark, d, "lineitem").select("l_returnflag", "l_orderkey"), path, ["l_returnflag"], "l_orderkey")
    part = F.regexp_extract("path", "l_returnflag=([A-Z])/", 1).alias("part")
    files = readers.inventory(spark, path).where(F.col("path").endswith(".parquet")).select(part, "bytes")
    whole = sinks.digests(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)).select(part, "sha256")
    a = files.groupBy("part").agg((F.sum("bytes") > 0).alias("has_bytes"))
    return a.join(whole.groupBy("part").agg(F.bool_and(F.length("sha256") == 64).alias("digest_ok")), "part")


@query("SRC-08", sql="SELECT p_partkey, CAST(p_size * 8 AS INTEGER) AS width, CAST(p_partkey % 4000 + 1 AS INTEGER) AS height FROM part")
def image_headers(spark: SparkSession, d: str) -> DataFrame:
    """Sizes read from JPEG headers (made from the parts)."""
    four = lambda c: F.lpad(F.hex(c), 4, "0")
    p = load(spark, d, "part")
    head = F.unhex(F.concat(F.lit("FFD8FFE000044142FFC0000B08"), four(F.col("p_partkey") % 4000 + 1), four((F.col("p_size") * 8).cast("long")), F.lit("01011100FFD9")))
    sizes = readers.image_sizes(p.select(F.col("p_partkey").cast("string").alias("path"), head.alias("content")))
    return sizes.select(F.col("path").cast("long").alias("p_partkey"), "width", "height")


@query("SRC-10", "STM-07", sql=r"""
SELECT user_id, count(*) FILTER (WHERE regexp_matches(props, '"k": [0-9]$|"k": [0-9]}')) AS short_lines, max(epoch_us(ts)) AS last_us, arg_max(event_type, epoch_us(ts)) AS last_state, round(arg_max(value, epoch_us(ts)), 6) AS last_load FROM events GROUP BY 1
""")  # fmt: skip
def operational_state(spark: SparkSession, d: str) -> DataFrame:
    """Append-only operational events: lines that match, and the latest state and load of each process."""
    e = load(spark, d, "events").withColumn("us", micros("ts"))
    g = e.groupBy("user_id").agg(F.count_if(F.col("props").rlike('"k": [0-9]$|"k": [0-9]}')).alias("short_lines"), F.max(F.struct("us", "event_type", "value")).alias("m"))
    return g.select("user_id", "short_lines", F.col("m.us").alias("last_us"), F.col("m.event_type").alias("last_state"), F.round("m.value", 6).alias("last_load"))


@query("PF-16", sql="""
WITH q AS (SELECT label, quantile_cont(abs(CAST(embedding[1] AS DOUBLE)), 0.4) AS t, quantile_cont(CAST(embedding[2] AS DOUBLE), 0.25) AS c FROM embeddings GROUP BY 1)
SELECT vec_id, abs(CAST(embedding[1] AS DOUBLE)) <= t AND CAST(embedding[2] AS DOUBLE) >= c AND vec_id % 10 NOT IN (0, 9) AS static FROM embeddings JOIN q USING (label)
""")  # fmt: skip
def static_mask(spark: SparkSession, d: str) -> DataFrame:
    """The relational part of a background mask: below a percentile of change, above one of confidence, off the border."""
    e = load(spark, d, "embeddings").select("vec_id", "label", F.abs(F.col("embedding")[0].cast("double")).alias("change"), F.col("embedding")[1].cast("double").alias("confidence"))
    q = e.groupBy("label").agg(F.percentile("change", 0.4).alias("t"), F.percentile("confidence", 0.25).alias("c"))
    return e.join(q, "label").select("vec_id", ((F.col("change") <= F.col("t")) & (F.col("confidence") >= F.col("c")) & ~(F.col("vec_id") % 10).isin(0, 9)).alias("static"))


@query("FN-26", sql="""
WITH q AS (SELECT quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM events) SELECT event_id, CAST(round(255 * least(greatest((value - a) / (b - a), 0), 1)) AS BIGINT) AS red FROM events, q
""")  # fmt: skip
def colour_ramp(spark: SparkSession, d: str) -> DataFrame:
    """A value between the 5th and 95th percentile as a shade."""
    e = load(spark, d, "events")
    q = e.agg(F.percentile("value", F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    x = (F.col("value") - F.col("q")[0]) / (F.col("q")[1] - F.col("q")[0])
    return e.crossJoin(F.broadcast(q)).select("event_id", F.round(255 * F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))).cast("long").alias("red"))  # one row


@query("SNK-07", sql="""
SELECT '| ' || o_orderpriority || ' | ' || count(*) || ' | ' || count(*) FILTER (WHERE o_orderstatus = 'F') || ' |' AS line FROM orders GROUP BY o_orderpriority
""")  # fmt: skip
def report_lines(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a Markdown table, formatted from aggregates."""
    g = load(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return g.select(F.format_string("| %s | %d | %d |", "o_orderpriority", "n", "f").alias("line"))


@query("SNK-10", sql="""
SELECT row_number() OVER (ORDER BY CASE WHEN source = 'src0' THEN 0 ELSE 1 END, source) AS step, 'copy ''' || source || '''' AS command, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY source
""")  # fmt: skip
def transfer_plan(spark: SparkSession, d: str) -> DataFrame:
    """Ordered copy commands over an inventory by source, the critical source first."""
    from pyspark.sql import Window as W

    g = load(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("bytes"))
    w = W.orderBy(F.when(F.col("source") == "src0", 0).otherwise(1), "source")  # a row for each source
    return g.select(F.row_number().over(w).cast("long").alias("step"), F.concat(F.lit("copy '"), "source", F.lit("'")).alias("command"), "bytes")
