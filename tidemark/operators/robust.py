"""Robust statistics as aggregates and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed value: makes the median absolute deviation of a normal distribution its standard deviation.
MAD_SCALE = 1.4826


def mad(df: DataFrame, keys: list[str], value: str, multiplier: float = 5.0, floor: float = 1e-9) -> DataFrame:
    """keys, median, mad, threshold = median + multiplier * 1.4826 * max(mad, floor). Two exact passes; groups without
    values have an infinite threshold."""
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    med = v.groupBy(*keys).agg(F.percentile(value, 0.5).alias("median"))
    dev = v.join(med, keys) if keys else v.crossJoin(F.broadcast(med))
    out = dev.groupBy(*keys, "median").agg(F.percentile(F.abs(F.col(value) - F.col("median")), 0.5).alias("mad"))
    return out.withColumn("threshold", F.coalesce(F.col("median") + multiplier * MAD_SCALE * F.greatest("mad", F.lit(floor)), F.lit(float("inf"))))


def weighted_median(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """The lower weighted median: the first value whose cumulative weight reaches half. Equal values are summed before
    anything is ordered, so that a large group is as small as its distinct values."""
    by_value = df.groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    w = W.partitionBy(*keys).orderBy(value)
    run = by_value.withColumn("__run", F.sum("__w").over(w)).withColumn("__all", F.sum("__w").over(W.partitionBy(*keys)))
    return run.where("__run * 2 >= __all").groupBy(*keys).agg(F.min(value).alias("weighted_median"))


def line_sums(x: Column, y: Column, w: Column) -> dict[str, Column]:
    return {"sw": F.sum(w), "sx": F.sum(w * x), "sy": F.sum(w * y), "sxx": F.sum(w * x * x), "sxy": F.sum(w * x * y), "syy": F.sum(w * y * y)}


def weighted_line(df: DataFrame, keys: list[str], x: Column, y: Column, w: Column) -> DataFrame:
    """keys, n, slope, intercept, r2, rmse of a weighted least-squares line in closed form; null with under two distinct x."""
    s = df.groupBy(*keys).agg(F.count("*").alias("n"), *[c.alias(k) for k, c in line_sums(x, y, w).items()])
    d = F.expr("sw * sxx - sx * sx")
    slope = F.when((F.col("n") >= 2) & (d > 1e-12), F.expr("sw * sxy - sx * sy") / d)
    out = s.withColumn("slope", slope).withColumn("intercept", F.expr("try_divide(sy - slope * sx, sw)"))
    sse = F.expr("greatest(syy - intercept * sy - slope * sxy, 0D)")
    sst = F.expr("syy - try_divide(sy * sy, sw)")
    return out.select(*keys, "n", "slope", "intercept", F.when(sst > 1e-12, 1 - sse / sst).alias("r2"), F.sqrt(F.expr("try_divide(greatest(syy - intercept * sy - slope * sxy, 0D), sw)")).alias("rmse"))


def iqr_limit(df: DataFrame, keys: list[str], value: str, factor: float = 1.5) -> DataFrame:
    """keys, q1, q3, limit = q3 + factor * (q3 - q1)."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    return q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"), (F.col("q")[1] + factor * (F.col("q")[1] - F.col("q")[0])).alias("limit"))


def guarded_corr(x: str, y: str, least: float = 1e-12) -> Column:
    """Pearson correlation, 0 where either side doesn't vary. From sums, so that a constant side raises nothing."""
    n = F.count("*")
    vx, vy = F.var_pop(x), F.var_pop(y)
    return F.when((vx > least) & (vy > least), F.try_divide(F.avg(F.col(x) * F.col(y)) - F.avg(x) * F.avg(y), F.sqrt(vx * vy))).otherwise(F.when(n > 0, F.lit(0.0)))
