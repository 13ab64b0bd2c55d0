"""Sequence operators: islands, deltas, offsets, smoothing by windows, schedules, ranks and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Runs of consecutive integers of `at`: keys, start, end, length. Repeated values count once."""
    d = df.select(*keys, at).distinct()
    d = d.withColumn("__g", F.col(at) - F.row_number().over(W.partitionBy(*keys).orderBy(at)))
    return d.groupBy(*keys, "__g").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count("*").alias("length")).drop("__g")


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str, gap: int = 0) -> DataFrame:
    """Overlapping intervals (or such with at most `gap` between them) as one."""
    w = W.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    d = df.withColumn("__new", F.when(seen.isNull() | (F.col(start) > seen + gap), 1).otherwise(0))
    d = d.withColumn("__g", F.sum("__new").over(w))
    return d.groupBy(*keys, "__g").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("__g")


def deltas(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """delta = value - previous value where the previous row is the preceding index."""
    w = W.partitionBy(*keys).orderBy(at)
    return df.withColumn("delta", F.when(F.col(at) - F.lag(at).over(w) == 1, F.col(value) - F.lag(value).over(w)))


def offsets(df: DataFrame, keys: list[str], at: str, count: str) -> DataFrame:
    """offset: the sum of the counts of all earlier rows; the next row's offset ends this row's slice."""
    w = W.partitionBy(*keys).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(count).over(w), F.lit(0)))


def moving_mean3(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Centred mean of three with zeros beyond the edges: always divided by three."""
    w = W.partitionBy(*keys).orderBy(at).rowsBetween(-1, 1)
    return df.withColumn("mean3", F.sum(value).over(w) / 3)


def parabolic_peak(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """keys, peak (index of the first largest value), shift (of the parabola through it and its neighbours), refined."""
    w = W.partitionBy(*keys).orderBy(at)
    d = df.withColumn("__p", F.lag(value).over(w)).withColumn("__n", F.lead(value).over(w))
    top = d.groupBy(*keys).agg(F.max_by(F.struct(at, value, "__p", "__n"), F.struct(F.col(value), -F.col(at))).alias("t"))
    curve = F.col("t.__p") - 2 * F.col(f"t.{value}") + F.col("t.__n")
    shift = F.coalesce(F.when(F.abs(curve) > 1e-12, 0.5 * (F.col("t.__p") - F.col("t.__n")) / curve), F.lit(0.0))
    return top.select(*keys, F.col(f"t.{at}").alias("peak"), shift.alias("shift"), (F.col(f"t.{at}") + shift).alias("refined"))


def edge_means(df: DataFrame, keys: list[str], at: str, value: str, weight: str) -> DataFrame:
    """keys, first_mean, last_mean, change: weighted means of the first and last min(2, max(1, n div 3)) rows."""
    up, down = W.partitionBy(*keys).orderBy(at), W.partitionBy(*keys).orderBy(F.desc(at))
    d = df.withColumn("__i", F.row_number().over(up)).withColumn("__j", F.row_number().over(down)).withColumn("__n", F.count("*").over(W.partitionBy(*keys)))
    k = F.expr("least(2, greatest(1, __n div 3))")
    mean = lambda c: F.try_divide(F.sum(F.when(c, F.col(value) * F.col(weight))), F.sum(F.when(c, F.col(weight))))
    out = d.groupBy(*keys).agg(mean(F.col("__i") <= k).alias("first_mean"), mean(F.col("__j") <= k).alias("last_mean"))
    return out.withColumn("change", F.col("last_mean") - F.col("first_mean"))


def max_plus_finish(df: DataFrame, keys: list[str], order: str, ready: str, work: str) -> DataFrame:
    """finish_i = max(ready_i, finish_{i-1}) + work_i, as W_i + max_{j <= i}(ready_j - W_{j-1}) with running sums W."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    d = df.withColumn("__w", F.sum(work).over(w))
    d = d.withColumn("__slack", F.max(F.col(ready) - (F.col("__w") - F.col(work))).over(w))
    return d.withColumn("finish", F.col("__w") + F.col("__slack")).drop("__w", "__slack")


def rank_margin(df: DataFrame, keys: list[str], score: str, identity: str, top: int = 8) -> DataFrame:
    """The `top` best rows of each key with rank and, for the best, its margin over the runner-up."""
    w = W.partitionBy(*keys).orderBy(F.desc(score), identity)
    d = df.withColumn("rank", F.row_number().over(w)).withColumn("margin", F.when(F.col("rank") == 1, F.col(score) - F.lead(score).over(w)))
    return d.where(F.col("rank") <= top)


def one_per_stride(df: DataFrame, keys: list[str], index: str, identity: str, stride: int, seed: str) -> DataFrame:
    """held: true for exactly one row of each run of `stride` indices, chosen by hash."""
    w = W.partitionBy(*keys, F.floor(F.col(index) / stride)).orderBy(F.md5(F.concat(F.lit(seed), F.col(identity).cast("string"))), identity)
    return df.withColumn("held", F.row_number().over(w) == 1)


def recent_rate(df: DataFrame, keys: list[str], at_us: str, count: str, last: int = 6) -> DataFrame:
    """keys, rate per second over the last events; the oldest of them only starts the clock."""
    d = df.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(at_us)))).where(F.col("__k") <= last)
    out = d.groupBy(*keys).agg(F.sum(count).alias("s"), F.min_by(count, at_us).alias("f"), (F.max(at_us) - F.min(at_us)).alias("us"), F.count("*").alias("n"))
    return out.select(*keys, "n", F.try_divide((F.col("s") - F.col("f")) * 1e6, F.col("us").cast("double")).alias("rate"))


def contiguous(df: DataFrame, keys: list[str], index: str, base: int = 0) -> DataFrame:
    """keys, n, contiguous: the indices are base .. base + n - 1, each once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), ((F.min(index) == base) & (F.max(index) - base == F.count("*") - 1) & (F.count_distinct(index) == F.count("*"))).alias("contiguous"))


def split_by_hash_round(df: DataFrame, category: str, identity: str, seed: str, shares: tuple[float, float]) -> DataFrame:
    """split of whole groups: round-robin over categories in hash order; the first share goes to test, the next to val."""
    h = F.md5(F.concat(F.lit(seed), F.col(identity).cast("string")))
    d = df.withColumn("__h", h).withColumn("__round", F.row_number().over(W.partitionBy(category).orderBy("__h", identity)))
    d = d.crossJoin(F.broadcast(df.agg(F.count("*").alias("__n"))))  # one row
    # the place in the global order (round, hash): ranks inside a round, after the sizes of all earlier rounds
    per = d.groupBy("__round").agg(F.count("*").alias("__c"))
    before = per.withColumn("__before", F.coalesce(F.sum("__c").over(W.orderBy("__round").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__c")
    d = d.join(before, "__round").withColumn("__place", F.col("__before") + F.row_number().over(W.partitionBy("__round").orderBy("__h", identity)))
    test, val = F.round(F.col("__n") * shares[0]), F.round(F.col("__n") * shares[1])
    return d.withColumn("split", F.when(F.col("__place") <= test, "test").when(F.col("__place") <= test + val, "val").otherwise("train")).drop("__h", "__round", "__n", "__before", "__place")


def worst(column: Column, ranks: dict[str, int], names: dict[int, str]) -> Column:
    """The worst status of a group by rank."""
    rank = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[column]
    back = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return back[F.max(rank)]
