"""Data contracts: reconciliation of inventories, signatures, named checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Full outer comparison of two inventories: keys, reason (MISSING_RIGHT, MISSING_LEFT, or MISMATCH_<column>), one
    row for each fault."""
    a = left.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in compare], F.lit(True).alias("__a"))
    b = right.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in compare], F.lit(True).alias("__b"))
    both = a.join(b, keys, "full")
    present = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    tests = [F.when(F.col("__b").isNull(), F.lit("MISSING_RIGHT")), F.when(F.col("__a").isNull(), F.lit("MISSING_LEFT"))]
    tests += [F.when(present & ~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")), F.lit(f"MISMATCH_{c}")) for c in compare]
    return both.select(*keys, F.explode(F.array_compact(F.array(*tests))).alias("reason"))


def signature(df: DataFrame, keys: list[str], label: str, fields: list[str]) -> DataFrame:
    """keys, signature: SHA-256 over the rows' "label:field:..." lines, in the order of the labels."""
    line = F.concat_ws(":", F.col(label).cast("string"), *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    rows = F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), line.alias("line"))))
    return df.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(rows, lambda r: r["line"]), "\n"), 256).alias("signature"))


def failed_checks(**checks: Column) -> Column:
    """The names of the named checks that don't hold, sorted and joined; empty where all do."""
    return F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))), ",")


def not_yet_done(items: DataFrame, done: DataFrame, keys: list[str], signature_column: str) -> DataFrame:
    """Items without a finished result of the same signature: what a resumed run still has to do."""
    return items.join(done.select(*keys, signature_column).distinct(), [*keys, signature_column], "left_anti")
