"""Table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def micros(column: str) -> Column:
    """Microseconds since 1970 of a zoneless timestamp; the same in every session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in measured data: make it NULL, so that aggregates skip it and it doesn't sort above all."""
    kinds = (T.FloatType, T.DoubleType)
    return df.select(*[F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name) for f in df.schema])
