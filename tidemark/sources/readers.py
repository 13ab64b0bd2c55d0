"""Sources: tolerant rows, documents, archives, discovery, inventories, chunks and versioned builds."""

from __future__ import annotations

import io
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.scalars import to_number, transient_name
from tidemark.operators.kernels import jpeg_size


def read_rows(spark: SparkSession, path: str, columns: list[str], numbers: tuple[str, ...] = ()) -> DataFrame:
    """CSV rows with a header; all values are text, and the columns in numbers are coerced (bad text is null)."""
    raw = spark.read.csv(path, header=True, schema=T.StructType([T.StructField(c, T.StringType()) for c in columns]), enforceSchema=False, mode="PERMISSIVE")
    return raw.select(*[to_number(F.col(c)).alias(c) if c in numbers else F.col(c) for c in columns])


def single_row(df: DataFrame) -> DataFrame:
    """df, which must have exactly one row: any other number raises when it is read."""
    n = df.agg(F.count("*").alias("__n"))
    checked = df.crossJoin(F.broadcast(n))  # one row
    return checked.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("expected one row")).isNull())).drop("__n")


def successful(df: DataFrame) -> DataFrame:
    return df.where(F.col("status").isin("PASS", "REVIEW"))


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents (one a file) with the file's path; what doesn't parse comes with null fields and its text in `corrupt`."""
    full = T.StructType([*schema.fields, T.StructField("corrupt", T.StringType())])
    return spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(path).withColumn("path", F.input_file_name())


class ArchiveReader(DataSourceReader):
    """Archives of named arrays that share axis 0; a partition is a file; a row is an index of axis 0."""

    def __init__(self, schema: T.StructType, path: str):
        self.schema, self.path = schema, path

    def partitions(self):
        files = sorted(os.path.join(self.path, f) for f in os.listdir(self.path) if f.endswith(".npz")) if os.path.isdir(self.path) else [self.path]
        return [InputPartition(f) for f in files]

    def read(self, partition):
        names = [f.name for f in self.schema.fields if f.name not in ("archive", "row")]
        with np.load(partition.value, allow_pickle=False) as z:
            arrays = [z[n] for n in names]
        for i in range(len(arrays[0]) if arrays else 0):
            values = {n: a[i].tolist() for n, a in zip(names, arrays)}
            yield tuple(os.path.basename(partition.value) if f.name == "archive" else i if f.name == "row" else values[f.name] for f in self.schema.fields)


class ArchiveSource(DataSource):
    """Format "array_archive": load(path) with a schema of `archive`, `row` and the arrays wanted."""

    @classmethod
    def name(cls) -> str:
        return "array_archive"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(schema, self.options["path"])


def register_archives(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)


def read_archives(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Archives from any store that Spark reads: whole files go to the workers, which load them without pickles."""
    struct = T.StructType.fromDDL(schema)
    names = [f.name for f in struct.fields if f.name not in ("archive", "row")]

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    out = pd.DataFrame({n: list(z[n].tolist()) for n in names})
                out["archive"], out["row"] = os.path.basename(name), range(len(out))
                yield out[[f.name for f in struct.fields]]

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, struct)


def discover(spark: SparkSession, path: str, pattern: str, names: list[str], glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """Files whose path matches pattern with its groups as columns, and the others; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")
    good = files.where(F.col("path").rlike(pattern))
    return good.select("*", *[F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)]), files.where(~F.col("path").rlike(pattern))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, label (top folder) of finalized files: names of unfinished work are left out; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~transient_name(name)).select("path", F.col("length").alias("bytes"))


def image_sizes(files: DataFrame) -> DataFrame:
    """path, width, height of JPEG files from their headers."""

    @F.pandas_udf("width int, height int")
    def size(head: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([jpeg_size(bytes(h)) or (None, None) for h in head], columns=["width", "height"]).astype("Int32")

    return files.select("path", size(F.substring("content", 1, 65536)).alias("s")).select("path", "s.*")


def contiguous_chunks(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """keys, n, contiguous for rows read from several chunk files."""
    from tidemark.operators.sequences import contiguous

    return contiguous(df, keys, index)


def missing_chunks(have: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(have.select(*keys).distinct(), keys, "left_anti")


def build_manifests(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The manifests of all builds below root with the folder of each."""
    docs = read_documents(spark, f"{root}/*/dataset_manifest.json", schema)
    return docs.withColumn("build", F.element_at(F.split("path", "/"), -2))


def valid_workloads(df: DataFrame, keys: list[str], valid: str, count: int, sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """Groups all of whose `count` rows are valid, with their sums; and the invalid rows."""
    ok = df.where(F.coalesce(F.expr(valid), F.lit(False)))
    return ok.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.sum(c).alias(c) for c in sums]).where(F.col("__n") == count).drop("__n"), df.where(~F.coalesce(F.expr(valid), F.lit(False)))


def with_timestamps(frames: DataFrame, times: DataFrame, keys: list[str]) -> DataFrame:
    """Frames with their timestamps by index; a name that differs raises."""
    j = frames.join(times.withColumnRenamed("frame_name", "__name"), [*keys, "frame_index"])
    return j.where(F.when(F.col("frame_name") == F.col("__name"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("name of frame "), F.col("frame_index"))).isNull())).drop("__name")


def log_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Lines of logs that match."""
    return spark.read.text(path).where(F.col("value").rlike(pattern))


def ragged_rows(df: DataFrame, keys: list[str], offsets: str, values: str) -> DataFrame:
    """keys, row, item, value from offsets[n + 1] and flat values; offsets that don't start at 0, rise and end at the
    length raise."""
    o, v = F.col(offsets), F.col(values)
    rising = F.forall(F.sequence(F.lit(1), F.size(o) - 1), lambda i: F.get(o, i) >= F.get(o, i - 1))
    good = (F.get(o, F.lit(0)) == 0) & (F.element_at(o, -1) == F.size(v)) & rising
    checked = df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("bad offsets")).isNull()))
    rows = checked.select(*keys, o.alias("__o"), v.alias("__v"), F.posexplode(F.slice(o, 1, F.size(o) - 1)).alias("row", "__a"))
    cut = F.slice("__v", F.col("__a").cast("int") + 1, (F.get("__o", F.col("row") + 1) - F.col("__a")).cast("int"))
    return rows.select(*keys, "row", F.posexplode(cut).alias("item", "value"))
