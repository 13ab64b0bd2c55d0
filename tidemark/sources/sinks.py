"""Sinks: atomic documents, tables with a union of columns, staged immutable builds, copies with digests, provenance."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.contracts import reconcile


def atomic_document(path: str, payload) -> None:
    """One small document of the driver's: a temporary sibling, flushed to disk and renamed."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, name = tempfile.mkstemp(dir=folder, prefix=".tmp-")
    try:
        with os.fdopen(fd, "w") as f:
            f.write(payload if isinstance(payload, str) else json.dumps(payload, indent=2, sort_keys=True))
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        if os.path.exists(name):
            os.unlink(name)
        raise


def flat(df: DataFrame, preferred: list[str] = ()) -> DataFrame:
    """Nested columns as JSON, the preferred columns first: what a CSV file can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    columns = [c for c in preferred if c in df.columns] + [c for c in df.columns if c not in preferred]
    return df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, nested) else F.col(c) for c in columns])


def write_csv(frames: list[DataFrame], path: str, preferred: list[str] = ()) -> None:
    """Frames with differing columns as one table; what a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    flat(out, list(preferred)).write.mode("overwrite").csv(path, header=True)


def write_partitioned(df: DataFrame, path: str, keys: list[str], order: str) -> None:
    """Rows in ranges of their order, in a folder for each key."""
    df.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order).write.mode("overwrite").partitionBy(*keys).parquet(path)


def publish(df: DataFrame, staging: str, final: str, verify) -> None:
    """Write to the staging folder, verify what was written, and rename it in one step; an existing build is refused."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path(final)):
        raise FileExistsError(final)
    df.write.mode("errorifexists").parquet(staging)
    reasons = verify(spark.read.parquet(staging))
    if reasons:
        fs.delete(path(staging), True)
        raise ValueError(f"not published: {reasons}")
    if not fs.rename(path(staging), path(final)):
        raise OSError(f"{staging} could not be renamed")


def digests(files: DataFrame) -> DataFrame:
    """path, bytes, sha256 of a binaryFile frame."""
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def copy_exact(source: str, destination: str, chunk: int = 1 << 20) -> str:
    """Copy a file with its digest computed on the way; a change of the source meanwhile raises; a finished copy with
    the same digest is kept. Returns the digest."""

    def digest(path):
        h = hashlib.sha256()
        with open(path, "rb") as f:
            while part := f.read(chunk):
                h.update(part)
        return h.hexdigest()

    before = os.stat(source)
    if os.path.exists(destination) and os.path.getsize(destination) == before.st_size and (known := digest(destination)) == digest(source):
        return known
    h, partial = hashlib.sha256(), f"{destination}.partial"
    with open(source, "rb") as a, open(partial, "wb") as b:
        while part := a.read(chunk):
            h.update(part)
            b.write(part)
        b.flush()
        os.fsync(b.fileno())
    after = os.stat(source)
    if (before.st_size, before.st_mtime_ns, before.st_ino) != (after.st_size, after.st_mtime_ns, after.st_ino):
        os.unlink(partial)
        raise RuntimeError(f"{source} changed while it was copied")
    os.replace(partial, destination)
    return h.hexdigest()


def insert_missing(done: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Provenance rows to append: completed items that have none yet."""
    return done.join(existing.select(*keys).distinct(), keys, "left_anti")


def manifest_faults(left: DataFrame, right: DataFrame) -> list[str]:
    """Reasons that two listings (path, bytes, sha256) differ for; empty where they agree."""
    return [r.reason for r in reconcile(left, right, ["path"], ["bytes", "sha256"]).select("reason").distinct().orderBy("reason").toLocalIterator()]
