"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the controls 9 to 13, which is what bytes.split() splits at.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of our own if driver
    and executors are one process; a cluster has to name one."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and the executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="tidemark-")
    return _own_dir


#: Rows of a batch that goes to a Python worker while cut() writes; whole texts come in them.
BATCH = 2000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def cut(df: DataFrame, label: str, release: bool = True, batch: int = BATCH) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it again.

    Executors that are lost later cost nothing, as the rows are in the shared store. release: let the driver collect its
    garbage, upon which Spark removes the shuffle files of what is written now. batch: the most rows that a worker gets
    at once; the session's own setting holds again afterwards.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    own = spark.conf.get(_ROWS)
    try:
        spark.conf.set(_ROWS, str(min(int(own), batch) if int(own) > 0 else batch))
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, own)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    if release:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote and nothing will read again."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class Memo(dict):
    """A worker's cache of a pure function. At its bound it starts afresh, so that its memory stays bounded."""

    def __init__(self, function, bound: int = 400_000):
        super().__init__()
        self.function, self.bound = function, bound

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.bound:
            self.clear()
        self[key] = value
        return value


def released(run):
    """run, after which the worker gives unused memory back: it may go on to serve other stages."""

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":  # glibc keeps what numpy freed, too
            getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)

    return whole
