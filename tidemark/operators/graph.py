"""Connected components by label propagation with shortcuts; each round is written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_own: list[str] = []


def shared_folder(spark) -> str:
    """spark.checkpoint.dir; a folder of our own only where driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and the executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _own[0]


def written(df: DataFrame) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the least id that is reachable. nodes: id; edges: a, b in either direction."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(nodes.select("id").distinct().withColumn("component", F.col("id")))
    while True:
        come = both.join(labels, both.a == labels.id).groupBy("b").agg(F.min("component").alias("come"))
        new = labels.join(come, labels.id == come.b, "left").select("id", F.least("component", "come").alias("component"), F.col("component").alias("was"))
        jump = new.groupBy("was").agg(F.min("component").alias("jump"))
        new = written(new.join(jump, "was").select("id", F.least("component", "jump").alias("component"), "was"))
        labels = new.select("id", "component")
        if new.where("component <> was").isEmpty():
            return labels


def accepted_components(labels: DataFrame, members: DataFrame) -> DataFrame:
    """(component, members, cameras, status) of each component. labels: id, component; members: id, camera, a row for each
    id. SINGLE: of one camera only; CONFLICT: with two members of one camera; else ACCEPTED."""
    by_camera = labels.join(members, "id").groupBy("component", "camera").agg(F.count("*").alias("n"))
    c = by_camera.groupBy("component").agg(F.sum("n").alias("members"), F.count("*").alias("cameras"))
    status = F.when(F.col("cameras") < 2, "SINGLE").when(F.col("cameras") < F.col("members"), "CONFLICT").otherwise("ACCEPTED")
    return c.select("component", "members", "cameras", status.alias("status"))
