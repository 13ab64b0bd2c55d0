import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import readers, sinks


def test_rows_and_documents(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,x\none,1/2\ntwo,N/A\n")
    got = [tuple(r) for r in readers.read_rows(spark, str(tmp_path / "a.csv"), ["name", "x"], ("x",)).collect()]
    assert got == [("one", 0.5), ("two", None)]
    os.mkdir(tmp_path / "docs")
    (tmp_path / "docs/a.json").write_text(json.dumps({"n": {"v": 3}}))
    (tmp_path / "docs/b.json").write_text("{broken")
    schema = T.StructType.fromDDL("n struct<v:int>")
    rows = {os.path.basename(r.path): (r.n.v if r.n else None, r.corrupt is None) for r in readers.read_documents(spark, str(tmp_path / "docs"), schema).collect()}
    assert rows == {"a.json": (3, True), "b.json": (None, False)}
    assert readers.single_row(spark.range(1)).count() == 1
    with pytest.raises(Exception, match="expected one row"):
        readers.single_row(spark.range(2)).collect()


def test_archives_both_ways(spark, tmp_path):
    for n in "ab":
        np.savez(tmp_path / f"{n}.npz", xy=np.arange(6.0).reshape(3, 2), ok=np.array([True, False, True]))
    schema = "archive string, row int, xy array<double>, ok boolean"
    readers.register_archives(spark)
    one = spark.read.format("array_archive").schema(schema).option("path", str(tmp_path)).load()
    two = readers.read_archives(spark, str(tmp_path), schema)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.count() == 6 and one.where("ok").count() == 4


def test_discovery_and_inventory(spark, tmp_path):
    for p in ("squat_01/cam1.mp4", "squat_01/cam2.mp4.tmp", "odd.txt"):
        os.makedirs((tmp_path / p).parent, exist_ok=True)
        (tmp_path / p).write_bytes(b"xx")
    good, bad = readers.discover(spark, str(tmp_path), r"/([a-z]+)_(\d+)/(cam\d)\.mp4$", ["exercise", "take", "camera"])
    assert [tuple(r) for r in good.select("exercise", "take", "camera").collect()] == [("squat", "01", "cam1")]
    assert bad.count() == 2
    assert readers.inventory(spark, str(tmp_path)).agg(F.count("*"), F.sum("bytes")).first()[:] == (2, 4)


def test_images_chunks_and_ragged(spark, tmp_path):
    (tmp_path / "i.jpg").write_bytes(b"\xff\xd8\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x01\x01\x11\x00\xff\xd9")
    (tmp_path / "j.jpg").write_bytes(b"zz")
    got = {os.path.basename(r.path): (r.width, r.height) for r in readers.image_sizes(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {"i.jpg": (32, 16), "j.jpg": (None, None)}
    d = spark.createDataFrame([("s", 0), ("s", 1), ("t", 0), ("t", 2)], "seq string, f int")
    assert {r.seq: r.contiguous for r in readers.contiguous_chunks(d, ["seq"], "f").collect()} == {"s": True, "t": False}
    r = spark.createDataFrame([("k", [0, 2, 2, 3], [5, 6, 7])], "k string, o array<int>, v array<int>")
    assert sorted((x.row, x.item, x.value) for x in readers.ragged_rows(r, ["k"], "o", "v").collect()) == [(0, 0, 5), (0, 1, 6), (2, 0, 7)]
    bad = spark.createDataFrame([("k", [0, 2, 1], [5])], "k string, o array<int>, v array<int>")
    with pytest.raises(Exception, match="bad offsets"):
        readers.ragged_rows(bad, ["k"], "o", "v").collect()


def test_workloads_timestamps_logs_builds(spark, tmp_path):
    w = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 5), ("b", 2, -1)], "s string, c int, n int")
    good, bad = readers.valid_workloads(w, ["s"], "n > 0", 2, ["n"])
    assert [tuple(r) for r in good.collect()] == [("a", 10)] and bad.count() == 1
    f = spark.createDataFrame([("s", 0, "x"), ("s", 1, "y")], "s string, frame_index int, frame_name string")
    assert readers.with_timestamps(f, f.withColumn("t", F.lit(1.0)), ["s"]).count() == 2
    with pytest.raises(Exception, match="name of frame"):
        readers.with_timestamps(f, f.withColumn("frame_name", F.lit("z")), ["s"]).collect()
    (tmp_path / "l.log").write_text("ok\nERROR x\n")
    assert readers.log_lines(spark, str(tmp_path / "l.log"), "ERROR").count() == 1
    sinks.atomic_document(str(tmp_path / "out/b1/dataset_manifest.json"), {"build_id": "b1"})
    assert [r.build for r in readers.build_manifests(spark, str(tmp_path / "out"), T.StructType.fromDDL("build_id string")).collect()] == ["b1"]


def test_csv_with_a_union_of_columns(spark, tmp_path):
    a, b = spark.createDataFrame([(1, [1, 2])], "k int, v array<int>"), spark.createDataFrame([(2, "x")], "k int, w string")
    sinks.write_csv([a, b], str(tmp_path / "o"), ["w", "k"])
    got = spark.read.csv(str(tmp_path / "o"), header=True)
    assert got.columns == ["w", "k", "v"] and got.count() == 2


def test_publish_refuses_and_verifies(spark, tmp_path):
    df = spark.range(5)
    stage, final = str(tmp_path / ".stage"), str(tmp_path / "build")
    with pytest.raises(ValueError):
        sinks.publish(df, stage, final, lambda x: ["BAD"])
    assert not os.path.exists(stage)
    sinks.publish(df, stage, final, lambda x: [] if x.count() == 5 else ["COUNT"])
    assert spark.read.parquet(final).count() == 5
    with pytest.raises(FileExistsError):
        sinks.publish(df, stage, final, lambda x: [])


def test_copies_partitions_and_provenance(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc" * 1000)
    want = hashlib.sha256(b"abc" * 1000).hexdigest()
    assert sinks.copy_exact(str(tmp_path / "a"), str(tmp_path / "b")) == want == sinks.copy_exact(str(tmp_path / "a"), str(tmp_path / "b"))
    d = sinks.digests(spark.read.format("binaryFile").load(str(tmp_path / "b")))
    assert d.first().sha256 == want
    assert sinks.manifest_faults(d, d.withColumn("bytes", F.lit(1).cast("long"))) == ["MISMATCH_bytes"]
    sinks.write_partitioned(spark.range(10).withColumn("k", F.col("id") % 2), str(tmp_path / "p"), ["k"], "id")
    assert spark.read.parquet(str(tmp_path / "p")).where("k = 1").count() == 5
    assert sinks.insert_missing(spark.range(5), spark.range(3), ["id"]).count() == 2
