"""op1 deals only the blocks of open buckets anew."""

from pyspark.sql import functions as F

from tests.llm.test_operators import DOCS
from tidemark.llm import ngram_join as J


def test_only_blocks_of_open_buckets_leave_the_mapper(spark):
    words = [" ".join(f"w{d}x{i}" for i in range(400)) for d in range(40)]
    docs = spark.createDataFrame(list(enumerate(words)), DOCS)
    ids = J.set_ids(docs, 4)
    classes = ids.groupBy("h1", "h2").agg(F.min(F.xxhash64("doc_id")).alias("rep"))
    rows = J.block_rows(docs, 4, 85, 100)
    label = F.struct(F.col("h1"), F.lit(0).cast("long").alias("h2")).alias("label")
    opened = rows.groupBy("h1").agg(F.min("key").alias("key")).select("key", "h1", label).localCheckpoint()
    found = J.open_blocks(docs, classes, opened, 4, 85, 100).select("key", "h1").collect()
    wanted = {(r.key, r.h1) for r in opened.collect()}
    successors = {(int(k), r.h1) for r, s in ((r, J.shingle_set(words[r.doc_id], 4)) for r in ids.collect()) for k in J.successors(s, J.Bands(85, 100))[0].view("int64")}
    assert wanted & successors <= {(r.key, r.h1) for r in found}
    assert len(found) <= len(wanted) < len(successors) / 10
    assert J.finer_rows(docs, classes, opened, 4, 85, 100).select("h1").distinct().count() == len(wanted)
