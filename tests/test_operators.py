import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import boxes, scalars, status
from tidemark.operators import align, contracts, graph, robust, sequences


def test_nearest_ties_go_to_the_earlier(spark):
    left = spark.createDataFrame([(1, 100), (1, 1000), (2, 5)], "k int, at long")
    right = spark.createDataFrame([(1, 90, "a"), (1, 110, "b"), (1, 5000, "c")], "k int, at long, v string").select("k", "at", F.struct("v").alias("row"))
    got = {(r.k, r["at"]): (r.match.row.v if r.match else None, r.distance) for r in align.nearest(left, right, ["k"], "at", 50).collect()}
    assert got == {(1, 100): ("a", 10), (1, 1000): ("b", 890), (2, 5): (None, None)}
    got = {(r.k, r["at"]): r.match for r in align.nearest(left, right, ["k"], "at", 50, 100).collect()}
    assert got[1, 1000] is None and got[1, 100] is not None


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours_do_not_depend_on_the_bucket(spark, width):
    left = spark.range(0, 200, 7).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    right = spark.range(0, 200, 11).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.struct("id").alias("row"))
    for r in align.neighbours(left, right, ["k"], "at", width).collect():
        below, above = [x for x in range(0, 200, 11) if x < r["at"]], [x for x in range(0, 200, 11) if x >= r["at"]]
        assert (r.lower["at"] if r.lower else None) == (below[-1] if below else None)
        assert (r.upper["at"] if r.upper else None) == (above[0] if above else None)


def test_robust_fixtures(spark):
    df = spark.createDataFrame([(1.0,)] * 20 + [(10.0,)], "v double")
    r = robust.mad(df, [], "v").first()
    assert (r["median"], r["mad"]) == (1.0, 0.0) and r.threshold < 10
    w = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 5.0), (1, 3.0, 1.0)], "k int, v double, w double")
    assert robust.weighted_median(w, ["k"], "v", "w").first().weighted_median == 2.0
    line = robust.weighted_line(spark.createDataFrame([(1, 1.0), (1, 1.0)], "k int, x double"), ["k"], F.col("x"), F.col("x"), F.lit(1.0)).first()
    assert line.n == 2 and line.slope is None
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double").agg(robust.guarded_corr("x", "y").alias("r")).first()
    assert flat.r == 0.0


def test_max_plus_equals_the_recurrence(spark):
    rows = [(1, i, (i * 37) % 50, (i * 13) % 9 + 1) for i in range(40)]
    got = {r.o: r.finish for r in sequences.max_plus_finish(spark.createDataFrame(rows, "k int, o int, ready long, work long"), ["k"], "o", "ready", "work").collect()}
    at = 0
    for _, o, ready, work in rows:
        at = max(ready, at if o else ready) + work
        assert got[o] == at


def test_islands_and_intervals(spark):
    d = spark.createDataFrame([(1, x) for x in (1, 2, 2, 3, 7, 9, 10)], "k int, at long")
    assert sorted((r.start, r.end, r.length) for r in sequences.islands(d, ["k"], "at").collect()) == [(1, 3, 3), (7, 7, 1), (9, 10, 2)]
    m = spark.createDataFrame([(1, 0, 10), (1, 2, 3), (1, 12, 15)], "k int, s int, e int")
    assert sorted((r.start, r.end) for r in sequences.merged_intervals(m, ["k"], "s", "e", 1).collect()) == [(0, 10), (12, 15)]
    assert sequences.islands(d.limit(0), ["k"], "at").count() == 0


def test_holdout_is_one_of_each_stride(spark):
    d = spark.range(101).select(F.lit(1).alias("k"), F.col("id"))
    held = [r.id for r in sequences.one_per_stride(d, ["k"], "id", "id", 5, "s").where("held").collect()]
    assert sorted(h // 5 for h in held) == list(range(21))


def test_status_fixtures(spark):
    d = spark.createDataFrame([(5.0, 20.0, "PASS"), (8.0, 40.0, "PASS"), (21.0, 50.0, "PASS"), (1.0, 2.0, "FAIL"), (None, 2.0, "PASS"), (5.0, 20.0, "REVIEW"), (5.0, 20.0, None)], "m double, p double, a string")
    got = [r.s for r in d.select(status.consistency(F.col("m"), F.col("p"), F.col("a"), F.lit(10.0)).alias("s")).collect()]
    review, no_go = "REVIEW_POSE_CAMERA_CONSISTENCY", "NO_GO_TRIANGULATION"
    assert got == ["PASS", review, no_go, no_go, no_go, review, review]
    row = spark.range(1).select(status.worst_of(F.array(F.lit("PASS"), F.lit("FAIL"), F.lit("REVIEW"))).alias("w"), status.family(F.lit("NO_GO_X")).alias("f"), status.bitmask(F.lit(True), F.lit(False), F.lit(True)).alias("b")).first()
    assert tuple(row) == ("FAIL", "FAIL", 5)
    sets = [((1, 2), (1, 2)), ((1, 3), (1, 2)), ((1, 2, 3), (1, 2))]
    got = [spark.range(1).select(status.set_action(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)), k).alias("x")).first().x for (a, b), k in zip(sets + [sets[2]], (1, 1, 2, 1))]
    assert got == ["WAIT", "ATTENTION", "WAIT", "EXPORT"]


def test_scalars(spark):
    d = spark.createDataFrame([("1/2",), ("1/0",), (" 3 ",), ("N/A",), ("inf",), ("",), (None,)], "t string")
    assert [r.v for r in d.select(scalars.to_number(F.col("t")).alias("v")).collect()] == [0.5, None, 3.0, None, None, None, None]
    r = spark.range(1).select(scalars.option(F.array(F.lit("a"), F.lit("--x"), F.lit("v")), "--x").alias("a"), scalars.option(F.array(F.lit("--x=w")), "--x").alias("b"), scalars.option(F.array(F.lit("a")), "--x").alias("c"), scalars.human_duration(F.lit(3725)).alias("d"), scalars.has_zone(F.lit("2024-01-01T00:00:00+0900")).alias("e")).first()
    assert tuple(r) == ("v", "w", None, "1h 02m 05s", True)
    b = spark.range(1).select(boxes.iou(boxes.box(*[F.lit(float(x)) for x in (0, 0, 2, 2)]), boxes.box(*[F.lit(float(x)) for x in (1, 0, 3, 2)])).alias("i"), boxes.iou(boxes.box(*[F.lit(0.0)] * 4), boxes.box(*[F.lit(0.0)] * 4)).alias("z")).first()
    assert b.i == pytest.approx(1 / 3) and b.z == 0


def test_contracts_and_graph(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    b = spark.createDataFrame([(2, 7), (3, 8)], "k int, v int")
    got = sorted((r.k, r.reason) for r in contracts.reconcile(a, b, ["k"], ["v"]).collect())
    assert got == [(1, "MISSING_RIGHT"), (2, "MISMATCH_v"), (3, "MISSING_LEFT")]
    s = [contracts.signature(spark.createDataFrame(x, "g int, k int, v int"), ["g"], "k", ["v"]).first().signature for x in ([(1, 1, 2), (1, 2, 3)], [(1, 2, 3), (1, 1, 2)], [(1, 1, 3), (1, 2, 2)])]
    assert s[0] == s[1] != s[2]
    nodes = spark.range(10).select("id")
    edges = spark.createDataFrame([(5, 4), (4, 3), (8, 9), (7, 7)], "a long, b long")
    assert {r.id: r.component for r in graph.connected_components(nodes, edges).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 8, 9: 8}


def test_whole_graph_and_conflicting_components(spark):
    edges = spark.createDataFrame([(1, 11), (11, 21), (2, 12), (2, 13), (4, 5)], "a long, b long")
    members = spark.createDataFrame([(i, i // 10) for i in (1, 11, 21, 2, 12, 13, 4, 5, 9)], "id long, camera long")
    got = {r.component: (r.members, r.cameras, r.status) for r in graph.accepted_components(graph.connected_components(members, edges), members).collect()}
    assert got == {1: (3, 3, "ACCEPTED"), 2: (3, 2, "CONFLICT"), 4: (2, 1, "SINGLE"), 9: (1, 1, "SINGLE")}

    from tidemark.plans import QUERIES

    folder, parent = "/root/testdata/sf0.001", {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    parts = {r.p_partkey for r in spark.read.parquet(f"{folder}/part.parquet").select("p_partkey").collect()}
    for r in spark.read.parquet(f"{folder}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().collect():
        if r.l_partkey in parts:
            a, b = find(r.l_partkey), find(r.l_suppkey + 1_000_000_000)
            parent[max(a, b)] = min(a, b)
    assert {r.id: r.component for r in QUERIES["components_whole"](spark, folder).collect()} == {i: find(i) for i in list(parent)}


def test_affinity_by_hand(spark):
    """Values worked out from the rule, and equal to the kernel's."""
    import math

    from tidemark.functions import boxes
    from tidemark.operators import kernels

    cases = [((0, 0, 1, 1), (0, 0, 1, 1), 1, 1.0), ((0, 0, 1, 1), (0, 0, 1, 1), 3, math.exp(-0.24)), ((0.0, 0.0, 0.2, 0.2), (0.5, 0.5, 0.7, 0.7), 1, 0.0), ((0, 0, 0.5, 0.5), (0, 0, 0.1, 0.1), 1, 0.0)]
    overlap, shift = 0.1 / 0.3, 0.1 / 0.14  # two boxes of 0.2 by 1, half beside each other
    cases.append(((0, 0, 0.2, 1), (0.1, 0, 0.3, 1), 1, 0.5 * overlap + 0.25 * math.exp(-(shift**2)) + 0.25))
    box = lambda b: F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(b, ("x1", "y1", "x2", "y2"))])
    for a, b, gap, want in cases:
        assert spark.range(1).select(boxes.affinity(box(a), box(b), F.lit(gap))).first()[0] == pytest.approx(want, abs=1e-9)
        assert kernels.box_affinity(np.array(a, float), np.array(b, float), gap) == pytest.approx(want, abs=1e-9)
