import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audits

SOURCE = "seq string, frame_name string"
CHOSEN = "seq string, frame long, frame_name string, pts double, n_candidates long, candidate_offset long, target long, ambiguous boolean, missing boolean, status string, n_others long, other_offset long"
BOXES = "seq string, frame long, candidate long, box array<double>, score double"
GOOD = [["a", 0, "f0", 0.0, 2, 0, 1, False, False, "TARGET", 1, 0], ["a", 1, "f1", 0.1, 0, 2, -1, False, True, "NONE", 0, 1], ["a", 2, "f2", 0.2, 1, 2, 0, False, False, "TARGET", 0, 1]]
SEEN = [["a", 0, 0, [0.0, 1.0], 0.5], ["a", 0, 1, [2.0, 3.0], None], ["a", 2, 0, [4.0, 5.0], 0.7]]


def faults(spark, chosen=GOOD, kept=SEEN, source=(("a", "f0"), ("a", "f1"), ("a", "f2")), others=(("a", 0),), detected=SEEN):
    make = lambda rows, schema: spark.createDataFrame([tuple(r) for r in rows], schema)
    return audits.selection_faults(["seq"], make(source, SOURCE), make(chosen, CHOSEN), make(detected, BOXES), make(kept, BOXES), make(others, "seq string, frame long")).collect()


def changed(rows, i, j, value):
    return [[value if (a, b) == (i, j) else x for b, x in enumerate(r)] for a, r in enumerate(rows)]


def test_a_lossless_selection_passes(spark):
    (r,) = faults(spark)
    assert (r.frames, r.candidates, r.targets, r.errors, r.status) == (3, 3, 2, "", "PASS")


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({"chosen": changed(GOOD, 2, 2, "g2")}, {"frame_name_matches_source"}),
        ({"chosen": changed(changed(GOOD, 0, 2, "f1"), 1, 2, "f0")}, {"frame_name_matches_source"}),
        ({"chosen": changed(GOOD, 1, 3, math.inf)}, {"timestamps_finite"}),
        ({"chosen": changed(GOOD, 1, 3, None)}, {"timestamps_finite"}),
        ({"chosen": changed(GOOD, 2, 5, 3)}, {"candidate_offsets_match_detector"}),
        ({"chosen": changed(GOOD, 0, 5, 1)}, {"candidate_offsets_match_detector"}),
        ({"chosen": changed(GOOD, 0, 6, 2)}, {"target_indices_in_bounds"}),
        ({"chosen": changed(GOOD, 0, 7, True)}, {"no_forced_abstention"}),
        ({"chosen": changed(GOOD, 0, 9, "REVIEW")}, {"accepted_status_is_target"}),
        ({"chosen": changed(GOOD, 2, 4, 2)}, {"candidate_counts_match_detector", "background_counts_consistent"}),
        ({"chosen": changed(GOOD, 2, 11, 0)}, {"background_offsets_consistent"}),
        ({"others": (("a", 0), ("a", 2))}, {"background_offsets_consistent"}),
        ({"kept": SEEN[1:]}, {"candidate_boxes_lossless", "candidate_scores_lossless"}),
        ({"kept": changed(SEEN, 1, 4, 0.1)}, {"candidate_scores_lossless"}),
        ({"kept": changed(SEEN, 1, 3, None)}, {"candidate_boxes_lossless"}),
    ],
)
def test_each_fault_is_named(spark, change, errors):
    (r,) = faults(spark, **change)
    assert set(r.errors.split(",")) == errors and r.status == "FAIL"


def test_sequences_of_one_side_only_fail_and_none_give_none(spark):
    assert faults(spark, [], [], (), (), []) == []
    (r,) = faults(spark, [], [], others=(), detected=[])
    assert r.frames == 0 and "frame_count_matches_source" in r.errors
    (r,) = faults(spark, source=())
    assert r.frames == 3 and "frame_count_matches_source" in r.errors


def test_rigid_errors(spark):
    one = [float(i == j) for i in range(4) for j in range(4)]
    turned = [0.0, -1.0, 0.0, 2.0, 1.0, 0.0, 0.0, 3.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    back = [0.0, 1.0, 0.0, -3.0, -1.0, 0.0, 0.0, 2.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    mirror = [-1.0, *one[1:]]
    df = spark.createDataFrame([(0, one, one), (1, turned, back), (2, turned, one), (3, mirror, mirror), (4, [math.nan, *one[1:]], one)], "id int, m array<double>, v array<double>")
    got = {r.id: r for r in df.select("id", *[c.alias(n) for n, c in audits.rigid_errors(F.col("m"), F.col("v")).items()]).collect()}
    assert [got[i].finite for i in range(5)] == [True, True, True, True, False]
    assert got[0].inverse_error == got[0].gauge_error == got[1].inverse_error == got[1].orthogonality_error == 0
    assert got[1].gauge_error == 3 and got[2].inverse_error == 3 and got[3].determinant == -1 and got[3].orthogonality_error == 0


def test_totals_of_nothing(spark):
    rows = spark.createDataFrame([], "kind string, exists boolean, file_count long, logical_bytes long, transient long, symlinks long, errors array<string>")
    (r,) = audits.inventory_totals(rows, "kind").collect()
    assert (r.overall, r.path_count, r.logical_bytes, r.gib, r.scan_errors) == (True, 0, 0, 0.0, 0)
    (r,) = audits.output_totals(spark.createDataFrame([], "stage string, sequence string, status string, frame_count long"), "q").collect()
    assert (r.sequences, r.frames, r.status) == (0, 0, "PASS")


def test_telemetry_passes_over_missing_readings(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", None), ("p", 3.0), ("q", None)], "phase string, load double")
    got = {r.phase: r for r in audits.telemetry(df, ["phase"], ["load"]).collect()}
    assert (got["p"].sample_count, got["p"].load_mean, got["p"].load_max) == (3, 2.0, 3.0) and got["p"].load_p90 == pytest.approx(2.8)
    assert got["q"].sample_count == 1 and got["q"].load_mean is None and got["q"].load_p95 is None


def test_stages_against_their_frames(spark):
    nan = math.nan
    base = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 0.5), ("b", 0, None), ("c", 0, 0.0)], "seq string, frame long, pts double")
    schema = "seq string, frame long, pts double, value double, valid boolean, accepted boolean, target_valid boolean"
    good = spark.createDataFrame([("a", 0, 0.0, 1.0, True, True, True), ("a", 1, 0.5, nan, False, False, None), ("b", 0, None, None, None, None, None), ("c", 0, 0.0, 1.0, True, False, False)], schema)
    bad = spark.createDataFrame([("a", 0, 0.0, nan, True, True, None), ("a", 2, 0.5, 1.0, False, False, True), ("b", 0, 1.0, None, False, None, None), ("z", 0, 0.0, 1.0, True, True, True)], schema)
    got = {r.seq: (r.reasons, r.status) for r in audits.stage_faults(["seq"], base, {"one": good, "two": bad}).collect()}
    # a: as many frames, but other ones
    assert got == {"a": ("two:finite,two:forced,two:frame_index", "FAIL"), "b": ("two:pts", "FAIL"), "c": ("two:missing", "FAIL")}
    none = audits.stage_faults(["seq"], base.limit(0), {"one": good})
    assert none.count() == 0
