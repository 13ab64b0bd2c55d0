"""Audits of a stage's output against what it was made from, and totals over what stages left behind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.contracts import failed_checks


def _finite(value: Column) -> Column:
    return F.coalesce((value > float("-inf")) & (value < float("inf")), F.lit(False))


def selection_faults(keys: list[str], source: DataFrame, chosen: DataFrame, detected: DataFrame, kept: DataFrame, others: DataFrame) -> DataFrame:
    """keys, frames, candidates, targets, errors (the names of the checks that fail, sorted and joined by commas), status.

    source: keys, frame_name. chosen: a row for each frame with keys, frame (from 0), frame_name, pts, n_candidates,
    candidate_offset (candidates before this frame), target (a candidate's number, or -1), ambiguous, missing, status,
    n_others, other_offset. detected and kept: keys, frame, candidate, box, score. others: keys, frame, a row each.

    Orders and offsets are compared with the next frame's by an equi-join, so that a sequence with any share of the rows
    is not gathered in one task. A sequence that only one of source and chosen has fails the count.
    """
    at = [*keys, "frame"]
    follower = chosen.select(*keys, (F.col("frame") - 1).alias("frame"), F.col("frame_name").alias("next_name"), F.col("candidate_offset").alias("next_candidate"), F.col("other_offset").alias("next_other"))
    seen = detected.groupBy(*at).agg(F.count("*").alias("n_detected"))
    known = source.select(*keys, "frame_name", F.lit(True).alias("known")).distinct()
    f = chosen.join(follower, at, "left").join(seen, at, "left").join(known, [*keys, "frame_name"], "left").na.fill(0, ["n_detected"])
    present, last, first = F.col("target") >= 0, F.col("next_name").isNull(), F.col("frame") == 0

    def holds(check: Column) -> Column:
        return F.bool_and(F.coalesce(check, F.lit(False)))

    def offsets(begin: str, then: str, size: str) -> Column:
        return holds((~first | (F.col(begin) == 0)) & (last | (F.col(then) == F.col(begin) + F.col(size))))

    a = f.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.sum("n_candidates").alias("candidates"), F.count_if(present).alias("targets"), F.min("frame").alias("low"), F.max("frame").alias("high"), F.count_if(~last).alias("followed"),
        holds(F.col("known") & (last | (F.col("frame_name") < F.col("next_name")))).alias("names"), F.bool_and(_finite(F.col("pts"))).alias("times"), holds(F.col("n_candidates") == F.col("n_detected")).alias("counts"),
        offsets("candidate_offset", "next_candidate", "n_detected").alias("offsets"), F.max(F.when(last, F.col("candidate_offset") + F.col("n_detected"))).alias("end"), holds(~present | (F.col("target") < F.col("n_candidates"))).alias("bounds"),
        holds(~(present & (F.col("ambiguous") | F.col("missing")))).alias("unforced"), holds(~present | (F.col("status") == "TARGET")).alias("accepted"), holds(F.col("n_others") == F.col("n_candidates") - present.cast("int")).alias("background"),
        offsets("other_offset", "next_other", "n_others").alias("other_offsets"), F.max(F.when(last, F.col("other_offset") + F.col("n_others"))).alias("other_end"),
    )
    which = [*at, "candidate"]
    one = detected.select(*which, F.struct("box").alias("__box"), F.struct("score").alias("__score"))
    two = kept.select(*which, F.struct("box").alias("__kept_box"), F.struct("score").alias("__kept_score"))
    lost = one.join(two, which, "full").groupBy(*keys).agg(F.bool_and(F.col("__box").eqNullSafe(F.col("__kept_box"))).alias("boxes"), F.bool_and(F.col("__score").eqNullSafe(F.col("__kept_score"))).alias("scores"))
    total = seen.groupBy(*keys).agg(F.sum("n_detected").alias("n_detected"))
    listed = others.groupBy(*keys).agg(F.count("*").alias("n_listed"))
    sources = source.groupBy(*keys).agg(F.count("*").alias("n_source"))
    j = a.join(sources, keys, "full")
    j = reduce(lambda x, y: x.join(y, keys, "left"), [lost, total, listed], j).na.fill(0, ["n_detected", "n_listed", "n_source", "frames", "candidates", "targets"])
    whole = F.col("frames") == F.col("n_source")
    # without any candidate there is nothing to lose
    errors = failed_checks(
        frame_count_matches_source=whole, frame_index_matches_source=whole & (F.col("low") == 0) & (F.col("high") == F.col("frames") - 1) & (F.col("followed") == F.col("frames") - 1),
        frame_name_matches_source=whole & F.col("names"), timestamps_finite=whole & F.col("times"), candidate_counts_match_detector=F.col("counts"), candidate_offsets_match_detector=F.col("offsets") & (F.col("end") == F.col("n_detected")),
        candidate_boxes_lossless=F.coalesce("boxes", F.lit(True)), candidate_scores_lossless=F.coalesce("scores", F.lit(True)), target_indices_in_bounds=F.col("bounds"), no_forced_abstention=F.col("unforced"),
        accepted_status_is_target=F.col("accepted"), background_counts_consistent=F.col("background"), background_offsets_consistent=F.col("other_offsets") & (F.col("other_end") == F.col("n_listed")),
    )
    return j.select(*keys, "frames", "candidates", "targets", errors.alias("errors"), F.when(errors == "", "PASS").otherwise("FAIL").alias("status"))


def _product(a: Column, b: Column) -> Column:
    """4x4 matrices of 16 numbers by row."""
    return F.array(*[reduce(lambda x, y: x + y, [a[4 * i + n] * b[4 * n + j] for n in range(4)]) for i in range(4) for j in range(4)])


def _off_identity(m: Column, size: int, width: int) -> Column:
    return F.greatest(*[F.abs(m[width * i + j] - (1.0 if i == j else 0.0)) for i in range(size) for j in range(size)])


def rigid_errors(pose: Column, inverse: Column) -> dict[str, Column]:
    """Of a 4x4 pose and what is given as its inverse: inverse_error and orthogonality_error (largest deviation from the
    identity), determinant of the rotation, gauge_error (of the pose itself from the identity), finite."""
    r = [[pose[4 * i + j] for j in range(3)] for i in range(3)]
    gram = F.array(*[r[i][0] * r[j][0] + r[i][1] * r[j][1] + r[i][2] * r[j][2] for i in range(3) for j in range(3)])
    det = r[0][0] * (r[1][1] * r[2][2] - r[1][2] * r[2][1]) - r[0][1] * (r[1][0] * r[2][2] - r[1][2] * r[2][0]) + r[0][2] * (r[1][0] * r[2][1] - r[1][1] * r[2][0])
    finite = F.forall(pose, _finite) & F.forall(inverse, _finite) & (F.size(pose) == 16) & (F.size(inverse) == 16)
    return {"inverse_error": _off_identity(_product(pose, inverse), 4, 4), "orthogonality_error": _off_identity(gram, 3, 3), "determinant": det, "gauge_error": _off_identity(pose, 4, 4), "finite": finite}


def inventory_totals(rows: DataFrame, by: str) -> DataFrame:
    """scope, overall and the totals of an inventory: a row for each value of `by`, and one over all (overall is true, scope
    null), which is there, with zeros, for an empty inventory too.

    rows: by, exists, file_count, logical_bytes, transient, symlinks, errors (an array; null counts as empty)."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = ["path_count", "existing", "file_count", "logical_bytes", "transient", "symlinks", "scan_errors"]
    each = rows.groupBy(F.col(by).alias("scope")).agg(
        F.count("*").alias("path_count"), F.count_if("exists").alias("existing"), n("file_count").alias("file_count"), n("logical_bytes").alias("logical_bytes"), n("transient").alias("transient"), n("symlinks").alias("symlinks"),
        n(F.greatest(F.size("errors"), F.lit(0))).alias("scan_errors"),
    )
    whole = each.agg(*[n(c).alias(c) for c in sums]).select(F.lit(None).cast(rows.schema[by].dataType).alias("scope"), F.lit(True).alias("overall"), *sums)
    return each.select("scope", F.lit(False).alias("overall"), *sums).unionByName(whole).withColumn("gib", F.col("logical_bytes") / 1024**3)


def telemetry(rows: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """by, sample_count and for each measure its mean, p90, p95 (linear) and max over the samples that have one; null
    where none has. The percentiles are exact and keep a group's distinct values."""
    p = {m: F.percentile(m, F.array(F.lit(0.9), F.lit(0.95))) for m in measures}
    out = rows.groupBy(*by).agg(F.count("*").alias("sample_count"), *[x for m in measures for x in (F.avg(m).alias(f"{m}_mean"), p[m][0].alias(f"{m}_p90"), p[m][1].alias(f"{m}_p95"), F.max(m).alias(f"{m}_max"))])
    return out


def output_totals(documents: DataFrame, stage: str) -> DataFrame:
    """One row over all outputs of a stage, whenever they were written: sequences, frames, passed, review, failed and the
    status. documents: stage, sequence, status, frame_count; those of other stages, of unknown status or without a
    number of frames don't count. Without outputs the status is PASS and all numbers are 0."""
    ours = documents.where((F.col("stage") == stage) & F.col("status").isin("PASS", "REVIEW", "FAIL") & F.col("sequence").isNotNull() & F.col("frame_count").isNotNull())
    n = lambda s: F.count_if(F.col("status") == s)
    return ours.agg(F.count("*").alias("sequences"), F.coalesce(F.sum("frame_count"), F.lit(0)).cast("long").alias("frames"), n("PASS").alias("passed"), n("REVIEW").alias("review"), n("FAIL").alias("failed"), F.when(n("FAIL") > 0, "FAIL").otherwise("PASS").alias("status"))


def stage_faults(keys: list[str], base: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """keys, reasons (sorted and joined by commas), status: every stage's frames against the base's.

    base: keys, frame, pts. A stage: keys, frame, pts, value, valid, accepted, target_valid. For each stage the reasons are
    <stage>:frame_count, :frame_index (a frame that one side lacks), :pts (other than the base's, null and NaN aside),
    :finite (a valid value that isn't finite, or an invalid one that isn't NaN or null) and :forced (accepted where the
    target isn't valid; null counts as false). A stage without rows for a sequence has :missing alone. Rows are expected
    once for each frame; sequences that only a stage has aren't reported.
    """
    out = base.select(*keys).distinct()
    names = []
    for stage, df in stages.items():
        a = base.select(*keys, "frame", F.col("pts").alias("__base_pts"), F.lit(1).alias("__base"))
        b = df.select(*keys, "frame", *[F.col(c).alias(f"__{c}") for c in ("pts", "value", "valid", "accepted", "target_valid")], F.lit(1).alias("__stage"))
        both = F.col("__base").isNotNull() & F.col("__stage").isNotNull()
        yes = lambda c: F.coalesce(F.col(c), F.lit(False))
        there = F.col("__stage").isNotNull()
        empty = F.col("__value").isNull() | F.isnan("__value")
        g = a.join(b, [*keys, "frame"], "full").groupBy(*keys).agg(
            (F.count("__stage") == 0).alias("missing"), (F.count("__base") != F.count("__stage")).alias("frame_count"), F.bool_or(~both).alias("frame_index"), F.bool_or(both & ~F.col("__pts").eqNullSafe(F.col("__base_pts"))).alias("pts"),
            F.bool_or(there & F.when(yes("__valid"), ~_finite(F.col("__value"))).otherwise(~empty)).alias("finite"), F.bool_or(there & yes("__accepted") & ~yes("__target_valid")).alias("forced"),
        )
        tests = [F.when(F.col("missing"), F.lit(f"{stage}:missing")), *[F.when(~F.col("missing") & F.col(c), F.lit(f"{stage}:{c}")) for c in ("frame_count", "frame_index", "pts", "finite", "forced")]]
        out = out.join(g.select(*keys, F.array_compact(F.array(*tests)).alias(f"__of_{stage}")), keys, "left")
        names.append(F.col(f"__of_{stage}"))
    reasons = F.array_join(F.array_sort(F.concat(*names)), ",")
    return out.select(*keys, reasons.alias("reasons"), F.when(reasons == "", "PASS").otherwise("FAIL").alias("status"))
