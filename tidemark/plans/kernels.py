"""Queries of the NumPy kernels: grouped Arrow maps over groups of bounded size. Tests hold them against plain versions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import kernels as K
from tidemark.plans.registry import query
from tidemark.tables import load

DAY_US = 86_400_000_000
#: Scenes that are adjusted together; some 10 MB.
SCENES = 256


def _daily(spark, d) -> DataFrame:
    e = load(spark, d, "events").select("user_id", "event_type", "value", F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div {DAY_US}").alias("day"))
    return e.groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"), F.sum("value").alias("v"))


def cameras() -> np.ndarray:
    """Three cameras a unit apart: projections K [R | t]."""
    k = np.array([[1000.0, 0, 320], [0, 1000, 240], [0, 0, 1]])
    return np.array([k @ np.hstack([np.eye(3), np.array([[-x], [0.0], [0.0]])]) for x in (0.0, 1.0, 2.0)])


@query("AG-21", "SRC-03")
def triangulate_points(spark: SparkSession, d: str) -> DataFrame:
    """Joints of each vector seen by three cameras (with an error in the third) and triangulated again."""
    views = cameras()

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            truth = np.stack(pdf["embedding"].to_numpy()).astype(float)[:, :63].reshape(-1, 3) + [0, 0, 5]
            joint = np.tile(np.arange(21), len(pdf))
            q = np.einsum("vij,nj->nvi", views[:, :, :3], truth) + views[:, :, 3]
            xy = q[:, :, :2] / q[:, :, 2:]
            xy[joint % 5 == 0, 2] += 40
            p, support, residual = K.triangulate_many(views, xy, np.broadcast_to([0.9, 0.8, 0.7], xy.shape[:2]))
            out = pd.DataFrame({"vec_id": np.repeat(pdf["vec_id"].to_numpy(), 21), "joint": joint.astype(np.int32), "support": support.astype(np.int32)})
            yield out.assign(x=p[:, 0], y=p[:, 1], z=p[:, 2], residual=np.nanmedian(residual, axis=1), error=np.linalg.norm(p - truth, axis=1))

    return load(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, joint int, support int, x double, y double, z double, residual double, error double")


@query("AG-19", "AG-20")
def similarity_fits(spark: SparkSession, d: str) -> DataFrame:
    """Each vector's joints carried onto the mean pose of its label by a robust similarity; plain and aligned errors."""
    e = load(spark, d, "embeddings")
    mean = e.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("mean"))

    def run(batches):
        for pdf in batches:
            rows = []
            for vec, a, b in zip(pdf["vec_id"], pdf["embedding"], pdf["mean"]):
                p, t = np.asarray(a, float)[:63].reshape(21, 3), np.asarray(b, float)[:63].reshape(21, 3)
                scale, r, s = K.similarity(p, t)
                error = np.linalg.norm(scale * p @ r.T + s - t, axis=1)
                rows.append((vec, scale, float(np.linalg.det(r)), float(np.median(error)), *K.pose_errors(p, t, np.ones(21, bool), 0)))
            yield pd.DataFrame(rows, columns=["vec_id", "scale", "det", "median_error", "mpjpe", "n_mpjpe", "pa_mpjpe"])

    return e.join(mean, "label").select("vec_id", "embedding", "mean").mapInPandas(run, "vec_id long, scale double, det double, median_error double, mpjpe double, n_mpjpe double, pa_mpjpe double")


@query("AG-18")
def pose_means(spark: SparkSession, d: str) -> DataFrame:
    """Robust mean rotation of eight samples of each vector, with the class of each sample."""

    def run(batches):
        for pdf in batches:
            rows = []
            for vec, e in zip(pdf["vec_id"], pdf["embedding"]):
                samples = []
                for v in np.asarray(e, float).reshape(8, 8)[:, :3] * 0.1:
                    a = np.linalg.norm(v) + 1e-12
                    k = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]]) / a
                    samples.append(np.eye(3) + np.sin(a) * k + (1 - np.cos(a)) * k @ k)
                mean, angles = K.mean_rotation(np.array(samples))
                limit = max(3 * float(np.median(angles)), 1e-6)
                rows.append((vec, float(np.trace(mean)), float(np.linalg.det(mean)), int((angles <= limit / 1.5).sum()), int((angles > limit).sum())))
            yield pd.DataFrame(rows, columns=["vec_id", "trace", "det", "good", "rejected"])

    return load(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, trace double, det double, good int, rejected int")


@query("JN-13")
def assignments(spark: SparkSession, d: str) -> DataFrame:
    """Event types of each user assigned one-to-one to weeks by the least total cost."""
    daily = _daily(spark, d).groupBy("user_id", "event_type", F.expr("day div 7").alias("week")).agg(F.sum("n").alias("n"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index="event_type", columns="week", values="n").fillna(0).sort_index()
        pairs = K.assignment(-wide.to_numpy(float))
        return pd.DataFrame([(int(pdf["user_id"].iloc[0]), wide.index[r], int(wide.columns[c]), int(wide.iat[r, c])) for r, c in pairs], columns=["user_id", "event_type", "week", "n"])

    return K.grouped(daily, ["user_id"], solve, "user_id long, event_type string, week int, n long")


def _frames(e) -> list[list[np.ndarray]]:
    """Eight frames of two boxes."""
    b = np.asarray(e, float).reshape(16, 4)
    b = np.concatenate([np.minimum(b[:, :2], b[:, 2:]), np.maximum(b[:, :2], b[:, 2:])], axis=1)
    return [[b[2 * f], b[2 * f + 1]] for f in range(8)]


@query("WN-10", "WN-09", "STM-16")
def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of each vector tracked both ways, and the chain of first boxes gated; a bad row would carry its error."""

    def run(batches):
        for pdf in batches:
            rows = []
            for vec, e in zip(pdf["vec_id"], pdf["embedding"]):
                try:
                    frames = _frames(e)
                    ahead, back = K.track(frames), K.track(frames, reverse=True)
                    gate = K.identity_gate([f[0] for f in frames])
                    rows.append((vec, len(ahead), len(back), max(map(len, ahead)), sum(gate), None))
                except ValueError as x:
                    rows.append((vec, None, None, None, None, str(x)))
            yield pd.DataFrame(rows, columns=["vec_id", "forward", "backward", "longest", "rejected", "error"])

    return load(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, forward int, backward int, longest int, rejected int, error string")


@query("WN-06", "SO-03", "SO-04")
def smoothed_series(spark: SparkSession, d: str) -> DataFrame:
    """Daily series of each user and type smoothed, its separated peaks, and clips around its larger days in a budget."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = np.full(31, np.nan)
        y[pdf["day"].to_numpy()] = pdf["v"].to_numpy()
        x = K.smooth(y, np.where(np.isfinite(y), 8.0, 0.0), 0.25)
        peaks = K.separated_extrema(x, 3, 4)
        filled = np.nan_to_num(y)
        clip = K.bounded_clips(filled > np.median(filled), filled, 1, 0.25)
        return pd.DataFrame([(int(pdf["user_id"].iloc[0]), pdf["event_type"].iloc[0], i, float(x[i]), i in peaks, bool(clip[i])) for i in range(31)], columns=["user_id", "event_type", "day", "smooth", "peak", "clip"])

    return K.grouped(_daily(spark, d), ["user_id", "event_type"], run, "user_id long, event_type string, day int, smooth double, peak boolean, clip boolean")


@query("FN-17", "JN-16")
def cross_correlations(spark: SparkSession, d: str) -> DataFrame:
    """Best lag of daily views against each other type of the user by FFT correlation, and the series' spectral flux."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index="day", columns="event_type", values="v").reindex(range(31)).fillna(0)
        rows = []
        for c in wide.columns:
            if "view" in wide.columns and c != "view":
                r = K.cross_correlation(wide["view"].to_numpy(), wide[c].to_numpy(), 6)
                rows.append((int(pdf["user_id"].iloc[0]), c, int(np.argmax(r)) - 6, float(r.max()), float(K.spectral_flux(wide[c].to_numpy(), 8, 4).max())))
        return pd.DataFrame(rows, columns=["user_id", "event_type", "lag", "r", "flux"])

    return K.grouped(_daily(spark, d), ["user_id"], run, "user_id long, event_type string, lag int, r double, flux double")




@query("GR-02", "CN-11")
def bundle_adjustment(spark: SparkSession, d: str) -> DataFrame:
    """Cameras and joints of each vector moved off and adjusted in two stages from their observations (some of them bad)."""
    k = np.broadcast_to(np.array([[1000.0, 0, 320], [0, 1000, 240], [0, 0, 1]]), (3, 3, 3))

    turns = np.array([K.rotation(np.array([0, 0.1 * c, 0])) for c in range(3)])
    shifts = np.array([[-0.5 * c, 0.0, 0.1 * c] for c in range(3)])
    moved = np.array([turns[0]] + [K.rotation(np.array([0.01, -0.02, 0.01]) * c) @ turns[c] for c in (1, 2)])
    shifted = shifts + 0.02 * np.arange(3)[:, None]

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), SCENES):
                part = pdf.iloc[at : at + SCENES]
                n = len(part)
                truth = np.stack(part["embedding"].to_numpy()).astype(float)[:, :63].reshape(n, 21, 3) + [0, 0, 5]
                x = truth[:, None] @ turns.transpose(0, 2, 1) + shifts[:, None]
                pixel = 1000 * x[..., :2] / x[..., 2:] + [320, 240]
                pixel.reshape(n, 63, 2)[:, ::17] += 60
                whole = lambda a: np.broadcast_to(a, (n, *a.shape))
                _, _, _, used, before, after, converged = K.two_stage_adjust_many(whole(moved), whole(shifted), truth + 0.02, k, pixel)
                rows = lambda a: a.reshape(n, 63)
                every = np.ones((n, 63), bool)
                yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "rejected": (~rows(used)).sum(axis=1), "before_px": K._medians(rows(before), every), "after_px": K._medians(rows(after), rows(used)), "converged": converged})

    vectors = load(spark, d, "embeddings").select("vec_id", "embedding")
    tasks = 4 * spark.sparkContext.defaultParallelism  # a number of its own: few bytes are much work, and adaptive execution would join them in a task
    return vectors.repartition(tasks, "vec_id").mapInPandas(run, "vec_id long, rejected int, before_px double, after_px double, converged boolean")
