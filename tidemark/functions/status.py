"""Status lattice, reason lists, gates and decision ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANK = {"PASS": 0, "REVIEW": 1, "FAIL": 2, "INCOMPLETE": 3}


def family(status: Column) -> Column:
    """PASS, REVIEW, FAIL (NO_GO too), INCOMPLETE by prefix; anything else is UNKNOWN."""
    s = F.upper(status)
    return (
        F.when(s.startswith("PASS"), "PASS").when(s.startswith("REVIEW"), "REVIEW").when(s.startswith("FAIL") | s.startswith("NO_GO"), "FAIL").when(s.startswith("INCOMPLETE"), "INCOMPLETE").otherwise("UNKNOWN")
    )


def worst_of(statuses: Column) -> Column:
    """The worst status of an array."""
    rank = F.transform(statuses, lambda s: F.array_position(F.array(*[F.lit(k) for k in RANK]), s))
    return F.element_at(F.array(*[F.lit(k) for k in RANK]), F.array_max(rank).cast("int"))


def reasons(*tests: tuple[str, Column]) -> Column:
    """The names of the tests that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests]))


def bitmask(*tests: Column) -> Column:
    """Bit i is set where test i holds."""
    total = F.lit(0).cast("long")
    for i, c in enumerate(tests):
        total = total + F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return total


def gate(fails: Column, reviews: Column) -> Column:
    return F.when(F.size(fails) > 0, "FAIL").when(F.size(reviews) > 0, "REVIEW").otherwise("PASS")


def consistency(median: Column, p90: Column, acceptance: Column, scale: Column) -> Column:
    """Residuals against a declared scale, and the camera's acceptance (PASS, FAIL or anything else): a failed camera,
    nothing measured, over 2x or over 10x is no-go; an accepted camera within 1x and 3x passes; the rest is reviewed."""
    bad = (F.coalesce(acceptance, F.lit("")) == "FAIL") | median.isNull() | p90.isNull() | (median > 2 * scale) | (p90 > 10 * scale)
    good = (F.coalesce(acceptance, F.lit("")) == "PASS") & (median <= scale) & (p90 <= 3 * scale)
    return F.when(bad, "NO_GO_TRIANGULATION").when(good, "PASS").otherwise("REVIEW_POSE_CAMERA_CONSISTENCY")


def confidence_level(value: Column) -> Column:
    return F.when(value >= 0.75, "HIGH").when(value >= 0.45, "MEDIUM").otherwise("LOW")


def ramp(value: Column, low: float, high: float) -> Column:
    """0 at low, 1 at high, clipped."""
    return F.least(F.greatest((value - low) / (high - low), F.lit(0.0)), F.lit(1.0))


def recovery_action(alive: Column, complete: Column, misses: Column, needed: int, valid: Column, restarts: Column, most: int) -> Column:
    return (
        F.when(complete, "COMPLETE").when(alive > 1, "AMBIGUOUS").when(alive == 1, "HEALTHY").when(misses < needed, "CONFIRMING").when(~valid, "INVALID_COMMAND").when(restarts >= most, "RESTART_LIMIT").otherwise("RESTART")
    )


def set_action(ready: Column, best: Column, least_increment: int = 1) -> Column:
    """EXPORT where ready strictly contains best with enough more, ATTENTION where something of best is gone, else WAIT."""
    gone, more = F.size(F.array_except(best, ready)), F.size(F.array_except(ready, best))
    return F.when(gone > 0, "ATTENTION").when(more >= least_increment, "EXPORT").otherwise("WAIT")
