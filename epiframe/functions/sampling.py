"""Frame sampling grids as array columns. Halves round to even, as the data sets' own grids do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def _int(x: Column) -> Column:
    return F.rint(x).cast("long")


def uniform_count(n, source_fps, target_fps, cap) -> Column:
    """How many frames a uniform grid has: two at least, n or cap at most."""
    n, cap = _col(n).cast("long"), _col(cap).cast("long")
    wanted = _int((n - 1) / _col(source_fps) * _col(target_fps)) + 1
    return F.least(n, cap, F.greatest(F.lit(2).cast("long"), wanted))


def uniform_indices(n, source_fps, target_fps, cap) -> Column:
    """Evenly spaced frames of 0 to n-1, both ends included; null where a cap of 1 can't hold both ends, or n is no positive number."""
    n = _col(n).cast("long")
    k = uniform_count(n, source_fps, target_fps, cap)
    grid = F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda p: _int(p * (n - 1) / (k - 1)))
    return F.when(n == 1, F.array(F.lit(0).cast("long"))).when((n > 1) & (k > 1), grid)


def minimum_distinct_interior(n, k) -> Column:
    """How many frames of its own the second pass must have."""
    n, k = _col(n).cast("long"), _col(k).cast("long")
    inner = F.least(F.greatest(k - 2, F.lit(0)), F.greatest(n - k, F.lit(0)))
    return F.floor((inner + 1) / 2)


def shifted_indices(n, source_fps, target_fps, cap) -> Column:
    """The second pass: the same ends and count, its inside half a step on, strictly increasing; the
    first pass again if that has no inside, or all frames.

    The i-th value is i plus the running greatest of ideal - i, held within 0 and n - k. Where a grid
    of 3 of 4 frames would repeat the first pass, it takes the inside frame that is left.
    """
    n = _col(n).cast("long")
    k = uniform_count(n, source_fps, target_fps, cap)
    room = n - k

    def ideal(p):
        return F.when(p == 0, 0).when(p == k - 1, n - 1).otherwise(_int((p + 0.5) * (n - 1) / (k - 1)))

    slack = F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda p: ideal(p) - p)
    empty = F.array().cast("array<bigint>")
    run = F.aggregate(slack, empty, lambda acc, d: F.concat(acc, F.array(F.greatest(d, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long"))))))
    grid = F.transform(run, lambda d, i: F.least(room, F.greatest(F.lit(0).cast("long"), d)) + i)
    first = uniform_indices(n, source_fps, target_fps, cap)
    other = F.filter(F.sequence(F.lit(1).cast("long"), n - 2), lambda x: ~F.array_contains(first, x))
    repaired = F.when((n == 4) & (k == 3), F.array(F.lit(0).cast("long"), F.get(other, 0), n - 1)).otherwise(grid)
    return F.when((k <= 2) | (k == n), first).when((n > 1) & (k > 1), repaired)


def window_indices(center, radius, stride, n) -> Column:
    """Every stride-th frame from center - radius to center + radius, within 0 and n-1, and the center."""
    c, r, n = _col(center).cast("long"), _col(radius).cast("long"), _col(n).cast("long")
    low, high = F.greatest(c - r, F.lit(0).cast("long")), F.least(c + r, n - 1)
    return F.array_sort(F.array_union(F.sequence(low, high, _col(stride).cast("long")), F.array(c)))


def evidence_indices(center, radius, stride, n) -> Column:
    """window_indices and both ends of the window."""
    c, r, n = _col(center).cast("long"), _col(radius).cast("long"), _col(n).cast("long")
    low, high = F.greatest(c - r, F.lit(0).cast("long")), F.least(c + r, n - 1)
    return F.array_sort(F.array_union(window_indices(c, r, stride, n), F.array(low, high)))


def window_parameters(fps, window_seconds=2.5, refine_fps=8.0, dense_seconds=0.5) -> Column:
    """The broad radius and stride and the dense radius, in frames."""
    f = _col(fps)
    return F.struct(
        _int(f * window_seconds).alias("radius"),
        F.greatest(F.lit(1).cast("long"), _int(f / refine_fps)).alias("stride"),
        _int(f * dense_seconds).alias("dense_radius"),
    )


def independent(first, second, n) -> Column:
    """Whether the second grid has the distinct frames that it must have."""
    a, b = _col(first), _col(second)
    return F.size(F.array_except(b, a)) >= minimum_distinct_interior(n, F.size(a))


def camera_order(primary, others) -> Column:
    return F.array_distinct(F.concat(F.array(_col(primary)), _col(others)))


def fps_matches(a, b, tolerance: float = 0.01) -> Column:
    def sound(x):
        return x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf"))

    a, b = _col(a), _col(b)
    return sound(a) & sound(b) & (F.abs(a - b) <= tolerance)
