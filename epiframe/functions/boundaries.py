"""Scalar functions on boundaries, frames and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def half_up_mean(a, b) -> Column:
    """The mean of two whole numbers, halves up."""
    return F.floor((_col(a) + _col(b) + 1) / 2).cast("long")


def agreed_boundary(a, b, tolerance) -> Column:
    """The mean of two estimates that are at most tolerance apart, else null."""
    return F.when(F.abs(_col(a) - _col(b)) <= _col(tolerance), half_up_mean(a, b))


def segment_at(frame, start, boundaries, count) -> Column:
    """The sub-task of a frame: start and one more for each boundary at or before it, count - 1 at most."""
    passed = F.size(F.filter(_col(boundaries), lambda b: b <= _col(frame)))
    return F.least(_col(count) - 1, _col(start) + passed)


def frame_from_time(seconds, fps, n) -> Column:
    """The nearest frame to a time (halves up), within the episode."""
    f = F.floor(_col(seconds) * _col(fps) + 0.5).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(_col(n) - 1, f))


def frame_from_pointer(x, left, width, n) -> Column:
    """The frame under a pointer on a time line of the given place and width."""
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (_col(x) - _col(left)) / _col(width)))
    return F.when(_col(width) > 0, F.floor(part * (_col(n) - 1) + 0.5).cast("long")).otherwise(F.lit(0).cast("long"))


def insert_boundary(boundaries, frame, n) -> Column:
    """The sorted set with the frame; a frame that can't be a boundary changes nothing."""
    b, f = _col(boundaries), _col(frame)
    return F.when((f > 0) & (f < _col(n)), F.array_sort(F.array_union(b, F.array(f)))).otherwise(b)


def remove_nearest_boundary(boundaries, frame) -> Column:
    """The boundaries without the one nearest to the frame, the first of equals."""
    b, f = _col(boundaries), _col(frame)
    nearest = F.array_min(F.transform(b, lambda x, i: F.struct(F.abs(x - f).alias("d"), i.alias("i"))))
    return F.filter(b, lambda x, i: i != nearest["i"])


def needs_frame_correction(now, wanted, fps) -> Column:
    return F.abs(_col(now) - _col(wanted)) >= 0.5 / _col(fps)


def timestamp_seconds(frame, fps) -> Column:
    return _col(frame) / _col(fps)


def episode_chunk(episode, chunk_size) -> Column:
    return F.floor(_col(episode) / _col(chunk_size)).cast("long")


def segment_lengths(boundaries, length) -> Column:
    """The lengths of the segments between 0, the boundaries and the episode's end."""
    b = _col(boundaries).cast("array<bigint>")
    edges = F.concat(F.array(F.lit(0).cast("long")), b, F.array(_col(length).cast("long")))
    return F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, c: c - a)
