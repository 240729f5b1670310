"""Annotation rules as columns: arrays of issue codes in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .boundaries import _col, segment_lengths

# Reasons for review in their canonical orders.
COARSE_REASONS = ["coarse_sequence_disagreement", "illegal_coarse_sequence", "coarse_boundary_count", "coarse_boundary_order", "coarse_uncertain"]
REFINE_REASONS = [
    "refine_boundary_disagreement",
    "refine_transition_mismatch",
    "camera_evidence_conflict",
    "start_subtask_range",
    "complete_start_index",
    "complete_boundary_count",
    "dagger_suffix_length",
    "boundary_order",
    "boundary_range",
    "segment_too_short",
    "model_oom",
]
ISSUES = ["start_subtask_range", "complete_start_index", "complete_boundary_count", "boundary_order", "boundary_range", "segment_too_short", "dagger_suffix_length"]
#: Reasons that reject an episode whatever else is known of it.
REJECTING = [*ISSUES, "invalid_model_response", "illegal_coarse_sequence", "coarse_boundary_count", "coarse_boundary_order", "refine_transition_mismatch"]


def _adjacent(b: Column, test) -> Column:
    """Whether test holds for any two neighbours."""
    n = F.size(b)
    pairs = F.zip_with(F.slice(b, 1, F.greatest(n - 1, F.lit(0))), F.slice(b, 2, F.greatest(n - 1, F.lit(0))), test)
    return (n > 1) & F.exists(pairs, lambda x: x)


def increasing(b) -> Column:
    return ~_adjacent(_col(b), lambda x, y: x >= y)


def validate_annotation(start, boundaries, length, subtasks, mode, min_segment=8) -> Column:
    """The codes of all rules that an annotation breaks, in the order of ISSUES; mode is complete or dagger_patch."""
    s, b, n, k, mode = _col(start), _col(boundaries), _col(length), _col(subtasks), _col(mode)
    complete = mode == "complete"
    checks = [
        (s >= k, "start_subtask_range"),
        (complete & (s != 0), "complete_start_index"),
        (complete & (F.size(b) != k - 1), "complete_boundary_count"),
        (_adjacent(b, lambda x, y: x >= y), "boundary_order"),
        (F.exists(b, lambda x: (x <= 0) | (x >= n)), "boundary_range"),
        (F.exists(segment_lengths(b, n), lambda x: x < _col(min_segment)), "segment_too_short"),
        (~complete & (s < k) & (F.size(b) != 0) & (F.size(b) != k - s - 1), "dagger_suffix_length"),
    ]
    return F.array_compact(F.array(*(F.when(test, F.lit(code)) for test, code in checks)))


def coarse_sequence_legal(observed, subtasks, mode) -> Column:
    """complete: all sub-tasks in order; dagger_patch: one, or all from one on."""
    o, k = _col(observed).cast("array<int>"), _col(subtasks).cast("int")
    n, first = F.size(o), F.get(o, 0)
    inside = (n > 0) & (first >= 0) & (first < k)
    run = o == F.sequence(first, first + n - 1)
    complete = inside & run & (first == 0) & (n == k)
    patch = inside & run & ((n == 1) | (first + n == k))
    return F.coalesce(F.when(n == 0, False).when(_col(mode) == "complete", complete).otherwise(patch), F.lit(False))


def in_order(found, order: list[str]) -> Column:
    """The reasons found, without repetition, in canonical order."""
    f = _col(found)
    return F.filter(F.array(*map(F.lit, order)), lambda r: F.array_contains(f, r))


def coarse_reasons(first, second, subtasks, mode) -> Column:
    """Why two passes, each struct<observed, boundaries: array<bigint>, uncertain>, do not make a decision."""
    a, b = _col(first), _col(second)
    illegal = ~coarse_sequence_legal(a["observed"], subtasks, mode) | ~coarse_sequence_legal(b["observed"], subtasks, mode)
    counts = (F.size(a["boundaries"]) != F.size(a["observed"]) - 1) | (F.size(b["boundaries"]) != F.size(b["observed"]) - 1)
    order = ~increasing(a["boundaries"]) | ~increasing(b["boundaries"])
    found = [
        (a["observed"] != b["observed"], "coarse_sequence_disagreement"),
        (illegal, "illegal_coarse_sequence"),
        (counts, "coarse_boundary_count"),
        (order, "coarse_boundary_order"),
        (a["uncertain"] | b["uncertain"], "coarse_uncertain"),
    ]
    return F.array_compact(F.array(*(F.when(test, F.lit(code)) for test, code in found)))


def rejected(issues, reasons, failure) -> Column:
    """Whether deterministic rules alone reject the episode."""
    return F.coalesce((F.size(_col(issues)) > 0) | F.arrays_overlap(_col(reasons), F.array(*map(F.lit, REJECTING))) | (_col(failure) == "invalid_model_response"), F.lit(False))


def dagger_violates(kind, start, boundaries, expected_start, expected_boundaries, length, min_segment) -> Column:
    """Whether a prediction on a view breaks a rule: start, count, a boundary in a singleton, order, range, or a short segment. No prediction does."""
    s, b, e, n = _col(start), _col(boundaries), _col(expected_boundaries), _col(length)
    single = (_col(kind) == "singleton") & (F.size(b) > 0)
    outside = F.exists(b, lambda x: (x <= 0) | (x >= n))
    short = F.exists(segment_lengths(b, n), lambda x: x < _col(min_segment))
    return s.isNull() | b.isNull() | F.coalesce((s != _col(expected_start)) | (F.size(b) != F.size(e)) | single | ~increasing(b) | outside | short, F.lit(False))


def refine_matches(result, left, right, length) -> Column:
    """Whether a refine result is about the asked pair, adjacent at its boundary and inside the episode."""
    r = _col(result)
    return (r["from_subtask"] == _col(left)) & (r["to_subtask"] == _col(right)) & (r["first_frame"] == r["boundary"]) & (r["last_frame"] + 1 == r["first_frame"]) & (r["boundary"] > 0) & (r["boundary"] < _col(length))
