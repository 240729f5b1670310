"""Replays of stored decisions: what a record says of its sampling and answers must give what it says of its outcome.

A replay is a fold over an episode's few answers, so it runs in the tasks, a record at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..config import Config
from ..functions.rules import COARSE_REASONS, REFINE_REASONS
from ..plans.annotate import annotation_issues, evidence, legal, shifted, uniform


def replay_coarse(config: Config, n: int, fps: float, c: dict) -> list[str]:
    """What contradicts in a coarse decision: grids, reasons, centers or status."""
    s, k, out = config.sampling, len(config.subtasks), []
    if c["grids"] != [g(n, fps, s.coarse_fps, s.coarse_max_frames) for g in (uniform, shifted)]:
        out.append("coarse_grids")
    one, two = c["attempts"]
    tests = {
        "coarse_sequence_disagreement": one["observed"] != two["observed"],
        "illegal_coarse_sequence": not all(legal(x["observed"], k, config.mode) for x in (one, two)),
        "coarse_boundary_count": any(len(x["boundaries"]) != len(x["observed"]) - 1 for x in (one, two)),
        "coarse_boundary_order": any(not 1 <= b < n for x in (one, two) for b in x["boundaries"]),
        "coarse_uncertain": one["uncertain"] or two["uncertain"],
    }
    reasons = [r for r in COARSE_REASONS if tests[r]]
    if reasons != c["reasons"]:
        out.append("coarse_reasons")
    centers = [] if reasons else [(a + b + 1) // 2 for a, b in zip(one["boundaries"], two["boundaries"], strict=True)]
    if centers != c["centers"]:
        out.append("coarse_centers")
    if (c["status"] == "needs_review") != bool(reasons):
        out.append("coarse_status")
    return out


def replay_refine(config: Config, n: int, fps: float, coarse: dict, r: dict) -> list[str]:
    """What contradicts in a refine decision: the order of stages, their sampling, degradation, boundaries or reasons."""
    s = config.sampling
    cameras = list(dict.fromkeys([config.primary_camera, *config.refine_cameras]))
    radius, stride, dense = round(s.refine_window_seconds * fps), max(1, round(fps / s.refine_fps)), round(s.dense_radius_seconds * fps)
    start, agreed, found, out, degraded = coarse["observed"][0], [], set(), [], False
    steps = iter(r["provenance"])

    def step(i: int, stage: str, center: int, width: int, apart: int, pass_id: int) -> dict | None:
        x = next(steps, None)
        if x is None:
            out.append("stage_missing")
            return None
        want = {"boundary": i, "stage": stage, "center": center, "radius": width, "stride": apart, "cameras": cameras[:1] if degraded else cameras, "frames": evidence(center, width, apart, n), "pass_id": pass_id}
        out.extend(f"provenance_{k}" for k, v in want.items() if x[k] != v)
        return x

    def fits(a: dict, i: int) -> bool:
        return (a["from_subtask"], a["to_subtask"]) == (start + i, start + i + 1) and a["last_frame"] + 1 == a["first_frame"] == a["boundary"] and 0 < a["boundary"] < n

    failed = False
    for i, center in enumerate(coarse["centers"]):
        broad = step(i, "broad", center, radius, stride * 2 if degraded else stride, 3 * i)
        if broad and broad["outcome"] == "model_oom" and not degraded and len(cameras) > 1:
            degraded = True
            broad = step(i, "broad_retry", center, radius, stride * 2, 3 * i + 1)
        if not broad or broad["outcome"] == "model_oom":
            failed = True
            break
        at = broad["answer"]["boundary"]
        if not 1 <= at < n:
            found.add("refine_transition_mismatch")
            break
        close = step(i, "dense", at, dense, 1, 3 * i + 2)
        if not close or close["outcome"] == "model_oom":
            failed = True
            break
        a, b = broad["answer"], close["answer"]
        if not fits(a, i) or not fits(b, i):
            found.add("refine_transition_mismatch")
        elif abs(a["boundary"] - b["boundary"]) > s.agreement_tolerance_frames:
            found.add("refine_boundary_disagreement")
        else:
            agreed.append((a["boundary"] + b["boundary"] + 1) // 2)
    if next(steps, None) is not None:
        out.append("stage_extra")
    whole = not failed and len(agreed) == len(coarse["centers"])
    if failed:
        found.add("model_oom")
    if whole:
        found |= set(annotation_issues(start, agreed, n, len(config.subtasks), config.mode, s.min_segment_frames))
    if r["reasons"] != [x for x in REFINE_REASONS if x in found]:
        out.append("refine_reasons")
    if r["boundaries"] != (agreed if whole else None):
        out.append("refine_boundaries")
    if r["status"] != ("failed" if failed else "needs_review" if found else "accepted"):
        out.append("refine_status")
    return list(dict.fromkeys(out))


def audit_record(config: Config, n: int, fps: float, details: str) -> list[str]:
    try:
        d = json.loads(details or "{}")
        if not isinstance(d, dict):
            raise TypeError
        if "coarse" not in d:
            return []
        out = replay_coarse(config, n, fps, d["coarse"])
        return out + (replay_refine(config, n, fps, d["coarse"], d["refine"]) if "refine" in d else [])
    except (KeyError, TypeError, ValueError, IndexError) as e:
        return [f"unreadable_{type(e).__name__}"]


def audit(records: DataFrame, config: Config, fps: float) -> DataFrame:
    """(episode_index, issues) of records (episode_index, length, sampling_details) whose replay contradicts them."""
    one = audit_record

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(int(e), one(config, int(n), fps, d)) for e, n, d in zip(p.episode_index, p.length, p.sampling_details, strict=True)]
            yield pd.DataFrame([r for r in rows if r[1]], columns=["episode_index", "issues"])

    return records.select("episode_index", "length", "sampling_details").mapInPandas(run, "episode_index long, issues array<string>")
