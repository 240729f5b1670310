"""What several modules share of the data model: the stored record as DDL, statuses and their transitions, metrics."""

from __future__ import annotations

RECORD = (
    "episode_index long, status string, coarse_attempts array<struct<pass_id:int,observed:array<int>,uncertain:boolean>>, refine_attempts array<struct<boundary_index:int,stage:string,boundary:int,uncertain:boolean>>, "
    "final_annotation struct<start_subtask_index:int,boundaries:array<int>>, validation_issues array<struct<code:string,message:string>>, review_reasons array<string>, failure_category string, decision_source string, "
    "created_at timestamp, updated_at timestamp, source_fingerprint string, run_fingerprint string, prompt_version string, model_revision string, sampling_details string"
)

# Statuses of an episode, in order, and the transitions between them.
STATUSES = ["pending", "coarse_done", "refine_done", "accepted", "needs_review", "failed"]
EDGES = {
    "pending": ["coarse_done", "needs_review", "failed"],
    "coarse_done": ["refine_done", "needs_review", "failed"],
    "refine_done": ["accepted", "needs_review", "failed"],
    "needs_review": ["failed"],
    "failed": [],
    "accepted": [],
}
#: Edges that a human decision allows in addition.
HUMAN_EDGES = {s: ["accepted"] for s in ("pending", "needs_review", "failed", "accepted")}
RESUMABLE = ["pending", "coarse_done", "refine_done"]
METRICS = ["min", "max", "mean", "std", "count", "q01", "q10", "q50", "q90", "q99"]
QUANTILES = {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}
