"""What a reviewer is shown: candidate frames and annotations, and budgets that admit whole candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES, IMAGES = 64, 512


def candidate_frames(n: str | Column, *sources: str, cap: int = CANDIDATES) -> Column:
    """struct<frames, omitted>: the distinct frames of all sources inside the episode, in order, cap at most."""
    n = F.col(n) if isinstance(n, str) else n
    every = F.concat(*(F.coalesce(F.col(s).cast("array<bigint>"), F.array().cast("array<bigint>")) for s in sources))
    inside = F.array_sort(F.array_distinct(F.filter(every, lambda f: (f >= 0) & (f < n))))
    return F.struct(F.slice(inside, 1, cap).alias("frames"), F.greatest(F.size(inside) - cap, F.lit(0)).alias("omitted"))


def candidate_annotation(*choices: str) -> Column:
    """The first annotation there is: final, refined, coarse, then the first attempt's."""
    return F.coalesce(*choices)


def within_budget(rows: DataFrame, by: str, order: str, cost: str, budget: int) -> DataFrame:
    """Rows of each group up to the first whose cost would pass the budget; none after that one."""
    w = Window.partitionBy(by).orderBy(order)
    total = rows.withColumn("_total", F.sum(cost).over(w))
    return total.where(F.col("_total") <= budget).drop("_total")


def queue_view(records: DataFrame, status: str | None = None) -> DataFrame:
    """The episode list of the review interface, of one status or all."""
    rows = records if status is None else records.where(F.col("status") == status)
    return rows.select("episode_index", "status", "review_reasons", "failure_category", "updated_at")


def evidence(records: DataFrame, cameras: DataFrame, per_frame_cost: int = 1) -> DataFrame:
    """(episode_index, frame_index, camera, camera_order): the images of a review bundle.

    Candidates are admitted whole, all cameras of a frame or none. The cameras are a few rows by definition.
    """
    frames = records.select("episode_index", F.posexplode("candidates.frames").alias("nth", "frame_index"))
    many = cameras.agg(F.count("*").alias("cost"))
    kept = within_budget(frames.join(F.broadcast(many)).withColumn("cost", F.col("cost") * per_frame_cost), "episode_index", "nth", "cost", IMAGES)
    return kept.select("episode_index", "frame_index").join(F.broadcast(cameras))


def apply_decision(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Records after human decisions (episode_index, expected_status, expected_updated_at, annotation, takeover, decided_at), and what became of each.

    A decision counts if the record is as expected; one on a record that is not for review also needs takeover.
    """
    d = decisions.select("episode_index", "expected_status", "expected_updated_at", "annotation", "takeover", "decided_at")
    rows = records.join(d, "episode_index", "left")
    asked = F.col("expected_status").isNotNull()
    same = F.col("status").eqNullSafe(F.col("expected_status")) & F.col("updated_at").eqNullSafe(F.col("expected_updated_at"))
    outcome = F.when(~asked, F.lit(None)).when(~same, "stale").when((F.col("status") != "needs_review") & ~F.coalesce("takeover", F.lit(False)), "takeover_required").otherwise("applied")
    rows = rows.withColumn("outcome", outcome)
    hit = F.coalesce(F.col("outcome") == "applied", F.lit(False))
    later = F.greatest(F.col("decided_at"), F.col("updated_at") + F.expr("INTERVAL 1 MICROSECOND"))
    return rows.select(
        "episode_index",
        F.when(hit, "accepted").otherwise(F.col("status")).alias("status"),
        F.when(hit, F.col("annotation")).otherwise(F.col("final_annotation")).alias("final_annotation"),
        F.when(hit, later).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(hit, "human").otherwise(F.col("decision_source")).alias("decision_source"),
        "outcome",
    )
