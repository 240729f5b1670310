"""Scores of predicted boundaries against golden ones, launch gates, and virtual views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boundaries import segment_lengths

# The launch gates as (name, metric, comparison, threshold).
GATES = [
    ("median_boundary_error_seconds", "median_absolute_error_seconds", "<=", 0.5),
    ("p90_boundary_error_seconds", "p90_absolute_error_seconds", "<=", 1.0),
    ("accepted_coverage", "accepted_coverage", ">=", 0.85),
    ("constraint_blocking_rate", "constraint_blocking_rate", ">=", 1.0),
    ("false_accept_count", "false_accept_count", "<=", 0.0),
]


def aligned(golden: DataFrame, predicted: DataFrame, statuses: DataFrame, violations: DataFrame | None = None) -> DataFrame:
    """A row for each golden episode: both boundary arrays, starts, status, and whether a rule is violated.

    golden and predicted: (episode_index, boundaries) and, if starts are judged, start_subtask_index.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        start = F.col("start_subtask_index") if "start_subtask_index" in df.columns else F.lit(None).cast("int")
        return df.select("episode_index", F.col("boundaries").alias(f"{name}_boundaries"), start.alias(f"{name}_start"), F.lit(True).alias(f"in_{name}"))

    rows = side(golden, "golden").join(side(predicted, "predicted"), "episode_index", "left").join(statuses.select("episode_index", "status"), "episode_index", "left")
    if violations is not None:
        rows = rows.join(violations.select("episode_index", F.col("violates").alias("_told")), "episode_index", "left")
    else:
        rows = rows.withColumn("_told", F.lit(False))
    missing = F.col("in_predicted").isNull()
    differs = ~missing & (F.size("predicted_boundaries") != F.size("golden_boundaries"))
    return rows.select(
        "episode_index",
        "status",
        "golden_boundaries",
        "predicted_boundaries",
        "golden_start",
        "predicted_start",
        missing.alias("missing"),
        differs.alias("count_mismatch"),
        (F.coalesce("_told", F.lit(False)) | differs).alias("violates"),
        F.when(~missing & ~differs, F.transform(F.arrays_zip("predicted_boundaries", "golden_boundaries"), lambda z: F.abs(z["predicted_boundaries"] - z["golden_boundaries"]))).alias("errors"),
        F.when(~missing, F.col("predicted_start") == F.col("golden_start")).alias("start_correct"),
    )


def boundary_errors(rows: DataFrame) -> DataFrame:
    """(episode_index, ordinal, error) of aligned episodes only; counts that differ are never zipped in part."""
    return rows.select("episode_index", F.posexplode("errors").alias("ordinal", "error"))


def false_accept(fps: float, seconds: float) -> Column:
    """An accepted episode that is missing, violates a rule, starts wrong or errs by more than so many seconds."""
    far = F.exists("errors", lambda e: e / fps > seconds)
    starts = F.col("golden_start").isNotNull() & ~F.coalesce("start_correct", F.lit(False))
    wrong = F.col("missing") | F.col("violates") | starts | F.coalesce(far, F.lit(False))
    return (F.col("status") == "accepted") & wrong


def metrics(rows: DataFrame, fps: float, false_accept_seconds: float = 1.0) -> DataFrame:
    """One row of all figures. Medians are exact, the 90th percentile is the nearest rank; both null without errors."""
    n = F.count("*")

    def many(test) -> Column:
        return F.count(F.when(F.col(test) if isinstance(test, str) else test, 1))

    def rate(x: Column) -> Column:
        return F.when(n == 0, 0.0).otherwise(x / n)

    blocked = F.col("violates") & (F.col("status") != "accepted")
    judged = F.when(F.col("golden_start").isNotNull(), F.col("start_correct"))
    per_episode = rows.agg(
        n.alias("episode_count"),
        many(~F.col("missing")).alias("predicted_episode_count"),
        many("missing").alias("missing_prediction_count"),
        F.coalesce(F.sum(F.size("golden_boundaries")), F.lit(0)).cast("long").alias("boundary_count"),
        many("count_mismatch").alias("transition_mismatch_count"),
        F.count(judged).alias("start_index_evaluated_count"),
        many(judged).alias("start_index_correct_count"),
        F.avg(judged.cast("double")).alias("start_subtask_index_accuracy"),
        many(F.col("status") == "accepted").alias("accepted_count"),
        many(F.col("status") == "needs_review").alias("needs_review_count"),
        many(F.col("status") == "failed").alias("failed_count"),
        n.alias("status_denominator"),
        rate(many(F.col("status") == "accepted")).alias("accepted_coverage"),
        rate(many(F.col("status") == "needs_review")).alias("needs_review_rate"),
        rate(many(F.col("status") == "failed")).alias("failed_rate"),
        many("violates").alias("constraint_violation_count"),
        many(blocked).alias("constraint_violation_blocked_count"),
        F.when(many("violates") == 0, 1.0).otherwise(many(blocked) / many("violates")).alias("constraint_blocking_rate"),
        many(false_accept(fps, false_accept_seconds)).alias("false_accept_count"),
    )
    per_boundary = boundary_errors(rows).agg(
        F.count("*").alias("aligned_boundary_count"),
        F.expr("percentile(error, 0.5)").alias("median_absolute_error_frames"),
        F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY error)").cast("double").alias("p90_absolute_error_frames"),
    )
    both = per_episode.join(F.broadcast(per_boundary))  # one row each
    for q in ("median", "p90"):
        both = both.withColumn(f"{q}_absolute_error_seconds", F.col(f"{q}_absolute_error_frames") / fps)
    return both.withColumn("obvious_error_threshold_seconds", F.lit(float(false_accept_seconds))).withColumn("fps", F.lit(float(fps)))


def launch_gates(figures: DataFrame) -> DataFrame:
    """A row for each gate: gate, observed, threshold, passed (false if there is nothing observed), and all_passed."""
    parts = [f"'{g}', CAST({m} AS DOUBLE), CAST({t} AS DOUBLE), coalesce({m} {op} {t}, false)" for g, m, op, t in GATES]
    rows = figures.selectExpr(f"stack({len(GATES)}, {', '.join(parts)}) AS (gate, observed, threshold, passed)", "*")
    every = " AND ".join(f"coalesce({m} {op} {t}, false)" for _, m, op, t in GATES)
    return rows.selectExpr("gate", "observed", "threshold", "passed", f"({every}) AS all_passed")


def missing_and_extra(golden: DataFrame, predicted: DataFrame) -> DataFrame:
    """(episode_index, side): golden episodes without prediction, and predictions without golden episode."""
    a = golden.join(predicted, "episode_index", "left_anti").select("episode_index", F.lit("missing").alias("side"))
    b = predicted.join(golden, "episode_index", "left_anti").select("episode_index", F.lit("extra").alias("side"))
    return a.union(b)


def same_keys(a: DataFrame, b: DataFrame, key: str = "episode_index") -> DataFrame:
    """The keys that only one side has; an empty result means that both have the same."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    return left.join(right, key, "full_outer").where("_a IS NULL OR _b IS NULL").select(key)


def dagger_views(golden: DataFrame, min_segment: int) -> DataFrame:
    """Virtual views of golden episodes (episode_index, length, boundaries), as frame ranges.

    Each segment gives a suffix, from its midpoint to the episode's end, unless one of the suffix's own
    segments is under min_segment frames; and each but the last gives a singleton, from its midpoint to
    min_segment frames before its end, unless that is under min_segment frames. Episodes whose
    boundaries are no increasing inside points give none.
    """
    b = F.col("boundaries").cast("array<bigint>")
    edges = F.concat(F.array(F.lit(0).cast("long")), b)
    ends = F.concat(b, F.array(F.col("length").cast("long")))
    sound = F.forall(F.zip_with(edges, ends, lambda l, r: r > l), lambda x: x)
    own = golden.where(sound).select("episode_index", F.col("length").cast("long").alias("n"), b.alias("b"), F.posexplode(F.arrays_zip(edges.alias("l"), ends.alias("r"))).alias("i", "z"))
    own = own.select("episode_index", "n", "b", "i", F.col("z.r").alias("r"), (F.col("z.l") + F.floor((F.col("z.r") - F.col("z.l")) / 2)).alias("start"))
    after = F.transform(F.filter("b", lambda x: x > F.col("start")), lambda x: x - F.col("start"))
    suffix = own.select(F.col("episode_index").alias("source_episode"), F.lit("suffix").alias("kind"), F.col("start").alias("start_frame"), F.col("n").alias("end_frame"), F.col("i").alias("expected_start"), after.alias("expected_boundaries"))
    long_enough = F.forall(segment_lengths("expected_boundaries", F.col("end_frame") - F.col("start_frame")), lambda x: x >= min_segment)
    stop = F.col("r") - min_segment
    single = own.where((F.col("i") < F.size("b")) & (stop - F.col("start") >= min_segment)).select("episode_index", F.lit("singleton"), "start", stop, "i", F.array().cast("array<bigint>"))
    return suffix.where(long_enough).union(single)
