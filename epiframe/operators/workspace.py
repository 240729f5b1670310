"""Episode records and their transitions: summaries, resumption, chain checks, and the log from the outbox."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EDGES, HUMAN_EDGES, RESUMABLE, STATUSES


def summary(records: DataFrame) -> DataFrame:
    """(status, n) for every status, those without records too."""
    counts = records.groupBy("status").agg(F.count("*").alias("n"))
    known = records.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    return known.join(F.broadcast(counts), "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def nonaccepted(records: DataFrame) -> DataFrame:
    """(status, episode_index): what summaries list, as rows, for lists may be long."""
    return records.where("status <> 'accepted'").select("status", "episode_index")


def summary_issues(counts: DataFrame, listed: DataFrame, total: int) -> DataFrame:
    """(issue, subject) of a stored summary: counts (status, n) and its episode lists as rows (status, episode_index)."""
    seen = listed.groupBy("status").agg(F.count("*").alias("_l"), F.count_distinct("episode_index").alias("_d"))
    rows = counts.where("status <> 'accepted'").join(F.broadcast(seen), "status", "full_outer")
    wrong = rows.where("coalesce(n, 0) <> coalesce(_l, 0) OR coalesce(_l, 0) <> coalesce(_d, 0)").select(F.lit("list_and_count").alias("issue"), F.col("status").alias("subject"))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).where(F.col("n") != total).select(F.lit("total"), F.col("n").cast("string"))
    outside = listed.where((F.col("episode_index") < 0) | (F.col("episode_index") >= total)).select(F.lit("range"), F.col("episode_index").cast("string"))
    twice = listed.groupBy("episode_index").agg(F.count_distinct("status").alias("n")).where("n > 1").select(F.lit("not_disjoint"), F.col("episode_index").cast("string"))
    return wrong.union(sums).union(outside).union(twice)


def status_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("status").agg(F.count("*").alias("n"))


def resumable(records: DataFrame) -> DataFrame:
    return records.where(F.col("status").isin(RESUMABLE))


def review_queue(records: DataFrame) -> DataFrame:
    """Episodes that are up for review, as rows in no order; who shows them sorts them."""
    return records.where("status = 'needs_review'")


def edge_allowed(source: str, target: str, human: str) -> Column:
    """Whether a transition is one of the graph; human tells of a human decision."""
    plain = [(F.col(source) == a) & F.col(target).isin(b) for a, b in EDGES.items() if b]
    told = [(F.col(source) == a) & F.col(target).isin(b) for a, b in HUMAN_EDGES.items()]
    return reduce(operator.or_, plain) | (F.col(human) & reduce(operator.or_, told))


def chain_issues(transitions: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """(episode_index, event_id, issue) of transition logs (event_id, episode_index, from_status, to_status, timestamp, human).

    Each event continues the one before, later than it; the first starts at pending; edges are of the
    graph; event_ids occur once; the last status is the record's. An event_id's check is a count of its own,
    so one window per episode is all that is ordered.
    """
    order = Window.partitionBy("episode_index").orderBy("timestamp", "event_id")
    rows = transitions.select(
        "episode_index", "event_id", "from_status", "to_status", "human",
        F.lag("to_status").over(order).alias("before"), F.lag("timestamp").over(order).alias("then"), "timestamp",
        F.lead("event_id").over(order).isNull().alias("last"),
    )
    if records is not None:
        rows = rows.join(records.select("episode_index", "status"), "episode_index", "left")
    else:
        rows = rows.withColumn("status", F.col("to_status"))
    issues = F.array_compact(
        F.array(
            F.when(F.col("before").isNull() & (F.col("from_status") != "pending"), F.lit("first_not_pending")),
            F.when(F.col("before") != F.col("from_status"), F.lit("broken_chain")),
            F.when(F.col("then") >= F.col("timestamp"), F.lit("time_not_increasing")),
            F.when(~edge_allowed("from_status", "to_status", "human"), F.lit("illegal_edge")),
            F.when(F.col("last") & ~F.col("to_status").eqNullSafe(F.col("status")), F.lit("last_not_record")),
        )
    )
    found = rows.select("episode_index", "event_id", F.explode(issues).alias("issue"))
    again = transitions.groupBy("event_id").agg(F.count("*").alias("n"), F.min("episode_index").alias("episode_index")).where("n > 1")
    return found.union(again.select("episode_index", "event_id", F.lit("repeated_event_id")))


def first_last(transitions: DataFrame) -> DataFrame:
    """(episode_index, events, first_status, last_status), by extreme time: an aggregate, no sort."""
    when = F.struct("timestamp", "event_id")
    return transitions.groupBy("episode_index").agg(F.count("*").alias("events"), F.min_by("to_status", when).alias("first_status"), F.max_by("to_status", when).alias("last_status"))


def latest(rows: DataFrame, value: str, order: str, by: str = "episode_index") -> DataFrame:
    """(by, value) at the greatest order: an aggregate, no sort."""
    return rows.groupBy(by).agg(F.max_by(value, order).alias(value))


def ordered_log(transitions: DataFrame) -> DataFrame:
    return transitions.dropDuplicates(["event_id"]).orderBy("timestamp", "episode_index", "event_id")


def monotone_clock(rows: DataFrame) -> DataFrame:
    """Rows (episode_index, seq, now as microseconds) with time: max(now, the time before + 1 microsecond).

    time_i is seq rank plus the running greatest of now - rank, so no row waits for the one before.
    """
    order = Window.partitionBy("episode_index").orderBy("seq")
    rank = F.row_number().over(order)
    return rows.withColumn("_r", rank).withColumn("time", F.max(F.col("now") - F.col("_r")).over(order) + F.col("_r")).drop("_r")


def zero_transition_review(details: str | Column, annotation: str | Column) -> Column:
    """Whether a record without refine steps is audited: a coarse decision without boundaries, then a review that asked nothing and gives the empty annotation."""
    d = F.col(details) if isinstance(details, str) else details
    a = F.col(annotation) if isinstance(annotation, str) else annotation
    want = {"$.coarse.status": "coarse_done", "$.coarse.centers": "[]", "$.refine.status": "needs_review", "$.refine.provenance": "[]", "$.refine.boundaries": "[]"}
    told = reduce(operator.and_, (F.get_json_object(d, path).eqNullSafe(F.lit(value)) for path, value in want.items()))
    return told & a.isNull()


def record_issues(records: DataFrame) -> DataFrame:
    """(episode_index, issues): fields that contradict a record's status. Decisions are in the JSON of sampling_details."""

    def absent(c: str) -> Column:
        return F.col(c).isNull()

    def empty(c: str) -> Column:
        return F.coalesce(F.size(c), F.lit(0)) <= 0

    def decided(kind: str) -> Column:
        return F.get_json_object("sampling_details", f"$.{kind}").isNotNull()

    status = F.col("status")
    done = status.isin("refine_done", "accepted")
    nothing = F.coalesce("sampling_details", F.lit("{}")) == "{}"
    plain = F.coalesce(F.size("final_annotation.boundaries") == 0, F.lit(False))
    stepped = ~empty("refine_attempts") | F.coalesce(F.get_json_object("sampling_details", "$.refine.provenance") != "[]", F.lit(False))
    audited = zero_transition_review("sampling_details", "final_annotation")
    checks = [
        (~status.isin(STATUSES), "unknown_status"),
        ((status == "pending") & ~(absent("final_annotation") & absent("failure_category") & empty("coarse_attempts") & empty("refine_attempts") & empty("validation_issues") & empty("review_reasons") & nothing), "pending_with_results"),
        (status.isin("coarse_done", "refine_done") & empty("coarse_attempts") & ~decided("coarse"), "coarse_missing"),
        ((status == "refine_done") & ~(stepped | plain | audited), "refine_missing"),
        (done & absent("final_annotation") & ~audited, "annotation_missing"),
        ((status == "accepted") & ~(empty("review_reasons") & empty("validation_issues")), "accepted_with_reasons"),
        ((status == "accepted") & absent("decision_source"), "accepted_without_source"),
        ((status == "accepted") & (F.col("decision_source") == "model") & (absent("prompt_version") | absent("model_revision") | nothing), "model_without_provenance"),
        ((status != "accepted") & ~absent("decision_source"), "source_without_acceptance"),
        ((status == "needs_review") & empty("review_reasons") & empty("validation_issues"), "review_without_reason"),
        ((status == "failed") & absent("failure_category"), "failure_without_category"),
        ((status != "failed") & ~absent("failure_category"), "category_without_failure"),
        (F.col("updated_at") < F.col("created_at"), "time_order"),
    ]
    return records.select("episode_index", F.array_compact(F.array(*(F.when(t, F.lit(c)) for t, c in checks))).alias("issues"))


def manifest_issues(lengths: DataFrame, manifest: dict) -> DataFrame:
    """(issue, subject): totals of a manifest that are not those of the episodes (episode_index, length), and cameras that it names twice."""
    spark = lengths.sparkSession
    sums = lengths.agg(F.count("*").alias("episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames"), F.count_if(F.col("length") < 1).alias("short"))
    checks = F.array_compact(
        F.array(
            *(F.when(F.col(n) != F.lit(manifest[n]), F.struct(F.lit(f"{n}_total").alias("issue"), F.col(n).cast("string").alias("subject"))) for n in ("episodes", "frames")),
            F.when(F.col("short") > 0, F.struct(F.lit("length").alias("issue"), F.col("short").cast("string").alias("subject"))),
        )
    )
    cameras = manifest.get("cameras", [])
    twice = spark.createDataFrame([("camera_repeated", c) for c in sorted(set(cameras)) if cameras.count(c) > 1], "issue string, subject string")
    return sums.select(F.explode(checks).alias("x")).select("x.*").union(twice)


def provenance_differences(records: DataFrame, manifest: dict) -> DataFrame:
    """(episode_index, fields): facts of a record that differ from the manifest's, null-safe."""
    names = [c for c in ("source_fingerprint", "run_fingerprint", "prompt_version", "model_revision") if c in manifest]
    return records.select("episode_index", F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.lit(manifest[c])), F.lit(c)) for c in names))).alias("fields")).where(F.size("fields") > 0)


def initialise(episodes: DataFrame, records: DataFrame) -> DataFrame:
    """Every episode with its record's status, pending where it has none, and what does not match."""
    rows = episodes.select("episode_index", F.lit(True).alias("_e")).join(records.select("episode_index", "status", F.lit(True).alias("_r")), "episode_index", "full_outer")
    action = F.when(F.col("_e").isNull(), "orphan_record").when(F.col("_r").isNull(), "create").otherwise("keep")
    return rows.select("episode_index", F.coalesce("status", F.lit("pending")).alias("status"), action.alias("action"))


def invalidated(records: DataFrame, episodes: list[int]) -> DataFrame:
    """Records, those of the episodes reset to pending."""
    hit = F.col("episode_index").isin(episodes)
    keep = {"episode_index", "created_at", "source_fingerprint", "run_fingerprint", "prompt_version", "model_revision"}
    kinds = dict(records.dtypes)
    return records.select(*(F.when(hit, F.lit("pending")).otherwise(F.col(c)).alias(c) if c == "status" else F.col(c) if c in keep else F.when(~hit, F.col(c)).otherwise(F.lit(None).cast(kinds[c])).alias(c) for c in records.columns))


def conflicts(current: DataFrame, expected: DataFrame) -> DataFrame:
    """Optimistic concurrency: episodes whose stored (status, updated_at) is not the expected one."""
    e = expected.select("episode_index", F.col("status").alias("_s"), F.col("updated_at").alias("_u"))
    return e.join(current, "episode_index", "left").where("NOT (status <=> _s AND updated_at <=> _u)").select("episode_index")
