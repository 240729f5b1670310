import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from epiframe.operators import evaluation, reindex, review, segments, statistics, workspace
from epiframe.streaming import state


def test_scalar_and_vector_statistics(spark):
    df = spark.createDataFrame([(0, 1, [1.0, 10.0]), (0, 2, [3.0, 30.0]), (1, 3, [5.0, 50.0]), (1, 4, [7.0, 70.0])], "episode_index long, x long, v array<float>")
    got = {(r.episode_index, r.feature, r.component): r for r in statistics.feature_stats(df, ["x", "v"], "episode_index").collect()}
    r = got[None, "x", 0]
    assert (r.min, r.max, r.mean, r["count"], r.q50) == (1, 4, 2.5, 4, 2.5) and math.isclose(r.std, math.sqrt(1.25))
    assert [round(r[q], 9) for q in ("q01", "q10", "q90", "q99")] == [1.03, 1.3, 3.7, 3.97]
    assert [round(got[None, "v", i].q01, 9) for i in (0, 1)] == [1.06, 10.6] and [got[None, "v", i].mean for i in (0, 1)] == [4, 40]
    assert got[1, "x", 0].mean == 3.5 and len(got) == 9
    v = {r.feature: r for r in statistics.as_vectors(statistics.feature_stats(df, ["x", "v"]), ["feature"]).collect()}
    assert v["v"].mean == [4, 40] and v["x"]["count"] == [4]
    s = statistics.rank_quantiles(statistics.components(df, ["v"], []), ["feature", "component"]).orderBy("component").first()
    assert round(s.q01, 9) == 1.06 and round(s.q90, 9) == 6.4


def test_histogram_statistics_of_images(spark):
    values = [(c, v) for c in range(3) for v in range(c * 10, 180, 30)]
    bins = spark.createDataFrame(values, "channel int, v int").groupBy("channel", F.col("v").alias("bin")).agg(F.count("*").alias("n"))
    got = {r.channel: r for r in statistics.histogram_stats(bins, ["channel"]).collect()}
    assert [round(got[c].mean * 255, 6) for c in range(3)] == [75, 85, 95] and [got[c]["count"] for c in range(3)] == [6, 6, 6]
    assert [round(got[c].q50 * 255, 6) for c in range(3)] == [75, 85, 95] and round(got[2].max * 255, 6) == 170


def test_comparison_of_statistics(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    s = statistics.feature_stats(df, ["x"])
    assert statistics.compare_stats(s, s.withColumn("mean", F.col("mean") + 1e-8), ["feature"]).count() == 0
    assert statistics.compare_stats(s, s.withColumn("max", F.col("max") + 1e-3), ["feature"]).count() == 1
    assert statistics.compare_stats(s, s.withColumn("max", F.col("max") + 1e-4), ["feature"], legacy=True).count() == 0
    bad = s.withColumn("q01", F.lit(float("nan"))).withColumn("count", F.lit(0).cast("long"))
    assert set(statistics.stats_issues(bad, ["feature"]).first().issues) >= {"not_finite", "count"}


def maps(spark, golden, predicted, statuses, starts=None, golden_starts=None):
    g = [(e, b, (golden_starts or {}).get(e)) for e, b in golden.items()]
    p = [(e, b, (starts or {}).get(e)) for e, b in predicted.items()]
    kind = "episode_index long, boundaries array<long>, start_subtask_index int"
    return evaluation.aligned(spark.createDataFrame(g, kind), spark.createDataFrame(p, kind), spark.createDataFrame(list(statuses.items()), "episode_index long, status string"))


def test_evaluation_examples(spark):
    m = evaluation.metrics(maps(spark, {0: [100, 200], 1: [110, 250]}, {0: [102, 198], 1: [120, 240]}, {0: "accepted", 1: "needs_review"}), 20.0).first()
    assert (m.accepted_coverage, m.aligned_boundary_count, m.median_absolute_error_frames, m.median_absolute_error_seconds, m.p90_absolute_error_frames, m.p90_absolute_error_seconds) == (0.5, 4, 6, 0.3, 10, 0.5)
    m = evaluation.metrics(maps(spark, {0: [100], 1: [200], 2: [300]}, {0: [100], 1: [240]}, {0: "accepted", 1: "accepted", 2: "failed"}, {0: 0, 1: 2}, {0: 0, 1: 1, 2: 1}), 100.0).first()
    assert (m.start_subtask_index_accuracy, m.false_accept_count, m.missing_prediction_count) == (0.5, 1, 1)
    m = evaluation.metrics(maps(spark, {0: [10, 20]}, {0: [10]}, {0: "needs_review"}), 10.0).first()
    assert (m.aligned_boundary_count, m.transition_mismatch_count, m.constraint_violation_count, m.constraint_violation_blocked_count, m.constraint_blocking_rate, m.median_absolute_error_frames) == (0, 1, 1, 1, 1.0, None)
    rows = maps(spark, {0: [100]}, {0: [121]}, {0: "accepted"})
    assert evaluation.metrics(rows, 20.0, 1.0).first().false_accept_count == 1 and evaluation.metrics(rows, 20.0, 2.0).first().false_accept_count == 0
    m = evaluation.metrics(maps(spark, {}, {}, {}), 10.0).first()
    assert (m.accepted_coverage, m.start_subtask_index_accuracy, m.constraint_blocking_rate) == (0.0, None, 1.0)
    gates = {r.gate: r for r in evaluation.launch_gates(evaluation.metrics(maps(spark, {}, {}, {}), 10.0)).collect()}
    assert not gates["median_boundary_error_seconds"].passed and gates["false_accept_count"].passed and not gates["accepted_coverage"].all_passed


def test_published_boundaries(spark):
    told = {0: [220, 416, 627], 1: [234, 418, 643], 2: [232, 455, 720], 3: [230, 370, 577], 4: [207, 390, 575]}
    gold = {0: [186, 400, 584], 1: [219, 435, 604], 2: [216, 458, 691], 3: [205, 397, 549], 4: [190, 399, 541]}
    m = evaluation.metrics(maps(spark, gold, told, dict.fromkeys(gold, "accepted")), 28.0).first()
    assert (m.median_absolute_error_frames, m.p90_absolute_error_frames) == (25, 39)


def test_views(spark):
    g = spark.createDataFrame([(0, 500, [100, 220, 360])], "episode_index long, length long, boundaries array<long>")
    got = {(r.kind, r.start_frame, r.end_frame, r.expected_start, tuple(r.expected_boundaries)) for r in evaluation.dagger_views(g, 20).collect()}
    assert ("suffix", 50, 500, 0, (50, 170, 310)) in got and ("singleton", 50, 80, 0, ()) in got and not any(k == "singleton" and s == 3 for k, _, _, s, _ in got)
    g = spark.createDataFrame([(0, 20, [10])], "episode_index long, length long, boundaries array<long>")
    assert {(r.kind, r.start_frame) for r in evaluation.dagger_views(g, 8).collect()} == set()


def test_segments(spark):
    f = spark.createDataFrame([(1, i, c) for i, c in enumerate("aabbbc")] + [(2, 0, "x")], "episode_index long, frame_index long, label string")
    got = [(r.segment_index, r.label, r.start_frame, r.end_frame) for r in segments.run_segments(f).where("episode_index = 1").orderBy("segment_index").collect()]
    assert got == [(0, "a", 0, 2), (1, "b", 2, 5), (2, "c", 5, 6)]
    a = spark.createDataFrame([(1, 6, 1, [2, 5])], "episode_index long, length long, start_subtask_index int, boundaries array<int>")
    assert [(r.subtask_index, r.start_frame, r.end_frame) for r in segments.annotation_segments(a).orderBy("segment_index").collect()] == [(1, 0, 2), (2, 2, 5), (3, 5, 6)]
    assert [r.subtask_index for r in segments.label_frames(f, a, 4).orderBy("frame_index").collect()] == [1, 1, 2, 2, 2, 3]


def test_offsets_and_splits(spark):
    e = spark.createDataFrame([(i * 3, i % 5 + 1) for i in range(500)], "episode_index long, length long")
    total = 0
    for i, r in enumerate(reindex.running_offsets(e).orderBy("episode_index").collect()):
        assert (r.output_index, r.global_offset) == (i, total)
        total += r.length
    assert reindex.running_offsets(e.where("length > 9")).count() == 0
    s = spark.createDataFrame([("b", 5, 9), ("a", 0, 5)], "split string, first long, last long")
    assert reindex.split_coverage(s, 9).count() == 0
    assert [r.issue for r in reindex.split_coverage(s, 10).collect()] == ["gap_at_end"]


def test_transition_chains(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [("a", 1, "pending", "coarse_done", t, False), ("b", 1, "coarse_done", "refine_done", t + dt.timedelta(1), False), ("c", 2, "coarse_done", "failed", t, False), ("d", 3, "pending", "accepted", t, True), ("d", 3, "accepted", "accepted", t, True)]
    df = spark.createDataFrame(rows, "event_id string, episode_index long, from_status string, to_status string, timestamp timestamp, human boolean")
    records = spark.createDataFrame([(1, "accepted"), (2, "failed"), (3, "accepted")], "episode_index long, status string")
    got = {(r.episode_index, r.issue) for r in workspace.chain_issues(df, records).collect()}
    assert got == {(1, "last_not_record"), (2, "first_not_pending"), (3, "time_not_increasing"), (3, "repeated_event_id")}


def test_summaries(spark):
    counts = spark.createDataFrame([("accepted", 3), ("failed", 1), ("pending", 1)], "status string, n long")
    good = spark.createDataFrame([("failed", 4), ("pending", 0)], "status string, episode_index long")
    assert workspace.summary_issues(counts, good, 5).count() == 0
    bad = spark.createDataFrame([("failed", 0), ("pending", 0), ("pending", 9)], "status string, episode_index long")
    assert {r.issue for r in workspace.summary_issues(counts, bad, 6).collect()} == {"list_and_count", "total", "range", "not_disjoint"}


def test_decisions_and_budget(spark):
    d = spark.createDataFrame([(1, i, 3) for i in range(5)] + [(2, 0, 9)], "g long, o long, c long")
    assert review.within_budget(d, "g", "o", "c", 8).count() == 2
    r = spark.createDataFrame([(5, [3, 9, 1], [9, 70])], "n long, a array<long>, b array<long>").select(review.candidate_frames("n", "a", "b", cap=1).alias("c")).first().c
    assert r.frames == [1] and r.omitted == 1


def test_state_machine_stream(spark, tmp_path):
    t = dt.datetime(2026, 1, 1)

    def rows(k):
        e = [("pending", "coarse_done"), ("coarse_done", "refine_done"), ("refine_done", "accepted"), ("accepted", "failed")][k]
        return [(f"{i}-{k}", i, e[0] if i != 3 or k != 1 else "pending", e[1], t + dt.timedelta(k if i != 4 else 0), False) for i in range(6)]

    kind = "event_id string, episode_index long, from_status string, to_status string, timestamp timestamp, human boolean"
    for k in range(4):
        spark.createDataFrame(rows(k), kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = state.run_available(state.run_state_machine(stream), "machine", f"{tmp_path}/c1").collect()
    reasons = {r.event_id: r.reason for r in got}
    assert len(got) == 24 and reasons["0-2"] is None and reasons["0-3"] == "illegal_edge" and reasons["3-1"] == "broken_chain" and reasons["4-1"] == "late"
    counts = {r.to_status: r.n for r in state.run_available(state.status_counts(stream), "counts", f"{tmp_path}/c2", "complete").collect()}
    assert counts == {"coarse_done": 6, "refine_done": 6, "accepted": 6, "failed": 6}


def test_log_is_written_once(spark, tmp_path):
    write = state.log_writer(f"{tmp_path}/log")
    kind = "event_id string, timestamp timestamp, x long"
    day = [dt.datetime(2026, 1, d, 12) for d in (1, 2, 3)]
    b = spark.createDataFrame([("a", day[0], 1), ("b", day[1], 2), ("a", day[0], 1)], kind)
    write(b, 0)
    write(b, 0)
    write(spark.createDataFrame([("b", day[1], 2), ("c", day[2], 3), ("d", None, 4)], kind), 1)
    got = state.read_log(spark, f"{tmp_path}/log", kind).collect()
    assert sorted((r.event_id, r.batch) for r in got) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_window_counts_stream(spark, sf, tmp_path, slide):
    spark.read.parquet(f"{sf}/events.parquet").selectExpr("CAST(ts AS TIMESTAMP) AS timestamp", "event_type AS label").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("timestamp timestamp, label string").parquet(f"{tmp_path}/in")
    out = state.run_available(state.window_counts(stream, "1 hour", slide), f"w{slide is None}", f"{tmp_path}/c", "complete")
    n = spark.read.parquet(f"{tmp_path}/in").count()
    assert out.agg(F.sum("n")).first()[0] == n * (2 if slide else 1)
