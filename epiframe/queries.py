"""A query for each operator on the driver's tables, with the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import adapters as A
from .functions import boundaries as B
from .functions import jsontext, rules, sampling, text
from .operators import evaluation, reindex, review, segments, statistics, workspace

FPS = 10.0
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Common parts of the SQL. Materialised: self-joins of these must not be rewritten.
F_SQL = """f AS MATERIALIZED (SELECT user_id AS episode_index, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, event_type AS label, value, ts, event_id FROM events)"""
B_SQL = """b AS MATERIALIZED (SELECT episode_index, frame_index AS boundary, prev AS from_label, label AS to_label, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS ordinal
  FROM (SELECT *, lag(label) OVER (PARTITION BY episode_index ORDER BY frame_index) AS prev FROM f) WHERE prev <> label)"""
G_SQL = f"""{F_SQL}, {B_SQL},
n AS MATERIALIZED (SELECT episode_index, count(*) AS length FROM f GROUP BY episode_index),
g3 AS MATERIALIZED (SELECT episode_index, list(boundary ORDER BY boundary)[1:3] AS bs FROM b GROUP BY episode_index),
g AS MATERIALIZED (SELECT episode_index, length, coalesce(bs, []::BIGINT[]) AS boundaries FROM n LEFT JOIN g3 USING (episode_index)),
p0 AS MATERIALIZED (SELECT episode_index, list_transform(boundaries, lambda x, i: x + (episode_index * 7 + (i - 1) * 3) % 11 - 5) AS sh FROM g WHERE episode_index % 17 <> 0),
p AS MATERIALIZED (SELECT episode_index, CASE WHEN episode_index % 13 = 0 THEN sh[1:greatest(len(sh) - 1, 0)] ELSE sh END AS boundaries FROM p0),
s AS MATERIALIZED (SELECT episode_index, CASE WHEN episode_index % 10 < 8 THEN 'accepted' WHEN episode_index % 10 = 8 THEN 'needs_review' ELSE 'failed' END AS status FROM g),
a AS MATERIALIZED (SELECT g.episode_index, status, g.boundaries AS gb, p.boundaries AS pb, p.episode_index IS NULL AS missing,
  coalesce(len(p.boundaries) <> len(g.boundaries), false) AS mismatch FROM g JOIN s USING (episode_index) LEFT JOIN p ON p.episode_index = g.episode_index),
e AS MATERIALIZED (SELECT episode_index, status, i - 1 AS ordinal, abs(pb[i] - gb[i]) AS error FROM (SELECT *, unnest(range(1, len(gb) + 1)) AS i FROM a WHERE NOT missing AND NOT mismatch))"""


def query(sql: str | None = None):
    """Registers a function as the query of its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _golden(spark: SparkSession, sf: str) -> DataFrame:
    return A.golden_arrays(A.event_frames(spark, sf))


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    g = _golden(spark, sf)
    return evaluation.aligned(g, A.shifted_predictions(g), A.statuses(g))


# --- boundaries and segments -------------------------------------------------------------------


@query(f"WITH {F_SQL}, {B_SQL} SELECT episode_index, ordinal, boundary, from_label, to_label FROM b")
def boundaries_runlength(spark, sf):
    rows = segments.run_boundaries(A.event_frames(spark, sf))
    return rows.select("episode_index", F.col("ordinal").cast("long").alias("ordinal"), "boundary", "from_label", "to_label")


@query("""SELECT episode_index, boundary FROM (SELECT conv_id AS episode_index, turn AS boundary, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) WHERE prev <> role""")
def boundaries_conversations(spark, sf):
    return segments.run_boundaries(A.conversation_frames(spark, sf)).select("episode_index", "boundary")


S_SQL = f"""{F_SQL}, w AS (SELECT *, coalesce(lag(label) OVER o <> label, true) AS isnew, max(frame_index) OVER (PARTITION BY episode_index) + 1 AS length FROM f WINDOW o AS (PARTITION BY episode_index ORDER BY frame_index)),
seg AS MATERIALIZED (SELECT episode_index, row_number() OVER q - 1 AS segment_index, label, frame_index AS start_frame, coalesce(lead(frame_index) OVER q, length) AS end_frame FROM w WHERE isnew WINDOW q AS (PARTITION BY episode_index ORDER BY frame_index))"""


def _segments(spark, sf):
    return segments.run_segments(A.event_frames(spark, sf)).withColumn("segment_index", F.col("segment_index").cast("long"))


@query(f"WITH {S_SQL} SELECT * FROM seg")
def segments_table(spark, sf):
    return _segments(spark, sf)


@query(f"WITH {S_SQL} SELECT label, count(*) AS n_segments, CAST(sum(end_frame - start_frame) AS BIGINT) AS frames, min(end_frame - start_frame) AS shortest, max(end_frame - start_frame) AS longest FROM seg GROUP BY label")
def segment_durations(spark, sf):
    return segments.durations(_segments(spark, sf))


@query(f"WITH {S_SQL} SELECT f.episode_index, frame_index, segment_index FROM f JOIN seg ON f.episode_index = seg.episode_index AND frame_index >= start_frame AND frame_index < end_frame")
def frame_labels_interval_join(spark, sf):
    frames = A.event_frames(spark, sf).select("episode_index", "frame_index")
    return segments.label_by_intervals(frames, _segments(spark, sf))


@query(f"WITH {G_SQL} SELECT f.episode_index, frame_index, least(3, len(list_filter(boundaries, lambda x: x <= frame_index))) AS subtask_index FROM f JOIN g USING (episode_index)")
def frame_labels_template(spark, sf):
    frames = A.event_frames(spark, sf).select("episode_index", "frame_index")
    out = segments.label_frames(frames, _golden(spark, sf).withColumn("start_subtask_index", F.lit(0)), 4)
    return out.withColumn("subtask_index", F.col("subtask_index").cast("long"))


@query(f"""WITH {G_SQL}, t(subtask_index, skill) AS (VALUES (0, 'approach'), (1, 'grasp'), (2, 'move'), (3, 'release')),
x AS (SELECT episode_index, i - 1 AS subtask_index, list_concat([0], boundaries)[i] AS start_frame, list_concat(boundaries, [length])[i] AS end_frame FROM (SELECT *, unnest(range(1, len(boundaries) + 2)) AS i FROM g))
SELECT episode_index, subtask_index, skill, start_frame, end_frame FROM x JOIN t USING (subtask_index)""")
def action_segments(spark, sf):
    template = spark.createDataFrame([(0, "approach"), (1, "grasp"), (2, "move"), (3, "release")], "subtask_index int, skill string")
    own = segments.annotation_segments(_golden(spark, sf).withColumn("start_subtask_index", F.lit(0)))
    return segments.with_template(own, template).select("episode_index", F.col("subtask_index").cast("long").alias("subtask_index"), "skill", "start_frame", "end_frame")


# --- rules ---------------------------------------------------------------------------------------

ISSUES_SQL = """array_to_string(list_filter([CASE WHEN st >= k THEN 'start_subtask_range' END, CASE WHEN complete AND st <> 0 THEN 'complete_start_index' END, CASE WHEN complete AND len(bs) <> k - 1 THEN 'complete_boundary_count' END,
CASE WHEN len(list_filter(range(1, len(bs)), lambda i: bs[i] >= bs[i + 1])) > 0 THEN 'boundary_order' END, CASE WHEN len(list_filter(bs, lambda x: x <= 0 OR x >= length)) > 0 THEN 'boundary_range' END,
CASE WHEN len(list_filter(range(1, len(bs) + 2), lambda i: list_concat(bs, [length])[i] - list_concat([0], bs)[i] < 3)) > 0 THEN 'segment_too_short' END,
CASE WHEN NOT complete AND st < k AND len(bs) <> 0 AND len(bs) <> k - st - 1 THEN 'dagger_suffix_length' END], lambda x: x IS NOT NULL), ',')"""


def _validated(spark, sf, mode, start):
    g = _golden(spark, sf)
    rows = A.shifted_predictions(g).join(g.select("episode_index", "length"), "episode_index")
    found = rules.validate_annotation(start, "boundaries", "length", 4, F.lit(mode), 3)
    return rows.select("episode_index", F.array_join(found, ",").alias("issues"))


@query(f"WITH {G_SQL} SELECT episode_index, {ISSUES_SQL} AS issues FROM (SELECT p.episode_index, p.boundaries AS bs, length, 0 AS st, 4 AS k, true AS complete FROM p JOIN g USING (episode_index))")
def validate_annotation_complete(spark, sf):
    return _validated(spark, sf, "complete", F.lit(0))


@query(f"WITH {G_SQL} SELECT episode_index, {ISSUES_SQL} AS issues FROM (SELECT p.episode_index, p.boundaries AS bs, length, p.episode_index % 6 AS st, 4 AS k, false AS complete FROM p JOIN g USING (episode_index))")
def validate_annotation_dagger(spark, sf):
    return _validated(spark, sf, "dagger_patch", F.col("episode_index") % 6)


@query("""SELECT conv_id AS episode_index, n = 4 AND lo = 0 AS complete_ok, (n = 1 OR lo + n = 4) AND lo < 4 AS dagger_ok FROM (SELECT conv_id, count(*) AS n, min(turn) + conv_id % 3 AS lo FROM conversations GROUP BY conv_id)""")
def coarse_sequence_legal(spark, sf):
    rows = A.conversation_frames(spark, sf).groupBy("episode_index").agg(F.sort_array(F.collect_list("frame_index")).alias("o"))
    seen = F.transform("o", lambda x: (x + F.col("episode_index") % 3).cast("int"))
    return rows.select("episode_index", rules.coarse_sequence_legal(seen, 4, F.lit("complete")).alias("complete_ok"), rules.coarse_sequence_legal(seen, 4, F.lit("dagger_patch")).alias("dagger_ok"))


@query(f"""WITH {G_SQL}, q AS (SELECT episode_index, gb AS x, pb AS y, len(gb) + 1 AS n, len(pb) + 1 AS m, episode_index % 5 = 0 AS u FROM a WHERE NOT missing)
SELECT episode_index, array_to_string(list_filter([CASE WHEN n <> m THEN 'coarse_sequence_disagreement' END, CASE WHEN n <> 4 OR m <> 4 THEN 'illegal_coarse_sequence' END,
CASE WHEN len(list_filter(range(1, len(y)), lambda i: y[i] >= y[i + 1])) > 0 THEN 'coarse_boundary_order' END, CASE WHEN u THEN 'coarse_uncertain' END], lambda r: r IS NOT NULL), ',') AS reasons FROM q""")
def coarse_agreement(spark, sf):
    rows = _aligned(spark, sf).where("NOT missing")

    def attempt(b: str, uncertain) -> Column:
        return F.struct(F.sequence(F.lit(0), F.size(b)).alias("observed"), F.col(b).alias("boundaries"), uncertain.alias("uncertain"))

    one, two = attempt("golden_boundaries", F.lit(False)), attempt("predicted_boundaries", F.col("episode_index") % 5 == 0)
    found = rows.select("episode_index", one.alias("one"), two.alias("two"))
    return found.select("episode_index", F.array_join(rules.coarse_reasons("one", "two", 4, F.lit("complete")), ",").alias("reasons"))


@query(f"WITH {G_SQL} SELECT episode_index, i - 1 AS boundary_index, CASE WHEN abs(pb[i] - gb[i]) <= 3 THEN (pb[i] + gb[i] + 1) // 2 END AS agreed FROM (SELECT *, unnest(range(1, len(gb) + 1)) AS i FROM a WHERE NOT missing AND NOT mismatch)")
def refine_agreement(spark, sf):
    rows = _aligned(spark, sf).where("NOT missing AND NOT count_mismatch").select("episode_index", F.posexplode(F.arrays_zip("golden_boundaries", "predicted_boundaries")).alias("i", "z"))
    return rows.select("episode_index", F.col("i").cast("long").alias("boundary_index"), B.agreed_boundary(F.col("z.golden_boundaries"), F.col("z.predicted_boundaries"), 3).alias("agreed"))


@query("""SELECT doc_id, array_to_string(list_filter(['coarse_sequence_disagreement', 'illegal_coarse_sequence', 'coarse_boundary_count', 'coarse_boundary_order', 'coarse_uncertain'], lambda r: list_contains(
[CASE WHEN doc_id % 2 = 0 THEN 'coarse_uncertain' END, CASE WHEN doc_id % 3 = 0 THEN 'illegal_coarse_sequence' END], r)), ',') AS reasons, doc_id % 3 = 0 OR doc_id % 7 = 0 AS rejected FROM documents""")
def reason_order_and_rejection(spark, sf):
    d = F.col("doc_id")
    rows = A.table(spark, sf, "documents").select("doc_id", F.array(F.when(d % 2 == 0, "coarse_uncertain"), F.when(d % 3 == 0, "illegal_coarse_sequence")).alias("found"), F.when(d % 7 == 0, "invalid_model_response").alias("failure"))
    ordered = rules.in_order("found", rules.COARSE_REASONS)
    none = F.array().cast("array<string>")
    return rows.select("doc_id", F.array_join(ordered, ",").alias("reasons"), rules.rejected(none, F.array_compact("found"), "failure").alias("rejected"))


# --- evaluation ----------------------------------------------------------------------------------

M_SQL = f"""{G_SQL},
c AS (SELECT count(*) AS episode_count, count(*) FILTER (WHERE NOT missing) AS predicted_episode_count, count(*) FILTER (WHERE missing) AS missing_prediction_count, CAST(sum(len(gb)) AS BIGINT) AS boundary_count,
count(*) FILTER (WHERE mismatch) AS transition_mismatch_count, 0::BIGINT AS start_index_evaluated_count, 0::BIGINT AS start_index_correct_count, NULL::DOUBLE AS start_subtask_index_accuracy,
count(*) FILTER (WHERE status = 'accepted') AS accepted_count, count(*) FILTER (WHERE status = 'needs_review') AS needs_review_count, count(*) FILTER (WHERE status = 'failed') AS failed_count, count(*) AS status_denominator,
count(*) FILTER (WHERE status = 'accepted') / count(*) AS accepted_coverage, count(*) FILTER (WHERE status = 'needs_review') / count(*) AS needs_review_rate, count(*) FILTER (WHERE status = 'failed') / count(*) AS failed_rate,
count(*) FILTER (WHERE mismatch) AS constraint_violation_count, count(*) FILTER (WHERE mismatch AND status <> 'accepted') AS constraint_violation_blocked_count,
CASE WHEN count(*) FILTER (WHERE mismatch) = 0 THEN 1.0::DOUBLE ELSE count(*) FILTER (WHERE mismatch AND status <> 'accepted') / count(*) FILTER (WHERE mismatch) END AS constraint_blocking_rate,
count(*) FILTER (WHERE status = 'accepted' AND (missing OR mismatch OR episode_index IN (SELECT episode_index FROM e WHERE error / 10.0 > 0.4))) AS false_accept_count FROM a),
d AS (SELECT count(*) AS aligned_boundary_count, CAST(quantile_cont(error, 0.5) AS DOUBLE) AS median_absolute_error_frames, CAST(quantile_disc(error, 0.9) AS DOUBLE) AS p90_absolute_error_frames FROM e),
m AS (SELECT *, median_absolute_error_frames / 10.0::DOUBLE AS median_absolute_error_seconds, p90_absolute_error_frames / 10.0::DOUBLE AS p90_absolute_error_seconds, 0.4::DOUBLE AS obvious_error_threshold_seconds, 10.0::DOUBLE AS fps FROM c, d)"""


def _metrics(spark, sf):
    return evaluation.metrics(_aligned(spark, sf), FPS, 0.4)


@query(f"WITH {M_SQL} SELECT * FROM m")
def eval_boundary_metrics(spark, sf):
    return _metrics(spark, sf)


@query(f"WITH {G_SQL} SELECT episode_index, ordinal, error FROM e")
def eval_per_episode_errors(spark, sf):
    return evaluation.boundary_errors(_aligned(spark, sf)).select("episode_index", F.col("ordinal").cast("long").alias("ordinal"), "error")


GATE_SQL = " UNION ALL ".join(
    f"SELECT '{g}' AS gate, CAST({m} AS DOUBLE) AS observed, {t}::DOUBLE AS threshold, coalesce({m} {op} {t}, false) AS passed, {' AND '.join(f'coalesce({x} {o} {y}, false)' for _, x, o, y in evaluation.GATES)} AS all_passed FROM m"
    for g, m, op, t in evaluation.GATES
)


@query(f"WITH {M_SQL} {GATE_SQL}")
def launch_gates(spark, sf):
    return evaluation.launch_gates(_metrics(spark, sf))


@query(f"WITH {G_SQL} SELECT episode_index, 'missing' AS side FROM g WHERE episode_index NOT IN (SELECT episode_index FROM p) UNION ALL SELECT x, 'extra' FROM (SELECT episode_index + 1000000 AS x FROM p WHERE episode_index % 20 = 0)")
def missing_extra_predictions(spark, sf):
    g = _golden(spark, sf)
    p = A.shifted_predictions(g).select("episode_index")
    extra = p.where("episode_index % 20 = 0").select((F.col("episode_index") + 1000000).alias("episode_index"))
    return evaluation.missing_and_extra(g, p.union(extra))


@query(f"WITH {G_SQL} SELECT count(*) AS evaluated, count(*) FILTER (WHERE episode_index % 3 = episode_index % 2) AS correct, avg(CAST(episode_index % 3 = episode_index % 2 AS INT)) AS accuracy FROM a WHERE NOT missing")
def start_index_accuracy(spark, sf):
    g = _golden(spark, sf)
    p = A.shifted_predictions(g).withColumn("start_subtask_index", (F.col("episode_index") % 2).cast("int"))
    rows = evaluation.aligned(g.withColumn("start_subtask_index", (F.col("episode_index") % 3).cast("int")), p, A.statuses(g))
    m = evaluation.metrics(rows, FPS)
    return m.select(F.col("start_index_evaluated_count").alias("evaluated"), F.col("start_index_correct_count").alias("correct"), F.col("start_subtask_index_accuracy").alias("accuracy"))


@query(f"WITH {G_SQL} SELECT episode_index FROM a WHERE status = 'accepted' AND (missing OR mismatch OR episode_index IN (SELECT episode_index FROM e WHERE error / 10.0 > 0.4))")
def false_accepts(spark, sf):
    return _aligned(spark, sf).where(evaluation.false_accept(FPS, 0.4)).select("episode_index")


V_SQL = f"""{G_SQL}, v0 AS (SELECT episode_index, length, boundaries, i, list_concat([0], boundaries)[i] AS l, list_concat(boundaries, [length])[i] AS r FROM (SELECT *, unnest(range(1, len(boundaries) + 2)) AS i FROM g)),
v1 AS (SELECT *, l + (r - l) // 2 AS st FROM v0), v2 AS (SELECT *, list_transform(list_filter(boundaries, lambda x: x > st), lambda x: x - st) AS rel FROM v1),
v AS MATERIALIZED (SELECT episode_index AS source_episode, 'suffix' AS kind, st AS start_frame, length AS end_frame, i - 1 AS expected_start, rel FROM v2
WHERE len(list_filter(range(1, len(rel) + 2), lambda j: list_concat(rel, [length - st])[j] - list_concat([0], rel)[j] < 3)) = 0
UNION ALL SELECT episode_index, 'singleton', st, r - 3, i - 1, []::BIGINT[] FROM v2 WHERE i <= len(boundaries) AND r - 3 - st >= 3)"""


def _views(spark, sf):
    return evaluation.dagger_views(_golden(spark, sf), 3).withColumn("expected_start", F.col("expected_start").cast("long"))


@query(f"WITH {V_SQL} SELECT source_episode, kind, start_frame, end_frame, expected_start, array_to_string(rel, ',') AS expected_boundaries FROM v")
def dagger_views(spark, sf):
    return _views(spark, sf).withColumn("expected_boundaries", F.array_join(F.col("expected_boundaries").cast("array<string>"), ","))


@query(f"""WITH {V_SQL}, q AS (SELECT *, expected_start + CAST(source_episode % 9 = 0 AS INT) AS ps, list_transform(rel, lambda x: x + source_episode % 4) AS pb, end_frame - start_frame AS n FROM v)
SELECT source_episode, kind, start_frame, ps <> expected_start OR len(list_filter(pb, lambda x: x <= 0 OR x >= n)) > 0
OR len(list_filter(range(1, len(pb) + 2), lambda j: list_concat(pb, [n])[j] - list_concat([0], pb)[j] < 3)) > 0 AS violates FROM q""")
def dagger_prediction_rules(spark, sf):
    v = _views(spark, sf)
    start = F.col("expected_start") + (F.col("source_episode") % 9 == 0).cast("int")
    said = F.transform("expected_boundaries", lambda x: x + F.col("source_episode") % 4)
    bad = rules.dagger_violates("kind", start, said, "expected_start", "expected_boundaries", F.col("end_frame") - F.col("start_frame"), 3)
    return v.select("source_episode", "kind", "start_frame", bad.alias("violates"))


# --- statistics ----------------------------------------------------------------------------------

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
I_SQL = """i AS MATERIALIZED (SELECT l_orderkey AS episode_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) - 1 AS frame_index, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)"""
X_SQL = "x AS (SELECT * FROM (SELECT l_orderkey AS episode_index, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature, 0 AS component, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM lineitem))"
STATS_SQL = """min(x) AS min, max(x) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, count(x) AS count, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.1), 6) AS q10,
round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.9), 6) AS q90, round(quantile_cont(x, 0.99), 6) AS q99"""


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    for c in ("mean", "std", "q01", "q10", "q50", "q90", "q99"):
        df = df.withColumn(c, F.round(c, digits))
    return df


def _items(spark, sf):
    # episodes as they are: statistics need no frame numbers, so no window
    return A.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("episode_index"), *FEATURES)


@query(f"WITH {X_SQL} SELECT feature, component, {STATS_SQL} FROM x GROUP BY feature, component")
def stats_scalar_global(spark, sf):
    return _rounded(statistics.feature_stats(_items(spark, sf), FEATURES))


@query(f"WITH {X_SQL} SELECT episode_index, feature, component, {STATS_SQL} FROM x GROUP BY episode_index, feature, component")
def stats_scalar_by_episode(spark, sf):
    rows = statistics.feature_stats(_items(spark, sf), FEATURES, "episode_index").where("episode_index IS NOT NULL")
    return _rounded(rows)


@query(f"WITH {X_SQL} SELECT episode_index, feature, component, {STATS_SQL} FROM x GROUP BY GROUPING SETS ((feature, component), (episode_index, feature, component))")
def stats_grouping_sets(spark, sf):
    return _rounded(statistics.feature_stats(_items(spark, sf), FEATURES, "episode_index"))


@query(f"WITH {X_SQL} SELECT feature, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.1), 6) AS q10, round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.9), 6) AS q90, round(quantile_cont(x, 0.99), 6) AS q99 FROM x GROUP BY feature")
def stats_rank_quantiles(spark, sf):
    rows = statistics.components(_items(spark, sf), FEATURES, [])
    out = statistics.rank_quantiles(rows, ["feature"])
    return out.select("feature", *(F.round(q, 6).alias(q) for q in ("q01", "q10", "q50", "q90", "q99")))


@query(f"WITH y AS (SELECT label AS camera, i - 1 AS component, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)) SELECT camera, 'vector' AS feature, CAST(component AS INT) AS component, {STATS_SQL.replace('min(x)', 'round(min(x), 6)').replace('max(x)', 'round(max(x), 6)')} FROM y GROUP BY camera, component")
def stats_vector(spark, sf):
    rows = statistics.feature_stats(A.vectors(spark, sf), ["vector"], "camera").where("camera IS NOT NULL")
    return _rounded(rows).withColumn("min", F.round("min", 6)).withColumn("max", F.round("max", 6))


@query("""WITH h AS (SELECT l_returnflag AS camera, CAST(floor(l_quantity * 5) AS INT) % 256 AS v FROM lineitem)
SELECT camera, min(v) / 255 AS min, max(v) / 255 AS max, round(avg(v / 255), 6) AS mean, round(stddev_pop(v / 255), 6) AS std, count(*) AS count, round(quantile_cont(v / 255, 0.01), 6) AS q01, round(quantile_cont(v / 255, 0.1), 6) AS q10,
round(quantile_cont(v / 255, 0.5), 6) AS q50, round(quantile_cont(v / 255, 0.9), 6) AS q90, round(quantile_cont(v / 255, 0.99), 6) AS q99 FROM h GROUP BY camera""")
def stats_histogram_quantiles(spark, sf):
    rows = A.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("camera"), (F.floor(F.col("l_quantity") * 5) % 256).alias("v"))
    bins = statistics.histogram(rows, ["camera"], "v")
    return _rounded(statistics.histogram_stats(bins, ["camera"]))


@query(f"""WITH {X_SQL}, t AS (SELECT feature, min(x) AS mn, max(x) AS mx FROM x GROUP BY feature)
SELECT feature, 'max' AS metric, round(mx * 1.001, 6) AS published, round(mx, 6) AS actual FROM t WHERE feature = 'l_quantity' UNION ALL SELECT feature, 'min', NULL, round(mn, 6) FROM t WHERE feature = 'l_tax'""")
def stats_compare_tolerance(spark, sf):
    actual = statistics.feature_stats(_items(spark, sf), FEATURES)
    changed = F.when(F.col("feature") == "l_quantity", F.col("max") * 1.001).otherwise(F.col("max"))
    lost = F.when(F.col("feature") != "l_tax", F.col("min"))
    published = actual.withColumn("max", changed).withColumn("min", lost).withColumn("mean", F.col("mean") + 1e-9)
    out = statistics.compare_stats(published, actual, ["feature"])
    return out.select("feature", "metric", F.round("published", 6).alias("published"), F.round("actual", 6).alias("actual"))


@query(f"WITH {X_SQL}, t AS (SELECT DISTINCT feature FROM x) SELECT feature, CASE feature WHEN 'l_quantity' THEN 'quantile_order' WHEN 'l_tax' THEN 'mean_range' WHEN 'l_discount' THEN 'negative_std' ELSE '' END AS issues FROM t")
def stats_issue_rules(spark, sf):
    s = statistics.feature_stats(_items(spark, sf), FEATURES)
    bad = s.withColumn("q10", F.when(F.col("feature") == "l_quantity", F.col("q90") + 1).otherwise(F.col("q10")))
    bad = bad.withColumn("mean", F.when(F.col("feature") == "l_tax", F.col("max") + 1).otherwise(F.col("mean"))).withColumn("std", F.when(F.col("feature") == "l_discount", -F.col("std")).otherwise(F.col("std")))
    return statistics.stats_issues(bad, ["feature"]).select("feature", F.array_join("issues", ",").alias("issues"))


# --- sampling ------------------------------------------------------------------------------------

N_SQL = "n AS (SELECT user_id AS episode_index, count(*) AS n FROM events GROUP BY user_id)"
K_SQL = f"{N_SQL}, k AS (SELECT *, least(n, 12, greatest(2, CAST(round_even((n - 1) / 10.0 * 2.0, 0) AS BIGINT) + 1)) AS k FROM n)"
U_SQL = f"{K_SQL}, u AS MATERIALIZED (SELECT *, list_transform(range(0, k), lambda p: CAST(round_even(p * (n - 1) / (k - 1)::DOUBLE, 0) AS BIGINT)) AS grid FROM k)"
D_SQL = f"""{U_SQL}, sh AS MATERIALIZED (SELECT *, CASE WHEN k = n OR k <= 2 THEN grid ELSE list_transform(range(0, k), lambda p: least(n - k, greatest(0, list_max(list_transform(range(0, p + 1), lambda q:
CASE WHEN q = 0 THEN 0 WHEN q = k - 1 THEN n - 1 ELSE CAST(round_even((q + 0.5) * (n - 1) / (k - 1)::DOUBLE, 0) AS BIGINT) END - q)))) + p) END AS second FROM u)"""


def _lengths(spark, sf):
    return A.table(spark, sf, "events").groupBy(F.col("user_id").alias("episode_index")).agg(F.count("*").alias("n"))


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",")


def _grids(spark, sf):
    return _lengths(spark, sf).select("episode_index", "n", sampling.uniform_indices("n", FPS, 2.0, 12).alias("first"), sampling.shifted_indices("n", FPS, 2.0, 12).alias("second"))


@query(f"WITH {U_SQL} SELECT episode_index, array_to_string(grid, ',') AS frames FROM u")
def uniform_indices(spark, sf):
    return _grids(spark, sf).select("episode_index", _joined("first").alias("frames"))


@query(f"WITH {D_SQL} SELECT episode_index, array_to_string(second, ',') AS frames FROM sh")
def coarse_pass_shifted(spark, sf):
    return _grids(spark, sf).select("episode_index", _joined("second").alias("frames"))


@query(f"WITH {D_SQL} SELECT episode_index, array_to_string(list_sort(list_distinct(list_concat(grid, second))), ',') AS frames FROM sh")
def grid_union(spark, sf):
    return _grids(spark, sf).withColumn("u", F.array_sort(F.array_union("first", "second"))).select("episode_index", _joined("u").alias("frames"))


@query(f"WITH {D_SQL} SELECT episode_index, array_to_string(list_sort(list_filter(second, lambda x: NOT list_contains(grid, x))), ',') AS frames, len(list_filter(second, lambda x: NOT list_contains(grid, x))) >= (least(greatest(k - 2, 0), greatest(n - k, 0)) + 1) // 2 AS independent FROM sh")
def grid_difference(spark, sf):
    rows = _grids(spark, sf).withColumn("d", F.array_sort(F.array_except("second", "first")))
    return rows.select("episode_index", _joined("d").alias("frames"), sampling.independent("first", "second", "n").alias("independent"))


W_SQL = f"{N_SQL}, w AS (SELECT *, episode_index % n AS c, greatest(0, episode_index % n - 7) AS lo, least(n - 1, episode_index % n + 7) AS hi FROM n)"


@query(f"WITH {W_SQL} SELECT episode_index, array_to_string(list_sort(list_distinct(list_concat(range(lo, hi + 1, 3), [c]))), ',') AS frames FROM w")
def window_indices(spark, sf):
    rows = _lengths(spark, sf).withColumn("w", sampling.window_indices(F.col("episode_index") % F.col("n"), 7, 3, "n"))
    return rows.select("episode_index", _joined("w").alias("frames"))


@query(f"WITH {W_SQL} SELECT episode_index, array_to_string(list_sort(list_distinct(list_concat(range(lo, hi + 1, 3), [c, lo, hi]))), ',') AS frames FROM w")
def evidence_indices(spark, sf):
    rows = _lengths(spark, sf).withColumn("w", sampling.evidence_indices(F.col("episode_index") % F.col("n"), 7, 3, "n"))
    return rows.select("episode_index", _joined("w").alias("frames"))


@query("SELECT n_nationkey AS camera_order, CAST(round_even(2.5 * (n_nationkey + 5), 0) AS BIGINT) AS radius, greatest(1, CAST(round_even((n_nationkey + 5) / 8.0, 0) AS BIGINT)) AS stride, CAST(round_even(0.5 * (n_nationkey + 5), 0) AS BIGINT) AS dense_radius, abs(10 + n_nationkey * 0.003::DOUBLE - 10.03::DOUBLE) <= 0.01 AS fps_ok FROM nation")
def window_parameters(spark, sf):
    rows = A.cameras(spark, sf).withColumn("p", sampling.window_parameters(F.col("camera_order").cast("double") + 5))
    kind = dict(A.table(spark, sf, "nation").dtypes)["n_nationkey"]
    return rows.select(F.col("camera_order").cast(kind).alias("camera_order"), "p.radius", "p.stride", "p.dense_radius", sampling.fps_matches(10 + F.col("camera_order") * 0.003, 10.03).alias("fps_ok"))


@query("SELECT event_id, least(99, greatest(0, CAST(floor(value * 3.0 + 0.5) AS BIGINT))) AS frame, CAST(floor(event_id / 7) AS BIGINT) AS chunk, event_id / 10.0::DOUBLE AS seconds FROM events")
def frame_times(spark, sf):
    return A.table(spark, sf, "events").select("event_id", B.frame_from_time("value", 3.0, 100).cast("long").alias("frame"), B.episode_chunk("event_id", 7).alias("chunk"), B.timestamp_seconds("event_id", FPS).alias("seconds"))


@query(f"""WITH {G_SQL}, q AS (SELECT episode_index, length, boundaries, episode_index % length AS x FROM g)
SELECT episode_index, array_to_string(CASE WHEN x > 0 THEN list_sort(list_distinct(list_concat(boundaries, [x]))) ELSE boundaries END, ',') AS inserted,
array_to_string(list_filter(boundaries, lambda v, i: i <> list_position(list_transform(boundaries, lambda y: abs(y - x)), list_min(list_transform(boundaries, lambda y: abs(y - x))))), ',') AS removed FROM q WHERE len(boundaries) > 0""")
def boundary_edits(spark, sf):
    rows = _golden(spark, sf).where("size(boundaries) > 0").withColumn("x", F.col("episode_index") % F.col("length"))
    rows = rows.withColumn("i", B.insert_boundary("boundaries", "x", "length")).withColumn("r", B.remove_nearest_boundary("boundaries", "x"))
    return rows.select("episode_index", _joined("i").alias("inserted"), _joined("r").alias("removed"))


# --- subsets and payload -------------------------------------------------------------------------

R_SQL = """l AS (SELECT l_orderkey AS episode_index, count(*) AS length FROM lineitem GROUP BY l_orderkey),
r AS MATERIALIZED (SELECT episode_index AS source_index, row_number() OVER (ORDER BY episode_index) - 1 AS output_index, length, CAST(coalesce(sum(length) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS global_offset
FROM l JOIN orders ON o_orderkey = episode_index WHERE o_orderstatus = 'F')"""


def _remap(spark, sf):
    return reindex.remap(A.order_records(spark, sf), A.item_lengths(spark, sf))


@query(f"WITH {R_SQL} SELECT * FROM r")
def subset_remap(spark, sf):
    return _remap(spark, sf)


@query("SELECT l_orderkey AS episode_index, count(*) AS length, row_number() OVER (ORDER BY l_orderkey) - 1 AS output_index, CAST(coalesce(sum(count(*)) OVER (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS global_offset FROM lineitem GROUP BY l_orderkey")
def running_offsets(spark, sf):
    return reindex.running_offsets(A.item_lengths(spark, sf))


@query(f"WITH {I_SQL}, {R_SQL} SELECT output_index AS episode_index, global_offset + frame_index AS \"index\", frame_index, l_quantity FROM i JOIN r ON episode_index = source_index")
def reindexed_frames(spark, sf):
    frames = A.item_frames(spark, sf).select("episode_index", "frame_index", "l_quantity")
    return reindex.reindex_frames(frames, _remap(spark, sf))


@query(f"WITH {R_SQL} SELECT output_index, output_index // 50 AS episode_chunk, printf('data/chunk-%03d/episode_%06d.parquet', output_index // 50, output_index) AS path FROM r")
def chunk_paths(spark, sf):
    return reindex.chunk_paths(_remap(spark, sf), 50)


@query(f"WITH {F_SQL}, x AS (SELECT episode_index, frame_index FROM f WHERE NOT (episode_index % 5 = 0 AND frame_index = 7)) SELECT episode_index, count(*) AS frames, min(frame_index) = 0 AND max(frame_index) = count(*) - 1 AS contiguous FROM x GROUP BY episode_index")
def frame_contiguity_check(spark, sf):
    return reindex.frame_contiguity(A.event_frames(spark, sf).where("NOT (episode_index % 5 = 0 AND frame_index = 7)"))


@query(f"WITH {F_SQL}, x AS (SELECT episode_index, value <= lag(value) OVER (PARTITION BY episode_index ORDER BY frame_index) AS bad FROM f) SELECT episode_index, count(*) FILTER (WHERE bad) AS breaks FROM x GROUP BY episode_index")
def timestamp_monotonic_check(spark, sf):
    return reindex.timestamp_order(A.event_frames(spark, sf), "value")


@query("""WITH s AS (SELECT n_name AS split, 10 * (row_number() OVER (ORDER BY n_nationkey) - 1) + CASE WHEN n_nationkey % 5 = 1 THEN 2 WHEN n_nationkey % 5 = 3 THEN -2 ELSE 0 END AS first, 10 * row_number() OVER (ORDER BY n_nationkey) - CASE WHEN n_nationkey % 7 = 6 THEN 1 ELSE 0 END AS last FROM nation),
o AS (SELECT *, coalesce(lag(last) OVER w, 0) AS before, lead(first) OVER w IS NULL AS at_end FROM s WINDOW w AS (ORDER BY first, last)), n AS (SELECT 10 * count(*) + 3 AS total FROM nation)
SELECT 'overlap' AS issue, split FROM o WHERE before > first UNION ALL SELECT 'gap', split FROM o WHERE before < first UNION ALL SELECT 'gap_at_end', split FROM o, n WHERE at_end AND last < total""")
def splits_coverage(spark, sf):
    k = F.col("n_nationkey")
    rows = A.table(spark, sf, "nation").select(F.col("n_name").alias("split"), k, (F.row_number().over(Window.orderBy(k)) - 1).alias("r"))  # a few nations
    first = 10 * F.col("r") + F.when(k % 5 == 1, 2).when(k % 5 == 3, -2).otherwise(0)
    splits = rows.select("split", first.cast("long").alias("first"), (10 * F.col("r") + 10 - F.when(k % 7 == 6, 1).otherwise(0)).cast("long").alias("last"))
    return reindex.split_coverage(splits, 10 * rows.count() + 3)


@query("SELECT o_orderkey AS episode_index, 'missing' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'unexpected' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def payload_set_diff(spark, sf):
    return reindex.set_difference(A.order_records(spark, sf).select("episode_index"), A.item_lengths(spark, sf).select("episode_index"), "episode_index")


@query("SELECT concat_ws('/', source, doc_id) AS path, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'changed' END AS difference FROM documents WHERE doc_id % 11 = 0 OR doc_id % 7 = 0")
def payload_digest_diff(spark, sf):
    files = A.payload(spark, sf).select("path", "doc_id", text.digest("text").alias("digest"))
    actual = files.where("doc_id % 11 <> 0").withColumn("digest", F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.col("digest")))
    return reindex.digest_difference(files, actual)


@query("SELECT n_nationkey AS camera_order, r_name AS task FROM nation LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 3 OR r_regionkey IS NULL")
def task_semi_anti(spark, sf):
    known = A.tasks(spark, sf)
    rows = A.table(spark, sf, "nation").select(F.col("n_nationkey").alias("camera_order"), F.col("n_regionkey").cast("long").alias("task_index"))
    held = rows.join(F.broadcast(known), "task_index", "left")
    return held.join(F.broadcast(known.where("task_index = 3")), "task_index", "left_anti").select("camera_order", "task")


@query("SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def duplicate_payloads(spark, sf):
    return reindex.duplicates(A.payload(spark, sf).where("text IS NOT NULL"), "text")


# --- workspace -----------------------------------------------------------------------------------

ST_SQL = "st AS (SELECT o_orderkey AS episode_index, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'needs_review' ELSE 'pending' END AS status, o_orderdate AS updated_at FROM orders)"


@query(f"WITH {ST_SQL}, k(status) AS (VALUES ('pending'), ('coarse_done'), ('refine_done'), ('accepted'), ('needs_review'), ('failed')) SELECT k.status, count(episode_index) AS n FROM k LEFT JOIN st ON st.status = k.status GROUP BY k.status")
def workspace_summary(spark, sf):
    return workspace.summary(A.order_records(spark, sf))


@query("SELECT CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'accepted' ELSE 'needs_review' END AS status, count(*) AS n FROM labels GROUP BY 1")
def status_counts(spark, sf):
    return workspace.status_counts(A.review_outcomes(spark, sf))


@query(f"WITH {ST_SQL} SELECT episode_index, status FROM st WHERE status IN ('pending', 'coarse_done', 'refine_done')")
def resumable_selection(spark, sf):
    return workspace.resumable(A.order_records(spark, sf)).select("episode_index", "status")


T_SQL = f"""{F_SQL}, t AS MATERIALIZED (SELECT episode_index, lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, ts, frame_index, frame_index >= 3 AND (episode_index % 4 = 0 OR frame_index % 3 <> 0) AS human,
CASE WHEN episode_index % 9 = 0 AND frame_index = 1 THEN 'pending' ELSE ['pending', 'coarse_done', 'refine_done', 'accepted'][least(frame_index, 3) + 1] END AS from_status, ['coarse_done', 'refine_done', 'accepted'][least(frame_index, 2) + 1] AS to_status FROM f)"""


@query(f"WITH {T_SQL} SELECT episode_index, event_id, from_status, to_status, human FROM t")
def transition_list(spark, sf):
    return transition_rows(spark, sf).drop("timestamp")


def transition_rows(spark, sf):
    """All events of a user as transitions: on to accepted, then audits of it by a human or, wrongly, by none."""
    rows = A.event_frames(spark, sf)
    i, e = F.col("frame_index").cast("int"), F.col("episode_index")
    chain = F.array(*map(F.lit, ["pending", "coarse_done", "refine_done", "accepted"]))
    source = F.when((e % 9 == 0) & (i == 1), "pending").otherwise(F.get(chain, F.least(i, F.lit(3))))
    human = (i >= 3) & ((e % 4 == 0) | (i % 3 != 0))
    return rows.select("episode_index", F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"), "timestamp", source.alias("from_status"), F.get(chain, F.least(i + 1, F.lit(3))).alias("to_status"), human.alias("human"))


@query(f"""WITH {T_SQL} SELECT episode_index, event_id, 'broken_chain' AS issue FROM t WHERE episode_index % 9 = 0 AND frame_index = 1
UNION ALL SELECT episode_index, event_id, 'illegal_edge' FROM t WHERE (episode_index % 9 = 0 AND frame_index = 1) OR (frame_index >= 3 AND NOT human)
UNION ALL SELECT episode_index, event_id, 'time_not_increasing' FROM (SELECT *, lag(ts) OVER (PARTITION BY episode_index ORDER BY frame_index) >= ts AS bad FROM t) WHERE bad""")
def transition_chain_check(spark, sf):
    return workspace.chain_issues(transition_rows(spark, sf))


@query(f"WITH {T_SQL} SELECT episode_index, count(*) AS events, arg_min(to_status, frame_index) AS first_status, arg_max(to_status, frame_index) AS last_status FROM t GROUP BY episode_index")
def first_last_event(spark, sf):
    return workspace.first_last(transition_rows(spark, sf))


@query(f"WITH {F_SQL} SELECT episode_index, label FROM (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index DESC) AS k FROM f) WHERE k = 1")
def latest_state(spark, sf):
    return workspace.latest(A.event_frames(spark, sf), "label", "frame_index")


@query(f"WITH {F_SQL}, c AS (SELECT *, CAST(floor(value) AS BIGINT) AS now FROM f) SELECT episode_index, frame_index AS seq, max(now - frame_index - 1) OVER (PARTITION BY episode_index ORDER BY frame_index) + frame_index + 1 AS time FROM c")
def monotone_clock(spark, sf):
    rows = A.event_frames(spark, sf).select("episode_index", F.col("frame_index").alias("seq"), F.floor("value").cast("long").alias("now"))
    return workspace.monotone_clock(rows).select("episode_index", "seq", F.col("time").cast("long").alias("time"))


@query("""SELECT coalesce(o_orderkey, k) AS episode_index, coalesce(CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'needs_review' WHEN 'P' THEN 'pending' END, 'pending') AS status,
CASE WHEN k IS NULL THEN 'orphan_record' WHEN o_orderkey IS NULL THEN 'create' ELSE 'keep' END AS action FROM (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) o FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o_orderkey = k""")
def workspace_initialise(spark, sf):
    return workspace.initialise(A.item_lengths(spark, sf), A.order_records(spark, sf).where("episode_index % 5 <> 0"))


@query("SELECT o_orderkey AS episode_index FROM orders WHERE o_orderkey % 3 = 0 OR (o_orderkey % 4 = 0 AND o_orderstatus <> 'F')")
def stale_writes(spark, sf):
    now = A.order_records(spark, sf)
    e = F.col("episode_index")
    expected = now.withColumn("updated_at", F.when(e % 3 == 0, F.col("updated_at") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("updated_at"))).withColumn("status", F.when(e % 4 == 0, "accepted").otherwise(F.col("status")))
    return workspace.conflicts(now, expected)


@query(f"""WITH {ST_SQL} SELECT episode_index, CASE WHEN episode_index % 3 <> 0 THEN status WHEN episode_index % 6 = 0 THEN status WHEN status = 'needs_review' OR episode_index % 5 = 0 THEN 'accepted' ELSE status END AS status,
CASE WHEN episode_index % 3 <> 0 THEN NULL WHEN episode_index % 6 = 0 THEN 'stale' WHEN status <> 'needs_review' AND episode_index % 5 <> 0 THEN 'takeover_required' ELSE 'applied' END AS outcome FROM st""")
def manual_decisions(spark, sf):
    r = A.order_records(spark, sf).withColumn("final_annotation", F.lit(None).cast("array<int>")).withColumn("decision_source", F.lit(None).cast("string"))
    e = F.col("episode_index")
    d = r.where(e % 3 == 0).select("episode_index", F.col("status").alias("expected_status"), F.when(e % 6 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("updated_at")).alias("expected_updated_at"), F.array(F.lit(1)).alias("annotation"), (e % 5 == 0).alias("takeover"), F.lit("2020-01-01 00:00:00").cast("timestamp").alias("decided_at"))
    return review.apply_decision(r, d).select("episode_index", "status", "outcome")


# --- review --------------------------------------------------------------------------------------


@query(f"""WITH {G_SQL}, c AS (SELECT a.episode_index, list_sort(list_distinct(list_filter(list_concat(gb, coalesce(pb, []::BIGINT[])), lambda x: x >= 0 AND x < length))) AS fr FROM a JOIN n USING (episode_index))
SELECT episode_index, array_to_string(fr[1:4], ',') AS frames, CAST(greatest(len(fr) - 4, 0) AS INT) AS omitted FROM c""")
def review_candidates(spark, sf):
    rows = _aligned(spark, sf).join(_golden(spark, sf).select("episode_index", "length"), "episode_index")
    rows = rows.withColumn("c", review.candidate_frames("length", "golden_boundaries", "predicted_boundaries", cap=4))
    return rows.select("episode_index", F.array_join(F.col("c.frames").cast("array<string>"), ",").alias("frames"), "c.omitted")


@query(f"WITH {F_SQL} SELECT episode_index, frame_index FROM (SELECT *, sum(1 + frame_index % 4) OVER (PARTITION BY episode_index ORDER BY frame_index) AS total FROM f) WHERE total <= 20")
def review_image_budget(spark, sf):
    rows = A.event_frames(spark, sf).select("episode_index", "frame_index", (1 + F.col("frame_index") % 4).alias("cost"))
    return review.within_budget(rows, "episode_index", "frame_index", "cost", 20).select("episode_index", "frame_index")


@query(f"WITH {G_SQL} SELECT episode_index, array_to_string(coalesce(CASE WHEN status = 'accepted' THEN pb END, gb), ',') AS boundaries FROM a")
def candidate_coalesce(spark, sf):
    rows = _aligned(spark, sf).withColumn("final", F.when(F.col("status") == "accepted", F.col("predicted_boundaries")))
    return rows.withColumn("c", review.candidate_annotation("final", "golden_boundaries")).select("episode_index", _joined("c").alias("boundaries"))


@query(f"WITH {ST_SQL}, c AS (SELECT count(*) AS n FROM nation) SELECT episode_index, n_name AS camera FROM (SELECT episode_index, c.n FROM st, c WHERE status = 'needs_review') CROSS JOIN nation WHERE n <= 512")
def review_evidence(spark, sf):
    rows = workspace.review_queue(A.order_records(spark, sf))
    rows = rows.select("episode_index", F.struct(F.array(F.lit(0).cast("long")).alias("frames")).alias("candidates"))
    return review.evidence(rows, A.cameras(spark, sf)).select("episode_index", "camera")


# --- text ----------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def text_sha256(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", text.digest("text").alias("digest"))


@query("SELECT source, sha256(string_agg(concat_ws('/', source, doc_id) || chr(0) || sha256(text) || chr(10), '' ORDER BY concat_ws('/', source, doc_id))) AS rollup, count(*) AS files, round(sum(strlen(text)) / 1048576.0, 9) AS megabytes FROM documents GROUP BY source")
def checksum_rollup(spark, sf):
    rows = A.table(spark, sf, "documents").select("source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), text.digest("text").alias("digest"), F.octet_length("text").alias("bytes"))
    sizes = rows.groupBy("source").agg(F.count("*").alias("files"), F.round(text.payload_megabytes("bytes"), 9).alias("megabytes"))
    return reindex.digest_rollup(rows, "source", "path", "digest").join(sizes, "source").select("source", "rollup", "files", "megabytes")


@query(r"SELECT doc_id, length(text) > 0 AND NOT regexp_matches(text, '^\s|\s$') AND text <> lang AND regexp_matches(text, '[A-Za-z]') AND NOT regexp_matches(text, '[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}]') AS valid FROM documents")
def augmented_text_valid(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", text.valid_paraphrase("text", "lang").alias("valid"))


@query("SELECT page_id, left(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 40) || '-' || left(sha256(url), 8) AS slug FROM pages")
def camera_slug(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", text.camera_slug("url").alias("slug"))


@query("SELECT doc_id, '<redacted chars=' || length(text) || '; sha256=' || left(sha256(text), 16) || '>' AS excerpt FROM documents")
def redact_excerpt(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", text.redacted("text").alias("excerpt"))


@query("SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^?#]*') AS endpoint FROM pages")
def redact_endpoint(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", text.redacted_endpoint("url").alias("endpoint"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_extract(spark, sf):
    return A.table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT event_id, true AS strict, replace(props, ' ', '') AS canonical, sha256(replace(props, ' ', '')) AS fingerprint FROM events")
def canonical_json_fingerprint(spark, sf):
    rows = A.table(spark, sf, "events").select("event_id", "props")
    rows = rows.select("event_id", jsontext.strict_json_ok(F.col("props"), ["k"]).alias("strict"), jsontext.canonical_json(F.col("props")).alias("canonical"))
    return rows.withColumn("fingerprint", text.digest("canonical"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey // 2 END AS first, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS last FROM orders")
def split_ranges(spark, sf):
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, F.concat(F.floor(k / 2).cast("string"), F.lit(":"), k.cast("string"))).when(k % 3 == 1, F.concat(k.cast("string"), F.lit(":"))).otherwise(F.lit("a:b"))
    return A.table(spark, sf, "orders").select("o_orderkey", text.split_range(said).alias("r")).select("o_orderkey", "r.first", "r.last")
