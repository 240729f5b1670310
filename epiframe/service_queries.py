"""Queries that reach sources, sinks, plans and streams: a run over the driver's tables (``demo``), with the same in DuckDB's SQL."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import adapters as A
from . import config as configuration
from .demo import FPS, REVISION, Demo, demo, no_sleep, paraphrase
from .functions import boundaries as B
from .functions import jsontext, rules, sampling, text
from .operators import audit, evaluation, release_checks, review, workspace
from .plans import annotate as annotation
from .plans import evaluate, models, release, review_files, review_server, store
from .queries import FPS as EVENT_FPS
from .queries import G_SQL, _golden, query, transition_rows
from .schemas import METRICS, STATUSES
from .sources import dataset, media, sinks
from .sources.model import Client, InvalidModelResponse, Malformed, ModelCallError, ModelOutOfMemory, Transient
from .streaming import state

#: Episodes e of the demo, their cameras and frames; materialised as in ``queries``.
EP = """ep AS MATERIALIZED (SELECT e, c_nationkey, length, length // 3 AS b1, 2 * length // 3 AS b2, CASE WHEN e % 7 = 3 THEN 'failed' WHEN e % 5 = 1 THEN 'needs_review' ELSE 'accepted' END AS status
FROM (SELECT row_number() OVER (ORDER BY c_nationkey) - 1 AS e, c_nationkey, count(*) AS length FROM customer GROUP BY c_nationkey)),
cam AS MATERIALIZED (SELECT replace(r_name, ' ', '_') AS camera, CAST(r_regionkey AS BIGINT) AS c FROM region),
fr AS MATERIALIZED (SELECT e, row_number() OVER (PARTITION BY e ORDER BY c_custkey) - 1 AS frame_index, CAST(c_acctbal AS DOUBLE) AS x, CAST(c_custkey % 7 AS DOUBLE) AS y FROM customer JOIN ep USING (c_nationkey)),
out AS MATERIALIZED (SELECT e, row_number() OVER (ORDER BY e) - 1 AS o, length, b1, b2, CAST(coalesce(sum(length) OVER (ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM ep WHERE status = 'accepted')"""


def _rounded(df: DataFrame, names: tuple = ("min", "max", "mean", "std", "q01", "q10", "q50", "q90", "q99")) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c in names else c for c in df.columns))


STATS_SQL = "round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, count(x) AS count, " + ", ".join(f"round(quantile_cont(x, {p}), 6) AS {q}" for q, p in (("q01", 0.01), ("q10", 0.1), ("q50", 0.5), ("q90", 0.9), ("q99", 0.99)))

# --- sources -------------------------------------------------------------------------------------


@query(f"WITH {EP} SELECT 'video' AS \"check\", e || '/' || camera AS subject FROM ep, cam WHERE e % 6 = 0 AND c = 0 UNION ALL SELECT 'camera', 'side' UNION ALL SELECT 'total', 'total_tasks'")
def dataset_inspection(spark, sf):
    d = demo(spark, sf)
    root = f"{d.folder()}/source"
    shutil.copytree(d.source, root)
    sinks.write_json(f"{root}/meta/info.json", d.info | {"total_tasks": 2})
    _, _, bad = dataset.inspect(spark, root, [d.cameras[0], "side"], d.prober(lambda e, c: int(e % 6 == 0 and c == 0)))
    return bad.select("check", "subject")


@query(f"WITH {EP} SELECT e AS episode_index, length, 'stack' AS task, printf('data/chunk-%03d/episode_%06d.parquet', e // 10, e) AS parquet FROM ep")
def dataset_episodes(spark, sf):
    return demo(spark, sf).episodes().select("episode_index", "length", "task", "parquet")


@query(f"WITH {EP} SELECT e AS episode_index, length, e % 9 = 4 AS bad FROM ep")
def jsonl_lines(spark, sf):
    d = demo(spark, sf)
    path = f"{d.folder()}/lines.jsonl"
    lines = [json.dumps({"episode_index": e, "length": n if e % 9 != 4 else "x"}) for e, n in d.lengths.items()]
    sinks.write_text(path, "\n".join(lines) + "\n")
    rows = dataset.jsonl_table(spark, path, "episode_index long, length long")
    return rows.join(d.lengths_table().withColumnRenamed("length", "n"), "episode_index").select("episode_index", F.coalesce("length", "n").alias("length"), "bad")


@query(f"WITH {EP} SELECT c, camera FROM cam UNION ALL SELECT -1, 'action' UNION ALL SELECT -1, 'frame_index'")
def dataset_features(spark, sf):
    info = dataset.read_json(spark, f"{demo(spark, sf).source}/meta/info.json")
    keys = dataset.camera_keys(info)
    return spark.createDataFrame([(keys.index(n) if n in keys else -1, n) for n, _, _ in dataset.features(info)], "c long, camera string")


@query(f"WITH {EP} SELECT printf('data/chunk-%03d/episode_%06d.parquet', e // 10, e) AS parquet, length AS rows FROM ep")
def parquet_row_counts(spark, sf):
    d = demo(spark, sf)
    return dataset.parquet_rows(spark, d.source, d.episodes())


@query(f"WITH {EP} SELECT e AS episode_index, camera, length + CAST(e % 4 = c AS INT) AS frames, 10.0::DOUBLE AS fps, printf('videos/chunk-%03d/%s/episode_%06d.mp4', e // 10, camera, e) AS path FROM ep, cam")
def video_probes(spark, sf):
    d = demo(spark, sf)
    seen = dataset.probe_videos(dataset.video_table(d.episodes(), d.info), d.source, d.prober(lambda e, c: int(e % 4 == c)))
    return seen.select("episode_index", "camera", "frames", "fps", "path")


@query(f"""WITH {EP}, w AS (SELECT e, unnest(list_sort(list_distinct(list_concat(range(greatest(0, b1 - 5), least(length - 1, b1 + 5) + 1, 2), [b1, greatest(0, b1 - 5), least(length - 1, b1 + 5)])))) AS f FROM ep)
SELECT e AS episode_index, f AS frame_index, sha256(printf('%s %d %.3fs', camera, f, f / 10.0::DOUBLE)) AS digest, f / 10.0::DOUBLE AS seconds FROM w, cam WHERE c = 0""")
def frame_extraction(spark, sf):
    d = demo(spark, sf)
    decode, camera, root = d.decoder(), d.cameras[0], d.source
    videos = dataset.video_table(d.episodes(), d.info).where(F.col("camera") == camera)
    asked = videos.select("episode_index", "path", sampling.evidence_indices(F.floor(F.col("length") / 3), 5, 2, "length").alias("frames"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for e, path, frames in zip(p.episode_index, p.path, p.frames, strict=True):
                wanted = [int(f) for f in frames]
                got = media.extract_frames(f"{root}/{path}", camera, wanted, FPS, decode, lambda frame, label: label.encode())
                media.check_samples(got, wanted, camera, FPS)
                out += [(int(e), s.frame_index, s.jpeg, s.timestamp_seconds) for s in got]
            yield pd.DataFrame(out, columns=["episode_index", "frame_index", "jpeg", "seconds"])

    got = asked.mapInPandas(run, "episode_index long, frame_index long, jpeg binary, seconds double")
    return got.select("episode_index", "frame_index", F.sha2("jpeg", 256).alias("digest"), "seconds")


@query(f"""WITH {EP}, v AS (SELECT camera AS feature, CAST(k AS INT) AS component, ((frame_index * 3 + e * 5 + c * 11 + k) % 256) / 255.0::DOUBLE AS x FROM fr, cam, range(3) r(k), range(4) p(q))
SELECT feature, component, {STATS_SQL} FROM v GROUP BY feature, component""")
def video_statistics(spark, sf):
    d = demo(spark, sf)
    return _rounded(release.video_stats(spark, d.source, d.info, d.decoder()).select("feature", "component", *METRICS))


CONFIG_TEXT = (
    '{"high_level_instruction":"stack","mode":"complete","model":{"endpoint":"http://127.0.0.1:8000/v1","name":"local-vision-model","revision":null},"primary_camera":"top","refine_cameras":["wrist"],'
    '"sampling":{"agreement_tolerance_frames":12,"coarse_fps":1.0,"coarse_max_frames":64,"dense_radius_seconds":0.5,"min_segment_frames":8,"refine_fps":8.0,"refine_window_seconds":2.5},'
    '"source":"s","subtasks":[{"skill":"a","text":"do a"}],"work_dir":"w"}'
)


@query(f"""WITH h AS (SELECT sha256('{CONFIG_TEXT}') AS config_hash)
SELECT config_hash, sha256('{{"config_hash":"' || config_hash || '","model_repo":"local-vision-model","model_revision":"{REVISION}","prompt_version":"epiframe-2"}}') AS run_fingerprint FROM h""")
def config_fingerprints(spark, sf):
    c = configuration.parse({"source": "s", "work_dir": "w", "mode": "complete", "high_level_instruction": "stack", "primary_camera": "top", "refine_cameras": ["wrist"], "subtasks": [{"skill": "a", "text": "do a"}], "model": {"api_key": "k"}})
    return spark.createDataFrame([(c.stable_hash(), store.run_fingerprint(c, REVISION))], "config_hash string, run_fingerprint string")


# --- annotation and the work folder --------------------------------------------------------------

REASON = "CASE status WHEN 'needs_review' THEN 'refine_boundary_disagreement' ELSE '' END"


@query(f"WITH {EP} SELECT e AS episode_index, status, {REASON} AS reasons, CASE status WHEN 'failed' THEN 'invalid_model_response' END AS failure, CASE status WHEN 'accepted' THEN b1 || ',' || b2 END AS boundaries FROM ep")
def annotation_results(spark, sf):
    d = demo(spark, sf)
    got = d.results(d.fresh_store(f"work-{uuid.uuid4().hex}"))
    return got.select("episode_index", "status", F.array_join("reasons", ",").alias("reasons"), F.col("failure_category").alias("failure"), F.array_join(F.col("boundaries").cast("array<string>"), ",").alias("boundaries"))


@query(f"""WITH {EP}, n AS (SELECT *, least(length, 64, greatest(2, CAST(round_even((length - 1) / 10.0, 0) AS BIGINT) + 1)) AS k FROM ep WHERE status <> 'failed')
SELECT e AS episode_index, array_to_string(list_transform(range(0, k), lambda p: CAST(round_even(p * (length - 1) / (k - 1)::DOUBLE, 0) AS BIGINT)), ',') AS grid, b1 || ',' || b2 AS centers, 0 AS first_seen FROM n""")
def coarse_decisions(spark, sf):
    r = demo(spark, sf).store.records(spark).where("status <> 'failed'")
    d = F.col("sampling_details")
    grid = F.from_json(F.get_json_object(d, "$.coarse.grids[0]"), "array<long>")
    centers = F.from_json(F.get_json_object(d, "$.coarse.centers"), "array<long>")
    return r.select("episode_index", F.array_join(grid.cast("array<string>"), ",").alias("grid"), F.array_join(centers.cast("array<string>"), ",").alias("centers"), F.get_json_object(d, "$.coarse.observed[0]").cast("int").alias("first_seen"))


@query(f"WITH {EP} SELECT e AS episode_index, status, CASE status WHEN 'accepted' THEN 'model' END AS decision_source, CASE status WHEN 'accepted' THEN 0 END AS start, CASE status WHEN 'accepted' THEN b2 END AS last_boundary FROM ep")
def workspace_records(spark, sf):
    r = demo(spark, sf).store.records(spark)
    return r.select("episode_index", "status", "decision_source", F.col("final_annotation.start_subtask_index").alias("start"), F.get("final_annotation.boundaries", F.lit(1)).cast("long").alias("last_boundary"))


STEPS = """steps AS (SELECT e, unnest(CASE status WHEN 'failed' THEN ['pending', 'failed'] WHEN 'accepted' THEN ['pending', 'coarse_done', 'refine_done', 'accepted'] ELSE ['pending', 'coarse_done', 'refine_done', 'needs_review'] END) AS s,
generate_subscripts(CASE status WHEN 'failed' THEN [1, 2] ELSE [1, 2, 3, 4] END, 1) AS i FROM ep),
log AS (SELECT e, lag(s) OVER (PARTITION BY e ORDER BY i) AS from_status, s AS to_status, i FROM steps)"""


@query(f"WITH {EP}, {STEPS} SELECT e AS episode_index, from_status, to_status, false AS bad FROM log WHERE i > 1")
def transition_log(spark, sf):
    return demo(spark, sf).store.read_log(spark).select("episode_index", "from_status", "to_status", "bad")


@query(f"WITH {EP} SELECT e AS episode_index, CASE WHEN e % 3 = 0 THEN 1 ELSE 0 END AS wrong, CASE WHEN e % 3 = 0 THEN 'last_not_record' ELSE '' END AS issue FROM ep WHERE status = 'accepted'")
def log_verification(spark, sf):
    d = demo(spark, sf)
    s = d.store_copy()
    accepted = [r.episode_index for r in s.records(spark).where("status = 'accepted'").select("episode_index").collect()]
    for e in accepted:
        if e % 3 == 0:  # as if somebody had changed the file
            r = s.load(e)
            r["transitions"][0]["reasons"] = ["x"]
            sinks.write_json(s.path(e), r | {"status": "failed", "failure_category": "x"})
    wrong = spark.createDataFrame([(e, len(s.bad_events(e))) for e in accepted], "episode_index long, wrong int")
    issues = workspace.chain_issues(s.transitions(spark), s.records(spark)).select("episode_index", "issue")
    return wrong.join(issues, "episode_index", "left").select("episode_index", "wrong", F.coalesce("issue", F.lit("")).alias("issue"))


@query(f"WITH {EP} SELECT e AS episode_index FROM ep WHERE e % 4 = 0 AND status <> 'failed'")
def decision_replay(spark, sf):
    d = demo(spark, sf)
    changed = F.when(F.col("episode_index") % 4 == 0, F.regexp_replace("sampling_details", r'"centers":\[[0-9]+', '"centers":[0')).otherwise(F.col("sampling_details"))
    rows = d.store.records(spark).withColumn("sampling_details", changed).join(d.lengths_table(), "episode_index")
    return audit.audit(rows, d.config, FPS).where(F.array_contains("issues", "coarse_centers")).select("episode_index")


@query(f"WITH {EP} SELECT 'complete' AS mode, count(*) AS episodes, CAST(sum(length) AS BIGINT) AS frames, (SELECT string_agg(camera, ',' ORDER BY c) FROM cam WHERE c < 3) AS cameras, 0::BIGINT AS other_runs FROM ep")
def run_manifest(spark, sf):
    d = demo(spark, sf)
    m, other = d.store.checked_manifest(spark, d.config)
    return spark.createDataFrame([(m["mode"], m["episodes"], m["frames"], ",".join(m["cameras"]), other.count())], "mode string, episodes long, frames long, cameras string, other_runs long")


@query(f"WITH {EP} SELECT 'episodes_total' AS issue, CAST(count(*) AS VARCHAR) AS subject FROM ep UNION ALL SELECT 'camera_repeated', camera FROM cam WHERE c = 1")
def manifest_totals(spark, sf):
    d = demo(spark, sf)
    return workspace.manifest_issues(d.lengths_table(), {"episodes": len(d.lengths) + 1, "frames": sum(d.lengths.values()), "cameras": [*d.cameras, d.cameras[1]]})


@query("""SELECT o_orderkey AS episode_index, array_to_string(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'source_fingerprint' END, CASE WHEN o_orderkey % 4 = 0 THEN 'prompt_version' END], lambda x: x IS NOT NULL), ',') AS fields
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 0""")
def provenance_check(spark, sf):
    e = F.col("episode_index")
    rows = A.order_records(spark, sf).select("episode_index", F.when(e % 3 != 0, "a").alias("source_fingerprint"), F.lit("r").alias("run_fingerprint"), F.when(e % 4 == 0, "2").otherwise("1").alias("prompt_version"))
    out = workspace.provenance_differences(rows, {"source_fingerprint": "a", "run_fingerprint": "r", "prompt_version": "1"})
    return out.select("episode_index", F.array_join("fields", ",").alias("fields"))


@query("""SELECT k AS episode_index, array_to_string(list_filter([
CASE WHEN s = 0 AND k % 4 = 0 THEN 'pending_with_results' END,
CASE WHEN (s = 1 AND k % 4 = 0) OR (s = 2 AND k % 5 = 0) THEN 'coarse_missing' END,
CASE WHEN s = 2 AND k % 5 = 0 THEN 'refine_missing' END,
CASE WHEN (s = 2 AND k % 5 = 0) OR (s = 3 AND k % 8 = 1) THEN 'annotation_missing' END,
CASE WHEN s = 3 AND k % 7 = 2 THEN 'accepted_with_reasons' END,
CASE WHEN s = 3 AND k % 5 = 0 THEN 'accepted_without_source' END,
CASE WHEN s = 3 AND k % 5 <> 0 AND k % 4 = 1 THEN 'model_without_provenance' END,
CASE WHEN s IN (4, 5) AND k % 13 = 0 THEN 'source_without_acceptance' END,
CASE WHEN s = 4 AND k % 3 = 0 THEN 'review_without_reason' END,
CASE WHEN s = 5 AND k % 4 = 0 THEN 'failure_without_category' END,
CASE WHEN s = 4 AND k % 9 = 1 THEN 'category_without_failure' END,
CASE WHEN k % 11 = 0 THEN 'time_order' END], lambda x: x IS NOT NULL), ',') AS issues FROM (SELECT o_orderkey AS k, (o_orderkey // 8) % 6 AS s FROM orders)""")
def record_state_rules(spark, sf):
    k = F.col("episode_index")
    s = F.floor(k / 8) % 6
    nothing, coarse = F.lit("{}"), F.lit('{"coarse": {"status": "coarse_done", "centers": []}}')
    audited = F.lit('{"coarse": {"status": "coarse_done", "centers": []}, "refine": {"status": "needs_review", "provenance": [], "boundaries": []}}')
    stepped = F.lit('{"coarse": {"status": "coarse_done"}, "refine": {"provenance": [{"stage": "broad"}]}}')
    details = (
        F.when(s == 0, F.when(k % 4 == 0, coarse).otherwise(nothing))
        .when(s == 1, F.when(k % 4 == 0, nothing).otherwise(coarse))
        .when(s == 2, F.when(k % 5 == 0, nothing).when(k % 5 == 1, audited).otherwise(stepped))
        .when((s == 3) & (k % 4 == 1), nothing)
        .otherwise(coarse)
    )
    annotated = ((s == 2) & (k % 5 > 1)) | ((s == 3) & (k % 8 != 1))
    empty = F.array().cast("array<string>")
    time = F.col("updated_at")
    rows = A.order_records(spark, sf).select(
        "episode_index",
        F.element_at(F.array(*map(F.lit, STATUSES)), (s + 1).cast("int")).alias("status"),
        empty.alias("coarse_attempts"),
        empty.alias("refine_attempts"),
        F.when(annotated, F.struct(F.lit(0).alias("start_subtask_index"), F.array(F.lit(3)).alias("boundaries"))).alias("final_annotation"),
        empty.alias("validation_issues"),
        F.when(((s == 3) & (k % 7 == 2)) | ((s == 4) & (k % 3 != 0)), F.array(F.lit("x"))).otherwise(empty).alias("review_reasons"),
        F.when(((s == 5) & (k % 4 != 0)) | ((s == 4) & (k % 9 == 1)), "x").alias("failure_category"),
        F.when(((s == 3) & (k % 5 != 0)) | (s.isin(4, 5) & (k % 13 == 0)), "model").alias("decision_source"),
        F.when(k % 11 == 0, time + F.expr("INTERVAL 1 DAY")).otherwise(time).alias("created_at"),
        time.alias("updated_at"),
        F.lit("1").alias("prompt_version"),
        F.lit(REVISION).alias("model_revision"),
        details.alias("sampling_details"),
    )
    return workspace.record_issues(rows).select("episode_index", F.array_join("issues", ",").alias("issues"))


@query("""WITH st AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'needs_review' ELSE 'pending' END AS status FROM orders), c AS (SELECT status, count(*) AS n FROM st GROUP BY status)
SELECT 'list_and_count' AS issue, 'pending' AS subject FROM c WHERE status = 'pending' UNION ALL SELECT 'total', CAST(sum(n) + 1 AS VARCHAR) FROM c
UNION ALL SELECT 'range', CAST(k AS VARCHAR) FROM st, (SELECT count(*) AS n FROM orders) WHERE status <> 'accepted' AND k >= n""")
def stored_summary_rules(spark, sf):
    r = A.order_records(spark, sf)
    counts = workspace.summary(r).where("n > 0").withColumn("n", F.when(F.col("status") == "pending", F.col("n") + 1).otherwise(F.col("n")))
    return workspace.summary_issues(counts, workspace.nonaccepted(r), r.count())


# --- evaluation ----------------------------------------------------------------------------------


@query(f"WITH {EP} SELECT e AS episode_index, length, b1 || ',' || b2 AS boundaries FROM ep")
def golden_folder(spark, sf):
    g = evaluate.golden(spark, f"{demo(spark, sf).root}/golden")
    return g.select("episode_index", "length", F.array_join(F.col("boundaries").cast("array<string>"), ",").alias("boundaries"))


RUN = """m AS (SELECT count(*) AS episode_count, count(*) FILTER (WHERE status = 'accepted') AS accepted_count, count(*) FILTER (WHERE status <> 'accepted') AS missing_prediction_count,
count(*) FILTER (WHERE status = 'accepted') / count(*) AS accepted_coverage FROM ep)"""


@query(f"WITH {EP}, {RUN} SELECT episode_count, accepted_count, missing_prediction_count, accepted_coverage, 0.0::DOUBLE AS median_absolute_error_seconds, 0::BIGINT AS false_accept_count FROM m")
def run_evaluation(spark, sf):
    d = demo(spark, sf)
    assert d.store
    m, _ = evaluate.evaluate(spark, d.config, f"{d.root}/golden", FPS)
    return m.select("episode_count", "accepted_count", "missing_prediction_count", "accepted_coverage", "median_absolute_error_seconds", "false_accept_count")


@query(f"""WITH {EP}, {RUN} SELECT unnest(['median_boundary_error_seconds', 'p90_boundary_error_seconds', 'accepted_coverage', 'constraint_blocking_rate', 'false_accept_count']) AS gate,
unnest([true, true, accepted_coverage >= 0.85, true, true]) AS passed FROM m""")
def evaluation_report_file(spark, sf):
    d = demo(spark, sf)
    assert d.store
    path = f"{d.folder()}/report.json"
    evaluate.write_report(*evaluate.evaluate(spark, d.config, f"{d.root}/golden", FPS), path)
    gates = json.loads(dataset.read_text(spark, path))["gates"]
    return spark.createDataFrame([(g["gate"], g["passed"]) for g in gates], "gate string, passed boolean")


VIEWS = f"""{G_SQL}, v0 AS (SELECT episode_index, length, boundaries, i, list_concat([0], boundaries)[i] AS l, list_concat(boundaries, [length])[i] AS r FROM (SELECT *, unnest(range(1, len(boundaries) + 2)) AS i FROM g)),
v1 AS (SELECT *, l + (r - l) // 2 AS st FROM v0), v2 AS (SELECT *, list_transform(list_filter(boundaries, lambda x: x > st), lambda x: x - st) AS rel FROM v1),
v AS MATERIALIZED (SELECT episode_index AS e, st, length AS en, rel FROM v2 WHERE len(list_filter(range(1, len(rel) + 2), lambda j: list_concat(rel, [length - st])[j] - list_concat([0], rel)[j] < 3)) = 0
UNION ALL SELECT episode_index, st, r - 3, []::BIGINT[] FROM v2 WHERE i <= len(boundaries) AND r - 3 - st >= 3)"""


@query(f"""WITH {VIEWS} SELECT count(*) AS episode_count, count(*) FILTER (WHERE e % 9 <> 0) AS accepted_count, count(*) FILTER (WHERE len(rel) > 0) AS constraint_violation_count,
count(*) FILTER (WHERE len(rel) > 0 AND e % 9 = 0) AS constraint_violation_blocked_count, count(*) FILTER (WHERE len(rel) = 0) AS same_start FROM v""")
def dagger_evaluation(spark, sf):
    views = evaluation.dagger_views(_golden(spark, sf), 3)
    # a model that sees no boundary, and starts right only where there is none
    services = evaluate.DaggerServices(lambda e, a, b: (e, a, b), lambda x: {"start_subtask_index": 0, "boundaries": [], "status": "accepted" if x[0] % 9 else "needs_review"})
    views = views.withColumn("expected_start", F.when(F.size("expected_boundaries") > 0, 1).otherwise(0))
    m, _ = evaluate.evaluate_dagger(views, services, EVENT_FPS, 3)
    return m.select("episode_count", "accepted_count", "constraint_violation_count", "constraint_violation_blocked_count", F.col("start_index_correct_count").alias("same_start"))


@query(f"WITH {G_SQL} SELECT episode_index, boundaries[1] - 1 AS before, boundaries[1] AS boundary FROM g WHERE len(boundaries) > 0 ORDER BY episode_index LIMIT 1")
def first_boundary_preview(spark, sf):
    return release_checks.first_preview(_golden(spark, sf))


@query(f"WITH {G_SQL} SELECT episode_index FROM g WHERE episode_index % 17 = 0 UNION ALL SELECT episode_index + 1000000 FROM g WHERE episode_index % 19 = 0")
def key_sets(spark, sf):
    g = _golden(spark, sf).select("episode_index")
    other = g.where("episode_index % 17 <> 0").union(g.where("episode_index % 19 = 0").selectExpr("episode_index + 1000000"))
    return evaluation.same_keys(g, other)


# --- releases ------------------------------------------------------------------------------------


@query(f"WITH {EP} SELECT o AS episode_index, frame_index, off + frame_index AS \"index\", 0::BIGINT AS task_index, x, y FROM fr JOIN out USING (e)")
def release_frames(spark, sf):
    rows = release._frames(spark, demo(spark, sf).released)
    return rows.select("episode_index", "frame_index", "index", "task_index", F.get("action", F.lit(0)).alias("x"), F.get("action", F.lit(1)).alias("y"))


@query(f"WITH {EP} SELECT o AS episode_index, length, e || ' ' || camera AS video, b1 || ',' || b2 AS boundaries FROM out, cam WHERE c = 1")
def release_files(spark, sf):
    d = demo(spark, sf)
    root = d.released
    rows = dataset.jsonl_table(spark, f"{root}/meta/episodes.jsonl", "episode_index long, length long").where("NOT bad").select("episode_index", "length")
    notes = dataset.read_json(spark, f"{root}/meta/annotations.json")["episodes"]
    said = spark.createDataFrame([(int(e), ",".join(map(str, x["boundaries"]))) for e, x in notes.items()], "episode_index long, boundaries string")
    videos = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.mp4").load(f"{root}/videos")
    videos = videos.where(F.col("path").contains(f"/{d.cameras[1]}/")).select(F.regexp_extract("path", r"episode_(\d+)\.mp4$", 1).cast("long").alias("episode_index"), F.col("content").cast("string").alias("video"))
    return rows.join(said, "episode_index").join(videos, "episode_index").select("episode_index", "length", "video", "boundaries")


@query(f"""WITH {EP}, a AS (SELECT NULL::BIGINT AS episode, 'action' AS feature, 0 AS component, x FROM fr JOIN out USING (e) UNION ALL SELECT NULL, 'action', 1, y FROM fr JOIN out USING (e) UNION ALL SELECT NULL, 'frame_index', 0, frame_index FROM fr JOIN out USING (e)
UNION ALL SELECT o, 'action', 0, x FROM fr JOIN out USING (e) UNION ALL SELECT o, 'action', 1, y FROM fr JOIN out USING (e) UNION ALL SELECT o, 'frame_index', 0, frame_index FROM fr JOIN out USING (e)) SELECT episode, feature, component, {STATS_SQL} FROM a GROUP BY episode, feature, component""")
def release_statistics(spark, sf):
    d = demo(spark, sf)
    whole = dataset.read_json(spark, f"{d.released}/meta/stats.json")
    each = dataset.read_jsonl(spark, f"{d.released}/meta/episodes_stats.jsonl")
    rows = [(None, *x) for x in release_checks.stats_rows({k: v for k, v in whole.items() if k not in d.cameras})]
    rows += [(r["episode_index"], *x) for r in each for x in release_checks.stats_rows(r["stats"])]
    return _rounded(spark.createDataFrame(rows, f"episode long, {release_checks.STATS_ROW}").select("episode", "feature", "component", *METRICS))


@query(f"WITH {EP} SELECT camera AS feature, 3 AS channels, (SELECT CAST(sum(length) AS BIGINT) * 4 FROM out) AS pixels, 1 AS depth FROM cam")
def release_image_statistics(spark, sf):
    d = demo(spark, sf)
    whole = dataset.read_json(spark, f"{d.released}/meta/stats.json")
    rows = [(c, len(whole[c]["mean"]), whole[c]["count"][0], len(whole[c]["mean"][0][0])) for c in d.cameras]
    return spark.createDataFrame(rows, "feature string, channels int, pixels long, depth int")


@query(f"""WITH {EP} SELECT * FROM (VALUES ('sound', 0), ('video_decoded_elsewhere', 1)) t(name, wrong)""")
def deep_video_check(spark, sf):
    d = demo(spark, sf)
    rows = []
    for name, shift in (("sound", 0), ("video_decoded_elsewhere", 1)):
        found = release.validate(spark, d.released, "strict_deep", decode=d.decoder(shift)).select("check").distinct().collect()
        rows.append((name, int([r.check for r in found] == ["stats"])))
    return spark.createDataFrame(rows, "name string, wrong int")


def _spoil(d: Demo, root: str) -> None:
    """Faults of all kinds, one episode or file each."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    def frames(e: int, change) -> None:
        path = f"{root}/" + d.info["data_path"].format(episode_chunk=e // 10, episode_index=e)
        pq.write_table(change(pq.read_table(path)), path)

    def replaced(t, name: str, values):
        i = t.schema.get_field_index(name)
        return t.set_column(i, t.schema.field(i), values.cast(t.schema.field(i).type))

    frames(0, lambda t: replaced(t, "index", pc.add(t["index"], 1)))
    frames(1, lambda t: t.slice(0, t.num_rows - 1))
    frames(2, lambda t: replaced(t, "task_index", pc.add(t["task_index"], 1)))
    frames(3, lambda t: replaced(t, "timestamp", pa.array(t["timestamp"].to_pylist()[::-1])))
    frames(4, lambda t: replaced(t, "timestamp", pc.subtract(t["timestamp"], 1.0)))
    frames(5, lambda t: t.drop_columns(["action"]))
    info = dataset_json(root, "info")
    features = info["features"] | {"frame_index": {"dtype": "float32", "shape": [1]}, "action": {"dtype": "float64", "shape": [3]}}
    sinks.write_json(f"{root}/meta/info.json", info | {"features": features, "splits": {"train": "0:1", "test": "x"}, "total_chunks": 99, "data_files_size_in_mb": 1.0})
    videos = sorted(p for p in os.listdir(f"{root}/videos/chunk-000/{d.cameras[0]}"))
    os.remove(f"{root}/videos/chunk-000/{d.cameras[0]}/{videos[0]}")
    sinks.write_text(f"{root}/videos/chunk-000/stray.txt", "x")
    sinks.write_text(f"{root}/videos/chunk-000/{d.cameras[0]}/{videos[1]}", "other")
    notes = dataset_json(root, "annotations")
    notes["episodes"]["0"]["boundaries"].reverse()
    del notes["episodes"]["1"]
    sinks.write_json(f"{root}/meta/annotations.json", notes | {"api_key": "x"})
    stats = dataset_json(root, "stats")
    stats["action"]["max"][0] += 1
    stats["action"]["q10"][1] = 99.0
    sinks.write_json(f"{root}/meta/stats.json", {k: v for k, v in stats.items() if k != d.cameras[0]} | {"other": stats["frame_index"]})
    with open(f"{root}/meta/episodes_stats.jsonl", encoding="utf-8") as f:
        lines = f.read().splitlines()
    sinks.write_text(f"{root}/meta/episodes_stats.jsonl", "\n".join(lines[:-1]) + "\n")


def dataset_json(root: str, name: str) -> dict:
    with open(f"{root}/meta/{name}.json", encoding="utf-8") as f:
        return json.load(f)


FOUND = ["annotation", "annotation_set", "column_missing", "dtype", "episode_stats", "forbidden_key", "frames", "global_index", "payload", "payload_size", "schema_differs", "shape", "source_payload", "source_stats_keys", "splits", "stats", "stats_coverage", "stats_rules", "task_index", "task_info", "timestamp_range", "timestamps", "total"]


@query(f"SELECT unnest({FOUND}) AS \"check\"")
def release_faults(spark, sf):
    d = demo(spark, sf)
    root = f"{d.folder()}/release"
    shutil.copytree(d.released, root)
    _spoil(d, root)
    found = release.validate(spark, root, source=d.released).select("check").distinct()
    return found.where(F.col("check") != "episode_stats_coverage")


@query("SELECT * FROM (VALUES ('sound', ''), ('unsorted', 'files_not_sorted_and_distinct'), ('lost', 'digests_not_of_files'), ('level', 'skips_not_of_level'), ('other', 'unknown_level')) t(name, issues)")
def report_rules(spark, sf):
    d = demo(spark, sf)
    good = release.conversion_report(spark, d.released, "strict_structural")
    files = good["payload_files"]
    cases = {"sound": {}, "unsorted": {"payload_files": files[::-1]}, "lost": {"payload_files": files[1:]}, "level": {"validation_level": "strict_deep"}, "other": {"validation_level": "x"}}
    return spark.createDataFrame([(n, ",".join(release_checks.report_issues(good | c))) for n, c in cases.items()], "name string, issues string")


@query(f"WITH {EP} SELECT printf('videos/chunk-%03d/%s/episode_%06d.mp4', e // 10, camera, e) AS path, length(e || ' ' || camera) AS size, sha256(e || ' ' || camera) AS digest FROM ep, cam")
def tree_of_files(spark, sf):
    return store.tree_files(demo(spark, sf).source, spark).where("path LIKE 'videos/%'").select("path", "size", "digest")


@query(f"""WITH {EP}, s AS (SELECT o AS e, k, printf('Please do %s now.', ['approach', 'grasp', 'release'][k + 1]) AS text FROM out, range(3) r(k))
SELECT e AS episode_index, CAST(k AS INT) AS subtask_index, CASE WHEN e % 5 = 2 AND k = 1 THEN 'missing' END AS side, text FROM s UNION ALL SELECT e, 7, 'unexpected', 'x' FROM s WHERE e % 6 = 1 AND k = 0""")
def augmentation_coverage(spark, sf):
    d = demo(spark, sf)
    rows = d.store.records(spark).where("status = 'accepted'").select(F.col("episode_index").alias("e"), "final_annotation.*")
    own = rows.withColumn("episode_index", (F.row_number().over(Window.orderBy("e")) - 1).cast("long")).drop("e")  # a few episodes
    texts = annotation.augment(own, d.config, paraphrase)
    lost = texts.where("NOT (episode_index % 5 = 2 AND subtask_index = 1)")
    more = own.where("episode_index % 6 = 1").select("episode_index", F.lit(7).alias("subtask_index"), F.lit("x").alias("text"))
    issues = release_checks.augmentation_issues(own, lost.union(more))
    return texts.union(more).join(issues, ["episode_index", "subtask_index"], "left").select("episode_index", "subtask_index", "side", "text")


@query(f"WITH {EP} SELECT o AS episode_id, k AS segment, printf('Please do %s now.', ['approach', 'grasp', 'release'][k + 1]) AS action_text FROM out, range(3) r(k)")
def augmented_release(spark, sf):
    d = demo(spark, sf)
    assert d.store
    target = f"{d.folder()}/release"
    release.convert(spark, d.configured(augmentation={"enabled": True}), target, services=release.Services(send=paraphrase))
    rows = json.loads(dataset.read_text(spark, f"{target}/task_info/task_0.json"))
    return spark.createDataFrame([(r["episode_id"], i, a["action_text"]) for r in rows for i, a in enumerate(r["label_info"]["action_config"])], "episode_id long, segment long, action_text string")


# --- review --------------------------------------------------------------------------------------


@query(f"WITH {EP} SELECT e AS episode_index, e % 3 <> 2 AS readable, CASE WHEN e % 3 = 0 AND status = 'needs_review' THEN 'accepted' ELSE status END AS status, CASE WHEN e % 3 = 0 AND status = 'needs_review' THEN 'human:file' WHEN status = 'accepted' THEN 'model' END AS decision_source FROM ep")
def review_decision_files(spark, sf):
    d = demo(spark, sf)
    s, folder = d.store_copy(), d.folder()
    for e, n in d.lengths.items():
        r = s.load(e)
        told = {"episode_index": e, "source_fingerprint": r["source_fingerprint"] if e % 3 == 0 else "0" * 64, "run_fingerprint": r["run_fingerprint"], "mode": "complete", "start_subtask_index": 0, "boundaries": [n // 3, 2 * n // 3]}
        sinks.write_json(f"{folder}/{e:06d}.json", told | ({"note": "x"} if e % 3 == 2 else {}))
    seen = review_files.load_decisions(spark, folder).select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("episode_index"), F.col("error").isNull().alias("readable")).persist()
    for r in seen.where("readable").collect():  # one file for each decision of a person
        try:
            review_files.apply_file(s, d.config, d.lengths, review_files.load_decision(f"{folder}/{r.episode_index:06d}.json"))
        except store.Conflict:
            continue
    return seen.join(s.records(spark).select("episode_index", "status", "decision_source"), "episode_index")


@query(f"WITH {EP} SELECT e AS episode_index, CASE WHEN e % 4 = 0 THEN 'pending' WHEN e % 4 = 1 AND status = 'needs_review' THEN 'accepted' ELSE status END AS status FROM ep")
def review_server_decisions(spark, sf):
    d = demo(spark, sf)
    s = d.store_copy()
    views = review_server.Views(d.configured(os.path.basename(s.root)), d.lengths, d.info)
    for x in views.episodes("needs_review"):
        e, n = x["episode_index"], d.lengths[x["episode_index"]]
        body = {"expected_status": x["status"], "expected_updated_at": x["updated_at"], "start_subtask_index": 0, "boundaries": [n // 3, 2 * n // 3]}
        if e % 4 != 1:
            body["boundaries"].reverse()  # refused
        views.answer("POST", f"/api/episodes/{e}/decision", json.dumps(body).encode())
    for e in d.lengths:
        if e % 4 == 0:
            s.invalidate(e)
    return s.records(spark).select("episode_index", "status")


@query(f"WITH {EP} SELECT status, count(*) AS n FROM ep GROUP BY status")
def review_session(spark, sf):
    d = demo(spark, sf)
    assert d.store
    _, _, body = review_server.Views(d.config, d.lengths, d.info).answer("GET", "/api/session")
    return spark.createDataFrame(list(json.loads(body)["counts"].items()), "status string, n long")


@query(f"""WITH {EP}, k AS (SELECT e, length, unnest(list_distinct([b1, b2, b2 - 1])) AS b FROM ep WHERE status = 'needs_review'), f AS (SELECT DISTINCT e, unnest(range(greatest(0, b - 25), least(length - 1, b + 25) + 1)) AS f FROM k)
SELECT e AS episode_index, camera, f AS frame_index, f / 10.0::DOUBLE AS seconds, printf('episode_%06d/%s-%s-frame-%d.jpg', e, left(camera, 40), left(sha256(camera), 8), f) AS path FROM f, cam WHERE c < 3""")
def review_bundle(spark, sf):
    d = demo(spark, sf)
    assert d.store
    target = f"{d.folder()}/review"
    review_files.render(spark, d.config, d.lengths, FPS, target, review_files.ReviewServices(d.services.sample))
    files = spark.read.json(f"{target}/episode_*.json", multiLine=True).select("episode_index", F.explode("images").alias("i"))
    return files.select("episode_index", "i.camera", "i.frame_index", "i.seconds", "i.path")


@query(f"WITH {EP} SELECT e AS episode_index, CASE WHEN status <> 'failed' THEN status END AS refined, CASE WHEN status <> 'failed' THEN 4 ELSE 0 END AS steps, false AS tells_answers FROM ep")
def decision_summaries(spark, sf):
    rows = review_files.decision_summaries(demo(spark, sf).store.records(spark))
    steps = F.from_json(F.get_json_object("summary", "$.refine.provenance"), "array<string>")
    return rows.select("episode_index", F.get_json_object("summary", "$.refine.status").alias("refined"), F.coalesce(F.size(steps), F.lit(0)).alias("steps"), F.col("summary").contains("answer").alias("tells_answers"))


@query("SELECT o_orderkey AS episode_index, status FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'needs_review' ELSE 'pending' END AS status FROM orders) WHERE status = 'needs_review'")
def review_queue(spark, sf):
    r = A.order_records(spark, sf).withColumn("review_reasons", F.array(F.lit("x"))).withColumn("failure_category", F.lit(None).cast("string"))
    return review.queue_view(r, "needs_review").select("episode_index", "status")


# --- models --------------------------------------------------------------------------------------

# What the scripted sender says, call by call, and what the client makes of it.
ANSWERS = [
    (['{"a": 1}'], "answered", 1, 0.0),
    (["!503", "!timeout", '{"a": 1}'], "answered", 3, 3.0),
    (['so {"a": 1}', '{"a": 1}'], "answered", 2, 0.0),
    (['so {"a": 1}', '{"a": 2}'], "invalid", 2, 0.0),
    (["!CUDA out of memory"], "memory", 1, 0.0),
    (["!503", "!503", "!503", "!503"], "failed", 4, 7.0),
    (["?"], "invalid", 1, 0.0),
]


@query(f"SELECT event_id, {[o for _, o, _, _ in ANSWERS]}[event_id % 7 + 1] AS outcome, {[n for _, _, n, _ in ANSWERS]}[event_id % 7 + 1] AS calls, {[float(w) for *_, w in ANSWERS]}[event_id % 7 + 1]::DOUBLE AS waited FROM events")
def model_client(spark, sf):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for i in p.event_id:
                script, waits = list(ANSWERS[int(i) % 7][0]), []
                n = len(script)

                def send(prompt: str, frames: list, timeout: float, script=script) -> str:
                    said = script.pop(0)
                    if said.startswith("!"):
                        raise Transient(said[1:])
                    if said == "?":
                        raise Malformed("no text")
                    return said

                def check(v: dict) -> None:
                    if "a" not in v:
                        raise ValueError("a is missing")

                try:
                    Client(send, waits.append).complete(f"p{i}", [], check)
                    outcome = "answered"
                except ModelOutOfMemory:
                    outcome = "memory"
                except InvalidModelResponse:
                    outcome = "invalid"
                except ModelCallError:
                    outcome = "failed"
                out.append((i, outcome, n - len(script), float(sum(waits))))
            yield pd.DataFrame(out, columns=["event_id", "outcome", "calls", "waited"])

    return A.table(spark, sf, "events").select("event_id").mapInPandas(run, "event_id long, outcome string, calls int, waited double")


@query(r"""WITH f AS (SELECT n_nationkey AS k, printf('weights/%02d.bin', n_nationkey) AS path FROM nation)
SELECT path, CASE WHEN k % 4 = 1 THEN 'missing' WHEN k % 4 = 2 THEN 'size' ELSE 'digest' END AS issue FROM f WHERE k % 4 <> 0 UNION ALL SELECT 'revision ' || repeat('a', 40), 'hf download,hf cache'""")
def model_install(spark, sf):
    d = demo(spark, sf)
    target = f"{d.folder()}/model"
    rows = A.table(spark, sf, "nation").select(F.col("n_nationkey").cast("int").alias("k"), "n_name").collect()
    calls = []

    def run(args: list[str], env: dict) -> None:
        calls.append(" ".join(args[:2]))
        if args[1] == "download":
            for r in rows:
                if r.k % 4 != 1:
                    sinks.write_text(f"{target}/weights/{r.k:02d}.bin", r.n_name + ("x" if r.k % 4 == 2 else ""))

    revision = models.resolve("own/model", "main", "hub", lambda url: {"sha": "a" * 40})
    models.download("own/model", revision, target, run)
    record = models.read_record(target)
    expected = A.table(spark, sf, "nation").select(F.format_string("weights/%02d.bin", F.col("n_nationkey").cast("int")).alias("path"), F.length("n_name").cast("long").alias("size"), F.when(F.col("n_nationkey") % 4 == 3, "x").otherwise(F.sha2("n_name", 256)).alias("digest"))
    issues = models.file_issues(spark, target, expected)
    return issues.union(spark.createDataFrame([(f"revision {record.revision}", ",".join(calls))], "path string, issue string"))


@query("SELECT * FROM (VALUES ('coarse', 'observed'), ('coarse', 'boundaries'), ('coarse', 'uncertain'), ('refine', 'from_subtask'), ('refine', 'to_subtask'), ('refine', 'last_frame'), ('refine', 'first_frame'), ('refine', 'boundary')) t(stage, field)")
def answer_schemas(spark, sf):
    return spark.createDataFrame([(s, f) for s in ("coarse", "refine") for f in annotation.answer_schema(s)["required"]], "stage string, field string")


# --- columns -------------------------------------------------------------------------------------


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'bytes=' || event_id % 50 || '-' || event_id % 90 WHEN 1 THEN 'bytes=' || event_id % 120 || '-' ELSE 'bytes=-' || event_id % 40 END AS header,
CASE event_id % 3 WHEN 0 THEN CASE WHEN event_id % 50 <= least(event_id % 90, 99) THEN event_id % 50 END WHEN 1 THEN CASE WHEN event_id % 120 < 100 THEN event_id % 120 END ELSE CASE WHEN event_id % 40 > 0 THEN 100 - event_id % 40 END END AS first,
CASE event_id % 3 WHEN 0 THEN CASE WHEN event_id % 50 <= least(event_id % 90, 99) THEN least(event_id % 90, 99) END WHEN 1 THEN CASE WHEN event_id % 120 < 100 THEN 99 END ELSE CASE WHEN event_id % 40 > 0 THEN 99 END END AS last FROM events""")
def byte_ranges(spark, sf):
    e = F.col("event_id")

    def part(n: int):
        return (e % n).cast("string")

    header = F.when(e % 3 == 0, F.concat(F.lit("bytes="), part(50), F.lit("-"), part(90))).when(e % 3 == 1, F.concat(F.lit("bytes="), part(120), F.lit("-"))).otherwise(F.concat(F.lit("bytes=-"), part(40)))
    rows = A.table(spark, sf, "events").select("event_id", header.alias("header"))
    return rows.withColumn("r", text.byte_range("header", F.lit(100).cast("long"))).select("event_id", "header", "r.first", "r.last")


@query("""SELECT event_id, regexp_matches(sha256(event_type), '^[0-9a-f]{64}$') AND event_id % 2 = 0 AS exact, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) END AS utc,
event_id % 4 = 1 AS memory, 'data:image/jpeg;base64,' || base64(CAST(event_type AS BLOB)) AS url, CASE WHEN event_id % 2 = 0 THEN array_to_string(list_sort(list_distinct([event_id % 7, event_id % 5])), ',') END AS ids FROM events""")
def text_forms(spark, sf):
    e = F.col("event_id")
    rows = A.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    said = F.concat(stamp, F.when(e % 3 == 0, "Z").when(e % 3 == 1, "+01:00").otherwise(""))
    digest = F.concat(F.when(e % 2 == 0, "").otherwise("X"), F.sha2("event_type", 256))
    error = F.when(e % 4 == 1, "CUDA error: Out of Memory at 3").when(e % 4 == 2, "no room for zoom").otherwise("timeout")
    listed = F.concat((e % 7).cast("string"), F.when(e % 2 == 0, ",").otherwise(", "), (e % 5).cast("string"))
    return rows.select(
        "event_id",
        digest.rlike(text.SHA256).alias("exact"),
        text.utc_timestamp(said).cast("timestamp_ntz").alias("utc"),
        text.out_of_memory(error).alias("memory"),
        text.data_url(F.col("event_type").cast("binary")).alias("url"),
        F.array_join(text.episode_list(listed).cast("array<string>"), ",").alias("ids"),
    )


@query(r"""SELECT event_id, event_id % 4 IN (0, 3) AS strict,
CASE event_id % 4 WHEN 0 THEN '{"a":[1,2.5,"\u00e9"],"k":' || event_id || ',"z":{"b":null,"c":true}}' WHEN 3 THEN '{"token":' || event_id || '}' END AS canonical, event_id % 4 <> 0 AS forbidden,
CASE event_id % 4 WHEN 0 THEN event_id WHEN 3 THEN NULL END AS k FROM events""")
def strict_json_cases(spark, sf):
    i = F.col("event_id").cast("string")
    e = F.col("event_id")
    said = (
        F.when(e % 4 == 0, F.concat(F.lit('{ "z": {"c": true, "b": null},\n "k": '), i, F.lit(', "a": [1, 2.50, "é"]}')))
        .when(e % 4 == 1, F.concat(F.lit('{"k": 1, "k": '), i, F.lit("}")))
        .when(e % 4 == 2, F.lit('{"k": NaN}'))
        .otherwise(F.concat(F.lit('{"Token": '), i, F.lit("}")))
    )
    rows = A.table(spark, sf, "events").select("event_id", said.alias("t"))
    out = rows.select("event_id", jsontext.strict_json_ok(F.col("t")).alias("strict"), jsontext.canonical_json(F.lower("t")).alias("canonical"), jsontext.forbidden_keys(F.col("t"), text.FORBIDDEN_KEYS).alias("forbidden"))
    return out.select("event_id", "strict", "canonical", "forbidden", F.get_json_object("canonical", "$.k").cast("long").alias("k"))


@query(f"WITH {G_SQL}, z AS (SELECT episode_index, length, unnest(boundaries) AS b FROM g) SELECT episode_index, b AS boundary, b % 3 = 0 AS matches, b % 4 >= 1 AS correct, CASE WHEN length > 1 THEN CAST(floor(least(1, (b % 50) / 40.0::DOUBLE) * (length - 1) + 0.5) AS BIGINT) ELSE 0 END AS pointed FROM z")
def refine_columns(spark, sf):
    rows = _golden(spark, sf).select("episode_index", "length", F.explode("boundaries").alias("boundary"))
    b = F.col("boundary")
    answer = F.struct(F.lit(0).alias("from_subtask"), F.lit(1).alias("to_subtask"), (b - 1).alias("last_frame"), b.alias("first_frame"), F.when(b % 3 == 0, b).otherwise(b + 1).alias("boundary"))
    seen = b / 10 + (b % 4) * 0.05
    return rows.withColumn("a", answer).select(
        "episode_index",
        "boundary",
        rules.refine_matches("a", F.lit(0), F.lit(1), "length").alias("matches"),
        B.needs_frame_correction(seen, b / 10 - 1e-9, FPS).alias("correct"),
        B.frame_from_pointer(b % 50, F.lit(0.0), F.lit(40.0), "length").alias("pointed"),
    )


@query(f"WITH {EP} SELECT camera, c = 2 AS is_primary, row_number() OVER (ORDER BY c <> 2, c) - 1 AS place FROM cam")
def camera_order(spark, sf):
    rows = A.table(spark, sf, "region").orderBy("r_regionkey").agg(F.sort_array(F.collect_list(F.struct("r_regionkey", F.regexp_replace("r_name", " ", "_").alias("n")))).alias("x")).select(F.col("x.n").alias("names"))
    order = sampling.camera_order(F.get("names", F.lit(2)), "names")
    return rows.select(F.get("names", F.lit(2)).alias("primary"), F.posexplode(order).alias("place", "camera")).select("camera", (F.col("camera") == F.col("primary")).alias("is_primary"), F.col("place").cast("long").alias("place"))


# --- streams -------------------------------------------------------------------------------------


def _stream(spark, rows: DataFrame, parts: int = 4) -> tuple[DataFrame, str]:
    """rows as a stream of files in a folder of the shared one, and the folder."""
    path = f"{sinks.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows.repartition(parts).write.parquet(f"{path}/in")
    return spark.readStream.schema(rows.schema).parquet(f"{path}/in"), path


CHAIN = """t AS MATERIALIZED (SELECT user_id AS e, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
j AS MATERIALIZED (SELECT *, e % 9 = 0 AND i >= 1 AS broken, i >= 3 AND NOT (e % 4 = 0 OR i % 3 <> 0) AS illegal FROM t)"""


@query(f"""WITH {CHAIN} SELECT e AS episode_index, event_id, NOT broken AND NOT illegal AS accepted, CASE WHEN broken THEN 'broken_chain' WHEN illegal THEN 'illegal_edge' END AS reason FROM j""")
def stream_state_machine(spark, sf):
    stream, path = _stream(spark, transition_rows(spark, sf), 1)
    out = state.run_to_table(state.run_state_machine(stream), f"{path}/out", f"{path}/checkpoint")
    return out.select("episode_index", F.col("event_id").cast("long").alias("event_id"), "accepted", "reason")


@query(f"WITH {CHAIN} SELECT CASE least(i, 2) WHEN 0 THEN 'coarse_done' WHEN 1 THEN 'refine_done' ELSE 'accepted' END AS to_status, count(*) AS n FROM t GROUP BY 1")
def stream_status_counts(spark, sf):
    stream, path = _stream(spark, transition_rows(spark, sf))
    return state.run_to_table(state.status_counts(stream), f"{path}/out", f"{path}/checkpoint", "complete")


@query("SELECT event_id, event_type AS label, CAST(ts AS DATE) AS day FROM events")
def stream_exactly_once_log(spark, sf):
    rows = A.event_frames(spark, sf).select(F.col("event_id").cast("string").alias("event_id"), "label", "timestamp")
    path = f"{sinks.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    # every event comes twice, in files of their own, and the first batch is written again
    rows.union(rows).repartition(6).write.parquet(f"{path}/in")
    write = state.log_writer(f"{path}/log")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    out = state.read_log(spark, f"{path}/log", "event_id string, label string, timestamp timestamp")
    return out.select(F.col("event_id").cast("long").alias("event_id"), "label", "day")


def _labels(spark, sf):
    return _stream(spark, A.event_frames(spark, sf).select("episode_index", "timestamp", "label"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS label, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_window_counts(spark, sf):
    stream, path = _labels(spark, sf)
    out = state.run_to_table(state.window_counts(stream, "1 hour"), f"{path}/out", f"{path}/checkpoint", "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "label", "n")


@query("""SELECT time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start, event_type AS label, count(*) AS n FROM events, range(2) r(k) GROUP BY 1, 2""")
def sliding_window_counts(spark, sf):
    stream, path = _labels(spark, sf)
    out = state.run_to_table(state.window_counts(stream, "1 hour", "30 minutes"), f"{path}/out", f"{path}/checkpoint", "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "label", "n")


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS isnew FROM events),
k AS (SELECT *, sum(isnew) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM s) SELECT user_id AS episode_index, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, sid""")
def session_window_counts(spark, sf):
    stream, path = _labels(spark, sf)
    out = state.run_to_table(state.session_counts(stream, "2 hours"), f"{path}/out", f"{path}/checkpoint", "complete")
    return out.select("episode_index", F.col("start").cast("timestamp_ntz").alias("start"), "n")
