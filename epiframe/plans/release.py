"""Publication of accepted episodes as a new data set, and the independent checks of such a release."""

from __future__ import annotations

import json
import math
import os
import shutil
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import rules, text
from ..operators import release_checks, reindex, segments, statistics
from ..operators.release_checks import LEVELS
from ..schemas import METRICS
from ..sources import dataset, media, sinks
from .annotate import augment
from .store import Store, tree_digest

#: A check is a row (check, subject, detail); a release without rows is sound.
CHECK = "check string, subject string, detail string"

SIZES = [("data_files_size_in_mb", "data", "*.parquet"), ("video_files_size_in_mb", "videos", "*.mp4")]


def _payload(spark: SparkSession, root: str, folder: str, pattern: str) -> DataFrame:
    """Files under a folder with their lengths; contents are read only if they are used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(f"{root}/{folder}")
    return files.withColumn("path", F.regexp_extract("path", f"({folder}/.*)$", 1))


def payload_digests(spark: SparkSession, root: str) -> DataFrame:
    """(path, digest) of all parquet files and videos, digested in the tasks."""
    parts = [_payload(spark, root, folder, pattern).select("path", F.sha2("content", 256).alias("digest")) for _, folder, pattern in SIZES if os.path.isdir(f"{root}/{folder}")]
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def payload_sizes(spark: SparkSession, root: str) -> dict[str, float]:
    return {name: float(_payload(spark, root, folder, pattern).agg(F.coalesce(text.payload_megabytes("length"), F.lit(0.0))).first()[0]) if os.path.isdir(f"{root}/{folder}") else 0.0 for name, folder, pattern in SIZES}


def report(spark: SparkSession, root: str, level: str) -> dict:
    """What was checked and what it was checked on: level, checks left out, the payload's digests and their one digest."""
    files = payload_digests(spark, root)
    counts = files.agg(F.count("*").alias("n")).first()
    return {"validation_level": level, "skipped_checks": LEVELS[level], "payload_files": counts.n, "payload_digest": reindex.ordered_digest(files, "path", "digest")}


@dataclass(frozen=True)
class Services:
    """What conversion and validation are given: decode for video statistics, send for paraphrases; none is needed for what does without."""

    decode: media.Decoder | None = None
    send: Callable[[str, list, float], str] | None = None


def _accepted(spark: SparkSession, store: Store, episodes: DataFrame) -> DataFrame:
    r = store.records(spark).where("status = 'accepted'").select("episode_index", "final_annotation.*")
    return r.join(episodes, "episode_index").select("episode_index", "length", "task", "parquet", "start_subtask_index", "boundaries")


def convert(spark: SparkSession, config: Config, target: str, accepted_only: bool = True, services: Services = Services()) -> dict:
    """Writes the release beside its place, checks it, then renames it; the source is read only and must not change."""
    store, source = Store(config.work_dir), config.source
    info = dataset.read_json(spark, f"{source}/meta/info.json")
    rows = dataset.read_jsonl(spark, f"{source}/meta/episodes.jsonl")
    own = _accepted(spark, store, dataset.episode_table(spark, rows, info))
    n = own.count()
    if not n or (not accepted_only and n != len(rows)):
        raise ValueError(f"{n} of {len(rows)} episodes are accepted")
    before = tree_digest(source, spark)
    staging = f"{target}.staging"
    shutil.rmtree(staging, ignore_errors=True)
    sinks.copy_tree(source, staging, skip=("data", "videos"))
    mapping = reindex.running_offsets(own)
    if accepted_only:
        _write_subset(spark, mapping, info, source, staging)
    else:
        files = payload_digests(spark, source).select(F.concat(F.lit(f"{source}/"), "path").alias("source_path"), F.concat(F.lit(f"{staging}/"), "path").alias("target_path"))
        sinks.copy_files(files).collect()
    _write_stats(spark, source, staging, services.decode)
    _write_annotations(spark, config, mapping, staging, services)
    sinks.write_json(f"{staging}/meta/info.json", dataset.read_json(spark, f"{staging}/meta/info.json") | payload_sizes(spark, staging), sort=False)
    level = "strict_deep" if services.decode else "strict_structural"
    problems = validate(spark, staging, level, decode=services.decode).collect()
    if tree_digest(source, spark) != before:
        raise RuntimeError("the source changed meanwhile")
    if problems:
        raise ValueError(f"the release is not sound: {problems[:5]}")
    sinks.publish(staging, target)
    totals = dataset.read_json(spark, f"{target}/meta/info.json")
    return report(spark, target, level) | {"episodes": n, "frames": totals["total_frames"], "source_digest": before, "files": sum(1 for p in Path(target).rglob("*") if p.is_file())}


def conversion_report(spark: SparkSession, root: str, level: str) -> dict:
    """A report that lists every payload file and its digest, for ``release_checks.report_issues``; as long as the payload has files."""
    files = {r.path: r.digest for r in payload_digests(spark, root).collect()}
    info = dataset.read_json(spark, f"{root}/meta/info.json")
    return {"payload_files": sorted(files), "payload_digests": files, "validation_level": level, "skipped_checks": LEVELS[level], "episodes": info["total_episodes"], "frames": info["total_frames"]}


def _write_subset(spark: SparkSession, mapping: DataFrame, info: dict, source: str, staging: str) -> None:
    size, template = info["chunks_size"], info["data_path"]
    rows = mapping.orderBy("output_index").collect()  # the meta files' own size
    paths = [(f"{source}/{r.parquet}", f"{staging}/{template.format(episode_chunk=r.output_index // size, episode_index=r.output_index)}", r.output_index, r.global_offset) for r in rows]
    sinks.rewrite_episodes(spark.createDataFrame(paths, "source_path string, target_path string, output_index long, global_offset long").repartition(min(len(paths), 256), "output_index")).collect()
    keys = dataset.camera_keys(info)

    def video(e: int, k: str) -> str:
        return info["video_path"].format(episode_chunk=e // size, episode_index=e, video_key=k)

    videos = [(f"{source}/{video(r.episode_index, k)}", f"{staging}/{video(r.output_index, k)}") for r in rows for k in keys]
    sinks.copy_files(spark.createDataFrame(videos, "source_path string, target_path string").repartition(min(len(videos), 256))).collect()
    sinks.write_jsonl(f"{staging}/meta/episodes.jsonl", [{"episode_index": r.output_index, "tasks": [r.task], "length": r.length} for r in rows])
    totals = {"total_episodes": len(rows), "total_frames": sum(r.length for r in rows), "total_chunks": -(-len(rows) // size), "total_videos": len(rows) * len(keys), "splits": {"train": f"0:{len(rows)}"}}
    sinks.write_json(f"{staging}/meta/info.json", info | totals, sort=False)


def _frames(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{root}/data")


def recomputed(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Global and episode statistics of a release's numeric features in one pass; episode is null on global rows."""
    frames = _frames(spark, root)
    kinds = dict(frames.dtypes)
    held = [n for n in names if n in kinds and not kinds[n].startswith(("string", "boolean"))]
    return statistics.feature_stats(frames.select(F.col("episode_index").alias("episode"), *held), held, "episode")


def video_stats(spark: SparkSession, root: str, info: dict, decode: media.Decoder) -> DataFrame:
    """Statistics (feature, component, metrics) of every camera's channels, of values from 0 to 1."""
    episodes = dataset.episode_table(spark, dataset.read_jsonl(spark, f"{root}/meta/episodes.jsonl"), info)
    shapes = spark.createDataFrame([(n, s[0], s[1]) for n, kind, s in dataset.features(info) if kind == "video"], "camera string, height int, width int")
    videos = dataset.video_table(episodes, info).join(F.broadcast(shapes), "camera")  # a row for each camera
    videos = videos.select("camera", F.concat(F.lit(f"{root}/"), "path").alias("path"), F.col("length").alias("frames"), "height", "width")
    bins = media.video_histograms(videos, decode).groupBy("camera", "channel", "bin").agg(F.sum("n").alias("n"))
    return statistics.histogram_stats(bins, ["camera", "channel"]).withColumnsRenamed({"camera": "feature", "channel": "component"})


def _write_stats(spark: SparkSession, source: str, root: str, decode: media.Decoder | None) -> None:
    """Both statistics files; what the source has statistics of must be what the release has."""
    info = dataset.read_json(spark, f"{root}/meta/info.json")
    vectors = statistics.as_vectors(recomputed(spark, root, [n for n, kind, _ in dataset.features(info) if kind != "video"]), ["episode", "feature"]).collect()
    every: dict = {None: {}}
    for r in vectors:
        every.setdefault(r.episode, {})[r.feature] = {m: [r[m][0]] if m == "count" else r[m] for m in METRICS}
    whole = every.pop(None)
    if decode:
        for r in statistics.as_vectors(video_stats(spark, root, info, decode), ["feature"]).collect():
            whole[r.feature] = {m: [r[m][0]] if m == "count" else [[[v]] for v in r[m]] for m in METRICS}
    said = dataset.read_json(spark, f"{source}/meta/stats.json") if os.path.exists(f"{source}/meta/stats.json") else {}
    cameras = set(dataset.camera_keys(info))
    if said and set(said) - cameras != set(whole) - cameras:
        raise ValueError(f"the source has statistics of {sorted(said)}, the release of {sorted(whole)}")
    sinks.write_json(f"{root}/meta/stats.json", whole)
    sinks.write_jsonl(f"{root}/meta/episodes_stats.jsonl", [{"episode_index": e, "stats": s} for e, s in sorted(every.items())])


def _write_annotations(spark: SparkSession, config: Config, mapping: DataFrame, root: str, services: Services) -> None:
    template = spark.createDataFrame([(i, s.skill, s.text) for i, s in enumerate(config.subtasks)], "subtask_index int, skill string, text string")
    own = mapping.select(F.col("output_index").alias("episode_index"), "length", "start_subtask_index", "boundaries")
    actions = segments.with_template(segments.annotation_segments(own), template)
    more = {}
    if config.augmentation.enabled:
        if services.send is None:
            raise ValueError("augmentation needs a sender")
        texts = augment(own, config, services.send).persist()
        lacking = release_checks.augmentation_issues(own, texts).take(5)
        if lacking:
            raise ValueError(f"paraphrases do not cover the sub-tasks: {lacking}")
        actions = actions.drop("text").join(texts, ["episode_index", "subtask_index"])
        more = {"augmentation": {"enabled": True, "language": config.augmentation.language, "model": config.model.name}}
    actions = actions.orderBy("episode_index", "segment_index").collect()
    episodes = own.orderBy("episode_index").collect()
    sinks.write_json(
        f"{root}/meta/annotations.json",
        {
            "high_level_instruction": config.high_level_instruction,
            "mode": config.mode,
            "min_segment_frames": config.sampling.min_segment_frames,
            "subtasks": [{"skill": s.skill, "text": s.text} for s in config.subtasks],
            "episodes": {str(r.episode_index): {"start_subtask_index": r.start_subtask_index, "boundaries": list(r.boundaries)} for r in episodes},
        }
        | more,
    )
    by: dict[int, list] = {}
    for a in actions:
        by.setdefault(a.episode_index, []).append({"start_frame": a.start_frame, "end_frame": a.end_frame, "skill": a.skill, "action_text": a.text})
    sinks.write_json(f"{root}/task_info/task_0.json", [{"episode_id": e, "label_info": {"action_config": by[e]}} for e in sorted(by)])


def _issue(check: str, subject, detail):
    return F.lit(check).alias("check"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail")


def validate(spark: SparkSession, root: str, level: str = "strict_structural", source: str | None = None, decode: media.Decoder | None = None) -> DataFrame:
    """Everything wrong with a release, as CHECK rows; the level says what is left out. strict_deep decodes the videos, so it needs a decoder."""
    if level == "strict_deep" and decode is None:
        raise ValueError("strict_deep compares video statistics and needs a decoder")
    if level == "source_backed_legacy" and source is None:
        raise ValueError("source_backed_legacy needs the source")
    info = dataset.read_json(spark, f"{root}/meta/info.json")
    rows = dataset.read_jsonl(spark, f"{root}/meta/episodes.jsonl")
    episodes = dataset.episode_table(spark, rows, info)
    notes = dataset.read_json(spark, f"{root}/meta/annotations.json")
    parts = [
        *_frame_checks(spark, root, info, episodes),
        *_annotation_checks(spark, root, notes, episodes),
        *_payload_checks(spark, root, info, episodes, len(rows), source),
        *_stats_checks(spark, root, info, episodes, level, source, decode),
    ]
    told = _told(spark, root, info, rows, level)
    if told:
        parts.append(spark.createDataFrame(told, CHECK))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _told(spark: SparkSession, root: str, info: dict, rows: list[dict], level: str) -> list[tuple]:
    """What the meta files alone show to be wrong: totals, payload sizes, names that must not be published."""
    cameras, size = len(dataset.camera_keys(info)), info["chunks_size"]
    want = {"total_episodes": len(rows), "total_frames": sum(r["length"] for r in rows), "total_chunks": -(-len(rows) // size), "total_videos": len(rows) * cameras}
    out = [("total", n, f"{info.get(n)}, expected {v}") for n, v in want.items() if info.get(n) != v]
    if not (level in ("legacy_structural", "source_backed_legacy") and not any(n in info for n, _, _ in SIZES)):
        actual = payload_sizes(spark, root)
        out += [("payload_size", n, str(actual[n])) for n, _, _ in SIZES if isinstance(info.get(n), bool) or not isinstance(info.get(n), (int, float)) or abs(info[n] - actual[n]) > max(1e-9, 1e-6 * actual[n])]
    return out + [("forbidden_key", name, "") for name in ("annotations.json", "info.json") if _forbidden(spark, f"{root}/meta/{name}")]


def _frame_checks(spark: SparkSession, root: str, info: dict, episodes: DataFrame) -> list[DataFrame]:
    e = F.col("episode_index")
    schemas = release_checks.payload_schemas(spark, root).persist()
    parts = [release_checks.schema_issues(schemas, dataset.features(info)), episodes.where("episode_index <> row").select(*_issue("contiguity", e, F.col("row")))]
    held = {r.name for r in schemas.select("name").distinct().collect()}  # a handful of columns
    if not set(release_checks.REQUIRED) <= held:
        return parts
    frames = _frames(spark, root).select(*release_checks.REQUIRED)
    offsets = reindex.running_offsets(episodes.select("episode_index", "length"))
    shift = frames.groupBy("episode_index").agg(F.min(F.col("index") - F.col("frame_index")).alias("a"), F.max(F.col("index") - F.col("frame_index")).alias("b"))
    return [
        *parts,
        release_checks.frame_value_issues(frames),
        reindex.frame_contiguity(frames).join(episodes.select("episode_index", "length"), "episode_index", "full_outer").where("NOT coalesce(contiguous, false) OR NOT (frames <=> length)").select(*_issue("frames", e, F.col("frames"))),
        reindex.timestamp_order(frames).where("breaks > 0").select(*_issue("timestamps", e, F.col("breaks"))),
        shift.join(offsets, "episode_index").where("a <> global_offset OR b <> global_offset").select(*_issue("global_index", e, F.col("a"))),
    ]


def _annotation_checks(spark: SparkSession, root: str, notes: dict, episodes: DataFrame) -> list[DataFrame]:
    mode, k, least, e = notes["mode"], len(notes["subtasks"]), notes["min_segment_frames"], F.col("episode_index")
    said = [(int(i), v["start_subtask_index"], v["boundaries"]) for i, v in notes["episodes"].items()]
    annotated = spark.createDataFrame(said, "episode_index long, start_subtask_index int, boundaries array<long>").join(episodes.select("episode_index", "length"), "episode_index", "full_outer")
    codes = rules.validate_annotation("start_subtask_index", "boundaries", "length", k, F.lit(mode), least)
    return [
        annotated.where("start_subtask_index IS NULL OR length IS NULL").select(*_issue("annotation_set", e, F.lit("episode or annotation missing"))),
        annotated.where("start_subtask_index IS NOT NULL AND length IS NOT NULL").withColumn("codes", codes).where("size(codes) > 0").select(*_issue("annotation", e, F.array_join("codes", ","))),
        _task_info(spark, root, notes, annotated),
    ]


def _payload_checks(spark: SparkSession, root: str, info: dict, episodes: DataFrame, n: int, source: str | None) -> list[DataFrame]:
    parts = []
    if info.get("splits"):
        ranges = [(s, v) for s, v in info["splits"].items()]
        split = spark.createDataFrame(ranges, "split string, v string").withColumn("r", text.split_range("v"))
        parts.append(split.where("r IS NULL").select(*_issue("splits", F.col("split"), F.col("v"))))
        parts.append(reindex.split_coverage(split.where("r IS NOT NULL").select("split", "r.first", "r.last"), n).select(*_issue("splits", F.col("split"), F.col("issue"))))
    expected = episodes.select(F.col("parquet").alias("path")).union(dataset.video_table(episodes, info).select("path"))
    folders = [folder for _, folder, _ in SIZES if os.path.isdir(f"{root}/{folder}")]
    actual = reduce(DataFrame.union, (_payload(spark, root, f, "*").select("path") for f in folders)) if folders else expected.limit(0)
    parts.append(reindex.set_difference(expected, actual, "path").select(*_issue("payload", F.col("path"), F.col("side"))))
    if source is not None:
        apart = reindex.digest_difference(payload_digests(spark, source), payload_digests(spark, root))
        parts.append(apart.select(*_issue("source_payload", F.col("path"), F.col("difference"))))
    return parts


def _forbidden(spark: SparkSession, path: str) -> bool:
    from ..functions.jsontext import has_forbidden

    return has_forbidden(dataset.read_json(spark, path), frozenset(text.FORBIDDEN_KEYS))


def _task_info(spark: SparkSession, root: str, notes: dict, annotated: DataFrame) -> DataFrame:
    """Segments of task_info against the annotations' own, both ways, with skills and texts; paraphrased texts need only keep the rules for them."""
    raw = json.loads(dataset.read_text(spark, f"{root}/task_info/task_0.json"))
    said = [(x["episode_id"], i, a["start_frame"], a["end_frame"], a["skill"], a["action_text"]) for x in raw for i, a in enumerate(x["label_info"]["action_config"])]
    names = "episode_index long, segment_index int, start_frame long, end_frame long, skill string, text string"
    template = spark.createDataFrame([(i, s["skill"], s["text"]) for i, s in enumerate(notes["subtasks"])], "subtask_index int, skill string, text string")
    own = segments.with_template(segments.annotation_segments(annotated.where("start_subtask_index IS NOT NULL AND length IS NOT NULL")), template)
    columns = [c.split(" ")[0] for c in names.split(", ")]
    a, b = own.select(*columns), spark.createDataFrame(said, names)
    if notes.get("augmentation"):
        keys = ["episode_index", "segment_index"]
        fine = text.valid_paraphrase("text", "said", notes["augmentation"]["language"])
        b = b.join(a.select(*keys, F.col("text").alias("said")), keys, "left").withColumn("text", F.when(fine, F.col("said")).otherwise(F.col("text"))).select(*columns)
    both = a.exceptAll(b).withColumn("side", F.lit("missing")).union(b.exceptAll(a).withColumn("side", F.lit("unexpected")))
    return both.select(F.lit("task_info").alias("check"), F.concat_ws("/", "episode_index", "segment_index").alias("subject"), F.col("side").alias("detail"))


def _stats_checks(spark: SparkSession, root: str, info: dict, episodes: DataFrame, level: str, source: str | None, decode: media.Decoder | None) -> list[DataFrame]:
    """Both statistics files against their features, their own rules and the payload."""
    whole, each = f"{root}/meta/stats.json", f"{root}/meta/episodes_stats.jsonl"
    lacking = [("stats_missing", os.path.basename(f), "") for f in (whole, each) if not os.path.exists(f)]
    if lacking:
        return [spark.createDataFrame(lacking, CHECK)]
    legacy = level in ("legacy_structural", "source_backed_legacy")
    said, rows = dataset.read_json(spark, whole), dataset.read_jsonl(spark, each)
    cameras = dataset.camera_keys(info)
    numeric = [(n, math.prod(shape)) for n, kind, shape in dataset.features(info) if kind.startswith(("int", "float"))]
    images = [(c, 3) for c in cameras] if decode is not None or any(c in said for c in cameras) else []
    published = spark.createDataFrame(release_checks.stats_rows(said), release_checks.STATS_ROW)
    by_episode = spark.createDataFrame([(r.get("episode_index"), *x) for r in rows for x in release_checks.stats_rows(r.get("stats") or {})], f"episode long, {release_checks.STATS_ROW}")
    keys, own = ["feature", "component"], ["episode", "feature", "component"]
    is_image = F.col("feature").isin(cameras)
    parts = [
        release_checks.coverage_issues(published, numeric + images, "stats_coverage"),
        release_checks.coverage_issues(by_episode, numeric, "episode_stats_coverage", ["episode"]),
        reindex.set_difference(episodes.select(F.col("episode_index").alias("episode")), by_episode.select("episode").distinct(), "episode").select(*_issue("episode_stats", F.col("episode"), F.col("side"))),
    ]
    for table, names, image in ((published.where(~is_image), keys, False), (published.where(is_image), keys, True), (by_episode, own, False)):
        wrong = statistics.stats_issues(table, names, image).where("size(issues) > 0")
        parts.append(wrong.select(*_issue("stats_rules", F.concat_ws("/", *names), F.array_join("issues", ","))))
    actual = recomputed(spark, root, [n for n, _ in numeric])
    compared = [(published.where(~is_image), actual.where("episode IS NULL").drop("episode"), keys), (by_episode, actual.where("episode IS NOT NULL"), own)]
    if level == "strict_deep":
        compared.append((published.where(is_image), video_stats(spark, root, info, decode), keys))
    for table, real, names in compared:
        apart = statistics.compare_stats(table, real, names, legacy)
        if legacy:
            apart = apart.where(F.col("metric").isin("min", "max", "mean", "std", "count"))
        parts.append(apart.select(*_issue("stats", F.concat_ws("/", *names), F.col("metric"))))
    if source is not None and os.path.exists(f"{source}/meta/stats.json"):
        theirs = dataset.read_json(spark, f"{source}/meta/stats.json")
        parts.append(release_checks.key_differences(sorted(theirs), sorted(said), "source_stats_keys", spark))
        if level == "source_backed_legacy" and theirs != said:
            parts.append(spark.createDataFrame([("source_stats", "stats.json", "changed")], CHECK))
    return parts
