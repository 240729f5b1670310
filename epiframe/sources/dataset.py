"""Episode data sets on disk, read with Spark's readers, and everything that can be wrong with them as rows."""

from __future__ import annotations

import string
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsontext import StrictJSONError, strict_jsonl, strict_loads
from ..functions.sampling import fps_matches

VERSION = "v2.1"
JSON_LIMIT = 64 << 20


class DatasetError(ValueError):
    """A data set that can't be read."""


def read_text(spark: SparkSession, path: str) -> str:
    """A small file by any path that Spark reads."""
    rows = spark.read.text(path, wholetext=True).take(2)
    if len(rows) > 1:
        raise DatasetError(f"{path} is no single file")
    return rows[0][0] if rows else ""


def read_json(spark: SparkSession, path: str, limit: int = JSON_LIMIT) -> dict:
    try:
        return strict_loads(read_text(spark, path), limit)
    except StrictJSONError as e:
        raise DatasetError(f"{path}: {e}") from e


def read_jsonl(spark: SparkSession, path: str, limit: int = JSON_LIMIT) -> list[dict]:
    try:
        return strict_jsonl(read_text(spark, path), limit)
    except StrictJSONError as e:
        raise DatasetError(f"{path}: {e}") from e


def jsonl_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of any number as a table with line numbers within files and a flag for lines that do not fit."""
    text = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    row = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    rows = text.withColumn("row", row).withColumn("bad", F.coalesce(F.col("row._bad").isNotNull(), F.lit(True)) | (F.trim("value") == ""))
    return rows.select("file", "bad", "row.*").drop("_bad")


def check_template(template: str, needed: set[str]) -> None:
    """Fields of path templates are episode_chunk, episode_index and video_key; no path leaves its root."""
    try:
        parts = list(string.Formatter().parse(template))
    except ValueError as e:
        raise DatasetError(f"path template {template!r}: {e}") from e
    names = {n for _, n, _, _ in parts if n is not None}
    if names - {"episode_chunk", "episode_index", "video_key"} or any("{" in (s or "") for _, _, s, _ in parts):
        raise DatasetError(f"path template {template!r} has other fields")
    if needed - names:
        raise DatasetError(f"path template {template!r} lacks {sorted(needed - names)}")
    if template.startswith("/") or ".." in template.split("/"):
        raise DatasetError(f"path template {template!r} leaves the data set")


def features(info: dict) -> list[tuple[str, str, list[int]]]:
    """(name, dtype, shape) in declared order; cameras are those of dtype video."""
    declared = info.get("features")
    if not isinstance(declared, dict) or not all(isinstance(v, dict) and isinstance(v.get("dtype"), str) for v in declared.values()):
        raise DatasetError("features must map names to dtypes")
    return [(k, v["dtype"], list(v.get("shape", [1]))) for k, v in declared.items()]


def camera_keys(info: dict) -> list[str]:
    found = [n for n, kind, _ in features(info) if kind == "video"]
    if not found:
        raise DatasetError("no camera is declared")
    return found


def _need(info: dict, name: str, kind, least=None):
    v = info.get(name)
    if isinstance(v, bool) or not isinstance(v, kind) or (least is not None and not v >= least):
        raise DatasetError(f"info.json: {name} is {v!r}")
    return v


def episode_table(spark: SparkSession, rows: list[dict], info: dict) -> DataFrame:
    """episodes.jsonl as (row, episode_index, length, task, tasks, parquet)."""
    size = _need(info, "chunks_size", int, 1)
    template = info["data_path"]
    data = []
    for i, r in enumerate(rows):
        e, n, tasks = r.get("episode_index"), r.get("length"), r.get("tasks")
        if type(e) is not int or type(n) is not int or n < 1 or not isinstance(tasks, list) or not tasks or not all(isinstance(t, str) and t for t in tasks):
            raise DatasetError(f"episodes.jsonl, row {i}")
        data.append((i, e, n, tasks[0], len(tasks), template.format(episode_chunk=e // size, episode_index=e)))
    return spark.createDataFrame(data, "row long, episode_index long, length long, task string, tasks int, parquet string")


def parquet_rows(spark: SparkSession, root: str, episodes: DataFrame) -> DataFrame:
    """(parquet, rows): counted by Spark from the files' own metadata column, so any store that Spark reads will do."""
    counts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{root}/data").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    return counts.select(F.regexp_extract("file", "(data/.*)$", 1).alias("parquet"), "rows")


def video_table(episodes: DataFrame, info: dict) -> DataFrame:
    """(episode_index, length, camera, path): one row for each camera's video."""
    size, template, keys = info["chunks_size"], info["video_path"], camera_keys(info)

    def paths(parts):
        for p in parts:
            rows = [(e, n, k, template.format(episode_chunk=e // size, episode_index=e, video_key=k)) for e, n in zip(p.episode_index, p.length, strict=True) for k in keys]
            yield pd.DataFrame(rows, columns=["episode_index", "length", "camera", "path"])

    return episodes.select("episode_index", "length").mapInPandas(paths, "episode_index long, length long, camera string, path string")


def probe_videos(videos: DataFrame, root: str, probe: Callable[[str], tuple[int, float]]) -> DataFrame:
    """videos with frames and fps by the probe, run in the tasks; error is what a probe raised."""

    def run(parts):
        for p in parts:
            got = []
            for path in p.path:
                try:
                    n, fps = probe(f"{root}/{path}")
                    got.append((int(n), float(fps), None))
                except Exception as e:  # what a decoder raises is data here
                    got.append((None, None, f"{type(e).__name__}: {e}"))
            p[["frames", "fps", "error"]] = pd.DataFrame(got, columns=["frames", "fps", "error"], index=p.index)
            yield p

    return videos.mapInPandas(run, "episode_index long, length long, camera string, path string, frames long, fps double, error string")


def inspect(spark: SparkSession, root: str, cameras: list[str], probe: Callable[[str], tuple[int, float]]) -> tuple[dict, DataFrame, DataFrame]:
    """info.json, the episodes, and a table (check, subject, detail) of all that is wrong; an empty one means a sound data set."""
    info = read_json(spark, f"{root}/meta/info.json")
    if info.get("codebase_version") != VERSION:
        raise DatasetError(f"codebase_version must be {VERSION}")
    fps = _need(info, "fps", (int, float), 1e-9)
    for name in ("total_episodes", "total_frames", "total_tasks", "total_chunks"):
        _need(info, name, int, 0)
    check_template(_need(info, "data_path", str), {"episode_index"})
    check_template(_need(info, "video_path", str), {"episode_index", "video_key"})
    keys = camera_keys(info)
    rows = read_jsonl(spark, f"{root}/meta/episodes.jsonl")
    tasks = read_jsonl(spark, f"{root}/meta/tasks.jsonl")
    found: list[tuple[str, str, str]] = [("camera", c, "not in the data set") for c in cameras if c not in keys]
    index, texts = [t.get("task_index") for t in tasks], [t.get("task") for t in tasks]
    if sorted(map(str, index)) != sorted(map(str, range(len(tasks)))) or len(set(texts)) != len(texts) or not all(isinstance(t, str) and t for t in texts):
        found.append(("tasks", "tasks.jsonl", "indices 0 to N-1 and distinct texts are needed"))
    size = _need(info, "chunks_size", int, 1)
    for name, want in (("total_episodes", len(rows)), ("total_tasks", len(tasks)), ("total_chunks", -(-len(rows) // size)), ("total_videos", len(rows) * len(keys))):
        if name in info and info[name] != want:
            found.append(("total", name, f"{info[name]}, expected {want}"))
    episodes = episode_table(spark, rows, info)
    known = spark.createDataFrame([(t,) for t in texts if isinstance(t, str)], "task string")

    def issue(check: str, subject, detail):
        return F.lit(check).alias("check"), subject.cast("string").alias("subject"), F.concat_ws(" ", *detail).alias("detail")

    e = F.col("episode_index")
    bad = episodes.where("episode_index <> row").select(*issue("contiguity", e, [F.lit("at row"), F.col("row")]))
    bad = bad.union(episodes.where("tasks <> 1").select(*issue("one_task", e, [F.col("tasks")])))
    bad = bad.union(episodes.join(F.broadcast(known), "task", "left_anti").select(*issue("known_task", e, [F.col("task")])))
    bad = bad.union(episodes.groupBy("parquet").agg(F.count("*").alias("n")).where("n > 1").select(*issue("distinct_path", F.col("parquet"), [F.col("n")])))
    held = episodes.join(parquet_rows(spark, root, episodes), "parquet", "left")
    bad = bad.union(held.where("NOT (rows <=> length)").select(*issue("parquet_rows", e, [F.coalesce("rows", F.lit(0)), F.lit("expected"), F.col("length")])))
    seen = probe_videos(video_table(episodes, info), root, probe)
    wrong = F.col("error").isNotNull() | (F.col("frames") != F.col("length")) | ~fps_matches("fps", float(fps))
    bad = bad.union(seen.where(wrong).select(*issue("video", F.concat_ws("/", e.cast("string"), F.col("camera")), [F.coalesce("error", F.concat_ws(" ", F.col("frames"), F.lit("frames at"), F.col("fps")))])))
    total = episodes.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).where(F.col("n") != info["total_frames"])
    bad = bad.union(total.select(*issue("total", F.lit("total_frames"), [F.lit(str(info["total_frames"])), F.lit("expected"), F.col("n")])))
    if found:
        bad = bad.union(spark.createDataFrame(found, "check string, subject string, detail string"))
    return info, episodes, bad
