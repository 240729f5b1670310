"""Checks of a release's parts as tables of what is wrong: payload schemas, frame columns, statistics files, coverage, reports."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METRICS

#: Columns that every episode's frames have.
REQUIRED = ["episode_index", "frame_index", "index", "task_index", "timestamp"]
SCHEMA = "path string, name string, kind string, width int"


def payload_schemas(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, kind, width): the columns of each parquet file under data by its footer; kind is the innermost type, width a fixed list's or null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/data")

    def footers(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for p in parts:
            rows = []
            for path, content in zip(p.path, p.content, strict=True):
                for f in pq.read_schema(pa.BufferReader(content)):
                    kind, width = f.type, None
                    if pa.types.is_fixed_size_list(kind):
                        width = kind.list_size
                    while pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
                        kind = kind.value_type
                    rows.append((path, f.name, str(kind), width))
            yield pd.DataFrame(rows, columns=["path", "name", "kind", "width"]).astype({"width": "Int32"})

    return files.select(F.regexp_extract("path", "(data/.*)$", 1).alias("path"), "content").mapInPandas(footers, SCHEMA)


def dtype_fits(declared, kind):
    """Whether a declared dtype is of the physical kind; unsigned features fit no declaration."""
    d, k = F.col(declared), F.col(kind)
    return (
        (d.startswith("int") & k.rlike("^u?int[0-9]+$"))
        | (d.startswith("float") & k.isin("halffloat", "float", "double"))
        | ((d == "bool") & (k == "bool"))
        | (d.isin("string", "utf8") & (k == "string"))
    )


def schema_issues(schemas: DataFrame, features: list[tuple[str, str, list[int]]]) -> DataFrame:
    """(check, subject, detail) where files lack declared or required columns, or differ from the declared dtype or shape, or from one another.

    features: (name, dtype, shape), cameras among them, which have no column.
    """
    spark = schemas.sparkSession
    rows = [(n, kind, math.prod(shape) if shape and all(type(x) is int and x > 0 for x in shape) else -1, list(shape) == [1]) for n, kind, shape in features if kind != "video"]
    known = {r[0] for r in rows}
    rows += [(n, None, None, None) for n in REQUIRED if n not in known]
    declared = F.broadcast(spark.createDataFrame(rows, "name string, declared string, cells long, scalar boolean"))
    paths = schemas.select("path").distinct()
    every = paths.join(declared).join(schemas, ["path", "name"], "left")  # declared: one row for each feature
    missing = every.where("kind IS NULL").select(F.lit("column_missing").alias("check"), F.col("path").alias("subject"), F.col("name").alias("detail"))
    held = every.where("kind IS NOT NULL AND declared IS NOT NULL")
    wrong = held.where(~dtype_fits("declared", "kind")).select(F.lit("dtype"), "path", "name")
    shape = held.where("cells < 0 OR (width IS NOT NULL AND width <> cells) OR (width IS NULL AND NOT scalar)").select(F.lit("shape"), "path", "name")
    whole = schemas.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("name", "kind", "width"))).cast("string").alias("own"))  # one file's columns
    usual = whole.groupBy("own").agg(F.count("*").alias("n"), F.min("path").alias("path")).orderBy(F.desc("n"), "path").limit(1)
    apart = whole.join(F.broadcast(usual.select("own")), "own", "left_anti").select(F.lit("schema_differs"), "path", F.lit(None).cast("string"))
    return missing.union(wrong).union(shape).union(apart)


def frame_value_issues(frames: DataFrame, task_index: int = 0) -> DataFrame:
    """(check, subject, detail): episodes with frames of another task, or with times that are not finite and from 0 on."""
    bad_time = F.col("timestamp").isNull() | F.isnan("timestamp") | (F.abs("timestamp") == float("inf")) | (F.col("timestamp") < 0)
    rows = frames.groupBy("episode_index").agg(F.count_if(~F.col("task_index").eqNullSafe(F.lit(task_index))).alias("task_index"), F.count_if(bad_time).alias("timestamp_range"))
    rows = rows.unpivot("episode_index", ["task_index", "timestamp_range"], "check", "n")
    return rows.where("n > 0").select("check", F.col("episode_index").cast("string").alias("subject"), F.col("n").cast("string").alias("detail"))


def stats_rows(stats: dict) -> list[tuple]:
    """(feature, component, metrics) of a statistics object; nested lists of one value count as it, what is no number as null."""

    def cell(values, i: int):
        x = values[i] if isinstance(values, list) and i < len(values) else None
        while isinstance(x, list) and len(x) == 1:
            x = x[0]
        return x if isinstance(x, (int, float)) and not isinstance(x, bool) else None

    out = []
    for feature, s in stats.items():
        own = s if isinstance(s, dict) else {}
        for i in range(len(own["mean"]) if isinstance(own.get("mean"), list) else 1):
            values = {m: cell(own.get(m), 0 if m == "count" else i) for m in METRICS}
            out.append((feature, i, *(None if v is None else int(v) if m == "count" else float(v) for m, v in values.items())))
    return out


STATS_ROW = "feature string, component int, " + ", ".join(f"`{m}` {'long' if m == 'count' else 'double'}" for m in METRICS)


def coverage_issues(found: DataFrame, expected: list[tuple[str, int]], check: str, by: list[str] = ()) -> DataFrame:
    """(check, subject, detail): features or components (feature, component) that statistics lack or have too many, for each by."""
    spark = found.sparkSession
    rows = [(f, i) for f, wide in expected for i in range(wide)]
    want = F.broadcast(spark.createDataFrame(rows, "feature string, component int"))
    groups = found.select(*by).distinct() if by else spark.range(1).select()
    every = groups.join(want)
    keys = [*by, "feature", "component"]
    lacking = every.join(found.select(*keys), keys, "left_anti").withColumn("side", F.lit("missing"))
    extra = found.select(*keys).join(want, ["feature", "component"], "left_anti").withColumn("side", F.lit("unexpected"))
    return lacking.unionByName(extra).select(F.lit(check).alias("check"), F.concat_ws("/", *by, "feature", "component").alias("subject"), F.col("side").alias("detail"))


def key_differences(a: list[str], b: list[str], check: str, spark: SparkSession) -> DataFrame:
    """(check, subject, detail): names that only one of two lists has."""
    rows = [(check, n, "missing" if n in a else "unexpected") for n in sorted(set(a) ^ set(b))]
    return spark.createDataFrame(rows, "check string, subject string, detail string")


def augmentation_issues(requested: DataFrame, texts: DataFrame) -> DataFrame:
    """(episode_index, subtask_index, side): sub-tasks (episode_index, start_subtask_index, boundaries) covers without a text, and texts of none."""
    want = requested.select("episode_index", F.explode(F.sequence("start_subtask_index", F.col("start_subtask_index") + F.size("boundaries"))).alias("subtask_index"))
    keys = ["episode_index", "subtask_index"]
    missing = want.join(texts, keys, "left_anti").select(*keys, F.lit("missing").alias("side"))
    twice = texts.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.lit("repeated"))
    return missing.union(texts.join(want, keys, "left_anti").select(*keys, F.lit("unexpected"))).union(twice)


def first_preview(annotations: DataFrame) -> DataFrame:
    """(episode_index, before, boundary): the first boundary of the first episode that has one, and the frame before it."""
    found = annotations.where("size(boundaries) > 0").select("episode_index", F.get("boundaries", F.lit(0)).cast("long").alias("b"))
    first = found.agg(F.min_by(F.struct("episode_index", "b"), "episode_index").alias("x")).where("x IS NOT NULL")
    return first.select("x.episode_index", (F.col("x.b") - 1).alias("before"), F.col("x.b").alias("boundary"))


# The levels of validation and the checks that each leaves out.
LEVELS = {
    "strict_deep": [],
    "strict_structural": ["video_payload_stat_equality"],
    "legacy_structural": ["numeric_quantile_payload_equality", "video_payload_stat_equality"],
    "source_backed_legacy": ["numeric_quantile_payload_equality", "video_payload_stat_equality"],
}


def report_issues(report: dict) -> list[str]:
    """What contradicts in a conversion report: files, digests, level or counts."""
    files, digests = report.get("payload_files", []), report.get("payload_digests", {})
    checks = [
        (files != sorted(set(files)), "files_not_sorted_and_distinct"),
        (set(files) != set(digests), "digests_not_of_files"),
        (any(not isinstance(d, str) or len(d) != 64 or set(d) - set("0123456789abcdef") for d in digests.values()), "digest_form"),
        (report.get("validation_level") not in LEVELS, "unknown_level"),
        (report.get("validation_level") in LEVELS and list(report.get("skipped_checks", [])) != LEVELS[report["validation_level"]], "skips_not_of_level"),
        (report.get("episodes", 0) < 1 or report.get("frames", 0) < report.get("episodes", 0), "counts"),
    ]
    return [name for bad, name in checks if bad]
