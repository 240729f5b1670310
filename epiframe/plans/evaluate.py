"""Evaluation of a work folder against golden annotations, with gates and a report that is never overwritten."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..functions import rules
from ..operators import evaluation
from ..sources import dataset, sinks
from .store import Store


def golden(spark: SparkSession, root: str) -> DataFrame:
    """(episode_index, length, start_subtask_index, boundaries) of a golden annotation folder, which must name each episode once."""
    notes = dataset.read_json(spark, f"{root}/annotations.json")
    lengths = {r["episode_index"]: r["length"] for r in dataset.read_jsonl(spark, f"{root}/meta/episodes.jsonl")}
    rows = []
    for key, x in notes["episodes"].items():
        e = int(key)
        if x.get("episode_index", e) != e or e not in lengths:
            raise dataset.DatasetError(f"golden episode {key}")
        rows.append((e, lengths[e], x.get("start_subtask_index", 0), x["boundaries"]))
    return spark.createDataFrame(rows, "episode_index long, length long, start_subtask_index int, boundaries array<long>")


def evaluate(spark: SparkSession, config: Config, golden_root: str, fps: float) -> tuple[DataFrame, DataFrame]:
    """One row of metrics, and the gates."""
    g = golden(spark, golden_root)
    records = Store(config.work_dir).records(spark).join(g.select("episode_index", "length"), "episode_index")
    predicted = records.where("final_annotation IS NOT NULL").select("episode_index", "length", "status", F.col("final_annotation.start_subtask_index").alias("start_subtask_index"), F.col("final_annotation.boundaries").cast("array<long>").alias("boundaries"))
    codes = rules.validate_annotation("start_subtask_index", "boundaries", "length", len(config.subtasks), F.lit(config.mode), config.sampling.min_segment_frames)
    broken = predicted.select("episode_index", (F.size(codes) > 0).alias("_a"))
    told = records.select("episode_index", rules.rejected("validation_issues", "review_reasons", "failure_category").alias("_b"))
    violations = told.join(broken, "episode_index", "left").select("episode_index", (F.col("_b") | F.coalesce("_a", F.lit(False))).alias("violates"))
    rows = evaluation.aligned(g, predicted, records.select("episode_index", "status"), violations)
    m = evaluation.metrics(rows, fps)
    return m, evaluation.launch_gates(m)


@dataclass(frozen=True)
class DaggerServices:
    """sample: (episode, first frame, frame behind the last) to evidence; infer: from evidence to a dict of start_subtask_index, boundaries, status and, if known, violated."""

    sample: Callable[[int, int, int], object]
    infer: Callable[[object], dict]


def predict_views(views: DataFrame, services: DaggerServices) -> DataFrame:
    """views (``evaluation.dagger_views``) with view_id, predicted_start, predicted_boundaries, status and told, asked for in the tasks."""
    names = ["view_id", *views.columns]
    numbered = views.select(F.xxhash64("source_episode", "kind", "start_frame").alias("view_id"), *views.columns)
    fields = [*numbered.schema.fields, T.StructField("predicted_start", T.IntegerType()), T.StructField("predicted_boundaries", T.ArrayType(T.LongType())), T.StructField("status", T.StringType()), T.StructField("told", T.BooleanType())]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = [services.infer(services.sample(int(e), int(a), int(b))) for e, a, b in zip(p.source_episode, p.start_frame, p.end_frame, strict=True)]
            for g in got:
                if type(g["start_subtask_index"]) is not int or any(type(x) is not int for x in g["boundaries"]) or g["status"] not in ("accepted", "needs_review", "failed"):
                    raise ValueError("not the form of a prediction")
            p["predicted_start"] = [g["start_subtask_index"] for g in got]
            p["predicted_boundaries"] = [list(g["boundaries"]) for g in got]
            p["status"] = [g["status"] for g in got]
            p["told"] = [bool(g.get("violated", False)) for g in got]
            yield p[[*names, "predicted_start", "predicted_boundaries", "status", "told"]]

    return numbered.mapInPandas(run, T.StructType(fields))


def evaluate_dagger(views: DataFrame, services: DaggerServices, fps: float, min_segment: int = 1, false_accept_seconds: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """One row of metrics over virtual views, and the gates. A prediction that breaks a rule of its view counts as a violation."""
    rows = predict_views(views, services).persist()  # the model is asked once
    breaks = rules.dagger_violates("kind", "predicted_start", "predicted_boundaries", "expected_start", "expected_boundaries", F.col("end_frame") - F.col("start_frame"), min_segment)
    key = F.col("view_id").alias("episode_index")
    aligned = evaluation.aligned(
        rows.select(key, F.col("expected_boundaries").alias("boundaries"), F.col("expected_start").alias("start_subtask_index")),
        rows.select(key, F.col("predicted_boundaries").alias("boundaries"), F.col("predicted_start").alias("start_subtask_index")),
        rows.select(key, "status"),
        rows.select(key, (F.col("told") | breaks).alias("violates")),
    )
    m = evaluation.metrics(aligned, fps, false_accept_seconds)
    return m, evaluation.launch_gates(m)


def write_report(metrics: DataFrame, gates: DataFrame, path: str) -> bool:
    """The report; whether all gates passed."""
    g = [r.asDict() for r in gates.collect()]
    sinks.write_new(path, json.dumps({"metrics": metrics.first().asDict(), "gates": g}, sort_keys=True, indent=2) + "\n")
    return all(r["passed"] for r in g)
