"""Review without a server: decision files, a static bundle of evidence, and what of the decisions a reviewer is shown."""

from __future__ import annotations

import html
import json
import os
import shutil
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import boundaries, sampling, text
from ..functions.jsontext import strict_loads
from ..operators import review
from ..sources import sinks
from ..sources.media import check_samples
from .annotate import annotation_issues
from .store import Conflict, Store

DECISION_LIMIT = 64 << 10
DECISION = {"episode_index": int, "source_fingerprint": str, "run_fingerprint": str, "mode": str, "start_subtask_index": int, "boundaries": list}

# The fields of stored decisions that a reviewer sees, and those of a refinement's steps.
COARSE_SHOWN = ["status", "reasons", "observed", "centers", "grids"]
REFINE_SHOWN = ["status", "reasons", "failure", "boundaries"]
STEP_SHOWN = ["boundary", "stage", "pass_id", "center", "radius", "stride", "cameras", "frames", "outcome"]


@dataclass(frozen=True)
class ReviewServices:
    """sample: (episode_index, camera, frames, fps) to samples, as for annotation; fingerprint: an episode's source fingerprint now."""

    sample: Callable[[int, str, list[int], float], list]
    fingerprint: Callable[[int], str] | None = None


def check_decision(value: dict) -> dict:
    """A human's decision, its fields exact and strictly typed."""
    if set(value) != set(DECISION) or any(type(value[k]) is not kind for k, kind in DECISION.items()):
        raise ValueError("a decision has other fields")
    if value["episode_index"] < 0 or value["start_subtask_index"] < 0 or any(type(b) is not int for b in value["boundaries"]):
        raise ValueError("a decision holds whole numbers")
    if value["mode"] not in ("complete", "dagger_patch") or any(len(value[k]) != 64 or set(value[k]) - set("0123456789abcdef") for k in ("source_fingerprint", "run_fingerprint")):
        raise ValueError("a decision names a mode and two SHA-256 digests")
    return value


def load_decision(path: str | Path) -> dict:
    """One decision file: a regular file of at most 64 KiB of strict JSON."""
    path = Path(path)
    if path.is_symlink() or not path.is_file():
        raise ValueError(f"{path} is no regular file")
    with path.open("rb") as f:
        data = f.read(DECISION_LIMIT + 1)
    return check_decision(strict_loads(data.decode(), DECISION_LIMIT))


def load_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """(path, episode_index, source_fingerprint, run_fingerprint, mode, start_subtask_index, boundaries, error) of all decision files of a folder, checked in the tasks."""
    one = check_decision

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for path, n, content in zip(p.path, p.length, p.content, strict=True):
                try:
                    if n > DECISION_LIMIT:
                        raise ValueError("too large")
                    d = one(strict_loads(bytes(content).decode(), DECISION_LIMIT))
                    rows.append((path, *(d[k] for k in DECISION), None))
                except ValueError as e:
                    rows.append((path, *[None] * len(DECISION), str(e)))
            yield pd.DataFrame(rows, columns=["path", *DECISION, "error"]).astype({"episode_index": "Int64", "start_subtask_index": "Int32"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select("path", "length", F.when(F.col("length") <= DECISION_LIMIT, F.col("content")).alias("content"))
    return files.mapInPandas(run, "path string, episode_index long, source_fingerprint string, run_fingerprint string, mode string, start_subtask_index int, boundaries array<long>, error string")


def apply_file(store: Store, config: Config, lengths: dict[int, int], decision: dict, services: ReviewServices | None = None) -> dict:
    """Accepts an episode that is up for review by a decision file made for this very run and source."""
    e = decision["episode_index"]
    r = store.load(e)
    if r["status"] != "needs_review":
        raise Conflict(f"episode {e} is {r['status']}")
    now = services.fingerprint(e) if services and services.fingerprint else r["source_fingerprint"]
    for name, have in (("source_fingerprint", r["source_fingerprint"]), ("source_fingerprint", now), ("run_fingerprint", r["run_fingerprint"]), ("mode", config.mode)):
        if decision[name] != have:
            raise Conflict(f"the decision is for another {name}")
    issues = annotation_issues(decision["start_subtask_index"], decision["boundaries"], lengths[e], len(config.subtasks), config.mode, config.sampling.min_segment_frames)
    if issues:
        raise ValueError(",".join(issues))
    return store.decide(e, (r["status"], r["updated_at"]), {"start_subtask_index": decision["start_subtask_index"], "boundaries": decision["boundaries"]}, note="file")


def decision_summary(details: str) -> dict:
    """What of a record's stored decisions is shown: named fields only, answers and prompts never."""
    d = json.loads(details or "{}")
    out = {}
    for kind, shown in (("coarse", COARSE_SHOWN), ("refine", REFINE_SHOWN)):
        if isinstance(d.get(kind), dict):
            out[kind] = {k: d[kind][k] for k in shown if k in d[kind]}
            steps = d[kind].get("provenance")
            if isinstance(steps, list):
                out[kind]["provenance"] = [{k: s[k] for k in STEP_SHOWN if k in s} for s in steps if isinstance(s, dict)]
    return out


def decision_summaries(records: DataFrame) -> DataFrame:
    """(episode_index, summary as JSON) of records (episode_index, sampling_details)."""
    one = decision_summary

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"episode_index": p.episode_index, "summary": [json.dumps(one(d), sort_keys=True) for d in p.sampling_details]})

    return records.select("episode_index", "sampling_details").mapInPandas(run, "episode_index long, summary string")


def bundle_frames(records: DataFrame, config: Config, fps: float) -> DataFrame:
    """(episode_index, candidate, frame_index, camera, camera_order): the images of a bundle, from records (episode_index, length, boundaries: the arrays of candidates).

    A candidate's context is the window around it and the frame before it, over all cameras; candidates are
    admitted whole, in order, within the image budget.
    """
    s = config.sampling
    cameras = list(dict.fromkeys([config.primary_camera, *config.refine_cameras]))
    w = sampling.window_parameters(F.lit(float(fps)), s.refine_window_seconds, s.refine_fps, s.dense_radius_seconds)
    rows = records.withColumn("c", review.candidate_frames("length", "boundaries")).select("episode_index", "length", w.alias("w"), F.explode("c.frames").alias("candidate"))
    context = F.array_union(sampling.window_indices(F.col("candidate"), F.col("w.radius"), F.col("w.stride"), "length"), F.array(F.greatest(F.col("candidate") - 1, F.lit(0)), F.col("candidate")))
    rows = rows.withColumn("frames", F.array_sort(context)).withColumn("cost", F.size("frames") * len(cameras))
    kept = review.within_budget(rows, "episode_index", "candidate", "cost", review.IMAGES)
    listed = F.array(*(F.struct(F.lit(i).alias("o"), F.lit(c).alias("c")) for i, c in enumerate(cameras)))
    out = kept.select("episode_index", "candidate", F.explode("frames").alias("frame_index")).withColumn("x", F.explode(listed))
    return out.select("episode_index", "candidate", "frame_index", F.col("x.c").alias("camera"), F.col("x.o").alias("camera_order"))


def write_images(frames: DataFrame, folder: str, fps: float, services: ReviewServices) -> DataFrame:
    """(episode_index, path, camera, frame_index, seconds): the images of bundle_frames, sampled and written by the tasks, an episode's camera decoded once."""
    sample = services.sample
    rows = frames.select("episode_index", "camera", text.camera_slug("camera").alias("slug"), "frame_index", boundaries.timestamp_seconds("frame_index", fps).alias("seconds")).distinct()
    asked = rows.groupBy("episode_index", "camera", "slug").agg(F.sort_array(F.collect_list("frame_index")).alias("frames"))  # within the image budget

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for e, camera, slug, wanted in zip(p.episode_index, p.camera, p.slug, p.frames, strict=True):
                wanted = [int(f) for f in wanted]
                got = sample(int(e), camera, wanted, fps)
                check_samples(got, wanted, camera, fps)
                where = f"episode_{e:06d}"
                os.makedirs(f"{folder}/{where}", exist_ok=True)
                for x in got:
                    path = f"{where}/{slug}-frame-{x.frame_index}.jpg"
                    with open(f"{folder}/{path}", "wb") as f:
                        f.write(x.jpeg)
                    out.append((int(e), path, camera, x.frame_index, x.timestamp_seconds))
            yield pd.DataFrame(out, columns=["episode_index", "path", "camera", "frame_index", "seconds"])

    return asked.mapInPandas(run, "episode_index long, path string, camera string, frame_index long, seconds double")


def candidates_of(record: dict) -> list[int]:
    """All boundaries that a record's annotation, refinement or coarse answers name."""
    d = json.loads(record["sampling_details"] or "{}")
    found = set((record["final_annotation"] or {}).get("boundaries", []))
    coarse, refine = d.get("coarse") or {}, d.get("refine") or {}
    found |= {b for a in coarse.get("attempts", []) for b in a["boundaries"]} | set(coarse.get("centers", [])) | set(refine.get("boundaries") or [])
    found |= {s["answer"]["boundary"] for s in refine.get("provenance", []) if "answer" in s}
    return sorted(found)


def render(spark: SparkSession, config: Config, lengths: dict[int, int], fps: float, target: str, services: ReviewServices) -> DataFrame:
    """Writes the bundle of all episodes that are up for review: a page, a JSON file for each, images; replaces target as a whole and returns the images' table."""
    store = Store(config.work_dir)
    queue = [store.load(e) for e in sorted(lengths)]
    queue = [r for r in queue if r["status"] == "needs_review"]
    staging = Path(f"{target}.staging")
    shutil.rmtree(staging, ignore_errors=True)
    staging.mkdir(parents=True)
    rows = [(r["episode_index"], lengths[r["episode_index"]], candidates_of(r)) for r in queue]
    records = spark.createDataFrame(rows, "episode_index long, length long, boundaries array<long>")
    frames = bundle_frames(records, config, fps).persist()
    images = write_images(frames, str(staging), fps, services).persist()
    shown: dict[int, list] = {}
    for r in images.orderBy("episode_index", "camera", "frame_index").toLocalIterator():
        shown.setdefault(r.episode_index, []).append({"path": r.path, "camera": r.camera, "frame_index": r.frame_index, "seconds": r.seconds})
    admitted: dict[int, list] = {}
    for r in frames.groupBy("episode_index").agg(F.sort_array(F.collect_set("candidate")).alias("c")).collect():
        admitted[r.episode_index] = list(r.c)
    body = []
    for r in queue:
        e = r["episode_index"]
        kept = admitted.get(e, [])
        payload = {
            "episode_index": e, "source_fingerprint": r["source_fingerprint"], "run_fingerprint": r["run_fingerprint"], "mode": config.mode, "review_reasons": r["review_reasons"], "candidate_annotation": r["final_annotation"],
            "candidates": kept, "omitted_candidates": [c for c in candidates_of(r) if 0 <= c < lengths[e] and c not in kept], "candidate_cap": review.CANDIDATES, "image_cap": review.IMAGES,
            "decision_summaries": decision_summary(r["sampling_details"]), "images": shown.get(e, []),
        }
        sinks.write_json(staging / f"episode_{e:06d}.json", payload)
        body.append(episode_section(payload))
    sinks.write_text(staging / "index.html", page(config, body))
    replace_folder(staging, target)
    return images


def episode_section(x: dict) -> str:
    """An episode's part of the page; every text is escaped."""
    images = "".join(f'<figure><img loading="lazy" src="{html.escape(i["path"], quote=True)}"><figcaption>{html.escape(i["camera"])} {i["frame_index"]} ({i["seconds"]:.3f} s)</figcaption></figure>' for i in x["images"])
    facts = html.escape(json.dumps({k: x[k] for k in ("candidates", "omitted_candidates", "candidate_annotation", "decision_summaries")}, sort_keys=True))
    return f'<section id="episode-{x["episode_index"]}"><h2>Episode {x["episode_index"]}</h2><p>{html.escape(", ".join(x["review_reasons"]))}</p><pre>{facts}</pre>{images}</section>'


def page(config: Config, sections: list[str]) -> str:
    tasks = "".join(f"<li>{html.escape(s.skill)}: {html.escape(s.text)}</li>" for s in config.subtasks)
    return f'<!doctype html><meta charset="utf-8"><title>Review</title><h1>{html.escape(config.high_level_instruction)}</h1><ol start="0">{tasks}</ol>{"".join(sections)}\n'


def replace_folder(staging: Path, target: str | Path) -> None:
    """Puts a finished folder in the place of another, which comes back if that fails."""
    target = Path(target)
    backup = target.with_name(f"{target.name}.before")
    shutil.rmtree(backup, ignore_errors=True)
    held = target.exists()
    if held:
        os.rename(target, backup)
    try:
        os.rename(staging, target)
    except BaseException:
        if held:
            os.rename(backup, target)
        raise
    shutil.rmtree(backup, ignore_errors=True)
