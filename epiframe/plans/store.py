"""The durable state of a run: a JSON document for each episode, with its transitions, and a manifest.

The driver is the only writer; executors compute results and the driver commits them. A write is
whole or absent, checks the record that it replaces, and leaves an event that links to the last one.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import fcntl
import hashlib
import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.jsontext import canonical, stable_hash, strict_loads
from ..operators import reindex, workspace
from ..schemas import EDGES, HUMAN_EDGES, RECORD, STATUSES
from ..sources import dataset
from ..sources.sinks import write_if_changed, write_json
from .annotate import PROMPT_VERSION

RECORD_LIMIT = 16 << 20
LOG_LIMIT = 64 << 20


class Conflict(RuntimeError):
    """The stored record is not the one that the writer has seen."""


class TakeoverRequired(RuntimeError):
    """A human decision on an episode that is not up for review."""


def now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


def source_fingerprint(root: str, length: int, parquet: str, videos: dict[str, str]) -> str:
    """Of what shows that cached evidence is stale: lengths, paths, sizes and times."""
    def stat(path: str) -> os.stat_result:
        return os.stat(os.path.join(root, path))

    return stable_hash(
        {
            "episode_length": length,
            "parquet": {"path": parquet, "size": stat(parquet).st_size},
            "videos": [{"camera": c, "path": p, "size": stat(p).st_size, "mtime_ns": stat(p).st_mtime_ns} for c, p in sorted(videos.items())],
        },
        ascii_only=False,
    )


def run_fingerprint(config: Config, revision: str) -> str:
    return stable_hash({"config_hash": config.stable_hash(), "prompt_version": PROMPT_VERSION, "model_repo": config.model.name, "model_revision": revision}, ascii_only=False)


def event_id(run: str, episode: int, source: str, target: str, time: str, event: str, category: str | None, reasons: list[str]) -> str:
    return stable_hash({"run_fingerprint": run, "episode": episode, "from_status": source, "to_status": target, "updated_at": time, "event": event, "category": category, "reasons": reasons})


class Store:
    def __init__(self, work_dir: str | Path, clock: Callable[[], dt.datetime] = now):
        self.root, self.clock = Path(work_dir), clock

    def path(self, episode: int) -> Path:
        return self.root / "episodes" / f"episode_{episode:06d}.json"

    @contextlib.contextmanager
    def locked(self) -> Iterator[None]:
        self.root.mkdir(parents=True, exist_ok=True)
        with (self.root / ".lock").open("a") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            yield

    def manifest(self) -> dict:
        return strict_loads((self.root / "manifest.json").read_text(encoding="utf-8"), RECORD_LIMIT)

    def checked_manifest(self, spark: SparkSession, config: Config) -> tuple[dict, DataFrame]:
        """The manifest, whose run must be the configuration's, and the records that are of another run."""
        m = self.manifest()
        if m["run_fingerprint"] != run_fingerprint(config, m["model_revision"]):
            raise Conflict("the work folder belongs to another run")
        return m, workspace.provenance_differences(self.records(spark), m)

    def initialise(self, config: Config, revision: str, episodes: list[tuple[int, int, str]]) -> None:
        """A manifest and a pending record for each (index, length, source fingerprint); what is there must match and stays."""
        run = run_fingerprint(config, revision)
        facts = {"run_fingerprint": run, "prompt_version": PROMPT_VERSION, "model_revision": revision, "mode": config.mode, "config_hash": config.stable_hash(), "episodes": len(episodes), "frames": sum(n for _, n, _ in episodes), "cameras": list(dict.fromkeys([config.primary_camera, *config.refine_cameras]))}
        with self.locked():
            if (self.root / "manifest.json").exists():
                if self.manifest() != facts:
                    raise Conflict("the work folder belongs to another run")
            else:
                write_json(self.root / "manifest.json", facts)
            for e, _, fingerprint in episodes:
                if self.path(e).exists():
                    r = self.load(e)
                    if r["run_fingerprint"] == run and r["source_fingerprint"] == fingerprint:
                        continue
                write_json(self.path(e), self._pending(e, run, fingerprint, revision))

    def _pending(self, e: int, run: str, fingerprint: str, revision: str) -> dict:
        t = self.clock().isoformat()
        return {
            "episode_index": e, "status": "pending", "coarse_attempts": [], "refine_attempts": [], "final_annotation": None, "validation_issues": [], "review_reasons": [], "failure_category": None,
            "decision_source": None, "created_at": t, "updated_at": t, "source_fingerprint": fingerprint, "run_fingerprint": run, "prompt_version": PROMPT_VERSION, "model_revision": revision, "sampling_details": "{}", "transitions": [],
        }

    def load(self, episode: int) -> dict:
        r = strict_loads(self.path(episode).read_text(encoding="utf-8"), RECORD_LIMIT)
        if r.get("episode_index") != episode or r.get("status") not in STATUSES:
            raise ValueError(f"{self.path(episode)} is no record of episode {episode}")
        return r

    def transition(self, episode: int, seen: tuple[str, str], target: str, event: str, *, human: bool = False, category: str | None = None, reasons: list[str] = (), **changes) -> dict:
        """Stores the record's next state if it still is as seen (status, updated_at)."""
        with self.locked():
            r = self.load(episode)
            if (r["status"], r["updated_at"]) != tuple(seen):
                raise Conflict(f"episode {episode} has changed")
            source = r["status"]
            if target not in EDGES[source] and not (human and target in HUMAN_EDGES.get(source, ())):
                raise ValueError(f"{source} does not lead to {target}")
            then = dt.datetime.fromisoformat(r["updated_at"])
            t = max(self.clock(), then + dt.timedelta(microseconds=1)).isoformat()
            e = {"event_id": event_id(r["run_fingerprint"], episode, source, target, t, event, category, list(reasons)), "timestamp": t, "episode": episode, "from_status": source, "to_status": target, "event": event, "category": category, "reasons": list(reasons), "human": human}
            r |= {"status": target, "updated_at": t, "failure_category": category, "review_reasons": list(reasons), **changes, "transitions": [*r["transitions"], e]}
            write_json(self.path(episode), r)
            return r

    def invalidate(self, episode: int) -> None:
        with self.locked():
            r = self.load(episode)
            write_json(self.path(episode), self._pending(episode, r["run_fingerprint"], r["source_fingerprint"], r["model_revision"]))

    def commit(self, results: DataFrame) -> dict[str, int]:
        """Stores annotate()'s results as they come, a partition of a few episodes at a time; the counts of new statuses."""
        counts: dict[str, int] = {}
        for x in results.toLocalIterator():
            r = self.load(x.episode_index)
            details = json.loads(x.details)
            path = {"accepted": ["coarse_done", "refine_done", "accepted"], "needs_review": (["coarse_done", "refine_done"] if "refine" in details else []) + ["needs_review"], "failed": ["failed"]}[x.status]
            path = path[path.index(r["status"]) + 1 :] if r["status"] in path else path
            for target in path:
                last = target == path[-1]
                annotation = {"start_subtask_index": x.start_subtask_index, "boundaries": list(x.boundaries)} if x.boundaries is not None and target in ("refine_done", "accepted") else r["final_annotation"]
                source = {"decision_source": "model"} if target == "accepted" else {}
                r = self.transition(x.episode_index, (r["status"], r["updated_at"]), target, "annotated", **source, category=x.failure_category if last else None, reasons=list(x.reasons or []) if last else [], final_annotation=annotation, sampling_details=canonical(details))
            counts[x.status] = counts.get(x.status, 0) + 1
        return counts

    def decide(self, episode: int, expected: tuple[str, str], annotation: dict, takeover: bool = False, note: str = "") -> dict:
        """A human's decision: accepted, with an audit; episodes that are not for review need consent to take over."""
        if expected[0] != "needs_review" and not takeover:
            raise TakeoverRequired(f"episode {episode} is {expected[0]}")
        event = "human_accepted" if expected[0] == "needs_review" else "human_takeover"
        return self.transition(episode, expected, "accepted", event, human=True, final_annotation=annotation, decision_source=f"human:{note}"[:200])

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RECORD).json(str(self.root / "episodes"), multiLine=True)

    def transitions(self, spark: SparkSession) -> DataFrame:
        kind = "transitions array<struct<event_id:string,timestamp:timestamp,episode:long,from_status:string,to_status:string,event:string,human:boolean>>"
        rows = spark.read.schema(kind).json(str(self.root / "episodes"), multiLine=True).selectExpr("inline(transitions)")
        return rows.withColumnRenamed("episode", "episode_index")

    def bad_events(self, episode: int) -> list[str]:
        """The ids of events that are not the digest of their own facts."""
        r = self.load(episode)
        return [e["event_id"] for e in r["transitions"] if e["event_id"] != event_id(r["run_fingerprint"], episode, e["from_status"], e["to_status"], e["timestamp"], e["event"], e["category"], e["reasons"])]

    def write_log(self) -> bool:
        """run.jsonl from the records' events in time order; written only if it differs."""
        events = [e for p in sorted((self.root / "episodes").glob("*.json")) for e in strict_loads(p.read_text(encoding="utf-8"), RECORD_LIMIT)["transitions"]]
        events.sort(key=lambda e: (e["timestamp"], e["episode"], e["event_id"]))
        return write_if_changed(self.root / "run.jsonl", "".join(canonical(e) + "\n" for e in events))


    def read_log(self, spark: SparkSession) -> DataFrame:
        """run.jsonl as a table of events, with a flag for lines that are none."""
        path = self.root / "run.jsonl"
        if path.stat().st_size > LOG_LIMIT:
            raise ValueError(f"{path} is too large")
        rows = dataset.jsonl_table(spark, str(path), "event_id string, timestamp timestamp, episode long, from_status string, to_status string, event string, category string, reasons array<string>, human boolean")
        return rows.withColumnRenamed("episode", "episode_index").drop("file")


def file_digest(path: str | Path) -> str:
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def tree_files(root: str | Path, spark: SparkSession) -> DataFrame:
    """(path, size, digest) of all files under a folder that driver and executors share; the tasks read them."""
    names = [p.relative_to(root).as_posix() for p in Path(root).rglob("*") if p.is_file()]
    one, where = file_digest, str(root)

    def run(parts):
        for p in parts:
            p["size"] = [os.path.getsize(f"{where}/{n}") for n in p.path]
            p["digest"] = [one(f"{where}/{n}") for n in p.path]
            yield p

    files = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, min(256, len(names) // 16)))
    return files.mapInPandas(run, "path string, size long, digest string")


def tree_digest(root: str | Path, spark: SparkSession) -> str:
    """Of all files' paths, sizes and contents in path order: the same before and after, or the source was touched."""
    files = tree_files(root, spark).select("path", F.concat_ws("\0", F.col("size").cast("string"), "digest").alias("digest"))
    return reindex.ordered_digest(files, "path", "digest")
