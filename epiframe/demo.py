"""A whole run over the driver's tables: a nation's customers are the frames of an episode, regions are cameras, a script is the model.

What is written goes to the shared folder, once for each session and folder of tables.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import uuid
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import adapters, config
from .plans import release
from .plans.annotate import Services, annotate
from .plans.store import Store, source_fingerprint
from .sources import dataset, sinks
from .sources.media import FrameSample

FPS, REVISION = 10.0, "0" * 40
SKILLS = ("approach", "grasp", "release")


def boundaries_of(n: int) -> list[int]:
    return [n // 3, 2 * n // 3]


def frame_value(episode: int, frame: int, camera: int, channel: int) -> int:
    """What a pixel of the made-up videos holds."""
    return (frame * 3 + episode * 5 + camera * 11 + channel) % 256


def no_sleep(seconds: float) -> None:
    return None


def sample(episode: int, camera: str, frames: list[int], fps: float) -> list[FrameSample]:
    return [FrameSample(camera, f, f / fps, f"{episode} {camera} {f}".encode()) for f in frames]


def scripted(lengths: dict[int, int]):
    """A sender that knows the boundaries: of episodes 1 modulo 5 it sees the last one elsewhere the second time, to those 3 modulo 7 it has no answer."""

    def send(prompt: str, frames: list, timeout: float) -> str:
        data = prompt.partition("<<<DATA\n")[2].partition("\nDATA>>>")[0]
        if not data:  # a request to repair an answer
            return "[]"
        facts = json.loads(data)
        e = facts["episode"]
        b = boundaries_of(lengths[e])
        if e % 7 == 3:
            return "[]"
        if facts["stage"] == "coarse":
            return json.dumps({"observed": [0, 1, 2], "boundaries": b, "uncertain": False})
        left, right = facts["pair"]
        x = b[left] - int(e % 5 == 1 and left == 1 and facts["pass_id"] % 3 == 2)
        return json.dumps({"from_subtask": left, "to_subtask": right, "last_frame": x - 1, "first_frame": x, "boundary": x})

    return send


def paraphrase(prompt: str, frames: list, timeout: float) -> str:
    texts = json.loads(prompt[prompt.rindex("[") :])
    return json.dumps({"texts": [f"Please {t} now." for t in texts]})


@dataclass
class Demo:
    spark: SparkSession
    sf: str
    root: str

    @property
    def source(self) -> str:
        return f"{self.root}/source"

    @property
    def config(self) -> config.Config:
        return self.configured()

    def configured(self, work: str = "work", **more) -> config.Config:
        data = {
            "source": self.source, "work_dir": f"{self.root}/{work}", "mode": "complete", "high_level_instruction": "stack", "primary_camera": self.cameras[0], "refine_cameras": self.cameras[1:3],
            "subtasks": [{"skill": s, "text": f"do {s}"} for s in SKILLS], "sampling": {"agreement_tolerance_frames": 0, "min_segment_frames": 1}, **more,
        }
        return config.parse(data)

    @cached_property
    def cameras(self) -> list[str]:
        rows = adapters.table(self.spark, self.sf, "region").orderBy("r_regionkey").collect()
        return [r.r_name.replace(" ", "_") for r in rows]

    def frames(self) -> DataFrame:
        """(episode_index, frame_index, x, y): customers in order of their keys; nations that have some are numbered from 0 on."""
        rows = adapters.table(self.spark, self.sf, "customer").select("c_nationkey", "c_custkey", F.col("c_acctbal").cast("double").alias("x"))
        nations = rows.select("c_nationkey").distinct().withColumn("episode_index", (F.row_number().over(Window.orderBy("c_nationkey")) - 1).cast("long"))  # a few nations
        order = Window.partitionBy("episode_index").orderBy("c_custkey")
        return rows.join(F.broadcast(nations), "c_nationkey").select("episode_index", (F.row_number().over(order) - 1).cast("long").alias("frame_index"), "x", (F.col("c_custkey") % 7).cast("double").alias("y"))

    @cached_property
    def lengths(self) -> dict[int, int]:
        return {r.episode_index: r.n for r in self.frames().groupBy("episode_index").agg(F.count("*").alias("n")).orderBy("episode_index").collect()}

    def lengths_table(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.lengths.items()), "episode_index long, length long")

    @cached_property
    def info(self) -> dict:
        n = len(self.lengths)
        return {
            "codebase_version": "v2.1", "fps": FPS, "chunks_size": 10, "total_episodes": n, "total_frames": sum(self.lengths.values()), "total_tasks": 1, "total_chunks": -(-n // 10), "total_videos": n * len(self.cameras),
            "splits": {"train": f"0:{n}"}, "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video_path": "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4",
            "features": {**{c: {"dtype": "video", "shape": [2, 2, 3]} for c in self.cameras}, "action": {"dtype": "float64", "shape": [2]}, "frame_index": {"dtype": "int64", "shape": [1]}},
        }

    def build(self) -> None:
        """Writes the data set: frames by the tasks, meta files by the driver."""
        root, info, cameras = self.source, self.info, self.cameras
        before, total = {}, 0
        for e, n in self.lengths.items():
            before[e], total = total, total + n

        def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            import pyarrow as pa
            import pyarrow.parquet as pq

            e, rows = int(key[0]), rows.sort_values("frame_index")
            n, at = len(rows), {"episode_chunk": int(key[0]) // 10, "episode_index": int(key[0])}
            action = pa.FixedSizeListArray.from_arrays(pa.array(rows[["x", "y"]].to_numpy().ravel()), 2)
            t = pa.table({"episode_index": pa.array([e] * n), "frame_index": pa.array(range(n)), "index": pa.array(range(before[e], before[e] + n)), "task_index": pa.array([0] * n), "timestamp": pa.array(np.arange(n) / FPS, pa.float32()), "action": action})
            path = f"{root}/{info['data_path'].format(**at)}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pq.write_table(t, path)
            for c in cameras:
                path = f"{root}/{info['video_path'].format(video_key=c, **at)}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as f:
                    f.write(f"{e} {c}".encode())
            return pd.DataFrame({"episode_index": [e]})

        self.frames().groupBy("episode_index").applyInPandas(write, "episode_index long").collect()
        sinks.write_json(f"{root}/meta/info.json", info)
        sinks.write_jsonl(f"{root}/meta/tasks.jsonl", [{"task_index": 0, "task": "stack"}])
        sinks.write_jsonl(f"{root}/meta/episodes.jsonl", [{"episode_index": e, "tasks": ["stack"], "length": n} for e, n in self.lengths.items()])
        sinks.write_json(f"{self.root}/golden/annotations.json", {"episodes": {str(e): {"episode_index": e, "boundaries": boundaries_of(n)} for e, n in self.lengths.items()}})
        sinks.write_jsonl(f"{self.root}/golden/meta/episodes.jsonl", [{"episode_index": e, "tasks": ["stack"], "length": n} for e, n in self.lengths.items()])

    def decoder(self, shift: int = 0):
        lengths, cameras = self.lengths, self.cameras

        def decode(path: str):
            with open(path, encoding="utf-8") as f:
                e, camera = f.read().split(" ")
            for i in range(lengths[int(e)]):
                values = [frame_value(int(e), i + shift, cameras.index(camera), k) for k in range(3)]
                yield np.broadcast_to(np.array(values, np.uint8), (2, 2, 3)).copy()

        return decode

    def prober(self, wrong=lambda e, c: 0):
        lengths, cameras = self.lengths, self.cameras

        def probe(path: str) -> tuple[int, float]:
            e, c = int(path[-10:-4]), cameras.index(path.split("/")[-2])
            return lengths[e] + wrong(e, c), FPS

        return probe

    def episodes(self) -> DataFrame:
        return dataset.episode_table(self.spark, dataset.read_jsonl(self.spark, f"{self.source}/meta/episodes.jsonl"), self.info)

    @cached_property
    def services(self) -> Services:
        return Services(sample, scripted(self.lengths), no_sleep)

    def fingerprints(self) -> list[tuple[int, int, str]]:
        return [(r.episode_index, r.length, source_fingerprint(self.source, r.length, r.parquet, {})) for r in self.episodes().collect()]

    def fresh_store(self, work: str) -> Store:
        store = Store(f"{self.root}/{work}")
        store.initialise(self.configured(work), REVISION, self.fingerprints())
        return store

    def results(self, store: Store) -> DataFrame:
        todo = store.records(self.spark).select("episode_index", "status").join(self.lengths_table(), "episode_index")
        return annotate(todo, self.config, FPS, self.services, per_task=4)

    @cached_property
    def store(self) -> Store:
        """The work folder after annotation."""
        store = self.fresh_store("work")
        store.commit(self.results(store))
        store.write_log()
        return store

    def store_copy(self) -> Store:
        work = f"work-{uuid.uuid4().hex}"
        shutil.copytree(self.store.root, f"{self.root}/{work}")
        return Store(f"{self.root}/{work}")

    @cached_property
    def released(self) -> str:
        """The release of the accepted episodes."""
        assert self.store
        release.convert(self.spark, self.config, f"{self.root}/release", services=release.Services(self.decoder()))
        return f"{self.root}/release"

    def folder(self) -> str:
        path = f"{self.root}/{uuid.uuid4().hex}"
        os.makedirs(path)
        return path


_MADE: dict[tuple[str, str], Demo] = {}


def demo(spark: SparkSession, sf: str) -> Demo:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MADE:
        d = Demo(spark, sf, f"{sinks.shared_folder(spark)}/demo-{uuid.uuid4().hex}")
        atexit.register(shutil.rmtree, d.root, ignore_errors=True)
        d.build()
        _MADE[key] = d
    return _MADE[key]
