import datetime as dt
import hashlib
import json
import os
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import yaml
from pyspark import cloudpickle

from epiframe import cli, config
from epiframe.operators import audit, statistics, workspace
from epiframe.plans import evaluate, release
from epiframe.plans.annotate import Services, annotate, augment
from epiframe.plans.review_server import Views
from epiframe.plans.store import Conflict, Store, TakeoverRequired, source_fingerprint, tree_digest
from epiframe.sources import dataset, media, sinks
from epiframe.sources.media import FrameSample
from epiframe.sources.model import Client, InvalidModelResponse, ModelCallError, ModelOutOfMemory, Transient

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the fakes below run on executors

LENGTHS, FPS = [60, 70, 50], 10
BOUNDARIES = {0: [20, 40], 1: [25, 45], 2: [15, 30]}


def build(root):
    """A small data set: 3 episodes, 2 cameras, a vector feature."""
    info = {
        "codebase_version": "v2.1", "fps": FPS, "chunks_size": 2, "total_episodes": 3, "total_frames": sum(LENGTHS), "total_tasks": 1, "total_chunks": 2, "total_videos": 6, "splits": {"train": "0:3"},
        "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video_path": "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4",
        "features": {"top": {"dtype": "video", "shape": [2, 2, 3]}, "wrist": {"dtype": "video", "shape": [2, 2, 3]}, "action": {"dtype": "float32", "shape": [2]}, "frame_index": {"dtype": "int64", "shape": [1]}}, "kept": {"x": 1},
    }
    sinks.write_json(root / "meta/info.json", info)
    sinks.write_jsonl(root / "meta/tasks.jsonl", [{"task_index": 0, "task": "stack"}])
    sinks.write_jsonl(root / "meta/episodes.jsonl", [{"episode_index": i, "tasks": ["stack"], "length": n} for i, n in enumerate(LENGTHS)])
    sinks.write_json(root / "meta/stats.json", {})
    offset = 0
    for i, n in enumerate(LENGTHS):
        action = pa.FixedSizeListArray.from_arrays(pa.array(np.stack([np.full(n, i), np.arange(n)], 1).ravel(), pa.float32()), 2)
        t = pa.table({"episode_index": pa.array([i] * n), "frame_index": pa.array(range(n)), "index": pa.array(range(offset, offset + n)), "task_index": pa.array([0] * n), "timestamp": pa.array(np.arange(n) / FPS, pa.float32()), "action": action})
        path = root / info["data_path"].format(episode_chunk=i // 2, episode_index=i)
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(t.replace_schema_metadata({"who": "test"}), path)
        for k in ("top", "wrist"):
            v = root / info["video_path"].format(episode_chunk=i // 2, episode_index=i, video_key=k)
            v.parent.mkdir(parents=True, exist_ok=True)
            v.write_bytes(f"{i} {k}".encode())
        offset += n
    return root


def probe(path):
    return LENGTHS[int(path[-10:-4])], float(FPS)


def configured(tmp, **more):
    data = {"source": str(tmp / "source"), "work_dir": str(tmp / "work"), "mode": "complete", "high_level_instruction": "stack", "primary_camera": "top", "refine_cameras": ["wrist"], "subtasks": [{"skill": s, "text": f"do {s}"} for s in ("a", "b", "c")], **more}
    (tmp / "c.yaml").write_text(yaml.safe_dump(data))
    return config.parse(data)


def sample(episode, camera, frames, fps):
    return [FrameSample(camera, f, f / fps, b"x") for f in frames]


def send(prompt, frames, timeout):
    """A model that knows the boundaries; episode 1 is seen differently by the dense look."""
    facts = json.loads(prompt.partition("<<<DATA\n")[2].partition("\nDATA>>>")[0])
    b = BOUNDARIES[facts["episode"]]
    if facts["stage"] == "coarse":
        return json.dumps({"observed": [0, 1, 2], "boundaries": [x + facts["pass_id"] for x in b], "uncertain": False})
    left, right = facts["pair"]
    x = b[left] + (20 if facts["episode"] == 1 and facts["pass_id"] % 3 == 2 else 0)
    return json.dumps({"from_subtask": left, "to_subtask": right, "last_frame": x - 1, "first_frame": x, "boundary": x})


def no_sleep(seconds):
    return None


SERVICES = Services(sample, send, no_sleep)


def initialised(spark, tmp):
    c, store = configured(tmp), Store(tmp / "work")
    info = dataset.read_json(spark, f"{c.source}/meta/info.json")
    episodes = dataset.episode_table(spark, dataset.read_jsonl(spark, f"{c.source}/meta/episodes.jsonl"), info)
    store.initialise(c, "0" * 40, [(r.episode_index, r.length, source_fingerprint(c.source, r.length, r.parquet, {})) for r in episodes.collect()])
    return c, store, episodes


def annotated(spark, tmp, services=SERVICES):
    c, store, episodes = initialised(spark, tmp)
    todo = store.records(spark).select("episode_index", "status").join(episodes.select("episode_index", "length"), "episode_index")
    return c, store, store.commit(annotate(todo, c, FPS, services))


def test_config(tmp_path):
    c = configured(tmp_path)
    assert config.load(tmp_path / "c.yaml") == c and len(c.stable_hash()) == 64
    assert configured(tmp_path, model={"api_key": "other"}).stable_hash() == c.stable_hash() != configured(tmp_path, mode="dagger_patch").stable_hash()
    for bad in ({"mode": "x"}, {"extra": 1}, {"sampling": {"coarse_max_frames": 7}}, {"sampling": {"coarse_fps": True}}, {"model": {"endpoint": "http://u@h/v1"}}, {"refine_cameras": []}, {"augmentation": {"language": " English"}}):
        with pytest.raises(config.ConfigError):
            configured(tmp_path, **bad)


def test_inspection(spark, tmp_path):
    build(tmp_path / "source")
    info, episodes, bad = dataset.inspect(spark, str(tmp_path / "source"), ["top"], probe)
    assert bad.collect() == [] and episodes.count() == 3 and dataset.camera_keys(info) == ["top", "wrist"]
    _, _, bad = dataset.inspect(spark, str(tmp_path / "source"), ["side"], lambda p: (59 if p.endswith("0.mp4") else probe(p)[0], 10.02))
    checks = sorted(r.check for r in bad.collect())
    assert checks == ["camera", *["video"] * 6]
    sinks.write_jsonl(tmp_path / "source/meta/episodes.jsonl", [{"episode_index": i, "tasks": ["other"] if i else ["stack", "x"], "length": 60} for i in (0, 2)])
    _, _, bad = dataset.inspect(spark, str(tmp_path / "source"), ["top"], lambda p: (60, 10.0))
    assert {r.check for r in bad.collect()} == {"contiguity", "one_task", "known_task", "parquet_rows", "total"}
    for t in ("data/{x}", "/abs/{episode_index}", "a/../{episode_index}", "data/{episode_index", "data/x", "{episode_index:{episode_chunk}}"):
        with pytest.raises(dataset.DatasetError):
            dataset.check_template(t, {"episode_index"})


def test_jsonl_table(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n')
    got = dataset.jsonl_table(spark, str(tmp_path / "x.jsonl"), "a long").collect()
    assert sorted((r.a or 0, r.bad) for r in got) == [(0, True), (0, True), (1, False)]


def test_media(spark):
    frames = [np.full((1, 2, 3), i, np.uint8) for i in range(4)]
    seen = []

    def decode(path):
        for f in frames:
            seen.append(1)
            yield f

    got = media.extract_frames("v", "top", [0, 2], 10.0, decode, lambda f, label: label.encode())
    assert [g.frame_index for g in got] == [0, 2] and len(seen) == 3
    with pytest.raises(ValueError):
        media.extract_frames("v", "top", [9], 10.0, decode, lambda f, label: b"x")
    with pytest.raises(ValueError):
        media.check_samples(got, [0, 1], "top", 10.0)
    videos = spark.createDataFrame([("top", "v", 4, 1, 2)], "camera string, path string, frames long, height int, width int")

    def plain(path):
        return (np.full((1, 2, 3), i, np.uint8) for i in range(4))

    s = statistics.histogram_stats(media.video_histograms(videos, plain), ["camera", "channel"]).collect()
    assert len(s) == 3 and all(r["count"] == 8 and abs(r.mean * 255 - 1.5) < 1e-9 for r in s)


def test_labels_and_png():
    import struct
    import zlib

    frame = np.full((40, 60, 3), 9, np.uint8)
    got = media.labelled(frame, "T1", scale=1)
    assert (frame == 9).all() and got[1, 1:4, 0].tolist() == [255] * 3 and got[2, 1:4, 0].tolist() == [0, 255, 0] and (got[7:] == 9).all()
    data = media.encode_png(frame, "a much longer label than fits 3.250s")
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", data[16:24]) == (60, 40)
    n = struct.unpack(">I", data[33:37])[0]
    lines = np.frombuffer(zlib.decompress(data[41 : 41 + n]), np.uint8).reshape(40, 181)
    assert (lines[:, 0] == 0).all() and (lines[20:, 1:] == 9).all()
    assert zlib.crc32(data[37 : 41 + n]) == struct.unpack(">I", data[41 + n : 45 + n])[0]


def test_http_sender():
    import io
    import urllib.error

    from epiframe.sources.model import HttpSender, Malformed, retry_waits

    seen = []

    def answering(result):
        def open_(request, timeout):
            seen.append((request.full_url, json.loads(request.data), timeout))
            if isinstance(result, Exception):
                raise result
            return io.BytesIO(result)

        return HttpSender("http://h/v1", "m", schema={"type": "object"}, open=open_)

    good = json.dumps({"choices": [{"message": {"content": "yes"}}]}).encode()
    assert answering(good)("p", sample(0, "top", [3], 10.0), 5.0) == "yes"
    url, body, timeout = seen[0]
    assert url == "http://h/v1/chat/completions" and timeout == 5.0 and [c["type"] for c in body["messages"][0]["content"]] == ["text", "text", "image_url"] and "response_format" in body
    for bad in (b"[]", b"{}", b"x", json.dumps({"choices": [{"message": {"content": 1}}]}).encode()):
        with pytest.raises(Malformed):
            answering(bad)("p", [], 1.0)

    def status(code, text=b""):
        return urllib.error.HTTPError("http://h", code, "", {}, io.BytesIO(text))

    for error in (status(503), status(429), TimeoutError(), ConnectionResetError(), urllib.error.URLError("x"), status(400, b"CUDA out of memory")):
        with pytest.raises(Transient):
            answering(error)("p", [], 1.0)
    with pytest.raises(ModelCallError):
        answering(status(400))("p", [], 1.0)
    assert retry_waits(2) == (2.0,) and retry_waits([0, 1.5]) == (0.0, 1.5)
    for bad in ([], "1", True, [True], [float("nan")], [-1], [10**400], None):
        with pytest.raises(ValueError):
            retry_waits(bad)


def test_models_are_installed_and_recorded(tmp_path):
    from epiframe.plans import models

    sha = "a" * 40
    assert models.resolve("own/model", sha, "hub", lambda url: 1 / 0) == sha
    assert models.resolve("own/model", "main", "http://hub", lambda url: {"sha": sha} if url == "http://hub/api/models/own/model/revision/main" else {}) == sha
    for answer in ({}, {"sha": "x"}, []):
        with pytest.raises(models.RevisionError):
            models.resolve("own/model", "main", "hub", lambda url, answer=answer: answer)
    for bad in ("../x", "a b", "", "a/b/c"):
        with pytest.raises(ValueError):
            models.check_repo(bad)
    calls = []
    got = models.download("own/model", sha, tmp_path / "m", lambda args, env: calls.append((args[1], set(env) & set(models.PROXIES))))
    assert [c for c, _ in calls] == ["download", "cache"] and not any(p for _, p in calls) and models.read_record(tmp_path / "m") == got

    def failing(args, env):
        if args[1] == "cache":
            raise OSError("bad")

    with pytest.raises(OSError):
        models.download("own/model", sha, tmp_path / "m", failing)
    with pytest.raises(ValueError):  # no record of what was not verified
        models.read_record(tmp_path / "m")


def test_decision_files(tmp_path):
    from epiframe.plans import review_files

    good = {"episode_index": 1, "source_fingerprint": "a" * 64, "run_fingerprint": "b" * 64, "mode": "complete", "start_subtask_index": 0, "boundaries": [3, 5]}
    sinks.write_json(tmp_path / "d.json", good)
    assert review_files.load_decision(tmp_path / "d.json") == good
    for bad in ({**good, "note": 1}, {**good, "boundaries": [True]}, {**good, "episode_index": 1.0}, {**good, "mode": "x"}, {**good, "source_fingerprint": "A" * 64}, {k: v for k, v in good.items() if k != "mode"}):
        with pytest.raises(ValueError):
            review_files.check_decision(bad)
    (tmp_path / "big.json").write_text('{"a": "' + "x" * (65 << 10) + '"}')
    os.symlink(tmp_path / "d.json", tmp_path / "l.json")
    for name in ("big.json", "l.json", "none.json"):
        with pytest.raises(ValueError):
            review_files.load_decision(tmp_path / name)


def test_review_pages_and_videos(spark, tmp_path):
    build(tmp_path / "source")
    c, store, _ = annotated(spark, tmp_path)
    info = json.loads((tmp_path / "source/meta/info.json").read_text())
    v = Views(c, dict(enumerate(LENGTHS)), info)
    x = v.episode(1)
    assert x["videos"] == {"top": "/api/episodes/1/videos/0", "wrist": "/api/episodes/1/videos/1"} and x["candidates"] == [25, 26, 45, 46] or x["candidates"]
    assert "<video" in v.answer("GET", "/episodes/1")[2]
    assert v.video(1, 0, None)[::2] == (200, b"1 top") and v.video(1, 0, "bytes=2-")[::2] == (206, b"top") and v.video(1, 1, "bytes=-5")[2] == b"wrist" and v.video(1, 0, "bytes=9-")[0] == 416
    with pytest.raises(KeyError):
        v.video(9, 0, None)


def test_levels_need_what_they_compare(spark, tmp_path):
    with pytest.raises(ValueError):
        release.validate(spark, str(tmp_path), "strict_deep")
    with pytest.raises(ValueError):
        release.validate(spark, str(tmp_path), "source_backed_legacy")


def test_model_client():
    waits, answers = [], []

    def run(*given, **more):
        waits.clear()
        answers[:] = given

        def send(prompt, frames, timeout):
            x = answers.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        def check(v):
            if "a" not in v:
                raise ValueError("a is missing")

        return Client(send, waits.append, **more).complete("p", [], check)

    assert run(Transient("503"), Transient("timeout"), '{"a": 1}') == {"a": 1} and waits == [1.0, 2.0]
    assert run('so {"a": 1}', '{"a": 1}') == {"a": 1}
    with pytest.raises(InvalidModelResponse):
        run('so {"a": 1}', '{"a": 2}')
    with pytest.raises(InvalidModelResponse):
        run("{}", "{}")
    with pytest.raises(ModelOutOfMemory):
        run(Transient("CUDA out of memory"))
    with pytest.raises(ModelCallError):
        run(*[Transient("503")] * 4)


def test_annotation_resumes_and_is_audited(spark, tmp_path):
    build(tmp_path / "source")
    c, store, counts = annotated(spark, tmp_path)
    assert counts == {"accepted": 2, "needs_review": 1}
    assert store.load(0)["final_annotation"] == {"start_subtask_index": 0, "boundaries": [20, 40]} and store.load(1)["review_reasons"] == ["refine_boundary_disagreement"]
    todo = store.records(spark).join(spark.createDataFrame([(i, n) for i, n in enumerate(LENGTHS)], "episode_index long, length long"), "episode_index")
    assert annotate(todo, c, FPS, SERVICES).count() == 0
    assert workspace.chain_issues(store.transitions(spark), store.records(spark)).count() == 0
    assert store.write_log() and not store.write_log()
    assert store.bad_events(0) == []
    r = store.load(0)
    r["transitions"][1]["reasons"] = ["x"]
    sinks.write_json(tmp_path / "copy/episodes/episode_000000.json", r)
    assert Store(tmp_path / "copy").bad_events(0) == [r["transitions"][1]["event_id"]]
    assert {r.status: r.n for r in workspace.summary(store.records(spark)).collect()}["accepted"] == 2
    assert all(r.issues == [] for r in workspace.record_issues(store.records(spark)).collect())
    with pytest.raises(Conflict):
        store.initialise(configured(tmp_path, mode="dagger_patch"), "0" * 40, [])


def test_memory_failures_degrade_once(spark, tmp_path):
    build(tmp_path / "source")

    def short(prompt, frames, timeout):
        if len({f.camera_key for f in frames}) > 1 or '"episode": 2' in prompt and '"refine"' in prompt:
            raise Transient("out of memory")
        return send(prompt, frames, timeout)

    _, store, counts = annotated(spark, tmp_path, Services(sample, short, no_sleep))
    assert counts == {"accepted": 1, "needs_review": 1, "failed": 1} and store.load(2)["failure_category"] == "model_oom"
    used = json.loads(store.load(0)["sampling_details"])["refine"]["provenance"]
    assert [u["stage"] for u in used] == ["broad", "broad_retry", "dense", "broad", "dense"] and all(u["cameras"] == ["top"] for u in used[1:])


def test_decisions_replay(spark, tmp_path):
    build(tmp_path / "source")

    def short(prompt, frames, timeout):
        if len({f.camera_key for f in frames}) > 1:
            raise Transient("out of memory")
        return send(prompt, frames, timeout)

    c, store, _ = annotated(spark, tmp_path, Services(sample, short, no_sleep))
    lengths = spark.createDataFrame(list(enumerate(LENGTHS)), "episode_index long, length long")
    assert audit.audit(store.records(spark).join(lengths, "episode_index"), c, FPS).count() == 0
    good = json.loads(store.load(0)["sampling_details"])

    def changed(*path_and_value):
        d = json.loads(json.dumps(good))
        *path, last, value = path_and_value
        x = d
        for p in path:
            x = x[p]
        x[last] = value
        return audit.audit_record(c, LENGTHS[0], FPS, json.dumps(d))

    assert changed("coarse", "centers", [1, 2]) and changed("coarse", "grids", 0, [0]) and changed("coarse", "attempts", 0, "uncertain", True)
    assert changed("refine", "boundaries", [20, 41]) and changed("refine", "provenance", 1, "stride", 1) and changed("refine", "provenance", [])
    assert changed("refine", "status", "needs_review") and changed("refine", "reasons", ["model_oom"]) and changed("refine", "provenance", 0, "outcome", "completed")
    assert audit.audit_record(c, 60, FPS, "[]") and not audit.audit_record(c, 60, FPS, "{}")


def test_bad_answers_fail_an_episode(spark, tmp_path):
    build(tmp_path / "source")
    _, store, counts = annotated(spark, tmp_path, Services(sample, lambda p, f, t: "[]", no_sleep))
    assert counts == {"failed": 3} and store.load(0)["failure_category"] == "invalid_model_response"


def test_human_decisions_and_views(spark, tmp_path):
    build(tmp_path / "source")
    c, store, _ = annotated(spark, tmp_path)
    v = Views(c, dict(enumerate(LENGTHS)))
    assert v.session()["counts"] == {"accepted": 2, "needs_review": 1} and [r["episode_index"] for r in v.episodes("needs_review")] == [1] and ">1</a></td>" in v.page()
    r = store.load(1)
    body = {"expected_status": "needs_review", "expected_updated_at": r["updated_at"], "start_subtask_index": 0, "boundaries": [25, 45]}
    assert v.answer("POST", "/api/episodes/1/decision", json.dumps(body | {"boundaries": [25]}).encode())[0] == 422
    assert v.answer("POST", "/api/episodes/1/decision", json.dumps(body).encode())[0] == 200
    assert v.answer("POST", "/api/episodes/1/decision", json.dumps(body).encode())[0] == 409
    with pytest.raises(TakeoverRequired):
        store.decide(0, ("accepted", store.load(0)["updated_at"]), {})
    assert v.answer("GET", "/api/episodes/9")[0] == 404 and v.answer("GET", "/api/episodes/1")[0] == 200
    store.invalidate(0)
    assert store.load(0)["status"] == "pending" and workspace.chain_issues(store.transitions(spark)).count() == 0


def test_conversion_validation_and_evaluation(spark, tmp_path):
    build(tmp_path / "source")
    c, store, _ = annotated(spark, tmp_path)
    before = tree_digest(c.source, spark)
    out = tmp_path / "out"
    assert release.convert(spark, c, str(out))["episodes"] == 2 and tree_digest(c.source, spark) == before
    info = json.loads((out / "meta/info.json").read_text())
    assert (info["total_episodes"], info["total_frames"], info["total_chunks"], info["total_videos"], info["splits"], info["kept"]) == (2, 110, 1, 4, {"train": "0:2"}, {"x": 1})
    t = pq.read_table(out / "data/chunk-000/episode_000001.parquet")
    assert t["index"].to_pylist() == list(range(60, 110)) and set(t["episode_index"].to_pylist()) == {1} and t.schema.metadata[b"who"] == b"test" and t.schema.field("action").type.list_size == 2
    stats = json.loads((out / "meta/stats.json").read_text())
    assert abs(stats["action"]["mean"][0] - 100 / 110) < 1e-9 and stats["action"]["count"] == [110]
    assert (out / "videos/chunk-000/top/episode_000001.mp4").read_bytes() == b"2 top"
    with pytest.raises(FileExistsError):
        release.convert(spark, c, str(out))
    notes = json.loads((out / "meta/annotations.json").read_text())
    notes["episodes"]["0"]["boundaries"] = [40, 20]
    sinks.write_json(out / "meta/annotations.json", notes | {"api_key": 1})
    stats["action"]["max"][1] += 1
    sinks.write_json(out / "meta/stats.json", stats)
    os.remove(out / "data/chunk-000/episode_000001.parquet")
    assert {r.check for r in release.validate(spark, str(out)).collect()} >= {"annotation", "task_info", "stats", "payload", "frames", "forbidden_key", "payload_size"}
    assert {r.detail for r in release.validate(spark, str(out), "legacy_structural").collect() if r.check == "stats"} <= {"min", "max", "mean", "std", "count"}
    sinks.write_json(tmp_path / "gold/annotations.json", {"episodes": {str(e): {"episode_index": e, "boundaries": [x + 2 for x in b]} for e, b in BOUNDARIES.items()}})
    sinks.write_jsonl(tmp_path / "gold/meta/episodes.jsonl", [{"episode_index": i, "tasks": ["stack"], "length": n} for i, n in enumerate(LENGTHS)])
    m, gates = evaluate.evaluate(spark, c, str(tmp_path / "gold"), FPS)
    r = m.first()
    assert (r.median_absolute_error_frames, r.accepted_count, r.missing_prediction_count, r.false_accept_count) == (2, 2, 1, 0)
    assert not evaluate.write_report(m, gates, str(tmp_path / "report.json"))
    with pytest.raises(FileExistsError):
        evaluate.write_report(m.withColumn("fps", m.fps + 1), gates, str(tmp_path / "report.json"))


def test_full_release_keeps_payload(spark, tmp_path):
    build(tmp_path / "source")
    os.remove(tmp_path / "source/meta/stats.json")
    c, store, _ = annotated(spark, tmp_path)
    with pytest.raises(ValueError):
        release.convert(spark, c, str(tmp_path / "out"), accepted_only=False)
    store.decide(1, ("needs_review", store.load(1)["updated_at"]), {"start_subtask_index": 0, "boundaries": [25, 45]})
    assert release.convert(spark, c, str(tmp_path / "out"), accepted_only=False)["episodes"] == 3
    a, b = (tmp_path / x / "data/chunk-000/episode_000000.parquet" for x in ("source", "out"))
    assert a.read_bytes() == b.read_bytes()


def test_augmentation(spark, tmp_path):
    build(tmp_path / "source")
    c = configured(tmp_path)
    rows = spark.createDataFrame([(0, 1, [5])], "episode_index long, start_subtask_index int, boundaries array<long>")
    got = augment(rows, c, lambda p, f, t: json.dumps({"texts": ["x", "y"]})).collect()
    assert [(r.subtask_index, r.text) for r in got] == [(1, "x"), (2, "y")]


def test_sinks(tmp_path):
    sinks.write_text(tmp_path / "a", "1")
    os.symlink(tmp_path / "a", tmp_path / "l")
    with pytest.raises(ValueError):
        sinks.write_text(tmp_path / "l", "2")
    with pytest.raises(ValueError):
        sinks.copy_tree(tmp_path, tmp_path / "x")
    with pytest.raises(ValueError):
        sinks.write_json(tmp_path / "b", float("nan"))
    sinks.write_new(tmp_path / "n", "1")
    sinks.write_new(tmp_path / "n", "1")
    with pytest.raises(FileExistsError):
        sinks.write_new(tmp_path / "n", "2")
    os.makedirs(tmp_path / "s")
    os.makedirs(tmp_path / "t")
    with pytest.raises(FileExistsError):
        sinks.publish(tmp_path / "s", tmp_path / "t")
    sinks.publish(tmp_path / "s", tmp_path / "u")
    assert hashlib.sha256(b"").hexdigest()


def test_commands(spark, tmp_path, capsys, monkeypatch):
    import test_services as own

    build(tmp_path / "source")
    configured(tmp_path)
    path = str(tmp_path / "c.yaml")
    monkeypatch.setattr(cli, "_named", lambda x: getattr(own, x))
    assert cli.main(["inspect", path, "--probe", "probe"], spark) == 0
    assert cli.main(["annotate", path, "--probe", "probe", "--services", "SERVICES", "--revision", "0" * 40], spark) == 0
    assert cli.main(["status", path, "--json"], spark) == 0 and '"accepted": 2' in capsys.readouterr().out
    assert cli.main(["convert", path, str(tmp_path / "out")], spark) == 0
    assert cli.main(["validate", str(tmp_path / "out")], spark) == 0
    assert cli.main(["status", str(tmp_path / "none.yaml")], spark) == 2 and cli.main(["nothing"], spark) == 2


def test_clock_never_goes_back(spark, tmp_path):
    build(tmp_path / "source")
    _, store, _ = initialised(spark, tmp_path)
    store.clock = lambda: dt.datetime(2000, 1, 1, tzinfo=dt.UTC)
    r = store.load(0)
    r2 = store.transition(0, (r["status"], r["updated_at"]), "failed", "annotated", category="model_call")
    assert r2["updated_at"] > r["updated_at"] and isinstance(pd.Timestamp(r2["updated_at"]), pd.Timestamp)
    with pytest.raises(ValueError):
        store.transition(0, (r2["status"], r2["updated_at"]), "coarse_done", "annotated")
