"""Commands: inspect, annotate, status, review, convert, validate, evaluate, model. Exit codes: 2 for usage or configuration, 1 for anything found wrong."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from . import config as configuration
from .operators import workspace
from .plans import evaluate, release
from .plans.annotate import annotate
from .plans.store import Store, source_fingerprint
from .sources import dataset


def _named(path: str):
    """module:name, for decoders and senders that the caller brings."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="epiframe")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("inspect", "annotate", "status", "review", "convert", "evaluate"):
        c = sub.add_parser(name)
        c.add_argument("config")
        if name in ("inspect", "annotate"):
            c.add_argument("--probe", required=True, help="module:function of path to (frames, fps)")
        if name == "annotate":
            c.add_argument("--services", required=True, help="module:object with sample, send and sleep")
            c.add_argument("--revision", required=True)
        if name == "status":
            c.add_argument("--json", action="store_true", help="one JSON object; else a line for each status")
        if name == "review":
            how = c.add_mutually_exclusive_group()
            how.add_argument("--apply", metavar="DECISION", help="a decision file")
            how.add_argument("--serve", action="store_true")
            c.add_argument("--port", type=int, default=8765)
            c.add_argument("--bundle", help="folder of the static bundle; in the work folder if not given")
            c.add_argument("--services", help="module:object with sample, for the bundle's images")
        if name == "convert":
            c.add_argument("target")
            c.add_argument("--all", action="store_true")
            c.add_argument("--services", help="module:object with decode and send, for video statistics and paraphrases")
        if name == "evaluate":
            c.add_argument("--golden", required=True)
            c.add_argument("--report", required=True)
    v = sub.add_parser("validate")
    v.add_argument("root")
    v.add_argument("--source", help="the data set that the release was made of")
    v.add_argument("--deep-video-stats", metavar="DECODER", help="module:function of path to frames: compare the videos' statistics too")
    v.add_argument("--allow-legacy-sampled-image-stats", action="store_true")
    m = sub.add_parser("model")
    m.add_argument("action", choices=["resolve", "download", "verify"])
    m.add_argument("repo")
    m.add_argument("--revision", default="main")
    m.add_argument("--target")
    m.add_argument("--hub", default="https://huggingface.co")
    return p


def manage_model(a) -> int:
    from .plans import models

    if a.action != "resolve" and not a.target:
        print("a target is needed", file=sys.stderr)
        return 2
    try:
        revision = models.resolve(a.repo, a.revision, a.hub)
        if a.action == "resolve":
            print(revision)
        elif a.action == "download":
            print(json.dumps(models.download(a.repo, revision, a.target).__dict__, sort_keys=True))
        else:
            models.verify(a.repo, revision, a.target)
    except Exception as e:  # addresses and commands' outputs are not shown
        print(type(e).__name__, file=sys.stderr)
        return 1
    return 0


def review(spark, config, a) -> int:
    from .plans import review_files, review_server

    info = dataset.read_json(spark, f"{config.source}/meta/info.json")
    lengths = {r["episode_index"]: r["length"] for r in dataset.read_jsonl(spark, f"{config.source}/meta/episodes.jsonl")}
    if a.serve:
        review_server.serve(review_server.Views(config, lengths, info), a.port).serve_forever()
        return 0
    if a.apply:
        try:
            decision = review_files.load_decision(a.apply)
        except (ValueError, OSError) as e:
            print(e, file=sys.stderr)
            return 2
        try:
            r = review_files.apply_file(Store(config.work_dir), config, lengths, decision)
        except (ValueError, KeyError, OSError, RuntimeError) as e:
            print(e, file=sys.stderr)
            return 1
        print(f"accepted episode {r['episode_index']}")
        return 0
    if not a.services:
        print("the bundle's images need --services", file=sys.stderr)
        return 2
    target = a.bundle or f"{config.work_dir}/review"
    review_files.render(spark, config, lengths, float(info["fps"]), target, review_files.ReviewServices(_named(a.services).sample))
    print(f"{target}/index.html")
    return 0


def main(argv: list[str] | None = None, spark=None) -> int:
    p = parser()
    try:
        a = p.parse_args(argv)
        if a.command == "model":
            return manage_model(a)
        if a.command == "validate" and a.allow_legacy_sampled_image_stats and a.deep_video_stats:
            p.error("sampled image statistics can't be compared with the videos")
        config = configuration.load(a.config) if "config" in a else None
    except SystemExit as e:
        return int(e.code or 0)
    except (ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 2
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("epiframe").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "validate":
        legacy = ("source_backed_legacy" if a.source else "legacy_structural") if a.allow_legacy_sampled_image_stats else None
        level = legacy or ("strict_deep" if a.deep_video_stats else "strict_structural")
        bad = release.validate(spark, a.root, level, a.source, _named(a.deep_video_stats) if a.deep_video_stats else None).collect()
        print(json.dumps([r.asDict() for r in bad]))
        return int(bool(bad))
    if a.command == "status":
        counts = {r.status: r.n for r in workspace.summary(Store(config.work_dir).records(spark)).collect()}
        print(json.dumps(counts, sort_keys=True) if a.json else "\n".join(f"{s}: {counts[s]}" for s in sorted(counts)))
        return 0
    if a.command == "review":
        return review(spark, config, a)
    if a.command == "convert":
        services = _named(a.services) if a.services else release.Services()
        print(json.dumps(release.convert(spark, config, a.target, accepted_only=not a.all, services=services)))
        return 0
    info = dataset.read_json(spark, f"{config.source}/meta/info.json")
    if a.command == "evaluate":
        m, gates = evaluate.evaluate(spark, config, a.golden, float(info["fps"]))
        return int(not evaluate.write_report(m, gates, a.report))
    _, episodes, bad = dataset.inspect(spark, config.source, [config.primary_camera, *config.refine_cameras], _named(a.probe))
    wrong = bad.collect()
    if a.command == "inspect" or wrong:
        print(json.dumps({"episodes": episodes.count(), "issues": [r.asDict() for r in wrong]}))
        return int(bool(wrong))
    store = Store(config.work_dir)
    videos: dict[int, dict] = {}
    for v in dataset.video_table(episodes, info).collect():
        videos.setdefault(v.episode_index, {})[v.camera] = v.path
    rows = episodes.orderBy("episode_index").collect()
    store.initialise(config, a.revision, [(r.episode_index, r.length, source_fingerprint(config.source, r.length, r.parquet, videos[r.episode_index])) for r in rows])
    todo = store.records(spark).select("episode_index", "status").join(episodes.select("episode_index", "length"), "episode_index")
    counts = store.commit(annotate(todo, config, float(info["fps"]), _named(a.services)))
    store.write_log()
    print(json.dumps(counts))
    return int(bool(counts.get("failed")))


if __name__ == "__main__":
    sys.exit(main())
