"""Installation of a model: an exact revision, a download by a runner, a check of every file, and a record of it."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import subprocess
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..functions.jsontext import strict_loads
from ..functions.text import SHA40
from ..sources import sinks
from .store import file_digest

RECORD = "install.json"
RECORD_LIMIT = 64 << 10
# Settings of the environment that would lead a download through a proxy.
PROXIES = ["HTTP_PROXY", "HTTPS_PROXY", "ALL_PROXY", "FTP_PROXY", "NO_PROXY", "http_proxy", "https_proxy", "all_proxy", "ftp_proxy", "no_proxy"]

#: (arguments, environment): runs a command, raising if it fails.
Runner = Callable[[list[str], dict[str, str]], object]


class RevisionError(RuntimeError):
    """A revision's name that could not be resolved to a commit."""


@dataclass(frozen=True)
class Install:
    repo: str
    revision: str
    path: str
    verified_at: str

    def __post_init__(self):
        check_repo(self.repo)
        if not re.fullmatch(SHA40, self.revision) or not os.path.isabs(self.path) or not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|\+00:00)", self.verified_at):
            raise ValueError("an install has a commit, an absolute path and a UTC time")


def check_repo(repo: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][\w.-]*(/[A-Za-z0-9][\w.-]*)?", repo) or ".." in repo:
        raise ValueError(f"{repo!r} is no repository")
    return repo


def fetch_json(url: str, timeout: float = 30.0) -> object:
    """The JSON at a url, without any proxy of the environment."""
    with urllib.request.build_opener(urllib.request.ProxyHandler({})).open(url, timeout=timeout) as r:
        return json.loads(r.read(1 << 20))


def resolve(repo: str, revision: str, hub: str, fetch: Callable[[str], object] = fetch_json) -> str:
    """The commit of a revision: itself if it is one, else what the hub's address for revisions says."""
    check_repo(repo)
    if re.fullmatch(SHA40, revision):
        return revision
    if not re.fullmatch(r"[\w][\w./-]*", revision) or ".." in revision:
        raise ValueError(f"{revision!r} is no revision")
    try:
        got = fetch(f"{hub}/api/models/{urllib.parse.quote(repo)}/revision/{urllib.parse.quote(revision, safe='')}")
    except Exception as e:  # what a fetch raises may hold the address
        raise RevisionError(f"the request for the revision failed ({type(e).__name__})") from None
    sha = got.get("sha") if isinstance(got, dict) else None
    if not isinstance(sha, str) or not re.fullmatch(SHA40, sha):
        raise RevisionError("the answer holds no commit")
    return sha


def environment(source: dict[str, str] | None = None) -> dict[str, str]:
    return {k: v for k, v in (os.environ if source is None else source).items() if k not in PROXIES}


def run_command(args: list[str], env: dict[str, str]) -> object:
    return subprocess.run(args, check=True, env=env)


def download(repo: str, revision: str, target: str | Path, run: Runner = run_command, workers: int = 8) -> Install:
    """Downloads a commit's files with the hub's own command, verifies them, and only then writes the record; a record of before goes first."""
    check_repo(repo)
    target = Path(target)
    if not re.fullmatch(SHA40, revision) or not target.is_absolute() or type(workers) is not int or workers < 1:
        raise ValueError("a commit, an absolute path and a number of workers are needed")
    target.mkdir(parents=True, exist_ok=True)
    (target / RECORD).unlink(missing_ok=True)
    env = environment()
    run(["hf", "download", repo, "--revision", revision, "--local-dir", str(target), "--max-workers", str(workers)], env)
    verify(repo, revision, target, run)
    install = Install(repo, revision, str(target), dt.datetime.now(dt.UTC).isoformat())
    sinks.write_json(target / RECORD, install.__dict__)
    return install


def verify(repo: str, revision: str, target: str | Path, run: Runner = run_command) -> None:
    """Has the hub's own command verify every file of a commit."""
    run(["hf", "cache", "verify", check_repo(repo), "--revision", revision, "--local-dir", str(target), "--fail-on-missing-files"], environment())


def read_record(target: str | Path) -> Install:
    """The install record: a regular file of at most 64 KiB, the same before and after it is read."""
    path = Path(target) / RECORD
    if path.is_symlink() or not path.is_file():
        raise ValueError(f"{path} is no regular file")
    with path.open("rb") as f:
        before = os.fstat(f.fileno())
        data = f.read(RECORD_LIMIT + 1)
        after = os.stat(path)
    if (before.st_ino, before.st_size, before.st_mtime_ns) != (after.st_ino, after.st_size, after.st_mtime_ns):
        raise ValueError(f"{path} has changed meanwhile")
    value = strict_loads(data.decode(), RECORD_LIMIT)
    if set(value) != {"repo", "revision", "path", "verified_at"} or not all(isinstance(v, str) for v in value.values()):
        raise ValueError(f"{path} has other fields")
    return Install(**value)


def file_issues(spark: SparkSession, target: str, expected: DataFrame) -> DataFrame:
    """(path, issue): files of (path, size, digest) that are missing or differ under a folder that executors share; files beyond those are no fault."""
    one = file_digest

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for path, size, digest in zip(p.path, p["size"], p.digest, strict=True):
                own = f"{target}/{path}"
                if not os.path.isfile(own) or os.path.islink(own):
                    out.append((path, "missing"))
                elif os.path.getsize(own) != size:
                    out.append((path, "size"))
                elif one(own) != digest:
                    out.append((path, "digest"))
            yield pd.DataFrame(out, columns=["path", "issue"])

    return expected.select("path", "size", "digest").mapInPandas(run, "path string, issue string")
