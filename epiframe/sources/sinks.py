"""Files that are written whole or not at all, on the driver."""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions.jsontext import canonical


_TEMPORARY: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors mount, from spark.checkpoint.dir; a local session without one gets a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _TEMPORARY:
            _TEMPORARY.append(tempfile.mkdtemp(prefix="shared-"))
            atexit.register(shutil.rmtree, _TEMPORARY[0], ignore_errors=True)
        where = _TEMPORARY[0]
    scheme, mark, rest = where.partition("://")
    if mark and scheme != "file":
        raise ValueError(f"{where} is no folder that files can be opened in")
    return rest if mark else where.removeprefix("file:")


def write_text(path: str | Path, text: str) -> None:
    """Replaces a file in one step; symbolic links are refused."""
    path = Path(path)
    if path.is_symlink():
        raise ValueError(f"{path} is a symbolic link")
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise


def write_json(path: str | Path, value, sort: bool = True) -> None:
    write_text(path, json.dumps(value, sort_keys=sort, indent=2, ensure_ascii=False, allow_nan=False) + "\n")


def write_jsonl(path: str | Path, rows: Iterable) -> None:
    write_text(path, "".join(canonical(r, ascii_only=False) + "\n" for r in rows))


def write_new(path: str | Path, text: str) -> None:
    """A file that must not be there yet; equal content is left alone."""
    path = Path(path)
    if path.exists():
        if path.read_text(encoding="utf-8") != text:
            raise FileExistsError(path)
        return
    write_text(path, text)


def write_if_changed(path: str | Path, text: str) -> bool:
    path = Path(path)
    if path.exists() and path.read_text(encoding="utf-8") == text:
        return False
    write_text(path, text)
    return True


def publish(staging: str | Path, target: str | Path) -> None:
    """Renames a finished folder to its place, which must be free."""
    os.mkdir(target)  # fails if there is one; an empty folder is then replaced by the rename
    try:
        os.rename(staging, target)
    except BaseException:
        os.rmdir(target)
        raise


def copy_tree(source: str | Path, target: str | Path, skip: tuple[str, ...] = ()) -> None:
    """Regular files and folders only; folders at the top named in skip stay out."""
    source, target = Path(source), Path(target)
    for folder, names, files in os.walk(source):
        here = Path(folder).relative_to(source)
        names[:] = sorted(n for n in names if not (here == Path(".") and n in skip))
        for n in [*names, *files]:
            if (Path(folder) / n).is_symlink():
                raise ValueError(f"{Path(folder) / n} is a symbolic link")
        (target / here).mkdir(parents=True, exist_ok=True)
        for n in files:
            shutil.copy2(Path(folder) / n, target / here / n)


def copy_files(files: DataFrame) -> DataFrame:
    """(target_path, bytes) of a table (source_path, target_path), each copied by a task; a repeated task copies again."""

    def run(parts):
        for p in parts:
            sizes = []
            for source, target in zip(p.source_path, p.target_path, strict=True):
                os.makedirs(os.path.dirname(target), exist_ok=True)
                sizes.append(os.path.getsize(shutil.copyfile(source, target, follow_symlinks=False)))
            p["bytes"] = sizes
            yield p[["target_path", "bytes"]]

    return files.mapInPandas(run, "target_path string, bytes long")


def rewrite_episode(source: str, target: str, episode: int, offset: int) -> int:
    """An episode's parquet with episode_index, frame_index and index anew; types, list widths and metadata stay."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    data = pq.read_table(source)
    n = data.num_rows
    for name, values in (("episode_index", np.full(n, episode)), ("frame_index", np.arange(n)), ("index", np.arange(offset, offset + n))):
        i = data.schema.get_field_index(name)
        if i >= 0:
            f = data.schema.field(i)
            data = data.set_column(i, f, pa.array(values).cast(f.type))
    os.makedirs(os.path.dirname(target), exist_ok=True)
    pq.write_table(data, target)
    return n


def rewrite_episodes(mapping: DataFrame) -> DataFrame:
    """(output_index, rows) of a table (source_path, target_path, output_index, global_offset), each rewritten by a task.

    Paths must be reachable from executors; a repeated task writes the same file again.
    """
    one = rewrite_episode

    def run(parts):
        for p in parts:
            p["rows"] = [one(s, t, int(e), int(o)) for s, t, e, o in zip(p.source_path, p.target_path, p.output_index, p.global_offset, strict=True)]
            yield p[["output_index", "rows"]]

    return mapping.mapInPandas(run, "output_index long, rows long")
