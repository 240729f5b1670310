"""What the operators of this subpackage share: reading, checkpoints, and Arrow batches of bounded size."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are worked on in slices of at most so many bytes; a single longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder, its lineage cut.

    The folder is the session's; only a local session without one gets a temporary folder.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        where = sc.getConf().get("spark.checkpoint.dir")
        if where is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            where = tempfile.mkdtemp(prefix="checkpoint-")
            atexit.register(shutil.rmtree, where, ignore_errors=True)
        sc.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def schema_with(df: DataFrame, keep: list[str], fields: list[T.StructField]) -> T.StructType:
    """The kept columns of df, then the fields; a field replaces a kept column of its name."""
    new = {f.name for f in fields}
    return T.StructType([df.schema[c] for c in keep if c not in new] + fields)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most limit bytes together, one row at least."""
    import pyarrow.compute as pc

    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start, n - start)


def pieces(data: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """The data in runs of some limit bytes that end at ASCII blanks, so that no word is cut; a longer word is whole."""
    blank, start = re.compile(rb"[\x20\x09-\x0D]").search, 0
    while len(data) - start > limit:
        found = blank(data, start + limit)
        if found is None:
            break
        yield data[start : found.end()]
        start = found.end()
    yield data[start:] if start else data


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list, pa.RecordBatch], list[pa.Array]]],
    fields: list[T.StructField],
    *,
    text: str = "text",
    keep: list[str],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """df's kept columns with new ones that make()'s function computes from lists of texts.

    make runs once a task; its function gets the texts of a slice (None for null) and the slice,
    and returns an array for each field.
    """
    schema = schema_with(df, keep, fields)
    names = [f.name for f in schema.fields]
    kept = names[: len(names) - len(fields)]
    need = list(dict.fromkeys([*kept, text]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for part in slices(batch, text, limit):
                work = work or make()
                out = work(part.column(text).to_pylist(), part)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *out], names=names)

    return df.select(*need).mapInArrow(run, schema)


def share(spark: SparkSession, value) -> Callable:
    """Broadcasts a value of bounded size with its classes' code; the result, called on an executor, gives the value."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        import pickle

        value = pickle.loads(sent.value)
        sent.__dict__.pop("_value", None)  # the bytes need not stay beside what they stand for
        return value

    return get


def sha(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def rewritten(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], *, text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """df with slices of its rows changed by make()'s function, which keeps their columns; columns stand by their place, whatever their names."""
    names, schema = [f"c{i}" for i in range(len(df.columns))], df.schema
    own = names[df.columns.index(text)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for part in slices(batch, own, limit):
                work = work or make()
                yield work(part)

    numbered = df.toDF(*names)
    return numbered.mapInArrow(run, numbered.schema).toDF(*schema.names)


def kept_where(df: DataFrame, make: Callable[[], Callable[[list], list[bool]]], *, text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """The rows of df, all columns as they are, for whose texts make()'s function says True."""
    at = df.columns.index(text)

    def filtered():
        work = make()
        return lambda part: part.filter(pa.array(work(part.column(at).to_pylist()), pa.bool_()))

    return rewritten(df, filtered, text=text, limit=limit)


#: Sides of at most so many rows of a few numbers each are broadcast, and of so many elements of their arrays; larger ones are joined by shuffling.
BROADCAST_ROWS, BROADCAST_CELLS = 300_000, 8_000_000


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, cells: Column | None = None) -> DataFrame:
    """df (already written out), marked for broadcasting if a count shows it small; cells: the number of elements of a row's arrays."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(cells if cells is not None else F.lit(0)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_CELLS else df
