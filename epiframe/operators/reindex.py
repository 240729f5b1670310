"""Subsets of episodes re-numbered densely, and checks of what such numbering promises."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_of(key: str, cuts: list) -> Column:
    """How many of the ascending cuts are under the key, by binary search."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*map(F.lit, cuts))
    steps = F.array(*(F.lit(1 << s) for s in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(listed, at + step - 1) < F.col(key), step).otherwise(0))


def running_offsets(episodes: DataFrame, length: str = "length", order: str = "episode_index") -> DataFrame:
    """episodes with output_index (dense, from 0) and global_offset (the lengths before).

    Ranks and sums over all rows need one order; they are made from range partitions, as many as a
    shuffle has: each numbers its own rows, and only the partitions' totals are added up in one place.
    """
    n = int(episodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = episodes.agg(F.percentile_approx(order, [i / n for i in range(1, n)] or [0.5], 10 * n + 100)).first()[0] or []
    rows = episodes.withColumn("_part", range_of(order, sorted(set(keys))))
    totals = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(length).alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as parts
    base = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_frames"))
    own = Window.partitionBy("_part").orderBy(order)
    inner = F.coalesce(F.sum(length).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("_row", F.row_number().over(own) - 1).withColumn("_inner", inner).join(F.broadcast(base), "_part")
    return out.select(*episodes.columns, (F.col("_rows") + F.col("_row")).cast("long").alias("output_index"), (F.col("_frames") + F.col("_inner")).cast("long").alias("global_offset"))


def ordered_digest(files: DataFrame, path: str, digest: str) -> str:
    """The digest of path, NUL, digest, newline of all rows in path order: a sorted table streams by, a partition at a time."""
    import hashlib

    h = hashlib.sha256()
    for r in files.select(path, digest).orderBy(path).toLocalIterator():
        h.update(f"{r[0]}\0{r[1]}\n".encode())
    return h.hexdigest()


def digest_rollup(files: DataFrame, by: str, path: str, digest: str) -> DataFrame:
    """(by, rollup): ``ordered_digest`` of each group. A group's lines stream through one task in order and are never held together."""
    kind = files.schema[by].dataType.simpleString()

    def run(batches):
        import hashlib

        own, h = None, None
        for b in batches:
            groups, lines = [], []
            for g, p, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if h is None or g != own:
                    if h is not None:
                        groups.append(own)
                        lines.append(h.hexdigest())
                    own, h = g, hashlib.sha256()
                h.update(f"{p}\0{d}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array(groups, b.schema.types[0]), pa.array(lines, pa.string())], names=[by, "rollup"])
            last = b.schema.types[0]
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], last), pa.array([h.hexdigest()])], names=[by, "rollup"])

    ordered = files.select(by, path, digest).repartition(by).sortWithinPartitions(by, path)
    return ordered.mapInArrow(run, f"`{by}` {kind}, rollup string")


def remap(records: DataFrame, lengths: DataFrame, status: str = "accepted") -> DataFrame:
    """(source_index, output_index, length, global_offset) of the episodes with the status."""
    own = records.where(F.col("status") == status).join(lengths, "episode_index").select("episode_index", "length")
    return running_offsets(own).select(F.col("episode_index").alias("source_index"), "output_index", "length", "global_offset")


def reindex_frames(frames: DataFrame, mapping: DataFrame) -> DataFrame:
    """Frames of mapped episodes with their new episode_index and index; others are not read on."""
    m = mapping.select(F.col("source_index").alias("episode_index"), "output_index", "global_offset")
    out = frames.join(m, "episode_index")
    columns = [c for c in frames.columns if c not in ("episode_index", "index")]
    return out.select(F.col("output_index").alias("episode_index"), (F.col("global_offset") + F.col("frame_index")).alias("index"), *columns)


def chunk_paths(mapping: DataFrame, chunk_size: int, template: str = "data/chunk-%03d/episode_%06d.parquet") -> DataFrame:
    chunk = F.floor(F.col("output_index") / chunk_size).cast("long")
    return mapping.select("output_index", chunk.alias("episode_chunk"), F.format_string(template, chunk, F.col("output_index")).alias("path"))


def frame_contiguity(frames: DataFrame) -> DataFrame:
    """(episode_index, frames, contiguous): whether frame_index is 0 to frames - 1, each once. Needs no order."""
    g = frames.groupBy("episode_index").agg(F.count("*").alias("frames"), F.count_distinct("frame_index").alias("_d"), F.min("frame_index").alias("_a"), F.max("frame_index").alias("_b"))
    return g.select("episode_index", "frames", ((F.col("_a") == 0) & (F.col("_b") == F.col("frames") - 1) & (F.col("_d") == F.col("frames"))).alias("contiguous"))


def timestamp_order(frames: DataFrame, time: str = "timestamp") -> DataFrame:
    """(episode_index, breaks): how many frames' times are not after the one before."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    rows = frames.select("episode_index", (F.lag(time).over(order) >= F.col(time)).alias("bad"))
    return rows.groupBy("episode_index").agg(F.count(F.when(F.col("bad"), 1)).alias("breaks"))


def split_coverage(splits: DataFrame, total: int) -> DataFrame:
    """What is wrong with half-open ranges (split, first, last): rows (issue, split).

    Disjoint ranges within 0 to total that are total together cover each episode once; neighbours in
    order are compared, no episode list is made.
    """
    order = Window.orderBy("first", "last")  # a handful of splits by definition
    rows = splits.withColumn("_end", F.lag("last").over(order)).withColumn("_next", F.lead("first").over(order))
    checks = F.array_compact(
        F.array(
            F.when((F.col("first") < 0) | (F.col("last") > total) | (F.col("first") >= F.col("last")), F.lit("range")),
            F.when(F.col("_end") > F.col("first"), F.lit("overlap")),
            F.when(F.coalesce("_end", F.lit(0)) < F.col("first"), F.lit("gap")),
            F.when(F.col("_next").isNull() & (F.col("last") < total), F.lit("gap_at_end")),
        )
    )
    return rows.select(F.explode(checks).alias("issue"), "split")


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, side): expected values that are missing, and unexpected ones."""
    missing = expected.join(actual, key, "left_anti").select(key, F.lit("missing").alias("side"))
    return missing.union(actual.join(expected, key, "left_anti").select(key, F.lit("unexpected").alias("side")))


def digest_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, difference) of (path, digest) tables: missing, unexpected or changed."""
    e, a = expected.select("path", F.col("digest").alias("_e")), actual.select("path", F.col("digest").alias("_a"))
    rows = e.join(a, "path", "full_outer").where("NOT (_e <=> _a)")
    return rows.select("path", F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").otherwise("changed").alias("difference"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
