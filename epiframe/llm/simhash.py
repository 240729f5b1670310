"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits; a bit is set if over half of the shingles' XXH64 hashes have it. Two
fingerprints link at ``max_bits`` or fewer differing bits. A fingerprint is cut into max_bits + 2
segments on a ring, so two linked ones are equal in two segments at least: fingerprints meet in the
buckets of their pairs of segments (for 2 bits, six buckets of 32 bits each). A pair of a bucket
survives only if from some segment on, going round the ring, the differences of the first l segments
never exceed l * max_bits / segments (the pigeonring chain); then the full Hamming distance decides.

A bucket of over BUCKET distinct fingerprints is dealt on by more bits of the same kind: what its key
leaves is cut into max_bits + 1 segments, in one of which linked fingerprints are equal. So all pairs
are found in buckets of at most BUCKET members, whatever is in the table (at the last, BUCKET
fingerprints is all that the remaining bits can tell apart), and a fingerprint is dealt to
max_bits + 1 buckets for each full one.

Links of a bucket are given as a forest that connects what they connect. Groups are connected
components; equal fingerprints are one node, so copies are never paired.

Defined cases: null text has no words; texts without words have fingerprint zero and link like any
other; texts of fewer words than a shingle have one shingle of all words; long texts are hashed in pieces
of bounded size. Rows of one doc_id are one document for the groups; each keeps its row. A row whose
doc_id is null has a null component. Only named columns are read.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, map_texts, pieces, small_enough, table
from .components import components

#: A power of two: the most fingerprints that are compared with each other.
BUCKET = 512


def hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """XXH64 with seed 42 of every shingle, repeats included, in pieces."""
    import xxhash

    of, before, none = xxhash.xxh64_intdigest, [], True
    for piece in pieces((text or "").encode()):
        words = [*before, *piece.lower().split()]
        before = words[len(words) - size + 1 :] if len(words) >= size else words
        if len(words) < size or size == 1 and not words:
            continue
        none = False
        flat = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        behind = np.cumsum(lengths)
        first, last = (behind - lengths).tolist(), (behind - 1)[size - 1 :].tolist()
        yield np.fromiter((of(flat[a:b], 42) for a, b in zip(first, last, strict=False)), np.uint64, len(last))
    if none and before:
        yield np.array([of(b" ".join(before), 42)], np.uint64)


def fingerprint(h: Iterable[np.ndarray]) -> int:
    """Of hashes in pieces, as a signed long."""
    total, n = np.zeros(64, np.int64), 0
    for piece in h:
        for i in range(0, len(piece), 1 << 16):
            bits = np.unpackbits(piece[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        n += len(piece)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, *, size: int = 3, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """df's kept columns and fp, the fingerprint as a signed long."""

    def make():
        return lambda texts, _: [pa.array([fingerprint(hashes(t, size)) for t in texts], pa.int64())]

    return map_texts(df, make, [T.StructField("fp", T.LongType())], text=text, keep=list(keep))


def cut(mask: int, parts: int) -> list[int]:
    """The bits that mask leaves, in order, in parts runs of nearly equal length, as masks."""
    left = [i for i in range(64) if not mask >> i & 1]
    ends = [len(left) * p // parts for p in range(parts + 1)]
    return [sum(1 << i for i in left[a:b]) for a, b in itertools.pairwise(ends)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chain(apart: np.ndarray, max_bits: int, segments: int) -> np.ndarray:
    """Whether differences pass the pigeonring: from some segment on, no l segments differ in more than l * max_bits / segments bits."""
    d = np.array([np.bitwise_count(apart & np.uint64(m)) for m in cut(0, segments)], np.int64)
    ok = np.zeros(len(apart), bool)
    for first in range(segments):
        run, good = np.zeros(len(apart), np.int64), np.ones(len(apart), bool)
        for l in range(1, segments + 1):
            run += d[(first + l - 1) % segments]
            good &= run * segments <= l * max_bits
        ok |= good
    return ok


def survives(a: Column, b: Column, max_bits: int, segments: int) -> Column:
    """The chain, then the Hamming distance, on columns."""
    apart = a.bitwiseXOR(b)
    d = [F.bit_count(apart.bitwiseAND(F.lit(signed(m)))) for m in cut(0, segments)]
    runs = [[sum((d[(f + j) % segments] for j in range(1, l)), d[f]) * segments <= l * max_bits for l in range(1, segments + 1)] for f in range(segments)]
    return reduce(operator.or_, (reduce(operator.and_, run) for run in runs)) & (F.bit_count(apart) <= max_bits)


def chain_pairs(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a bucket that the chain lets through and the Hamming distance confirms."""
    a, b = np.triu_indices(len(fp), 1)
    apart = (fp[a] ^ fp[b]).view(np.uint64)
    for test in (lambda x: chain(x, max_bits, max_bits + 2), lambda x: np.bitwise_count(x) <= max_bits):
        ok = test(apart)
        a, b, apart = a[ok], b[ok], apart[ok]
    return a, b


def forest(fps: list[int], reps: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Pairs of reps that connect what a bucket's pairs connect."""
    root, out = list(range(len(fps))), []
    for i, j in zip(*(x.tolist() for x in chain_pairs(np.array(fps, np.int64), max_bits)), strict=True):
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        if i != j:
            root[j] = i
            out.append((reps[i], reps[j]))
    return out


def links(nodes: DataFrame, *, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) of nodes (fp, rep), fps distinct, enough of them to connect all that are linked."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for f, r in zip(*(batch.column(c).to_pylist() for c in ("fps", "reps")), strict=True) for x in forest(f, r, max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    segments = cut(0, max_bits + 2)
    masks = sorted({a | b for a, b in itertools.combinations(segments, 2)})
    rows = nodes.select("fp", "rep", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"))
    out = None
    while True:
        # a bucket's key is the mask and the bits under it
        sizes = checkpointed(rows.groupBy("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("val")).count().where("count > 1"))
        met = rows.withColumn("val", F.col("fp").bitwiseAND(F.col("mask"))).join(small_enough(sizes), ["mask", "val"])
        # the sizes are exact, so the gathered lists are of bucket members at most
        lists = met.where(F.col("count") <= bucket).groupBy("mask", "val").agg(F.collect_list("fp").alias("fps"), F.collect_list("rep").alias("reps"))
        found = lists.select("fps", "reps").mapInArrow(pairs, "a long, b long")
        out = found if out is None else out.union(found)
        if sizes.where(F.col("count") > bucket).isEmpty():
            return out
        finer = {m: sorted({m | part for part in cut(m, max_bits + 1)}) for m in masks}
        masks = sorted({x for own in finer.values() for x in own})
        deal = F.create_map(*(x for m, own in finer.items() for x in (F.lit(signed(m)), F.array(*(F.lit(signed(x)) for x in own)))))
        rows = met.where(F.col("count") > bucket).select("fp", "rep", F.explode(F.element_at(deal, F.col("mask"))).alias("mask")).distinct()


def groups(prints: DataFrame, *, key: str = "doc_id", max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(fp, component) for each distinct fp of prints (key, fp) that are written out; component: the least key reachable."""
    nodes = prints.groupBy("fp").agg(F.min(key).alias("rep"))
    found = components(links(nodes.where("rep IS NOT NULL"), max_bits=max_bits, bucket=bucket))
    return nodes.join(found, nodes.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component"))


def near_groups(df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3, max_bits: int = 2) -> DataFrame:
    """(key, fp, component) for each row of df."""
    prints = checkpointed(fingerprints(df, size=size, text=text, keep=[key]))
    return prints.join(groups(prints, key=key, max_bits=max_bits), "fp").select(key, "fp", F.when(F.col(key).isNotNull(), F.col("component")).alias("component"))


def first_of_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3, max_bits: int = 2) -> DataFrame:
    """docs without those that are linked, at any distance, to a document of smaller key."""
    got = near_groups(docs, key=key, text=text, size=size, max_bits=max_bits)
    gone = checkpointed(got.where(F.col("component") != F.col(key)).select(key).distinct())
    return docs.join(small_enough(gone), key, "left_anti").select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
