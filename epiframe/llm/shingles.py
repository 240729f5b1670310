"""SimHash near-dedup at a likeness: the Jaccard index of the sets of 5-word shingles is 0.8 or more.

At a likeness of 0.8 the SimHash fingerprints (``simhash``) of two shingle sets differ in some 10 of 64
bits, up to 20 and more; equal segments of them can't bring such pairs together (``op7`` links at 2
bits). So candidates come from the sets: shingles are in one order, rare ones first. Of two sets of
likeness t or more, the first n - ceil(t n) + 1 shingles of each have one in common (n: the set's
size), so documents meet in the buckets of these shingles and no alike pair is missed. Where two meet, the
shingles from there on bound their overlap. Then the pigeonring prunes: fingerprints of the sets pass if a chain of their segments
stays within the proportional budgets of MAX_BITS, and the full Hamming distance within MAX_BITS, which alike sets
exceed with a probability of 1e-5 at 5 shingles and under 1e-8 from 6 on. What passes is verified by the
whole sets. Which shingles are rare is counted on all documents, by the first 48 bits of their hashes: any order gives
the same links, a good one small buckets.

Equal sets are one node. ``linking`` connects all alike nodes; groups are connected components.
Defined cases are those of ``simhash``: texts without words are alike, texts of fewer words than a
shingle have one shingle, rows of one doc_id are one document, rows with a null doc_id stay.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linking
from .common import checkpointed, map_texts, share, slices, small_enough
from .components import components
from .simhash import fingerprint, hashes, survives

#: For the order: how many of the most frequent shingles are taken; all others are rare.
COUNTED = 2_000_000
#: Counts are added up in parts of the hashes' range, by so many bits after those of the part.
PARTS, BITS = 256, 40
#: The pigeonring's budget of differing bits, and its segments.
MAX_BITS, SEGMENTS = 26, 4
#: Pairs of one node that are compared in one place.
PAIRS = 1000
#: Texts are worked on in slices of so many bytes: each word of them takes some hundred bytes.
SLICE = 2 << 20


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes(text, size)]))


def digest(own: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), 7)).view(np.int64))


def prefix(own: np.ndarray, least: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, in order; common: sorted shingles, as ``cut``, whose counts are known."""
    n = len(own)
    if not n:
        return own
    rank = np.zeros(n, np.int64)
    if len(common):
        key = cut(own)
        at = np.minimum(np.searchsorted(common, key), len(common) - 1)
        rank = np.where(common[at] == key, counts[at], 0)
    return own[np.lexsort((own, rank))][: n - int(np.ceil(least * n - 1e-9)) + 1]


def cut(own: np.ndarray) -> np.ndarray:
    """The bits of shingles by which they are counted."""
    return own >> np.uint64(56 - BITS)


def common_shingles(docs: DataFrame, *, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several documents, as ``cut``, sorted, and in how many of all documents they are: the most frequent, bounded.

    A part of the hashes' range goes as arrays of sorted hashes (5 bytes each) and counts, a slice of texts at a time;
    those that a slice has once stand last, without counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", SLICE):
                s, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *(cut(shingle_set(t, size)) for t in part.column(0).to_pylist())]), return_counts=True)
                ends = np.searchsorted(s >> np.uint64(BITS), np.arange(PARTS + 1))
                low = np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8])
                columns = [], [], []
                for i, (a, z) in enumerate(itertools.pairwise(ends.tolist())):
                    if z > a:
                        once = c[a:z] == 1
                        columns[0].append(i)
                        columns[1].append(low[a:z][~once].tobytes() + low[a:z][once].tobytes())
                        columns[2].append(c[a:z][~once].astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "s", "c"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for i, s, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                held.setdefault(i, []).append((np.frombuffer(s, np.uint8), np.frombuffer(c, np.uint32)))
        for i, own in held.items():
            low = np.concatenate([s for s, _ in own]).reshape(-1, BITS // 8)
            c = np.concatenate([np.append(c, np.ones(len(s) // (BITS // 8) - len(c), np.uint32)) for s, c in own])
            own.clear()
            s = np.zeros((len(low), 8), np.uint8)
            s[:, : BITS // 8] = low
            s, at = np.unique(s.view("<u8").ravel(), return_inverse=True)
            c = np.bincount(at, c).astype(np.int64)
            often = c > 2
            yield pa.RecordBatch.from_arrays([pa.array(s[often].view(np.int64) + (i << BITS)), pa.array(c[often])], names=["s", "count"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "part int, s binary, c binary").repartition(PARTS, "part").mapInArrow(total, "s long, count long")
    found = sums.orderBy(F.desc("count"), "s").limit(COUNTED).toArrow()
    s, c = found["s"].to_numpy().view(np.uint64), np.minimum(found["count"].to_numpy(), 2**31 - 1).astype(np.int32)
    order = np.argsort(s)
    return s[order], c[order]


def shared_rows(keyed: DataFrame, several: DataFrame) -> DataFrame:
    """(node, n, print, i, k): the first shingles of keyed (fp_, n_, print_, first_) that are among several's k, and a few others.

    What goes to the tasks is a bitmap of 16 to 32 bits for each k, 2^30 bits at most.
    """
    bits = min(30, max(16, several.count().bit_length() + 4))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for at, where in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = held.get(at)
                if own is None:
                    own = held[at] = np.zeros(1 << 16, bool)
                own[where] = True
        for at, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(own).tobytes()])], names=["at", "data"])

    low = F.col("k").bitwiseAND((1 << bits) - 1)
    blocks = several.select(F.shiftright(low, 16).alias("at"), low.bitwiseAND(0xFFFF).alias("b")).repartition("at").mapInArrow(block, "at long, data binary")
    table = np.zeros(1 << (bits - 3), np.uint8)
    for r in blocks.toLocalIterator():  # the bitmap's size
        table[r["at"] << 13 : (r["at"] + 1) << 13] = np.frombuffer(r["data"], np.uint8)
    shared = share(keyed.sparkSession, table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared()
        for b in batches:
            lists = b.column("first_")
            k = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            i = np.arange(len(k)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = k & ((1 << bits) - 1)
            on = (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            columns = [*(np.repeat(b.column(c).to_numpy(), sizes) for c in ("fp_", "n_", "print_")), i.astype(np.int32), k]
            yield pa.RecordBatch.from_arrays([pa.array(c[on]) for c in columns], names=["node", "n", "print", "i", "k"])

    return keyed.select("fp_", "n_", "print_", "first_").mapInArrow(rows, "node long, n int, print long, i int, k long")


def verified(found: DataFrame, nodes: DataFrame, own: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (x, y) of found, written out, whose whole sets are alike. nodes: (fp_, rep_); own: (key_, text_).

    A node's text goes once to each group of PAIRS of its pairs, whose other texts then stream by it.
    """
    need = found.select(F.explode(F.array("x", "y")).alias("fp_")).distinct().join(nodes, "fp_")
    need = small_enough(checkpointed(need))
    texts = own.join(need, own["key_"] == F.col("rep_")).select("fp_", "text_")
    many = found.groupBy("x").agg(F.floor((F.count("*") - 1) / PAIRS).alias("m"))
    pairs = found.join(many, "x").select("x", "y", F.when(F.col("m") > 0, F.pmod(F.xxhash64("y"), F.col("m") + 1)).otherwise(0).cast("long").alias("s"))
    first = texts.join(many, texts["fp_"] == many["x"]).select("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long"))).alias("s"), F.lit(None).cast("long").alias("y"), "text_")
    other = pairs.join(texts, pairs["y"] == texts["fp_"]).select("x", "s", "y", "text_")
    rows = first.union(other).repartition("x", "s").sortWithinPartitions("x", "s", F.col("y").asc_nulls_first())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held = None
        for b in batches:
            left, right = [], []
            for i, (x, s, y) in enumerate(zip(*(b.column(c).to_pylist() for c in ("x", "s", "y")), strict=True)):
                if at != (x, s):
                    at, held = (x, s), None
                # a key's other rows come along
                if y is None:
                    mine = shingle_set(b.column("text_")[i].as_py(), size) if held is None else held
                    held = mine if digest(mine) == x else None
                elif held is not None:
                    theirs = shingle_set(b.column("text_")[i].as_py(), size)
                    both = len(np.intersect1d(held, theirs, assume_unique=True))
                    if digest(theirs) == y and both >= least * (len(held) + len(theirs) - both) - 1e-9:
                        left.append(x)
                        right.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["x", "y"])

    return rows.mapInArrow(verify, "x long, y long")


def first_of_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """docs without those that are linked, at any distance, to a document of smaller key."""
    spark = docs.sparkSession
    shared = share(spark, common_shingles(docs, text=text, size=size))

    def first():
        common, counts = shared()

        def work(texts, _):
            sets = [shingle_set(t, size) for t in texts]
            firsts = [prefix(s, least, common, counts).view(np.int64) for s in sets]
            columns = [digest(s) for s in sets], [len(s) for s in sets], [fingerprint([s]) for s in sets], firsts
            return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)]

        return work

    fields = [T.StructField("fp_", T.LongType()), T.StructField("n_", T.IntegerType()), T.StructField("print_", T.LongType()), T.StructField("first_", T.ArrayType(T.LongType()))]
    own = docs.select(F.col(key).cast("long").alias("key_"), F.col(text).alias("text_"))
    prints = checkpointed(map_texts(own, first, fields, text="text_", keep=["key_"], limit=SLICE))
    keyed = prints.where("key_ IS NOT NULL")
    nodes = checkpointed(keyed.groupBy("fp_").agg(F.min("key_").alias("rep_")))
    pairs = keyed.select(F.col("fp_").alias("node"), F.explode("first_").alias("k"))
    several = checkpointed(pairs.groupBy("k").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("k"))
    met = checkpointed(shared_rows(keyed, several).distinct().join(several, "k", "left_semi"))

    def alike(found: DataFrame) -> DataFrame:
        return verified(checkpointed(found), nodes, own, size, least)

    def may(p, q):
        met = F.least(p("n") - p("i"), q("n") - q("i")) >= F.ceil((p("n") + q("n")) * (least / (1 + least)) - 1e-6)
        return met & survives(p("print"), q("print"), MAX_BITS, SEGMENTS)

    linked = linking.links(met, alike, may=may)
    by = nodes.withColumnRenamed("fp_", "node")
    edges = linked.join(by.select(F.col("node").alias("x"), F.col("rep_").alias("a")), "x").join(by.select(F.col("node").alias("y"), F.col("rep_").alias("b")), "y").select("a", "b")
    at = checkpointed(keyed.join(nodes, "fp_").select("key_", "rep_").distinct())
    # rows of one key with several sets are one document
    several = at.groupBy("key_").agg(F.min("rep_").alias("a"), F.max("rep_").alias("high")).where("a <> high").select("key_", "a")
    found = components(edges.union(at.join(several, "key_").select("a", F.col("rep_").alias("b"))))
    found = small_enough(checkpointed(found.where("node <> component").withColumnRenamed("node", "rep_")))
    gone = checkpointed(at.join(found, "rep_", "left").where(F.coalesce("component", "rep_") != F.col("key_")).select(F.col("key_").alias("gone_")).distinct())
    return docs.join(small_enough(gone), docs[key] == F.col("gone_"), "left_anti").select(*docs.columns)
