"""Substring dedup: word passages that occur earlier are removed, found with suffix automata.

A window of ``size`` consecutive words is repeated if the same words also start earlier (by doc_id,
then position); each word that a repeated window covers is removed. Equal windows have the same
anchor, the least of the hashes of their GRAM-word grams; runs of windows with one anchor in one
place are worked on together.

1. Anchors are counted over all texts. Those that occur once belong to windows that occur once.
   The others are marked in a bitmap of bounded size (a hash prefilter: what it lets through
   wrongly only costs work).
2. The words under marked runs are the reference passages. A task keeps of its passages those with
   windows that are new to it, with their first places, by the same automata. They are dealt to shards by anchor, so passages that share a window share a shard.
   A shard streams them, in the order of their places, into suffix automata, one for each anchor:
   each step gives the matching statistic, the longest end of the passage so far that occurred
   before; where it reaches size words, the window that ends there is repeated. Automata are not
   broadcast to all documents, as the references grow with the corpus.
3. An anchor of over SPLIT different passages, as a phrase in very many documents has, is not held by
   its task: its passages are passed on, cut anew by longer grams, at the last by whole windows, and
   dealt again by those. So a task holds SPLIT passages at most, whatever repeats.
4. A shard reports the windows that are new at a passage's first place. All other windows of marked
   runs are repeated. The reports go back to the documents, which drop the maximal spans.

Defined cases: null text has no words; rows of one doc_id are the same document, and equal rows of it
do not repeat one another; its different texts do, in the order of their hashes. A null doc_id sorts first. Texts of any
length are read whole: a text's words and some 60 bytes for each are held at a time. Only named
columns are read, whatever else there is and however it is named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, partitions, share, slices, table

GRAM = 6
MAX_BITS = 30
BLOCK_BITS = 19
#: The most different passages of one anchor that a task holds, some 10 KB each.
SPLIT = 4096
#: Stands for a null doc_id.
NO_ID = -(2**63)


class Words:
    """The words of texts and their hashes; hashes of words are kept while they are few."""

    def __init__(self):
        import xxhash

        self.known: dict[bytes, int] = {}
        self.of = xxhash.xxh64_intdigest

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            of = self.of
            for w in set(words):
                if w not in known:
                    known[w] = of(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def runs(codes: np.ndarray, size: int, gram_words: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each run."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.zeros(len(codes) - gram_words + 1, np.uint64)
    for j in range(gram_words):
        gram *= np.uint64(0x9E3779B97F4A7C15)
        gram += codes[j : len(gram) + j]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    # the leftmost least hash of each window, by 36 bits of it: minima over doubling widths
    place = np.uint64((1 << 28) - 1)
    low = (gram & ~place) | np.arange(len(gram), dtype=np.uint64)
    wide, width = low, 1
    span = size - gram_words + 1
    while 2 * width <= span:
        wide = np.minimum(wide[:-width], wide[width:])
        width *= 2
    low = np.minimum(wide[:n], wide[span - width : span - width + n])
    at = (low & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return gram[at[first]].view(np.int64), first, np.diff(np.append(first, n))


class Automaton:
    """A suffix automaton of all passages fed so far, built word by word."""

    def __init__(self):
        self.go: list[dict] = [{}]
        self.link, self.len = [-1], [0]

    def feed(self, words: list[bytes]) -> list[int]:
        """For each word the length of the longest end of the passage up to it that occurred before."""
        go, link, length = self.go, self.link, self.len
        last, out = 0, []
        for w in words:
            if (q := go[last].get(w)) is not None:
                last = self._exact(last, w, q)
                out.append(length[last])
                continue
            new = len(go)
            go.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and w not in go[p]:
                go[p][w] = new
                p = link[p]
            if p >= 0:
                link[new] = self._exact(p, w, go[p][w])
            last = new
            out.append(length[link[new]])
        return out

    def _exact(self, p: int, w: bytes, q: int) -> int:
        """The state of p's longest string with w, split off q if q is longer."""
        go, link, length = self.go, self.link, self.len
        if length[q] == length[p] + 1:
            return q
        clone = len(go)
        go.append(go[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and go[p].get(w) == q:
            go[p][w] = clone
            p = link[p]
        return clone


class Marks:
    """A bitmap over hashes."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def hit(self, anchors: np.ndarray) -> np.ndarray:
        at = anchors & ((1 << self.bits) - 1)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))


def repeated_anchors(rows: DataFrame, size: int) -> DataFrame:
    """(anchor) of those that occur more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [runs(words.hashes((t or "").encode().split()), size)[0] for t in part.column("text").to_pylist()]
                anchor, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], names=["anchor", "n"])

    # equal rows of one doc_id count as well here; that only marks more
    got = rows.select("text").mapInArrow(count, "anchor long, n long")
    return got.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def marked(anchors: DataFrame, most_bits: int = MAX_BITS) -> Marks:
    """The bitmap of anchors (written out): some 16 bits for each, 2^most_bits at most."""
    bits = max(BLOCK_BITS, min(most_bits, (16 * anchors.count()).bit_length()))
    at = F.col("anchor").bitwiseAND((1 << bits) - 1)
    dealt = anchors.select(F.shiftright(at, BLOCK_BITS).alias("block"), at.bitwiseAND((1 << BLOCK_BITS) - 1).alias("bit"))
    dealt = dealt.repartition(partitions(anchors.sparkSession), "block")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bit = batch.column("block").to_numpy(), batch.column("bit").to_numpy()
            for b in np.unique(block).tolist():
                own = held.setdefault(b, np.zeros(1 << BLOCK_BITS, bool))
                own[bit[block == b]] = True
        for b, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()])], names=["block", "data"])

    data = np.zeros(1 << (bits - 3), np.uint8)
    step = 1 << (BLOCK_BITS - 3)
    for r in dealt.mapInArrow(fold, "block long, data binary").toLocalIterator():
        data[r.block * step : (r.block + 1) * step] = np.frombuffer(r.data, np.uint8)
    return Marks(bits, data)


def new_windows(passages: list[list[bytes]], size: int) -> Iterator[int]:
    """For each passage of one anchor, in the order of their places, its windows that none before has, as bits."""
    automaton = None
    for n, w in enumerate(passages):
        if n == 0:
            yield (1 << (len(w) - size + 1)) - 1
            continue
        if automaton is None:
            automaton = Automaton()
            automaton.feed(passages[0])
        yield sum(1 << i for i, m in enumerate(automaton.feed(w)[size - 1 :]) if m < size)


#: Passages: group, document, its text's hash, first window here, anchor and first window of the run they are of, words.
PASSAGE = {"sub": pa.int64(), "k": pa.int64(), "t": pa.int64(), "at": pa.int32(), "anchor": pa.int64(), "s": pa.int32(), "passage": pa.binary()}
PASSAGE_SQL = "sub long, k long, t long, at int, anchor long, s int, passage binary"


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def passages(rows: DataFrame, marks: Callable[[], Marks], size: int) -> DataFrame:
    """The passages (PASSAGE) of each slice of rows that have windows new in the slice, cut to those; their group is their anchor.

    Equal passages and passages with the same windows meet here first, so what is shuffled of copies,
    exact or near, is little for each slice, however many there are.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = Words(), None
        for batch in batches:
            own = own or marks()
            for part in slices(batch, "text"):
                first: dict[tuple[int, bytes], tuple[int, int, int]] = {}
                for k, h, t in zip(*(part.column(c).to_pylist() for c in ("k", "t", "text")), strict=True):
                    w = (t or "").encode().split()
                    anchor, s, n = runs(words.hashes(w), size)
                    hit = own.hit(anchor)
                    for a, i, m in zip(anchor[hit].tolist(), s[hit].tolist(), n[hit].tolist(), strict=True):
                        p = (a, b" ".join(w[i : i + m + size - 1]))
                        if p not in first or (k, h, i) < first[p]:
                            first[p] = (k, h, i)
                by: dict[int, list] = {}
                for (a, p), place in first.items():
                    by.setdefault(a, []).append((place, p))
                out = []
                for a, held in by.items():
                    if len(held) == 1:
                        (k, h, i), p = held[0]
                        out.append((a, k, h, i, a, i, p))
                        continue
                    held.sort()
                    split = [p.split() for _, p in held]
                    for ((k, h, i), _), w, fresh in zip(held, split, new_windows(split, size), strict=True):
                        if fresh:
                            low, high = (fresh & -fresh).bit_length() - 1, fresh.bit_length()
                            out.append((a, k, h, i + low, a, i, b" ".join(w[low : high + size - 1])))
                yield _batch(out, PASSAGE)

    return rows.mapInArrow(cut, PASSAGE_SQL)


def finer(found: DataFrame, size: int, gram_words: int) -> DataFrame:
    """Passages cut by the anchors of longer grams, their groups; of equal ones in a group the first place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            out = []
            for _, k, t, at, a, s, p in zip(*(batch.column(c).to_pylist() for c in PASSAGE), strict=True):
                w = p.split()
                for sub, i, m in zip(*(x.tolist() for x in runs(words.hashes(w), size, gram_words)), strict=True):
                    out.append((sub, k, t, at + i, a, s, b" ".join(w[i : i + m + size - 1])))
            yield _batch(out, PASSAGE)

    cut_rows = found.mapInArrow(cut, PASSAGE_SQL)
    first = cut_rows.groupBy("sub", "passage").agg(F.min(F.struct("k", "t", "at", "anchor", "s")).alias("f"))
    return first.select("sub", "f.k", "f.t", "f.at", "f.anchor", "f.s", "passage")


def fresh_windows(found: DataFrame, size: int, split: int = SPLIT) -> DataFrame:
    """(k, t, anchor, s, fresh): of the passages that have some, the windows (bits from the run's first on) that are new at the passage's first place.

    Groups of over split passages come back whole, as passages, and are dealt anew by longer grams.
    """
    kinds = {**PASSAGE, "fresh": pa.int64()}

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, automaton, told, over = None, {}, None, [], False
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in PASSAGE), strict=True):
                sub, k, t, at, a, s, p = row
                if sub != own or not seen:
                    out += told
                    own, seen, automaton, told, over = sub, {}, None, [], False
                if p in seen:
                    continue
                if over:
                    out.append((*row, None))
                    continue
                if len(seen) == split:
                    out += [(*r, None) for r in seen.values()]
                    out.append((*row, None))
                    seen, automaton, told, over = {None: None}, None, [], True
                    continue
                w = p.split()
                if not seen:
                    fresh = (1 << (len(w) - size + 1)) - 1
                else:
                    if automaton is None:
                        automaton = Automaton()
                        for q in seen:
                            automaton.feed(q.split())
                    fresh = sum(1 << i for i, n in enumerate(automaton.feed(w)[size - 1 :]) if n < size)
                seen[p] = row
                if fresh:
                    told.append((sub, k, t, at, a, s, None, fresh << (at - s)))
            yield _batch(out, kinds)
        yield _batch(told, kinds)

    out, grams = None, [g for g in (size - 4, size) if g > GRAM]
    while True:
        shards = found.repartition(partitions(found.sparkSession), "sub").sortWithinPartitions("sub", "k", "t", "at", "passage")
        got = checkpointed(shards.mapInArrow(stream, PASSAGE_SQL + ", fresh long"))
        told = got.where("fresh IS NOT NULL").select("k", "t", "anchor", "s", "fresh")
        out = told if out is None else out.union(told)
        left = got.where("fresh IS NULL").drop("fresh")
        if not grams or left.isEmpty():
            return out
        found = finer(left, size, grams.pop(0))


def spans(df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 20, split: int = SPLIT) -> tuple[DataFrame, Callable]:
    """Rows (k, text, fresh) and a function that gives, on executors, which words of such a row are removed."""
    if not GRAM < size < GRAM + 62:
        raise ValueError(f"windows of {GRAM + 1} to {GRAM + 61} words")
    rows = _rows(df, key, text)
    bitmap = share(df.sparkSession, marked(checkpointed(repeated_anchors(rows, size))))
    fresh = fresh_windows(passages(rows, bitmap, size), size, split)
    lists = fresh.groupBy(F.col("k").alias("k_"), F.col("t").alias("t_")).agg(F.collect_list(F.struct("s", "anchor", "fresh")).alias("fresh"))  # a text's own windows
    joined = rows.join(lists, (F.col("k") == F.col("k_")) & F.col("t").eqNullSafe(F.col("t_")), "left").select("k", "text", "fresh")

    def make() -> Callable[[list[bytes], list | None], np.ndarray]:
        words, marks = Words(), bitmap()

        def gone(w: list[bytes], told: list | None) -> np.ndarray:
            new: dict[tuple[int, int], int] = {}
            for x in told or ():
                new[x["s"], x["anchor"]] = new.get((x["s"], x["anchor"]), 0) | x["fresh"]
            anchor, s, n = runs(words.hashes(w), size)
            hit = marks.hit(anchor)
            edge = np.zeros(len(w) + 1, np.int32)
            for a, i, m in zip(anchor[hit].tolist(), s[hit].tolist(), n[hit].tolist(), strict=True):
                keep = new.get((i, a), 0)
                if not keep:
                    edge[i] += 1
                    edge[i + m + size - 1] -= 1
                elif keep != (1 << m) - 1:
                    for j in range(m):
                        if not keep >> j & 1:
                            edge[i + j] += 1
                            edge[i + j + size] -= 1
            return np.cumsum(edge[:-1]) > 0

        return gone

    return joined, make


def removed(df: DataFrame, **how) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    rows, make = spans(df, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = None
        for batch in batches:
            gone = gone or make()
            for part in slices(batch, "text"):
                out = []
                for k, t, told in zip(*(part.column(c).to_pylist() for c in ("k", "text", "fresh")), strict=True):
                    w = (t or "").encode().split()
                    off = gone(w, told)
                    n = int(off.sum())
                    kept = b" ".join(x for x, o in zip(w, off.tolist(), strict=True) if not o) if n else b" ".join(w)
                    out.append((None if k == NO_ID else k, len(w), n, hashlib.sha256(kept).hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i+19], ' ')) AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) > 19)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM v) WHERE nth > 1),
g AS (SELECT doc_id, list(DISTINCT k) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS k FROM r) GROUP BY doc_id),
x AS (SELECT w.doc_id, ws, coalesce(gone, []) AS gone FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN len(gone) = 0 THEN ws ELSE list_filter(ws, lambda y, k: NOT list_contains(gone, k)) END, ' '), '')) AS kept_sha256
FROM x
"""
