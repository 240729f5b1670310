"""Language-model scoring by a hashed maximum-entropy model.

Tokens are words (ASCII capitals lower-cased) and an end of text. The most frequent tokens
of the training texts are outputs of their own, in classes of MEMBERS by rank; all others belong to
one of RARE spelling classes, within which a token has its smoothed unigram share, unseen tokens
together one. The probability of a token is that of its class times that within the class; both are
softmaxes over summed weights of active features: the token before, the two before together, the
second before and the third before (skips), by their hashes, rare words by their spelling classes. Features
are hashed to table rows; in the tables for words the class is hashed along. How many outputs, rows and
words with a hash of their own there are is the model's ``Shape``; ``shape_for`` lets rows and words grow
with the training tokens, up to what every executor can hold.

Training is distributed. Every training text is counted: the gradient of the likelihood at the
unigram model is observed less expected counts of (feature, output) pairs, and as no feature is
active yet, the expected counts follow from the feature's own count (by class, in the tables for words).
Tasks give sparse blocks of these counts, which are added up block by block, and each weight takes its damped Newton step from
them. Then come ROUNDS rounds of gradient updates of all weights, to which all training texts are dealt (BATCHES
by crc32, each in a round), so that each text is in one round at least: tasks add up observed less expected counts
at the weights of the round, the driver adds the blocks and takes a step, scaled by the counts. The
scores come from numpy over batches of tokens. Tokens with the same rows have the same probabilities, which are made once a slice of texts.

The token counts stay a table. The HEAD most frequent ones (bounded) go to the tasks; the counts of the
other tokens of each document come by a shuffle join.

Defined cases: null text counts as empty and has the end token only. Equal rows score alike, and each
keeps its row. A null doc_id is training text. Without training text all base scores are 0. A text of
any length is scored whole; one over the slices' size takes some 200 bytes a token. Only named columns are
read, whatever else there is and however it is named.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, partitions, share, slices, table

END = b"\n"
MEMBERS, RARE = 64, 32
HEAD = 250_000
BLOCK = 1 << 16
#: Texts are worked on in slices of so many bytes: a token takes some 200 bytes meanwhile.
SLICE = 4 << 20
#: Contexts whose probabilities are made at once: their rows stay in a core's cache.
STEP = 4096
#: Gradient rounds, the batches that are dealt to them, a round's step, the most a weight's step is before that, and a cell's prior count.
ROUNDS, BATCHES, RATE, MOST, PRIOR = 2, 8, 0.3, 1.5, 10.0
#: What the weights of the first step are multiplied by, as several features say the same: for classes, for words.
FIRST = (0.3, 0.5)
#: A gradient round has a task for so many tokens of the whole training text, and so many tasks at least.
TOKENS, FEWEST = 8_000_000, 2
ONES = np.ones(256, np.float32)
_WIDE = re.compile(rb"[\x80-\xff]{1,2}")


@dataclass(frozen=True)
class Shape:
    """classes: of frequent words, MEMBERS outputs each; bits of the numbers of rows: for classes by the four features, for words by three of them."""

    classes: int = 32
    class_bits: tuple = (12, 15, 12, 12)
    word_bits: tuple = (15, 15, 15)

    @property
    def frequent(self) -> int:
        return self.classes * MEMBERS

    @property
    def contexts(self) -> int:
        """How many of the most frequent words are contexts of their own: half as many as the first table has rows."""
        return max(self.frequent, 1 << (self.class_bits[0] - 1))

    @property
    def out(self) -> int:
        return self.classes + RARE

    def tables(self) -> list[tuple[str, int, int, int, int]]:
        """(layer, kind, first cell, rows, width) of each table; the layer "by" counts a word table's rows by class."""
        found, at = [], 0
        for layer, bits, wide in (("class", self.class_bits, self.out), ("word", self.word_bits, MEMBERS), ("by", self.word_bits, self.classes)):
            for j, b in enumerate(bits):
                found.append((layer, j, at, 1 << b, wide))
                at += wide << b
        return found

    def cells(self, layer: str) -> slice:
        own = [t for t in self.tables() if t[0] == layer]
        return slice(own[0][2], own[-1][2] + own[-1][3] * own[-1][4])

    @property
    def size(self) -> int:
        return self.cells("by").stop


def shape_for(tokens: int, classes: int = 32, most_bits: int = 16) -> Shape:
    """A row of a word table for some 4096 training tokens, as a power of two: 2^15 at least, 2^most_bits at most, then a model of 75 MB."""
    bits = max(15, min(most_bits, (tokens // 4096).bit_length()))
    few = max(12, bits - 3)
    return Shape(classes, (few, bits, few, few), (bits, bits, bits))


def words(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


class Tokens:
    """The tokens of a slice of texts: the different ones, and which of them stands where. Texts are split by Arrow, not word by word."""

    def __init__(self, texts: pa.Array):
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
        flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        full = pc.binary_length(flat).to_numpy() > 0  # blanks at a text's ends give empty words
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        coded = flat.filter(pa.array(full)).dictionary_encode()
        self.unique = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
        self.sizes = np.diff(ends) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.index = np.full(int(self.sizes.sum()), len(self.unique) - 1, np.int32)
        words = np.ones(len(self.index), bool)
        words[self.starts + self.sizes - 1] = False
        self.index[words] = coded.indices.to_numpy()


def rare_class(word: bytes) -> int:
    """0 to RARE-1, by the first non-ASCII character, or else by the last two letters."""
    wide = _WIDE.search(word)
    return zlib.crc32(wide[0]) % 8 if wide else 8 + zlib.crc32(word[-2:]) % (RARE - 8)


class Ids:
    """Tokens to numbers: the place among the tokens at hand, the frequent first; that of all others is FAR."""

    FAR = np.iinfo(np.int32).max

    def __init__(self, shape: Shape, known: list[bytes]):
        """known: the tokens at hand, the most frequent first, with at least those that the shape has use for."""
        self.shape, self.known = shape, pa.array(known, pa.binary())
        self.code = np.array([zlib.crc32(w) for w in known[: shape.contexts]] or [0], np.uint32)
        self.one = np.array([zlib.crc32(bytes([a])) for a in range(256)], np.uint32)
        self.two = np.array([zlib.crc32(bytes([a, b])) for a in range(256) for b in range(256)], np.uint32)

    def rare_classes(self, words: pa.Array) -> np.ndarray:
        """rare_class of each of the words, none of them empty."""
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(data, np.uint8)
        last, before = data[ends[1:] - 1], data[np.maximum(ends[1:] - 2, 0)].astype(np.int32)
        out = 8 + np.where(np.diff(ends) > 1, self.two[before << 8 | last], self.one[last]) % (RARE - 8)
        wide = np.flatnonzero(data[ends[0] : ends[-1]] >= 0x80) + ends[0]
        word = np.searchsorted(ends, wide, "right") - 1
        first = np.flatnonzero(np.diff(word, prepend=-1))
        at, word = wide[first], word[first]
        after = data[np.minimum(at + 1, len(data) - 1)]
        pair = self.two[data[at].astype(np.int32) << 8 | after]
        out[word] = np.where((at + 1 < ends[word + 1]) & (after >= 0x80), pair, self.one[data[at]]) % 8
        return out.astype(np.int32)

    def numbers(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens as numbers, outputs (from the shape's frequent on: the spelling class) and contexts (itself, or if it is none of the shape's first words its spelling class)."""
        import pyarrow.compute as pc

        n = pc.fill_null(pc.index_in(tokens.unique, self.known), self.FAR).to_numpy()
        rare, f = self.rare_classes(tokens.unique), self.shape.frequent
        out = np.where(n < f, n, f + rare)
        own = np.where(n < self.shape.contexts, self.code[np.minimum(n, len(self.code) - 1)], rare.astype(np.uint32))
        return n[tokens.index], out[tokens.index], own[tokens.index]

    def contexts(self, tokens: Tokens) -> Contexts:
        _, out, code = self.numbers(tokens)
        return Contexts(self.shape, out, code, tokens.starts)


def mixed(a: np.ndarray, rows: int, salt: int = 0) -> np.ndarray:
    """Rows, a power of two, of 32-bit keys."""
    h = (a + np.uint32(salt)) * np.uint32(2654435761)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519)
    return h >> np.uint32(33 - rows.bit_length())


class Contexts:
    """The table rows of the tokens of consecutive texts; before a text stand ends of text."""

    def __init__(self, shape: Shape, out: np.ndarray, code: np.ndarray, starts: np.ndarray):
        n = len(out)
        before, end = [], np.uint32(zlib.crc32(END))
        for back in (1, 2, 3):
            p = np.full(n, end, np.uint32)
            p[back:] = code[: max(0, n - back)]
            for into in range(back):  # texts have one token at least
                at = starts + into
                p[at[at < np.append(starts[1:], n)]] = end
            before.append(p)
        one, two, three = before
        frequent = out < shape.frequent
        self.shape = shape
        self.y = np.where(frequent, out // MEMBERS, out + (shape.classes - shape.frequent))
        self.at = np.flatnonzero(frequent)
        self.member = out[self.at] % MEMBERS
        kinds = [one, two * np.uint32(2246822519) + one, two, three]
        of = self.y[self.at].astype(np.uint32) * np.uint32(0x9E3779B9)
        #: Rows within their own tables.
        self.rows = [mixed(k, 1 << b, j).astype(np.int32) for j, (k, b) in enumerate(zip(kinds, shape.class_bits, strict=True))]
        self.word_rows = [mixed(k[self.at] ^ of, 1 << b, j + 9).astype(np.int32) for j, (k, b) in enumerate(zip(kinds, shape.word_bits, strict=False))]

    def distinct(self, layer: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of a layer (of the words': places in ``at``) so that those of the same rows and base stand together; where each such context starts; where each run of contexts of the same first three rows does."""
        rows, bits = (self.rows, self.shape.class_bits) if layer == "class" else (self.word_rows, self.shape.word_bits)
        key = np.zeros(len(rows[0]), np.int64) if layer == "class" else self.y[self.at].astype(np.int64)
        for r, b in zip(rows, bits, strict=True):
            key <<= b
            key |= r
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[first]
        return order, first, np.flatnonzero(np.diff(key >> sum(bits[3:]), prepend=-1))

    def observed(self, cells: np.ndarray, by_class: bool = True) -> None:
        """Adds the counts of (row, output) to cells."""
        for layer, j, at, rows, wide in self.shape.tables():
            if layer == "by" and not by_class:
                continue
            row, y = (self.rows[j], self.y) if layer == "class" else (self.word_rows[j], self.member if layer == "word" else self.y[self.at])
            own = cells[at : at + rows * wide]
            np.add(own, np.bincount(row * wide + y, minlength=rows * wide), out=own, casting="unsafe")


def row_sums(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows, each once, and the sums of their values, which are changed. Neighbours are added in pairs, then pairs, and so on: reduceat would take each column of each row by itself."""
    new = np.ones(len(row), bool)
    np.not_equal(row[1:], row[:-1], out=new[1:])
    start = np.flatnonzero(new)
    if len(start) == len(row):
        return row, values
    place = np.arange(len(row)) - start[np.cumsum(new) - 1]
    left, by = np.flatnonzero(place), 1
    while len(left):
        odd = place[left] & by > 0
        at = left[odd]
        values[at - by] += values[at]
        left, by = left[~odd], by * 2
    return row[start], values[start]


def take_off(to: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Takes each row's values off to's row."""
    order = np.argsort(row)
    row, values = row_sums(row[order], values[order])
    to[row] -= values


class Model:
    """Weights of all tables in one array, as ``Shape.tables`` deals it."""

    def __init__(self, shape: Shape, words: list[bytes], counts: np.ndarray, rare: np.ndarray, cells: np.ndarray | None = None, prior: float = 4.0):
        """words: the most frequent, as many as the shape has use for, with their counts; rare: (counts, distinct tokens) by spelling class; cells: the observed counts."""
        self.shape, self.words, self.counts = shape, words, counts
        self.end = words.index(END)
        self.tokens = int(counts[: shape.frequent].sum() + rare[0].sum())
        n = np.zeros(shape.frequent)
        n[: len(counts)] = counts[: shape.frequent]
        n = n.reshape(shape.classes, MEMBERS)
        total = np.concatenate([n.sum(axis=1), rare[0]])
        self.class_p = np.log((total + 0.5) / (total + 0.5).sum()).astype(np.float32)
        self.word_p = np.log((n + 0.1) / (n + 0.1).sum(axis=1, keepdims=True)).astype(np.float32)
        #: log10 of what a rare token's count and 0.1 are divided by
        self.rare_z = np.log10(rare[0] + 0.1 * (rare[1] + 1))
        self.weights = np.zeros(shape.cells("word").stop, np.float32)
        if cells is not None:
            for (layer, _, at, rows, wide), step in self._tables(cells, prior):
                self.weights[at : at + rows * wide] = step.ravel() * np.float32(FIRST[layer == "word"])

    def _tables(self, cells: np.ndarray, prior: float) -> Iterator[tuple[tuple, np.ndarray]]:
        """Tables with damped Newton steps of their weights from the unigram model: the log of observed to expected counts, shrunk."""
        by = {j: cells[at : at + rows * wide].reshape(rows, wide) for layer, j, at, rows, wide in self.shape.tables() if layer == "by"}
        for table in self.shape.tables():
            layer, j, at, rows, wide = table
            if layer == "by":
                return
            seen, step = cells[at : at + rows * wide].reshape(rows, wide), np.empty((rows, wide), np.float32)
            for i in range(0, rows, 4096):
                own = seen[i : i + 4096].astype(np.float32)
                if layer == "class":
                    expected = own.sum(axis=1, keepdims=True) * np.exp(self.class_p)
                    base = np.exp(self.class_p)[None, :]
                else:
                    share = by[j][i : i + 4096].astype(np.float32)
                    expected = share @ np.exp(self.word_p)
                    base = expected / np.maximum(1, share.sum(axis=1, keepdims=True))
                step[i : i + 4096] = np.log((own + prior * base + 1e-6) / (expected + prior * base + 1e-6))
            yield table, step

    def tables(self, weights: np.ndarray | None = None) -> dict[str, list[np.ndarray]]:
        w = self.weights if weights is None else weights
        out: dict[str, list[np.ndarray]] = {"class": [], "word": []}
        for layer, _, at, rows, wide in self.shape.tables():
            if layer != "by":
                out[layer].append(w[at : at + rows * wide].reshape(rows, wide))
        return out

    def _layers(self, c: Contexts) -> Iterator[tuple]:
        """(layer, tokens, context of each, rows of the contexts, runs, logits) for STEP contexts at a time, tokens in contexts' order; runs: how many contexts each run has whose first three rows are the same."""
        tables = self.tables()
        room = np.empty((2, STEP * max(self.shape.out, MEMBERS)), np.float32)
        for layer, own in (("class", c.rows), ("word", c.word_rows)):
            order, first, run = c.distinct(layer)
            ends = np.append(first, len(order))
            for i in range(0, len(first), STEP):
                n = min(STEP, len(first) - i)
                tokens = order[ends[i] : ends[i + n]]
                context = np.repeat(np.arange(n), np.diff(ends[i : i + n + 1]))
                lead = order[first[i : i + n]]
                rows = [r[lead] for r in own]
                start = np.concatenate([[0], run[np.searchsorted(run, i + 1) : np.searchsorted(run, i + n)] - i])
                runs = np.diff(np.append(start, n))
                head = [r[start] for r in rows[:3]]
                wide = tables[layer][0].shape[1]
                few, more = (x[: len(start) * wide].reshape(-1, wide) for x in room)
                np.take(tables[layer][0], head[0], 0, few, "clip")
                for t, r in zip(tables[layer][1:3], head[1:], strict=True):
                    np.take(t, r, 0, more, "clip")
                    few += more
                few += self.class_p if layer == "class" else self.word_p[c.y[c.at[lead[start]]]]
                if layer == "class":
                    logit = np.repeat(few, runs, 0)
                    more = room[1, : n * wide].reshape(-1, wide)
                    np.take(tables[layer][3], rows[3], 0, more, "clip")
                    logit += more
                else:
                    logit = few
                yield layer, tokens, context, rows, runs, logit

    def log_p(self, c: Contexts) -> np.ndarray:
        """Natural logs of the probability of each token's class, and, if frequent, of it within the class."""
        out = np.zeros(len(c.y))
        for layer, tokens, context, _, _, logit in self._layers(c):
            y, at = (c.y[tokens], tokens) if layer == "class" else (c.member[tokens], c.at[tokens])
            own = logit[context, y]
            np.exp(logit, out=logit)
            out[at] += own - np.log(logit @ ONES[: logit.shape[1]])[context]
        return out

    def expected(self, c: Contexts, cells: np.ndarray) -> None:
        """Takes the expected counts of (row, output) off cells."""
        off = self.tables(cells)
        for layer, _, context, rows, runs, p in self._layers(c):
            np.exp(p, out=p)
            p *= (np.bincount(context) / (p @ ONES[: p.shape[1]])).astype(np.float32)[:, None]
            if layer == "class":
                take_off(off[layer][3], rows[3], p)
            at, p = row_sums(np.repeat(np.arange(len(runs)), runs), p)
            start = np.cumsum(runs) - runs
            for t, r in zip(off[layer][:3], rows[:3], strict=True):
                take_off(t, r[start], p)

    def update(self, gradient: np.ndarray, cells: np.ndarray, share: float) -> None:
        """A step by a batch's gradient, scaled by the counts that the batch, a share of the texts, would have."""
        size = len(self.weights)
        for i in range(0, size, 1 << 20):
            part = slice(i, min(size, i + (1 << 20)))
            scale = cells[part].astype(np.float32) * np.float32(share) + np.abs(gradient[part]) * np.float32(0.5) + np.float32(0.5 * PRIOR * share + 0.1)
            self.weights[part] += np.float32(RATE) * np.clip(gradient[part] / scale, -MOST, MOST)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield part, Tokens(part.column("text"))


def token_counts(train: DataFrame) -> DataFrame:
    """(token, c): every token of the texts, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"])

        had = seen.get
        for _, t in _text_batches(batches):
            for w, n in zip(t.unique.to_pylist(), np.bincount(t.index, minlength=len(t.unique)).tolist(), strict=True):
                seen[w] = had(w, 0) + n
            if len(seen) > 1_000_000:
                yield out()
                seen.clear()
        yield out()

    return train.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def rare_totals(counts: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """Counts and numbers of the distinct tokens that aren't frequent, by spelling class."""
    shared = share(counts.sparkSession, frozenset(frequent))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = shared(), np.zeros((2, RARE), np.int64)
        for b in batches:
            for w, c in zip(b.column("token").to_pylist(), b.column("c").to_pylist(), strict=True):
                if w not in known:
                    r = rare_class(w)
                    sums[0, r] += c
                    sums[1, r] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(RARE), pa.int64()), pa.array(sums[0]), pa.array(sums[1])], names=["r", "c", "v"])

    out = np.zeros((2, RARE))
    for row in counts.mapInArrow(total, "r long, c long, v long").groupBy("r").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect():
        out[:, row.r] = row.c, row.v
    return out


def summed(texts: DataFrame, make: Callable, kind: np.dtype, size: int) -> np.ndarray:
    """The sum over the tasks of an array of cells. make gives, in a task, a function that adds the part of a slice's tokens to it.

    Arrays go as sparse blocks, which are added up block by block; what the driver gets is an array of the model's size.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, cells = None, np.zeros(size, kind)
        for _, tokens in _text_batches(batches):
            add = add or make()
            add(tokens, cells)
        for b in range(0, size, BLOCK):
            own = cells[b : b + BLOCK]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK], pa.int32()), pa.array([packed(own)])], names=["block", "data"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for m in batches:
            for b, d in zip(*(c.to_pylist() for c in m.columns), strict=True):
                unpack(d, held.setdefault(b, np.zeros(BLOCK, np.int64 if np.issubdtype(kind, np.integer) else np.float64)))
        for b, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed(own)])], names=["block", "data"])

    columns = "block int, data binary"
    sums = texts.mapInArrow(part, columns).repartition(partitions(texts.sparkSession), "block").mapInArrow(total, columns)
    out = np.zeros(-(-size // BLOCK) * BLOCK, np.int64 if np.issubdtype(kind, np.integer) else np.float32)
    for r in sums.toLocalIterator():
        unpack(r.data, out[r.block * BLOCK : (r.block + 1) * BLOCK])
    return out[:size]


def gathered(train: DataFrame, shape: Shape, known: list[bytes]) -> np.ndarray:
    """The observed counts of (feature, output) pairs of the texts. known: tokens that are looked up, the most frequent first."""
    shared = share(train.sparkSession, known)

    def make():
        ids = Ids(shape, shared())
        return lambda tokens, cells: ids.contexts(tokens).observed(cells)

    return summed(train.select("text"), make, np.dtype(np.int32), shape.size)


def gradient(batch: DataFrame, model: Model) -> np.ndarray:
    """Observed less expected counts of the texts at the model's weights."""
    shared = share(batch.sparkSession, model)

    def make():
        m = shared()
        ids = Ids(m.shape, m.words)

        def add(tokens, cells):
            c = ids.contexts(tokens)
            c.observed(cells, by_class=False)
            m.expected(c, cells)

        return add

    # each task gives a whole gradient, some 16 MB: as many tasks as have work for it
    rows = batch.select("text")
    tasks = max(1, min(rows.rdd.getNumPartitions(), max(FEWEST, model.tokens // TOKENS)))
    return summed(rows.coalesce(tasks), make, np.dtype(np.float32), len(model.weights))


def packed(cells: np.ndarray) -> bytes:
    """A block of whole numbers, or of reals to 8 binary digits, without its zeros: a letter for the kind, the places' distances, the values."""
    at = np.flatnonzero(cells)
    if np.issubdtype(cells.dtype, np.integer):
        kind = next(k for k in "BHq" if k == "q" or 0 <= cells.min() and cells.max() <= np.iinfo(k).max)
        values = cells[at].astype(kind)
    else:
        kind, values = "f", ((cells[at].astype(np.float32).view(np.uint32) + np.uint32(1 << 15)) >> np.uint32(16)).astype(np.uint16)
    return kind.encode() + np.uint32(len(at)).tobytes() + np.diff(at, prepend=0).astype(np.uint16).tobytes() + values.tobytes()


def unpack(data: bytes, to: np.ndarray) -> None:
    n = int(np.frombuffer(data, np.uint32, 1, 1)[0])
    at = np.cumsum(np.frombuffer(data, np.uint16, n, 5).astype(np.int64))
    kind = chr(data[0])
    if kind == "f":
        to[at] += (np.frombuffer(data, np.uint16, n, 5 + 2 * n).astype(np.uint32) << np.uint32(16)).view(np.float32)
    else:
        to[at] += np.frombuffer(data, kind, n, 5 + 2 * n)


@dataclass(frozen=True)
class Head:
    """What is known of the counts: all tokens' count and number, that of the ends of text, and the most frequent others (token, c), the most frequent first."""

    total: int
    distinct: int
    ends: int
    rows: list[tuple[bytes, int]]


def head_of(counts: DataFrame, most: int = HEAD) -> Head:
    """The rows are as many whole count levels, an eighth of a doubling wide, as hold most tokens at most; if the first holds more, most of its tokens."""
    level, is_end = F.floor(F.log2("c") * 8).cast("int"), F.col("token") == F.lit(bytearray(END))
    levels = counts.groupBy(level.alias("l")).agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.sum(F.when(is_end, F.col("c"))).alias("ends")).orderBy(F.desc("l")).collect()  # some 500 levels
    held, cut = 0, None
    for r in levels:
        held += r.n
        if held > most:
            break
        cut = r.l
    some = counts.where(~is_end)
    rows = (some.where(level >= cut) if cut is not None else some.orderBy(F.desc("c"), "token").limit(most)).toArrow()
    found = sorted(zip(rows["token"].to_pylist(), rows["c"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    return Head(sum(r.c for r in levels), sum(r.n for r in levels), sum(r.ends or 0 for r in levels), found)


def train_model(train: DataFrame, batch: str, counts: DataFrame, *, classes: int = 32, rounds: int = ROUNDS, shape: Shape | None = None, head: Head | None = None) -> Model:
    """A model of the texts of train (text, and batch: a number from 0 to BATCHES - 1 that deals them to the rounds, all of them)."""
    head = head or head_of(counts)
    shape = shape or shape_for(head.total, classes)
    # the end is an output whatever its count
    rows = sorted([(END, head.ends), *head.rows[: shape.frequent - 1]], key=lambda r: (-r[1], r[0])) + head.rows[shape.frequent - 1 :]
    own = rows[: shape.contexts]
    rare = rare_totals(counts, [w for w, _ in own[: shape.frequent]])
    cells = gathered(train, shape, [w for w, _ in rows])
    model = Model(shape, [w for w, _ in own], np.array([c for _, c in own], float), rare, cells)
    parts = min(rounds, BATCHES)
    for r in range(rounds):
        at = r % parts  # every text is in one round at least
        model.update(gradient(train.where(F.col(batch) % parts == at), model), cells, len(range(at, BATCHES, parts)) / BATCHES)
    return model


def score(df: DataFrame, model: Model, counts: DataFrame, *, text: str = "text", keep: list[str] = ("doc_id",), head: int | Head = HEAD) -> DataFrame:
    """df's kept columns, n_tokens, n_known, train_tokens, base_score and score. counts (token, c): written out.

    The counts of the head most frequent tokens and of the model's own are at hand in the tasks.
    """
    spark = df.sparkSession
    known = head if isinstance(head, Head) else head_of(counts, head)
    n, v = known.total, known.distinct
    z = float(np.log10(n + 0.1 * (v + 1)))
    own = set(model.words)
    top = [r for r in known.rows if r[0] not in own]
    shared = share(spark, (model, [w for w, _ in top], np.array([c for _, c in top], np.float64)))
    keep = list(keep)
    extra = {"n_tokens": "long", "known": "long", "base": "double", "own": "double", "n_rest": "long", "rest": "array<binary>"}
    columns = [f"_k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for part, tokens in _text_batches(batches):
            if m is None:
                m, more, c = shared()
                ids = Ids(m.shape, [*m.words, *more])
                logs = np.log10(np.concatenate([m.counts, c, [0.9]]) + 0.1)  # the last, 0, is for tokens that aren't at hand
            number, own, code = ids.numbers(tokens)
            there = number < len(ids.known)
            log = logs[np.minimum(number, len(ids.known))]
            sizes, starts = tokens.sizes, tokens.starts
            p = m.log_p(Contexts(m.shape, own, code, starts)) / np.log(10)
            rare = np.flatnonzero(own >= m.shape.frequent)
            p[rare] += log[rare] - m.rare_z[own[rare] - m.shape.frequent]
            far = np.flatnonzero(~there)
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(far, np.append(starts, len(number))).astype(np.int32)), tokens.unique.take(pa.array(tokens.index[far])))
            known = np.add.reduceat(there.astype(np.int64), starts)
            seen = known if m.counts[m.end] else known - 1  # without training texts not even the end is known
            values = [sizes, seen, np.add.reduceat(log, starts), np.add.reduceat(p, starts), sizes - known]
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in columns), *map(pa.array, values), rest], names=[*columns, *extra])

    rows = df.select(*(F.col(k).alias(c) for k, c in zip(keep, columns, strict=True)), F.col(text).alias("text"))
    kinds = ", ".join([*(f"{c} {df.schema[k].dataType.simpleString()}" for k, c in zip(keep, columns, strict=True)), *(f"{k} {t}" for k, t in extra.items())])
    got = checkpointed(rows.mapInArrow(run, kinds).withColumn("_row", F.monotonically_increasing_id()))
    rest = got.select("_row", F.explode("rest").alias("token"))
    sums = rest.join(counts, "token", "left").groupBy("_row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("more"), F.count("c").alias("also"))
    out = got.drop("rest").join(sums, "_row", "left").fillna({"more": 0.0, "also": 0})
    return out.select(
        *(F.col(c).alias(k) for k, c in zip(keep, columns, strict=True)),
        "n_tokens",
        (F.col("known") + F.col("also")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") - F.col("n_tokens") * F.lit(z)).alias("base_score"),
        (F.col("own") + F.col("more")).alias("score"),
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    code = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(2))
    train = docs.where(code % 10 != 0).select("text", (F.floor(code / 10) % BATCHES).alias("batch"))
    counts = checkpointed(token_counts(train))
    head = head_of(counts)
    model = train_model(train, "batch", counts, head=head)
    out = score(docs, model, counts, head=head)
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
