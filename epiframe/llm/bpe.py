"""Byte-level BPE encoding and decoding by rank files.

Pieces of text (the matches of the vocabulary's pattern) are encoded together: the distinct pieces
of a batch that are no token themselves stand as rows of byte ids in padded matrices, bucketed by
length. In each round every row merges its leftmost pair of least rank; pairs are found in an
open-addressing hash table, and finished rows and merged cells are squeezed out when they are many. A
piece of over LONG bytes is a row of its own, in which a round merges all places of the least rank,
which is the same as one after another from the left unless a merge makes a pair of less rank; then
it merges the leftmost alone. So rounds are bounded by the vocabulary, not by the piece.

Null text counts as empty and gives no ids; a text of any length is encoded whole, one over SLICE
bytes in a slice of its own. Repeated rows each keep their row. An empty table gives
an empty result. Other columns are not read unless they are named in ``keep``; a kept column that
has the name of a result column is replaced by it.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import map_texts, schema_with, sha, share, table

NONE = np.int32(2**31 - 1)
LONG = 1024
#: Texts are encoded in slices of so many bytes: each piece of them takes some sixty bytes.
SLICE = 2 << 20


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in rank order; ranks must be 0 to n-1."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """Pairs of ids to the id of their concatenation, by open addressing at a quarter load."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot] == -1
            at, first = np.unique(slot[free], return_index=True)
            placed = todo[free][first]
            self.keys[at], self.values[at] = keys[placed], values[placed]
            left = np.ones(len(todo), bool)
            left[np.flatnonzero(free)[first]] = False
            slot, todo = (slot[left] + 1) & self.mask, todo[left]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids of pairs, NONE where there is none; ids under 0 pair with nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], NONE)
        todo = np.flatnonzero((held != keys) & (held != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        out[(left < 0) | (right < 0)] = NONE
        return out


class Codec:
    """A vocabulary as encoder and decoder."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern, self.rank = tokens, pattern, {t: i for i, t in enumerate(tokens)}
        left, right, whole = [], [], []
        get = self.rank.get
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    whole.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        self.pairs = PairTable(keys, np.array(whole, np.int32))
        self.byte_id = np.array([get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks single bytes")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rank", "split")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.rank = {t: i for i, t in enumerate(self.tokens)}

    def pieces(self, text: str) -> list[str]:
        if "split" not in self.__dict__:
            import regex

            self.split = regex.compile(self.pattern).findall
        return self.split(text)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        get = self.rank.get
        for i, piece in enumerate(pieces):
            whole = get(piece)
            if whole is not None:
                out[i] = [whole]
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault((len(piece) + 3) // 4 if len(piece) <= 32 else 8 + len(piece).bit_length(), []).append(i)
        for rows in buckets.values():
            rows.sort(key=lambda i: len(pieces[i]))
            start = 0
            while start < len(rows):  # matrices of about a million cells
                stop = start + 1
                while stop < len(rows) and (stop + 1 - start) * len(pieces[rows[stop]]) <= 1 << 20:
                    stop += 1
                for i, ids in zip(rows[start:stop], self._merge([pieces[i] for i in rows[start:stop]]), strict=True):
                    out[i] = ids
                start = stop
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        rank = self.pairs.find(ids[:-1], ids[1:])
        while len(rank):
            low = rank.min()
            if low == NONE:
                break
            at = np.flatnonzero(rank == low)
            # of places side by side every second one, from the left
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            new_ids, new_rank = self._merged(ids, rank, at, low)
            if len(at) > 1 and len(new_rank) and new_rank.min() < low:
                new_ids, new_rank = self._merged(ids, rank, at[:1], low)
            ids, rank = new_ids, new_rank
        return ids.tolist()

    def _merged(self, ids: np.ndarray, rank: np.ndarray, at: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
        """The row after its pairs at these places have become one id each, and its pairs' ranks."""
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids = ids.copy()
        ids[at] = to
        ids = ids[keep]
        rank = np.delete(rank, at)
        place = at - np.arange(len(at))
        anew = np.concatenate([place[place > 0] - 1, place[place < len(rank)]])
        rank[anew] = self.pairs.find(ids[anew], ids[anew + 1])
        return ids, rank

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(p) for p in pieces])
        wide = int(sizes.max())
        cell = np.arange(wide) < sizes[:, None]
        ids = np.full((len(pieces), wide), -1, np.int32)
        ids[cell] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list = [None] * len(pieces)
        who = np.arange(len(pieces))
        while True:
            # ids has no gaps here; links let a merge leave its cell behind until the next squeeze
            rows, wide = ids.shape
            rank = np.full((rows, wide), NONE, np.int32)
            if wide > 1:
                rank[:, :-1] = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, wide - 1)
            after = np.broadcast_to(np.arange(1, wide + 1, dtype=np.int32), (rows, wide)).copy()
            before = np.broadcast_to(np.arange(-1, wide - 1, dtype=np.int32), (rows, wide)).copy()
            live, rounds, at = rows, 0, np.arange(rows)
            while live > rows // 2 and rounds < max(1, wide // 2):
                low = rank[at].argmin(axis=1) if live < rows else rank.argmin(axis=1)
                best = rank[at, low]
                go = best != NONE
                at, low, best = at[go], low[go], best[go]
                live = len(at)
                if not live:
                    break
                gone = after[at, low]
                far = after[at, gone]
                ids[at, low], ids[at, gone] = best, -1
                rank[at, gone] = NONE
                after[at, low] = far
                inside = far < wide
                before[at[inside], far[inside]] = low[inside]
                right = np.where(inside, ids[at, np.minimum(far, wide - 1)], -1)
                rank[at, low] = self.pairs.find(best, right)
                back = before[at, low]
                has = back >= 0
                rank[at[has], back[has]] = self.pairs.find(ids[at[has], back[has]], best[has])
                rounds += 1
            done = (rank == NONE).all(axis=1)
            full = ids >= 0
            for r in np.flatnonzero(done):
                out[who[r]] = ids[r][full[r]].tolist()
            left = ~done
            if not left.any():
                return out
            who, kept, full = who[left], ids[left], full[left]
            sizes = full.sum(axis=1)
            ids = np.full((len(who), int(sizes.max())), -1, np.int32)
            ids[np.arange(ids.shape[1]) < sizes[:, None]] = kept[full]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start (one more than texts)."""
        known: dict[str, int] = {}
        number = known.setdefault
        runs = [[number(p, len(known)) for p in self.pieces(t)] if t else [] for t in texts]
        coded = self.encode_pieces([p.encode() for p in known])
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.int32, int(size.sum()))
        place = np.concatenate([[0], np.cumsum(size)])
        use = np.fromiter((p for run in runs for p in run), np.int64, sum(map(len, runs)))
        many = size[use]
        ends = np.cumsum(many)
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - many, many)
        ids = flat[np.repeat(place[use], many) + step]
        edge = np.concatenate([[0], np.cumsum([len(run) for run in runs])]).astype(np.int64)
        starts = np.concatenate([[0], ends])[edge]
        return ids, starts

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(path: str, pattern: str) -> Codec:
    return Codec(load_ranks(path), pattern)


def encode(df: DataFrame, coder: Codec, *, text: str = "text", keep: list[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """df's kept columns, n_tokens and the ids of each text as an array."""
    shared = share(df.sparkSession, coder)  # bounded by the vocabulary

    def make():
        c = shared()

        def work(texts, _):
            flat, starts = c.encode(texts)
            return [pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))]

        return work

    return map_texts(df, make, [T.StructField("n_tokens", T.LongType()), T.StructField(ids, T.ArrayType(T.IntegerType()))], text=text, keep=list(keep), limit=SLICE)


def decode(df: DataFrame, coder: Codec, *, ids: str = "ids", keep: list[str] = ("doc_id",), out: str = "decoded") -> DataFrame:
    """df's kept columns and the bytes that the ids stand for; null ids give no bytes."""
    shared = share(df.sparkSession, coder)
    schema = schema_with(df, list(keep), [T.StructField(out, T.BinaryType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches):
        c = None
        for b in batches:
            c = c or shared()
            data = [c.decode(np.array(x or [], np.int64)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(data, pa.binary())], names=[*kept, out])

    return df.select(*dict.fromkeys([*kept, ids])).mapInArrow(run, schema)


def round_trip(df: DataFrame, coder: Codec, *, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """df's kept columns, n_tokens, and the digests of each text's ids and of what they decode to."""
    shared = share(df.sparkSession, coder)

    def make():
        c = shared()
        named = [str(i) for i in range(len(c.tokens))]

        def work(texts, _):
            flat, starts = c.encode(texts)
            ids_sha, text_sha = [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                own = flat[a:b]
                ids_sha.append(sha(",".join(map(named.__getitem__, own.tolist())).encode()))
                text_sha.append(sha(c.decode(own)))
            return [pa.array(np.diff(starts)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]

        return work

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_texts(df, make, fields, text=text, keep=list(keep), limit=SLICE)


def default_codec(vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> Codec:
    import public_tokenizers

    return codec(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_codec())
