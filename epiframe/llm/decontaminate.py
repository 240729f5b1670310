"""Benchmark decontamination with an Aho-Corasick automaton.

Texts and items are normalised alike: A-Z lower-cased, words are runs of digits, letters and
non-ASCII characters, joined by single blanks. The patterns are the windows of ``size`` consecutive
words of the items; an item of fewer words is one window. The automaton scans each normalised text
once; where it hits, ends of matches are mapped to word numbers and, for spans, to character
offsets of the original text.

The items' windows are dealt to automata by size: each holds at most SHARD_CHARS of patterns, so a
broadcast is bounded; a larger benchmark takes more scans, and nothing is left out.

Defined cases: null text has no words; an item without words or with a null id is no item; equal
windows of several items count for each; repeated rows each keep their row; an empty benchmark hits
nothing. A text of any length is scanned whole, and takes some 100 bytes a word. A benchmark of several
automata builds them anew for each slice of texts, so that one is held at a time. Only named columns
are read, whatever else there is and however it is named.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept_where, map_texts, share, table

#: ASCII as words see it: capitals lower-cased, all that is neither digit nor letter a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A word in a text that keeps its capitals.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SHARD_CHARS = 4_000_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def windows(text: str | None, size: int) -> set[str]:
    w = words(text)
    return {b" ".join(w[i : i + size]).decode() for i in range(max(1, len(w) - size + 1))} if w else set()


def shards(items: list[tuple[str, str]], size: int, limit: int = SHARD_CHARS) -> list[dict[str, list[str]]]:
    """Windows to the ids of their items, in parts of at most limit characters."""
    out, held = [{}], 0
    for item, text in sorted(items):
        for window in sorted(windows(text, size)):
            if window not in out[-1]:
                if held + len(window) > limit:
                    out.append({})
                    held = 0
                held += len(window)
            ids = out[-1].setdefault(window, [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return out


class Scanner:
    def __init__(self, patterns: dict[str, list[str]]):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        for window, ids in patterns.items():
            self.find.add_word(f" {window} ", (window.count(" ") + 1, ids))
        self.find.make_automaton()
        self.any = bool(patterns)

    def scan(self, text: str | None) -> tuple[int, np.ndarray | None, dict[str, list[tuple[int, int]]]]:
        """The number of words, which are hit (None: none), and the word ranges by item."""
        w = words(text)
        if not w or not self.any:
            return len(w), None, {}
        flat = " " + b" ".join(w).decode() + " "
        hits = list(self.find.iter(flat))
        if not hits:
            return len(w), None, {}
        blanks = np.flatnonzero(np.frombuffer(flat.encode("utf-32-le"), np.uint32) == 32)
        edge, found = np.zeros(len(w) + 1, np.int64), {}
        for end, (n, ids) in hits:
            last = int(np.searchsorted(blanks, end))  # the blank after the window's last word
            edge[last - n] += 1
            edge[last] -= 1
            for item in ids:
                found.setdefault(item, []).append((last - n, last))
        return len(w), np.cumsum(edge[:-1]) > 0, found


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character offsets of the text as it is."""
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def load_items(benchmark: DataFrame, item_id: str, text: str) -> list[tuple[str, str]]:
    """The items, whose size the driver's result limit bounds; a benchmark is a list of test questions."""
    rows = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).cast("string"), text).distinct().collect()
    return [(r[0], r[1]) for r in rows]


def scan(df: DataFrame, benchmark: DataFrame, *, size: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """df's kept columns, n_words, and the hits: items (sorted ids), n_hit, and spans (first, behind last) of the hit runs in characters."""
    parts = shards(load_items(benchmark, item_id, item_text), size)
    shared = [share(df.sparkSession, p) for p in parts]

    def make():
        scanners = [Scanner(s()) for s in shared] if len(shared) == 1 else None

        def work(texts, _):
            n = np.zeros(len(texts), np.int64)
            hit: list = [None] * len(texts)
            found: list[set] = [set() for _ in texts]
            for s in range(len(shared)):  # one automaton at a time is held
                scanner = scanners[s] if scanners else Scanner(shared[s]())
                for i, t in enumerate(texts):
                    n[i], own, items = scanner.scan(t)
                    if own is not None:
                        hit[i] = own if hit[i] is None else hit[i] | own
                        found[i] |= items.keys()
            spans = [[] if h is None else [{"start": a, "end": b} for a, b in offsets(t, runs(h))] for h, t in zip(hit, texts, strict=True)]
            return [
                pa.array(n),
                pa.array([0 if h is None else int(h.sum()) for h in hit], pa.int64()),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ]

        return work

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span))]
    return map_texts(df, make, fields, text=text, keep=list(keep))


def clean(df: DataFrame, benchmark: DataFrame, *, size: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of df, all columns as they are, whose text holds no window of an item."""
    for part in shards(load_items(benchmark, item_id, item_text), size):
        shared = share(df.sparkSession, part)

        def make(shared=shared):
            scanner = Scanner(shared())
            return lambda texts: [scanner.scan(t)[1] is None for t in texts]

        df = kept_where(df, make, text=text)
    return df


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i:i+least(len(ws), 10)-1], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
dw AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT doc_id, i, dw.n, item FROM dw JOIN p USING (win) WHERE dw.n = p.n),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
