"""URL filters over a sorted digest array.

A rule is a host, a path prefix and a verdict. Its key is host + path; the keys' 64-bit xxhash
digests are sorted and memory-mapped once a task (from an anonymous memory file, filled from a
broadcast of bounded size). A url's candidates are its host's dot suffixes with as many labels as some rule's
host has, and with as many first characters of its path as some rule has; all candidates of a batch are probed by one
vectorised binary search, and a found digest counts only if the stored full string is equal. The
longest key wins; of equally long keys the one with the longer host.

Rule lists over ``limit`` rules are dealt into arrays of that size; a url's candidates are probed in each.

Defined cases: a url that is null or has no ``://`` has an empty host and path and fits no rule; a
url that fits no rule gets the method's verdict, ``allow``: its digest is in no array. Of rules with
equal host and path the last one holds, whatever ``limit`` is. Hosts of any length and number of labels
give no more candidates than the rules' hosts have different numbers of labels. Repeated rows each
keep their row. Only named columns are read; kept columns named host, path, rule or verdict give way.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import map_texts, share, table

# The rules of the query, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
CAPITALS = {c: c + 32 for c in range(65, 91)}


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a url."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:].partition("#")[0].partition("?")[0]
    return rest[:end].translate(CAPITALS), path


def suffixes(host: str, labels: list[int], longest: int) -> list[str]:
    """The host's dot suffixes with one of these numbers of labels (in ascending order), none longer than longest."""
    out, end, had = [], len(host), 0
    for n in labels:
        while had < n and end >= 0:
            end = host.rfind(".", max(0, len(host) - longest - 1), end)
            had += 1
        if had == n and len(host) - end - 1 <= longest:
            out.append(host[end + 1 :])
        if end < 0:
            break
    return out


class Digests:
    """Sorted digests of the rules' keys, with what confirms and judges them. rules: (host, path) to the verdict."""

    def __init__(self, rules: dict[tuple[str, str], str]):
        import xxhash

        rows = sorted((xxhash.xxh64_intdigest(f"{host}\0{path}".encode()), host, path, verdict) for (host, path), verdict in rules.items())
        self.data = np.array([r[0] for r in rows], np.uint64).tobytes()
        self.rows = [r[1:] for r in rows]
        self.lengths = sorted({len(path) for _, path in rules})
        self.labels = sorted({host.count(".") + 1 for host, _ in rules})
        self.longest = max((len(host) for host, _ in rules), default=0)

    def mapped(self) -> np.ndarray:
        if not self.data:
            return np.zeros(0, np.uint64)
        with os.fdopen(os.memfd_create("digests"), "w+b") as f:
            f.write(self.data)
            f.flush()
            return np.memmap(f, np.uint64, "r")

    def candidates(self, split: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[int]]:
        """(host, path) pairs to probe, and the number of the url that each is of."""
        at, of = [], []
        for i, (host, path) in enumerate(split):
            if host:
                ends = suffixes(host, self.labels, self.longest)
                for n in self.lengths:
                    if n <= len(path):
                        at += [(e, path[:n]) for e in ends]
                        of += [i] * len(ends)
        return at, of

    def probe(self, digests: np.ndarray, split: list[tuple[str, str]], best: list) -> None:
        """Improves best, a (key length, host length, rule, verdict) or None for each url, by the candidates' rules."""
        import xxhash

        at, of = self.candidates(split)
        keys = np.fromiter((xxhash.xxh64_intdigest(f"{h}\0{p}".encode()) for h, p in at), np.uint64, len(at))
        low = np.searchsorted(digests, keys, "left")
        high = np.searchsorted(digests, keys, "right")
        for c in np.flatnonzero(high > low).tolist():
            for k in range(low[c], high[c]):
                host, path, verdict = self.rows[k]
                if (host, path) == at[c]:
                    own = (len(host) + len(path), len(host), host + path, verdict)
                    if best[of[c]] is None or own[:2] > best[of[c]][:2]:
                        best[of[c]] = own


def judge(df: DataFrame, rules: list[tuple[str, str, str]], *, url: str = "url", keep: list[str] = ("page_id",), limit: int = 200_000) -> DataFrame:
    """df's kept columns, host, path, rule and verdict."""
    last = {(host, path): verdict for host, path, verdict in rules}
    keys = list(last)
    shared = [share(df.sparkSession, Digests({k: last[k] for k in keys[i : i + limit]})) for i in range(0, max(1, len(keys)), limit)]

    def make():
        arrays = [(d, d.mapped()) for d in (s() for s in shared)]

        def work(urls, _):
            split = [parts(u) for u in urls]
            best: list = [None] * len(urls)
            for d, digests in arrays:
                d.probe(digests, split, best)
            return [
                pa.array([h for h, _ in split], pa.string()),
                pa.array([p for _, p in split], pa.string()),
                pa.array([b and b[2] for b in best], pa.string()),
                pa.array([b[3] if b else "allow" for b in best], pa.string()),
            ]

        return work

    fields = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")]
    return map_texts(df, make, fields, text=url, keep=list(keep))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
s AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM s JOIN r ON (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN m USING (page_id)
"""
