"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Each line has a hash; a rolling hash over the last three line hashes chooses the boundaries: a chunk
ends behind a line whose rolling hash is less than the one before it and not more than the one
behind it. So boundaries follow content, not position, and a chunk has two lines at least, but for
what is left at the end of a text. Chunks of two lines or more that occur again anywhere are removed but
for the first, by doc_id, then position. Chunks are found to be repeated by their digests, then
compared by their bytes.

The texts are cut twice: once for the chunks' digests, which are written out and used from there on,
and once, only those with a repeated digest, for the bytes of these chunks. Of the latter equal
ones meet in their tasks first. The digests, first places and removed chunks go back to chunks and
documents by broadcast if they are shown to be small, else by a shuffle join, whose large partitions
adaptive execution may split.

Defined cases: null text stays null and has no lines; a text may become empty; a text of any length is
cut whole, in time that grows with its length; rows with the same doc_id are the same document, so a
repeated row does not make its chunks repeated; a null doc_id sorts first and is a document as any
other. Other columns of the input stay as they are, whatever their names; _n_lines and _n_removed are
added behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, small_enough, table

#: The rolling hash is taken modulo this prime.
PRIME = 65521


def _let(value: str, name: str, body: str) -> str:
    """SQL for body with name bound to value, which is computed once for a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chunks(text: str, body: str) -> str:
    """SQL for body, in which _ls is the text's lines and _cs its chunks, an array of struct<n, body>."""
    line = "CAST(conv(substring(md5(CAST(x AS BINARY)), 1, 12), 16, 10) AS BIGINT) % 65521"
    roll = f"transform(_h, (x, i) -> (if(i > 1, get(_h, i - 2) * 961, 0L) + if(i > 0, get(_h, i - 1) * 31, 0L) + x) % {PRIME})"
    ends = "filter(sequence(0, size(_r) - 1), i -> i = size(_r) - 1 OR (i > 0 AND get(_r, i) < get(_r, i - 1) AND get(_r, i) <= get(_r, i + 1)))"
    first = "if(k = 0, 0, get(_e, k - 1) + 1)"
    cut = f"transform(_e, (e, k) -> named_struct('n', e + 1 - {first}, 'body', array_join(slice(_ls, {first} + 1, e + 1 - {first}), '\n')))"
    inner = _let(f"transform(_ls, x -> {line})", "_h", _let(roll, "_r", _let(ends, "_e", _let(cut, "_cs", body))))
    return _let(f"split(`{text}`, '\n', -1)", "_ls", inner)


def _removed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _gone: for each chunk up to the last that is removed, whether it is) for documents that have such chunks."""
    own = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chunk = F.posexplode(F.expr(_chunks("_text", "_cs"))).alias("_no", "_chunk")
    md5, more = F.unhex(F.md5(F.col("_chunk.body").cast("binary"))).alias("_md5"), F.xxhash64("_chunk.body").alias("_more")
    digests = checkpointed(own.select("_key", chunk).where("_chunk.n > 1").select("_key", "_no", md5, more))
    again = checkpointed(digests.groupBy("_md5").agg(F.count("*").alias("n")).where("n > 1").select("_md5"))
    marked = checkpointed(digests.join(small_enough(again), "_md5", "left_semi"))
    # only documents with such chunks are read again; a null key is a key here
    some = own.join(small_enough(checkpointed(marked.select(F.col("_key").alias("_k")).distinct())), F.col("_key").eqNullSafe(F.col("_k")), "left_semi")
    bodies = some.select("_key", chunk).where("_chunk.n > 1").select(F.struct("_key", "_no").alias("_at"), md5, F.col("_chunk.body").alias("_body")).join(small_enough(again), "_md5", "left_semi")
    # chunks with equal bytes make a group, map-side first; what goes on is a digest and the first place
    same = bodies.groupBy("_md5", "_body").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    groups = checkpointed(same.select("_md5", F.xxhash64("_body").alias("_more"), "_first", "n"))
    # chunks whose digests other bytes have too are left alone
    alike = groups.groupBy("_md5", "_more").agg(F.count("*").alias("m"), F.min("_first").alias("_first"), F.max("n").alias("n"))
    first = checkpointed(alike.where("m = 1 AND n > 1").select("_md5", "_more", "_first"))
    gone = marked.join(small_enough(first), ["_md5", "_more"]).where("NOT (struct(_key, _no) <=> _first)")
    listed = gone.groupBy("_key").agg(F.sort_array(F.collect_set("_no")).alias("_nos"))
    flags = "flatten(transform(_nos, (x, i) -> concat(array_repeat(false, x - if(i = 0, -1, get(_nos, i - 1)) - 1), array(true))))"
    return listed.select("_key", F.expr(flags).alias("_gone"))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with repeated chunks taken out of the text, and _n_lines and _n_removed, lines before and removed."""
    gone = checkpointed(_removed(docs, key, text))
    names = [f"c{i}" for i in range(len(docs.columns))]
    at, of = names[docs.columns.index(key)], names[docs.columns.index(text)]
    found = docs.toDF(*names).join(small_enough(gone, cells=F.size("_gone")), F.col(at).eqNullSafe(F.col("_key")), "left")
    kept = "array_join(transform(filter(_cs, (c, k) -> NOT coalesce(get(_gone, k), false)), c -> c.body), '\n')"
    lines = "aggregate(transform(_gone, (g, k) -> if(g, get(_cs, k).n, 0)), 0L, (s, n) -> s + n)"
    done = f"named_struct('n', CAST(size(_ls) AS BIGINT), 'gone', {lines}, 'text', {kept})"
    plain = f"named_struct('n', CAST(size(split({of}, '\n', -1)) AS BIGINT), 'gone', 0L, 'text', {of})"
    out = found.withColumn("_out", F.expr(f"CASE WHEN _gone IS NULL THEN {plain} ELSE {_chunks(of, done)} END"))
    columns = [F.col("_out.text" if n == of else n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    return out.select(*columns, F.when(F.col(of).isNull(), 0).otherwise(F.col("_out.n")).alias("_n_lines"), F.coalesce("_out.gone", F.lit(0)).alias("_n_removed"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, ls, list_transform(ls, lambda x: CAST('0x' || substr(md5(x), 1, 12) AS BIGINT) % 65521) AS hs FROM l),
r AS (SELECT doc_id, ls, list_transform(range(1, len(ls) + 1), lambda i:
  ((CASE WHEN i > 2 THEN hs[i - 2] * 961 ELSE 0 END) + (CASE WHEN i > 1 THEN hs[i - 1] * 31 ELSE 0 END) + hs[i]) % 65521) AS rs FROM h),
e AS (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: i = len(ls) OR (i > 1 AND rs[i] < rs[i - 1] AND rs[i] <= rs[i + 1])) AS es FROM r),
x AS (SELECT doc_id, ls, es, unnest(range(1, len(es) + 1)) AS k FROM e),
c AS (SELECT doc_id, k, es[k] - (CASE WHEN k = 1 THEN 0 ELSE es[k - 1] END) AS n,
  array_to_string(ls[(CASE WHEN k = 1 THEN 0 ELSE es[k - 1] END) + 1 : es[k]], chr(10)) AS body FROM x),
d AS (SELECT *, n > 1 AND row_number() OVER (PARTITION BY body, n > 1 ORDER BY doc_id, k) > 1 AS gone FROM c),
t AS (SELECT doc_id, CAST(sum(CASE WHEN gone THEN n ELSE 0 END) AS BIGINT) AS n_removed, CAST(sum(n) AS BIGINT) AS n_lines,
  coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept FROM d GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, length(coalesce(kept, '')) AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN t USING (doc_id)
"""
