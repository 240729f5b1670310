"""Digests, redaction, slugs, regular forms, and rules for paraphrases, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .boundaries import _col

# Names that published files must not hold.
FORBIDDEN_KEYS = ["api_key", "apikey", "authorization", "password", "secret", "token", "access_token", "endpoint", "base_url", "prompt", "raw_response", "model_path", "work_dir", "source_root"]
# Marks of a server that is out of memory.
OOM_MARKS = ["out of memory", "outofmemory", "cuda error: out of memory", "cublas_status_alloc_failed", "oom"]
#: Kana, CJK ideographs and Hangul, as ranges of a character class.
EAST_ASIAN = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}"
SHA256 = "^[0-9a-f]{64}$"
SHA40 = "^[0-9a-f]{40}$"
UNICODE_SPACE = r"\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def digest(x) -> Column:
    return F.sha2(_col(x), 256)


def valid_paraphrase(text, source, language: str = "English") -> Column:
    """Not empty, without space at its ends, other than its source; English also has a Latin letter and no East Asian one."""
    t = _col(text)
    edges = t.rlike(f"^[{UNICODE_SPACE}]|[{UNICODE_SPACE}]$")
    ok = (F.length(t) > 0) & ~edges & (t != _col(source))
    if language == "English":
        ok = ok & t.rlike("[A-Za-z]") & ~t.rlike(f"[{EAST_ASIAN}]")
    return F.coalesce(ok, F.lit(False))


def camera_slug(camera) -> Column:
    """A file name for a camera: its first 40 plain characters and 8 digits of its digest."""
    c = _col(camera)
    plain = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_-]+", "-"), "^-+|-+$", "")
    return F.concat(F.substring(plain, 1, 40), F.lit("-"), F.substring(F.sha2(c, 256), 1, 8))


def redacted(text) -> Column:
    """Only the length and 16 digits of the digest of a text that is not to be kept."""
    t = _col(text)
    return F.concat(F.lit("<redacted chars="), F.length(t).cast("string"), F.lit("; sha256="), F.substring(F.sha2(t, 256), 1, 16), F.lit(">"))


def redacted_endpoint(url) -> Column:
    """Scheme, host, port and path of a url."""
    return F.regexp_replace(F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*)", 1), "://[^/@]*@", "://")


def out_of_memory(text) -> Column:
    return F.lower(_col(text)).rlike("|".join(m.replace(" ", r"\s") for m in OOM_MARKS[:-1]) + r"|\boom\b")


def utc_timestamp(text) -> Column:
    """An ISO 8601 time with the offset Z or +00:00; others are null."""
    t = _col(text)
    return F.when(t.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|\+00:00)$"), F.try_to_timestamp(t))


def split_range(text) -> Column:
    """struct<first, last> of "a:b", null if it is no such thing."""
    t = _col(text)
    part = F.split(t, ":")
    return F.when(t.rlike(r"^\d+:\d+$"), F.struct(F.get(part, 0).cast("long").alias("first"), F.get(part, 1).cast("long").alias("last")))


def byte_range(header, size) -> Column:
    """struct<first, last> of an HTTP range header within a file of size bytes, null if it can't be met."""
    h, n = _col(header), _col(size)
    a, b = F.regexp_extract(h, r"^bytes=(\d*)-(\d*)$", 1), F.regexp_extract(h, r"^bytes=(\d*)-(\d*)$", 2)
    tail = (a == "") & (b != "")
    first = F.when(tail, F.greatest(n - b.try_cast("long"), F.lit(0))).otherwise(a.try_cast("long"))
    last = F.when(tail | (b == ""), n - 1).otherwise(F.least(b.try_cast("long"), n - 1))
    return F.when(h.rlike(r"^bytes=(\d+-\d*|-\d+)$") & (first <= last) & (first < n) & ~(tail & (b.try_cast("long") == 0)), F.struct(first.alias("first"), last.alias("last")))


def episode_list(text) -> Column:
    """Sorted distinct ids of a list like 3,1,2; null for any other form."""
    t = _col(text)
    return F.when(t.rlike("^[0-9]+(,[0-9]+)*$"), F.array_sort(F.array_distinct(F.split(t, ",").cast("array<bigint>"))))


def data_url(jpeg) -> Column:
    return F.concat(F.lit("data:image/jpeg;base64,"), F.regexp_replace(F.base64(_col(jpeg)), r"\s", ""))


def payload_megabytes(length: str) -> Column:
    return F.sum(length) / 1048576.0
