"""Strict and canonical JSON. Python semantics (duplicate keys, float forms, escapes), so Arrow-batched UDFs on executors."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


class StrictJSONError(ValueError):
    """Text that is no strict JSON."""


def _pairs(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise StrictJSONError("repeated key")
    return out


def _constant(name: str):
    raise StrictJSONError(f"{name} is no number")


def strict_loads(text: str, limit: int | None = None, root: type | None = dict):
    """The value of a JSON text with distinct keys, without NaN and infinities, of at most limit bytes, root of the type."""
    if limit is not None and len(text.encode()) > limit:
        raise StrictJSONError("too large")
    try:
        value = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant)
    except RecursionError as e:
        raise StrictJSONError("too deep") from e
    except json.JSONDecodeError as e:
        raise StrictJSONError(str(e)) from e
    if root is not None and type(value) is not root:
        raise StrictJSONError("the root has another type")
    return value


def strict_jsonl(text: str, limit: int | None = None) -> list[dict]:
    """The objects of JSON lines; blank lines are errors, but for the end of the last line."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    out = []
    for i, line in enumerate(lines, 1):
        if not line.strip():
            raise StrictJSONError(f"line {i} is blank")
        out.append(strict_loads(line, limit))
    return out


def canonical(value, ascii_only: bool = True) -> str:
    """Sorted keys, no spaces, no NaN."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only, allow_nan=False)


def stable_hash(value, ascii_only: bool = True) -> str:
    return hashlib.sha256(canonical(value, ascii_only).encode()).hexdigest()


def equal(a, b) -> bool:
    """Deep equality that tells 1, 1.0 and True apart."""
    if type(a) is not type(b):
        return False
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(equal(a[k], b[k]) for k in a)
    if isinstance(a, list):
        return len(a) == len(b) and all(map(equal, a, b))
    return a == b


def only_object(text: str) -> dict | None:
    """The one balanced {...} of a text around it, parsed strictly; None if there is none or more than one."""
    found, depth, start, quoted, skip = [], 0, 0, False, False
    for i, c in enumerate(text):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"' and depth:
            quoted = True
        elif c == "{":
            start = i if depth == 0 else start
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                found.append(text[start : i + 1])
    if len(found) != 1 or depth:
        return None
    try:
        return strict_loads(found[0])
    except StrictJSONError:
        return None


def has_forbidden(value, names: frozenset) -> bool:
    if isinstance(value, dict):
        return any(str(k).lower() in names or has_forbidden(v, names) for k, v in value.items())
    return isinstance(value, list) and any(has_forbidden(v, names) for v in value)


def strict_json_ok(text: Column, keys: list[str] | None = None) -> Column:
    """Whether each text is a strict JSON object, with no keys but those."""
    allowed = None if keys is None else frozenset(keys)
    loads, error = strict_loads, StrictJSONError

    @pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return False
            try:
                value = loads(t)
            except error:
                return False
            return allowed is None or value.keys() <= allowed

        return texts.map(one).astype(bool)

    return check(text)


def canonical_json(text: Column, ascii_only: bool = True) -> Column:
    """Each JSON text in canonical form; null where it isn't strict JSON."""
    loads, error, form = strict_loads, StrictJSONError, canonical

    @pandas_udf("string")
    def rewrite(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else form(loads(t, root=None), ascii_only)
            except error:
                return None

        return pd.Series([one(t) for t in texts], dtype=object)

    return rewrite(text)


def forbidden_keys(text: Column, names: list[str]) -> Column:
    """Whether a JSON text has one of the names as a key at any depth, in any case."""
    loads, error, has, wanted = strict_loads, StrictJSONError, has_forbidden, frozenset(n.lower() for n in names)

    @pandas_udf("boolean")
    def look(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return t is not None and has(loads(t, root=None), wanted)
            except error:
                return True

        return texts.map(one).astype(bool)

    return look(text)
