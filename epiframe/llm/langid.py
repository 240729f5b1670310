"""Language identification by hierarchical discrimination.

A text's features are the relative frequencies of its hashed byte n-grams, n from 1 to 4, over the
whole text with ASCII letters lower-cased, digits and ASCII punctuation as blanks. One linear
classifier picks the language family; within the family, linear support vector machines, one for
each pair of languages, vote. All are trained here by averaged stochastic subgradients of the
hinge loss, on at most ``max_train`` labelled rows, those of the least crc32 of their id's text
first, which hold at most ``max_chars`` characters together (the documented bound: the model is a
classifier of fixed size); a single text of over a twentieth of ``max_chars`` is no training row.

``identified`` rejects documents: those without a letter, those most of whose letters are not of the
learned alphabet (letters of one in a thousand training rows at least), and those whose score is under
``min_score``; 0.25 is what two decisions between equals give. With nothing learned there is no
language to tell, and only documents without a letter go.

Defined cases: null text, or text without a letter, is ``und`` with score 0. Without labelled rows
every text is ``und``. One learned language is predicted for all, with score 1. Equal votes go to
the larger summed margin, then to the language first in the alphabet. Texts of any length are judged
whole, in blocks of bounded size. Repeated rows each keep their row; only named columns are read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, pieces, rewritten, share, table

# Language families by ISO 639-1 code. A code that is not here is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}
BITS = 16
#: Texts are predicted in slices of so many bytes: each byte takes some fifty bytes of arrays.
SLICE = 1 << 20
#: Bytes that stand for themselves; others of ASCII count as a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 or b == 39 else 32 for b in range(256))


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def folded(text: str) -> bytes:
    parts = (b" ".join(p.split()) for p in pieces(text.encode().translate(FOLD)))
    return b" " + b" ".join(p for p in parts if p) + b" "


def grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of the 1- to 4-grams that start at each byte (shorter ones at the end are left out), one array for each n."""
    x = data.astype(np.uint32)
    code = x
    yield x
    for n in range(2, 5):
        code = (code[:-1] << np.uint32(8)) ^ x[n - 1 :] if n < 4 else code[:-1] * np.uint32(257) ^ (x[n - 1 :] << np.uint32(24))
        yield (code * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(32 - BITS)


def means(texts: list[bytes], weights: np.ndarray, block: int = SLICE) -> np.ndarray:
    """For each text the mean weight vector of its features; weights: features by outputs. A block of bytes at a time."""
    if not texts:
        return np.zeros((0, weights.shape[1]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    total = np.zeros((len(texts), weights.shape[1]))
    for at in range(0, len(data), block):
        first, last = np.searchsorted(starts, [at, at + block], "left")
        some = slice(max(0, first - 1), last)
        for n, code in enumerate(grams(data[at : at + block + 3]), 1):
            code = code[:block]
            a = np.clip(starts[some] - at, 0, len(code))
            b = np.maximum(a, np.clip(starts[some] + sizes[some] - (n - 1) - at, 0, len(code)))
            for k in range(weights.shape[1] if len(code) else 0):
                sums = np.concatenate([[0.0], np.cumsum(weights[:, k][code], dtype=np.float64)])
                total[some, k] += sums[b] - sums[a]
    return total / np.maximum(1, sizes)[:, None]


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for t in texts:
        codes = np.concatenate(list(grams(np.frombuffer(t, np.uint8))))
        at, n = np.unique(codes, return_counts=True)
        out.append((at, n / max(1, len(t))))
    return out


def separate(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, rounds: int = 6, strength: float = 1e-4) -> np.ndarray:
    """Weights of a linear support vector machine; positive margins mean sign 1. Averaged over the steps."""
    rng = np.random.default_rng(7)
    w, mean, scale, at = np.zeros(1 << BITS), np.zeros(1 << BITS), 1.0, 0
    balance = {s: len(sign) / (2 * max(1, (sign == s).sum())) for s in (-1, 1)}
    mean_scale = 0.0  # mean = sum of scale * w over steps, kept as sums of the parts
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at += 1
            rate = 1.0 / (strength * (at + 1 / strength))
            idx, x = rows[i]
            scale *= 1 - rate * strength
            if sign[i] * scale * (w[idx] @ x) < 0.1:
                step = rate * balance[int(sign[i])] * sign[i] * x / scale
                w[idx] += step
                mean[idx] -= mean_scale * step
            mean_scale += scale
    return (mean + mean_scale * w) / max(1, at)


class Model:
    def __init__(self, labelled: list[tuple[str, str]]):
        langs = sorted({lang for _, lang in labelled})
        self.langs, self.families = langs, sorted({family(x) for x in langs})
        texts = [folded(t) for t, _ in labelled]
        rows, lang = features(texts), np.array([x for _, x in labelled], object)
        fam = np.array([family(x) for x in lang], object)
        self.columns, weights = [], []
        self.alphabet = "".join(sorted(c for c, n in Counter(c for t, _ in labelled for c in set(t)).items() if 1000 * n >= len(labelled) and c.isalpha()))

        def learn(kind, a, b, sign):
            at = np.flatnonzero(sign)
            w = separate([rows[i] for i in at], sign[at])
            margin = np.array([x @ w[i] for i, x in (rows[j] for j in at)])
            size = np.median(np.abs(margin)) or 1.0
            self.columns.append((kind, a, b))
            weights.append(w * (2.0 / size))

        pairs = itertools.combinations(self.families, 2)
        for a, b in pairs:
            learn("family", a, b, np.where(fam == a, 1, np.where(fam == b, -1, 0)))
        for f in self.families:
            for a, b in itertools.combinations([x for x in langs if family(x) == f], 2):
                learn(f, a, b, np.where(lang == a, 1, np.where(lang == b, -1, 0)))
        self.weights = np.array(weights, np.float32).T.copy() if weights else np.zeros((1 << BITS, 0), np.float32)

    def _vote(self, margins: np.ndarray, kind: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The winners among names, and a certainty in 0 to 1: the logistic of the winner's least margin."""
        votes = np.zeros((len(margins), len(names), 2))
        least = np.full((len(margins), len(names)), np.inf)
        for k, (of, a, b) in enumerate(self.columns):
            if of == kind and a in names and b in names:
                i, j, m = names.index(a), names.index(b), margins[:, k]
                votes[:, i, 0] += m >= 0
                votes[:, j, 0] += m < 0
                votes[:, i, 1] += m
                votes[:, j, 1] -= m
                least[:, i] = np.minimum(least[:, i], m)
                least[:, j] = np.minimum(least[:, j], -m)
        best = (votes[:, :, 0] + 1e-3 * np.tanh(votes[:, :, 1])).argmax(axis=1) if len(names) > 1 else np.zeros(len(margins), int)
        return best, 1 / (1 + np.exp(-np.clip(least[np.arange(len(best)), best], -30, 30)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        import regex

        letter = regex.compile(r"\p{L}").search
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if t and letter(t)] if self.langs else []
        margins = means([folded(texts[i]) for i in at], self.weights)
        fam, sure = self._vote(margins, "family", self.families)
        for f, name in enumerate(self.families):
            own = np.flatnonzero(fam == f)
            names = [x for x in self.langs if family(x) == name]
            best, certain = self._vote(margins[own], name, names)
            for i, b, p in zip(own, best, sure[own] * certain, strict=True):
                lang[at[i]], score[at[i]] = names[b], float(p)
        return lang, score


def train(df: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", max_train: int = 4000, max_chars: int = 4_000_000) -> Model:
    """A model of at most max_train rows, and of as many in their order as hold max_chars together."""
    order = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))
    known = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"), order.alias("o"), F.length(text).alias("n"))
    known = known.where(F.col("n") <= max_chars // 20).select("*", F.xxhash64("t", "l").alias("h"))
    sizes = known.select("o", "n", "h").orderBy("o", "n", "h").limit(max_train).collect()
    take = int(np.searchsorted(np.cumsum([r.n for r in sizes]), max_chars, "right")) if sizes else 0
    rows = known.where(F.col("o") <= sizes[take - 1].o).orderBy("o", "n", "h").limit(take).select("t", "l").collect() if take else []
    return Model([(r.t, r.l) for r in rows])


def identify(df: DataFrame, model: Model, *, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """df's kept columns, lang_pred and score."""
    shared = share(df.sparkSession, model)  # 2^16 features by pairs of related languages

    def make():
        own = shared()

        def work(texts, _):
            lang, score = own.predict(texts)
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

        return work

    return map_texts(df, make, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], text=text, keep=list(keep), limit=SLICE)


def shares(text: str, tables: list[np.ndarray], block: int = SLICE) -> list[int]:
    """How many of a text's characters each table of code points has as true."""
    out = [0] * len(tables)
    for i in range(0, len(text), block):
        codes = np.frombuffer(text[i : i + block].encode("utf-32-le"), np.uint32)
        for k, t in enumerate(tables):
            out[k] += int(np.count_nonzero(t[codes]))
    return out


def identified(df: DataFrame, model: Model, *, text: str = "text", lang: str = "lang", min_score: float = 0.25, languages: list[str] | None = None) -> DataFrame:
    """The rows of df whose language is identified (as one of languages, if given), all columns as they are, but for a null lang, which is filled in."""
    shared = share(df.sparkSession, model)
    at, to = df.columns.index(text), df.columns.index(lang)

    def make():
        own = shared()
        any_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        known = np.zeros(0x110000, bool)
        known[[ord(c) for c in own.alphabet]] = True

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            n, seen = np.array([shares(t, [any_letter, known]) for t in texts]).T
            keep = n > 0
            said = batch.column(to).to_pylist()
            if own.langs:
                found, score = own.predict(texts)
                keep &= (2 * seen >= n) & (np.array(score) >= min_score)
                if languages is not None:
                    keep &= np.isin(found, languages)
                said = [x if x is not None else y for x, y in zip(said, found, strict=True)]
            columns = [pa.array(said, c.type) if i == to else c for i, c in enumerate(batch.columns)]
            return pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep))

        return work

    return rewritten(df, make, text=text, limit=SLICE)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def fold_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4
