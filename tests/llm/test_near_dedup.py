import random

import numpy as np
from helpers import documents

import corpus_pipeline
from epiframe.llm import shingles


def brute_force(texts, least=0.8):
    """The keys that stay if all pairs of 5-word shingle sets are compared."""
    sets, root = {}, {k: k for k in texts}
    for k, t in texts.items():
        w = t.lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in texts:
        for b in texts:
            if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                a_, b_ = sorted((top(a), top(b)))
                root[b_] = a_
    return {k for k in texts if top(k) == k}


def test_near_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [word() for _ in range(40)]
    texts = {}
    for group in range(12):
        base = [word() for _ in range(rng.randrange(30, 150))] + shared
        for _ in range(3 if group else 90):  # one large group
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = word()
            texts[len(texts) + 1] = " ".join(own)
    want = brute_force(texts)
    got = corpus_pipeline.near_dedup(spark, documents(spark, list(texts.items())), "")
    assert {r.doc_id for r in got.collect()} == want
    assert 12 < len(want) < len(texts) - 40


def test_near_dedup_rows_of_one_key_are_one_document(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abc"}
    rows = [(1, texts["a"]), (2, texts["a"]), (2, texts["b"]), (3, texts["b"]), (4, texts["c"]), (None, texts["c"])]
    got = corpus_pipeline.near_dedup(spark, documents(spark, rows), "")
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "4", "None"]


def test_common_shingles_are_counted_in_all_documents(spark):
    rng = random.Random(7)
    lines = [" ".join(f"l{i}w{j}" for j in range(8)) for i in range(40)]
    texts = [" ".join(rng.choices(lines, weights=range(1, 41), k=4)) for _ in range(60)] + [None, "", "one two"] * 2
    want = {}
    for t in texts:
        for h in shingles.shingle_set(t, 5).tolist():
            want[h >> 16] = want.get(h >> 16, 0) + 1
    s, c = shingles.common_shingles(documents(spark, list(enumerate(texts))), text="text", size=5)
    assert dict(zip(s.tolist(), c.tolist(), strict=True)) == {h: n for h, n in want.items() if n > 2}
    assert (np.diff(s.astype(np.int64)) > 0).all() and max(c) > 10
    own = shingles.shingle_set(texts[0], 5)
    first = sorted(own.tolist(), key=lambda h: (want[h >> 16] if want[h >> 16] > 2 else 0, h))
    assert shingles.prefix(own, 0.5, s, c).tolist() == first[: len(own) - int(np.ceil(len(own) / 2)) + 1]
