import random

from helpers import documents

from epiframe.llm import fingerprints


def test_near_connects_all_alike_pairs_of_a_shared_template(spark, monkeypatch):
    rng = random.Random(2)
    prints = []
    template = [rng.randrange(256) for _ in range(128)]
    for _ in range(150):
        base = [c if rng.random() < 0.7 else rng.randrange(256) for c in template]
        other = list(base)
        for k in rng.sample(range(128), 20):
            other[k] = rng.randrange(256)
        prints += [bytes(base), bytes(other)]
    order = list(range(len(prints)))
    rng.shuffle(order)
    prints = [prints[i] for i in order]
    given = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(prints)], "doc_id long, fingerprint binary")
    monkeypatch.setattr(fingerprints, "fingerprint", lambda *_, **__: given)
    embedding = fingerprints.Embedding()
    pairs = fingerprints.near(documents(spark, []), embedding, bands=1, sampled=0).collect()  # one bucket
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in pairs:
        assert r.likeness == fingerprints.likeness(prints[r.a], prints[r.b]) >= 0.8
        root[top(r.b)] = top(r.a)
    alike = [(i, j) for i in range(len(prints)) for j in range(i) if fingerprints.likeness(prints[i], prints[j]) >= 0.8]
    assert len(alike) >= 150 and all(top(i) == top(j) for i, j in alike)


def edited(rng, text, share):
    out = []
    for c in text:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(rng.choice("abcdefgh ") if x < 2 * share / 3 else c)
        if 2 * share / 3 <= x < share:
            out.append(rng.choice("abcdefgh "))
    return "".join(out)


def test_recall_of_near_documents(spark):
    """At least 0.9 of all pairs of likeness 0.8 or more are in one class; pairs are found by comparing all."""
    rng = random.Random(7)
    head = "".join(rng.choice("abcdefgh ") for _ in range(200))  # all share it
    texts = []
    for _ in range(60):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(200, 900)))
        texts += [head + base] + [head + edited(rng, base, s) for s in (0.01, 0.02, 0.04, 0.08)]
    texts += [None, "", "short", "short"]
    own = fingerprints.Embedding()
    prints = own.fingerprints([t or "" for t in texts])
    given = spark.createDataFrame([(bytearray(p), i) for i, p in enumerate(prints)], "fingerprint binary, key_ long").cache()
    found = {r.key_: r.class_ for r in fingerprints.classes(given, own.slots).collect()}
    alike = [(i, j) for i in range(len(prints)) for j in range(i) if fingerprints.likeness(prints[i], prints[j]) >= 0.8]
    held = sum(found.get(i, i) == found.get(j, j) for i, j in alike)
    assert len(alike) > 100 and held >= 0.9 * len(alike)
    assert found[301] == 300 and found[303] == 302  # equal texts


def test_near_takes_nulls_and_empty_tables(spark):
    own = fingerprints.Embedding()
    assert fingerprints.near(documents(spark, []), own).count() == 0
    rows = [(None, "abc " * 50), (None, None), (1, "abc " * 50), (2, "abc " * 50 + "d"), (3, None)]
    assert [(r.a, r.b) for r in fingerprints.near(documents(spark, rows), own).collect()] == [(1, 2)]
