import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import TEXTS, documents, written

import corpus_pipeline
from epiframe.llm import components, lines, lm, simhash, substrings


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("c"), documents=documents(spark), benchmark=spark.createDataFrame([(2, "in the evening sun")], "item_id long, text string"))


def plain_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints, bits=2):
    root = {f: f for f in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= bits:
                root[top(a)] = top(b)
    return {f: min(i for g in prints if top(g) == top(f) for i in prints[g]) for f in prints}


def test_simhash_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {}
    for r in docs:
        prints.setdefault(plain_fingerprint(r.text), []).append(r.doc_id)
    group = plain_groups(prints)
    want = {i: (f"{f:016x}", group[f]) for f, ids in prints.items() for i in ids}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op7_simhash(spark, sf).collect()} == want


@pytest.mark.parametrize("bucket", [8, 512])
def test_simhash_groups_in_small_and_large_buckets(spark, bucket):
    rng = np.random.default_rng(bucket)
    prints = {}
    for i in range(40):
        f = int(rng.integers(0, 2**63))
        for _ in range(rng.integers(1, 12)):
            prints.setdefault(f, []).append(len(prints) * 7 + i)
            f ^= 1 << int(rng.integers(0, 64))
            if rng.random() < 0.4:
                f ^= 1 << int(rng.integers(0, 64))
            if rng.random() < 0.2:
                f ^= 1 << int(rng.integers(0, 64))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for f, ids in prints.items() for i in ids]
    ids = {}
    for f, own in prints.items():
        ids[f] = sorted(own)
    want = plain_groups(ids)
    got = simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long"), bucket=bucket).collect()
    assert {r.fp & (2**64 - 1): r.component for r in got} == want


def near_prints(rng, n, bits):
    fp = np.array([5 ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, bits), replace=False)) for _ in range(n)], np.uint64).view(np.int64)
    return np.unique(fp)


@pytest.mark.parametrize("bits", [1, 2, 3, 9])
def test_chain_pairs_are_all_pairs_of_the_bucket(bits):
    fp = near_prints(np.random.default_rng(0), 120, bits + 2)
    a, b = simhash.chain_pairs(fp, bits)
    found = {frozenset((int(fp[i]), int(fp[j]))) for i, j in zip(a, b, strict=True)}
    assert found == {frozenset((int(a), int(b))) for a in fp for b in fp if a < b and ((int(a) ^ int(b)) & (2**64 - 1)).bit_count() <= bits}


def test_chain_prunes():
    spread = np.array([0x1111_0000_0000_0000, 0x3, 0x1_0001_0001, 0x0001_0001_0001_0001], np.uint64)
    assert simhash.chain(spread, 2, 4).tolist() == [False, True, False, False]
    assert [m.bit_count() for m in simhash.cut(0, 4)] == [16] * 4 and sum(simhash.cut(0xFF, 3)) == 2**64 - 256


def test_simhash_with_one_large_bucket(spark):
    rng = np.random.default_rng(12)
    own = np.unique(rng.integers(0, 2**32, 100_000, np.uint64))
    own = np.unique(np.concatenate([own, own[:3000] ^ np.uint64(1 << 7), own[5000:6000] ^ np.uint64(1 << 9 | 1 << 30)]))
    edges = set()
    flips = [1 << i for i in range(32)] + [1 << i | 1 << j for i in range(32) for j in range(i)]
    for f in flips:
        other = own ^ np.uint64(f)
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        hit = np.flatnonzero((own[at] == other) & (own < other))
        edges |= set(zip(hit.tolist(), at[hit].tolist(), strict=True))
    root = list(range(len(own)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in edges:
        x, y = sorted((top(i), top(j)))
        root[y] = x
    want = {i: top(i) for i in range(len(own)) if top(i) != i}
    wide = (own | np.uint64(0xABCD_1234 << 32)).view(np.int64).tolist()
    prints = spark.createDataFrame(list(enumerate(wide)), "doc_id long, fp long").cache()
    fp_of = dict(enumerate(wide))
    got = {r.fp: r.component for r in simhash.groups(prints).collect()}
    assert len(edges) >= 4000 and {i: got[fp_of[i]] for i in fp_of if got[fp_of[i]] != i} == want


def test_simhash_of_long_texts_in_pieces(monkeypatch):
    from epiframe.llm import common

    text = " ".join(f"w{i % 37}\n" if i % 5 else f"W{i}\t" for i in range(3000)) + " x" * 50 + "y" * 500
    whole = simhash.fingerprint(simhash.hashes(text, 3))
    monkeypatch.setattr(simhash, "pieces", lambda data: common.pieces(data, 64))
    assert len(list(simhash.hashes(text, 3))) > 100 and simhash.fingerprint(simhash.hashes(text, 3)) == whole == simhash.signed(plain_fingerprint(text))
    assert b"".join(common.pieces(text.encode(), 10)) == text.encode()
    for t in ("", " ", "a", " a b ", "a " * 90, None):
        assert simhash.fingerprint(simhash.hashes(t, 3)) & (2**64 - 1) == plain_fingerprint(t)


def test_simhash_cases(spark, folder):
    got = {}
    for r in simhash.op7_simhash(spark, folder).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[2][0].fingerprint == "0" * 16 and got[2][0].component_id == got[3][0].component_id == 2
    assert got[4][0].component_id == 1 and len(got[7]) == 2 and got[None][0].component_id is None
    docs = documents(spark)
    left = simhash.first_of_groups(docs)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 5, 6, None, 7, 7, 8]))
    assert simhash.near_groups(documents(spark, [])).count() == 0


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (3000, 2000), (2000, 3000)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df, small=0).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1200)) and got[3000] == 2000
    assert {r.node: r.component for r in components.components(df).collect()} == got
    none = components.components(df.where("a < 0"))
    assert none.count() == 0 and components.components(df.where("a < 0"), small=-1).count() == 0


def plain_lines(rows):
    """Chunks by the same boundaries, repeated ones dropped by their text."""
    cut = {}
    for i, t in rows:
        if t is None:
            continue
        ls = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:12], 16) % 65521 for x in ls]
        r = [((h[k - 2] * 961 if k > 1 else 0) + (h[k - 1] * 31 if k else 0) + h[k]) % 65521 for k in range(len(h))]
        ends = [k for k in range(len(r)) if k == len(r) - 1 or (k and r[k] < r[k - 1] and r[k] <= r[k + 1])]
        cut[i] = [ls[a:b] for a, b in zip([0, *(e + 1 for e in ends)], [e + 1 for e in ends], strict=False)]
    seen, out = set(), {}
    for i in sorted(cut):
        kept = []
        for c in cut[i]:
            if len(c) < 2 or tuple(c) not in seen:
                kept.append("\n".join(c))
            seen.add(tuple(c))
        out[i] = "\n".join(kept)
    return out


def test_line_dedup(spark):
    rng = np.random.default_rng(4)
    shared = [f"shared line {i}" for i in range(12)]
    rows = []
    for i in range(30):
        own = [f"own {i} {k}" for k in range(rng.integers(0, 8))]
        rows.append((i, "\n".join(own + shared[rng.integers(0, 4) :] + [f"tail {i}"])))
    rows += [(100, None), (101, ""), (102, "\n"), (103, "\n\n\n\n"), (104, "\n\n\n\n"), (105, "one line")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(spark, rows)).collect()}
    assert got == plain_lines(rows) | {100: None}
    assert sum(len(t or "") for t in got.values()) < 0.7 * sum(len(t or "") for _, t in rows)


def test_line_dedup_cases(spark):
    docs = documents(spark)
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_removed"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[4][0].text) < len(got[1][0].text) and [r.text for r in got[7]] == [TEXTS[7][1]] * 2
    assert got[2][0].text is None and got[2][0]._n_lines == 0 and got[None][0].text == TEXTS[6][1]
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def plain_substrings(rows, size):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if seen.setdefault(tuple(w[s : s + size]), (i, s)) != (i, s):
                gone[s : s + size] = [True] * size
        out.append((str(i), len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark, tmp_path):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 90))
    rows = []
    for i in range(80):
        own = list(rng.choice(vocabulary, rng.integers(0, 120)))
        if i % 3 == 0:
            a = rng.integers(0, 60)
            p = list(passage[a : a + rng.integers(15, 60)])
            if i % 6 == 0 and len(p) > 20:
                p[len(p) // 2] = f"edit{i}"
            own[len(own) // 2 : len(own) // 2] = p
        rows.append((i, " ".join(own)))
    rows += [(200, "a " * 200), (201, "a b " * 60), (202, "a " * 19), (203, "a " * 20), *TEXTS[:7]]
    rows = [(i if i is None or i >= 100 or k < 80 else 300 + i, t) for k, (i, t) in enumerate(rows)]
    where = written(spark, tmp_path, documents=documents(spark, rows).repartition(5))
    assert sorted((str(r[0]), *r[1:]) for r in substrings.op10_substring_dedup(spark, where).collect()) == plain_substrings(rows, 20)


def phrase_rows(rng, n, vocabulary=3000):
    """Texts around one phrase: its anchor has a passage for each of them, some of whose windows repeat."""
    phrase = " ".join(f"p{i}" for i in range(7))
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for i in range(n):
        before, after = (" ".join(rng.choice(words, 16)) for _ in range(2))
        if i % 7 == 3:
            after = rows[int(rng.integers(0, i))][1].partition(phrase)[2].strip()
        rows.append((i, f"{before} {phrase} {after}"))
    return rows


@pytest.mark.parametrize("split", [3, 40])
def test_substring_dedup_splits_hot_anchors(spark, split):
    rows = phrase_rows(np.random.default_rng(5), 400) + [(1000 + i, " ".join(f"q{j}" for j in range(40)) + f" e{i}") for i in range(60)]
    got = substrings.removed(documents(spark, rows).repartition(3), split=split).collect()
    want = plain_substrings(rows, 20)
    assert sorted((str(r[0]), *r[1:]) for r in got) == want and sum(r[2] > 0 for r in want) > 100


def test_substring_dedup_of_different_texts_with_one_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(1, f"{a} x"), (1, f"y {a}"), (1, f"{a} x"), (2, f"{b} {a}")]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.removed(documents(spark, rows)).collect())
    # one of the two texts of 1 keeps the passage, with its equal row
    assert got in ([(1, 31, 0), (1, 31, 0), (1, 31, 30), (2, 60, 30)], [(1, 31, 0), (1, 31, 30), (1, 31, 30), (2, 60, 30)])


def test_automaton_matching_statistics():
    rng = np.random.default_rng(8)
    feed, before = substrings.Automaton(), []
    for _ in range(40):
        w = [bytes([c]) for c in rng.choice(list(b"ab"), rng.integers(1, 14))]
        want = []
        for e in range(1, len(w) + 1):
            places = [*before, w[: e - 1]]
            want.append(max([n for n in range(e + 1) if n == 0 or any(p[k : k + n] == w[e - n : e] for p in places for k in range(len(p) - n + 1))]))
        assert feed.feed(w) == want
        before.append(w)


def test_lm_scores(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i in docs}
    c = Counter(w for i, t in docs.items() if fold[i] for w in lm.words(t))
    n, v = sum(c.values()), len(c)
    got = lm.op5_lm_score(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        w = lm.words(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[r.doc_id] == 0, len(w), sum(x in c for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_small_head_gives_the_same(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").selectExpr("doc_id", "IF(doc_id % 7 = 0, NULL, text) AS text")
    counts = lm.token_counts(docs.where("doc_id % 3 <> 0")).cache()
    model = lm.train_model(docs.where("doc_id % 3 <> 0").selectExpr("text", "doc_id % 8 AS batch"), "batch", counts)
    a, b = (sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in lm.score(docs, model, counts, head=h).collect()) for h in (3, 100_000))
    assert a == b and len(a) == 60
    empty = lm.token_counts(documents(spark, [])).cache()
    nothing = lm.train_model(documents(spark, []).selectExpr("text", "0 AS batch"), "batch", empty)
    assert {(round(r.base_score, 9), r.n_known) for r in lm.score(docs, nothing, empty).collect()} == {(0.0, 0)}


TINY = lm.Shape(2, (6, 7, 6, 6), (7, 7, 7))


def plain_rows(shape, words, word, context):
    """The class and word rows of a token, by hand."""
    spelled = {w: i for i, w in enumerate(words)}

    def code(w):
        return zlib.crc32(w) if spelled.get(w, 10**9) < shape.contexts else lm.rare_class(w)

    def row(key, bits, salt):
        h = ((key + salt) * 2654435761) & 0xFFFFFFFF
        h ^= h >> 15
        h = (h * 2246822519) & 0xFFFFFFFF
        return h >> (32 - bits)

    one, two, three = (code(w) if w != lm.END else zlib.crc32(lm.END) for w in (context[-1], context[-2], context[-3]))
    kinds = [one, (two * 2246822519 + one) & 0xFFFFFFFF, two, three]
    place = spelled.get(word, 10**9)
    y = place // lm.MEMBERS if place < shape.frequent else shape.classes + lm.rare_class(word)
    of = (y * 0x9E3779B9) & 0xFFFFFFFF
    return y, place % lm.MEMBERS if place < shape.frequent else None, [row(k, b, j) for j, (k, b) in enumerate(zip(kinds, shape.class_bits, strict=True))], [row(k ^ of, b, j + 9) for j, (k, b) in enumerate(zip(kinds, shape.word_bits, strict=False))]


def plain_score(m, counts, text):
    """The log10 probability of a text, token by token."""
    total, context, tables = 0.0, [lm.END] * 3, m.tables()
    for w in lm.words(text):
        y, member, rows, word_rows = plain_rows(m.shape, m.words, w, context)
        logit = m.class_p.astype(float) + sum(t[r].astype(float) for t, r in zip(tables["class"], rows, strict=True))
        total += (logit[y] - np.log(np.exp(logit).sum())) / np.log(10)
        if member is None:
            total += math.log10(counts.get(w, 0) + 0.1) - m.rare_z[y - m.shape.classes]
        else:
            logit = m.word_p[y].astype(float) + sum(t[r].astype(float) for t, r in zip(tables["word"], word_rows, strict=True))
            total += (logit[member] - np.log(np.exp(logit).sum())) / np.log(10)
        context.append(w)
    return total


def test_lm_score_equals_a_plain_walk(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"v{i}é" if i % 9 == 0 else f"v{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60), p=np.arange(300, 0, -1) / 45150))) for i in range(80)] + [(90, None), (91, "V1 v2 unseen other\tv3"), (92, "")]
    docs = documents(spark, rows)
    train = docs.where("doc_id % 4 <> 0").selectExpr("text", "doc_id % 8 AS batch")
    counts = lm.token_counts(train).cache()
    model = lm.train_model(train, "batch", counts, shape=TINY)
    known = {bytes(r.token): r.c for r in counts.collect()}
    got = {r.doc_id: r.score for r in lm.score(docs, model, counts, head=5).collect()}
    assert all(math.isclose(got[i], plain_score(model, known, t), rel_tol=1e-4, abs_tol=1e-4) for i, t in rows)


def test_lm_gradient_is_observed_less_expected(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"v{i}" for i in range(200)], 30))) for i in range(40)]
    train = documents(spark, rows).selectExpr("text", "doc_id % 8 AS batch")
    counts = lm.token_counts(train).cache()
    model = lm.train_model(train, "batch", counts, shape=TINY, rounds=1)
    want = np.zeros(len(model.weights))
    tables, off = model.tables(), model.tables(want)
    for _, t in rows:
        context = [lm.END] * 3
        for w in lm.words(t):
            y, member, class_rows, word_rows = plain_rows(TINY, model.words, w, context)
            for layer, found, own, base in (("class", class_rows, y, model.class_p), ("word", word_rows, member, None if member is None else model.word_p[y])):
                if own is None:
                    continue
                logit = base.astype(float) + sum(x[r] for x, r in zip(tables[layer], found, strict=True))
                p = np.exp(logit) / np.exp(logit).sum()
                for x, r in zip(off[layer], found, strict=True):
                    x[r] -= p
                    x[r, own] += 1
            context.append(w)
    got = lm.gradient(train, model)
    assert np.allclose(got, want, rtol=2e-2, atol=2e-3 * np.abs(want).max()) and np.abs(want).max() > 1


def test_lm_learns_by_rounds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    train, held = docs.where("doc_id % 5 <> 0").selectExpr("text", "doc_id % 8 AS batch"), docs.where("doc_id % 5 = 0")
    counts = lm.token_counts(train).cache()
    scores = []
    for rounds in (0, 3):
        model = lm.train_model(train, "batch", counts, rounds=rounds, classes=16)
        r = lm.score(held, model, counts).selectExpr("sum(score) / sum(n_tokens) AS s", "sum(base_score) / sum(n_tokens) AS b").first()
        scores.append(r.s)
    assert r.b < scores[0] < scores[1]


def test_lm_rounds_take_all_training_texts(spark, monkeypatch):
    train = documents(spark, [(i, f"t{i} and more") for i in range(41)]).selectExpr("text", "doc_id % 8 AS batch")
    counts = lm.token_counts(train).cache()
    seen, shares = [], []
    gradient, update = lm.gradient, lm.Model.update
    monkeypatch.setattr(lm, "gradient", lambda batch, model: seen.append([r.text for r in batch.collect()]) or gradient(batch, model))
    monkeypatch.setattr(lm.Model, "update", lambda self, g, cells, share: shares.append(share) or update(self, g, cells, share))
    for rounds in (lm.ROUNDS, 1, 3, 9):
        seen.clear(), shares.clear()
        lm.train_model(train, "batch", counts, shape=TINY, rounds=rounds)
        assert len(seen) == rounds and {t for part in seen for t in part} == {r.text for r in train.collect()}
        assert math.isclose(sum(shares[:8]), 1) and sum(map(len, seen[:8])) == 41


def test_lm_equal_contexts_are_one():
    """The expected counts of tokens whose rows repeat, of one row and of many, are those of the tokens one by one."""
    rng = np.random.default_rng(8)
    words = [lm.END, *(f"w{i}".encode() for i in range(200))]
    for n, most in ((1, 3), (5000, 3), (9000, 160)):
        model = lm.Model(TINY, words, rng.integers(1, 90, 201), np.ones((2, lm.RARE)), rng.poisson(0.5, TINY.size).astype(np.int32))
        out = rng.integers(0, most, n)
        c = lm.Contexts(TINY, out, out.astype(np.uint32) + np.uint32(5), np.arange(0, n, 9))
        got, want = np.zeros(len(model.weights), np.float32), np.zeros(len(model.weights))
        model.expected(c, got)
        for layer, rows, base, y in (("class", c.rows, model.class_p[None, :].repeat(n, 0), c.y), ("word", c.word_rows, model.word_p[c.y[c.at]], c.member)):
            p = np.exp(base + sum(t[r].astype(float) for t, r in zip(model.tables()[layer], rows, strict=True)))
            p /= p.sum(axis=1, keepdims=True)
            for t, r in zip(model.tables(want)[layer], rows, strict=True):
                np.subtract.at(t, r, p)
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3)
        assert len(c.distinct("class")[1]) < max(2, n) and len(np.unique(c.distinct("class")[0])) == n


def test_lm_tokens_as_numbers():
    texts = ["a bc é éa aé xéé Ab \u65e5\u672c x\u65e5 the", None, "", " the\tend of ab \U0001f600 q\u00df"]
    tokens = lm.Tokens(pa.array(texts, pa.string()))
    plain = [w for t in texts for w in lm.words(t)]
    assert [tokens.unique[i].as_py() for i in tokens.index] == plain
    shape = lm.Shape(1)
    known = [lm.END, b"the", *(f"k{i}".encode() for i in range(5000)), b"ab", b"of"]
    for part in (known, known[:2]):
        number, out, code = lm.Ids(shape, part).numbers(tokens)
        place = {w: i for i, w in enumerate(part)}
        assert number.tolist() == [place.get(w, lm.Ids.FAR) for w in plain]
        assert out.tolist() == [place[w] if place.get(w, 10**9) < 64 else 64 + lm.rare_class(w) for w in plain]
        assert code.tolist() == [zlib.crc32(w) if place.get(w, 10**9) < shape.contexts else lm.rare_class(w) for w in plain]


def test_lm_rows_grow_with_the_tokens():
    assert lm.shape_for(0).word_bits == (15,) * 3 and lm.shape_for(500_000_000).word_bits == (16,) * 3 == lm.shape_for(10**12).word_bits
    assert lm.shape_for(500_000_000).contexts == 4096 > lm.shape_for(0).contexts == 2048
    shape = lm.Shape(4)
    assert (shape.frequent, shape.out) == (256, 36) and shape.size > shape.cells("word").stop


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(9)
    words = [lm.END, *(f"w{i}".encode() for i in range(500))]
    shape = lm.Shape()
    cells = rng.poisson(0.3, shape.size).astype(np.int32)
    model = lm.Model(shape, words, rng.integers(1, 90, 501), np.array([[30.0] * lm.RARE, [10.0] * lm.RARE]), cells)
    total = 0.0
    for first in range(0, shape.frequent + lm.RARE, 640):
        out = np.array([x for y in range(first, min(first + 640, shape.frequent + lm.RARE)) for x in (3, 9, y)])
        c = lm.Contexts(shape, out, out.astype(np.uint32) + np.uint32(77), np.arange(0, len(out), 3))
        total += np.exp(model.log_p(c)[2::3]).sum()
    assert math.isclose(total, 1.0, rel_tol=1e-3)


def test_lm_blocks_are_packed():
    rng = np.random.default_rng(3)
    for kind, close in ((np.int32, 0), (np.float32, 1 / 250)):
        x = (rng.normal(0, 1000, 5000) * (rng.random(5000) < 0.3)).astype(kind)
        to = np.zeros(5000, np.int64 if kind is np.int32 else np.float64)
        lm.unpack(lm.packed(x), to)
        lm.unpack(lm.packed(np.zeros(5000, kind)), to)
        assert np.allclose(to, x, rtol=close, atol=0)


def test_pipeline(spark, sf, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    # 2, 3 and 5 have no letter, 1 holds the item; 4 has lost its repeated chunks, the rest is clean
    assert {6, None, 7, 8} <= set(out) and not {1, 2, 3, 5} & set(out)
    assert all(r.n_tokens == len(r.ids) for r in out.values())
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.7 * n < corpus_pipeline.run(spark, sf).count() < n


def test_stages_take_empty_tables_and_clashing_columns(spark, folder):
    for rows in ([], TEXTS[:1]):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "score", "_gone"]
        docs.count()


def test_line_dedup_of_texts_with_many_chunks(spark):
    """Time that grows with a text's length: 60,000 lines, all of them twice."""
    half = "\n".join(f"line {i}" for i in range(30_000))
    rows = [(1, half), (2, half + "\n" + half), (3, "line 5\nother")]
    got = {r.doc_id: r for r in lines.dedup_lines(documents(spark, rows)).collect()}
    want = plain_lines(rows)
    assert {i: r.text for i, r in got.items()} == want and got[2]._n_removed > 50_000
