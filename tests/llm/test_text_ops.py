import hashlib
import random

import numpy as np
import pytest
from helpers import TEXTS, documents, written
from pyspark.sql import functions as F

from epiframe.llm import bpe, chat, decontaminate, fingerprints, langid, urls


def sha(x):
    return hashlib.sha256(x).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("t"), documents=documents(spark), benchmark=spark.createDataFrame([(1, "quick BROWN fox jumps over the lazy dog again and again"), (2, "evening sun"), (3, None), (None, "a row"), (4, "!!")], "item_id long, text string"))


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    tokens = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def test_bpe_equals_the_library(spark, folder, tiktoken_encoding):
    want = sorted((str(i), len(e := tiktoken_encoding.encode_ordinary(t or "")), sha(",".join(map(str, e)).encode()), sha((t or "").encode())) for i, t in TEXTS)
    assert sorted((str(r[0]), *r[1:4]) for r in bpe.op1_byte_bpe(spark, folder).collect()) == want


def test_bpe_random_texts(tiktoken_encoding):
    rng = np.random.default_rng(3)
    letters = list("abcdeéñüß日 \n\t19!?'sS🙂\x00")
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 400, 200)] + ["ab" * 4000, "'" * 3000] + ["".join(rng.choice(list(x), n)) for x in ("ab", "aaab", "éaß日", "abcdefghijklmnopqrstuvwxyz") for n in (1025, 6000)]
    coder = bpe.default_codec()
    ids, at = coder.encode(texts)
    for i, t in enumerate(texts):
        own = ids[at[i] : at[i + 1]]
        assert own.tolist() == tiktoken_encoding.encode_ordinary(t)
        assert coder.decode(own) == t.encode()


def test_bpe_ids_round_trip(spark):
    coder = bpe.default_codec()
    back = bpe.decode(bpe.encode(documents(spark), coder), coder).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in TEXTS)
    assert bpe.encode(documents(spark, []), coder).count() == 0


def test_fingerprints(spark, folder):
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    own = fingerprints.Embedding()
    want = []
    for n, (i, t) in enumerate(rows):
        t, after = t or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        a, b, c = own.fingerprints([t, new, after])
        want.append((str(i), len(t), sha(new.encode()), a.hex(), b.hex(), fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    got = fingerprints.op2_fingerprints(spark, folder).collect()
    assert sorted((str(r[0]), *r[1:7]) for r in got) == sorted(want)
    prints = fingerprints.fingerprint(documents(spark), own).withColumnRenamed("doc_id", "key_").cache()
    assert {r.key_: r.class_ for r in fingerprints.classes(prints, own.slots).collect()} == {4: 1, 3: 2}


def plain_walk(text, slots=128, seed=11):
    """The fingerprint by a walk step by step."""
    rng = np.random.default_rng(seed)
    move = rng.random((256, 4096)) < 0.5
    move[:, -1] |= ~move.any(axis=1)
    noted = []
    for c in text:
        kind = (ord(c) * 2654435761 & 0xFFFFFFFF) >> 24
        while True:
            noted.append(c)
            if move[kind, (len(noted) - 1) % 4096]:
                break
    out, steps = [], [[0] for _ in range(slots)]
    draws = [np.maximum(rng.random(slots), 1e-9) for _ in range(95)]
    for k in range(slots):
        for d in draws:
            far = (steps[k][-1] + 1.0) / d[k]
            steps[k].append(int(far) if far < 2.0**50 else 2**60)
        if noted:
            step = max(s for s in steps[k] if s < len(noted))
            out.append((ord(noted[step]) * 2246822519 + 374761393 & 0xFFFFFFFF) >> 24)
    return bytes(out) or bytes(slots)


def test_fingerprints_equal_a_plain_walk():
    rng = np.random.default_rng(2)
    texts = ["", "a", "aaaa", "日本🙂 é", *("".join(rng.choice(list("abc dé\n"), n)) for n in (3, 40, 900, 6000))]
    assert fingerprints.Embedding().fingerprints(texts) == [plain_walk(t) for t in texts]


def test_fingerprint_likeness_follows_edits():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh "), 5000))
    other = "".join(rng.choice(list("abcdefgh "), 5000))
    own = fingerprints.Embedding()
    a, one, many, b = own.fingerprints([text, text[:2500] + "x" + text[2500:], "".join(c if rng.random() > 0.2 else "z" for c in text), other])
    assert fingerprints.likeness(a, one) > 0.8 > fingerprints.likeness(a, many) > fingerprints.likeness(a, b)


def test_near_fingerprints_link_copies_with_edits(spark):
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("abcdefgh "), 3000))
    rows = [(1, base), (2, base[:2000] + " and " + base[2000:]), (3, "".join(rng.choice(list("abcdefgh "), 3000))), (4, base)]
    assert [(r.a, r.b) for r in fingerprints.near(documents(spark, rows), fingerprints.Embedding()).collect()] == [(1, 2)]


def test_decontamination(spark, folder):
    got = {}
    for r in decontaminate.op3_decontamination(spark, folder).collect():
        got.setdefault(r.doc_id, r)
    assert (got[1].n_hit, got[1].n_items, got[1].items_sha256) == (13, 2, sha(b"1,2"))
    assert (got[2].n_words, got[2].contaminated, got[2].items_sha256) == (0, False, sha(b""))
    assert not any(got[i].contaminated for i in (2, 3, 5, 6, 7, 8, None))


def test_decontamination_shards_and_spans(spark):
    items = [(str(i), f"alpha{i} beta gamma") for i in range(30)]
    parts = decontaminate.shards(items, 10, limit=60)
    assert len(parts) > 5 and sum(map(len, parts)) == 30
    docs = documents(spark, [(1, "So, Alpha3  BETA\tgamma! Alpha9 beta"), (2, "alpha beta gamma")])
    found = {r.doc_id: r for r in decontaminate.scan(docs, spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert found[1]["items"] == ["3"] and [(s.start, s.end) for s in found[1].spans] == [(4, 22)] and found[2].n_hit == 0
    clean = decontaminate.clean(docs, spark.createDataFrame(items, "item_id string, text string"))
    assert [r.doc_id for r in clean.collect()] == [2] and clean.columns == docs.columns
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.clean(docs, none).count() == 2 and decontaminate.scan(docs, none).agg({"n_hit": "sum"}).first()[0] == 0


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|>", "<|im_start|>assistant\nx<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "a<|b", "<|im_end|", "|im_end|>", "\n<|", "\\"])
def test_chat_round_trip(text):
    for role in ("user", "assistant", "", "a\nb", "<|im_end|>", "x\\n", "<|im_start|>", "<\\l"):
        out = chat.render([(role, text), ("assistant", text), (role, "")])
        assert [r[:2] for r in chat.parse(out)] == [(role, text), ("assistant", text), (role, "")]


def test_chat_rejects_what_is_no_chat():
    for bad in ("x", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>user\n<|im_start|>a\nb<|im_end|>\n"):
        with pytest.raises(chat.BadChat):
            chat.parse(bad)


def test_chat_query(spark, tmp_path):
    rows = [(1, 1, "assistant", "yes <|im_end|>"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "y"), (1, 2, "assistant", "no"), (2, 0, None, "x")]
    where = written(spark, tmp_path, conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.op4_chat_format(spark, where).collect()}
    assert set(got) == {1, 2, None, -1}
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 16, sha(b"yes <|im_end|>no"))
    assert got[1].turns_sha256 == sha(b"user\n\nassistant\nyes <|im_end|>\nassistant\nno\n") and got[2].n_turns == 2
    assert got[-1].loss_sha256 == sha(b"<|im_end|><|im_start|>assistant ok")


def test_language_id_held_out(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in langid.op6_language_id(spark, sf).collect() if r.held_out]
    assert got and all(0 <= r.score <= 1 for r in got) and all(langid.fold_of(r.doc_id) == 2 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.93 * len(got)


def test_language_id_cases(spark, folder):
    got = {r.doc_id: r for r in langid.op6_language_id(spark, folder).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (2, 3, 5)) and got[1].lang_pred == "en"
    docs = documents(spark)
    kept = langid.identified(docs, langid.train(docs))
    assert kept.columns == docs.columns and kept.count() == 7
    nobody = langid.Model([])
    # with nothing learned only texts without a letter go
    assert langid.identified(docs, nobody).count() == 7 and langid.identified(docs.withColumn("lang", F.lit(None).cast("string")), nobody).count() == 7
    assert {r.lang_pred for r in langid.identify(docs, nobody).collect()} == {"und"}


def learned(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").orderBy("doc_id").collect()
    return rows, langid.Model([(r.text, r.lang) for r in rows if r.doc_id % 4])


def plain_prediction(m, text):
    """Language and score by a walk over the n-grams and a count of votes."""
    d = langid.folded(text)
    margin = [0.0] * len(m.columns)
    for n in range(1, 5):
        for i in range(len(d) - n + 1):
            g = d[i : i + n]
            code = 0
            for c in g[:3]:
                code = (code << 8) ^ c
            if n == 4:
                code = code * 257 ^ (g[3] << 24)
            at = code if n == 1 else ((code * 2654435761 + n) & (2**32 - 1)) >> 16
            for k in range(len(margin)):
                margin[k] += float(m.weights[at, k]) / len(d)

    def vote(kind, names):
        best = None
        for x in names:
            own = [v if a == x else -v for (of, a, b), v in zip(m.columns, margin, strict=True) if of == kind and x in (a, b)]
            wins = sum(v > 0 for v in own)
            if best is None or (wins, sum(own)) > best[0]:
                best = (wins, sum(own)), x, min(own, default=np.inf)
        return best[1], 1 / (1 + np.exp(-min(30, best[2])))

    f, p = vote("family", m.families)
    lang, q = vote(f, [x for x in m.langs if langid.family(x) == f])
    return lang, p * q


def test_language_id_equals_a_plain_vote(spark, sf):
    rows, m = learned(spark, sf)
    texts = sorted((r.text for r in rows if r.text), key=len)[:40]
    lang, score = m.predict(texts)
    for t, a, b in zip(texts, lang, score, strict=True):
        want = plain_prediction(m, t)
        assert a == want[0] and abs(b - want[1]) < 1e-6


def test_language_id_works_in_blocks(spark, sf):
    rows, m = learned(spark, sf)
    texts = [langid.folded(t) for t in ["", "a", *(r.text for r in rows[:60])]]
    whole = langid.means(texts, m.weights)
    for block in (1, 7, 1000):
        some = texts[:12] if block == 1 else texts
        assert np.allclose(langid.means(some, m.weights, block), whole[: len(some)], rtol=1e-9, atol=1e-9)
    assert langid.shares("aé日1 ", [np.array([chr(i).isalpha() for i in range(0x110000)])], 2) == [3]
    assert langid.folded("a  1 " * 3_000_000) == b" " + b"a " * 3_000_000


def test_language_stage_decides(spark, sf):
    rows, m = learned(spark, sf)
    other = [(1, "Это русский текст о погоде и о людях, которые живут в городе.", None), (2, "日本語のテキストです。今日は天気がいいですね。", "en"), (3, "123 !", "en"), (4, None, "en")]
    clean = [(10 + i, r.text, None if i % 2 else "xx") for i, r in enumerate(rows[:40])]
    docs = spark.createDataFrame(other + clean, "doc_id long, text string, lang string")
    kept = {r.doc_id: r for r in langid.identified(docs, m).collect()}
    assert set(kept) == {i for i, _, _ in clean}
    assert all(kept[i].lang == (said or m.predict([t])[0][0]) for i, t, said in clean)
    assert {r.doc_id for r in langid.identified(docs, m, languages=["de"]).collect()} == {i for i, t, _ in clean if m.predict([t])[0] == ["de"]}
    assert langid.identified(docs, m, min_score=1.0).count() == 0


def brute_judge(url):
    host, path = urls.parts(url)
    fit = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit)[1:]) if fit else (host, path, None, "allow")


def test_urls(spark, tmp_path):
    given = ["http://WWW.Example.COM/en/x?y#z", "https://a.example.com/en/", "https://example.com/EN/", "http://com/", "http://xcom/", "http://a.net/es/1", "http://net/fr/", "http://a.net/frx", "no host", None, "", "ftp://", "http://a.com", "http://a.com?x://b/", "x://h#/p"]
    assert urls.parts("http://A.b/C?d#e") == ("a.b", "/C") and urls.parts("http://a.com?x://b/") == ("a.com", "")
    where = written(spark, tmp_path, pages=spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string"))
    got = {r.page_id: tuple(r)[1:] for r in urls.op8_url_filter(spark, where).collect()}
    assert got == {i: brute_judge(u) for i, u in enumerate(given)}
    # several digest arrays find the same
    split = urls.judge(spark.read.parquet(f"{where}/pages.parquet"), urls.RULES, limit=2)
    assert {r.page_id: tuple(r)[1:] for r in split.collect()} == got
    assert urls.judge(spark.read.parquet(f"{where}/pages.parquet"), []).where("verdict <> 'allow'").count() == 0


def test_digest_collisions_are_told_apart():
    d = urls.Digests({("a.com", "/"): "block"})
    best = [None]
    d.rows = [("other.com", "/", "block")]  # as if another string had this digest
    d.probe(d.mapped(), [("a.com", "/")], best)
    assert best == [None]


def test_url_rules_hold_whatever_the_limit(spark):
    rules = [("com", "/", "block"), ("a.com", "/", "allow"), ("b.com", "/x", "block"), ("com", "/", "allow"), ("a.com", "/", "block")]
    given = ["http://q.com/", "http://a.com/y", "http://z.b.com/xy", None]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    for limit in (1, 2, 100):
        got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, rules, limit=limit).collect()}
        assert got == {0: ("com/", "allow"), 1: ("a.com/", "block"), 2: ("b.com/x", "block"), 3: (None, "allow")}


def test_urls_with_long_hosts_and_clashing_columns(spark):
    hosts = ["a." * 500_000 + "net", "a" * 1_000_000 + ".net", "." * 300_000, "x" * 100]
    pages = spark.createDataFrame([(i, f"http://{h}/es/1", "own", "own") for i, h in enumerate(hosts)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in urls.judge(pages, urls.RULES, keep=["page_id", "host"]).collect()}
    assert [got[i].verdict for i in range(4)] == ["block", "block", "allow", "allow"] and all(got[i].host == h for i, h in enumerate(hosts))
    assert urls.suffixes("d.c.b.a", [1, 2, 4], 3) == ["a", "b.a"] and urls.suffixes("a", [2], 9) == []
    rng = random.Random(3)
    for _ in range(500):
        host = "".join(rng.choice("ab..") for _ in range(rng.randrange(9)))
        every = [host] + [host[i + 1 :] for i, c in enumerate(host) if c == "."]
        assert urls.suffixes(host, [1, 3], 4) == sorted((e for e in every if e.count(".") in (0, 2) and len(e) <= 4), key=len)
