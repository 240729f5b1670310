"""The pipeline against a plain one, stage by stage, on a whole table."""

import numpy as np
import public_tokenizers
import tiktoken
from helpers import documents, written
from test_corpus_ops import plain_lines
from test_near_dedup import brute_force

import corpus_pipeline
from epiframe.llm import bpe, langid


def plain_language(rows, model):
    """Texts with a letter, most of whose letters are learned, of a score of 0.25 or more."""
    out = []
    for i, t in rows:
        letters = [c for c in t or "" if c.isalpha()]
        if letters and 2 * sum(c in set(model.alphabet) for c in letters) >= len(letters) and model.predict([t])[1][0] >= 0.25:
            out.append((i, t))
    return out


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def plain_clean(rows, items):
    """Texts without any ten words in a row of an item."""
    windows = set()
    for t in items:
        w = [x for x in words_of(t) if x]
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    out = []
    for i, t in rows:
        w = [x for x in words_of(t) if x]
        if not any(tuple(w[a : a + n]) in windows for n in {len(x) for x in windows} for a in range(len(w) - n + 1)):
            out.append((i, t))
    return out


def test_pipeline_equals_a_plain_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = plain_language(rows, langid.train(docs))
    rows = sorted(plain_lines(rows).items())
    kept = brute_force(dict(rows))
    rows = plain_clean([(i, t) for i, t in rows if i in kept], items)
    tokens = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = {i: encoding.encode_ordinary(t) for i, t in rows}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_pipeline_without_labels_keeps_the_corpus(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{rng.integers(0, 5000)}" for _ in range(40))) for i in range(50)]
    docs = documents(spark, rows).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    where = written(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, where).count() == 50


def test_pipeline_takes_long_texts(spark, tmp_path):
    rng = np.random.default_rng(5)
    long = " ".join(f"w{rng.integers(0, 50000)}" for _ in range(400_000)) + " " + "x" * 300_000
    docs = documents(spark, [(1, long), (2, long + " more"), (3, "a short text of some words")])
    where = written(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame([], "item_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, where).collect()}
    assert set(got) == {1, 3} and got[1] > 400_000
