"""All queries and the pipeline on empty tables, on rows of nulls, and on copies of one text."""

import pytest
from helpers import documents, written

import corpus_pipeline
from epiframe.llm.registry import queries

PAGES, CHAT, ITEMS = "page_id long, url string", "conv_id long, turn long, role string, text string", "item_id long, text string"


def folder(spark, path, docs, pages, chat, items):
    return written(spark, path, documents=docs, pages=spark.createDataFrame(pages, PAGES), conversations=spark.createDataFrame(chat, CHAT), benchmark=spark.createDataFrame(items, ITEMS))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), documents(spark, []), [], [], [])


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    docs = spark.createDataFrame([(None,) * 5] * 2, "doc_id long, text string, lang string, source string, n_chars long")
    return folder(spark, tmp_path_factory.mktemp("nulls"), docs, [(None, None)], [(None,) * 4] * 2, [(None, None)])


@pytest.mark.parametrize("name", sorted(queries()))
def test_empty_and_null_tables(spark, empty, nulls, name):
    more = int(name.startswith("op4_"))  # the conversation that the query adds
    assert queries()[name](spark, empty).count() == more
    got = queries()[name](spark, nulls).collect()
    assert len(got) == (1 if name.startswith(("op4_", "op8_")) else 2) + more
    assert sum(r[0] is None for r in got) == len(got) - more


def test_pipeline_on_empty_and_null_tables(spark, empty, nulls):
    assert corpus_pipeline.run(spark, empty).count() == 0 and corpus_pipeline.run(spark, nulls).count() == 0


def test_copies_of_one_text(spark, tmp_path):
    text = "\n".join(f"line {i} of a text that many documents share, with some words in it" for i in range(6))
    docs = documents(spark, [(i, text) for i in range(300)]).repartition(7)
    where = folder(spark, tmp_path, docs, [], [], [])
    q = queries()
    assert {r.component_id for r in q["op7_simhash"](spark, where).collect()} == {0}
    assert [r.doc_id for r in q["op10_substring_dedup"](spark, where).where("n_removed = 0").collect()] == [0]
    assert q["op9_line_dedup"](spark, where).where("n_removed > 0").count() == 299
    assert q["op2_fingerprints"](spark, where).where("near_next < 1").count() == 0
    assert corpus_pipeline.run(spark, where).count() <= 2
