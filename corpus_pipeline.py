"""The corpus pipeline: language ID, line dedup, near-dedup by shingle sets, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of docs, whatever they are beside doc_id, text and lang; n_chars, where there is
one, follows a changed text. The last returns doc_id, n_tokens and ids.

What goes: documents whose language is not identified (without a letter, null and empty ones too;
of letters that most learned texts lack; of a score that tells nothing); lines in repeated multi-line
chunks but for the first; documents linked to one of smaller doc_id by sets of
5-word shingles whose Jaccard index is 0.8 or more; documents that hold a benchmark window. All other
documents stay. Where lang is null it becomes the identified language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm import bpe, decontaminate, langid, lines, shingles
from epiframe.llm.common import checkpointed, table

#: What can't be in SQL: the trained language ID and BPE.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return langid.identified(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated chunks of lines."""
    out = lines.dedup_lines(docs)
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    return shingles.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of the documents."""
    return bpe.encode(docs, bpe.default_codec())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written out before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
