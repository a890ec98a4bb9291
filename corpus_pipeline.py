"""A corpus pipeline of five stages; each stage's rows are written as Parquet and reread as the next one's ``docs``.

1. ``quality``: the classifier rejects poor and toxic documents.
2. ``near_duplicates``: one document of each group of near duplicates stays.
3. ``repeated_passages``: passages that an earlier document holds are cut out.
4. ``mixture``: sources are repeated or sampled to their target weights, whole documents only.
5. ``packing``: the remaining documents are packed into training sequences.

All but the last return the columns of ``documents``; where a text changes, ``n_chars`` follows it.

Defined results, stage by stage; none fails on them, and columns whose names a stage uses itself are carried as they are:

* null and empty texts: rejected or kept by their source's and path's posterior; never near duplicates;
  unchanged by the passage stage; without words they take part in no mixture.
* a null id: kept and cut like others (it counts as the largest); repeated rows: one of them stays.
* ties: the smallest id stays of near duplicates; the later document loses a shared passage; documents tied
  at the end of a source's budget are taken or left together.
* very long texts: scored, compared and cut whole; only the last stage splits them, into pieces that fit a sequence.
* an empty table: every stage returns no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm import classifier, jaccard, mixing, packing, repeats
from tickerlake.llm.common import stored, table

SEQUENCE_TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_component(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(repeats.without_repeats(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, cut_last=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixture", mixture), ("packing", pack)]

#: The classifier is trained and the duplicate stages are iterative: SQL cannot express the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
