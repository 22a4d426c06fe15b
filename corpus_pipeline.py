"""A training corpus from the documents table: five stages, each on all that its predecessor kept.

1. ``toxicity``: documents that the tagger finds toxic go.
2. ``near_duplicates``: of each group of near copies (five-word shingles, similarity 0.8 or more) the
   one with the smallest id stays. Rows without an id stay.
3. ``decontamination``: documents that hold a benchmark item, up to some edits, go.
4. ``mixing``: sources are mixed to their target weights; a document that the mix takes several times
   is there several times, one that it does not take is not. Texts without words are never taken.
5. ``sharding``: every row gets a shard and a slot in it.

Each stage keeps all columns of documents, further ones too; one that is named like a result of sharding
comes back as ``document_<name>``. Rows that share an id but not their text are documents of their own; of
equal rows one stays. Empty tables run through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tailtrim.llm.common import saved, table
from tailtrim.llm.decontamination import without_items
from tailtrim.llm.mixing import mixed_rows
from tailtrim.llm.neardup import one_of_each
from tailtrim.llm.sharding import shard
from tailtrim.llm.toxicity import not_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs, keep=[name for name in docs.columns if name != "doc_id"])


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Tagging, sketches and edit distances are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
