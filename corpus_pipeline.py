"""Corpus cleaning pipeline over the documents table, counted as part of the
``llm`` subpackage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run``
writes every stage's result as Parquet beside the checkpoints and hands the
table read back to the next stage, so a lost executor repeats tasks of one
stage only.  All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantwise.llm import host_rules, packing, simhash, suffix_dedup, winnowing
from plantwise.llm.common import Stages, read_table

#: Words of a repeated passage, as in operator 1.
PASSAGE_WORDS = 35


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes (operator 7).
    Null and empty texts go; null hosts are one host; repeated rows are judged
    alike; an empty table stays empty."""
    return host_rules.keep_by_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 4-word shingles, 4 bits (operator 3).
    Texts without words are one group; of repeated rows one stays, null ids
    last; an empty table stays empty."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of ``PASSAGE_WORDS`` words or more that stand
    twice in the corpus (operator 2, on words: a passage of short words may have
    few bytes, and its copies may be spaced otherwise).  Null texts stay null,
    wholly repeated ones become empty; an empty table stays empty."""
    return suffix_dedup.without_repeats(docs, threshold=PASSAGE_WORDS, words=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark (operator 8).  Null
    and empty texts stay; empty tables change nothing."""
    return winnowing.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences
    (operator 10).  Null and empty texts are their end token; repeated rows are
    packed each; an empty table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: SQL has no tokenizer and no SimHash, so no text stands for the whole run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stages.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            stages.drop(f"stage-{k - 1}")
    return docs
