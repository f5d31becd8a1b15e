"""The corpus pipeline: documents -> quality -> near-dedup -> decontamination ->
mixture -> shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a driver writes it
as Parquet and rereads it as the next one's docs. ``run`` does the same through
tables in the shared folder. All stages but the last return the columns of
``documents``; the last adds ``shard`` and ``slot``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermart.llm import decontaminate, minhash_dedup, mixing, quality_classifier, sharding
from ordermart.llm.common import corpus_session, read_table
from ordermart.session import cut_lineage, discard_cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; documents scored under the threshold go."""
    corpus_session(spark)
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 similarity on five-word shingles, the smallest id stays."""
    corpus_session(spark)
    return minhash_dedup.keep_one_per_group(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    corpus_session(spark)
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in global order."""
    corpus_session(spark)
    return mixing.replicate(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every copy; copies of a text stay together."""
    corpus_session(spark)
    return sharding.place(docs)


STAGES = [("quality classifier", quality), ("near dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("source mixing", mixture), ("sharding", shards)]

#: Training, signatures and Hamming look-ups have no SQL form; tests/llm hold run() against its stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut_lineage(stage(spark, docs, sf_dir))
        discard_cut(before)
    return STAGES[-1][1](spark, docs, sf_dir)
