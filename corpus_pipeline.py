"""From raw documents to shards: each stage applies one operator to all rows its predecessor kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, histogram_sort, mixing, odd_sketch, quality_rules
from ledgerline.llm.common import finished, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked at 80 percent, the general threshold for near copies."""
    return odd_sketch.keep_first(docs, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each pass over it."""
    return mixing.Mix(docs).documents()


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return histogram_sort.histogram_sort(docs)


STAGES = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("mixed", mixed),
    ("sharded", sharded),
]

# the mix and the splitters depend on hashes and refined probes that SQL cannot restate
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = finished(partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
