"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix.

Each stage reads all that the one before kept, as a table in the shared folder.  All but
the last return the columns of ``documents``; the mix adds ``shard``, ``copy`` and
``mix_block``.  Empty tables, nulls, repeated rows and further columns are handled as the
operators say; a document that line dedup leaves without a word goes.  Given columns that have the
name of one that a stage needs for itself come through; ``shard``, ``copy`` and ``mix_block`` are the mix's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.llm import decontaminate, jaccard, lines, mixing, quality
from tapeflow.llm.columns import beside
from tapeflow.scratch import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and reach the threshold of the likelihood ratio."""
    ratio, threshold = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, ratio, threshold)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; those left without a word go."""
    def run(rows: DataFrame) -> DataFrame:
        done = lines.dedup_lines(rows, share=lines.SHARE)
        lost = F.size("removed_lines") > 0
        left = done.filter(~lost | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        if "n_chars" in rows.columns:
            left = left.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        return left.select(*rows.columns)

    return beside(docs, run, ["line_count", "removed_lines"])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 80 % of five-word shingles in common."""
    return jaccard.keep_one(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their weights, in shuffled shards."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

#: The likelihood ratio's hashes, the edit join and the mix's draws are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
