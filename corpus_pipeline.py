"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm import decontaminate, line_dedup, minhash_near, packing, quality_rules
from spanfan.llm.common import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v2 of the quality rules keeps."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines, short ones too, go (the first of each component stays), and with them
    documents that have no other line; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_near.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left, as pieces with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("decontamination", benchmark),
    ("packing", pack),
]

# line dedup, near-dedup and packing have no SQL form: tests/llm holds the brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
