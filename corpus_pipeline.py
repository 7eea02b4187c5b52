"""The corpus pipeline: documents in, packed batches out.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``. Its result is
written as Parquet in the shared checkpoint folder and read again as the next
stage's ``docs``, so a lost executor repeats tasks of one stage at most.

Stages write tables of their own, some as large as the documents. They are needed
until the stage's result is written, so a stage that is given written documents
first deletes what the stage before it left. The disk holds the tables of one
stage and its input at a time.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rankshelf.llm import exact_dedup, mixing, packing, quality, simhash
from rankshelf.session import collected_stages, stage, unstage

_LEFT: dict[str, tuple[DataFrame, list]] = {}  # by application: the result of the last stage and the tables it reads


def _tidy(function):
    """``function``, deleting the tables of the stage before unless ``docs`` is that stage's unwritten result."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId
        result, tables = _LEFT.pop(key, (None, []))
        with collected_stages() as made:
            if docs is result:
                made += tables
            else:
                unstage(*tables)
            out = function(spark, docs, sf_dir)
        _LEFT[key] = out, made
        return out

    return run_stage


@_tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


@_tidy
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


@_tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


@_tidy
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with probabilities that meet the source, language and topic targets."""
    return mixing.sample_mix(docs)


@_tidy
def packed_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document that is left."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed_batches),
]

# SQL has no XXH64 for the SimHash stage; the rows are tested against a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the last stage's rows."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
        unstage(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
