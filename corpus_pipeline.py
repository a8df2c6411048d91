"""Corpus pipeline: quality, near-duplicates, contamination, secrets, and the mix of sources.

Every stage is a function of (spark, docs, sf_dir). ``docs`` is what the stage before kept, reread
from Parquet; models and benchmarks come from the tables in ``sf_dir``. All stages but the last
return the columns of ``docs``, whatever they are. Null texts count as empty; an empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import contamination, mixing, quality, secrets, simhash
from larkspur.llm.common import prepared, set_aside, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores 0.5 or more; the others go."""
    prepared(spark)
    docs, back = set_aside(docs)
    field = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return back(quality.score(docs, field).where("__score >= 0.5"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints, that with the smallest id.

    Shingles of four words and four bits of distance, as in the operator's own query.
    """
    prepared(spark)
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule clears, unchanged; the others go."""
    prepared(spark)
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced and n_chars set to the new length."""
    prepared(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, source_size, target, copies and taken (words that the mix takes).

    A column of ``docs`` with one of these names is replaced.
    """
    prepared(spark)
    names = docs.columns
    docs, _ = set_aside(docs)
    new = {
        "size": F.col("__size"),
        "source_size": F.col("__total"),
        "target": F.col("__target"),
        "copies": F.col("__copies"),
        "taken": F.col("__copies") * F.col("__size"),
    }
    old = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names) if n.lower() not in new]
    return mixing.mix(docs).select(*old, *(column.alias(name) for name, column in new.items()))


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
]

#: The classifier's model and the fingerprints' hash have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and reread."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
