"""Writers for the text and wide-row outputs of the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated text, one row per line, written by all tasks in parallel.

    Fields are written as they are, blanks and quotes included; NULL is empty. A tab, line end or
    backslash inside a field becomes ``\\t``, ``\\n``, ``\\r`` or ``\\\\``, so a row stays a line.
    """
    fields = [F.coalesce(_escaped(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode(mode).text(path)


def _escaped(text: Column) -> Column:
    for raw, mark in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of ``write_tsv``; an empty field is NULL."""
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    parts = F.split("value", "\t", -1)

    def plain(text: Column) -> Column:
        # a backslash pair first becomes a character that no field keeps, else \\\\t reads as a tab
        text = F.replace(text, F.lit("\\\\"), F.lit("\x00"))
        for mark, raw in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
            text = F.replace(text, F.lit(mark), F.lit(raw))
        return F.replace(text, F.lit("\x00"), F.lit("\\"))

    return spark.read.text(path).select(
        *(
            plain(F.nullif(F.get(parts, F.lit(i)), F.lit(""))).cast(f.dataType).alias(f.name)
            for i, f in enumerate(fields)
        )
    )


def to_wide_rows(suggestions: DataFrame, key: str, item: str = "word") -> DataFrame:
    """One row per key with a map item → share as text.

    Suggestions are already cut to a few per key, so a map stays small.
    """
    entry = F.struct(F.col(item), F.col("share").cast("string"))
    return suggestions.groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("columns")
    )


def to_long_rows(wide: DataFrame, key: str, item: str = "word") -> DataFrame:
    """Wide rows read back: (key, item, share)."""
    return wide.select(key, F.explode("columns").alias(item, "share")).withColumn(
        "share", F.col("share").cast("double")
    )
