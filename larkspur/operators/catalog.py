"""Search and ranking over the song catalogue.

All predicates are plain column comparisons, so Catalyst pushes them into the Parquet scan and
prunes the columns nobody reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.predicates import all_of, any_of, contains_in_any

# Fixed patterns: decimals in text of at least 400, and of at least 1.
AT_LEAST_400_PATTERN = r"(\d{2,9}|[4-9])\d{2}\.\d+"
AT_LEAST_1_PATTERN = r"(\d{2,9}|[1-9])(\.\d+)"


def family_scan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scan that reads the named columns only."""
    return df.select(*columns)


def prefix_match(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def prefix_match_count(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return row_count(prefix_match(df, column, prefix))


def prefix_suffix_match(df: DataFrame, column: str, prefix: str, suffix: str) -> DataFrame:
    """Starts with ``prefix`` and ends with ``suffix``, the two not overlapping."""
    return df.filter(
        F.col(column).startswith(prefix)
        & F.col(column).endswith(suffix)
        & (F.char_length(column) >= len(prefix) + len(suffix))
    )


def match_all(
    df: DataFrame, conditions: Sequence[Column], alternatives: Sequence[Column] = ()
) -> DataFrame:
    """Rows meeting every condition and, when given, at least one of the alternatives."""
    required = list(conditions)
    if alternatives:
        required.append(any_of(alternatives))
    return df.filter(all_of(required))


def contains_any_prefix(
    df: DataFrame, contains: tuple[str, str], column: str, prefixes: Sequence[str]
) -> DataFrame:
    name, term = contains
    return match_all(
        df, [F.col(name).contains(term)], [F.col(column).startswith(p) for p in prefixes]
    )


def prefix_range(
    df: DataFrame, prefix: tuple[str, str], at_least: Sequence[tuple[str, float]]
) -> DataFrame:
    name, start = prefix
    return match_all(
        df, [F.col(name).startswith(start), *(F.col(c) >= low for c, low in at_least)]
    )


def threshold_contains(
    df: DataFrame, at_least: tuple[str, float], contains: Sequence[tuple[str, str]]
) -> DataFrame:
    measure, low = at_least
    return match_all(
        df, [F.col(measure) >= low, *(F.col(c).contains(term) for c, term in contains)]
    )


def contains_not_contains(
    df: DataFrame,
    prefix: tuple[str, str],
    contains: tuple[str, str],
    without: Sequence[str],
    equals: tuple[str, int],
) -> DataFrame:
    """Prefix on one column; another holds a term but none of ``without``; a third equals."""
    column, term = contains
    return match_all(
        df,
        [
            F.col(prefix[0]).startswith(prefix[1]),
            F.col(column).contains(term),
            *(~F.col(column).contains(w) for w in without),
            F.col(equals[0]) == equals[1],
        ],
    )


def any_column_contains_count(
    df: DataFrame, columns: Sequence[str], term: str, key: str
) -> DataFrame:
    """Number of rows with a key where some column holds ``term``."""
    return df.filter(contains_in_any(columns, term)).agg(F.count(key).alias("matches"))


def regex_match(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose column, as text, holds a match of ``pattern`` anywhere."""
    return df.filter(F.col(column).cast("string").rlike(pattern))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def nth_most_frequent(df: DataFrame, key: str, label: str, n: int = 3) -> DataFrame:
    """Label of the group with the n-th most rows; ties go to the smaller key.

    Rows are pre-aggregated before the shuffle; the cut is a bounded top-n.
    """
    return (
        df.groupBy(key)
        .agg(F.count(label).alias("row_count"), F.min(label).alias(label))
        .orderBy(F.desc("row_count"), key)
        .offset(n - 1)
        .limit(1)
        .select(label, "row_count")
    )


def longest_track(df: DataFrame, id_column: str, measure: str) -> DataFrame:
    """Row id with the greatest measure; ties go to the smaller id."""
    return (
        df.select(id_column, measure)
        .filter(F.col(measure).isNotNull())
        .orderBy(F.desc(measure), id_column)
        .limit(1)
    )
