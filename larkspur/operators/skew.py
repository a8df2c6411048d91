"""Splitting hot groups so that no single task has to hold one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_piece"
SPLIT = "_split"


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of ``left`` stay."""
    theirs = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*(F.col(c).alias(theirs.get(c, c)) for c in right.columns))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(r)) for k, r in theirs.items()))
    return left.join(renamed, same, how).drop(*theirs.values())


def with_pieces(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    target_rows: int,
    slot_width: int,
    ties: Sequence[str | Column] = (),
    least: DataFrame | None = None,
) -> DataFrame:
    """Cut every group of more than ``target_rows`` rows into consecutive runs along ``order``.

    Adds ``_piece``: 0 for small groups, 0, 1, 2, … along ``order`` (NULL first), then ``ties``,
    for large ones, and ``_split``, true for rows of large groups. A histogram of the group's rows
    over slots of ``slot_width`` gives runs of near-equal depth. A slot that is itself too deep is
    counted by exact ``order`` and ``ties``, the last of which must be a number and is counted in
    runs of a sixteenth of the target; so a burst at one instant is cut as well. NULL keys are a
    group like any other. ``least`` (keys, ``_least``) raises the target of single groups.

    Histograms are aggregated before their shuffle, and only those of large groups meet in a window.
    """
    keys = list(keys)
    slot = F.floor(F.col(order) / F.lit(slot_width)).cast("bigint")
    rows = df.withColumn("_slot", slot)
    coarse = rows.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    totals = coarse.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    target = F.lit(target_rows).cast("bigint")
    if least is not None:
        totals = null_safe_join(totals, least, keys, "left")
        target = F.greatest(target, F.coalesce("_least", target))
    large = totals.withColumn("_target", target).filter("_total > _target").select(*keys, "_target")
    heavy = (
        null_safe_join(coarse, large, keys)
        .filter("_n > _target")
        .select(*keys, "_slot", F.lit(True).alias("_heavy"))
    )
    exact: list[Column] = [F.col(order)]
    for k, tie in enumerate(ties):
        column = F.col(tie) if isinstance(tie, str) else tie
        exact.append(F.floor(column / max(1, target_rows // 16)) if k == len(ties) - 1 else column)
    fine = [f"_fine{k}" for k in range(len(exact))]
    marked = null_safe_join(rows, heavy, [*keys, "_slot"], "left").select(
        *rows.columns, *(F.when(F.col("_heavy"), c).alias(n) for n, c in zip(fine, exact))
    )
    slots = [*keys, "_slot", *fine]
    group = Window.partitionBy(*keys).orderBy(*(F.asc_nulls_first(c) for c in ("_slot", *fine)))
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    histogram = (
        null_safe_join(marked.groupBy(*slots).agg(F.count(F.lit(1)).alias("_n")), large, keys)
        .withColumn("_before", F.sum("_n").over(so_far) - F.col("_n"))
        .select(*slots, F.floor(F.col("_before") / F.col("_target")).alias(PIECE))
    )
    return (
        null_safe_join(marked, histogram, slots, "left")
        .withColumn(SPLIT, F.col(PIECE).isNotNull())
        .withColumn(PIECE, F.coalesce(PIECE, F.lit(0)).cast("bigint"))
        .drop("_slot", *fine)
    )


def carry_forward(summary: DataFrame, keys: Sequence[str], column: str, how: str) -> DataFrame:
    """Per (keys, piece): ``column`` combined over all earlier pieces of the same group.

    ``summary`` has one row per piece, so the window stays small however large the group is.
    ``how`` is ``last`` (newest non-null), ``max`` or ``sum``.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    )
    combine = {"last": lambda c: F.last(c, ignorenulls=True), "max": F.max, "sum": F.sum}
    value = combine[how](column).over(earlier)
    return summary.select(*keys, PIECE, value.alias(column)).filter(F.col(column).isNotNull())


def split_join(
    left: DataFrame, right: DataFrame, key: str, left_row: str, right_row: str, block: int = 4096
) -> DataFrame:
    """Inner equi-join on ``key`` for two sides that both repeat it, in bounded blocks.

    A key with ``a`` left and ``b`` right rows is spread over a grid of ceil(a/block) x
    ceil(b/block) cells: each left row is copied once per grid column, each right row once per
    grid row. Every result pair arises in exactly one cell, and a cell holds about block x block
    pairs. ``left_row``/``right_row`` name columns that are unique per key on their side.
    Keys below the block size on both sides are joined as they are.
    """
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("_b"))
    grid = (
        a.join(b, key)
        .filter((F.col("_a") > block) | (F.col("_b") > block))
        .select(
            key,
            F.ceil(F.col("_a") / block).cast("int").alias("_rows"),
            F.ceil(F.col("_b") / block).cast("int").alias("_cols"),
        )
    )

    def cells(side: DataFrame, own: str, other: str, row: str) -> DataFrame:
        spread = side.join(grid, key, "left")
        mine = F.coalesce(F.pmod(F.xxhash64(row), F.col(own)), F.lit(0)).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return spread.withColumn(own, mine).withColumn(other, F.explode(copies))

    return cells(left, "_rows", "_cols", left_row).join(
        cells(right, "_cols", "_rows", right_row), [key, "_rows", "_cols"]
    ).drop("_rows", "_cols")
