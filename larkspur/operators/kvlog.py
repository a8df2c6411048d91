"""Reads and writes over a key-value operation log.

``ops(seq, key, op, value, ts)``: arrival number, key, GET or PUT, value, timestamp. A key with
more rows than ``target_rows`` is cut into consecutive pieces handled by different tasks; each
piece starts from one row carried over from the pieces before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.hashing import home_region
from larkspur.operators.skew import PIECE, SPLIT, carry_forward, with_pieces

TARGET_ROWS = 1_000_000
TS_SLOT = 60_000
SEQ_SLOT = 65_536
MISSING = "0"


def read_as_of(
    ops: DataFrame, target_rows: int = TARGET_ROWS, slot_width: int = TS_SLOT
) -> DataFrame:
    """Each GET with the value of the newest PUT of a strictly smaller timestamp, else "0".

    Among PUTs of equal timestamp the later arrival counts.
    """
    put = F.col("op") == "PUT"
    # GETs stand before the PUTs of their instant, also where a piece ends inside one
    ties = [F.when(put, 1).otherwise(0), "seq"]
    pieces = with_pieces(ops, ["key"], "ts", target_rows, slot_width, ties)
    summary = pieces.filter(SPLIT).groupBy("key", PIECE).agg(
        F.max_by(F.when(put, F.col("value")), F.when(put, F.struct("ts", "seq"))).alias("value")
    )
    carried = carry_forward(summary, ["key"], "value", "last").withColumn("op", F.lit("PUT"))
    order = [F.asc_nulls_first("ts"), F.when(put, 1).otherwise(0).asc(), F.asc("seq")]
    so_far = (
        Window.partitionBy("key", PIECE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        pieces.drop(SPLIT)
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("_seen", F.last(F.when(put, F.col("value")), ignorenulls=True).over(so_far))
        .filter(F.col("op") == "GET")
        .select("seq", "key", "ts", F.coalesce("_seen", F.lit(MISSING)).alias("value"))
    )


def kv_latest(ops: DataFrame) -> DataFrame:
    """Surviving value per key: newest timestamp, then latest arrival. Also runs on a stream."""
    newest = F.struct("ts", "seq")
    return (
        ops.filter(F.col("op") == "PUT")
        .groupBy("key")
        .agg(F.max_by("value", newest).alias("value"), F.max("ts").alias("ts"))
    )


def kv_stale_puts(
    ops: DataFrame, target_rows: int = TARGET_ROWS, slot_width: int = SEQ_SLOT
) -> DataFrame:
    """PUTs that arrive after one of a greater timestamp for their key."""
    puts = ops.filter(F.col("op") == "PUT").select("seq", "key", "value", "ts")
    pieces = with_pieces(puts, ["key"], "seq", target_rows, slot_width)
    summary = pieces.filter(SPLIT).groupBy("key", PIECE).agg(F.max("ts").alias("ts"))
    carried = carry_forward(summary, ["key"], "ts", "max")
    before = (
        Window.partitionBy("key", PIECE)
        .orderBy(F.asc_nulls_first("seq"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        pieces.drop(SPLIT)
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("newest", F.max("ts").over(before))
        .filter(F.col("seq").isNotNull() & (F.col("ts") < F.col("newest")))
        .select("seq", "key", "value", "ts", "newest")
    )


def kv_region_load(ops: DataFrame) -> DataFrame:
    """Operations per home region; keys are counted before they are hashed."""
    per_key = ops.groupBy("key").agg(
        F.count(F.lit(1)).alias("_ops"),
        F.sum(F.when(F.col("op") == "PUT", 1).otherwise(0)).alias("_puts"),
    )
    return (
        per_key.withColumn("region", home_region(F.col("key")))
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("_ops").alias("operations"),
            F.sum("_puts").alias("puts"),
        )
    )
