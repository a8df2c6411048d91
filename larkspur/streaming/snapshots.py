"""What a running match stream knows, read from its state: no table of changes is kept for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _state(spark: SparkSession, checkpoint: str, name: str, batch: int | None) -> DataFrame:
    reader = spark.read.format("statestore").option("stateVarName", name)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def drivers_at(
    spark: SparkSession, checkpoint: str, batch: int | None = None, location_wins: bool = False
) -> DataFrame:
    """(block_id, driver_id, gender, rating, salary, latitude, longitude) after a committed batch.

    The drivers then available in each block, at the positions that requests would have found. By
    default the last batch; earlier ones as long as the checkpoint keeps their versions.
    """
    block = F.nullif(F.col("key.block"), F.lit("")).cast("int").alias("block_id")
    driver = F.col("user_map_key.driver_id").alias("driver_id")
    drivers = _state(spark, checkpoint, "drivers", batch).select(block, driver, "user_map_value.*")
    moves = _state(spark, checkpoint, "moves", batch).select(
        F.col("key.block").alias("_block"),
        F.col("user_map_key.driver_id").alias("_driver"),
        F.col("user_map_value").alias("_move"),
    )
    same = F.coalesce(F.col("block_id").cast("string"), F.lit("")) == F.col("_block")
    newer = F.col("_move").isNotNull()
    if not location_wins:
        newer &= F.struct("_move.ts", "_move.seq") > F.struct("ts", "seq")
    return drivers.join(moves, same & (F.col("driver_id") == F.col("_driver")), "left").select(
        "block_id", "driver_id", "gender", "rating", "salary",
        *(F.when(newer, F.col(f"_move.{c}")).otherwise(F.col(c)).alias(c) for c in ("latitude", "longitude")),
    )


def driver_counts_at(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(block_id, drivers): drivers available in each block that has some, after a committed batch."""
    return drivers_at(spark, checkpoint, batch).groupBy("block_id").agg(F.count(F.lit(1)).alias("drivers"))
