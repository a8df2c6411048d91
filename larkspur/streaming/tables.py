"""Tables kept up to date by a stream: the changes of each micro-batch, and the rows now valid.

The aggregations are the batch ones, run by Spark's built-in streaming state. A micro-batch writes
only the keys it changed.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators.kvlog import kv_latest
from larkspur.operators.rides import driver_history_ends
from larkspur.session import scratch_path
from larkspur.streaming.rides import AVAILABLE


def kv_latest_stream(ops: DataFrame) -> DataFrame:
    """Newest surviving value per key. An operation older than the newest seen changes nothing,
    whenever it arrives; of equal timestamps the later arrival number wins."""
    return kv_latest(ops)


def driver_state_stream(trace: DataFrame) -> DataFrame:
    """Last known state and position per block and driver."""
    return driver_history_ends(trace)


def changes_sink(
    aggregate: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] = AVAILABLE,
) -> StreamingQuery:
    """Write the changed rows of each micro-batch to their own folder, which a rerun replaces."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        aggregate.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or scratch_path(aggregate.sparkSession, "stream"))
        .trigger(**trigger)
        .start()
    )


def current_rows(changes: DataFrame, *keys: str) -> DataFrame:
    """Newest version of each key's row among written changes."""
    others = [c for c in changes.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*others), F.col("batch")).alias("_row")
    return changes.groupBy(*keys).agg(newest).select(*keys, *(f"_row.{c}" for c in others))


def compact_changes(changes: DataFrame, base: str, *keys: str) -> None:
    """Write the rows valid after all ``changes`` as a base table, as of their last micro-batch.

    Readers then need the base and later micro-batches alone (``rows_since``), and the folders of
    earlier ones can be dropped. Bases do not overwrite each other; the newest counts.
    """
    last = changes.agg(F.max("batch")).first()[0]
    if last is not None:
        current_rows(changes, *keys).write.mode("overwrite").parquet(f"{base}/batch={last}")


def rows_since(spark: SparkSession, base: str, changes: DataFrame, *keys: str) -> DataFrame:
    """Rows now valid: those of the newest base, replaced by changes of later micro-batches."""
    stored = spark.read.parquet(base)
    last = stored.agg(F.max("batch")).first()[0]
    later = changes.filter(F.col("batch") > last)
    return current_rows(stored.filter(F.col("batch") == last).unionByName(later), *keys)
