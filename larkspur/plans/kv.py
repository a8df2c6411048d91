"""Key-value log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import kvlog as ops
from larkspur.plans.registry import Query
from larkspur.plans.tables import KV_OPS_SQL, event_stream, in_slices, kv_ops, kv_ops_of, with_clauses
from larkspur.session import materialise, scratch_path
from larkspur.streaming.ordered import as_of_stream, split_sink
from larkspur.streaming.tables import changes_sink, current_rows, kv_latest_stream

_LATEST_SQL = (
    with_clauses(KV_OPS_SQL)
    + """SELECT "key", "value", ts FROM (
  SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY ts DESC, seq DESC) AS place
  FROM kv_ops WHERE op = 'PUT') WHERE place = 1"""
)


def _streamed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "latest")
    changes_sink(kv_latest_stream(kv_ops_of(event_stream(spark, sf_dir))), path).awaitTermination()
    return current_rows(spark.read.parquet(path), "key")


def _streamed_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of files in order of arrival; timestamps are up to 100 hours behind."""
    log = materialise(kv_ops(spark, sf_dir), "operations")
    folder, path, late = (scratch_path(spark, n) for n in ("log", "answers", "late"))
    in_slices(log, folder, F.col("seq"), files=1)
    end = log.agg(F.max("ts")).first()[0] or 0
    beyond = F.lit(end + 400 * 3_600_000).alias("ts")
    tick = spark.range(1).select(F.lit(0).cast("long").alias("seq"), F.lit("").alias("key"), F.lit("TICK").alias("op"), beyond)
    tick.withColumn("value", F.lit(None).cast("string")).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    split_sink(as_of_stream(stream, "101 hours"), path, late).awaitTermination()
    return spark.read.parquet(path).select("seq", "key", "ts", "value")


_AS_OF_SQL = (
    with_clauses(
        KV_OPS_SQL,
        """puts AS (
  SELECT "key", ts, arg_max("value", seq) AS "value" FROM kv_ops WHERE op = 'PUT'
  GROUP BY "key", ts)""",
    )
    + """SELECT g.seq, g."key", g.ts, coalesce(p."value", '0') AS "value"
FROM (SELECT * FROM kv_ops WHERE op = 'GET') g
ASOF LEFT JOIN puts p ON g."key" = p."key" AND g.ts > p.ts"""
)

_STALE_SQL = (
    with_clauses(KV_OPS_SQL)
    + """SELECT seq, "key", "value", ts, newest FROM (
  SELECT *, max(ts) OVER (PARTITION BY "key" ORDER BY seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM kv_ops WHERE op = 'PUT') WHERE ts < newest"""
)

QUERIES: dict[str, Query] = {
    "kv_read_as_of": Query(lambda spark, d: ops.read_as_of(kv_ops(spark, d)), _AS_OF_SQL),
    "kv_read_as_of_split": Query(
        lambda spark, d: ops.read_as_of(kv_ops(spark, d), target_rows=16), _AS_OF_SQL
    ),
    "kv_read_as_of_stream": Query(_streamed_as_of, _AS_OF_SQL),
    "kv_latest": Query(lambda spark, d: ops.kv_latest(kv_ops(spark, d)), _LATEST_SQL),
    "kv_latest_stream": Query(_streamed_latest, _LATEST_SQL),
    "kv_stale_puts": Query(lambda spark, d: ops.kv_stale_puts(kv_ops(spark, d)), _STALE_SQL),
    "kv_stale_puts_split": Query(
        lambda spark, d: ops.kv_stale_puts(kv_ops(spark, d), target_rows=16), _STALE_SQL
    ),
    "kv_region_load": Query(
        lambda spark, d: ops.kv_region_load(kv_ops(spark, d)),
        with_clauses(
            KV_OPS_SQL,
            """hashed AS (
  SELECT *, list_reduce(list_prepend(0::BIGINT, [ord(c)::BIGINT for c in string_split("key", '')]),
                        lambda h, c : (h * 31 + c) % 4294967296) AS u FROM kv_ops)""",
            """signed AS (
  SELECT *, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS h FROM hashed)""",
        )
        + """SELECT region, count(DISTINCT "key") AS "keys", count(*) AS operations,
       count(*) FILTER (WHERE op = 'PUT') AS puts
FROM (SELECT *, CAST((abs(h) - 1) % 3 + 1 AS INTEGER) AS region FROM signed) GROUP BY region""",
    ),
}
