"""Ride queries over the trace, as batch jobs and as streams of the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import dispatching
from larkspur.operators import rides as ops
from larkspur.plans.registry import Plan, Query
from larkspur.plans.tables import TRACE_SQL, event_stream, in_slices, trace, trace_of, with_clauses
from larkspur.session import materialise, scratch_path
from larkspur.streaming.ordered import ordered_match_stream, split_sink, ticks
from larkspur.streaming.rides import match_sink, match_stream, ride_stream
from larkspur.streaming.snapshots import driver_counts_at, drivers_at
from larkspur.streaming.tables import changes_sink, current_rows, driver_state_stream

_EFFECTIVE_SQL = """effective AS (
  SELECT *, CASE
      WHEN "type" = 'DRIVER_LOCATION' THEN CASE WHEN driver_id IS NOT NULL THEN 'move' END
      WHEN driver_id IS NOT NULL AND ("type" = 'RIDE_COMPLETE'
        OR ("type" = 'ENTERING_BLOCK' AND status = 'AVAILABLE')) THEN 'put'
      WHEN driver_id IS NOT NULL AND "type" = 'LEAVING_BLOCK' THEN 'drop'
      WHEN driver_id IS NULL AND client_id IS NOT NULL THEN 'request' END AS action
  FROM trace WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""

# State of a driver after each of its rows; seq orders the trace as ts does.
_HISTORY_SQL = """history AS (
  SELECT block_id, driver_id, seq,
         arg_max(action, seq) FILTER (WHERE action IN ('put', 'drop')) OVER w = 'put' AS available,
         arg_max(gender, seq) FILTER (WHERE action IN ('put', 'drop')) OVER w AS gender,
         arg_max(rating, seq) FILTER (WHERE action IN ('put', 'drop')) OVER w AS rating,
         arg_max(salary, seq) FILTER (WHERE action IN ('put', 'drop')) OVER w AS salary,
         arg_max(latitude, seq) FILTER (WHERE action IN ('put', 'move')) OVER w AS latitude,
         arg_max(longitude, seq) FILTER (WHERE action IN ('put', 'move')) OVER w AS longitude,
         lead(seq) OVER (PARTITION BY block_id, driver_id ORDER BY seq) AS until
  FROM effective WHERE action IN ('put', 'drop', 'move')
  WINDOW w AS (PARTITION BY block_id, driver_id ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

_CANDIDATES_SQL = """candidates AS (
  SELECT r.block_id, r.seq, r.client_id, r.gender_preference, r.latitude AS request_latitude,
         r.longitude AS request_longitude, h.driver_id, h.gender, h.rating, h.salary,
         h.latitude, h.longitude
  FROM effective r JOIN history h ON r.block_id = h.block_id AND h.seq < r.seq
   AND (h.until IS NULL OR r.seq < h.until)
  WHERE r.action = 'request' AND h.available)"""

_SCORE_SQL = """exp(-sqrt(pow(latitude - request_latitude, 2) + pow(longitude - request_longitude, 2)))
    * 0.4::DOUBLE
  + (CASE WHEN gender_preference = 'N' OR gender_preference = gender THEN 1.0::DOUBLE ELSE 0 END)
    * 0.2::DOUBLE
  + rating / 5.0::DOUBLE * 0.2::DOUBLE + (1 - salary / 100.0::DOUBLE) * 0.2::DOUBLE"""

_SCORED_SQL = f"scored AS (SELECT *, {_SCORE_SQL} AS score FROM candidates)"

_COUNTS_SQL = """counts AS (
  SELECT r.seq, r.block_id, r.client_id, count(c.driver_id) AS drivers
  FROM effective r LEFT JOIN candidates c ON c.seq = r.seq
  WHERE r.action = 'request' GROUP BY ALL)"""

_BASE = with_clauses(
    TRACE_SQL, _EFFECTIVE_SQL, _HISTORY_SQL, _CANDIDATES_SQL, _SCORED_SQL, _COUNTS_SQL
)
_STATE_SQL = (
    _BASE
    + """SELECT block_id, driver_id, gender, rating, salary, latitude, longitude
FROM history WHERE until IS NULL AND available"""
)
_BEST_SQL = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY seq
              ORDER BY score DESC, CAST(driver_id AS VARCHAR)) AS place
  FROM scored WHERE score > 0) WHERE place = 1"""

# Matching with removal, one event of every block per recursion step, drivers kept as a list.
_DRIVER_SQL = (
    "{'d': driver_id, 'lat': latitude, 'lon': longitude, 'g': gender, 'r': rating, 's': salary}"
)
_LIST_SCORE_SQL = """exp(-sqrt(pow(x.lat - latitude, 2) + pow(x.lon - longitude, 2))) * 0.4::DOUBLE
    + (CASE WHEN gender_preference = 'N' OR gender_preference = x.g THEN 1.0::DOUBLE ELSE 0 END)
      * 0.2::DOUBLE + x.r / 5.0::DOUBLE * 0.2::DOUBLE + (1 - x.s / 100.0::DOUBLE) * 0.2::DOUBLE"""
_SEQUENTIAL_SQL = f"""WITH RECURSIVE {TRACE_SQL},
{_EFFECTIVE_SQL},
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY seq) AS i
  FROM effective WHERE action IS NOT NULL),
run AS (
  SELECT DISTINCT block_id, 0::BIGINT AS i,
         []::STRUCT(d BIGINT, lat DOUBLE, lon DOUBLE, g VARCHAR, r DOUBLE, s DOUBLE)[] AS drivers,
         NULL::BIGINT AS seq, NULL::BIGINT AS client_id,
         NULL::STRUCT(neg DOUBLE, k VARCHAR) AS best, 0::BIGINT AS n
  FROM numbered
  UNION ALL
  SELECT block_id, i, CASE action
           WHEN 'put' THEN list_append(
             list_filter(drivers, lambda x: x.d <> driver_id), {_DRIVER_SQL})
           WHEN 'drop' THEN list_filter(drivers, lambda x: x.d <> driver_id)
           WHEN 'move' THEN list_transform(drivers, lambda x: CASE WHEN x.d = driver_id
             THEN {{'d': x.d, 'lat': latitude, 'lon': longitude, 'g': x.g, 'r': x.r, 's': x.s}}
             ELSE x END)
           ELSE CASE WHEN best.neg < 0
             THEN list_filter(drivers, lambda x: CAST(x.d AS VARCHAR) <> best.k)
             ELSE drivers END
         END, seq, CASE WHEN action = 'request' THEN client_id END, best, len(drivers)
  FROM (
    SELECT e.*, r.drivers, CASE WHEN e.action = 'request' THEN list_min(list_transform(r.drivers,
             lambda x: {{'neg': -({_LIST_SCORE_SQL}), 'k': CAST(x.d AS VARCHAR)}})) END AS best
    FROM run r JOIN numbered e ON e.block_id = r.block_id AND e.i = r.i + 1)),
matched AS (
  SELECT seq, block_id, client_id, best, n, CAST(best.k AS BIGINT) AS driver_id,
         round(-best.neg, 6) AS score,
         lag(n) OVER (PARTITION BY block_id ORDER BY seq) AS previous
  FROM run WHERE client_id IS NOT NULL),
priced AS (
  SELECT *, round(CASE WHEN (previous + n) / 2.0 < 4.5
                  THEN 1 + 2 * (4.5 - (previous + n) / 2.0) / 1.25 ELSE 1 END, 6)::DOUBLE
              AS price_factor
  FROM matched)
"""


# Any location update of a driver overrides where they were put.
_LOCATION_WINS = {
    f"arg_max({axis}, seq) FILTER (WHERE action IN ('put', 'move')) OVER w AS {axis}": (
        f"coalesce(arg_max({axis}, seq) FILTER (WHERE action = 'move') OVER w, "
        f"arg_max({axis}, seq) FILTER (WHERE action = 'put') OVER w) AS {axis}"
    )
    for axis in ("latitude", "longitude")
}


def _location_wins(sql: str) -> str:
    for newest, moved in _LOCATION_WINS.items():
        sql = sql.replace(newest, moved)
    return sql


def _sequential(columns: str) -> str:
    return _SEQUENTIAL_SQL + f"SELECT {columns} FROM priced WHERE best.neg < 0"



def _tagged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations, _ = ops.split_trace(trace_of(event_stream(spark, sf_dir)))
    _, events = ops.split_trace(trace_of(event_stream(spark, sf_dir)))
    return ride_stream(locations, events)


def _streamed_matches(surge: bool = False, consume: bool = True) -> Plan:
    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "matches")
        matches = match_stream(_tagged_stream(spark, sf_dir), consume)
        match_sink(matches, path, surge).awaitTermination()
        return spark.read.parquet(path)

    return plan


#: Up to so many ms late do rows arrive in the query below.
DISORDER = 3_600_000


def _ordered_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in files that are out of order by up to an hour, matched in order all the same."""
    rows = materialise(trace(spark, sf_dir), "trace")
    arrives = F.col("ts") + F.pmod(F.xxhash64("seq"), F.lit(DISORDER))
    end = rows.agg(F.max("ts")).first()[0] or 0
    streams = []
    for topic, part in zip(("locations", "events"), ops.split_trace(rows)):
        folder = scratch_path(spark, topic)
        in_slices(part, folder, arrives, files=1)
        ticks(rows, end + 2 * DISORDER).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
        streams.append(stream.parquet(folder))
    path, late = scratch_path(spark, "matches"), scratch_path(spark, "late")
    split_sink(ordered_match_stream(*streams, f"{DISORDER + 1} milliseconds"), path, late).awaitTermination()
    return spark.read.parquet(path).select("seq", "client_id", "driver_id", "score", "price_factor")


def _drivers_in_state(spark: SparkSession, sf_dir: str) -> str:
    """Checkpoint of a match stream that has seen all events."""
    checkpoint = scratch_path(spark, "checkpoint")
    matches = match_stream(_tagged_stream(spark, sf_dir), consume=False)
    match_sink(matches, scratch_path(spark, "matches"), checkpoint=checkpoint).awaitTermination()
    return checkpoint


def _streamed_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "drivers")
    changes_sink(
        driver_state_stream(trace_of(event_stream(spark, sf_dir))), path
    ).awaitTermination()
    return ops.available_drivers(
        current_rows(spark.read.parquet(path), "block_id", "driver_id")
    )


def _merged_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its origin after both streams were merged."""
    path = scratch_path(spark, "merged")
    tagged = _tagged_stream(spark, sf_dir).select("origin", "type", "seq")
    (
        tagged.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    "split_trace": Query(
        lambda spark, d: (
            lambda parts: parts[0]
            .withColumn("topic", F.lit("driver-locations"))
            .unionByName(parts[1].withColumn("topic", F.lit("events")))
            .select("topic", "block_id", "seq", "type")
        )(ops.split_trace(trace(spark, d))),
        with_clauses(TRACE_SQL)
        + """SELECT CASE WHEN "type" = 'DRIVER_LOCATION' THEN 'driver-locations' ELSE 'events' END
         AS topic, block_id, seq, "type" FROM trace""",
    ),
    "effective_events": Query(
        lambda spark, d: ops.effective_events(trace(spark, d)),
        _BASE
        + f"SELECT {', '.join(ops.EVENT_COLUMNS)} FROM effective WHERE action IS NOT NULL",
    ),
    "driver_state": Query(lambda spark, d: ops.driver_state(trace(spark, d)), _STATE_SQL),
    "driver_state_stream": Query(_streamed_drivers, _STATE_SQL),
    "driver_state_snapshot": Query(
        lambda spark, d: drivers_at(spark, _drivers_in_state(spark, d)), _STATE_SQL
    ),
    "driver_count_snapshot": Query(
        lambda spark, d: driver_counts_at(spark, _drivers_in_state(spark, d)),
        f"SELECT block_id, count(*) AS drivers FROM ({_STATE_SQL}) GROUP BY block_id",
    ),
    "match_ordered_stream": Query(
        lambda spark, d: _ordered_matches(spark, d)
        .withColumn("score", F.round("score", 6))
        .withColumn("price_factor", F.round("price_factor", 6)),
        _sequential("seq, client_id, driver_id, score, price_factor"),
    ),
    "request_driver_candidates": Query(
        lambda spark, d: ops.request_driver_candidates(trace(spark, d)),
        _BASE + "SELECT * FROM candidates",
    ),
    "match_score": Query(
        lambda spark, d: ops.scored_candidates(
            ops.request_driver_candidates(trace(spark, d))
        ).select("seq", "client_id", "driver_id", F.round("score", 6).alias("score")),
        _BASE + "SELECT seq, client_id, driver_id, round(score, 6) AS score FROM scored",
    ),
    "match_reuse": Query(
        lambda spark, d: ops.match_reuse(trace(spark, d)).withColumn("score", F.round("score", 6)),
        _BASE + f"SELECT seq, client_id, driver_id, round(score, 6) AS score FROM ({_BEST_SQL})",
    ),
    "match_reuse_split": Query(
        lambda spark, d: ops.match_reuse(trace(spark, d), target_rows=16).withColumn(
            "score", F.round("score", 6)
        ),
        _BASE + f"SELECT seq, client_id, driver_id, round(score, 6) AS score FROM ({_BEST_SQL})",
    ),
    "driver_state_location_wins": Query(
        lambda spark, d: ops.driver_state(trace(spark, d), location_wins=True), _location_wins(_STATE_SQL)
    ),
    "match_reuse_location_wins": Query(
        lambda spark, d: ops.match_reuse(trace(spark, d), location_wins=True).withColumn(
            "score", F.round("score", 6)
        ),
        _location_wins(_BASE)
        + f"SELECT seq, client_id, driver_id, round(score, 6) AS score FROM ({_BEST_SQL})",
    ),
    "available_driver_count_split": Query(
        lambda spark, d: ops.available_driver_count(trace(spark, d), target_rows=16),
        _BASE + "SELECT seq, block_id, client_id, drivers FROM counts",
    ),
    "match_consume_split": Query(
        lambda spark, d: dispatching.match_consume(trace(spark, d), target_rows=16).withColumn(
            "score", F.round("score", 6)
        ),
        _sequential("seq, client_id, driver_id, score"),
    ),
    "match_reuse_stream": Query(
        _streamed_matches(consume=False),
        _BASE + f"SELECT seq, client_id, driver_id FROM ({_BEST_SQL})",
    ),
    "available_driver_count": Query(
        lambda spark, d: ops.available_driver_count(trace(spark, d)),
        _BASE + "SELECT seq, block_id, client_id, drivers FROM counts",
    ),
    "surge_factor": Query(
        lambda spark, d: ops.surge_prices(trace(spark, d)).withColumn(
            "price_factor", F.round("price_factor", 6)
        ),
        _BASE
        + """SELECT seq, block_id, client_id, drivers, previous,
       round(CASE WHEN (previous + drivers) / 2.0 < 4.5
             THEN 1 + 2 * (4.5 - (previous + drivers) / 2.0) / 1.25 ELSE 1 END, 6)::DOUBLE
         AS price_factor
FROM (SELECT *, lag(drivers) OVER (PARTITION BY block_id ORDER BY seq) AS previous FROM counts)""",
    ),
    "match_consume": Query(
        lambda spark, d: dispatching.match_consume(trace(spark, d)).withColumn("score", F.round("score", 6)),
        _sequential("seq, client_id, driver_id, score"),
    ),
    "match_surge": Query(
        lambda spark, d: dispatching.match_surge(trace(spark, d))
        .withColumn("score", F.round("score", 6))
        .withColumn("price_factor", F.round("price_factor", 6)),
        _sequential("seq, client_id, driver_id, score, price_factor"),
    ),
    "stream_in": Query(
        _merged_streams,
        with_clauses(TRACE_SQL)
        + """SELECT CASE WHEN "type" = 'DRIVER_LOCATION' THEN 'locations' ELSE 'events' END AS origin,
       "type", seq FROM trace""",
    ),
    "match_sink": Query(_streamed_matches(), _sequential("seq, client_id, driver_id")),
    "match_sink_surge": Query(
        lambda spark, d: _streamed_matches(surge=True)(spark, d).withColumn("price_factor", F.round("price_factor", 6)),
        _sequential("seq, client_id, driver_id, price_factor"),
    ),
}
