"""Ride matching over a recorded trace: driver state, candidates, best matches, surge prices.

Rows of a trace take effect in (ts, seq) order within their block. A block with more rows than
``target_rows`` is cut into consecutive pieces handled by different tasks. Where drivers themselves
are needed, every piece starts from a snapshot of those then available, and pieces grow with the
drivers of their block, so that all snapshots together stay below the number of events. Driver
counts need none: a piece starts from one number. A NULL block is a block like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.pairs import best_drivers
from larkspur.functions.scoring import match_score, surge_factor
from larkspur.operators.skew import PIECE, SPLIT, carry_forward, null_safe_join, with_pieces
from larkspur.session import materialise, ship_package

TARGET_ROWS = 4096
TS_SLOT = 1000
#: Events in a piece for each driver of its block, where drivers are carried over.
PIECE_PER_DRIVER = 2

LOCATION = "DRIVER_LOCATION"
#: A row that says only how far its stream has come.
TICK = "TICK"
EVENT_COLUMNS = [
    "seq",
    "ts",
    "block_id",
    "action",
    "driver_id",
    "client_id",
    "latitude",
    "longitude",
    "gender",
    "gender_preference",
    "rating",
    "salary",
]


_SCORED = "seq bigint, client_id bigint, driver_id bigint, score double"


def split_trace(trace: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Location updates, and everything else; both keyed by ``block_id``."""
    location = F.coalesce(F.col("type") == LOCATION, F.lit(False))
    return trace.filter(location), trace.filter(~location)


def effective_events(trace: DataFrame, strict: bool = False, ticks: bool = False) -> DataFrame:
    """Rows that change state or ask for a driver, with their ``action``.

    move: a driver's new position; put: a driver becomes available; drop: a driver leaves;
    request: a client asks. Rows without coordinates have no effect. An ``origin`` column, if
    present, tells which stream a row came from; under ``strict`` a location update arriving on
    the event stream is an error. With ``ticks``, rows of type TICK stay as well, as ``tick``.
    """
    kind = F.col("type")
    driver = F.col("driver_id").isNotNull()
    arrived = ((kind == "ENTERING_BLOCK") & (F.col("status") == "AVAILABLE")) | (
        kind == "RIDE_COMPLETE"
    )
    if "origin" in trace.columns:
        on_locations = F.col("origin") == "locations"
        misplaced = ~on_locations & (kind == LOCATION)
    else:
        on_locations, misplaced = kind == LOCATION, F.lit(False)
    action = (
        F.when(on_locations, F.when(driver, "move"))
        .when(driver & arrived, "put")
        .when(driver & (kind == "LEAVING_BLOCK"), "drop")
        .when(~driver & F.col("client_id").isNotNull(), "request")
    )
    if strict:
        failure = F.raise_error(F.lit("location update on the event stream")).cast("string")
        action = F.when(misplaced, failure).otherwise(action)
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    if ticks:
        action = F.when(kind == TICK, "tick").otherwise(action)
        placed = placed | (kind == TICK)
    return (
        trace.withColumn("action", action)
        .filter(F.col("action").isNotNull() & placed)
        .select(*EVENT_COLUMNS)
    )


def _at() -> Column:
    return F.struct("ts", "seq")


def _standing() -> Column:
    """State a put or drop leaves behind; orders by time."""
    return F.when(
        F.col("action").isin("put", "drop"),
        F.struct(
            _at().alias("at"),
            (F.col("action") == "put").alias("available"),
            "gender",
            "rating",
            "salary",
            "latitude",
            "longitude",
        ),
    )


def _moved() -> Column:
    """Position a location update leaves behind; orders by time."""
    return F.when(
        F.col("action") == "move", F.struct(_at().alias("at"), "latitude", "longitude")
    )


def _position(axis: str, location_wins: bool) -> Column:
    """A driver's coordinate: the newest known, or any location update's if those win."""
    moved, standing = F.col(f"moved.{axis}"), F.col(f"standing.{axis}")
    if location_wins:
        return F.coalesce(moved, standing)
    return F.when(F.col("moved.at") > F.col("standing.at"), moved).otherwise(standing)


def driver_history_ends(trace: DataFrame) -> DataFrame:
    """Last known state and position per block and driver. Also runs on a stream."""
    return (
        effective_events(trace)
        .filter(F.col("action") != "request")
        .groupBy("block_id", "driver_id")
        .agg(F.max(_standing()).alias("standing"), F.max(_moved()).alias("moved"))
    )


def driver_state(trace: DataFrame, location_wins: bool = False) -> DataFrame:
    """Drivers available in each block at the end of the trace."""
    return available_drivers(driver_history_ends(trace), location_wins)


def available_drivers(states: DataFrame, location_wins: bool = False) -> DataFrame:
    """Driver table of last known states."""
    return states.filter(F.col("standing.available")).select(
        "block_id",
        "driver_id",
        "standing.gender",
        "standing.rating",
        "standing.salary",
        _position("latitude", location_wins).alias("latitude"),
        _position("longitude", location_wins).alias("longitude"),
    )


def _pieces(
    trace: DataFrame, target_rows: int, slot_width: int, per_driver: int = 0
) -> DataFrame:
    """Effective events with their piece, written once: every job below reads them several times,
    each time other rows and columns. A piece has ``per_driver`` events a driver of its block at
    least, which bounds the drivers carried from piece to piece."""
    events = effective_events(trace)
    least = None
    if per_driver:
        drivers = events.filter(F.col("action") != "request").groupBy("block_id", "driver_id")
        least = (
            drivers.agg(F.count(F.lit(1)))
            .groupBy("block_id")
            .agg((F.count(F.lit(1)) * per_driver).alias("_least"))
        )
    return materialise(
        with_pieces(events, ["block_id"], "ts", target_rows, slot_width, ["seq"], least), "pieces"
    )


def _snapshots(pieces: DataFrame) -> DataFrame:
    """Driver states at the start of each later piece of a split block.

    A state holds from the piece after the one it arose in up to the driver's next active piece.
    """
    split = pieces.filter(SPLIT)
    ends = split.groupBy("block_id").agg(F.max(PIECE).alias("_last"))
    per_piece = (
        split.filter(F.col("action") != "request")
        .groupBy("block_id", "driver_id", PIECE)
        .agg(F.max(_standing()).alias("standing"), F.max(_moved()).alias("moved"))
    )
    driver = Window.partitionBy("block_id", "driver_id").orderBy(PIECE)
    so_far = driver.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = per_piece.select(
        "block_id",
        "driver_id",
        PIECE,
        F.last("standing", ignorenulls=True).over(so_far).alias("standing"),
        F.last("moved", ignorenulls=True).over(so_far).alias("moved"),
        F.lead(PIECE).over(driver).alias("_next"),
    )
    first, last = F.col(PIECE) + 1, F.coalesce("_next", "_last")
    return (
        null_safe_join(known, ends, ["block_id"])
        .filter((F.col("standing.available") | F.col("moved").isNotNull()) & (first <= last))
        .select(
            "block_id", "driver_id", "standing", "moved", F.explode(F.sequence(first, last)).alias(PIECE)
        )
    )


def _driver_history(pieces: DataFrame) -> DataFrame:
    """State of a driver from each of its rows on, per piece, and when the next row ends it."""
    rows = (
        pieces.filter(F.col("action") != "request")
        .select(
            "block_id",
            PIECE,
            "driver_id",
            "ts",
            "seq",
            _standing().alias("standing"),
            _moved().alias("moved"),
        )
        .unionByName(_snapshots(pieces), allowMissingColumns=True)
    )
    driver = Window.partitionBy("block_id", PIECE, "driver_id").orderBy(
        F.asc_nulls_first("ts"), "seq"
    )
    so_far = driver.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        "block_id",
        PIECE,
        "driver_id",
        "ts",
        "seq",
        F.last("standing", ignorenulls=True).over(so_far).alias("standing"),
        F.last("moved", ignorenulls=True).over(so_far).alias("moved"),
        F.lead(_at()).over(driver).alias("until"),
    ).withColumn("available", F.coalesce("standing.available", F.lit(False)))


def request_driver_candidates(
    trace: DataFrame,
    location_wins: bool = False,
    target_rows: int = TARGET_ROWS,
    slot_width: int = TS_SLOT,
) -> DataFrame:
    """Every (request, driver available in its block at that moment)."""
    requests, intervals = _requests_and_intervals(trace, location_wins, target_rows, slot_width)
    return _present(requests, intervals).drop(PIECE, "at", "since", "until")


def _present(requests: DataFrame, intervals: DataFrame) -> DataFrame:
    """Requests paired with the intervals they fall into."""
    during = (F.col("since").isNull() | (F.col("since") < F.col("at"))) & (
        F.col("until").isNull() | (F.col("at") < F.col("until"))
    )
    return null_safe_join(requests, intervals, ["block_id", PIECE]).filter(during)


def _requests_and_intervals(
    trace: DataFrame, location_wins: bool, target_rows: int, slot_width: int
) -> tuple[DataFrame, DataFrame]:
    """Requests, and the intervals in which a driver is available with one state."""
    pieces = _pieces(trace, target_rows, slot_width, PIECE_PER_DRIVER)
    intervals = (
        _driver_history(pieces)
        .filter("available")
        .select(
            "block_id",
            PIECE,
            "driver_id",
            F.when(F.col("seq").isNotNull(), _at()).alias("since"),
            "until",
            F.col("standing.gender").alias("gender"),
            F.col("standing.rating").alias("rating"),
            F.col("standing.salary").alias("salary"),
            _position("latitude", location_wins).alias("latitude"),
            _position("longitude", location_wins).alias("longitude"),
        )
    )
    requests = pieces.filter(F.col("action") == "request").select(
        "block_id",
        PIECE,
        "seq",
        "client_id",
        "gender_preference",
        _at().alias("at"),
        F.col("latitude").alias("request_latitude"),
        F.col("longitude").alias("request_longitude"),
    )
    return requests, intervals


def scored_candidates(candidates: DataFrame) -> DataFrame:
    score = match_score(
        *(
            F.col(c)
            for c in (
                "request_latitude",
                "request_longitude",
                "gender_preference",
                "latitude",
                "longitude",
                "gender",
                "rating",
                "salary",
            )
        )
    )
    return candidates.withColumn("score", score)


def _piece_rows(requests: DataFrame, intervals: DataFrame) -> DataFrame:
    """Requests and intervals of each piece in one table; a row with a ``driver_id`` is an interval."""
    asks = requests.select(
        "block_id", PIECE, "seq", "client_id", F.col("at.ts").alias("from_ts"), F.col("at.seq").alias("from_seq"),
        F.col("request_latitude").alias("latitude"), F.col("request_longitude").alias("longitude"),
        F.col("gender_preference").alias("gender"),
    )
    spans = intervals.select(
        "block_id", PIECE, "driver_id", "latitude", "longitude", "gender", "rating", "salary",
        F.col("since").isNull().alias("always"), F.col("since.ts").alias("from_ts"), F.col("since.seq").alias("from_seq"),
        F.col("until").isNull().alias("forever"), F.col("until.ts").alias("to_ts"), F.col("until.seq").alias("to_seq"),
    )
    return asks.unionByName(spans, allowMissingColumns=True)


def match_reuse(
    trace: DataFrame,
    location_wins: bool = False,
    target_rows: int = TARGET_ROWS,
    slot_width: int = TS_SLOT,
) -> DataFrame:
    """Best driver per request, drivers staying available: (seq, client_id, driver_id, score).

    Scores must be positive; equal ones go to the driver first in text order. A task takes a piece at
    a time, scores its pairs in chunks and keeps one driver a request: pairs are never rows, so
    neither sorted, spilled nor shuffled, however many drivers a block has.
    """
    ship_package(trace.sparkSession)
    pieces = _piece_rows(*_requests_and_intervals(trace, location_wins, target_rows, slot_width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from best_drivers(pa.Table.from_batches(batches))

    best = F.min(F.struct((-F.col("score")).alias("neg"), F.col("driver_id").cast("string").alias("d")))
    return (  # rows that repeat a request are one request
        pieces.groupBy("block_id", PIECE)
        .applyInArrow(run, _SCORED)
        .groupBy("seq", "client_id")
        .agg(best.alias("_best"))
        .select(
            "seq",
            "client_id",
            F.col("_best.d").cast("bigint").alias("driver_id"),
            (-F.col("_best.neg")).alias("score"),
        )
    )


def _request_counts(trace: DataFrame, target_rows: int, slot_width: int) -> DataFrame:
    """Requests with the number of drivers then in their block, still tagged with their piece.

    Arrivals and departures are summed per piece, and each piece starts from the sum of the pieces
    before it.
    """
    pieces = _pieces(trace, target_rows, slot_width)
    in_order = (F.asc_nulls_first("ts"), F.asc_nulls_first("seq"))
    acts = pieces.filter(F.col("action").isin("put", "drop")).withColumn(
        "now", (F.col("action") == "put").cast("int")
    )
    # a driver's last act in a piece is where its next piece starts, so one busy driver is many tasks' work
    ends = acts.groupBy("block_id", "driver_id", PIECE).agg(F.max_by("now", _at()).alias("_end"))
    over_pieces = Window.partitionBy("block_id", "driver_id").orderBy(PIECE)
    starts = ends.withColumn("_from", F.lag("_end").over(over_pieces)).drop("_end").filter("_from = 1")
    driver = Window.partitionBy("block_id", PIECE, "driver_id").orderBy(*in_order)
    changes = (
        null_safe_join(acts, starts, ["block_id", "driver_id", PIECE], "left")
        .withColumn("change", F.col("now") - F.coalesce(F.lag("now").over(driver), "_from", F.lit(0)))
        .filter(F.col("change") != 0)
        .select("block_id", PIECE, "ts", "seq", "change")
    )
    requests = pieces.filter(F.col("action") == "request").select(
        "block_id", PIECE, "ts", "seq", "client_id", F.lit(0).alias("change")
    )
    both = changes.unionByName(requests, allowMissingColumns=True)
    sums = both.groupBy("block_id", PIECE).agg(F.sum("change").alias("_start"))
    carried = carry_forward(sums, ["block_id"], "_start", "sum")
    so_far = (
        Window.partitionBy("block_id", PIECE)
        .orderBy(*in_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = both.withColumn("_inside", F.sum("change").over(so_far)).filter(
        F.col("client_id").isNotNull()
    )
    return (
        null_safe_join(counted, carried, ["block_id", PIECE], "left")
        .withColumn("drivers", F.coalesce("_start", F.lit(0)) + F.col("_inside"))
        .drop("change", "_inside", "_start")
    )


def available_driver_count(
    trace: DataFrame, target_rows: int = TARGET_ROWS, slot_width: int = TS_SLOT
) -> DataFrame:
    """(seq, block_id, client_id, drivers): drivers in the block at each request.

    Counted from arrivals and departures alone, without pairing requests and drivers.
    """
    return _request_counts(trace, target_rows, slot_width).select(
        "seq", "block_id", "client_id", "drivers"
    )


def surge_prices(
    trace: DataFrame, target_rows: int = TARGET_ROWS, slot_width: int = TS_SLOT
) -> DataFrame:
    """Price factor per request from its block's driver counts, drivers staying available."""
    counts = _request_counts(trace, target_rows, slot_width)
    summary = counts.groupBy("block_id", PIECE).agg(
        F.max_by("drivers", F.struct("ts", "seq")).alias("earlier")
    )
    carried = carry_forward(summary, ["block_id"], "earlier", "last")
    order = Window.partitionBy("block_id", PIECE).orderBy("ts", "seq")
    previous = F.coalesce(F.lag("drivers").over(order), F.col("earlier"))
    return (
        null_safe_join(counts, carried, ["block_id", PIECE], "left")
        .withColumn("previous", previous)
        .select(
            "seq",
            "block_id",
            "client_id",
            "drivers",
            "previous",
            surge_factor(F.col("previous"), F.col("drivers")).alias("price_factor"),
        )
    )
