"""Ride matching on streams: two tagged sources, one keyed stateful processor, match sinks.

Inside a micro-batch a block's rows are applied in (ts, seq) order; between micro-batches the
order of arrival stands. State is kept per block and does not expire unless a TTL is given. The
size of a micro-batch is bounded at the sources (files, offsets or bytes per trigger).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import (
    StatefulProcessor,
    StatefulProcessorHandle,
    StreamingQuery,
)

from larkspur.functions.dispatch import Board, Driver, Move
from larkspur.operators.rides import effective_events, split_trace
from larkspur.session import scratch_path, ship_package
from larkspur.sources.messages import encode_messages

LOCATIONS, EVENTS = "locations", "events"
#: Run over what is there, then stop.
AVAILABLE = {"availableNow": True}
MATCH = "seq bigint, client_id bigint, driver_id bigint, score double, price_factor double"
_DRIVER = "latitude double, longitude double, gender string, rating double, salary double, ts bigint, seq bigint"
_MOVE = "latitude double, longitude double, ts bigint, seq bigint"
#: Rows turned into Python values at a time.
STEP = 8192


def ride_stream(locations: DataFrame, events: DataFrame) -> DataFrame:
    """The two inputs as one, each row tagged with its ``origin``."""
    return locations.withColumn("origin", F.lit(LOCATIONS)).unionByName(
        events.withColumn("origin", F.lit(EVENTS)), allowMissingColumns=True
    )


def checked_origin(tagged: DataFrame) -> DataFrame:
    """Fail on rows of any other stream."""
    known = F.col("origin").isin(LOCATIONS, EVENTS)
    unknown = F.raise_error(F.concat(F.lit("unexpected input stream: "), F.col("origin")))
    return tagged.withColumn("origin", F.when(known, F.col("origin")).otherwise(unknown.cast("string")))


def block_key() -> Column:
    """A block's key in state: a text, since numbers beside a NULL reach a processor as floats."""
    return F.coalesce(F.col("block_id").cast("string"), F.lit("")).alias("block")


class Rows:
    """Rows of a block, column by column in arrays, texts as codes: a fraction of what frames and their copies hold."""

    TEXTS = ("action", "gender")
    COLUMNS = ("action", "party", "ts", "seq", "latitude", "longitude", "gender", "rating", "salary")

    def __init__(self, frames: Iterator[pd.DataFrame]) -> None:
        self.known: dict[str | None, int] = {None: 0}
        parts: dict[str, list[np.ndarray]] = {c: [] for c in self.COLUMNS}
        for frame in frames:
            for c in self.COLUMNS:
                parts[c].append(self._codes(frame[c]) if c in self.TEXTS else frame[c].to_numpy(copy=True))
        self.columns = {c: np.concatenate(parts.pop(c) or [np.empty(0)]) for c in self.COLUMNS}
        #: Places of the rows in (ts, seq) order, missing ones last, equal ones as they came.
        self.order = np.lexsort((self.columns["seq"], self.columns["ts"]))

    def _codes(self, texts: pd.Series) -> np.ndarray:
        codes, values = pd.factorize(texts)
        whole = [self.known.setdefault(v, len(self.known)) for v in values] + [0]  # -1, a missing text, is the last
        return np.array(whole, np.int32)[codes]

    def count(self, action: str) -> int:
        return int(np.count_nonzero(self.columns["action"] == self.known.get(action, -1)))

    def steps(self, first: int, last: int, step: int = STEP) -> Iterator[pd.DataFrame]:
        """Rows from place ``first`` to before ``last``, some at a time."""
        texts = np.array(list(self.known), object)
        for k in range(first, last, step):
            some = self.order[k : min(k + step, last)]
            yield pd.DataFrame(
                {c: texts[v[some]] if c in self.TEXTS else v[some] for c, v in self.columns.items()}
            )


class MatchProcessor(StatefulProcessor):
    """Keeps a block's drivers, positions and last driver count; answers its requests."""

    def __init__(
        self, consume: bool = True, location_wins: bool = False, ttl_ms: int | None = None
    ) -> None:
        self.consume, self.location_wins, self.ttl_ms = consume, location_wins, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.drivers = handle.getMapState("drivers", "driver_id bigint", _DRIVER, self.ttl_ms)
        self.moves = handle.getMapState("moves", "driver_id bigint", _MOVE, self.ttl_ms)
        self.last = handle.getValueState("last", "drivers bigint", self.ttl_ms)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        held = Rows(rows)
        yield from self.applied_to(held, len(held.order))

    def applied_to(self, rows: Rows, number: int) -> Iterator[pd.DataFrame]:
        """Apply the first ``number`` rows in (ts, seq) order to the block's state; the matches they lead to."""
        board = Board(self.consume, self.location_wins)
        if rows.count("request"):
            board.restore(
                {driver: Driver(*value) for (driver,), value in self.drivers.iterator()},
                {driver: Move(*value) for (driver,), value in self.moves.iterator()},
            )
        else:  # without a request only the drivers that rows name can change
            named = {(int(party),) for party in np.unique(rows.columns["party"])}
            board.restore(
                {k[0]: Driver(*self.drivers.getValue(k)) for k in named if self.drivers.containsKey(k)},
                {k[0]: Move(*self.moves.getValue(k)) for k in named if self.moves.containsKey(k)},
            )
        if self.last.exists():
            board.previous = self.last.get()[0]
        drivers, moves, previous = dict(board.drivers), dict(board.moves), board.previous

        for frame in rows.steps(0, number):
            matches = []
            for row in frame.itertuples(index=False):
                if row.action == "put":
                    board.put(
                        row.party,
                        Driver(
                            row.latitude, row.longitude, row.gender, row.rating, row.salary, row.ts, row.seq
                        ),
                    )
                elif row.action == "move":
                    board.move(row.party, Move(row.latitude, row.longitude, row.ts, row.seq))
                elif row.action == "drop":
                    board.drop(row.party)
                else:
                    price = board.surge()
                    match = board.request(row.latitude, row.longitude, row.gender)
                    if match:
                        matches.append((row.seq, row.party, *match, price))
            yield _matches(matches)

        _store(self.drivers, drivers, board.drivers)
        _store(self.moves, moves, board.moves)
        if board.previous != previous:
            self.last.update((board.previous,))


def _matches(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(
        rows, columns=["seq", "client_id", "driver_id", "score", "price_factor"]
    ).astype(
        {
            "seq": "int64",
            "client_id": "int64",
            "driver_id": "int64",
            "score": "float64",
            "price_factor": "float64",
        }
    )


def _store(state: Any, before: dict, after: dict) -> None:
    """Write what a micro-batch changed."""
    for driver in before.keys() - after.keys():
        state.removeKey((driver,))
    for driver, value in after.items():
        if before.get(driver) != value:
            state.updateValue((driver,), tuple(value))


def match_stream(
    tagged: DataFrame,
    consume: bool = True,
    location_wins: bool = False,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Stream of matches (seq, client_id, driver_id, score, price_factor)."""
    ship_package(tagged.sparkSession)
    events = effective_events(checked_origin(tagged)).select(
        block_key(),
        "action",
        F.coalesce("driver_id", "client_id").alias("party"),
        "ts",
        "seq",
        "latitude",
        "longitude",
        F.coalesce("gender_preference", "gender").alias("gender"),
        "rating",
        "salary",
    )
    return events.groupBy("block").transformWithStateInPandas(
        MatchProcessor(consume, location_wins, ttl_ms),
        outputStructType=MATCH,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def match_sink(
    matches: DataFrame,
    path: str,
    surge: bool = False,
    checkpoint: str | None = None,
    format: str = "parquet",
    trigger: Mapping[str, Any] = AVAILABLE,
    messages: bool = False,
    **options: str,
) -> StreamingQuery:
    """Write matches as they arise: client, driver and, for surge matching, the price factor.

    ``trigger`` is any of Spark's (``{"processingTime": "1 second"}`` runs until stopped).
    ``messages`` writes (key, value) rows, the key being the client, for message sinks.
    """
    columns = ["client_id", "driver_id"] + (["price_factor"] if surge else [])
    rows = matches.select("seq", *columns)
    return (
        (encode_messages(rows, "client_id") if messages else rows)
        .writeStream.format(format)
        .option("checkpointLocation", checkpoint or scratch_path(matches.sparkSession, "stream"))
        .options(**options)
        .outputMode("append")
        .trigger(**trigger)
        .start(path)
    )


def split_stream(
    trace: DataFrame,
    locations_path: str,
    events_path: str,
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] = AVAILABLE,
) -> StreamingQuery:
    """Route a stream's location updates and other rows to two tables.

    A micro-batch is kept while its two writes run, so its source is read once.

    A micro-batch that is run again after a failure overwrites its own folder, so no row is
    written twice.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for part, path in zip(split_trace(batch), (locations_path, events_path)):
            part.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.unpersist()

    return (
        trace.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint or scratch_path(trace.sparkSession, "stream"))
        .trigger(**trigger)
        .start()
    )
