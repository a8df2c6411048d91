"""Matching with removal over a recorded trace.

A matched driver leaves the block, so each match depends on all earlier ones. Blocks are
independent of one another; inside a block the order is strict. A large block is still cut into
pieces that run in parallel, by guessing and repairing: every piece starts from the snapshot of
drivers its block would have without removals, minus the drivers known to be taken by then. At
first none are; each round passes the drivers still taken at the end of a piece on to the next
one and runs again only the pieces whose start changed. When no start changes, every piece has
run from its true start, so the result is the sequential one.

A driver who comes back replaces whatever was taken before, so where drivers return, starts settle
after few rounds. Where they do not, every piece depends on all before it and repairing piece by
piece would take as many rounds as pieces. So as soon as a round does not halve the pieces that
are wrong, or after REPAIRS rounds, the rest of each block, from its first wrong piece on, runs in
one sorted pass that keeps the state of the block as it goes. Rounds write only what they ran.
Where blocks alone keep the cores busy, all blocks run in that pass from the start, without a guess.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.dispatch import Board, Driver, Move
from larkspur.functions.scoring import surge_factor
from larkspur.operators.rides import PIECE_PER_DRIVER, TS_SLOT, _pieces, _snapshots
from larkspur.operators.skew import PIECE, SPLIT, carry_forward, null_safe_join
from larkspur.session import discard, materialise, ship_package

TARGET_ROWS = 200_000
#: Rounds of repairs before the rest of a block runs in one pass.
REPAIRS = 3
#: Blocks run whole at once where the largest is at most so many times a core's share of the rows: a guess and
#: its repairs go over all rows several times.
EVEN = 2
#: Tasks for each core where a block is one task's work, so that blocks seldom share one.
TASKS_PER_CORE = 16
KEY = ["block_id", PIECE]
RESULT = (
    "block_id int, _piece bigint, seq bigint, ts bigint, client_id bigint, drivers bigint, "
    "driver_id bigint, score double, taken boolean"
)
_COLUMNS = [name.split()[0] for name in RESULT.split(", ")]


def _events(pieces: DataFrame) -> DataFrame:
    """Events of every piece as input rows (phase 2), one party id per row."""
    return pieces.select(
        "block_id",
        PIECE,
        SPLIT,
        F.lit(2).alias("phase"),
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


def _inputs(pieces: DataFrame) -> DataFrame:
    """Snapshot rows (phase 0) and events (phase 2) of every piece, one party id per row."""
    shared = ["block_id", PIECE, SPLIT]
    starts = _snapshots(pieces).withColumn(SPLIT, F.lit(True)).withColumn("phase", F.lit(0))
    standing = starts.filter("standing.available").select(
        *shared, "phase", F.lit("put").alias("action"), F.col("driver_id").alias("party"),
        "standing.at.ts", "standing.at.seq", "standing.latitude", "standing.longitude",
        "standing.gender", "standing.rating", "standing.salary",
    )
    moved = starts.filter("moved is not null").select(
        *shared, "phase", F.lit("move").alias("action"), F.col("driver_id").alias("party"),
        "moved.at.ts", "moved.at.seq", "moved.latitude", "moved.longitude",
    )
    return _events(pieces).unionByName(standing).unionByName(moved, allowMissingColumns=True)


def _even(pieces: DataFrame) -> bool:
    """Whether whole blocks, one task each, would take about as long as all rows on all cores."""
    rows = pieces.groupBy("block_id").agg(F.count(F.lit(1)).alias("_n"))
    largest, total = rows.agg(F.max("_n"), F.sum("_n")).first()
    return bool(total) and largest * pieces.sparkSession.sparkContext.defaultParallelism <= EVEN * total


def _run(
    inputs: DataFrame, consume: bool, location_wins: bool, chained: bool = False
) -> DataFrame:
    """Apply each piece's rows in order. Rows stream through the task in sorted batches, so only
    the drivers of one piece are held. ``chained`` pieces go on from the state the one before
    left, a block in one task; of their inputs only the first piece may bear a snapshot."""
    together = KEY[:1] if chained else KEY

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, split, board = None, False, Board(consume, location_wins)

        def same(one: object, other: object) -> bool:
            return one == other or (pd.isna(one) and pd.isna(other))

        def leftovers() -> list[tuple]:
            if not split:
                return []
            return [(*key, None, None, None, None, d, None, True) for d in sorted(board.taken)]

        for batch in batches:
            out: list[tuple] = []
            for row in batch.itertuples(index=False, name=None):
                block, piece, is_split, _, action, party, ts, seq, lat, lon, gender, rating, pay = row
                if key is None or piece != key[1] or not same(key[0], block):
                    out += leftovers()
                    if not chained or key is None or not same(key[0], block):
                        board = Board(consume, location_wins)
                    key, split = (block, piece), is_split and not chained
                at = -math.inf if pd.isna(ts) else ts  # a NULL time is the earliest
                if action == "put":
                    board.put(party, Driver(lat, lon, gender, rating, pay, at, seq))
                elif action == "move":
                    board.move(party, Move(lat, lon, at, seq))
                elif action == "drop":
                    board.drop(party)
                elif action == "taken":
                    board.take(party)
                else:
                    n = board.count()
                    match = board.request(lat, lon, gender)
                    found = match or (None, None)
                    out.append((block, piece, seq, ts, party, n, *found, False))
            yield _frame(out)
        yield _frame(leftovers())

    cores = inputs.sparkSession.sparkContext.defaultParallelism
    dealt = inputs.repartition(TASKS_PER_CORE * cores, *together) if chained else inputs.repartition(*together)
    return (
        dealt.sortWithinPartitions(*KEY, "phase", "ts", "seq")
        .mapInPandas(replay, RESULT)
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_COLUMNS)
    whole = ["block_id", "_piece", "seq", "ts", "client_id", "drivers", "driver_id"]
    return frame.astype({**dict.fromkeys(whole, "Int64"), "score": "float64", "taken": "bool"})


def dispatch(
    trace: DataFrame,
    consume: bool = True,
    location_wins: bool = False,
    target_rows: int = TARGET_ROWS,
    slot_width: int = TS_SLOT,
) -> DataFrame:
    """Every request with the drivers present before it and its match, if any."""
    ship_package(trace.sparkSession)
    pieces = _pieces(trace, target_rows, slot_width, PIECE_PER_DRIVER)
    if consume and _even(pieces):
        ran = materialise(_run(_events(pieces), consume, location_wins, chained=True), "round")
        discard(pieces)
        return ran.drop("taken")
    inputs = materialise(_inputs(pieces), "inputs")
    following = materialise(
        pieces.filter(SPLIT)
        .select(*KEY)
        .distinct()
        .withColumn("_next", F.lead(PIECE).over(Window.partitionBy("block_id").orderBy(PIECE)))
        .filter(F.col("_next").isNotNull()),
        "following",
    )
    discard(pieces)
    # what each round ran: its results, and its pieces (None: all of them)
    rounds = [(materialise(_run(inputs, consume, location_wins), "round"), None)]
    used, wrong_before = None, None
    while consume:
        taken = (
            null_safe_join(_newest(rounds).filter("taken").select(*KEY, "driver_id"), following, KEY)
            .select("block_id", F.col("_next").alias(PIECE), F.col("driver_id").alias("party"))
        )
        taken = materialise(taken, "taken")
        side = [*KEY, "party"]
        changed = taken if used is None else null_safe_join(taken, used, side, "left_anti").unionByName(
            null_safe_join(used, taken, side, "left_anti")
        )
        changed = materialise(changed.select(*KEY).distinct(), "changed")
        wrong = changed.count()
        if used is not None:
            discard(used)
        used = taken
        if not wrong:
            break
        last = len(rounds) > REPAIRS or (wrong_before is not None and 2 * wrong > wrong_before)
        start = used.withColumn(SPLIT, F.lit(True)).withColumn("phase", F.lit(1)).withColumn(
            "action", F.lit("taken")
        )
        again, starts = inputs, start
        if last:
            first = changed.groupBy("block_id").agg(F.min(PIECE).alias("_first"))
            rest = null_safe_join(inputs, first, ["block_id"]).filter(F.col(PIECE) >= F.col("_first"))
            again = rest.filter((F.col(PIECE) == F.col("_first")) | (F.col("phase") == 2)).drop("_first")
            starts = null_safe_join(start, first, ["block_id"]).filter(
                F.col(PIECE) == F.col("_first")
            ).drop("_first")
            changed = materialise(rest.select(*KEY).distinct(), "changed")
        else:
            again = null_safe_join(inputs, changed, KEY, "left_semi")
            starts = null_safe_join(start, changed, KEY, "left_semi")
        ran = _run(
            again.unionByName(starts, allowMissingColumns=True), consume, location_wins, chained=last
        )
        rounds.append((materialise(ran, "round"), changed))
        if last:
            break
        wrong_before = wrong
    discard(inputs)
    if used is not None:
        discard(used)
    return _newest(rounds).filter("not taken").drop("taken")


def _newest(rounds: list[tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """Results of each piece from the last round that ran it."""
    rows, later = None, None
    for results, ran in reversed(rounds):
        left = results if later is None else null_safe_join(results, later.distinct(), KEY, "left_anti")
        rows = left if rows is None else rows.unionByName(left)
        if ran is not None:
            later = ran if later is None else later.unionByName(ran)
    return rows


def match_consume(
    trace: DataFrame,
    location_wins: bool = False,
    target_rows: int = TARGET_ROWS,
    slot_width: int = TS_SLOT,
) -> DataFrame:
    """(seq, client_id, driver_id, score): each match removes its driver; no driver, no row."""
    return (
        dispatch(trace, True, location_wins, target_rows, slot_width)
        .filter(F.col("driver_id").isNotNull())
        .select("seq", "client_id", "driver_id", "score")
    )


def match_surge(
    trace: DataFrame,
    location_wins: bool = False,
    target_rows: int = TARGET_ROWS,
    slot_width: int = TS_SLOT,
) -> DataFrame:
    """As ``match_consume``, with a price factor from the block's driver counts.

    The counts are taken before the match; a request without a driver still counts as the
    block's last one.
    """
    requests = dispatch(trace, True, location_wins, target_rows, slot_width)
    summary = requests.groupBy(*KEY).agg(
        F.max_by("drivers", F.struct("ts", "seq")).alias("earlier")
    )
    carried = carry_forward(summary, ["block_id"], "earlier", "last")
    order = Window.partitionBy(*KEY).orderBy("ts", "seq")
    previous = F.coalesce(F.lag("drivers").over(order), F.col("earlier"))
    return (
        null_safe_join(requests, carried, KEY, "left")
        .withColumn("price_factor", surge_factor(previous, F.col("drivers")))
        .filter(F.col("driver_id").isNotNull())
        .select("seq", "client_id", "driver_id", "score", "price_factor")
    )
