"""Cutting groups into pieces must not change any result, whatever the size of the pieces."""

import random

import pytest

from larkspur.operators import dispatching, kvlog, rides
from larkspur.operators.skew import PIECE, SPLIT, with_pieces
from tests.replay import replay
from tests.test_rides import frame, make_events

TARGETS = [1, 2, 7]


def rows_of(df):
    return sorted((tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def odd_trace(kind):
    rng = random.Random(3)
    events = make_events(seed=23, n=160)
    for e in events:
        if kind == "instant":
            e["ts"] = 5
        if rng.random() < 0.15:
            e["ts"] = None
        if rng.random() < 0.3:
            e["block_id"] = None
        elif e["block_id"] != 1:
            e["block_id"] = 2
    return events


@pytest.mark.parametrize("kind", ["spread", "instant"])
def test_rides_with_null_times_and_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(rides, "PIECE_PER_DRIVER", 0)
    monkeypatch.setattr(dispatching, "PIECE_PER_DRIVER", 0)
    trace = frame(spark, odd_trace(kind)).cache()
    operators = [
        rides.available_driver_count, rides.surge_prices,
        lambda t, target_rows: rides.request_driver_candidates(t, target_rows=target_rows),
        lambda t, target_rows: rides.match_reuse(t, target_rows=target_rows),
        lambda t, target_rows: dispatching.match_surge(t, target_rows=target_rows),
    ]
    for operator in operators:
        whole = rows_of(operator(trace, target_rows=10**6))
        assert whole
        for target in TARGETS if operator in operators[:2] else TARGETS[2:]:
            assert rows_of(operator(trace, target_rows=target)) == whole, (operator, target)


@pytest.mark.parametrize("instant", [False, True])
def test_logs_with_null_times_and_keys(spark, instant):
    rng = random.Random(8)
    rows = [
        (k, rng.choice(["a", "a", None, "b"]), rng.choice(["GET", "PUT"]), f"v{k}",
         rng.choice([None, 50]) if instant else rng.choice([None, *range(0, 200, 10)]))
        for k in range(150)
    ]
    ops = spark.createDataFrame(rows, "seq long, key string, op string, value string, ts long").cache()
    for operator in (kvlog.read_as_of, kvlog.kv_stale_puts):
        whole = rows_of(operator(ops, 10**6))
        for target in TARGETS:
            assert rows_of(operator(ops, target, 20)) == whole, (operator, target)


def test_bursts_and_null_groups_are_cut(spark):
    rows = [(None if k % 2 else "x", 7 if k < 90 else None, k) for k in range(100)]
    df = spark.createDataFrame(rows, "key string, at long, seq long")
    pieces = with_pieces(df, ["key"], "at", 10, 1000, ["seq"])
    sizes = pieces.groupBy("key", PIECE).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 20
    assert pieces.filter(SPLIT).count() == 100


def test_carried_drivers_stay_below_the_events(spark):
    """Twice the drivers and events carry about twice the drivers, not four times."""
    def carried(scale):
        events = [
            e | {"driver_id": None if e["driver_id"] is None else e["seq"] % (20 * scale), "block_id": 1}
            for e in make_events(seed=5, n=600 * scale)
        ]
        pieces = rides._pieces(frame(spark, events), 20, 5, rides.PIECE_PER_DRIVER)
        return rides._snapshots(pieces).count(), len(events)

    (small, n), (large, m) = carried(1), carried(4)
    assert small <= n and large <= m and large <= 5 * small


def test_drivers_that_never_return_take_a_few_rounds(spark, monkeypatch):
    events = []
    for seq in range(640):
        base = dict(seq=seq, ts=seq, block_id=1, latitude=0.0, longitude=0.0, gender="M", gender_preference=None,
                    rating=5.0, salary=float(seq % 50), status="AVAILABLE", driver_id=None, client_id=None)
        if seq < 15:
            events.append(base | {"type": "ENTERING_BLOCK", "driver_id": seq + 1})
        elif seq % 40 == 0:
            events.append(base | {"type": "RIDE_REQUEST", "client_id": seq, "gender": None, "gender_preference": "N"})
        else:
            events.append(base | {"type": "DRIVER_LOCATION", "driver_id": seq % 15 + 1})
    ran = []
    run = dispatching._run
    monkeypatch.setattr(dispatching, "_run", lambda *a, **k: ran.append(k) or run(*a, **k))
    rows = dispatching.match_consume(frame(spark, events), False, 30, 1).collect()
    expected, _ = replay(events, True)
    assert {r.seq: r.driver_id for r in rows} == {r["seq"]: r["driver_id"] for r in expected if r["driver_id"]}
    assert len(ran) <= dispatching.REPAIRS + 2 and ran[-1] == {"chained": True}
    assert rides._pieces(frame(spark, events), 30, 1, 2).select(PIECE).distinct().count() >= 20


def test_even_blocks_run_whole_without_a_guess(spark, monkeypatch):
    """Many blocks of like size, a NULL one among them, go over their rows once; the matches are the sequential ones."""
    rng = random.Random(4)
    events = make_events(seed=31, n=600)
    for e in events:
        e["block_id"] = rng.choice([None, *range(1, 16)])
        if rng.random() < 0.1:
            e["ts"] = None
    trace = frame(spark, events).cache()
    ran = []
    run = dispatching._run
    monkeypatch.setattr(dispatching, "_run", lambda *a, **k: ran.append(k) or run(*a, **k))
    for operator in (dispatching.match_consume, dispatching.match_surge):
        ran.clear()
        monkeypatch.setattr(dispatching, "EVEN", 2)
        whole = rows_of(operator(trace, False, 7, 1))
        assert whole and ran == [{"chained": True}]
        monkeypatch.setattr(dispatching, "EVEN", 0)
        assert rows_of(operator(trace, False, 7, 1)) == whole and len(ran) > 2
