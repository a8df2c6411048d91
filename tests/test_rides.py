import random

import pytest

from larkspur.functions import pairs
from larkspur.functions.dispatch import Board, Driver
from larkspur.operators import dispatching, rides
from larkspur.sources.files import TRACE_SCHEMA
from tests.conftest import plan_text
from tests.replay import replay

NAMES = [c.split()[0] for c in TRACE_SCHEMA.split(", ")]
CUTS = [(25, 5), (1_000_000, 1000)]


def make_events(seed=11, n=700):
    """Most rows fall in one block; drivers change blocks, some rows have no effect."""
    rng = random.Random(seed)
    events = []
    for seq in range(n):
        kind = rng.choice(
            ["DRIVER_LOCATION", "ENTERING_BLOCK", "ENTERING_BLOCK", "LEAVING_BLOCK", "RIDE_COMPLETE",
             "RIDE_REQUEST", "RIDE_REQUEST"])
        request = kind == "RIDE_REQUEST"
        events.append({
            "seq": seq, "ts": seq // 2 * 3, "type": kind,
            "block_id": 1 if rng.random() < 0.7 else rng.randrange(2, 5),
            "driver_id": None if request else rng.randrange(1, 25),
            "client_id": 1000 + seq if request else None,
            "latitude": None if rng.random() < 0.03 else rng.randrange(40) / 10,
            "longitude": rng.randrange(40) / 10,
            "gender": None if request else rng.choice(["M", "F", None]),
            "gender_preference": rng.choice(["N", "M", "F", None]) if request else None,
            "rating": float(rng.randrange(1, 6)), "salary": float(rng.randrange(100)),
            "status": rng.choice(["AVAILABLE", "AVAILABLE", "UNAVAILABLE"]),
        })
    return events


def frame(spark, events):
    return spark.createDataFrame([tuple(e[n] for n in NAMES) for e in events], TRACE_SCHEMA)


@pytest.mark.parametrize("target,slot", CUTS)
@pytest.mark.parametrize("location_wins", [False, True])
def test_candidates_and_reuse(spark, target, slot, location_wins):
    events = make_events()
    expected, final = replay(events, False, location_wins)
    trace = frame(spark, events)
    candidates = rides.scored_candidates(
        rides.request_driver_candidates(trace, location_wins, target, slot)).collect()
    got = {(r.seq, r.driver_id): round(r.score, 9) for r in candidates}
    assert got == {(r["seq"], d): round(s, 9) for r in expected for d, s in r["candidates"].items()}
    best = {r.seq: r.driver_id for r in rides.match_reuse(trace, location_wins, target, slot).collect()}
    assert best == {r["seq"]: r["driver_id"] for r in expected if r["driver_id"] is not None}
    state = {(r.block_id, r.driver_id) for r in rides.driver_state(trace, location_wins).collect()}
    assert state == set(final)


def test_a_busy_driver_is_cut_like_its_block(spark):
    """A driver with a third of all rows: counts do not depend on how many pieces its rows fall into."""
    rng = random.Random(2)
    events = [
        {**e, "driver_id": 1, "block_id": 1} if e["driver_id"] is not None and rng.random() < 0.4 else e
        for e in make_events(seed=31, n=900)
    ]
    expected = {r["seq"]: r["drivers"] for r in replay(events, False)[0]}
    for target, slot in [(20, 5), (200, 50), (1_000_000, 1000)]:
        counts = rides.available_driver_count(frame(spark, events), target, slot).collect()
        assert {r.seq: r.drivers for r in counts} == expected


@pytest.mark.parametrize("target,slot", CUTS)
def test_counts_and_surge(spark, target, slot):
    events = make_events()
    expected, _ = replay(events, False)
    trace = frame(spark, events)
    counts = {r.seq: r.drivers for r in rides.available_driver_count(trace, target, slot).collect()}
    assert counts == {r["seq"]: r["drivers"] for r in expected}
    prices = {r.seq: (r.previous, round(r.price_factor, 9)) for r in rides.surge_prices(trace, target, slot).collect()}
    assert prices == {r["seq"]: (r["previous"], round(r["price"], 9)) for r in expected}


@pytest.mark.parametrize("target,slot", CUTS)
@pytest.mark.parametrize("location_wins", [False, True])
def test_consume_and_surge(spark, target, slot, location_wins):
    events = make_events(seed=13)
    expected, _ = replay(events, True, location_wins)
    want = {r["seq"]: (r["client_id"], r["driver_id"], round(r["price"], 9))
            for r in expected if r["driver_id"] is not None}
    rows = dispatching.match_surge(frame(spark, events), location_wins, target, slot).collect()
    assert {r.seq: (r.client_id, r.driver_id, round(r.price_factor, 9)) for r in rows} == want


def test_hot_block_runs_in_many_pieces(spark):
    events = make_events(seed=17, n=900)
    pieces = rides._pieces(frame(spark, events), 25, 5)
    assert pieces.filter("block_id = 1").select("_piece").distinct().count() > 10


def test_dispatch_agrees_on_a_long_chain(spark):
    """Drivers enter once and are never put again: every piece depends on all earlier ones."""
    events = []
    for seq in range(200):
        base = dict(seq=seq, ts=seq, block_id=1, latitude=0.0, longitude=0.0, gender="M",
                    gender_preference=None, rating=5.0, salary=float(seq % 50), status="AVAILABLE",
                    driver_id=None, client_id=None)
        if seq < 100:
            events.append(base | {"type": "ENTERING_BLOCK", "driver_id": seq + 1})
        else:
            events.append(base | {"type": "RIDE_REQUEST", "client_id": seq, "gender": None,
                                  "gender_preference": "N"})
    expected, _ = replay(events, True)
    rows = dispatching.match_consume(frame(spark, events), False, 40, 1).collect()
    assert {r.seq: r.driver_id for r in rows} == {
        r["seq"]: r["driver_id"] for r in expected if r["driver_id"] is not None}


def test_strict_rejects_location_updates_among_events(spark):
    trace = frame(spark, [make_events()[0] | {"type": "DRIVER_LOCATION", "driver_id": 1, "latitude": 1.0}])
    tagged = trace.selectExpr("*", "'events' as origin")
    assert rides.effective_events(tagged).count() == 0
    with pytest.raises(Exception, match="location update"):
        rides.effective_events(tagged, strict=True).collect()


def test_scores_that_are_not_positive_never_match():
    board = Board()
    board.put(1, Driver(0.0, 0.0, "M", 0.0, 500.0, 0, 0))
    assert board.request(9.0, 9.0, "F") is None and board.count() == 1


def test_ties_go_to_the_first_in_text_order():
    board = Board()
    for driver in (9, 10, 2):
        board.put(driver, Driver(0.0, 0.0, "M", 5.0, 0.0, 0, driver))
    assert [board.request(0.0, 0.0, "N").driver_id for _ in range(3)] == [10, 2, 9]


@pytest.mark.parametrize("chunk", [1, 1 << 17])
def test_pairs_are_never_rows_of_a_sort(spark, monkeypatch, chunk):
    """Best matches score pairs inside a piece: no plan step joins, sorts or shuffles them."""
    monkeypatch.setattr(pairs, "PAIRS", chunk)
    events = [{**e, "rating": None if e["seq"] % 11 == 0 else e["rating"]} for e in make_events(5, 300)]
    trace = frame(spark, events + events[-40:])  # repeated rows are one request
    best = rides.match_reuse(trace)
    plan = plan_text(best)
    assert "FlatMapGroupsInArrow" in plan and "request_latitude" not in plan.split("FlatMapGroupsInArrow")[0]
    expected = {}
    scored = rides.scored_candidates(rides.request_driver_candidates(trace)).collect()
    for r in scored:
        if r.score is not None and r.score > 0:
            here = (-r.score, str(r.driver_id))
            expected[r.seq] = min(expected.get(r.seq, here), here)
    assert {r.seq: r.driver_id for r in best.collect()} == {k: int(v[1]) for k, v in expected.items()}
