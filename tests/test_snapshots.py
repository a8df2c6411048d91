"""Drivers read from the state of a match stream, at any committed batch."""

import pytest

from larkspur.operators.rides import available_driver_count, driver_state
from larkspur.sources.files import read_trace
from larkspur.streaming.rides import match_sink, match_stream, ride_stream
from larkspur.streaming.snapshots import driver_counts_at, drivers_at
from tests.test_ordered import deliver
from tests.test_rides import frame, make_events


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("location_wins", [False, True])
def test_state_equals_the_batch_job_at_each_batch(spark, tmp_path, location_wins):
    events = [{**e, "block_id": None if e["block_id"] == 4 else e["block_id"]} for e in make_events(seed=21, n=240)]
    checkpoint, done = str(tmp_path / "cp"), []
    for k in range(3):
        deliver(tmp_path, events[80 * k : 80 * k + 80], 1, first=100_000 * k)
        topics = [read_trace(spark, str(tmp_path / n), stream=True) for n in ("locations", "events")]
        matches = match_stream(ride_stream(*topics), consume=False, location_wins=location_wins)
        query = match_sink(matches, str(tmp_path / "out"), checkpoint=checkpoint)
        query.awaitTermination()
        done.append(max(int(p.name) for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit()))
    for k, batch in enumerate(done):
        seen = frame(spark, events[: 80 * k + 80])
        want = driver_state(seen, location_wins)
        got = drivers_at(spark, checkpoint, batch, location_wins)
        assert got.columns == want.columns and rows(got) == rows(want)
    last = driver_state(frame(spark, events), location_wins)
    assert rows(drivers_at(spark, checkpoint, None, location_wins)) == rows(last)
    counts = {r.block_id: r.drivers for r in driver_counts_at(spark, checkpoint).collect()}
    asked = [{**events[0], "seq": 1000 + b, "ts": 10**9, "type": "RIDE_REQUEST", "block_id": b, "driver_id": None,
              "client_id": 1, "latitude": 1.0, "longitude": 1.0} for b in (1, 2, 3)]
    for r in available_driver_count(frame(spark, events + asked)).where("seq >= 1000").collect():
        assert counts.get(r.block_id, 0) == r.drivers
