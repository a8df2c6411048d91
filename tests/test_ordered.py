"""Event-time order: shuffled files, any trigger, restarts, late rows; as-of reads of a growing log."""

import itertools
import json
import os
import random
import time

import pytest

from larkspur.operators.rides import LOCATION
from larkspur.sources.files import read_trace
from larkspur.streaming.ordered import as_of_stream, ordered_match_stream, split_sink, ticks
from tests.replay import replay
from tests.test_rides import make_events

STEP = 1000  # ms between events
KV = "seq long, key string, op string, ts long, value string"


written = itertools.count(1)


def write(folder, name, rows):
    """Files are taken by their time of change, so each gets a second of its own."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    at = time.time() - 50_000 + next(written)
    os.utime(folder / name, (at, at))


def displaced(rows, reach, seed):
    """Rows in an order of arrival that is off by ``reach`` events at most."""
    rng = random.Random(seed)
    return [r for _, _, r in sorted((i + rng.uniform(0, reach), i, r) for i, r in enumerate(rows))]


def deliver(tmp_path, rows, files, first=0):
    """Rows to their topics in ``files`` files each, cut at different places for each topic."""
    for topic, wanted in (("locations", True), ("events", False)):
        mine = [r for r in rows if (r["type"] == LOCATION) == wanted]
        size = max(1, -(-len(mine) // (files + wanted)))
        for k in range(0, len(mine), size):
            write(tmp_path / topic, f"{first + k:06d}.json", mine[k : k + size])


def finish(spark, tmp_path, ts):
    for topic in ("locations", "events"):
        sample = read_trace(spark, str(tmp_path / topic))
        row = {k: v for k, v in ticks(sample, ts).first().asDict().items() if v is not None}
        write(tmp_path / topic, "999999.json", [row])


def run(spark, tmp_path, delay, files):
    topics = [
        read_trace(spark, str(tmp_path / n), stream=True, maxFilesPerTrigger=str(files)) for n in ("locations", "events")
    ]
    out, late = str(tmp_path / "out"), str(tmp_path / "late")
    split_sink(ordered_match_stream(*topics, delay), out, late, str(tmp_path / "cp")).awaitTermination()
    return spark.read.parquet(out).collect(), spark.read.parquet(late).collect()


def events_in_time(seed, n):
    return [{**e, "ts": 10_000 + STEP * k} for k, e in enumerate(make_events(seed=seed, n=n))]


def wanted(events):
    return {
        r["seq"]: (r["client_id"], r["driver_id"], round(r["price"], 9))
        for r in replay(events, True)[0] if r["driver_id"] is not None
    }


@pytest.mark.parametrize("files", [1, 3, 100])
def test_shuffled_topics_give_the_sequential_result(spark, tmp_path, files):
    events = events_in_time(7, 160)
    arrived = displaced(events, 20, files)
    deliver(tmp_path, arrived[:90], 3)
    first, _ = run(spark, tmp_path, "30 seconds", files)
    want = wanted(events)
    assert {r.seq for r in first} < set(want)  # the last rows wait
    deliver(tmp_path, arrived[90:], 2, first=500_000)
    finish(spark, tmp_path, 10_000_000)
    rows, late = run(spark, tmp_path, "30 seconds", files)  # a restart from the checkpoint
    assert {r.seq: (r.client_id, r.driver_id, round(r.price_factor, 9)) for r in rows} == want
    assert len(rows) == len(want) and late == []


def test_late_rows_are_set_aside(spark, tmp_path):
    events = events_in_time(3, 120)
    held = [e for e in events[:40] if e["seq"] % 7 == 3]
    rest = [e for e in events if e not in held]
    deliver(tmp_path, rest, 2)
    run(spark, tmp_path, "5 seconds", 1)
    deliver(tmp_path, held, 1, first=600_000)
    finish(spark, tmp_path, 10_000_000)
    rows, late = run(spark, tmp_path, "5 seconds", 1)
    effective = {e["seq"] for e in held}
    assert {r.seq for r in late} <= effective and len(late) > 0
    assert {r.seq: (r.client_id, r.driver_id, round(r.price_factor, 9)) for r in rows} == wanted(
        [e for e in events if e["seq"] not in {r.seq for r in late}]
    )


def as_of(rows):
    out = {}
    for seq, key, op, ts, _ in rows:
        if op == "GET":
            older = [(t, s, v) for s, k, o, t, v in rows if k == key and o == "PUT" and t < ts]
            out[seq] = (key, ts, max(older)[2] if older else "0")
    return out


@pytest.mark.parametrize("per_trigger", ["1", "4"])
def test_as_of_stream_equals_all_rows(spark, tmp_path, per_trigger):
    rng = random.Random(5)
    log = [
        (k, f"k{rng.choice([0, 0, 0, 1, 2])}", rng.choice(["PUT", "GET"]), 50_000 + 100 * rng.randint(k // 4, k // 4 + 20), f"v{k}")
        for k in range(200)
    ]
    folder, out, late = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "late")
    names = [part.split()[0] for part in KV.split(", ")]

    def serve():
        stream = spark.readStream.schema(KV).option("maxFilesPerTrigger", per_trigger).json(str(folder))
        split_sink(as_of_stream(stream, "3 seconds"), out, late, str(tmp_path / "cp")).awaitTermination()

    for part in range(8):
        write(folder, f"{part}.json", [dict(zip(names, r)) for r in log[part * 25 : part * 25 + 25]])
        if part == 3:
            serve()
    write(folder, "8.json", [{"seq": -1, "key": "tick", "op": "TICK", "ts": 10_000_000}])
    write(folder, "9.json", [{"seq": -2, "key": "k0", "op": "GET", "ts": None}])
    serve()
    got = {r.seq: (r.key, r.ts, r.value) for r in spark.read.parquet(out).collect()}
    assert got == as_of(log)
    assert [(r.seq, r.value) for r in spark.read.parquet(late).collect()] == [(-2, None)]


def test_versions_behind_the_watermark_go(spark, tmp_path):
    """However many versions pass, a key's state holds those within the delay and one more."""
    folder, out, late = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "late")
    for part in range(6):
        rows = [{"seq": 50 * part + k, "key": "k", "op": "PUT", "ts": 1000 * (50 * part + k), "value": "v"} for k in range(50)]
        write(folder, f"{part}.json", rows)
    stream = spark.readStream.schema(KV).option("maxFilesPerTrigger", "1").json(str(folder))
    split_sink(as_of_stream(stream, "10 seconds"), out, late, str(tmp_path / "cp")).awaitTermination()
    state = spark.read.format("statestore").option("stateVarName", "versions").load(str(tmp_path / "cp"))
    assert 10 <= state.count() <= 13


def test_null_blocks_are_a_block_of_their_own(spark, tmp_path):
    events = [{**e, "block_id": None if e["block_id"] == 3 else e["block_id"]} for e in events_in_time(9, 90)]
    deliver(tmp_path, displaced(events, 10, 1), 2)
    finish(spark, tmp_path, 10_000_000)
    rows, late = run(spark, tmp_path, "20 seconds", 2)
    assert {r.seq: (r.client_id, r.driver_id, round(r.price_factor, 9)) for r in rows} == wanted(events) and late == []
