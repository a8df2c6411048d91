import json
import os

import pytest

from larkspur.operators.kvlog import kv_latest
from larkspur.operators.rides import available_drivers, driver_state, split_trace
from larkspur.sources.files import read_trace
from larkspur.streaming.rides import (
    checked_origin,
    match_sink,
    match_stream,
    ride_stream,
    split_stream,
)
from larkspur.streaming.tables import (
    changes_sink,
    current_rows,
    driver_state_stream,
    kv_latest_stream,
)
from tests.replay import replay
from tests.test_rides import frame, make_events


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def run(spark, tmp_path, out, consume=True, surge=True):
    """Both topics as file streams, one file per micro-batch, one checkpoint for all calls."""
    def topic(name):
        return read_trace(spark, str(tmp_path / name), stream=True, maxFilesPerTrigger="1")

    matches = match_stream(ride_stream(topic("locations"), topic("events")), consume)
    query = match_sink(matches, str(tmp_path / out), surge, checkpoint=str(tmp_path / f"cp-{out}"))
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / out)).collect()


def deliver(tmp_path, name, events):
    for topic, wanted in (("locations", True), ("events", False)):
        write(tmp_path / topic, name, [e for e in events if (e["type"] == "DRIVER_LOCATION") == wanted])


@pytest.mark.parametrize("consume", [True, False])
def test_stream_equals_replay_across_batches_and_restart(spark, tmp_path, consume):
    events = make_events(seed=19, n=240)
    want = {r["seq"]: (r["client_id"], r["driver_id"], round(r["price"], 9))
            for r in replay(events, consume)[0] if r["driver_id"] is not None}
    deliver(tmp_path, "1.json", events[:80])
    first = run(spark, tmp_path, "out", consume)
    assert {r.seq for r in first} == {s for s in want if s < 80}
    deliver(tmp_path, "2.json", events[80:160])
    run(spark, tmp_path, "out", consume)
    deliver(tmp_path, "3.json", events[160:])
    rows = run(spark, tmp_path, "out", consume)
    assert {r.seq: (r.client_id, r.driver_id, round(r.price_factor, 9)) for r in rows} == want
    assert len(rows) == len(want)


def test_unknown_stream_is_rejected(spark):
    df = spark.createDataFrame([("elsewhere",)], "origin string")
    with pytest.raises(Exception, match="unexpected input stream"):
        checked_origin(df).collect()


def test_split_stream(spark, tmp_path):
    events = make_events(n=90)
    for i in range(3):
        write(tmp_path / "in", f"{i}.json", events[i * 30:(i + 1) * 30])
    stream = read_trace(spark, str(tmp_path / "in"), stream=True, maxFilesPerTrigger="1")
    split_stream(stream, str(tmp_path / "l"), str(tmp_path / "e"), str(tmp_path / "cp")).awaitTermination()
    for path, part in zip("le", split_trace(frame(spark, events))):
        got = sorted(r.seq for r in spark.read.parquet(str(tmp_path / path)).collect())
        assert got == sorted(r.seq for r in part.collect())


def table_of(spark, stream, tmp_path, *keys):
    changes_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "out"))
    assert changes.select("batch").distinct().count() == 3
    return current_rows(changes, *keys)


def test_driver_table_stream_equals_batch(spark, tmp_path):
    events = make_events(n=300)
    for i in range(3):
        write(tmp_path / "in", f"{i}.json", events[i * 100:(i + 1) * 100])
    stream = read_trace(spark, str(tmp_path / "in"), stream=True, maxFilesPerTrigger="1")
    got = available_drivers(table_of(spark, driver_state_stream(stream), tmp_path, "block_id", "driver_id"))
    assert set(got.collect()) == set(driver_state(frame(spark, events)).collect())


def test_latest_values_stream_equals_batch(spark, tmp_path):
    rows = [{"seq": i, "key": f"k{i % 4}", "op": "PUT", "value": f"v{i}", "ts": (i * 37) % 11} for i in range(60)]
    for i in range(3):
        write(tmp_path / "in", f"{i}.json", rows[i * 20:(i + 1) * 20])
    schema = "seq bigint, key string, op string, value string, ts bigint"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").json(str(tmp_path / "in"))
    batch = kv_latest(spark.read.schema(schema).json(str(tmp_path / "in")))
    got = table_of(spark, kv_latest_stream(stream), tmp_path, "key").select("key", "value", "ts")
    assert set(got.collect()) == set(batch.select("key", "value", "ts").collect())


STREAMS = {
    "kv_latest_stream": "kv_latest", "driver_state_stream": "driver_state", "match_reuse_stream": "match_reuse",
    "match_sink": "match_consume", "match_sink_surge": "match_surge", "stream_in": None,
}


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_entries_on_a_table_of_many_files(spark, tmp_path, monkeypatch, name):
    """A folder of part files, read in several micro-batches, gives the batch answer."""
    from __spark_entry__ import queries
    from larkspur.plans import tables

    monkeypatch.setattr(tables, "FILES_PER_TRIGGER", 1)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = tmp_path / "sf" / "events.parquet"
    folder.mkdir(parents=True)
    for k in range(3):
        part = events.filter(f"event_id >= {k * 400} and event_id < {(k + 1) * 400}").coalesce(1)
        part.write.parquet(str(tmp_path / f"part{k}"))
        (file,) = (tmp_path / f"part{k}").glob("*.parquet")
        (folder / f"part-{k}.parquet").write_bytes(file.read_bytes())
        os.utime(folder / f"part-{k}.parquet", (1000 + k, 1000 + k))
    got = queries()[name](spark, str(tmp_path / "sf"))
    if STREAMS[name]:
        want = queries()[STREAMS[name]](spark, str(tmp_path / "sf")).select(*got.columns)
    else:
        want = queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_messages_and_compaction(spark, tmp_path):
    from larkspur.sources.messages import decode_messages
    from larkspur.streaming.tables import compact_changes, rows_since

    events = make_events(n=200)
    for i in range(2):
        write(tmp_path / "in", f"{i}.json", events[i * 100:(i + 1) * 100])

    def tagged():
        stream = read_trace(spark, str(tmp_path / "in"), stream=True, maxFilesPerTrigger="1")
        return ride_stream(*split_trace(stream))

    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    match_sink(match_stream(tagged()), plain).awaitTermination()
    match_sink(match_stream(tagged()), keyed, format="json", messages=True).awaitTermination()
    sent = spark.read.schema("key string, value string").json(keyed)
    back = decode_messages(sent, "seq bigint, client_id bigint, driver_id bigint")
    assert set(back.collect()) == set(spark.read.parquet(plain).collect())
    query = match_sink(match_stream(tagged()), str(tmp_path / "on"), trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()

    changes = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (1, "c", 1), (3, "d", 2)], "k int, v string, batch int")
    base = str(tmp_path / "base")
    compact_changes(changes.filter("batch < 2"), base, "k")
    assert set(rows_since(spark, base, changes, "k").collect()) == set(current_rows(changes, "k").collect())
