"""Stream processors on a state kept in plain Python: calls to the store, memory, and what they answer."""

import tracemalloc
from types import SimpleNamespace

import pandas as pd

from larkspur.operators.kvlog import MISSING
from larkspur.streaming.ordered import AsOfProcessor, OrderedMatchProcessor
from larkspur.streaming.rides import MatchProcessor


class Store:
    """States of one key; counts the calls and the values that come and go one by one."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def _state(self, kind):
        store, kept = self, {} if kind == "map" else []

        class State:
            def __getattr__(self, name):
                store.calls += 1
                return getattr(SimpleNamespace(
                    exists=lambda: bool(kept), containsKey=lambda k: k in kept,
                    get=lambda: (iter(kept) if kind == "list" else kept[0]),
                    getValue=lambda k: kept[k], removeKey=lambda k: kept.pop(k, None),
                    update=lambda v: kept.__setitem__(slice(None), [v]),
                    updateValue=lambda k, v: kept.__setitem__(k, v), iterator=lambda: iter(kept.items()),
                    appendList=lambda v: (kept.extend(v), store.add(len(v))),
                    put=lambda v: (kept.__setitem__(slice(None), v), store.add(len(v))), clear=kept.clear,
                ), name)

        return State()

    def add(self, values):
        self.calls += values

    def getValueState(self, *_):
        return self._state("value")

    def getMapState(self, *_):
        return self._state("map")

    def getListState(self, *_):
        return self._state("list")

    def registerTimer(self, at):
        self.timers.append(at)


def expire(processor, key, watermark):
    return pd.concat(
        list(processor.handleExpiredTimer(key, SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), None))
        or [pd.DataFrame({"late": []})]
    )


def deliver(processor, key, frame):
    return list(processor.handleInputRows(key, iter([frame]), None))


def test_as_of_calls_the_store_per_packet_not_per_row():
    store, processor, n = Store(), AsOfProcessor(), 2000
    processor.init(store)
    frame = pd.DataFrame({"seq": range(n), "key": "a", "op": ["PUT", "GET"] * (n // 2), "ts": range(n)})
    deliver(processor, ("a",), frame.assign(value=[str(k) for k in range(n)]))
    assert store.timers == [1]
    first = expire(processor, ("a",), 1000)
    second = expire(processor, ("a",), n + 1)
    assert dict(zip(first["seq"], first["value"])) == {k: str(k - 1) for k in range(1, 1001, 2)}
    assert dict(zip(second["seq"], second["value"])) == {k: str(k - 1) for k in range(1001, n, 2)}
    assert store.calls < 40


def test_as_of_ties_missing_values_and_late_rows():
    store, processor = Store(), AsOfProcessor()
    processor.init(store)
    rows = [(1, "GET", 5, None), (2, "PUT", 5, "a"), (4, "PUT", 7, "b"), (3, "PUT", 7, "c"), (5, "GET", 8, None),
            (6, "PUT", 9, None), (7, "GET", 10, None), (8, "GET", 7, None), (9, "GET", None, None)]
    frame = pd.DataFrame(rows, columns=["seq", "op", "ts", "value"]).assign(key="k")
    late = pd.concat(deliver(processor, ("k",), frame))
    assert list(late["seq"]) == [9] and late["late"].all()
    found = expire(processor, ("k",), 50)
    assert {s: None if pd.isna(v) else v for s, v in zip(found["seq"], found["value"])} == {
        1: MISSING, 5: "b", 7: None, 8: "a",
    }
    late = pd.concat(deliver(processor, ("k",), frame.iloc[:1]))
    assert list(late["seq"]) == [1] and late["late"].all()


def rides(n, action="move"):
    return pd.DataFrame(
        {"action": action, "party": [k % 50 for k in range(n)], "ts": range(n, 0, -1), "seq": range(n), "latitude": 1.0,
         "longitude": 2.0, "gender": ["F", None] * (n // 2), "rating": 3.0, "salary": 4.0}
    )


def test_ordered_rows_wait_in_packets():
    store, processor = Store(), OrderedMatchProcessor()
    processor.init(store)
    n = 2000
    asks = pd.DataFrame({**rides(2, "request"), "party": [7, 8], "ts": [n + 5, n + 90], "seq": [n, n + 1], "gender": "N"})
    deliver(processor, ("1",), rides(n, "put"))
    deliver(processor, ("1",), asks)
    assert store.calls < 20
    first = expire(processor, ("1",), n + 50)
    assert first[["client_id", "driver_id"]].values.tolist() == [[7, 0]]
    assert store.timers[-1] == n + 91
    assert expire(processor, ("1",), n + 100)[["client_id", "driver_id"]].values.tolist() == [[8, 10]]


def test_rows_of_a_block_take_little_more_than_their_columns():
    processor, parts, n = MatchProcessor(), 40, 5000
    processor.init(Store())
    frame = rides(n)
    tracemalloc.start()
    for _ in processor.handleInputRows(("1",), (frame.copy() for _ in range(parts)), None):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 140 * parts * n
