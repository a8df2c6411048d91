"""Groups of authors and readers against the rules of one, and how often they call the state store."""

import random
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row

from larkspur.streaming import timelines
from larkspur.streaming.timelines import AuthorGroups, AuthorProcessor, ReaderGroups, ReaderProcessor

COLUMNS = ["user_id", "uid", "pid", "at", "timestamp", "content"]


class Value:
    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def started(processor):
    made = []
    processor.init(SimpleNamespace(getValueState=lambda name, schema: made.append(Value()) or made[-1]))
    return processor, made


def packets(rows, size):
    """A frame of packets of at most ``size`` rows."""
    schema = pa.schema([f for f in timelines._ROWS][: len(rows[0]) if rows else 4])
    tables = [pa.table(list(map(list, zip(*rows[k : k + size]))), schema=schema) for k in range(0, len(rows), size)]
    return iter([pd.DataFrame({"rows": [timelines._packed(t) for t in tables]})])


def plain(frames):
    """Rows of frames, missing values as None."""
    return [tuple(None if pd.isna(v) else v for v in r) for f in frames for r in f[COLUMNS].itertuples(index=False)]


def deliveries(seed):
    rng = random.Random(seed)
    for step in range(4):
        posts = []
        for n in range(rng.choice([0, 30])):
            at = rng.choice([None, rng.randint(-3, 3), (1 << 60) + 1])
            posts.append((rng.choice([1, 1, 2, 3]), 100 * step + n, at, None if n % 7 == 0 else f"t{at}", f"p{n}"))
        links = [(rng.choice([1, 2, 2, 3, 4]), rng.choice([rng.randint(10, 30), (1 << 60) + 1])) for _ in range(9)]
        yield posts, links


@pytest.mark.parametrize("seed", range(6))
def test_groups_follow_the_rules_of_one(seed, monkeypatch):
    monkeypatch.setattr(timelines, "STEP", 16)
    monkeypatch.setattr(timelines, "HELD", 50)
    authors, authors_state = started(AuthorGroups(4, 7))
    readers, readers_state = started(ReaderGroups(4))
    each, inboxes = {}, {}
    row = Row(*COLUMNS)
    for posts, links in deliveries(seed):
        rows = [(None, *p) for p in posts] + [(r, u, *[None] * 4) for u, r in links]
        sent = plain(authors.handleInputRows((0,), packets(rows, 20), None))
        want = []
        for uid in {r[0] for r in [*posts, *links]}:
            rows = [row(None, *p) for p in posts if p[0] == uid] + [row(r, u, *[None] * 4) for u, r in links if u == uid]
            one = each.setdefault(uid, started(AuthorProcessor(4, 7))[0])
            want += [tuple(r) for r in one.handleInputRows((uid,), iter(rows), None)]
        assert sorted(sent, key=str) == sorted(want, key=str)
        assert list(readers.handleInputRows((0,), packets([r[:4] for r in sent], 40), None)) == []
        for reader in {r[0] for r in sent}:
            one = inboxes.setdefault(reader, started(ReaderProcessor(4)))[0]
            list(one.handleInputRows((reader,), (row(*r) for r in sent if r[0] == reader), None))
    kept = pa.ipc.open_stream(readers_state[0].value[0]).read_all().to_pylist() if readers_state[0].value else []
    want = [(r, *p[:3]) for r, (_, s) in inboxes.items() if s[0].value for p in s[0].value[0]]
    assert sorted((tuple(p.values()) for p in kept), key=str) == sorted(want, key=str)
    pulled = pa.ipc.open_stream(readers_state[1].value[0]).read_all().to_pylist() if readers_state[1].value else []
    want = [(u, r) for r, (_, s) in inboxes.items() if s[1].value for u in s[1].value[0]]
    assert sorted(tuple(p.values()) for p in pulled) == sorted(want)


def test_many_authors_cost_few_calls_to_the_state():
    (authors, one), (readers, two) = started(AuthorGroups()), started(ReaderGroups())
    rows = [(None, u, u, 1, "t", "c") for u in range(500)] + [(7, u, None, None, None, None) for u in range(500)]
    assert len(plain(authors.handleInputRows((0,), packets(rows, 300), None))) == 500
    rows = [(u, 1, None, None) for u in range(500)] + [(u, 1, 0, 1) for u in range(500)]
    list(readers.handleInputRows((0,), packets(rows, 300), None))
    assert sum(v.calls for v in one + two) <= 8


def test_rows_of_a_group_come_in_few_packets(spark):
    rows = spark.range(4000).selectExpr("id AS user_id", "1L AS uid", "if(id % 9 = 0, NULL, id) AS pid", "id AS at").coalesce(1)
    dealt = timelines.packets(rows, "user_id", 16, timelines._INBOX).collect()
    assert len(dealt) == len({r.group for r in dealt}) == 16
    got = [tuple(r.values()) for d in dealt for r in pa.ipc.open_stream(d.rows).read_all().to_pylist()]
    assert sorted(got) == sorted(map(tuple, rows.collect()))
