"""Timelines that follow new posts and new links: newest posts per reader, kept by a stream.

Two keyed steps. An author's state holds the newest k posts and, while they are few, the followers;
a new post goes to each of them. An author with more followers than ``celebrity`` is read instead of
written: the followers are told once, and from then on a post costs one row in the author's own
state however many follow. A reader's state holds the newest k posts received and the celebrities
followed; the timeline is the newest k of both. A post beyond its author's newest k can be in no
timeline, and one beyond a reader's newest k never comes back, so both states stay bounded.

Authors and readers are dealt to groups. Rows come to a group in packets of columns, and its state is such
a packet, as a call to the state store or a Python object for each author, reader or post costs more than
all else. Readers keep places of posts; texts stay with the authors.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from larkspur.functions.dates import post_time
from larkspur.session import scratch_path, ship_package
from larkspur.streaming.rides import AVAILABLE

K = 30
#: Followers up to which a post is written to each of them.
CELEBRITY = 10_000

_SENT = "user_id bigint, uid bigint, pid bigint, at bigint, timestamp string, content string"
_POST = "at: bigint, timestamp: string, content: string"


#: Groups that authors and readers are dealt to. A checkpoint goes on with the number it began with.
GROUPS = 512
#: Rows sent at a time, about.
STEP = 1 << 16
#: Rows that a task holds to pack them, and posts of a group of readers before the old ones go.
HELD = 1 << 18

_WRITTEN = pa.schema({"uid": pa.int64(), "pid": pa.int64(), "at": pa.int64(), "timestamp": pa.string(), "content": pa.string()})
_LINKS = pa.schema({"uid": pa.int64(), "user_id": pa.int64()})
_INBOX = pa.schema({"user_id": pa.int64(), "uid": pa.int64(), "pid": pa.int64(), "at": pa.int64()})
_ROWS = pa.schema([pa.field("user_id", pa.int64()), *_WRITTEN])

_sent = Row(*(part.split()[0] for part in _SENT.split(", ")))


def _age(post: tuple) -> tuple:
    """(id, at, ...) from newest to oldest: unreadable times last, then by id."""
    return (post[1] is None, -(post[1] or 0), post[0])


class AuthorProcessor(StatefulProcessor):
    """Newest posts and followers of an author; sends posts to followers, or names itself to be read.

    The rules of one author, to which ``AuthorGroups`` is held by tests. Each variable is one value, read and written once for a delivery: a call to the state store for
    each post or follower costs more than all else.
    """

    def __init__(self, k: int = K, celebrity: int = CELEBRITY) -> None:
        self.k, self.celebrity = k, celebrity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", f"posts array<struct<pid: bigint, {_POST}>>")
        self.links = handle.getValueState("links", "followers binary, pulled boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        uid = key[0]
        new, added = {}, {}
        for row in rows:
            if row.user_id is not None:
                added[row.user_id] = True
            elif row.pid is not None:
                new[row.pid] = (row.pid, row.at, row.timestamp, row.content)
        stored = self.links.get()
        old, pulled = (array("q", bytes(stored[0])), stored[1]) if stored else (array("q"), False)

        known = _posts(self.recent)
        kept = sorted([p for p in known if p[0] not in new] + list(new.values()), key=_age)[: self.k]
        fresh = [p for p in kept if p[0] in new]
        if fresh:
            self.recent.update((kept,))

        if pulled:
            yield from (_sent(reader, uid, None, None, None, None) for reader in added)
            return
        if added:
            followed = set(old)
            added = [reader for reader in added if reader not in followed]
        if len(old) + len(added) > self.celebrity:
            self.links.update((b"", True))
            yield from (_sent(reader, uid, None, None, None, None) for reader in (*old, *added))
            return
        if added:
            self.links.update(((old + array("q", added)).tobytes(), False))
            yield from (_sent(reader, uid, *post) for reader in added for post in kept)
        yield from (_sent(reader, uid, *post) for reader in old for post in fresh)


class ReaderProcessor(StatefulProcessor):
    """Newest posts that a reader has received, and the authors whose posts the reader looks up.

    The rules of one reader, to which ``ReaderGroups`` is held by tests.
    """

    def __init__(self, k: int = K) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inbox = handle.getValueState("inbox", f"posts array<struct<uid: bigint, pid: bigint, {_POST}>>")
        self.pulls = handle.getValueState("pulls", "uids array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        new, asked = {}, set()
        for row in rows:
            if row.pid is None:
                asked.add(row.uid)
            else:
                new[row.uid, row.pid] = (row.uid, row.pid, row.at, row.timestamp, row.content)
            if len(new) >= 1000 + self.k:  # what is not among the k newest now never will be
                new = {p[:2]: p for p in sorted(new.values(), key=_inbox_age)[: self.k]}
        if asked:
            stored = self.pulls.get()
            known = set(stored[0]) if stored else set()
            if not asked <= known:
                self.pulls.update((sorted(known | asked),))
        if new:
            merged = {p[:2]: p for p in _posts(self.inbox)} | new
            self.inbox.update((sorted(merged.values(), key=_inbox_age)[: self.k],))
        return iter(())


def _posts(state: Any) -> list[tuple]:
    """Posts kept in a value of one array."""
    stored = state.get()
    return [tuple(post) for post in stored[0]] if stored else []


def _inbox_age(post: tuple) -> tuple:
    """(uid, pid, at, ...) from newest to oldest, as ``_age``, then by author."""
    return (*_age(post[1:]), post[0])


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes | None, schema: pa.Schema) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all() if raw else schema.empty_table()


def packets(rows: DataFrame, key: str, groups: int, schema: pa.Schema) -> DataFrame:
    """(group, rows): the rows of a group, by hash of ``key``, that a task has read together, as one packet."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        group = table["group"].to_numpy()
        order = np.argsort(group, kind="stable")
        table, group = table.select(schema.names).cast(schema).take(pa.array(order)).combine_chunks(), group[order]
        first = np.flatnonzero(_heads(group))
        sizes = np.diff(np.append(first, len(group)))
        raw = [_packed(table.slice(low, n)) for low, n in zip(first, sizes, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(group[first], pa.int32()), pa.array(raw, pa.binary())], ["group", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    group = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("group")
    return rows.select(group, *schema.names).mapInArrow(run, "group int, rows binary")


def _joined(parts: list[pa.Table], schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *parts]).combine_chunks()


def _newest(posts: pa.Table, owner: str, k: int) -> np.ndarray:
    """Places of each owner's k newest posts, by owner and age; of a post that is repeated the last counts."""
    own, uid, pid = (posts[c].to_numpy() for c in (owner, "uid", "pid"))
    undated = posts["at"].is_null().to_numpy()
    at = posts["at"].fill_null(0).to_numpy()
    order = np.lexsort((pid, uid, own))
    last = order[_heads(own[order][::-1], uid[order][::-1], pid[order][::-1])[::-1]]
    order = last[np.lexsort((uid[last], pid[last], -at[last], undated[last], own[last]))]
    first = np.flatnonzero(_heads(own[order]))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Marks rows that differ from the row before in any column."""
    head = np.ones(len(columns[0]), bool)
    if len(head):
        head[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return head


def _pairs(first: pa.Table, second: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Distinct rows of two tables of pairs in order, and which of them only ``second`` has."""
    rows = _joined([first, second], _LINKS)
    one, two = (rows[c].to_numpy() for c in _LINKS.names)
    order = np.lexsort((two, one))
    order = order[_heads(one[order], two[order])]
    return rows.take(pa.array(order)), order >= len(first)


class AuthorGroups(StatefulProcessor):
    """``AuthorProcessor`` for all authors of a group at once."""

    def __init__(self, k: int = K, celebrity: int = CELEBRITY) -> None:
        self.k, self.celebrity = k, celebrity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "posts binary")
        self.links = handle.getValueState("links", "followers binary, pulled binary")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        came = _joined([_unpacked(raw, _ROWS) for frame in rows for raw in frame["rows"]], _ROWS)
        link = came["user_id"].is_valid()
        new, added = came.filter(pc.invert(link)).select(_WRITTEN.names), came.filter(link).select(_LINKS.names)
        known = _unpacked((self.recent.get() or (None,))[0], _WRITTEN)
        posts = _joined([known, new], _WRITTEN)
        kept = _newest(posts, "uid", self.k)
        posts, fresh = posts.take(pa.array(kept)), kept >= len(known)
        if fresh.any():
            self.recent.update((_packed(posts),))

        stored = self.links.get() or (None, None)
        old, pulled = _unpacked(stored[0], _LINKS), np.frombuffer(stored[1] or b"", np.int64)
        added = _pairs(_LINKS.empty_table(), added)[0]
        read = np.isin(added["uid"].to_numpy(), pulled)
        links, late = _pairs(old, added.filter(pa.array(~read)))
        uids, counts = np.unique(links["uid"].to_numpy(), return_counts=True)
        many = uids[counts > self.celebrity]
        turned = np.isin(links["uid"].to_numpy(), many)
        told = _joined([added.filter(pa.array(read)), links.filter(pa.array(turned))], _LINKS)
        links, late = links.filter(pa.array(~turned)), late[~turned]
        if late.any() or len(many):
            self.links.update((_packed(links), np.union1d(pulled, many).astype(np.int64).tobytes()))
        yield from _frames(_told(told))
        yield from _frames(_spread(links.filter(pa.array(late)), posts))
        if fresh.any():
            yield from _frames(_spread(links.filter(pa.array(~late)), posts.filter(pa.array(fresh))))


def _frames(tables: Iterator[pa.Table]) -> Iterator[pd.DataFrame]:
    for table in tables:
        yield table.combine_chunks().to_pandas(types_mapper=pd.ArrowDtype)


def _told(links: pa.Table) -> Iterator[pa.Table]:
    """Rows that tell followers to look an author's posts up."""
    for k in range(0, len(links), STEP):
        some = links.slice(k, STEP)
        columns = [some[f.name] if f.name in _LINKS.names else pa.nulls(len(some), f.type) for f in _ROWS]
        yield pa.Table.from_arrays(columns, schema=_ROWS)


def _spread(links: pa.Table, posts: pa.Table) -> Iterator[pa.Table]:
    """Each post to each follower of its author; both tables are in the order of authors."""
    if not len(links) or not len(posts):
        return
    of, authors = links["uid"].to_numpy(), posts["uid"].to_numpy()
    first = np.searchsorted(authors, of, "left")
    many = np.searchsorted(authors, of, "right") - first
    cuts = np.flatnonzero(_heads(np.cumsum(many) // STEP))
    for low, high in zip(cuts, [*cuts[1:], len(of)], strict=True):
        n = many[low:high]
        if not n.sum():
            continue
        start = first[low:high] - np.cumsum(n) + n
        some = posts.take(pa.array(np.repeat(start, n) + np.arange(n.sum())))
        readers = pa.array(np.repeat(links["user_id"].to_numpy()[low:high], n))
        yield some.add_column(0, "user_id", readers)


class ReaderGroups(StatefulProcessor):
    """``ReaderProcessor`` for all readers of a group at once, without the texts of posts."""

    def __init__(self, k: int = K) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inbox = handle.getValueState("inbox", "posts binary")
        self.pulls = handle.getValueState("pulls", "pairs binary")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        new, asked, held, size = _INBOX.empty_table(), [], [], 0

        def newest(*posts: pa.Table) -> pa.Table:
            table = _joined([*posts], _INBOX)
            return table.take(pa.array(_newest(table, "user_id", self.k)))

        for part in (_unpacked(raw, _INBOX) for frame in rows for raw in frame["rows"]):
            pull = part["pid"].is_null()
            asked.append(part.filter(pull).select(_LINKS.names))
            held.append(part.filter(pc.invert(pull)))
            size += len(held[-1])
            if size >= HELD:  # what is not among the k newest now never will be
                new, held, size = newest(new, *held), [], 0
        if size or len(new):
            self.inbox.update((_packed(newest(_unpacked((self.inbox.get() or (None,))[0], _INBOX), new, *held)),))
        asked = _joined(asked, _LINKS)
        if len(asked):
            pairs, late = _pairs(_unpacked((self.pulls.get() or (None,))[0], _LINKS), asked)
            if late.any():
                self.pulls.update((_packed(pairs),))
        return iter(())


def fan_out(
    posts: DataFrame, follows: DataFrame, k: int = K, celebrity: int = CELEBRITY, groups: int = GROUPS
) -> DataFrame:
    """Rows (user_id, uid, pid, at, timestamp, content) that new posts and links send to readers.

    ``posts(uid, pid, timestamp, content)`` and ``follows(src, dst)`` are streams. A row without
    ``pid`` tells a reader to look the author's posts up. Repeated posts and links change nothing;
    rows without an author, post or reader are left out.
    """
    ship_package(posts.sparkSession)
    wrote = posts.where("uid IS NOT NULL AND pid IS NOT NULL").select(
        F.col("uid").cast("bigint").alias("uid"), F.lit(None).cast("bigint").alias("user_id"),
        F.col("pid").cast("bigint").alias("pid"), post_time("timestamp").cast("bigint").alias("at"),
        "timestamp", "content",
    )
    joined = follows.where("src IS NOT NULL AND dst IS NOT NULL").select(
        F.col("dst").cast("bigint").alias("uid"), F.col("src").cast("bigint").alias("user_id")
    )
    dealt = packets(wrote.unionByName(joined, allowMissingColumns=True), "uid", groups, _ROWS)
    return dealt.groupBy("group").transformWithStateInPandas(
        AuthorGroups(k, celebrity), outputStructType=_SENT, outputMode="Append", timeMode="None"
    )


def timelines_query(
    posts: DataFrame,
    follows: DataFrame,
    checkpoint: str | None = None,
    k: int = K,
    celebrity: int = CELEBRITY,
    trigger: Mapping[str, Any] = AVAILABLE,
    groups: int = GROUPS,
) -> tuple[StreamingQuery, str]:
    """Start the stream that keeps all timelines; its checkpoint is what ``timelines_at`` reads."""
    checkpoint = checkpoint or scratch_path(posts.sparkSession, "timelines")
    sent = fan_out(posts, follows, k, celebrity, groups)
    dealt = packets(sent, "user_id", groups, _INBOX)
    kept = dealt.groupBy("group").transformWithStateInPandas(
        ReaderGroups(k), outputStructType=_SENT, outputMode="Append", timeMode="None"
    )
    query = kept.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(**trigger).start()
    return query, checkpoint


def _variable(spark: SparkSession, checkpoint: str, name: str, schema: pa.Schema) -> DataFrame:
    """Rows of the state variable ``name``, whichever step holds it."""
    steps = spark.read.format("state-metadata").load(checkpoint)
    step = steps.where(F.col("operatorProperties").contains(f'"{name}"')).select("operatorId").first()[0]
    reader = spark.read.format("statestore").option("stateVarName", name).option("operatorId", step)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                yield from _unpacked(raw.as_py(), schema).to_batches(STEP)

    ddl = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in schema)
    return reader.load(checkpoint).select("value.*").mapInArrow(unpack, ddl)


def timelines_at(
    spark: SparkSession, checkpoint: str, ids: DataFrame | None = None, k: int = K
) -> DataFrame:
    """(user_id, position, uid, pid, timestamp, content): the k newest followee posts of each reader.

    The result of ``social.timeline_posts`` over all posts and links the stream has taken. Posts of
    celebrities are looked up in their authors' state, one join for all readers.
    """
    ship_package(spark)
    inbox = _variable(spark, checkpoint, "inbox", _INBOX)
    pulls = _variable(spark, checkpoint, "pulls", _LINKS)
    if ids is not None:
        wanted = ids.select("user_id").distinct()
        inbox, pulls = (part.join(wanted, "user_id", "left_semi") for part in (inbox, pulls))
    recent = _variable(spark, checkpoint, "recent", _WRITTEN)
    # what a reader received before an author became a celebrity is in the author's state too, or old
    received = inbox.join(pulls, ["user_id", "uid"], "left_anti")
    both = received.unionByName(pulls.join(recent.select("uid", "pid", "at"), "uid").select(*received.columns))
    newest = Window.partitionBy("user_id").orderBy(F.desc_nulls_last("at"), "pid")
    shown = Window.partitionBy("user_id").orderBy(F.asc_nulls_first("at"), "pid")
    places = (
        both.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k)
        .withColumn("position", F.row_number().over(shown))
    )
    # a post among a reader's newest is among its author's newest
    return places.join(recent.drop("at"), ["uid", "pid"]).select(
        "user_id", "position", "uid", "pid", "timestamp", "content"
    )
