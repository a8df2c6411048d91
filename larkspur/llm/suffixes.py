"""Repeated byte strings over documents, by bucket-pointer refinement of suffixes that can repeat.

A byte goes when it lies in a string of ``length`` bytes that also starts in a document with a
smaller id. Sorting all suffixes would move every text many times over, so anchors choose those
that can matter: of the 16-grams in a string of ``length`` bytes, the one with the least hash.
Equal strings have equal anchors at equal places, whatever stands around them. Very common grams
are anchors only where there is no other choice.

1. Anchors meet by the hash of their gram, the first and coarsest buckets. A bucket of one document
   is done. Anchors whose whole surroundings (every string they stand for) also surround an anchor
   of a smaller document are done too: all of that repeats.
2. What is left are the edges of repeats. Their surroundings meet by bucket again, and their
   suffixes are sorted there: buckets of equal 8-grams are refined by the bucket pointers 8, 16, ...
   bytes further on, each round over the pointers that the round before has left, until suffixes of
   a bucket agree in ``length`` bytes. A suffix repeats if its bucket holds a smaller document.

Tasks send each other packed arrays. Of equal surroundings only the smallest document leaves a task,
so a passage that a third of all documents share is a row for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, free_names, map_texts, prepared, ragged, slices, table, written
from larkspur.plans.registry import Query

LENGTH = 50
GRAM = 16
#: Text handled at once while anchors are searched, so that arrays stay in the cache.
STRETCH = 1 << 17
#: Anchors that a task holds before it sends them.
HELD = 1 << 17
#: Text for each bucket range of anchors.
RANGE_BYTES = 4 << 20
#: Surroundings sorted at once.
CHUNK = 1 << 12
#: A gram with more different surroundings is met by 33 bytes instead of 16.
DEEP = 20_000
#: Documents sampled to find very common grams; these only steer the choice of anchors.
SAMPLE, COMMON_SHARE, COMMON_MOST = 20_000, 20_000, 10_000
FULL = -1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> list[np.uint64]:
    out = [0x9E3779B97F4A7C15]
    while len(out) < 4:
        out.append(out[-1] * out[-1] % 2**64)
    return [np.uint64(x) for x in out]


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the 16 bytes from each place on."""
    h = data.astype(np.uint64) + np.uint64(1)
    for k, power in enumerate(_powers()):  # 2, 4, 8, 16 bytes
        h = h[: -(1 << k)] * power + h[1 << k :]
    return _mix(h)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` consecutive values."""
    n = 1
    while 2 * n <= width:
        values = pick(values[:-n], values[n:])
        n *= 2
    return values if n == width else pick(values[: len(values) - (width - n)], values[width - n :])


class Common:
    """Grams that are anchors only where all others in reach are common too."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.sort(hashes)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        some = np.flatnonzero(found)
        if len(some):
            at = np.minimum(np.searchsorted(self.sorted, hashes[some]), len(self.sorted) - 1)
            found[some] = self.sorted[at] == hashes[some]
        return found


def anchors(texts: list[bytes], length: int, common: Common) -> tuple[np.ndarray, ...]:
    """(text, place, gram, surroundings) of the anchors in ``texts``; hashes stand for the last two."""
    out: list[tuple[np.ndarray, ...]] = []
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= STRETCH or k + 1 == len(texts):
            out.append(_anchors(held, first, length, common))
            held, size, first = [], 0, k + 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _anchors(texts: list[bytes], first: int, length: int, common: Common) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    long = sizes >= length
    if not long.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    width = length - GRAM + 1
    g = grams(data)
    order = ((g >> np.uint64(2)) + np.uint64(1)) | (common(g) * _TOP)
    least = _slide(order, width, np.minimum)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, (starts + sizes)[long] - length + 1, -1)
    inside = np.cumsum(edge)[: len(least)] > 0  # strings within one text
    pad = np.zeros(width - 1, np.uint64)
    reach = _slide(np.concatenate([pad, least * inside, pad]), width, np.maximum)
    at = np.flatnonzero(reach == order)
    row = np.searchsorted(starts, at, side="right") - 1
    low = np.maximum(at - (length - GRAM), starts[row])
    high = np.minimum(at + length, starts[row] + sizes[row])
    around = ((at - low) * 4096 + (high - at)).astype(np.uint64)
    for k in range(0, 2 * length - 2 * GRAM + GRAM, GRAM):
        around = _mix(around * _ODD + g[np.minimum(low + k, high - GRAM)])
    return row + first, at - starts[row], g[at], around


def _bytes(values: list[str | None]) -> list[bytes]:
    return [(v or "").encode("utf-8", "surrogatepass") for v in values]


_PACKED = "bucket long, gram binary, around binary, doc binary, twin binary, place binary"


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, twin, text) of rows with an id; ``twin`` tells rows of one id apart by their text."""
    text = F.col("text").cast("string")
    twin = F.pmod(F.xxhash64(text), F.lit(2**31)).cast("int")
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc"), twin.alias("twin"), text.alias("text")
    )


def common_grams(docs: DataFrame, length: int) -> np.ndarray:
    """Hashes of grams that are more than a 20,000th of the anchors in a bounded sample of documents."""
    number = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64("doc", "twin"), F.lit(max(1, number))) < SAMPLE)
    nothing = Common(np.zeros(0, np.uint64))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = anchors(_bytes(batch.column("text").to_pylist()), length, nothing)[2]
        hashes, n = np.unique(found, return_counts=True)
        return {
            "gram": np.append(hashes[n > 1].view(np.int64), 0), "n": np.append(n[n > 1], 0),
            "all": np.append(np.zeros(int((n > 1).sum()), np.int64), len(found)),
        }

    counts = written(map_texts(chosen, "gram long, n long, all long", work).groupBy("gram").agg(
        F.sum("n").alias("n"), F.sum("all").alias("all")
    ), "grams")
    total = counts.agg(F.sum("all")).first()[0] or 0
    often = counts.where(F.col("n") >= max(64, total // COMMON_SHARE)).orderBy(F.desc("n"), "gram")
    return np.array([r.gram for r in often.limit(COMMON_MOST).select("gram").collect()], np.int64).view(np.uint64)


def sent_anchors(docs: DataFrame, length: int, ranges: int, common) -> DataFrame:
    """Anchors of all documents as packed rows for each range of gram hashes.

    Rows with a negative bucket are places whose surroundings a smaller document of the same task has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seldom = Common(common.value)
        held, number = [], 0
        for batch in slices(batches):
            doc, twin = np.asarray(batch.column("doc"), np.int64), np.asarray(batch.column("twin"), np.int32)
            row, place, gram, around = anchors(_bytes(batch.column("text").to_pylist()), length, seldom)
            gram = _mix(gram * _ODD)  # anchors have the least hashes; ranges need even ones
            held.append((gram, around, doc[row], twin[row], place.astype(np.int32)))
            number += len(row)
            if number >= HELD:
                yield pack(held)
                held, number = [], 0
        if number:
            yield pack(held)

    def pack(held: list) -> pa.RecordBatch:
        gram, around, doc, twin, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((doc, around, gram))
        gram, around, doc, twin, place = (c[order] for c in (gram, around, doc, twin, place))
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])])
        later = doc > doc[new][np.cumsum(new) - 1]
        rest = [c[~later] for c in (gram, around, doc, twin, place)]
        edges = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(rest[0], edges), [len(rest[0])]])
        rows = [
            (k, *(c[a:b].tobytes() for c in rest))
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
        ]
        if later.any():
            done = [c[later].tobytes() for c in (doc, twin, place)]
            rows.append((-1 - int(doc[0]) % 997, b"", b"", *done))
        names = [p.split()[0] for p in _PACKED.split(", ")]
        return pa.RecordBatch.from_pydict(
            {n: pa.array(c, pa.binary() if k else pa.int64()) for k, (n, c) in enumerate(zip(names, zip(*rows, strict=True), strict=True))}
        )

    return docs.mapInArrow(run, _PACKED)


def _buckets(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[tuple[int, list]]:
    """(bucket, unpacked columns) of partitions sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        columns = [(batch.column(n), t) for n, t in kinds.items()]
        for k, own in enumerate(batch.column("bucket").to_pylist()):
            if own != bucket and held:
                yield bucket, [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            bucket = own
            held.append([np.frombuffer(c[k].as_buffer(), t) for c, t in columns])
    if held:
        yield bucket, [np.concatenate(c) for c in zip(*held, strict=True)]


_PLACE = "doc long, twin int, place int, gram long, deep boolean"


def met_anchors(packed: DataFrame) -> DataFrame:
    """(doc, twin, place, gram, deep) of anchors in buckets of several documents.

    A null ``gram`` marks surroundings that a smaller document has as a whole. The others are in
    buckets with different surroundings and must be looked at byte by byte.
    """
    kinds = {"gram": np.uint64, "around": np.uint64, "doc": np.int64, "twin": np.int32, "place": np.int32}

    def batch(doc, twin, place, gram, full, deep) -> pa.RecordBatch:
        arrays = [pa.array(doc), pa.array(twin), pa.array(place), pa.array(gram.view(np.int64), mask=full), pa.array(deep)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "twin", "place", "gram", "deep"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (gram, around, doc, twin, place) in _buckets(batches, kinds):
            if bucket < 0:
                yes = np.ones(len(doc), bool)
                yield batch(doc, twin, place, np.zeros(len(doc), np.uint64), yes, ~yes)
                continue
            order = np.lexsort((doc, around, gram))
            gram, around, doc, twin, place = (c[order] for c in (gram, around, doc, twin, place))
            new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
            new = new_gram | np.concatenate([[True], around[1:] != around[:-1]])
            at = np.flatnonzero(new_gram)
            of = np.cumsum(new_gram) - 1
            shared = (np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at))[of]
            kinds_of = np.add.reduceat(new.astype(np.int64), at)[of]
            full = doc > doc[new][np.cumsum(new) - 1]
            keep = shared & (full | (kinds_of > 1))
            if keep.any():
                yield batch(*(c[keep] for c in (doc, twin, place, gram, full, kinds_of > DEEP)))

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _PLACE)


_EDGES = "bucket long, key binary, doc binary, twin binary, place binary, size binary, data binary"


def sent_edges(docs: DataFrame, places: DataFrame, length: int, ranges: int) -> DataFrame:
    """Surroundings of anchors, packed for each range of bucket keys."""
    asked = places.where("gram is not null").groupBy("doc", "twin").agg(
        F.collect_list(F.struct("place", "gram", "deep")).alias("asked")
    )
    half = (length - GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in slices(batches):
            texts = _bytes(batch.column("text").to_pylist())
            doc, twin = np.asarray(batch.column("doc"), np.int64), np.asarray(batch.column("twin"), np.int32)
            asked = batch.column("asked")
            flat, counts = asked.flatten(), np.asarray(pa.compute.list_value_length(asked), np.int64)
            places, keys, deep = (np.asarray(flat.field(k)) for k in range(3))
            end = 0
            for row, text in enumerate(texts):
                start, end = end, end + int(counts[row])
                at = places[start:end].astype(np.int64)
                key = keys[start:end].view(np.uint64)
                if deep[start:end].any():  # these meet by the bytes right of the gram, and by those left of it
                    far = np.flatnonzero(deep[start:end])
                    near = np.flatnonzero(~deep[start:end])
                    extra = [(k, text[at[k] : at[k] + GRAM + half]) for k in far if at[k] + GRAM + half <= len(text)]
                    extra += [(k, b"<" + text[at[k] - half : at[k] + GRAM]) for k in far if at[k] >= half]
                    finer = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little") for _, x in extra]
                    at = np.concatenate([at[near], at[[k for k, _ in extra]]]) if extra else at[near]
                    key = np.concatenate([key[near], np.array(finer, np.uint64)])
                low, high = np.maximum(at - (length - GRAM), 0), np.minimum(at + length, len(text))
                data = np.frombuffer(text, np.uint8)
                which, k = ragged(high - low)
                held.append(
                    (key, np.full(len(at), doc[row]), np.full(len(at), twin[row], np.int32), at.astype(np.int32),
                     (high - low).astype(np.int32), data[low[which] + k])
                )
                number += len(at)
                if number >= HELD // 4:
                    yield pack(held)
                    held, number = [], 0
        if number:
            yield pack(held)

    def pack(held: list) -> pa.RecordBatch:
        key, doc, twin, place, size, data = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(key, kind="stable")
        first = np.cumsum(size) - size
        which, k = ragged(size[order])
        data = data[first[order][which] + k]
        key, doc, twin, place, size = (c[order] for c in (key, doc, twin, place, size))
        edges = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(key, edges), [len(key)]])
        ends = np.concatenate([[0], np.cumsum(size)])
        rows = [
            (k, *(c[a:b].tobytes() for c in (key, doc, twin, place, size)), data[ends[a] : ends[b]].tobytes())
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
        ]
        names = [p.split()[0] for p in _EDGES.split(", ")]
        return pa.RecordBatch.from_pydict(
            {n: pa.array(c, pa.binary() if k else pa.int64()) for k, (n, c) in enumerate(zip(names, zip(*rows, strict=True), strict=True))}
        )

    return docs.join(asked, ["doc", "twin"]).select("doc", "twin", "text", "asked").mapInArrow(run, _EDGES)


def repeats_earlier(data: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each byte of rows laid end to end: does its suffix agree in ``length`` bytes with a smaller document's?

    ``pointer`` holds, for every suffix, where its bucket begins among all suffixes in order. Buckets
    start as equal 8-grams. A round sorts the suffixes of each bucket by the pointers further on and
    leaves finer pointers for the next; suffixes alone in their bucket are not sorted again.
    """
    out = np.zeros(len(data), bool)
    row, place = ragged(sizes)
    room = sizes[row] - place
    depth = min(8, length)
    alive = np.flatnonzero(room >= depth)
    if not len(alive):
        return out
    gram = np.zeros(len(data) - depth + 1, np.uint64)
    for k in range(depth):
        gram = (gram << np.uint64(8)) | data[k : len(gram) + k]
    pointer = np.zeros(len(data), np.int64)
    ordered = alive[np.argsort(gram[alive])]
    new = np.concatenate([[True], gram[ordered[1:]] != gram[ordered[:-1]]])
    alive = _settle(pointer, ordered, new, np.zeros(len(ordered), np.int64), np.arange(len(ordered)))
    while depth < length and len(alive):
        deeper = min(2 * depth, length)
        alive = alive[room[alive] >= deeper]
        key = pointer[alive] * len(data) + pointer[alive + deeper - depth]
        order = np.argsort(key)
        ordered, key = alive[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        old = pointer[ordered]
        bucket = np.concatenate([[True], old[1:] != old[:-1]]) if len(key) else np.zeros(0, bool)
        begun = np.flatnonzero(bucket)[np.cumsum(bucket) - 1] if len(key) else np.zeros(0, np.int64)
        alive = _settle(pointer, ordered, new, old, np.arange(len(ordered)) - begun)
        depth = deeper
    alive = alive[room[alive] >= length]
    if len(alive):
        ordered = alive[np.lexsort((docs[row[alive]], pointer[alive]))]
        new = np.concatenate([[True], pointer[ordered[1:]] != pointer[ordered[:-1]]])
        owner = docs[row[ordered]]
        out[ordered] = owner > owner[new][np.cumsum(new) - 1]
    return out


def _settle(pointer: np.ndarray, ordered: np.ndarray, new: np.ndarray, old: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Write the pointers of freshly sorted suffixes; returns those that are not alone in their bucket."""
    if not len(ordered):
        return ordered
    at = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    pointer[ordered] = old + rank[at][of]
    sizes = np.diff(np.append(at, len(ordered)))
    return np.sort(ordered[sizes[of] > 1])


def met_edges(packed: DataFrame, length: int) -> DataFrame:
    """(doc, twin, place, mask): strings around each anchor, by start, that a smaller document has."""
    kinds = {"key": np.uint64, "doc": np.int64, "twin": np.int32, "place": np.int32, "size": np.int32, "data": np.uint8}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (key, doc, twin, place, size, data) in _buckets(batches, kinds):
            order = np.argsort(key, kind="stable")
            first = np.cumsum(size) - size
            key, doc, twin, place, own, first = (c[order] for c in (key, doc, twin, place, size.astype(np.int64), first))
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            start = 0
            while start < len(key):  # whole keys, about CHUNK surroundings at once
                k = np.searchsorted(heads, start + CHUNK, side="right") - 1
                stop = int(heads[k]) if heads[k] > start else int(heads[k + 1]) if k + 1 < len(heads) else len(key)
                stop = len(key) if start + CHUNK >= len(key) else stop
                sizes = own[start:stop]
                which, at = ragged(sizes)
                hit = repeats_earlier(data[first[start:stop][which] + at], sizes, doc[start:stop], length)
                words = -(-(length - GRAM + 1) // 32)
                masks = np.zeros((stop - start, words), np.int64)
                found = np.flatnonzero(hit)
                np.bitwise_or.at(masks, (which[found], at[found] // 32), np.int64(1) << (at[found] % 32))
                some = np.flatnonzero(masks.any(axis=1))
                if len(some):
                    ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[start:stop][some]), pa.array(twin[start:stop][some]), pa.array(place[start:stop][some]),
                         pa.ListArray.from_arrays(ends, pa.array(masks[some].ravel()))],
                        names=["doc", "twin", "place", "mask"],
                    )
                start = stop

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc long, twin int, place int, mask array<long>")


def spans_of(size: int, places: np.ndarray, masks: list[list[int] | None], length: int) -> list[int]:
    """Start, end, start, end, ... of the bytes that the marked strings cover in a text of ``size`` bytes."""
    edge = np.zeros(size + 1, np.int64)
    for place, mask in zip(places.tolist(), masks, strict=True):
        low = max(place - (length - GRAM), 0)
        if mask is None:
            edge[low] += 1
            edge[min(place + length, size)] -= 1
            continue
        for k, word in enumerate(mask):
            while word:
                at = low + 32 * k + (word & -word).bit_length() - 1
                edge[at] += 1
                edge[at + length] -= 1
                word &= word - 1
    covered = np.cumsum(edge) > 0
    return np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(np.int8))).tolist()


@contextmanager
def lean(spark: SparkSession):
    """Within it, shuffle files go when their query ends, since its result is read from files anyway,
    and tasks get few rows at once: packed ones are large."""
    own = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "128",
    }
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _marked(docs: DataFrame, length: int) -> tuple[DataFrame, str]:
    """``docs`` with the marks of each row in a column of the returned name; written work is done by then."""
    if length < 2 * GRAM:
        raise ValueError(f"strings must have {2 * GRAM} bytes at least")
    spark = prepared(docs.sparkSession)
    plain = _documents(docs)
    with lean(spark):
        common = spark.sparkContext.broadcast(common_grams(plain, length))
        total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(8, -(-total // RANGE_BYTES))
        places = written(met_anchors(sent_anchors(plain, length, ranges, common)), "anchors")
        edges = written(met_edges(sent_edges(plain, places, length, max(8, ranges // 2)), length), "edges")
        full = places.where("gram is null").select("doc", "twin", "place", F.lit(None).cast("array<long>").alias("mask"))
        marks = full.unionByName(edges).groupBy("doc", "twin").agg(
            F.collect_list(F.struct("place", "mask")).alias("marks")
        )
        marks = written(marks, "marks")
    doc, twin, found = free_names(docs, "doc", "twin", "marks")
    marks = marks.select(F.col("doc").alias(doc), F.col("twin").alias(twin), F.col("marks").alias(found))
    mine = F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(2**31)).cast("int")
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (mine == F.col(twin))
    return docs.join(marks, same, "left").drop(doc, twin), found


def _rows(batch: pa.RecordBatch, found: str, length: int) -> Iterator[tuple[bytes, list[int]]]:
    """The UTF-8 of each text of a batch and its spans."""
    for value, marked in zip(batch.column("text").to_pylist(), batch.column(found).to_pylist(), strict=True):
        data = (value or "").encode("utf-8", "surrogatepass")
        places = np.array([m["place"] for m in marked or ()], np.int64)
        yield data, spans_of(len(data), places, [m["mask"] for m in marked], length) if marked else []


def repeated_bytes(docs: DataFrame, length: int = LENGTH, spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: start, end, ... of the bytes that strings of earlier documents cover.

    A string counts if it has ``length`` bytes (32 at least) of UTF-8 and also starts in a document with
    a smaller doc_id; strings are judged on the texts as given and may overlap. Rows without an id
    neither give nor lose anything; rows of one id do not take from each other, repeated rows get
    equal spans. Null, empty and short texts have none. Other columns pass through; one named as
    ``spans`` is replaced. An empty table stays empty.
    """
    marked, found = _marked(docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != spans.lower())), length)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        return {spans: [s for _, s in _rows(batch, found, length)]}

    return add_columns(marked, f"`{spans}` array<int>", work, (found,))


def kept_bytes(data: bytes, spans: list[int]) -> bytes:
    """``data`` without ``spans``."""
    edges = [0, *spans, len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated bytes cut out of the texts; halves of characters at the cuts go as well."""
    marked, found = _marked(docs, length)
    (cut,) = free_names(marked, "cut")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column("text").to_pylist()
        rows = zip(texts, _rows(batch, found, length), strict=True)
        return {cut: [kept_bytes(data, s).decode("utf-8", "ignore") if s else t for t, (data, s) in rows]}

    made = add_columns(marked, f"`{cut}` string", work, ("text", found))
    new = {"text": F.col(cut), "n_chars": F.coalesce(F.char_length(cut), F.lit(0)).cast("long")}
    return made.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and a digest of those that stay."""
    marked, found = _marked(table(prepared(spark), sf_dir, "documents").select("doc_id", "text"), LENGTH)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sizes, removed, digests, number = [], [], [], []
        for data, spans in _rows(batch, found, LENGTH):
            sizes.append(len(data))
            removed.append(sum(spans[1::2]) - sum(spans[::2]))
            number.append(len(spans) // 2)
            digests.append(hashlib.sha256(kept_bytes(data, spans)).hexdigest())
        return {"n_bytes": sizes, "n_removed": removed, "n_spans": number, "kept_sha256": digests}

    ddl = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return add_columns(marked, ddl, work, ("text", found))


_SQL = """
WITH data AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (
  SELECT k, doc_id, i, substring(x, 2 * i + 1, 100) AS s
  FROM (SELECT k, doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM data WHERE length(x) >= 100)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
met AS (SELECT k, i FROM strings JOIN firsts USING (s) WHERE doc_id > first),
breaks AS (SELECT k, i, CASE WHEN i <= lag(i) OVER (PARTITION BY k ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM met),
numbered AS (SELECT k, i, sum(fresh) OVER (PARTITION BY k ORDER BY i) AS run FROM breaks),
runs AS (SELECT k, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY k, run),
gaps AS (
  SELECT k, a AS stop, coalesce(lag(b) OVER (PARTITION BY k ORDER BY a), 0) AS start FROM runs
  UNION ALL
  SELECT data.k, length(x) // 2, coalesce(max(b), 0) FROM data LEFT JOIN runs USING (k) GROUP BY data.k, x),
kept AS (
  SELECT k, string_agg(substring(x, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS rest FROM gaps JOIN data USING (k) GROUP BY k),
sums AS (SELECT k, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY k)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM data JOIN kept USING (k) LEFT JOIN sums USING (k)
"""

QUERIES = {"op13_suffixes": Query(op13_suffixes, _SQL)}
