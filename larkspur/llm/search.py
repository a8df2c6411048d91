"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of similar size form blocks. A block is a bit matrix: one row for each hash slot, one
column for each document. A term sets K slots of its document, and again for each threshold that
its number of occurrences reaches. The AND of a term's rows is a bitmap of the documents that may
hold it so often: none is missed, a few are named in vain. Weighted sums of these bitmaps, one for
each threshold, bound the score of every document for an item from above.

The documents with the highest bounds are scored exactly; the last of the best of them is a score
that any other document must reach. All documents whose bound reaches it are then scored exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import map_texts, prepared, ragged, table, written
from larkspur.llm.contamination import normal_words
from larkspur.plans.registry import Query

TOP = 20
#: Slots of a term, and slots of a block for each term of its largest document.
SLOTS, SPACE = 4, 12
#: Documents in a block.
BLOCK = 512
#: Numbers of occurrences that have slots of their own.
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
#: Words of items that are searched for at once; more items take several passes over the blocks.
ITEM_WORDS = 200_000
#: Bounds held in a task before they are cut to the best of each item.
HELD = 1 << 19
#: Pairs of items and documents to score that are sent to all tasks; more are joined.
SENT_PAIRS = 500_000
NO_ID = np.iinfo(np.int64).max  # null ids come last


def slots(hashes: np.ndarray, step: int, width: int) -> np.ndarray:
    """(SLOTS, terms): the rows that a term sets when it occurs STEPS[step] times."""
    out = np.empty((SLOTS, len(hashes)), np.int64)
    for k in range(SLOTS):
        x = hashes + np.uint64((0x9E3779B97F4A7C15 * (1 + step * SLOTS + k)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[k] = (x ^ (x >> np.uint64(31))) % np.uint64(width)
    return out


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


_BLOCK = (
    "keys array<long>, ids array<long>, sizes array<long>, width int, bits binary, "
    "terms array<binary>, counts array<long>"
)


def blocks(docs: DataFrame) -> DataFrame:
    """Signature blocks of ``docs`` (key, doc_id, text), with the terms of each slice and their documents."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = [normal_words(t) for t in batch.column("text").to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        coded = pa.array([w for row in found for w in row], pa.binary()).dictionary_encode()
        terms = coded.dictionary.to_pylist()
        owner = np.repeat(np.arange(len(found)), sizes)
        pair, tf = np.unique(owner * max(1, len(terms)) + np.asarray(coded.indices, np.int64), return_counts=True)
        owner, code = np.divmod(pair, max(1, len(terms)))
        reached = np.searchsorted(STEPS, tf, side="right")
        load = np.bincount(owner, weights=reached, minlength=len(found)).astype(np.int64)
        order = np.argsort(load, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        hashes = term_hashes(terms)
        ids = np.array([NO_ID if d is None else d for d in batch.column("doc_id").to_pylist()], np.int64)
        keys = np.asarray(batch.column("key"), np.int64)
        by = place[owner] // BLOCK
        made: dict[str, list] = {n: [] for n in ("keys", "ids", "sizes", "width", "bits", "terms", "counts")}
        for b in range(-(-len(found) // BLOCK)):
            rows = order[b * BLOCK : (b + 1) * BLOCK]
            width = SPACE * max(1, int(load[rows].max()))
            matrix = np.zeros((width, len(rows)), bool)
            own = np.flatnonzero(by == b)
            for step in range(int(reached[own].max(initial=0))):
                high = own[reached[own] > step]
                column = place[owner[high]] - b * BLOCK
                for slot in slots(hashes[code[high]], step, width):
                    matrix[slot, column] = True
            made["keys"].append(keys[rows])
            made["ids"].append(ids[rows])
            made["sizes"].append(sizes[rows])
            made["width"].append(width)
            made["bits"].append(np.packbits(matrix, axis=1).tobytes())
            made["terms"].append([] if b else terms)
            made["counts"].append([] if b else np.bincount(code, minlength=len(terms)))
        return made

    return map_texts(docs.select("key", "doc_id", "text"), _BLOCK, work)


@dataclass
class Index:
    """Signatures of all documents, the documents themselves, and their totals."""

    docs: DataFrame  # key, doc_id, text
    blocks: DataFrame
    with_terms: int  # documents with a term
    total: int  # terms of all documents, repeats included

    @classmethod
    def build(cls, docs: DataFrame) -> Index:
        """Index every row of ``docs`` (doc_id, text); null texts have no terms, repeated rows stay."""
        prepared(docs.sparkSession)
        plain = docs.select(
            F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
        made = written(blocks(plain), "signatures")
        size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
        some = F.size(F.filter("sizes", lambda x: x > 0)).cast("long")
        totals = made.agg(F.sum(some).alias("n"), F.sum(size).alias("total")).first()
        return cls(plain, made, totals.n or 0, totals.total or 0)

    def frequencies(self, terms: list[bytes]) -> dict[bytes, int]:
        """Documents that hold each of a bounded list of ``terms``."""
        asked = self.docs.sparkSession.createDataFrame([(t,) for t in terms], "term binary")
        pairs = self.blocks.where("size(terms) > 0").select(
            F.explode(F.arrays_zip("terms", "counts")).alias("t")
        )
        met = pairs.select(F.col("t.terms").alias("term"), F.col("t.counts").alias("n")).join(asked, "term", "left_semi")
        return {bytes(r.term): r.n for r in met.groupBy("term").agg(F.sum("n").alias("n")).collect()}


@dataclass
class Items:
    """A bounded list of items as weighted terms."""

    names: list
    words: list[list[tuple[bytes, int]]]  # of each item: term and weight times repeats
    hashes: np.ndarray  # of the distinct terms
    term: np.ndarray  # of each entry, item after item
    weight: np.ndarray
    starts: np.ndarray  # first entry of each item with entries
    owners: np.ndarray  # items with entries
    with_terms: int
    total: int

    @classmethod
    def build(cls, index: Index, group: list[tuple[object, list[bytes]]]) -> Items:
        counted = [Counter(found) for _, found in group]
        df = index.frequencies(sorted({t for row in counted for t in row}))
        n = index.with_terms
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
        words = [[(t, weight[t] * c) for t, c in row.items() if weight.get(t)] for row in counted]
        number = {t: k for k, t in enumerate({t: None for row in words for t, _ in row})}
        lengths = np.array([len(row) for row in words], np.int64)
        return cls(
            [name for name, _ in group], words, term_hashes(list(number)),
            np.array([number[t] for row in words for t, _ in row], np.int64),
            np.array([w for row in words for _, w in row], np.int64),
            (np.cumsum(lengths) - lengths)[lengths > 0], np.flatnonzero(lengths), n, index.total,
        )

    def norm(self, size: int) -> int:
        return 75 + (25 * size * self.with_terms) // self.total

    def score(self, item: int, counts: Counter, norm: int) -> int:
        return sum(
            w * ((1_000_000_000 * tf) // (1000 * tf + 12 * norm)) for t, w in self.words[item] if (tf := counts.get(t))
        )

    def bounds(self, sizes: np.ndarray, width: int, bits: bytes) -> np.ndarray:
        """(items with entries, documents): scores that no document of the block exceeds."""
        docs = len(sizes)
        matrix = np.frombuffer(bits, np.uint8).reshape(width, -1)
        norm = np.array([self.norm(int(n)) for n in sizes], np.int64)
        out = np.zeros((len(self.owners), docs), np.int64)
        alive = np.arange(len(self.hashes))  # terms that may reach the step somewhere
        maps = np.full((len(self.hashes), matrix.shape[1]), 255, np.uint8)
        below = np.zeros(docs, np.int64)
        for step in range(len(STEPS)):
            for slot in slots(self.hashes[alive], step, width):
                maps &= matrix[slot]
            some = maps.any(axis=1)
            alive, maps = alive[some], maps[some]
            if not len(alive):
                break
            most = np.minimum(STEPS[step + 1] - 1, sizes) if step + 1 < len(STEPS) else sizes
            reach = (1_000_000_000 * most) // np.maximum(1, 1000 * most + 12 * norm)
            out += self._sums(alive, np.unpackbits(maps, axis=1, count=docs)) * np.maximum(0, reach - below)
            below = np.maximum(below, reach)
        return out

    def _sums(self, alive: np.ndarray, present: np.ndarray) -> np.ndarray:
        """(items with entries, documents): summed weights of the terms present."""
        row = np.full(len(self.hashes), -1, np.int64)
        row[alive] = np.arange(len(alive))
        entry = np.flatnonzero(row[self.term] >= 0)
        out = np.zeros((len(self.owners), present.shape[1]), np.int64)
        if not len(entry):
            return out
        item = np.searchsorted(self.starts, entry, side="right") - 1
        new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        ends = np.append(new[1:], len(entry))
        for a in range(0, len(new), 64):  # items at once, so that few rows are spread out together
            low, high = new[a], ends[min(a + 64, len(new)) - 1]
            part = entry[low:high]
            spread = present[row[self.term[part]]] * self.weight[part, None]
            out[item[new[a : a + 64]]] = np.add.reduceat(spread, new[a : a + 64] - low, axis=0)
        return out


_BOUND = "item int, key long, id long, bound long"


def _bounded(index: Index, shared, keep) -> DataFrame:
    """Rows (item, key, id, bound) of the blocks that ``keep`` (items, bounds, ids) -> mask retains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        chosen = keep()
        held, rows = [], 0
        for batch in batches:
            for b in batch.to_pylist():
                ids, keys = np.array(b["ids"], np.int64), np.array(b["keys"], np.int64)
                bound = items.bounds(np.array(b["sizes"], np.int64), b["width"], b["bits"])
                item, doc = np.nonzero(chosen.mask(bound, ids))
                held.append(np.stack([items.owners[item], keys[doc], ids[doc], bound[item, doc]]))
                rows += len(item)
                if rows >= HELD:
                    held = [chosen.cut(np.concatenate(held, axis=1))]
                    if chosen.final:
                        yield _bounds_batch(held.pop())
                    rows = sum(h.shape[1] for h in held)
        if rows:
            yield _bounds_batch(chosen.cut(np.concatenate(held, axis=1)))

    return index.blocks.select("keys", "ids", "sizes", "width", "bits").mapInArrow(run, _BOUND)


def _bounds_batch(found: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(found[0].astype(np.int32)), *(pa.array(found[k]) for k in (1, 2, 3))]
    return pa.RecordBatch.from_arrays(arrays, names=["item", "key", "id", "bound"])


class Best:
    """Keeps the ``top`` highest bounds of each item, smaller ids first among equal ones."""

    final = False

    def __init__(self, items: Items, top: int):
        self.top, self.least = top, np.ones(len(items.owners), np.int64)
        self.place = {int(k): n for n, k in enumerate(items.owners)}

    def mask(self, bound: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return bound >= self.least[:, None]

    def cut(self, found: np.ndarray) -> np.ndarray:
        found = found[:, np.lexsort((found[2], -found[3], found[0]))]
        item = found[0]
        new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        _, rank = ragged(np.diff(np.append(new, len(item))))
        for k in np.flatnonzero(rank == self.top - 1):
            self.least[self.place[int(item[k])]] = found[3, k]
        return found[:, rank < self.top]


class Reaching:
    """Keeps every document that may come before the last of the best known of its item."""

    final = True

    def __init__(self, items: Items, last: dict[int, tuple[int, int]]):
        known = [last.get(int(k), (0, NO_ID)) for k in items.owners]
        self.score = np.array([max(1, s) for s, _ in known], np.int64)[:, None]
        self.id = np.array([d if s > 0 else NO_ID for s, d in known], np.int64)[:, None]

    def mask(self, bound: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (bound > self.score) | ((bound == self.score) & (ids[None, :] <= self.id))

    def cut(self, found: np.ndarray) -> np.ndarray:
        return found


def exact(index: Index, pairs: DataFrame, shared) -> DataFrame:
    """(item, id, score) of all documents in ``pairs`` (item, key), from their whole texts."""
    wanted = written(pairs.groupBy("key").agg(F.collect_set("item").alias("items")), "wanted")
    number = wanted.agg(F.sum(F.size("items"))).first()[0] or 0
    if number <= SENT_PAIRS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            made = []
            for doc, text, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items")), strict=True):
                found = normal_words(text)
                norm, counts = items.norm(len(found)), Counter(found)
                made += [(k, NO_ID if doc is None else doc, items.score(k, counts, norm)) for k in asked]
            made = [m for m in made if m[2] > 0]
            if made:
                item, ids, score = zip(*made, strict=True)
                arrays = [pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["item", "id", "score"])

    met = index.docs.join(wanted, "key").select("doc_id", "text", "items")
    return met.mapInArrow(run, "item int, id long, score long")


def ranked(scores: DataFrame, top: int) -> DataFrame:
    """``scores`` (item, id, score) with rank 1 to ``top`` of each item."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(index: Index, items: DataFrame, top: int = TOP, item_words: int = ITEM_WORDS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every row of ``items``.

    Only scores above 0 count; equal ones come by ascending doc_id, null ids last. An item without
    a known term has no rows; repeated items and repeated documents have rows each. An empty index
    or no items give an empty result.
    """
    spark = prepared(index.docs.sparkSession)
    kind = items.schema["item_id"].dataType
    schema = f"item int, item_id {kind.simpleString()}"
    found = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    if not index.with_terms:
        return found
    parts = []
    for group in _groups(items, item_words):
        made = Items.build(index, group)
        if not len(made.owners):
            continue
        shared = spark.sparkContext.broadcast(made)
        seeds = _bounded(index, shared, lambda s=shared: Best(s.value, top))
        first = ranked(seeds.withColumnRenamed("bound", "score"), top)
        known = ranked(exact(index, first.select("item", "key"), shared), top)
        last = {r.item: (r.score, r.id) for r in known.where(F.col("rank") == top).collect()}
        reach = _bounded(index, shared, lambda s=shared, t=last: Reaching(s.value, t))
        best = ranked(exact(index, reach.select("item", "key"), shared), top)
        names = spark.createDataFrame(list(enumerate(made.names)), schema)
        parts.append(
            best.join(names, "item").select(
                "item_id", F.col("rank").cast("int").alias("rank"),
                F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "score",
            )
        )
    for part in parts:
        found = found.unionByName(part)
    return found


def _groups(items: DataFrame, limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their words, in lists of about ``limit`` words, read one list after the other."""
    group, held = [], 0
    for name, text in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        found = normal_words(text)
        if group and held + len(found) > limit:
            yield group
            group, held = [], 0
        group.append((name, found))
        held += len(found)
    if group:
        yield group


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = Index.build(table(prepared(spark), sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"))


_SQL = r"""
WITH found AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
totals AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM found WHERE len(w) > 0),
held AS (
  SELECT k, doc_id, term, CAST(count(*) AS BIGINT) AS tf, 75 + (25 * len(any_value(w)) * any_value(n)) // any_value(l) AS m
  FROM (SELECT found.*, unnest(w) AS term FROM found), totals GROUP BY k, doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, totals GROUP BY term),
asked AS (
  SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS c FROM (
    SELECT row_number() OVER () AS i, item_id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY i, item_id, term),
scored AS (
  SELECT i, item_id, k, doc_id, CAST(sum(c * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) GROUP BY i, item_id, k, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""

QUERIES = {"op12_search": Query(op12_search, _SQL)}
