"""LM scoring by deleted interpolation of n-gram maximum-likelihood estimates.

A word's probability mixes the estimates of all orders, c(context, word) / c(context), with a
smoothed base. The weights depend on how often the longest known context occurs, in buckets by
powers of two, and are learned by expectation-maximisation on documents whose counts are left out
of the estimates meanwhile.

The counts grow with the corpus, so no task and no driver ever holds them. Texts are packed into
blocks of bounded size. A block sends each of its different n-grams once, as sorted 64-bit hashes
cut into ranges of the hash; a range gathers the counts of all blocks, sums them, and answers each
block in the block's own order, so the way back needs no hashes. Different n-grams share a hash with
a probability of about n^2 / 2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import prepared, remainder, slices, table, words, written
from larkspur.llm.rules import word_numbers
from larkspur.plans.registry import Query

ORDER = 2
FOLDS = 10
ALPHA = 0.1
#: Bytes of words in a block.
BLOCK_BYTES = 6 << 20
#: Hashes that a range gathers, about.
RANGE_KEYS = 1_000_000
ROUNDS = 12
LEARN, TUNE, TEST = 0, 1, 2
_END = np.uint64(0xD1B54A32D192ED03)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _begin(order: int) -> np.uint64:
    """Hash that stands for a context of ``order`` places before the text."""
    return np.uint64(xxhash.xxh64_intdigest(b"begin", order))


def _packed_array(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, then compressed: small numbers cost little."""
    raw = values.view(np.uint8).reshape(len(values), -1).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return flat.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def roles(folds: int = FOLDS) -> F.Column:
    """TEST for held-out documents (crc32 of the id modulo ``folds`` is 0); of the others, one in
    ``folds`` by the next digit of the crc32 is TUNE, the rest LEARN."""
    return F.when(remainder(folds) == 0, TEST).when(
        F.floor(remainder(folds * folds) / folds) == 0, TUNE
    ).otherwise(LEARN)


def pack(docs: DataFrame, role: F.Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents of one role, cut as the scan comes: nothing is shuffled.

    A block holds the lower-cased words of its texts, compressed; a text longer than a block is a
    block of its own. The ids are those of the task and its count, so the table must be written
    before it is used twice.
    """
    ddl = "block long, role int, tokens long, doc_ids array<long>, body binary"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", role.cast("int").alias("role"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list, list]] = {r: ([], [], []) for r in (LEARN, TUNE, TEST)}

        def block(which: int) -> pa.RecordBatch:
            nonlocal number
            ids, bodies, tokens = held[which]
            body = zstandard.ZstdCompressor(level=3).compress(b"\n".join(bodies))
            columns = [
                pa.array([(task << 32) | number], pa.int64()), pa.array([which], pa.int32()),
                pa.array([sum(tokens)], pa.int64()), pa.array([list(ids)], pa.list_(pa.int64())),
                pa.array([body], pa.binary()),
            ]
            number += 1
            held[which] = ([], [], [])
            return pa.RecordBatch.from_arrays(columns, names=["block", "role", "tokens", "doc_ids", "body"])

        sizes = dict.fromkeys(held, 0)
        for part in slices(batches):
            for doc_id, text, which in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "role")), strict=True):
                found = words(text)
                body = b" ".join(found)
                if sizes[which] and sizes[which] + len(body) > block_bytes:
                    yield block(which)
                    sizes[which] = 0
                for column, value in zip(held[which], (doc_id, body, len(found) + 1), strict=True):
                    column.append(value)
                sizes[which] += len(body) + 1
        for which in held:
            if held[which][0]:
                yield block(which)

    return source.mapInArrow(run, ddl)


class Grams:
    """The n-grams of a block: for each order the hash at every place, the different hashes in
    order, and which of them stands at each place. An end follows each text and is a token."""

    def __init__(self, body: bytes, order: int):
        rows = [r.split() for r in zstandard.ZstdDecompressor().decompress(body).split(b"\n")]
        flat, sizes, vocabulary = word_numbers(rows)
        del rows
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w) for w in vocabulary), np.uint64, len(vocabulary))
        self.lengths = sizes + 1
        ends = np.cumsum(self.lengths) - 1
        self.first = ends + 1 - self.lengths
        stream = np.full(len(flat) + len(sizes), _END, np.uint64)
        inside = np.ones(len(stream), bool)
        inside[ends] = False
        stream[inside] = hashes[flat]
        self.keys, self.place, self.counts = [], [], []
        gram = stream
        for k in range(1, order + 1):
            if k > 1:
                before = np.empty_like(gram)
                before[1:] = gram[:-1]
                before[self.first] = _begin(k - 1)
                gram = ((before ^ (before >> np.uint64(32))) * _FIRST + stream) * _SECOND
                gram ^= gram >> np.uint64(32)
                gram *= _FIRST
            keys, place, counts = np.unique(gram, return_inverse=True, return_counts=True)
            self.keys.append(keys)
            self.place.append(place)
            self.counts.append(counts.astype(np.uint32))


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, starts), len(keys))


def gather(packed: DataFrame, order: int, bits: int) -> DataFrame:
    """(part, block, learned, all): for each block's n-grams of a range, the counts over all blocks.

    ``part`` numbers orders and ranges of the hash; ``learned`` are counts over LEARN blocks,
    ``all`` over LEARN and TUNE blocks, in the order of the block's sorted hashes. A row without a
    block tells the range's different n-grams (``learned``) and their occurrences (``all``).
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, role, body in zip(*(batch.column(c).to_pylist() for c in ("block", "role", "body")), strict=True):
                grams = Grams(body, order)
                rows: list[tuple] = []
                for k, (keys, counts) in enumerate(zip(grams.keys, grams.counts, strict=True)):
                    edges = _edges(keys, bits)
                    for number in np.flatnonzero(np.diff(edges)):
                        a, b = edges[number], edges[number + 1]
                        steps = np.diff(keys[a:b], prepend=np.uint64(0))
                        rows.append(((k << bits) + int(number), block, role, _packed_array(steps), _packed_array(counts[a:b])))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "role", "keys", "counts"])

    def answer(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        keys = [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
        counts = [_unpacked(c, np.uint32) for c in rows.column("counts").to_pylist()]
        role = np.array(rows.column("role").to_pylist())
        sizes = np.array([len(k) for k in keys])
        different, place = np.unique(np.concatenate(keys), return_inverse=True)
        weights = np.concatenate(counts).astype(np.float64)
        of = np.repeat(role, sizes)
        learned = np.bincount(place, weights * (of == LEARN), len(different))
        every = np.bincount(place, weights * (of != TEST), len(different))
        cuts = np.cumsum(sizes)[:-1]
        asked = np.split(place, cuts)
        blocks = rows.column("block").to_pylist()
        return pa.table(
            {
                "part": pa.array([part] * (len(blocks) + 1), pa.int64()),
                "block": pa.array([*blocks, None], pa.int64()),
                # only TUNE blocks need the counts without them
                "learned": pa.array(
                    [_packed_array(learned[p].astype(np.uint64)) if r == TUNE else None for p, r in zip(asked, role, strict=True)]
                    + [int((every > 0).sum()).to_bytes(8, "little")],
                    pa.binary(),
                ),
                "all": pa.array(
                    [_packed_array(every[p].astype(np.uint64)) for p in asked] + [int(every.sum()).to_bytes(8, "little")],
                    pa.binary(),
                ),
            }
        )

    sent = packed.select("block", "role", "body").mapInArrow(
        send, "part long, block long, role int, keys binary, counts binary"
    )
    return sent.groupBy("part").applyInArrow(answer, "part long, block long, learned binary, all binary")


@dataclass
class Weights:
    """Mixture weights by bucket of the longest known context, and the base's numbers."""

    order: int
    tokens: int
    different: int
    table: dict[int, np.ndarray]

    def row(self, bucket: int) -> np.ndarray:
        """The bucket's weights; of the nearest bucket below where none was learned."""
        while bucket >= 0:
            if bucket in self.table:
                return self.table[bucket]
            bucket -= 1
        return np.full(self.order + 1, 1 / (self.order + 1))


def estimates(grams: Grams, parts: pa.Table, column: str, order: int, bits: int, tokens: int, different: int):
    """At each place of a block: its bucket, the base, and the estimates of orders 1 to ``order``."""
    found: dict[int, np.ndarray] = {}
    for part, raw in zip(parts.column("part").to_pylist(), parts.column(column).to_pylist(), strict=True):
        found[part] = _unpacked(raw, np.uint64).astype(np.float64)
    counts = []
    for k in range(order):
        own = [found[p] for p in sorted(found) if p >> bits == k]
        counts.append(np.concatenate(own)[grams.place[k]])
    base = (counts[0] + ALPHA) / (tokens + ALPHA * (different + 1))
    shares = [counts[0] / max(1, tokens)]
    # every training text has one end, so the ends count the contexts before all texts
    ends = counts[0][grams.first + grams.lengths - 1][0]
    bucket = np.zeros(len(base), np.int64)
    for k in range(1, order):
        context = np.empty_like(base)
        context[1:] = counts[k - 1][:-1]
        context[grams.first] = ends
        shares.append(np.divide(counts[k], context, out=np.zeros_like(base), where=context > 0))
        known = context > 0
        bucket[known] = 64 * k + np.floor(np.log2(context[known])).astype(np.int64)
    return bucket, base, shares, counts[0]


def learn_weights(ratios: DataFrame, order: int, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Expectation-maximisation of the weights of each bucket on held-out counts.

    ``ratios`` has a bucket, a count n and the estimates over the base, r1 to r<order>; a weight's
    share in a count is taken over all rows by Spark, and a few hundred sums reach the driver. Half
    a count of each order goes in beforehand, so that no weight becomes zero.
    """
    names = [f"r{k}" for k in range(1, order + 1)]
    buckets = [r.bucket for r in ratios.select("bucket").distinct().collect()]  # 64 an order at most
    weights = {b: np.full(order + 1, 1 / (order + 1)) for b in buckets}
    spark = ratios.sparkSession
    for _ in range(rounds if weights else 0):
        rows = [(b, *map(float, w)) for b, w in weights.items()]
        now = spark.createDataFrame(rows, "bucket long, " + ", ".join(f"w{k} double" for k in range(order + 1)))
        parts = [F.col("w0"), *(F.col(f"w{k}") * F.col(f"r{k}") for k in range(1, order + 1))]
        whole = sum(parts[1:], parts[0])
        shared = ratios.select("bucket", "n", *names).join(F.broadcast(now), "bucket")
        sums = shared.groupBy("bucket").agg(*(F.sum(F.col("n") * p / whole).alias(f"s{k}") for k, p in enumerate(parts)))
        for row in sums.collect():
            gained = np.array(row[1:], float) + 0.5
            weights[row.bucket] = gained / gained.sum()
    return weights


def score(
    docs: DataFrame, role: F.Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES,
    range_keys: int = RANGE_KEYS, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The model learns from LEARN and TUNE documents; while the weights are learned, TUNE documents
    are not counted. A null or empty text is one end. Without training documents every token is
    unknown. Repeated rows count as often as they stand.
    """
    spark = prepared(docs.sparkSession)
    packed = written(pack(docs, role, block_bytes), "blocks")
    tokens = packed.agg(F.sum("tokens")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, tokens / range_keys))))
    counts = written(gather(packed, order, bits), "counts")
    ones = counts.where(f"block IS NULL AND part < {1 << bits}")
    train, different = 0, 0
    for row in ones.select("learned", "all").toLocalIterator():  # a row of two numbers each range
        different += int.from_bytes(row[0], "little")
        train += int.from_bytes(row[1], "little")
    kept_tokens = packed.where(F.col("role") == LEARN).agg(F.sum("tokens")).first()[0] or 0
    answers = counts.where("block IS NOT NULL")

    def ratio(blocks: pa.Table, parts: pa.Table) -> pa.Table:
        grams = Grams(blocks.column("body")[0].as_py(), order)
        bucket, base, shares, _ = estimates(grams, parts, "learned", order, bits, kept_tokens, different)
        # places with the same longest n-gram and context count alike: take one for all
        last = grams.place[-1]
        _, one, n = np.unique(last, return_index=True, return_counts=True)
        data = {"bucket": bucket[one], "n": n}
        data |= {f"r{k}": (s[one] / base[one]).astype(np.float32) for k, s in enumerate(shares, start=1)}
        return pa.table(data)

    ddl = "bucket long, n long, " + ", ".join(f"r{k} float" for k in range(1, order + 1))
    tune = packed.where(F.col("role") == TUNE).groupBy("block")
    # answers to TUNE blocks alone carry the counts without them
    ratios = written(
        tune.cogroup(answers.where("learned IS NOT NULL").groupBy("block")).applyInArrow(ratio, ddl), "ratios"
    )
    model = Weights(order, train, different, learn_weights(ratios, order, rounds))
    shared = spark.sparkContext.broadcast(model)

    def result(blocks: pa.Table, parts: pa.Table) -> pa.Table:
        model: Weights = shared.value
        grams = Grams(blocks.column("body")[0].as_py(), order)
        bucket, base, shares, known = estimates(grams, parts, "all", order, bits, train, different)
        rows = {b: model.row(b) for b in np.unique(bucket).tolist()}
        grid = np.zeros((max(rows) + 1, order + 1))
        for b, weights in rows.items():
            grid[b] = weights
        mixed = grid[bucket, 0] * base
        for k, s in enumerate(shares, start=1):
            mixed += grid[bucket, k] * s
        total = lambda values: np.add.reduceat(values, grams.first)
        return pa.table(
            {
                "doc_id": pa.array(blocks.column("doc_ids")[0].as_py(), pa.int64()),
                "n_tokens": pa.array(grams.lengths, pa.int64()),
                "n_known": pa.array(total((known > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array([train] * len(grams.lengths), pa.int64()),
                "base_score": total(np.log10(base)),
                "score": total(np.log10(mixed)),
            }
        )

    whole = packed.groupBy("block").cogroup(answers.select("part", "block", "all").groupBy("block"))
    return whole.applyInArrow(
        result, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op1_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, roles())
    return scored.select(
        "doc_id", (remainder(FOLDS) == 0).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


QUERIES = {"op1_interpolation": Query(op1_interpolation)}
