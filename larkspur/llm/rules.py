"""Quality rules: text counts, and hashed n-gram log-likelihood ratios against trusted text.

Words and word pairs, lower-cased, are hashed to a fixed number of buckets. One multinomial over
the buckets is counted on the whole corpus, one on trusted documents. A document's ratio is the sum
over its n-grams of log p(trusted) - log p(corpus), divided by their number; it is kept when that
reaches a threshold, the same for every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, lowered, prepared, ragged, slices, table, written
from larkspur.plans.registry import Query

BUCKETS = 1 << 16
#: Ids of trusted documents up to which they are sent to all tasks; more meet the texts in a shuffled join.
SENT_IDS = 2_000_000
#: Share of trusted documents that may fall below the threshold.
TRUSTED_LOSS = 0.005
SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of all words laid end to end, the words of each text, and the vocabulary."""
    seen: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number = seen.setdefault
    flat = np.fromiter((number(w, len(seen)) for row in texts for w in row), np.int64, int(sizes.sum()))
    return flat, sizes, list(seen)


def repeated_words(numbers: np.ndarray, vocabulary: int) -> int:
    """Words covered by the 3-word windows that occur twice or more in ``numbers``."""
    if len(numbers) < 4:
        return 0
    a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
    if vocabulary < 1 << 21:
        key = (a << 42) | (b << 21) | c
    else:  # beyond 63 bits: number the pairs first
        _, pair = np.unique(a * vocabulary + b, return_inverse=True)
        key = pair * vocabulary + c
    order = np.sort(key)
    if not (order[1:] == order[:-1]).any():
        return 0
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.encode("utf-8", "surrogatepass").split():
            seen.add(line)
    return repeats


def buckets_of(flat: np.ndarray, sizes: np.ndarray, vocabulary: list[bytes], buckets: int):
    """Buckets of all words and word pairs of texts laid end to end, and the text of each."""
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in vocabulary), np.uint64, len(vocabulary))
    each = hashes[flat]
    rows, _ = ragged(sizes)
    inside = rows[1:] == rows[:-1]
    pair = (each[:-1] * _MIX) ^ (each[1:] + (each[:-1] >> np.uint64(7)))
    pair = (pair ^ (pair >> np.uint64(29))) * _MIX
    grams = np.concatenate([each * _MIX, pair[inside]])
    return ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), np.concatenate(
        [rows, rows[:-1][inside]]
    )


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratio of each bucket and the threshold on a document's mean."""

    weights: np.ndarray
    threshold: float

    def means(self, flat: np.ndarray, sizes: np.ndarray, vocabulary: list[bytes]) -> np.ndarray:
        found, rows = buckets_of(flat, sizes, vocabulary, len(self.weights))
        total = np.bincount(rows, self.weights[found], len(sizes))
        return total / np.maximum(np.bincount(rows, minlength=len(sizes)), 1)


def labelled(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``docs`` inner-joined with at most ``bound`` rows of ``labels`` (doc_id and what it marks).

    The rows of the smallest hash of the id are taken, one an id, so the choice is the same on each
    run; the bound makes the sample safe to broadcast, and the texts are not shuffled.
    """
    few = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.join(F.broadcast(few), "doc_id")


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """Counts of the buckets over all texts: summed in each task, then across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches):
            texts = [lowered(t).split() for t in part.column("text").to_pylist()]
            total += np.bincount(buckets_of(*word_numbers(texts), buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    counts = np.zeros(buckets)
    for bucket, n in rows.toLocalIterator():  # at most ``buckets`` rows
        counts[bucket] = n
    return counts


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles ``values``."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def nth_key(keys: DataFrame, n: int) -> int:
    """The n-th smallest (from 0) of the column ``key``, 16 bits at a time from the highest."""
    found = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("key", shift) if shift == 48 else F.shiftright("key", shift).bitwiseAND(0xFFFF)
        for value, rows in sorted(map(tuple, keys.groupBy(digit).count().collect())):  # at most 65,536 rows
            if n < rows:
                break
            n -= rows
        found |= value << shift
        keys = keys.where(F.shiftright("key", shift) == found >> shift)
    return found


def quantile(keys: DataFrame, share: float) -> float:
    """The ``share`` quantile of the doubles behind ``ordered_keys``, interpolated between two neighbours."""
    at = (keys.count() - 1) * share
    low, high = int(np.floor(at)), int(np.ceil(at))
    ends = np.array([nth_key(keys, n) for n in (low, high)], np.int64)
    values = (ends ^ ((ends >> 63) & np.int64((1 << 63) - 1))).view(np.float64)
    return float(np.quantile(values, at - low))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> Ratios:
    """Multinomials of the corpus and of trusted documents, and the threshold between them.

    The corpus counts cover all documents, the trusted ones all that are labelled quality 1. Both
    multinomials mix in the uniform one with one count a bucket. The threshold is the exact
    TRUSTED_LOSS quantile of the trusted documents' means. Without labels everything is kept.
    """
    good = written(
        labels.groupBy("doc_id").agg(F.min("quality").alias("__q")).where("__q = 1").select("doc_id"), "trusted"
    )
    ids = F.broadcast(good) if good.count() <= SENT_IDS else good
    trusted = docs.select("doc_id", "text").join(ids, "doc_id")
    raw, target = bucket_counts(docs, buckets), bucket_counts(trusted, buckets)
    if not target.sum():
        return Ratios(np.zeros(buckets), -np.inf)
    share = [np.log((c + 1) / (c.sum() + buckets)) for c in (target, raw)]
    weights = share[0] - share[1]
    probe = docs.sparkSession.sparkContext.broadcast(Ratios(weights, -np.inf))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [lowered(t).split() for t in part.column("text").to_pylist()]
            means = probe.value.means(*word_numbers(texts))
            yield pa.RecordBatch.from_arrays([pa.array(ordered_keys(means))], names=["key"])

    keys = written(trusted.select("text").mapInArrow(score, "key long"), "means")
    return Ratios(weights, quantile(keys, TRUSTED_LOSS))


def apply_rules(docs: DataFrame, ratios: Ratios, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the counts ``__words`` ... ``__repeats``, ``__ratio`` and ``__kept``.

    Null and empty texts have no words, ratio 0, and fail the rules for their length.
    """
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(ratios)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        flat, sizes, vocabulary = word_numbers([r.split() for r in raw])
        ends = np.cumsum(sizes)
        repeats = [
            repeated_words(flat[e - n : e], len(vocabulary)) for e, n in zip(ends, sizes, strict=True)
        ]
        means = shared.value.means(*word_numbers([r.lower().split() for r in raw]))
        return {
            "__words": sizes,
            "__chars": [
                len(t) - len(r) + len(r.translate(None, _BLANKS)) for t, r in zip(texts, raw, strict=True)
            ],
            "__symbols": [len(r) - len(r.translate(None, SYMBOLS)) for r in raw],
            "__lines": [duplicate_lines(t) for t in texts],
            "__repeats": repeats,
            "__ratio": means,
        }

    ddl = "__words long, __chars long, __symbols long, __lines long, __repeats long, __ratio double"
    failed = (F.col("__words") < 50) | (100 * F.col("__repeats") > 50 * F.col("__words"))
    return (
        add_columns(docs, ddl, work, drop)
        .withColumn("__failed", failed)
        .withColumn("__kept", ~failed & (F.col("__ratio") >= F.lit(ratios.threshold)))
    )


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts and verdict of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    ratios = fit(docs, table(spark, sf_dir, "labels"))
    return apply_rules(docs, ratios, drop=("text",)).select(
        "doc_id",
        F.col("__words").alias("n_words"),
        F.col("__chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        F.col("__lines").alias("n_dup_lines"),
        F.col("__repeats").alias("n_repeat_words"),
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
        F.col("__ratio").alias("mean_ratio"),
    )


QUERIES = {"op10_rules": Query(op10_rules)}
