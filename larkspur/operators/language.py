"""N-gram counts, word completion and next-word prediction.

Grams are (gram, n, cnt). Counting sums before its shuffle, so a gram that makes up a third of
the text reaches its reducer as one row per map task.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from larkspur.functions import grams
from larkspur.functions.text import (
    clean_text,
    head_words,
    last_word,
    ngram_total,
    proper_prefixes,
    tokens,
)
from larkspur.session import materialise, ship_package

NMAX = 5
MIN_COUNT = 3
#: Words of a block whose grams are counted together.
BLOCK_WORDS = 1 << 19
#: Hashes that meet in a task, about.
RANGE_KEYS = 1 << 22
#: Bits by which parts of grams as text are finer than ranges of hashes.
FINER = 2


def word_arrays(text: DataFrame, column: str = "text") -> DataFrame:
    """(words) per text, without texts that have none.

    The array is generated rather than filtered: a filter would be pushed below the projection
    and tokenise every text a second time.
    """
    words = F.array(tokens(clean_text(F.col(column))))
    return text.select(F.explode(F.filter(words, lambda w: F.size(w) > 0)).alias("words"))


def ngram_count(
    text: DataFrame,
    nmax: int = NMAX,
    min_count: int = MIN_COUNT,
    observation: Observation | None = None,
    block_words: int = BLOCK_WORDS,
    range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """Counts of all 1..nmax-grams that occur at least ``min_count`` times.

    Most grams are rare, so their text is not shuffled. Texts are written once, in blocks; a block
    sends hashes of its grams, cut into ranges, and is told which may be frequent. Only those become
    text and are counted, so hashes spare work and never change a count. A task adds up the counts of its blocks and sends
    them in compressed parts. What fits one block, and single words, are counted directly. ``observation`` receives ``emitted``, the number of
    grams counted.
    """
    words = word_arrays(text)
    if observation is not None:
        words = words.observe(
            observation, F.sum(ngram_total(F.col("words"), nmax)).alias("emitted")
        )
    if nmax < 2 or min_count < 2:
        return _counted_directly(words, nmax, min_count)
    ship_package(text.sparkSession)
    packed = words.mapInArrow(lambda batches: grams.blocks_of(batches, block_words), grams.BLOCK_DDL)
    blocks = materialise(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    total = blocks.agg(F.sum("tokens")).first()[0] or 0
    if total <= block_words:
        return _counted_directly(word_arrays(text), nmax, min_count)
    bits = max(0, math.ceil(math.log2(total * (nmax - 1) / range_keys)))
    shares = _frequent_grams(blocks, nmax, min_count, bits).mapInArrow(
        lambda batches: grams.shares(batches, bits + FINER), "part int, grams binary, counts binary"
    )
    counted = shares.groupBy("part").applyInArrow(lambda rows: grams.of_shares(rows, min_count), "gram string, cnt long")
    return counted.select("gram", F.size(F.split("gram", " ")).alias("n"), "cnt")


def _frequent_grams(blocks: DataFrame, nmax: int, min_count: int, bits: int) -> DataFrame:
    """(gram, cnt) in each block, without grams whose hash is rare in all blocks together."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                rows = list(grams.sent(_block(batch, n), nmax, min_count, bits))
                if rows:
                    part, hashes, counts = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array(part, pa.int32()),
                            "block": pa.array([batch.column("block")[n].as_py()] * len(rows), pa.int64()),
                            "hashes": pa.array(hashes, pa.binary()),
                            "counts": pa.array(counts, pa.binary()),
                        }
                    )

    def answer(sums: pa.Table) -> pa.Table:
        hashes, counts = (sums.column(c).to_pylist() for c in ("hashes", "counts"))
        told = pa.array(grams.answers(hashes, counts, min_count), pa.binary())
        return sums.select(["part", "block"]).append_column("told", told)

    def keep(block: pa.Table, told: pa.Table) -> pa.Table:
        known = dict(zip(told.column("part").to_pylist(), told.column("told").to_pylist(), strict=True))
        return grams.frequent(_block(block, 0), nmax, known, bits)

    messages = blocks.select("block", "vocabulary", "codes", "lengths").mapInArrow(
        send, "part int, block long, hashes binary, counts binary"
    )
    told = messages.groupBy("part").applyInArrow(answer, "part int, block long, told binary")
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(keep, "gram string, cnt long")


def _block(rows: pa.RecordBatch | pa.Table, n: int) -> grams.Block:
    return grams.block_of(*(rows.column(c)[n].as_py() for c in ("vocabulary", "codes", "lengths")))


def _counted_directly(words: DataFrame, nmax: int, min_count: int) -> DataFrame:
    """Start positions are exploded, then the lengths from there, so no array of all grams is built."""
    starts = words.select(
        "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("start")
    )
    lengths = F.sequence(
        F.lit(1), F.least(F.lit(nmax), F.size("words") - F.col("start") + 1)
    )
    gram = F.array_join(F.slice("words", F.col("start"), F.col("n")), " ")
    return (
        starts.select("words", "start", F.explode(lengths).alias("n"))
        .select(gram.alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") >= min_count)
        .select("gram", F.size(F.split("gram", " ")).alias("n"), "cnt")
    )


def emitted_counter(text: DataFrame, nmax: int = NMAX) -> DataFrame:
    """Number of grams a count over ``text`` emits."""
    return word_arrays(text).agg(
        F.coalesce(F.sum(ngram_total(F.col("words"), nmax)), F.lit(0)).alias("emitted")
    )


def unigrams(grams: DataFrame) -> DataFrame:
    """Grams of exactly one word, as (word, cnt)."""
    return grams.filter(F.col("n") == 1).select(F.col("gram").alias("word"), "cnt")


def group_share(items: DataFrame, key: str, item: str, k: int | None = None) -> DataFrame:
    """Share of each item in its key's total, best k per key: (key, item, cnt, share, position).

    The total covers the whole group, the cut only the output. Totals and the k best are
    reduced separately ahead of their shuffles, since a total taken as a window would send a whole group to
    one task.
    """
    totals = items.groupBy(key).agg(F.sum("cnt").alias("_total"))
    if k is None:
        kept = items
    else:
        best = Window.partitionBy(key).orderBy(F.desc("cnt"), F.asc(item))
        kept = items.withColumn("position", F.row_number().over(best)).filter(
            F.col("position") <= k
        )
    return kept.join(totals, key).withColumn("share", F.col("cnt") / F.col("_total")).drop("_total")


def prefix_entries(words: DataFrame) -> DataFrame:
    """(prefix, word, cnt) for every proper prefix of every word."""
    return words.select(F.explode(proper_prefixes(F.col("word"))).alias("prefix"), "word", "cnt")


class _Node:
    """A prefix whose words are still arriving: their total and the k best (count, word)."""

    def __init__(self) -> None:
        self.total, self.best = 0, []

    def add(self, total: int, best: list[tuple[int, str]], k: int) -> None:
        self.total += total
        self.best = sorted(self.best + best, key=lambda b: (-b[0], b[1]))[:k]


def prefix_nodes(words: DataFrame, k: int) -> DataFrame:
    """(prefix, word, cnt): for each prefix in a task its k best words, and their total without a word.

    Words come sorted, so a task walks the trie of its range with one open path. A prefix is left
    when the next word does not share it; its total and its k best then go to the prefix one
    shorter. Prefixes at the ends of a range arise in two tasks and are merged by who reads them.
    """
    ship_package(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, last, rows = [_Node()], "", []

        def leave(depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                prefix = last[: len(path)]
                if node.best:
                    rows.extend((prefix, word, cnt) for cnt, word in node.best)
                    rows.append((prefix, None, node.total))
                path[-1].add(node.total, node.best, k)

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.string(), pa.int64())
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["prefix", "word", "cnt"]
            )

        for batch in batches:
            for word, cnt in zip(*(batch.column(c).to_pylist() for c in ("word", "cnt")), strict=True):
                shared = len(os.path.commonprefix([last, word]))
                leave(min(shared, max(0, len(word) - 1)))
                last = word
                path.extend(_Node() for _ in range(len(path), len(word)))
                if len(word) > 1:
                    path[-1].add(cnt, [(cnt, word)], k)
                if len(rows) >= 10_000:
                    yield made()
        leave(0)
        if rows:
            yield made()

    dealt = words.where("word IS NOT NULL").select("word", F.col("cnt").cast("long").alias("cnt"))
    return dealt.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(
        run, "prefix string, word string, cnt long"
    )


def word_completion(words: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent words behind each proper prefix, with their share.

    Instead of a row for each prefix of each word, at most k a prefix are shuffled. ``words`` has one
    row a word; null words are left out.
    """
    nodes = materialise(prefix_nodes(words, k), "prefixes")
    totals = nodes.where("word IS NULL").groupBy("prefix").agg(F.sum("cnt").alias("_total"))
    best = Window.partitionBy("prefix").orderBy(F.desc("cnt"), F.asc("word"))
    kept = nodes.where("word IS NOT NULL").withColumn("position", F.row_number().over(best)).filter(
        F.col("position") <= k
    )
    return kept.join(totals, "prefix").withColumn("share", F.col("cnt") / F.col("_total")).drop("_total")


def phrase_entries(grams: DataFrame) -> DataFrame:
    """(head, word, cnt) for every gram of two words or more."""
    gram: Column = F.col("gram")
    return grams.filter(F.col("n") > 1).select(
        head_words(gram).alias("head"), last_word(gram).alias("word"), "cnt"
    )


def next_word(grams: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent words after each phrase, with their share."""
    return group_share(phrase_entries(grams), "head", "word", k)


def language_model(text: DataFrame, k: int = 5) -> DataFrame:
    """Completion and next-word suggestions in one table; grams are counted and written once."""
    grams = materialise(ngram_count(text), "grams")
    return model_of(grams, k)


def model_of(grams: DataFrame, k: int = 5) -> DataFrame:
    """(kind, context, word, cnt, share, position) from counted grams."""
    columns = ["kind", "context", "word", "cnt", "share", "position"]
    complete = word_completion(unigrams(grams), k).withColumn("kind", F.lit("completion"))
    follow = next_word(grams, k).withColumn("kind", F.lit("next"))
    return (
        complete.withColumnRenamed("prefix", "context").select(*columns)
        .unionByName(follow.withColumnRenamed("head", "context").select(*columns))
    )
