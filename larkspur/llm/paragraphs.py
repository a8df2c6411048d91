"""Substring dedup by paragraph MinHash banding, exact verification and components.

Texts are cut into paragraphs at two grains. Lines are the coarse grain: MinHash signatures over
their 5-word shingles are cut into bands, lines that meet in a band are joined, their exact Jaccard
similarity is computed, and those of 0.8 or more are linked. 14 bands of 4 rows find a pair at 0.8
with a probability of 0.9994, a closer one almost surely.

Passages are also pasted into the middle of lines, so the fine grain cuts a text, across lines,
behind words whose hash is lowest among their neighbours. Such cuts depend on the nearest words
alone and so fall alike in every copy of a passage. Pieces have 5 to 23 words, 9 on average, and
are linked when equal, which needs no bands. Unequal pieces can reach 0.8 (8 of 9 words do), so a
near copy pasted into a line is found by its equal pieces only, and missed where these are too few.

Linked paragraphs form components; a paragraph repeats when its component spans documents. The
smallest document of a component keeps its copy, and so a word goes only where no paragraph around
it is kept. Repeated paragraphs that touch are merged to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import lowered, map_texts, prepared, ragged, table, written
from larkspur.llm.components import components
from larkspur.llm.rules import word_numbers
from larkspur.plans.registry import Query

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 4
#: Lines of fewer words are left to the fine grain: from 8 words against 9 on (4 of 5 shingles), unequal lines reach 0.8.
LINE_WORDS = 8
RADIUS, LONG_PIECE = 4, 24
#: Words of the shortest passage reported.
PASSAGE_WORDS = 20
#: Paragraphs compared in one task; more are cut into cells.
CELL_ROWS = 256
#: Rows without an id are named by a hash of their text, from this number on.
UNNAMED = 1 << 62
#: Sorted keys sent to every task while they are so few (8 bytes each); beyond, a join does it.
SENT_KEYS = 500_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEEDS = (np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _A) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(29))


def _hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word laid end to end, and the number of words of each text."""
    flat, sizes, vocabulary = word_numbers(texts)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in vocabulary), np.uint64, len(vocabulary))[flat], sizes


def _sequence_keys(each: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of the word sequence at ``starts``, laid end to end with these ``sizes``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(int(sizes.max()), _A, np.uint64))
    rows, place = ragged(sizes)
    weighted = _mixed(each[starts[rows] + place]) * powers[place]
    return _mixed(np.add.reduceat(weighted, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def _shingles(each: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each line laid end to end, and their numbers."""
    numbers = sizes - SHINGLE + 1
    rows, place = ragged(numbers)
    at = starts[rows] + place
    key = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        key = _mixed((key + each[at + k]) * _A)
    return key, numbers


def _bands(shingles: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Band keys (lines x BANDS) of the MinHash signatures."""
    first = np.cumsum(numbers) - numbers
    out = np.zeros((len(numbers), BANDS), np.uint64)
    for k, seed in enumerate(_SEEDS):
        lowest = np.minimum.reduceat(_mixed(shingles * seed + np.uint64(k)), first)
        out[:, k // ROWS] = _mixed((out[:, k // ROWS] + lowest) * _A + np.uint64(k))
    return out


def _pieces(each: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the fine paragraphs of texts laid end to end."""
    n = len(each)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, place = ragged(sizes)
    before = np.zeros_like(each)
    before[1:] = each[:-1]
    before[place == 0] = 0
    value = _mixed(each + _mixed(before))
    low = np.ones(n, bool)
    for step in range(1, RADIUS + 1):
        near = rows[step:] == rows[:-step]
        low[step:] &= ~near | (value[step:] < value[:-step])
        low[:-step] &= ~near | (value[:-step] < value[step:])
    starts = np.flatnonzero(low | (place == 0))
    lengths = np.diff(np.append(starts, n))
    # periodic text has no lowest word: cut it evenly
    parts = np.where(lengths >= LONG_PIECE, lengths // 12, 1)
    owner, k = ragged(parts)
    last = k == parts[owner] - 1
    return starts[owner] + 12 * k, np.where(last, lengths[owner] - 12 * k, 12)


def _lines(text: str | None) -> list[list[bytes]]:
    return [line.split() for line in lowered(text).split(b"\n")]


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc, start, n, key, bands): all paragraphs; bands are null at the fine grain."""

    def work(batch: pa.RecordBatch) -> dict[str, object] | None:
        split = [_lines(t) for t in batch.column("text").to_pylist()]
        each, sizes = _hashes([[w for line in lines for w in line] for lines in split])
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        heads = np.cumsum(sizes) - sizes
        counts = np.fromiter((len(line) for lines in split for line in lines), np.int64)
        owner = np.repeat(np.arange(len(split)), [len(lines) for lines in split])
        starts = np.cumsum(counts) - counts
        long = counts >= LINE_WORDS
        owner, starts, counts = owner[long], starts[long], counts[long]
        fine_starts, fine_sizes = _pieces(each, sizes)
        fine = fine_sizes >= SHINGLE
        fine_starts, fine_sizes = fine_starts[fine], fine_sizes[fine]
        fine_owner = np.searchsorted(heads + sizes, fine_starts, side="right")
        bands = [None] * len(fine_starts)
        if len(starts):
            bands = _bands(*_shingles(each, starts, counts)).view(np.int64).tolist() + bands
        at, n, of = (np.concatenate(x) for x in ((starts, fine_starts), (counts, fine_sizes), (owner, fine_owner)))
        if not len(at):
            return None
        keys = np.concatenate([_sequence_keys(each, starts, counts), _sequence_keys(each, fine_starts, fine_sizes)])
        return {
            "doc": ids[of].astype(np.int64),
            "start": (at - heads[of]).astype(np.int32),
            "n": n.astype(np.int32),
            "key": keys.view(np.int64),
            "bands": bands,
        }

    own = F.pmod(F.xxhash64("text"), F.lit(UNNAMED)) + F.lit(UNNAMED)
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("doc_id"), "text")
    return map_texts(source, "doc long, start int, n int, key long, bands array<long>", work)


def shared_keys(occurrences: DataFrame) -> DataFrame:
    """(key, first): keys that stand in two documents or more, and the smallest of those."""
    ends = occurrences.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    return ends.where("first < last").select("key", "first")


def colliding(lines: DataFrame) -> DataFrame:
    """(band, key): members of bands that hold two different lines or more.

    Bands are sorted within their partition and read in a stream; nothing of a band is kept but
    its last row, however long it is.
    """
    members = lines.select("key", F.explode("bands").alias("band"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, bool] | None = None  # the last row, and whether its band has others
        for batch in batches:
            band, key = (batch.column(c).to_numpy() for c in ("band", "key"))
            if held is not None:
                band, key = np.concatenate([[held[0]], band]), np.concatenate([[held[1]], key])
            same = band[1:] == band[:-1]
            after = np.append(same, False)
            ahead = np.insert(same, 0, held[2] if held is not None else False)
            show = ahead | after
            held = (int(band[-1]), int(key[-1]), bool(ahead[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(band[:-1][show[:-1]]), pa.array(key[:-1][show[:-1]])], names=["band", "key"])
        if held is not None and held[2]:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]])], names=["band", "key"])

    return members.repartition("band").sortWithinPartitions("band", "key").mapInArrow(run, "band long, key long")


def line_shingles(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, shingles): the sorted different shingles of the lines in ``keys``.

    The texts are read once more. Few keys are sent to the tasks as a sorted array, so that other
    lines never leave them; more than SENT_KEYS are joined instead.
    """
    few = keys.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    spark = docs.sparkSession
    chosen = np.zeros(0, np.int64)
    if few:
        chosen = np.sort(np.fromiter((k for (k,) in keys.toLocalIterator()), np.int64))
    sent = spark.sparkContext.broadcast(chosen)

    def work(batch: pa.RecordBatch) -> dict[str, object] | None:
        each, counts = _hashes([line for t in batch.column("text").to_pylist() for line in _lines(t)])
        starts = np.cumsum(counts) - counts
        long = counts >= LINE_WORDS
        starts, counts = starts[long], counts[long]
        found = _sequence_keys(each, starts, counts).view(np.int64)
        found, one = np.unique(found, return_index=True)
        if few:
            known = np.isin(found, sent.value)
            found, one = found[known], one[known]
        if not len(found):
            return None
        shingles, numbers = _shingles(each, starts[one], counts[one])
        sets = [np.unique(s).view(np.int64) for s in np.split(shingles, np.cumsum(numbers)[:-1])]
        return {"key": found, "shingles": sets}

    made = map_texts(docs.select("text"), "key long, shingles array<long>", work)
    if not few:
        made = made.join(keys, "key", "left_semi")
    return made.groupBy("key").agg(F.any_value("shingles").alias("shingles"))


def similar(clusters: DataFrame, shingles: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that connect all lines of a cluster that share a band and are similar.

    Clusters beyond CELL_ROWS are cut into chunks, each pair of chunks a cell of its own. In a cell
    only lines that share a band are compared, and only while they are not connected yet.
    """
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks").cast("long")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(F.col("chunk"), other).cast("long") * F.lit(1 << 31) + F.greatest(F.col("chunk"), other),
    )
    placed = (
        clusters.join(sizes, "component")
        .withColumn("chunks", F.ceil(F.col("size") / CELL_ROWS).cast("int"))
        .withColumn("chunk", chunk)
        .join(shingles, "key")
        .join(lines.select("key", "bands"), "key")
        .select("component", F.explode(cells).alias("cell"), "key", "bands", "shingles")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, list, list]] = []
        name = None
        for batch in batches:
            for component, cell, key, bands, own in zip(*(batch.column(c).to_pylist() for c in ("component", "cell", "key", "bands", "shingles")), strict=True):
                if (component, cell) != name:
                    yield from links(group)
                    group, name = [], (component, cell)
                group.append((key, bands, own))
        yield from links(group)

    def links(group: list[tuple[int, list, list]]) -> Iterator[pa.RecordBatch]:
        if len(group) < 2:
            return
        bands = np.array([g[1] for g in group])
        sets = [frozenset(g[2]) for g in group]
        root = list(range(len(group)))

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        a, b = [], []
        for k in range(1, len(group)):
            for other in np.flatnonzero((bands[:k] == bands[k]).any(axis=1)).tolist():
                if top(k) == top(other):
                    continue
                both = len(sets[k] & sets[other])
                if both >= similarity * (len(sets[k]) + len(sets[other]) - both):
                    root[top(k)] = top(other)
                    a.append(group[other][0])
                    b.append(group[k][0])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    # the rows of a cell are few and small, so Arrow's batches may cut through it
    return placed.repartition("component", "cell").sortWithinPartitions("component", "cell", "key").mapInArrow(
        run, "a long, b long"
    )


def repeated_passages(
    docs: DataFrame, similarity: float = SIMILARITY, passage_words: int = PASSAGE_WORDS
) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, class_id, removed, removed_spans): repeated passages.

    Words are counted from 0 over the whole text, ends are exclusive. ``class_id`` is the smallest
    doc_id that holds a part of the passage, itself included. ``removed_spans`` are the words to
    remove, as "start:end,...": those in repeated paragraphs of which a smaller doc_id keeps a copy,
    but for words that also stand in a paragraph kept here. So every paragraph is kept once, also
    where a passage meets one class at its head and another at its tail. ``removed`` tells whether
    there are any. Passages start at ``passage_words``; a passage pasted into other text is found
    from about 30 words on. Repeats inside one document alone do not count. Null and empty texts
    have no paragraphs. Repeated rows with the same id are one document; rows without an id are
    named by a hash of their text (from UNNAMED on), so equal ones are one document too.
    """
    prepared(docs.sparkSession)
    found = written(paragraphs(docs), "paragraphs")
    fine, coarse = found.where("bands IS NULL"), found.where("bands IS NOT NULL")
    lines = written(
        coarse.groupBy("key").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.any_value("bands").alias("bands")
        ),
        "lines",
    )
    met = written(colliding(lines), "collisions")
    # all members of a band hang on its smallest line: the clusters hold every pair that meets
    least = met.groupBy("band").agg(F.min("key").alias("a"))
    stars = met.join(least, "band").select("a", F.col("key").alias("b"))
    clusters = written(components(stars).select(F.col("node").alias("key"), "component"), "clusters")
    shingles = line_shingles(docs, clusters.select("key"))
    links = similar(clusters, shingles, lines, similarity)
    classes = components(links)
    spans = (
        lines.join(classes.withColumnRenamed("node", "key"), "key")
        .groupBy("component")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    linked = classes.join(spans, "component").where("first < last").select(F.col("node").alias("key"), "first")
    alone = lines.where("first < last").select("key", "first").join(
        classes.select(F.col("node").alias("key")), "key", "left_anti"
    )
    repeated = fine.join(shared_keys(fine), "key").select("doc", "start", "n", "first").unionByName(
        coarse.join(linked.unionByName(alone), "key").select("doc", "start", "n", "first")
    )
    return _merged(repeated, passage_words)


def _merged(repeated: DataFrame, passage_words: int) -> DataFrame:
    """Passages of the repeated paragraphs (doc, start, n, first); repeated rows do not matter.

    A sweep over the places where paragraphs start and end counts how many cover the words up to
    the next place, and how many of these are kept. Places are summed before the shuffle.
    """
    own = F.when(F.col("doc") == F.col("first"), 1).otherwise(0)
    start, end = F.col("start"), F.col("start") + F.col("n")
    nobody = F.lit(None).cast("long")
    marks = [
        F.struct(start.alias("at"), F.lit(1).alias("cover"), own.alias("own"), F.col("first").alias("first")),
        F.struct(end.alias("at"), F.lit(-1).alias("cover"), (-own).alias("own"), nobody.alias("first")),
    ]
    places = repeated.select("doc", F.inline(F.array(*marks))).groupBy("doc", "at").agg(
        F.sum("cover").alias("cover"), F.sum("own").alias("own"), F.min("first").alias("first")
    )
    by_place = Window.partitionBy("doc").orderBy("at")
    upto = by_place.rowsBetween(Window.unboundedPreceding, 0)
    stretches = (
        places.withColumn("covered", F.sum("cover").over(upto))
        .withColumn("gone", (F.sum("own").over(upto) == 0) & (F.col("covered") > 0))
        .withColumn("until", F.lead("at").over(by_place))
        .withColumn("run", F.sum(F.when(F.col("covered") == F.col("cover"), 1).otherwise(0)).over(upto))
        .withColumn("turn", F.when(F.col("gone") == F.lag("gone").over(by_place), 0).otherwise(1))
        .withColumn("part", F.sum("turn").over(upto))
        .where("covered > 0")
    )
    parts = stretches.groupBy("doc", "run", "part").agg(
        F.min("at").cast("long").alias("start"), F.max("until").cast("long").alias("end"),
        F.min("first").alias("first"), F.first("gone").alias("gone"),
    )
    # a list is as long as its document at most
    spans = F.array_sort(F.collect_list(F.when(F.col("gone"), F.struct("start", "end"))))
    spelled = F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])))
    runs = parts.groupBy("doc", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("first").alias("first"), spelled.alias("removed_spans"),
    )
    n_words = F.col("end") - F.col("start")
    return runs.where(n_words >= passage_words).select(
        F.col("doc").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        n_words.alias("n_words"),
        F.col("first").alias("class_id"),
        (F.col("removed_spans") != "").alias("removed"),
        "removed_spans",
    )


def op3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents with their class and the words to remove."""
    return repeated_passages(table(prepared(spark), sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_paragraphs": Query(op3_paragraphs)}
