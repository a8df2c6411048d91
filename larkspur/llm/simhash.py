"""Near-duplicates by SimHash: a byte-position index with count filtering, verified by distance.

A fingerprint has eight bytes. Two that differ in at most four bits differ in at most four bytes,
so they share at least four of the eight positional bytes: the guaranteed minimum. Posting lists of
single bytes would hold a fixed share of all rows, so the index posts triples of positions. The
triples are chosen such that any four positions hold at least one of them: with the positions in
three classes, a triple lies in one class or has two members in a class and one in the next. That
makes 20 postings of 24 bits for a fingerprint. Pairs that meet in a posting get the tally of all
their shared positional bytes, those below four are dropped, the rest verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, map_texts, prepared, set_aside, table, words, written
from larkspur.llm.components import components, local_roots
from larkspur.plans.registry import Query

BITS, BYTES = 64, 8
MAX_DISTANCE = 4
#: Fingerprints that one posting list compares in one task; longer lists are cut into cells.
LIST_ROWS = 4096
_CLASSES = ((0, 1, 2), (3, 4, 5), (6, 7))
TRIPLES = [
    triple
    for k, own in enumerate(_CLASSES)
    for triple in [
        *combinations(own, 3),
        *((*pair, other) for pair in combinations(own, 2) for other in _CLASSES[(k + 1) % 3]),
    ]
]
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, width: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``width`` words; of all words where there are fewer; none of none."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    if len(found) <= width:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    cuts = zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(view[i:j], seed) for i, j in cuts), np.uint64, len(found) - width + 1)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """SimHash of each document: a bit is set where over half its hashes have it."""
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    if not counts.sum():
        return out
    flat = np.concatenate(hashes)
    # a lane of eight bits counts up to 255 hashes, so rows are summed in runs of at most that many
    runs = -(-counts // 255)
    owner = np.repeat(np.arange(len(hashes)), runs)
    first = np.cumsum(runs) - runs
    at = (np.cumsum(counts) - counts)[owner] + (np.arange(len(owner)) - first[owner]) * 255
    filled = counts > 0
    for k in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(k)) & _LANES, at)
        ones = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        sums = np.add.reduceat(ones, first[filled], axis=0)
        over = np.zeros((len(hashes), 8), bool)
        over[filled] = 2 * sums > counts[filled, None]
        for byte in range(8):
            out |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def simhash(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long; no words give zero."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        hashes = [shingle_hashes(t, width, seed) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "fp": fingerprints(hashes).view(np.int64)}

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_texts(source, "doc_id long, fp long", work)


def _byte(position: int) -> F.Column:
    return F.shiftrightunsigned(F.col("fp"), 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame) -> DataFrame:
    """(posting, fp): the 20 postings of each distinct fingerprint."""
    keys = [
        (F.lit(k << 24) + _byte(x) * 65536 + _byte(y) * 256 + _byte(z)).cast("int")
        for k, (x, y, z) in enumerate(TRIPLES)
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("posting"))


def near_fingerprints(
    prints: DataFrame, distance: int = MAX_DISTANCE, list_rows: int = LIST_ROWS
) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` at ``distance`` bits or fewer.

    Lists of one fingerprint are dropped before the comparison. A list of more than ``list_rows``
    is cut into chunks, and each pair of chunks is a cell of its own, so no task holds a whole long
    list and no pair is missed. Of the pairs verified in a list, only a star for each group they
    connect is written: reachability is the same and the output stays below the rows of the lists.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError("the postings guarantee pairs of four differing bits or fewer")
    listed = postings(prints)
    sizes = listed.groupBy("posting").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(list_rows)).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int")
    cells = F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda other: F.least(F.col("chunk"), other).cast("long") * F.lit(1 << 31)
            + F.greatest(F.col("chunk"), other),
        )
    )
    spread = (
        listed.join(sizes, "posting")
        .withColumn("chunks", chunks)
        .withColumn("chunk", chunk)
        .select("posting", F.explode(cells).alias("cell"), "fp")
    )
    sorted_lists = spread.repartition("posting", "cell").sortWithinPartitions("posting", "cell", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if left is None else pa.concat_tables([left, rows]).combine_chunks()
            posting, cell = (rows.column(n).to_numpy() for n in ("posting", "cell"))
            # the last list may go on in the next batch; lists are bounded, so is what is kept
            same = (posting == posting[-1]) & (cell == cell[-1])
            cut = int(np.argmax(same))
            left = rows.slice(cut)
            yield from star(rows.slice(0, cut))
        if left is not None:
            yield from star(left)

    def star(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        if n < 2:
            return
        posting, cell, fp = (rows.column(c).to_numpy() for c in ("posting", "cell", "fp"))
        fp = fp.view(np.uint64)
        alive, step, pairs, held = np.arange(n - 1), 1, [], 0
        root = np.arange(n)
        while len(alive):
            alive = alive[alive + step < n]
            other = alive + step
            alive = alive[(posting[alive] == posting[other]) & (cell[alive] == cell[other])]
            other = alive + step
            differ = fp[alive] ^ fp[other]
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (tally >= BYTES - MAX_DISTANCE) & (np.bitwise_count(differ) <= distance)
            pairs.append((alive[near], other[near]))
            held += int(near.sum())
            if held > 1_000_000:
                root = _joined(root, pairs)
                pairs, held = [], 0
            step += 1
        root = _joined(root, pairs)
        moved = np.flatnonzero(root != np.arange(n))
        if len(moved):
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[moved].view(np.int64)), pa.array(fp[root[moved]].view(np.int64))],
                names=["a", "b"],
            )

    return sorted_lists.mapInArrow(compare, "a long, b long")


def _joined(root: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    own = np.arange(len(root))
    a = np.concatenate([own, *(p[0] for p in pairs)])
    b = np.concatenate([root, *(p[1] for p in pairs)])
    return local_roots(len(root), a, b)


def groups(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component_id, first): group of each distinct fingerprint of (doc_id, fp) rows.

    ``component_id`` is the group's smallest doc_id, ``first`` the fingerprint that bears it (the
    smallest such; of all where no document of the group has an id).
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return named(nodes, components(near_fingerprints(nodes.select("fp"), distance)))


def named(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """(fp, component_id, first) of all ``nodes`` (fp, least) grouped by ``linked`` (node, component)."""
    own = F.struct(F.col("least").isNull().alias("unnamed"), F.col("least").alias("id"), F.col("fp").alias("first"))
    named = linked.withColumnRenamed("node", "fp").join(nodes, "fp").withColumn("own", own)
    best = named.groupBy("component").agg(F.min("own").alias("best"))
    reached = named.join(best, "component").select("fp", "best")
    return nodes.join(reached, "fp", "left").select(
        "fp",
        F.coalesce("best.id", "least").alias("component_id"),
        F.coalesce("best.first", "fp").alias("first"),
    )


def deduplicated(docs: DataFrame, distance: int = MAX_DISTANCE, width: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest doc_id.

    Repeated rows of that id and fingerprint leave one. Groups without any id keep one row too.
    Texts are hashed twice rather than written once more; they meet the list of keepers by id and
    fingerprint, so no group of copies meets in one task.
    """
    prepared(docs.sparkSession)
    docs, back = set_aside(docs)
    prints = written(simhash(docs, width, seed), "fingerprints")

    def again(batch: pa.RecordBatch) -> dict[str, object]:
        hashes = [shingle_hashes(t, width, seed) for t in batch.column("text").to_pylist()]
        return {"__print": fingerprints(hashes).view(np.int64)}

    keepers = groups(prints, distance).where("fp = first").select(
        F.col("fp").alias("__fp"), F.col("component_id").alias("__id")
    )
    own = add_columns(docs, "__print long", again)
    same = (F.col("__print") == F.col("__fp")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    once = F.row_number().over(Window.partitionBy("__fp", "__id").orderBy(F.lit(0)))
    return back(own.join(keepers, same).withColumn("__once", once).where("__once = 1"))


def near_duplicates(
    docs: DataFrame, distance: int = MAX_DISTANCE, width: int = 4, seed: int = 42
) -> DataFrame:
    """(doc_id, fp, component_id): near-duplicate groups of all documents.

    Documents are linked when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest doc_id reachable. Equal fingerprints are one node, so copies
    cost one row each. Null and empty texts share the fingerprint zero. A null doc_id takes part,
    but names a component only if no other id is in it (then null). Repeated rows are kept.
    """
    prepared(docs.sparkSession)
    prints = written(simhash(docs, width, seed), "fingerprints")
    labels = groups(prints, distance).select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = near_duplicates(table(prepared(spark), sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": Query(op2_simhash)}
