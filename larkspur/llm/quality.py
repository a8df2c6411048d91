"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's evidence is a handful of binned measures of its own and of the
lines before and behind it; neighbouring labels are tied by transition weights. Forward and
backward passes give each line's probability of being good, and their mean, weighted by the length
of the lines, is calibrated to the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, prepared, remainder, slices, table
from larkspur.llm.rules import labelled
from larkspur.plans.registry import Query

#: At most so many labelled documents are learned from, in the order of a hash of the id.
LEARN_ROWS = 4000
ROUNDS = 120
_UPPER, _LOWER, _DIGITS = (bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
_SYMBOLS, _SHOUTS = b"#*$%&|<>", b"!?"
# upper ends of the bins of each measure; the last bin is open
_BINS = [
    np.array(edges)
    for edges in (
        [0.5, 3.5, 9.5, 29.5, 99.5],  # words
        [0.02, 0.1, 0.3, 0.6, 0.9],  # capitals in ASCII letters
        [0.001, 0.01, 0.05, 0.15, 0.3],  # symbols in bytes
        [0.001, 0.01, 0.05, 0.15, 0.3],  # shouts in bytes
        [0.001, 0.02, 0.1, 0.3, 0.6],  # digits in bytes
        [0.1, 0.3, 0.5, 0.7, 0.9],  # different words in words
        [2.5, 4.5, 6.5, 9.5, 14.5],  # bytes in a word
        [0.5, 1.5, 2.5, 4.5, 9.5],  # earlier lines that equal it
    )
]
MEASURES, WIDTH = len(_BINS), 6


def line_bins(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins (lines x measures) and lengths of the lines of a whole text; no text is an empty line."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    seen: dict[bytes, int] = {}
    rows = np.zeros((len(lines), MEASURES))
    for k, line in enumerate(lines):
        n, found = len(line), line.split()
        before = seen.get(line, 0)
        seen[line] = before + 1
        if not found:
            continue
        upper = n - len(line.translate(None, _UPPER))
        lower = n - len(line.translate(None, _LOWER))
        rows[k] = (
            len(found), upper / max(1, upper + lower),
            1 - len(line.translate(None, _SYMBOLS)) / n, 1 - len(line.translate(None, _SHOUTS)) / n,
            1 - len(line.translate(None, _DIGITS)) / n, len(set(found)) / len(found),
            (n - len(found) + 1) / len(found), before,
        )
    bins = np.stack([np.searchsorted(e, rows[:, m]) for m, e in enumerate(_BINS)], axis=1)
    return bins.astype(np.int8), np.fromiter((len(line) + 1 for line in lines), np.int64, len(lines))


def _shifted(bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of each line's weights: own, previous and next bins; WIDTH stands beyond an end."""
    n = len(bins)
    before = np.full_like(bins, WIDTH)
    before[1:] = bins[:-1]
    before[first] = WIDTH
    behind = np.full_like(bins, WIDTH)
    behind[:-1] = bins[1:]
    behind[np.concatenate([first[1:], [n]]) - 1] = WIDTH
    columns = np.concatenate([bins, before, behind], axis=1).astype(np.int64)
    return columns + np.arange(3 * MEASURES) * (WIDTH + 1)


@dataclass
class Field:
    """Weights: evidence for good of each bin, transitions, and the calibration of the mean."""

    evidence: np.ndarray
    moves: np.ndarray  # 2 x 2, from the label before to the label
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, index: np.ndarray, sizes: np.ndarray):
        """Probability of good for each line, expected moves, and log-partition of each document."""
        first = np.cumsum(sizes) - sizes
        score = self.evidence[index].sum(axis=1)
        local = np.stack([np.zeros_like(score), score], axis=1)
        order = np.argsort(-sizes, kind="stable")
        # documents with a line at this place come first in ``order``
        alive = np.searchsorted(-sizes[order], -np.arange(int(sizes.max())), side="left")
        ahead, back = np.zeros_like(local), np.zeros_like(local)
        for place, n in enumerate(alive):
            at = first[order[:n]] + place
            ahead[at] = local[at]
            if place:
                ahead[at] += np.logaddexp(
                    ahead[at - 1][:, :1] + self.moves[0], ahead[at - 1][:, 1:] + self.moves[1]
                )
        for place in range(len(alive) - 2, -1, -1):
            at = first[order[: alive[place + 1]]] + place
            onward = back[at + 1] + local[at + 1]
            back[at] = np.logaddexp(
                onward[:, :1] + self.moves[:, 0], onward[:, 1:] + self.moves[:, 1]
            )
        end = ahead[first + sizes - 1]
        total = np.logaddexp(end[:, 0], end[:, 1])
        whole = np.repeat(total, sizes)
        good = np.exp(ahead[:, 1] + back[:, 1] - whole)
        inner = np.ones(len(index), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        onward = back[at] + local[at]
        pairs = ahead[at - 1][:, :, None] + self.moves[None] + onward[:, None, :]
        moved = np.exp(pairs - whole[at][:, None, None]).sum(axis=0)
        return good, moved, total

    def means(self, index: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted mean probability of good of each document."""
        good = self.marginals(index, sizes)[0]
        first = np.cumsum(sizes) - sizes
        return np.add.reduceat(good * lengths, first) / np.add.reduceat(lengths, first)

    def scores(self, index: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Calibrated document scores between 0 and 1."""
        mean = np.clip(self.means(index, sizes, lengths), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.shift)))


def learn(documents: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = ROUNDS) -> Field:
    """Fit a field to (bins, lengths, label) of labelled documents, whose lines bear their label.

    Gradient ascent on the conditional likelihood per line with an L2 penalty, then a logistic
    calibration of the document means. With no rows, or one label alone, the scores are constant.
    """
    size = 3 * MEASURES * (WIDTH + 1)
    field = Field(np.zeros(size), np.zeros((2, 2)))
    labels = np.array([d[2] for d in documents], np.int64)
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        field.slope, field.shift = 0.0, float(np.log(share / (1 - share)))
        return field
    sizes = np.array([len(d[0]) for d in documents], np.int64)
    first = np.cumsum(sizes) - sizes
    index = _shifted(np.concatenate([d[0] for d in documents]), first)
    lengths = np.concatenate([d[1] for d in documents])
    truth = np.repeat(labels, sizes)
    # both labels, and all documents whatever their lines, weigh alike
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight = np.repeat(balance / sizes, sizes) / len(labels)
    inner = np.ones(len(index), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[at - 1], truth[at]), 1.0)
    mean, square = np.zeros(size + 4), np.zeros(size + 4)
    for k in range(1, rounds + 1):
        good, moved, _ = field.marginals(index, sizes)
        slope = np.bincount(index.ravel(), np.repeat((truth - good) * weight, index.shape[1]), size)
        step = np.concatenate([slope - 1e-4 * field.evidence, ((seen - moved) / len(index) - 1e-2 * field.moves).ravel()])
        mean = 0.9 * mean + 0.1 * step
        square = 0.99 * square + 0.01 * step**2
        change = 0.15 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        field.evidence += change[:size]
        field.moves += change[size:].reshape(2, 2)
    logit = np.clip(field.means(index, sizes, lengths), 1e-6, 1 - 1e-6)
    logit = np.log(logit / (1 - logit))
    a, b = 1.0, 0.0
    for _ in range(25):  # Newton steps of the two calibration parameters
        p = 1 / (1 + np.exp(-(a * logit + b)))
        w = p * (1 - p) + 1e-6
        g = np.array([((labels - p) * logit).sum() - 1e-2 * a, (labels - p).sum()])
        h = np.array([[(w * logit**2).sum() + 1e-2, (w * logit).sum()], [(w * logit).sum(), w.sum()]])
        a, b = (a, b) + np.linalg.solve(h, g)
    field.slope, field.shift = float(max(a, 0.0)), float(b)
    return field


def fit(docs: DataFrame, labels: DataFrame, bound: int = LEARN_ROWS) -> Field:
    """Learn from at most ``bound`` labelled documents whose crc32 modulo 3 is not 1.

    Only text and ``quality`` are used. Tasks measure the lines, so bins of a bounded number of
    documents reach the driver; the fit itself is small. Null labels are not learned from.
    """
    marks = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .where(remainder(3) != 1)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__quality"))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [line_bins(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("__quality"),
                    pa.array([b.tobytes() for b, _ in made], pa.binary()),
                    pa.array([n.astype(np.int32).tobytes() for _, n in made], pa.binary()),
                ],
                names=["doc_id", "label", "bins", "lengths"],
            )

    chosen = labelled(docs.select("doc_id", "text"), marks, bound)
    ddl = "doc_id long, label int, bins binary, lengths binary"
    chosen = chosen.select(F.col("doc_id").cast("long"), "text", F.col("__quality").cast("int"))
    rows = sorted(
        (r.doc_id, r.label, bytes(r.bins), bytes(r.lengths)) for r in chosen.mapInArrow(measure, ddl).collect()
    )  # bounded by ``bound``
    return learn(
        [
            (np.frombuffer(b, np.int8).reshape(-1, MEASURES), np.frombuffer(n, np.int32).astype(np.int64), int(y == 1))
            for _, y, b, n in rows
        ]
    )


def score(docs: DataFrame, field: Field, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``__score``; null and empty texts are one empty line. All rows stay."""
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(field)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        made = [line_bins(t) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(b) for b, _ in made], np.int64)
        index = _shifted(np.concatenate([b for b, _ in made]), np.cumsum(sizes) - sizes)
        return {"__score": shared.value.scores(index, sizes, np.concatenate([n for _, n in made]))}

    return add_columns(docs, "__score double", work, drop)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    field = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, field, drop=("text",)).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op9_quality": Query(op9_quality)}
