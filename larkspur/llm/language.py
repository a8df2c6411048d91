"""Language ID by interpolated Kneser-Ney character models, one for each language.

Texts become lower-case letters with single blanks between words. For each language the n-grams up
to an order are counted: the longest ones by occurrences, shorter ones by the different characters
before them, as Kneser-Ney asks. Every n-gram seen gets its interpolated probability once and for
all, every context its back-off weight, and both lie in arrays sorted by a 64-bit hash. A text goes
to the language with the lowest cross-entropy per character; how sure that is comes from a slope
calibrated on texts that the counts have not seen, and so does the entropy beyond which a text is
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, prepared, remainder, slices, table
from larkspur.plans.registry import Query

ORDER = 4
#: Documents a language that the models are learned from, in the order of a hash of the id.
LEARN_ROWS = 1500
#: One in so many of them calibrates instead of being counted.
CALIBRATE = 5
#: Share of calibration texts of a language that rejection may cost.
REJECTED = 0.005
UNKNOWN = "und"
_BLANK = 32
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def letters(text: str | None) -> np.ndarray:
    """Code points of a whole text: a blank, then lower-case words with single blanks behind."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, np.uint32)
    known = _letters()[points]
    keep = known.copy()
    keep[1:] |= known[:-1]
    kept, real = points[keep], known[keep]
    kept = np.where(real, kept, _BLANK)
    if not real.any():
        return np.zeros(0, np.uint64)
    tail = [_BLANK] if real[-1] else []
    return np.concatenate([[_BLANK], kept, tail]).astype(np.uint64)


def gram_keys(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each place from ``order - 1`` on."""
    n = len(points) - order + 1
    key = np.zeros(max(0, n), np.uint64)
    for k in range(order if n > 0 else 0):
        key = (key + points[k : k + n] + np.uint64(1)) * _PRIME
        key ^= key >> np.uint64(31)
    return key


def _different(flat: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different windows of ``order`` characters that start at ``at``, and which one each is."""
    alphabet = np.flatnonzero(np.bincount(flat.astype(np.int64)))
    size = len(alphabet)
    if size**order > 1 << 25:  # many characters: sort hashes instead of numbering all windows
        keys = gram_keys(flat, order)[at]
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return flat[at[first][:, None] + np.arange(order)], place
    number = np.zeros(int(alphabet[-1]) + 1, np.int32)
    number[alphabet] = np.arange(size, dtype=np.int32)
    digits = number[flat]
    code = np.zeros(len(flat) - order + 1, np.int32)
    for k in range(order):
        code = code * np.int32(size) + digits[k : k + len(code)]
    code = code[at]
    used = np.zeros(size**order, bool)
    used[code] = True
    rows = np.flatnonzero(used)
    place = np.zeros(size**order, np.int32)
    place[rows] = np.arange(len(rows), dtype=np.int32)
    powers = size ** np.arange(order - 1, -1, -1)
    return alphabet[(rows[:, None] // powers) % size].astype(np.uint64), place[code]


@dataclass
class Model:
    """Sorted hashes of n-grams with log probabilities and of contexts with log back-off weights."""

    grams: list[np.ndarray] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0

    def log_probability(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each row of code points after the others."""
        order = windows.shape[1]
        out, back = np.zeros(len(windows)), np.zeros(len(windows))
        open_rows = np.arange(len(windows))
        for n in range(order, 0, -1):
            rows = windows[open_rows, order - n :]
            hit, value = _find(self.grams[n - 1], self.logs[n - 1], _hash_rows(rows))
            done = open_rows[hit]
            out[done] = back[done] + value[hit]
            open_rows, rows = open_rows[~hit], rows[~hit]
            seen, weight = _find(self.contexts[n - 1], self.weights[n - 1], _hash_rows(rows[:, :-1]))
            back[open_rows] += np.where(seen, weight, 0.0)
        out[open_rows] = back[open_rows] + self.floor
        return out


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    key = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        key = (key + rows[:, k] + np.uint64(1)) * _PRIME
        key ^= key >> np.uint64(31)
    return key


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted, values[at]


def train(windows: np.ndarray, counts: np.ndarray, characters: int) -> Model:
    """Model from the different windows of ORDER code points and how often each occurs.

    The discount of an order is n1 / (n1 + 2 n2) of its counts. The uniform floor spreads over all
    characters known to any language and one unknown.
    """
    order = windows.shape[1]
    made: list[tuple[np.ndarray, np.ndarray]] = [(windows, counts.astype(np.float64))]
    for _ in range(order - 1):
        # a shorter n-gram counts the different n-grams that it ends
        rows = made[-1][0][:, 1:]
        _, first, number = np.unique(_hash_rows(rows), return_index=True, return_counts=True)
        made.append((rows[first], number.astype(np.float64)))
    model = Model(floor=-float(np.log(characters + 1)))
    for n, (rows, number) in enumerate(reversed(made), start=1):
        ones, twos = (number == 1).sum(), (number == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        own, place = np.unique(_hash_rows(rows[:, :-1]), return_inverse=True)
        total = np.bincount(place, number)
        weight = discount * np.bincount(place) / total
        if n == 1:
            lower = np.full(len(rows), np.exp(model.floor))
        else:
            lower = np.exp(model.log_probability(rows[:, 1:]))
        value = np.log((number - discount) / total[place] + weight[place] * lower)
        keys = _hash_rows(rows)
        by_key = np.argsort(keys)
        model.grams.append(keys[by_key])
        model.logs.append(value[by_key])
        model.contexts.append(own)
        model.weights.append(np.log(weight))
    return model


@dataclass
class Identifier:
    """Models by language (sorted), the slope of the posterior, and entropy limits by language."""

    languages: list[str]
    models: list[Model]
    slope: float = 1.0
    limits: np.ndarray | None = None

    def entropies(self, texts: list[np.ndarray], order: int = ORDER) -> np.ndarray:
        """Mean negative log probability per character, by text and language."""
        sizes = np.array([max(0, len(t) - 1) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.models)))
        if not sizes.sum() or not self.models:
            return out
        # blanks ahead make a full window at each character
        padded = [np.concatenate([np.full(order - 2, _BLANK, np.uint64), t]) for t in texts if len(t)]
        flat = np.concatenate([np.concatenate(padded), np.zeros(order, np.uint64)])
        filled = np.flatnonzero(sizes)
        lengths = np.array([len(p) for p in padded])
        starts = np.cumsum(lengths) - lengths
        n = sizes[filled]
        at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        windows, place = _different(flat, at, order)
        heads = np.cumsum(n) - n
        for k, model in enumerate(self.models):
            logs = model.log_probability(windows)
            out[filled, k] = -np.add.reduceat(logs[place], heads) / n
        return out

    def posteriors(self, entropies: np.ndarray) -> np.ndarray:
        low = entropies - entropies.min(axis=1, keepdims=True)
        odds = np.exp(-self.slope * low)
        return odds / odds.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, order: int = ORDER, bound: int = LEARN_ROWS) -> Identifier:
    """Learn from text and lang of documents whose crc32 modulo 4 is not 2 and whose lang is known.

    Of each language the ``bound`` documents of the smallest hash of the id are used, whole: the
    bound keeps the models small enough to send to every task, however large the corpus. Tasks
    count the windows of their texts, Spark sums them by language.
    """
    spark = prepared(docs.sparkSession)
    known = docs.where("lang IS NOT NULL").where(remainder(4) != 2)
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("lang"))
    ids = known.select("lang", draw.alias("__draw"))
    # Spark cuts each task's rows to the bound ahead of the shuffle, so no language meets whole
    order_by = F.row_number().over(Window.partitionBy("lang").orderBy("__draw"))
    last = ids.withColumn("k", order_by).where(F.col("k") <= bound).groupBy("lang").agg(F.max("__draw").alias("__last"))
    # one row a language, and every task is sent a model of each anyway; the texts stay in place
    chosen = known.withColumn("__draw", draw).join(F.broadcast(last), "lang").where("__draw <= __last")
    rows = chosen.select("lang", "text", (F.pmod("__draw", F.lit(CALIBRATE)) == 0).alias("held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs = np.array(part.column("lang").to_pylist(), object)
            held = np.array(part.column("held").to_pylist(), bool)
            texts = part.column("text").to_pylist()
            for lang in sorted(set(langs)):
                pieces = [
                    np.concatenate([np.full(order - 2, _BLANK, np.uint64), t])
                    for i in np.flatnonzero((langs == lang) & ~held)
                    if len(t := letters(texts[i]))
                ]
                if not pieces:
                    continue
                all_windows = np.concatenate(
                    [np.lib.stride_tricks.sliding_window_view(p, order) for p in pieces]
                )
                _, first, number = np.unique(
                    _hash_rows(all_windows), return_index=True, return_counts=True
                )
                flat = all_windows[first].astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(first), pa.string()),
                        pa.array([row.tobytes() for row in flat], pa.binary()),
                        pa.array(number, pa.int64()),
                    ],
                    names=["lang", "chars", "n"],
                )

    counted = rows.mapInArrow(count, "lang string, chars binary, n long").groupBy("lang", "chars").agg(F.sum("n").alias("n"))
    by_lang: dict[str, tuple[list[bytes], list[int]]] = {}
    for lang, chars, n in counted.toLocalIterator():  # bounded by the documents learned from
        keys, numbers = by_lang.setdefault(lang, ([], []))
        keys.append(bytes(chars))
        numbers.append(n)
    languages = sorted(by_lang)
    grids = {
        lang: np.frombuffer(b"".join(by_lang[lang][0]), np.uint32).reshape(-1, order).astype(np.uint64)
        for lang in languages
    }
    characters = len(set().union(*(np.unique(g).tolist() for g in grids.values()))) if grids else 0
    made = Identifier(
        languages, [train(grids[lang], np.array(by_lang[lang][1]), characters) for lang in languages]
    )
    return calibrated(made, rows.where("held"), spark)


def calibrated(made: Identifier, held: DataFrame, spark: SparkSession) -> Identifier:
    """Slope and limits from the held texts: highest likelihood, and the REJECTED quantile."""
    shared = spark.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [letters(t) for t in part.column("text").to_pylist()]
            some = [k for k, t in enumerate(texts) if len(t)]
            if some:
                found = shared.value.entropies([texts[k] for k in some])
                langs = part.column("lang").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[k] for k in some], pa.string()), pa.array(found.tolist(), pa.list_(pa.float64()))],
                    names=["lang", "h"],
                )

    place = {lang: k for k, lang in enumerate(made.languages)}
    rows = held.mapInArrow(run, "lang string, h array<double>").collect() if place else []
    rows = [(place[r.lang], r.h) for r in rows if r.lang in place]  # bounded as above
    made.limits = np.full(len(made.languages), np.inf)
    if rows:
        truth, h = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        slopes = 2.0 ** np.arange(0, 8, 0.5)
        cost = []
        for slope in slopes:
            made.slope = float(slope)
            cost.append(-np.log(np.maximum(made.posteriors(h)[np.arange(len(h)), truth], 1e-12)).mean())
        made.slope = float(slopes[int(np.argmin(cost))])
        for k in range(len(made.languages)):
            if (truth == k).any():
                made.limits[k] = np.quantile(h[truth == k, k], 1 - REJECTED)
    return made


def identify(docs: DataFrame, made: Identifier, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``__lang``, ``__score`` (posterior) and ``__rejected`` (entropy over the limit).

    A text without letters, a null text, or no model at all gives ``und``, score 0, rejected. Ties
    go to the first language by code point. All rows stay.
    """
    shared = prepared(docs.sparkSession).sparkContext.broadcast(made)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        made: Identifier = shared.value
        texts = [letters(t) for t in batch.column("text").to_pylist()]
        if not made.models:
            n = len(texts)
            return {"__lang": [UNKNOWN] * n, "__score": [0.0] * n, "__rejected": [True] * n}
        some = np.array([len(t) > 0 for t in texts])
        found = made.entropies(texts)
        best = found.argmin(axis=1)
        own = np.arange(len(texts))
        return {
            "__lang": [made.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)],
            "__score": np.where(some, made.posteriors(found)[own, best], 0.0),
            "__rejected": ~some | (found[own, best] > made.limits[best]),
        }

    return add_columns(docs, "__lang string, __score double, __rejected boolean", work, drop)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(prepared(spark), sf_dir, "documents")
    made = fit(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), made, drop=("text",)).select(
        "doc_id",
        (remainder(4) == 2).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
        F.col("__rejected").alias("rejected"),
    )


QUERIES = {"op6_language": Query(op6_language)}
