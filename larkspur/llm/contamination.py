"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents are normalised to the same words. All items of a benchmark go into one suffix
automaton, each inserted from the root, so that a path never crosses from one item to the next.
Documents stream through it: every word extends the longest match or falls back along suffix links.
Where a match is a window long (13 words, or a whole item of fewer), the window's words are hit and
the state names the items it belongs to.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, prepared, set_aside, table, written
from larkspur.plans.registry import Query

WINDOW = 13
#: Words of items in one automaton. A larger benchmark is taken in several, one pass each.
PIECE_WORDS = 100_000
#: Letters and digits of ASCII and everything beyond it are parts of words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    """Words of a whole text with A-Z lower-cased; a null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Automaton:
    """Suffix automaton over word numbers, with the windows that its states complete."""

    vocabulary: dict[bytes, int]
    step: list[dict[int, int]]
    link: list[int]
    length: list[int]
    full: list[int]  # the state of the suffix of WINDOW words, or 0
    short: list[int]  # the nearest state upwards that is a whole short item, or 0
    items: dict[int, tuple[int, ...]]  # item numbers by such states
    names: list[str | None]
    pairs: np.ndarray  # sorted keys of word pairs that stand in some item
    least: int  # words of the shortest window

    @classmethod
    def build(cls, texts: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> Automaton:
        vocabulary: dict[bytes, int] = {}
        rows = [[vocabulary.setdefault(w, len(vocabulary)) for w in found] for _, found in texts]
        step, link, length = [{}], [-1], [0]

        def extend(last: int, word: int) -> int:
            """Add ``word`` behind the state ``last``; the state of the longer prefix."""
            if (old := step[last].get(word)) is not None:
                if length[old] == length[last] + 1:
                    return old
                return split(last, word, old)
            new = add({}, -1, length[last] + 1)
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            if at < 0:
                link[new] = 0
            else:
                old = step[at][word]
                link[new] = old if length[old] == length[at] + 1 else split(at, word, old)
            return new

        def split(at: int, word: int, old: int) -> int:
            """Part the shorter strings of ``old`` off into a state of their own."""
            copy = add(dict(step[old]), link[old], length[at] + 1)
            link[old] = copy
            while at >= 0 and step[at].get(word) == old:
                step[at][word] = copy
                at = link[at]
            return copy

        def add(ways: dict[int, int], up: int, size: int) -> int:
            step.append(ways)
            link.append(up)
            length.append(size)
            return len(step) - 1

        for row in rows:
            state = 0
            for word in row:
                state = extend(state, word)
        full, short, owners = [0] * len(step), [0] * len(step), {}
        order = sorted(range(1, len(step)), key=length.__getitem__)
        for v in order:
            if length[v] >= window:
                full[v] = v if length[link[v]] < window else full[link[v]]
        for number, row in enumerate(rows):
            state = 0
            for place, word in enumerate(row):
                state = step[state][word]
                if place + 1 >= window:
                    owners.setdefault(full[state], {})[number] = None
            if row and len(row) < window:
                owners.setdefault(state, {})[number] = None
                short[state] = state
        for v in order:
            short[v] = short[v] or short[link[v]]
        keys = {a * len(vocabulary) + b for row in rows for a, b in pairwise(row)}
        return cls(
            vocabulary, step, link, length, full, short,
            {state: tuple(found) for state, found in owners.items()},
            [name for name, _ in texts],
            np.array(sorted(keys), np.int64),
            min((min(len(row), window) for row in rows if row), default=0),
        )

    def runs(self, numbers: np.ndarray) -> np.ndarray:
        """Starts and ends of the stretches that can hold a window: all their pairs are in items.

        The longest match is one word at most behind a pair that no item has, so the automaton
        may start anew there without losing a match.
        """
        known = numbers >= 0
        if self.least == 1:
            linked = known[:-1] & known[1:]
        else:
            key = numbers[:-1] * max(1, len(self.vocabulary)) + numbers[1:]
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            linked = known[:-1] & known[1:]
            linked &= self.pairs[at] == key if len(self.pairs) else False
        edge = np.diff(np.concatenate([[0], linked.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        if self.least == 1:  # single known words
            lone = known.copy()
            for a, b in zip(starts, ends, strict=True):
                lone[a:b] = False
            single = np.flatnonzero(lone)
            starts, ends = np.concatenate([starts, single]), np.concatenate([ends, single + 1])
        keep = ends - starts >= self.least
        return np.stack([starts[keep], ends[keep]], axis=1)

    def spans(self, numbers: list[int], window: int = WINDOW) -> tuple[list[tuple[int, int]], set]:
        """Windows completed while streaming over ``numbers``, and the items they belong to."""
        step, link, length = self.step, self.link, self.length
        state = size = 0
        found, items = [], set()
        for place, word in enumerate(numbers):
            while state and word not in step[state]:
                state = link[state]
                size = length[state]
            state = step[state].get(word, 0)
            size = size + 1 if state else 0
            if size >= window:
                found.append((place + 1 - window, place + 1))
                items.update(self.items[self.full[state]])
            up = self.short[state]
            while up:
                if length[up] <= size:
                    found.append((place + 1 - length[up], place + 1))
                    items.update(self.items[up])
                up = self.short[link[up]]
        return found, items


def pieces(items: DataFrame, window: int, limit: int):
    """Items as (name, words) in lists of about ``limit`` words, read one after the other.

    An item longer than that is cut into parts that share window - 1 words, so that every window
    lies in a part.
    """
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    group, held = [], 0
    for name, text in rows.toLocalIterator():
        found = normal_words(text)
        stride = max(1, limit - window + 1)
        for start in range(0, max(1, len(found) - window + 1), stride):
            part = found[start : start + stride + window - 1]
            if group and held + len(part) > limit:
                yield group
                group, held = [], 0
            group.append((name, part))
            held += len(part)
    yield group


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, piece_words: int = PIECE_WORDS,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with ``__words``, ``__spans`` (start, end, ... of hit words) and ``__items``.

    ``__items`` are the distinct item ids with an occurring window; windows of items without an id
    count as hits but are not listed. Null and empty texts have no words; an empty benchmark hits
    nothing. Rows and their other columns stay as they are, repeated rows included; columns named
    in ``drop`` are left out.
    """
    spark = prepared(docs.sparkSession)
    out, ahead = docs, None
    for number, group in enumerate(pieces(items, window, piece_words)):
        if ahead is not None:
            out = written(_stream(out, ahead, window, number > 1, ()), "contamination")
        ahead = spark.sparkContext.broadcast(Automaton.build(group, window))
    return _stream(out, ahead, window, out is not docs, drop)


def _stream(docs: DataFrame, shared, window: int, again: bool, drop: tuple[str, ...]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict[str, object]:
        automaton: Automaton = shared.value
        found = [normal_words(t) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(w) for w in found], np.int64)
        get = automaton.vocabulary.get
        # a stop of -1 behind each document keeps stretches inside it
        numbers = np.fromiter(
            (n for row in found for n in (*(get(w, -1) for w in row), -1)), np.int64, int(sizes.sum()) + len(sizes)
        )
        first = np.cumsum(sizes + 1) - sizes - 1
        hits: list[list[tuple[int, int]]] = [[] for _ in found]
        items: list[set] = [set() for _ in found]
        if again:
            for row, flat in enumerate(batch.column("__spans").to_pylist()):
                hits[row] += zip(flat[::2], flat[1::2], strict=True)
            for row, names in enumerate(batch.column("__items").to_pylist()):
                items[row].update(names)
        for a, b in automaton.runs(numbers).tolist():
            row = int(np.searchsorted(first, a, side="right")) - 1
            spans, owners = automaton.spans(numbers[a:b].tolist(), window)
            at = a - int(first[row])
            hits[row] += [(x + at, y + at) for x, y in spans]
            items[row].update(n for o in owners if (n := automaton.names[o]) is not None)
        return {
            "__words": sizes,
            "__spans": [merged(spans) for spans in hits],
            "__items": [sorted(names) for names in items],
        }

    drop = (*drop, "__words", "__spans", "__items") if again else drop
    return add_columns(docs, "__words long, __spans array<int>, __items array<string>", work, drop)


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Union of the spans as start, end, start, end, ..."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def hit_words() -> F.Column:
    """Number of words in ``__spans``."""
    signed = F.transform(
        F.col("__spans"), lambda x, k: F.when(k % 2 == 1, x).otherwise(-x).cast("long")
    )
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def over_coverage(percent: int = 5) -> F.Column:
    """The coverage limit: some word is hit, and at least ``percent`` in a hundred are."""
    return (F.col("__hit") > 0) & (F.col("__hit") * 100 >= F.col("__words") * percent)


def without_contaminated(docs: DataFrame, items: DataFrame, percent: int = 5, **options) -> DataFrame:
    """Drop the documents over the coverage limit; all others stay untouched."""
    docs, back = set_aside(docs)
    found = contamination(docs, items, **options).withColumn("__hit", hit_words())
    return back(found.where(~over_coverage(percent)))


def cut_spans(docs: DataFrame, items: DataFrame, longest: int = WINDOW, **options) -> DataFrame:
    """Cut stretches of at least ``longest`` hit words out of the texts, and keep every document.

    ``n_chars``, where there is one, follows the new text.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column("text").to_pylist()
        for row, flat in enumerate(batch.column("__spans").to_pylist()):
            long = [(a, b) for a, b in zip(flat[::2], flat[1::2], strict=True) if b - a >= longest]
            if long:
                places = [m.span() for m in _WORD.finditer(texts[row])]
                for a, b in reversed(long):
                    texts[row] = texts[row][: places[a][0]] + texts[row][places[b - 1][1] :]
        return {"__text": texts}

    docs, back = set_aside(docs)
    found = contamination(docs, items, **options)
    cut = add_columns(found, "__text string", work, ("text",))
    new = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("long")}
    return back(cut.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns)))


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and occurring items of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), drop=("text",))
    return found.withColumn("__hit", hit_words()).select(
        "doc_id",
        F.col("__words").alias("n_words"),
        F.col("__hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("__items")).cast("binary"), 256).alias("items_sha256"),
        over_coverage().alias("contaminated"),
    )


_SQL = r"""
WITH norm AS (
  SELECT doc_id, row_number() OVER () AS k,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
    unnest([array_to_string(w[i:i + least(len(w), 13) - 1], ' ')
            FOR i IN range(1, len(w) - least(len(w), 13) + 2)]) AS win
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
cut AS (
  SELECT k, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS win
  FROM norm, sizes WHERE len(w) >= n),
met AS (SELECT cut.k, cut.n, cut.i, windows.item_id FROM cut JOIN windows ON cut.n = windows.n AND cut.win = windows.win),
hit AS (
  SELECT k, count(DISTINCT p) AS n_hit
  FROM (SELECT k, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT k, n, i FROM met)) GROUP BY k),
named AS (
  SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT k, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM norm LEFT JOIN hit USING (k) LEFT JOIN named USING (k)
"""

QUERIES = {"op7_contamination": Query(op7_contamination, _SQL)}
