"""Requests of one piece of a block against the intervals in which drivers are available there.

Spark cuts blocks into pieces and deals them; this helper scores the pairs of one piece inside a
task, a chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from larkspur.functions import scoring

#: Pairs of a chunk, about.
PAIRS = 1 << 17
#: Requests of a chunk at most: those close in time see nearly the same drivers.
REQUESTS = 256
_NULL = np.iinfo(np.int64).min
_NAN = np.nextafter(0.0, 1.0)


def _whole(rows: pa.Table, name: str) -> np.ndarray:
    return pc.fill_null(rows[name].cast(pa.int64()), _NULL).to_numpy()


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    return pc.fill_null(rows[name].cast(pa.float64()), np.nan).to_numpy()


def _ranks(ts: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """Places of moments (ts, seq) in time, equal ones alike."""
    order = np.lexsort((seq, ts))
    ts, seq = ts[order], seq[order]
    rank = np.empty(len(ts), np.int64)
    rank[order] = np.cumsum(np.r_[False, (ts[1:] != ts[:-1]) | (seq[1:] != seq[:-1])][: len(ts)])
    return rank


def _chunks(rows: pa.Table) -> Iterator[tuple[pa.Table, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(requests, driver ids in text order, present, known, scores) of consecutive requests.

    ``present`` marks pairs whose interval holds the request's moment. Where a driver's rating or
    salary is not ``known``, there is no score.
    """
    gender = rows["gender"].combine_chunks().dictionary_encode()
    rows = rows.append_column("code", pc.fill_null(gender.indices, -1))
    whichever = pc.index(gender.dictionary, scoring.ANY_GENDER).as_py()
    whichever = -2 if whichever < 0 else whichever
    asked = pc.is_null(rows["driver_id"])
    asks, spans = rows.filter(asked), rows.filter(pc.invert(asked))
    if not len(asks) or not len(spans):
        return
    spans = spans.take(np.argsort(_whole(spans, "driver_id").astype("U20"), kind="stable"))
    ends = np.cumsum([len(asks), len(spans)])
    at, since, until = np.split(
        _ranks(
            np.concatenate([_whole(asks, "from_ts"), _whole(spans, "from_ts"), _whole(spans, "to_ts")]),
            np.concatenate([_whole(asks, "from_seq"), _whole(spans, "from_seq"), _whole(spans, "to_seq")]),
        ),
        ends,
    )
    since = np.where(spans["always"].to_numpy(), -1, since)
    until = np.where(spans["forever"].to_numpy(), np.iinfo(np.int64).max, until)
    order = np.argsort(at, kind="stable")
    asks, at = asks.take(order), at[order]
    drivers = spans["driver_id"].combine_chunks()
    known = (pc.is_valid(spans["rating"]).to_numpy()) & (pc.is_valid(spans["salary"]).to_numpy())
    lat, lon, code = (f(spans, c) for f, c in ((_numbers, "latitude"), (_numbers, "longitude"), (_whole, "code")))
    rated = _numbers(spans, "rating") / scoring.MAX_RATING * scoring.RATING_WEIGHT
    paid = (1 - _numbers(spans, "salary") / scoring.MAX_SALARY) * scoring.SALARY_WEIGHT
    y, x, wish = (f(asks, c) for f, c in ((_numbers, "latitude"), (_numbers, "longitude"), (_whole, "code")))
    step = max(1, min(REQUESTS, PAIRS // len(spans)))
    for first in range(0, len(asks), step):
        part = slice(first, first + step)
        when = at[part, None]
        near = np.flatnonzero((since < when[-1]) & (until > when[0]))
        if not len(near):
            continue
        present = (since[near] < when) & (when < until[near])
        distance = np.sqrt((lat[near] - y[part, None]) ** 2 + (lon[near] - x[part, None]) ** 2)
        fits = (code[near] >= 0) & ((wish[part, None] == whichever) | (wish[part, None] == code[near]))
        scores = (
            np.exp(-distance) * scoring.DISTANCE_WEIGHT + fits * scoring.GENDER_WEIGHT + rated[near] + paid[near]
        )
        yield asks.slice(first, step), drivers.take(pa.array(near)), present, known[near], scores


def best_drivers(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(seq, client_id, driver_id, score) of each request's best driver of positive score.

    Equal scores go to the driver first in text order; NaN comes after every positive score.
    """
    for asks, drivers, present, known, scores in _chunks(rows):
        worth = np.where(present & known, np.where(np.isnan(scores), _NAN, scores), -np.inf)
        which = worth.argmax(axis=1)
        of = np.flatnonzero(worth[np.arange(len(which)), which] > 0)
        which = which[of]
        columns = [asks[c].combine_chunks().take(pa.array(of)) for c in ("seq", "client_id")]
        yield pa.RecordBatch.from_arrays(
            [*columns, drivers.take(pa.array(which)), pa.array(scores[of, which])],
            names=["seq", "client_id", "driver_id", "score"],
        )
