"""Repeated bytes against all strings of the length, sorted suffixes against plain sorting, odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from larkspur.llm import suffixes

DOCS = "doc_id long, text string, marks int, __doc string, __twin string, n_chars long"


def brute(docs, length):
    first = defaultdict(lambda: None)
    for doc, text in docs:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - length + 1):
                s = data[i : i + length]
                first[s] = doc if first[s] is None else min(first[s], doc)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if doc is not None:
            for i in range(len(data) - length + 1):
                if first[data[i : i + length]] < doc:
                    gone[i : i + length] = b"\1" * length
        out.append((doc, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def rows(seed, count=60):
    rng = random.Random(seed)
    letters = "abcdeé中 \n"
    fresh = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [fresh(rng.randint(30, 200)) for _ in range(8)]
    docs = []
    for k in range(count):
        parts = [fresh(rng.randint(0, 120)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            parts.insert(rng.randint(0, len(parts)), p[a : len(p) - rng.randint(0, 20)])
        docs.append((rng.randint(0, count // 2) * 7 - 50, "".join(parts)))
    docs += [docs[3], docs[3], (None, passages[0]), (None, None), (5000, None), (5001, ""), (5002, "short")]
    docs += [(6000 + k, "x" * (40 + 15 * k)) for k in range(4)] + [(6100 + k, "ab" * 100 + f"{k}" * 60) for k in range(3)]
    docs += [(7000 + k, passages[1] + passages[2]) for k in range(40)]
    edited = list(passages[4] * 3)
    for k in range(10):
        edited[rng.randrange(len(edited))] = "Z"
        docs.append((8000 + k, "".join(edited)))
    docs += [(9000, "q".join(passages) * 40), (9001, "r".join(passages[::-1]) * 40)]
    return docs


def frame(spark, docs, parts=5):
    full = [(*d, 1, "a", "b", len(d[1] or "")) for d in docs]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def kept(found):
    return sorted(((r.doc_id, suffixes.kept_bytes((r.text or "").encode(), r.spans)) for r in found.collect()), key=str)


@pytest.mark.parametrize("length, deep", [(50, 20_000), (50, 1), (33, 1)])
def test_bytes_equal_brute_force(spark, monkeypatch, length, deep):
    """Whatever the sizes of ranges, chunks and deep buckets are."""
    docs = rows(length + deep)
    for name, value in (("HELD", 500), ("RANGE_BYTES", 4000), ("CHUNK", 40)):
        monkeypatch.setattr(suffixes, name, value)
    packed = suffixes.sent_anchors
    common = spark.sparkContext.broadcast(np.array([3, 2**63 + 1], np.uint64))
    plain = suffixes._documents(frame(spark, docs))
    monkeypatch.setattr(suffixes, "DEEP", deep)
    places = suffixes.met_anchors(packed(plain, length, 7, common)).cache()
    if deep == 1:
        assert places.where("deep").count() > 0
    found = suffixes.repeated_bytes(frame(spark, docs), length)
    assert set(found.columns) == {*DOCS.replace(",", "").split()[::2], "spans"}
    assert kept(found) == brute(docs, length)


def test_common_grams_change_nothing(spark, monkeypatch):
    docs = rows(11)
    everything = np.unique(suffixes.anchors([(t or "").encode() for _, t in docs], 50, suffixes.Common(np.zeros(0, np.uint64)))[2])
    monkeypatch.setattr(suffixes, "common_grams", lambda docs, length: everything[::2])
    assert kept(suffixes.repeated_bytes(frame(spark, docs))) == brute(docs, 50)


def test_refined_buckets_equal_plain_comparison():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 90, 300)
    data = rng.integers(0, 2, sizes.sum()).astype(np.uint8)
    base = rng.integers(0, 2, 84).astype(np.uint8)
    ends = np.cumsum(sizes)
    for k in range(0, 300, 2):
        n = min(sizes[k], 84)
        data[ends[k] - sizes[k] : ends[k] - sizes[k] + n] = base[:n]
    docs = rng.integers(0, 40, 300)
    for length in (33, 50):
        got = suffixes.repeats_earlier(data, sizes, docs, length)
        least, want = {}, np.zeros(len(data), bool)
        places = [(ends[k] - sizes[k] + i, docs[k]) for k in range(300) for i in range(sizes[k] - length + 1)]
        for p, d in places:
            s = data[p : p + length].tobytes()
            least[s] = min(least.get(s, d), d)
        for p, d in places:
            want[p] = least[data[p : p + length].tobytes()] < d
        assert (got == want).all() and want.any()


def test_every_string_has_an_anchor():
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(3000)) + b"z" * 300
    for common in (np.zeros(0, np.uint64), suffixes.grams(np.frombuffer(text, np.uint8))[::3]):
        _, place, _, _ = suffixes.anchors([b"", text, b"short", text[500:900]], 50, suffixes.Common(common))
        first = place[: np.flatnonzero(np.diff(place) < 0)[0] + 1] if (np.diff(place) < 0).any() else place
        at = np.zeros(len(text), bool)
        at[first] = True
        assert all(at[i : i + 35].any() for i in range(len(text) - 49))


def test_cut_texts_and_empty(spark):
    docs = rows(2)
    cut = suffixes.without_repeats(frame(spark, docs))
    want = sorted(((d, k.decode("utf-8", "ignore")) for d, k in brute(docs, 50)), key=str)
    got = sorted(((r.doc_id, r.text or "") for r in cut.collect()), key=str)
    assert got == want and cut.columns == frame(spark, []).columns
    assert suffixes.repeated_bytes(frame(spark, [], 1)).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_bytes(cut, 20)
