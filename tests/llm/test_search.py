"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id string, key int, bits string, score long"
ITEMS = "item_id string, text string, doc_id int, rank string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    found = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(bool(c) for _, c in found)
    total = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for name, text in items:
        asked, best = Counter(terms(text)), []
        for doc, counts in found:
            m = 75 + (25 * sum(counts.values()) * n) // total if total else 0
            score = sum(
                c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t, c in asked.items() if t in counts
            )
            if score > 0:
                best.append((-score, doc is None, doc or 0, doc))
        best.sort(key=lambda b: b[:3])
        out += [(name, k + 1, b[3], -b[0]) for k, b in enumerate(best[:top])]
    return sorted(out, key=str)


def rows(seed, count=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "İ", "中文", "x1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 200)))) for k in range(count)]
    docs += [(1000 + k, "same Copy, w7 w7 w9") for k in range(60)]
    docs += [(5, "w7"), (5, "w7"), (None, "same copy w9 w250"), (None, None), (7001, ""), (7002, " .,\n")]
    docs += [(7003, " ".join(rng.choices(vocabulary, k=30_000)) + " w250" * 500 + "X" * 100_000)]
    items = [(f"i{k}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for k in range(12)]
    items += [("i1", "same copy"), ("copy", "SAME same copy w9"), ("rare", "w250 w299"), (None, "w7 W7"), ("none", "zzz"), ("blank", ""), ("null", None)]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "c", 1, "c", 5) for d in docs], DOCS),
        spark.createDataFrame([(*i, 3, "c") for i in items], ITEMS),
    )


def results(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


@pytest.mark.parametrize("item_words", [search.ITEM_WORDS, 40])
def test_ranks_equal_scoring_everything(spark, item_words, monkeypatch):
    monkeypatch.setattr(search, "SENT_PAIRS", 200_000 if item_words > 40 else 0)
    docs, items = rows(2)
    d, i = frames(spark, docs, items)
    made = results(search.search(search.Index.build(d), i, item_words=item_words))
    assert made == brute(docs, items)


def test_no_bound_is_below_a_score(spark):
    docs, items = rows(4, 700)
    d, _ = frames(spark, docs, items)
    index = search.Index.build(d)
    asked = search.Items.build(index, [(n, [t.encode() for t in terms(x)]) for n, x in items])
    exact = {}
    for key, text in {(r.key, r.text) for r in index.docs.collect()}:
        counts = Counter(t.encode() for t in terms(text))
        norm = asked.norm(sum(counts.values()))
        exact[key] = np.array([asked.score(k, counts, norm) for k in asked.owners])
    near, all_ = 0, 0
    for b in index.blocks.collect():
        bound = asked.bounds(np.array(b.sizes, np.int64), b.width, b.bits)
        truth = np.stack([exact[k] for k in b["keys"]], axis=1)
        assert (bound >= truth).all()
        near += (bound <= 1.2 * truth + 1).sum()
        all_ += bound.size
    assert near > 0.8 * all_  # and few are far above


def test_empty(spark):
    docs, items = rows(3, 10)
    none, some = frames(spark, [], items)[0], frames(spark, docs, [])[1]
    assert results(search.search(search.Index.build(none), frames(spark, docs, items)[1])) == []
    assert results(search.search(search.Index.build(frames(spark, docs, items)[0]), some)) == []
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert results(search.search(search.Index.build(blank), frames(spark, docs, items)[1])) == []
