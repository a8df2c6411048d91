"""What blocks, hashes and grams take on their way: compressed columns, each gram once a task."""

from collections import Counter

import numpy as np
import pyarrow as pa

from larkspur.functions import grams


def test_hashes_travel_by_their_steps():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << grams.HASH_BITS, 200_000).astype(np.uint64))
    raw = grams.packed(keys)
    assert len(raw) < 3.2 * len(keys)  # five bytes each before compression
    assert (grams.unpacked(raw) == keys).all()
    for few in (keys[:0], keys[:1], keys[-1:]):
        assert (grams.unpacked(grams.packed(few)) == few).all()


def test_a_block_comes_back_from_its_row():
    lists = [["b", "a", "b"], ["c"], [], ["b", "é", "a'b"]]
    batch = pa.RecordBatch.from_pydict({"words": pa.array(lists, pa.list_(pa.string()))})
    for size in (2, 100):
        got = []
        for row in grams.blocks_of(iter([batch]), size):
            block = grams.block_of(*(row.column(c)[0].as_py() for c in ("vocabulary", "codes", "lengths")))
            words = block.vocabulary.take(pa.array(block.codes)).to_pylist()
            got += [(w, int(n)) for w, n in zip(words, block.left, strict=True)]
        assert got == [(w, len(words) - n) for words in lists for n, w in enumerate(words)]


def test_a_task_sends_each_gram_once():
    rows = [("a", 1), ("a b", 2), ("é", 5), ("a", 2), ("c", 2)]
    batches = [pa.RecordBatch.from_pydict({"gram": [g], "cnt": pa.array([n], pa.int64())}) for g, n in rows]
    sent = list(grams.shares(iter(batches), 3))
    assert len(sent) == 1 and len(set(sent[0].column("part").to_pylist())) == sent[0].num_rows
    assert sum(len(grams.unpacked_texts(raw)) for raw in sent[0].column("grams").to_pylist()) == 4
    more = sent + list(grams.shares(iter(batches[4:]), 3))
    got = Counter()
    for part in range(8):
        some = [b.filter(pa.compute.equal(b.column("part"), part)) for b in more]
        if sum(map(len, some)):
            got.update(dict(zip(*grams.of_shares(pa.Table.from_batches(some), 3).to_pydict().values(), strict=True)))
    assert got == {"a": 3, "é": 5, "c": 4}
