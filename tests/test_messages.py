"""Vertex programs: ranks and components against plain loops, shrinking frontiers, split hubs."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur import session
from larkspur.operators import graph, messages


def edges_of(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "src long, dst long")


def random_pairs(seed, n=40, m=90):
    rng = random.Random(seed)
    return {(rng.randrange(n), rng.randrange(n)) for _ in range(m)} | {(100, 3), (7, 101), (5, 5)}


def ranks_by_loop(pairs, rounds, dangling):
    ids = sorted({v for p in pairs for v in p})
    out = {v: sum(a == v for a, _ in pairs) for v in ids}
    rank = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        got = {}
        for a, b in pairs:
            got[b] = got.get(b, 0.0) + rank[a] / out[a]
        if dangling == "spread":
            share = sum(rank[v] for v in ids if not out[v]) / len(ids)
            rank = {v: 0.15 + 0.85 * (got.get(v, 0.0) + share) for v in ids}
        else:
            new = {v: 0.15 + 0.85 * got[v] if v in got else 0.0 for v in ids}
            share = sum(new[v] for v in ids if not out[v]) / len(ids)
            rank = {v: new[v] + share for v in ids}
    return rank


@pytest.mark.parametrize("dangling", ["spread", "post"])
def test_pagerank(spark, dangling):
    pairs = random_pairs(3)
    found = messages.ranked(edges_of(spark, pairs), 4, block=2, dangling=dangling)
    got = {r.id: r.rank for r in found.vertices.collect()}
    assert got == pytest.approx(ranks_by_loop(pairs, 4, dangling), abs=1e-12)
    assert found.sent == [len(pairs)] * 4


def test_pagerank_to_a_tolerance(spark):
    pairs = random_pairs(8, 25, 120)
    found = messages.ranked(edges_of(spark, pairs), 100, tolerance=1e-4)
    got = {r.id: r.rank for r in found.vertices.collect()}
    assert got == pytest.approx(ranks_by_loop(pairs, len(found.sent), "spread"), abs=1e-12)
    assert got == pytest.approx(ranks_by_loop(pairs, 200, "spread"), abs=1e-3) and len(found.sent) < 40


def test_components_send_less_and_less(spark):
    pairs = {(k, k + 1) for k in range(12)} | {(30 + k, 30) for k in range(1, 9)} | {(50, 50), (60, 61)}
    found = messages.connected_components(edges_of(spark, pairs), block=3)
    got = {r.id: r.component for r in found.vertices.collect()}
    assert got == {v: 0 for v in range(13)} | {30 + k: 30 for k in range(9)} | {50: 50, 60: 60, 61: 60}
    assert found.sent[0] == 2 * (len(pairs) - 1) + 1
    assert all(a >= b for a, b in zip(found.sent, found.sent[1:])) and found.sent[-1] <= 2
    assert [(r.id, r.component) for r in messages.connected_components(edges_of(spark, set())).vertices.collect()] == []


def test_messages_both_ways_and_null_messages(spark):
    edges = edges_of(spark, {(1, 2), (1, 3), (2, 3), (9, 3)})
    vertices = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id long, x int")
    to_dst = messages.aggregate_messages(vertices, edges, F.col("x"), F.sum)
    assert {(r.id, r.message) for r in to_dst.collect()} == {(2, 10), (3, 10)}
    to_src = messages.aggregate_messages(vertices, edges, F.col("x") + F.col("sender"), F.max, to="src")
    assert {(r.id, r.message) for r in to_src.collect()} == {(1, 33), (2, 33), (9, 33)}
    with pytest.raises(ValueError):
        messages.aggregate_messages(vertices, edges, F.col("x"), F.sum, to="both")


def test_influencer_equals_the_joins(spark):
    pairs = random_pairs(11)
    edges = edges_of(spark, pairs)
    ranks = spark.createDataFrame([(v, float(v * 7 % 11)) for v in range(40)], "id long, rank double")
    want = graph.influencer_two_hop(edges, ranks)
    assert sorted(messages.influencer(edges, ranks).collect()) == sorted(want.collect())


def test_edges_are_derived_once(spark):
    """Vertices, degrees and layout read the distinct edges as written, not their derivation again."""
    for job in (lambda e: messages.ranked(e, rounds=1), messages.connected_components):
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = [(1, 2), (2, 3), (3, 3), (7, 8)]
        edges = spark.createDataFrame(rows, "src bigint, dst bigint").coalesce(1).mapInArrow(count, "src bigint, dst bigint")
        assert job(edges).vertices.count() == 5
        assert seen.value == len(rows)


def test_layouts_follow_the_edges(spark, monkeypatch):
    """Kept edges lie in as many tasks as their rows need; components are the same, hubs and NULL ends included."""
    pairs = [(k, k + 1) for k in range(20)] + [(50, 50 + k) for k in range(1, 9)] + [(None, 3), (7, None)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    want = {k: 0 for k in range(21)} | {50 + k: 50 for k in range(9)} | {None: None}
    for task_rows in (2_000_000, 5):
        monkeypatch.setattr(session, "TASK_ROWS", task_rows)
        kept = graph.kept_by(session.materialise(edges, "edges"), "src")
        assert task_rows > 5 or kept.rdd.getNumPartitions() == len(pairs) // 5
        kept.unpersist()
        got = messages.connected_components(edges, block=3).vertices.collect()
        assert len(got) == len(want) and {r.id: r.component for r in got} == want
