import random

import pytest

from larkspur import session
from larkspur.operators import graph as ops
from larkspur.plans.tables import links, raw_edges
from tests.conftest import plan_text


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def brute(pairs, rounds, dangling):
    pairs = set(pairs)
    vertices = {v for p in pairs for v in p}
    out = {v: [d for s, d in pairs if s == v] for v in vertices}
    loose = [v for v in vertices if not out[v]]
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(rounds):
        received = {}
        for v in vertices:
            targets = out[v] or (vertices if dangling == "spread" else [])
            for d in targets:
                received[d] = received.get(d, 0.0) + rank[v] / len(targets)
        if dangling == "spread":
            rank = {v: 0.15 + 0.85 * received.get(v, 0.0) for v in vertices}
        else:
            rank = {v: 0.15 + 0.85 * received[v] if v in received else 0.0 for v in vertices}
            share = sum(rank[v] for v in loose) / len(vertices)
            rank = {v: r + share for v, r in rank.items()}
    return rank


@pytest.mark.parametrize("dangling", ["spread", "post"])
@pytest.mark.parametrize("block", [3, 1_000_000])
def test_pagerank_against_brute_force(spark, dangling, block):
    rng = random.Random(3)
    pairs = [(rng.randrange(8), rng.randrange(12)) for _ in range(30)] + [(0, i) for i in range(1, 12)]
    got = {r.id: r.rank for r in ops.pagerank(edges(spark, pairs), 10, dangling=dangling, block=block).collect()}
    expected = brute(pairs, 10, dangling)
    assert got.keys() == expected.keys()
    assert all(abs(got[v] - expected[v]) < 1e-9 for v in got)


@pytest.mark.parametrize("dangling", ["spread", "post"])
def test_pagerank_without_dangling_vertices_keeps_all(spark, dangling):
    got = {r.id: r.rank for r in ops.pagerank(edges(spark, [(0, 1), (1, 2), (2, 1)]), dangling=dangling).collect()}
    assert set(got) == {0, 1, 2}
    if dangling == "spread":
        assert {v: round(r, 3) for v, r in got.items()} == {0: 0.15, 1: 1.369, 2: 1.481}


def test_rank_then_recommend(spark):
    pairs = [(1, 2), (1, 3), (2, 4), (3, 5), (6, 5), (7, 5), (8, 1)]
    ranks = ops.pagerank(edges(spark, pairs))
    got = {r.user_id: r.recommended_id for r in ops.influencer_two_hop(edges(spark, pairs), ranks).collect()}
    # 5 is followed most; followees that follow nobody stand for 0; 2 and 3 tie behind 1
    assert got == {1: 5, 2: 0, 3: 0, 6: 0, 7: 0, 8: 2}


def test_best_neighbour_tie_to_smaller_id(spark):
    ranks = spark.createDataFrame([(2, 1.0), (3, 1.0), (4, 0.5)], "id bigint, rank double")
    got = ops.best_neighbour(edges(spark, [(1, 4), (1, 3), (1, 2)]), ranks).first()
    assert (got.id, got.best, got.rank) == (1, 2, 1.0)


def test_adjacency_blocks_are_bounded(spark):
    got = ops.adjacency(edges(spark, [(1, d) for d in range(100)] * 2), span=16).collect()
    assert max(len(r.neighbours) for r in got) == 16
    assert sorted(d for r in got for d in r.neighbours) == list(range(100))


def test_no_cartesian_product(spark):
    plan = plan_text(ops.contributions(
        links(spark, "/root/testdata/sf0.001").selectExpr("src", "dst", "1 as degree", "0 as copy"),
        spark.range(5).selectExpr("id", "1.0D as rank", "0 as copy"),
    ))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "partial_sum" in plan


def test_vertex_set_reads_its_edges_once_in_bounded_tasks(spark, tmp_path, monkeypatch):
    """One derivation of the edges for both ends; tasks follow the rows where the session has too few."""
    orders = [(k, 100 + k % 3) for k in range(40)] + [(None, 7), (3, 55), (3, 55)]
    lines = [(k % 40, 500 + k % 11) for k in range(90)] + [(None, 8), (5, None), (99, 9)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = {(a, d) for k, a in orders for j, d in lines if k is not None and k == j}
    for task_rows in (1_000_000, 10):
        monkeypatch.setattr(session, "TASK_ROWS", task_rows)
        ids = ops.vertex_set(raw_edges(spark, str(tmp_path)))
        assert plan_text(ids).count("Join") == 1 and "Union" not in plan_text(ids)
        assert ("REPARTITION_BY_NUM" in plan_text(ids)) == (task_rows == 10)
        assert sorted((r.id for r in ids.collect()), key=str) == sorted({v for p in want for v in p}, key=str)
        found = links(spark, str(tmp_path)).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want
