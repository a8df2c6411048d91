"""Degree counts, vertex sets, PageRank and influencer search over edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from larkspur.session import cut_lineage, materialise, more_tasks


def follower_count(edges: DataFrame) -> DataFrame:
    """In-degree with repeated edges counted."""
    return edges.groupBy(F.col("dst").alias("user_id")).agg(F.count(F.lit(1)).alias("followers"))


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return first.unionByName(second)


def vertex_set(edges: DataFrame) -> DataFrame:
    """Distinct ids over both edge ends, from one pass over the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def dangling_vertices(edges: DataFrame) -> DataFrame:
    """Vertices without an outgoing edge."""
    targets = edges.select(F.col("dst").alias("id")).distinct()
    return targets.join(edges.select(F.col("src").alias("id")), "id", "left_anti")


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def adjacency(edges: DataFrame, span: int = 1024) -> DataFrame:
    """Sorted neighbours per source, in blocks of ``span`` consecutive ids.

    (src, block, neighbours): block = floor(dst / span), so a list never holds more than ``span``
    ids, however many neighbours the source has.
    """
    block = F.floor(F.col("dst") / F.lit(span)).cast("bigint")
    return (
        distinct_edges(edges)
        .groupBy("src", block.alias("block"))
        .agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))
    )


def attach_rank(vertices: DataFrame, ranks: DataFrame, default: float = 0.0) -> DataFrame:
    """(id, rank) for every vertex; the default where no rank is known."""
    return vertices.select("id").join(ranks.select("id", "rank"), "id", "left").fillna(
        default, ["rank"]
    )


def best_neighbour(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per source the followee of greatest rank, ties to the smaller id: (id, best, rank).

    ``ranks`` must hold every edge target.
    """
    best = F.max(F.struct(F.col("rank").alias("rank"), (-F.col("dst")).alias("neg")))
    return (
        edges.join(ranks.select(F.col("id").alias("dst"), "rank"), "dst")
        .groupBy(F.col("src").alias("id"))
        .agg(best.alias("_best"))
        .select("id", (-F.col("_best.neg")).alias("best"), F.col("_best.rank").alias("rank"))
    )


def influencer_two_hop(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per user, the best followee of that followee whose best followee ranks highest.

    A followee that follows nobody stands for id 0 with rank 0; users already followed, and the
    user, are not left out.
    """
    vertices = vertex_set(edges)
    first = best_neighbour(edges, attach_rank(vertices, ranks))
    passed = (
        vertices.join(first, "id", "left")
        .select(
            F.col("id").alias("dst"),
            F.coalesce("best", F.lit(0)).cast("bigint").alias("_best"),
            F.coalesce("rank", F.lit(0.0)).alias("_rank"),
        )
    )
    choice = F.max(F.struct(F.col("_rank").alias("rank"), (-F.col("_best")).alias("neg")))
    return (
        edges.join(passed, "dst")
        .groupBy(F.col("src").alias("user_id"))
        .agg(choice.alias("_c"))
        .select(
            "user_id",
            (-F.col("_c.neg")).alias("recommended_id"),
            F.col("_c.rank").alias("influence"),
        )
    )


def contributions(edges_out: DataFrame, ranks: DataFrame) -> DataFrame:
    """(id, received): rank shares summed per target, partly before the shuffle."""
    return (
        edges_out.join(ranks.select(F.col("id").alias("src"), "rank", "copy"), ["src", "copy"])
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col("rank") / F.col("degree")).alias("received"))
    )


def sum_by_key(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """One round of rank contributions, summed per receiving vertex."""
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    return contributions(
        edges.join(out, "src").withColumn("copy", F.lit(0)), ranks.withColumn("copy", F.lit(0))
    )


def pagerank(
    edges: DataFrame,
    iters: int = 10,
    damping: float = 0.85,
    dangling: str = "spread",
    block: int = 1_000_000,
) -> DataFrame:
    """(id, rank) after ``iters`` rounds from rank 1.

    ``dangling="spread"``: vertices without out-edges give their rank evenly to all vertices,
    as if they followed everyone, and this share is damped like any other.
    ``dangling="post"``: receivers are updated first (others drop to nothing), then the new
    rank of the dangling vertices is spread evenly over all, undamped.

    The edges are written once, then laid out by source and kept; each round shuffles only the
    ranks and the partly summed contributions. A source of more than ``block`` edges is spread over several
    partitions by target, its rank copied to each. The dangling share is a scalar subquery: no
    product of vertices. The ranks, a small part of the edges' volume, are checkpointed in every
    round: each is read twice in the next one, so its plan would double otherwise.
    """
    if dangling not in ("spread", "post"):
        raise ValueError("dangling must be 'spread' or 'post'")
    pairs = distinct_edges(edges)
    degrees = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    copies = F.ceil(F.col("degree") / F.lit(block)).cast("int")
    outgoing = materialise(
        pairs.join(degrees, "src").withColumn(
            "copy", F.pmod(F.xxhash64("dst"), copies).cast("int")
        ),
        "outgoing",
    )
    laid_out = kept_by(outgoing, "src", "copy")
    ends = outgoing.select(F.col("src").alias("id"), copies.alias("copies")).unionByName(
        outgoing.select(F.col("dst").alias("id"), F.lit(0).alias("copies"))
    )
    vertices = kept_by(
        materialise(ends.groupBy("id").agg(F.max("copies").alias("copies")), "vertices"), "id"
    )
    size = float(vertices.count())
    base = F.lit(1.0 - damping)

    ranks = vertices.withColumn("rank", F.lit(1.0))
    for _ in range(iters):
        sent = ranks.filter("copies > 0").withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
        )
        joined = vertices.join(contributions(laid_out, sent), "id", "left")
        if dangling == "spread":
            share = _dangling_mass(ranks) / size
            rank = base + damping * (F.coalesce("received", F.lit(0.0)) + share)
            ranks = cut_lineage(joined.select("id", "copies", rank.alias("rank")))
        else:
            rank = F.coalesce(base + damping * F.col("received"), F.lit(0.0))
            updated = cut_lineage(joined.select("id", "copies", rank.alias("rank")))
            share = _dangling_mass(updated) / size
            ranks = updated.withColumn("rank", F.col("rank") + share)
    result = ranks.select("id", "rank")
    if dangling == "post":
        result = cut_lineage(result)
    laid_out.unpersist()
    vertices.unpersist()
    return result


def kept_by(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, a written table, cached in the layout its joins on ``keys`` need: no exchange and no sort per round.

    It is filled at once, since a join sees the layout of a filled cache only.
    """
    tasks = more_tasks(df, df.count())
    laid = df.repartition(tasks, *keys) if tasks else df.repartition(*keys)
    kept = laid.sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def _dangling_mass(ranks: DataFrame) -> Column:
    """Total rank of the vertices without out-edges, 0 when there are none; a scalar."""
    return (
        ranks.filter("copies = 0")
        .agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("mass"))
        .scalar()
    )
