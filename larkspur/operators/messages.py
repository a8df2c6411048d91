"""Vertex programs: rounds of messages along edges, merged where they arrive.

A message is a Column over the sender's attributes, so sending, merging and updating run in the JVM.
Edges are laid out by sender once and kept; a round moves the state of the vertices that send, and
messages already merged in part. Vertices that are not active send nothing, so a frontier that
shrinks makes rounds cheaper. A sender of more than ``block`` edges is spread over several
partitions, its state copied to each.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.graph import distinct_edges, kept_by, vertex_set
from larkspur.session import cut_lineage, dealt, materialise

BLOCK = 1_000_000


def aggregate_messages(
    vertices: DataFrame, edges: DataFrame, message: Column, merge: Callable[[Column], Column], to: str = "dst"
) -> DataFrame:
    """(id, message): messages along all edges, merged for each receiver, once and without state.

    ``message`` sees the attributes of the sender, the vertex at the other end than ``to``, its id as
    ``sender``, and the columns of the edge. A null message is not sent; a vertex that nobody sends to
    has no row. ``vertices`` has one row for each ``id``; a sender without one sends nothing.
    """
    if to not in ("src", "dst"):
        raise ValueError("to must be 'src' or 'dst'")
    start = "src" if to == "dst" else "dst"
    sent = edges.withColumnsRenamed({start: "sender", to: "receiver"}).join(
        vertices.withColumnRenamed("id", "sender"), "sender"
    )
    return (
        sent.select(F.col("receiver").alias("id"), message.alias("message"))
        .where(F.col("message").isNotNull())
        .groupBy("id")
        .agg(merge(F.col("message")).alias("message"))
    )


@dataclass(frozen=True)
class Program:
    """What vertices send, how messages meet, and what they change.

    ``send`` is over a vertex's attributes, its ``id`` and ``degree`` (edges it sends along); null sends
    nothing. ``update`` gives new attributes from the old ones and ``message`` (null if none came).
    ``active``, over new attributes and old ones as ``old_<name>``, picks the vertices that send in the
    next round; without it all do. ``totals`` are aggregates over all vertices ahead of a round, one
    scalar each, that ``update`` may use by name. ``finish`` changes the state after each round.
    ``halt``, an aggregate over the same columns as ``active``, ends the run when it is true.
    """

    send: Column
    merge: Callable[[Column], Column]
    update: Mapping[str, Column]
    active: Column | None = None
    totals: Mapping[str, Column] = field(default_factory=dict)
    finish: Callable[[DataFrame], DataFrame] | None = None
    halt: Column | None = None


@dataclass
class Run:
    """The vertices after the last round, and the messages sent in each."""

    vertices: DataFrame
    sent: list[int]


def run(vertices: DataFrame, edges: DataFrame, program: Program, rounds: int, block: int = BLOCK) -> Run:
    """Run ``program`` from ``vertices`` (id, attributes) along distinct ``edges`` src -> dst.

    It ends after ``rounds``, when nobody is active, or when ``halt`` says so. Ends of edges without a
    row in ``vertices`` neither send nor receive. The state is checkpointed in every round.
    """
    return _run(vertices, _written(edges), program, rounds, block)


def _written(edges: DataFrame) -> DataFrame:
    """Distinct edges, made once: degrees, vertices and layout all read them."""
    return materialise(distinct_edges(edges), "pairs")


def _run(vertices: DataFrame, pairs: DataFrame, program: Program, rounds: int, block: int) -> Run:
    """``run`` along edges that are distinct."""
    degrees = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    copies = F.ceil(F.col("degree") / F.lit(block)).cast("int")
    # few senders are that large: only they meet the edges, so that those are neither shuffled nor sorted here
    large = materialise(degrees.where(F.col("degree") > F.lit(block)), "large")
    outgoing = pairs.where(F.col("src").isNotNull()).join(large, "src", "left").select(
        "src", F.coalesce(F.pmod(F.xxhash64("dst"), copies), F.lit(0)).cast("int").alias("copy"), "dst"
    )
    laid_out = kept_by(materialise(outgoing, "outgoing"), "src", "copy")
    names = [c for c in vertices.columns if c != "id"]
    state = vertices.join(degrees.withColumnRenamed("src", "id"), "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree"), F.lit(True).alias("_active"), *names
    )
    state = cut_lineage(state)
    found = Run(state, [])
    for _ in range(rounds):
        going, edges_sent = state.where("_active AND degree > 0").agg(
            F.count(F.lit(1)), F.coalesce(F.sum("degree"), F.lit(0))
        ).first()
        if not going:
            break
        found.sent.append(edges_sent)
        state, over = _round(state, laid_out, program, names, copies)
        if over:
            break
    laid_out.unpersist()
    found.vertices = state.select("id", *names)
    return found


def _round(
    state: DataFrame, laid_out: DataFrame, program: Program, names: list[str], copies: Column
) -> tuple[DataFrame, bool]:
    """The state after one more round, and whether the program halts there."""
    senders = state.where("_active AND degree > 0").select(
        F.col("id").alias("src"), program.send.alias("message"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
    )
    arrived = (
        laid_out.join(senders.where(F.col("message").isNotNull()), ["src", "copy"])
        .groupBy(F.col("dst").alias("id"))
        .agg(program.merge(F.col("message")).alias("message"))
    )
    joined = state.join(arrived, "id", "left")
    if program.totals:
        joined = joined.withColumns(
            {name: state.agg(total.alias(name)).scalar() for name, total in program.totals.items()}
        )
    changed = joined.select(
        "id", "degree", *(F.col(n).alias(f"old_{n}") for n in names),
        *(program.update.get(n, F.col(n)).alias(n) for n in names),
    )
    if program.finish:
        changed = program.finish(cut_lineage(changed))
    active = F.lit(True) if program.active is None else F.coalesce(program.active, F.lit(False))
    after = cut_lineage(changed.withColumn("_active", active))
    over = bool(program.halt is not None and after.agg(program.halt).first()[0])
    return after.select("id", "degree", "_active", *names), over


def pagerank_program(size: int, damping: float = 0.85, dangling: str = "spread", tolerance: float | None = None) -> Program:
    """PageRank over vertices (id, rank); see ``graph.pagerank`` for ``dangling``.

    With ``tolerance`` it halts when no rank has changed by more.
    """
    base = F.lit(1.0 - damping)
    lost = F.coalesce(F.sum(F.when(F.col("degree") == 0, F.col("rank"))), F.lit(0.0))
    halt = None if tolerance is None else F.max(F.abs(F.col("rank") - F.col("old_rank"))) <= tolerance
    send = F.col("rank") / F.col("degree")
    if dangling == "spread":
        rank = base + damping * (F.coalesce("message", F.lit(0.0)) + F.col("lost") / F.lit(float(size)))
        return Program(send, F.sum, {"rank": rank}, totals={"lost": lost}, halt=halt)

    def spread_after(state: DataFrame) -> DataFrame:
        return state.withColumn("rank", F.col("rank") + state.agg(lost.alias("lost")).scalar() / F.lit(float(size)))

    rank = F.coalesce(base + damping * F.col("message"), F.lit(0.0))
    return Program(send, F.sum, {"rank": rank}, finish=spread_after, halt=halt)


def ranked(edges: DataFrame, rounds: int = 10, block: int = BLOCK, **options) -> Run:
    """PageRank of all vertices of ``edges`` from rank 1, as a vertex program."""
    pairs = _written(edges)
    vertices = materialise(vertex_set(pairs), "vertices")
    program = pagerank_program(vertices.count(), **options)
    return _run(vertices.withColumn("rank", F.lit(1.0)), pairs, program, rounds, block)


def connected_components(edges: DataFrame, rounds: int = 1_000, block: int = BLOCK) -> Run:
    """(id, component): the smallest id that edges reach in either direction.

    A vertex sends only after its component has changed. Chains longer than ``rounds`` stay open.
    """
    pairs = _written(edges)
    ways = pairs.select("src", "dst").union(pairs.select("dst", "src"))
    both = _written(dealt(ways, 2 * pairs.count(), "src", "dst"))
    vertices = vertex_set(pairs).withColumn("component", F.col("id"))
    least = F.least("component", "message")
    program = Program(
        F.col("component"), F.min, {"component": least}, active=F.col("component") < F.col("old_component")
    )
    return _run(vertices, both, program, rounds, block)


def influencer(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """``graph.influencer_two_hop`` as two sweeps of messages from followees to followers."""

    def best(vertices: DataFrame, rank: str, name: Column) -> DataFrame:
        offer = F.struct(F.col(rank).alias("rank"), (-name).alias("neg"))
        return aggregate_messages(vertices, edges, offer, F.max, to="src")

    everyone = vertex_set(edges).join(ranks.select("id", "rank"), "id", "left").fillna(0.0, ["rank"])
    first = best(everyone, "rank", F.col("sender"))
    passed = everyone.select("id").join(first, "id", "left").select(
        "id",
        F.coalesce(-F.col("message.neg"), F.lit(0)).cast("bigint").alias("best"),
        F.coalesce("message.rank", F.lit(0.0)).alias("influence"),
    )
    return best(passed, "influence", F.col("best")).select(
        F.col("id").alias("user_id"),
        (-F.col("message.neg")).alias("recommended_id"),
        F.col("message.rank").alias("influence"),
    )
