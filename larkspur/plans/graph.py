"""Graph queries over the link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import graph as ops
from larkspur.operators import messages
from larkspur.plans.registry import Query
from larkspur.plans.tables import LINKS_SQL, RAW_EDGES_SQL, links, raw_edges, with_clauses
from larkspur.session import scratch_path
from larkspur.sources.files import read_edges, read_ranks
from larkspur.sources.sinks import write_tsv

_VERTICES_SQL = "vertices AS (SELECT src AS id FROM links UNION SELECT dst FROM links)"
_OUT_SQL = "outs AS (SELECT src, count(*) AS degree FROM links GROUP BY src)"
_DANGLING_SQL = """dangling AS (
  SELECT id FROM vertices WHERE NOT EXISTS (SELECT 1 FROM links WHERE src = id))"""


def _in_degree_ranks(edges: DataFrame) -> DataFrame:
    """Follower counts as ranks: cheap, whole-numbered and so equal in every engine."""
    return ops.follower_count(edges).select(
        F.col("user_id").alias("id"), F.col("followers").cast("double").alias("rank")
    )


def _pagerank_sql(rounds: int, dangling: str) -> str:
    clauses = [
        LINKS_SQL,
        _VERTICES_SQL,
        _OUT_SQL,
        _DANGLING_SQL,
        "size AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM vertices)",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM vertices)",
    ]
    for i in range(1, rounds + 1):
        received = f"""SELECT l.dst AS id, sum(r.rank / o.degree) AS received
    FROM links l JOIN outs o ON o.src = l.src JOIN r{i - 1} r ON r.id = l.src GROUP BY l.dst"""
        if dangling == "spread":
            clauses.append(f"""r{i} AS MATERIALIZED (
  SELECT v.id, 0.15 + 0.85 * (coalesce(c.received, 0) +
    (SELECT coalesce(sum(rank), 0) FROM r{i - 1} JOIN dangling USING (id)) / (SELECT n FROM size)) AS rank
  FROM vertices v LEFT JOIN ({received}) c ON c.id = v.id)""")
        else:
            clauses.append(f"""u{i} AS MATERIALIZED (
  SELECT v.id, CASE WHEN c.received IS NULL THEN 0 ELSE 0.15 + 0.85 * c.received END AS rank
  FROM vertices v LEFT JOIN ({received}) c ON c.id = v.id)""")
            clauses.append(f"""r{i} AS MATERIALIZED (
  SELECT id, rank + (SELECT coalesce(sum(rank), 0) FROM u{i} JOIN dangling USING (id))
    / (SELECT n FROM size) AS rank FROM u{i})""")
    return with_clauses(*clauses)


def _pagerank(dangling: str, rounds: int = 10) -> Query:
    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranks = ops.pagerank(links(spark, sf_dir), rounds, dangling=dangling)
        return ranks.select("id", F.round("rank", 6).alias("rank"))

    return Query(
        plan, _pagerank_sql(rounds, dangling) + f"SELECT id, round(rank, 6) AS rank FROM r{rounds}"
    )


def _ranked(dangling: str) -> Query:
    """The same ranks by a vertex program."""

    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = messages.ranked(links(spark, sf_dir), dangling=dangling)
        return found.vertices.select("id", F.round("rank", 6).alias("rank"))

    return Query(plan, _pagerank(dangling).sql)


#: Hops after which the check below has every vertex's smallest reachable id.
_HOPS = 16


def _components_sql() -> str:
    clauses = [LINKS_SQL, _VERTICES_SQL, "c0 AS MATERIALIZED (SELECT id, id AS component FROM vertices)"]
    clauses.append("ways AS MATERIALIZED (SELECT src, dst FROM links UNION SELECT dst, src FROM links)")
    for i in range(1, _HOPS + 1):
        clauses.append(f"""c{i} AS MATERIALIZED (
  SELECT a.id, least(min(a.component), min(b.component)) AS component
  FROM c{i - 1} a JOIN ways w ON w.dst = a.id JOIN c{i - 1} b ON b.id = w.src GROUP BY a.id)""")
    return with_clauses(*clauses) + f"SELECT id, component FROM c{_HOPS}"


def _rank_then_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks written as text by one job and read back by the next, which recommends."""
    path = scratch_path(spark, "ranks")
    write_tsv(ops.pagerank(links(spark, sf_dir)).select("id", F.round("rank", 6)), path)
    found = ops.influencer_two_hop(links(spark, sf_dir), read_ranks(spark, path))
    return found.withColumn("influence", F.round("influence", 6))


def _two_hop_sql(ranks: str) -> str:
    return f"""firsts AS (
  SELECT * FROM (
    SELECT l.src AS id, l.dst AS best, r.rank,
           row_number() OVER (PARTITION BY l.src ORDER BY r.rank DESC, l.dst) AS place
    FROM links l JOIN {ranks} r ON r.id = l.dst) WHERE place = 1),
passed AS (
  SELECT v.id, coalesce(f.best, 0) AS best, coalesce(f.rank, 0.0)::DOUBLE AS rank
  FROM vertices v LEFT JOIN firsts f ON f.id = v.id)"""


_TWO_HOP_SQL = """SELECT user_id, recommended_id, influence FROM (
  SELECT l.src AS user_id, p.best AS recommended_id, p.rank AS influence,
         row_number() OVER (PARTITION BY l.src ORDER BY p.rank DESC, p.best) AS place
  FROM links l JOIN passed p ON p.id = l.dst) WHERE place = 1"""


def _string_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose ids are any text."""
    path = scratch_path(spark, "edges")
    name = F.concat(F.lit("u "), F.col("src").cast("string"))
    write_tsv(raw_edges(spark, sf_dir).select(name, "dst"), path)
    return read_edges(spark, path, ids="string")


_INFLUENCER_SQL = (
    with_clauses(
        LINKS_SQL,
        _VERTICES_SQL,
        """ranks AS (
  SELECT v.id, coalesce(r.rank, 0.0)::DOUBLE AS rank FROM vertices v
  LEFT JOIN (SELECT dst AS id, count(*)::DOUBLE AS rank FROM links GROUP BY dst) r
    ON r.id = v.id)""",
        _two_hop_sql("ranks"),
    )
    + _TWO_HOP_SQL
)

QUERIES: dict[str, Query] = {
    "rank_then_recommend": Query(
        _rank_then_recommend,
        _pagerank_sql(10, "spread").rstrip()
        + """,
rounded AS MATERIALIZED (SELECT id, round(rank, 6) AS rank FROM r10),
"""
        + _two_hop_sql("rounded")
        + "\n"
        + _TWO_HOP_SQL,
    ),
    "read_edges_text": Query(
        _string_edges,
        with_clauses(RAW_EDGES_SQL) + "SELECT 'u ' || src AS src, CAST(dst AS VARCHAR) AS dst FROM raw_edges",
    ),
    "follower_count": Query(
        lambda spark, d: ops.follower_count(raw_edges(spark, d)),
        with_clauses(RAW_EDGES_SQL)
        + "SELECT dst AS user_id, count(*) AS followers FROM raw_edges GROUP BY dst",
    ),
    "vertex_set": Query(
        lambda spark, d: ops.vertex_set(raw_edges(spark, d)),
        with_clauses(RAW_EDGES_SQL)
        + "SELECT src AS id FROM raw_edges UNION SELECT dst FROM raw_edges",
    ),
    "dangling_vertices": Query(
        lambda spark, d: ops.dangling_vertices(raw_edges(spark, d)),
        with_clauses(RAW_EDGES_SQL)
        + "SELECT dst AS id FROM raw_edges EXCEPT SELECT src FROM raw_edges",
    ),
    "distinct_edges": Query(
        lambda spark, d: ops.distinct_edges(raw_edges(spark, d)),
        with_clauses(RAW_EDGES_SQL) + "SELECT DISTINCT src, dst FROM raw_edges",
    ),
    "union_all": Query(
        lambda spark, d: ops.union_all(
            raw_edges(spark, d),
            raw_edges(spark, d).select(F.col("dst").alias("src"), F.col("src").alias("dst")),
        ),
        with_clauses(RAW_EDGES_SQL)
        + "SELECT src, dst FROM raw_edges UNION ALL SELECT dst AS src, src AS dst FROM raw_edges",
    ),
    "adjacency": Query(
        lambda spark, d: ops.adjacency(raw_edges(spark, d)).select(
            "src", "block", F.array_join(F.col("neighbours"), ",").alias("neighbours")
        ),
        with_clauses(LINKS_SQL)
        + """SELECT src, dst // 1024 AS block, string_agg(dst, ',' ORDER BY dst) AS neighbours
FROM links GROUP BY src, dst // 1024""",
    ),
    "attach_rank": Query(
        lambda spark, d: ops.attach_rank(
            ops.vertex_set(links(spark, d)), _in_degree_ranks(links(spark, d))
        ),
        with_clauses(LINKS_SQL, _VERTICES_SQL)
        + """SELECT v.id, coalesce(r.rank, 0.0)::DOUBLE AS rank FROM vertices v
LEFT JOIN (SELECT dst AS id, count(*)::DOUBLE AS rank FROM links GROUP BY dst) r ON r.id = v.id""",
    ),
    "max_by_neighbour": Query(
        lambda spark, d: ops.best_neighbour(links(spark, d), _in_degree_ranks(links(spark, d))),
        with_clauses(LINKS_SQL)
        + """SELECT id, best, rank FROM (
  SELECT l.src AS id, l.dst AS best, r.rank,
         row_number() OVER (PARTITION BY l.src ORDER BY r.rank DESC, l.dst) AS place
  FROM links l JOIN (SELECT dst AS id, count(*)::DOUBLE AS rank FROM links GROUP BY dst) r
    ON r.id = l.dst) WHERE place = 1""",
    ),
    "sum_by_key": Query(
        lambda spark, d: ops.sum_by_key(
            links(spark, d), ops.vertex_set(links(spark, d)).withColumn("rank", F.lit(1.0))
        ).select("id", F.round("received", 6).alias("received")),
        with_clauses(LINKS_SQL, _OUT_SQL)
        + """SELECT dst AS id, round(sum(1.0::DOUBLE / degree), 6) AS received
FROM links JOIN outs USING (src) GROUP BY dst""",
    ),
    "pagerank": _pagerank("spread"),
    "pagerank_post": _pagerank("post"),
    "pagerank_messages": _ranked("spread"),
    "pagerank_post_messages": _ranked("post"),
    "connected_components": Query(
        lambda spark, d: messages.connected_components(links(spark, d)).vertices, _components_sql()
    ),
    "influencer_messages": Query(
        lambda spark, d: messages.influencer(links(spark, d), _in_degree_ranks(links(spark, d))), _INFLUENCER_SQL
    ),
    "influencer_two_hop": Query(
        lambda spark, d: ops.influencer_two_hop(
            links(spark, d), _in_degree_ranks(links(spark, d))
        ),
        _INFLUENCER_SQL,
    ),
}
