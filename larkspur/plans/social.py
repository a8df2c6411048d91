"""Social queries, for all users at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import social as ops
from larkspur.plans.registry import Plan, Query
from larkspur.plans.tables import (
    FILES_PER_TRIGGER,
    LINKS_SQL,
    POSTS_SQL,
    USERS_SQL,
    in_slices,
    links,
    posts,
    table,
    users,
    with_clauses,
)
from larkspur.session import materialise, scratch_path
from larkspur.sources.clustered import SocialTables
from larkspur.streaming.timelines import timelines_at, timelines_query


def _login_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sign-in per order, with a password that is right for some."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("pw"), (F.col("o_orderkey") % 25).cast("string")).alias("password"),
    )


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))


def _streamed_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and links delivered slice by slice; about half of the authors count as celebrities."""
    folders, streams = {}, []
    for name, rows, arrives in (
        ("posts", posts(spark, sf_dir), F.col("pid")),
        ("links", links(spark, sf_dir), F.pmod(F.xxhash64("src", "dst"), F.lit(1000))),
    ):
        folders[name] = scratch_path(spark, name)
        in_slices(materialise(rows, name), folders[name], arrives, 3, FILES_PER_TRIGGER)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        streams.append(stream.parquet(folders[name]))
    query, checkpoint = timelines_query(*streams, celebrity=30)
    query.awaitTermination()
    return timelines_at(spark, checkpoint)


def _clustered(read: Callable[[SocialTables, DataFrame], DataFrame]) -> Plan:
    """Tables written by row key, then read for the suppliers."""

    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = SocialTables.write(links(spark, sf_dir), users(spark, sf_dir), posts(spark, sf_dir), 8)
        return read(tables, _suppliers(spark, sf_dir))

    return plan


_MUTUAL_SQL = """paths AS (
  SELECT a.src AS user_id, b.dst AS candidate, count(*) AS score
  FROM links a JOIN links b ON a.dst = b.src
  WHERE b.dst <> a.src GROUP BY ALL),
scored AS (
  SELECT p.* FROM paths p
  WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.src = p.user_id AND l.dst = p.candidate))"""

_FEED_SQL = """feed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", pid) AS "position"
  FROM (
    SELECT l.src AS user_id, p.uid, p.pid, p."timestamp", p.content,
           row_number() OVER (PARTITION BY l.src ORDER BY p."timestamp" DESC, p.pid) AS age
    FROM links l JOIN posts p ON l.dst = p.uid)
  WHERE age <= 30)"""

_FOLLOWERS_SQL = """SELECT l.dst AS user_id, u.name, u.profile_url
FROM links l JOIN users u ON l.src = u.user_id"""

#: Users asked for: an id list, read from the suppliers.
_ASKED = "(SELECT s_suppkey FROM supplier)"

_TIMELINE_SQL = (
    with_clauses(LINKS_SQL, USERS_SQL, POSTS_SQL, _FEED_SQL)
    + f"""SELECT e.user_id, 'profile' AS section, coalesce(u.name, '') AS name,
       coalesce(u.profile_url, '') AS profile_url, CAST(NULL AS INTEGER) AS "position",
       CAST(NULL AS BIGINT) AS uid, CAST(NULL AS BIGINT) AS pid,
       CAST(NULL AS VARCHAR) AS "timestamp", CAST(NULL AS VARCHAR) AS content
FROM (SELECT user_id FROM users UNION SELECT src FROM links UNION SELECT dst FROM links) e
LEFT JOIN users u ON u.user_id = e.user_id
UNION ALL
SELECT user_id, 'follower', name, profile_url,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY name, profile_url) AS INTEGER),
       NULL, NULL, NULL, NULL
FROM ({_FOLLOWERS_SQL})
UNION ALL
SELECT user_id, 'post', NULL, NULL, CAST("position" AS INTEGER), uid, pid, "timestamp", content
FROM feed"""
)

_RECOMMEND_SQL = (
    with_clauses(LINKS_SQL, USERS_SQL, _MUTUAL_SQL)
    + """SELECT r.user_id, CAST(r."position" AS INTEGER) AS "position", r.candidate, r.score,
       u.name, u.profile_url
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, candidate)
    AS "position" FROM scored) r
JOIN users u ON u.user_id = r.candidate
WHERE r."position" <= 10"""
)

QUERIES: dict[str, Query] = {
    "profile_lookup": Query(
        lambda spark, d: ops.profile_lookup(users(spark, d), _login_requests(spark, d)),
        with_clauses(USERS_SQL)
        + """SELECT o_orderkey AS request_id, coalesce(u.name, 'Unauthorized') AS name,
       coalesce(u.profile_url, '#') AS profile_url
FROM orders LEFT JOIN users u
  ON u.user_id = o_custkey AND u."password" = 'pw' || (o_orderkey % 25)""",
    ),
    "row_key_lookup": Query(
        lambda spark, d: ops.row_key_lookup(links(spark, d), _suppliers(spark, d), "follower"),
        with_clauses(LINKS_SQL)
        + """SELECT dst AS user_id, src AS neighbour FROM links
WHERE dst IN (SELECT s_suppkey FROM supplier)""",
    ),
    "followers": Query(
        lambda spark, d: ops.ordered_followers(links(spark, d), users(spark, d)),
        with_clauses(LINKS_SQL, USERS_SQL)
        + _FOLLOWERS_SQL
        + "\nORDER BY l.dst, u.name, u.profile_url",
    ),
    "user_posts": Query(
        lambda spark, d: ops.user_posts(posts(spark, d)),
        with_clauses(POSTS_SQL)
        + 'SELECT uid, pid, "timestamp", content FROM posts ORDER BY uid, "timestamp", pid',
    ),
    "followee_posts": Query(
        lambda spark, d: ops.followee_posts(links(spark, d), posts(spark, d)),
        with_clauses(LINKS_SQL, POSTS_SQL)
        + """SELECT l.src AS user_id, p.uid, p.pid, p."timestamp", p.content
FROM links l JOIN posts p ON l.dst = p.uid""",
    ),
    "timeline_posts": Query(
        lambda spark, d: ops.timeline_posts(links(spark, d), posts(spark, d)),
        with_clauses(LINKS_SQL, POSTS_SQL, _FEED_SQL)
        + 'SELECT user_id, CAST("position" AS INTEGER) AS "position", uid, pid, "timestamp", '
        + "content FROM feed",
    ),
    "timeline_posts_stream": Query(
        _streamed_timelines,
        with_clauses(LINKS_SQL, POSTS_SQL, _FEED_SQL)
        + 'SELECT user_id, CAST("position" AS INTEGER) AS "position", uid, pid, "timestamp", '
        + "content FROM feed",
    ),
    "row_key_lookup_clustered": Query(
        _clustered(lambda tables, ids: tables.neighbours(ids)),
        with_clauses(LINKS_SQL)
        + """SELECT dst AS user_id, src AS neighbour FROM links
WHERE dst IN (SELECT s_suppkey FROM supplier)""",
    ),
    "followers_clustered": Query(
        _clustered(lambda tables, ids: tables.followers()),
        with_clauses(LINKS_SQL, USERS_SQL) + _FOLLOWERS_SQL,
    ),
    "user_posts_clustered": Query(
        _clustered(lambda tables, ids: tables.user_posts(ids)),
        with_clauses(POSTS_SQL)
        + f'SELECT uid, pid, "timestamp", content FROM posts WHERE uid IN {_ASKED}',
    ),
    "timeline": Query(
        lambda spark, d: ops.timeline(links(spark, d), users(spark, d), posts(spark, d)), _TIMELINE_SQL
    ),
    "timeline_of": Query(
        lambda spark, d: ops.timeline(
            links(spark, d), users(spark, d), posts(spark, d), _suppliers(spark, d)
        ),
        f"SELECT * FROM ({_TIMELINE_SQL}) WHERE user_id IN {_ASKED}\n"
        "UNION ALL SELECT s_suppkey, 'profile', '', '', NULL, NULL, NULL, NULL, NULL FROM supplier\n"
        f"WHERE s_suppkey NOT IN (SELECT user_id FROM ({_TIMELINE_SQL}) WHERE section = 'profile')",
    ),
    "followers_of": Query(
        lambda spark, d: ops.ordered_followers(links(spark, d), users(spark, d), _suppliers(spark, d)),
        with_clauses(LINKS_SQL, USERS_SQL) + _FOLLOWERS_SQL + f"\nWHERE l.dst IN {_ASKED}",
    ),
    "user_posts_of": Query(
        lambda spark, d: ops.user_posts(posts(spark, d), _suppliers(spark, d)),
        with_clauses(POSTS_SQL)
        + f'SELECT uid, pid, "timestamp", content FROM posts WHERE uid IN {_ASKED}',
    ),
    "recommend_of": Query(
        lambda spark, d: ops.recommend_followees(
            links(spark, d), users(spark, d), _suppliers(spark, d)
        ),
        f"SELECT * FROM ({_RECOMMEND_SQL}) WHERE user_id IN {_ASKED}",
    ),
    "followee_posts_split": Query(
        lambda spark, d: ops.followee_posts(links(spark, d), posts(spark, d), block=8),
        with_clauses(LINKS_SQL, POSTS_SQL)
        + """SELECT l.src AS user_id, p.uid, p.pid, p."timestamp", p.content
FROM links l JOIN posts p ON l.dst = p.uid""",
    ),
    "two_hop_candidates": Query(
        lambda spark, d: ops.two_hop_candidates(links(spark, d)),
        with_clauses(LINKS_SQL, _MUTUAL_SQL) + "SELECT user_id, candidate FROM scored",
    ),
    "mutual_count": Query(
        lambda spark, d: ops.mutual_count(links(spark, d)),
        with_clauses(LINKS_SQL, _MUTUAL_SQL) + "SELECT user_id, candidate, score FROM scored",
    ),
    "recommend_followees": Query(
        lambda spark, d: ops.recommend_followees(links(spark, d), users(spark, d)), _RECOMMEND_SQL
    ),
    # every other followee counts as a hub, so that thresholds and both ways of meeting hubs are used
    "recommend_followees_hubs": Query(
        lambda spark, d: ops.recommend_followees(
            links(spark, d), users(spark, d), hub_links=40, cell_paths=1000
        ),
        _RECOMMEND_SQL,
    ),
}
