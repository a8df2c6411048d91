"""Followers, timelines and recommendations over links, profiles and posts.

``links(src, dst)`` means src follows dst and is distinct; ``users`` has one row per ``user_id``.
Each job answers for all users at once, or for those in a frame of ids, with one join per
relationship. Results are long tables, one row per follower or post, because a celebrity's
followers would not fit one nested record. Joins against the one-row-per-key tables leave a hot
key to AQE, which splits the fact side of a skewed join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.dates import post_time
from larkspur.operators.recommend import all_candidates, best_candidates
from larkspur.operators.skew import split_join
from larkspur.session import materialise

UNAUTHORIZED = ("Unauthorized", "#")


def profile_lookup(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Name and image for each (request_id, user_id, password); no match is unauthorised.

    A stored empty name counts as no match.
    """
    known = users.filter(F.col("name") != "").select("user_id", "password", "name", "profile_url")
    name, url = UNAUTHORIZED
    return (
        requests.join(known, ["user_id", "password"], "left")
        .withColumn("_ok", F.col("name").isNotNull())
        .select(
            "request_id",
            F.when(F.col("_ok"), F.col("name")).otherwise(name).alias("name"),
            F.when(F.col("_ok"), F.col("profile_url")).otherwise(url).alias("profile_url"),
        )
    )


def row_key_lookup(links: DataFrame, ids: DataFrame, family: str = "follower") -> DataFrame:
    """Neighbours of each id in one orientation: its followers or its followees."""
    row, cell = ("dst", "src") if family == "follower" else ("src", "dst")
    return (
        links.select(F.col(row).alias("user_id"), F.col(cell).alias("neighbour"))
        .join(ids.select("user_id").distinct(), "user_id", "left_semi")
    )


def _for_users(df: DataFrame, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return df
    return df.join(ids.select("user_id").distinct(), "user_id", "left_semi")


def followers(links: DataFrame, users: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(user_id, name, profile_url) of every known follower."""
    pairs = _for_users(
        links.select(F.col("dst").alias("user_id"), F.col("src").alias("_follower")), ids
    )
    profiles = users.select(F.col("user_id").alias("_follower"), "name", "profile_url")
    return pairs.join(profiles, "_follower").select("user_id", "name", "profile_url")


def ordered_followers(
    links: DataFrame, users: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Followers in page order: by user, then name, then image address.

    The sort ranges over all three columns, so one user's many followers spread over tasks.
    """
    return followers(links, users, ids).orderBy("user_id", "name", "profile_url")


def numbered_followers(
    links: DataFrame, users: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Followers with their ``position`` in page order, from 1.

    Profiles are put in order once, and links carry a profile's place instead of its texts. Rows are
    range-partitioned by the whole order and written once; rows are numbered inside each
    range, after those of the user's earlier ranges, so a user's many followers meet in no task.
    """
    profiles = _placed(users.select("user_id", "name", "profile_url"), [F.asc("name"), F.asc("profile_url")], "profiles")
    pairs = _for_users(
        links.select(F.col("dst").alias("user_id"), F.col("src").alias("_follower")), ids
    )
    places = profiles.select(F.col("user_id").alias("_follower"), "_place")
    ranges = pairs.join(places, "_follower").select("user_id", "_place").repartitionByRange("user_id", "_place")
    ranges = materialise(ranges.withColumn("_range", F.spark_partition_id()), "followers")
    earlier = Window.partitionBy("user_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        ranges.groupBy("user_id", "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("user_id", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"))
    )
    inside = F.row_number().over(Window.partitionBy("user_id", "_range").orderBy("_place"))
    return (
        ranges.withColumn("_inside", inside)
        .join(ahead, ["user_id", "_range"])
        .select("user_id", "_place", (F.col("_ahead") + F.col("_inside")).cast("int").alias("position"))
        .join(profiles.drop("user_id"), "_place")
        .select("user_id", "name", "profile_url", "position")
    )


def _placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` written once, with the ``_place`` of each row in ``order``: unique, and all that joins and
    sorts further on have to move."""
    return materialise(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), name)


def user_posts(posts: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Posts of each user, oldest first, ties by post id."""
    mine = posts if ids is None else posts.join(
        ids.select(F.col("user_id").alias("uid")).distinct(), "uid", "left_semi"
    )
    return (
        mine.withColumn("_at", post_time("timestamp"))
        .orderBy("uid", F.asc_nulls_first("_at"), "pid")
        .drop("_at")
    )


def followee_posts(
    links: DataFrame, posts: DataFrame, ids: DataFrame | None = None, block: int = 4096
) -> DataFrame:
    """Every post of every followee, per user.

    Both sides may repeat an author many times, so a busy author is joined in bounded blocks.
    """
    followed = _for_users(links.select(F.col("src").alias("user_id"), F.col("dst").alias("uid")), ids)
    return split_join(followed, posts, "uid", "user_id", "pid", block).select(
        "user_id", "uid", "pid", "timestamp", "content"
    )


def timeline_posts(
    links: DataFrame, posts: DataFrame, ids: DataFrame | None = None, k: int = 30
) -> DataFrame:
    """The k newest followee posts per user (newest first for the cut, ties by post id).

    A post older than its author's k newest cannot be among the k newest of any reader, so posts
    are cut to k per author before the join. Both cuts are ``row_number() <= k``, which Spark
    applies ahead of the shuffle. What is cut and shuffled for a reader is a post's time and its place
    among all posts kept; text joins the rows that stay.
    """
    newest = [F.desc_nulls_last("_at"), F.asc("pid")]
    followed = _for_users(links.select(F.col("src").alias("user_id"), F.col("dst").alias("uid")), ids)
    if ids is not None:  # rank the posts of authors somebody asks for, no others
        posts = posts.join(followed.select("uid").distinct(), "uid", "left_semi")
    recent = (
        posts.withColumn("_at", post_time("timestamp"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("uid").orderBy(*newest)))
        .filter(F.col("_rank") <= k)
        .drop("_rank")
    )
    recent = _placed(recent, newest, "recent")
    return (
        followed.join(recent.select("uid", "_place", "_at"), "uid")
        .select("user_id", "_place", "_at")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("user_id").orderBy("_place")))
        .filter(F.col("_rank") <= k)
        .withColumn(
            "position",  # places go by id among posts of one time
            F.row_number().over(
                Window.partitionBy("user_id").orderBy(F.asc_nulls_first("_at"), F.asc("_place"))
            ),
        )
        .select("user_id", "position", "_place")
        .join(recent.drop("_at"), "_place")
        .select("user_id", "position", "uid", "pid", "timestamp", "content")
    )


def timeline(
    links: DataFrame,
    users: DataFrame,
    posts: DataFrame,
    ids: DataFrame | None = None,
    k: int = 30,
) -> DataFrame:
    """Profile, followers and newest followee posts of each user, as tagged rows.

    ``section`` is profile, follower or post; ``position`` is the place in the user's followers by
    name and image, or posts. A user without a profile has an empty one.
    """
    everyone = ids if ids is not None else (
        users.select("user_id")
        .unionByName(links.select(F.col("src").alias("user_id")))
        .unionByName(links.select(F.col("dst").alias("user_id")))
    )
    own = (
        everyone.select("user_id").distinct()
        .join(users.select("user_id", "name", "profile_url"), "user_id", "left")
        .fillna("", ["name", "profile_url"])
        .withColumn("section", F.lit("profile"))
    )
    fans = numbered_followers(links, users, ids).withColumn("section", F.lit("follower"))
    feed = timeline_posts(links, posts, ids, k).withColumn("section", F.lit("post"))
    return own.unionByName(fans, allowMissingColumns=True).unionByName(feed, allowMissingColumns=True).select(
        "user_id", "section", "name", "profile_url", "position", "uid", "pid", "timestamp", "content"
    )


def mutual_count(links: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(user_id, candidate, score): candidates two hops away, by how many followees link to them.

    A user's own id and the ids already followed are left out. Ids of 64 bits are counted inside tasks
    over lists of links, so that paths are no rows. For others a hub between many followers and
    many followees is joined in bounded blocks, and the paths are summed before their shuffle;
    the exclusion then runs on the summed pairs, in the partitioning of the sum.
    """
    if {links.schema["src"].dataType, links.schema["dst"].dataType} == {T.LongType()}:
        return all_candidates(links, ids)
    first = links.select(F.col("src").alias("user_id"), F.col("dst").alias("_via"))
    second = links.select(F.col("src").alias("_via"), F.col("dst").alias("candidate"))
    followed = links.select(F.col("src").alias("user_id"), F.col("dst").alias("candidate"))
    if ids is not None:  # only links of those that somebody asked for follows
        first, followed = _for_users(first, ids), _for_users(followed, ids)
        second = second.join(first.select("_via").distinct(), "_via", "left_semi")
    scored = (
        split_join(first, second, "_via", "user_id", "candidate")
        .filter(F.col("candidate") != F.col("user_id"))
        .groupBy("user_id", "candidate")
        .agg(F.count(F.lit(1)).alias("score"))
    )
    return scored.join(followed, ["user_id", "candidate"], "left_anti")


def two_hop_candidates(links: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Distinct (user_id, candidate) pairs two hops apart and not yet linked."""
    return mutual_count(links, ids).select("user_id", "candidate")


def recommend_followees(
    links: DataFrame, users: DataFrame, ids: DataFrame | None = None, k: int = 10, **limits: int
) -> DataFrame:
    """The k best candidates per user, ties to the smaller id; unknown ones drop out after the cut.

    Scores are counted as ``recommend.best_candidates`` does, which takes ``limits``.
    """
    top = best_candidates(links, ids, k, **limits)
    profiles = users.select(F.col("user_id").alias("candidate"), "name", "profile_url")
    return top.join(profiles, "candidate").select(
        "user_id", "position", "candidate", "score", "name", "profile_url"
    )
