"""Tables laid out by a row key: bucketed and sorted by it, with Bloom filters on it.

A join on the key needs no exchange of the table, and a lookup of few ids opens the files of their
buckets alone and, in them, the row groups that can hold an id.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import scratch_path

#: Ids that are sent to the scan as a list; more are joined.
LISTED_IDS = 1_000
BUCKETS = 64
ROW_GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Clustered:
    """A table and the key it is laid out by."""

    spark: SparkSession
    name: str
    key: str

    @classmethod
    def write(
        cls, df: DataFrame, key: str, buckets: int = BUCKETS, path: str | None = None, row_group: int = ROW_GROUP_BYTES
    ) -> Clustered:
        """Write ``df`` with one sorted file for each bucket of ``key``.

        ``buckets`` fixes how wide joins on the key run; tables that are to meet need the same number.
        Null keys form a bucket with others and are never found by a lookup. A key that holds a large
        part of the rows is one file: such tables are for keys with bounded rows, or for scans.
        """
        spark = df.sparkSession
        name = f"clustered_{uuid.uuid4().hex}"
        (
            df.repartition(buckets, key)
            .write.bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path or scratch_path(spark, "clustered"))
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .option("parquet.block.size", row_group)
            .saveAsTable(name)
        )
        return cls(spark, name, key)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self, ids: DataFrame | None = None) -> DataFrame:
        """All rows, or those whose key is in the first column of ``ids``.

        Few ids (``LISTED_IDS``) reach the scan as a list; more are joined in the table's own layout.
        """
        if ids is None:
            return self.table()
        wanted = ids.select(F.col(ids.columns[0]).alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        listed = [row[0] for row in wanted.limit(LISTED_IDS + 1).collect()]
        if len(listed) <= LISTED_IDS:
            return self.table().where(F.col(self.key).isin(listed))
        return self.table().join(wanted, self.key, "left_semi")


@dataclass(frozen=True)
class SocialTables:
    """Links in both orientations, profiles and posts, each by the user it is asked for."""

    by_follower: Clustered  # src, dst by src
    by_followee: Clustered  # src, dst by dst
    users: Clustered  # by user_id
    posts: Clustered  # by uid

    @classmethod
    def write(cls, links: DataFrame, users: DataFrame, posts: DataFrame, buckets: int = BUCKETS, **options) -> SocialTables:
        return cls(
            Clustered.write(links, "src", buckets, **options),
            Clustered.write(links, "dst", buckets, **options),
            Clustered.write(users, "user_id", buckets, **options),
            Clustered.write(posts, "uid", buckets, **options),
        )

    def neighbours(self, ids: DataFrame, family: str = "follower") -> DataFrame:
        """``social.row_key_lookup``: followers or followees of each id."""
        table, row, cell = (
            (self.by_followee, "dst", "src") if family == "follower" else (self.by_follower, "src", "dst")
        )
        return table.rows(ids).select(F.col(row).alias("user_id"), F.col(cell).alias("neighbour"))

    def followers(self, ids: DataFrame | None = None) -> DataFrame:
        """``social.followers``: profiles of every known follower.

        For all users, links by follower meet profiles in the same buckets. For an id list, the links
        of those ids are looked up first; they are few beside the table.
        """
        links = self.by_follower.rows() if ids is None else self.by_followee.rows(ids)
        profiles = self.users.table().select(F.col("user_id").alias("src"), "name", "profile_url")
        return links.join(profiles, "src").select(F.col("dst").alias("user_id"), "name", "profile_url")

    def user_posts(self, ids: DataFrame | None = None) -> DataFrame:
        """``social.user_posts`` without its order."""
        return self.posts.rows(ids)
