"""Tables by row key: no exchange in joins, few row groups in lookups, the results of the plain jobs."""

import pytest

from larkspur.operators import social
from larkspur.sources import clustered
from larkspur.sources.clustered import Clustered, SocialTables
from tests.conftest import plan_text


@pytest.fixture
def plain(spark):
    """Plans as they are, and no side small enough to be sent around."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def data(spark):
    links = spark.range(6_000).selectExpr("id % 500 AS src", "(id * 7919) % 400 AS dst").distinct()
    users = spark.range(450).selectExpr("id AS user_id", "'pw' AS password", "concat('n', id % 9) AS name", "concat('u/', id) AS profile_url")
    posts = spark.range(20_000).selectExpr(
        "(id * 31) % 400 AS uid", "id AS pid", "'2020-01-01 00:00:00' AS timestamp", "repeat('x', 50) AS content"
    )
    return links, users, posts


def table(frame):
    return sorted(map(tuple, frame.collect()))


def scanned(frame):
    """Rows that leave the scan: those of the row groups that were read."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_same_results(spark, data, monkeypatch):
    links, users, posts = data
    tables = SocialTables.write(links, users, posts, 8)
    ids = spark.createDataFrame([(3,), (77,), (77,), (None,), (9_999,)], "user_id long")
    for limit in (clustered.LISTED_IDS, 1):
        monkeypatch.setattr(clustered, "LISTED_IDS", limit)
        for family in ("follower", "followee"):
            assert table(tables.neighbours(ids, family)) == table(social.row_key_lookup(links, ids, family))
        assert table(tables.followers(ids)) == table(social.followers(links, users, ids))
        assert table(tables.user_posts(ids)) == table(social.user_posts(posts, ids))
    assert table(tables.followers()) == table(social.followers(links, users))


def test_joins_on_the_key_exchange_nothing(spark, data, plain):
    links, users, posts = data
    tables = SocialTables.write(links, users, posts, 8)
    assert "Exchange" in plan_text(social.followers(links, users))
    assert "Exchange" not in plan_text(tables.followers())
    read = tables.posts.table().join(tables.by_followee.table(), tables.posts.table()["uid"] == tables.by_followee.table()["dst"])
    assert "Exchange" not in plan_text(read)


def test_few_ids_read_few_row_groups(spark, data, plain):
    _, _, posts = data
    many = posts.union(posts.selectExpr("uid", "pid + 100000", "timestamp", "content"))
    kept = Clustered.write(many, "uid", 4, row_group=8 * 1024)
    ids = spark.createDataFrame([(5,), (250,)], "uid long")
    found = kept.rows(ids)
    assert found.count() == 200
    assert 200 <= scanned(found) <= 40_000 / 10
    missing = kept.rows(spark.createDataFrame([(10**12,)], "uid long"))
    assert scanned(missing) == 0
