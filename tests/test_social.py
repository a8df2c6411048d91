from collections import Counter

from larkspur.operators import social as ops
from larkspur.operators import skew

USERS = [(1, "p", "Ann", "u/1"), (2, "p", "", "u/2"), (3, "p", "Cem", "u/3"), (4, "p", "Ann", "u/0")]


def users(spark):
    return spark.createDataFrame(USERS, "user_id bigint, password string, name string, profile_url string")


def links(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def test_profile_lookup(spark):
    requests = spark.createDataFrame(
        [(1, 1, "p"), (2, 1, "wrong"), (3, 2, "p"), (4, 9, "p")],
        "request_id bigint, user_id bigint, password string",
    )
    got = {r.request_id: (r.name, r.profile_url) for r in ops.profile_lookup(users(spark), requests).collect()}
    none = ("Unauthorized", "#")
    assert got == {1: ("Ann", "u/1"), 2: none, 3: none, 4: none}


def test_followers_order_and_unknown(spark):
    df = links(spark, [(1, 7), (4, 7), (3, 7), (99, 7), (1, 8)])
    ids = spark.createDataFrame([(7,)], "user_id bigint")
    got = [(r.name, r.profile_url) for r in ops.ordered_followers(df, users(spark), ids).collect()]
    assert got == [("Ann", "u/0"), ("Ann", "u/1"), ("Cem", "u/3")]


def test_bad_timestamps_sort_first(spark):
    posts = spark.createDataFrame(
        [(1, 2, "2020-01-01 00:00:00", "a"), (1, 3, "soon", "b"), (1, 1, "2020-01-01 00:00:00", "c")],
        "uid bigint, pid bigint, timestamp string, content string",
    )
    assert [r.pid for r in ops.user_posts(posts).collect()] == [3, 1, 2]


def test_timeline_cut_equals_full_sort(spark):
    pairs = [(u, a) for u in range(5) for a in range(10, 16) if (u + a) % 3]
    rows = [(10 + p % 6, p, f"2020-01-01 00:{p % 7:02d}:00", "x") for p in range(120)]
    posts = spark.createDataFrame(rows, "uid bigint, pid bigint, timestamp string, content string")
    got = {}
    for r in ops.timeline_posts(links(spark, pairs), posts, k=4).collect():
        got.setdefault(r.user_id, []).append((r.position, r.pid))
    for user in range(5):
        mine = [r for r in rows if (user, r[0]) in pairs]
        mine.sort(key=lambda r: r[1])
        mine.sort(key=lambda r: r[2], reverse=True)
        shown = sorted(mine[:4], key=lambda r: (r[2], r[1]))
        assert [pid for _, pid in sorted(got[user])] == [r[1] for r in shown]


def test_recommendations_against_brute_force(spark, monkeypatch):
    # a hub that many follow and that follows many, beyond the block size of the join
    pairs = {(u, 100) for u in range(30)} | {(100, c) for c in range(200, 230)}
    pairs |= {(u, (u * 7) % 30) for u in range(30)} | {(5, 200), (0, 0)}
    plain = skew.split_join
    monkeypatch.setattr(ops, "split_join", lambda *a: plain(*a, block=4))
    got = {}
    for r in ops.mutual_count(links(spark, sorted(pairs))).collect():
        got[r.user_id, r.candidate] = r.score
    follows = {}
    for s, d in pairs:
        follows.setdefault(s, set()).add(d)
    expected = {}
    for u, mine in follows.items():
        counts = Counter(c for v in mine for c in follows.get(v, ()) if c != u and c not in mine)
        expected |= {(u, c): n for c, n in counts.items()}
    assert got == expected


def test_unknown_candidates_drop_after_the_cut(spark):
    df = links(spark, [(1, 2), (2, 50), (2, 3), (2, 4)])
    top = ops.recommend_followees(df, users(spark), k=2).collect()
    assert [(r.user_id, r.candidate, r.position) for r in top if r.user_id == 1] == [(1, 3, 1), (1, 4, 2)]
    top = ops.recommend_followees(links(spark, [(1, 2), (2, 0), (2, 3), (2, 4)]), users(spark), k=2)
    assert [(r.candidate, r.position) for r in top.collect()] == [(3, 2)]


def test_id_lists_prune_before_ranking(spark):
    from tests.conftest import plan_text

    pairs = links(spark, [(1, 7), (1, 8), (2, 7), (7, 9), (8, 9), (9, 1)])
    posts = spark.createDataFrame(
        [(7, 1, "2020-01-01 00:00:00", "a"), (5, 2, "2020-01-01 00:00:00", "b")],
        "uid bigint, pid bigint, timestamp string, content string",
    )
    ids = spark.createDataFrame([(1,)], "user_id bigint")
    feed = ops.timeline_posts(pairs, posts, ids)
    assert [(r.user_id, r.pid) for r in feed.collect()] == [(1, 1)]
    plan = plan_text(feed)
    # of plans printed top down, what runs first stands last
    assert plan.rindex("LeftSemi") > plan.index("Window")
    assert [tuple(r) for r in ops.mutual_count(pairs, ids).collect()] == [(1, 9, 2)]


def test_followers_are_numbered_in_page_order(spark):
    df = links(spark, [(1, 7), (4, 7), (3, 7), (1, 8)])
    got = {(r.user_id, r.profile_url, r.position) for r in ops.numbered_followers(df, users(spark)).collect()}
    assert got == {(7, "u/0", 1), (7, "u/1", 2), (7, "u/3", 3), (8, "u/1", 1)}
