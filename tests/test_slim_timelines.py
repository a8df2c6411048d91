"""What timelines move for each link and post: places, not texts."""

from larkspur.operators import social


def test_timelines_sort_and_write_places(spark, monkeypatch):
    written, real = {}, social.materialise

    def watched(df, name):
        written[name] = df.columns
        return real(df, name)

    monkeypatch.setattr(social, "materialise", watched)
    links = spark.createDataFrame([(1, 2), (1, 3), (3, 2), (4, 2), (None, 2), (5, None)], "src bigint, dst bigint")
    users = spark.createDataFrame(
        [(1, "b", "x"), (3, "a", "y"), (4, None, "z"), (4, "a", "w"), (None, "q", "q")], "user_id bigint, name string, profile_url string"
    )
    posts = spark.createDataFrame(
        [(2, 10, "2024-01-01 05:00:00", "old"), (2, 12, "2024-01-01 07:00:00", "c"), (3, 11, "2024-01-01 07:00:00", "d"),
         (3, 11, "2024-01-01 07:00:00", "d"), (3, 13, None, "e"), (None, 14, "2024-01-01 07:00:00", "f")],
        "uid bigint, pid bigint, timestamp string, content string",
    )
    rows = social.timeline(links, users, posts, k=3).where("user_id IN (1, 2)").collect()
    fans = sorted((r.position, r.name, r.profile_url) for r in rows if r.section == "follower" and r.user_id == 2)
    assert fans == [(1, None, "z"), (2, "a", "w"), (3, "a", "y"), (4, "b", "x")]
    feed = sorted((r.position, r.pid, r.content) for r in rows if r.section == "post" and r.user_id == 1)
    assert feed == [(1, 11, "d"), (2, 11, "d"), (3, 12, "c")]
    assert written["followers"] == ["user_id", "_place", "_range"]
    assert "_place" in written["recent"]
