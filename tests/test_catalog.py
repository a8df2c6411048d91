from larkspur.operators import catalog as ops


def songs(spark, rows):
    return spark.createDataFrame(
        rows, "track_id string, title string, artist_id string, artist_name string, duration double"
    )


def test_prefix_and_suffix_do_not_overlap(spark):
    df = songs(spark, [("1", "Total", "a", "A", 1.0), ("2", "Total Water", "a", "A", 1.0)])
    assert [r.track_id for r in ops.prefix_suffix_match(df, "title", "Total", "Water").collect()] == ["2"]
    assert ops.prefix_suffix_match(df, "title", "Total", "otal").count() == 0


def test_null_fails_every_predicate(spark):
    df = songs(spark, [("1", None, "a", None, None), ("2", "Love", "a", "Gwen", 5.0)])
    without = ops.match_all(df, [~df.title.contains("Bitter")])
    assert [r.track_id for r in without.collect()] == ["2"]
    assert ops.any_column_contains_count(df, ["title", "artist_name"], "ove", "track_id").first()[0] == 1


def test_search_is_case_sensitive(spark):
    df = songs(spark, [("1", "the beatles", "a", "A", 1.0), ("2", "The Beatles", "a", "A", 1.0)])
    assert ops.any_column_contains_count(df, ["title"], "The Beatles", "track_id").first()[0] == 1


def test_longest_track_breaks_ties_by_id_and_skips_null(spark):
    df = songs(spark, [("b", "x", "a", "A", 9.0), ("a", "x", "a", "A", 9.0), ("c", "x", "a", "A", None)])
    assert ops.longest_track(df, "track_id", "duration").first().track_id == "a"


def test_nth_most_frequent_counts_named_rows(spark):
    rows = [("1", "t", a, n, 1.0) for a, n in
            [("x", "X"), ("x", "X"), ("x", "X"), ("y", "Y"), ("y", "Y"), ("z", None), ("z", None), ("w", "W")]]
    third = ops.nth_most_frequent(songs(spark, rows), "artist_id", "artist_name", 3).first()
    assert (third.artist_name, third.row_count) == ("W", 1)


def test_digit_patterns_find_anywhere(spark):
    texts = ["399.9", "400.1", "1000.5", "12345.6", "99.0", "1400"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = {r.v for r in ops.regex_match(df, "v", ops.AT_LEAST_400_PATTERN).collect()}
    assert found == {"400.1", "1000.5", "12345.6"}
    one = {r.v for r in ops.regex_match(df, "v", ops.AT_LEAST_1_PATTERN).collect()}
    assert one == {"399.9", "400.1", "1000.5", "12345.6", "99.0"}


def test_filters_reach_the_scan(spark):
    from larkspur.plans.tables import songs as catalogue
    from tests.conftest import plan_text

    plan = plan_text(
        ops.prefix_match(catalogue(spark, "/root/testdata/sf0.001"), "title", "red").select("track_id")
    )
    assert "StringStartsWith(p_name,red)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
