"""Catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import catalog as ops
from larkspur.plans.registry import Query
from larkspur.plans.tables import SONGS_SQL, songs, with_clauses

_COLUMNS = ["track_id", "title", "artist_name"]
_SELECT = with_clauses(SONGS_SQL) + "SELECT track_id, title, artist_name FROM songs WHERE "

QUERIES: dict[str, Query] = {
    "family_scan": Query(
        lambda spark, d: ops.family_scan(
            songs(spark, d), ["track_id", "artist_name", "duration", "year"]
        ),
        with_clauses(SONGS_SQL) + 'SELECT track_id, artist_name, duration, "year" FROM songs',
    ),
    "prefix_match": Query(
        lambda spark, d: ops.prefix_match(songs(spark, d), "title", "red").select(*_COLUMNS),
        _SELECT + "starts_with(title, 'red')",
    ),
    "prefix_match_count": Query(
        lambda spark, d: ops.prefix_match_count(songs(spark, d), "title", "red"),
        with_clauses(SONGS_SQL)
        + "SELECT count(*) AS cnt FROM songs WHERE starts_with(title, 'red')",
    ),
    "prefix_suffix_match": Query(
        lambda spark, d: ops.prefix_suffix_match(songs(spark, d), "title", "red", "bolt").select(
            *_COLUMNS
        ),
        _SELECT + "regexp_matches(title, '^red.*bolt$')",
    ),
    "contains_any_prefix": Query(
        lambda spark, d: ops.contains_any_prefix(
            songs(spark, d), ("artist_name", "Brand#1"), "title", ["red", "blue"]
        ).select(*_COLUMNS),
        _SELECT
        + "contains(artist_name, 'Brand#1') "
        + "AND (starts_with(title, 'red') OR starts_with(title, 'blue'))",
    ),
    "prefix_range": Query(
        lambda spark, d: ops.prefix_range(
            songs(spark, d),
            ("artist_name", "Artist Brand#1"),
            [("duration", 905.0), ("year", 2000)],
        ).select(*_COLUMNS),
        _SELECT
        + "starts_with(artist_name, 'Artist Brand#1') AND duration >= 905 AND \"year\" >= 2000",
    ),
    "threshold_contains": Query(
        lambda spark, d: ops.threshold_contains(
            songs(spark, d),
            ("artist_hotttnesss", 0.91),
            [("artist_name", "Brand"), ("title", "ring")],
        ).select(*_COLUMNS),
        _SELECT
        + "artist_hotttnesss >= 0.91 AND contains(artist_name, 'Brand') "
        + "AND contains(title, 'ring')",
    ),
    "contains_not_contains": Query(
        lambda spark, d: ops.contains_not_contains(
            songs(spark, d),
            ("artist_name", "Artist Brand#2"),
            ("title", "red"),
            ["bolt", "ring"],
            ("year", 2005),
        ).select(*_COLUMNS),
        _SELECT
        + "starts_with(artist_name, 'Artist Brand#2') AND contains(title, 'red') "
        + "AND NOT contains(title, 'bolt') AND NOT contains(title, 'ring') AND \"year\" = 2005",
    ),
    "any_column_contains_count": Query(
        lambda spark, d: ops.any_column_contains_count(
            songs(spark, d), ["title", "release", "artist_name"], "SMALL", "track_id"
        ),
        with_clauses(SONGS_SQL)
        + "SELECT count(track_id) AS matches FROM songs WHERE contains(title, 'SMALL') "
        + "OR contains(\"release\", 'SMALL') OR contains(artist_name, 'SMALL')",
    ),
    "digit_regex_match": Query(
        lambda spark, d: ops.regex_match(
            ops.regex_match(
                songs(spark, d).select(
                    "track_id",
                    (F.col("duration") / 2.3).alias("length"),
                    (F.col("artist_hotttnesss") * 1.05).alias("heat"),
                ),
                "length",
                ops.AT_LEAST_400_PATTERN,
            ),
            "heat",
            ops.AT_LEAST_1_PATTERN,
        ),
        with_clauses(SONGS_SQL)
        + f"""SELECT * FROM (
  SELECT track_id, duration / 2.3::DOUBLE AS length,
         artist_hotttnesss * 1.05::DOUBLE AS heat FROM songs)
WHERE regexp_matches(CAST(length AS VARCHAR), '{ops.AT_LEAST_400_PATTERN}')
  AND regexp_matches(CAST(heat AS VARCHAR), '{ops.AT_LEAST_1_PATTERN}')""",
    ),
    "row_count": Query(
        lambda spark, d: ops.row_count(songs(spark, d)),
        with_clauses(SONGS_SQL) + "SELECT count(*) AS cnt FROM songs",
    ),
    "nth_most_frequent": Query(
        lambda spark, d: ops.nth_most_frequent(songs(spark, d), "artist_id", "artist_name", 3),
        with_clauses(SONGS_SQL)
        + """SELECT min(artist_name) AS artist_name, count(artist_name) AS row_count FROM songs
GROUP BY artist_id ORDER BY row_count DESC, artist_id LIMIT 1 OFFSET 2""",
    ),
    "longest_track": Query(
        lambda spark, d: ops.longest_track(songs(spark, d), "track_id", "duration"),
        with_clauses(SONGS_SQL)
        + "SELECT track_id, duration FROM songs ORDER BY duration DESC, track_id LIMIT 1",
    ),
}
