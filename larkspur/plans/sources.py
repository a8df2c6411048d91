"""Reader and writer queries: the tables are written in each format by Spark, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.graph import follower_count
from larkspur.plans.registry import Query
from larkspur.plans.tables import (
    ARTICLES_SQL,
    POSTS_SQL,
    RAW_EDGES_SQL,
    SONGS_SQL,
    TRACE_SQL,
    article_lines,
    posts,
    raw_edges,
    songs,
    trace,
    with_clauses,
)
from larkspur.session import scratch_path
from larkspur.sources import files
from larkspur.sources.sinks import write_tsv


def _csv_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue, then a second delivery that lengthens every third track."""
    first = songs(spark, sf_dir)
    second = first.filter(F.col("track_id") % 3 == 0).withColumn(
        "duration", F.col("duration") + 1
    )
    folder = scratch_path(spark, "songs")
    paths = [f"{folder}/1", f"{folder}/2"]
    for part, path in zip((first, second), paths):
        part.write.csv(path, quoteAll=True, escape="\\")
    return files.load_csv_upsert(spark, paths, first.schema, "track_id")


def _edges_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "edges")
    write_tsv(raw_edges(spark, sf_dir), path)
    return files.read_edges(spark, path)


def _edges_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White-space edges; every seventh target's lines are commented out."""
    path = scratch_path(spark, "edges")
    mark = F.when(F.col("dst") % 7 == 0, "# ").otherwise("")
    line = F.concat(mark, F.col("src").cast("string"), F.lit("  "), F.col("dst").cast("string"))
    raw_edges(spark, sf_dir).select(line.alias("value")).write.text(path)
    return files.read_edges(spark, path, sep=None, comments=True)


def _xml_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of every article's text."""
    path = scratch_path(spark, "articles")
    article_lines(spark, sf_dir, malformed=True).select("value").write.text(path)
    # white space at the ends of an element is the reader's to keep or drop
    text = F.regexp_replace("text", r"[\x00-\x20]", "")
    return files.read_xml_lines(spark, path).select(
        F.md5(text).alias("text_md5"), F.char_length(text).cast("bigint").alias("characters")
    )


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "trace")
    trace(spark, sf_dir).write.json(path)
    return files.read_trace(spark, path)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "posts")
    posts(spark, sf_dir).write.json(path)
    return files.read_posts(spark, path)


def _tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "followers")
    write_tsv(follower_count(raw_edges(spark, sf_dir)), path)
    return spark.read.text(path)


QUERIES: dict[str, Query] = {
    "load_csv_upsert": Query(
        _csv_upsert,
        with_clauses(SONGS_SQL)
        + """SELECT track_id, title, "release", artist_id, artist_name,
       CASE WHEN track_id % 3 = 0 THEN duration + 1 ELSE duration END AS duration, "year",
       artist_hotttnesss FROM songs""",
    ),
    "read_edges_tab": Query(
        _edges_tab, with_clauses(RAW_EDGES_SQL) + "SELECT src, dst FROM raw_edges"
    ),
    "read_edges_long": Query(
        _edges_long,
        with_clauses(RAW_EDGES_SQL) + "SELECT src, dst FROM raw_edges WHERE dst % 7 <> 0",
    ),
    "read_xml_lines": Query(
        _xml_lines,
        with_clauses(ARTICLES_SQL)
        + r"""SELECT md5(letters) AS text_md5, length(letters) AS characters
FROM (SELECT regexp_replace(body, '[\x00-\x20]', '', 'g') AS letters FROM articles WHERE doc_id % 50 <> 7)""",
    ),
    "read_trace": Query(_trace, with_clauses(TRACE_SQL) + "SELECT * FROM trace"),
    "read_posts": Query(
        _posts, with_clauses(POSTS_SQL) + 'SELECT uid, pid, "timestamp", content FROM posts'
    ),
    "read_table": Query(
        lambda spark, d: files.read_table(spark, "customer", root=d),
        "SELECT * FROM customer",
    ),
    "write_tsv": Query(
        _tsv,
        with_clauses(RAW_EDGES_SQL)
        + """SELECT dst || chr(9) || count(*) AS "value" FROM raw_edges GROUP BY dst""",
    ),
}
