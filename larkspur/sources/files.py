"""Readers for the file and table formats of the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACE_SCHEMA = (
    "seq BIGINT, ts BIGINT, type STRING, block_id INT, driver_id BIGINT, client_id BIGINT, "
    "latitude DOUBLE, longitude DOUBLE, gender STRING, gender_preference STRING, "
    "rating DOUBLE, salary DOUBLE, status STRING"
)
POSTS_SCHEMA = "uid BIGINT, pid BIGINT, timestamp STRING, content STRING"
ARTICLE_SCHEMA = "revision STRUCT<text: STRING>"


def load_csv_upsert(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    key: str,
    multi_line: bool = False,
    file_order: Column | None = None,
) -> DataFrame:
    """Comma-separated, optionally quoted rows; of rows with one key the last read counts.

    "Last" is by the position in a list of paths; inside a folder by the file's modification time,
    then by name, numbers in it taken as numbers; then by position in the file. It does not depend
    on how Spark spreads the files over tasks. ``file_order``, a column over ``_metadata``,
    replaces time and name. Positions come from block starts and a counter that ascends within
    each task. Duplicates are reduced before the shuffle. ``multi_line`` allows line breaks
    inside quotes, at the price of one task per file.
    """
    name = F.col("_metadata.file_name")
    digits = F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)")), lambda d: d.cast("decimal(38,0)"))
    by_name = F.struct(F.regexp_replace(name, r"\d+", "0"), digits, name)
    if file_order is None:
        file_order = F.struct("_metadata.file_modification_time", by_name)
    parts = []
    for place, one in enumerate([path] if isinstance(path, str) else path):
        rows = spark.read.csv(
            one, schema=schema, sep=",", quote='"', escape="\\", multiLine=multi_line
        )
        columns = rows.columns
        parts.append(
            rows.select(
                *columns,
                F.struct(
                    F.lit(place).alias("path"),
                    file_order.alias("file"),
                    F.col("_metadata.file_path").alias("name"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias("_place"),
            )
        )
    placed = reduce(DataFrame.unionByName, parts)
    others = [c for c in columns if c != key]
    return (
        placed.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.col("_place")).alias("_row"))
        .select(*(F.col(c) if c == key else F.col(f"_row.{c}") for c in columns))
    )


def read_edges(
    spark: SparkSession,
    path: str,
    sep: str | None = "\t",
    comments: bool = False,
    ids: str = "bigint",
    dropped: Observation | None = None,
) -> DataFrame:
    """(src, dst) from the first two fields of each line.

    With ``sep=None`` fields are split at any white space. ``comments`` skips lines starting
    with ``#``. ``ids`` is the type of an id; as ``string``, any text that is not empty is one.
    Lines without two ids are left out, and counted as ``dropped`` by the observation given.
    """
    lines = spark.read.text(path)
    if comments:
        lines = lines.filter(~F.col("value").startswith("#"))
    parts = F.split(F.trim("value"), r"\s+") if sep is None else F.split("value", f"\\Q{sep}\\E")
    fields = [F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast(ids) for i in range(2)]
    edges = lines.select(fields[0].alias("src"), fields[1].alias("dst"))
    whole = F.col("src").isNotNull() & F.col("dst").isNotNull()
    if dropped is not None:
        edges = edges.observe(dropped, F.count_if(~whole).alias("dropped"))
    return edges.filter(whole)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(id, rank) from tab-separated text."""
    return spark.read.csv(path, schema="id BIGINT, rank DOUBLE", sep="\t")


def read_grams(spark: SparkSession, path: str) -> DataFrame:
    """(gram, n, cnt) from tab-separated gram counts."""
    grams = spark.read.csv(path, schema="gram STRING, cnt BIGINT", sep="\t", quote="")
    gram = F.trim("gram")
    return grams.select(gram.alias("gram"), F.size(F.split(gram, " ")).alias("n"), "cnt")


def parse_articles(
    lines: DataFrame, column: str = "value", skipped: Observation | None = None
) -> DataFrame:
    """(text): the lower-cased body of each one-line XML page.

    Lines that are not well formed, or lack a revision or text, are left out, and counted as
    ``skipped`` by the observation given. They are dropped by generating rows, since a filter on
    the parsed text would parse every line twice.
    """
    page = F.from_xml(F.lower(column), ARTICLE_SCHEMA, {"mode": "PERMISSIVE"})
    body = F.array_compact(F.array(page["revision"]["text"]))
    bodies = lines.select(body.alias("_body"))
    if skipped is not None:
        bodies = bodies.observe(skipped, F.count_if(F.size("_body") == 0).alias("skipped"))
    return bodies.select(F.explode("_body").alias("text"))


def read_xml_lines(
    spark: SparkSession, path: str, skipped: Observation | None = None
) -> DataFrame:
    """(text) of one XML page per line."""
    return parse_articles(spark.read.text(path), skipped=skipped)


def read_trace(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Ride trace from JSON lines, as a batch or as a stream of arriving files."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(TRACE_SCHEMA).options(**options).json(path)


def read_posts(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Post documents from JSON lines or Parquet; filters on ``uid`` reach the scan."""
    return spark.read.schema(POSTS_SCHEMA).format(format).load(path)


def read_table(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table by name: over JDBC, from Parquet under ``root``, or from the session catalog.

    ``split=(column, low, high, parts)`` reads a JDBC table in parallel ranges; without it a
    single task reads the whole table. The driver jar of the database must be on the class path.
    """
    if jdbc is not None:
        return spark.read.format("jdbc").options(**jdbc_options(name, jdbc, split)).load()
    return spark.read.parquet(f"{root}/{name}.parquet") if root else spark.table(name)


def jdbc_options(
    name: str, jdbc: Mapping[str, str], split: tuple[str, int, int, int] | None = None
) -> dict[str, str]:
    options = {"fetchsize": "10000", **jdbc, "dbtable": name}
    if split:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options
