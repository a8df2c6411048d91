"""Input tables of the jobs, derived from the given Parquet tables.

Every derivation exists twice: as a DataFrame here and as the SQL text of a CTE, so that a
query's check starts from the same tables as the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.dates import epoch_millis
from larkspur.session import dealt, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("release"),
        F.col("p_brand").alias("artist_id"),
        F.concat(F.lit("Artist "), "p_brand").alias("artist_name"),
        F.col("p_retailprice").alias("duration"),
        (F.lit(1985) + F.col("p_size") % 30).cast("int").alias("year"),
        (F.col("p_retailprice") / 1000.0).alias("artist_hotttnesss"),
    )


SONGS_SQL = """songs AS (
  SELECT p_partkey AS track_id, p_name AS title, p_type AS "release", p_brand AS artist_id,
         'Artist ' || p_brand AS artist_name, p_retailprice AS duration,
         CAST(1985 + p_size % 30 AS INTEGER) AS "year",
         p_retailprice / 1000.0 AS artist_hotttnesss
  FROM part)"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.concat(F.lit("pw"), F.col("c_nationkey").cast("string")).alias("password"),
        F.concat(F.lit("User "), (key % 97).cast("string")).alias("name"),
        F.concat(F.lit("img/"), "c_mktsegment", F.lit("/"), key.cast("string")).alias(
            "profile_url"
        ),
    )


USERS_SQL = """users AS (
  SELECT c_custkey AS user_id, 'pw' || c_nationkey AS "password",
         'User ' || (c_custkey % 97) AS name,
         'img/' || c_mktsegment || '/' || c_custkey AS profile_url
  FROM customer)"""


def raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst) with repeats, as an edge-list file may hold them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("src"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("dst"))
    rows = lines.count()
    orders, lines = dealt(orders, rows, "o_orderkey"), dealt(lines, rows, "l_orderkey")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select("src", "dst")


RAW_EDGES_SQL = """raw_edges AS (
  SELECT o_custkey AS src, l_partkey AS dst
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src`` follows ``dst``; distinct."""
    rows = table(spark, sf_dir, "lineitem").count()
    return dealt(raw_edges(spark, sf_dir), rows, "src", "dst").distinct()


LINKS_SQL = (
    RAW_EDGES_SQL
    + """,
links AS (SELECT DISTINCT src, dst FROM raw_edges)"""
)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("uid"),
        F.col("event_id").alias("pid"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("props").alias("content"),
    )


POSTS_SQL = """posts AS (
  SELECT user_id AS uid, event_id AS pid,
         strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "timestamp",
         props AS content
  FROM events)"""


#: Files of the events table in one micro-batch.
FILES_PER_TRIGGER = 16


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, one file or a folder of them, read as a stream in bounded micro-batches."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", FILES_PER_TRIGGER)
        .parquet(f"{sf_dir}/events.parquet*")
    )


#: Rows of a file of a slice, at most, where the number of files is bounded.
FILE_ROWS = 2_000_000


def in_slices(
    df: DataFrame, folder: str, arrives: Column, number: int = 6, files: int | None = None
) -> None:
    """Write ``df`` as the files of a stream: slice after slice of the time at which rows arrive.

    With ``files``, a slice has at most so many (more only beyond ``FILE_ROWS`` rows each), so that the
    number of micro-batches does not follow the number of tasks that made ``df``. Where that is fewer
    than there are cores, rows are dealt to the files, so that reading ``df`` still takes all cores.
    """
    low, high = df.agg(F.min(arrives), F.max(arrives)).first()
    place = F.floor((arrives - F.lit(low or 0)) * number / F.lit((high or 0) - (low or 0) + 1))
    for k in range(number):
        part = df.where(place == k)
        if files:
            few = files < df.sparkSession.sparkContext.defaultParallelism
            part = part.repartition(files) if few else part.coalesce(files)
            writer = part.write.option("maxRecordsPerFile", FILE_ROWS)
        else:
            writer = part.write
        writer.mode("append").parquet(folder)


def kv_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv_ops_of(table(spark, sf_dir, "events"))


def kv_ops_of(events: DataFrame) -> DataFrame:
    """Operation log of an ``events`` frame; also used on a stream of that table."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("k"), (F.col("user_id") % 50).cast("string")).alias("key"),
        F.when(F.col("event_type").isin("click", "error"), "GET").otherwise("PUT").alias("op"),
        (epoch_millis("ts") - (F.col("event_id") * 37 % 101) * 3600000).alias("ts"),
        F.format_string("%.2f", "value").alias("value"),
    )


KV_OPS_SQL = """kv_ops AS (
  SELECT event_id AS seq, 'k' || (user_id % 50) AS "key",
         CASE WHEN event_type IN ('click', 'error') THEN 'GET' ELSE 'PUT' END AS op,
         epoch_us(ts) // 1000 - (event_id * 37 % 101) * 3600000 AS ts,
         printf('%.2f', "value") AS "value"
  FROM events)"""


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace_of(table(spark, sf_dir, "events"))


def trace_of(events: DataFrame) -> DataFrame:
    """Ride trace of an ``events`` frame; also used on a stream of that table."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    request = kind == "purchase"
    driver = F.when(~request, F.col("user_id"))

    def cyclic(position: Column, values: list[str]) -> Column:
        """values[position mod n]"""
        choice = F.lit(values[-1])
        for i, value in enumerate(values[:-1]):
            choice = F.when(position % len(values) == i, value).otherwise(choice)
        return choice

    return events.select(
        F.col("event_id").alias("seq"),
        epoch_millis("ts").alias("ts"),
        F.when(kind == "click", "DRIVER_LOCATION")
        .when(kind == "view", "ENTERING_BLOCK")
        .when(kind == "error", "LEAVING_BLOCK")
        .when(kind == "signup", "RIDE_COMPLETE")
        .otherwise("RIDE_REQUEST")
        .alias("type"),
        (F.col("user_id") % 10).cast("int").alias("block_id"),
        driver.alias("driver_id"),
        F.when(request, 10000 + F.col("event_id")).alias("client_id"),
        (k / 10.0).alias("latitude"),
        ((k * 7 % 100) / 10.0).alias("longitude"),
        F.when(~request, cyclic(F.col("user_id"), ["M", "F"])).alias("gender"),
        F.when(request, cyclic(k, ["N", "M", "F"])).alias("gender_preference"),
        (k % 5 + 1).cast("double").alias("rating"),
        (k * 3 % 100).cast("double").alias("salary"),
        F.when(k % 4 == 0, "UNAVAILABLE").otherwise("AVAILABLE").alias("status"),
    )


TRACE_SQL = """keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
trace AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts,
         CASE event_type WHEN 'click' THEN 'DRIVER_LOCATION' WHEN 'view' THEN 'ENTERING_BLOCK'
              WHEN 'error' THEN 'LEAVING_BLOCK' WHEN 'signup' THEN 'RIDE_COMPLETE'
              ELSE 'RIDE_REQUEST' END AS "type",
         CAST(user_id % 10 AS INTEGER) AS block_id,
         CASE WHEN event_type <> 'purchase' THEN user_id END AS driver_id,
         CASE WHEN event_type = 'purchase' THEN 10000 + event_id END AS client_id,
         k / 10.0 AS latitude, (k * 7 % 100) / 10.0 AS longitude,
         CASE WHEN event_type <> 'purchase'
              THEN CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
         CASE WHEN event_type = 'purchase'
              THEN CASE k % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'M' ELSE 'F' END
              END AS gender_preference,
         CAST(k % 5 + 1 AS DOUBLE) AS rating, CAST(k * 3 % 100 AS DOUBLE) AS salary,
         CASE WHEN k % 4 = 0 THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS status
  FROM keyed)"""


def article_lines(spark: SparkSession, sf_dir: str, malformed: bool = False) -> DataFrame:
    """One XML page per row in ``value``; with ``malformed``, every fiftieth is cut off."""
    doc = F.col("doc_id")
    extra = (
        F.when(doc % 3 == 0, " see http://ex.com/A?b=c, end ")
        .when(doc % 3 == 1, " <ref name=\"x\">cited</ref> 'tis ")
        .otherwise(" plain ")
    )
    text = F.concat(F.regexp_replace("text", "[\\r\\n]", " "), extra)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    tail = F.lit("</Text></Revision></Page>")
    if malformed:
        tail = F.when(doc % 50 == 7, "</Te").otherwise(tail)
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        doc.alias("doc_id"), F.concat(F.lit("<Page><Revision><Text>"), text, tail).alias("value")
    )


# Text of the pages as an XML reader returns it: entities resolved, lower case.
ARTICLES_SQL = """articles AS (
  SELECT doc_id,
         lower(regexp_replace(text, '[\\r\\n]', ' ', 'g') ||
           CASE doc_id % 3 WHEN 0 THEN ' see http://ex.com/A?b=c, end '
                WHEN 1 THEN ' <ref name="x">cited</ref> ''tis '
                ELSE ' plain ' END) AS body
  FROM documents)"""


def with_clauses(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
