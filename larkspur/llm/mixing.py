"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words; a document's expected copies are the target over the source's
size. The whole part is certain: every document gets that many copies. The fractional part is an
inclusion probability p, and a Pareto order sample of fixed size decides who gets one copy more:
documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the
smallest ranks win. Samples are drawn within classes of nearly equal size, from the longest
documents down; what whole documents leave over or short in a class is passed on to the next, so
the words taken stay near the target, however unequal the documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import WORD, prepared, table, written
from larkspur.plans.registry import Query

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
#: Documents in one bin of the ranks; only the bin with the last winner is sorted.
BIN_ROWS = 1000
_ONE = 1 << 30  # inclusion probabilities are whole multiples of 1 / _ONE, so that sums are exact


def word_count() -> Column:
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def size_class() -> Column:
    """Eight classes to a power of two, exact below 16."""
    bits = F.length(F.bin("__size"))
    eighth = F.expr("CAST(shiftright(__size, length(bin(__size)) - 4) & 7 AS INT)")
    return F.when(F.col("__size") < 16, F.col("__size").cast("int")).otherwise(bits * 8 + eighth)


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """(__source, __place, __total, __target): target words of each source.

    Sources by code point, null last, take the weights in turn and share ``percent`` of all words;
    none gets more than ``most`` times its size, and the excess is shared anew by weight. That ends
    where one rate holds for all sources below their bound: in the order of size over weight, it is
    the rate of the first source that stays below. The windows run over one row a source.
    """
    totals = sizes.groupBy("__source").agg(F.sum("__size").alias("__total"))
    turn = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last()))
    listed = totals.withColumn("__place", turn).withColumn(
        "__weight",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("__place") - 1) % len(weights) + 1).cast("long"),
    )
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("__total") / F.col("__weight"), "__place")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("__total").over(everything) * (percent / 100) - most * F.coalesce(
        F.sum("__total").over(before), F.lit(0)
    )
    weight = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0))
    tried = listed.withColumn("__rate", rest / weight).withColumn(
        "__open", F.col("__rate") * F.col("__weight") <= most * F.col("__total")
    )
    rate = F.first(F.when(F.col("__open"), F.col("__rate")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    bound = (most * F.col("__total")).cast("double")
    target = F.least(bound, F.coalesce(rate * F.col("__weight"), bound))
    return tried.select("__source", "__place", "__total", target.alias("__target"))


def _ranked(docs: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``docs`` with its source's numbers, certain copies, inclusion and rank.

    Sources are one small row each; Spark broadcasts them where that holds and else splits the
    busy ones of the join.
    """
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary")), 1, 13), 16, 10)
    u = (draw.cast("long") + 0.5) / float(1 << 52)
    p = F.col("__part") / float(_ONE)
    ratio = F.when(F.col("__total") > 0, F.col("__target") / F.col("__total")).otherwise(F.lit(0.0))
    return (
        docs.withColumn("__key", text)
        .join(sources.withColumnRenamed("__source", "__name"), F.col("__source").eqNullSafe(F.col("__name")))
        .withColumn("__ratio", ratio)
        .withColumn("__whole", F.floor("__ratio"))
        .withColumn("__part", F.floor((F.col("__ratio") - F.col("__whole")) * float(_ONE)).cast("long"))
        .withColumn("__class", size_class())
        .withColumn("__rank", F.when(F.col("__part") > 0, (u / (1 - u)) / (p / (1 - p))))
        .drop("__name", "__ratio")
    )


def _quotas(ranked: DataFrame) -> DataFrame:
    """(__place, __class, __n, __quota): how many documents of a class win a copy more."""
    classes = ranked.groupBy("__place", "__class").agg(
        F.count("*").alias("n"),
        F.sum(F.col("__part").cast("decimal(20,0)")).cast("double").alias("p"),
        F.sum(F.col("__part").cast("decimal(20,0)") * F.col("__size")).cast("double").alias("e"),
    )
    rows = F.reverse(F.array_sort(F.collect_list(F.struct("__class", "n", "p", "e"))))
    start = F.struct(
        F.lit(0.0).alias("carry"), F.array().cast("array<struct<__class:int,__n:bigint,__quota:bigint>>").alias("out")
    )

    def add(state: Column, row: Column) -> Column:
        mean, want = row["e"] / row["p"], row["e"] / float(_ONE) + state["carry"]
        raw = F.floor(want / mean + 0.5)
        quota = F.when(row["e"] > 0, F.greatest(F.lit(0).cast("long"), F.least(row["n"], raw))).otherwise(
            F.lit(0).cast("long")
        )
        left = F.when(row["e"] > 0, want - quota * mean).otherwise(state["carry"])
        entry = F.struct(row["__class"].alias("__class"), row["n"].alias("__n"), quota.alias("__quota"))
        return F.struct(left.alias("carry"), F.concat(state["out"], F.array(entry)).alias("out"))

    # a source has a few hundred classes at most, so its list is short whatever its documents
    return (
        classes.groupBy("__place")
        .agg(F.aggregate(rows, start, add)["out"].alias("rows"))
        .select("__place", F.inline("rows"))
    )


def _last_winners(ranked: DataFrame, quotas: DataFrame) -> DataFrame:
    """(__place, __class, __last): rank, key and size of the last winner of each class.

    Ranks go into bins of about BIN_ROWS documents; counts of bins, cumulated, tell the bin of the
    last winner, and only that bin is sorted.
    """
    of_class = ["__place", "__class"]
    bins = F.ceil(F.col("__n") / BIN_ROWS)
    place = F.col("__rank") / (1 + F.col("__rank"))
    drawn = ranked.join(quotas.where("__quota > 0"), of_class).withColumn(
        "__bin", F.least(F.floor(place * bins), bins - 1)
    )
    counted = drawn.groupBy(*of_class, "__bin").agg(F.count("*").alias("c"), F.first("__quota").alias("q"))
    upto = F.sum("c").over(Window.partitionBy(*of_class).orderBy("__bin"))
    edge = (
        counted.withColumn("upto", upto)
        .where("upto >= q AND upto - c < q")
        .select(*of_class, "__bin", (F.col("q") - F.col("upto") + F.col("c")).alias("rest"))
    )
    order = Window.partitionBy(*of_class, "__bin").orderBy("__rank", "__key", "__size")
    return (
        drawn.join(edge, [*of_class, "__bin"])
        .withColumn("k", F.row_number().over(order))
        .where("k = rest")
        .select(*of_class, F.struct("__rank", "__key", "__size").alias("__last"))
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT,
    most: int = MOST_COPIES, seed: int = 42,
) -> DataFrame:
    """``docs`` with ``__size``, ``__total``, ``__target`` (of its source) and ``__copies``.

    All rows stay. Reruns agree: the draw is a hash of the id. A null text has size 0 and so takes
    nothing, a null source is a source of its own, a null id draws as the empty id. Rows with the
    same id and size share their draw, so they win or lose together.
    """
    prepared(docs.sparkSession)
    sized = docs.withColumn("__size", word_count()).withColumn("__source", F.col("source"))
    slim = written(sized.select("doc_id", "__source", "__size"), "sizes")
    sources = written(targets(slim, weights, percent, most), "sources")
    ranked = _ranked(slim, sources, seed)
    quotas = written(_quotas(ranked), "quotas")
    winners = written(_last_winners(ranked, quotas), "winners")
    extra = F.when(F.struct("__rank", "__key", "__size") <= F.col("__last"), 1).otherwise(0)
    return (
        _ranked(sized, sources, seed)
        .join(winners, ["__place", "__class"], "left")
        .select(
            *(F.col(f"`{c}`") for c in docs.columns),
            "__size", "__total", "__target", (F.col("__whole") + extra).alias("__copies"),
        )
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__total").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM sized GROUP BY source),
placed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM totals),
tried AS (
  SELECT *, (sum(total) OVER () * CAST(1.5 AS DOUBLE) - 2 * coalesce(sum(total) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS rate
  FROM placed
  WINDOW before AS (ORDER BY total / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (SELECT arg_min(rate, total / weight) AS rate FROM tried WHERE rate * weight <= 2 * total),
sources AS (
  SELECT source, place, total, least(CAST(2 * total AS DOUBLE), coalesce(held.rate * weight, CAST(2 * total AS DOUBLE))) AS target
  FROM tried LEFT JOIN held ON true),
parts AS (
  SELECT doc_id, key, size, place, total, target,
    CASE WHEN total > 0 THEN target / total ELSE CAST(0 AS DOUBLE) END AS ratio,
    CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 8 + ((size >> CAST(length(bin(size)) - 4 AS BIGINT)) & 7) END AS class,
    (CAST('0x' || substr(md5('42:' || key), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u
  FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source),
inclusion AS (
  SELECT *, floor(ratio) AS whole, CAST(floor((ratio - floor(ratio)) * CAST(1073741824 AS DOUBLE)) AS BIGINT) AS part FROM parts),
ranked AS (
  SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) /
    ((part / CAST(1073741824 AS DOUBLE)) / (1 - part / CAST(1073741824 AS DOUBLE))) END AS odds FROM inclusion),
classes AS (
  SELECT place, class, count(*) AS n, CAST(sum(CAST(part AS HUGEINT)) AS DOUBLE) AS p,
    CAST(sum(CAST(part AS HUGEINT) * size) AS DOUBLE) AS e,
    row_number() OVER (PARTITION BY place ORDER BY class DESC) AS k
  FROM ranked GROUP BY place, class),
quotas AS (
  SELECT place, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS class, CAST(0 AS DOUBLE) AS carry, CAST(0 AS BIGINT) AS quota FROM sources
  UNION ALL
  SELECT c.place, c.k, c.class,
    CASE WHEN c.e > 0 THEN c.e / CAST(1073741824 AS DOUBLE) + q.carry - greatest(0, least(c.n,
      CAST(floor((c.e / CAST(1073741824 AS DOUBLE) + q.carry) / (c.e / c.p) + CAST(0.5 AS DOUBLE)) AS BIGINT))) * (c.e / c.p) ELSE q.carry END,
    CASE WHEN c.e > 0 THEN greatest(0, least(c.n,
      CAST(floor((c.e / CAST(1073741824 AS DOUBLE) + q.carry) / (c.e / c.p) + CAST(0.5 AS DOUBLE)) AS BIGINT))) ELSE 0 END
  FROM quotas q JOIN classes c ON c.place = q.place AND c.k = q.k + 1),
won AS (
  SELECT r.*, q.quota, rank() OVER (PARTITION BY r.place, r.class ORDER BY odds, key, size) AS pos
  FROM ranked r JOIN quotas q ON r.place = q.place AND r.class = q.class)
SELECT doc_id, size, total AS source_size, target,
  CAST((whole + CASE WHEN part > 0 AND pos <= quota THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM won
"""

QUERIES = {"op4_mixing": Query(op4_mixing, _SQL)}
