import random

from pyspark.sql import functions as F

from larkspur.operators.skew import PIECE, SPLIT, split_join, with_pieces


def test_split_join_equals_plain_join(spark):
    rng = random.Random(1)
    keys = [0] * 40 + [1] * 9 + list(range(2, 12))
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key int, l int")
    right = spark.createDataFrame(
        [(rng.choice([0, 0, 0, 1, 2, 3, 20]), i) for i in range(60)], "key int, r int"
    )
    plain = left.join(right, "key").select("key", "l", "r")
    split = split_join(left, right, "key", "l", "r", block=4).select("key", "l", "r")
    assert sorted(split.collect()) == sorted(plain.collect())


def test_pieces_are_consecutive_and_bounded(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("key"),
        (F.col("id") * 3).alias("at"),
    )
    pieces = with_pieces(df, ["key"], "at", target_rows=50, slot_width=10)
    hot = pieces.filter("key = 'hot'").groupBy(PIECE).agg(
        F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")
    ).orderBy(PIECE).collect()
    assert sum(r.n for r in hot) == 700 and max(r.n for r in hot) <= 60
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert pieces.filter("key <> 'hot'").select(PIECE, SPLIT).distinct().collect() == [(0, False)]
