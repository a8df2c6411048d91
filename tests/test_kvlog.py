import random

import pytest

from larkspur.functions.hashing import home_region, string_hash
from larkspur.operators import kvlog as ops
from pyspark.sql import functions as F

SCHEMA = "seq bigint, key string, op string, value string, ts bigint"


def log(spark):
    """Half of all rows share one key; timestamps repeat and arrive out of order."""
    rng = random.Random(5)
    rows = []
    for seq in range(600):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
        op = rng.choice(["PUT", "GET"])
        ts = seq // 3 * 10 - rng.randrange(4) * 50
        rows.append((seq, key, op, f"v{seq}" if op == "PUT" else None, ts))
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("target", [10, 10_000])
def test_read_as_of(spark, target):
    rows, df = log(spark)
    got = {r.seq: r.value for r in ops.read_as_of(df, target, 20).collect()}
    for seq, key, op, _, ts in rows:
        if op == "GET":
            earlier = [(t, s, v) for s, k, o, v, t in rows if k == key and o == "PUT" and t < ts]
            assert got[seq] == (max(earlier)[2] if earlier else "0")
    assert len(got) == sum(r[2] == "GET" for r in rows)


@pytest.mark.parametrize("target", [10, 10_000])
def test_stale_puts_and_latest(spark, target):
    rows, df = log(spark)
    newest, stored, stale = {}, {}, []
    for seq, key, op, value, ts in rows:
        if op == "PUT":
            if newest.get(key, ts) > ts:
                stale.append((seq, newest[key]))
            else:
                newest[key], stored[key] = ts, value
    got = [(r.seq, r.newest) for r in ops.kv_stale_puts(df, target, 7).orderBy("seq").collect()]
    assert got == stale
    assert {r.key: r.value for r in ops.kv_latest(df).collect()} == stored


def test_hash_wraps_like_32_bit_arithmetic(spark):
    def reference(text):
        h = 0
        data = text.encode("utf-16-be")
        for i in range(0, len(data), 2):
            h = (h * 31 + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    # the last one hashes to the least 32-bit number
    texts = ["", "a", "k49", "Customer#000000001", "münchen", "a\U0001F600b", "polygenelubricants"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.h, r.g) for r in df.select("t", string_hash(F.col("t")).alias("h"), home_region(F.col("t")).alias("g")).collect()}
    for t in texts:
        h = reference(t)
        assert got[t][0] == h
        a = h if h == -(1 << 31) else abs(h)
        less = (a - 1 + (1 << 31)) % (1 << 32) - (1 << 31)
        assert got[t][1] == (less % 3 + 1 if less >= 0 else -((-less) % 3) + 1)
    assert got["polygenelubricants"][0] == -(1 << 31)
    assert got[""][1] == 0
