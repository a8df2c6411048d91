import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Observation

from larkspur.functions import grams
from larkspur.operators import language as ops
from larkspur.sources.files import parse_articles
from larkspur.sources.sinks import to_wide_rows
from tests.conftest import plan_text


def text(spark, *lines):
    return spark.createDataFrame([(t,) for t in lines], "text string")


def words(spark, line):
    found = ops.word_arrays(text(spark, line)).first()
    return found.words if found else []


def test_cleaning(spark):
    assert words(spark, "see http://ex.com/a?b=c, end") == ["see", "end"]
    assert words(spark, 'a <ref name="x">cited</ref> b') == ["a", "cited", "b"]
    assert words(spark, "'tis dogs' don't rock'n'roll '' 'quoted'") == [
        "tis", "dogs", "don't", "rock'n'roll", "quoted"]
    assert words(spark, "1234 -- ''") == []


def test_ngrams_against_brute_force(spark):
    lines = ["a b a b a b a b", "b a b a c", "", "c", "a b a b a b"]
    expected = Counter()
    for line in lines:
        w = re.findall("[a-z]+", line)
        expected.update(" ".join(w[i:i + n]) for n in range(1, 6) for i in range(len(w) - n + 1))
    observed = Observation()
    rows = ops.ngram_count(text(spark, *lines), observation=observed).collect()
    assert {r.gram: r.cnt for r in rows} == {g: c for g, c in expected.items() if c > 2}
    assert all(r.n == len(r.gram.split()) for r in rows)
    assert observed.get["emitted"] == sum(expected.values())
    assert ops.emitted_counter(text(spark, *lines)).first().emitted == sum(expected.values())


def test_malformed_and_incomplete_pages_are_skipped(spark):
    lines = spark.createDataFrame([
        ("<Page><Revision><Text>Good &amp; Fine</Text></Revision></Page>",),
        ('<page><revision><text xml:space="preserve">kept</text></revision></page>',),
        ("<Page><Revision><Text>cut</Te",),
        ("<Page><Revision></Revision></Page>",),
        ("<Page><Other/></Page>",),
    ], "value string")
    assert sorted(r.text for r in parse_articles(lines).collect()) == ["good & fine", "kept"]


def test_completion_total_covers_the_whole_group(spark):
    df = spark.createDataFrame(
        [("aa", 4), ("ab", 4), ("ac", 2), ("a", 90)], "word string, cnt bigint")
    got = [(r.prefix, r.word, r.share) for r in ops.word_completion(df, k=2).orderBy("position").collect()]
    assert got == [("a", "aa", 0.4), ("a", "ab", 0.4)]


def test_next_word_and_wide_rows(spark):
    grams = spark.createDataFrame(
        [("to be", 2, 6), ("to do", 2, 2), ("to be or", 3, 3), ("to", 1, 9)], "gram string, n int, cnt bigint")
    wide = {r.head: r.columns for r in to_wide_rows(ops.next_word(grams), "head").collect()}
    assert wide == {"to": {"be": "0.75", "do": "0.25"}, "to be": {"or": "1.0"}}


def test_plans_reduce_before_the_shuffle(spark):
    grams = ops.ngram_count(text(spark, "a b"))
    assert "partial_count" in plan_text(grams)
    assert "WindowGroupLimit" in plan_text(ops.word_completion(ops.unigrams(grams)))
    assert "WindowGroupLimit" in plan_text(ops.next_word(grams))


def test_rare_grams_are_not_shuffled_as_text(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    lines += [lines[0]] * 3 + ["solo"]
    for limits in ({"block_words": 50, "range_keys": 64}, {"block_words": 700, "range_keys": 1 << 20}):
        got = {r.gram: (r.n, r.cnt) for r in ops.ngram_count(text(spark, *lines), **limits).collect()}
        direct = {r.gram: (r.n, r.cnt) for r in ops.ngram_count(text(spark, *lines)).collect()}
        assert got == direct and max(n for n, _ in got.values()) == 5
    blocks = [grams.Block(pa.array(["a", "b", "c", "d"]), np.array(c, np.int32).tobytes(), np.array([len(c)], np.int32).tobytes())
              for c in ([0, 1, 2], [0, 1, 3], [3, 0, 1])]
    sent = [list(grams.sent(b, 2, 3, 0))[0] for b in blocks]
    told = grams.answers([s[1] for s in sent], [s[2] for s in sent], 3)
    kept = [grams.frequent(b, 2, {0: bits}, 0).to_pydict()["gram"] for b, bits in zip(blocks, told)]
    assert [[g for g in k if " " in g] for k in kept] == [["a b"]] * 3
