"""Language queries over the article pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import REF_CLOSE_PATTERN, REF_OPEN_PATTERN, URL_PATTERN
from larkspur.operators import language as ops
from larkspur.plans.registry import Query
from larkspur.plans.tables import ARTICLES_SQL, article_lines, with_clauses
from larkspur.session import materialise, scratch_path
from larkspur.sources.files import parse_articles, read_grams
from larkspur.sources.sinks import to_long_rows, to_wide_rows, write_tsv


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_articles(article_lines(spark, sf_dir))


def _grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ngram_count(_articles(spark, sf_dir))


def _stored_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(_grams(spark, sf_dir), "grams")


# The loose-apostrophe pattern needs look-around, which the check's engine lacks; taking words
# with inner apostrophes directly gives the same tokens.
_TOKENS_SQL = f"""tokens AS (
  SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS s FROM (
    SELECT doc_id, regexp_extract_all(
      regexp_replace(regexp_replace(regexp_replace(body, '{URL_PATTERN}', ' ', 'g'),
        '{REF_OPEN_PATTERN}', ' ', 'g'), '{REF_CLOSE_PATTERN}', ' ', 'g'),
      '([a-z]+(?:''[a-z]+)*)', 1) AS w FROM articles)),
fives AS (
  SELECT t AS t1, lead(t, 1) OVER d AS t2, lead(t, 2) OVER d AS t3, lead(t, 3) OVER d AS t4,
         lead(t, 4) OVER d AS t5
  FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY s)),
emitted AS (
  SELECT t1 AS gram, 1 AS n FROM fives
  UNION ALL SELECT t1 || ' ' || t2, 2 FROM fives WHERE t2 IS NOT NULL
  UNION ALL SELECT t1 || ' ' || t2 || ' ' || t3, 3 FROM fives WHERE t3 IS NOT NULL
  UNION ALL SELECT t1 || ' ' || t2 || ' ' || t3 || ' ' || t4, 4 FROM fives WHERE t4 IS NOT NULL
  UNION ALL SELECT t1 || ' ' || t2 || ' ' || t3 || ' ' || t4 || ' ' || t5, 5 FROM fives
    WHERE t5 IS NOT NULL)"""

_GRAMS_SQL = """grams AS MATERIALIZED (
  SELECT gram, n, count(*) AS cnt FROM emitted GROUP BY gram, n HAVING count(*) > 2)"""

_ENTRIES_SQL = """prefixes AS (
  SELECT substr(gram, 1, CAST(len AS INTEGER)) AS prefix, gram AS word, cnt
  FROM (SELECT gram, cnt, unnest(range(1, length(gram))) AS len FROM grams WHERE n = 1)),
phrases AS (
  SELECT regexp_extract(gram, '^(.*) [^ ]*$', 1) AS head,
         regexp_extract(gram, '([^ ]*)$', 1) AS word, cnt
  FROM grams WHERE n > 1)"""


def _ranked_sql(source: str, key: str) -> str:
    return f"""SELECT {key}, word, cnt, round(cnt / total, 6) AS share,
       CAST(place AS INTEGER) AS "position"
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cnt DESC, word) AS place,
             CAST(sum(cnt) OVER (PARTITION BY {key}) AS DOUBLE) AS total FROM {source})
WHERE place <= 5"""


_BASE = with_clauses(ARTICLES_SQL, _TOKENS_SQL, _GRAMS_SQL, _ENTRIES_SQL)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumn("share", F.round("share", 6)).select(*columns)


def _reread_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "grams_text")
    write_tsv(_grams(spark, sf_dir).select("gram", "cnt"), path)
    return read_grams(spark, path)


QUERIES: dict[str, Query] = {
    "read_grams": Query(
        _reread_grams, _BASE + "SELECT gram, CAST(n AS INTEGER) AS n, cnt FROM grams"
    ),
    "ngram_count": Query(
        _grams, _BASE + "SELECT gram, CAST(n AS INTEGER) AS n, cnt FROM grams"
    ),
    "emitted_counter": Query(
        lambda spark, d: ops.emitted_counter(_articles(spark, d)),
        _BASE + "SELECT count(*) AS emitted FROM emitted",
    ),
    "single_token_filter": Query(
        lambda spark, d: ops.unigrams(_grams(spark, d)),
        _BASE + "SELECT gram AS word, cnt FROM grams WHERE n = 1",
    ),
    "group_share": Query(
        lambda spark, d: _rounded(
            ops.group_share(ops.phrase_entries(_stored_grams(spark, d)), "head", "word"),
            *("head", "word", "cnt", "share"),
        ),
        _BASE
        + """SELECT head, word, cnt,
       round(cnt / CAST(sum(cnt) OVER (PARTITION BY head) AS DOUBLE), 6) AS share FROM phrases""",
    ),
    "word_completion": Query(
        lambda spark, d: _rounded(
            ops.word_completion(ops.unigrams(ops.ngram_count(_articles(spark, d), nmax=1))),
            *("prefix", "word", "cnt", "share", "position"),
        ),
        _BASE + _ranked_sql("prefixes", "prefix"),
    ),
    "next_word": Query(
        lambda spark, d: _rounded(
            ops.next_word(_stored_grams(spark, d)),
            *("head", "word", "cnt", "share", "position"),
        ),
        _BASE + _ranked_sql("phrases", "head"),
    ),
    "language_model": Query(
        lambda spark, d: ops.language_model(_articles(spark, d)).withColumn("share", F.round("share", 6)),
        _BASE
        + f"""SELECT 'completion' AS kind, prefix AS context, word, cnt, share, "position"
FROM ({_ranked_sql("prefixes", "prefix")})
UNION ALL
SELECT 'next', head, word, cnt, share, "position" FROM ({_ranked_sql("phrases", "head")})""",
    ),
    "write_wide_row": Query(
        lambda spark, d: _rounded(
            to_long_rows(
                materialise(
                    to_wide_rows(ops.next_word(_stored_grams(spark, d)), "head"), "wide_rows"
                ),
                "head",
            ),
            *("head", "word", "share"),
        ),
        _BASE + f"SELECT head, word, share FROM ({_ranked_sql('phrases', 'head')})",
    ),
}
