"""Token counts: the exact histogram of encoded lengths and the sums it answers.

Every whole text is encoded once; documents are counted by their number of tokens. Suffix sums over
that histogram, one row a length, give for any context limit how many documents are longer, how
many tokens they hold, and what remains when every document is cut there.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, prepared, table
from larkspur.plans.registry import Query

#: A public byte-pair vocabulary as ranks; any file of that form will do.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that cuts text ahead of the merges of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths that share a block of the suffix sums.
BLOCK = 1024


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    rows = (line.split() for line in ranks.splitlines() if line.strip())
    merges = {base64.b64decode(token): int(rank) for token, rank in rows}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def token_counts(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, drop: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` with ``__tokens``: the encoded length of the whole text, special strings as text.

    The driver reads the vocabulary, whose size is fixed, and sends it along, so executors need no
    file. Null and empty texts have none.
    """
    with open(vocabulary, "rb") as file:
        shared = prepared(docs.sparkSession).sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        encode = _encoding(shared.value, pattern).encode_ordinary
        return {"__tokens": [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]}

    return add_columns(docs, "__tokens long", work, drop)


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) and, for the limit n_tokens, the sums over all documents.

    ``docs_longer`` and ``tokens_longer`` are of documents beyond the limit, ``truncated_tokens``
    the total with every document cut at the limit, ``share_within`` the share of documents that
    fit. Sums run in blocks of lengths, the blocks' totals over one row a block.
    """
    counted = lengths.groupBy(F.col("__tokens").alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    rows = counted.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    per_block = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = per_block.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("d_above")).alias("docs_longer"),
        (F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("t_above")).alias("tokens_longer"),
        "docs_total",
        "tokens_total",
    )
    return summed.withColumn(
        "truncated_tokens",
        F.col("tokens_total") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens"),
    ).withColumn("share_within", 1 - F.col("docs_longer") / F.col("docs_total"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_longer, cut_tokens beyond it) for any context limits, from the histogram alone."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    joined = wanted.join(histogram, F.col("n_tokens") > F.col("limit"), "left")
    return joined.groupBy("limit").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.sum(F.col("n_docs") * (F.col("n_tokens") - F.col("limit"))), F.lit(0)).alias("cut_tokens"),
    )


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """(n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    fits = F.col("docs_total") - F.col("docs_longer") >= F.lit(share) * F.col("docs_total")
    return histogram.where(fits).agg(F.min("n_tokens").alias("n_tokens"))


def op8_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths of all documents with its sums."""
    docs = table(prepared(spark), sf_dir, "documents").select("text")
    return histogram(token_counts(docs, drop=("text",)))


QUERIES = {"op8_lengths": Query(op8_lengths)}
