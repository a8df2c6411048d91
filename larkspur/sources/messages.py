"""Rows as messages with a key and a JSON value, as message brokers carry them.

Pure column work: the same functions serve a broker source or sink by format name, where its jar is
on the class path, and files in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BROKEN = "_broken"


def encode_messages(rows: DataFrame, key: str) -> DataFrame:
    """(key, value): the key column as text, and all columns as one JSON object."""
    value = F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)))
    return rows.select(F.col(f"`{key}`").cast("string").alias("key"), value.alias("value"))


def decode_messages(
    messages: DataFrame, schema: str, malformed: Observation | None = None
) -> DataFrame:
    """Rows of ``schema`` from the JSON in ``value``, text or bytes.

    Messages that are not such an object, null ones included, are left out, and counted as
    ``malformed`` by the observation given. The value is parsed once.
    """
    fields = T.StructType.fromDDL(schema)
    wide = T.StructType([*fields.fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = F.from_json(F.col("value").cast("string"), wide, options)
    good = F.filter(F.array(parsed), lambda r: r.isNotNull() & r[_BROKEN].isNull())
    rows = messages.select(good.alias("_rows"))
    if malformed is not None:
        rows = rows.observe(malformed, F.count_if(F.size("_rows") == 0).alias("malformed"))
    return rows.select(F.explode("_rows").alias("_row")).select(
        *(F.col(f"_row.`{f.name}`").alias(f.name) for f in fields.fields)
    )
