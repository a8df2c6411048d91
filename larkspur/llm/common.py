"""Helpers shared by the text operators: tokens, learning splits, Arrow batches, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import configure, scratch_path, ship_package

#: Words are runs of anything but these; ``bytes.split`` cuts at exactly the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings and the package that Python stages need."""
    configure(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and nothing else; a null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a whole text."""
    return lowered(text).split()


def remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about SLICE_BYTES of text at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, done + SLICE_BYTES, side="right"))
            stop = max(start + 1, stop)
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def map_texts(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict[str, object] | None]
) -> DataFrame:
    """Apply ``work`` to bounded slices of ``df``; it returns the columns of ``schema`` by name."""
    names = [field.name for field in _struct(schema).fields]
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = work(part)
            if made is not None:
                arrays = [
                    a if isinstance(a := made[n], pa.Array) else pa.array(a, type=k)
                    for n, k in zip(names, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _arrow(schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(field.dataType) for field in _struct(schema).fields]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends, executors may go."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/larkspur/" in file:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of these lengths laid end to end: each element's row and its place in the row."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    return rows, np.arange(len(rows)) - starts[rows]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened by underscores until no column of ``df`` has them, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns named as operators name theirs (``__...``) under other names, and the way back.

    The second value gives a frame with the same columns their names, and order, again.
    """
    plain = [c.lower() for c in docs.columns]
    names, number = [], 0
    for name in docs.columns:
        if name.startswith("__"):
            while f"aside{number}" in plain:
                number += 1
            name, number = f"aside{number}", number + 1
        names.append(name)

    def back(result: DataFrame) -> DataFrame:
        pairs = zip(names, docs.columns, strict=True)
        return result.select(*(F.col(f"`{ours}`").alias(theirs) for ours, theirs in pairs))

    return docs.toDF(*names), back


def add_columns(
    df: DataFrame,
    ddl: str,
    work: Callable[[pa.RecordBatch], dict[str, object]],
    drop: tuple[str, ...] = (),
    column: str = "text",
) -> DataFrame:
    """Append the columns of ``ddl``, computed by ``work`` on bounded slices, and leave out ``drop``.

    All other columns pass through as they are, whatever their types. A column of ``df`` with a name
    in ``ddl``, in any case, is replaced; operators give theirs a leading underscore pair.
    """
    from pyspark.sql.types import StructType

    added = _struct(ddl)
    gone = {f.name.lower() for f in added.fields}
    place = [k for k, f in enumerate(df.schema.fields) if f.name not in drop and f.name.lower() not in gone]
    kept = [df.schema.fields[k] for k in place]
    names = [f.name for f in (*kept, *added.fields)]
    kinds = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            made = work(part)
            arrays = [part.column(k) for k in place]
            for field, kind in zip(added.fields, kinds, strict=True):
                a = made[field.name]
                arrays.append(a if isinstance(a, pa.Array) else pa.array(a, type=kind))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, StructType([*kept, *added.fields]))
