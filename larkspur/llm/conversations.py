"""Repair of conversation structure by cheapest edits: a checkpointed dynamic programme.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Rows are kept,
given another role or deleted, and empty turns are inserted; blank and repeated rows must go. The
cheapest edits follow from backward vectors: the cost of all that is left, for each of four states
(nothing yet, after s, after u, after a).

Only every sqrt(n)-th vector is stored. The walk forward recomputes one block of vectors at a time
from its checkpoint and takes, of the cheapest edits, the least in ASCII (D, I, K, R).

Long conversations are cut into pieces that are handled in parallel. A piece is a 4 x 4 table of
costs; chaining the tables from the end gives the vector behind each piece, and chaining the states
in which walks leave the pieces gives the state in front of it. So no task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from larkspur.llm.common import prepared, table, written
from larkspur.operators.skew import PIECE, SPLIT, null_safe_join, with_pieces
from larkspur.plans.registry import Query

#: Rows of a conversation in one piece, about.
PIECE_ROWS = 4096
#: Turns whose rows are counted together when a long conversation is cut.
SLOT_TURNS = 256
BLANKS = " \t\n\x0b\f\r"

NEVER = 1 << 60
#: The state after the turn that the pattern asks for next: u, u, a, u.
FILLED = (2, 2, 3, 2)
#: The state after an initial, by state; a missing one is not allowed.
KEPT = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
ROLES = {2: "user", 3: "assistant"}
#: What is left to pay behind the last row: turns that complete the pattern.
LAST = (0, 4, 2, 0)
FORCED = 8  # the kind of rows that must go; else the initial's number, and 4 more if truncated


def before(kind: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector in front of a row of this kind, from the one behind it."""
    if kind == FORCED:
        return tuple(3 + x for x in after)
    late, ways = kind >> 2, KEPT[kind & 3]
    best = [
        min(3 + after[q], 2 + late + after[FILLED[q]], NEVER if ways[q] is None else late + after[ways[q]])
        for q in range(4)
    ]
    for q in (2, 3, 0, 1):  # an inserted turn leads from each state to the next
        best[q] = min(best[q], 2 + best[FILLED[q]])
    return tuple(best)


def vectors(kinds: bytes, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The vectors in front of each of these rows, and the one behind the last."""
    found = [after]
    for kind in reversed(kinds):
        found.append(before(kind, found[-1]))
    return found[::-1]


def checkpoints(kinds: bytes, after: tuple[int, ...], width: int) -> list[tuple[int, ...]]:
    """The vectors in front of rows 0, width, 2 width, ... and the one behind the last row."""
    found, now = [after], after
    for place in range(len(kinds) - 1, -1, -1):
        now = before(kinds[place], now)
        if place % width == 0:
            found.append(now)
    return found[::-1]


def walk(
    kinds: bytes, after: tuple[int, ...], state: int, end: bool, edit: Callable[[int, str, int], None]
) -> int:
    """Call ``edit`` (row, letter, state behind it) for the cheapest, ASCII-least edits from ``state``.

    Inserted turns are named with the row they come before. Returns the state behind the rows.
    """
    width = isqrt(len(kinds)) + 1
    stored = checkpoints(kinds, after, width)
    for block in range(len(stored) - 1):
        start = block * width
        part = kinds[start : start + width]
        inside = vectors(part, stored[block + 1])
        for k, kind in enumerate(part):
            now, then = inside[k], inside[k + 1]
            while now[state] != 3 + then[state] and now[state] == 2 + now[FILLED[state]]:
                state = FILLED[state]
                edit(start + k, "I", state)
            if now[state] == 3 + then[state]:
                edit(start + k, "D", state)
                continue
            kept = KEPT[kind & 3][state]
            if kept is not None and now[state] == (kind >> 2) + then[kept]:
                state = kept
                edit(start + k, "K", state)
            else:
                state = FILLED[state]
                edit(start + k, "R", state)
    while end and after[state]:
        state = FILLED[state]
        edit(len(kinds), "I", state)
    return state


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): rows as the crc32 of their place leaves them.

    Null roles and texts become one space. Of the remainders modulo 20, 0 drops the row, 1 empties
    its text, 2 removes ``.!?`` from it, 3 says it twice and 4 makes it the user's.
    """
    place = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    kind = F.col("__kind")
    marked = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "__kind", F.crc32(place.cast("binary")) % 20
    )
    return marked.where("__kind != 0").select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def same_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, key, times, initial, blank, late): one row for equal rows of a turn.

    ``key`` is the MD5 of the text. Rows are added up before they are shuffled, so that a row
    repeated any number of times costs little.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    slim = turns.select(
        "conv_id", "turn", "role", "times", F.md5("text").alias("key"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*".!?")).alias("late"),
    )
    return slim.groupBy("conv_id", "turn", "role", "key").agg(
        F.sum("times").alias("times"),
        F.any_value("blank").alias("blank"),
        F.any_value("late").alias("late"),
    )


def with_kinds(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seen``: the same role and text stand in an earlier turn of the conversation."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = (
        rows.groupBy("conv_id", "role", "key")
        .agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("conv_id", "role", "key", "first")
    )
    return (
        null_safe_join(rows, first, ["conv_id", "role", "key"], "left")
        .withColumn("seen", F.coalesce(turn > F.col("first"), F.lit(False)))
        .drop("first")
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict]]:
    """Consecutive rows with the same keys, as (keys, columns); rows must come sorted by them."""
    group, held = None, None
    for batch in batches:
        columns = batch.to_pydict()
        names = list(columns)
        for row in zip(*columns.values(), strict=True):
            own = dict(zip(names, row, strict=True))
            at = tuple(own[k] for k in keys)
            if at != group or held is None:
                if held is not None:
                    yield group, held
                group, held = at, {n: [] for n in names}
            for n in names:
                held[n].append(own[n])
    if held is not None:
        yield group, held


def _streamed(df: DataFrame, schema: StructType, rows: Callable, keys: list[str]) -> DataFrame:
    """Apply ``rows`` (keys, columns) -> dict to each run of ``keys`` in the sorted partitions of ``df``."""
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        for group, columns in _runs(batches, keys):
            made += rows(group, columns)
            if len(made) >= 1024:
                yield batch(made)
                made = []
        if made:
            yield batch(made)

    def batch(made: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([m[n] for m in made], type=k) for n, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def _schema(conv: StructField, ddl: str) -> StructType:
    return StructType([StructField("conv_id", conv.dataType, True), *StructType.fromDDL(ddl).fields])


_PIECE = (
    "_piece long, split boolean, kinds binary, extra array<long>, rows array<struct<turn:long,role:string,key:string>>, "
    "costs array<long>, head string, tail string, illegal long, blank long, duplicate long, truncated long, "
    "lowest long, highest long, turns long, last long"
)


def laid_out(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for each piece of a conversation: its rows' kinds and keys, its costs, its counts."""
    bucket = F.conv(F.substring("key", 1, 4), 16, 10).cast("long") * max(1, piece_rows // 16)
    cut = with_pieces(rows, ["conv_id"], "turn", piece_rows, SLOT_TURNS, ("role", bucket))
    order = [F.asc_nulls_first("conv_id"), PIECE, F.asc_nulls_first("turn"), "role", "key"]
    dealt = cut.repartition("conv_id", PIECE).sortWithinPartitions(*order)

    def piece(group: tuple, c: dict) -> list[dict]:
        kinds, extra, turns = bytearray(), [], [t for t in c["turn"] if t is not None]
        blank = duplicate = truncated = illegal = 0
        old = None
        for role, times, empty, late, seen in zip(
            c["role"], c["times"], c["blank"], c["late"], c["seen"], strict=True
        ):
            first = role[:1]
            illegal += times - 1 + (old is not None and old + first not in ("su", "ua", "au"))
            old = first
            forced = empty or seen
            kinds.append(FORCED if forced else "sua?".index(first if first in ("s", "u", "a") else "?") + 4 * late)
            extra.append(times if forced else times - 1)
            blank += times * empty
            duplicate += 0 if empty else times if seen else times - 1
            truncated += not forced and late
        codes, split = bytes(kinds), c[SPLIT][0]
        costs = []
        if split:
            units = [tuple(0 if q == r else NEVER for q in range(4)) for r in range(4)]
            columns = [checkpoints(codes, unit, len(codes) + 1)[0] for unit in units]
            costs = [min(columns[r][q], NEVER) for q in range(4) for r in range(4)]
        return [{
            "conv_id": group[0], "_piece": group[1], "split": split, "kinds": codes, "extra": extra,
            "rows": [{"turn": t, "role": r, "key": k} for t, r, k in zip(c["turn"], c["role"], c["key"], strict=True)],
            "costs": costs, "head": c["role"][0][:1], "tail": c["role"][-1][:1], "illegal": illegal,
            "blank": blank, "duplicate": duplicate, "truncated": truncated,
            "lowest": min(turns, default=None), "highest": max(turns, default=None),
            "turns": len(set(turns)), "last": c["turn"][-1],
        }]

    return _streamed(dealt, _schema(rows.schema["conv_id"], _PIECE), piece, ["conv_id", PIECE])


def _chained(pieces: DataFrame, columns: list[str], ddl: str, down: bool, link: Callable) -> DataFrame:
    """Carry a value along the pieces of each conversation; ``link`` (value, row) -> (out, value)."""
    keys = [F.asc_nulls_first("conv_id"), F.desc(PIECE) if down else F.asc(PIECE)]
    dealt = pieces.select("conv_id", PIECE, *columns).repartition("conv_id").sortWithinPartitions(*keys)
    schema = _schema(pieces.schema["conv_id"], f"_piece long, {ddl}")
    names = [f.name for f in schema.fields]
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, value, begun = None, None, False
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != group:
                    group, value, begun = row["conv_id"], None, True
                out, value = link(value, row)
                made.append((row["conv_id"], row[PIECE], out))
            arrays = [pa.array(list(c), type=k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return dealt.mapInArrow(run, schema)


def _bounded(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``after`` (the vector behind), ``state`` (in front) and ``end`` (is the last)."""

    def behind(value, row):
        now = list(LAST) if value is None else value
        table = row["costs"]
        ahead = [min(min(table[4 * q + r] + now[r] for r in range(4)), NEVER) for q in range(4)]
        return now, ahead

    def entered(value, row):
        now = 0 if value is None else value
        return now, row["exits"][now]

    whole = pieces.where("!split").withColumns(
        {"after": F.array(*(F.lit(x).cast("long") for x in LAST)), "state": F.lit(0), "end": F.lit(True)}
    )
    long = pieces.where("split")
    final = long.groupBy("conv_id").agg(F.max(PIECE).alias("final"))
    vector = _chained(long, ["costs"], "after array<long>", True, behind)
    long = null_safe_join(long, vector, ["conv_id", PIECE])
    long = null_safe_join(long, final, ["conv_id"]).withColumn("end", F.col(PIECE) == F.col("final"))

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                [walk(k, tuple(a), q, False, lambda *_: None) for q in range(4)]
                for k, a in zip(batch.column("kinds").to_pylist(), batch.column("after").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column(PIECE), pa.array(made, pa.list_(pa.int32()))],
                names=["conv_id", PIECE, "exits"],
            )

    left = long.select("conv_id", PIECE, "kinds", "after").mapInArrow(
        exits, _schema(pieces.schema["conv_id"], "_piece long, exits array<int>")
    )
    state = _chained(left, ["exits"], "state int", False, entered)
    long = null_safe_join(long, state, ["conv_id", PIECE]).select(*whole.columns)
    return whole.unionByName(long)


_PLAN = (
    "_piece long, audit string, cost long, kept array<struct<turn:long,role:string,key:string,place:int,now:string,edit:string>>, "
    "inserted array<struct<place:int,now:string>>"
)


def edits(pieces: DataFrame) -> DataFrame:
    """(conv_id, _piece, audit, cost, kept, inserted): the cheapest edits of each piece."""
    names = ["conv_id", *(f.name for f in StructType.fromDDL(_PLAN).fields)]
    schema = _schema(pieces.schema["conv_id"], _PLAN)
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def planned(row: dict) -> tuple:
        codes, extra, rows = row["kinds"], row["extra"], row["rows"]
        audit, kept, inserted, cost, place = [], [], [], 0, 0

        def edit(k: int, letter: str, state: int) -> None:
            nonlocal cost, place
            forced = k < len(codes) and codes[k] == FORCED
            if letter == "I":
                inserted.append({"place": place, "now": ROLES[state]})
                audit.append("I")
                cost += 2
                place += 1
                return
            if letter != "D":
                now = rows[k]["role"] if letter == "K" else ROLES[state]
                kept.append({**rows[k], "place": place, "now": now, "edit": letter})
                place += 1
                cost += (codes[k] >> 2) + 2 * (letter == "R")
            if not forced:
                audit.append(letter)
                cost += 3 * (letter == "D")
            audit.append("D" * extra[k])
            cost += 3 * extra[k]

        walk(codes, tuple(row["after"]), row["state"], row["end"], edit)
        return row["conv_id"], row[PIECE], "".join(audit), cost, kept, inserted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                made = [planned(r) for r in batch.slice(start, 256).to_pylist()]
                arrays = [pa.array(list(c), type=k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = ["conv_id", PIECE, "kinds", "extra", "rows", "after", "state", "end"]
    return _bounded(pieces).select(*chosen).mapInArrow(run, schema)


def findings(pieces: DataFrame, planned: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, faults, cost and audit, added up over its pieces."""
    along = Window.partitionBy("conv_id").orderBy(PIECE)
    joined = F.concat(F.lag("tail").over(along), F.col("head"))
    shared = (F.lag("last").over(along) == F.element_at("rows.turn", 1)).cast("long")
    apart = pieces.withColumns(
        {
            "illegal": F.col("illegal") + F.coalesce((~joined.isin("su", "ua", "au")).cast("long"), F.lit(0)),
            "turns": F.col("turns") - F.coalesce(shared, F.lit(0)),
        }
    )
    counts = apart.groupBy("conv_id").agg(
        (F.max("highest") - F.min("lowest") + 1 - F.sum("turns")).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
    )
    parts = F.transform(F.sort_array(F.collect_list(F.struct(PIECE, "audit"))), lambda x: x["audit"])
    texts = planned.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.array_join(parts, "").alias("audit"))
    return null_safe_join(counts, texts, ["conv_id"])


def repair(turns: DataFrame, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(repaired, findings) of rows (conv_id, turn, role, text, times).

    ``repaired`` has (conv_id, piece, place, edit, role, text); sorted by piece and place the rows of a
    conversation are well formed. ``findings`` has a row for each conversation with rows: gaps,
    blank, duplicate, truncated, illegal, cost, audit.

    Rows are taken by turn (nulls first), then role, then the MD5 of the text; equal rows of a turn
    lie side by side and all but the first are duplicates. A null conv_id is a conversation, and
    turns that are all null leave no gaps. Roles other than s..., u..., a... never fit as they are.
    Empty input gives two empty frames. Other columns of ``turns`` are not looked at.
    """
    prepared(turns.sparkSession)
    rows = written(with_kinds(same_rows(turns)), "turns")
    pieces = written(laid_out(rows, piece_rows), "pieces")
    planned = written(edits(pieces), "edits")
    kept = planned.select("conv_id", PIECE, F.explode("kept").alias("k")).select("conv_id", PIECE, "k.*")
    texts = turns.select("conv_id", "turn", "role", F.md5("text").alias("key"), "text")
    once = texts.dropDuplicates(["conv_id", "turn", "role", "key"])
    met = null_safe_join(kept, once, ["conv_id", "turn", "role", "key"])
    stayed = met.select("conv_id", F.col(PIECE).alias("piece"), "place", "edit", F.col("now").alias("role"), "text")
    new = planned.select("conv_id", F.col(PIECE).alias("piece"), F.explode("inserted").alias("i")).select(
        "conv_id", "piece", "i.place", F.lit("I").alias("edit"), F.col("i.now").alias("role"), F.lit("").alias("text")
    )
    return stayed.unionByName(new), findings(pieces, planned)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines; one stream a conversation, held row by row."""
    order = [F.asc_nulls_first("conv_id"), "piece", "place"]
    dealt = repaired.select("conv_id", "piece", "place", "role", "text")
    dealt = dealt.repartition("conv_id").sortWithinPartitions(*order)
    schema = _schema(repaired.schema["conv_id"], "repaired_sha256 string")
    kind = to_arrow_type(repaired.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, running, names, made = None, None, [], []
        for batch in batches:
            c = batch.to_pydict()
            for conv, role, text in zip(c["conv_id"], c["role"], c["text"], strict=True):
                if running is None or conv != group:
                    if running is not None:
                        names.append(group)
                        made.append(running.hexdigest())
                    group, running = conv, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if len(made) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(made)], names=schema.names)
                names, made = [], []
        if running is not None:
            names, made = [*names, group], [*made, running.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(made)], names=schema.names)

    return dealt.mapInArrow(run, schema)


def digested(turns: DataFrame, damaged: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """A row for every conv_id of ``turns``: what ``repair`` finds in ``damaged``, and its digest."""
    repaired, found = repair(damaged, piece_rows)
    ids = turns.select("conv_id").distinct()
    joined = null_safe_join(ids, found, ["conv_id"], "left")
    joined = null_safe_join(joined, digests(repaired), ["conv_id"], "left")

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)

    return joined.select(
        "conv_id",
        *(count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after the damage."""
    turns = table(prepared(spark), sf_dir, "conversations")
    return digested(turns, damage(turns))


_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT [list_reduce(list_concat([CAST(b AS BIGINT)], [0, 1, 2, 3, 4, 5, 6, 7]),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
    FOR b IN range(0, 256)] AS t),
said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations),
marked AS (
  SELECT said.*, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      [CAST(ascii(c) AS BIGINT) FOR c IN string_split(place, '')]),
      lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM said, bits),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copies(c) WHERE kind > 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt),
faults AS (
  SELECT *, left(role, 1) AS initial, bare = '' AS blank,
    bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice,
    CASE WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS late,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS old
  FROM placed),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (twice) AS duplicate,
    count(*) FILTER (NOT blank AND NOT twice AND late = 1) AS truncated,
    count(*) FILTER (old || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
back AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 4 AS v1, 2 AS v2, 0 AS v3 FROM counts
  UNION ALL
  SELECT conv_id, i, least(b0, 2 + least(b2, 2 + b3)), least(b1, 2 + least(b2, 2 + b3)), least(b2, 2 + b3), least(b3, 2 + b2)
  FROM (
    SELECT f.conv_id, f.i,
      least(3 + v0, CASE WHEN gone THEN 99999999 ELSE least(2 + late + v2, CASE initial WHEN 's' THEN late + v1 WHEN 'u' THEN late + v2 ELSE 99999999 END) END) AS b0,
      least(3 + v1, CASE WHEN gone THEN 99999999 ELSE least(2 + late + v2, CASE initial WHEN 'u' THEN late + v2 ELSE 99999999 END) END) AS b1,
      least(3 + v2, CASE WHEN gone THEN 99999999 ELSE least(2 + late + v3, CASE initial WHEN 'a' THEN late + v3 ELSE 99999999 END) END) AS b2,
      least(3 + v3, CASE WHEN gone THEN 99999999 ELSE least(2 + late + v2, CASE initial WHEN 'u' THEN late + v2 ELSE 99999999 END) END) AS b3
    FROM back JOIN (SELECT *, blank OR twice AS gone FROM faults) f ON f.conv_id IS NOT DISTINCT FROM back.conv_id AND f.i = back.i - 1)),
cost AS (
  SELECT a.conv_id, a.i, [a.v0, a.v1, a.v2, a.v3] AS v, coalesce([b.v0, b.v1, b.v2, b.v3], [-9, -9, -9, -9]) AS w,
    f.role, f.text, f.initial, f.late, a.v0 AS first
  FROM back a LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = a.i + 1
  LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = a.i),
edit AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS i, 1 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS lines, false AS over FROM counts
  UNION ALL
  SELECT conv_id, i + CASE WHEN letter = 'I' THEN 0 ELSE 1 END,
    CASE letter WHEN 'D' THEN q WHEN 'K' THEN kept ELSE filled END, audit || letter,
    CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE filled WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END,
    false
  FROM (
    SELECT *, CASE WHEN v[q] = 3 + w[q] THEN 'D' WHEN v[q] = 2 + v[filled] THEN 'I'
      WHEN kept > 0 AND v[q] = late + w[kept] THEN 'K' WHEN role IS NOT NULL THEN 'R' END AS letter
    FROM (
      SELECT e.*, c.v, c.w, c.role, c.text, c.late, CASE q WHEN 3 THEN 4 ELSE 3 END AS filled,
        CASE WHEN c.initial = 's' AND q = 1 THEN 2 WHEN c.initial = 'u' AND q <> 3 THEN 3 WHEN c.initial = 'a' AND q = 3 THEN 4 ELSE 0 END AS kept
      FROM edit e JOIN cost c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.i = e.i))
  WHERE letter IS NOT NULL),
ended AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(lines, length(audit)) AS lines FROM edit GROUP BY conv_id),
named AS (SELECT DISTINCT conv_id FROM conversations)
SELECT named.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(k.first, 0) AS BIGINT) AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM named LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM named.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM named.conv_id
LEFT JOIN cost k ON k.conv_id IS NOT DISTINCT FROM named.conv_id AND k.i = 1
"""

QUERIES = {"op11_conversations": Query(op11_conversations, _SQL)}
