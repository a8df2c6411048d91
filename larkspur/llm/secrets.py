"""Secret scans: Aho-Corasick keywords, anchored expressions at their hits, then checks inside.

One automaton finds every keyword of every kind in one pass over the lower-cased text. Only where a
keyword stands is that kind's expression tried, anchored at the hit; a kind's matches are taken
from left to right without overlap, exactly as a search of the whole text would. No stretch is read
again for each hit inside it, so a text of one keyword over and over takes linear time. Strings of hex
digits have no keyword: the text's characters are folded to classes, and the keyword is 24 hex
classes in a row. Last, kinds with a check inside (checksum, encoded header, closing line) drop
matches that fail it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import add_columns, prepared, set_aside, table
from larkspur.plans.registry import Query

HEX_RUN = 24
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Bytes of lower-case hex digits become h, all others a space.
_HEX_CLASS = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))


@dataclass(frozen=True)
class Kind:
    name: str
    keywords: tuple[str, ...]  # lower case; each stands at the start of a match
    pattern: re.Pattern
    passes: Callable[[re.Match], bool]


def crc_token(match: re.Match) -> bool:
    """The last six characters are the base-62 CRC-32 of the rest behind the prefix."""
    body, check = match.group(1)[:-6], match.group(1)[-6:]
    value = 0
    for c in check:
        value = value * 62 + _BASE62.index(c)
    return value == zlib.crc32(body.encode())


def json_header(match: re.Match) -> bool:
    """The first part of a signed web token decodes to a JSON object that names an algorithm."""
    head = match.group(1)
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(found, dict) and "alg" in found


def iban_check(match: re.Match) -> bool:
    """ISO 7064 check of an account number: modulo 97 of the rotated digits is 1."""
    text = match.group(1)
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


# The base kinds are given by contract; the others are public token formats.
BASE_KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.ASCII | re.IGNORECASE,
        ),
        lambda m: m.end(2) - m.start(2) >= 6,
    ),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
    Kind("hex", (), re.compile(r"[0-9a-f]+"), lambda m: m.end() - m.start() >= HEX_RUN),
)
ADDED_KINDS = (
    Kind(
        "git",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
        crc_token,
    ),
    Kind("npm", ("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), crc_token),
    Kind("jwt", ("eyj",), re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), json_header),
    Kind("key", ("-----begin ",), re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----"), lambda m: True),
    Kind(
        "account",
        ("iban",),
        re.compile(r"IBAN[\x20:]*([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9])"),
        iban_check,
    ),
)
KINDS = BASE_KINDS + ADDED_KINDS
_NUMBER = {kind.name: k for k, kind in enumerate(KINDS)}
#: Characters that the first part of a signed web token can go on with.
_TOKEN_RUN = re.compile(r"[A-Za-z0-9_-]*")
#: Characters between the opening and the closing line of a private key.
_KEY_RUN = re.compile(r"[A-Za-z0-9+/=\s:,-]*")
_KEY_END = re.compile(r"(?=-----END ([A-Z ]*PRIVATE KEY)-----)")


class Closings:
    """Closing lines of private keys in one text: all found in one pass, at the first question."""

    def __init__(self, text: str):
        self.text = text
        self.places: dict[str, list[int]] | None = None
        self.run = (0, 0)  # the last run of key characters looked at

    def behind(self, opening: re.Match) -> int:
        """The end of the key that ``opening`` begins, or -1: its first closing line, if only key
        characters stand before it."""
        if self.places is None:
            self.places = {}
            for found in _KEY_END.finditer(self.text):
                self.places.setdefault(found.group(1), []).append(found.start())
        places, at = self.places.get(opening.group(1), []), opening.end()
        k = bisect_left(places, at)
        if k == len(places):
            return -1
        if not self.run[0] <= at <= self.run[1]:
            self.run = (at, _KEY_RUN.match(self.text, at).end())
        if places[k] > self.run[1]:
            return -1
        return places[k] + len(f"-----END {opening.group(1)}-----")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for number, kind in enumerate(KINDS):
        for word in kind.keywords:
            automaton.add_word(word, (number, len(word)))
    automaton.make_automaton()
    return automaton


def _hex_runs(low: bytes) -> list[tuple[int, int]]:
    folded, want, at, runs = low.translate(_HEX_CLASS), b"h" * HEX_RUN, 0, []
    while (at := folded.find(want, at)) >= 0:
        end = folded.find(b" ", at)
        end = len(folded) if end < 0 else end
        runs.append((at, end))
        at = end
    return runs


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """Spans (start, end, kind number) of a whole text in code points, by start, then kind."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    # A-Z alone are lowered, so that code points keep their places
    low = raw.lower()
    lowered = low.decode("utf-8", "surrogatepass")
    taken: dict[int, int] = {}
    spans = []
    # an anchored match begins at its keyword, so hits sorted by start are tried left to right
    hits = [(end + 1 - size, number) for end, (number, size) in _automaton().iter(lowered)]
    closings = Closings(text)
    for start, number in sorted(set(hits)):
        if start < taken.get(number, 0):
            continue
        kind = KINDS[number]
        match = kind.pattern.match(text, start)
        end = match.end() if match else -1
        if match and number == _NUMBER["key"]:
            end = closings.behind(match)
        if end >= 0:
            taken[number] = end
            if kind.passes(match):
                spans.append((start, end, number))
        elif number == _NUMBER["jwt"]:
            # a match needs the end of this run, so no other hit inside it has one
            taken[number] = _TOKEN_RUN.match(text, start).end()
    number = _NUMBER["hex"]
    shift = seen = 0  # bytes ahead of code points, up to the byte seen; each byte is read once
    for start, end in _hex_runs(raw):
        if len(raw) != len(text):
            shift += start - seen - len(raw[seen:start].decode("utf-8", "surrogatepass"))
            seen = start
        match = KINDS[number].pattern.match(text, start - shift, end - shift)
        if match and KINDS[number].passes(match):
            spans.append((match.start(), match.end(), number))
    return sorted(spans, key=lambda s: (s[0], s[2]))


def spelled(spans: list[tuple[int, int, int]], kinds: int = len(KINDS)) -> str:
    """kind:start:end of the spans whose kind number is below ``kinds``, comma-joined."""
    return ",".join(f"{KINDS[k].name}:{a}:{b}" for a, b, k in spans if k < kinds)


def find_secrets(docs: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``__spans`` (kind:start:end, ...), ``__base`` (base kinds only) and counts.

    Null and empty texts have none. All rows and other columns stay; ``drop`` names columns to
    leave out.
    """
    prepared(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = [scan(t) for t in batch.column("text").to_pylist()]
        counts = {
            f"__{kind.name}": [sum(s[2] == k for s in spans) for spans in found]
            for k, kind in enumerate(BASE_KINDS)
        }
        return counts | {
            "__base": [spelled(spans, len(BASE_KINDS)) for spans in found],
            "__spans": [spelled(spans) for spans in found],
        }

    ddl = "__assign long, __access long, __hex long, __base string, __spans string"
    return add_columns(docs, ddl, work, drop)


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with each stretch covered by spans replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    end = -1
    for start, stop, _ in scan(text):
        if start >= end:
            if end >= 0:
                at = end
            out += [text[at:start], mark]
            end = stop
        else:
            end = max(end, stop)
    return "".join(out) + text[end:] if end >= 0 else text


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; ``n_chars``, where there is one, follows it."""
    prepared(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        return {"__text": [redacted(t, mark) for t in batch.column("text").to_pylist()]}

    docs, back = set_aside(docs)
    clean = add_columns(docs, "__text string", work)
    changed = ~F.col("__text").eqNullSafe(F.col("text"))
    new = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        length = F.char_length("__text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return back(clean.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns)))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, drop=("text",)).select(
        "doc_id",
        F.col("__assign").alias("n_assign"),
        F.col("__access").alias("n_access"),
        F.col("__hex").alias("n_hex"),
        F.sha2(F.col("__base").cast("binary"), 256).alias("base_sha256"),
        F.col("__spans").alias("spans"),
    )


QUERIES = {"op5_secrets": Query(op5_secrets)}
