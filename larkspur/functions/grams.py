"""N-grams of blocks of texts: hashes that say which may be frequent, and the counted text of those.

A block holds the words of many texts as codes into its vocabulary. The hash of a gram is cut to 40
bits; equal grams have equal hashes, so a sum by hash is never below a gram's count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bits of a gram's hash.
HASH_BITS = 40
_ODD = np.uint64(0x9E3779B97F4A7C15)

BLOCK_DDL = "tokens long, vocabulary binary, codes binary, lengths binary"
#: Grams that a task holds to add up their counts before it sends them, about.
HELD = 1 << 21


def squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """Whole numbers byte by byte, the highest bytes first: those hardly change and compress well."""
    planes = numbers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
    return squeezed(np.ascontiguousarray(planes.T).tobytes())


def _of_planes(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(unsqueezed(raw), np.uint8).reshape(width, -1)
    numbers = np.zeros(planes.shape[1], np.uint64)
    for plane in planes:
        numbers = (numbers << np.uint64(8)) | plane
    return numbers


def packed_texts(texts: pa.Array) -> bytes:
    """Texts without nulls: their lengths in bytes, then all bytes."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int32)
    data = pa.concat_arrays([texts, pa.array([], texts.type)]).buffers()[2] if len(texts) else None
    return squeezed(len(lengths).to_bytes(8, "little") + lengths.tobytes() + (data.to_pybytes()[: lengths.sum()] if data else b""))


def unpacked_texts(raw: bytes) -> pa.Array:
    raw = unsqueezed(raw)
    n = int.from_bytes(raw[:8], "little")
    ends = np.zeros(n + 1, np.int32)
    np.cumsum(np.frombuffer(raw, np.int32, n, 8), out=ends[1:])
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[8 + 4 * n :])])


def blocks_of(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """Blocks of about ``block_words`` words from batches with one column ``words``; no text is cut."""
    held, lengths, size = [], [], 0

    def made() -> pa.RecordBatch:
        coded = pa.chunked_array(held, pa.string()).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        by_use = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        place = np.empty(len(by_use), np.int64)
        place[by_use] = np.arange(len(by_use))
        row = {
            "tokens": pa.array([size], pa.int64()),
            "vocabulary": pa.array([packed_texts(coded.dictionary.take(pa.array(by_use)))], pa.binary()),
            "codes": pa.array([_planes(place[codes], 4)], pa.binary()),
            "lengths": pa.array([squeezed(np.concatenate(lengths).astype(np.int32).tobytes())], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        lists = batch.column("words")
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(count)
        flat = lists.flatten()
        first = 0
        while first < len(count):
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + block_words - size, "right")))
            held.append(flat.slice(before, int(ends[last - 1]) - before))
            lengths.append(count[first:last])
            size += int(ends[last - 1]) - before
            first = last
            if first < len(count) or size >= block_words:
                yield made()
                held, lengths, size = [], [], 0
    if size:
        yield made()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def block_of(vocabulary: bytes, codes: bytes, lengths: bytes) -> Block:
    """A row of ``blocks_of``."""
    return Block(unpacked_texts(vocabulary), _of_planes(codes, 4).astype(np.int32).tobytes(), unsqueezed(lengths))


class Block:
    """The words of a block and its grams."""

    def __init__(self, vocabulary: pa.Array, codes: bytes, lengths: bytes) -> None:
        self.vocabulary = vocabulary
        self.codes = np.frombuffer(codes, np.int32)
        ends = np.cumsum(np.frombuffer(lengths, np.int32), dtype=np.int64)
        #: words from each place to the end of its text
        self.left = np.repeat(ends, np.frombuffer(lengths, np.int32)) - np.arange(len(self.codes))

    def hashes(self, nmax: int) -> list[np.ndarray]:
        """For n = 2..nmax the hashes of the grams at ``places(n)``."""
        words = [int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in self.vocabulary.to_pylist()]
        word = np.array(words, np.uint64)[self.codes]
        found, h = [], word
        for n in range(2, nmax + 1):
            if len(word) < n:
                break
            h = _mixed(h[:-1] * _ODD + word[n - 1 :] + np.uint64(n))
            found.append(h[self.left[: len(h)] >= n] >> np.uint64(64 - HASH_BITS))
        return found

    def places(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.left >= n)

    def counted(self, n: int, places: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """The grams of n words at ``places`` as text, each once, and how often they stand there."""
        if n == 1:
            count = np.bincount(self.codes[places], minlength=len(self.vocabulary))
            some = np.flatnonzero(count)
            return self.vocabulary.take(pa.array(some)), pa.array(count[some], pa.int64())
        words = [self.vocabulary.take(pa.array(self.codes[places + j])) for j in range(n)]
        each = pc.value_counts(pc.binary_join_element_wise(*words, " "))
        return each.field("values"), each.field("counts").cast(pa.int64())


def packed(keys: np.ndarray) -> bytes:
    """Sorted hashes by the steps from one to the next."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), HASH_BITS // 8)


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(raw, HASH_BITS // 8), dtype=np.uint64)


def sent(block: Block, nmax: int, most: int, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, hashes, counts) for each range of hashes; counts are cut at ``most``."""
    found = block.hashes(nmax)
    if not found:
        return
    keys, count = np.unique(np.concatenate(found), return_counts=True)
    count = np.minimum(count, most).astype(np.min_scalar_type(most))
    for part, rows in ranges(keys, bits):
        yield part, packed(keys[rows]), squeezed(count[rows].tobytes())


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The ranges (by their first ``bits`` bits) of sorted hashes that hold any."""
    parts = (keys >> np.uint64(HASH_BITS - bits)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, int)
    for low, high in zip(heads, [*heads[1:], len(keys)], strict=True):
        yield int(parts[low]), slice(int(low), int(high))


def answers(hashes: list[bytes], counts: list[bytes], least: int) -> list[bytes]:
    """For each block's hashes of a range one bit each: whether all blocks' counts reach ``least``."""
    keys = [unpacked(raw) for raw in hashes]
    every = np.concatenate(keys)
    weight = np.concatenate([np.frombuffer(unsqueezed(raw), np.min_scalar_type(least)) for raw in counts]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, weight = every[order], weight[order]
    head = np.concatenate([[True], every[1:] != every[:-1]])
    enough = np.add.reduceat(weight, np.flatnonzero(head)) >= least
    bits = np.empty(len(every), bool)
    bits[order] = enough[np.cumsum(head) - 1]
    return [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum([len(k) for k in keys])[:-1])]


def frequent(block: Block, nmax: int, told: dict[int, bytes], bits: int) -> pa.Table:
    """(gram, cnt) of the block: all single words, and longer grams whose hash may be frequent."""
    texts, numbers = [], []
    grams = [block.counted(1, block.places(1))]
    found = block.hashes(nmax)
    if found:
        keys = np.sort(np.concatenate(found))  # np.unique would hash, which takes four times as long
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        keep = np.zeros(len(keys), bool)
        for part, rows in ranges(keys, bits):
            size = rows.stop - rows.start
            keep[rows] = np.unpackbits(np.frombuffer(told[part], np.uint8), count=size).astype(bool)
        keys = keys[keep]
        for n, own in enumerate(found, start=2):
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            known = keys[at] == own if len(keys) else np.zeros(len(own), bool)
            if known.any():
                grams.append(block.counted(n, block.places(n)[known]))
    for text, number in grams:
        texts.append(text)
        numbers.append(number)
    return pa.table({"gram": pa.chunked_array(texts, pa.string()), "cnt": pa.chunked_array(numbers, pa.int64())})


def added_up(tables: list[pa.Table]) -> pa.Table:
    """(gram, cnt), each gram once."""
    rows = pa.concat_tables(tables).combine_chunks().group_by("gram").aggregate([("cnt", "sum")])
    return pa.table({"gram": rows["gram"], "cnt": rows["cnt_sum"]}).combine_chunks()


def shares(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(part, grams, counts): what a task has counted, added up and cut into parts by a hash of the gram."""

    def made(held: list[pa.Table]) -> pa.RecordBatch:
        rows = added_up(held)
        texts = rows["gram"].chunk(0)
        part = (pd.util.hash_array(texts.to_numpy(zero_copy_only=False), categorize=False) >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, texts, count = part[order], texts.take(pa.array(order)), rows["cnt"].to_numpy()[order]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        cuts = list(zip(first, np.append(first, len(part))[1:], strict=True))
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part[first], pa.int32()),
                "grams": pa.array([packed_texts(texts.slice(low, high - low)) for low, high in cuts], pa.binary()),
                "counts": pa.array([squeezed(count[low:high].tobytes()) for low, high in cuts], pa.binary()),
            }
        )

    held, size = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= HELD:
            yield made(held)
            held, size = [], 0
    if size:
        yield made(held)


def of_shares(rows: pa.Table, least: int) -> pa.Table:
    """(gram, cnt) of a part's rows whose counts together reach ``least``."""
    tables = [
        pa.table({"gram": unpacked_texts(grams), "cnt": pa.array(np.frombuffer(unsqueezed(counts), np.int64))})
        for grams, counts in zip(rows.column("grams").to_pylist(), rows.column("counts").to_pylist(), strict=True)
    ]
    whole = added_up(tables)
    return whole.filter(pc.greater_equal(whole["cnt"], least))
