"""Vectorised views of Arrow text columns: bytes, words, hashes, without Python strings."""

from __future__ import annotations

import ctypes
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a longer document is handled whole, alone.
CHUNK = 1 << 18
#: ASCII white space \x09-\x0D and \x20.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters, digits and all bytes of non-ASCII characters.
WORDLIKE = np.zeros(256, bool)
WORDLIKE[48:58] = WORDLIKE[65:91] = WORDLIKE[97:123] = WORDLIKE[128:] = True

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Return free memory to the system. Arrow's pool and the C library keep it else, and a Python worker serves task after task,
    of other operators too, at the largest size that it ever had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about CHUNK bytes of text. Between batches and at their end free memory goes back."""
    for batch in batches:
        give_back()
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.maximum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), 1))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
            yield batch.slice(at, to - at)
            at = to
        del batch
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, and len + 1 offsets; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse. Those for usual runs are kept, those for longer texts are made anew and go again."""
    usual = CHUNK + 1024
    if n <= usual and kind in _powers:
        return _powers[kind]
    made = []
    for base in (_BASES[kind], pow(_BASES[kind], -1, 2**64)):
        steps = np.full(max(n, usual), base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps, out=steps))
    if n <= usual:
        _powers[kind] = (made[0], made[1])
    return made[0], made[1]


#: Bytes of a range up to which prefix sums hash it. Texts of two letters in Thue-Morse order and their complements agree modulo 2^64
#: from about 1,000 bytes on, whatever the odd base; 32 bytes stay far below.
SUMMED = 32


class Rolling:
    """Hash of any byte range in 64 bits; kind 0 or 1 for independent hashes. Ranges of up to SUMMED bytes by prefix sums of
    byte value * base ** place, longer ones by blake2b."""

    def __init__(self, data: np.ndarray, kind: int = 0):
        self.data, self.kind = data, kind
        power, self.inverse = _tables(len(data) + 1, kind)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[kind][data] * power[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        long = np.flatnonzero(ends - starts > SUMMED)
        if len(long):
            view, half = memoryview(np.ascontiguousarray(self.data)), slice(8 * self.kind, 8 * self.kind + 8)
            digest = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest()[half] for a, b in zip(starts[long].tolist(), ends[long].tolist()))
            out[long] = np.frombuffer(digest, "<u8")
        return out


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs where apart is False, none across rows; and each row's first word (len + 1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first = np.ones(len(data), bool)
    first[1:] = apart[:-1]
    last = np.ones(len(data), bool)
    last[:-1] = apart[1:]
    filled = offsets[1:] > offsets[:-1]
    first[offsets[:-1][filled]] = True
    last[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(first & ~apart)
    ends = np.flatnonzero(last & ~apart) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values within each row's range."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def crc32_of(doc_ids: pa.Array) -> np.ndarray:
    """crc32 of each id as decimal text; null as empty text."""
    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) for x in doc_ids.to_pylist()], np.int64)
