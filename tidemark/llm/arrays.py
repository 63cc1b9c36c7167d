"""Words and hashes of whole Arrow batches with numpy, for operators whose tasks work on arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)  # odd, as every multiplier below must be
BACK = U64(pow(int(STEP), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * STEP)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < size:
        grown = np.full(max(size, 2 * len(have)), base, U64)
        grown[0] = 1
        have = _powers[name] = np.multiply.accumulate(grown)
    return have[:size]


def release() -> None:
    """Give freed memory back to the system; Arrow and the C library otherwise keep much of it while the worker lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], *texts: str, limit: int = CHUNK_BYTES, lean: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece hold about `limit` bytes; a longer text is a piece of its own.

    `lean` gives memory freed since back to the system after each piece.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.zeros(batch.num_rows, np.int64)
        for name in texts:
            sizes += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            if lean:
                release()
            start = stop


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range behind the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the offsets of each; null counts as empty."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    at = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    whole = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return whole, at - at[0]


def find_words(data: np.ndarray, at: np.ndarray, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; words never cross texts. `outside` marks the bytes between words."""
    inside = ~outside[data]
    n = len(data)
    after = np.zeros(n, bool)  # the byte before it belongs to the same text and to a word
    after[1:] = inside[:-1]
    heads = at[:-1][at[:-1] < n]
    after[heads] = False
    starts = np.flatnonzero(inside & ~after)
    before = np.zeros(n, bool)
    before[:-1] = inside[1:]
    before[heads[heads > 0] - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from running sums."""
    n = len(data)
    sums = np.zeros(n + 1, U64)
    np.cumsum(BYTE_CODE[data] * _power("up", STEP, n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power("down", BACK, n + 1)[starts]
    return mix(value + (ends - starts).astype(U64))


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each span's bytes among the different ones, and those different ones."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    letters = pa.py_buffer(np.ascontiguousarray(data[ranges(starts, lengths)]))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), letters])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data)


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every window of `size` words, in text order; letters A-Z count as lower case."""
    data, at = utf8(texts)
    data = lower_ascii(data)
    starts, ends, text = find_words(data, at)
    if len(starts) < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    words = hash_spans(data, starts, ends)
    last = len(words) - size + 1
    value = np.zeros(last, U64)
    for k in range(size):
        value = mix(value * STEP + words[k : k + last])
    whole = text[:last] == text[size - 1 :]
    return text[:last][whole], value[whole]


def multiset(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, value) in order, and how often each occurs."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return text[first], value[first], np.diff(np.append(first, len(text)))
