"""Vectorised text helpers for code that runs inside Spark tasks.

Everything here works on one Arrow batch at a time: texts are handled as the
UTF-8 bytes of the batch plus document offsets, and words, word hashes and
window hashes are numpy arrays over all documents of a chunk.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that separate words: space and TAB..CR.
BREAKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(BREAKS)] = True

#: Stands for a null document id; it orders before every other id.
NULL_ID = -(1 << 63)

_SEEDS = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = [_SEEDS.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BLOCK = 1 << 16


def doc_key(id_col: str) -> Column:
    """The document id as a long that is never null (see :data:`NULL_ID`)."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def scan_bytes(df: DataFrame) -> int:
    """Planner's size estimate of ``df`` in bytes (file sizes; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string or binary array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if arr.null_count:
        arr = arr.fill_null("" if "string" in str(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together (one longer document stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_chunks(arr: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive chunks of a batch."""
    data, offsets = string_buffers(arr)
    for i, j in chunks(offsets, limit):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends and, per document, where its words begin (one more entry than documents)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = _BREAK[data]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    before[inner] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    after[inner - 1] = True
    word = ~gap
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0 .. n - 1 at least."""
    have = _POWERS.get(family)
    if have is None or len(have[0]) < n:
        size = max(n, _BLOCK + 1)
        base = _BASES[family]
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t))
        _POWERS[family] = have = (tables[0], tables[1])
    return have


def _prefix(n: int, values: Callable[[int, int], np.ndarray], family: int) -> np.ndarray:
    """Prefix polynomial hashes modulo 2**64, block by block: entry i + 1 is entry i times the base plus value i."""
    power, inverse = _powers(_BLOCK + 1, family)
    out = np.zeros(n + 1, np.uint64)
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        sums = np.cumsum(values(a, b) * inverse[1:b - a + 1])
        out[a + 1:b + 1] = (sums + out[a]) * power[1:b - a + 1]
    return out


def prefix_hash(values: np.ndarray, family: int = 0) -> np.ndarray:
    """Prefix polynomial hash of 64-bit values; entry i covers the first i values."""
    return _prefix(len(values), lambda a, b: values[a:b], family)


def byte_prefix(data: np.ndarray, family: int = 0) -> np.ndarray:
    """Prefix polynomial hash over bytes."""
    table = _BYTE_VALUES[family]
    return _prefix(len(data), lambda a, b: table[data[a:b]], family)


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of each range [start, end) from the prefix hashes, independent of where the range lies."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    power = _powers(int(sizes.max()) + 1, family)[0]
    return prefix[ends] - prefix[starts] * power[sizes]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A mixed 64-bit hash per word."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    return mix(range_hash(byte_prefix(data, family), starts, ends, family) + (ends - starts).astype(np.uint64))


def window_index(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``n`` items that lie inside one document: first item, document, start within it."""
    sizes = np.maximum(np.diff(bounds) - n + 1, 0)
    total = int(sizes.sum())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return bounds[:-1][doc] + within, doc, within


def window_hashes(hashes: np.ndarray, first: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """Rabin-Karp hash of the ``n`` word hashes from each entry of ``first``."""
    return mix(range_hash(prefix_hash(hashes, family), first, first + n, family))


_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_LETTERS_LATIN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == "L") + "]+").findall


def in_latin(text: str) -> bool:
    """Whether all characters are below U+0100."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def letter_words(text: str) -> list[str]:
    """Runs of letters (and the marks on them), in lower case."""
    text = text.lower()
    return _LETTERS_LATIN(text) if in_latin(text) else _LETTERS(text)
