"""Packed exchange of keyed positions between tasks.

A corpus has about one window per word, so sending one Spark row per window
would cost several times the input.  Tasks send arrays instead: per bucket
one row holding the 64-bit keys, the names of the documents and the positions of
all its windows (8 bytes of key and one to two bytes of place per window).  Spark
deals the rows out by bucket; buckets are taken one after the other.

A document is named by its id and the hash of its text (``key, twin``), since an
id may be null or shared.  Inside a task documents are numbers into a table of
names, ascending as the names do.

A key that is frequent in one batch is sent once per batch (its first place),
so a key shared by a third of all rows reaches its bucket as one entry per
batch and not as one per row.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._text import doc_key, scan_bytes

PLACES = "part int, kind byte, payload binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int8()), ("payload", pa.binary())])
#: kind of a row: keys that are to be compared, or places already decided.
KEYS, DECIDED = 0, 1
#: Decided places a task holds before it sends them.
SETTLED = 1 << 18
#: Input bytes (as stored) per bucket, and the largest number of buckets.
BUCKET_BYTES, MOST_BUCKETS = 4 << 20, 1 << 18
_MUL = np.uint64(0x9E3779B97F4A7C15)


def n_buckets(df: DataFrame) -> int:
    """Number of buckets for a scan: in proportion to its size, two a shuffle partition at least.
    It only decides how work is cut, never what is compared."""
    spark: SparkSession = df.sparkSession
    least = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(max(least, scan_bytes(df) // BUCKET_BYTES), MOST_BUCKETS)


#: Ids and text hashes of numbered documents.
Names = tuple[np.ndarray, np.ndarray]


def number(ids: np.ndarray, twins: np.ndarray) -> tuple[np.ndarray, Names]:
    """Number of each (id, text hash) in the table of all of them, and that table; equal pairs are one document."""
    order = np.lexsort((twins, ids))
    i, t = ids[order], twins[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(i), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, (i[new], t[new])


def join_names(docs: list[np.ndarray], names: list[Names]) -> tuple[np.ndarray, Names]:
    """Documents numbered by one table each, numbered by one table of them all."""
    ranks, table = number(*(np.concatenate(x) for x in zip(*names)))
    begin = np.cumsum([0, *(len(n[0]) for n in names)])
    return np.concatenate([ranks[b + d] for b, d in zip(begin, docs)]), table


def group_of(names: Names, n: int) -> np.ndarray:
    """Document group of each name: documents are dealt to ``n`` groups by a hash of their id and text hash."""
    x = (names[0].view(np.uint64) * _MUL ^ names[1].view(np.uint64)) * _MUL
    return ((x >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, dtype: str, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).reshape(n)


def pack(docs: np.ndarray, places: np.ndarray, keys: np.ndarray | None = None) -> bytes:
    """Bytes of the three arrays; documents ascend, places ascend within a document."""
    n = len(docs)
    turn = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1]))) if n else np.zeros(0, np.int64)
    step = np.diff(places, prepend=np.int64(0)).astype(np.int64)
    step[turn] = places[turn]
    ids = np.diff(docs[turn], prepend=np.int64(0)).astype("<i8")
    sizes = np.diff(np.append(turn, n)).astype("<u4")
    small = zstandard.ZstdCompressor(level=1).compress(_planes(ids) + _planes(sizes) + _planes(step.astype("<u4")))
    tail = b"" if keys is None else np.ascontiguousarray(keys, "<u8").tobytes()
    return struct.pack("<III", n, len(turn), len(small)) + small + tail


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    n, m, size = struct.unpack_from("<III", raw)
    flat = zstandard.ZstdDecompressor().decompress(raw[12:12 + size], max_output_size=12 * m + 4 * n + 1)
    ids = np.cumsum(_unplanes(flat[:8 * m], "<i8", m))
    sizes = _unplanes(flat[8 * m:12 * m], "<u4", m).astype(np.int64)
    step = _unplanes(flat[12 * m:], "<u4", n).astype(np.int64)
    run = np.cumsum(step)
    begin = np.cumsum(sizes) - sizes
    before = np.where(begin > 0, run[begin - 1], 0) if m else run[:0]
    keys = np.frombuffer(raw, "<u8", n, 12 + size) if len(raw) > 12 + size else None
    return np.repeat(ids, sizes), run - np.repeat(before, sizes), keys


def pack_named(docs: np.ndarray, places: np.ndarray, keys: np.ndarray | None, names: Names) -> bytes:
    """:func:`pack` with the names of the documents; documents ascend, places ascend within a document."""
    own, at = np.unique(docs, return_inverse=True)
    head = zstandard.ZstdCompressor(level=1).compress(_planes(np.diff(names[0][own], prepend=np.int64(0)).astype("<i8")))
    return struct.pack("<II", len(own), len(head)) + head + names[1][own].astype("<i8").tobytes() + pack(at, places, keys)


def unpack_named(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, Names]:
    m, size = struct.unpack_from("<II", raw)
    flat = zstandard.ZstdDecompressor().decompress(raw[8:8 + size], max_output_size=8 * m + 1)
    names = np.cumsum(_unplanes(flat, "<i8", m)), np.frombuffer(raw, "<i8", m, 8 + size)
    return (*unpack(raw[8 + size + 8 * m:]), names)


def row_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _SCHEMA.field(i).type) for i in range(3)], schema=_SCHEMA)


def by_part(part: np.ndarray, kind: int, docs: np.ndarray, places: np.ndarray,
            keys: np.ndarray | None, names: Names) -> Iterator[pa.RecordBatch]:
    """One row per value of ``part``; the order within a part stays."""
    if len(part) == 0:
        return
    small = np.uint16 if part.max() < 1 << 16 else np.uint32
    order = np.argsort(part.astype(small), kind="stable")
    cut = part[order]
    edges = np.append(np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1]))), len(cut))
    rows, size = [], 0
    for a, b in zip(edges[:-1], edges[1:]):
        sel = order[a:b]
        rows.append((int(cut[a]), kind, pack_named(docs[sel], places[sel], None if keys is None else keys[sel], names)))
        size += len(rows[-1][2])
        if size > 4 << 20:
            yield row_batch(rows)
            rows, size = [], 0
    if rows:
        yield row_batch(rows)


def settle(items: Iterator, n: int) -> Iterator[pa.RecordBatch]:
    """Rows of a task: batches pass, and places that need no further comparison (documents, places, if a place needs it a number each
    or else None, and the names of the documents) are gathered and dealt to ``n`` document groups."""
    held, size = [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        docs, names = join_names([h[0] for h in held], [h[3] for h in held])
        places = np.concatenate([h[1] for h in held])
        keys = None if held[0][2] is None else np.concatenate([h[2] for h in held])
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order]
        yield from by_part(group_of(names, n)[docs], DECIDED, docs, places, None if keys is None else keys[order], names)

    for item in items:
        if isinstance(item, pa.RecordBatch):
            yield item
        elif len(item[0]):
            used, at = np.unique(item[0], return_inverse=True)
            held.append((at, *item[1:3], tuple(x[used] for x in item[3])))
            size += len(item[0])
            if size >= SETTLED:
                yield from rows()
                held, size = [], 0
    if held:
        yield from rows()


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows of a task gathered by (part, kind); the rows come sorted by both."""
    now: tuple[int, int] | None = None
    held: list[bytes] = []
    for batch in batches:
        for part, kind, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (part, kind) != now:
                if now is not None:
                    yield now[0], now[1], held
                now, held = (part, kind), []
            held.append(raw)
    if now is not None:
        yield now[0], now[1], held


def gather(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, Names]:
    got = [unpack_named(r) for r in raws]
    keys = None if got[0][2] is None else np.concatenate([g[2] for g in got])
    docs, names = join_names([g[0] for g in got], [g[3] for g in got])
    return docs, np.concatenate([g[1] for g in got]), keys, names


def _nothing() -> Iterator:
    return iter(())


def compare_rows(emitted: DataFrame, judge: Callable, n: int, last: Callable = _nothing) -> DataFrame:
    """Deal emitted rows out by bucket and let ``judge(payloads)`` give the places it decides on, or rows to be dealt
    out again (see :func:`settle`), and ``last()`` what is left behind a task's buckets; rows already decided pass through.  Result: rows by
    document group."""

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator:
        for part, kind, raws in parts(batches):
            if kind == DECIDED:
                yield row_batch([(part, DECIDED, r) for r in raws])
            else:
                yield from judge(raws)
        yield from last()

    dealt = emitted.repartition("part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(lambda batches: settle(items(batches), n), PLACES)


def compare(emitted: DataFrame, judge: Callable, n: int) -> DataFrame:
    """:func:`compare_rows` of packed places: ``judge(docs, places, keys)`` returns the documents and places it decides on."""

    def rows(raws: list[bytes]) -> Iterator:
        *found, names = gather(raws)
        yield *judge(*found), None, names

    return compare_rows(emitted, rows, n)


def per_document(places: DataFrame, merge: Callable) -> DataFrame:
    """All decided places of a document group together; ``merge(docs, places, keys)`` gives (ids, starts, ends)
    of spans with documents ascending.  Result: one row per document, ``key``, ``twin`` and
    ``spans`` (pairs of little-endian 64-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, raws in parts(batches):
            docs, at, keys, names = gather(raws)
            order = np.lexsort((at, docs))
            ids, starts, ends = merge(docs[order], at[order], None if keys is None else keys[order])
            turn = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
            pairs = np.stack([starts, ends], axis=1).astype("<i8")
            edges = np.append(turn, len(ids))
            spans = [pairs[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[ids[turn]], pa.int64()) for x in names), pa.array(spans, pa.binary())], names=["key", "twin", "spans"])

    dealt = places.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "key long, twin long, spans binary")


def merge_fixed(length: int) -> Callable:
    """Merge of windows of one length into maximal spans."""

    def merge(docs: np.ndarray, starts: np.ndarray, _: None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + length)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(docs)) - 1
        return docs[first], starts[first], starts[last] + length

    return merge


def merge_spans(docs: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge of spans, whose ends are the keys, into maximal ones."""
    ends = keys.astype(np.int64)
    if not len(docs):
        return docs, starts, ends
    turn = np.concatenate(([True], docs[1:] != docs[:-1]))
    shift = np.cumsum(turn) * (int(ends.max()) + 1)  # documents one behind the other
    reach = np.maximum.accumulate(ends + shift)
    new = turn.copy()
    new[1:] |= (starts + shift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(docs)) - 1
    return docs[first], starts[first], (reach - shift)[last]


def named(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, twin, raw``: id and text hash, which name the row, and the bytes of its text."""
    raw = F.col(text_col).cast("binary")
    return df.select(doc_key(id_col).alias("key"), F.xxhash64(raw).alias("twin"), raw.alias("raw"))


def pack_texts(source: DataFrame) -> DataFrame:
    """:func:`named` rows with the bytes compressed (``key, twin, packed``), for a join that shuffles texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = (None if not x.is_valid else tool.compress(x.as_buffer()) for x in b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["key", "twin", "packed"])

    return source.mapInArrow(run, "key long, twin long, packed binary")


def unpack_text(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)
