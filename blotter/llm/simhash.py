"""SimHash near-duplicates, compared in bit-sliced form.

Fingerprint: XXH64 (seed 42) of every word shingle, one vote per bit, a bit is set
if more than half of the hashes have it.  Two fingerprints link if they differ in
at most ``radius`` bits.

Candidates: the 64 bits are cut into ``blocks`` blocks; two fingerprints within the
radius agree in at least ``blocks - radius`` whole blocks, so every choice of that
many blocks is a key, and linked fingerprints share a key.  Fingerprints of a key
meet in one task.  There the block of fingerprints is stored by bit planes, and the
distances of 64 fingerprints to a query are counted at once, one bit of the counter
a word, with carry-save adders over eight planes at a time; a block of queries is
abandoned as soon as all its counters have passed the radius.

Copies with one fingerprint are one node.  Tasks return a spanning forest of the
links they find, never all pairs; a key with many fingerprints is cut into tiles
that other tasks compare.  Components are contracted in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import _text as tx
from .components import connected_components

SEED = 42
#: Fingerprints packed into one comparison, and the largest side of a tile.
PACKED, TILE = 512, 1 << 14
#: Shingles whose bits are counted at once.
VOTES = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """Fingerprint of a text in UTF-8: A-Z in lower case, words ``[^\\x20\\x09-\\x0D]+``, space-joined
    shingles with repeats (fewer words: the whole sequence; none: zero)."""
    found = raw.lower().split()
    if not found:
        return 0
    joined, width = b" ".join(found), min(shingle, len(found))
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[width - 1:])])
    votes, total = np.zeros(64, np.int64), len(hashes) // 8
    for at in range(0, len(hashes), 8 * VOTES):
        part = np.frombuffer(hashes, np.uint8, min(8 * VOTES, len(hashes) - at), at).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, twin, fp`` per row: the id (see ``_text.doc_key``), a hash of the text and the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["key", "twin", "fp"])

    raw = F.col(text_col).cast("binary")
    return df.select(tx.doc_key(id_col).alias("key"), F.xxhash64(raw).alias("twin"), raw.alias("raw")).mapInArrow(run, "key long, twin long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit j of row k is bit k of fingerprint j."""
    lanes = -len(fps) % 64
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = np.concatenate([bits, np.zeros((lanes, 64), np.uint8)])
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bits in every lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def near(queries: np.ndarray, planes: np.ndarray, dead: np.ndarray, radius: int) -> np.ndarray:
    """Lanes (bits of queries x words) whose distance to the query is at most ``radius`` (under 8); ``dead`` has
    the lanes that need no comparison."""
    ones = np.zeros((len(queries), planes.shape[1]), np.uint64)
    twos, fours = ones, ones
    for step in range(0, 64, 8):
        x = [planes[k] ^ np.where(queries >> np.uint64(k) & np.uint64(1), _ALL, np.uint64(0))[:, None] for k in range(step, step + 8)]
        ones, t0 = _add(ones, x[0], x[1])
        ones, t1 = _add(ones, x[2], x[3])
        twos, f0 = _add(twos, t0, t1)
        ones, t0 = _add(ones, x[4], x[5])
        ones, t1 = _add(ones, x[6], x[7])
        twos, f1 = _add(twos, t0, t1)
        fours, eights = _add(fours, f0, f1)
        over, equal = eights, _ALL
        for counter, weight in ((fours, 4), (twos, 2), (ones, 1)):
            if radius & weight:
                equal = equal & counter
            else:
                over = over | (equal & counter)
                equal = equal & ~counter
        dead = dead | over
        if (dead == _ALL).all():
            break
    return ~dead


def _pairs(alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row, word = np.nonzero(alive)
    bits = np.unpackbits(alive[row, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], word[at] * 64 + bit


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of ``i`` and ``j``; ``root`` names the smallest member of each set."""
    while len(i):
        a, b = root[i], root[j]
        some = a != b
        if not some.any():
            return
        i, j, a, b = i[some], j[some], a[some], b[some]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within ``left``, or between ``left`` and ``right``."""
    nodes = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))
    root, planes = np.arange(len(nodes)), bit_planes(other)
    words = planes.shape[1]
    pad = np.zeros(words, np.uint64)
    if len(other) % 64:
        pad[-1] = _ALL << np.uint64(len(other) % 64)
    rows = max(1, min(PACKED, (1 << 17) // words))
    for at in range(0, len(left), rows):
        part = left[at:at + rows]
        dead = np.broadcast_to(pad, (len(part), words))
        if right is None:  # only lanes after the query
            place = at + np.arange(len(part))[:, None]
            word = np.arange(words)[None, :]
            upto = np.where(word < place // 64, _ALL, np.uint64(0))
            own = (np.uint64(2) << (place % 64).astype(np.uint64)) - np.uint64(1)
            dead = dead | np.where(word == place // 64, own, upto)
        i, j = _pairs(near(part, planes, dead, radius))
        _union(root, i + at, j + shift)
    tied = np.flatnonzero(root != np.arange(len(root)))
    return nodes[root[tied]], nodes[tied]


class Tables:
    """Keys of a fingerprint: the bits of every choice of whole blocks that two linked fingerprints can share."""

    def __init__(self, radius: int, blocks: int):
        if not 0 <= radius < min(8, blocks):
            raise ValueError("the radius must be under 8 and under the number of blocks")
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        whole = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
        self.masks = [np.uint64(sum(c)) for c in combinations(whole, blocks - radius)]

    def key(self, table: np.ndarray, fps: np.ndarray) -> np.ndarray:
        return tx.mix((fps & np.array(self.masks, np.uint64)[table]) + table.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SCHEMA = "part int, kind byte, payload binary"
#: kind of a row: fingerprints with their table, a tile (its left side's size first), a forest.
_LANES, _TILES, _FOREST = 0, 1, 2


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int8(), pa.binary()))], names=["part", "kind", "payload"])


def _deal(tables: Tables, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            table = np.repeat(np.arange(len(tables.masks)), len(fps))
            fps = np.tile(fps, len(tables.masks))
            part = (tables.key(table, fps) % np.uint64(n)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
            yield _batch([(int(part[order[a]]), _LANES, table[order[a:z]].astype(np.uint8).tobytes() + fps[order[a:z]].tobytes())
                          for a, z in zip(edges[:-1], edges[1:])])

    return run


def _meet(tables: Tables, radius: int, n: int):
    def group(raws: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([np.frombuffer(r, np.uint8, len(r) // 9) for r in raws]).astype(np.int64)
        fps = np.concatenate([np.frombuffer(r, "<u8", len(r) // 9, len(r) // 9) for r in raws])
        key = tables.key(table, fps)
        order = np.argsort(key, kind="stable")
        key, fps = key[order], fps[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(first, len(key)))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        packed: list[np.ndarray] = []
        held = 0
        for a, m in zip(first[sizes > 1], sizes[sizes > 1]):
            lanes = fps[a:a + m]
            if m > TILE:
                parts = [lanes[i:i + TILE] for i in range(0, m, TILE)]
                for i, left in enumerate(parts):
                    for right in parts[i:]:
                        sides = left.tobytes() + (b"" if right is left else right.tobytes())
                        yield _batch([(int(tx.mix(right[:1] + left[:1])[0] % np.uint64(n)), _TILES, len(left).to_bytes(8, "little") + sides)])
            elif m > PACKED:
                found.append(forest(lanes, None, radius))
            else:
                if held + m > PACKED:
                    found.append(forest(np.concatenate(packed), None, radius))
                    packed, held = [], 0
                packed.append(lanes)
                held += m
        if packed:
            found.append(forest(np.concatenate(packed), None, radius))
        u, v = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64) for i in (0, 1))
        if len(u):
            yield _batch([(int(u[0] % np.uint64(n)), _FOREST, u.tobytes() + v.tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raws = None, []
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if part != now and raws:
                    yield from group(raws)
                    raws = []
                now = part
                raws.append(raw)
        if raws:
            yield from group(raws)

    return run


def _compare_tiles(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if kind == _FOREST:
                    u, v = np.frombuffer(raw, "<u8").reshape(2, -1)
                else:
                    size = int.from_bytes(raw[:8], "little")
                    sides = np.frombuffer(raw, "<u8", -1, 8)
                    u, v = forest(sides[:size], sides[size:] if len(sides) > size else None, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return run


def links(fps: DataFrame, radius: int = 4, blocks: int = 6) -> DataFrame:
    """``u, v``: a forest that joins exactly the distinct fingerprints (column ``fp``) that chains of links join."""
    tables = Tables(radius, blocks)
    n = max(64, 2 * int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lanes = fps.select("fp").mapInArrow(_deal(tables, n), _SCHEMA).repartition("part").sortWithinPartitions("part")
    met = lanes.mapInArrow(_meet(tables, radius, n), _SCHEMA).repartition("part")
    return met.mapInArrow(_compare_tiles(radius), "u long, v long").distinct()


def _rooted(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``fp, least, root`` of distinct fingerprints (``fp, least``): the root names the component."""
    roots = connected_components(links(nodes, radius, blocks)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def representatives(df: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, twin``: of each component (see :func:`near_duplicates`) the row with the smallest id (null first) and, among rows of
    that id, the smallest hash of the text (``xxhash64`` of its bytes)."""
    prints = fingerprints(df, shingle, id_col, text_col)
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min(F.struct("key", "twin")).alias("least")))
    return _rooted(nodes, radius, blocks).groupBy("root").agg(F.min("least").alias("first")).select("first.key", "first.twin")


def near_duplicates(df: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per input row.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the smallest id reachable over links (fingerprints
    that differ in at most ``radius`` bits), the row's own included.  Null and empty texts and texts without words have
    fingerprint zero, which links like any other.  A null id orders before all others and stays null.  Repeated rows
    each get their row; other columns are ignored; an empty table gives an empty result."""
    prints = cut_lineage(fingerprints(df, shingle, id_col, text_col).drop("twin"))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("key").alias("least")))
    named = _rooted(nodes, radius, blocks)
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    of = named.join(least, "root").select("fp", "component")
    out = prints.join(of, "fp")
    null = F.lit(tx.NULL_ID)
    return out.select(F.nullif("key", null).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.nullif("component", null).alias("component_id"))


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """4-word shingles, at most 4 differing bits, over the whole ``documents`` table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
