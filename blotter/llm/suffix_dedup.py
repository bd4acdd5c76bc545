"""Removal of repeated byte strings, by a hash-compared suffix sort.

A byte is removed if a string of ``width`` bytes that covers it also starts anywhere else.

Comparing suffixes.  Prefix polynomial hashes give the hash of any range in constant time, so a binary
search finds the common extension of two suffixes in a logarithmic number of steps.  The sort is a mergesort:
suffixes that agree so far form a run; the common extension of a run is found by hash, the run is sorted by
the eight bytes behind it, and runs that still agree go on.  A run whose common extension reaches ``width`` bytes
is a set of equal strings; its members are compared byte for byte (collision verification), and if a hash was
wrong the bucket is sorted again with the other hash family.

Cutting the sort.  Equal strings of ``width`` bytes have the same lowest-hashing ``GRAM``-byte substring (their
anchor) at the same place.  Tasks send one 64-bit key per run of strings with a common anchor; only runs whose anchor
occurs twice send their text, dealt out by anchor, to the task that sorts their suffixes.  Runs with equal texts
are sorted once.  An anchor with very many different texts around it is dealt out again by longer parts of its strings,
and a part that still has many different texts (the edge of a popular passage, with private bytes beside it) string by string: then
equal texts are equal strings, which collapse to one, however many there are.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _exchange as ex
from . import _text as tx

WIDTH, GRAM = 200, 50
#: Bytes of a longer document handled at once, and bytes of text a task holds before it sends it.
SLICE, HELD = 1 << 20, 2 << 20
#: Bytes of text that a task gathers before it deals them out again.
AGAIN = 16 << 20
#: Rows unpacked at once.
ROWS = 1000
#: Runs a task holds before it sends their keys.
RUNS = 1 << 18
#: Suffixes sorted at once.
SUFFIXES = 1 << 18
#: Different texts around an anchor beyond which they are dealt out again, first in parts of this many strings, then string by string.
CROWD, PART = 4096, 8
_AT = np.uint64((1 << 24) - 1)


def runs(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same anchor: document, first start, number of strings, bytes from the first start to the
    anchor, hash of the anchor."""
    first, doc, within = tx.window_index(offsets, width)
    if len(first) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    prefix = tx.byte_prefix(data)
    starts = np.arange(len(data) - gram + 1)
    hashes = tx.mix(tx.range_hash(prefix, starts, starts + gram))
    span = width - gram + 1
    low = np.full(-(-len(hashes) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    low[:len(hashes)] = (hashes & ~_AT) | starts.astype(np.uint64)
    blocks = low.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(behind[first], ahead[first + span - 1]) & _AT).astype(np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(new)
    return doc[begin], within[begin], np.diff(np.append(begin, len(first))), anchor[begin] - first[begin], hashes[anchor[begin]]


def pieces(arr: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place in the row's text, bytes, offsets) of chunks; a long text is cut into slices that overlap by ``width - 1`` bytes."""
    for i, j, data, offsets in tx.text_chunks(arr):
        if len(data) <= SLICE:
            yield np.arange(i, j), np.zeros(j - i, np.int64), data, offsets
        else:
            for at in range(0, max(1, len(data) - width + 1), SLICE):
                part = data[at:at + SLICE + width - 1]
                yield np.array([i]), np.array([at]), part, np.array([0, len(part)])


def _emit_keys(width: int, gram: int, n: int) -> Callable:
    """Keys of all runs; keys that a batch has twice are decided at once and sent once."""

    def flush(held: list[tuple[np.ndarray, ...]], rows: list[ex.Names]) -> Iterator:
        ranks, names = ex.number(*(np.concatenate(x) for x in zip(*rows)))
        docs, starts, keys = (np.concatenate(x) for x in zip(*held))
        docs = ranks[docs]
        order = np.lexsort((starts, docs))
        docs, starts, keys = docs[order], starts[order], keys[order]
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        head = np.ones(len(k), bool)
        head[1:] = k[1:] != k[:-1]
        many = ~head
        many[:-1] |= ~head[1:]
        yield docs[order[many]], starts[order[many]], None, names
        send = np.sort(order[head])
        yield from ex.by_part((keys[send] % np.uint64(n)).astype(np.int64), ex.KEYS, docs[send], starts[send], keys[send], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator:
        held, rows, size, n_rows = [], [], 0, 0
        for batch in batches:
            ids, twins = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for row, at, data, offsets in pieces(batch.column(2), width):
                doc, start, _, _, key = runs(data, offsets, width, gram)
                held.append((doc + n_rows, start + at[doc], key))
                rows.append((ids[row], twins[row]))
                n_rows += len(row)
                size += len(key)
                if size >= RUNS:
                    yield from flush(held, rows)
                    held, rows, size, n_rows = [], [], 0, 0
        if held:
            yield from flush(held, rows)

    return lambda batches: ex.settle(run(batches), n)


def _seen_twice(docs: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    many = np.zeros(len(keys), bool)
    many[order[1:]] |= same
    many[order[:-1]] |= same
    return docs[many], starts[many]


def _as_places(docs: np.ndarray, starts: np.ndarray, _: None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return docs, starts, starts


class Segments:
    """Texts of runs: document, first start, key, bytes to the anchor, and the bytes of text i at ``begin[i]:begin[i + 1]``;
    ``names`` has the documents."""

    def __init__(self, docs: np.ndarray, starts: np.ndarray, keys: np.ndarray, lead: np.ndarray, sizes: np.ndarray, data: np.ndarray, names: ex.Names):
        self.docs, self.starts, self.keys, self.lead, self.sizes, self.data = docs, starts, keys, lead, sizes, data
        self.begin, self.names = np.cumsum(sizes) - sizes, names

    def cut(self, seg: np.ndarray, skip: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> "Segments":
        """Parts of texts ``seg``: ``sizes`` bytes from byte ``skip``."""
        return Segments(self.docs[seg], self.starts[seg] + skip, keys, self.lead[seg] - skip, sizes, _ranges(self.data, self.begin[seg] + skip, sizes), self.names)

    def take(self, sel: np.ndarray) -> "Segments":
        return self.cut(sel, np.zeros(len(sel), np.int64), self.sizes[sel], self.keys[sel])

    def pack(self) -> bytes:
        places = ex.pack_named(self.docs, self.starts, self.keys, self.names)
        text = zstandard.ZstdCompressor(level=1).compress(
            self.sizes.astype("<u4").tobytes() + self.lead.astype("<u4").tobytes() + self.data.tobytes())
        return struct.pack("<II", len(places), len(self.docs)) + places + text

    @staticmethod
    def unpack(raws: list[bytes]) -> "Segments":
        docs, names, columns = [], [], []
        for raw in raws:
            size, n = struct.unpack_from("<II", raw)
            text = zstandard.ZstdDecompressor().decompress(raw[8 + size:])
            own, *places, known = ex.unpack_named(raw[8:8 + size])
            docs.append(own)
            names.append(known)
            columns.append((*places, np.frombuffer(text, "<u4", n, 4 * n).astype(np.int64),
                            np.frombuffer(text, "<u4", n).astype(np.int64), np.frombuffer(text, np.uint8, -1, 8 * n)))
        numbered, table = ex.join_names(docs, names)
        return Segments(numbered, *(np.concatenate(x) for x in zip(*columns)), table)

    @staticmethod
    def join(parts: list["Segments"]) -> "Segments":
        numbered, table = ex.join_names([p.docs for p in parts], [p.names for p in parts])
        return Segments(numbered, *(np.concatenate(x) for x in zip(*((p.starts, p.keys, p.lead, p.sizes, p.data) for p in parts))), table)

    def rows(self, n: int) -> pa.RecordBatch:
        """Rows that deal the texts out by key."""
        part = (self.keys % np.uint64(n)).astype(np.int64)
        order = np.lexsort((self.starts, self.docs, part))
        cut = part[order]
        edges = np.append(np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1]))), len(cut))
        return ex.row_batch([(int(cut[a]), ex.KEYS, self.take(order[a:b]).pack()) for a, b in zip(edges[:-1], edges[1:])])

    def same_texts(self) -> tuple[np.ndarray, np.ndarray]:
        """A class number per text, the first text of each class: texts of one class are equal, byte for byte."""
        for family in (0, 1):
            prefix = tx.byte_prefix(self.data, family)
            code = tx.mix(tx.range_hash(prefix, self.begin, self.begin + self.sizes, family) + self.sizes.astype(np.uint64))
            _, first, cls = np.unique(code, return_index=True, return_inverse=True)
            other = np.flatnonzero(first[cls] != np.arange(len(cls)))
            if (self.sizes[other] == self.sizes[first[cls[other]]]).all() and _equal(
                    self.data, self.begin[first[cls[other]]], self.begin[other], self.sizes[other]):
                return cls, first
        raise RuntimeError("both hash families collide")


def _shares_of(sizes: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[slice, np.ndarray]]:
    """Ranges taken together up to ``most`` bytes (or one longer), and for every byte its place in its range."""
    total, at = np.concatenate(([0], np.cumsum(sizes))), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        size = sizes[at:stop]
        yield slice(at, stop), np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = stop


def _ranges(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one behind the other."""
    parts = [data[np.repeat(begin[share], sizes[share]) + within] for share, within in _shares_of(sizes)]
    return np.concatenate(parts) if parts else data[:0]


def _equal(data: np.ndarray, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> bool:
    """Whether all pairs of ranges are equal."""
    return all(np.array_equal(data[np.repeat(left[share], sizes[share]) + within], data[np.repeat(right[share], sizes[share]) + within])
               for share, within in _shares_of(sizes))


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian number (zeros behind the end); a view, nothing is copied per place."""
    return np.ndarray((len(data) + 1,), ">u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))


def sort_suffixes(data: np.ndarray, at: np.ndarray, width: int, family: int = 0, prefix: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that start at ``at``, compared over ``width`` bytes, and for each place of the order the number of its
    set of equal strings.  Every start has ``width`` bytes behind it."""
    prefix, eight = tx.byte_prefix(data, family) if prefix is None else prefix, _eight(data)
    unused = np.uint64(8 * max(0, 8 - width))  # bits of a first number beyond the width
    lead = eight[at].astype(np.uint64) >> unused
    order = np.argsort(lead, kind="stable")
    lead = lead[order]
    run = np.cumsum(np.concatenate(([True], lead[1:] != lead[:-1]))) - 1 if len(at) else np.zeros(0, np.int64)
    done = np.zeros(len(at), np.int64)  # set of equal strings, by place in the order
    live = np.arange(len(at))  # places of the order that are not settled, ascending
    depth = np.full(len(at), min(8, width))
    while len(live):
        # Runs of one suffix are settled.
        turn = np.concatenate(([True], run[1:] != run[:-1]))
        sizes = np.diff(np.append(np.flatnonzero(turn), len(run)))
        several = np.repeat(sizes > 1, sizes)
        live, run, depth = live[several], run[several], depth[several]
        if not len(live):
            break
        turn = np.concatenate(([True], run[1:] != run[:-1]))
        first = np.flatnonzero(turn)
        number = np.cumsum(turn) - 1
        mine, head = at[order[live]], at[order[live[first]]][number]
        # Common extension with the first suffix of the run: binary search over the range hashes.
        low, high = depth.copy(), np.full(len(live), width)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = tx.range_hash(prefix, mine, mine + mid, family) == tx.range_hash(prefix, head, head + mid, family)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        common = np.minimum.reduceat(low, first)
        equal = (common >= width)[number]
        done[live[equal]] = live[first][number][equal] + 1
        live, number, extension = live[~equal], number[~equal], common[number][~equal]
        if not len(live):
            break
        behind = eight[at[order[live]] + extension].astype(np.uint64)
        if width < 8 or (extension + 8 > width).any():  # bytes beyond the width do not count
            spare = np.maximum(extension + 8 - width, 0).astype(np.uint64) * np.uint64(8)
            behind = behind >> spare << spare
        by = np.lexsort((behind, number))
        order[live] = order[live[by]]
        behind, number, extension = behind[by], number[by], extension[by]
        run = np.cumsum(np.concatenate(([True], (number[1:] != number[:-1]) | (behind[1:] != behind[:-1])))) - 1
        depth = np.minimum(extension + 8, width)
    return order, done


def repeated_starts(data: np.ndarray, at: np.ndarray, width: int, prefix: np.ndarray | None = None) -> np.ndarray:
    """Which of the strings of ``width`` bytes at ``at`` occur more than once among them."""
    for family in (0, 1):
        order, equal = sort_suffixes(data, at, width, family, None if family else prefix)
        same = np.flatnonzero((equal[1:] > 0) & (equal[1:] == equal[:-1]))
        if _verified(data, at[order[same]], at[order[same + 1]], width):
            out = np.zeros(len(at), bool)
            out[order[equal > 0]] = True
            return out
    raise RuntimeError("both hash families collide")


def _verified(data: np.ndarray, left: np.ndarray, right: np.ndarray, width: int) -> bool:
    eight = _eight(data)
    steps = [*range(0, width - 7, 8), width - 8] if width >= 8 else []
    for lo in range(0, len(left), 1 << 16):
        a, b = left[lo:lo + (1 << 16)], right[lo:lo + (1 << 16)]
        if steps and not all(np.array_equal(eight[a + s], eight[b + s]) for s in steps):
            return False
    return bool(steps) or _equal(data, left, right, np.full(len(left), width))


def _emit_texts(width: int, gram: int, wide: int, n: int) -> Callable:
    """Texts of the runs whose start is listed; texts that a batch has twice are decided at once and sent once."""

    def flush(held: list[tuple[np.ndarray, ...]], rows: list[ex.Names]) -> Iterator:
        ranks, names = ex.number(*(np.concatenate(x) for x in zip(*rows)))
        docs, *rest = (np.concatenate(x) for x in zip(*held))
        own = yield from _collapse(Segments(ranks[docs], *rest, names))
        if len(own.docs):
            yield own.rows(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator:
        held, rows, size, n_rows = [], [], 0, 0
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, twins = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = pa.array([ex.unpack_text(x) if x is not None else b"" for x in batch.column(2).to_pylist()], pa.large_binary())
            wanted = [np.frombuffer(x, "<i8")[::2] for x in batch.column(3).to_pylist()]
            for row, at, data, offsets in pieces(texts, width):
                doc, start, strings, lead, key = runs(data, offsets, width, gram)
                listed = np.zeros(len(doc), bool)
                edges = np.searchsorted(doc, np.arange(len(row) + 1))
                for d, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    listed[a:b] = np.isin(start[a:b] + at[d], wanted[row[d]])
                doc, start, lead, key = doc[listed], start[listed], lead[listed], key[listed]
                sizes = strings[listed] + width - 1
                held.append((doc + n_rows, start + at[doc], key, lead, sizes, _ranges(data, offsets[doc] + start, sizes)))
                rows.append((ids[row], twins[row]))
                n_rows += len(row)
                size += len(held[-1][-1])
                if size >= HELD:
                    yield from flush(held, rows)
                    held, rows, size, n_rows = [], [], 0, 0
        if held:
            yield from flush(held, rows)

    return lambda batches: ex.settle(run(batches), n)


def _collapse(own: Segments):
    """Decide on texts that occur more than once (their strings all do); return one of each."""
    cls, first = own.same_texts()
    # Repeated rows are the same place: they do not make a text occur twice.
    place = np.lexsort((own.starts, own.docs, cls))
    c, d, s = cls[place], own.docs[place], own.starts[place]
    new = np.ones(len(place), bool)
    new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    twice = np.bincount(c[new], minlength=len(first))[cls] > 1
    yield own.docs[twice], own.starts[twice], (own.starts + own.sizes)[twice].astype(np.uint64), own.names
    return own.take(np.sort(first))


def _sort_bucket(width: int, n: int, most: int | None, part: int = PART) -> tuple[Callable, Callable]:
    """Decide on the strings of a task's buckets; more than ``most`` different texts around an anchor are dealt out again in
    parts of ``part`` strings (None: never), gathered over the buckets so that a target gets few rows from a task (the second
    function returned gives what is left at its end)."""

    def decide(raws: list[bytes]) -> Iterator:
        own = yield from _collapse(Segments.unpack(raws))
        _, at, around = np.unique(own.keys, return_inverse=True, return_counts=True)
        several = around[at] > 1
        crowd = np.flatnonzero(around[at] > most) if most else np.zeros(0, np.int64)
        for lo in range(0, len(crowd), CROWD):
            yield (yield from _collapse(_parts(own.take(crowd[lo:lo + CROWD]), width, part)))
        several[crowd] = False
        own = own.take(np.flatnonzero(several))
        if not len(own.docs):
            return
        strings = own.sizes - width + 1
        seg = np.repeat(np.arange(len(strings)), strings)
        within = np.arange(len(seg)) - np.repeat(np.cumsum(strings) - strings, strings)
        start = own.begin[seg] + within
        again, prefix = np.zeros(len(start), bool), tx.byte_prefix(own.data)
        for sel in _shares(own.data, start):
            again[sel] = repeated_starts(own.data, start[sel], width, prefix)
        hit = np.flatnonzero(again)
        if len(hit):
            new = np.ones(len(hit), bool)
            new[1:] = (seg[hit][1:] != seg[hit][:-1]) | (hit[1:] != hit[:-1] + 1)
            a = hit[new]
            b = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
            yield own.docs[seg[a]], own.starts[seg[a]] + within[a], (own.starts[seg[b]] + within[b] + width).astype(np.uint64), own.names

    held: list[Segments] = []  # of one task: it is unpickled for each

    def flush() -> Iterator:
        if held:
            yield Segments.join(held).rows(n)
            held.clear()

    def run(raws: list[bytes]) -> Iterator:
        for item in decide(raws):
            if not isinstance(item, Segments):
                yield item
                continue
            held.append(item)
            if sum(len(h.data) for h in held) >= AGAIN:
                yield from flush()

    return run, flush


def _shares(data: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
    """The suffixes in shares of about ``SUFFIXES`` by their first two bytes: equal strings are in one share."""
    if len(start) <= SUFFIXES:
        yield np.arange(len(start))
        return
    lead = data[start].astype(np.int64) << 8 | data[start + 1]
    total = np.cumsum(np.bincount(lead, minlength=1 << 16))
    share = (total - 1) // SUFFIXES
    for k in np.unique(share[lead]):
        yield np.flatnonzero(share[lead] == k)


def _parts(own: Segments, width: int, part: int = PART) -> Segments:
    """Texts cut into parts of at most ``part`` strings by the distance of a string to the anchor, so that equal strings fall
    into corresponding parts; a part's key is the hash of the bytes that all strings of such a part have in common."""
    far, near = own.lead, own.lead - (own.sizes - width)  # distances of the first and the last string
    low, high = near // part, far // part
    count = high - low + 1
    seg = np.repeat(np.arange(len(count)), count)
    block = high[seg] - (np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count))
    top = np.minimum(far[seg], block * part + part - 1)
    bottom = np.maximum(near[seg], block * part)
    anchor = own.begin[seg] + far[seg]
    common = anchor - block * part, anchor - block * part - part + 1 + width
    key = tx.mix(tx.range_hash(tx.byte_prefix(own.data), *common) + block.astype(np.uint64))
    return own.cut(seg, far[seg] - top, top - bottom + width, key)


def repeated_spans(df: DataFrame, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``key, twin, spans`` (maximal spans of bytes to remove) and the packed texts (``key, twin, packed``)."""
    source = ex.named(df, id_col, text_col)
    n = ex.n_buckets(source)
    wide = 2 * n  # smaller buckets where texts are sorted
    groups = max(32, n // 2)  # of documents: every pass over the texts deals its decided places out to them, a row per task and group
    keys = source.mapInArrow(_emit_keys(width, gram, n), ex.PLACES)
    listed = ex.per_document(ex.compare(keys, _seen_twice, n), _as_places)
    packed = ex.pack_texts(source)
    texts = packed.join(listed, ["key", "twin"]).select("key", "twin", "packed", "spans").mapInArrow(_emit_texts(width, gram, wide, groups), ex.PLACES)
    for most, part in ((crowd, PART), (crowd, 1), (None, 1)):
        judge, rest = _sort_bucket(width, wide, most, part)
        texts = ex.compare_rows(texts, judge, groups, rest)
    return ex.per_document(texts, ex.merge_spans), packed


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        total, gone, count, kept = [], [], [], []
        for packed, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = ex.unpack_text(packed) if packed is not None else b""
            parts, at = [], 0
            pairs = np.frombuffer(spans or b"", "<i8").reshape(-1, 2).tolist()
            for a, b in pairs:
                parts.append(raw[at:a])
                at = b
            parts.append(raw[at:])
            kept.append(b"".join(parts))
            total.append(len(raw))
            gone.append(len(raw) - len(kept[-1]))
            count.append(len(pairs))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in (total, gone, count)], pa.array(kept, pa.binary()), batch.column(2)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def dedup_bytes(df: DataFrame, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a string of ``width`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; matches stay within a document; all copies go; strings are judged on the input.  Result per input
    row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs), ``kept`` (the remaining bytes) and ``spans`` (pairs of
    little-endian 64-bit integers, null if none).  Null text is empty; a null id stays null; repeated rows (same id and text)
    are the same place and get the same result, rows that share an id, or have none, but differ in text are not; other columns are ignored; an empty table gives an empty result.
    ``gram`` (under ``width``) and ``crowd`` only decide how strings are dealt out."""
    spans, packed = repeated_spans(df, width, gram, crowd, id_col, text_col)
    joined = packed.join(spans, ["key", "twin"], "left").select("key", "packed", "spans")
    out = joined.mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(tx.NULL_ID)))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes over the whole ``documents`` table."""
    out = dedup_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
