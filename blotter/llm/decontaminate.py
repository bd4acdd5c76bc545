"""Benchmark decontamination with spaced seeds.

Fixed masks select some of the words of a window and ignore the others, so a
window still hashes to the same seed when words at ignored positions were
replaced.  Seed hashes of the benchmark are joined with those of every document
position; around each hit the two texts are compared word by word on the same
diagonal, which decides.

The masks below are lossless for the default: whichever two words of a 13-word window
are replaced, some placement of the first two masks avoids both (checked in the tests).
Items shorter than the window, and windows of other sizes, have masks made for their
number of words and of replaced words (see :func:`masks_for`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as tx

#: Word positions each mask of a 13-word window looks at.
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 4, 7, 8, 10), (0, 1, 2, 3, 4, 5))
#: Items of fewer words are found where all their words are equal.
LEAST_WORDS = 6
#: Text of the benchmark compared in one pass over the documents; a larger benchmark takes several passes.
BLOCK_BYTES = 8 << 20
#: Compared texts: ASCII letters and digits in lower case and all bytes from 0x80 on; everything else separates words.
_FOLD = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if _c >= 0x80 or chr(_c).isalnum():
        _FOLD[_c] = ord(chr(_c).lower()) if _c < 0x80 else _c
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def least_equal(size: int, similarity: float) -> int:
    """Words of ``size`` that have to be equal."""
    return size if size < LEAST_WORDS else max(1, math.ceil(similarity * size - 1e-9))


def masks_for(size: int, replaced: int) -> list[tuple[int, ...]]:
    """Masks over ``size`` words of which one at least sees none of any ``replaced`` words: the words are cut into two groups
    more than that (as far as there are words), and a mask leaves out ``replaced`` of the groups."""
    groups = min(size, replaced + 2)
    cuts = [size * k // groups for k in range(groups + 1)]
    return [tuple(at for k in range(groups) if k not in out for at in range(cuts[k], cuts[k + 1])) for out in combinations(range(groups), replaced)]


def seed_hashes(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Seed of every place of a sequence of word hashes where the mask fits."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for at in mask:
        out = out * _MUL + hashes[at:at + n]
    return tx.mix(out)


class Index:
    """Seeds of a block of benchmark items: per mask the sorted hashes with item and position, and a bit table
    that most document seeds fail."""

    def __init__(self, texts: list[str], window: int = 13, similarity: float = 0.8):
        data, offsets = tx.string_buffers(pa.array(texts, pa.string()))
        data = _FOLD[data]
        starts, ends, bounds = tx.words(data, offsets)
        self.hashes, self.bounds = tx.word_hashes(data, starts, ends), bounds
        self.seeds = []
        for mask, places in self._places(np.diff(bounds), window, similarity).items():
            item, place = (np.concatenate(x) for x in zip(*places))
            seed = np.zeros(len(item), np.uint64)
            for at in mask:
                seed = seed * _MUL + self.hashes[bounds[item] + place + at]
            seed = tx.mix(seed)
            order = np.argsort(seed, kind="stable")
            shift = np.uint64(64 - min(_BITS, max(10, len(seed).bit_length() + 4)))
            table = np.zeros(1 << (64 - int(shift)), bool)
            table[seed >> shift] = True
            self.seeds.append((mask, shift, table, seed[order], item[order], place[order]))

    @staticmethod
    def _places(sizes: np.ndarray, window: int, similarity: float) -> dict[tuple[int, ...], list[tuple[np.ndarray, np.ndarray]]]:
        """Per mask (from position 0 on) the items and the places in them where it is laid: once on a whole item that is shorter
        than the window, on every place of the others."""
        out: dict[tuple[int, ...], list[tuple[np.ndarray, np.ndarray]]] = {}
        for size in np.unique(np.minimum(sizes, window)).tolist():
            if size == 0:
                continue
            replaced = size - least_equal(size, similarity)
            masks = MASKS if size == 13 == window and replaced <= 2 else masks_for(size, replaced)
            items = np.flatnonzero(np.minimum(sizes, window) == size)
            for mask in masks:
                shape = tuple(at - mask[0] for at in mask)
                if size < window:
                    found = items, np.full(len(items), mask[0])
                elif any(m != mask and tuple(at - m[0] for at in m) == shape for m in masks[:masks.index(mask)]):
                    continue  # laid on every place already
                else:
                    many = sizes[items] - shape[-1]
                    found = np.repeat(items, many), np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                out.setdefault(shape, []).append(found)
        return out

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (document, item, diagonal) with a common seed."""
        found = [np.zeros((0, 3), np.int64)]
        for mask, bits, table, seeds, items, places in self.seeds:
            mine = seed_hashes(hashes, mask)
            at = np.flatnonzero(table[mine >> bits])
            low, high = np.searchsorted(seeds, mine[at], "left"), np.searchsorted(seeds, mine[at], "right")
            sizes = high - low
            at, low, sizes = at[sizes > 0], low[sizes > 0], sizes[sizes > 0]
            doc = np.searchsorted(bounds, at, "right") - 1
            inside = at + mask[-1] < bounds[doc + 1]
            at, low, sizes, doc = at[inside], low[inside], sizes[inside], doc[inside]
            entry = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            doc = np.repeat(doc, sizes)
            found.append(np.stack([doc, items[entry], np.repeat(at, sizes) - bounds[doc] - places[entry]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def overlap(self, words: np.ndarray, item: int, shift: int, window: int, similarity: float) -> tuple[int, int]:
        """(words covered, words equal) on a diagonal: the union of the windows that are similar enough."""
        own = self.hashes[self.bounds[item]:self.bounds[item + 1]]
        size = min(window, len(own))
        low, high = max(0, -shift), min(len(own), len(words) - shift)
        if high - low < size:
            return 0, 0
        same = words[low + shift:high + shift] == own[low:high]
        total = np.concatenate(([0], np.cumsum(same)))
        good = np.flatnonzero(total[size:] - total[:-size] >= least_equal(size, similarity))
        if len(good) == 0:
            return 0, 0
        covered = np.zeros(len(same) + 1, np.int64)
        np.add.at(covered, good, 1)
        np.add.at(covered, good + size, -1)
        covered = np.cumsum(covered)[:-1] > 0
        return int(covered.sum()), int(same[covered].sum())


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[str]]]:
    """The benchmark in blocks of at most ``BLOCK_BYTES`` of text (or one longer item), read partition by partition."""
    ids, texts, size = [], [], 0
    for row in benchmark.toLocalIterator():
        if texts and size + 4 * len(row.text) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        size += 4 * len(row.text)
    if texts:
        yield ids, texts


def _twin(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("binary"))


def _overlaps(df: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8, id_col: str = "doc_id",
              text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """:func:`find_overlaps` with ``twin``, the hash of the text that names a row together with its id."""
    spark = df.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).dropna(subset=["text"]).distinct()
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), _twin(text_col).alias("twin"), F.col(text_col).cast("binary").alias("raw"))
    schema = "doc_id long, twin long, item_id long, n_overlap long, n_equal long"
    out = spark.createDataFrame([], schema)

    def against(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value[1], window, similarity)
            for batch in batches:
                ids, twins, rows = batch.column(0), batch.column(1), []
                for i, _, data, offsets in tx.text_chunks(batch.column(2)):
                    data = _FOLD[data]
                    starts, ends, bounds = tx.words(data, offsets)
                    hashes = tx.word_hashes(data, starts, ends)
                    for doc, item, shift in index.hits(hashes, bounds).tolist():
                        covered, equal = index.overlap(hashes[bounds[doc]:bounds[doc + 1]], item, shift, window, similarity)
                        if covered:
                            rows.append((ids[i + doc].as_py(), twins[i + doc].as_py(), shared.value[0][item], covered, equal))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "twin", "item_id", "n_overlap", "n_equal"])

        return run

    for ids, texts in _blocks(items):
        shared = spark.sparkContext.broadcast((ids, texts))  # at most BLOCK_BYTES of text
        out = out.union(docs.mapInArrow(against(shared), schema))
    best = F.max(F.struct("n_equal", F.negative("n_overlap").alias("less"))).alias("best")
    return out.groupBy("doc_id", "twin", "item_id").agg(best).select(
        "doc_id", "twin", "item_id", F.negative("best.less").alias("n_overlap"), F.col("best.n_equal").alias("n_equal"))


def find_overlaps(df: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_overlap, n_equal``: every document and benchmark item that share ``window`` words in a row (the whole
    item if it is shorter) of which ``similarity`` are equal, words replaced one for one.

    Case of ASCII letters and punctuation don't count.  ``n_overlap`` words are covered on the best diagonal, ``n_equal`` of them
    are equal.  Items of fewer than ``LEAST_WORDS`` words are found where all their words are equal.  Null and empty texts and
    items without words have no overlap; null ids are carried along; repeated rows of either table give one row (their ids and
    texts are the same), documents that share an id, or have none, but differ in text a row each; other columns are ignored."""
    return _overlaps(df, benchmark, window, similarity, id_col, text_col, item_col, item_text_col).drop("twin")


def clean_documents(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that share no passage with the benchmark, each judged by its own text: a row is named by its id and
    the hash of its text, since an id may be null or shared."""
    found = _overlaps(df, benchmark, id_col=id_col, text_col=text_col, **options).select(
        F.col("doc_id").alias("_leaked"), F.col("twin").alias("_leaked_twin")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_leaked")) & (_twin(text_col) == F.col("_leaked_twin"))
    return df.join(found, same, "left_anti")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Passages of 13 words, 80 % of them equal, of the whole ``benchmark`` in the whole ``documents`` table."""
    return find_overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
