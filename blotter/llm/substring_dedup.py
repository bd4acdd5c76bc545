"""Removal of repeated word passages (exact, by fixed-length word windows).

Method: Rabin-Karp hashes of every window of ``window`` consecutive words,
dealt out by a second, independent hash and counted in Spark; every repeated
window but the earliest is marked, and marked windows merge into maximal
intervals of words that are removed.

Keys have 64 bits plus the bits of the bucket (from the second hash family),
so equal keys of different windows are expected less than once in a corpus of
10**11 words; windows are not compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _exchange as ex
from . import _text as tx

#: Windows a task holds before it sends them.
HELD = 1 << 19
#: Rows unpacked at once.
ROWS = 1000


def _first_seen(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the keys and, along it, the index of the first entry of each group."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return order, np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))


def _emit(window: int, n: int):
    def flush(held: list[tuple[np.ndarray, ...]], rows: list[ex.Names]) -> Iterator:
        ranks, names = ex.number(*(np.concatenate(x) for x in zip(*rows)))
        docs, starts, keys, seconds = (np.concatenate(x) for x in zip(*held))
        docs = ranks[docs]
        order = np.lexsort((starts, docs)) if (docs[1:] < docs[:-1]).any() else np.arange(len(docs))
        docs, starts, keys, seconds = docs[order], starts[order], keys[order], seconds[order]
        order, head = _first_seen(keys)
        first = order[head]
        later = (docs[order] != docs[first]) | (starts[order] != starts[first])
        yield docs[order[later]], starts[order[later]], None, names
        send = np.sort(order[head == np.arange(len(order))])
        yield from ex.by_part((seconds[send] % np.uint64(n)).astype(np.int64), ex.KEYS, docs[send], starts[send], keys[send], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator:
        held, rows, size, n_rows = [], [], 0, 0
        for batch in batches:
            ids, twins = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for i, j, data, offsets in tx.text_chunks(batch.column(2)):
                begin, end, bounds = tx.words(data, offsets)
                first, doc, start = tx.window_index(bounds, window)
                if len(first) == 0:
                    continue
                hashes = tx.word_hashes(data, begin, end)
                keys = tx.window_hashes(hashes, first, window, 0)
                held.append((doc + n_rows, start, keys, tx.window_hashes(hashes, first, window, 1)))
                rows.append((ids[i:j], twins[i:j]))
                n_rows += j - i
                size += len(first)
                if size >= HELD:
                    yield from flush(held, rows)
                    held, rows, size, n_rows = [], [], 0, 0
        if held:
            yield from flush(held, rows)

    return lambda batches: ex.settle(run(batches), n)


def _later(docs: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a bucket that are not the earliest of their key."""
    order = np.argsort(keys)
    k = keys[order]
    same = k[1:] == k[:-1]
    many = np.zeros(len(k), bool)
    many[1:] |= same
    many[:-1] |= same
    sel = order[many]
    docs, starts, keys = docs[sel], starts[sel], keys[sel]
    order = np.lexsort((starts, docs, keys))
    docs, starts, keys = docs[order], starts[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    later = (docs != docs[head]) | (starts != starts[head])
    return docs[later], starts[later]


def repeated_spans(df: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, twin, spans``: per document the maximal intervals of words covered by a repeated window
    that is not the earliest of its kind (documents without one are absent)."""
    source = ex.named(df, id_col, text_col)
    n = ex.n_buckets(source)
    emitted = source.mapInArrow(_emit(window, n), ex.PLACES)
    return ex.per_document(ex.compare(emitted, _later, n), ex.merge_fixed(window))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        total, gone, kept = [], [], []
        for packed, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            found = ex.unpack_text(packed).split() if packed is not None else []
            total.append(len(found))
            rest, at = found, 0
            if spans is not None:
                rest = []
                for a, b in np.frombuffer(spans, "<i8").reshape(-1, 2).tolist():
                    rest += found[at:a]
                    at = b
                rest += found[at:]
            gone.append(len(found) - len(rest))
            kept.append(b" ".join(rest))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()), batch.column(2)],
            names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def dedup_substrings(df: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts earlier.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Earlier means a smaller document id, then
    a smaller ``xxhash64`` of the text, then an earlier start; windows are judged on the input.  Result per input row:
    ``doc_id, n_words, n_removed, kept`` (kept words joined by one space) and ``spans`` (removed
    intervals of words, pairs of little-endian 64-bit integers, null if none).

    Null text has no words; a null id orders before all others and stays null in the result; texts
    under ``window`` words lose nothing.  Repeated rows (same id and text) are the same document: they
    don't remove each other and get the same result; rows that share an id, or have none, but differ in text
    are different documents.  Other columns are ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(df, window, id_col, text_col)
    texts = ex.pack_texts(ex.named(df, id_col, text_col))
    joined = texts.join(spans, ["key", "twin"], "left").select("key", "packed", "spans")
    out = joined.mapInArrow(_apply, "doc_id long, n_words long, n_removed long, kept binary, spans binary")
    return out.withColumns({"doc_id": F.nullif("doc_id", F.lit(tx.NULL_ID)), "kept": F.col("kept").cast("string")})


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 20 words over the whole ``documents`` table."""
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
