"""Source divergence audit: how far the word use of a language's sources lies apart, from run-length columns.

Terms are counted once per (language, source, term).  A language keeps the terms that enough of its documents hold.  The kept
vocabulary is put in an order that brings equal counts together (by total, then by a hash of all sources' counts, then, inside a
block, by the counts of one source after the other) and is cut into blocks of bounded size.  In a block, a source is a
column of counts in that order, kept as runs of equal counts.  A count gives a source's share of a term; for two columns the
run boundaries are intersected, and the difference of shares counts once per run, times the run's length.  Sums over blocks
are the distances of sources; the runs of a source against those of its language give the terms it uses more.

The columns are a table in the shared checkpoint folder.  Sources are dealt into tiles, so a task holds the columns of at most
two tiles of one block, and a source's missing terms are a single run of zeros.  All arithmetic is in whole numbers.
"""

from __future__ import annotations

import functools
import heapq
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dims import broadcast_checked
from ..session import ensure_checkpoint_dir

#: Documents of a language that must hold a term.
LEAST_DOCUMENTS = 30
#: Shares are in units of one in this, after this many extra occurrences of every term.
UNIT, EXTRA = 1_000_000_000, 5
#: Listed terms per source.
TOP = 50
#: Counted (group, term) entries, or bytes of documents' different terms, after which a worker hands its counts on.
KEPT, KEPT_BYTES = 1 << 18, 1 << 26
#: (Source, term) entries and term bytes of a block.
BLOCK, BLOCK_BYTES = 1 << 18, 1 << 25
#: Sources per tile.
TILE = 128
#: Bytes of text searched at once.
SLICE = 1 << 20

# After A-Z became a-z, a term is a run of letters and of bytes of characters beyond ASCII.
_TERMS = re.compile(rb"[a-z\x80-\xff]+").findall
_BREAK = re.compile(rb"[^a-z\x80-\xff]").search


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice (a slice ends between two terms)."""
    at = 0
    while len(text) - at > SLICE:
        found = _BREAK(text, at + SLICE)
        end = found.start() if found else len(text)
        yield _TERMS(text, at, end)
        at = end
    yield _TERMS(text, at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` (bytes): occurrences and documents of a term in a group, and a row with an empty term
    for every group."""
    seen: dict = defaultdict(lambda: (Counter(), Counter()))
    size = held = 0

    def rows() -> pa.RecordBatch:
        out: list[tuple] = []
        for (lang, source), (n, docs) in seen.items():
            out.append((lang, source, b"", 0, 0))
            out.extend([(lang, source, t, k, docs[t]) for t, k in n.items()])
        seen.clear()
        columns = zip(zip(*out), [pa.binary()] * 3 + [pa.int64()] * 2)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            n, docs = seen[lang, source]
            size -= len(n)
            words: set[bytes] = set()
            for found in terms(text.as_py().lower()):
                n.update(found)
                words.update(found)
            docs.update(words)
            size += len(n)
            held += sum(map(len, words))
            if size >= KEPT or held >= KEPT_BYTES:
                yield rows()
                size = held = 0
    if seen:
        yield rows()


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs`` (the first three as bytes) per group and term; an empty term for every group."""
    raw = lambda c: F.coalesce(F.col(f"`{c}`").cast("string").cast("binary"), F.lit(b""))
    found = df.select(raw(lang_col).alias("lang"), raw(source_col).alias("source"), raw(text_col).alias("text")).mapInArrow(
        _count, "lang binary, source binary, term binary, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def runs(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run starts and the value of each run."""
    if not len(dense):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], dense[1:] != dense[:-1]]))
    return starts.astype(np.int32), dense[starts]


class Block:
    """Some terms of one language with their counts by source."""

    def __init__(self, lang: bytes):
        self.lang = lang
        self.terms: list[bytes] = []
        self.total: list[int] = []
        self.places: dict[bytes, list[int]] = defaultdict(list)
        self.counts: dict[bytes, list[int]] = defaultdict(list)
        self.size = self.bytes = 0

    def rows(self, ident: int) -> Iterator[tuple]:
        """One row per source with its column, and one without source: the language's column and the terms themselves."""
        n = len(self.terms)
        total = np.array(self.total, np.int64)
        often = sorted(self.places, key=lambda s: (-len(self.places[s]), s))
        keys = [self._dense(s) for s in often[:32]]
        order = np.lexsort([*keys[::-1], total])
        new = np.empty(n, np.int64)
        new[order] = np.arange(n)
        starts, values = runs(total[order])
        yield self.lang, ident, None, n, int(total.sum()), starts.tobytes(), values.tobytes(), [self.terms[i] for i in order.tolist()]
        for s in often:
            starts, values = runs(self._dense(s)[order])
            yield self.lang, ident, s, n, sum(self.counts[s]), starts.tobytes(), values.tobytes(), None

    def _dense(self, source: bytes) -> np.ndarray:
        out = np.zeros(len(self.terms), np.int64)
        out[self.places[source]] = self.counts[source]
        return out


_COLUMNS = pa.schema([("lang", pa.binary()), ("block", pa.int64()), ("source", pa.binary()), ("size", pa.int32()), ("n", pa.int64()),
                      ("starts", pa.binary()), ("counts", pa.binary()), ("terms", pa.list_(pa.binary()))])
COLUMNS = "lang binary, block long, source binary, size int, n long, starts binary, counts binary, terms array<binary>"


def _columns(batches: Iterator[pa.RecordBatch], most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Run-length columns of the blocks of a partition, whose rows come in vocabulary order; a block has about ``most`` entries."""
    task, made, block, last = TaskContext.get().partitionId(), 0, None, None

    def put(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        some = []
        for row in rows:
            some.append(row)
            if len(some) == TILE:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), _COLUMNS)], schema=_COLUMNS)
                some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), _COLUMNS)], schema=_COLUMNS)

    for batch in batches:
        for lang, term, total, source, n in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if (lang, term) != last:
                if block is not None and (lang != block.lang or block.size >= most or block.bytes >= BLOCK_BYTES):
                    yield from put(block.rows(task << 32 | made))
                    block, made = None, made + 1
                block = block or Block(lang)
                block.terms.append(term)
                block.total.append(total)
                block.bytes += len(term)
                last = lang, term
            block.places[source].append(len(block.terms) - 1)
            block.counts[source].append(n)
            block.size += 1
    if block is not None:
        yield from put(block.rows(task << 32 | made))


def run_length_columns(counted: DataFrame, least: int = LEAST_DOCUMENTS, most: int = BLOCK) -> DataFrame:
    """:data:`COLUMNS` of the kept terms; without ``source``: the language's own column, with the block's terms in order."""
    vocabulary = (counted.filter(F.octet_length("term") > 0).groupBy("lang", "term")
                  .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("source", "n")).alias("alike"))
                  .filter(F.col("docs") >= least).select("lang", "term", "total", "alike"))
    order = ["lang", "total", "alike", "term"]
    return (counted.join(vocabulary, ["lang", "term"]).repartitionByRange(*order).sortWithinPartitions(*order, "source")
            .select("lang", "term", "total", "source", "n").mapInArrow(functools.partial(_columns, most=most), COLUMNS))


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(UNIT * (count + EXTRA) / (n + EXTRA * v)) of every count, exactly."""
    different, where = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (c + EXTRA) // (n + EXTRA * v) for c in different.tolist()], np.int64)[where]


class Column:
    """A source's runs in a block, with the share of a term in each."""

    __slots__ = ("counts", "shares", "starts")

    def __init__(self, starts: bytes | None, counts: bytes | None, size: int, n: int, v: int):
        if starts is None:  # no term of the block: one run of zeros
            self.starts, self.counts = runs(np.zeros(min(size, 1), np.int64))
        else:
            self.starts, self.counts = np.frombuffer(starts, np.int32), np.frombuffer(counts, np.int64)
        self.shares = shares(self.counts, n, v)


def intersected(a: Column, b: Column, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the runs in which both columns are constant, and the run of either."""
    starts = np.union1d(a.starts, b.starts)
    return (np.diff(np.append(starts, size)), np.searchsorted(a.starts, starts, "right") - 1,
            np.searchsorted(b.starts, starts, "right") - 1)


def distance(a: Column, b: Column, size: int) -> int:
    """Sum of the differences of shares over all terms of the block."""
    lengths, i, j = intersected(a, b, size)
    return int((np.abs(a.shares[i] - b.shares[j]) * lengths).sum())


def most_used(own: Column, whole: Column, words: list[bytes], top: int) -> list[tuple[int, bytes]]:
    """The block's ``top`` terms by how much the source's share is above the language's."""
    lengths, i, j = intersected(own, whole, len(words))
    above = np.where(own.counts[i] > 0, own.shares[i] - whole.shares[j], 0)
    order = np.argsort(-above, kind="stable")
    order = order[above[order] > 0]
    if not len(order):
        return []
    enough = int(np.searchsorted(np.cumsum(lengths[order]), top))
    least = above[order[min(enough, len(order) - 1)]]
    begins = np.cumsum(lengths) - lengths
    found = [(int(above[r]), words[t]) for r in order if above[r] >= least for t in range(begins[r], begins[r] + lengths[r])]
    return heapq.nsmallest(top, found, key=lambda x: (-x[0], x[1]))


def _measure(top: int):
    """Partial sums of a block and two tiles: ``lang, source, part, item, value``."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lang, size, same = rows[0]["lang"], rows[0]["size"], rows[0]["low"] == rows[0]["high"]
        columns = {r["source"]: (Column(r["starts"], r["counts"], size, r["total"], r["v"]), r["tile"]) for r in rows}
        words = next((r["terms"] for r in rows if r["source"] is None), None) or []
        names = sorted(s for s in columns if s is not None)
        out = []
        for at, a in enumerate(names):
            for b in names[at + 1:]:
                if same or columns[a][1] != columns[b][1]:
                    out.append((lang, a, "pair", b, distance(columns[a][0], columns[b][0], size)))
            if same and words:
                out += [(lang, a, "term", t, f) for f, t in most_used(columns[a][0], columns[None][0], words, top)]
        kinds = [pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int64()]
        made = zip(zip(*out), kinds) if out else [([], k) for k in kinds]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in made], names=["lang", "source", "part", "item", "value"])

    return run


def audit(df: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, tile: int = TILE, most: int = BLOCK, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) of ``df``.

    ``part`` is ``pair`` (``item``: another source of the language, ``value``: the sum of the differences of shares over all
    kept terms) or ``term`` (``item``: a term that the source has and whose share there is above the language's, ``value``: by
    how much; the first ``top``).  ``rank`` is by falling value, then by item.  Every row of ``df`` is a document, repeated or
    not; null text, language and source are empty; a language without kept terms has pairs of value 0; an empty table gives no rows.
    Other columns, whatever their names, are not read."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/divergence-{uuid.uuid4().hex}"
    term_counts(df, text_col, lang_col, source_col).write.parquet(f"{folder}/counted")
    counted = spark.read.parquet(f"{folder}/counted")
    run_length_columns(counted, least, most).write.parquet(f"{folder}/columns")
    columns = spark.read.parquet(f"{folder}/columns")

    whole = columns.filter(F.col("source").isNull())
    sums = columns.filter(F.col("source").isNotNull()).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.filter(F.octet_length("term") == 0).select("lang", "source")
    sizes = whole.groupBy("lang").agg(F.sum("size").cast("long").alias("v"), F.sum("n").alias("total"))
    langs = (groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
             .join(sizes, "lang", "left").fillna(0, ["v", "total"]))
    groups = (groups.join(sums, ["lang", "source"], "left").fillna(0, ["total"])
              .join(broadcast_checked(langs.select("lang", "tiles", "v")), "lang")
              .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")))

    # Every block with every source of its language (a language without kept terms: one empty block), sent to all tile pairs.
    blocks = whole.select("lang", "block", "size").unionByName(langs.filter("v = 0").select("lang", F.lit(-1).cast("long").alias("block"),
                                                                                           F.lit(0).alias("size")))
    full = (blocks.join(broadcast_checked(groups), "lang")
            .join(columns.select("lang", "block", "source", "starts", "counts"), ["lang", "block", "source"], "left")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source",
                    "size", "total", "v", "starts", "counts", F.lit(None).cast("array<binary>").alias("terms")))
    own = (whole.drop("source").join(broadcast_checked(langs), "lang").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
           .select("lang", "block", F.col("tile").alias("low"), F.col("tile").alias("high"), "tile", F.lit(None).cast("binary").alias("source"),
                   "size", "total", "v", "starts", "counts", "terms"))
    measured = full.unionByName(own).groupBy("lang", "block", "low", "high").applyInArrow(
        _measure(top), "lang binary, source binary, part string, item binary, value long")
    measured.write.parquet(f"{folder}/measured")
    measured = spark.read.parquet(f"{folder}/measured")

    once = measured.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    listed = measured.filter("part = 'term'").select("lang", "source", "item", "value").withColumn("rank", rank).filter(F.col("rank") <= top)
    both = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(listed.withColumn("part", F.lit("term")))
    text = lambda c: F.col(c).cast("string").alias(c)
    return both.select(text("lang"), text("source"), "part", text("item"), "value", F.col("rank").cast("int").alias("rank"))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table: terms in 30 documents of a language, the 50 terms each source uses more."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS MATERIALIZED (SELECT lang, source, row_no, unnest(words) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row_no) >= 30),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) //
             (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM k),
counts AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON g.lang = k.lang
           LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) //
             (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM counts),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
above AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term
          WHERE p.n > 0 AND p.p > q.q),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term' AS part, item, value FROM above)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 50
"""
