"""Quality rules: text statistics and language-model perplexity bands.

The language model is a modified Kneser-Ney character model per language, over the
characters as they are: an n-gram is packed without loss, so no two share an entry, and
the model grows with the n-grams of the corpus.  Spark counts the n-grams of every
document and derives the model with groupings and joins, a row per n-gram; nothing of it
passes through the driver.  Tasks cut the documents into blocks and name the different
n-grams of each; Spark joins these with the model, and a block meets its documents
again with the probabilities in arrays sorted by n-gram, looked up by binary search.  A
document whose perplexity lies outside the band of its language and length, on either
side, is rejected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import _text as tx

#: A symbol is a code point plus one; symbol 0 is the context before a text.  Three of them fit 63 bits.
ORDER, SYMBOLS = 3, 0x110001
#: Bytes of text per block (a longer text is a block of its own) and per packed row, characters handled at a time.
BLOCK_BYTES, ROW_BYTES, SLICE = 16 << 20, 1 << 20, 1 << 20
#: Kind of a dealt row: an n-gram of a block, or documents of a block.
_GRAM, _TEXTS = 0, 1
#: Perplexity bands: quartiles of the log-perplexity of documents of a length, widened by this many interquartile ranges.
BAND = 3.0
_SYMBOL_CHARS = b"#*$%&|<>"
_LETTERS: list[np.ndarray] = []


def _letters(s: np.ndarray) -> np.ndarray:
    """Which symbols are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((c > 0 and chr(c - 1).isalpha() for c in range(SYMBOLS)), bool, SYMBOLS))
    return _LETTERS[0][s]


def symbols(text: str) -> np.ndarray:
    """A text as symbols, one per code point; every code point has its own."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1


def _pack(s: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The n-grams whose last symbols stand at ``ends``, packed."""
    packed = np.zeros(len(ends), np.int64)
    for k in range(ORDER - 1, -1, -1):
        packed = packed * SYMBOLS + s[ends - k]
    return packed


def _grams(text: str) -> np.ndarray:
    """The n-gram that ends at each character, packed; places before the text are symbol 0."""
    s = np.concatenate((np.zeros(ORDER - 1, np.int64), symbols(text)))
    return _pack(s, np.arange(ORDER - 1, len(s)))


def _chunk_grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of the documents of a chunk and, per document, where its n-grams begin (one more entry than documents); a
    document that stands alone comes in slices."""
    docs, pad = len(offsets) - 1, ORDER - 1
    text = data.tobytes().decode()
    if docs == 1:
        for at in range(0, len(text), SLICE):
            before = text[max(0, at - pad):at]
            s = np.concatenate((np.zeros(pad - len(before), np.int64), symbols(before + text[at:at + SLICE])))
            yield _pack(s, np.arange(pad, len(s))), np.array([0, len(s) - pad])
        return
    bounds = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    s = np.zeros(len(text) + pad * docs, np.int64)
    ends = np.arange(len(text)) + pad * np.repeat(np.arange(1, docs + 1), np.diff(bounds))
    s[ends] = symbols(text)
    yield _pack(s, ends), bounds


def _by_language(langs: pa.Array, bounds: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """Languages of the documents of a chunk and the places of their n-grams, ascending."""
    coded = langs.dictionary_encode()
    names = coded.dictionary.to_pylist()
    if len(names) == 1:
        yield names[0], np.arange(bounds[-1])
        return
    lang = np.repeat(coded.indices.to_numpy().astype(np.uint16 if len(names) < 1 << 16 else np.uint32), np.diff(bounds))
    order = np.argsort(lang, kind="stable")
    edges = np.cumsum(np.bincount(lang, minlength=len(names)))
    for k, name in enumerate(names):
        yield name, order[edges[k - 1] if k else 0:edges[k]]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams, ascending, and their counts added up."""
    gram, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(gram)
    gram = gram[order]
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    return gram[first], np.add.reduceat(n[order], first, dtype=np.int64)


_DEALT = pa.schema([("block", pa.int64()), ("kind", pa.int8()), ("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])


def _deal(df: DataFrame, id_col: str | None, text_col: str, lang_col: str) -> DataFrame:
    """Blocks of documents: ``block, kind, lang, gram, n`` for every different n-gram of a block and language, and (with
    ``id_col``) ``block, kind, payload`` with the rows themselves, compressed.  A null language is the empty one."""

    def grams(block: int, held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        found = [_merge(parts) for parts in held.values()]
        sizes = [len(gram) for gram, _ in found]
        gram, n = (np.concatenate(x) for x in zip(*found))
        lang = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), pa.array(list(held), pa.string()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(gram), block)), pa.array(np.full(len(gram), _GRAM, np.int8)), lang.cast(pa.string()), pa.array(gram), pa.array(n),
             pa.nulls(len(gram), pa.binary())], schema=_DEALT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, held = TaskContext.get().partitionId() << 32, 0, {}
        packing = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
        for batch in batches:
            for i, j, data, offsets in tx.text_chunks(batch.column(2), ROW_BYTES):
                if size and size + len(data) > BLOCK_BYTES:
                    yield from grams(block, held)
                    block, size, held = block + 1, 0, {}
                size += len(data)
                rows = batch.slice(i, j - i)
                for packed, bounds in _chunk_grams(data, offsets):
                    for lang, at in _by_language(rows.column(1), bounds):
                        if len(at):
                            held.setdefault(lang, []).append(np.unique(packed[at], return_counts=True))
                if id_col is not None:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=packing) as writer:
                        writer.write_batch(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([_TEXTS], pa.int8()), *(pa.nulls(1, _DEALT.field(k).type) for k in (2, 3, 4)),
                         pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_DEALT)
        yield from grams(block, held)

    rows = df.select((F.lit(None) if id_col is None else F.col(id_col)).cast("long").alias("doc_id"),
                     F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "block long, kind byte, lang string, gram long, n long, payload binary")


def _add_up(dealt: DataFrame) -> DataFrame:
    return dealt.filter(F.col("kind") == _GRAM).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def ngram_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, gram, n`` over every whole text: each task counts its n-grams per block and language, Spark adds them up."""
    return _add_up(_deal(df, None, text_col, lang_col))


def _cuts(t: list[int]) -> list[float]:
    if t[0] == 0 or t[1] == 0:
        return [0.5, 0.75, 0.9]
    y = t[0] / (t[0] + 2 * t[1])
    raw = [k - (k + 1) * y * t[k] / t[k - 1] if t[k - 1] else 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


def discounts(sizes: np.ndarray) -> np.ndarray:
    """Discounts of modified Kneser-Ney for counts of one, two, and three or more, from the numbers of
    n-grams seen once to four times."""
    return np.array(_cuts([int((sizes == k).sum()) for k in range(1, 5)]))


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The model of one language in arrays.  Per order, lowest first: sorted n-gram codes, their discounted probability, and the back-off weight of the n-gram as a
    context for the next order.  The highest order uses counts, lower ones the number of different symbols before an n-gram."""
    levels = [(grams, counts)]
    for k in range(ORDER - 1, 0, -1):
        tail, n = np.unique(levels[0][0] % SYMBOLS**k, return_counts=True)
        levels.insert(0, (tail, n))
    model = []
    for k, (gram, n) in enumerate(levels):
        cut = discounts(n)
        off = cut[np.minimum(n, 3) - 1]
        context = gram // SYMBOLS
        heads, at = np.unique(context, return_inverse=True)
        total = np.bincount(at, n)
        model.append([gram, (n - off) / total[at], np.zeros(len(gram))])
        weight = np.bincount(at, off) / total
        if k == 0:
            base = weight[0]
        else:  # the context is an n-gram of the order below, or was never seen as one
            below = model[k - 1]
            place = np.minimum(np.searchsorted(below[0], heads), len(below[0]) - 1)
            hit = below[0][place] == heads
            below[2][place[hit]] = weight[hit]
            extra = heads[~hit]
            if len(extra):
                merged = np.concatenate((below[0], extra))
                order = np.argsort(merged)
                below[0] = merged[order]
                below[1] = np.concatenate((below[1], np.zeros(len(extra))))[order]
                below[2] = np.concatenate((below[2], weight[~hit]))[order]
    model[0].append(base)
    return [tuple(m) for m in model]


def _find(table: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, code), len(table) - 1)
    return place, table[place] == code


def log_probabilities(model: list[tuple], grams: np.ndarray) -> np.ndarray:
    """Natural logarithm of the interpolated probability of the last symbol of each n-gram."""
    codes, prob, _, base = model[0]
    place, hit = _find(codes, grams % SYMBOLS)
    p = np.where(hit, prob[place], 0.0) + base / SYMBOLS
    for k in range(1, ORDER):
        context = grams // SYMBOLS % SYMBOLS**k
        codes, _, back = model[k - 1][:3]
        place, hit = _find(codes, context)
        weight = np.where(hit & (back[place] > 0), back[place], 1.0)
        codes, prob = model[k][:2]
        place, hit = _find(codes, grams % SYMBOLS**(k + 1))
        p = np.where(hit, prob[place], 0.0) + weight * p
    return np.log(p)


def log_perplexity(model: list[tuple], text: str) -> float:
    """Log-perplexity of a whole text per letter.  What is no letter costs without counting: regular strings of marks do not
    make a text look likely."""
    grams = _grams(text)
    letters = int(_letters(grams % SYMBOLS).sum())
    return float(-log_probabilities(model, grams).sum() / max(letters, 1))


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _folder(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quality-{uuid.uuid4().hex}"


def _context() -> Column:
    return F.expr(f"gram div {SYMBOLS}L")


def _model(counts: DataFrame, folder: str) -> DataFrame:
    """``lang, size, gram, p, back`` from ``lang, gram, n``: per language and n-gram seen of each size its interpolated probability, and
    its weight as a context of the next size (null where it was none; a context that is no n-gram of its size has no ``p``).  Size 0
    is the empty n-gram.  The same model as :func:`kneser_ney`, made by Spark."""
    levels = {ORDER: _stored(counts, folder, "counts")}
    for k in range(ORDER - 1, 0, -1):  # the number of different symbols before an n-gram
        levels[k] = _stored(levels[k + 1].groupBy("lang", (F.col("gram") % SYMBOLS**k).alias("gram")).agg(F.count("*").alias("n")), folder, f"level-{k}")
    cuts = F.udf(lambda t: _cuts(t), "array<double>")
    below = levels[1].select("lang", F.lit(0).cast("long").alias("gram"), F.lit(1.0 / SYMBOLS).alias("p")).distinct()
    made = []
    for k in range(1, ORDER + 1):
        seen = levels[k].groupBy("lang").agg(*[F.count_if(F.col("n") == t).alias(f"t{t}") for t in (1, 2, 3, 4)])
        cut = seen.select("lang", cuts(F.array("t1", "t2", "t3", "t4")).alias("cut"))
        sums = levels[k].groupBy("lang", _context().alias("context")).agg(
            F.sum("n").alias("total"), *[F.count_if(F.least("n", F.lit(3)) == t).alias(f"t{t}") for t in (1, 2, 3)]).join(cut, "lang")
        off = sum(F.col("cut")[t - 1] * F.col(f"t{t}") for t in (1, 2, 3))
        contexts = _stored(sums.select("lang", "context", "total", "cut", (off / F.col("total")).alias("weight")), folder, f"contexts-{k}")
        backs = contexts.select("lang", F.col("context").alias("gram"), F.col("weight").alias("back"))
        made.append(below.join(backs, ["lang", "gram"], "full").select("lang", F.lit(k - 1).alias("size"), "gram", "p", "back"))
        rows = levels[k].withColumns({"context": _context(), "rest": F.col("gram") % SYMBOLS ** (k - 1)}).join(contexts, ["lang", "context"])
        rows = rows.join(below.select("lang", F.col("gram").alias("rest"), F.col("p").alias("lower")), ["lang", "rest"])
        kept = F.col("n") - F.get("cut", (F.least("n", F.lit(3)) - 1).cast("int"))
        below = _stored(rows.select("lang", "gram", (kept / F.col("total") + F.col("weight") * F.col("lower")).alias("p")), folder, f"p-{k}")
    made.append(below.select("lang", F.lit(ORDER).alias("size"), "gram", "p", F.lit(None).cast("double").alias("back")))
    out = made[0]
    for more in made[1:]:
        out = out.union(more)
    return _stored(out, folder, "model")


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, size, gram, p, back``: the model (see :func:`_model`) from the n-grams of every document of ``df`` (rows of no language
    are one more language), a table under the checkpoint folder."""
    return _model(ngram_counts(df, text_col, lang_col), _folder(df))


def probabilities(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``lang, gram, p`` of different n-grams of size ``ORDER``: that of the model, or where it has not seen one that of the shorter
    n-gram times the weight of the context, and so on; null in a language the model does not know."""
    entry = lambda size, key, name, value: model.filter(F.col("size") == size).filter(F.col(value).isNotNull()).select(
        "lang", F.col("gram").alias(key), F.col(value).alias(name))
    out = grams.select("lang", "gram", F.lit(0).cast("long").alias("rest")).join(entry(0, "rest", "p", "p"), ["lang", "rest"], "left").drop("rest")
    for k in range(1, ORDER + 1):
        part = F.col("gram") % SYMBOLS**k
        out = out.withColumns({"part": part, "context": F.expr(f"(gram % {SYMBOLS**k}L) div {SYMBOLS}L")})
        out = out.join(entry(k, "part", "seen", "p"), ["lang", "part"], "left").join(entry(k - 1, "context", "weight", "back"), ["lang", "context"], "left")
        out = out.select("lang", "gram", F.coalesce("seen", F.coalesce("weight", F.lit(1.0)) * F.col("p")).alias("p"))
    return out


def _statistics(data: np.ndarray, offsets: np.ndarray, texts: list[str | None]) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the documents of a chunk."""
    starts, ends, bounds = tx.words(data, offsets)
    docs = len(offsets) - 1
    lead = (data & 0xC0) != 0x80  # first bytes of code points
    space = np.isin(data, np.array(tx.BREAKS, np.uint8))
    per_doc = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
    n_words, chars = np.diff(bounds), per_doc(lead & ~space)
    marks = per_doc(np.isin(data, np.frombuffer(_SYMBOL_CHARS, np.uint8)))
    dup = np.zeros(docs, np.int64)
    for i, text in enumerate(texts):
        if text and "\n" in text:
            lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
            dup[i] = len(lines) - len(set(lines))
    first, doc, _ = tx.window_index(bounds, 3)
    repeat = np.zeros(docs, np.int64)
    if len(first):
        key = tx.window_hashes(tx.word_hashes(data, starts, ends), first, 3) + tx.mix(doc.astype(np.uint64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        many = np.zeros(len(key), bool)
        many[order[1:]] |= same
        many[order[:-1]] |= same
        covered = np.zeros(len(starts) + 3, bool)
        for k in range(3):
            covered[first[many] + k] = True
        repeat = np.diff(np.concatenate(([0], np.cumsum(covered)))[bounds])
    return [n_words, chars, marks, dup, repeat]


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


_MEASURED = ["doc_id", "lang", "log_ppl", *_COLUMNS]


def _score_rows(rows: pa.RecordBatch, tables: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Packed documents with their statistics and log-perplexity: per letter, of the whole text.  What is no letter costs without
    counting: regular strings of marks do not make a text look likely."""
    data, offsets = tx.string_buffers(rows.column(2))
    cost, letters = np.zeros(rows.num_rows), np.zeros(rows.num_rows, np.int64)
    for grams, bounds in _chunk_grams(data, offsets):
        log_p = np.zeros(len(grams))
        for lang, at in _by_language(rows.column(1), bounds):
            if len(at):
                known, values = tables[lang]
                log_p[at] = values[np.searchsorted(known, grams[at])]  # a block has all its n-grams
        full = np.flatnonzero(np.diff(bounds))
        cost[full] -= np.add.reduceat(log_p, bounds[full])
        letters[full] += np.add.reduceat(_letters(grams % SYMBOLS), bounds[full], dtype=np.int64)
    ppl = cost / np.maximum(letters, 1)
    return pa.RecordBatch.from_arrays(
        [rows.column(0), rows.column(1), pa.array(ppl, pa.float64(), mask=(np.diff(offsets) == 0) | np.isnan(ppl)),
         *[pa.array(c, pa.int64()) for c in _statistics(data, offsets, rows.column(2).to_pylist())]], names=_MEASURED)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: first the block's n-grams with their ``log_p``, by language and n-gram, then its documents."""
    now, held, tables = None, {}, None
    for batch in batches:
        block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        turn = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *turn], [*turn, len(block)]):
            if a == b:
                continue
            if block[a] != now:
                now, held, tables = block[a], {}, None
            part = batch.slice(a, b - a)
            if kind[a] == _GRAM:
                gram, log_p = part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)
                for lang, at in _by_language(part.column(2), np.arange(b - a + 1)):
                    held.setdefault(lang, []).append((gram[at], log_p[at]))  # in order: the rows are sorted
                continue
            if tables is None:
                tables = {lang: tuple(np.concatenate(x) for x in zip(*parts)) for lang, parts in held.items()}
            for raw in part.column(5):
                yield from (_score_rows(rows, tables) for rows in pa.ipc.open_stream(raw.as_buffer()))


def _measure(dealt: DataFrame, model: DataFrame) -> DataFrame:
    grams = dealt.filter(F.col("kind") == _GRAM).select("block", "kind", "lang", "gram")
    found = probabilities(grams.select("lang", "gram").distinct(), model).select("lang", "gram", F.log("p").alias("log_p"))
    needed = grams.join(found, ["lang", "gram"]).select("block", "kind", "lang", "gram", "log_p", F.lit(None).cast("binary").alias("payload"))
    texts = dealt.filter(F.col("kind") == _TEXTS).select("block", "kind", "lang", "gram", F.lit(None).cast("double").alias("log_p"), "payload")
    met = needed.union(texts).repartition("block").sortWithinPartitions("block", "kind", "lang", "gram")
    return met.mapInArrow(_score, "doc_id long, lang string, log_ppl double, " + ", ".join(f"{c} long" for c in _COLUMNS))


def measure(df: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang``, the statistics of the whole text and ``log_ppl``: its log-perplexity
    under the model of its language (null without a character, or in a language the model does not know)."""
    return _measure(_stored(_deal(df, id_col, text_col, lang_col), _folder(df), "dealt"), model)


def bands(measured: DataFrame, width: float = BAND) -> DataFrame:
    """``measured`` with ``low, high``: the band of log-perplexity of each document, from all documents that pass the base rules.

    The middle is the median of the language, however few documents it has.  The spread around it is pooled over the
    languages, by length (classes of doubling ``word_chars``): the quartiles of a class, smoothed over the classes
    next to it by their numbers of documents, widened by ``width`` interquartile ranges.  While no class has two documents
    there is no spread, and nothing lies outside."""
    clean = ~F.col("base_failed") & F.col("log_ppl").isNotNull()
    middle = measured.filter(clean).groupBy("lang").agg(F.percentile_approx("log_ppl", 0.5, 10_000).alias("middle"))
    size = F.floor(F.log2(F.greatest("word_chars", F.lit(1)))).cast("int")
    rows = measured.withColumn("size", size).join(F.broadcast(middle), "lang", "left")  # a row per language
    spread = rows.filter(clean).groupBy("size").agg(F.percentile_approx(F.col("log_ppl") - F.col("middle"), [0.25, 0.75], 10_000).alias("q"), F.count("*").alias("n")).collect()
    limits = []  # at most 64 classes
    for r in spread:
        weights = [(x.n - 1) * 8.0 ** -abs(x["size"] - r["size"]) for x in spread]
        if sum(weights):
            low, high = (sum(w * x.q[k] for w, x in zip(weights, spread)) / sum(weights) for k in (0, 1))
            limits.append((r["size"], low - width * (high - low), high + width * (high - low)))
    limits = measured.sparkSession.createDataFrame(limits, "size int, under double, over double")
    return rows.join(F.broadcast(limits), "size", "left").withColumns(
        {"low": F.col("middle") + F.col("under"), "high": F.col("middle") + F.col("over")}).drop("size", "middle", "under", "over")


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least_words: int = 50,
          most_repeated: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, the statistics, ``base_failed``, ``kept``, ``log_ppl`` and the band, per input row.

    ``base_failed``: under ``least_words`` words, or over ``most_repeated`` percent of them in repeated 3-word windows.  ``kept``: the base
    rules pass and ``log_ppl`` lies in the band (see :func:`bands`).  Null and empty
    texts have zero counts and fail the base rule; a null language is a language; ids are carried along; repeated rows each
    get their row (and count twice in the model); an empty table gives an empty result."""
    folder = _folder(df)
    dealt = _stored(_deal(df, id_col, text_col, lang_col), folder, "dealt")
    measured = _measure(dealt, _model(_add_up(dealt), folder))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    out = bands(cut_lineage(measured.withColumn("base_failed", failed)))
    inside = F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(True))
    return out.select("doc_id", *_COLUMNS, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "log_ppl", "low", "high", "lang")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands over the whole ``documents`` table."""
    out = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *_COLUMNS, "base_failed", "kept", F.round("log_ppl", 6).alias("log_ppl"))
