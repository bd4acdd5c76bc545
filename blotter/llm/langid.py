"""Language identification by unigram pieces with all segmentations summed.

The piece inventory is a fixed public vocabulary (a parameter); per language a
unigram distribution over its pieces is learned by expectation maximisation.
The probability of a word is the sum over all its segmentations into pieces,
computed by the forward algorithm; a text's log-likelihood is the sum over its
words, and the prediction is the language with the largest posterior under equal
priors.

A word is a run of letters in lower case, with the vocabulary's word mark in
front, of any length.  Letters that no piece covers cost a fixed small probability.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import _text as tx

WORD_MARK = "▁"
#: Longer words are summed in logarithms: products of so many probabilities fall below the smallest double.
LONG_WORD = 40
#: Letters of long words taken at once; a longer word is read in blocks of so many letters.
BLOCK = 1 << 15
#: Probability of a letter that no piece covers, and the count added to every piece.
UNCOVERED, ADDED = 1e-6, 0.05
#: Shares of a language from which its sample is drawn.
SHARES = 64
#: Words a worker keeps the scores of, and their letters; rows it takes at once.
KEPT, KEPT_LETTERS, ROWS = 1 << 18, 1 << 23, 512
#: The languages a model holds at most: 32,000 pieces of 8 bytes each stay under 100 MB of broadcast.
MOST_LANGUAGES = 400


def load_pieces(path: str) -> list[str]:
    """Ordinary pieces of a vocabulary file, without control, unknown and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def text_words(text: str | None) -> list[str]:
    """The words of a text as they are scored."""
    return tx.letter_words(text) if text else []


def _by_length(words: list[str]) -> Iterator[tuple[bool, list[int]]]:
    """The numbers of the words in groups: the short ones, and long ones of about ``BLOCK`` letters together."""
    short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
    if short:
        yield False, short
    group, size = [], 0
    for i in sorted((i for i, w in enumerate(words) if len(w) > LONG_WORD), key=lambda i: len(words[i])):
        if group and size + len(words[i]) > BLOCK:
            yield True, group
            group, size = [], 0
        group.append(i)
        size += len(words[i])
    if group:
        yield True, group


class Lattice:
    """All segmentations of a list of words: an arc for each piece at each place, and one for each uncovered letter."""

    def __init__(self, pieces: list[str]):
        self.find = ahocorasick.Automaton()
        for i, piece in enumerate(pieces):
            self.find.add_word(piece, i)
        self.find.make_automaton()
        self.size = np.array([len(p) for p in pieces] + [1], np.int64)
        self.uncovered = len(pieces)

    def arcs(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(start, end, piece, level of the start, word starts, word ends), places counted over all words joined."""
        marked = [WORD_MARK + w for w in words]
        lengths = np.array([len(w) for w in marked], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1  # one separator after each word
        found = np.array(list(self.find.iter("\n".join(marked))), np.int64).reshape(-1, 2)
        ends, piece = found[:, 0] + 1, found[:, 1]
        begins = ends - self.size[piece]
        single = np.ones(int(lengths.sum() + len(words)), bool)
        single[begins[self.size[piece] == 1]] = False
        single[starts + lengths] = False
        more = np.flatnonzero(single)
        begins = np.concatenate([begins, more])
        ends = np.concatenate([ends, more + 1])
        piece = np.concatenate([piece, np.full(len(more), self.uncovered)])
        word = np.searchsorted(starts, begins, "right") - 1
        return begins, ends, piece, begins - starts[word], starts, starts + lengths

    @staticmethod
    def _levels(level: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(level, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(level[order])) + 1) if len(order) else []

    def forward(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log-probability of each word (rows) in each language (columns), over all segmentations of the whole word; ``prob`` has a row for
        each piece and a last one for uncovered letters."""
        out = np.empty((len(words), prob.shape[1]))
        for long, which in _by_length(words):
            some = [words[i] for i in which]
            if not long:
                begins, ends, piece, level, starts, stops = self.arcs(some)
                alpha = np.zeros((int(stops[-1]) + 1, prob.shape[1]))
                alpha[starts] = 1.0
                for sel in self._levels(level):  # arcs of one level end at different places
                    alpha[ends[sel]] += alpha[begins[sel]] * prob[piece[sel]]
                out[which] = np.log(alpha[stops])
            elif len(some) == 1 and len(some[0]) > BLOCK:
                out[which] = self._in_blocks(some[0], np.log(prob))
            else:
                alpha, _, stops = self._logs(some, np.log(prob))
                out[which] = alpha[stops]
        return out

    def _logs(self, words: list[str], logs: np.ndarray) -> tuple[np.ndarray, tuple, np.ndarray]:
        """Logarithms of the forward sums at every place, the arcs, and where words end."""
        begins, ends, piece, level, starts, stops = self.arcs(words)
        alpha = np.full((int(stops[-1]) + 1, logs.shape[1]), -np.inf)
        alpha[starts] = 0.0
        levels = self._levels(level)
        for sel in levels:
            alpha[ends[sel]] = np.logaddexp(alpha[ends[sel]], alpha[begins[sel]] + logs[piece[sel]])
        return alpha, (begins, ends, piece, levels, starts), stops

    def _in_blocks(self, word: str, logs: np.ndarray) -> np.ndarray:
        """The forward sum of one very long word, with the places of one block in memory: a piece reaches back by its length only."""
        marked, reach = WORD_MARK + word, int(self.size.max())
        alpha = np.full((reach + 1, logs.shape[1]), -np.inf)  # the last places before a block, the last one at its start
        alpha[-1] = 0.0
        for at in range(0, len(marked), BLOCK):
            size = min(BLOCK, len(marked) - at)
            back = min(at, reach)
            found = np.array(list(self.find.iter(marked[at - back:at + size])), np.int64).reshape(-1, 2)
            ends, piece = found[:, 0] + 1 - back, found[:, 1]  # places counted from the start of the block
            begins = ends - self.size[piece]
            ends, piece, begins = ends[ends > 0], piece[ends > 0], begins[ends > 0]
            single = np.ones(size, bool)
            one = begins[(self.size[piece] == 1)]
            single[one] = False
            more = np.flatnonzero(single)
            begins, ends = np.concatenate([begins, more]), np.concatenate([ends, more + 1])
            piece = np.concatenate([piece, np.full(len(more), self.uncovered)])
            local = np.concatenate([alpha, np.full((size, logs.shape[1]), -np.inf)])
            for sel in self._levels(begins):
                local[ends[sel] + reach] = np.logaddexp(local[ends[sel] + reach], local[begins[sel] + reach] + logs[piece[sel]])
            alpha = local[-(reach + 1):]
        return alpha[-1]

    def expected(self, words: list[str], counts: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in ``counts`` occurrences of the words, one language."""
        total = np.zeros(self.uncovered + 1)
        for long, which in _by_length(words):
            some, n = [words[i] for i in which], counts[which]
            if long:
                logs = np.log(prob)
                alpha, (begins, ends, piece, levels, starts), stops = self._logs(some, logs[:, None])
                alpha, beta = alpha[:, 0], np.full(len(alpha), -np.inf)
                beta[stops] = 0.0
                for sel in reversed(levels):
                    np.logaddexp.at(beta, begins[sel], logs[piece[sel]] + beta[ends[sel]])
                word = np.searchsorted(starts, begins, "right") - 1
                use = np.exp(alpha[begins] + logs[piece] + beta[ends] - alpha[stops][word]) * n[word]
            else:
                begins, ends, piece, level, starts, stops = self.arcs(some)
                alpha, beta = np.zeros(int(stops[-1]) + 1), np.zeros(int(stops[-1]) + 1)
                alpha[starts], beta[stops] = 1.0, 1.0
                levels = self._levels(level)
                for sel in levels:
                    alpha[ends[sel]] += alpha[begins[sel]] * prob[piece[sel]]
                for sel in reversed(levels):  # arcs of one level may begin at one place
                    np.add.at(beta, begins[sel], prob[piece[sel]] * beta[ends[sel]])
                word = np.searchsorted(starts, begins, "right") - 1
                use = alpha[begins] * prob[piece] * beta[ends] / alpha[stops][word] * n[word]
            total += np.bincount(piece, use, minlength=self.uncovered + 1)
        return total


_LATTICES: dict[str, Lattice] = {}


def _lattice(pieces: dict) -> Lattice:
    """One lattice builder per worker and vocabulary."""
    if pieces["id"] not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[pieces["id"]] = Lattice(pieces["pieces"])
    return _LATTICES[pieces["id"]]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of learning: crc32 of the id as text is 2 modulo 4 (a null id is not held out, nor learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(langs, batch.column(1)):
            counts.update((lang, w) for w in text_words(text.as_py()))
        rows = [(lang, word, n) for (lang, word), n in counts.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])


def sample_rows(rows: DataFrame, per_language: int) -> DataFrame:
    """``lang, text`` of at most ``per_language`` rows of each language (rounded up to whole shares), of ``lang, id, text`` rows without nulls.

    Each of ``SHARES`` shares of the ids by hash gives the rows with its smallest hashes, so no task sees all rows of a language.
    Rows are named by language, id and text hash: rows that share an id are rows of their own, copies of a row are one."""
    named = rows.withColumn("twin", F.xxhash64(F.col("text").cast("binary")))
    rank = F.row_number().over(Window.partitionBy("lang", "share").orderBy("hash", "id", "twin"))
    hashed = named.select("lang", "id", "twin", F.xxhash64("id").alias("hash")).withColumn("share", F.pmod(F.shiftright("hash", 32), F.lit(SHARES)))
    chosen = hashed.withColumn("rank", rank).filter(F.col("rank") <= -(-per_language // SHARES))
    chosen = cut_lineage(chosen.select("lang", "id", "twin").distinct())
    # The row names are broadcast: per_language * MOST_LANGUAGES rows at most.  Copies of a row are dropped in each task first.
    return named.join(F.broadcast(chosen), ["lang", "id", "twin"]).dropDuplicates(["lang", "id", "twin"]).select("lang", "text")


def fit(df: DataFrame, path: str, per_language: int = 1000, rounds: int = 3, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> dict:
    """Learn the model from the labelled rows of ``df``.

    It learns from a bounded sample: ``per_language`` rows of each language, in ``SHARES`` equal shares of the ids by hash the
    smallest hashes of each (the only bound; texts are used whole; equal rows count once, rows that share an id are rows of their own).  Rows with a null id, text or language are left out.  Word counts and
    expected piece counts are summed by Spark; what reaches the driver is one number per language and piece of the
    vocabulary.  Result: ``languages``, ``prob`` (pieces + 1 x languages) and the vocabulary."""
    spark = df.sparkSession
    pieces = load_pieces(path)
    shared = {"id": hashlib.sha256("\n".join(pieces).encode()).hexdigest(), "pieces": pieces}
    rows = df.select(F.col(lang_col).alias("lang"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).dropna()
    languages = [r.lang for r in rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sample = sample_rows(rows, per_language)
    words = sample.mapInArrow(_word_counts, "lang string, word string, n long")
    words = cut_lineage(words.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    prob = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    prob[-1] = UNCOVERED
    for _ in range(rounds if languages else 0):
        now = spark.sparkContext.broadcast({"vocabulary": shared, "prob": prob, "languages": languages})

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = now.value
            column = {lang: i for i, lang in enumerate(model["languages"])}
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                lang, word, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for name in set(lang):
                    sel = np.flatnonzero(lang == name)
                    use = _lattice(model["vocabulary"]).expected([word[i] for i in sel], n[sel].astype(float), model["prob"][:, column[name]])
                    total[name] = total.get(name, 0) + use
            for name, use in total.items():
                some = np.flatnonzero(use[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(use[some], pa.float64())], names=["lang", "piece", "uses"])

        uses = words.mapInArrow(expect, "lang string, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
        table = uses.toPandas()
        prob = np.full((len(pieces) + 1, len(languages)), ADDED)
        prob[table["piece"].to_numpy(), [languages.index(x) for x in table["lang"]]] += table["uses"].to_numpy()
        prob /= prob[:-1].sum(axis=0)
        prob[-1] = UNCOVERED
        now.destroy()
    return {"vocabulary": shared, "prob": prob, "languages": languages}


class _Scores(dict):
    """Index of each word seen; words without a score wait in ``new``."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.letters = 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.letters += len(word)
        self.new.append(word)
        return n


def identify(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and behind them ``lang_pred`` and ``score`` (columns of ``df`` by these names are replaced): the most
    likely language of the whole text and its posterior.

    A null text, a text without a letter and a model without languages give ``und`` and 0.  Ties go to the language that sorts
    first.  Only the text is looked at; rows are carried along as they are (null ids, repeated rows, other columns)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary times MOST_LANGUAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prob, languages = shared.value["prob"], shared.value["languages"]
        lattice = _lattice(shared.value["vocabulary"])
        index, score = _Scores(), np.zeros((0, max(1, len(languages))))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.column(0).slice(at, ROWS)
                found = [[index[w] for w in text_words(t)] for t in rows.field(text_col).to_pylist()]
                if index.new and languages:
                    score = np.concatenate([score, lattice.forward(index.new, prob)])
                    index.new = []
                lang, posterior = ["und"] * len(found), np.zeros(len(found))
                for i, ids in enumerate(found):
                    if ids and languages:
                        total = score[ids].sum(axis=0)
                        best = int(total.argmax())
                        lang[i], posterior[i] = languages[best], 1.0 / np.exp(total - total[best]).sum()
                if len(index) > KEPT or index.letters > KEPT_LETTERS:
                    index, score = _Scores(), score[:0]
                yield pa.RecordBatch.from_arrays([rows, pa.array(lang, pa.string()), pa.array(posterior, pa.float64())],
                                                 names=["row", "lang_pred", "score"])

    names = [c for c in df.columns if c not in ("lang_pred", "score")]
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    schema = T.StructType([source.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema).select("row.*", "lang_pred", "score")


def vocabulary_path() -> str:
    """Default place of the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Learn on the rows that are not held out, predict every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(~held_out()), vocabulary_path())
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
