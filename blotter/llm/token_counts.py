"""Token counts by a transducer that was compiled from a word-end BPE file.

The merge rules become a deterministic transducer over the bytes of a word.  Two tokens may stand side by side if no rule
would have joined parts of them first; a word's BPE tokenization is its only way through the tokens in which all neighbours
may.  Reading a word byte by byte, a path is the last whole token and the part of the next one read since.  A state of the
transducer is the set of all paths still open, each with the number of tokens it holds beyond what was emitted; a transition
emits the tokens that all its paths agree on, so every arc carries a count.  States and arcs are made when first met and the
table starts anew when it is full.

Whole texts are cut into chunks, anywhere.  What a chunk does is a map from the state before it to the state behind it and a
count.  Behind white space or a digit the state is the same whatever came before, so a map is the head that still depends on
the state, a constant count, and the state at the end; a chunk without such a place is all head.  Maps compose associatively,
and a scan over the chunks of a text (pairs, pairs of pairs, ...) gives its count.  Memory is bounded by the chunk beside the
text itself; no shuffle takes place.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WORD_END, byte_symbols, load_spec

#: States, and word counts, a worker keeps at once.
KEPT = 1 << 17
#: Characters of a chunk.
CHUNK = 1 << 16
#: Tokens beyond which a text is over the limit.
LIMIT = 2048
#: White space of the file's patterns (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A chunk may begin before one of these: none of them joins the character before it under NFC.
_STARTS = regex.compile(r"[\x00-\x7fЀ-҂Ҋ-ԯぁ-ゖァ-ヺ一-鿿가-힣]")
_RESETS = regex.compile(rf"[{SPACE}\p{{N}}]")
_LAST_RESET = regex.compile(rf"(?r)[{SPACE}\p{{N}}]")
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")


class Compiler:
    """Tokens, the prefix tree over their symbols, and which tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        symbol = {s: b for b, s in enumerate(byte_symbols())}
        self.parts: dict[str, tuple[str, str, int]] = {}  # token -> what its rule joined, and the rule's rank
        self.rank: dict[tuple[str, str], int] = {}
        results = {left + right for left, right in merges}
        self.tokens = {t for t in vocab if t not in results}
        for rank, (left, right) in enumerate(merges):
            if left in self.tokens and right in self.tokens and left + right not in self.tokens and self.beside(left, right):
                self.tokens.add(left + right)
                self.parts[left + right] = (left, right, rank)
            self.rank.setdefault((left, right), rank)
        # Nodes of the prefix tree; symbol 256 + b is the last byte b of a word.
        self.child: dict[int, int] = {}
        self.token_at: dict[int, str] = {}
        self.inner: set[int] = set()
        nodes = 1
        for token in sorted(self.tokens):
            body = token.removesuffix(WORD_END)
            codes = [symbol[c] for c in body]
            if body != token:
                codes[-1] += 256
            at = 0
            for code in codes:
                self.inner.add(at)
                key = at << 9 | code
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                at = self.child[key]
            self.token_at[at] = token
        self.pairs: dict[tuple[str, str], bool] = {}

    def beside(self, left: str, right: str) -> bool:
        """Whether no rule known so far joins the end of ``left`` with the start of ``right``.

        The last piece of ``left`` and the first piece of ``right`` grow rule by rule; a rule for two of them applies if its turn
        comes before either has grown further.  (A rule goes from left to right, so on equal rank the left piece goes first.)"""
        ends = self._edge(left, 1)
        starts = self._edge(right, 0)
        for a, until_a in ends:
            for b, until_b in starts:
                rank = self.rank.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b:
                    return False
        return True

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The pieces at one edge of a token, from the whole token to a symbol, each with the rank of the rule that ends it."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            made = self.parts.get(token)
            if made is None:
                return out
            token, until = made[side], made[2]


class Transducer:
    """Arcs ``(state, byte) -> (state, tokens emitted)`` inside a word and ``(state, last byte) -> tokens emitted`` at its end."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], kept: int = KEPT):
        self.compiler = Compiler(vocab, merges)
        self.kept = kept
        self._anew()

    def _anew(self) -> None:
        # A path: (last whole token, node of the part read since, tokens not emitted yet).
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.arcs: dict[int, tuple[int, int]] = {}
        self.ends: dict[int, int] = {}
        self._state((("", 0, 0),))

    def _state(self, paths: tuple) -> int:
        known = self.ids.get(paths)
        if known is None:
            known = self.ids[paths] = len(self.states)
            self.states.append(paths)
        return known

    def _beside(self, left: str, right: str) -> bool:
        if not left:
            return True
        pairs, key = self.compiler.pairs, (left, right)
        known = pairs.get(key)
        if known is None:
            if len(pairs) >= self.kept:
                pairs.clear()
            known = pairs[key] = self.compiler.beside(left, right)
        return known

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        compiler, paths = self.compiler, []
        for last, node, held in self.states[state]:
            node = compiler.child.get(node << 9 | byte)
            if node is None:
                continue
            if node in compiler.inner:
                paths.append((last, node, held))
            token = compiler.token_at.get(node)
            if token is not None and self._beside(last, token):
                paths.append((token, 0, held + 1))
        sure = min([held for _, _, held in paths])
        reached = tuple(sorted([(last, node, held - sure) for last, node, held in paths]))
        if reached not in self.ids and len(self.states) >= self.kept:
            self._anew()  # the arc's origin goes too
            return self._state(reached), sure
        arc = self.arcs[state << 8 | byte] = self._state(reached), sure
        return arc

    def _end(self, state: int, byte: int) -> int:
        compiler = self.compiler
        for last, node, held in self.states[state]:
            token = compiler.token_at.get(compiler.child.get(node << 9 | 256 | byte, -1))
            if token is not None and self._beside(last, token):
                self.ends[state << 8 | byte] = held + 1
                return held + 1
        raise ValueError("no path for a word")

    def read(self, data: bytes, state: int = 0) -> tuple[int, int]:
        """Read bytes inside a word: the state behind them and the tokens emitted."""
        arcs, count = self.arcs, 0
        for byte in data:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                arc = self._arc(state, byte)
                arcs = self.arcs
            state = arc[0]
            count += arc[1]
        return state, count

    def word(self, data: bytes) -> int:
        """Tokens of a whole word."""
        state, count = self.read(data[:-1])
        key = state << 8 | data[-1]
        end = self.ends.get(key)
        return count + (self._end(state, data[-1]) if end is None else end)


class ChunkMap:
    """What a chunk does to the state before it: ``head`` is read from that state; if ``resets``, the state is then that of a
    text's start, ``count`` tokens follow, and ``tail`` is read."""

    __slots__ = ("count", "head", "resets", "tail")

    def __init__(self, head: str, resets: bool = False, count: int = 0, tail: str = ""):
        self.head, self.resets, self.count, self.tail = head, resets, count, tail


class Counter:
    """Counts the tokens of whole texts: NFC, lower case, words, bytes."""

    def __init__(self, spec: dict, chunk: int = CHUNK, kept: int = KEPT):
        self.transducer = Transducer(spec["vocab"], spec["merges"], kept)
        self.chunk = chunk
        added = sorted(spec["added"], key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, added))).split if added else None
        counter = self

        class Words(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= kept:
                    self.clear()
                if len(word) > 256:  # long words are not kept
                    return counter.transducer.word(word.encode())
                self[word] = got = counter.transducer.word(word.encode())
                return got

        self.words = Words()

    def _inside(self, text: str) -> int:
        """Tokens of a normalised text from a text's start to its end."""
        words = self.words
        return sum([words[w] for w in _WORDS.findall(text)])

    def chunk_map(self, text: str) -> ChunkMap:
        """The map of one chunk of raw text."""
        if not text.isascii():
            # The lower case of a capital sigma does not depend on its place in the word.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        first = _RESETS.search(text)
        if first is None:
            return ChunkMap(text)
        last = _LAST_RESET.search(text).end()
        return ChunkMap(text[:first.start()], True, self._inside(text[first.start():last]), text[last:])

    def compose(self, left: ChunkMap, right: ChunkMap) -> ChunkMap:
        """First ``left``, then ``right``; associative."""
        if not left.resets:
            return ChunkMap(left.head + right.head, right.resets, right.count, right.tail)
        if not right.resets:
            return ChunkMap(left.head, True, left.count, left.tail + right.head)
        return ChunkMap(left.head, True, left.count + self._inside(left.tail + right.head) + right.count, right.tail)

    def chunks(self, text: str) -> Iterator[str]:
        """The text in pieces of about ``chunk`` characters, cut where normalisation does not look across."""
        at, n = 0, len(text)
        while n - at > self.chunk:
            found = _STARTS.search(text, at + self.chunk)
            end = found.start() if found else n
            yield text[at:end]
            at = end
        yield text[at:]

    def _plain(self, text: str) -> int:
        maps = [self.chunk_map(piece) for piece in self.chunks(text)]
        while len(maps) > 1:  # one level of the scan: neighbours compose
            maps = [functools.reduce(self.compose, maps[i:i + 2]) for i in range(0, len(maps), 2)]
        whole = maps[0]
        return self._inside(whole.head) + whole.count + self._inside(whole.tail)

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; the strings of added tokens count one each; null is the empty text."""
        if not text:
            return 0
        pieces = self.cut(text) if self.cut else [text]
        return sum([self._plain(p) for p in pieces if p]) + len(pieces) - 1


_COUNTERS: dict[str, Counter] = {}


def _counter(shared) -> Counter:
    """One compiled transducer per worker and broadcast vocabulary."""
    key = shared.value["id"]
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(shared.value["spec"])
    return _COUNTERS[key]


def token_counts(df: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``df``.

    ``n_bytes`` is the length in UTF-8, ``n_tokens`` the number of tokens the vocabulary file at ``path`` gives the whole text,
    ``over_limit`` whether that is more than ``limit``.  Null and empty texts have no bytes and no tokens; null and repeated ids
    are carried along, one row out per row in; an empty table gives no rows; other columns, whatever their names, are not read."""
    spec = load_spec(path)
    ident = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()
    # As large as the vocabulary file, whatever the data.
    shared = df.sparkSession.sparkContext.broadcast({"id": ident, "spec": spec})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter = _counter(shared)
            found = []
            for text in batch.column(1):
                found.append(counter.count(text.as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                     F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")).alias("n_bytes"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def tokenizer_path() -> str:
    """Default place of the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of the whole ``documents`` table under the 49,408-token word BPE."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
