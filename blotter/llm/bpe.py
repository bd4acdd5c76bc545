"""BPE encoding and decoding with a tokenization automaton.

The merge table is compiled into a deterministic automaton over tokens by one
merge gadget per rule, in rule order.  It starts with a single state that
loops on every base symbol.  The gadget of the rule ``u v -> w``

* takes the arc ``v`` out of the state reached by ``u`` (after ``u``, ``v`` can no longer
  follow: the two would have merged), and
* adds an arc ``w`` to every state that still has an arc ``u``; it leads to a copy of
  the state reached by ``v``.

A rule whose ``v`` can no longer follow ``u`` never applies and adds nothing.

The target of an arc depends on its label alone, so a state is named by the token
that leads to it.  Written out, the arcs of a 49,000-token vocabulary are over
2 * 10**9; the table therefore keeps what each gadget did (the state it copied, the
arc it doubled, the arc it took out) and an arc is looked up through that history,
once per pair of tokens, and then kept.

Every symbol string has exactly one path, and that path is its BPE tokenization.
Encoding walks a word through the table; decoding emits the labels of the arcs.  Vocabulary and merges come from a
tokenizer file (a parameter); nothing is trained.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


WORD_END = "</w>"
#: White space of the file's patterns (Unicode White_Space), as a character class.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Word tokenizations and arcs a worker keeps at once; it starts anew beyond them.
KEPT = 1 << 18
#: Rows a worker returns at once.
ROWS = 256


def _latin(first: str) -> str:
    """The characters up to U+00FF whose general category begins with ``first``, escaped for a character class."""
    return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == first)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others get the characters from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def load_spec(path: str) -> dict:
    """Vocabulary, merges and added tokens of a tokenizer file with word-end BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
        raise ValueError(f"{path}: not a BPE file with word ends")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class Automaton:
    """States and arcs as the merge gadgets left them (see the module's docstring)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int]):
        self.added = added
        self.n = max([*vocab.values(), *added.values()]) + 1
        self.reach: dict[str, int] = {}  # longest token by its first two symbols
        for t in vocab:
            length = len(t.removesuffix(WORD_END))
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), length)
        self.label = [""] * self.n
        for token, i in [*vocab.items(), *added.items()]:
            self.label[i] = token
        self.made = [-1] * self.n  # the gadget that made a token's arc and state; -1: a base symbol
        self.doubled = [-1] * self.n  # the arc beside which the arc was added
        self.copied = [-1] * self.n  # the state of which the state is a copy
        self.taken: dict[int, int] = {}  # (state, arc) taken out -> gadget
        results = {left + right for left, right in merges}
        self.vocab = {t: i for t, i in vocab.items() if t not in results}  # tokens that are arcs
        for rank, (left, right) in enumerate(merges):
            if left in self.vocab and right in self.vocab and self._look_up(vocab[left], vocab[right]):
                self._gadget(rank, vocab[left], vocab[right], vocab[left + right])
                self.vocab[left + right] = vocab[left + right]
        self.arcs: dict[int, bool] = {}

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        self.taken[u * self.n + v] = rank
        self.made[w], self.doubled[w], self.copied[w] = rank, u, v

    def has_arc(self, state: int, arc: int) -> bool:
        """Whether ``arc`` leaves ``state`` after all gadgets."""
        key = state * self.n + arc
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= KEPT:
                self.arcs.clear()
            known = self.arcs[key] = self._look_up(state, arc)
        return known

    def _look_up(self, state: int, arc: int) -> bool:
        made, n, before = self.made, self.n, sys.maxsize
        while True:
            gone = self.taken.get(state * n + arc)
            if gone is not None and gone < before:
                return False
            if made[state] > made[arc]:  # the state is a copy: as the original was just before
                before = made[state]
                state = self.copied[state]
            elif made[arc] >= 0:  # the arc was added beside another one, once that gadget had taken its arc out
                before = made[arc] + 1
                arc = self.doubled[arc]
            else:
                return True

    def encode_word(self, symbols: str) -> list[int]:
        """Token ids of a word given in byte symbols.

        The state after a prefix is the same on every path to it, so a place from which no arc leads
        on is dead for good: the walk takes the longest arc first and never enters a place twice."""
        n, vocab, reach, has_arc = len(symbols), self.vocab, self.reach, self.has_arc
        marked = symbols + WORD_END
        out: list[int] = []
        begins: list[int] = []
        dead: set[int] = set()
        at, state = 0, -1
        end = min(n, reach.get(marked[:2], 1))
        while at < n:
            while end > at:
                token = vocab.get(symbols[at:end] if end < n else marked[at:])
                if token is not None and end not in dead and (state < 0 or has_arc(state, token)):
                    break
                end -= 1
            else:
                if not out:
                    raise ValueError(f"no path for {symbols[:40]!r}")
                dead.add(at)
                end, at = at - 1, begins.pop()
                out.pop()
                state = out[-1] if out else -1
                continue
            out.append(token)
            begins.append(at)
            at, state = end, token
            end = min(n, at + reach.get(marked[at:at + 2], 1))
        return out


def _in_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Codec:
    """Encoder and decoder of whole texts for the word-BPE file: NFC, lower case, split into
    words, bytes as symbols.  The strings of added tokens are taken out of a text first."""

    def __init__(self, spec: dict):
        self.automaton = Automaton(spec["vocab"], spec["merges"], spec["added"])
        pattern = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
        self.find = regex.compile(pattern.format(L=r"\p{L}", N=r"\p{N}", S=_SPACE)).findall
        # The same words for texts within Latin-1, where plain character classes do.
        self.find_latin = re.compile(pattern.format(L=_latin("L"), N=_latin("N"), S="\\t-\\r \\x85\\xa0")).findall
        added = sorted(spec["added"], key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")").split if added else None
        self.marks = {t: np.array([i], "<u4").tobytes() for t, i in spec["added"].items()}
        self.symbol = byte_symbols()
        codec = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= KEPT:
                    self.clear()
                symbols = "".join([codec.symbol[b] for b in word.encode()])
                self[word] = got = np.array(codec.automaton.encode_word(symbols), "<u4").tobytes()
                return got

        self.words = Words()

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # The lower case of a capital sigma does not depend on its place in the word.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        words, text = self.words, text.lower()
        find = self.find_latin if text.isascii() or _in_latin(text) else self.find
        return b"".join([words[w] for w in find(text)])

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers; null is the empty text."""
        if not text:
            return b""
        if self.cut is None or not any(t in text for t in self.marks):
            return self._plain(text)
        return b"".join([self.marks.get(piece) or self._plain(piece) for piece in self.cut(text)])

    def decode(self, ids: bytes) -> str:
        """The labels of the ids, joined by one space."""
        label = self.automaton.label
        return " ".join([label[i] for i in np.frombuffer(ids, "<u4").tolist()])


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker and broadcast vocabulary."""
    key = shared.value["id"]
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value["spec"])
    return _CODECS[key]


def _share(df: DataFrame, path: str):
    """The vocabulary as a broadcast variable; its size is that of the file (a few MB), not of the data."""
    spec = load_spec(path)
    ident = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast({"id": ident, "spec": spec})


def _rows(work: Callable, names: list[str], types: list[pa.DataType]):
    """Map of an Arrow batch, ``ROWS`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids, values = batch.column(0).slice(at, ROWS), batch.column(1).slice(at, ROWS).to_pylist()
                made = list(zip(*[work(v) for v in values]))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(m, t) for m, t in zip(made, types))], names=[ids_name, *names])

    ids_name = "doc_id"
    return run


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: the token ids of every whole text as little-endian unsigned 32-bit
    integers.  Null and empty texts have no tokens; ids are carried along as they are (null, repeated)."""
    shared = _share(df, path)

    def work(text: str | None) -> tuple[int, bytes]:
        ids = _codec(shared).encode(text)
        return len(ids) // 4, ids

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _rows(work, ["n_tokens", "ids"], [pa.int64(), pa.binary()]), "doc_id long, n_tokens long, ids binary")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the labels of the ids joined by one space (null ids: empty text)."""
    shared = _share(df, path)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        _rows(lambda ids: (_codec(shared).decode(ids or b""),), ["text"], [pa.string()]), "doc_id long, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again, in one pass over the rows.

    Result per input row: ``doc_id, n_tokens, ids_sha256`` (of the ids as little-endian unsigned
    32-bit integers), ``decoded_sha256`` (of the decoded text in UTF-8), both lowercase hex, and with
    ``with_ids`` also ``ids``.  Null and empty texts encode to no tokens and decode to the empty
    text; repeated rows each get their row; other columns are ignored."""
    shared = _share(df, path)

    def work(text: str | None) -> tuple:
        codec = _codec(shared)
        ids = codec.encode(text)
        found = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        return (*found, ids) if with_ids else found

    names, types = ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.binary()], schema + ", ids binary"
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _rows(work, names, types), schema)


def tokenizer_path() -> str:
    """Default place of the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe_codec(spark, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table through the 49,408-token word BPE, there and back."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
