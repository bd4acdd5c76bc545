"""Token counts against the tokenizers library."""

import random
from itertools import product

import pytest
from tokenizers import Tokenizer

from blotter.llm import bpe, token_counts
from tests.conftest import SF_SMALL
from tests.llm import corpus


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(token_counts.tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def spec():
    return bpe.load_spec(token_counts.tokenizer_path())


ODD = [*"abcdefgstrevmlDRE'''  \n\t123!?.,;<|>", "É", "é", "ü", "Σ", "ς", "ß", "İ", "日", "本", "한", "글", "й", "́", "̈", "라",
       "ᆨ", "\U0001f642", "Ⅷ", "Ж", "\xa0", "\x1c", "\u0000", "<|endoftext|>", "<|startoftext|>", "'s", "'re", "'ll", "the", "ing"]


@pytest.mark.parametrize("chunk, kept", [(1, 50), (3, 300), (1 << 16, 1 << 17)])
def test_cut_anywhere_and_tables_of_any_size(spec, library, chunk, kept):
    rng = random.Random(chunk)
    counter = token_counts.Counter(spec, chunk, kept)
    for _ in range(300):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 50)))
        assert counter.count(text) == library(text), text


def test_long_words_and_long_texts(spec, library):
    rng = random.Random(7)
    counter = token_counts.Counter(spec, chunk=1000)
    for text in ("a" * 20000, "ab" * 5000, "".join(rng.choice("abcdefgh") for _ in range(20000)), "日本" * 4000, "'" * 3001, "word 12 " * 50000):
        assert counter.count(text) == library(text)


def test_maps_compose_in_any_grouping(spec):
    rng = random.Random(3)
    counter = token_counts.Counter(spec)
    for _ in range(50):
        a, b, c = (counter.chunk_map("".join(rng.choice("ab 1'st") for _ in range(rng.randint(0, 6)))) for _ in range(3))
        left, right = counter.compose(counter.compose(a, b), c), counter.compose(a, counter.compose(b, c))
        assert [getattr(left, k) for k in left.__slots__] == [getattr(right, k) for k in right.__slots__]


def test_transducer_equals_merging_by_rank():
    """All words over three letters under a few rules, with rules that never apply and rules that overlap."""
    end = token_counts.WORD_END
    rules = [("a", "a"), ("b", "c" + end), ("a", "b"), ("aa", "a"), ("ab", "ab"), ("c", "c"), ("cc", "c"), ("b", "a"), ("ba", "b" + end)]
    letters = [*"abc", *(x + end for x in "abc")]
    vocab = {t: i for i, t in enumerate([*letters, *(a + b for a, b in rules)])}
    transducer = token_counts.Transducer(vocab, rules)

    def merged(word):
        parts = [*word[:-1], word[-1] + end]
        for a, b in rules:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (a, b):
                    parts[i:i + 2] = [a + b]
                i += 1
        return len(parts)

    for n in range(1, 8):
        for word in product("abc", repeat=n):
            assert transducer.word("".join(word).encode()) == merged(word), word


def test_rows_of_odd_tables(spark, library):
    rows = corpus.documents(seed=5) + [(None, None, None, None, None, None, None, None, None)]
    out = token_counts.token_counts(corpus.frame(spark, rows), token_counts.tokenizer_path(), limit=100)
    got = sorted([tuple(r) for r in out.collect()], key=str)
    want = [(r[0], len((r[1] or "").encode()), library(r[1]), library(r[1]) > 100) for r in rows]
    assert got == sorted(want, key=str)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert token_counts.token_counts(corpus.empty(spark), token_counts.tokenizer_path()).collect() == []


def test_whole_table(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for row in token_counts.op13_token_counts(spark, SF_SMALL).collect():
        assert row["n_tokens"] == library(texts[row["doc_id"]])
