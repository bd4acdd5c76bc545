"""Language ID, quality rules, tokenisation: brute force, library comparison, held-out accuracy."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import bpe, langid, quality
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ tokens
@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_spec(bpe.tokenizer_path()))


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


ODD = ["", " ", "a", "ÀÉÎ ΣΑΣ οδός İstanbul ﬁ ½ Ⅷ ² x²", "hello<|endoftext|>World <|startoftext|><|endoftext|>", "<|endoftext|",
       "it's we'll they've I'm d'd 'S", "\x1c\x1f a\x85b​z　q", "日本語テキスト 한국어 العربية हिन्दी \U0001f642", "a" * 3000, "aaaaa ababababab", "é é",
       "\x00\x01 _foo__bar123 4567", "﻿bom", "thethethe" * 40, "\n\n\t"]


def _same(codec, library, text):
    ids = codec.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_codec_on_odd_texts(codec, library, text):
    _same(codec, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefghijklmnopqrstuvwxyzéüñß'  \n0123.,!#日🙂", max_size=60))
def test_codec_equals_the_library(codec, library, text):
    _same(codec, library, text)


def test_automaton_equals_merging_by_rank():
    """All words over two letters under random merge tables, against merging by rank."""
    rng = random.Random(5)
    for _ in range(30):
        symbols = ["a", "b", "a</w>", "b</w>"]
        merges = []
        while len(merges) < 9:
            left, right = rng.choice(symbols), rng.choice(symbols)
            if left.endswith("</w>") or (left, right) in merges or left + right in symbols:
                continue
            merges.append((left, right))
            symbols.append(left + right)
        vocab = {s: i for i, s in enumerate(symbols)}
        automaton = bpe.Automaton(vocab, merges, {})
        for n in range(1, 9):
            for word in map("".join, product("ab", repeat=n)):
                parts = [*word[:-1], word[-1] + "</w>"]
                for left, right in merges:
                    i, out = 0, []
                    while i < len(parts):
                        if parts[i:i + 2] == [left, right]:
                            out.append(left + right)
                            i += 2
                        else:
                            out.append(parts[i])
                            i += 1
                    parts = out
                assert [symbols[t] for t in automaton.encode_word(word)] == parts


def test_round_trip_rows(spark, codec):
    rows = corpus.documents(seed=2)
    out = bpe.round_trip(corpus.frame(spark, rows), bpe.tokenizer_path(), with_ids=True).collect()
    want = Counter()
    for r in rows:
        ids = codec.encode(r[1])
        want[r[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:4] for r in out) == want
    encoded = bpe.encode(corpus.frame(spark, rows), bpe.tokenizer_path())
    back = {r.doc_id: r.text for r in bpe.decode(encoded, bpe.tokenizer_path()).collect()}
    assert all(back[r[0]] == codec.decode(codec.encode(r[1])) for r in rows)
    assert bpe.round_trip(corpus.empty(spark), bpe.tokenizer_path()).count() == 0


def test_op7_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in bpe.op7_bpe_codec(spark, SF_SMALL).collect():
        ids = library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---------------------------------------------------------------- language
def _segmentations(word, prob, pieces):
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            total += prob[pieces[word[:n]]] * _segmentations(word[n:], prob, pieces)
    if word[0] not in pieces:
        total += prob[-1] * _segmentations(word[1:], prob, pieces)
    return total


PIECES = ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "aab", "bb", "▁b"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abz", min_size=1, max_size=8), min_size=1, max_size=5), st.integers(0, 99))
def test_forward_sums_all_segmentations(words, seed):
    rng = np.random.default_rng(seed)
    prob = rng.random((len(PIECES) + 1, 2)) * 0.3 + 0.01
    lattice = langid.Lattice(PIECES)
    got = lattice.forward(words, prob)
    index = {p: i for i, p in enumerate(PIECES)}
    for row, word in zip(got, words):
        for lang in (0, 1):
            assert math.isclose(math.exp(row[lang]), _segmentations("▁" + word, prob[:, lang], index), rel_tol=1e-9)


@pytest.mark.parametrize("block", [1 << 15, 700, 3])
def test_long_words_sum_all_segmentations(monkeypatch, block):
    """Words of any length, against the sum over segmentations in numbers that do not underflow."""
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(block)
    prob = np.random.default_rng(5).random((len(PIECES) + 1, 2)) * 1e-4 + 1e-6
    words = ["".join(rng.choice("abz") for _ in range(n)) for n in (41, 500, 39, 3000, 1200, 40, 1)]
    got = langid.Lattice(PIECES).forward(words, prob)
    index = {p: i for i, p in enumerate(PIECES)}
    for row, word in zip(got, words):
        text = "▁" + word
        for lang in (0, 1):
            sums = [Decimal(1)]
            for end in range(1, len(text) + 1):
                total = Decimal(0)
                for size in range(1, min(4, end + 1)):
                    piece = text[end - size:end]
                    if piece in index:
                        total += sums[end - size] * Decimal(prob[index[piece], lang])
                    elif size == 1:
                        total += sums[end - 1] * Decimal(prob[-1, lang])
                sums.append(total)
            assert math.isclose(row[lang], float(sums[-1].ln()), rel_tol=1e-9)


def test_sample_of_rows_is_bounded(spark):
    """A third of the rows share one id, another third are copies of one row: neither fills the sample."""
    rows = [(7, f"word number {i} of a shared id", "en") for i in range(300)] + [(8, "the same row", "en")] * 300 + [
        (100 + i, f"other row {i}", "en") for i in range(300)]
    taken = langid.sample_rows(spark.createDataFrame(rows, "id long, text string, lang string").repartition(5), 64).collect()
    texts = Counter(r.text for r in taken)
    assert 0 < len(taken) <= 64 and max(texts.values()) == 1


def test_expected_uses_sum_to_the_letters():
    lattice = langid.Lattice(PIECES)
    words, counts = ["abab", "zab", "b", "a" * 40, "ab" * 400, "abz" * 30], np.array([2.0, 1.0, 5.0, 1.0, 3.0, 2.0])
    use = lattice.expected(words, counts, np.full(len(PIECES) + 1, 0.1))
    letters = sum(n * (len(w) + 1) for w, n in zip(words, counts))
    assert math.isclose(float((use * lattice.size).sum()), letters, rel_tol=1e-9)


def test_held_out_accuracy_and_contract(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rows = langid.op10_language_id(spark, SF_CHECK).collect()
    import zlib

    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert len(tested) > 100 and sum(r.lang_pred == docs[r.doc_id].lang for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)


def test_identify_odd_rows(spark):
    model = langid.fit(corpus.frame(spark, corpus.documents(seed=3)), langid.vocabulary_path(), per_language=20, rounds=1)
    assert model["languages"] == ["de", "en", "fr"]
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (3, "123 %%% ²", 7), (4, "x" * 5000, 8), (5, "word", 9)], "doc_id long, text string, score int")
    out = langid.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"] and out.count() == 6
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[1] == got[None] == got[3] == ("und", 0.0)
    assert got[4][0] in model["languages"] and got[5][0] in model["languages"]
    nothing = langid.fit(corpus.empty(spark), langid.vocabulary_path())
    assert nothing["languages"] == [] and {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    assert langid.identify(corpus.empty(spark), model).count() == 0


def test_prediction_does_not_look_at_labels(spark):
    rows = corpus.documents(seed=4)
    model = langid.fit(corpus.frame(spark, rows), langid.vocabulary_path(), per_language=20, rounds=1)
    plain = {(r.text): r.lang_pred for r in langid.identify(corpus.frame(spark, rows), model).collect()}
    moved = [(r[0], r[1], "zz", "other", *r[4:]) for r in rows]
    assert plain == {(r.text): r.lang_pred for r in langid.identify(corpus.frame(spark, moved), model).collect()}


# ----------------------------------------------------------------- quality
def _statistics(text):
    found = WORD.findall(text or "")
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(found[i:i + 3]) for i in range(len(found) - 2))
    covered = set()
    for i in range(len(found) - 2):
        if windows[tuple(found[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_statistics_against_brute_force(spark):
    rows = corpus.documents(seed=5) + [(900, "a b a b a b a b", "en", "s", 1, 1, 1, "", ""), (901, "x\nx\n\n x\nx", "en", "s", 1, 1, 1, "", "")]
    got = quality.judge(corpus.frame(spark, rows)).collect()
    want = Counter()
    for r in rows:
        s = _statistics(r[1])
        want[(r[0], *s, s[0] < 50 or 100 * s[4] > 50 * s[0])] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not (r.kept and r.base_failed) for r in got)
    assert quality.judge(corpus.empty(spark)).count() == 0


def _plain_kneser_ney(counts):
    """Interpolated modified Kneser-Ney from its definition, with dictionaries."""
    order, size = quality.ORDER, quality.SYMBOLS
    levels = [None] * order
    levels[order - 1] = dict(counts)
    for k in range(order - 2, -1, -1):
        before = defaultdict(set)
        for gram in levels[k + 1]:
            before[gram[1:]].add(gram[0])
        levels[k] = {g: len(s) for g, s in before.items()}
    cuts = [quality.discounts(np.array(list(level.values()))) for level in levels]

    def probability(gram, k=order - 1):
        if k < 0:
            return 1.0 / size
        level, cut = levels[k], cuts[k]
        context, last = gram[-k - 1:-1] if k else (), gram[-1]
        after = {g: n for g, n in level.items() if g[:-1] == context}
        total = sum(after.values())
        below = probability(gram[-k:] if k else gram, k - 1)
        if not total:
            return below
        n = after.get((*context, last), 0)
        weight = sum(cut[min(m, 3) - 1] for m in after.values()) / total
        return (max(n - cut[min(n, 3) - 1], 0) / total if n else 0) + weight * below

    return probability


def test_kneser_ney_against_its_definition():
    text = "the cat sat on the mat, the cat ate the rat; 77 cats sat!"
    grams, counts = np.unique(quality._grams(text), return_counts=True)
    model = quality.kneser_ney(grams, counts)
    unpack = lambda g: tuple(int(g) // quality.SYMBOLS**k % quality.SYMBOLS for k in range(quality.ORDER - 1, -1, -1))
    plain = _plain_kneser_ney({unpack(g): int(n) for g, n in zip(grams, counts)})
    tried = np.concatenate([grams, quality._grams("zebra the % rat cattle")])
    got = np.exp(quality.log_probabilities(model, tried))
    assert np.allclose(got, [plain(unpack(g)) for g in tried], rtol=1e-9)
    context = int(quality._grams("the")[-1]) // quality.SYMBOLS * quality.SYMBOLS
    assert math.isclose(float(np.exp(quality.log_probabilities(model, context + np.arange(quality.SYMBOLS))).sum()), 1.0, rel_tol=1e-9)


def test_counts_cover_every_character(spark):
    rows = corpus.documents(seed=6)
    got = {(r.lang, r.gram): r.n for r in quality.ngram_counts(corpus.frame(spark, rows).filter("lang is not null")).collect()}
    want = Counter()
    for r in rows:
        if r[1] and r[2]:
            want.update((r[2], int(g)) for g in quality._grams(r[1]))
    assert got == dict(want)


def test_bands_keep_clean_documents(spark):
    judged = quality.op8_quality_rules(spark, SF_CHECK).filter("not base_failed")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    share = {r.quality: r.kept for r in judged.join(labels, "doc_id").groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "kept").collect()}
    kept = {r.quality: r["count"] for r in judged.join(labels, "doc_id").filter("kept").groupBy("quality").count().collect()}
    assert kept[1] >= 0.97 * share[1] and kept.get(0, 0) <= 0.4 * share[0]


def _prose(rng, words, letters):
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words)) for _ in range(1)][0]


def _clean(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def test_text_with_nearly_half_its_blocks_gibberish_is_rejected(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("aeiou" if k % 2 else "bdlmnrst") for k in range(rng.randint(2, 9))) for _ in range(200)]
    rows = [(i, _clean(rng, rng.randint(60, 500), vocabulary), "en") for i in range(150)]
    rows += [(1000 + i, _clean(rng, 28 * n, vocabulary) + " " + _prose(rng, 22 * n, "qxzjkvwfghpcy"), "en") for i, n in enumerate((3, 6, 12))]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(kept[1000 + i] for i in range(3)) and sum(kept[i] for i in range(150)) >= 147


def test_small_and_many_languages_are_judged(spark):
    """A language of a few documents rejects as a large one does, and 40 languages are whole."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("aeiou" if k % 2 else "bdlmnrst") for k in range(rng.randint(2, 9))) for _ in range(200)]
    rows = [(i, _clean(rng, rng.randint(60, 300), vocabulary), f"l{i % 40:02}") for i in range(320)]
    rows += [(1000 + i, _prose(rng, 120, "qxzjkvwfghpcy"), f"l{i:02}") for i in (0, 39)] + [(2000, None, "none"), (2001, "", None)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows) and not any(kept[i] for i in (1000, 1039, 2000, 2001))
    assert sum(kept[i] for i in range(320)) >= 310


def test_bands_reject_low_quality_documents(spark):
    judged = quality.op8_quality_rules(spark, SF_CHECK).filter("not base_failed").join(spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id")
    counts = Counter((r.quality, r.kept) for r in judged.collect())
    assert counts[0, True] == 0 < counts[0, False] and counts[1, True] >= 0.97 * (counts[1, True] + counts[1, False]), counts


def test_every_code_point_is_a_symbol_of_its_own(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert len(set(quality.symbols("".join(map(chr, points))).tolist())) == len(points)
    texts = ["ab", "Ab", "aB", "\u0430\u0431", "\u044e\u0431", "\U0001f642\U0001f643", "\U0001f643\U0001f642", "\x00ab", "\x00\x00ab"]
    rows = [(i, t, f"l{i}") for i, t in enumerate(texts)]
    got = defaultdict(set)
    for r in quality.ngram_counts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect():
        got[r.lang].add((r.gram, r.n))
    assert len({frozenset(x) for x in got.values()}) == len(texts)


def test_characters_that_shared_a_symbol_are_told_apart(spark):
    """Words whose letters are swapped at random for letters 30 code points on are noise."""
    rng = random.Random(13)
    letters = [chr(c) for c in range(0x430, 0x440)]
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(200)]
    rows = [(i, _clean(rng, rng.randint(60, 500), vocabulary), "ru") for i in range(150)]
    noisy = lambda text: "".join(c if c == " " or rng.random() < 0.5 else chr(ord(c) + 30) for c in text)
    rows += [(1000 + i, noisy(_clean(rng, 150 * n, vocabulary)), "ru") for i, n in enumerate((1, 2, 4))]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(kept[1000 + i] for i in range(3)) and sum(kept[i] for i in range(150)) >= 147


@pytest.fixture
def small_blocks(monkeypatch):
    """Few bytes per block, row and slice, so that a small corpus has many of each."""
    for name, value in (("BLOCK_BYTES", 3000), ("ROW_BYTES", 700), ("SLICE", 100)):
        monkeypatch.setattr(quality, name, value)


def _models(rows):
    grams = defaultdict(list)
    for _, text, lang, *_ in rows:
        if text:
            grams[lang or ""].append(quality._grams(text))
    return {lang: quality.kneser_ney(*np.unique(np.concatenate(g), return_counts=True)) for lang, g in grams.items()}


def test_log_perplexity_against_one_model_per_language(spark):
    rows = corpus.documents(seed=7) + [(903, "Ж日\U0001f642 \x00 é" * 400, "xx", "s", 1, 1, 1, "", ""), (904, "Ä", "yy", "s", 1, 1, 1, "", "")]
    known = _models(rows)
    want = Counter((r[0], r[2] or "", None if not r[1] else round(quality.log_perplexity(known[r[2] or ""], r[1]), 9)) for r in rows)
    got = quality.judge(corpus.frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.lang, None if r.log_ppl is None else round(r.log_ppl, 9)) for r in got) == want


def test_blocks_and_slices_change_nothing(spark, small_blocks):
    rows = corpus.documents(seed=8)
    dealt = list(quality._chunk_grams(np.frombuffer("aé日 b".encode() * 90, np.uint8), np.array([0, 8 * 90])))
    assert len(dealt) == 5 and np.array_equal(np.concatenate([g for g, _ in dealt]), quality._grams("aé日 b" * 90))
    assert quality._deal(corpus.frame(spark, rows, 1), "doc_id", "text", "lang").select("block").distinct().count() > 5
    known = _models(rows)
    measured = quality.measure(corpus.frame(spark, rows, 1), quality.fit(corpus.frame(spark, rows)))
    want = Counter((r[0], None if not r[1] else round(quality.log_perplexity(known[r[2] or ""], r[1]), 9), *_statistics(r[1])) for r in rows)
    assert Counter((r.doc_id, None if r.log_ppl is None else round(r.log_ppl, 9), *r[3:]) for r in measured.collect()) == want


def test_other_texts_back_off_and_unknown_languages_have_no_perplexity(spark):
    train = [(1, "the cat sat on the mat, the cat ate the rat; 77 cats sat!", "en"), (2, "the hat", "en"), (3, "der Hut", "de")]
    other = [(4, "zebra the % rat catt\u0436e", "en"), (5, "the cat", "de"), (6, "the cat", "xx"), (7, "", "en")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = _models(train)
    got = {r.doc_id: r.log_ppl for r in quality.measure(frame(other), quality.fit(frame(train))).collect()}
    for i, text, lang in other[:2]:
        assert math.isclose(got[i], quality.log_perplexity(known[lang], text), rel_tol=1e-9)
    assert got[6] is None and got[7] is None
