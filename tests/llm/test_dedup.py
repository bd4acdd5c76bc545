"""Exact dedup operators against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import line_dedup, substring_dedup, suffix_dedup
from blotter.llm import _exchange as ex
from blotter.llm import _text as tx
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _place(doc_id):
    return (doc_id is not None, doc_id)


def _words_removed(rows, window):
    seen = {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: (_place(r[0]), r[1] or "")):
        found = WORD.findall(text or "")
        for s in range(len(found) - window + 1):
            seen.setdefault(tuple(found[s:s + window]), (_place(doc_id), s))
    out = {}
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        found = WORD.findall(text or "")
        gone = set()
        for s in range(len(found) - window + 1):
            if seen[tuple(found[s:s + window])] != (_place(doc_id), s):
                gone |= set(range(s, s + window))
        out[doc_id, text] = (len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone))
    return out


@pytest.mark.parametrize("window", [2, 5, 20])
def test_substrings_against_brute_force(spark, window):
    rows = corpus.documents(seed=window)
    want = _words_removed(rows, window)
    got = substring_dedup.dedup_substrings(corpus.frame(spark, rows), window).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == Counter((r[0], *want[r[0], r[1]]) for r in rows)
    assert any(r.n_removed for r in got)


def test_substrings_order_and_edges(spark):
    a, b = "a b c d", "x a b c d y"
    df = spark.createDataFrame([(2, a), (1, b), (3, "a b c d a b c d"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.dedup_substrings(df, 3).collect()}
    assert got == {1: (0, b), 2: (4, ""), 3: (8, ""), 4: (0, ""), 5: (0, "")}
    assert substring_dedup.dedup_substrings(corpus.empty(spark), 3).count() == 0


def _bytes_removed(rows, width):
    places = defaultdict(set)
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        raw = (text or "").encode()
        for s in range(len(raw) - width + 1):
            places[raw[s:s + width]].add((doc_id, s))
    out = {}
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - width + 1):
            if len(places[raw[s:s + width]]) > 1:
                gone[s:s + width] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[doc_id, text] = (len(raw), int(gone.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("width, gram, crowd", [(30, 10, 4096), (30, 10, 1), (200, 50, 1), (12, 4, 2)])
def test_bytes_against_brute_force(spark, width, gram, crowd):
    rows = corpus.documents(seed=width)
    want = _bytes_removed(rows, width)
    out = suffix_dedup.dedup_bytes(corpus.frame(spark, rows), width, gram, crowd)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()]
    assert Counter(got) == Counter((r[0], *want[r[0], r[1]]) for r in rows)
    assert any(r[2] for r in got) and suffix_dedup.dedup_bytes(corpus.empty(spark)).count() == 0


def test_bytes_long_texts_are_cut_into_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    long = "".join(rng.choice(list("abcdef "), 3000))
    arr = suffix_dedup.pa.array([long])
    monkeypatch.setattr(suffix_dedup, "SLICE", 500)
    whole = [(0, s) for s in range(len(long) - 99)]
    found = []
    for row, at, data, offsets in suffix_dedup.pieces(arr, 100):
        _, start, strings, _, _ = suffix_dedup.runs(data, offsets, 100, 20)
        assert len(data) <= 599
        for s, n in zip(start, strings):
            found += [(int(row[0]), int(at[0]) + int(s) + k) for k in range(int(n))]
    assert found == whole


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(c % 3 for c in b)), st.integers(1, 20), st.integers(0, 1))
def test_suffix_sort(raw, width, family):
    data = np.frombuffer(raw, np.uint8)
    at = np.arange(max(0, len(raw) - width + 1))
    order, equal = suffix_dedup.sort_suffixes(data, at, width, family)
    texts = [raw[i:i + width] for i in order]
    assert texts == sorted(texts)
    counts = Counter(raw[i:i + width] for i in at)
    assert [e > 0 for e in equal] == [counts[t] > 1 for t in texts]
    assert [bool(x) for x in suffix_dedup.repeated_starts(data, at, width)] == [counts[raw[i:i + width]] > 1 for i in at]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-(1 << 63), (1 << 63) - 1), st.integers(0, 1 << 31)), max_size=30), st.booleans())
def test_packed_places_round_trip(pairs, keyed):
    pairs = sorted(set(pairs))
    docs, places = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    keys = np.arange(len(pairs), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) if keyed and pairs else None
    d, p, k = ex.unpack(ex.pack(docs, places, keys))
    assert d.tolist() == docs.tolist() and p.tolist() == places.tolist()
    assert (k is None) if keys is None else k.tolist() == keys.tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=12), max_size=6))
def test_vectorised_words(texts):
    import pyarrow as pa

    data, offsets = tx.string_buffers(pa.array(texts, pa.string()))
    starts, ends, bounds = tx.words(data, offsets)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        assert [raw[a:b].decode() for a, b in zip(starts[bounds[i]:bounds[i + 1]], ends[bounds[i]:bounds[i + 1]])] == WORD.findall(t)
    hashes = tx.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len({raw[a:b] for a, b in zip(starts, ends)})


def _lines_removed(rows, min_sites):
    sites, first = defaultdict(set), {}
    for r in rows:
        for pos, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            bare = line.strip(" \t\r")
            if bare:
                sites[bare].add(r[3])
                place = (_place(r[0]), pos)
                first[bare] = min(first.get(bare, place), place)
    out = {}
    for r in rows:
        if r[1] is None:
            out[r[0], r[1]] = (None, 0, 0)
            continue
        found = r[1].split("\n")
        gone = [i for i, line in enumerate(found) if len(sites[line.strip(" \t\r")]) >= min_sites
                and first[line.strip(" \t\r")] != (_place(r[0]), i) and line.strip(" \t\r")]
        out[r[0], r[1]] = ("\n".join(x for i, x in enumerate(found) if i not in gone), len(found), len(gone))
    return out


@pytest.mark.parametrize("min_sites", [2, 4, 8])
def test_lines_against_brute_force(spark, min_sites):
    rows = corpus.documents(seed=7)
    want = _lines_removed(rows, min_sites)
    out = line_dedup.dedup_lines(corpus.frame(spark, rows), min_sites)
    assert out.columns == [*corpus.frame(spark, rows).columns, "n_lines", "n_removed"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()]
    assert Counter(got) == Counter((r[0], *want[r[0], r[1]]) for r in rows)
    assert any(r[3] for r in got) and line_dedup.dedup_lines(corpus.empty(spark)).count() == 0


def test_line_spread_is_exact_at_the_threshold(spark):
    rows = [(line, site) for line in range(60) for site in range(line + 1)]
    spread = spark.createDataFrame(rows, "line long, site long")
    for least in (10, 30):
        assert sorted(r.line for r in line_dedup.boilerplate(spread, least, lg_k=8).collect()) == list(range(least - 1, 60))


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.dedup_lines(corpus.frame(spark, corpus.documents()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def _unnamed(seed):
    """Many rows without an id, ids shared by different texts, and passages at the same offset of such rows."""
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(40), prose(60)]
    texts = [f"{rng.choice(shared)} {prose(50)}" for _ in range(10)] + [f"{prose(k)} {shared[0]} {prose(20)}" for k in range(5)] + [prose(80) for _ in range(10)]
    rows = [([None, None, 7, 8, i][i % 5], t) for i, t in enumerate(texts)]
    return rows + rows[:4]


def test_substrings_of_rows_without_an_id_of_their_own(spark):
    rows = _unnamed(1)
    signed = lambda t: (x := xxhash.xxh64_intdigest(t.encode(), 42)) - (x >> 63 << 64)
    place = lambda r: (_place(r[0]), signed(r[1]))
    seen, want = {}, {}
    for r in sorted(set(rows), key=place):
        found = r[1].split()
        for s in range(len(found) - 19):
            seen.setdefault(tuple(found[s:s + 20]), (r, s))
    for r in set(rows):
        found = r[1].split()
        gone = {i for s in range(len(found) - 19) if seen[tuple(found[s:s + 20])] != (r, s) for i in range(s, s + 20)}
        want[r] = len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, substring_dedup.dedup_substrings(df).select("doc_id", "n_words", "n_removed", "kept").collect()))
    assert got == Counter((r[0], *want[r]) for r in rows)


@pytest.mark.parametrize("crowd", [4096, 1])
def test_bytes_of_rows_without_an_id_of_their_own(spark, crowd):
    rows = _unnamed(2)
    named = {r: i for i, r in enumerate(dict.fromkeys(rows))}
    want = _bytes_removed([(i, r[1]) for r, i in named.items()], 100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup_bytes(df, 100, 30, crowd).collect())
    assert got == Counter((r[0], *want[named[r], r[1]]) for r in rows)


def _dealt(batches):
    """Rows dealt out, by bucket, and the places decided on."""
    parts, decided = {}, []
    for out in batches:
        if isinstance(out, tuple):
            docs, starts, ends, names = out
            decided += list(zip(names[0][docs].tolist(), starts.tolist(), ends.tolist()))
        else:
            for part, _, raw in zip(*(out.column(i).to_pylist() for i in range(3))):
                parts.setdefault(part, []).append(raw)
    return parts, decided


def test_crowded_passage_is_dealt_out_until_groups_are_small():
    rng, width, n_docs, crowd, buckets = random.Random(5), 100, 3000, 64, 64
    passage = bytes(rng.randrange(97, 123) for _ in range(width + 20))
    texts = [bytes(rng.randrange(97, 123) for _ in range(25)) + passage + bytes(rng.randrange(97, 123) for _ in range(25)) for _ in range(n_docs)]
    np = suffix_dedup.np
    sizes = np.full(n_docs, len(texts[0]), np.int64)
    twins = np.arange(n_docs, dtype=np.int64)
    # All texts around one anchor, in the passage.
    own = suffix_dedup.Segments(np.arange(n_docs), np.zeros(n_docs, np.int64), np.full(n_docs, 7, np.uint64), np.full(n_docs, 70, np.int64), sizes,
                                np.frombuffer(b"".join(texts), np.uint8), (np.arange(n_docs, dtype=np.int64), twins))
    parts, decided = {0: [own.pack()]}, []
    for most, part in ((crowd, suffix_dedup.PART), (crowd, 1), (None, 1)):
        (judge, rest), dealt = suffix_dedup._sort_bucket(width, buckets, most, part), {}
        for raws in parts.values():
            if most is None:  # what is left for one key: equal strings only
                left = suffix_dedup.Segments.unpack(raws)
                _, first = left.same_texts()
                assert max(Counter(left.keys[first].tolist()).values()) == 1
            again, found = _dealt([*judge(raws), *rest()])
            decided += found
            for k, v in again.items():
                dealt.setdefault(k, []).extend(v)
        parts = dealt
    assert not parts
    covered = {d: set() for d in range(n_docs)}
    for d, a, b in decided:
        covered[d].update(range(a, b))
    seen = Counter(t[a:a + width] for t in texts for a in range(len(t) - width + 1))
    for d, t in enumerate(texts):
        assert covered[d] == {x for a in range(len(t) - width + 1) if seen[t[a:a + width]] > 1 for x in range(a, a + width)}
