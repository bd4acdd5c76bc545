"""Source divergence against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from blotter.llm import divergence as dv
from tests.llm import corpus

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top):
    """``rows``: (text, lang, source)."""
    used, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        group = lang or "", source or ""
        groups.add(group)
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        used[group].update(found)
        held[group[0]].update(set(found))
    kept = {lang: [t for t, n in held[lang].items() if n >= least] for lang in {g[0] for g in groups}}
    part = {}
    for lang, source in groups:
        part[lang, source] = used[lang, source]
    for lang in kept:
        part[lang, None] = sum((used[g] for g in groups if g[0] == lang), Counter())
    share = {}
    for (lang, source), n in part.items():
        total = sum(n[t] for t in kept[lang])
        share[lang, source] = {t: 1 + 1000000000 * (n[t] + 5) // (total + 5 * len(kept[lang])) for t in kept[lang]}
    out = []
    for lang, source in groups:
        own, whole = share[lang, source], share[lang, None]
        pairs = [(b, sum(abs(own[t] - share[lang, b][t]) for t in own)) for x, b in groups if x == lang and b != source]
        terms = [(t, own[t] - whole[t]) for t in own if part[lang, source][t] and own[t] > whole[t]]
        for name, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, name, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def _got(spark, rows, **options):
    data = [(i, t, a, s, 0, i, i, "x", "y") for i, (t, a, s) in enumerate(rows)]
    out = dv.audit(corpus.frame(spark, data, 4), **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted([tuple(r) for r in out.collect()])


def _rows(seed, n, sources=9):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeÉéßñжя日") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    out = []
    for _ in range(n):
        source = rng.choice([None, "", *(f"s{i}" for i in range(sources))]) if rng.random() < 0.6 else "s0"
        some = words[:40] if source == "s1" else words
        text = "".join(rng.choice(some) + rng.choice([" ", "\n", "7", "-", "."]) for _ in range(rng.randint(0, 40)))
        out.append((rng.choice([text, text.upper(), text]), rng.choice(["en", "en", "de", None, ""]), source))
    out += [(None, "en", "null text"), ("", "fr", "one"), ("123 [] `", "fr", "two"), ("alone", "xx", "s0")]
    return out + [out[0]] * 5


@pytest.mark.parametrize("options", [dict(), dict(tile=2), dict(most=7, tile=3), dict(least=1, top=3, most=50), dict(least=10**6)])
def test_against_plain_python(spark, options):
    rows = _rows(11, 250)
    least, top = options.get("least", 6), options.get("top", 50)
    assert _got(spark, rows, **{"least": least, "top": top, **options}) == brute(rows, least, top)


def test_counts_handed_on_early(spark, monkeypatch):
    rows = [(t, a, s) for _, t, a, s, *_ in corpus.documents(seed=3)]
    got = [tuple(r) for r in dv.term_counts(corpus.frame(spark, [(0, *r, 0, 0, 0, "", "") for r in rows])).collect()]
    monkeypatch.setattr(dv, "KEPT", 10)
    monkeypatch.setattr(dv, "SLICE", 50)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([(r[k] or "").encode() for r in rows], pa.binary()) for k in (1, 2, 0)], names=["a", "b", "c"])
    again = defaultdict(lambda: [0, 0])
    for out in dv._count(iter([batch])):
        for *key, n, docs in zip(*out.to_pydict().values()):
            again[tuple(key)][0] += n
            again[tuple(key)][1] += docs
    assert {k: tuple(v) for k, v in again.items()} == {tuple(map(bytes, r[:3])): tuple(r[3:]) for r in got}


def test_empty_table(spark):
    assert dv.audit(corpus.empty(spark)).collect() == []


def test_runs_and_intersections():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(0, 30))
        a, b = rng.integers(0, 3, n), rng.integers(0, 3, n)
        one, two = (dv.Column(*(x.tobytes() for x in dv.runs(v.astype(np.int64))), n, 50, 9) for v in (a, b))
        want = np.abs(dv.shares(a, 50, 9) - dv.shares(b, 50, 9)).sum()
        assert dv.distance(one, two, n) == want
        assert len(one.starts) == (n > 0) + int((a[1:] != a[:-1]).sum())


def test_shares_are_exact():
    counts = np.array([0, 1, 10**13, 3 * 10**17], np.int64)
    want = [1 + 10**9 * (int(c) + 5) // (10**18 + 5 * 7) for c in counts]
    assert dv.shares(counts, 10**18, 7).tolist() == want
