"""The pipeline against a plain Python version of its stages, and the registration of the queries."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from blotter.llm import bpe, langid
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import corpus
from tests.llm.test_dedup import _lines_removed
from tests.llm.test_links_web import _fingerprint, _overlaps, _roots


def test_every_operator_is_registered():
    keys = entry.queries()
    for n in range(1, 11):
        assert len([k for k in keys if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in keys and {"op1_line_dedup", "op4_warc_round_trip", "op6_url_filter"} <= entry.oracle_sql().keys()
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "tokens"]


def _plain(spark, docs, items, library):
    """(doc_id, number of ids, digest of the ids) after all stages."""
    model = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").filter(~langid.held_out()), langid.vocabulary_path())
    known = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), model).collect()
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in known if r.lang_pred != "und" and r.score >= 0.5]
    lines = _lines_removed(docs, 10)
    docs = [(d[0], lines[d[0], d[1]][0]) for d in docs]
    prints = {d: _fingerprint(d[1]) for d in docs}
    distinct = sorted(set(prints.values()))
    root = _roots(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 4])
    first = {}
    for d in docs:
        first[root[prints[d]]] = min(first.get(root[prints[d]], d[0]), d[0])
    docs = sorted({d for d in docs if d[0] == first[root[prints[d]]]})
    docs = [d for d in docs if not any(_overlaps(d[1], i) for i in items if i)]
    out = Counter()
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out[doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] += 1
    return out


def test_run_against_plain_python(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == _plain(spark, docs, items, library)
    assert 0 < len(got) < len(docs)


def test_stages_on_odd_tables(spark, tmp_path):
    """Null ids, texts and columns, repeated rows, other columns, and no rows at all."""
    for docs in (corpus.frame(spark, corpus.documents(seed=9)), corpus.empty(spark)):
        before = None
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            path = f"{tmp_path}/{name}-{docs.count()}"
            out.write.parquet(path)
            out = spark.read.parquet(path)
            if name != "tokens":
                assert out.columns == docs.columns
            if before is not None:
                assert out.count() <= before
            before, docs = out.count(), out


def test_language_stage_drops_what_has_no_language(spark):
    rows = [(i, r[1], r[2], r[3]) for i, r in enumerate(corpus.documents(seed=10)) if r[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, df, SF_SMALL).collect()}
    assert kept and all(any(c.isalpha() for c in t) == (i in kept) or any(c.isalpha() for c in t) for i, t, *_ in rows)
    assert not any(i in kept for i, t, *_ in rows if not any(c.isalpha() for c in t))


def test_clean_documents_stay(spark):
    """No document with letters in a learned language goes for its language."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert corpus_pipeline.language(spark, docs, SF_CHECK).count() == docs.filter(r"text rlike r'\p{L}'").count()


def test_rows_without_an_id_are_filtered_by_their_own_text(spark):
    """A third of the rows has no id, others share one: one of each group of near-duplicates stays, and only leaking rows go."""
    rng = random.Random(4)
    prose = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    leak = next(r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect() if r.text and len(r.text.split()) >= 16)
    near = prose(400)
    rows = [(None, near), (None, near + " end"), (None, near + " tail"), (None, near), (3, near + " more")]
    rows += [(None, prose(60)) for _ in range(5)] + [(9, prose(60)) for _ in range(3)] + [(None, f"{prose(20)} {leak}"), (9, f"{prose(20)} {leak}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [_fingerprint(t) for _, t in rows]
    root = _roots(set(prints), [(a, b) for a, b in combinations(set(prints), 2) if (a ^ b).bit_count() <= 4])
    signed = lambda t: (x := xxhash.xxh64_intdigest(t.encode(), 42)) - (x >> 63 << 64)
    first = {}
    for r, f in zip(rows, prints):
        first[root[f]] = min(first.get(root[f], r), r, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    assert len(first) == 11  # the five near copies are one
    once = corpus_pipeline.near_duplicates(spark, df, SF_SMALL)
    assert Counter(map(tuple, once.collect())) == Counter(first.values())
    assert Counter(map(tuple, corpus_pipeline.benchmark(spark, once, SF_SMALL).collect())) == Counter(r for r in first.values() if leak not in r[1])
