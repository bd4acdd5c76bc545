"""SimHash, decontamination, WARC and URL rules against plain Python."""

import base64
import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import _text as tx
from blotter.llm import components, decontaminate, simhash, url_filter, warc
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ----------------------------------------------------------------- simhash
def _fingerprint(text, shingle=4):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i:i + shingle]).encode(), 42) for i in range(max(1, len(found) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in ["", None, " \n", "One", "A b c", "a B c d e", "Ünï É " * 30, "x y " * 500]:
        assert simhash.fingerprint((text or "").encode()) == _fingerprint(text)


def test_near_duplicates_against_brute_force(spark):
    rows = corpus.documents(seed=8)
    got = simhash.near_duplicates(corpus.frame(spark, rows)).collect()
    prints = [(r[0], _fingerprint(r[1])) for r in rows]
    distinct = sorted({f for _, f in prints})
    root = _roots(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 4])
    low = lambda ids: min(ids, key=lambda i: (i is not None, i))
    component = {r: low([i for i, f in prints if root[f] == r]) for r in set(root.values())}
    assert Counter(map(tuple, got)) == Counter((i, f"{f:016x}", component[root[f]]) for i, f in prints)
    assert len(set(root.values())) < len(distinct)
    assert simhash.near_duplicates(corpus.empty(spark)).count() == 0


def _cloud(rng, n, flips):
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    out = []
    for _ in range(n):
        x = int(centre)
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 6), st.booleans())
def test_bit_sliced_forest(seed, radius, two_sides):
    rng = np.random.default_rng(seed)
    fps = np.array(sorted({*_cloud(rng, 90, 9), *_cloud(rng, 60, 4), *map(int, rng.integers(0, 1 << 63, 40, dtype=np.uint64))}), np.uint64)
    rng.shuffle(fps)
    left, right = (fps[:70], fps[70:]) if two_sides else (fps, None)
    u, v = simhash.forest(left, right, radius)
    found = _roots(fps.tolist(), zip(u.tolist(), v.tolist()))
    pairs = [(a, b) for a in left.tolist() for b in right.tolist()] if two_sides else list(combinations(fps.tolist(), 2))
    want = _roots(fps.tolist(), [p for p in pairs if (p[0] ^ p[1]).bit_count() <= radius])
    assert len(u) == len(fps) - len(set(want.values()))  # a forest: no more links than needed
    groups = lambda roots: sorted(sorted(n for n in roots if roots[n] == r) for r in set(roots.values()))
    assert groups(found) == groups(want)


def test_blocks_whose_counters_all_passed_are_abandoned(monkeypatch):
    calls = []
    add = simhash._add
    monkeypatch.setattr(simhash, "_add", lambda *a: calls.append(1) or add(*a))
    far = simhash.bit_planes(np.full(64, 0xFFFFFFFFFFFFFFFF, np.uint64))
    assert not simhash.near(np.zeros(3, np.uint64), far, np.zeros((3, 1), np.uint64), 4).any()
    assert len(calls) == 7  # one step of eight planes


@pytest.mark.parametrize("radius, blocks", [(4, 6), (3, 5), (0, 2)])
def test_linked_fingerprints_share_a_key(radius, blocks):
    rng = random.Random(radius)
    tables = simhash.Tables(radius, blocks)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), radius):
            b ^= 1 << bit
        t = np.arange(len(tables.masks))
        assert (tables.key(t, np.full(len(t), a, np.uint64)) == tables.key(t, np.full(len(t), b, np.uint64))).any()


def test_a_crowded_key_is_cut_into_tiles(spark):
    rng = np.random.default_rng(1)
    fps = np.array(sorted({int(x) << 20 for x in rng.integers(0, 1 << 16, 300)}), np.uint64)  # low blocks equal: one key for many
    tables = simhash.Tables(4, 6)
    raws = [np.zeros(len(fps), np.uint8).tobytes() + fps.tobytes()]
    old, simhash.TILE = simhash.TILE, 64
    try:
        out = [r for b in simhash._meet(tables, 4, 8)(iter([simhash._batch([(0, 0, raws[0])])])) for r in b.to_pylist()]
    finally:
        simhash.TILE = old
    tiles = [r for r in out if r["kind"] == simhash._TILES]
    assert tiles
    links = []
    for batch in simhash._compare_tiles(4)(iter([simhash._batch([(r["part"], r["kind"], r["payload"]) for r in out])])):
        links += [(x % (1 << 64), y % (1 << 64)) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    key = tables.key(np.zeros(len(fps), np.int64), fps)
    want = [(a, b) for (a, ka), (b, kb) in combinations(list(zip(fps.tolist(), key.tolist())), 2) if ka == kb and (a ^ b).bit_count() <= 4]
    groups = lambda roots: sorted(sorted(n for n in roots if roots[n] == r) for r in set(roots.values()))
    assert groups(_roots(fps.tolist(), links)) == groups(_roots(fps.tolist(), want))


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1001 + i) for i in range(50)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = chain + star + loose + [(5, 5), (41, -3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == _roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --------------------------------------------------------- decontamination
def test_masks_are_lossless_for_two_replaced_words():
    window = 13
    for gone in combinations(range(window), 2):
        assert any(not {at + m for m in mask} & set(gone) for mask in decontaminate.MASKS[:2] for at in range(window - mask[-1]))


def _tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _overlaps(doc, item, window=13, similarity=0.8):
    a, b = _tokens(doc), _tokens(item)
    size = min(window, len(b))
    if len(b) < 6:
        return False
    return any(sum(a[i + k] == b[j + k] for k in range(size)) >= similarity * size - 1e-9
               for i in range(len(a) - size + 1) for j in range(len(b) - size + 1))


def test_overlaps_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([15, 20, 40])))) for i in range(12)] + [(20, "Short item here"), (21, None), (22, ""), (None, " ".join(prose(16)))]
    items += [items[0], (23, items[1][1])]
    docs = [(None, items[2][1]), (500, None), (501, ""), (502, "w1 w2")]
    for i in range(60):
        own = (rng.choice(items[:12])[1]).split()
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        lo = rng.randint(0, 5)
        text = " ".join(prose(rng.randint(0, 50)) + own[lo:lo + rng.randint(8, 40)] + prose(rng.randint(0, 50)))
        docs.append((i, text.upper() if i % 9 == 0 else text.replace(" ", ", ") if i % 5 == 0 else text))
    docs += [docs[-1]]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_overlaps(df, bench).collect()
    want = {(d, i) for d, t in docs for i, u in items if u and _overlaps(t, u)}
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 20
    assert all(0.8 * r.n_overlap <= r.n_equal + 1e-9 <= r.n_overlap + 1e-9 or r.n_overlap > 13 for r in got)
    clean = decontaminate.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(d for d in docs if d[0] not in {w[0] for w in want})


@pytest.mark.parametrize("size", range(1, 14))
def test_every_allowed_replacement_is_found(size):
    """Items of each length under all replacements of words the similarity allows, and of one more."""
    item = [f"i{k}" for k in range(size)]
    index = decontaminate.Index([" ".join(item), "other words " * 20])
    allowed = size - math.ceil(0.8 * size - 1e-9) if size >= 6 else 0
    for n in range(min(size, allowed + 1) + 1):
        for gone in combinations(range(size), n):
            words = ["x", "y", *("z" if k in gone else w for k, w in enumerate(item)), "x"]
            data, offsets = tx.string_buffers(pa.array([" ".join(words)]))
            starts, ends, bounds = tx.words(data, offsets)
            hashes = tx.word_hashes(data, starts, ends)
            hits = [h for h in index.hits(hashes, bounds).tolist() if index.overlap(hashes, h[1], h[2], 13, 0.8)[0]]
            assert hits == ([[0, 0, 2]] if n <= allowed else [])


@pytest.mark.parametrize("size, replaced", [(1, 0), (5, 1), (6, 1), (12, 2), (13, 3), (3, 2), (20, 4)])
def test_made_masks_are_lossless(size, replaced):
    masks = decontaminate.masks_for(size, replaced)
    assert all(any(not set(mask) & set(gone) for mask in masks) for gone in combinations(range(size), replaced))


def test_short_items_and_documents_without_an_id_of_their_own(spark):
    items = [(1, "one two three four five six"), (2, "alpha beta"), (3, "lone"), (4, "...")]
    docs = [(None, "x one two THREE four 5 six y"), (None, "nothing here"), (None, "also, Alpha beta"), (7, "clean text"), (7, "a lone word"), (8, "alpha x beta"), (None, None)]
    df, bench = spark.createDataFrame(docs + docs[:1], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, decontaminate.find_overlaps(df, bench).collect()))
    assert got == Counter([(None, 1, 6, 5), (None, 2, 2, 2), (7, 3, 1, 1)])
    assert Counter(map(tuple, decontaminate.clean_documents(df, bench).collect())) == Counter([docs[1], docs[3], docs[5], docs[6]])


def test_benchmark_in_several_blocks_and_empty_tables(spark, monkeypatch):
    items = [(i, " ".join(f"b{i}x{k}" for k in range(15))) for i in range(10)]
    df = spark.createDataFrame([(i, f"pre {t} post") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    assert len(list(decontaminate._blocks(bench))) > 3
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_overlaps(df, bench).collect()} == {(i, i) for i in range(10)}
    assert decontaminate.find_overlaps(df, bench.limit(0)).count() == 0
    assert decontaminate.find_overlaps(df.limit(0), bench).count() == 0


# -------------------------------------------------------------------- WARC
def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, member int")


PAGES = [(3, "http://a/ b\r\nx", "<p>same</p>", "c", 1), (1, "http://a/1", "<p>same</p>", None, 1), (2, None, None, None, 1), (4, "http://é", "", None, 1),
         (5, "http://b", "ünï\r\n\r\nWARC/1.1\r\n" * 40, None, 1), (5, "http://b", "ünï\r\n\r\nWARC/1.1\r\n" * 40, None, 1), (None, "u", "<p>same</p>", None, 1),
         (9, "http://long", "z" * 300000, None, 1)]


def test_warc_round_trip(spark, tmp_path):
    warc.write_archives(_pages(spark, PAGES), f"{tmp_path}/w", records_per_file=3)
    out = warc.read_archives(spark, f"{tmp_path}/w")
    assert out.filter("gap is not null").count() == 0
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = Counter()
    for page, _, html, *_ in PAGES:
        first = min((p for p, _, h, *_ in PAGES if (h or "") == (html or "")), key=lambda p: (p is None, p))
        want[page, len((html or "").encode()), digest(html), "response" if first == page else "revisit", None if first == page else first] += 1
    assert Counter(map(tuple, warc.page_records(out).collect())) == want
    stored = {r.record_id: bytes(r.payload) for r in out.filter("warc_type = 'response'").collect()}
    assert stored["<urn:x-page:9>"] == b"z" * 300000 and stored["<urn:x-page:2>"] == b""
    # Any gzip reader sees one stream of WARC records.
    import glob
    import gzip

    text = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/w/part-*") if open(f, "rb").read())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)


def test_short_payloads_are_all_responses_and_empty_tables(spark, tmp_path):
    warc.write_archives(_pages(spark, PAGES), f"{tmp_path}/w", least_bytes=100)
    kinds = Counter(r.record_type for r in warc.page_records(warc.read_archives(spark, f"{tmp_path}/w")).collect())
    assert kinds == {"response": len(PAGES)}
    warc.write_archives(_pages(spark, []), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def _archive(n, zipped):
    records = []
    for i in range(n):
        payload = f"<html>{i}</html>".encode() * (i + 1)
        record = warc.build_record(i, f"http://x/{i}", payload, warc.base32_sha1(payload), None, False, "1970-01-01T00:00:00Z")
        records.append(warc.gzip_member(record) + warc.EMPTY_MEMBER if zipped else record)
    return records


def _ids(data):
    return [f["warc-record-id"] for *_, reason, f, _ in warc.salvage(data) if reason is None]


@pytest.mark.parametrize("zipped", [True, False])
@settings(max_examples=60, deadline=None)
@given(hit=st.integers(0, 5), at=st.floats(0, 0.999), how=st.sampled_from(["flip", "cut", "insert", "zero"]))
def test_salvage(zipped, hit, at, how):
    records = _archive(6, zipped)
    # Without a CRC the header is not covered: there the block is damaged.
    low = 0 if zipped else records[hit].index(b"\r\n\r\n") + 4
    high = len(records[hit]) - (len(warc.EMPTY_MEMBER) if zipped else 4)
    k = low + int(at * (high - low))
    bad = bytearray(records[hit])
    if how == "flip":
        bad[k] ^= 0x55
    elif how == "cut":
        del bad[k:k + 7]
    elif how == "insert":
        bad[k:k] = b"\x1f\x8b\x08WARC/1.1\r\n"
    else:
        bad[k:k + 9] = bytes(len(bad[k:k + 9]))
    data = b"".join(records[:hit]) + bytes(bad) + b"".join(records[hit + 1:])
    found = list(warc.salvage(data))
    ids = _ids(data)
    for i in range(6):  # every other record is recovered
        if i != hit:
            assert f"<urn:x-page:{i}>" in ids
    for start, end, reason, fields, block in found:
        if reason is None and fields["warc-record-id"] != f"<urn:x-page:{hit}>":
            payload = warc.http_payload(block)[1]
            assert payload == f"<html>{fields['warc-record-id'][12:-1]}</html>".encode() * (int(fields["warc-record-id"][12:-1]) + 1)
    gaps = [(s, e) for s, e, reason, *_ in found if reason]
    begin = sum(map(len, records[:hit]))
    assert all(begin <= s < e <= begin + len(bad) for s, e in gaps)
    assert f"<urn:x-page:{hit}>" in ids or gaps


def test_salvage_reports_gaps_with_reasons():
    records = _archive(3, True)
    data = b"junk in front" + records[0] + records[1][:-40] + records[2] + b"tail"
    found = list(warc.salvage(data))
    assert _ids(data) == ["<urn:x-page:0>", "<urn:x-page:2>"]
    gaps = [(s, e, reason) for s, e, reason, *_ in found if reason]
    assert gaps[0][:2] == (0, 13) and gaps[-1][1] == len(data) and all(g[2] for g in gaps) and len(gaps) == 3
    assert list(warc.salvage(b"")) == [] and [x[:2] for x in warc.salvage(b"\0" * 50)] == [(0, 50)]
    crc = bytearray(records[0])
    crc[-len(warc.EMPTY_MEMBER) - 6] ^= 1
    assert _ids(bytes(crc) + records[1]) == ["<urn:x-page:1>"]


def test_salvage_inside_a_member_of_many_records():
    records = _archive(9, False)
    every = [f"<urn:x-page:{i}>" for i in range(9)]
    bad = bytearray(records[4])
    bad[-9] ^= 1  # in the payload
    hurt = b"".join(records[:4]) + bytes(bad) + b"".join(records[5:])
    # The member is whole, one record in it is not.
    data = warc.gzip_member(hurt) + _archive(1, True)[0]
    assert _ids(data) == [*every[:4], *every[5:], every[0]]
    gaps = [(s, e, reason) for s, e, reason, *_ in warc.salvage(data) if reason]
    assert len(gaps) == 1 and gaps[0][:2] == (0, len(warc.gzip_member(hurt))) and f"bytes {sum(map(len, records[:4]))} to" in gaps[0][2]
    # The member's CRC is wrong, the member is cut short, a bit of it is flipped: what passes its own checks stays.
    whole = warc.gzip_member(b"".join(records))
    crc = whole[:-8] + bytes(4) + whole[-4:]
    assert _ids(crc + records[0]) == [*every, every[0]] and [r[2] for r in warc.salvage(crc) if r[2]]
    noise = [warc.build_record(i, None, p := random.Random(i).randbytes(30000), warc.base32_sha1(p), None, False, "1970-01-01T00:00:00Z") for i in range(9)]
    cut = warc.gzip_member(b"".join(noise))[:150000]
    assert _ids(cut) == every[:4] and any("cut short" in r[2] for r in warc.salvage(cut) if r[2])
    flipped = bytearray(warc.gzip_member(b"".join(noise)))
    flipped[140000] ^= 0x10  # in a stored block: only the digest of one record and the member's CRC see it
    assert set(every[:4]) <= set(_ids(bytes(flipped))) and any(r[2] for r in warc.salvage(bytes(flipped)))


# -------------------------------------------------------------------- URLs
URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://example.com/en/", "https://a.b.example.com/en", "https://www.example.com/en/?://x",
        "http://example.net/fr/a", "http://net/es/", "http://xnet/es/", "http://com", "http://com/", "http://a.com?x", "http://a.com#/en/", "http://x.y://z/", "ftp://.com/",
        "http://com./", "http://\nexample.com/en/\n", "http://example.com/" + "a/" * 5000, "http://" + "a." * 3000 + "com/x", "http://é.com/é"]


def _verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("rules", [url_filter.RULES, (("block", "com", ""), ("allow", "example.com", "/e"), ("block", "b.example.com", "/en"), ("block", "com", "/a/a/"), ("allow", "com", "/a/a/")),
                                   tuple(("block" if n % 2 else "allow", host, "/en/"[:4 - n % 3] + "a" * n) for n in range(60) for host in ("com", "example.com", "a.b.c.d"))])
def test_url_rules(spark, rules):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(3, URLS[5], "x"), (None, URLS[4], "x"), (3, URLS[5], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.judge_urls(df, url_filter.rules_table(spark, rules)).collect()
    assert Counter(map(tuple, got)) == Counter((i, *_verdict(u, rules)) for i, u, _ in rows)
    assert url_filter.judge_urls(df.limit(0), url_filter.rules_table(spark, rules)).count() == 0
    none = url_filter.judge_urls(df, url_filter.rules_table(spark, rules).limit(0), default="block").collect()
    assert {r.verdict for r in none} == {"block"} and len(none) == len(rows)


def test_url_rules_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    rules = url_filter.rules_table(spark)
    want = Counter(map(tuple, url_filter.judge_urls(df, rules).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 2)
    assert Counter(map(tuple, url_filter.judge_urls(df, rules).collect())) == want
