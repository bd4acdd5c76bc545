"""Centroid clustering against plain Python integers."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest

from blotter.llm import centroids as ct

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, id string, distance double"


def _single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, clusters, rounds, size, scale=64):
    kept = []
    for row in rows:
        v = row[1]
        if v is not None and len(v) == size and all(x is not None and math.isfinite(_single(x)) for x in v):
            kept.append((row[0], [math.floor(scale * _single(x)) for x in v], v))
    mark = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v, _ in sorted(kept, key=lambda r: (mark(r[0]), r[2]))[:clusters]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((distance(v, c), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v, _ in kept]
        for c in set(own):
            mine = [v for (_, v, _), o in zip(kept, own) if o == c]
            cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(v)) for i, v, _ in kept]
    fits = lambda x: x if x < 1 << 63 else None
    sums = {c: sum(d for _, d, o in last if o == c) for c in range(len(cents))}
    if any(fits(d) is None for _, d, _ in last):  # a sum with an unknown distance is unknown
        sums = {c: None if any(fits(d) is None for _, d, o in last if o == c) else s for c, s in sums.items()}
        total = None
    else:
        total = fits(sum(sums.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, fits(d), None if sums[c] is None else fits(sums[c]), total, digest[c]) for i, d, c in last), key=str)


def _rows(rng, n, size, spread=1.0):
    middle = [[rng.gauss(0, 3) for _ in range(size)] for _ in range(5)]
    out = []
    for i in range(n):
        m = rng.choice(middle)
        out.append((i * 7, [x + rng.gauss(0, spread) for x in m], 0, 1, "x", None))
    return out


def _odd(rng, size):
    rows = _rows(rng, 120, size)
    bad = [None, [], [0.5] * (size - 1), [0.5] * (size + 1), [None] + [0.5] * (size - 1), [float("nan")] * size, [float("inf")] + [0.0] * (size - 1)]
    rows += [(1000 + i, v, None, None, None, None) for i, v in enumerate(bad)]
    rows += [(None, [0.25] * size, 1, 1, "a", 0.0), (None, [0.25] * size, 1, 1, "a", 0.0), (None, [-0.25] * size, 1, 1, "a", 0.0)]
    rows += [rows[0]] * 60 + [(5, [0.0] * size, 1, 1, "a", 0.0), (5, [-0.0] * size, 1, 1, "b", 0.0)]
    rng.shuffle(rows)
    return rows


def _got(spark, rows, **options):
    out = ct.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted([tuple(r) for r in out.collect()], key=str)


@pytest.mark.parametrize("size, clusters, rounds, pivots", [(64, 16, 3, 8), (3, 6, 2, 8), (1, 4, 3, 2), (8, 5, 0, 1)])
def test_against_brute_force(spark, size, clusters, rounds, pivots):
    rows = _odd(random.Random(size), size)
    assert _got(spark, rows, clusters=clusters, rounds=rounds, size=size, pivots=pivots) == brute(rows, clusters, rounds, size)


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = _rows(rng, 40, 4) + [(900 + i, [rng.choice([1e9, -3e12, 2.5e7, 0.1]) for _ in range(4)], 0, 0, "", None) for i in range(20)]
    assert _got(spark, rows, clusters=6, rounds=3, size=4) == brute(rows, 6, 3, 4)
    rows += [(990 + i, [3e38, -3e38, 1.0, float(i)], 0, 0, "", None) for i in range(3)]
    assert _got(spark, rows, clusters=6, rounds=2, size=4) == brute(rows, 6, 2, 4)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 4, 0, 0, "", None) for i in range(3)]
    assert _got(spark, rows, clusters=16, size=4) == brute(rows, 16, 3, 4)
    same = [(1, [0.5] * 4, 0, 0, "", None)] * 50
    assert _got(spark, same, clusters=4, size=4) == brute(same, 4, 3, 4)
    assert _got(spark, [], size=4) == []
    assert _got(spark, [(1, None, 0, 0, "", None)], size=4) == []


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(4)
    middle = rng.integers(-400, 400, (16, 64))
    vectors = middle[rng.integers(0, 16, 3000)] + rng.integers(-20, 20, (3000, 64))
    simplex = ct.Simplex(middle)
    assert simplex.size == 8
    a, t = simplex.apexes(vectors), simplex.apexes(middle)
    true = np.sqrt(((vectors[:, None] - middle[None]) ** 2).sum(axis=2))
    flat = ((a[:, None, :-1] - t[None, :, :-1]) ** 2).sum(axis=2)
    assert (np.sqrt(flat + (a[:, None, -1] - t[None, :, -1]) ** 2) <= true + 1e-6).all()
    assert (np.sqrt(flat + (a[:, None, -1] + t[None, :, -1]) ** 2) >= true - 1e-6).all()
    which, least, compared = ct.nearest(vectors, a, middle, t)
    assert (which == true.argmin(axis=1)).all() and (least == (true.min(axis=1) ** 2).round().astype(int)).all()
    assert compared < 0.5 * true.size
