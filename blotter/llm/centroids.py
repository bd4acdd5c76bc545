"""Centroid clustering of whole-number vectors, with n-simplex projections as the filter.

A vector is kept if it has the asked number of components, none null or non-finite; a component x becomes floor(scale * x).
Distances to a few pivots (some of the first centroids, in general position) are taken once per vector and kept: they are the
edge lengths of a simplex over the pivots, and the coordinates of its apex are the vector's projection.  For two apexes the
Euclidean distance is a lower bound of the true distance, and with the last coordinate (the height over the pivots' span)
turned over it is an upper bound.  In a round every vector meets the centroids' apexes first; a centroid whose lower bound lies above the
least upper bound cannot be the nearest, and the rest are compared exactly, in whole numbers.  The bounds leave room for
rounding, so the result is that of comparing all.

The kept vectors with their apexes are one table in the shared checkpoint folder; a round is one pass over it that returns a
partial sum per task and centroid, added up by Spark.  Only centroids (their number times the number of components, both
parameters) reach the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Sums travel as multiples of this and a rest, so that they fit Spark's decimals.
BASE = 10**30
#: Components of vectors of doubles from here on count as non-finite (those of floats are all below).
MOST = 1e50
#: Room left for rounding in the bounds, as a share of the largest distance.
ROOM = 1e-6
PIVOTS = 8
ROWS = 2048
LONG = (1 << 63) - 1


def narrow(size: int) -> int:
    """Components up to this are compared as 64-bit integers (the distance of ``size`` of them fits), larger ones as Python integers."""
    return int((2**62 / max(size, 1)) ** 0.5) // 2


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of a matrix of doubles: 64-bit integers, or Python integers if some are large."""
    scaled = np.floor(values * scale)
    if scaled.size == 0 or np.abs(scaled).max() <= narrow(values.shape[1]):
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` and ``b``, pair by pair."""
    if a.dtype == object or b.dtype == object:
        a, b = a.astype(object), b.astype(object)
    gap = a - b
    return (gap * gap).sum(axis=1)


class Simplex:
    """Apex coordinates over pivots in general position."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        chosen: list[int] = []
        rows: list[np.ndarray] = []
        span = max((float(np.sqrt(float(squared(points[:1], p[None])[0]))) for p in points), default=0.0)
        for i, p in enumerate(points):
            if not chosen:
                chosen.append(i)
                continue
            # Coordinates of this pivot over those before it; too low a height would blow up rounding.
            apex = self._solve(np.array(rows).reshape(len(rows), len(rows)),
                               np.array([[float(d) for d in squared(points[chosen], np.repeat(p[None], len(chosen), 0))]]))[0]
            if apex[-1] > 1e-2 * span and len(chosen) < most:
                rows = [np.append(r, 0.0) for r in rows] + [apex]
                chosen.append(i)
        self.points = points[chosen]
        self.base = np.array(rows).reshape(len(rows), len(rows))
        self.size = len(chosen)

    @staticmethod
    def _solve(base: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Apexes from squared distances to the pivots; ``base`` holds the coordinates of the pivots after the first."""
        n = len(base)
        right = (squares[:, :1] + (base * base).sum(axis=1)[None] - squares[:, 1:]) / 2
        flat = np.linalg.solve(base, right.T).T if n else right
        height = np.sqrt(np.maximum(squares[:, 0] - (flat * flat).sum(axis=1), 0.0))
        return np.concatenate([flat, height[:, None]], axis=1)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """One apex per row of ``vectors``."""
        squares = np.empty((len(vectors), self.size))
        for j, pivot in enumerate(self.points):
            squares[:, j] = squared(vectors, np.repeat(pivot[None], len(vectors), 0)).astype(float)
        return self._solve(self.base, squares)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller) and the exact squared distance of every vector; and how many exact
    comparisons that took.  ``apexes`` and ``tops`` are the projections of vectors and centroids."""
    flat = ((apexes[:, None, :-1] - tops[None, :, :-1]) ** 2).sum(axis=2)
    low = np.sqrt(flat + (apexes[:, None, -1] - tops[None, :, -1]) ** 2)
    high = np.sqrt(flat + (apexes[:, None, -1] + tops[None, :, -1]) ** 2)
    room = ROOM * (1.0 + high.max(axis=1))
    at, which = np.nonzero(low - room[:, None] <= (high.min(axis=1) + room)[:, None])  # by vector, then by centroid
    exact = squared(vectors[at], centroids[which])
    begins = np.searchsorted(at, np.arange(len(vectors)))
    least = np.minimum.reduceat(exact, begins)
    hit = np.flatnonzero(exact == least[at])
    first = hit[np.searchsorted(at[hit], np.arange(len(vectors)))]
    return which[first], least, len(exact)


def _kept(components: str, size: int) -> Column:
    """Whether a vector has ``size`` components, all finite."""
    fine = F.forall(F.col(components), lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(MOST), F.lit(False)))
    return F.coalesce((F.size(components) == size) & fine, F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), size)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def project(vectors: DataFrame, simplex: Simplex, size: int, scale: float) -> DataFrame:
    """``id, components, apex`` of kept vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            apex = simplex.apexes(whole(_matrix(batch.column(1), size), scale))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(apex) + 1) * simplex.size, pa.int32()), pa.array(apex.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "components", "apex"])

    return vectors.mapInArrow(run, "id long, components array<double>, apex array<double>")


def _assign(batch: pa.RecordBatch, centroids: np.ndarray, tops: np.ndarray, size: int, scale: float) -> tuple:
    vectors = whole(_matrix(batch.column(1), size), scale)
    return vectors, *nearest(vectors, _matrix(batch.column(2), tops.shape[1]), centroids, tops)


def partial_sums(projected: DataFrame, centroids: np.ndarray, tops: np.ndarray, size: int, scale: float) -> DataFrame:
    """``cluster, axis, high, low, n`` of every task: component sums as ``high * BASE + low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), size), dtype=object)
        counts = np.zeros(len(centroids), np.int64)
        for batch in _slices(batches):
            vectors, cluster, _, _ = _assign(batch, centroids, tops, size, scale)
            for c in np.unique(cluster):
                mine = vectors[cluster == c]
                sums[c] += mine.sum(axis=0).astype(object)
                counts[c] += len(mine)
        rows = [(c, a, *divmod(int(sums[c, a]), BASE), int(counts[c])) for c in np.flatnonzero(counts).tolist() for a in range(size)]
        wide = pa.decimal128(38, 0)
        columns = zip([*zip(*rows)] or [()] * 5, [pa.int32(), pa.int32(), wide, wide, pa.int64()])
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in columns], names=["cluster", "axis", "high", "low", "n"])

    return projected.mapInArrow(run, "cluster int, axis int, high decimal(38,0), low decimal(38,0), n long")


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centroids after a round: floor of the mean of their vectors, unchanged without any."""
    total = sums.groupBy("cluster", "axis").agg(
        F.sum("high").cast("string").alias("high"), F.sum("low").cast("string").alias("low"), F.sum("n").alias("n"))
    new = [[int(x) for x in row] for row in centroids]
    for row in total.collect():  # number of centroids x components
        new[row["cluster"]][row["axis"]] = (int(row["high"]) * BASE + int(row["low"])) // row["n"]
    return narrowed(new)


def narrowed(rows: list[list[int]]) -> np.ndarray:
    """Whole numbers as 64-bit integers, or as Python integers if some are large."""
    large = any(abs(x) > narrow(len(row)) for row in rows for x in row)
    return np.array(rows, dtype=object if large else np.int64)


def assigned(projected: DataFrame, centroids: np.ndarray, tops: np.ndarray, size: int, scale: float) -> DataFrame:
    """``id, cluster, distance`` per vector; a distance beyond a long is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            _, cluster, distance, _ = _assign(batch, centroids, tops, size, scale)
            if distance.dtype == object:
                distance = [None if d > LONG else int(d) for d in distance]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance, pa.int64())],
                                             names=["id", "cluster", "distance"])

    return projected.mapInArrow(run, "id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, clusters: int, seed: int, size: int, scale: float) -> np.ndarray:
    """The ``clusters`` vectors with the smallest SHA-256 of ``<seed>:<id>`` (a null id: ``<seed>:``), equal hashes by components."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    least = vectors.select(mark.alias("mark"), "components").orderBy("mark", "components").limit(clusters).collect()
    values = np.array([r["components"] for r in least], dtype=float).reshape(len(least), size)
    return narrowed([[int(x) for x in row] for row in whole(values, scale)])


def cluster_vectors(df: DataFrame, clusters: int = 16, rounds: int = 3, size: int = 64, scale: float = 64.0, seed: int = 1,
                    pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector of ``df``.

    Centroids start as :func:`first_centroids`; each round assigns all vectors to the nearest one (squared Euclidean
    distance, ties to the smaller number) and moves it to the floor of its vectors' mean; a last pass assigns once more.
    ``centroid_sha256`` is of the final components, joined by commas.

    Null vectors, other lengths, null and non-finite components: the row is not kept.  Null and repeated ids: one row out per
    kept row.  Fewer kept vectors than ``clusters``: as many centroids as vectors; none (also an empty table): no rows.  Equal
    vectors may start several centroids; the smallest number wins.  A distance or sum beyond a long is null.  Other columns,
    whatever their names, are not read."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/centroids-{uuid.uuid4().hex}"
    vectors = (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("components"))
               .filter(_kept("components", size)).select("id", F.col("components").cast("array<double>").alias("components")))
    centroids = first_centroids(vectors, clusters, seed, size, scale)
    if not len(centroids):
        return vectors.select(F.col("id").alias("vec_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    simplex = Simplex(centroids, pivots)
    project(vectors, simplex, size, scale).write.parquet(f"{folder}/projected")
    projected = spark.read.parquet(f"{folder}/projected")
    for _ in range(rounds):
        centroids = moved(centroids, partial_sums(projected, centroids, simplex.apexes(centroids), size, scale))
    assigned(projected, centroids, simplex.apexes(centroids), size, scale).write.parquet(f"{folder}/assigned")
    out = spark.read.parquet(f"{folder}/assigned")

    # One row per centroid: its sums and digest.
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("string").alias("s"),
                                      F.count_if(F.col("distance").isNull()).alias("unknown")).collect()
    own = {r["cluster"]: None if r["unknown"] else int(r["s"]) for r in sums}
    fits = lambda x: x if x is not None and x <= LONG else None
    total = None if None in own.values() else sum(own.values())
    rows = [(c, fits(own.get(c, 0)), fits(total), hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest())
            for c, row in enumerate(centroids)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """The whole ``embeddings`` table: 16 centroids, three rounds."""
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _round(n: int) -> str:
    """One round in SQL: assignment, exact floor of the mean, centroids without vectors as they were."""
    return f"""
near{n} AS (SELECT v.row_no, arg_min(c.no, {_distance("v.v", "c.c")} * 16 + c.no) AS no
            FROM kept v, cent{n} c GROUP BY v.row_no),
sums{n} AS (SELECT n.no, t.axis, sum(t.x) AS s, count(*) AS m FROM near{n} n JOIN flat t USING (row_no) GROUP BY n.no, t.axis),
mean{n} AS (SELECT no, list((s - ((s % m) + m) % m) // m ORDER BY axis) AS c FROM sums{n} GROUP BY no),
cent{n + 1} AS (SELECT c.no, coalesce(list_transform(m.c, lambda x: CAST(x AS BIGINT)), c.c) AS c FROM cent{n} c LEFT JOIN mean{n} m USING (no))"""


OP12_SQL = f"""
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
kept AS MATERIALIZED (
  SELECT vec_id, v, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS row_no FROM fine),
flat AS MATERIALIZED (SELECT row_no, unnest(range(64)) AS axis, unnest(v) AS x FROM kept),
cent0 AS MATERIALIZED (SELECT row_no AS no, v AS c FROM kept WHERE row_no < 16),
{",".join(_round(n).replace(" AS (", " AS MATERIALIZED (") for n in range(3))},
last AS MATERIALIZED (
  SELECT v.row_no, v.vec_id, arg_min(c.no, {_distance("v.v", "c.c")} * 16 + c.no) AS no,
         min({_distance("v.v", "c.c")}) AS distance FROM kept v, cent3 c GROUP BY v.row_no, v.vec_id)
SELECT l.vec_id, CAST(l.no AS INTEGER) AS cluster, CAST(l.distance AS BIGINT) AS distance,
       CAST(sum(l.distance) OVER (PARTITION BY l.no) AS BIGINT) AS cluster_inertia,
       CAST(sum(l.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM last l JOIN cent3 c ON c.no = l.no
"""
