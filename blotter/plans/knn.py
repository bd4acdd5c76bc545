"""Exact k-nearest-neighbour classification as Spark joins over a pyramid of occupied cells.

No pair enumeration: training rows are first collapsed to distinct ``(features, label)`` vectors with a weight (partial
aggregate), query rows to distinct feature vectors.  Space is cut into cubic cells on several levels, each twice as wide as the
one before; the pyramid holds, per level, the cells with at least ``k`` rows and their counts, and is built once.

A query finds the narrowest level on which its own cell holds ``k`` rows (one equi-join).  That gives two radii: the corner
of the cell farthest away, within which ``k`` rows lie for certain, and an estimate from the cell's density, at which the search begins.
A round gives each query the narrowest level on which its radius reaches a bounded number of cells, and joins it with the
training vectors of those cells (whole-number features on the lowest level: the lattice points within the radius).  A query is settled
when its k-th nearest row lies within the radius - everything that near was seen, ties included - or when the cells covered all
data.  Otherwise the distance of the k-th row found is its next radius, which settles it; with fewer than ``k`` rows found the
radius grows once by what the count says is missing, then to the certain one: three rounds at most.  So a query in a sparse region
starts on a wide level and probes no empty cells on the way.  Rounds are separated by checkpoints in the shared checkpoint folder.

Order and votes: neighbours are ordered by squared distance, then by the training vector and label (a total order); a vector of
weight ``n`` counts as ``n`` rows and the k-th row may take part of its weight.  The predicted label has the most votes; ties go to
the smallest label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.topk import top_k
from ..session import cut_lineage

# Low-dimensional features only (the category model uses five): the probe
# set grows as 3^d.
MAX_DIMS = 8
#: Rows that the first radius is expected to hold, as a multiple of k.
AIM = 1.3
#: Cells that a query may probe, if the neighbouring ones are not more.
MOST_CELLS = 350
#: Room for rounding in the distance of a cell, as a share of its width.
ROOM = 1e-9
INFINITE = float("inf")


def _reach(width: float, tail: float, dims: int, most: int) -> tuple[list[tuple[float, ...]], float]:
    """Offsets of cells, each with the square of its least distance from any place in the middle cell, nearest first, and the
    square of a radius below which the list is complete: as far as it has at most ``most`` offsets, and at least the
    neighbouring cells."""
    gaps = [0.0, *((n * width + tail) ** 2 for n in range(most))]  # by the size of the offset along one axis
    bound = dims * gaps[1] + gaps[2]
    while True:
        found: list[tuple[float, ...]] = [(0.0,)]
        for _ in range(dims):
            found = [(f[0] + gaps[abs(o)], *f[1:], o) for f in found for o in _steps(gaps, bound - f[0])]
        if len(found) > max(most, 3 ** dims):
            break
        bound *= 2
    found.sort()
    end = max(most, 3 ** dims)
    limit = found[end][0]
    return [f for f in found if f[0] < limit], limit


def _steps(gaps: Sequence[float], room: float) -> range:
    """Offsets along one axis whose least distance squared is within ``room``."""
    n = 0
    while n + 1 < len(gaps) and gaps[n + 1] <= room:
        n += 1
    return range(-n, n + 1)


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small local table, handed to the JVM as one Arrow table (no Python worker starts for it)."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    return spark.createDataFrame(pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields]))


def knn_vectors(train: DataFrame, queries: DataFrame, features: Sequence[str], label: str, k: int = 25,
                cell: float | None = None) -> DataFrame:
    """Prediction per distinct query feature vector: ``(features..., prediction)``.

    ``cell`` is the width of the lowest level (default: from the data
    density); it changes the work, never the answer."""
    features = list(features)
    d = len(features)
    if d > MAX_DIMS:
        raise ValueError(f"grid kNN probes 3^d cells; {d} features is beyond the supported {MAX_DIMS}")
    spark, qf = train.sparkSession, [f"q_{f}" for f in features]
    tw = train.select(*features, label).dropna().groupBy(*features, label).agg(F.count(F.lit(1)).alias("_w"))
    tw = cached = tw.persist(StorageLevel.MEMORY_AND_DISK)
    asked = queries.select(*[F.col(f).alias(q) for f, q in zip(features, qf)]).dropna().distinct()
    asked = cut_lineage(asked.withColumn("_qid", F.monotonically_increasing_id()))

    # One row of facts: ranges over training and query vectors, whole numbers or not, total weight, label range.
    integral_label = dict(tw.dtypes)[label] in ("int", "bigint", "smallint", "tinyint")
    code = F.col(label).cast("bigint") if integral_label else F.lit(None).cast("bigint")
    both = tw.select(*features, "_w", code.alias("_l")).unionByName(
        asked.select(*[F.col(q).alias(f) for f, q in zip(features, qf)], F.lit(0).cast("bigint").alias("_w"), F.lit(None).cast("bigint").alias("_l")))
    facts = both.agg(F.sum("_w").alias("total"), F.min("_l").alias("llo"), F.max("_l").alias("lhi"),
                     *[F.min(f).alias(f"lo{i}") for i, f in enumerate(features)], *[F.max(f).alias(f"hi{i}") for i, f in enumerate(features)],
                     *[F.max(F.abs(F.col(f) - F.floor(F.col(f)))).alias(f"frac{i}") for i, f in enumerate(features)]).first()
    if facts["lo0"] is None or not facts["total"]:
        cached.unpersist()
        return asked.select(*[F.col(q).alias(f) for f, q in zip(features, qf)], F.lit(None).cast("int").alias("prediction"))
    lo = [float(facts[f"lo{i}"]) for i in range(d)]
    hi = [float(facts[f"hi{i}"]) for i in range(d)]
    span = [h - lw for lw, h in zip(lo, hi)]
    integral = all((facts[f"frac{i}"] or 0) == 0 for i in range(d))
    total = float(facts["total"])

    # Tie order (training vector, then label) as one long when the vectors
    # and labels are small integers: candidate rows then carry four narrow
    # columns into the sort instead of every feature.
    tie_cols = [F.col(f) for f in features] + [F.col(label)]
    order = [F.col("_d2"), *tie_cols]
    packed_tie = False
    if integral_label and integral:
        radix = [int(s) + 1 for s in span] + [int(facts["lhi"]) - int(facts["llo"]) + 1]
        if packed_tie := math.prod(radix) < 2 ** 62:
            tie = F.lit(0).cast("bigint")
            for c, base, r in zip(tie_cols, [*lo, float(facts["llo"])], radix):
                tie = tie * F.lit(r) + (c - F.lit(int(base))).cast("bigint")
            tw = tw.withColumn("_tie", tie)
            order = [F.col("_d2"), F.col("_tie")]
    by_query = Window.partitionBy("_qid").orderBy(*order)
    upto = by_query.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # Levels: from about a quarter of the side of a cube that holds k rows at the mean density, to one cell for everything.
    step = 1.0 if integral else 0.0
    wide = [s + step for s in span if s > 0]
    if cell is None:
        side = (k * math.prod(wide) / total) ** (1.0 / max(len(wide), 1)) if wide else 1.0
        cell = max(2.0 ** math.floor(math.log2(max(side / 4, 1e-300))), 1.0 if integral else max([*span, 1.0]) * 1e-9)
    widths = [float(cell)]
    while widths[-1] <= max(span):
        widths.append(widths[-1] * 2)
    top = len(widths) - 1
    # In a cell of whole width and whole numbers, nothing lies within the last unit.
    tail = 1.0 if integral and widths[0] == int(widths[0]) else 0.0
    n_cells = [int(span[i] // widths[0]) + 1 for i in range(d)]
    radix = [n + 2 for n in n_cells]
    packed = math.prod(radix) < 2 ** 62
    mults = [math.prod(radix[:i]) for i in range(d)]

    def room(i: int, level: int) -> float:
        """What a distance along an axis may be off by."""
        return ROOM * (widths[level] + 1e-3 * max(abs(lo[i]), abs(hi[i])))

    def base_cell(name: str, i: int) -> Column:
        return F.floor((F.col(name) - F.lit(lo[i])) / F.lit(widths[0])).cast("bigint")

    def key(cells: list[Column]) -> Column:
        """Collision-free key of a cell within its level."""
        if not packed:
            return F.array(*cells)
        return sum(((c + 1) * F.lit(m) for c, m in zip(cells, mults)), F.lit(0).cast("bigint"))

    def on_level(names: Sequence[str], level: str) -> list[Column]:
        """Cell numbers on the level in column ``level``, from those on the lowest."""
        return [F.expr(f"shiftright({n}, {level})") for n in names]

    level_widths = F.broadcast(_local(spark, list(enumerate(widths)), "_level int, _width double"))  # one row a level

    b = [f"_b{i}" for i in range(d)]
    every = F.explode(F.array(*[F.lit(n) for n in range(top + 1)]))
    tw = tw.withColumns({b[i]: base_cell(f, i) for i, f in enumerate(features)})
    asked = asked.withColumns({b[i]: base_cell(q, i) for i, q in enumerate(qf)})

    # The pyramid: cells with k rows or more, and each query's narrowest one.
    cells = tw.groupBy(*b).agg(F.sum("_w").alias("_n")).withColumn("_level", every)
    cells = (cells.select("_level", key(on_level(b, "_level")).alias("_key"), "_n").groupBy("_level", "_key").agg(F.sum("_n").alias("_n"))
             .filter(F.col("_n") >= k))
    own = asked.select("_qid", *b, every.alias("_level")).select("_qid", "_level", key(on_level(b, "_level")).alias("_key"))
    narrowest = own.join(cells, ["_level", "_key"]).groupBy("_qid").agg(F.min(F.struct("_level", "_n")).alias("_m"))
    start = asked.join(narrowest.select("_qid", F.col("_m._level").alias("_level"), "_m._n"), "_qid", "left").join(level_widths, "_level", "left")
    w = F.col("_width")
    corner, volume = F.lit(0.0), F.lit(1.0)
    for i, q in enumerate(qf):
        low = F.lit(lo[i]) + on_level([b[i]], "_level")[0] * w
        far = F.greatest(F.col(q) - low, low + w - F.lit(tail) - F.col(q))
        corner = corner + far * far
        if span[i] > 0:
            volume = volume * F.least(w, F.lit(span[i] + step))
    dims = max(len(wide), 1)
    unit = math.pi ** (dims / 2) / math.gamma(dims / 2 + 1)
    guess = F.pow(F.lit(AIM * k / unit) * volume / F.col("_n"), F.lit(2.0 / dims))
    never = F.col("_level").isNull()  # fewer than k rows in all
    pending = cut_lineage(start.withColumns({
        "_most": F.when(never, INFINITE).otherwise(corner * (1 + ROOM)),
        "_r2": F.when(never, INFINITE).otherwise(F.least(guess, corner * (1 + ROOM)))}).drop("_level", "_width", "_n"))

    # Per level the cells around one, by distance, and the radius up to which they do.
    open_dims = [[i for i in range(d) if span[i] >= w] for w in widths]
    around = [_reach(w, tail, len(dims_), MOST_CELLS) if dims_ else ([(0.0,)], INFINITE) for w, dims_ in zip(widths, open_dims)]

    results: list[DataFrame] = []
    while True:
        # The narrowest level on which the listed cells hold all that the radius reaches.
        level = F.lit(top)
        for n in range(top - 1, -1, -1):
            level = F.when(F.col("_r2") < F.lit(around[n][1]), n).otherwise(level)
        pending = pending.withColumn("_level", level)
        # Queries that wait, by level: at most one row per level.
        waiting = {r["_level"]: r["count"] for r in pending.groupBy("_level").count().collect()}
        if not waiting:
            break
        spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, sum(waiting.values()) // 4096))
        pending, used = pending.repartition(spread, "_qid"), sorted(waiting)
        # Offsets of a level (at most MOST_CELLS, or 3^d) with what they add to the key and, per axis, the sign and the constant of
        # the distance between the query's place in its cell and the other cell.
        axes, listed = open_dims[0], []
        for n in used:
            for least, *steps in around[n][0]:
                offset = [0] * d
                for i, o in zip(open_dims[n], steps):
                    offset[i] = o
                move = sum(o * m for o, m in zip(offset, mults)) if packed else 0
                near_by = [(offset[i], float((offset[i] > 0) - (offset[i] < 0)),
                            (offset[i] if offset[i] > 0 else abs(offset[i]) - 1) * widths[n] * 1.0 + (tail if offset[i] < 0 else 0.0)
                            - room(i, n) if offset[i] else 0.0) for i in axes]
                listed.append((n, least, move, *(x for one in near_by for x in one)))
        offsets = _local(spark, listed, "_level int, _least double, _move bigint" + "".join(
            f", _o{i} int, _s{i} double, _t{i} double" for i in axes))
        at = pending.join(level_widths, "_level").withColumns({f"_c{i}": c for i, c in enumerate(on_level(b, "_level"))})
        at = at.select("_qid", *qf, "_level", "_r2", *([] if packed else [f"_c{i}" for i in range(d)]),
                       key([F.col(f"_c{i}") for i in range(d)]).alias("_own"),
                       *[F.col(f"_c{i}").alias(f"_n{i}") for i in axes],
                       *[(F.floor(F.lit(span[i]) / F.col("_width")) - F.col(f"_c{i}")).alias(f"_m{i}") for i in axes],
                       *[(F.col(qf[i]) - F.lit(lo[i]) - F.col(f"_c{i}") * F.col("_width")).alias(f"_p{i}") for i in axes])
        probes = at.join(F.broadcast(offsets), (at["_level"] == offsets["_level"]) & (F.col("_least") <= F.col("_r2"))).drop(offsets["_level"])
        inside, gaps = F.lit(True), F.lit(0.0)
        for i in axes:
            inside = inside & (F.col(f"_o{i}") + F.col(f"_n{i}") >= 0) & (F.col(f"_o{i}") <= F.col(f"_m{i}"))
            gap = F.col(f"_t{i}") - F.col(f"_s{i}") * F.col(f"_p{i}")
            gaps = gaps + gap * gap
        probes = probes.filter(inside & (gaps <= F.col("_r2")))
        there = F.col("_own") + F.col("_move") if packed else F.array(*[
            F.col(f"_c{i}") + F.col(f"_o{i}") if i in axes else F.col(f"_c{i}") for i in range(d)])
        probes = probes.select("_qid", *qf, "_level", there.alias("_key"))
        stored = tw.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in used])))
        stored = stored.withColumn("_key", key(on_level(b, "_level"))).drop(*b)
        cand = probes.join(stored, ["_level", "_key"])
        # Doubles before the product: squares of integer differences overflow.
        gap = [F.col(q).cast("double") - F.col(f).cast("double") for f, q in zip(features, qf)]
        cand = cand.withColumn("_d2", sum((g * g for g in gap), F.lit(0.0)))
        cand = cand.select("_qid", "_d2", *(["_tie"] if packed_tie else features), label, "_w")
        # row_number <= k: Spark limits each group per map task before the
        # shuffle (WindowGroupLimit); weights >= 1 so k rows always reach
        # weight k.
        near = (cand.withColumn("_rn", F.row_number().over(by_query)).filter(F.col("_rn") <= k)
                .withColumn("_cum", F.sum("_w").over(upto))
                .withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_w"), F.lit(k) - (F.col("_cum") - F.col("_w")))))
                .persist(StorageLevel.MEMORY_AND_DISK))
        stats = near.groupBy("_qid").agg(F.min(F.when(F.col("_cum") >= k, F.col("_d2"))).alias("_kth"), F.max("_cum").alias("_found"))
        known = pending.join(stats, "_qid", "left")
        settled = F.coalesce(F.col("_kth") <= F.col("_r2"), F.lit(False)) | (F.col("_level") == top)
        votes = near.filter(F.col("_take") > 0).groupBy("_qid", label).agg(F.sum("_take").alias("_votes"))
        best = top_k(votes, ["_qid"], [F.desc("_votes"), F.asc(label)], k=1).select("_qid", F.col(label).alias("prediction"))
        known = cut_lineage(known.withColumn("_settled", settled).join(best, "_qid", "left"))
        near.unpersist()
        results.append(known.filter("_settled").select(*qf, "prediction"))
        # The k-th row found bounds the k-th distance.  Without one: once halfway (by ratio) to the certain radius or as far as the
        # rows found so far call for, then to the certain one.
        missing = F.pow(F.lit(AIM * k) / F.greatest(F.coalesce(F.col("_found"), F.lit(0)), F.lit(1)), F.lit(2.0 / dims))
        halfway = F.greatest(F.sqrt(F.col("_r2") * F.col("_most")), F.col("_r2") * missing + F.lit(tail))
        grown = F.least(halfway, F.col("_most")) if len(results) == 1 else F.col("_most")
        pending = (known.filter(~F.col("_settled")).withColumn("_r2", F.coalesce("_kth", grown))
                   .drop("_kth", "_found", "_settled", "prediction", "_level"))
    cached.unpersist()
    if not results:
        return asked.select(*[F.col(q).alias(f) for f, q in zip(features, qf)], F.lit(None).cast("int").alias("prediction"))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(q).alias(f) for f, q in zip(features, qf)], "prediction")


def knn_predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, k: int = 25,
                cell: float | None = None) -> DataFrame:
    """``test`` rows with a ``prediction`` column (null if a feature is null
    or the training set is empty)."""
    preds = knn_vectors(train, test, features, label, k, cell)
    return test.join(preds, list(features), "left")
