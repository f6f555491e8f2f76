"""Station clusters (M8, M25): k-means over coordinates, many fits side by side.

A fit is one group of stations (all of them, or those of one holiday), one k and one restart.  All fits go through
the same Spark jobs: starts by farthest points, then Lloyd's steps as aggregates keyed by fit and centre.  Both read
the distinct places only, and a task sends one row for each fit and centre.  Coordinates
are whole millionths of a degree, so sums and moves are exact, and the result is the same for any split of the input and in any engine.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokecast.functions import geo
from spokecast.session import cut_lineage

# Clusters, seed and restarts of the dimension.
CLUSTERS = 30
SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300
#: A fit ends when the squares of its centres' moves, in steps, sum up to no more than this one's.
STILL = 500
#: Centres of all fits that go through the jobs together; beyond it groups are fitted in turns.
CENTRES_AT_ONCE = 100_000
#: Steps to a degree; positions are shifted to be positive.
STEPS = 1_000_000
CENTRES = "array<struct<x:bigint,y:bigint>>"
#: Distances that a task holds at a time, if no group has more centres, and the greatest way along an axis.
CELLS = 1 << 17
FARTHEST = (1 << 31) - 1
HALF = 32


def _position(degrees: str, shift: int) -> Column:
    return F.round((F.col(degrees) + shift) * STEPS).cast("bigint")


def _squared(centre: Column) -> Column:
    return (F.col("x") - centre["x"]) * (F.col("x") - centre["x"]) + (F.col("y") - centre["y"]) * (F.col("y") - centre["y"])


def grouped_clusters(
    stations: DataFrame,
    by: Sequence[str] = (),
    ks: Sequence[int] = (CLUSTERS,),
    seed: int = SEED,
    restarts: int = RESTARTS,
    max_iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """Label, centroid and distance to it for every located station of every group and every k (K2, K3, K1, C14).

    A group's first centre is the station with the least hash of its id and the restart's seed; each next one is the
    station farthest from those before, ties to the greater latitude and then longitude.  A station belongs to the
    nearest centre, ties to the first; a centre moves to the mean of its members, rounded down to a millionth of a
    degree, and stays where it is without members; a fit ends when all moves together are below ``STILL``.  Of the restarts the cheapest fit wins, ties to the first.  A group
    with fewer places than k has as many clusters as places.  Stations without coordinates or id are left out.

    The located stations are written once to the shared folder, so no step rescans trips.  The driver holds the
    centres of ``CENTRES_AT_ONCE`` at most, or of one group; groups are numbered in the order of their keys.
    """
    located = stations.filter("latitude is not null and longitude is not null and station_id is not null").select(
        *by, "station_id", "station_name", "latitude", "longitude"
    )
    located = cut_lineage(located.withColumns({"x": _position("latitude", 90), "y": _position("longitude", 180)}))
    if by:
        order = [F.col(c).asc_nulls_first() for c in by]
        keys = cut_lineage(located.select(*by).distinct().withColumn("g", F.row_number().over(Window.orderBy(*order))))
        same = reduce(lambda a, b: a & b, [located[c].eqNullSafe(keys[c]) for c in by])
        points = located.join(keys.select("g", *by), same).select("g", *[located[c] for c in located.columns])
        groups = keys.count()
    else:
        points, groups = located.withColumn("g", F.lit(1)), 1
    turns = -(-groups * sum(ks) * restarts // CENTRES_AT_ONCE) or 1
    parts = [_fitted(points.where(F.col("g") % turns == i) if turns > 1 else points, by, ks, seed, restarts, max_iterations) for i in range(turns)]
    return reduce(DataFrame.unionAll, parts)


def _frame(points: DataFrame, rows: Iterable[tuple]) -> DataFrame:
    return points.sparkSession.createDataFrame(list(rows), f"g int, k int, restart int, centres {CENTRES}")


def _blocks(batches: Iterable[pa.RecordBatch], groups: dict[int, tuple]) -> Iterator[tuple]:
    """Some places of a group at a time: the numbers of its fits, where each fit's centres begin, ``x``, ``y`` and ``n`` of
    the places, and the square of the distance of each place (row) to each centre (column)."""
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("g", "x", "y", "n")]
        order = np.argsort(columns[0], kind="stable")
        g, *places = (c[order] for c in columns)
        cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b or int(g[a]) not in groups:
                continue
            numbers, first, centres = groups[int(g[a])]
            step = max(1, CELLS // centres.shape[1])
            for i in range(a, b, step):
                x, y, n = (c[i : min(i + step, b)] for c in places)
                for own, others in ((x, centres[0]), (y, centres[1])):
                    if max(int(own.max()) - int(others.min()), int(others.max()) - int(own.min())) > FARTHEST:
                        raise OverflowError("places too far apart for 64-bit distances")
                d, e = x[:, None] - centres[0], y[:, None] - centres[1]
                d *= d
                e *= e
                d += e
                yield numbers, first, x, y, n, d


def _over(places: DataFrame, fits: Sequence[tuple[int, list[tuple[int, int]]]], work: Callable, schema: str) -> tuple:
    """``work`` on the places of every task with the numbered ``fits``, each a group and its centres; and what was sent for it."""
    held: dict[int, list[int]] = {}
    for number, (g, _) in enumerate(fits):
        held.setdefault(g, []).append(number)
    groups = {}
    for g, numbers in held.items():
        first = np.cumsum([0, *(len(fits[f][1]) for f in numbers)])
        groups[g] = numbers, first, np.array([c for f in numbers for c in fits[f][1]], np.int64).T
    sent = places.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield work(_blocks(batches, sent.value))

    return places.mapInArrow(run, schema), sent


FAR = "f int, d bigint, x bigint, y bigint"


def _far(blocks: Iterator[tuple]) -> pa.RecordBatch:
    """For each fit the place farthest from its centres, ties to the greater ``x`` and then ``y``."""
    best: dict[int, tuple[int, int, int]] = {}
    for numbers, first, x, y, _, d in blocks:
        for f, near in zip(numbers, np.minimum.reduceat(d, first[:-1], axis=1).T, strict=True):
            most = near.max()
            at = np.flatnonzero(near == most)
            at = at[np.lexsort((y[at], x[at]))[-1]]
            found = int(most), int(x[at]), int(y[at])
            best[f] = max(best.get(f, found), found)
    rows = [(f, *p) for f, p in best.items()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["f", "d", "x", "y"])


SUMS = ("n", "x", "y", "upper", "lower")


def _sums(blocks: Iterator[tuple]) -> pa.RecordBatch:
    """For each fit and centre the sums over its members: stations, ``x``, ``y``, and the squares in two halves."""
    total: dict[int, np.ndarray] = {}
    for numbers, first, x, y, n, d in blocks:
        weighed, rows = (n, x * n, y * n), np.arange(len(n))
        for f, a, b in zip(numbers, first[:-1].tolist(), first[1:].tolist(), strict=True):
            at = d[:, a:b].argmin(axis=1)
            near = d[rows, a + at]
            sums = total.setdefault(f, np.zeros((len(SUMS), b - a), np.int64))
            for own, values in zip(sums, (*weighed, (near >> HALF) * n, (near & ((1 << HALF) - 1)) * n), strict=True):
                np.add.at(own, at, values)
            sums[3] += sums[4] >> HALF
            sums[4] &= (1 << HALF) - 1
    some = [(f, np.flatnonzero(sums[0])) for f, sums in total.items()]
    fit = [np.full(len(at), f, np.int32) for f, at in some]
    numbers = [np.concatenate([np.empty(0, np.int32), *fit]), np.concatenate([np.empty(0, np.int32), *(at.astype(np.int32) for _, at in some)])]
    values = np.concatenate([np.empty((len(SUMS), 0), np.int64), *(total[f][:, at] for f, at in some)], axis=1)
    return pa.RecordBatch.from_arrays([*map(pa.array, numbers), *(pa.array(v) for v in values)], names=["f", "i", *SUMS])


def _starts(points: DataFrame, places: DataFrame, k: int, seed: int, restarts: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """For each group and restart up to ``k`` places, each the farthest from those before it."""
    tries = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart")
    key = F.md5(F.concat(F.col("station_id").cast("string"), F.lit("|"), (F.col("restart") + seed).cast("string")).cast("binary"))
    first = points.select("*", tries).groupBy("g", "restart").agg(F.min(F.struct(key, F.col("x").alias("x"), F.col("y").alias("y"))).alias("p"))
    out = {(r.g, r.restart): [(r.p.x, r.p.y)] for r in first.collect()}
    open_ = sorted(out)
    for _ in range(k - 1):
        if not open_:
            break
        found, sent = _over(places, [(f[0], out[f]) for f in open_], _far, FAR)
        farthest = found.groupBy("f").agg(F.max(F.struct("d", "x", "y")).alias("p")).where("p.d > 0").collect()
        sent.destroy()
        for r in farthest:
            out[open_[r.f]].append((r.p.x, r.p.y))
        open_ = sorted(open_[r.f] for r in farthest)
    return out


def _labelled(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Every station once for each fit of its group, with the number of the nearest centre and the squared distance."""
    nearest = F.array_min(F.transform("centres", lambda c, i: F.struct(_squared(c).alias("d"), i.alias("i"))))
    return points.join(F.broadcast(centres), "g").withColumn("nearest", nearest)


def _way(old: list[tuple[int, int]], new: list[tuple[int, int]]) -> int:
    return sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(old, new, strict=True))


def _fitted(points: DataFrame, by: Sequence[str], ks: Sequence[int], seed: int, restarts: int, max_iterations: int) -> DataFrame:
    # Stations at one place move together.
    places = cut_lineage(points.groupBy("g", "x", "y").agg(F.count("*").alias("n")))
    starts = _starts(points, places, max(ks), seed, restarts)
    fits = {(g, k, r): list(found[:k]) for (g, r), found in starts.items() for k in ks}
    cost: dict[tuple[int, int, int], int] = {}
    open_ = sorted(fits)
    for _ in range(max_iterations):
        if not open_:
            break
        found, sent = _over(places, [(f[0], fits[f]) for f in open_], _sums, "f int, i int, " + ", ".join(f"{c} bigint" for c in SUMS))
        sums = found.groupBy("f", "i").agg(*(F.sum(c).alias(c) for c in SUMS)).collect()
        sent.destroy()
        moved, now = {f: list(fits[f]) for f in open_}, dict.fromkeys(open_, 0)
        for r in sums:
            f = open_[r.f]
            moved[f][r.i] = (r.x // r.n, r.y // r.n)
            now[f] += (r.upper << HALF) + r.lower
        cost.update(now)
        open_ = [f for f in open_ if _way(fits[f], moved[f]) > STILL**2]
        fits.update(moved)
    if open_:
        warnings.warn(f"{len(open_)} fits did not converge within {max_iterations} iterations", stacklevel=3)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for g, k, r in fits:
        best[g, k] = min(best.get((g, k), (cost[g, k, r], r)), (cost[g, k, r], r))
    winners = _frame(points, [(g, k, r, fits[g, k, r]) for (g, k), (_, r) in sorted(best.items())])
    labelled = _labelled(points, winners).withColumn("cluster_id", F.col("nearest.i"))
    means = labelled.groupBy("g", "k", "cluster_id").agg(
        (F.sum("x") / F.count("*") / STEPS - 90).alias("centroid_lat"), (F.sum("y") / F.count("*") / STEPS - 180).alias("centroid_lon")
    )
    distance = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("centroid_lat"), F.col("centroid_lon"))
    return labelled.join(means, ["g", "k", "cluster_id"]).select(
        *by, "k", "station_id", "station_name", "latitude", "longitude", "cluster_id", "centroid_lat", "centroid_lon",
        distance.alias("distance_from_centroid_km"),
    )


def station_clusters(
    stations: DataFrame, k: int = CLUSTERS, seed: int = SEED, restarts: int = RESTARTS, max_iterations: int = MAX_ITERATIONS
) -> DataFrame:
    """The dimension: one fit over all located stations (M8)."""
    return grouped_clusters(stations, (), (k,), seed, restarts, max_iterations).drop("k")


def cluster_members(clusters: DataFrame, cluster_id: int) -> DataFrame:
    """Stations of one cluster, nearest to the centroid first."""
    return clusters.filter(F.col("cluster_id") == cluster_id).orderBy("distance_from_centroid_km", "station_id")
