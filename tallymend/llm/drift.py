"""Centroid clustering with bounds that the movement of centroids loosens geometrically.

Vectors become whole numbers, so distances and means are exact and reruns
agree. A round assigns every vector to its nearest centroid, then moves each
centroid to the floor of its vectors' mean.

Bounds. A vector carries an upper bound of the distance to its own centroid and
a lower bound of the distance to any other. While the upper one is below the
lower one, its centroid is still the nearest; else the vector is ambiguous, and
its distances to all centroids are computed exactly.

Drift. When a centroid moves from a to b, how much nearer can it come to the
vectors of a cluster? They lie in a sphere around the cluster's centroid c. In
the plane through a, b and c, moving on from a changes the distance to x at the
rate of -cos of the angle between the move and the way to x, and that cosine
only falls on the way. So no vector comes nearer than |ab| times the largest
cosine the sphere shows from a: the angle at c less the sphere's half angle,
arcsin(radius / |ac|). That is less than the full drift |ab| unless the move
aims into the sphere, and negative when the centroid moves away. Spheres are
taken per block of vectors, from their upper bounds.

How it scales: blocks of vectors are stored once, bucketed by number; bounds are
a small table with the same buckets, so a round joins both without a shuffle of
either and writes the bounds only. Tasks return the sums of vectors that changed their
cluster; a round brings at most (clusters x components) numbers to the driver.

Cases: rows whose vector is null, of another length, or holds null or non-finite components
are left out; a null id takes part but is no first centroid; repeated rows are
vectors of their own; fewer vectors than clusters give as many clusters as
vectors; extra columns are not read; an empty table gives an empty result.
Components of 2^27 and more are computed with unbounded integers, and a
distance that no long holds fails the job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.llm.common import bucketed, stored

# Vectors of a block. Below WIDE in size, squares and their sums fit 64 bits.
BLOCK = 1024
WIDE = 1 << 27
# What rounding can add to a distance computed in double precision, and to an angle's cosine.
SLACK, ANGLE_SLACK = 1e-12, 1e-7

STATE = (
    "block long, assigned binary, upper binary, lower binary, scanned long,"
    " moved array<struct<cluster:int,n:long,sums:array<decimal(38,0)>>>"
)


# --- bounds


def distances(x: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Exact squared distances of rows to one centroid."""
    if x.dtype == object or max(map(abs, centroid)) >= WIDE:
        return ((x.astype(object) - np.array(centroid, object)) ** 2).sum(axis=1)
    return ((x - np.array(centroid, "i8")) ** 2).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype("f8"))


def loosening(own: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> float:
    """By how much, at most, a centroid that moves comes nearer to a vector of the sphere."""
    move, way = after - before, own - before
    drift, far = float(np.linalg.norm(move)), float(np.linalg.norm(way))
    if drift == 0:
        return 0.0
    slack = ANGLE_SLACK * drift
    if not radius < far:
        return drift + slack
    angle = math.acos(min(1.0, max(-1.0, float(way @ move) / far / drift)))
    half = math.asin(min(1.0, radius / far))
    return drift * math.cos(max(0.0, angle - half)) + slack


class Bounds:
    """Clusters and bounds of one block's vectors."""

    def __init__(self, assigned: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.assigned, self.upper, self.lower = assigned, upper, lower

    @classmethod
    def unknown(cls, n: int) -> Bounds:
        return cls(np.zeros(n, "u1"), np.full(n, np.inf), np.full(n, -np.inf))

    def drift(self, before: list[list[int]], after: list[list[int]]) -> None:
        """Loosen the bounds for centroids that moved."""
        old, new = np.array(before, "f8"), np.array(after, "f8")
        for i in np.unique(self.assigned):
            own = self.assigned == i
            radius = float(self.upper[own].max())
            others = [j for j in range(len(old)) if j != i]
            if others:
                self.lower[own] -= max(loosening(old[i], radius, old[j], new[j]) for j in others)
            self.upper[own] += float(np.linalg.norm(new[i] - old[i])) * (1 + ANGLE_SLACK)

    def settle(self, x: np.ndarray, centroids: list[list[int]]) -> int:
        """Make every assignment right; the number of vectors scanned exactly."""
        open_ = np.flatnonzero(~(self.upper < self.lower))
        for i in np.unique(self.assigned[open_]):
            own = open_[self.assigned[open_] == i]
            self.upper[own] = _roots(distances(x[own], centroids[i])) * (1 + SLACK)
        open_ = open_[~(self.upper[open_] < self.lower[open_])]
        if len(open_):
            found = np.stack([distances(x[open_], c) for c in centroids], axis=1)
            # The first of equal distances is that of the smaller number.
            nearest = found.argmin(axis=1)
            self.assigned[open_] = nearest
            self.upper[open_] = _roots(found[np.arange(len(open_)), nearest]) * (1 + SLACK)
            found = found.astype("f8")
            found[np.arange(len(open_)), nearest] = np.inf
            self.lower[open_] = np.sqrt(found.min(axis=1)) * (1 - SLACK)
        return len(open_)


def _changes(x: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> list[dict]:
    """What clusters gained and lost, as counts and sums of components."""
    moved = np.arange(len(x)) if before is None else np.flatnonzero(before != after)
    out: dict[int, list] = {}
    for sign, clusters in ((1, after), (-1, before)):
        if clusters is None:
            continue
        for i in np.unique(clusters[moved]).tolist():
            own = x[moved[clusters[moved] == i]]
            n, sums = out.get(i, (0, [0] * x.shape[1]))
            gained = [sign * int(s) for s in own.sum(axis=0)]
            out[i] = (n + sign * len(own), [a + b for a, b in zip(sums, gained, strict=True)])
    return [
        {"cluster": i, "n": n, "sums": [Decimal(s) for s in sums]} for i, (n, sums) in out.items()
    ]


# --- blocks


def kept_vectors(vectors: DataFrame, dims: int, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    usable = (F.size(vector) == dims) & F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    )
    chosen = vectors.where(F.coalesce(usable, F.lit(False)))
    return chosen.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )


def whole(x: float, scale: int) -> int:
    """floor(scale * x); beyond 2^53 every double is whole already."""
    return math.floor(scale * x) if abs(x) < 2**53 else scale * int(x)


def _packed(flat: np.ndarray, scale: int) -> tuple[bool, bytes]:
    scaled = np.floor(scale * flat)
    if np.abs(scaled).max() < WIDE:
        return False, scaled.astype("<i4").tobytes()
    return True, ",".join(str(whole(x, scale)) for x in flat.tolist()).encode()


def _matrix(data: bytes, wide: bool, dims: int) -> np.ndarray:
    if wide:
        return np.array([int(t) for t in data.split(b",")], object).reshape(-1, dims)
    return np.frombuffer(data, "<i4").astype("i8").reshape(-1, dims)


def _blocks(kept: DataFrame, dims: int, scale: int) -> DataFrame:
    """(block, ids, wide, data): vectors packed as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                wide, data = _packed(part.column("vector").flatten().to_numpy(), scale)
                ids = part.column("id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([ids], pa.list_(pa.int64())),
                        pa.array([wide], pa.bool_()),
                        pa.array([data], pa.binary()),
                    ],
                    ["block", "ids", "wide", "data"],
                )
                block += 1

    return kept.mapInArrow(run, "block long, ids array<long>, wide boolean, data binary")


def _assign(
    blocks: DataFrame,
    state: DataFrame | None,
    before: list[list[int]],
    after: list[list[int]],
    dims: int,
) -> DataFrame:
    """The state for centroids ``after``, from that for ``before``."""
    first, joined = state is None, blocks
    if not first:
        bounds = state.select("block", "assigned", "upper", "lower")
        joined = blocks.join(bounds.hint("shuffle_hash"), "block")
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    moved = pa.list_(
        pa.struct(
            [("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names if c != "ids"}
                x = _matrix(one["data"], one["wide"], dims)
                if first:
                    bounds, old = Bounds.unknown(len(x)), None
                else:
                    bounds = Bounds(
                        np.frombuffer(one["assigned"], "u1").copy(),
                        np.frombuffer(one["upper"], "<f8").copy(),
                        np.frombuffer(one["lower"], "<f8").copy(),
                    )
                    old = bounds.assigned.copy()
                    bounds.drift(before, after)
                scanned = bounds.settle(x, after)
                made = (
                    one["block"],
                    bounds.assigned.tobytes(),
                    bounds.upper.astype("<f8").tobytes(),
                    bounds.lower.astype("<f8").tobytes(),
                    scanned,
                    _changes(x, old, bounds.assigned),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(made, [*types, moved], strict=True)],
                    ["block", "assigned", "upper", "lower", "scanned", "moved"],
                )

    return joined.mapInArrow(run, STATE)


def _members(blocks: DataFrame, state: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                x = _matrix(one["data"], one["wide"], dims)
                assigned = np.frombuffer(one["assigned"], "u1")
                found = np.zeros(len(x), object)
                for i in np.unique(assigned):
                    found[assigned == i] = distances(x[assigned == i], centroids[i])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["ids"], pa.int64()),
                        pa.array(assigned, pa.int32()),
                        pa.array([int(d) for d in found], pa.int64()),
                    ],
                    ["id", "cluster", "distance"],
                )

    joined = blocks.join(state.select("block", "assigned").hint("shuffle_hash"), "block")
    return joined.mapInArrow(run, "id long, cluster int, distance long")


# --- the whole


def first_centroids(kept: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors whose ``seed:id`` has the smallest hash, in its order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.where("id IS NOT NULL").orderBy(order, "id", "vector").limit(clusters)
    return [[whole(x, scale) for x in r["vector"]] for r in rows.select("vector").collect()]


def cluster(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    key: str = "vec_id",
    vector: str = "embedding",
    watch=None,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes part.

    ``clusters``: at most 256. ``watch`` is called with each round's state, for
    those who want to know how many vectors were scanned.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims, key, vector)
    centroids = before = first_centroids(kept, clusters, seed, scale)
    result = f"`{key}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<decimal(38,0)>"
    if not centroids:
        return spark.createDataFrame([], result)
    blocks, state = bucketed(_blocks(kept, dims, scale), "block"), None
    size, total = [0] * len(centroids), [[0] * dims for _ in centroids]
    for step in range(rounds + 1):
        state = bucketed(_assign(blocks, state, before, centroids, dims), "block")
        if watch:
            watch(state)
        if step == rounds:
            break
        moved = state.select(F.inline("moved"))
        for r in moved.groupBy("cluster").agg(F.sum("n").alias("n")).collect():
            size[r["cluster"]] += r["n"]
        parts = moved.select("cluster", F.posexplode("sums").alias("place", "part"))
        for r in parts.groupBy("cluster", "place").agg(F.sum("part").alias("part")).collect():
            total[r["cluster"]][r["place"]] += int(r["part"])
        before = centroids
        centroids = [
            [s // n for s in own] if n else old
            for own, n, old in zip(total, size, before, strict=True)
        ]
    members = stored(_members(blocks, state, centroids, dims))
    # One row per cluster, on the driver and in the join.
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    own, total_inertia = {r["cluster"]: r["d"] for r in sums}, sum(r["d"] for r in sums)
    facts = spark.createDataFrame(
        [(i, own.get(i), total_inertia, [Decimal(x) for x in c]) for i, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid array<decimal(38,0)>",
    )
    return members.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def digest(found: DataFrame, key: str = "vec_id") -> DataFrame:
    """The result with a hash of the centroid's components as decimals joined by commas."""
    listed = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select(
        key, "cluster", "distance", "cluster_inertia", "inertia", F.sha2(listed, 256).alias("centroid_sha256")
    )


def digest_sql(clusters: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """The same in DuckDB, round by round."""
    steps = [
        f"""kept AS MATERIALIZED (
          SELECT vec_id, row_number() OVER () AS r,
            list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {dims}
            AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS j, v AS c FROM (
            SELECT *, sha256('{seed}:' || vec_id) AS h FROM kept WHERE vec_id IS NOT NULL
            ORDER BY h, vec_id, v LIMIT {clusters}))""",
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
          SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v,
            min(struct_pack(d := d, j := j)) AS b FROM (
            SELECT r, vec_id, v, j, list_sum(list_transform(list_zip(v, c),
              lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept, c{t}) GROUP BY r)"""
        )
        if t < rounds:
            # floor(s / n) without rounding: s less its non-negative remainder.
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (
          SELECT c{t}.j, coalesce(m.c, c{t}.c) AS c FROM c{t} LEFT JOIN (
            SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
              SELECT b.j AS j, i, sum(v[i]) AS s, count(*) AS n FROM a{t}, range(1, {dims + 1}) AS g(i)
              GROUP BY b.j, i) GROUP BY j) AS m ON m.j = c{t}.j)"""
            )
    last = f"a{rounds}"
    return (
        "WITH "
        + ", ".join(steps)
        + f""" SELECT vec_id, CAST(b.j AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance,
          CAST(sum(b.d) OVER (PARTITION BY b.j) AS BIGINT) AS cluster_inertia,
          CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
          sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM {last} JOIN c{rounds} ON c{rounds}.j = b.j"""
    )
