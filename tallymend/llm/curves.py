"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions in several ways, each way shifted at
random, and ordered along a Hilbert curve. The orders are range-partitioned;
around every query a window of its order gives candidates, which are merged
over the orders and reranked by the exact distance on the original vectors.

Windows alone promise nothing where neighbours are hardly nearer than anyone
else. So a check follows: the first order, cut into blocks, gives each block a
centre and a radius, and a query looks into every block that could still hold a
vector nearer than the last of its list. It makes the result exact. Where
vectors cluster, nearly all blocks are ruled out; where they do not, the check
is a pass of the query set over the blocks.

How it scales: the windows of a task lie in its own partition and, over its
borders, in two halos of bounded size. The check sends the queries in slices of
bounded size to all tasks; the vectors are not shuffled for it.

Cases: a vector that is null, zero or holds null or non-finite components takes
no part; vectors of other lengths than the query's are no candidates; rows with
the query's own id are not its candidates; a repeated row with another id is one;
of rows that share an id the nearest counts; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymend.llm.common import shuffle_partitions
from tallymend.llm.vectors import matrix, packed, squares
from tallymend.plans.durable import durable


@dataclass(frozen=True)
class Curves:
    """``window``: places looked at to either side of a query, per order. ``slice``: queries
    sent to the tasks at once. ``block``: vectors in a block of the check."""

    nearest: int = 10
    orders: int = 4
    dims: int = 8
    bits: int = 7
    window: int = 64
    slice: int = 16_384
    block: int = 1024
    seed: int = 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points given as whole coordinates below 2^bits.

    Gray decoding of the transposed axes, top bit first: each bit of an axis
    swaps or inverts the lower bits of the first axis, then the bits interleave.
    """
    x = cells.astype("u8").T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for axis in range(len(x)):
            set_ = (x[axis] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        turn = np.where((x[-1] & q) != 0, turn ^ (q - one), turn)
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << one) | ((axis >> np.uint64(level)) & one)
    return place


def places(vectors: np.ndarray, how: Curves) -> np.ndarray:
    """One place per order and vector. Directions only matter: vectors are scaled to length 1."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    out = []
    for order in range(how.orders):
        rng = np.random.default_rng([how.seed, order, vectors.shape[1]])
        axes = rng.standard_normal((vectors.shape[1], how.dims))
        shift = rng.random(how.dims)
        # A projection of a unit vector on a normal direction is standard normal / sqrt(dim) wide.
        flat = (vectors / length) @ axes
        cells = np.floor((flat / 6 + 0.5) * (1 << (how.bits - 1)) + shift * (1 << (how.bits - 1)))
        out.append(hilbert(np.clip(cells, 0, (1 << how.bits) - 1), how.bits))
    return np.stack(out)


def _orders(rows: DataFrame, how: Curves, key: str, vector: str, query: Column) -> DataFrame:
    """(order, dim, place, id, query, vector): every usable vector once per order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["order", "dim", "place", "id", "query", "vector"]
        for batch in batches:
            found = packed(batch.column("vector"))
            ids, asked = batch.column("id").to_pylist(), batch.column("query").to_pylist()
            for dim in sorted({len(v) // 8 for v in found if v}):
                own = [i for i, v in enumerate(found) if v and len(v) == 8 * dim]
                vectors = [found[i] for i in own]
                for order, place in enumerate(places(matrix(vectors), how)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([order] * len(own), pa.int32()),
                            pa.array([dim] * len(own), pa.int32()),
                            pa.array(place.astype("i8")),
                            pa.array([ids[i] for i in own], pa.int64()),
                            pa.array([bool(asked[i]) for i in own]),
                            pa.array(vectors, pa.binary()),
                        ],
                        names,
                    )

    narrow = rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        query.alias("query"),
    ).where("id IS NOT NULL")
    return narrow.mapInArrow(
        run, "order int, dim int, place long, id long, query boolean, vector binary"
    )


NEAR = "query_id long, vec_id long, score double"


def nearest(query_id, ids, scores, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` best rows of each query, ties to the smaller id; an id counts once per query."""
    order = np.lexsort((ids, scores, query_id))
    q, i, s = query_id[order], ids[order], scores[order]
    first = np.ones(len(q), bool)
    first[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1])
    q, i, s = q[first], i[first], s[first]
    first = np.ones(len(q), bool)
    first[1:] = q[1:] != q[:-1]
    start = np.flatnonzero(first)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    return q[rank < n], i[rank < n], s[rank < n]


def _in_windows(part: pd.DataFrame, how: Curves, first: int = 0, last: int | None = None):
    """Neighbours of the queries at places first..last of ``part``, rows of one order in order."""
    asked = np.flatnonzero(part["query"].to_numpy())
    asked = asked[(asked >= first) & (asked < (len(part) if last is None else last))]
    if not len(asked):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    vectors, ids = matrix(part["vector"]), part["id"].to_numpy()
    found = []
    for at in asked.tolist():
        a, b = max(0, at - how.window), min(len(ids), at + how.window + 1)
        score = np.sqrt(squares(vectors[a:b] - vectors[at]))
        other = ids[a:b] != ids[at]
        own = np.full(int(other.sum()), ids[at])
        found.append(nearest(own, ids[a:b][other], score[other], how.nearest))
    q, i, s = (np.concatenate(c) for c in zip(*found, strict=True))
    return pd.DataFrame({"query_id": q, "vec_id": i, "score": s})


def _segments(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of each order and vector length; ``part`` is sorted by them."""
    for _, rows in part.groupby(["order", "dim"], sort=False):
        yield rows


def _near_rows(frames: list[pd.DataFrame]) -> pd.DataFrame:
    frame = pd.concat([pd.DataFrame({"query_id": [], "vec_id": [], "score": []}), *frames])
    return frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def window_candidates(ordered: DataFrame, how: Curves) -> DataFrame:
    """(query_id, vec_id, score) from the windows around every query.

    ``ordered`` is range-partitioned and sorted, with its partition's number in
    ``part``. Windows that cross into the next partition are looked at again in
    the halo of the border: the last places of one and the first of the next.
    """

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            part = pa.Table.from_batches(rows).to_pandas()
            found = _near_rows([_in_windows(s, how) for s in _segments(part)])
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            head = rows if first is None else pa.concat_tables([first, rows])
            first = head.slice(0, how.window) if first is None or len(first) < how.window else first
            tail = rows if last is None else pa.concat_tables([last, rows])
            last = tail.slice(max(0, len(tail) - how.window)).combine_chunks()
        if first is None:
            return
        number = first.column("part")[0].as_py()
        for border, rows in ((number - 1, first), (number, last)):
            marked = rows.append_column("border", pa.array([border] * len(rows), pa.int32()))
            yield from marked.combine_chunks().to_batches()

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "dim", "place", "id"], kind="stable")
        return _near_rows([_in_windows(s, how) for s in _segments(pdf)])

    halo = ordered.mapInArrow(
        edges,
        "order int, dim int, place long, id long, query boolean, vector binary, part int, border int",
    )
    return ordered.mapInArrow(inside, NEAR).union(halo.groupBy("border").applyInPandas(across, NEAR))


def merge(candidates: DataFrame, how: Curves) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest of each query, ties to the smaller id."""
    best = candidates.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= how.nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def _look_through(rows: pd.DataFrame, asked: dict, how: Curves) -> list[tuple]:
    """Rows of one block that are near enough to a query to enter its list."""
    vectors, ids = matrix(rows["vector"]), rows["id"].to_numpy()
    centre = vectors.mean(axis=0)
    radius = np.sqrt(((vectors - centre) ** 2).sum(axis=1).max())
    found = []
    for at in range(0, len(asked["id"]), 2048):
        q, own = asked["vector"][at : at + 2048], asked["id"][at : at + 2048]
        bound = asked["bound"][at : at + 2048]
        # A little room for rounding: what is let in is measured exactly below.
        reach = np.sqrt(((q - centre) ** 2).sum(axis=1)) - radius
        open_ = np.flatnonzero(reach <= bound * (1 + 1e-9) + 1e-9)
        if not len(open_):
            continue
        q, own, bound = q[open_], own[open_], bound[open_]
        size = (q**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1)[None, :]
        rough = size - 2 * (q @ vectors.T)
        a, b = np.nonzero(rough <= bound[:, None] ** 2 + 1e-9 * size)
        kept = own[a] != ids[b]
        a, b = a[kept], b[kept]
        score = np.sqrt(squares(q[a] - vectors[b]))
        kept = score <= bound[a]
        found.append(nearest(own[a][kept], ids[b][kept], score[kept], how.nearest))
    return found


def check(ordered: DataFrame, queries: DataFrame, how: Curves) -> DataFrame:
    """(query_id, vec_id, score) of all rows that may still enter a query's list.

    ``queries`` has (id, dim, vector, bound). They go to the tasks in slices of
    ``how.slice``; a slice is stored before the next is sent.
    """
    spark = ordered.sparkSession
    queries = durable(queries)
    slices = max(1, -(-queries.count() // how.slice))
    one_order = ordered.where("`order` = 0").select("dim", "id", "vector")
    parts = []
    for number in range(slices):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(slices)) == number).toPandas()
        sent = spark.sparkContext.broadcast(
            {
                dim: {
                    "id": rows["id"].to_numpy(),
                    "bound": rows["bound"].to_numpy(),
                    "vector": matrix(rows["vector"]),
                }
                for dim, rows in own.groupby("dim")
            }
        )

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            found = [tuple(np.empty(0, t) for t in ("i8", "i8", "f8"))]
            for batch in batches:
                rows = batch.to_pandas()
                for dim, same in rows.groupby("dim"):
                    if dim not in sent.value:
                        continue
                    for at in range(0, len(same), how.block):
                        block = same.iloc[at : at + how.block]
                        found += _look_through(block, sent.value[dim], how)
                merged = nearest(*(np.concatenate(c) for c in zip(*found, strict=True)), how.nearest)
                found = [merged]
            q, i, s = found[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array(i), pa.array(s)], ["query_id", "vec_id", "score"]
            )

        parts.append(durable(one_order.mapInArrow(run, NEAR)))
        sent.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def search(
    rows: DataFrame,
    how: Curves = Curves(),
    key: str = "vec_id",
    vector: str = "embedding",
    query: Column | None = None,
    exact: bool = True,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest other rows of every query.

    Queries are the rows for which ``query`` holds, by default those whose key
    is divisible by 100. With ``exact`` off the windows alone decide.
    """
    query = F.col(key) % 100 == 0 if query is None else query
    order = ("order", "dim", "place", "id")
    ordered = durable(
        _orders(rows, how, key, vector, query)
        .repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    candidates = durable(window_candidates(ordered, how))
    if exact:
        last = merge(candidates, how).where(F.col("rank") == how.nearest)
        bounds = last.select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
        asked = ordered.where("query AND `order` = 0").select("id", "dim", "vector")
        asked = asked.join(bounds, "id", "left").fillna(float("inf"), ["bound"])
        candidates = candidates.union(check(ordered, asked, how))
    return merge(candidates, how)


def digest_sql(how: Curves = Curves()) -> str:
    """The same in DuckDB, by measuring every row against every query."""
    return f"""
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
measured AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
    list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER near AS rank, vec_id, score FROM measured
WINDOW near AS (PARTITION BY query_id ORDER BY score, vec_id)
QUALIFY row_number() OVER near <= {how.nearest}"""
