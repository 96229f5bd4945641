"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes, learned on a bounded sample, turns vectors
into binary codes whose bits are balanced. Codes are cut into substrings, one
table each; two codes meet in a table if their substrings differ in one bit at
most, and pass if the whole codes differ in no more bits than a pair at the
threshold would but for rare cases. How many tables and bits that takes is measured
on pairs at the threshold, as vectors with a common direction flip more bits once
it is subtracted; where no table would tell pairs apart, all tiles are compared. What passes is reranked by cosine on the
original vectors in double precision, so no link below the threshold is given.

How it scales: equal vectors of a label are one point. Vectors sit in tiles of
bounded size, cut by code; the tables carry codes and tiles, no vectors, and
report pairs of tiles, never pairs of vectors. A bucket of a table that is too
large for a task is compared in blocks. A task multiplies two tiles and gives
numbers of links and a forest of them.

Cases: a null label or key, or a vector that is null, zero or holds null or
non-finite components, links with nothing; vectors of unlike length are not compared;
repeated rows and equal vectors are linked; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.llm.graph import components, local_forest
from tallymend.llm.vectors import matrix, packed, unit
from tallymend.plans.durable import durable


@dataclass(frozen=True)
class Quantiser:
    """``sample``: vectors that the rotation is learned on, at most. ``tables``: substrings of
    a code, at least. ``radius``: bits in which two codes may differ, at least. Both grow until
    ``recall`` of ``pairs`` sampled pairs at the threshold is met, up to ``most_tables`` and
    ``most_radius``; beyond these the tables would pass most pairs. ``tile``: vectors in a tile,
    ``block``: codes compared at once."""

    threshold: float = 0.93
    bits: int = 64
    sample: int = 20_000
    rounds: int = 30
    tables: int = 6
    radius: int = 16
    recall: float = 0.99
    pairs: int = 4000
    most_tables: int = 10
    most_radius: int = 24
    tile: int = 256
    block: int = 4096
    seed: int = 1


def learn(sample: np.ndarray, how: Quantiser) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection: principal axes, rotated so that signs lose least."""
    rng = np.random.default_rng(how.seed)
    bits = min(how.bits, sample.shape[1])
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    flat = centred @ axes
    rotation, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(how.rounds):
        codes = np.where(flat @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(codes.T @ flat)
        rotation = (u @ v).T
    return mean, axes @ rotation


def encode(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes of up to 64 bits."""
    bits = ((vectors - mean) @ projection >= 0).astype("u8")
    return (bits << np.arange(bits.shape[1], dtype="u8")).sum(axis=1, dtype="u8")


def substrings(bits: int, tables: int) -> list[tuple[int, int]]:
    """(shift, width) of every table's part of a code."""
    edges = [round(i * bits / tables) for i in range(tables + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def threshold_pairs(sample: np.ndarray, how: Quantiser) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at the threshold, kind by kind: sampled vectors turned towards and
    away from others and at random, and pairs of the sample that are just above it."""
    rng = np.random.default_rng(how.seed)
    u = sample[rng.permutation(len(sample))[: how.pairs]]
    to = sample[rng.integers(len(sample), size=len(u))] - u
    for turn in (to, -to, rng.standard_normal(u.shape)):
        turn = turn - (turn * u).sum(axis=1, keepdims=True) * u
        length = np.linalg.norm(turn, axis=1)
        some = length > 1e-6
        turn = turn[some] / length[some, None]
        yield u[some], how.threshold * u[some] + np.sqrt(1 - how.threshold**2) * turn
    a, b = [], []
    for at in range(0, len(u), 256):
        alike = u[at : at + 256] @ sample.T
        x, y = np.nonzero((alike >= how.threshold) & (alike < how.threshold + 0.01))
        a.append(u[at : at + 256][x])
        b.append(sample[y])
    a, b = np.concatenate(a), np.concatenate(b)
    # A few pairs say nothing about a share.
    if len(a) >= 100:
        yield a, b


def found_share(apart: np.ndarray, bits: int, tables: int, radius: int) -> float:
    """Share of pairs that some table and the radius let pass; ``apart``: where codes differ."""
    met = np.zeros(len(apart), bool)
    for shift, width in substrings(bits, tables):
        part = (apart >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        met |= np.bitwise_count(part) <= 1
    return float((met & (np.bitwise_count(apart) <= radius)).mean())


def reach(sample: np.ndarray, model: tuple, how: Quantiser) -> tuple[int, int] | None:
    """Least (tables, radius) with the recall asked for on every kind of pair; None if beyond bounds."""
    kinds = [encode(a, *model) ^ encode(b, *model) for a, b in threshold_pairs(sample, how) if len(a)]
    for tables in range(how.tables, how.most_tables + 1):
        for radius in range(how.radius, how.most_radius + 1):
            if all(found_share(x, how.bits, tables, radius) >= how.recall for x in kinds):
                return tables, radius
    return None


def _packed_rows(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, dim, vector, class); class, a hash of label and vector, is null without a use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, labels = batch.column("key").to_pylist(), batch.column("label").to_pylist()
            found = [
                None if name is None or key is None else v
                for v, name, key in zip(packed(batch.column("vector")), labels, keys, strict=True)
            ]
            classes = [
                None if v is None else xxhash.xxh3_128_digest(f"{len(v)}:{name}:".encode() + v)
                for v, name in zip(found, labels, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("label"),
                    pa.array([v and len(v) // 8 for v in found], pa.int32()),
                    pa.array(found, pa.binary()),
                    pa.array(classes, pa.binary()),
                ],
                ["key", "label", "dim", "vector", "class"],
            )

    narrow = rows.select(
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return narrow.mapInArrow(run, "key long, label string, dim int, vector binary, class binary")


def _coded(points: DataFrame, models: dict[int, tuple], how: Quantiser) -> DataFrame:
    """``points`` with ``code``; the models, one per vector length, are a few matrices."""
    sent = points.sparkSession.sparkContext.broadcast(models)
    names = points.columns
    schema = T.StructType([*points.schema.fields]).add("code", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            vectors = batch.column("vector").to_pylist()
            codes = np.zeros(len(vectors), "u8")
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                codes[own] = encode(unit(matrix(vectors[i] for i in own)), *sent.value[dim])
            columns = [*(batch.column(n) for n in names), pa.array(codes.view("i8"))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code"])

    return points.mapInArrow(run, schema)


def models_of(points: DataFrame, how: Quantiser) -> tuple[dict[int, tuple], Quantiser, list[int]]:
    """A mean and projection per vector length, learned on the first vectors by hash; ``how``
    with the tables and radius that the recall takes; the lengths that no table serves."""
    by_hash = points.select("dim", "vector").orderBy(F.xxhash64("vector"), "vector")
    rows = by_hash.limit(how.sample).collect()
    of: dict[int, list] = {}
    for row in rows:
        of.setdefault(row["dim"], []).append(bytes(row["vector"]))
    # Lengths that the sample has not met get axes without rotation.
    for row in points.select("dim").distinct().collect():
        of.setdefault(row["dim"], [np.eye(1, row["dim"]).tobytes()])
    models, plans = {}, {}
    for dim, vectors in of.items():
        known = unit(matrix(vectors))
        models[dim] = learn(known, how)
        plans[dim] = reach(known, models[dim], how)
    fit = [plan for plan in plans.values() if plan]
    how = replace(
        how,
        tables=max([t for t, _ in fit], default=how.tables),
        radius=max([r for _, r in fit], default=how.radius),
    )
    return models, how, sorted(dim for dim, plan in plans.items() if plan is None)


def _tiled(coded: DataFrame, how: Quantiser) -> DataFrame:
    """``coded`` with ``group`` (label and vector length) and ``tile``.

    A tile is a range of codes; a range with too many points is dealt by hash.
    """
    group = F.xxhash64("label", "dim")
    n = coded.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n"))
    depth = F.greatest(F.ceil(F.log2(F.col("n") / how.tile)), F.lit(0)).cast("int")
    cut = coded.withColumn("group", group).join(n.select("group", depth.alias("depth")), "group")
    top = F.expr(f"shiftrightunsigned(code, {how.bits} - depth)")
    cut = cut.withColumn("range", F.when(F.col("depth") == 0, F.lit(0)).otherwise(top))
    share = cut.groupBy("group", "range").agg(
        F.ceil(F.count(F.lit(1)) / how.tile).alias("parts")
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    return (
        cut.join(share, ["group", "range"])
        .withColumn("tile", F.xxhash64("range", part))
        .drop("depth", "range", "parts")
    )


def met_tiles(tiled: DataFrame, how: Quantiser, whole: bool = False) -> DataFrame:
    """(group, i, j): each tile with itself, and tiles with codes that meet in some table.

    ``whole``: there are rows whose column ``whole`` is true; of these every two tiles of a
    group meet.

    Per table and bit the substring without that bit is a key, so codes whose
    substrings differ in one bit at most share a key. Equal codes of a tile are
    one entry.
    """
    itself = tiled.select("group", F.col("tile").alias("i"), F.col("tile").alias("j")).distinct()
    masks = [
        F.struct(
            F.lit(table * how.bits + bit).alias("table"),
            F.shiftrightunsigned("code", shift)
            .bitwiseAND(F.lit((1 << width) - 1 - (1 << bit)))
            .alias("part"),
        )
        for table, (shift, width) in enumerate(substrings(how.bits, how.tables))
        for bit in range(width)
    ]
    entries = (
        tiled.where("NOT whole")
        .select("group", "tile", "code")
        .distinct()
        .withColumn("_k", F.explode(F.array(*masks)))
        .select(F.xxhash64("group", "_k").alias("bucket"), "group", "tile", "code")
    )
    counts = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / how.block).cast("int")
    block = F.pmod(F.xxhash64("code", "tile"), F.col("blocks")).cast("int")
    # A block of a bucket meets every block of the bucket once; most buckets are one block.
    met = (
        entries.join(counts.select("bucket", blocks.alias("blocks")), "bucket")
        .withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "group",
            "tile",
            "code",
        )
        .repartition("cell")
        .sortWithinPartitions("cell", "group")
    )
    radius = how.radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int, int]] = set()
        rest = np.empty((4, 0), "i8")
        for batch in batches:
            names = ("cell", "group", "tile", "code")
            rows = np.concatenate([rest, np.stack([np.asarray(batch.column(n)) for n in names])], 1)
            # The last cell may go on in the next batch.
            last = int(np.searchsorted(rows[0], rows[0, -1]))
            rest = rows[:, last:]
            _meet(rows[:, :last], radius, found)
            if len(found) > 1 << 16:
                yield _pair_rows(found)
                found.clear()
        _meet(rest, radius, found)
        yield _pair_rows(found)

    pairs = met.mapInArrow(run, "group long, i long, j long").union(itself)
    if whole:
        tiles = tiled.where("whole").select("group", "tile").distinct()
        first, second = tiles.withColumnRenamed("tile", "i"), tiles.withColumnRenamed("tile", "j")
        pairs = pairs.union(first.join(second, "group").where("i < j").select("group", "i", "j"))
    return pairs.distinct()


def _meet(rows: np.ndarray, radius: int, found: set[tuple[int, int, int]]) -> None:
    """Add the tiles of codes in one cell and group that are within ``radius`` bits."""
    if not rows.shape[1]:
        return
    cell, group, tile, code = rows
    code = code.view("u8")
    starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (group[1:] != group[:-1])])
    ends = np.r_[starts[1:], len(cell)]
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        for at in range(a, b, 512):
            apart = np.bitwise_count(code[at : min(at + 512, b), None] ^ code[None, a:b])
            x, y = np.nonzero(apart <= radius)
            x, y = x + at, y + a
            x, y = x[x != y], y[x != y]
            if len(x):
                pairs = np.unique(np.stack([tile[x], tile[y]]), axis=1)
                found.update((int(group[a]), i, j) for i, j in pairs.T.tolist() if i < j)


def _pair_rows(found: set[tuple[int, int, int]]) -> pa.RecordBatch:
    rows = np.array(sorted(found), "i8").reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], ["group", "i", "j"])


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of two tiles: for every point its linked rows, and a forest of the links."""
    first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    mine = pdf[pdf["tile"] == first]
    theirs = mine if first == second else pdf[pdf["tile"] == second]
    alike = unit(matrix(mine["vector"])) @ unit(matrix(theirs["vector"])).T >= threshold
    a, b = mine["node"].to_numpy(), theirs["node"].to_numpy()
    if first == second:
        np.fill_diagonal(alike, False)
    forest = local_forest(alike, a, b)
    node, links = a, alike @ theirs["copies"].to_numpy("i8")
    if first != second:
        node = np.concatenate([a, b])
        links = np.concatenate([links, alike.T @ mine["copies"].to_numpy("i8")])
    u = np.array([forest[n] for n in node.tolist()], "i8")
    return pd.DataFrame({"node": node, "links": links, "u": u})[links > 0]


def join(
    rows: DataFrame,
    how: Quantiser = Quantiser(),
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of ``rows``: (key, n_links, component_id, kept).

    ``n_links``: other rows of the label at the threshold or above.
    ``component_id``: the smallest key reachable by links. ``kept``: whether
    that is the row's own key.
    """
    every = _packed_rows(rows, key, vector, label)
    points = durable(
        every.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("key").alias("key"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("dim").alias("dim"),
            F.first("vector").alias("vector"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    models, how, untold = models_of(points, how)
    tiled = durable(
        _tiled(_coded(points, models, how), how).select(
            "group", "tile", "code", "node", "copies", "vector", F.col("dim").isin(untold).alias("whole")
        )
    )
    met = met_tiles(tiled, how, whole=bool(untold))
    # A tile pair is one group of rows; a tile that meets itself is there once.
    both = met.select("group", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"))
    threshold = how.threshold
    found = durable(
        both.join(tiled.drop("code", "whole"), ["group", "tile"])
        .groupBy("group", "i", "j")
        .applyInPandas(lambda pdf: _verify(pdf, threshold), "node long, links long, u long")
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tree = components(found.select("u", F.col("node").alias("v")))
    joined = (
        points.select("node", "class", "key", "copies")
        .join(links, "node", "left")
        .join(tree, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = joined.groupBy("component").agg(F.min("key").alias("component_id"))
    judged = joined.join(least, "component").select(
        "class",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    component = F.coalesce("component_id", "key")
    return every.select("key", "class").join(judged, "class", "left").select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )


def digest_sql(how: Quantiser = Quantiser()) -> str:
    """The same in DuckDB, by comparing every two vectors of a label."""
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {how.threshold}),
reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION SELECT reach.u, pairs.v FROM reach JOIN pairs ON reach.v = pairs.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n_links FROM pairs GROUP BY u)
SELECT least.u AS vec_id, coalesce(n_links, 0) AS n_links, component_id,
  least.u = component_id AS kept
FROM least LEFT JOIN degree ON least.u = degree.u"""
