"""N-gram Jaccard join by MinHash banding, the fixed case of an LSH forest.

A text is the set of its five-word shingles. Its MinHash signature is spread
over trees; in a tree, texts whose signatures share a prefix meet. Matched
prefixes have one fixed length for all: the longest at which a pair at the
threshold is met with the target probability, computed from the constants. It
does not adapt to what was met; a shorter prefix would add work and no recall
that was asked for. Every pair that meets is verified on the whole
shingle sets.

How it scales: equal sets are one class, joined by membership only. Signatures
are made once and stored, narrow. Pairs are never listed: a prefix group links
its members to its smallest one, the components of these links are cut into
tiles of bounded size, and a task verifies two tiles at a time, giving numbers
of links and a forest of them.

Cases: a null or empty text, or one of blanks, has no shingle and links with
nothing, not even its like, and so does a row without key; a text of fewer than
five words is one shingle; repeated rows and equal texts link at similarity 1; extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.llm.byte_bpe import sliced
from tallymend.llm.common import rows_of, with_row
from tallymend.llm.graph import components, local_forest
from tallymend.plans.durable import durable

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
# Texts and shingles of one tile at most; a single longer text is a tile of its own.
TILE_TEXTS = 512
TILE_SHINGLES = 120_000


# Rows that a worker holds.
ROWS = 256


@dataclass(frozen=True)
class Forest:
    """``recall``: least probability that a pair at the threshold meets."""

    words: int = 5
    threshold: float = 0.8
    trees: int = 16
    depth: int = 8
    recall: float = 0.999
    seed: int = 1

    def met(self, depth: int) -> float:
        return 1 - (1 - self.threshold**depth) ** self.trees

    def matched_depth(self) -> int:
        """The longest prefix that reaches the target, shortened step by step."""
        depth = self.depth
        while depth > 1 and self.met(depth) < self.recall:
            depth -= 1
        return depth


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text, hashed to 64 bits, ascending."""
    found = WORD(text or "")
    if not found:
        return np.empty(0, "u8")
    n = max(1, len(found) - words + 1)
    if n == 1:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(found))], "u8")
    # One hash per word, then a mixed sum over the window: no string per shingle.
    of = {w: xxhash.xxh3_64_intdigest(w) for w in set(found)}
    h = np.fromiter(map(of.__getitem__, found), "u8", len(found))
    total = np.zeros(n, "u8")
    for k in range(words):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(total)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits that scatters them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefixes(found: np.ndarray, forest: Forest, depth: int) -> np.ndarray:
    """One hash per tree: the first ``depth`` entries of the tree's part of the signature."""
    draw = np.random.default_rng(forest.seed).integers(0, 1 << 63, (2, forest.depth, forest.trees))
    draw = draw.astype("u8")[:, :depth].reshape(2, -1)
    least = np.full(draw.shape[1], np.iinfo("u8").max, "u8")
    for at in range(0, len(found), 1024):
        part = (found[at : at + 1024, None] ^ draw[0]) * (draw[1] | np.uint64(1))
        least = np.minimum(least, part.min(axis=0))
    out = np.arange(forest.trees, dtype="u8")
    for entries in (least >> np.uint64(16)).reshape(depth, forest.trees):
        out = mix(out * np.uint64(31) + entries)
    return out


def signatures(docs: DataFrame, forest: Forest, key: str, text: str) -> DataFrame:
    """(key, text_hash, class, n, prefixes): the hash of the whole set, its size, a prefix per tree.

    Without shingles ``class`` is null.
    """
    depth = forest.matched_depth()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"class": [], "n": [], "prefixes": []}
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            for name, body in zip(keys, texts, strict=True):
                found = shingles(None if name is None else body, forest.words)
                rows["n"].append(len(found))
                rows["class"].append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                rows["prefixes"].append(
                    prefixes(found, forest, depth).view("i8") if len(found) else None
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text_hash"),
                    pa.array(rows["class"], pa.binary()),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["prefixes"], pa.list_(pa.int64())),
                ],
                ["key", "text_hash", "class", "n", "prefixes"],
            )

    narrow = docs.select(
        F.col(key).cast("long").alias("key"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return narrow.mapInArrow(
        run, "key long, text_hash long, class binary, n long, prefixes array<long>"
    )


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that meet another one in some tree.

    ``classes`` has (node, prefixes). Members of a prefix group hang on its
    smallest member, so the components hold every pair that meets.
    """
    entries = classes.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    least = (
        entries.groupBy("tree", "prefix")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where("least <> most")
        .drop("most")
    )
    met = entries.join(least, ["tree", "prefix"]).where("node <> least")
    return components(met.select(F.col("least").alias("u"), F.col("node").alias("v")))


def tiles(grouped: DataFrame) -> DataFrame:
    """``grouped`` (node, component, n, ...) with ``tile`` and ``tiles``, the number in the group."""
    sized = grouped.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / TILE_TEXTS), F.ceil(F.sum("n") / TILE_SHINGLES), F.lit(1)
        ).alias("tiles")
    )
    return grouped.join(sized, "component").withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    )


def tile_links(
    left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float
) -> np.ndarray:
    """Which sets are at least ``threshold`` alike; without ``right``, among ``left`` itself."""
    sets = left if right is None else left + right
    lengths = np.array([len(s) for s in sets])
    names, code = np.unique(np.concatenate(sets), return_inverse=True)
    # A shingle of one set only never counts in an intersection.
    often = np.bincount(code, minlength=len(names)) > 1
    place = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(sets)), lengths)
    kept = often[code]
    row, column = row[kept], place[code[kept]]
    common = np.zeros((len(left), len(sets) if right is None else len(right)), "f4")
    # Columns in slices, so the dense pieces stay small whatever the texts' length.
    for at in range(0, int(often.sum()), 4096):
        part = (column >= at) & (column < at + 4096)
        dense = np.zeros((len(sets), 4096), "f4")
        dense[row[part], column[part] - at] = 1
        other = dense if right is None else dense[len(left) :]
        common += dense[: len(left)] @ other.T
    mine = lengths[: len(left), None]
    theirs = lengths[None, :] if right is None else lengths[None, len(left) :]
    # In whole numbers of 1e-9, so that a similarity of exactly the threshold counts.
    alike = common.astype("i8") * 10**9 >= (mine + theirs - common.astype("i8")) * round(
        threshold * 10**9
    )
    if right is None:
        np.fill_diagonal(alike, False)
    return alike


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of two tiles: for every class its linked documents, and a forest of the links."""
    first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    pdf = pdf.drop_duplicates("node")
    mine = pdf[pdf["tile"] == first]
    theirs = mine if first == second else pdf[pdf["tile"] == second]
    if not len(mine) or not len(theirs):
        return pd.DataFrame({"node": [], "links": [], "u": []}).astype("int64")
    sets = lambda part: [np.frombuffer(s, "u8") for s in part["shingles"]]
    alike = tile_links(sets(mine), None if first == second else sets(theirs), threshold)
    a, b = mine["node"].to_numpy(), theirs["node"].to_numpy()
    forest = local_forest(alike, a, b)
    out = [(a, alike @ theirs["copies"].to_numpy("i8"))]
    if first != second:
        out.append((b, alike.T @ mine["copies"].to_numpy("i8")))
    node, links = np.concatenate([n for n, _ in out]), np.concatenate([c for _, c in out])
    u = np.array([forest.get(n, n) for n in node.tolist()], "i8")
    kept = links > 0
    return pd.DataFrame({"node": node[kept], "links": links[kept], "u": u[kept]})


def verified(
    docs: DataFrame, grouped: DataFrame, forest: Forest, key: str, text: str
) -> DataFrame:
    """(node, links, u): for every class and tile pair its linked documents, and a linked node.

    ``grouped`` has (node, component, n, copies, key, class) of the classes to
    compare; ``key`` names a document of the class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, ROWS):
            sets = [shingles(body, forest.words) for body in batch.column("text").to_pylist()]
            # Another text may share the key.
            own = [
                xxhash.xxh3_128_digest(s.tobytes()) == c
                for s, c in zip(sets, batch.column("class").to_pylist(), strict=True)
            ]
            kept = [batch.column(c) for c in ("node", "component", "copies", "tile", "tiles")]
            rows = pa.RecordBatch.from_arrays(
                [*kept, pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "component", "copies", "tile", "tiles", "shingles"],
            )
            yield rows.filter(pa.array(own, pa.bool_()))

    tiled = tiles(grouped)
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = texts.join(tiled, "key").select("text", *tiled.columns)
    made = rows.mapInArrow(
        run, "node long, component long, copies long, tile int, tiles long, shingles binary"
    )
    other = F.sequence(F.lit(0), F.col("tiles").cast("int") - 1)
    paired = made.withColumn("_other", F.explode(other)).select(
        "*",
        F.least("tile", "_other").alias("i"),
        F.greatest("tile", "_other").alias("j"),
    )
    threshold = forest.threshold
    return paired.groupBy("component", "i", "j").applyInPandas(
        lambda pdf: _verify(pdf, threshold), "node long, links long, u long"
    )


def join(
    docs: DataFrame, forest: Forest = Forest(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (key, text_hash, n_links, component_id, kept).

    ``n_links``: other documents at the threshold or above, equal texts
    included. ``component_id``: the smallest key reachable by links. ``kept``:
    whether that is the row's own key.
    """
    marked = durable(signatures(docs, forest, key, text))
    classes = durable(
        marked.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("key").alias("key"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("prefixes").alias("prefixes"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    grouped = candidate_groups(classes).join(classes.drop("prefixes"), "node")
    found = durable(verified(docs, grouped, forest, key, text))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tree = components(found.select("u", F.col("node").alias("v")))
    joined = (
        classes.select("node", "class", "key", "copies")
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
    return marked.join(judged, "class", "left").select(
        F.col("key").alias(key),
        "text_hash",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )


def keep_one(
    docs: DataFrame, forest: Forest = Forest(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stand for their group; of repeated rows one stays."""
    kept = (
        join(docs, forest, key, text)
        .where("kept")
        .select(F.col(key).cast("long").alias("key"), F.col("text_hash").alias("hash"))
        .distinct()
    )
    own = with_row(docs, F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("hash"))
    met = own.where("key IS NOT NULL").join(kept, ["key", "hash"], "left_semi")
    # A row without key stands for nobody else.
    stay = met.unionByName(own.where("key IS NULL")).dropDuplicates(["key", "hash"])
    return stay.select(*rows_of(stay, docs.columns))


def digest_sql(forest: Forest = Forest()) -> str:
    """The same in DuckDB, by comparing every two texts that share a shingle."""
    k = forest.words
    return f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(range(greatest(len(w) - {k - 1}, 1)),
    lambda i: array_to_string(w[i + 1:i + {k}], ' '))) AS s FROM worded WHERE len(w) > 0),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING count(*) * 1000 >= (a.n + b.n - count(*)) * {round(forest.threshold * 1000)}),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT reach.u, pairs.v FROM reach JOIN pairs ON reach.v = pairs.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n_links FROM pairs GROUP BY u)
SELECT least.u AS doc_id, coalesce(n_links, 0) AS n_links, component_id,
  least.u = component_id AS kept
FROM least LEFT JOIN degree ON least.u = degree.u"""
