"""Order-free digests per partition, key range and row, compared from the top.

A leaf is a partition's key range on one side: its row count and the sums of the
halves of its row digests, so leaves add up to partitions, and the leaves of files
to those of a table. Where a partition's sums agree, its ranges are not looked at;
where a range's agree, its rows are not read again. Two ranges of different rows agree
by chance about once in 2^64, as two rows do for the digests themselves.

Rows without a key belong to no leaf: they pair with nothing and are always reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.functions.cells import apart, path
from tallymend.functions.hashing import NULL_MARK, row_hash
from tallymend.functions.ranges import KeyRanges
from tallymend.operators.align import Sides

PLACE = ("year", "month", "week")
LEAF = (*PLACE, "range")
SUMS = ("rows", "low", "high")


def halves(digest: str) -> tuple[str, str]:
    """A digest as two numbers whose sums do not overflow."""
    return (
        f"cast({digest} & 4294967295 AS decimal(18,0))",
        f"cast(shiftrightunsigned({digest}, 32) AS decimal(18,0))",
    )


def side_leaves(both: Sides, name: str, ranges: KeyRanges, file: str | None = None) -> DataFrame:
    """Leaves of side ``name`` (``src`` or ``dest``): LEAF and SUMS.

    Only sums are shuffled. ``file``, a column of the side, splits leaves further.
    """
    rows = both.src if name == "src" else both.dest
    digest = apart(row_hash({c: both.plain_cell(name, c) for c in both.columns}), "primary_key")
    by = [*LEAF, *([file] if file else [])]
    low, high = halves("digest")
    return (
        rows.where("primary_key IS NOT NULL")
        .selectExpr(
            *PLACE,
            f"{ranges.number('primary_key')} AS range",
            *([f"{path(name, file)} AS {file}"] if file else []),
            f"xxhash64(coalesce(cast(primary_key AS string), r'{NULL_MARK}'), {digest}) AS digest",
        )
        .groupBy(*by)
        .agg(F.expr("count(*) AS rows"), F.expr(f"sum({low}) AS low"), F.expr(f"sum({high}) AS high"))
    )


def differing(src: DataFrame, dest: DataFrame, *level: str) -> DataFrame:
    """Nodes of ``level`` whose sums differ between the leaves of the two sides."""

    def signed(leaves: DataFrame, sign: str) -> DataFrame:
        return leaves.selectExpr(*level, *(f"cast({sign}{s} AS decimal(38,0)) AS {s}" for s in SUMS))

    return (
        signed(src, "")
        .unionByName(signed(dest, "-"))
        .groupBy(*level)
        .agg(*(F.sum(s).alias(s) for s in SUMS))
        .where(" OR ".join(f"{s} <> 0" for s in SUMS))
        .select(*level)
    )


def _meet(rows: DataFrame, nodes: DataFrame, level: Sequence[str], how: str) -> DataFrame:
    """Rows joined with the nodes of ``level`` they stand under, whose columns become ``at_...``."""
    on = reduce(and_, (F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in level))
    return rows.join(nodes.withColumnsRenamed({c: f"at_{c}" for c in level}), on, how)


def dirty_ranges(src: DataFrame, dest: DataFrame) -> DataFrame:
    """Leaves that differ, looked for in partitions that differ."""
    parts = differing(src, dest, *PLACE)
    src, dest = (_meet(d, parts, PLACE, "left_semi") for d in (src, dest))
    return differing(src, dest, *LEAF)


def only_dirty(both: Sides, dirty: DataFrame, ranges: KeyRanges) -> Sides:
    """Rows with a key in the dirty ranges.

    ``dirty`` has at most one row per leaf and is read twice, so store it. The keys' ranges
    go to the scan as conditions on the key; partition and range are then met exactly.
    """
    # At most one number per range reaches the driver.
    numbers = [r["range"] for r in dirty.select("range").distinct().collect()]
    near = f"primary_key IS NOT NULL AND ({ranges.condition('primary_key', numbers)})"

    def cut(rows: DataFrame) -> DataFrame:
        placed = rows.where(near).withColumn("range", F.expr(ranges.number("primary_key")))
        return _meet(placed, dirty, LEAF, "left_semi").drop("range")

    return both.on(cut(both.src), cut(both.dest))


def dirty_rows(src: DataFrame, dest: DataFrame, dirty: DataFrame) -> tuple[int, int]:
    """Rows in the dirty leaves of the two sides together, and in the largest of these.

    All rows that a key has in a partition are in one leaf, so no key has more than the largest.
    """
    counts = src.select(*LEAF, "rows").unionByName(dest.select(*LEAF, "rows"))
    leaves = _meet(counts.groupBy(*LEAF).agg(F.sum("rows").alias("rows")), dirty, LEAF, "left_semi")
    found = leaves.agg(F.sum("rows").alias("all"), F.max("rows").alias("most")).first()
    return int(found["all"] or 0), int(found["most"] or 0)


def partition_counts(src: DataFrame, dest: DataFrame) -> DataFrame:
    """Rows with a key per partition and side, and whether the sides agree, from leaves alone."""

    def counted(leaves: DataFrame, side: str) -> DataFrame:
        counts = {"src": "0", "dest": "0"} | {side: "rows"}
        return leaves.selectExpr(*PLACE, *(f"{v} AS {k}_rows" for k, v in counts.items()))

    totals = (
        counted(src, "src")
        .unionByName(counted(dest, "dest"))
        .groupBy(*PLACE)
        .agg(*(F.sum(f"{s}_rows").cast("long").alias(f"{s}_rows") for s in ("src", "dest")))
    )
    parts = differing(src, dest, *PLACE).withColumn("differs", F.lit(True))
    return _meet(totals, parts, PLACE, "left").select(
        *totals.columns, F.expr("differs IS NULL AS agrees")
    )
