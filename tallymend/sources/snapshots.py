"""Sides stored numbered, parsed and bucketed, so that aligning them shuffles no row.

A row's number within its key is made once, when its side is stored; the buckets are dealt
by key *and* number. So pairing two snapshots is one join on what both are bucketed by,
and a key with a third of all rows is spread over all buckets. A side that has not
changed is not read from its system again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.functions.cells import path
from tallymend.operators import align as al

# Partition and number in one text: NULL weeks must meet, and the join must be on
# just the columns that the buckets are made of.
SLOT = "slot"
PLACE = ("year", "month", "week")


def store_side(
    both: al.Sides,
    name: str,
    table: str,
    buckets: int,
    folder: str | None = None,
    hot_rows: int | None = 1_000_000,
) -> None:
    """Store side ``name`` (``src`` or ``dest``) of ``both`` as a bucketed catalog table.

    The other side may be empty: only its types matter, as numbers follow the order that both
    sides' types give. Snapshots that are to meet take the same number of buckets.
    Rows without a key are dealt by their place in the scan. One file is written per bucket.
    """
    alone = both.on(both.src, both.dest.limit(0)) if name == "src" else both.on(both.src.limit(0), both.dest)
    keyed = alone.where("primary_key IS NOT NULL")
    row = alone.src if name == "src" else alone.dest
    layout = ("year", "month", "week", "primary_key", "occurrence", name, "cells")
    numbered = [part.select(*layout) for part in al.numbered(keyed, hot_rows)]
    cells = numbered[0].schema["cells"].dataType
    # Cells of rows without a key are never compared.
    loose = row.where("primary_key IS NULL").select(
        *PLACE,
        "primary_key",
        F.lit(None).cast("long").alias("occurrence"),
        name,
        F.lit(None).cast(cells).alias("cells"),
    )
    slot = (
        "CASE WHEN occurrence IS NULL THEN concat('-', monotonically_increasing_id())"
        " ELSE to_json(struct(year, month, week, occurrence), map('ignoreNullFields', 'false')) END"
    )
    rows = reduce(DataFrame.unionByName, [*numbered, loose]).withColumn(SLOT, F.expr(slot))
    writer = (
        rows.repartition(buckets, "primary_key", SLOT)
        .write.mode("overwrite")
        .bucketBy(buckets, "primary_key", SLOT)
        .sortBy("primary_key", SLOT)
    )
    (writer.option("path", folder) if folder else writer).saveAsTable(table)


def align_stored(spark: SparkSession, src_table: str, dest_table: str) -> DataFrame:
    """The alignment of two stored sides, in the layout of ``align.align``.

    No exchange where both have the same buckets; other buckets only cost a shuffle.
    """
    src, dest = spark.table(src_table).alias("s"), spark.table(dest_table).alias("d")
    on = (F.col("s.primary_key") == F.col("d.primary_key")) & (F.col(f"s.{SLOT}") == F.col(f"d.{SLOT}"))
    # Merging is asked for: a side that looks small to the planner may hold wide rows.
    joined = src.join(dest.hint("merge"), on, "full_outer")
    common = (*PLACE, "primary_key", "occurrence")
    return joined.selectExpr(
        *(f"coalesce({path('s', c)}, {path('d', c)}) AS {c}" for c in common),
        "s.src AS src",
        "d.dest AS dest",
        "s.cells AS src_cells",
        "d.cells AS dest_cells",
    )
