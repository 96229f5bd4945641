"""An independent check that a report accounts for every difference.

Every cell of every row has a digest of key, column and canonical text. Per partition the
sums must satisfy: source - missing rows + extra rows, with each reported cell exchanged,
= destination. Nothing is aligned or sorted, so the check shares no code with what it
checks beyond reading cells.

It needs a report that includes NULL differences. Two numbers that the tolerance makes equal
although they differ at five decimals are not reported and leave their partition unbalanced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.functions.cells import apart, literal, path, read_cell
from tallymend.functions.hashing import NULL_MARK
from tallymend.operators.align import Sides
from tallymend.operators.checksums import PLACE
from tallymend.operators.report import EXTRA, MISMATCH, MISSING


def _cell_digest(key: str, column: str, text: str) -> str:
    return f"xxhash64({', '.join(f'''coalesce({t}, r'{NULL_MARK}')''' for t in (key, column, text))})"


# A digest's bits in three numbers, whose sums over 2^41 cells fit a BIGINT: adding decimals
# took most of the time.
PART_BITS = 22
PARTS = ("low", "middle", "high")


def _part(digest: str, i: int) -> str:
    return f"(shiftrightunsigned({digest}, {PART_BITS * i}) & {(1 << PART_BITS) - 1}L)"


def _row_digests(both: Sides, name: str) -> str:
    """ARRAY of the digests of a row's cells; the row is a struct ``name``."""
    row = both.src_row if name == "src" else both.dest_row
    digests = (
        _cell_digest(
            "key", literal(c), read_cell(path(name, c), row[c].dataType, both.forms).canonical()
        )
        for c in both.columns
    )
    return f"array({', '.join(digests)})"


def _added(both: Sides, i: int) -> str:
    """Part ``i`` of the digests of a row's cells, added up."""
    return "(" + " + ".join(["0L", *(_part(f"digests[{n}]", i) for n in range(len(both.columns)))]) + ")"


COUNTS = ("src_rows", "dest_rows", "missing_rows", "extra_rows", "cells")


def _rows(both: Sides, name: str, sign: int) -> DataFrame:
    """What the rows of a side add to the balance."""
    rows = both.src if name == "src" else both.dest
    return (
        rows.selectExpr(*PLACE, "cast(primary_key AS string) AS key", name)
        .selectExpr(*PLACE, f"{apart(_row_digests(both, name), 'key')} AS digests")
        .selectExpr(
            *PLACE,
            *(f"{sign} * {_added(both, i)} AS {part}" for i, part in enumerate(PARTS)),
            *(f"{int(c == f'{name}_rows')}L AS {c}" for c in COUNTS),
        )
    )


def _records(both: Sides, found: DataFrame) -> DataFrame:
    """What the records add to the balance, in one pass over the report."""

    def whole(kind: str, value: str, schema: T.StructType) -> Column:
        return F.when(F.col("type") == kind, F.from_json(value, schema))

    cells = ", ".join(_cell_digest("key", "column", v) for v in ("source_value", "dest_value"))
    digests = (
        f"CASE type WHEN '{MISSING}' THEN {_row_digests(both, 'src')}"
        f" WHEN '{EXTRA}' THEN {_row_digests(both, 'dest')} ELSE array({cells}) END"
    )
    kinds = {"missing_rows": MISSING, "extra_rows": EXTRA, "cells": MISMATCH}
    return (
        found.where(F.col("type").isin(*kinds.values()))
        .select(
            *PLACE,
            "type",
            "column",
            "source_value",
            "dest_value",
            F.col("primary_key").alias("key"),
            whole(MISSING, "source_value", both.src_row).alias("src"),
            whole(EXTRA, "dest_value", both.dest_row).alias("dest"),
        )
        .selectExpr(*PLACE, "type", f"{apart(digests, 'key')} AS digests")
        .selectExpr(
            *PLACE,
            *(
                f"CASE type WHEN '{MISSING}' THEN -{_added(both, i)} WHEN '{EXTRA}' THEN {_added(both, i)}"
                f" ELSE {_part('digests[1]', i)} - {_part('digests[0]', i)} END AS {part}"
                for i, part in enumerate(PARTS)
            ),
            *(f"if(type = '{kinds[c]}', 1L, 0L) AS {c}" if c in kinds else f"0L AS {c}" for c in COUNTS),
        )
    )


def balance(both: Sides, found: DataFrame) -> DataFrame:
    """Per partition: rows per side, records per type, and whether the report balances.

    One aggregation whose partial sums are all that is shuffled. Rows without a key count
    like others; repeated rows and records count as often as they occur. Partitions that
    only the report names are listed, unbalanced unless their records cancel.
    """

    parts = [_rows(both, "src", 1), _rows(both, "dest", -1), _records(both, found)]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*PLACE)
        .agg(
            *(F.sum(c).alias(c) for c in COUNTS),
            F.expr(" AND ".join(f"sum({p}) = 0" for p in PARTS)).alias("even"),
        )
        .selectExpr(
            *PLACE,
            *COUNTS,
            "even AND src_rows - missing_rows + extra_rows = dest_rows AS balanced",
        )
    )
