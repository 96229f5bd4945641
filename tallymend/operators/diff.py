"""Cell differences of aligned rows, flat or nested.

The whole comparison is one expression per aligned row: an array of the cells
that differ, NULL for an equal row, unfolded afterwards. So width times rows
never exists. There is deliberately no filter on the comparison itself, and the
unfolding is an outer one so that none is inferred: Catalyst would carry that
large condition through every later projection as a constraint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.config import Compare
from tallymend.functions.cells import NO_TEXT, Cell, apart, cells_equal, literal, raw_text
from tallymend.functions.hashing import row_hash
from tallymend.operators.align import aligned_cell, matched_pairs

CELL_FIELDS = ("column", "source_value", "dest_value", "source_raw", "dest_raw")
PAIR_KEYS = ("year", "month", "week", "primary_key", "occurrence")


def _cell(aligned: DataFrame, name: str, column: str) -> Cell:
    types = (aligned.schema[side].dataType for side in ("src", "dest"))
    return aligned_cell(*types, name, column)


def differs(aligned: DataFrame, column: str, options: Compare = Compare()) -> str:
    """True where the cell is a reportable difference; never NULL."""
    s, d = _cell(aligned, "src", column), _cell(aligned, "dest", column)
    unequal = f"NOT {cells_equal(s, d, options.tolerance)}"
    if options.include_nulls:
        return f"({unequal})"
    return f"({s.raw} IS NOT NULL AND {d.raw} IS NOT NULL AND {unequal})"


def hashes(aligned: DataFrame, columns: Sequence[str], algo: str) -> tuple[str, str]:
    """Row digests of both sides over the compared columns."""
    return tuple(
        row_hash({c: _cell(aligned, name, c) for c in columns}, algo) for name in ("src", "dest")
    )


def pairs_with_unequal_hash(aligned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Matched pairs whose row digests differ."""
    src, dest = hashes(aligned, columns, "xxhash64")
    return matched_pairs(aligned).where(f"{src} <> {dest}")


def discard_equal(aligned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Aligned rows without the pairs whose row digests agree."""
    src, dest = hashes(aligned, columns, "xxhash64")
    return aligned.where(f"src IS NULL OR dest IS NULL OR {src} <> {dest}")


def hash_counts(aligned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per partition: pairs discarded for equal digests, and pairs kept."""
    src, dest = hashes(aligned, columns, "xxhash64")
    return (
        matched_pairs(aligned)
        .selectExpr("year", "month", "week", f"{src} = {dest} AS agree")
        .groupBy("year", "month", "week")
        .agg(F.expr("count_if(agree) AS discarded"), F.expr("count_if(NOT agree) AS kept"))
    )


def differing_cells(
    aligned: DataFrame, columns: Sequence[str], options: Compare = Compare()
) -> str:
    """ARRAY of the differing cells of a pair, in column order; NULL for none."""
    flags = {c: differs(aligned, c, options) for c in columns}

    def entry(column: str) -> str:
        s, d = _cell(aligned, "src", column), _cell(aligned, "dest", column)
        return (
            f"CASE WHEN {flags[column]} THEN array(named_struct('column', {literal(column)},"
            f" 'source_value', {s.canonical()}, 'dest_value', {d.canonical()},"
            f" 'source_raw', {raw_text(s.raw, s.dtype)}, 'dest_raw', {raw_text(d.raw, d.dtype)}"
            f")) ELSE array() END"
        )

    if not columns:
        raise ValueError("no columns to compare")
    any_flag = " OR ".join(flags.values())
    return f"CASE WHEN {any_flag} THEN concat({', '.join(entry(c) for c in columns)}) END"


def with_digests(
    aligned: DataFrame, rows: DataFrame, columns: Sequence[str], options: Compare, found: str
) -> DataFrame:
    """``rows`` of ``aligned`` with both digests, where ``found`` is not NULL.

    Two columns per row, not two texts per cell. Equal digests imply equal
    cells, so the digests never change which cells differ.
    """
    src_hash, dest_hash = (
        hashes(aligned, columns, "md5") if options.use_row_hash else (NO_TEXT, NO_TEXT)
    )
    return rows.selectExpr(
        "*",
        *(
            f"CASE WHEN {found} IS NOT NULL THEN {apart(digest, 'occurrence')} END AS {name}"
            for name, digest in (("source_hash", src_hash), ("dest_hash", dest_hash))
        ),
    )


def _differing_rows(aligned: DataFrame, columns: Sequence[str], options: Compare) -> DataFrame:
    cells = apart(differing_cells(aligned, columns, options), "occurrence")
    rows = matched_pairs(aligned).selectExpr("*", f"{cells} AS cells")
    return with_digests(aligned, rows, columns, options, "cells")


def diff(aligned: DataFrame, columns: Sequence[str], options: Compare = Compare()) -> DataFrame:
    """One row per differing cell."""
    return (
        _differing_rows(aligned, columns, options)
        .selectExpr(*PAIR_KEYS, "source_hash", "dest_hash", "inline_outer(cells)")
        .where("column IS NOT NULL")
        .select(*PAIR_KEYS, *CELL_FIELDS, "source_hash", "dest_hash")
    )


def diff_nested(
    aligned: DataFrame, columns: Sequence[str], options: Compare = Compare()
) -> DataFrame:
    """One row per differing pair, its differences nested in column order."""
    fields = [f"cell.{f} AS {f}" for f in ("column", "source_value", "dest_value")]
    if options.use_row_hash:
        fields += ["source_hash", "dest_hash"]
    return (
        _differing_rows(aligned, columns, options)
        .where("cells IS NOT NULL")
        .selectExpr(
            "primary_key",
            f"transform(cells, cell -> struct({', '.join(fields)})) AS mismatches",
            "struct(year, month, week) AS partition",
        )
    )
