"""The discrepancy report, its summary and its sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.config import Compare
from tallymend.functions.cells import NO_TEXT, apart
from tallymend.operators.diff import differing_cells, with_digests

MISMATCH, MISSING, EXTRA = "mismatch", "missing_in_dest", "extra_in_dest"

# ``occurrence`` tells the records of duplicate keys apart; the raw values are
# what a repair writes.
REPORT_COLUMNS = (
    "primary_key",
    "type",
    "column",
    "source_value",
    "dest_value",
    "source_hash",
    "dest_hash",
    "year",
    "month",
    "week",
    "source_raw",
    "dest_raw",
    "occurrence",
)
REPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REPORT_COLUMNS])


def _row_json(name: str) -> str:
    return f"to_json({name}, map('ignoreNullFields', 'false'))"


def _whole_row(source: str, dest: str) -> str:
    absent = ("source_raw", "dest_raw")
    return (
        f"array(named_struct('column', {NO_TEXT}, 'source_value', {source}, 'dest_value', {dest}, "
        + ", ".join(f"'{name}', {NO_TEXT}" for name in absent)
        + "))"
    )


def report(aligned: DataFrame, columns: Sequence[str], options: Compare = Compare()) -> DataFrame:
    """All discrepancies of an alignment, one row each, as text.

    Missing and extra rows have no column and carry the whole row as JSON. The
    three kinds come out of one pass, not out of three reads of the alignment.
    """
    records = (
        f"CASE WHEN dest IS NULL THEN {_whole_row(_row_json('src'), NO_TEXT)}"
        f" WHEN src IS NULL THEN {_whole_row(NO_TEXT, _row_json('dest'))}"
        f" ELSE {differing_cells(aligned, columns, options)} END"
    )
    # A row without a key has no position; its content tells it apart.
    content = f"md5(coalesce({_row_json('src')}, {_row_json('dest')}))"
    fixed = ("primary_key", "type", "year", "month", "week", "occurrence")
    rows = aligned.selectExpr("*", f"{apart(records, 'occurrence')} AS records")
    pair = "CASE WHEN src IS NOT NULL AND dest IS NOT NULL THEN records END"
    return (
        with_digests(aligned, rows, columns, options, pair)
        .selectExpr(
            "cast(primary_key AS string) AS primary_key",
            f"CASE WHEN dest IS NULL THEN '{MISSING}' WHEN src IS NULL THEN '{EXTRA}'"
            f" ELSE '{MISMATCH}' END AS type",
            "year",
            "month",
            "week",
            f"coalesce(cast(occurrence AS string), {content}) AS occurrence",
            "source_hash",
            "dest_hash",
            "records",
        )
        .selectExpr(*fixed, "source_hash", "dest_hash", "inline_outer(records)")
        .where(f"column IS NOT NULL OR type <> '{MISMATCH}'")
        .select(*REPORT_COLUMNS)
    )


def summary(found: DataFrame) -> DataFrame:
    """Records per partition, type and column."""
    return found.groupBy("year", "month", "week", "type", "column").agg(
        F.count("*").alias("records")
    )


def sample(found: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` mismatching keys, each with its first difference.

    The first difference per key is an aggregate that folds before the
    shuffle, so a key with many differences costs no more than another.
    """
    first = F.expr("min(struct(column, occurrence, source_value, dest_value)) AS first")
    return (
        found.where(f"type = '{MISMATCH}'")
        .groupBy("primary_key")
        .agg(first)
        .orderBy("primary_key")
        .limit(n)
        .select("primary_key", "first.column", "first.source_value", "first.dest_value")
    )


def echo(found: DataFrame, n: int = 20) -> None:
    """Print some records; never the whole report."""
    found.limit(n).show(n, truncate=False)
