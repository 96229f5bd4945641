"""Copying source values into the destination, and what that leaves to report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.functions.cells import TOLERANCE, cell_equal, literal, orderable, path, raw_text
from tallymend.functions.labels import update_label
from tallymend.operators.align import BROADCAST_BYTES, list_bytes, number_rows
from tallymend.operators.report import MISMATCH
from tallymend.plans.durable import durable
from tallymend.plans.scope import PARTITION, Scope

# A list of planned keys too big to broadcast is sent as a table of so many bits per key, of
# so many bytes at most. Rows whose bit is not set are at no planned key.
FILTER_BITS = 16
FILTER_BYTES = 64 << 20
# Keys of these types are equal exactly if their hashes' inputs are.
HASHED_TYPES = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType)

PLAN_KEYS = ("primary_key", "year", "month", "week", "occurrence")


def candidates(found: DataFrame, scope: Scope | None = None) -> DataFrame:
    """Mismatch records of the given partitions."""
    chosen = found.where(F.col("type") == MISMATCH)
    if scope is None:
        return chosen
    in_scope = F.lit(False)
    for year, month, week in scope.partitions():
        term = (F.col("year") == year) & (F.col("month") == month)
        in_scope = in_scope | (term if week is None else term & (F.col("week") == week))
    return chosen.where(in_scope)


def skip_null_sources(chosen: DataFrame) -> DataFrame:
    """Records with a source value to write."""
    return chosen.where(F.col("source_value").isNotNull() & (F.col("source_value") != ""))


def columns_to_repair(chosen: DataFrame) -> DataFrame:
    """Distinct columns per partition; bounded by the table's width."""
    return chosen.select("year", "month", "week", "column").distinct()


def key_from_text(text: Column, dtype: T.DataType) -> Column:
    """A reported key as a value of the destination's key type."""
    if isinstance(dtype, T.IntegralType):
        # "12.0" is a valid key text when the source key is a decimal.
        return text.try_cast("decimal(38,10)").try_cast(dtype)
    return text.try_cast(dtype)


def plan_repairs(
    found: DataFrame,
    dest: DataFrame,
    *,
    skip_nulls: bool = True,
    scope: Scope | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The updates a repair would make; showing it is the dry run.

    One row per key, partition, occurrence and column. A value that the
    destination column's type would change beyond the tolerance is left out
    and so stays in the report.
    """
    chosen = candidates(found, scope)
    if skip_nulls:
        chosen = skip_null_sources(chosen)
    fits = "CASE column"
    for field in dest.schema.fields:
        if field.name not in PARTITION:
            ok = "source_raw IS NULL"
            if _assignable(field.dataType):
                written = f"try_cast(source_raw AS {field.dataType.simpleString()})"
                same = cell_equal("source_raw", T.StringType(), written, field.dataType, tolerance)
                ok += f" OR ({written} IS NOT NULL AND {same})"
            fits += f" WHEN {literal(field.name)} THEN {ok}"
    fits += " ELSE false END"
    # A report holds a cell once; of repeated records the smallest counts.
    value = F.min(F.struct("source_raw", "source_value", "dest_value", "dest_raw")).alias("v")
    return (
        chosen.where(fits)
        .groupBy(*PLAN_KEYS, "column")
        .agg(value)
        .select(*PLAN_KEYS, "column", "v.*")
    )


def _assignable(dtype: T.DataType) -> bool:
    """Types a reported text can be cast back to."""
    return isinstance(dtype, T.AtomicType) and not isinstance(dtype, (T.BinaryType, T.VariantType))


def _meets(rows: DataFrame, other: DataFrame, key_type: T.DataType) -> Column:
    """Whether a numbered row is the one that a plan's row names."""
    return reduce(
        and_,
        [
            rows["primary_key"] == key_from_text(other["primary_key"], key_type),
            rows["occurrence"].cast("string") == other["occurrence"],
        ]
        + [rows[n].eqNullSafe(other[n]) for n in PLACE[1:]],
    )


def _now(row: T.StructType, column: str) -> str:
    """The text a report would give for the cell as the row holds it."""
    return raw_text(path("dest", column), row[column].dataType)


PLACE = ("primary_key", "year", "month", "week")


@dataclass(frozen=True)
class Planned:
    """A plan set against its destination, in work that grows with the plan.

    ``places``: the keys and partitions it names, each once. ``rows``: all
    destination rows of those, numbered as for the report. Plan and rows are
    written once, so that repair, purge and summary read the same. ``near`` and
    ``far`` make up the destination; no row of ``far`` is at a planned key.
    """

    dest: DataFrame
    key: str
    plan: DataFrame
    places: DataFrame
    rows: DataFrame
    near: DataFrame
    far: DataFrame | None

    @cached_property
    def met(self) -> DataFrame:
        """Updates that meet a row which still holds what the report saw."""
        return durable(_met(self.plan, self.rows, self.key, self.dest.schema[self.key].dataType))


def set_against(
    plan: DataFrame, dest: DataFrame, key: str, columns: Sequence[str] | None = None
) -> Planned:
    """``plan`` against ``dest``; ``columns`` are the compared ones, in the report's order.

    Only rows of planned keys are numbered, shuffled or sorted: a key keeps all
    its rows of the partition, so their numbers are those of the report.
    """
    plan = durable(plan)
    # Measured once, for both joins.
    places, near, far = _listed(_places(plan, dest.schema[key].dataType), dest, key)
    touched = near.join(places, _at_place(near, key, places), "left_semi")
    compared = [c for c in columns or dest.columns if c not in (key, *PARTITION)]
    return Planned(dest, key, plan, places, durable(number_rows(touched, key, compared)), near, far)


def files_of(plan: DataFrame, dest: DataFrame, key: str, file: str) -> list[str]:
    """The files that hold rows of planned keys; ``file`` is the column with their names.

    At most one name per file of the table.
    """
    places = _places(plan, dest.schema[key].dataType)
    held = dest.select(key, *PARTITION, file)
    places, near, _ = _listed(places, held, key)
    held = near.join(places, _at_place(near, key, places), "left_semi")
    return sorted(r[0] for r in held.select(file).distinct().collect())


def _places(plan: DataFrame, key_type: T.DataType) -> DataFrame:
    """Every key and partition that a plan names, once."""
    named = key_from_text(F.col("primary_key"), key_type).alias("primary_key")
    return plan.select(named, "year", "month", "week").distinct()


def _listed(
    places: DataFrame, dest: DataFrame, key: str
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The places for joins with ``dest``, the rows that may meet them, and the others.

    A small list is broadcast and meets all rows, none of them shuffled. Of a large one
    a table of bits is broadcast, so that hardly more rows are shuffled than are planned.
    """
    size = list_bytes(places)
    if size <= BROADCAST_BYTES:
        return F.broadcast(places), dest, None
    if not isinstance(dest.schema[key].dataType, HASHED_TYPES):
        return places, dest, None
    places = durable(places)
    slots = min(FILTER_BITS * max(1, places.count()), 8 * FILTER_BYTES)

    def slot(rows: DataFrame, *columns: str) -> Column:
        first, *partition = (rows[c] for c in columns)
        return F.pmod(F.xxhash64(first, *(p.cast("string") for p in partition)), F.lit(slots)) + 1

    bits = (
        places.select(slot(places, *PLACE).alias("slot"))
        .select(
            F.bitmap_bucket_number("slot").alias("bucket"), F.bitmap_bit_position("slot").alias("bit")
        )
        # Dealt first, so that no task makes bits of all buckets.
        .repartition("bucket")
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    own = slot(dest, key, *PARTITION)
    met = dest.join(F.broadcast(bits), F.bitmap_bucket_number(own) == bits["bucket"], "left")
    bit = F.bitmap_bit_position(own)
    byte = F.substring(bits["bits"], F.floor(bit / 8).cast("int") + 1, F.lit(1))
    set_ = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1
    near = F.coalesce(set_, F.lit(False))
    columns = [dest[f"`{c}`"] for c in dest.columns]
    return places, met.where(near).select(*columns), met.where(~near).select(*columns)


def _at_place(dest: DataFrame, key: str, places: DataFrame) -> Column:
    partition = zip(PARTITION, PLACE[1:], strict=True)
    same = [dest[p].eqNullSafe(places[n]) for p, n in partition]
    return reduce(and_, same, dest[key] == places["primary_key"])


def apply_repairs(
    dest: DataFrame,
    plan: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    planned: Planned | None = None,
) -> DataFrame:
    """The destination with every planned value written.

    Rows of planned keys get their updates in one join; a repeated key's
    updates meet the rows they were found in. All other rows pass as they are,
    unshuffled but for a few where the list of planned keys is too big to broadcast. A
    cell is written only if it still holds what the report saw.
    """
    planned = planned or set_against(plan, dest, key, columns)
    near = planned.near
    rest = near.join(planned.places, _at_place(near, key, planned.places), "left_anti")
    rest = rest if planned.far is None else rest.unionByName(planned.far)
    return repaired_rows(planned).unionByName(rest)


def repaired_rows(planned: Planned) -> DataFrame:
    """The rows of planned keys, with every planned value written.

    The plan is pivoted to one row per key and number with a field per column,
    so all columns are updated together.
    """
    dest, rows, key = planned.dest, planned.rows, planned.key
    row = rows.schema["dest"].dataType
    values = [c for c in dest.columns if c not in (key, *PARTITION)]
    fixes = planned.plan.groupBy(*PLAN_KEYS).agg(
        *(
            F.max(F.when(F.col("column") == c, F.struct("source_raw", "dest_raw"))).alias(f"fix_{i}")
            for i, c in enumerate(values)
        )
    )
    joined = rows.join(fixes, _meets(rows, fixes, dest.schema[key].dataType), "left").select(
        *(rows[p].alias(name) for p, name in zip(PLACE[1:], PARTITION, strict=True)),
        "dest",
        *(f"fix_{i}" for i in range(len(values))),
    )
    updated = {p: F.col(p) for p in PARTITION} | {key: F.col("dest")[key]}
    for i, c in enumerate(values):
        own, fix = F.col("dest")[c], F.col(f"fix_{i}")
        if not orderable(dest.schema[c].dataType):
            own = F.from_json(own, dest.schema[c].dataType.simpleString())
        as_seen = fix.isNotNull() & F.expr(_now(row, c)).eqNullSafe(fix["dest_raw"])
        updated[c] = F.when(as_seen, _assigned(fix["source_raw"], dest, c)).otherwise(own)
    return joined.select(*(updated[c].alias(c) for c in dest.columns))


def _assigned(raw: Column, dest: DataFrame, column: str) -> Column:
    dtype = dest.schema[column].dataType
    return raw.try_cast(dtype) if _assignable(dtype) else F.lit(None).cast(dtype)


def _met(plan: DataFrame, rows: DataFrame, key: str, key_type: T.DataType) -> DataFrame:
    """Planned updates that meet a destination row which still holds what was seen."""
    row = rows.schema["dest"].dataType
    now = "CASE column " + " ".join(
        f"WHEN {literal(f.name)} THEN {_now(row, f.name)}" for f in row if f.name != key
    )
    met = rows.join(plan, _meets(rows, plan, key_type)).select(
        *(plan[c] for c in (*PLAN_KEYS, "column", "dest_raw")), "dest"
    )
    return met.where(F.expr(f"{now} END").eqNullSafe(F.col("dest_raw"))).select(*PLAN_KEYS, "column")


def purge_repaired(
    found: DataFrame,
    plan: DataFrame,
    dest: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    planned: Planned | None = None,
) -> DataFrame:
    """The report without the records whose update was written."""
    done = (planned or set_against(plan, dest, key, columns)).met
    return found.join(done, _done(found, done), "left_anti")


def purged_records(found: DataFrame, planned: Planned) -> DataFrame:
    """The records of the report whose update was written."""
    return found.join(planned.met, _done(found, planned.met), "left_semi")


def _done(found: DataFrame, done: DataFrame) -> Column:
    return reduce(
        and_,
        [found["type"] == MISMATCH]
        + [found[n] == done[n] for n in ("primary_key", "column", "occurrence")]
        + [found[n].eqNullSafe(done[n]) for n in PLACE[1:]],
    )


def repair_summary(
    plan: DataFrame,
    dest: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    planned: Planned | None = None,
) -> DataFrame:
    """Destination rows updated per partition and column.

    A NULL column marks a partition's total, a NULL partition the run's.
    """
    return (
        (planned or set_against(plan, dest, key, columns))
        .met.selectExpr(f"{update_label()} AS partition", "column")
        .rollup("partition", "column")
        .agg(F.count("*").alias("rows_updated"))
    )
