"""Whole runs: reconcile a scope, record what was found, repair."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.config import Compare, Job
from tallymend.functions.cells import TOLERANCE
from tallymend.functions.ranges import KeyRanges, key_ranges
from tallymend.operators import align as al
from tallymend.operators import checksums as cs
from tallymend.operators import repair as rp
from tallymend.operators import report as rep
from tallymend.plans.durable import durable
from tallymend.plans.scope import PARTITION, Scope, tag_partition
from tallymend.sources import sinks
from tallymend.sources.files import FileTable
from tallymend.sources.jdbc import jdbc_options
from tallymend.sources.reportlog import ReportLog
from tallymend.sources.snapshots import align_stored
from tallymend.sources.tables import DATABASES, load, read_side


def reconcile_tables(
    src: DataFrame,
    dest: DataFrame,
    key: str,
    columns: list[str] | None = None,
    options: Compare = Compare(),
) -> DataFrame:
    """Discrepancies between two partition-tagged tables, all partitions at once."""
    if columns is None:
        columns = [c for c in src.columns if c in dest.columns and c not in (key, *PARTITION)]
    compared = options.columns(columns)
    both = al.sides(src, dest, key, compared, options.date_forms)
    aligned = al.align(
        both,
        unique_key=options.unique_key,
        # Equal digests mean equal to five decimals; a finer tolerance must see those rows.
        discard_equal_first=options.discard_equal_first and options.tolerance >= TOLERANCE,
        hot_rows=options.hot_rows,
    )
    return rep.report(aligned, compared, options)


def reconcile_by_ranges(
    src: DataFrame,
    dest: DataFrame,
    key: str,
    columns: list[str],
    options: Compare = Compare(),
    *,
    ranges: int | KeyRanges = 256,
    leaves: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The report of ``reconcile_tables``, reading rows again only in key ranges that differ.

    ``leaves`` are digests of the two sides over ``ranges`` that are known already, of
    the same columns (``DigestStore``); without them both sides are digested first. A tolerance finer than the
    digests' five decimals must see all rows.
    """
    compared = options.columns(columns)
    both = al.sides(src, dest, key, compared, options.date_forms)
    keyed, rows, hot_rows = both, None, options.hot_rows
    if options.tolerance >= TOLERANCE:
        cuts = ranges if isinstance(ranges, KeyRanges) else key_ranges(both.src, "primary_key", ranges)
        if leaves is None:
            leaves = tuple(durable(cs.side_leaves(both, name, cuts)) for name in ("src", "dest"))
        dirty = durable(cs.dirty_ranges(*leaves))
        keyed = cs.only_dirty(both, dirty, cuts)
        rows, most = cs.dirty_rows(*leaves, dirty)
        # Where no range has that many rows, no key has, and none need be looked for.
        hot_rows = hot_rows if hot_rows and most >= hot_rows else None
    aligned = al.align(both, unique_key=options.unique_key, hot_rows=hot_rows, keyed=keyed, rows=rows)
    return rep.report(aligned, compared, options)


def reconcile_stored(
    spark: SparkSession, src_table: str, dest_table: str, columns: list[str], options: Compare = Compare()
) -> DataFrame:
    """The report of two sides stored by ``snapshots.store_side``, without a shuffle of rows."""
    return rep.report(align_stored(spark, src_table, dest_table), options.columns(columns), options)


def reconcile(spark: SparkSession, job: Job) -> DataFrame:
    """The discrepancy report of a job."""
    return reconcile_tables(
        read_side(spark, job, job.source),
        read_side(spark, job, job.destination),
        job.primary_key,
        job.value_columns(),
        job.compare,
    )


@dataclass(frozen=True)
class Outcome:
    """What a run found, what it would change, and the changed tables.

    After a dry run ``repaired`` and ``summary`` are None and ``remaining``
    equals ``found``.
    """

    found: DataFrame
    plan: DataFrame
    repaired: DataFrame | None
    remaining: DataFrame
    summary: DataFrame | None = None
    planned: rp.Planned | None = None


def repair(
    found: DataFrame,
    dest: DataFrame,
    key: str,
    *,
    columns: list[str] | None = None,
    dry_run: bool = True,
    skip_nulls: bool = True,
    scope: Scope | None = None,
) -> Outcome:
    """Plan the repairs of a report and, unless it is a dry run, apply them to ``dest``.

    ``dest`` is partition-tagged; ``columns`` are the compared ones, in the
    report's order. Nothing is written: ``repaired`` holds the rows and columns
    of ``dest``, and of nothing else (see ``repair_destination``).
    """
    plan = rp.plan_repairs(found, dest, skip_nulls=skip_nulls, scope=scope)
    if dry_run:
        return Outcome(found, plan, None, found)
    planned = rp.set_against(plan, dest, key, columns)
    return Outcome(
        found,
        planned.plan,
        rp.apply_repairs(dest, planned.plan, key, columns, planned),
        rp.purge_repaired(found, planned.plan, dest, key, columns, planned),
        rp.repair_summary(planned.plan, dest, key, columns, planned),
        planned,
    )


OTHER = "other column "


def whole_destination(spark: SparkSession, job: Job) -> tuple[DataFrame, DataFrame, list[str]]:
    """All rows and columns of the destination: in scope and tagged, out of scope, physical order.

    Mapped columns go under their logical names; the others under a name that
    no logical column has.
    """
    side, scope = job.destination, job.scope if job.scope.entries else None
    table = load(spark, side, None, side.columns[job.primary_key], ("", "", None))
    logical = {physical.lower(): name for name, physical in side.columns.items()}
    names = [logical.get(c.lower(), OTHER + c) for c in table.columns]
    # Mapped columns first: ties between rows break as they did for the report.
    mapped = [n for n in side.columns if n in names]
    renamed = table.toDF(*names).select(*mapped, *(n for n in names if n not in mapped))

    def here(column: str | None) -> str | None:
        return column if column is None or column in names else OTHER + column

    year, month, week = map(here, (job.year_column, job.month_column, job.week_column))
    inside = tag_partition(renamed, year, month, week, scope)
    if scope is None:
        return inside, renamed.limit(0), names
    outside = ~F.coalesce(scope.predicate(renamed.schema, year, month, week), F.lit(False))
    return inside, renamed.where(outside), names


def repair_destination(spark: SparkSession, job: Job, found: DataFrame | None = None) -> Outcome:
    """Repair a job's destination from a report, by default the stored one.

    ``repaired`` is the whole destination: every row, also out of scope, limit
    or record, and every column under its own name. Unless the job is a dry
    run, ``apply_to`` can store it, and the stored report loses what was
    repaired.
    """
    path = job.output.get("path")
    # A purge leaves records alone that are reported again after this version.
    as_of = sinks.latest_version(spark, path) if path else 0
    if found is None:
        found = sinks.read_latest(spark, path) if path else None
        if found is None:
            raise ValueError("there is no stored report to repair from")
    inside, outside, names = whole_destination(spark, job)
    outcome = repair(
        found,
        inside,
        job.primary_key,
        columns=job.compare.columns(job.value_columns()),
        dry_run=job.dry_run,
        skip_nulls=job.skip_nulls,
        scope=job.scope if job.scope.entries else None,
    )
    if outcome.repaired is None:
        return outcome
    whole = outcome.repaired.drop(*PARTITION).unionByName(outside).select(*(f"`{n}`" for n in names))
    physical = [job.destination.columns.get(n, n.removeprefix(OTHER)) for n in names]
    remaining = durable(outcome.remaining)
    if path and as_of:
        ReportLog(spark, path).purge(rp.purged_records(found, outcome.planned), as_of)
    return replace(outcome, repaired=whole.toDF(*physical), remaining=remaining)


def apply_to(outcome: Outcome, target: str, *, table: bool = False) -> None:
    """Store the repaired destination as a new version of a folder, or as a catalog table.

    The tables that were read stay as they are: a version is named only when it
    is complete, and a catalog table of another name is written anew.
    """
    if outcome.repaired is None:
        raise ValueError("a dry run has nothing to store")
    if table:
        outcome.repaired.write.mode("overwrite").saveAsTable(target)
    else:
        sinks.write_version(outcome.repaired, target)


def repair_files(
    found: DataFrame,
    table: FileTable,
    key: str,
    tag: Callable[[DataFrame], DataFrame],
    *,
    columns: list[str] | None = None,
    skip_nulls: bool = True,
    scope: Scope | None = None,
) -> tuple[int, Outcome]:
    """Repair a table of files by rewriting only the files that hold planned keys.

    ``tag`` adds the partition columns (``tag_partition``). Files are found by
    key and partition columns alone. A planned key's rows are numbered over all files that
    hold some, so repeated keys meet their updates. The other files belong to
    the new version under their own names. Returns its number and the outcome,
    ``repaired`` being the rewritten rows.
    """
    version, files = table.snapshot()
    whole = tag(table.read(files))
    plan = durable(rp.plan_repairs(found, whole, skip_nulls=skip_nulls, scope=scope))
    touched = rp.files_of(plan, tag(table.read(files, with_file=True)), key, FileTable.FILE)
    dest = tag(table.read(touched))
    planned = rp.set_against(plan, dest, key, columns)
    repaired = rp.apply_repairs(dest, plan, key, columns, planned)
    if touched:
        version = table.replace(version, touched, repaired.drop(*PARTITION))
    remaining = rp.purge_repaired(found, plan, dest, key, columns, planned)
    summary = rp.repair_summary(plan, dest, key, columns, planned)
    return version, Outcome(found, plan, repaired, remaining, summary, planned)


def store(found: DataFrame, job: Job) -> None:
    """Upsert a report where the job's output says.

    ``path`` is a versioned folder; ``table`` is a table next to the
    destination, when that is a database.
    """
    out = job.output
    if out.get("path"):
        sinks.write_records(found, out["path"])
    elif out.get("table") and job.destination.type in DATABASES:
        table = f"{out['schema']}.{out['table']}" if out.get("schema") else out["table"]
        sinks.merge_jdbc(found, jdbc_options(job.destination), table)


def run(spark: SparkSession, job: Job, *, show: int = 0) -> Outcome:
    """Reconcile, record and, where the job asks for it, repair.

    The report is written once and read back, so that showing, upserting,
    planning and purging do not align the tables again. An applied repair
    covers the whole destination; ``updates.target`` names a folder to store it.
    """
    found = durable(reconcile(spark, job))
    if show:
        rep.echo(found, show)
    store(found, job)
    job = replace(job, dry_run=job.dry_run or not job.auto_repair)
    outcome = repair_destination(spark, job, found)
    if outcome.repaired is not None and job.repair_target:
        apply_to(outcome, job.repair_target)
    return outcome
