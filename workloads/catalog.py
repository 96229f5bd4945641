"""The registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.config import Compare, job_from
from tallymend.functions.cells import as_day, as_number, canonical, cell_equal, read_cell, sanitize
from tallymend.functions.hashing import row_hash as digest
from tallymend.functions.labels import partition_label as label_text
from tallymend.functions.ranges import KeyRanges, key_ranges
from tallymend.operators import align as al
from tallymend.operators import checksums as cs
from tallymend.operators import diff as df
from tallymend.operators import proof
from tallymend.operators import repair as rp
from tallymend.operators import report as rep
from tallymend.operators import sampling
from tallymend.plans.durable import checkpoint_folder, durable
from tallymend.plans.job import (
    reconcile,
    reconcile_by_ranges,
    reconcile_stored,
    reconcile_tables,
    repair_files,
)
from tallymend.plans.scope import PARTITION, Scope, expand_scope, tag_partition
from tallymend.sources import sinks
from tallymend.sources import snapshots
from tallymend.sources import tables as tb
from tallymend.sources.digests import DigestStore
from tallymend.sources.files import FileTable
from tallymend.sources.reportlog import ReportLog
from workloads import pairs

Query = Callable[[SparkSession, str], DataFrame]

ORDER_MAP = {
    c: c for c in ("id", "year", "month", "week", "amount", "status", "priority", "order_date")
}
# Key ``line`` has seven values, so every key is far above this many rows.
MANY_ROWS = 50

MONTHS = Scope.of([{"year": 1998, "month": 5}, {"year": 1997, "month": 11}])
ONE_MONTH = Scope.of([{"year": 1998, "month": 5}])
WEEKS = Scope.of([{"year": 1998, "month": 5, "weeks": [1, 3]}])
WEEKS_AND_MONTH = Scope.of(
    [{"year": 1998, "month": 5, "weeks": [1, 3]}, {"year": 1997, "month": 11}]
)

REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


# --- shared inputs


def _order_sides(spark: SparkSession, sf_dir: str) -> al.Sides:
    return al.sides(*pairs.tagged_orders(spark, sf_dir), "id", pairs.ORDER_VALUES)


def _aligned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.align(_order_sides(spark, sf_dir))


def _line_sides(spark: SparkSession, sf_dir: str) -> al.Sides:
    return al.sides(*pairs.tagged_lines(spark, sf_dir), "id", pairs.LINE_VALUES)


def _order_report(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    compare = Compare(include_nulls=True, **options)
    return reconcile_tables(*pairs.tagged_orders(spark, sf_dir), "id", pairs.ORDER_VALUES, compare)


def _line_report(spark: SparkSession, sf_dir: str, key: str = "id", **options) -> DataFrame:
    columns = [c for c in pairs.LINE_VALUES if c != key]
    return reconcile_tables(
        *pairs.tagged_lines(spark, sf_dir), key, columns, Compare(include_nulls=True, **options)
    )


def _comparable(found: DataFrame, *more: str) -> DataFrame:
    """Report columns that read alike in any engine: no JSON of whole rows."""
    return found.selectExpr(
        "primary_key",
        "type",
        "column",
        "CASE WHEN type = 'mismatch' THEN source_value END AS source_value",
        "CASE WHEN type = 'mismatch' THEN dest_value END AS dest_value",
        "year",
        "month",
        *more,
    )


def _scan(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tb.scan_partition(
        pairs.orders_source(spark, sf_dir),
        ORDER_MAP,
        key="id",
        year="year",
        month="month",
        **options,
    )


# --- scans


@query
def scan_partition(spark, sf_dir):
    return _scan(spark, sf_dir, scope=ONE_MONTH)


@query
def project_mapped(spark, sf_dir):
    columns = {
        "id": "o_orderkey",
        "customer": "o_custkey",
        "amount": "o_totalprice",
        "status": "o_orderstatus",
    }
    return tb.project_mapped(pairs.table(spark, sf_dir, "orders"), columns)


@query
def filter_partition(spark, sf_dir):
    """Numeric partition columns: the scope's texts become typed literals."""
    orders = pairs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").cast("bigint").alias("y"),
        F.month("o_orderdate").cast("bigint").alias("m"),
    )
    return orders.where(MONTHS.predicate(orders.schema, "y", "m"))


@query
def filter_partition_week(spark, sf_dir):
    rows = _scan(spark, sf_dir, week="week", scope=WEEKS)
    return rows.select("id", "year", "month", "week", "part_week")


@query
def filter_record(spark, sf_dir):
    return _scan(spark, sf_dir, record="42").drop(*PARTITION)


@query
def scan_ordered(spark, sf_dir):
    return _scan(spark, sf_dir).drop(*PARTITION).orderBy("id")


@query
def scan_limit(spark, sf_dir):
    return _scan(spark, sf_dir, limit=5).drop(*PARTITION)


@query
def scan_limit_large(spark, sf_dir):
    """More rows a year than are kept before a shuffle: the rank is made slice by slice."""
    lines = pairs.lines_source(spark, sf_dir).withColumn("month", F.lit("01"))
    lines = tag_partition(lines, "year", "month")
    return tb.limit_per_partition(lines, "id", 2000).drop(*PARTITION)


@query
def expand_partitions(spark, sf_dir):
    """A scope taken from the orders: even months by week, odd months whole."""
    day = F.col("o_orderdate")
    entries = (
        pairs.table(spark, sf_dir, "orders")
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.collect_set((F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("int")).alias("weeks"))
        .withColumn("weeks", F.expr("CASE WHEN month % 2 = 0 THEN weeks END"))
    )
    return expand_scope(entries)


@query
def partition_label(spark, sf_dir):
    counted = (
        pairs.orders_source(spark, sf_dir)
        .rollup("year", "month", "week")
        .agg(F.count("*").alias("n"))
    )
    return counted.withColumn("label", F.expr(label_text()))


# --- cells


def _both_orders(spark, sf_dir) -> list[tuple[str, DataFrame]]:
    return [
        ("source", pairs.orders_source(spark, sf_dir)),
        ("destination", pairs.orders_dest(spark, sf_dir)),
    ]


@query
def sanitize_cells(spark, sf_dir):
    def cells(side: str, rows: DataFrame) -> DataFrame:
        types = {c: rows.schema[c].dataType for c in pairs.ORDER_VALUES}
        read = rows.selectExpr("id", *(f"{sanitize(c, t)} AS {c}" for c, t in types.items()))
        return read.selectExpr(
            f"'{side}' AS side",
            "id",
            "amount.number AS amount_number",
            "amount.text AS amount_text",
            "status.text AS status_text",
            "priority.text AS priority_text",
            "cast(order_date.day AS string) AS order_day",
        )

    source, dest = (cells(side, rows) for side, rows in _both_orders(spark, sf_dir))
    return source.unionByName(dest)


@query
def normalize_cells(spark, sf_dir):
    def cells(side: str, rows: DataFrame) -> DataFrame:
        types = {c: rows.schema[c].dataType for c in pairs.ORDER_VALUES}
        return rows.selectExpr(
            f"'{side}' AS side", "id", *(f"{canonical(c, t)} AS {c}" for c, t in types.items())
        )

    source, dest = (cells(side, rows) for side, rows in _both_orders(spark, sf_dir))
    return source.unionByName(dest)


@query
def cell_equality(spark, sf_dir):
    source, dest = (rows for _, rows in _both_orders(spark, sf_dir))
    joined = source.alias("s").join(dest.alias("d"), ["id", "year", "month", "week"])
    return joined.selectExpr(
        "id",
        *(
            f"{cell_equal(f's.{c}', source.schema[c].dataType, f'd.{c}', dest.schema[c].dataType)}"
            f" AS {c}_equal"
            for c in pairs.ORDER_VALUES
        ),
    )


@query
def parse_dates(spark, sf_dir):
    """The same day written in every accepted form, and in one that is not."""
    forms = (
        "yyyy-MM-dd",
        "yyyy-MM-dd HH:mm:ss",
        "yyyy/MM/dd",
        "MM/dd/yyyy",
        "dd-MMM-yyyy",
        "MMM d, yyyy",
        "yyyy-MM",
    )
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    written = F.coalesce(
        *(F.when(key % len(forms) == i, F.date_format(day, f)) for i, f in enumerate(forms))
    )
    rows = pairs.table(spark, sf_dir, "orders").select(key.alias("id"), written.alias("written"))
    return rows.selectExpr("id", f"cast({as_day('written', T.StringType())} AS string) AS day")


@query
def parse_numbers(spark, sf_dir):
    """Plain, padded, signed and exponent forms; a suffix or word is no number."""
    written = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN cast(o_totalprice AS string)"
        " WHEN 1 THEN concat(' ', cast(o_totalprice AS string), '\\t')"
        " WHEN 2 THEN concat('-', cast(o_totalprice AS string))"
        " WHEN 3 THEN concat('+', cast(o_totalprice AS string), 'e0')"
        " WHEN 4 THEN concat(cast(o_totalprice AS string), 'd') ELSE o_orderpriority END"
    )
    rows = pairs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), written.alias("written")
    )
    return rows.selectExpr("id", f"{as_number('written', T.StringType())} AS number")


@query
def row_hash(spark, sf_dir):
    rows = pairs.orders_source(spark, sf_dir)
    cells = {c: read_cell(c, rows.schema[c].dataType) for c in pairs.ORDER_VALUES}
    return rows.selectExpr("id", f"{digest(cells, 'md5')} AS digest")


# --- alignment


@query
def align_full_outer(spark, sf_dir):
    return _aligned_orders(spark, sf_dir).selectExpr(
        "primary_key AS id",
        "year",
        "month",
        "week",
        "src.amount AS source_amount",
        "dest.amount AS dest_amount",
        "src IS NOT NULL AS in_source",
        "dest IS NOT NULL AS in_dest",
    )


@query
def matched_pairs(spark, sf_dir):
    return al.matched_pairs(_aligned_orders(spark, sf_dir)).selectExpr(
        "primary_key AS id",
        "year",
        "month",
        "week",
        "src_cells.status.text AS s_status",
        "dest_cells.status.text AS d_status",
    )


@query
def missing_in_dest(spark, sf_dir):
    return al.missing_in_dest(_aligned_orders(spark, sf_dir)).selectExpr(
        "primary_key AS id", "year", "month", "week", "src.status AS status"
    )


@query
def extra_in_dest(spark, sf_dir):
    return al.extra_in_dest(_aligned_orders(spark, sf_dir)).selectExpr(
        "primary_key AS id", "year", "month", "week", "dest.status AS status"
    )


@query
def common_keys(spark, sf_dir):
    return al.common_keys(_order_sides(spark, sf_dir)).withColumnRenamed("primary_key", "id")


def _nullable_key_sides(spark, sf_dir) -> al.Sides:
    """Orders whose key is absent for some customers, differently on each side."""

    def side(every: int) -> DataFrame:
        rows = pairs.table(spark, sf_dir, "orders").selectExpr(
            f"CASE WHEN o_custkey % {every} = 0 THEN NULL ELSE o_orderkey END AS id",
            "cast(year(o_orderdate) AS string) AS year",
            "'00' AS month",
            "o_totalprice AS amount",
        )
        return tag_partition(rows, "year", "month")

    return al.sides(side(3), side(4), "id", ["amount"])


@query
def null_key_count(spark, sf_dir):
    return al.null_key_counts(_nullable_key_sides(spark, sf_dir))


@query
def align_null_keys(spark, sf_dir):
    return al.align(_nullable_key_sides(spark, sf_dir)).selectExpr(
        "primary_key AS id", "year", "src IS NOT NULL AS in_source", "dest IS NOT NULL AS in_dest"
    )


@query
def align_duplicate_keys(spark, sf_dir):
    return al.align(_line_sides(spark, sf_dir)).selectExpr(
        "primary_key AS id",
        "year",
        "month",
        "occurrence",
        *(f"{t}.{c} AS {t[0]}_{c}" for c in ("line", "quantity", "price") for t in ("src", "dest")),
    )


@query
def align_split_keys(spark, sf_dir):
    """Keys with so many rows that their numbering is split over tasks."""
    both = al.sides(*pairs.tagged_lines(spark, sf_dir), "line", ["quantity", "price", "flag"])
    return al.align(both, hot_rows=MANY_ROWS).selectExpr(
        "cast(primary_key AS int) AS id",
        "year",
        "month",
        "occurrence",
        *(f"{t}.{c} AS {t[0]}_{c}" for c in ("quantity", "price", "flag") for t in ("src", "dest")),
    )


def _stored_sides(spark, both: al.Sides, hot_rows: int | None = 1_000_000) -> tuple[str, str]:
    """Both sides as bucketed tables below the shared folder."""
    names = []
    for side in ("src", "dest"):
        name = f"{side}_{uuid.uuid4().hex}"
        snapshots.store_side(both, side, name, 16, f"{_new_folder(spark)}-{side}", hot_rows)
        names.append(name)
    return tuple(names)


@query
def align_stored(spark, sf_dir):
    """Repeated keys from two snapshots bucketed by key and number: a join without exchange."""
    aligned = snapshots.align_stored(spark, *_stored_sides(spark, _line_sides(spark, sf_dir)))
    return aligned.selectExpr(
        "primary_key AS id",
        "year",
        "month",
        "occurrence",
        *(f"{t}.{c} AS {t[0]}_{c}" for c in ("line", "quantity", "price") for t in ("src", "dest")),
    )


@query
def align_stored_null_keys(spark, sf_dir):
    tables = _stored_sides(spark, _nullable_key_sides(spark, sf_dir))
    return snapshots.align_stored(spark, *tables).selectExpr(
        "primary_key AS id", "year", "src IS NOT NULL AS in_source", "dest IS NOT NULL AS in_dest"
    )


@query
def duplicate_keys(spark, sf_dir):
    found = al.duplicate_keys(_line_sides(spark, sf_dir)).drop("week")
    return found.withColumnRenamed("primary_key", "id")


@query
def side_row_counts(spark, sf_dir):
    return al.side_row_counts(_order_sides(spark, sf_dir))


# --- hashes and differences


def _far_numbers(spark: SparkSession, sf_dir: str, planted: bool) -> DataFrame:
    """Order keys far beyond what a double holds exactly; the destination is off by one now and then."""
    key = "o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END" if planted else "o_orderkey"
    rows = pairs.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "cast(year(o_orderdate) AS string) AS year",
        "'00' AS month",
        f"9007199254740992L + ({key}) AS big",
        f"cast('1000000000000000000000000000000' AS decimal(38,0)) + cast({key} AS decimal(20,0)) AS wide",
        f"cast(cast('1234567890123456789' AS decimal(38,7)) + cast({key} AS decimal(20,7)) / 10000000"
        " AS decimal(38,7)) AS fine",
    )
    return tag_partition(rows, "year", "month")


@query
def exact_numbers(spark, sf_dir):
    """Integers and decimals that are equal as doubles: equal rows are dropped by digest first."""
    source, dest = (_far_numbers(spark, sf_dir, planted) for planted in (False, True))
    found = reconcile_tables(
        source, dest, "id", ["big", "wide", "fine"], Compare(use_row_hash=True, discard_equal_first=True)
    )
    return found.select("primary_key", "type", "column", "source_raw", "dest_raw")


@query
def discard_by_hash(spark, sf_dir):
    kept = df.discard_equal(_aligned_orders(spark, sf_dir), pairs.ORDER_VALUES)
    return kept.selectExpr(
        "explode(array_compact(array(CASE WHEN src IS NOT NULL THEN 'source' END,"
        " CASE WHEN dest IS NOT NULL THEN 'destination' END))) AS side",
        "primary_key AS id",
        "year",
        "month",
        "week",
    )


@query
def pairs_hash_differs(spark, sf_dir):
    kept = df.pairs_with_unequal_hash(_aligned_orders(spark, sf_dir), pairs.ORDER_VALUES)
    src, dest = df.hashes(kept, pairs.ORDER_VALUES, "md5")
    return kept.selectExpr(
        "primary_key AS id", "year", "month", "week", f"{src} AS source_hash", f"{dest} AS dest_hash"
    )


@query
def hash_discard_counts(spark, sf_dir):
    return df.hash_counts(_aligned_orders(spark, sf_dir), pairs.ORDER_VALUES)


def _diff(spark, sf_dir, *more: str, aligned: DataFrame | None = None, **options) -> DataFrame:
    compare = Compare(**options)
    aligned = _aligned_orders(spark, sf_dir) if aligned is None else aligned
    cells = df.diff(aligned, compare.columns(pairs.ORDER_VALUES), compare)
    return cells.selectExpr(
        "primary_key AS id", "year", "month", "week", "column", "source_value", "dest_value", *more
    )


@query
def diff_cells(spark, sf_dir):
    return _diff(spark, sf_dir, "source_raw")


@query
def diff_include_nulls(spark, sf_dir):
    return _diff(spark, sf_dir, include_nulls=True)


@query
def diff_exclude_nulls(spark, sf_dir):
    return _diff(spark, sf_dir, include_nulls=False)


@query
def diff_only_columns(spark, sf_dir):
    return _diff(spark, sf_dir, include_nulls=True, only_columns=("status", "priority"))


@query
def diff_strict(spark, sf_dir):
    return _diff(spark, sf_dir, tolerance=0.0)


@query
def diff_hash_then_cells(spark, sf_dir):
    aligned = al.align(_order_sides(spark, sf_dir), discard_equal_first=True)
    return _diff(
        spark, sf_dir, "source_hash", "dest_hash", aligned=aligned, include_nulls=True, use_row_hash=True
    )


@query
def mismatch_nested(spark, sf_dir):
    nested = df.diff_nested(
        _aligned_orders(spark, sf_dir), pairs.ORDER_VALUES, Compare(include_nulls=True)
    )
    return nested.selectExpr(
        "primary_key AS id",
        "partition.year",
        "partition.month",
        "partition.week",
        "cast(size(mismatches) AS bigint) AS cells",
        "array_join(mismatches.column, ',') AS columns",
    )


# --- reports


@query
def discrepancy_report(spark, sf_dir):
    found = _order_report(spark, sf_dir, use_row_hash=True)
    return _comparable(found, "week", "source_hash", "dest_hash")


@query
def discrepancy_report_hash_first(spark, sf_dir):
    found = _order_report(spark, sf_dir, use_row_hash=True, discard_equal_first=True)
    return _comparable(found, "week", "source_hash", "dest_hash")


@query
def discrepancy_report_fine_tolerance(spark, sf_dir):
    """Below the digest's five decimals no row may be dropped early."""
    found = _order_report(
        spark, sf_dir, use_row_hash=True, discard_equal_first=True, tolerance=1e-7
    )
    return _comparable(found, "week")


@query
def discrepancy_report_unique_key(spark, sf_dir):
    found = _order_report(spark, sf_dir, use_row_hash=True, unique_key=True)
    return _comparable(found, "week", "source_hash", "dest_hash")


@query
def discrepancy_report_lines(spark, sf_dir):
    return _comparable(_line_report(spark, sf_dir), "occurrence")


@query
def discrepancy_report_lines_hash_first(spark, sf_dir):
    found = _line_report(spark, sf_dir, use_row_hash=True, discard_equal_first=True)
    return _comparable(found, "occurrence")


@query
def discrepancy_report_split_keys(spark, sf_dir):
    return _comparable(_line_report(spark, sf_dir, "line", hot_rows=MANY_ROWS), "occurrence")


@query
def discrepancy_report_stored(spark, sf_dir):
    tables = _stored_sides(spark, _order_sides(spark, sf_dir))
    compare = Compare(include_nulls=True, use_row_hash=True)
    found = reconcile_stored(spark, *tables, pairs.ORDER_VALUES, compare)
    return _comparable(found, "week", "source_hash", "dest_hash")


@query
def discrepancy_report_by_ranges(spark, sf_dir):
    """Digests per partition and key range first, then only rows of ranges that differ."""
    found = reconcile_by_ranges(
        *pairs.tagged_orders(spark, sf_dir),
        "id",
        pairs.ORDER_VALUES,
        Compare(include_nulls=True, use_row_hash=True),
        ranges=64,
    )
    return _comparable(found, "week", "source_hash", "dest_hash")


@query
def discrepancy_report_lines_by_ranges(spark, sf_dir):
    found = reconcile_by_ranges(
        *pairs.tagged_lines(spark, sf_dir), "id", pairs.LINE_VALUES, Compare(include_nulls=True), ranges=64
    )
    return _comparable(found, "occurrence")


@query
def partition_digests(spark, sf_dir):
    """Rows per partition and side, and whether the two sides' digests agree."""
    both = _order_sides(spark, sf_dir)
    ranges = key_ranges(both.src, "primary_key", 16)
    return cs.partition_counts(*(durable(cs.side_leaves(both, s, ranges)) for s in ("src", "dest")))


@query
def key_range_counts(spark, sf_dir):
    """Rows per fixed range of the key and side; what the ranges cover."""
    ranges = KeyRanges(("1000L", "5000L", "12000L", "1000000000L"))
    source, dest = pairs.orders_source(spark, sf_dir), pairs.orders_dest(spark, sf_dir)
    return source.selectExpr("'source' AS side", f"{ranges.number('id')} AS range").unionByName(
        dest.selectExpr("'destination' AS side", f"{ranges.number('id')} AS range")
    ).groupBy("side", "range").agg(F.count("*").alias("n"))


@query
def reconcile_changed_files(spark, sf_dir):
    """A second run after a repair: only the rewritten files are digested again."""
    folder = _new_folder(spark)
    pairs.orders_source(spark, sf_dir).repartitionByRange(16, "id").write.parquet(f"{folder}/source")
    pairs.orders_dest(spark, sf_dir).repartitionByRange(16, "id").write.parquet(f"{folder}/dest")
    source, dest = (FileTable(spark, f"{folder}/{s}", f"{folder}/{s}-versions") for s in ("source", "dest"))
    store = DigestStore(spark, f"{folder}/digests")
    compare = Compare(include_nulls=True)
    ranges = key_ranges(source.current(), "id", 64)

    def tag(rows: DataFrame) -> DataFrame:
        return tag_partition(rows, "year", "month", "week")

    def lay_out(rows: DataFrame) -> al.Sides:
        return al.sides(tag(rows), tag(rows), "id", pairs.ORDER_VALUES)

    def once() -> DataFrame:
        leaves = tuple(
            store.refresh(t, lay_out, n, ranges)[0] for t, n in ((source, "src"), (dest, "dest"))
        )
        tables = (tag(t.current()) for t in (source, dest))
        return reconcile_by_ranges(
            *tables, "id", pairs.ORDER_VALUES, compare, ranges=ranges, leaves=leaves
        )

    repair_files(durable(once()), dest, "id", tag, columns=pairs.ORDER_VALUES)
    return once().select("primary_key", "type", "column", "year", "month", "week")


def _sampled_orders(spark, sf_dir) -> tuple[DataFrame, float]:
    """The report of 500 sampled keys and their chance."""
    drawn = sampling.sample_keys(_order_sides(spark, sf_dir), 500, seed=7)
    aligned = al.align(drawn.both)
    return rep.report(aligned, pairs.ORDER_VALUES, Compare(include_nulls=True)), drawn.chance


@query
def key_sample_report(spark, sf_dir):
    """The discrepancies of the same 500 keys on both sides."""
    return _comparable(_sampled_orders(spark, sf_dir)[0], "week")


@query
def key_sample_estimates(spark, sf_dir):
    """Records per type and column, estimated from 500 keys."""
    counts = sampling.estimated_counts(*_sampled_orders(spark, sf_dir))
    # Whole numbers read alike in any engine.
    return counts.selectExpr("type", "column", "sampled", "cast(round(records) AS bigint) AS records")


@query
def report_balance(spark, sf_dir):
    """Source, report and destination add up in every partition."""
    return proof.balance(_order_sides(spark, sf_dir), durable(_order_report(spark, sf_dir)))


@query
def report_balance_lines(spark, sf_dir):
    """The same for repeated keys."""
    found = durable(_line_report(spark, sf_dir))
    return proof.balance(_line_sides(spark, sf_dir), found).drop("week")


@query
def report_balance_damaged(spark, sf_dir):
    """A report that lost some records: just their partitions do not add up."""
    found = durable(_order_report(spark, sf_dir)).where(
        "NOT (coalesce(`column`, '') IN ('', 'status') AND cast(primary_key AS bigint) % 5 = 0)"
    )
    return proof.balance(_order_sides(spark, sf_dir), found)


@query
def discrepancy_summary(spark, sf_dir):
    return rep.summary(_order_report(spark, sf_dir))


@query
def mismatch_sample(spark, sf_dir):
    return rep.sample(_order_report(spark, sf_dir))


@query
def reconcile_scope(spark, sf_dir):
    """A run from settings: two weeks of one month and one whole month."""
    pairs.orders_source(spark, sf_dir).createOrReplaceTempView("orders_source")
    pairs.orders_dest(spark, sf_dir).createOrReplaceTempView("orders_dest")
    job = job_from(
        {
            "source": {"type": "table", "table": "orders_source", "columns": list(ORDER_MAP)},
            "destination": {"type": "table", "table": "orders_dest"},
            "primary_key": "id",
            "comparison": {"include_nulls": True},
            "partitioning": {
                "year_column": "year",
                "month_column": "month",
                "week_column": "week",
                "scope": [
                    {"year": "1998", "month": "05", "weeks": [1, 3]},
                    {"year": "1997", "month": 11},
                ],
            },
        }
    )
    return _comparable(reconcile(spark, job), "week")


# --- sinks


RECORD = ["primary_key", "column", "source_value", "dest_value", "year", "month", "week"]


def _new_folder(spark) -> str:
    """A folder of its own below the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/records-{uuid.uuid4().hex}"


def _two_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The mismatches of one run, and of a later run that sees other amounts."""
    first = _order_report(spark, sf_dir).where("type = 'mismatch'").select(*RECORD)
    source, dest = pairs.tagged_orders(spark, sf_dir)
    amount = F.expr("CASE WHEN id % 3 = 0 THEN amount + 2 ELSE amount END")
    changed = dest.withColumn("amount", amount)
    later = reconcile_tables(source, changed, "id", ["amount"], Compare(include_nulls=True))
    return first, later.where("type = 'mismatch'").select(*RECORD)


@query
def upsert_discrepancies(spark, sf_dir):
    folder = _new_folder(spark)
    for records in _two_runs(spark, sf_dir):
        sinks.write_records(records, folder, ("primary_key", "column", "year", "month", "week"))
    return sinks.read_latest(spark, folder)


@query
def append_records(spark, sf_dir):
    folder = _new_folder(spark)
    for records in _two_runs(spark, sf_dir):
        sinks.append(records, folder)
    return spark.read.parquet(folder)


@query
def report_log(spark, sf_dir):
    """Three upserts, a purge and a compaction of the report's log."""
    log = ReportLog(spark, _new_folder(spark))
    first, later = _two_runs(spark, sf_dir)
    # Two upserts read it.
    first = durable(first)
    key = ["primary_key", "column", "year", "month", "week"]
    log.upsert(first, key)
    log.upsert(later, key)
    log.upsert(first.where("month = '05'").withColumn("dest_value", F.lit("third")), key)
    log.purge(log.read().where("year = '1997'"), log.version())
    log.compact()
    return log.read()


# --- repair


def _stored_report(spark, sf_dir) -> DataFrame:
    """The report as a repair finds it: written once, then read several times."""
    return durable(_order_report(spark, sf_dir))


def _dest(spark, sf_dir) -> DataFrame:
    return pairs.tagged_orders(spark, sf_dir)[1]


@query
def repair_candidates(spark, sf_dir):
    return rp.candidates(_order_report(spark, sf_dir), WEEKS_AND_MONTH).select(*RECORD)


@query
def repair_skip_nulls(spark, sf_dir):
    return rp.skip_null_sources(rp.candidates(_order_report(spark, sf_dir))).select(*RECORD)


@query
def repair_skip_nulls_swapped(spark, sf_dir):
    """The destination as source: some of its cells are NULL and must not be written."""
    source, dest = pairs.tagged_orders(spark, sf_dir)
    found = reconcile_tables(dest, source, "id", pairs.ORDER_VALUES, Compare(include_nulls=True))
    return rp.skip_null_sources(rp.candidates(found)).select(*RECORD)


@query
def repair_columns(spark, sf_dir):
    return rp.columns_to_repair(rp.candidates(_order_report(spark, sf_dir)))


@query
def repair_plan(spark, sf_dir):
    plan = rp.plan_repairs(_order_report(spark, sf_dir), _dest(spark, sf_dir))
    return plan.drop("occurrence", "dest_raw")


@query
def repair_apply(spark, sf_dir):
    dest = _dest(spark, sf_dir)
    plan = rp.plan_repairs(_order_report(spark, sf_dir), dest)
    return rp.apply_repairs(dest, plan, "id", pairs.ORDER_VALUES).drop(*PARTITION)


@query
def repair_copy_on_write(spark, sf_dir):
    """The same repair of a table of files: only files with planned keys are rewritten."""
    folder = _new_folder(spark)
    pairs.orders_dest(spark, sf_dir).repartitionByRange(16, "id").write.parquet(folder)
    table = FileTable(spark, folder, f"{folder}-versions")
    repair_files(
        _stored_report(spark, sf_dir),
        table,
        "id",
        lambda rows: tag_partition(rows, "year", "month", "week"),
        columns=pairs.ORDER_VALUES,
    )
    return table.current()


@query
def purge_repaired(spark, sf_dir):
    found, dest = _stored_report(spark, sf_dir), _dest(spark, sf_dir)
    plan = rp.plan_repairs(found, dest)
    left = rp.purge_repaired(found, plan, dest, "id", pairs.ORDER_VALUES)
    return _comparable(left, "week")


@query
def repair_summary(spark, sf_dir):
    dest = _dest(spark, sf_dir)
    plan = rp.plan_repairs(_order_report(spark, sf_dir), dest)
    return rp.repair_summary(plan, dest, "id", pairs.ORDER_VALUES)


@query
def reconcile_then_repair(spark, sf_dir):
    """After a full repair only unpaired rows are left to report."""
    source, dest = pairs.tagged_orders(spark, sf_dir)
    found = _stored_report(spark, sf_dir)
    repaired = rp.apply_repairs(dest, rp.plan_repairs(found, dest), "id", pairs.ORDER_VALUES)
    again = reconcile_tables(
        source, repaired, "id", pairs.ORDER_VALUES, Compare(include_nulls=True)
    )
    return again.select("primary_key", "type", "column", "year", "month", "week")


@query
def reconcile_then_repair_lines(spark, sf_dir):
    """Repeated keys are repaired row by row: only unpaired rows are left."""
    source, dest = pairs.tagged_lines(spark, sf_dir)
    found = durable(_line_report(spark, sf_dir))
    repaired = rp.apply_repairs(dest, rp.plan_repairs(found, dest), "id", pairs.LINE_VALUES)
    again = reconcile_tables(source, repaired, "id", pairs.LINE_VALUES, Compare(include_nulls=True))
    return again.select("primary_key", "type", "column", "year", "month")
