"""Reading one side: project, filter to the scope, tag the partition, limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymend.config import Job, Side
from tallymend.functions.cells import orderable
from tallymend.plans.durable import durable
from tallymend.plans.scope import PARTITION, Scope, tag_partition, typed
from tallymend.sources.jdbc import is_split, jdbc_options, scan_predicates, split_predicates

DATABASES = ("oracle", "sqlserver", "jdbc")
FILES = ("parquet", "orc", "csv", "json")
# A limit is taken per share of a partition first, then over the shares.
LIMIT_SHARES = 1024
# Up to here Spark keeps only the first rows of a share before the shuffle.
SMALL_LIMIT = 1000


def project_mapped(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Physical columns under their logical, lower-case names."""
    return df.select(*(F.col(physical).alias(logical) for logical, physical in columns.items()))


def only_record(df: DataFrame, key: str, value: str) -> DataFrame:
    """The rows of one key; the literal takes the key's type, so it is pushed down."""
    return df.where(F.col(key) == typed(df.schema, key, value))


def limit_per_partition(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key of every partition.

    A small limit cuts each share of a partition before its rows are shuffled;
    a large one would not, so there the rows are range-partitioned in order,
    and a row's rank is its rank in its slice plus the rows of earlier slices.
    Both give the same rows: those of equal key are taken in the order of
    their remaining columns.
    """
    ties = [f.name for f in df.schema if f.name not in (*PARTITION, key) and orderable(f.dataType)]
    order = [F.col(key), *(F.col(c) for c in ties)]
    return _first_by_share(df, order, n) if n <= SMALL_LIMIT else _first_by_slice(df, order, n)


def _first_by_share(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    share = F.pmod(F.xxhash64(order[0], F.spark_partition_id()), F.lit(LIMIT_SHARES))
    in_share = F.row_number().over(Window.partitionBy(*PARTITION, "limit_share").orderBy(*order))
    in_partition = F.row_number().over(Window.partitionBy(*PARTITION).orderBy(*order))
    return (
        df.withColumn("limit_share", share)
        .withColumn("limit_rank", in_share)
        .where(F.col("limit_rank") <= n)
        .withColumn("limit_rank", in_partition)
        .where(F.col("limit_rank") <= n)
        .drop("limit_share", "limit_rank")
    )


def _first_by_slice(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """No task gets more than a slice; slices behind the limit are not ranked at all.

    The slices are written out, so that a lost executor cannot cut them anew.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = durable(
        df.repartitionByRange(slices, *PARTITION, *order).withColumn(
            "limit_slice", F.spark_partition_id()
        )
    )
    before = Window.partitionBy(*PARTITION).orderBy("limit_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most one row per partition and slice.
    begins = (
        sliced.groupBy(*PARTITION, "limit_slice")
        .agg(F.count("*").alias("limit_rows"))
        .withColumn("limit_begin", F.coalesce(F.sum("limit_rows").over(before), F.lit(0)))
        .where(F.col("limit_begin") < n)
        .withColumnsRenamed({c: f"at_{c}" for c in (*PARTITION, "limit_slice")})
    )
    same = reduce(
        and_, (F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in (*PARTITION, "limit_slice"))
    )
    rank = F.row_number().over(Window.partitionBy(*PARTITION, "limit_slice").orderBy(*order))
    return (
        sliced.join(begins, same)
        .withColumn("limit_rank", rank + F.col("limit_begin"))
        .where(F.col("limit_rank") <= n)
        .select(*df.columns)
    )


def load(
    spark: SparkSession,
    side: Side,
    scope: Scope | None,
    key: str,
    partition: tuple[str, str, str | None],
) -> DataFrame:
    """The side's table as Spark reads it; ``key`` and ``partition`` are physical names."""
    if side.type in DATABASES:
        options = jdbc_options(side)
        plain = spark.read.format("jdbc").options(**options, dbtable=side.qualified).load()
        if scope is None or not scope.entries:
            if not is_split(side):
                return plain
            predicates = split_predicates(side, key)
        else:
            predicates = scan_predicates(side, plain.schema, scope, key, *partition)
        return spark.read.jdbc(
            options["url"],
            side.qualified,
            predicates=predicates,
            properties={k: v for k, v in options.items() if k != "url"},
        )
    if side.type == "table":
        return spark.table(side.qualified)
    if side.type in FILES:
        return spark.read.format(side.type).options(**side.options).load(side.table)
    raise ValueError(f"unsupported table type: {side.type!r}")


def scan_partition(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    key: str,
    year: str,
    month: str,
    week: str | None = None,
    scope: Scope | None = None,
    record: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Mapped columns of the rows in scope, tagged with their partition.

    All names are logical. A partition column that is not mapped is read under
    its own name.
    """
    extra = {c: c for c in (year, month, week) if c and c not in columns}
    rows = tag_partition(project_mapped(df, {**columns, **extra}), year, month, week, scope)
    if record is not None:
        rows = only_record(rows, key, record)
    rows = rows.drop(*extra)
    return limit_per_partition(rows, key, limit) if limit else rows


def read_side(spark: SparkSession, job: Job, side: Side) -> DataFrame:
    """One side of a job, ready for alignment."""
    scope = job.scope if job.scope.entries else None

    def physical(name: str | None) -> str | None:
        return side.columns.get(name, name) if name else None

    partition = (
        physical(job.year_column),
        physical(job.month_column),
        physical(job.week_column),
    )
    table = load(spark, side, scope, side.columns[job.primary_key], partition)
    return scan_partition(
        table,
        side.columns,
        key=job.primary_key,
        year=job.year_column,
        month=job.month_column,
        week=job.week_column,
        scope=scope,
        record=job.record,
        limit=job.limit,
    )
