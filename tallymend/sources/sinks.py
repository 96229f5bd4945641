"""Where discrepancies go: append, upsert, versioned folders, CSV, JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.sources.commits import CommitLog, new_folder
from tallymend.sources.reportlog import ReportLog

WRITE_ROWS = 1000
KEY_LENGTH = 500
# A record is the same record when all of these agree, NULLs included.
MERGE_KEY = ("primary_key", "column", "type", "year", "month", "week", "occurrence")
# The narrower key of two columns only.
PAIR_KEY = ("primary_key", "column")


def same_record(a: DataFrame, b: DataFrame, key: Sequence[str]) -> Column:
    return reduce(and_, (a[k].eqNullSafe(b[k]) for k in key))


def one_per_key(records: DataFrame, key: Sequence[str] = MERGE_KEY) -> DataFrame:
    """One record per key: the greatest of its remaining values.

    An aggregate, so records of a repeated key fold before the shuffle.
    """
    rest = [c for c in records.columns if c not in key]
    if not rest:
        return records.select(*key).distinct()
    kept = records.groupBy(*key).agg(F.max(F.struct(*rest)).alias("kept"))
    return kept.select(*(F.col(c) if c in key else F.col("kept")[c].alias(c) for c in records.columns))


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str] = MERGE_KEY) -> DataFrame:
    """``existing`` with the records of ``new`` updated or added.

    One aggregate over both, so each is read once; a new record wins over an
    existing one. Upserting the same records again changes nothing.
    """
    columns = existing.columns
    rest = [c for c in columns if c not in key]
    both = existing.withColumn("is_new", F.lit(False)).unionByName(
        new.select(*columns).withColumn("is_new", F.lit(True))
    )
    kept = both.groupBy(*key).agg(F.max(F.struct("is_new", *rest)).alias("kept"))
    return kept.select(*(F.col(c) if c in key else F.col("kept")[c].alias(c) for c in columns))


def write_records(records: DataFrame, path: str, key: Sequence[str] = MERGE_KEY) -> int:
    """Append to a folder of parquet files, or upsert where there is a key.

    Records without any key column are appended as they are. An upsert is a
    commit of the report's log: it writes these records only. Returns the
    commit's number, 0 for an append.
    """
    key = [k for k in key if k in records.columns]
    if not {"primary_key", "column"} & set(records.columns):
        append(records, path)
        return 0
    return ReportLog(records.sparkSession, path).upsert(records, key)


def append(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest commit under ``path``; 0 for none."""
    return CommitLog(spark, path).latest()


VERSION = "version"


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table, or the records that hold in a report; None for nothing."""
    _, facts = next(CommitLog(spark, path).newest_first(), (0, None))
    if facts is None:
        return None
    if facts["kind"] == VERSION:
        return spark.read.parquet(f"{path}/{facts['folder']}")
    return ReportLog(spark, path).read()


def write_version(df: DataFrame, path: str, based_on: int | None = None) -> int:
    """Write a whole new version and then commit it.

    The version being read is never overwritten, and one that failed half way
    is never named. With ``based_on``, the version that ``df`` was made from, a
    version that another writer has committed since raises Conflict.
    """
    folder = new_folder("data")
    df.write.parquet(f"{path}/{folder}")
    log = CommitLog(df.sparkSession, path)
    return log.commit({"kind": VERSION, "folder": folder}, based_on, lambda other: based_on is not None)


def merge_into(records: DataFrame, table: str, key: Sequence[str] = MERGE_KEY) -> None:
    """Upsert into a table of a catalog that supports row-level merges."""
    key = [k for k in key if k in records.columns]
    matched = reduce(and_, (F.col(f"{table}.{k}").eqNullSafe(F.col(f"incoming.{k}")) for k in key))
    (
        one_per_key(records, key)
        .alias("incoming")
        .mergeInto(table, matched)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def create_table(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Create a discrepancy table of text columns unless it exists."""
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet")


def dialect_of(options: Mapping[str, str]) -> str:
    """``oracle``, ``sqlserver`` or another name, from the connection's address."""
    return options.get("url", "").removeprefix("jdbc:").partition(":")[0]


# How long a VARCHAR column of the dialect can be.
LONGEST = {"oracle": 4000, "sqlserver": 8000}


def jdbc_column_types(columns: Sequence[str], dialect: str = "") -> str:
    """Short types for the key columns of a database table, the longest for the rest.

    Oracle's default for text is 255 characters. A whole row longer than the
    dialect's limit needs a table made beforehand.
    """
    lengths = {c: KEY_LENGTH if c in PAIR_KEY else LONGEST.get(dialect) for c in columns}
    return ", ".join(f"`{c}` VARCHAR({n})" for c, n in lengths.items() if n)


def write_jdbc(
    records: DataFrame, options: dict[str, str], table: str, *, mode: str = "append"
) -> None:
    """Write records to a database table, creating it if absent."""
    writer = records.write.format("jdbc").options(**options).option("dbtable", table)
    short = jdbc_column_types(records.columns, dialect_of(options))
    if short:
        writer = writer.option("createTableColumnTypes", short)
    writer.option("batchsize", WRITE_ROWS).mode(mode).save()


def merge_statement(
    table: str,
    staging: str,
    columns: Sequence[str],
    key: Sequence[str] = MERGE_KEY,
    dialect: str = "sqlserver",
) -> str:
    """The database's own upsert of a staging table, NULLs in the key included.

    SQL Server wants the statement ended, Oracle's driver refuses the end.
    """
    key = [k for k in key if k in columns]

    def name(c: str, side: str = "") -> str:
        return f'{side}"{c}"'

    on = " AND ".join(
        f"({name(k, 't.')} = {name(k, 's.')} OR ({name(k, 't.')} IS NULL AND {name(k, 's.')} IS NULL))"
        for k in key
    )
    values = ", ".join(f"{name(c, 't.')} = {name(c, 's.')}" for c in columns if c not in key)
    update = f" WHEN MATCHED THEN UPDATE SET {values}" if values else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON ({on}){update}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(name(c) for c in columns)})"
        f" VALUES ({', '.join(name(c, 's.') for c in columns)})"
        + (";" if dialect == "sqlserver" else "")
    )


def merge_jdbc(
    records: DataFrame, options: dict[str, str], table: str, key: Sequence[str] = MERGE_KEY
) -> None:
    """Upsert records into a database table through a staging table.

    Executors bulk-insert the staging table; the database then merges it, in
    the session of a one-row read, and drops it in another's.
    """
    # A name of its own, so that two runs do not overwrite each other's rows.
    spark, staging = records.sparkSession, f"{table}_{uuid.uuid4().hex[:8]}"
    incoming = one_per_key(records, [k for k in key if k in records.columns])
    write_jdbc(incoming.limit(0), options, table)
    write_jdbc(incoming, options, staging, mode="overwrite")
    merge = merge_statement(table, staging, incoming.columns, key, dialect_of(options))
    for statement, counted in ((merge, staging), (f"DROP TABLE {staging}", table)):
        spark.read.format("jdbc").options(**options).option("sessionInitStatement", statement).option(
            "query", f"SELECT count(*) AS n FROM {counted}"
        ).load().collect()


def write_csv(records: DataFrame, path: str) -> bool:
    """Write a CSV report with a header; False, and no files, when there is nothing."""
    if records.isEmpty():
        print(f"nothing to report, {path} not written")
        return False
    records.write.mode("overwrite").option("header", True).csv(path)
    return True
