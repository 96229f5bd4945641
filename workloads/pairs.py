"""Source and destination pairs derived from the given tables.

The destinations are the same tables with planted differences: dropped and
added rows, changed cells, and changes that must not count (padding, a time of
day, an amount within the tolerance).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.plans.scope import tag_partition

ORDER_VALUES = ["amount", "status", "priority", "order_date"]
LINE_VALUES = ["line", "quantity", "price", "flag"]


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _year(ts: Column) -> Column:
    return F.year(ts).cast("string")


def _month(ts: Column) -> Column:
    return F.lpad(F.month(ts).cast("string"), 2, "0")


def _week(ts: Column) -> Column:
    return (F.floor((F.dayofmonth(ts) - 1) / 7).cast("int") + 1).cast("string")


def _calendar(ts: str) -> list[Column]:
    day = F.col(ts)
    return [_year(day).alias("year"), _month(day).alias("month"), _week(day).alias("week")]


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        *_calendar("o_orderdate"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").cast("string").alias("order_date"),
    )


def orders_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, price, status = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    priority, day = F.col("o_orderpriority"), F.to_date("o_orderdate")

    def every(n: int) -> Column:
        return key % n == 0

    kept = orders.where(key % 97 != 0).select(
        key.alias("id"),
        *_calendar("o_orderdate"),
        F.when(every(31), price + 1.0).when(every(37), price + 0.000001).otherwise(price).alias("amount"),
        F.when(every(41), F.lit(None))
        .when(every(43), F.concat(F.lit("  "), status, F.lit(" ")))
        .when(every(59), F.lit("X"))
        .otherwise(status)
        .alias("status"),
        F.when(every(47), F.lower(priority)).otherwise(priority).alias("priority"),
        F.when(every(53), F.date_add(day, 1).cast("string"))
        .otherwise(F.concat(day.cast("string"), F.lit(" 00:00:00")))
        .alias("order_date"),
    )
    added = orders.where(every(89)).select(
        (key + 1000000000).alias("id"),
        *_calendar("o_orderdate"),
        price.alias("amount"),
        status.alias("status"),
        priority.alias("priority"),
        day.cast("string").alias("order_date"),
    )
    return kept.unionByName(added)


def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        _year(F.col("l_shipdate")).alias("year"),
        _month(F.col("l_shipdate")).alias("month"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )


def lines_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("id") % 11 == 0, F.col("quantity") + 1).otherwise(F.col("quantity"))
    dropped = (F.col("id") % 5 == 0) & (F.col("line") >= 6)
    return lines_source(spark, sf_dir).where(~dropped).withColumn("quantity", changed)


def tagged_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(
        tag_partition(df, "year", "month", "week")
        for df in (orders_source(spark, sf_dir), orders_dest(spark, sf_dir))
    )


def tagged_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tuple(
        tag_partition(df, "year", "month")
        for df in (lines_source(spark, sf_dir), lines_dest(spark, sf_dir))
    )
