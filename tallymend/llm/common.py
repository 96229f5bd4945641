"""What several corpus operators share."""

from __future__ import annotations

import uuid
from sys import getsizeof

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.plans.durable import checkpoint_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def with_row(docs: DataFrame, *own) -> DataFrame:
    """``row``, a struct of all columns, beside columns of one's own: so their names never clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *own)


def rows_of(packed: DataFrame, columns: list[str]) -> list[Column]:
    """The given columns of ``row``."""
    return [F.col("row")[c].alias(c) for c in columns]


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed files below the shared checkpoint folder, and read back."""
    folder = work_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """``df`` written once, its rows dealt into files by a hash of ``column``.

    A join or group by that column reads the files as they lie, without
    shuffling them. There are as many buckets as shuffle partitions. The
    catalog's entry goes at once; the files stay below the checkpoint folder.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", work_folder(spark, "bucketed"))
    writer.bucketBy(shuffle_partitions(spark), column).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


class Memory(dict):
    """Remembers what ``make`` gave; starts anew beyond ``most`` bytes, by estimate."""

    ENTRY = 120

    def __init__(self, make, most: int = 32 << 20):
        super().__init__()
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, key):
        value = self.make(key)
        self.keep(key, value)
        return value

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def keep(self, key, value) -> None:
        size = self.ENTRY + getsizeof(key) + getsizeof(value)
        if self.held + size > self.most:
            self.clear()
        if size <= self.most:
            self[key] = value
            self.held += size
