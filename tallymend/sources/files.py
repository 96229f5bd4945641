"""A table as a list of files, of which a new version replaces some.

The table's folder is only read. A version is a manifest: the names of its
files, those of the folder among them, kept with new files in a store of its
own. Replacing files writes the new ones, then commits the version; files that stay
are carried over by name. A writer that finds another one's commit in between builds
on it, unless that commit replaced a file that it has rewritten itself.

The folder holds plain Parquet files: columns in directory names are refused.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.sources.commits import CommitLog, Conflict, new_folder

FILES = "files"


class FileTable:
    # The column that names a row's file.
    FILE = "_file"

    def __init__(self, spark: SparkSession, folder: str, store: str):
        self.spark, self.folder, self.store = spark, folder, store
        self.log = CommitLog(spark, store)

    def _listed(self, manifest: str) -> list[str]:
        """At most one name per file, as Spark's own listing brings to the driver."""
        return [r[0] for r in self.spark.read.parquet(f"{self.store}/{manifest}").collect()]

    def snapshot(self) -> tuple[int, list[str]]:
        """The newest version and its files; version 0 is the folder itself."""
        for number, facts in self.log.newest_first():
            return number, self._listed(facts["manifest"])
        return 0, self._names(self.spark.read.parquet(self.folder))

    def _names(self, rows: DataFrame) -> list[str]:
        """A table's files as its rows name them."""
        return sorted(re.sub("^file:/+", "file:///", f) for f in rows.inputFiles())

    def read(self, files: Sequence[str], with_file: bool = False) -> DataFrame:
        """The rows of some files; none gives an empty table."""
        schema = self.spark.read.parquet(self.folder).schema
        if not files:
            rows = self.spark.createDataFrame([], schema)
            return rows.withColumn(self.FILE, F.lit("")) if with_file else rows
        if any("=" in part for f in files for part in f.removeprefix(self.folder).split("/")[:-1]):
            raise ValueError(f"{self.folder} keeps columns in directory names")
        rows = self.spark.read.schema(schema).parquet(*(unquote(f) for f in files))
        named = F.regexp_replace("_metadata.file_path", "^file:/+", "file:///")
        return rows.select("*", named.alias(self.FILE)) if with_file else rows

    def current(self) -> DataFrame:
        return self.read(self.snapshot()[1])

    def replace(self, based_on: int, files: Sequence[str], rows: DataFrame) -> int:
        """A new version with ``rows`` in new files instead of ``files``."""
        folder, gone = new_folder("data"), set(files)
        rows.write.parquet(f"{self.store}/{folder}")
        added = self._names(self.spark.read.schema(rows.schema).parquet(f"{self.store}/{folder}"))
        while True:
            version, now = self.snapshot()
            if version < based_on or not gone <= set(now):
                raise Conflict(f"version {version} of {self.store} has other files than {based_on}")
            manifest = new_folder("manifest")
            kept = [(f,) for f in now if f not in gone] + [(f,) for f in added]
            listed = self.spark.createDataFrame(kept, "file string")
            listed.coalesce(1).write.parquet(f"{self.store}/{manifest}")
            facts = {"kind": FILES, "manifest": manifest, "removed": len(gone), "added": len(added)}
            if self.log.try_commit(version + 1, facts):
                return version + 1
