"""Leaf digests kept per file, so that a later run reads only files it has not seen.

For tables of files whose files are never written anew under their old names
(``FileTable``). What was digested is a log of commits, each naming a folder of leaves
and one of the files they cover. Digests of other columns, key types or ranges
are of another kind and are not reused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymend.functions.ranges import KeyRanges
from tallymend.operators.align import Sides
from tallymend.operators.checksums import LEAF, SUMS, side_leaves
from tallymend.sources.commits import CommitLog, new_folder
from tallymend.sources.files import FileTable


class DigestStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.log = CommitLog(spark, folder)

    def _stored(self, kind: str) -> list[str]:
        return [f["folder"] for _, f in self.log.newest_first() if f["kind"] == kind]

    def _all(self, folders: list[str], what: str) -> DataFrame:
        return reduce(
            DataFrame.unionByName, (self.spark.read.parquet(f"{self.folder}/{f}/{what}") for f in folders)
        )

    def refresh(
        self,
        table: FileTable,
        lay_out: Callable[[DataFrame], Sides],
        name: str,
        ranges: KeyRanges,
    ) -> tuple[DataFrame, int]:
        """Leaves of the table's newest version, and how many files were read for them.

        ``lay_out`` brings rows into the common layout as side ``name``; it is given the
        table's columns and the file's name. Two writers may digest the
        same new file; it then counts once.
        """
        _, files = table.snapshot()
        empty = lay_out(table.read([], with_file=True))
        laid = empty.src if name == "src" else empty.dest
        said = (laid.schema.simpleString(), name, empty.columns, empty.forms, ranges)
        kind = hashlib.sha256(repr(said).encode()).hexdigest()
        stored = self._stored(kind)
        # One name per file, as listing the table brings to the driver.
        known = {r[0] for r in self._all(stored, "files").collect()} if stored else set()
        new = sorted(set(files) - known)
        if new:
            folder = new_folder("digests")
            at = f"{self.folder}/{folder}"
            rows = lay_out(table.read(new, with_file=True))
            side_leaves(rows, name, ranges, FileTable.FILE).write.parquet(f"{at}/leaves")
            self.spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).write.parquet(
                f"{at}/files"
            )
            self.log.commit({"kind": kind, "folder": folder})
            stored = self._stored(kind)
        if not stored:
            return side_leaves(empty, name, ranges), 0
        now = self.spark.createDataFrame([(f,) for f in files], f"{FileTable.FILE} string")
        leaves = self._all(stored, "leaves").join(now, FileTable.FILE, "left_semi")
        return (
            leaves.dropDuplicates([*LEAF, FileTable.FILE])
            .groupBy(*LEAF)
            .agg(*(F.sum(s).alias(s) for s in SUMS)),
            len(new),
        )
