"""A report stored as a log of changes: upserts and tombstones, merged when read.

An upsert writes its records and nothing else; a purge writes the keys that go.
Both are dealt into buckets by a hash of the key. Reading takes the
newest base and the changes after it, and the last word on a key counts. Compaction
folds the changes into a new base, bucket by bucket: buckets without changes
keep their files.

A purge rests on the version its keys were read from. It counts as said at that
version, so a record that another run has upserted since stays. So neither
upserts, purges nor compactions conflict: any order of commits keeps all
records, and a writer that loses a number takes the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.sources.commits import CommitLog, new_folder

BUCKETS = 64
UPSERT, PURGE, BASE = "upsert", "purge", "base"
# Columns of the files beside the record's own.
BUCKET, GONE, SAID = "_bucket", "_gone", "_said"


class ReportLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, CommitLog(spark, path)

    # --- what is there

    def _state(self) -> tuple[dict | None, list[tuple[int, dict]]]:
        """The base that covers most, and the changes it does not cover."""
        base, changes = None, []
        for number, facts in self.log.newest_first():
            if facts["kind"] != BASE:
                changes.append((number, facts))
            elif base is None or facts["covers"] > base["covers"]:
                base = facts
            # Every commit below was there when the base was made.
            if base is not None and number <= base["covers"]:
                break
        covered = base["covers"] if base else 0
        return base, [(n, f) for n, f in changes if n > covered]

    def version(self) -> int:
        """Number of the newest commit; 0 for none."""
        return self.log.latest()

    def read(self) -> DataFrame | None:
        """The records that hold now; None if nothing was ever stored."""
        base, changes = self._state()
        if base is None and not changes:
            return None
        facts, parts = base or changes[-1][1], self._parts(base, changes)
        if not parts:
            return self.spark.createDataFrame([], self._schema(facts))
        return self._merged(parts, facts).drop(BUCKET)

    def _schema(self, facts: dict) -> T.StructType:
        return T.StructType.fromJson(facts["schema"])

    def _files(self, folders: Sequence[str], facts: dict, keys_only: bool = False) -> DataFrame:
        own = self._schema(facts)
        if keys_only:
            own = T.StructType([f for f in own if f.name in facts["key"]])
        schema = T.StructType([T.StructField(BUCKET, T.IntegerType()), *own])
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths)

    def _parts(
        self, base: dict | None, changes: list[tuple[int, dict]], buckets: set[int] | None = None
    ) -> list[DataFrame]:
        """Base and changes with when they were said, of all buckets or some."""

        def folders(facts: dict) -> list[str]:
            return [f for b, f in facts["buckets"].items() if buckets is None or int(b) in buckets]

        parts = []
        if base and folders(base):
            said = F.struct(F.lit(base["covers"]).alias("at"), F.lit(False).alias("gone"))
            parts.append(self._files(folders(base), base).withColumn(SAID, said))
        for number, facts in changes:
            if not folders(facts):
                continue
            gone = facts["kind"] == PURGE
            at = min(facts["as_of"], number) if gone else number
            said = F.struct(F.lit(at).alias("at"), F.lit(gone).alias("gone"))
            parts.append(self._files(folders(facts), facts, gone).withColumn(SAID, said))
        return parts

    def _merged(self, parts: list[DataFrame], facts: dict) -> DataFrame:
        """The last word on every key; one aggregate over all parts, folded before the shuffle."""
        key, columns = facts["key"], [f.name for f in self._schema(facts)]
        rest = [c for c in columns if c not in key]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        last = F.max(F.struct(SAID, *(F.col(f"`{c}`") for c in rest))).alias("last")
        kept = rows.groupBy(BUCKET, *(F.col(f"`{k}`") for k in key)).agg(last).where(f"NOT last.{SAID}.gone")
        return kept.select(
            BUCKET, *(F.col(f"`{c}`") if c in key else F.col("last")[c].alias(c) for c in columns)
        )

    # --- changes

    def _bucket(self, key: Sequence[str], buckets: int) -> Column:
        # Text forms, so that a key's bucket does not depend on its type.
        texts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\0")) for k in key]
        return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str, key: Sequence[str], buckets: int) -> dict[str, str]:
        """Write rows by bucket; the folder of every bucket that has some."""
        folder = new_folder(name)
        dealt = rows if BUCKET in rows.columns else rows.withColumn(BUCKET, self._bucket(key, buckets))
        # The directory's name holds the bucket as well; the column stays in the files.
        dealt = dealt.withColumn("_in", F.col(BUCKET)).repartition(BUCKET)
        dealt.write.partitionBy("_in").parquet(f"{self.path}/{folder}")
        return {f.removeprefix("_in="): f"{folder}/{f}" for f in self.log.folders(folder)}

    def _like(self) -> dict | None:
        """Facts of any earlier commit, for the key, the columns and the number of buckets."""
        return next((facts for _, facts in self.log.newest_first()), None)

    def upsert(self, records: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> int:
        """Add or replace records, one per key: of repeated ones the greatest counts."""
        like = self._like()
        if like:
            key, buckets = like["key"], like["n_buckets"]
            records = records.select(*(F.col(f"`{f['name']}`") for f in like["schema"]["fields"]))
        schema = like["schema"] if like else records.schema.jsonValue()
        facts = {"kind": UPSERT, "key": list(key), "schema": schema, "n_buckets": buckets}
        facts["buckets"] = self._write(_one_per_key(records, key), UPSERT, key, buckets)
        return self.log.commit(facts)

    def purge(self, records: DataFrame, as_of: int) -> int:
        """Take the records of these keys away, unless they were said again after ``as_of``."""
        like = self._like()
        if like is None:
            raise ValueError(f"there is no report in {self.path}")
        key = like["key"]
        gone = records.select(*(F.col(f"`{k}`") for k in key)).distinct()
        facts = {f: like[f] for f in ("key", "schema", "n_buckets")} | {"kind": PURGE, "as_of": as_of}
        facts["buckets"] = self._write(gone, PURGE, key, like["n_buckets"])
        return self.log.commit(facts)

    def compact(self) -> int | None:
        """Fold all changes into a new base; None if there are none.

        Buckets that no change touches are carried over by name.
        """
        base, changes = self._state()
        if not changes:
            return None
        facts = base or changes[-1][1]
        dirty = {int(b) for _, f in changes for b in f["buckets"]}
        made = {f: facts[f] for f in ("key", "schema", "n_buckets")}
        made |= {"kind": BASE, "covers": max(n for n, _ in changes), "buckets": {}}
        if base:
            made["buckets"] = {b: f for b, f in base["buckets"].items() if int(b) not in dirty}
        if dirty:
            rows = self._merged(self._parts(base, changes, dirty), facts)
            made["buckets"] |= self._write(rows, BASE, facts["key"], facts["n_buckets"])
        return self.log.commit(made)


def _one_per_key(records: DataFrame, key: Sequence[str]) -> DataFrame:
    rest = [c for c in records.columns if c not in key]
    if not rest:
        return records.distinct()
    kept = records.groupBy(*(F.col(f"`{k}`") for k in key)).agg(
        F.max(F.struct(*(F.col(f"`{c}`") for c in rest))).alias("kept")
    )
    return kept.select(
        *(F.col(f"`{c}`") if c in key else F.col("kept")[c].alias(c) for c in records.columns)
    )
