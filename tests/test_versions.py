"""Commits, the report's log, and repairs that rewrite only the files they touch."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallymend import Compare, reconcile_tables, tag_partition
from tallymend.operators import repair as rp
from tallymend.plans.durable import durable as catalog_durable
from tallymend.plans.job import repair_files
from tallymend.sources import sinks
from tallymend.sources.commits import CommitLog, Conflict
from tallymend.sources.files import FileTable
from tallymend.sources.reportlog import ReportLog

KEY = ["primary_key", "column"]
SCHEMA = "primary_key string, column string, source_value string"


def records(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def held(log):
    return sorted((tuple(r) for r in log.read().collect()), key=repr)


# --- commits


def test_one_of_two_writers_gets_a_number(spark, tmp_path):
    first, second = (CommitLog(spark, str(tmp_path)) for _ in range(2))
    assert first.latest() == 0 and list(first.newest_first()) == []
    assert first.try_commit(1, {"by": "first"})
    assert not second.try_commit(1, {"by": "second"})
    assert second.commit({"by": "second"}, based_on=0) == 2
    assert [f["by"] for _, f in first.newest_first()] == ["second", "first"]


def test_a_conflict_is_raised_or_passed_over(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    log.commit({"files": ["a"]})
    log.commit({"files": ["b"]})
    with pytest.raises(Conflict):
        log.commit({"files": ["b"]}, based_on=1, conflicts=lambda other: "b" in other["files"])
    assert log.commit({"files": ["c"]}, based_on=1, conflicts=lambda other: "c" in other["files"]) == 3


def test_an_incomplete_commit_names_nothing(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    log.commit({"n": 1})
    (tmp_path / "commits" / f"{2:020d}.json").write_text('{"n"')
    assert [f for _, f in log.newest_first()] == [{"n": 1}]
    assert log.commit({"n": 3}) == 3


# --- the report's log


def test_log_of_upserts_purge_and_compaction(spark, tmp_path):
    log = ReportLog(spark, str(tmp_path))
    assert log.read() is None and log.compact() is None
    log.upsert(records(spark, ("1", "a", "x"), ("2", "a", "x"), (None, "a", "n"), ("1", "a", "w")), KEY)
    log.upsert(records(spark, ("2", "a", "y"), ("3", None, "z")), KEY)
    log.upsert(records(spark, ("4", "a", "u")), KEY)
    log.purge(records(spark, ("1", "a", ""), ("3", None, ""), ("9", "z", "")), log.version())
    expected = sorted([("2", "a", "y"), ("4", "a", "u"), (None, "a", "n")], key=repr)
    assert held(log) == expected
    assert log.compact() == 5
    assert held(log) == expected
    assert log.compact() is None
    log.upsert(records(spark, ("1", "a", "again")), KEY)
    assert held(log) == sorted([*expected, ("1", "a", "again")], key=repr)
    log.purge(records(spark, *expected, ("1", "a", "")), log.version())
    log.compact()
    assert held(log) == []


def test_interleaved_writers_lose_nothing(spark, tmp_path):
    """Both writers see version 0 and write; each one's records stay."""
    a, b = (ReportLog(spark, str(tmp_path)) for _ in range(2))
    real, done = a.log.try_commit, []

    def late(number, facts):
        if not done:
            done.append(b.upsert(records(spark, ("2", "a", "b")), KEY))
        return real(number, facts)

    a.log.try_commit = late
    assert a.upsert(records(spark, ("1", "a", "a")), KEY) == 2 and done == [1]
    assert held(a) == held(b) == [("1", "a", "a"), ("2", "a", "b")]


def test_purge_spares_what_is_said_again(spark, tmp_path):
    log = ReportLog(spark, str(tmp_path))
    seen = log.upsert(records(spark, ("1", "a", "old"), ("2", "a", "old")), KEY)
    log.upsert(records(spark, ("1", "a", "new")), KEY)
    log.purge(records(spark, ("1", "a", ""), ("2", "a", "")), seen)
    assert held(log) == [("1", "a", "new")]
    log.compact()
    assert held(log) == [("1", "a", "new")]


def test_compaction_beside_an_upsert(spark, tmp_path):
    a, b = (ReportLog(spark, str(tmp_path)) for _ in range(2))
    a.upsert(records(spark, ("1", "a", "x")), KEY)
    real, done = a.log.try_commit, []

    def late(number, facts):
        if not done:
            done.append(b.upsert(records(spark, ("1", "a", "y"), ("2", "a", "y")), KEY))
        return real(number, facts)

    a.log.try_commit = late
    a.compact()
    assert held(b) == [("1", "a", "y"), ("2", "a", "y")]
    b.compact()
    assert held(b) == [("1", "a", "y"), ("2", "a", "y")]


def test_compaction_keeps_clean_buckets_by_name(spark, tmp_path):
    log = ReportLog(spark, str(tmp_path))
    log.upsert(records(spark, *((str(i), "a", "x") for i in range(200))), KEY)
    log.compact()
    before = log._state()[0]["buckets"]
    log.upsert(records(spark, ("7", "a", "y")), KEY)
    log.compact()
    after = log._state()[0]["buckets"]
    assert len(before) > 50 and sum(before[b] != after[b] for b in before) == 1
    assert log.read().count() == 200


def test_a_stale_version_conflicts(spark, tmp_path):
    rows = records(spark, ("1", "a", "x"))
    seen = sinks.write_version(rows, str(tmp_path))
    assert sinks.write_version(rows, str(tmp_path), based_on=seen) == 2
    with pytest.raises(Conflict):
        sinks.write_version(rows, str(tmp_path), based_on=seen)


# --- copy on write


def table_rows(n):
    return [(i, "2024", "05", f"v{i}", float(i)) for i in range(n)]


COLUMNS = "id long, year string, month string, val string, num double"


@pytest.fixture()
def two_tables(spark, tmp_path):
    """Ten destination files of 20 keys; planted faults in two of them, a repeated key in both."""
    source = table_rows(200) + [(30, "2024", "05", "second", 2.0)]
    dest = [
        (i, y, m, "wrong" if i in (3, 31) else v, None if i == 38 else x)
        for i, y, m, v, x in table_rows(200)
    ]
    for part in range(10):
        rows = dest[20 * part : 20 * part + 20]
        if part == 0:
            rows = [*rows, (30, "2024", "05", "secund", 2.0)]
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    return spark.createDataFrame(source, COLUMNS), str(tmp_path / "d"), str(tmp_path / "store")


def tag(df):
    return tag_partition(df, "year", "month")


def test_only_touched_files_are_rewritten(spark, two_tables):
    source, folder, store = two_tables
    table = FileTable(spark, folder, store)
    found = reconcile_tables(tag(source), tag(table.current()), "id", ["val", "num"], Compare(include_nulls=True))
    before = table.snapshot()[1]
    sizes = {f: os.path.getsize(os.path.join(folder, os.path.basename(f))) for f in before}
    version, outcome = repair_files(found, table, "id", tag, columns=["val", "num"])
    number, after = table.snapshot()
    assert version == number == 1
    gone = set(before) - set(after)
    assert len(gone) == 2 and len(set(before) & set(after)) == 8
    written = sum(os.path.getsize(f.removeprefix("file://")) for f in set(after) - set(before))
    # Two files' rows, in however many files the tasks wrote.
    assert written < 8 * sum(sizes[f] for f in gone)
    assert outcome.repaired.count() == 41
    again = reconcile_tables(tag(source), tag(table.current()), "id", ["val", "num"], Compare(include_nulls=True))
    assert again.isEmpty() and outcome.remaining.isEmpty()
    assert spark.read.parquet(folder).where("val = 'wrong'").count() == 2
    # The same as rewriting the whole table.
    dest = tag(spark.read.parquet(folder))
    whole = rp.apply_repairs(dest, rp.plan_repairs(found, dest), "id", ["val", "num"])
    rows = sorted(map(tuple, whole.select("id", "val", "num").collect()))
    assert rows == sorted(map(tuple, table.current().select("id", "val", "num").collect()))


def test_a_repair_without_plan_writes_nothing(spark, two_tables):
    _, folder, store = two_tables
    table = FileTable(spark, folder, store)
    dest = tag(table.current())
    found = reconcile_tables(dest, dest, "id", ["val"])
    version, outcome = repair_files(found, table, "id", tag, columns=["val"])
    assert version == 0 and outcome.repaired.isEmpty() and len(table.snapshot()[1]) == 10


def test_repairs_of_other_files_build_on_each_other(spark, two_tables):
    _, folder, store = two_tables
    a, b = (FileTable(spark, folder, store) for _ in range(2))
    version, files = a.snapshot()
    mark = [b.read(files[:1]).withColumn("val", F.lit("b")), a.read(files[1:2]).withColumn("val", F.lit("a"))]
    assert b.replace(version, files[:1], mark[0]) == 1
    assert a.replace(version, files[1:2], mark[1]) == 2
    kept = {r["val"]: r["count"] for r in a.current().groupBy("val").count().collect()}
    assert kept["a"] + kept["b"] in (40, 41)
    with pytest.raises(Conflict):
        b.replace(version, files[:1], mark[0])


def test_unplanned_rows_meet_no_exchange(spark, two_tables):
    """Rows of keys without a plan go from the scan to the result."""
    source, folder, _ = two_tables
    dest = tag(spark.read.parquet(folder))
    found = reconcile_tables(tag(source), dest, "id", ["val", "num"], Compare(include_nulls=True))
    plan = rp.plan_repairs(found, dest)
    planned = rp.set_against(plan, dest, "id", ["val", "num"])
    assert planned.rows.count() < 10
    rest = rp.apply_repairs(dest, planned.plan, "id", ["val", "num"], planned)
    text = rest._jdf.queryExecution().executedPlan().toString()
    other = text[text.index("LeftAnti") :]
    assert "BroadcastHashJoin" in text[: text.index("LeftAnti")].splitlines()[-1]
    assert "FileScan parquet" in other.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in other.split("BroadcastExchange")[0]


@pytest.mark.parametrize("key", ["string", "double"])
def test_a_list_too_big_to_broadcast_shuffles_few_other_rows(spark, two_tables, monkeypatch, key):
    source, folder, _ = two_tables
    rows = spark.read.parquet(folder)
    rows = rows.unionByName(rows.limit(1).withColumn("id", F.lit(None).cast("long")))
    # Names that the filter has as well.
    source, dest = (
        tag(df.withColumn("id", F.col("id").cast(key)).withColumn("bits", F.lit("x")).withColumn("bucket", F.lit(1)))
        for df in (source, rows)
    )
    found = reconcile_tables(source, dest, "id", ["val", "num"], Compare(include_nulls=True))
    plan = rp.plan_repairs(found, dest)

    def results(planned):
        made = rp.apply_repairs(dest, planned.plan, "id", ["val", "num"], planned)
        summary = rp.repair_summary(planned.plan, dest, "id", ["val", "num"], planned)
        return [sorted(map(repr, df.collect())) for df in (made, summary)]

    few = rp.set_against(plan, dest, "id", ["val", "num"])
    monkeypatch.setattr(rp, "BROADCAST_BYTES", 0)
    many = rp.set_against(plan, dest, "id", ["val", "num"])
    assert results(few) == results(many) and len(results(many)[0]) == dest.count()
    assert rp.files_of(plan, dest.withColumn("file", F.col("val")), "id", "file")
    if key != "double":
        assert many.near.count() + many.far.count() == dest.count() > 4 * many.near.count()
        text = many.far._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]


def test_the_log_query_makes_a_report_once(spark, monkeypatch):
    """Two upserts read the first report; it is aligned for one of them."""
    from workloads import catalog

    kept = []
    monkeypatch.setattr(catalog, "durable", lambda df: kept.append(catalog_durable(df)) or kept[-1])
    rows = catalog.report_log(spark, "/root/testdata/sf0.001")
    assert len(kept) == 1 and kept[0].count() > 0 and rows.count() > 0
