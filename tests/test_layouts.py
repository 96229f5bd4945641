"""Key ranges, digests per range and file, bucketed snapshots, and the balance of a report."""

from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tallymend import Compare, Side, reconcile_tables, tag_partition
from tallymend.functions.ranges import KeyRanges, key_quantiles, key_ranges
from tallymend.operators import align as al
from tallymend.operators import checksums as cs
from tallymend.operators import proof, sampling
from tallymend.operators.report import report
from tallymend.plans.job import reconcile_by_ranges
from tallymend.sources import snapshots
from tallymend.sources.digests import DigestStore
from tallymend.sources.files import FileTable
from tallymend.sources.jdbc import split_predicates

SCHEMA = "id long, year string, month string, val string, num double"
COLUMNS = ["val", "num"]
ALL = Compare(include_nulls=True)


def tag(df):
    return tag_partition(df, "year", "month")


def many(spark, n, changed=()):
    """``n`` rows in two partitions; the listed ids have another value."""
    other = f"id IN ({', '.join(map(str, changed)) or 'NULL'})"
    return spark.range(n).selectExpr(
        "id",
        "'2024' AS year",
        "if(id % 2 = 0, '05', '06') AS month",
        f"if({other}, 'other', concat('v', id)) AS val",
        "cast(id AS double) AS num",
    )


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


# --- ranges


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_ranges_cover_every_key_once(spark, n):
    keys = spark.range(1000).selectExpr("if(id % 10 = 0, NULL, id * id) AS k")
    ranges = key_ranges(keys, "k", n)
    # As a WHERE takes it: NULL is not met.
    met = " + ".join(f"int(coalesce({t}, false))" for t in ranges.terms("k"))
    by_term = " ".join(f"WHEN {t} THEN {i}" for i, t in enumerate(ranges.terms("k")))
    rows = keys.selectExpr(f"{met} AS met", f"{ranges.number('k')} AS n", f"CASE {by_term} END AS term")
    assert {(r["met"], r["n"] == r["term"]) for r in rows.distinct().collect()} == {(1, True)}


def test_ranges_of_a_skewed_key_hold_near_equal_rows(spark):
    """Keys bunch at the low end; equal widths would put nearly all rows in one range."""
    keys = spark.range(20_000).selectExpr("cast(pow(id / 1000, 5) AS bigint) AS k")
    ranges = key_ranges(keys, "k", 10)
    held = keys.groupBy(F.expr(ranges.number("k"))).count().collect()
    big = keys.groupBy("k").count().agg(F.max("count")).first()[0]
    assert max(r["count"] for r in held) <= 2000 * 1.1 + big


def test_one_key_with_a_third_of_the_rows_is_a_range_of_its_own(spark):
    keys = spark.range(9000).selectExpr("if(id % 3 = 0, 4000, id) AS k")
    ranges = key_ranges(keys, "k", 30)
    held = {r[0]: r[1] for r in keys.groupBy(F.expr(ranges.number("k"))).count().collect()}
    assert sorted(held.values())[-2] <= 2 * 9000 / 30


@pytest.mark.parametrize("key", ["cast(id AS string)", "array(id)", "id % 2 = 0"])
def test_other_keys_are_cut_by_hash(spark, key):
    keys = spark.range(500).selectExpr(f"if(id < 5, NULL, {key}) AS k")
    ranges = key_ranges(keys, "k", 4)
    assert ranges == KeyRanges(shares=4)
    met = " + ".join(f"cast({t} AS int)" for t in ranges.terms("k"))
    assert [r[0] for r in keys.selectExpr(met).distinct().collect()] == [1]


@pytest.mark.parametrize("dtype", ["date", "timestamp", "decimal(20,3)", "double", "int"])
def test_bounds_keep_their_type(spark, dtype):
    days = "date_add(date'2024-01-01', cast(id AS int))" if dtype in ("date", "timestamp") else "id"
    keys = spark.range(300).selectExpr(f"cast({days} AS {dtype}) AS k")
    ranges = key_ranges(keys, "k", 3)
    assert len(ranges) == 3
    held = sorted(r["count"] for r in keys.groupBy(F.expr(ranges.number("k"))).count().collect())
    assert held[0] >= 95 and held[-1] <= 105


def test_ranges_of_an_empty_table(spark):
    assert key_ranges(spark.range(0), "id", 5) == KeyRanges()
    assert KeyRanges().terms("id") == ["true"]
    assert KeyRanges(("1", "2")).condition("id", []) == "false"


def test_database_reads_take_key_ranges():
    def texts(kind, *bounds):
        return split_predicates(Side(kind, "t", {}, split_bounds=bounds), "k")

    assert texts("oracle", 10, 20) == ["(k IS NULL OR k < 10)", "(k >= 10 AND k < 20)", "(k >= 20)"]
    day = datetime.date(2024, 5, 1)
    assert texts("oracle", day)[1] == "(k >= DATE '2024-05-01')"
    assert texts("sqlserver", day)[1] == "(k >= '20240501')"
    assert len(texts("jdbc", 1, 1, 2)) == 3
    for wrong in ((2, 1), ("a", "b")):
        with pytest.raises(ValueError):
            texts("oracle", *wrong)


def test_quantiles_serve_as_bounds_of_reads(spark):
    table = spark.range(1000).selectExpr("id * id AS k")
    side = Side("jdbc", "t", {}, split_bounds=tuple(key_quantiles(table, "k", 8)))
    held = [table.where(p).count() for p in split_predicates(side, "k")]
    assert sum(held) == 1000 and max(held) <= 140


# --- digests


def sides(a, b, columns=COLUMNS):
    return al.sides(tag(a), tag(b), "id", columns)


def test_only_ranges_that_differ_are_read_again(spark):
    a, b = many(spark, 10_000), many(spark, 10_000, changed=(17, 18, 9000))
    both = sides(a, b)
    ranges = key_ranges(both.src, "primary_key", 100)
    src, dest = (cs.side_leaves(both, n, ranges).cache() for n in ("src", "dest"))
    dirty = cs.dirty_ranges(src, dest).cache()
    assert dirty.count() == 3
    kept = cs.only_dirty(both, dirty, ranges)
    assert kept.src.count() < 10_000 * 3 / 100
    found = reconcile_by_ranges(tag(a), tag(b), "id", COLUMNS, ALL, ranges=ranges)
    assert bag(found) == bag(reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL))
    assert [r["agrees"] for r in cs.partition_counts(src, dest).orderBy("month").collect()] == [False, False]


def test_equal_tables_have_no_dirty_range(spark):
    both = sides(many(spark, 500), many(spark, 500).repartition(7))
    ranges = key_ranges(both.src, "primary_key", 10)
    leaves = [cs.side_leaves(both, n, ranges) for n in ("src", "dest")]
    assert cs.dirty_ranges(*leaves).count() == 0
    assert [r["agrees"] for r in cs.partition_counts(*leaves).collect()] == [True, True]


ROWS = [
    (1, "2024", "05", "a", 1.0),
    (1, "2024", "05", "a", 1.0),
    (1, "2024", "05", None, None),
    (None, "2024", "05", "no key", 2.0),
    (None, "2024", "05", "no key", 2.0),
    (2, "2024", "06", "", float("nan")),
    (3, None, "06", "x" * 20_000, -0.0),
]


@pytest.mark.parametrize(
    ("a", "b"),
    [(ROWS, ROWS[1:]), (ROWS[2:], ROWS), (ROWS, []), ([], ROWS), ([], []), (ROWS, ROWS[::-1])],
)
@pytest.mark.parametrize("way", ["ranges", "stored"])
def test_other_ways_give_the_plain_report(spark, tmp_path, a, b, way):
    """NULLs, repeated rows, rows without a key, long texts and empty tables."""
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (a, b))
    plain = reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL)
    if way == "ranges":
        found = reconcile_by_ranges(tag(a), tag(b), "id", COLUMNS, ALL, ranges=4)
    else:
        aligned = stored(spark, sides(a, b), tmp_path)
        found = report(aligned, COLUMNS, ALL)
    assert bag(found) == bag(plain)
    assert all(r["balanced"] for r in proof.balance(sides(a, b), found).collect())


def test_no_hot_key_is_looked_for_where_no_range_can_hold_one(spark, monkeypatch):
    a, b = many(spark, 400), many(spark, 400, changed=range(0, 400, 9))
    options = Compare(include_nulls=True, hot_rows=None)
    plain = bag(reconcile_tables(tag(a), tag(b), "id", COLUMNS, options))

    def looked(*_):
        raise AssertionError("rows are read for hot keys, or only to be counted")

    monkeypatch.setattr(al, "_surveyed", looked)
    monkeypatch.setattr(al, "_rows", looked)
    found = [
        reconcile_by_ranges(tag(a), tag(b), "id", COLUMNS, Compare(include_nulls=True, **more), ranges=4)
        for more in ({}, {"hot_rows": None}, {"unique_key": True})
    ]
    assert [bag(f) for f in found] == [plain] * 3


def test_a_hot_key_in_a_range_that_differs_is_still_split(spark, monkeypatch):
    a, b = (many(spark, 400, c).withColumn("id", F.expr("if(id < 90, 7, id)")) for c in ((), (3, 200)))
    options = Compare(include_nulls=True, hot_rows=50)
    split, number_split = [], al._number_split
    monkeypatch.setattr(al, "_number_split", lambda *x: split.append(1) or number_split(*x))
    found = reconcile_by_ranges(tag(a), tag(b), "id", COLUMNS, options, ranges=4)
    plain = reconcile_tables(tag(a), tag(b), "id", COLUMNS, Compare(include_nulls=True, hot_rows=None))
    assert bag(found) == bag(plain) and split


def test_a_fine_tolerance_sees_all_rows(spark):
    a = spark.createDataFrame([(1, "2024", "05", "a", 1.0)], SCHEMA)
    b = spark.createDataFrame([(1, "2024", "05", "a", 1.000001)], SCHEMA)
    fine = Compare(include_nulls=True, tolerance=1e-7)
    assert reconcile_by_ranges(tag(a), tag(b), "id", COLUMNS, fine).count() == 1


def test_digests_of_files_are_kept(spark, tmp_path):
    many(spark, 1000).repartitionByRange(8, "id").write.parquet(f"{tmp_path}/t")
    table = FileTable(spark, f"{tmp_path}/t", f"{tmp_path}/versions")
    store = DigestStore(spark, f"{tmp_path}/digests")
    ranges = KeyRanges(("250L", "500L"))

    def lay_out(rows):
        return sides(rows, rows)

    def plain():
        rows = tag(table.current())
        return bag(cs.side_leaves(al.sides(rows, rows, "id", COLUMNS), "src", ranges))

    leaves, read = store.refresh(table, lay_out, "src", ranges)
    assert (bag(leaves), read) == (plain(), 8)
    assert store.refresh(table, lay_out, "src", ranges)[1] == 0
    version, files = table.snapshot()
    gone = files[:1]
    table.replace(version, gone, table.read(gone).withColumn("val", F.lit("new")).coalesce(1))
    leaves, read = store.refresh(table, lay_out, "src", ranges)
    assert (bag(leaves), read) == (plain(), 1)
    # Other ranges or columns are other digests.
    assert store.refresh(table, lay_out, "src", KeyRanges(("9L",)))[1] == 8
    assert store.refresh(table, lambda r: sides(r, r, ["num"]), "src", ranges)[1] == 8


# --- snapshots


def stored(spark, both, folder, hot_rows=1_000_000):
    names = []
    for side in ("src", "dest"):
        names.append(f"t_{uuid.uuid4().hex}")
        snapshots.store_side(both, side, names[-1], 8, f"{folder}/{names[-1]}", hot_rows)
    return snapshots.align_stored(spark, *names)


def test_stored_sides_align_without_an_exchange(spark, tmp_path):
    aligned = stored(spark, sides(many(spark, 500), many(spark, 400)), tmp_path)
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_hot_key_is_spread_over_the_buckets(spark, tmp_path):
    """All rows on one key: its numbers deal them out, split and plain numbering alike."""
    rows = many(spark, 800).withColumn("id", F.lit(7).cast("long"))
    both = sides(rows, rows.where("num % 3 <> 0"))
    aligned = stored(spark, both, tmp_path, hot_rows=50)
    assert bag(aligned.drop("src_cells", "dest_cells")) == bag(
        al.align(both, hot_rows=None).drop("src_cells", "dest_cells")
    )
    held = aligned.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 8 and max(r["count"] for r in held) < 200


# --- balance


def test_one_lost_record_unbalances_its_partition(spark):
    a, b = many(spark, 200, changed=(3, 4)), many(spark, 210).where("id <> 50")
    both = sides(a, b)
    found = reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL).cache()
    assert [r["balanced"] for r in proof.balance(both, found).collect()] == [True, True]
    for lost in found.collect():
        same = F.lit(True)
        for c in ("primary_key", "type", "column"):
            same &= F.col(c).eqNullSafe(F.lit(lost[c]))
        left = {r["month"]: r["balanced"] for r in proof.balance(both, found.where(~same)).collect()}
        assert left == {m: m != lost["month"] for m in ("05", "06")}


def test_a_wrong_value_unbalances(spark):
    a, b = many(spark, 20, changed=(3,)), many(spark, 20)
    found = reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL)
    wrong = found.withColumn("dest_value", F.lit("guessed"))
    balanced = {r["month"]: r["balanced"] for r in proof.balance(sides(a, b), wrong).collect()}
    assert balanced == {"05": True, "06": False}


# --- samples of keys


def test_a_sample_has_the_same_keys_on_both_sides(spark):
    a, b = many(spark, 3000, changed=range(0, 3000, 7)), many(spark, 2900)
    drawn = sampling.sample_keys(sides(a, b), 200, seed=3)
    keys = [{r[0] for r in d.select("primary_key").collect()} for d in (drawn.both.src, drawn.both.dest)]
    assert len(keys[0] | keys[1]) == 200
    whole = reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL)
    of_drawn = whole.where(F.col("primary_key").isin([str(k) for k in keys[0] | keys[1]]))
    assert bag(report(al.align(drawn.both), COLUMNS, ALL)) == bag(of_drawn)


def test_intervals_hold_the_true_counts(spark):
    """Nine of ten draws at least: 1.96 deviations promise nineteen of twenty."""
    a, b = many(spark, 4000, changed=range(0, 4000, 3)), many(spark, 3600)
    true = {
        (r["type"], r["column"]): r["count"]
        for r in reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL).groupBy("type", "column").count().collect()
    }
    held = []
    for seed in range(10):
        drawn = sampling.sample_keys(sides(a, b), 600, seed)
        found = report(al.align(drawn.both, hot_rows=None), COLUMNS, ALL)
        for r in sampling.estimated_counts(found, drawn.chance).collect():
            held.append(r["low"] <= true[r["type"], r["column"]] <= r["high"])
    assert len(held) == 20 and sum(held) >= 18


@pytest.mark.parametrize(("a", "b"), [(ROWS, ROWS[1:]), ([], []), (ROWS, [])])
def test_a_sample_above_all_keys_is_everything_with_a_key(spark, a, b):
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (a, b))
    drawn = sampling.sample_keys(sides(a, b), 50)
    assert (drawn.limit, drawn.chance) == (None, 1.0)
    found = report(al.align(drawn.both), COLUMNS, ALL)
    keyed = reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL).where("primary_key IS NOT NULL")
    assert bag(found) == bag(keyed)
    for r in sampling.estimated_counts(found, 1.0).collect():
        assert r["sampled"] == r["records"] == r["low"] == r["high"]


# --- the balance's work


def test_the_balance_reads_a_report_once_and_adds_no_decimals(spark, tmp_path):
    a, b = many(spark, 20, changed=(3,)), many(spark, 20)
    reconcile_tables(tag(a), tag(b), "id", COLUMNS, ALL).write.parquet(str(tmp_path / "found"))
    balanced = proof.balance(sides(a, b), spark.read.parquet(str(tmp_path / "found")))
    plan = balanced._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "decimal(38,0)" not in plan
    assert all(r["balanced"] for r in balanced.collect())


# --- how much a task gets


@pytest.mark.parametrize("unique_key", [False, True])
def test_a_task_does_not_get_more_as_the_tables_grow(spark, monkeypatch, unique_key):
    """Whatever Spark would merge: 2,000 keys a side go to 18 tasks, 4,000 to 36."""
    monkeypatch.setattr(al, "TASK_BYTES", 256 << 10)
    for n, tasks in ((2000, 18), (4000, 36)):
        aligned = al.align(sides(many(spark, n), many(spark, n)), unique_key=unique_key)
        keyed = aligned.where("primary_key IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in keyed) == n
        assert len(keyed) >= tasks and max(r["count"] for r in keyed) < 2 * n / tasks


@pytest.mark.parametrize("unique_key", [False, True])
def test_a_session_with_many_partitions_does_not_make_the_shuffle_sort(spark, monkeypatch, unique_key):
    """With more than 200 partitions every task that reads a table sorts its rows in memory first."""
    monkeypatch.setattr(al, "TASK_ROWS", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        aligned = al.align(sides(many(spark, 3000), many(spark, 3000)), unique_key=unique_key, hot_rows=None)
        keyed = aligned.where("primary_key IS NOT NULL").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r["count"] for r in keyed) == 3000
    assert len(keyed) > 100 and max(r["task"] for r in keyed) < 200


# --- many hot keys


def test_more_hot_keys_than_are_listed_are_all_split(spark):
    """20,000 keys above the bound, twice what a list may hold."""
    rows = spark.range(60_000).selectExpr(
        "id % 20000 AS id", "'2024' AS year", "'05' AS month", "concat('v', id) AS val", "double(id) AS num"
    )
    few = spark.range(20_000, 20_100).selectExpr(
        "id", "'2024' AS year", "'05' AS month", "'few' AS val", "double(id) AS num"
    )
    both = sides(rows.union(few), rows.where("num % 11 <> 0").union(few))
    assert len(al.hot_keys(both, 5)) == al.HOT_KEYS
    assert al.all_hot_keys(both, 5).count() == 20_000
    cold, split = al.numbered(both, 5)
    assert cold.select("primary_key").distinct().count() == 100
    assert split.select("primary_key").distinct().count() == 20_000
    plain = al.align(both, hot_rows=None).drop("src_cells", "dest_cells")
    found = al.align(both, hot_rows=5).drop("src_cells", "dest_cells")
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_copies_are_counted_without_sorting_and_keep_their_zeros(spark):
    """Copies beyond one block, zeros of both signs, NULLs, and a shuffle less than before."""
    rows = spark.range(25_000).selectExpr(
        "7L AS id",
        "'2024' AS year",
        "'05' AS month",
        "if(id % 9 = 0, NULL, 'same') AS val",
        "CASE id % 3 WHEN 0 THEN 0.0D WHEN 1 THEN double('-0.0') END AS num",
    )
    both = sides(rows, rows.where("val IS NOT NULL"))
    folded = al._folded(both)
    assert "SortAggregate" not in folded._jdf.queryExecution().executedPlan().toString()
    signs = folded.where("side = 0").selectExpr("cast(src.num AS string) AS num", "copies")
    counted = {r["num"]: r["n"] for r in signs.groupBy("num").agg(F.sum("copies").alias("n")).collect()}
    assert counted == {"0.0": 8334, "-0.0": 8333, None: 8333}
    text = "year, month, occurrence, cast(src.num AS string) AS s, cast(dest.num AS string) AS d, src.val, dest.val AS v"
    plain = al.align(both, hot_rows=None).selectExpr(*text.split(", "))
    found = al.align(both, hot_rows=5).selectExpr(*text.split(", "))
    assert found.count() == 25_000
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0
