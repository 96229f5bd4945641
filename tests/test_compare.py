"""Alignment, comparison and repair on small tables, and their properties."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymend import Compare, reconcile_tables, repair
from tallymend.operators import align as al
from tallymend.operators import diff as df
from tallymend.operators import repair as rp
from tallymend.operators import report as rep
from tallymend.plans.scope import PARTITION, tag_partition
from tallymend.sources import sinks

SCHEMA = "id long, year string, month string, val string, num double"


def make(spark, rows, schema=SCHEMA):
    return tag_partition(spark.createDataFrame(rows, schema), "year", "month")


def rows_of(values):
    """(id, val, num) -> full rows in one partition."""
    return [(i, "2024", "05", v, n) for i, v, n in values]


def found(spark, a, b, **options):
    compare = Compare(**{"include_nulls": True, "hot_rows": None, **options})
    return reconcile_tables(make(spark, a), make(spark, b), "id", ["val", "num"], compare)


def key_of(record):
    key = record["primary_key"] or ""
    return (record["type"], key, record["column"] or "", record["occurrence"])


def as_set(report):
    return sorted(
        (*key_of(r), r["source_value"] or "", r["dest_value"] or "") for r in report.collect()
    )


def test_flat_difference(spark):
    report = found(spark, rows_of([(1, "a", 1.0)]), rows_of([(1, "b", 1.0)])).collect()
    assert [(r["column"], r["source_value"], r["dest_value"]) for r in report] == [("val", "a", "b")]


def test_report_schema_is_all_text(spark):
    assert [f.dataType for f in found(spark, [], []).schema] == [f.dataType for f in rep.REPORT_SCHEMA]
    assert found(spark, [], []).columns == list(rep.REPORT_COLUMNS)


def test_hashes_come_with_mismatches_only(spark):
    report = found(
        spark, rows_of([(1, "a", 1.0), (2, "x", 1.0)]), rows_of([(1, "b", 1.0)]), use_row_hash=True
    )
    by_type = {r["type"]: r for r in report.collect()}
    assert len(by_type["mismatch"]["source_hash"]) == 32
    assert by_type["mismatch"]["source_hash"] != by_type["mismatch"]["dest_hash"]
    assert by_type["missing_in_dest"]["source_hash"] is None
    assert by_type["missing_in_dest"]["source_value"] == (
        '{"id":2,"year":"2024","month":"05","val":"x","num":1.0}'
    )


def test_only_columns(spark):
    report = found(
        spark, rows_of([(1, "a", 1.0)]), rows_of([(1, "b", 1.0)]), only_columns=("num",)
    )
    assert report.count() == 0


def test_null_cells_follow_the_option(spark):
    a, b = rows_of([(1, None, 1.0)]), rows_of([(1, "b", 1.0)])
    assert found(spark, a, b).count() == 1
    assert found(spark, a, b, include_nulls=False).count() == 0


def test_hash_discard_counts(spark):
    a = rows_of([(i, "v", float(i)) for i in range(1000)])
    b = rows_of([(i, "v", float(i if i < 500 else i + 1)) for i in range(1000)])
    aligned = al.align(al.sides(make(spark, a), make(spark, b), "id", ["val", "num"]))
    counts = df.hash_counts(aligned, ["val", "num"]).first()
    assert (counts["discarded"], counts["kept"]) == (500, 500)
    kept = df.discard_equal(aligned, ["val", "num"])
    assert kept.agg({"primary_key": "min"}).first()[0] == 500


def test_nested(spark):
    aligned = al.align(
        al.sides(
            make(spark, rows_of([(1, "a", 1.0), (2, "x", 5.0)])),
            make(spark, rows_of([(1, "a", 1.0), (2, "y", 6.0)])),
            "id",
            ["val", "num"],
        )
    )
    rows = df.diff_nested(aligned, ["val", "num"]).collect()
    assert [r["primary_key"] for r in rows] == [2]
    assert [m["column"] for m in rows[0]["mismatches"]] == ["val", "num"]
    assert rows[0]["partition"]["month"] == "05"


def test_key_types_may_differ(spark):
    src = tag_partition(
        spark.createDataFrame([("1", "2024", "5", "a")], "id string, year string, month string, val string")
        .selectExpr("cast(id AS decimal(20,2)) AS id", "year", "month", "val"),
        "year",
        "month",
    )
    dest = make(spark, [(1, 2024, 5, "a")], "id long, year int, month int, val string")
    assert reconcile_tables(src, dest, "id", ["val"]).count() == 0


def test_a_row_that_changed_partition_is_missing_and_extra(spark):
    moved = found(spark, [(1, "2024", "05", "a", 1.0)], [(1, "2024", "06", "a", 1.0)])
    assert sorted(r["type"] for r in moved.collect()) == ["extra_in_dest", "missing_in_dest"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="nope"):
        al.sides(make(spark, []), make(spark, []), "id", ["nope"])
    with pytest.raises(ValueError, match="lacks"):
        al.sides(make(spark, []).drop("id"), make(spark, []), "id")


def test_repeated_key_fails_where_stated_unique(spark):
    twice = rows_of([(1, "a", 1.0), (1, "b", 1.0)])
    with pytest.raises(Exception, match="key repeats"):
        found(spark, twice, twice, unique_key=True).collect()


def test_rows_without_key_pair_with_nothing(spark):
    report = found(spark, rows_of([(None, "a", 1.0)]), rows_of([(None, "a", 1.0)]))
    assert sorted(r["type"] for r in report.collect()) == ["extra_in_dest", "missing_in_dest"]


def test_split_numbering_equals_plain_numbering(spark, monkeypatch):
    """Hot keys, exact copies among them, take the other way to the same result."""
    monkeypatch.setattr(al, "COPIES_PER_STEP", 7)
    a = rows_of([(1, f"v{i % 9}", float(i % 13)) for i in range(300)] + [(1, "copy", 0.0)] * 100)
    b = rows_of([(1, f"v{i % 8}", float(i % 13)) for i in range(290)] + [(1, "copy", 0.0)] * 40)
    a += rows_of([(k, "x", 1.0) for k in range(2, 30)])
    b += rows_of([(k, "y", 1.0) for k in range(5, 32)])
    both = al.sides(make(spark, a), make(spark, b), "id", ["val", "num"])
    assert len(al.hot_keys(both, 100)) == 1
    plain, split = found(spark, a, b), found(spark, a, b, hot_rows=100)
    assert as_set(split) == as_set(plain)
    hashed = found(spark, a, b, hot_rows=100, use_row_hash=True, discard_equal_first=True)
    assert as_set(hashed) == as_set(plain)


VALUES = st.lists(
    st.tuples(
        st.integers(1, 4),
        st.sampled_from([None, "a", " a", "1.0", "1", "2024-05-01", "2024-05-01 00:00:00"]),
        st.sampled_from([None, 1.0, 1.000001, 2.0]),
    ),
    max_size=12,
)
FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(VALUES, VALUES)
def test_properties(spark, a, b):
    a, b = rows_of(a), rows_of(b)
    assert found(spark, a, a).count() == 0
    forward, backward = found(spark, a, b).collect(), found(spark, b, a).collect()
    count = lambda rows, kind: sum(r["type"] == kind for r in rows)
    assert count(forward, "missing_in_dest") == count(backward, "extra_in_dest")
    assert count(forward, "extra_in_dest") == count(backward, "missing_in_dest")
    assert count(forward, "mismatch") == count(backward, "mismatch")
    first = found(spark, a, b, use_row_hash=True, discard_equal_first=True)
    assert as_set(first) == sorted(
        (*key_of(r), r["source_value"] or "", r["dest_value"] or "") for r in forward
    )


def test_repair_leaves_only_what_it_must(spark):
    a = rows_of([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (4, "d", 4.0)])
    b = rows_of([(1, "z", 9.0), (2, "n", 2.0), (3, "c", 3.0), (5, "e", 5.0)])
    dest = make(spark, b)
    report = found(spark, a, b)
    outcome = repair(report, dest, "id", dry_run=False)
    again = reconcile_tables(
        make(spark, a), outcome.repaired, "id", ["val", "num"], Compare(include_nulls=True)
    )
    assert {(r["type"], r["primary_key"]) for r in again.collect()} == {
        ("mismatch", "2"),
        ("missing_in_dest", "4"),
        ("extra_in_dest", "5"),
    }
    left = {(r["type"], r["primary_key"]) for r in outcome.remaining.collect()}
    assert left == {("mismatch", "2"), ("missing_in_dest", "4"), ("extra_in_dest", "5")}

    with_nulls = repair(report, dest, "id", dry_run=False, skip_nulls=False).repaired
    assert with_nulls.where("id = 2").first()["val"] is None


def test_dry_run_changes_nothing(spark):
    a, b = rows_of([(1, "a", 1.0)]), rows_of([(1, "b", 1.0)])
    report = found(spark, a, b)
    outcome = repair(report, make(spark, b), "id")
    assert outcome.repaired is None
    assert outcome.remaining is report
    assert [r["source_raw"] for r in outcome.plan.collect()] == ["a"]


def test_repair_writes_raw_values_and_skips_what_does_not_fit(spark):
    src = make(spark, [(1, "2024", "05", "007", "x")], "id long, year string, month string, val string, num string")
    dest = make(spark, [(1, "2024", "05", "8", 2.0)])
    report = reconcile_tables(src, dest, "id", ["val", "num"])
    outcome = repair(report, dest, "id", dry_run=False)
    row = outcome.repaired.first()
    assert (row["val"], row["num"]) == ("007", 2.0)
    assert [r["column"] for r in outcome.remaining.collect()] == ["num"]


def test_repeated_keys_are_repaired_row_by_row(spark):
    """Only the row that differs changes, and a second comparison finds nothing."""
    a = rows_of([(1, "a", 1.0), (1, "b", 1.0)])
    b = rows_of([(1, "a", 1.0), (1, "c", 1.0)])
    dest = make(spark, b)
    outcome = repair(found(spark, a, b), dest, "id", columns=["val", "num"], dry_run=False)
    assert sorted(r["val"] for r in outcome.repaired.collect()) == ["a", "b"]
    assert outcome.remaining.count() == 0
    totals = {(r["partition"], r["column"]): r["rows_updated"] for r in outcome.summary.collect()}
    assert totals == {("2024-05", "val"): 1, ("2024-05", None): 1, (None, None): 1}
    again = reconcile_tables(make(spark, a), outcome.repaired, "id", ["val", "num"])
    assert again.count() == 0


def test_a_value_that_the_column_would_change_stays_reported(spark):
    src = make(spark, [(1, "2024", "05", "x", "1.005")], "id long, year string, month string, val string, num string")
    dest = make(spark, [(1, "2024", "05", "x", Decimal(7))], "id long, year string, month string, val string, num decimal(10,2)")
    report = reconcile_tables(src, dest, "id", ["val", "num"])
    outcome = repair(report, dest, "id", dry_run=False)
    assert [r["column"] for r in outcome.remaining.collect()] == ["num"]
    assert float(outcome.repaired.first()["num"]) == 7.0


def test_a_fine_tolerance_sees_what_the_digest_does_not(spark):
    a, b = rows_of([(1, "a", 1.000001)]), rows_of([(1, "a", 1.000003)])
    options = {"tolerance": 1e-7, "use_row_hash": True}
    for first in (False, True):
        compare = Compare(discard_equal_first=first, **options)
        assert reconcile_tables(make(spark, a), make(spark, b), "id", ["val", "num"], compare).count() == 1


def test_split_keys_keep_the_sign_of_zero(spark):
    """Numbering over many tasks gives the rows and numbers of the plain way."""
    a = rows_of([(1, "a", 0.0), (1, "a", -0.0), (1, "a", -0.0), (1, "b", 2.0)])
    b = rows_of([(1, "a", -0.0), (1, "a", 0.0), (1, "a", 5.0)])
    reports = [
        reconcile_tables(make(spark, a), make(spark, b), "id", ["val", "num"], Compare(hot_rows=hot))
        for hot in (None, 2)
    ]
    assert as_set(reports[0]) == as_set(reports[1])


def test_cost_of_digests_is_linear_in_width(spark):
    """The plan of a wide report grows as its columns do, digests included."""

    def size(width):
        names = [f"c{i}" for i in range(width)]
        schema = "id long, year string, month string, " + ", ".join(f"{n} string" for n in names)
        table = make(spark, [(1, "2024", "05", *["x"] * width)], schema)
        compare = Compare(use_row_hash=True, unique_key=True)
        plan = reconcile_tables(table, table, "id", names, compare)._jdf.queryExecution().logical()
        return sum(len(str(e)) for e in [plan.toString()])

    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    assert size(32) < 2.6 * size(16)


def test_second_upsert_changes_nothing(spark):
    a = rows_of([(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.0), (None, "k", 1.0)])
    report = found(spark, a, rows_of([(1, "z", 9.0)]))
    once = sinks.upsert(report.limit(0), report)
    twice = sinks.upsert(once, report)
    assert as_set(once) == as_set(twice) == as_set(report)


def test_sample(spark):
    a = rows_of([(i, "a", 1.0) for i in range(1, 6)])
    b = rows_of([(i, "b", 2.0) for i in range(1, 6)])
    rows = rep.sample(found(spark, a, b)).collect()
    assert [(r["primary_key"], r["column"]) for r in rows] == [("1", "num"), ("2", "num")]


def test_aligned_plan_has_one_shuffle_of_rows(spark):
    both = al.sides(make(spark, rows_of([(1, "a", 1.0)])), make(spark, []), "id", ["val", "num"])
    plan = rep.report(al.align(both), ["val", "num"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_partition_columns_do_not_hide_the_tables_own(spark):
    assert set(PARTITION).isdisjoint({"year", "month", "week"})
