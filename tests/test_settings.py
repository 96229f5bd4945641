"""Scopes, settings, scans, JDBC options and sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tallymend import Scope, job_from, run
from tallymend.config import Side, load_job, read_env
from tallymend.plans.job import apply_to, repair_destination
from tallymend.plans.scope import expand_scope, tag_partition
from tallymend.sources import jdbc, sinks
from tallymend.sources import tables as tb

SETTINGS = {
    "source": {"type": "parquet", "table": "s", "columns": ["ID", "Year", "Month", "Week", "Val"]},
    "destination": {"type": "parquet", "table": "d"},
    "primary_key": "ID",
    "comparison": {"use_row_hash": True, "aggressive_memory_cleanup": True, "include_nulls": True},
    "partitioning": {
        "year_column": "year",
        "month_column": "month",
        "week_column": "week",
        "scope": [{"year": 2024, "month": 5, "weeks": [1, 2]}, {"year": "2023", "month": "12"}],
    },
}


def test_scope_expansion():
    months = Scope.of([{"year": 2021, "month": 1}, {"year": 2021, "month": 2}])
    assert months.partitions() == [("2021", "01", None), ("2021", "02", None)]
    weeks = Scope.of([{"year": 2022, "month": 5, "weeks": [1, 2]}])
    assert weeks.partitions() == [("2022", "05", "1"), ("2022", "05", "2")]
    sample = Scope.of(
        [
            {"year": "2024", "month": "05", "weeks": [1, 2, 3, 4]},
            {"year": "2024", "month": "06", "weeks": [1, 2, 3, 4, 5]},
            {"year": "2023", "month": "12"},
        ]
    )
    assert len(sample.partitions()) == 10


def test_scope_table_expands_alike(spark):
    entries = spark.createDataFrame(
        [(2021, 1, None), (2022, 5, [1, 2])], "year int, month int, weeks array<int>"
    )
    assert sorted(map(tuple, expand_scope(entries).collect()), key=str) == [
        ("2021", "01", None),
        ("2022", "05", "1"),
        ("2022", "05", "2"),
    ]


@pytest.mark.parametrize("dtype", ["string", "int", "decimal(4,0)"])
def test_scope_matches_text_and_numbers(spark, dtype):
    rows = spark.createDataFrame(
        [(1, "2021", "01", "2"), (2, "2021", "02", "2"), (3, "2021", "01", "3")],
        "id int, year string, month string, week string",
    ).selectExpr("id", *(f"cast({c} AS {dtype}) AS {c}" for c in ("year", "month", "week")))

    def ids(scope, week="week"):
        kept = tag_partition(rows, "year", "month", week, Scope.of(scope))
        return {r["id"]: (r["part_year"], r["part_month"], r["part_week"]) for r in kept.collect()}

    assert ids([{"year": 2021, "month": 1}]) == {1: ("2021", "01", None), 3: ("2021", "01", None)}
    assert ids([{"year": 2021, "month": 1, "weeks": [2]}]) == {1: ("2021", "01", "2")}
    overlap = [{"year": 2021, "month": 1}, {"year": 2021, "month": 1, "weeks": [3]}]
    assert ids(overlap) == {1: ("2021", "01", None), 3: ("2021", "01", "3")}
    with pytest.raises(ValueError, match="week"):
        ids([{"year": 2021, "month": 1, "weeks": [2]}], None)


def test_scope_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "2021 AS year", "1 AS month", "'x' AS val").write.parquet(path)
    scope = Scope.of([{"year": "2021", "month": "01"}])
    rows = tb.scan_partition(
        spark.read.parquet(path),
        {"key": "id", "val": "val"},
        key="key",
        year="year",
        month="month",
        scope=scope,
        record="3",
    )
    assert [r["key"] for r in rows.collect()] == [3]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    for pushed in ("EqualTo(year,2021)", "EqualTo(month,1)", "EqualTo(id,3)"):
        assert pushed in plan


def test_limit_takes_the_first_rows_of_each_partition(spark):
    rows = spark.range(100).selectExpr(
        "id", "cast(id % 2 AS string) AS year", "'01' AS month", "'x' AS val"
    )
    kept = tb.limit_per_partition(tag_partition(rows, "year", "month"), "id", 3)
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


def test_settings_are_normalised():
    job = job_from(SETTINGS, limit=0, record="")
    assert job.primary_key == "id"
    assert job.destination.columns == job.source.columns
    assert job.value_columns() == ["val"]
    assert job.compare.discard_equal_first and job.dry_run and job.skip_nulls
    assert job.limit is None and job.record is None
    assert not job_from(SETTINGS, apply=True).dry_run


def test_destination_columns_may_be_a_list_and_are_pruned():
    raw = {**SETTINGS, "destination": {"type": "parquet", "table": "d", "columns": ["id", "val", "zz"]}}
    assert list(job_from(raw).destination.columns) == ["id", "val"]


@pytest.mark.parametrize("section", ["source", "destination", "primary_key", "partitioning"])
def test_sections_are_required(section):
    with pytest.raises(KeyError, match=section):
        job_from({k: v for k, v in SETTINGS.items() if k != section})


def test_weeks_need_a_week_column():
    parts = {k: v for k, v in SETTINGS["partitioning"].items() if k != "week_column"}
    with pytest.raises(ValueError, match="week_column"):
        job_from({**SETTINGS, "partitioning": parts})


def test_environment(monkeypatch):
    monkeypatch.setenv("A_USER", "me")
    monkeypatch.delenv("A_PASSWORD", raising=False)
    assert read_env({"user": "A_USER"}) == {"user": "me"}
    with pytest.raises(EnvironmentError, match="A_PASSWORD"):
        read_env({"user": "A_USER", "password": "A_PASSWORD"})


def test_settings_file(tmp_path):
    yaml = pytest.importorskip("yaml")
    file = tmp_path / "job.yaml"
    file.write_text(yaml.safe_dump(SETTINGS))
    assert load_job(str(file)).scope.partitions()[0] == ("2024", "05", "1")


ORACLE = {"user": "u", "password": "p", "host": "h", "port": "1521", "service": "x"}
SQLSERVER = {
    "driver": "any",
    "server": "h",
    "database": "db",
    "trusted_connection": "yes",
    "trust_server_certificate": "no",
}


def test_jdbc_options():
    side = Side("oracle", "t", {}, schema="s", env=ORACLE)
    assert side.qualified == "s.t"
    options = jdbc.jdbc_options(side)
    assert options["url"] == "jdbc:oracle:thin:@//h:1521/x"
    assert options["fetchsize"] == "1000"
    url = jdbc.sqlserver_options(SQLSERVER)["url"]
    assert url == (
        "jdbc:sqlserver://h;databaseName=db;integratedSecurity=true;trustServerCertificate=false"
    )
    with pytest.raises(KeyError, match="service"):
        jdbc.oracle_options({k: v for k, v in ORACLE.items() if k != "service"})
    with pytest.raises(KeyError, match="server"):
        jdbc.sqlserver_options({})
    with pytest.raises(ValueError, match="mongo"):
        jdbc.jdbc_options(Side("mongo", "t", {}))


def test_scan_predicates_cover_the_scope_once():
    schema = T.StructType(
        [
            T.StructField("K", T.LongType()),
            T.StructField("YR", T.StringType()),
            T.StructField("MON", T.IntegerType()),
            T.StructField("WK", T.StringType()),
        ]
    )
    scope = Scope.of([{"year": 2024, "month": 5, "weeks": [1, 2]}, {"year": 2023, "month": 12}])
    side = Side("oracle", "t", {})
    assert jdbc.scan_predicates(side, schema, scope, "k", "yr", "mon", "wk") == [
        "yr = '2024' AND mon = 5 AND wk = '1'",
        "yr = '2024' AND mon = 5 AND wk = '2'",
        "yr = '2023' AND mon = 12",
    ]
    split = jdbc.scan_predicates(
        Side("sqlserver", "t", {}, splits=4), schema, scope, "k", "yr", "mon", "wk"
    )
    assert len(split) == 12 and len(set(split)) == 12
    assert split[1].endswith("(ABS(CAST(CHECKSUM(k) AS BIGINT)) % 4 = 1 AND k IS NOT NULL)")


def test_unknown_table_type(spark):
    with pytest.raises(ValueError, match="mongo"):
        tb.load(spark, Side("mongo", "t", {}), None, "id", ("y", "m", None))


def test_run_from_files(spark, tmp_path):
    columns = "id long, yr int, mon int, wk int, val string"
    spark.createDataFrame([(1, 2024, 5, 1, "a"), (2, 2024, 5, 3, "b"), (3, 2023, 12, 1, "c")], columns).write.parquet(
        str(tmp_path / "s")
    )
    spark.createDataFrame([(1, 2024, 5, 1, "z"), (3, 2023, 12, 1, "c")], columns).write.parquet(str(tmp_path / "d"))
    mapping = {"id": "id", "year": "yr", "month": "mon", "week": "wk", "val": "val"}
    job = job_from(
        {
            **SETTINGS,
            "source": {"type": "parquet", "table": str(tmp_path / "s"), "columns": mapping},
            "destination": {"type": "parquet", "table": str(tmp_path / "d"), "columns": mapping},
            "output": {"path": str(tmp_path / "out")},
            "updates": {"auto_repair": True},
        },
        apply=True,
    )
    for _ in range(2):
        outcome = run(spark, job)
    found = [(r["type"], r["primary_key"], r["week"]) for r in outcome.found.collect()]
    assert found == [("mismatch", "1", "1")]
    # Each run stores its report, and then what is left of it.
    assert sinks.latest_version(spark, str(tmp_path / "out")) == 4
    assert sinks.read_latest(spark, str(tmp_path / "out")).count() == 0
    assert outcome.remaining.count() == 0
    assert {r["id"]: r["val"] for r in outcome.repaired.collect()} == {1: "a", 3: "c"}
    assert outcome.repaired.columns == ["id", "yr", "mon", "wk", "val"]


@pytest.mark.parametrize("narrow", [{}, {"limit": 2}, {"record": "1"}])
def test_repair_job_covers_the_whole_destination(spark, tmp_path, narrow):
    """Rows out of scope, limit or record and unmapped columns stay; a dry run writes nothing."""
    columns = "ident long, yr int, mon int, note string, val string"
    rows = [(1, 2024, 5, "n1", "z"), (2, 2024, 5, "n2", "b"), (3, 2023, 12, "n3", "c"), (None, 2024, 5, "n4", "d")]
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "d"))
    right = [(1, 2024, 5, "", "a"), (2, 2024, 5, "", "b"), (3, 2023, 12, "", "x")]
    spark.createDataFrame(right, columns).write.parquet(str(tmp_path / "s"))
    mapping = {"id": "ident", "year": "yr", "month": "mon", "val": "val"}
    raw = {
        "source": {"type": "parquet", "table": str(tmp_path / "s"), "columns": mapping},
        "destination": {"type": "parquet", "table": str(tmp_path / "d"), "columns": mapping},
        "primary_key": "id",
        "partitioning": {"scope": [{"year": 2024, "month": 5}]},
        "output": {"path": str(tmp_path / "out")},
        "updates": {"auto_repair": True, "target": str(tmp_path / "fixed")},
    }
    dry = run(spark, job_from(raw, **narrow))
    assert dry.repaired is None and sinks.read_latest(spark, str(tmp_path / "fixed")) is None
    # From the stored report, as a job of its own.
    outcome = repair_destination(spark, job_from(raw, apply=True, **narrow))
    apply_to(outcome, str(tmp_path / "fixed"))
    fixed = sinks.read_latest(spark, str(tmp_path / "fixed"))
    assert fixed.columns == columns.replace(",", "").split()[::2]
    expected = [(1, 2024, 5, "n1", "a"), *rows[1:]]
    assert sorted(map(tuple, fixed.collect()), key=str) == sorted(expected, key=str)
    assert sinks.read_latest(spark, str(tmp_path / "out")).where("type = 'mismatch'").count() == 0
    totals = [r["rows_updated"] for r in outcome.summary.where("partition IS NULL").collect()]
    assert totals == [1]


def test_unknown_settings_are_refused():
    raw = {**SETTINGS, "comparison": {"tolerence": 0.1}}
    with pytest.raises(KeyError, match="tolerence"):
        job_from(raw, resolve_env=False)
    job = job_from({**SETTINGS, "comparison": {"tolerance": 0.5, "hot_rows": 7}}, resolve_env=False)
    assert (job.compare.tolerance, job.compare.hot_rows) == (0.5, 7)


def test_records_without_a_key_are_appended(spark, tmp_path):
    records = spark.createDataFrame([("x",)], "a string")
    for _ in range(2):
        sinks.write_records(records, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_csv(spark, tmp_path, capsys):
    path = str(tmp_path / "deep" / "report")
    records = spark.createDataFrame([("1", "a,b")], "primary_key string, source_value string")
    assert not sinks.write_csv(records.limit(0), path)
    assert "nothing to report" in capsys.readouterr().out
    assert sinks.write_csv(records, path)
    back = spark.read.option("header", True).csv(path).collect()
    assert [tuple(r) for r in back] == [("1", "a,b")]


def test_table_is_created_once(spark):
    for _ in range(2):
        sinks.create_table(spark, "found_records", ["primary_key", "column"])
    assert spark.table("found_records").columns == ["primary_key", "column"]


def test_jdbc_column_types(spark):
    names = ["primary_key", "source_value"]
    assert sinks.jdbc_column_types(names) == "`primary_key` VARCHAR(500)"
    oracle = sinks.jdbc_column_types(names, sinks.dialect_of({"url": "jdbc:oracle:thin:@//h:1/s"}))
    assert oracle == "`primary_key` VARCHAR(500), `source_value` VARCHAR(4000)"
    assert T.StructType.fromDDL(oracle).names == names


def test_merge_statement():
    text = sinks.merge_statement("r.t", "r.t_staging", ["primary_key", "source_value"], sinks.PAIR_KEY)
    assert text == (
        "MERGE INTO r.t t USING r.t_staging s ON"
        ' ((t."primary_key" = s."primary_key" OR (t."primary_key" IS NULL AND s."primary_key" IS NULL)))'
        ' WHEN MATCHED THEN UPDATE SET t."source_value" = s."source_value"'
        ' WHEN NOT MATCHED THEN INSERT ("primary_key", "source_value")'
        ' VALUES (s."primary_key", s."source_value");'
    )
