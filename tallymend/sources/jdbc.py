"""JDBC options for the two database dialects.

The drivers are the deployer's (``spark.jars``); nothing here opens a
connection.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import types as T

from tallymend.config import Side
from tallymend.functions.ranges import KeyRanges
from tallymend.plans.scope import Scope

FETCH_ROWS = 1000

# Settings each dialect needs.
ORACLE_SETTINGS = ("user", "password", "host", "port", "service")
SQLSERVER_SETTINGS = (
    "driver",
    "server",
    "database",
    "trusted_connection",
    "trust_server_certificate",
)
# Spellings that switch a setting on.
ON = ("yes", "true", "1", "sspi")


def _need(env: Mapping[str, str], names: Sequence[str], dialect: str) -> None:
    absent = [n for n in names if n not in env]
    if absent:
        raise KeyError(f"{dialect} settings lack {', '.join(absent)}")


def oracle_options(env: Mapping[str, str]) -> dict[str, str]:
    _need(env, ORACLE_SETTINGS, "oracle")
    return {
        "url": f"jdbc:oracle:thin:@//{env['host']}:{env['port']}/{env['service']}",
        "driver": "oracle.jdbc.OracleDriver",
        "user": env["user"],
        "password": env["password"],
    }


def sqlserver_options(env: Mapping[str, str]) -> dict[str, str]:
    """Options for SQL Server; the ODBC driver name has no JDBC counterpart."""
    _need(env, SQLSERVER_SETTINGS, "sqlserver")

    def flag(name: str) -> str:
        return "true" if env[name].strip().lower() in ON else "false"

    url = ";".join(
        (
            f"jdbc:sqlserver://{env['server']}",
            f"databaseName={env['database']}",
            f"integratedSecurity={flag('trusted_connection')}",
            f"trustServerCertificate={flag('trust_server_certificate')}",
        )
    )
    return {"url": url, "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver"}


def jdbc_options(side: Side) -> dict[str, str]:
    """Connection options of a side; ``jdbc`` takes them from its options."""
    if side.type == "oracle":
        base = oracle_options(side.env)
    elif side.type == "sqlserver":
        base = sqlserver_options(side.env)
    elif side.type == "jdbc":
        base = dict(side.env)
    else:
        raise ValueError(f"not a database type: {side.type!r}")
    return {"fetchsize": str(FETCH_ROWS), **base, **side.options}


def _literal(dtype: T.DataType, value: str) -> str:
    if isinstance(dtype, T.NumericType):
        return str(int(value))
    return "'" + value.replace("'", "''") + "'"


def _split_term(side: Side, key: str, part: int) -> str:
    """Share ``part`` of ``side.splits`` of the rows, in the side's dialect.

    Rows whose key is NULL fall into share 0.
    """
    n = side.splits
    share = {
        "oracle": f"ORA_HASH({key}, {n - 1}) = {part}",
        "sqlserver": f"ABS(CAST(CHECKSUM({key}) AS BIGINT)) % {n} = {part}",
    }.get(side.type, f"MOD(ABS({key}), {n}) = {part}")
    return f"({share} OR {key} IS NULL)" if part == 0 else f"({share} AND {key} IS NOT NULL)"


def _bound(side: Side, value: object) -> str:
    """A key value as a literal of the side's dialect: numbers bare, days quoted."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, datetime.date)):
        raise ValueError(f"a bound must be a number or a day: {value!r}")
    if not isinstance(value, datetime.date):
        return str(value)
    if isinstance(value, datetime.datetime):
        text = value.isoformat(sep="T" if side.type == "sqlserver" else " ")
        return f"'{text}'" if side.type == "sqlserver" else f"TIMESTAMP '{text}'"
    return f"'{value:%Y%m%d}'" if side.type == "sqlserver" else f"DATE '{value.isoformat()}'"


def _split_terms(side: Side, key: str) -> list[str]:
    """One condition per share: key ranges, which an index can serve, or hashes of the key."""
    if side.split_bounds:
        bounds = tuple(dict.fromkeys(side.split_bounds))
        if list(bounds) != sorted(bounds):
            raise ValueError("split_bounds must ascend")
        return KeyRanges(tuple(_bound(side, b) for b in bounds)).terms(key)
    return [_split_term(side, key, part) for part in range(side.splits)]


def is_split(side: Side) -> bool:
    return side.splits > 1 or bool(side.split_bounds)


def split_predicates(side: Side, key: str) -> list[str]:
    """One WHERE text per share of the whole table."""
    return _split_terms(side, key)


def scan_predicates(
    side: Side,
    schema: T.StructType,
    scope: Scope,
    key: str,
    year_column: str,
    month_column: str,
    week_column: str | None,
) -> list[str]:
    """One WHERE text per read task; together they cover the scope once.

    Each calendar partition is its own task, and ``side.splits`` cuts every
    partition further by a hash of the key, or ``side.split_bounds`` by key ranges
    (``functions.ranges.key_quantiles`` finds near-equal ones), so one big month need not be
    read by one task. Names are physical.
    """
    fields = {f.name.lower(): f.dataType for f in schema.fields}

    def equals(column: str, value: str) -> str:
        return f"{column} = {_literal(fields[column.lower()], value)}"

    whole, weeks = scope.whole_months(), scope.weeks()
    terms = []
    for year, month in dict.fromkeys((e.year, e.month) for e in scope.entries):
        base = f"{equals(year_column, year)} AND {equals(month_column, month)}"
        if (year, month) in whole or week_column is None:
            terms.append(base)
        else:
            terms += [f"{base} AND {equals(week_column, w)}" for w in weeks[year, month]]
    if not is_split(side):
        return terms
    return [f"{t} AND {share}" for t in terms for share in _split_terms(side, key)]
