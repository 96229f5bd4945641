"""Job settings: a plain mapping (or YAML file) checked into dataclasses."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from tallymend.functions.cells import DATE_FORMS, TOLERANCE
from tallymend.plans.scope import Scope

# Names of the settings.
REQUIRED_SECTIONS = ("source", "destination", "primary_key", "partitioning")

KNOWN_COMPARISON = (
    "include_nulls",
    "only_columns",
    "use_row_hash",
    "aggressive_memory_cleanup",
    "unique_key",
    "tolerance",
    "date_forms",
    "hot_rows",
    # Settings of worker pools, which Spark takes the place of.
    "parallel",
    "parallel_mode",
    "workers",
)
KNOWN_UPDATES = ("dry_run", "skip_nulls", "auto_repair", "target")


def read_env(names: Mapping[str, str]) -> dict[str, str]:
    """Values of the environment variables named in ``names``."""
    missing = sorted(var for var in names.values() if var not in os.environ)
    if missing:
        raise EnvironmentError(f"unset environment variables: {', '.join(missing)}")
    return {key: os.environ[var] for key, var in names.items()}


@dataclass(frozen=True)
class Side:
    """One table: where it is and how its columns are named.

    ``type`` is ``oracle``, ``sqlserver``, ``jdbc``, ``table`` or a Spark file
    format. ``columns`` maps logical to physical names.
    """

    type: str
    table: str
    columns: Mapping[str, str]
    schema: str = ""
    env: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    splits: int = 1
    # Ascending key values (numbers or days) that cut reads into ranges instead of hashes.
    split_bounds: tuple = ()

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table


@dataclass(frozen=True)
class Compare:
    """How aligned rows are compared."""

    include_nulls: bool = False
    only_columns: tuple[str, ...] | None = None
    use_row_hash: bool = False
    discard_equal_first: bool = False
    unique_key: bool = False
    tolerance: float = TOLERANCE
    date_forms: tuple[tuple[str, str], ...] = DATE_FORMS
    hot_rows: int | None = 1_000_000

    def columns(self, available: list[str]) -> list[str]:
        if not self.only_columns:
            return available
        return [c for c in available if c in self.only_columns]


@dataclass(frozen=True)
class Job:
    source: Side
    destination: Side
    primary_key: str
    year_column: str
    month_column: str
    week_column: str | None
    scope: Scope
    compare: Compare = Compare()
    output: Mapping[str, Any] = field(default_factory=dict)
    dry_run: bool = True
    skip_nulls: bool = True
    auto_repair: bool = False
    repair_target: str | None = None
    limit: int | None = None
    record: str | None = None

    def value_columns(self) -> list[str]:
        """Columns mapped on both sides, other than the key and the partition."""
        fixed = {self.primary_key, self.year_column, self.month_column, self.week_column}
        return [
            c
            for c in self.source.columns
            if c in self.destination.columns and c not in fixed
        ]


def _mapping(columns: Any) -> dict[str, str]:
    pairs = columns.items() if isinstance(columns, Mapping) else ((c, c) for c in columns)
    return {str(k).lower(): str(v).lower() for k, v in pairs}


def _side(raw: Mapping, columns: Mapping[str, str], resolve: bool) -> Side:
    env = dict(raw.get("env") or {})
    return Side(
        type=str(raw.get("type", "sqlserver")).lower(),
        schema=str(raw.get("schema") or ""),
        table=str(raw["table"]),
        columns=columns,
        env=read_env(env) if resolve else env,
        options={str(k): str(v) for k, v in (raw.get("options") or {}).items()},
        splits=int(raw.get("splits", 1)),
        split_bounds=tuple(raw.get("split_bounds") or ()),
    )


def job_from(raw: Mapping, *, resolve_env: bool = True, **arguments: Any) -> Job:
    """Build a Job from a settings mapping; keyword arguments are run options.

    Run options: ``limit``, ``record``, ``apply`` (repair for real).
    """
    for section in REQUIRED_SECTIONS:
        if section not in raw:
            raise KeyError(f"settings lack the section {section!r}")
    source_columns = _mapping(raw["source"].get("columns") or {})
    if raw["destination"].get("columns") is None:
        dest_columns = dict(source_columns)
    else:
        mapped = _mapping(raw["destination"]["columns"])
        dest_columns = {k: v for k, v in mapped.items() if k in source_columns}

    key = str((raw.get("columns") or {}).get("primary_key", raw["primary_key"])).lower()
    for name, columns in (("source", source_columns), ("destination", dest_columns)):
        if key not in columns:
            raise KeyError(f"the primary key {key!r} is not a column of the {name}")

    parts = raw["partitioning"]
    scope = Scope.of(parts.get("scope") or [])
    week = parts.get("week_column")
    if scope.weeks() and not week:
        raise ValueError("the scope lists weeks but partitioning.week_column is not set")

    cmp = raw.get("comparison") or {}
    updates = raw.get("updates") or {}
    for section, given, known in (
        ("comparison", cmp, KNOWN_COMPARISON),
        ("updates", updates, KNOWN_UPDATES),
    ):
        if unknown := sorted(set(given) - set(known)):
            raise KeyError(f"unknown settings in {section!r}: {', '.join(unknown)}")
    only = cmp.get("only_columns")
    use_hash = bool(cmp.get("use_row_hash", False))
    limit = arguments.get("limit", raw.get("limit"))
    record = arguments.get("record", raw.get("record"))
    return Job(
        source=_side(raw["source"], source_columns, resolve_env),
        destination=_side(raw["destination"], dest_columns, resolve_env),
        primary_key=key,
        year_column=str(parts.get("year_column", "year")).lower(),
        month_column=str(parts.get("month_column", "month")).lower(),
        week_column=str(week).lower() if week else None,
        scope=scope,
        compare=Compare(
            include_nulls=bool(cmp.get("include_nulls", False)),
            only_columns=tuple(str(c).lower() for c in only) if only else None,
            use_row_hash=use_hash,
            discard_equal_first=use_hash and bool(cmp.get("aggressive_memory_cleanup", False)),
            unique_key=bool(cmp.get("unique_key", False)),
            tolerance=float(cmp.get("tolerance", TOLERANCE)),
            date_forms=tuple((str(day), str(form)) for day, form in cmp.get("date_forms", DATE_FORMS)),
            hot_rows=int(cmp["hot_rows"]) if cmp.get("hot_rows") else Compare.hot_rows,
        ),
        output=dict(raw.get("output") or {}),
        dry_run=not arguments["apply"] if "apply" in arguments else bool(updates.get("dry_run", True)),
        skip_nulls=bool(updates.get("skip_nulls", True)),
        auto_repair=bool(updates.get("auto_repair", False)),
        repair_target=str(updates["target"]) if updates.get("target") else None,
        limit=int(limit) if limit else None,
        record=str(record) if record is not None and record != "" else None,
    )


def load_job(path: str, **arguments: Any) -> Job:
    """Read settings from a YAML file."""
    try:
        import yaml
    except ImportError as exc:  # PyYAML is only needed for settings files
        raise ImportError("reading a settings file needs PyYAML; pass a dict to job_from") from exc
    with open(path, encoding="utf-8") as handle:
        return job_from(yaml.safe_load(handle), **arguments)
