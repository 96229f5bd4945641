"""Which calendar partitions a run covers, and the partition each row is in.

A scope is a list of entries (year, month, optional weeks). It becomes one
static filter plus one tagging projection, so a single plan serves every
partition at once instead of one run per partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.functions.cells import NO_TEXT, literal, path
from tallymend.functions.labels import month_text

# Names of the partition columns a tagged table carries next to its own.
PARTITION = ("part_year", "part_month", "part_week")


@dataclass(frozen=True, order=True)
class Entry:
    """One scope entry; ``weeks=None`` means the whole month."""

    year: str
    month: str
    weeks: tuple[str, ...] | None = None

    @classmethod
    def of(cls, raw: Mapping) -> Entry:
        weeks = raw.get("weeks")
        return cls(
            str(raw["year"]),
            str(raw["month"]).zfill(2),
            None if weeks is None else tuple(str(w) for w in weeks),
        )


@dataclass(frozen=True)
class Scope:
    entries: tuple[Entry, ...]

    @classmethod
    def of(cls, raw: Iterable[Mapping]) -> Scope:
        return cls(tuple(Entry.of(entry) for entry in raw))

    def partitions(self) -> list[tuple[str, str, str | None]]:
        """(year, month, week) per partition, in the order given."""
        return [
            (e.year, e.month, week)
            for e in self.entries
            for week in ((None,) if e.weeks is None else e.weeks)
        ]

    def whole_months(self) -> set[tuple[str, str]]:
        return {(e.year, e.month) for e in self.entries if e.weeks is None}

    def weeks(self) -> dict[tuple[str, str], list[str]]:
        """Weeks listed per month, merged over entries."""
        found: dict[tuple[str, str], list[str]] = {}
        for e in self.entries:
            if e.weeks is not None:
                known = found.setdefault((e.year, e.month), [])
                known.extend(w for w in e.weeks if w not in known)
        return found

    def predicate(
        self,
        schema: T.StructType,
        year_column: str,
        month_column: str,
        week_column: str | None = None,
    ) -> Column:
        """Filter for the rows of the scope.

        Literals are cast to the column's type, never the column to the
        literal's, so the comparison reaches the parquet or JDBC scan.
        """
        whole, weeks = self.whole_months(), self.weeks()
        if weeks and week_column is None:
            raise ValueError("the scope lists weeks but no week column is configured")
        terms = []
        for year, month in dict.fromkeys((e.year, e.month) for e in self.entries):
            term = (F.col(year_column) == typed(schema, year_column, year)) & (
                F.col(month_column) == typed(schema, month_column, month)
            )
            if (year, month) not in whole:
                listed = [typed(schema, week_column, w) for w in weeks[year, month]]
                term = term & (F.col(week_column).isin(*listed) if listed else F.lit(False))
            terms.append(term)
        return reduce(or_, terms, F.lit(False)) if len(terms) != 1 else terms[0]

    def week_tag(self, year: str, month: str, week: str | None) -> str:
        """Week of the scope entry a row falls into, NULL under a whole month.

        Where entries overlap, a row belongs to the most specific one.
        """
        listed = [literal("-".join((*ym, w))) for ym, weeks in self.weeks().items() for w in weeks]
        if week is None or not listed:
            return NO_TEXT
        return f"CASE WHEN concat_ws('-', {year}, {month}, {week}) IN ({', '.join(listed)}) THEN {week} END"


def typed(schema: T.StructType, column: str, value: str) -> Column:
    """``value`` as a literal of the column's type."""
    return F.lit(value).cast(schema[column].dataType)


def expand_scope(entries: DataFrame) -> DataFrame:
    """Scope table (year, month, weeks ARRAY) -> one row per partition, as text."""
    return entries.selectExpr(
        "cast(year AS string) AS year", f"{month_text('month')} AS month", "explode_outer(weeks) AS week"
    ).withColumn("week", F.col("week").cast("string"))


def tag_partition(
    df: DataFrame,
    year_column: str,
    month_column: str,
    week_column: str | None = None,
    scope: Scope | None = None,
    *,
    names: tuple[str, str, str] = PARTITION,
) -> DataFrame:
    """Keep the rows of the scope and add their partition as three text columns.

    Without a scope every row is kept and its own year, month and week name
    its partition.
    """
    year = f"cast({path(year_column)} AS string)"
    month = month_text(path(month_column))
    week = f"cast({path(week_column)} AS string)" if week_column else None
    if scope is not None:
        df = df.where(scope.predicate(df.schema, year_column, month_column, week_column))
        tag = scope.week_tag(year, month, week)
    else:
        tag = week if week is not None else NO_TEXT
    tags = zip((year, month, tag), names, strict=True)
    return df.selectExpr("*", *(f"{value} AS {path(name)}" for value, name in tags))
