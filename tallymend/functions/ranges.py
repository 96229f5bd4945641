"""Key ranges of near-equal size, as SQL text.

Numbers, days and times are cut at quantiles. Other keys, whose order two
engines need not share, are cut by a hash. NULL belongs to range 0.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.functions.cells import literal, path

QUANTILE_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Relative error of a quantile's rank is one in this many.
ACCURACY = 10_000


@dataclass(frozen=True)
class KeyRanges:
    """Ascending SQL literals that start a range each, or a number of hashed shares."""

    bounds: tuple[str, ...] = ()
    shares: int = 0

    def __len__(self) -> int:
        return self.shares or len(self.bounds) + 1

    def number(self, key: str) -> str:
        """The range of a key: a search tree of comparisons, or its hash."""
        if self.shares:
            return f"cast(coalesce(pmod(xxhash64({key}), {self.shares}), 0) AS int)"

        def within(low: int, high: int) -> str:
            if low == high:
                return str(low)
            mid = (low + high + 1) // 2
            return f"if({key} >= {self.bounds[mid - 1]}, {within(mid, high)}, {within(low, mid - 1)})"

        return f"cast({within(0, len(self.bounds))} AS int)"

    def terms(self, key: str) -> list[str]:
        """A condition on each range; every row, NULL keys included, meets exactly one."""
        return [self.condition(key, [n]) for n in range(len(self))]

    def condition(self, key: str, numbers: Iterable[int]) -> str:
        """True for keys in the numbered ranges; neighbouring ranges become one."""
        numbers = sorted(set(numbers))
        if self.shares:
            listed = ", ".join(map(str, numbers))
            return f"{self.number(key)} IN ({listed})" if numbers else "false"
        runs: list[list[int]] = []
        for n in numbers:
            if runs and runs[-1][1] == n - 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        return " OR ".join(self._run(key, *run) for run in runs) or "false"

    def _run(self, key: str, first: int, last: int) -> str:
        ends = []
        if first > 0:
            ends.append(f"{key} >= {self.bounds[first - 1]}")
        if last < len(self.bounds):
            ends.append(f"{key} < {self.bounds[last]}")
        if first > 0:
            return f"({' AND '.join(ends)})"
        return f"({key} IS NULL OR {ends[0]})" if ends else "true"


def key_quantiles(df: DataFrame, key: str, n: int) -> list:
    """At most ``n - 1`` key values between ranges that hold near-equal numbers of rows.

    One pass with a bounded quantile sketch. A key with more rows than a range should hold
    takes a range of its own, so there may be fewer. An empty table has none.
    """
    at = ", ".join(f"{i / n!r}D" for i in range(1, n))
    found = df.agg(F.expr(f"approx_percentile({path(key)}, array({at}), {ACCURACY}) AS bounds"))
    return list(dict.fromkeys(found.first()["bounds"] or []))


def key_ranges(df: DataFrame, key: str, n: int) -> KeyRanges:
    """At most ``n`` ranges of ``key``, by quantiles or, for other types, by hash."""
    dtype = df.schema[key].dataType
    if n <= 1:
        return KeyRanges()
    if not isinstance(dtype, QUANTILE_TYPES):
        return KeyRanges(shares=n)
    typed = dtype.simpleString()
    # Spark writes the values: its texts cast back to themselves.
    values = df.sparkSession.createDataFrame([(v,) for v in key_quantiles(df, key, n)], f"v {typed}")
    texts = [r[0] for r in values.selectExpr("cast(v AS string)").collect()]
    return KeyRanges(tuple(f"cast({literal(t)} AS {typed})" for t in texts))
