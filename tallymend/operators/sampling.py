"""A sample of keys that is the same on both sides, and counts estimated from it.

Keys are ordered by a hash and the first ``n`` of both sides together are taken, each with all
its rows. So a sampled key has all it has on either side, and no row is reported missing or extra
because of the sample. Every key's chance is known, which gives unbiased counts and their
intervals. Rows without a key are not sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.functions.cells import literal
from tallymend.operators.align import Sides

# Leading hex digits of a hash that a double holds exactly.
DIGITS = 13
# Standard deviations on each side of an estimate: 95 of 100 intervals hold the true count.
WIDTH = 1.96


@dataclass(frozen=True)
class KeySample:
    """Rows of keys whose hash is below ``limit``; None takes every key."""

    both: Sides
    limit: str | None

    @property
    def chance(self) -> float:
        """The probability of each key to be in the sample."""
        return 1.0 if self.limit is None else int(self.limit[:DIGITS], 16) / 16**DIGITS


def key_hash(seed: int) -> str:
    return f"md5(concat({literal(f'{seed}:')}, cast(primary_key AS string)))"


def sample_keys(both: Sides, n: int, seed: int = 0) -> KeySample:
    """The ``n`` first keys by hash, found without shuffling more than a few times ``n`` hashes.

    A count of distinct keys tells below which hash about ``2 n`` keys lie. Should that hold
    too few after all, all keys are looked at. ``n + 1`` hashes reach the driver.
    """
    hashes = (
        both.src.select("primary_key")
        .unionByName(both.dest.select("primary_key"))
        .where("primary_key IS NOT NULL")
        .selectExpr(f"{key_hash(seed)} AS hash")
    )
    share = 2 * n / max(hashes.agg(F.approx_count_distinct("hash")).first()[0], 1)
    nearby = hashes.where(F.col("hash") < f"{int(share * 16**DIGITS):0{DIGITS}x}") if share < 1 else hashes

    def first(of: DataFrame) -> list[str]:
        return [r["hash"] for r in of.distinct().orderBy("hash").limit(n + 1).collect()]

    found = first(nearby)
    if len(found) <= n and share < 1:
        found = first(hashes)
    limit = found[n] if len(found) > n else None
    taken = "primary_key IS NOT NULL"
    if limit is not None:
        taken += f" AND {key_hash(seed)} < {literal(limit)}"
    return KeySample(both.where(taken), limit)


def estimated_counts(found: DataFrame, chance: float) -> DataFrame:
    """Records per type and column in the whole tables, from the report of a sample.

    ``sampled`` were seen; ``records`` is the unbiased estimate, and ``low`` to ``high`` its interval.
    Keys, not records, are sampled, so a key with many records widens it as it should. What no
    sampled key has is not listed.
    """
    per_key = found.groupBy("primary_key", "type", "column").agg(F.count("*").alias("n"))
    spread = f"{WIDTH}D * sqrt(sum(n * n) * (1 - {chance!r}D)) / {chance!r}D"
    return (
        per_key.groupBy("type", "column")
        .agg(
            F.expr("sum(n) AS sampled"),
            F.expr(f"sum(n) / {chance!r}D AS records"),
            F.expr(f"{spread} AS spread"),
        )
        .selectExpr(
            "type",
            "column",
            "sampled",
            "records",
            # At least what was seen is there.
            "greatest(records - spread, double(sampled)) AS low",
            "records + spread AS high",
        )
    )
