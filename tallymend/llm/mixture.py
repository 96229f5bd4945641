"""Mixing sources to target weights under a time-varying curriculum.

Every source has a target in words and a weight schedule over training time
0..1. The schedule, integrated, gives the words of the source that training has
asked for by time t; a document whose words begin at offset c of its source's
stream is trained on when that demand reaches c. Ordering by that time is the
mix.

Cases: a null text has no words and is never taken; a null source is a source
of its own, last in order; repeated rows are rows of their own; a source
without words takes none; extra columns are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymend.llm.common import rows_of, shuffle_partitions, text_or_empty, with_row

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights and schedules go round the sources in order.

    ``share``: words of the mix per word of the input. ``most``: how often a
    source may be read. ``schedules``: (weight at time 0, weight at time 1),
    linear between; only their shape counts, the target fixes the amount.
    """

    weights: Sequence[int] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    schedules: Sequence[tuple[float, float]] = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
    seed: str = "mix"


def _turn(rank: Column, values: Sequence) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(rank, F.lit(len(values))).cast("int"))


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and the schedule's ends ``w0``, ``w1``.

    ``sizes`` has ``source`` and ``source_size``. Handing out the excess of
    capped sources by weight, again and again, ends at one level: every target
    is min(cap, level x weight). Sources reach their cap in the order of cap per
    weight, so the level follows from running sums in that order. One row per
    source goes through one task here, no documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_rank", F.row_number().over(in_order) - 1)
    ranked = (
        ranked.withColumn("_weight", _turn(F.col("_rank"), mix.weights).cast("long"))
        .withColumn("_cap", F.col("source_size") * mix.most)
        .withColumn("w0", _turn(F.col("_rank"), [a for a, _ in mix.schedules]))
        .withColumn("w1", _turn(F.col("_rank"), [b for _, b in mix.schedules]))
    )
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.sum("source_size").over(every) * F.lit(mix.share)
    capped = F.coalesce(F.sum("_cap").over(before), F.lit(0))
    free = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    # The level if all earlier sources sit at their caps and this one and all later ones do not.
    filled = ranked.withColumn("_level", (wanted - capped) / free)
    below = F.col("_level") * F.col("_weight") <= F.col("_cap")
    level = F.first(F.when(below, F.col("_level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    cap = F.col("_cap").cast("double")
    target = F.least(cap, F.coalesce(level * F.col("_weight"), cap))
    return filled.select("source", "source_size", target.alias("target"), "w0", "w1")


def _inverse_demand(words: Column) -> Column:
    """The time at which the integrated schedule has asked for ``words`` of ``target``.

    Demand is target x (w0 t + (w1 - w0) t^2 / 2) / ((w0 + w1) / 2).
    """
    w0, w1 = F.col("w0"), F.col("w1")
    area = words / F.col("target") * (w0 + w1) / 2
    root = F.sqrt(w0 * w0 + 2 * (w1 - w0) * area)
    return F.when(area <= 0, F.lit(0.0)).otherwise(2 * area / (w0 + root))


def assign(
    docs: DataFrame,
    mix: Mix = Mix(),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``positions``.

    A source is read in hash order, pass after pass; a document is taken by a
    pass if its middle word lies within the target, so the words taken miss the
    target by half a document at most. ``positions`` has the training time of
    every time it is taken. Columns of these names are replaced.
    """
    added = ("size", "source_size", "target", "taken", "positions")
    order = F.md5(F.concat(F.lit(mix.seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    # A null source has a key of its own and takes part in the plain joins below.
    owner = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    sized = with_row(
        docs,
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
        order.alias("_order"),
        F.substring(order, 1, 3).alias("_slice"),
        owner.alias("_owner"),
        F.col(key).alias("_key"),
    )
    slices = sized.groupBy("_owner", "_slice").agg(F.sum("size").alias("_words"))
    sources = slices.groupBy("_owner").agg(F.sum("_words").alias("source_size"))
    goals = targets(
        sources.select(
            F.when(F.col("_owner") != "n", F.expr("substring(_owner, 2)")).alias("source"),
            "source_size",
        ),
        mix,
    ).withColumn("_owner", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    before = Window.partitionBy("_owner").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = slices.withColumn("_begin", F.coalesce(F.sum("_words").over(before), F.lit(0))).join(
        goals.drop("source"), "_owner"
    )
    within = (
        Window.partitionBy("_owner", "_slice")
        .orderBy("_order", "_key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = sized.join(begins.drop("_words"), ["_owner", "_slice"]).withColumn(
        "_at", F.col("_begin") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    starts = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(mix.most - 1)),
            lambda turn: turn * F.col("source_size") + F.col("_at"),
        ),
        lambda at: (F.col("size") > 0) & (at + F.col("size") / 2 <= F.col("target")),
    )
    return (
        placed.withColumn("_starts", starts)
        .withColumn("taken", F.size("_starts") * F.col("size"))
        .withColumn("positions", F.transform("_starts", _inverse_demand))
        .select(*rows_of(placed, [c for c in docs.columns if c not in added]), *added)
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for every time a document is taken, range-sorted by ``position``."""
    copies = mixed.withColumn("position", F.explode("positions"))
    parts = shuffle_partitions(mixed.sparkSession)
    return copies.repartitionByRange(parts, "position").sortWithinPartitions("position")


# A document is taken twice at most.
TIMES = ("position", "second_position")


def digest(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    return mixed.select(
        key,
        "size",
        "source_size",
        "target",
        "taken",
        *(F.get("positions", F.lit(i)).alias(name) for i, name in enumerate(TIMES)),
    )


def digest_sql(mix: Mix = Mix()) -> str:
    """The same in DuckDB."""
    pick = lambda values: f"[{', '.join(map(str, values))}][rank % {len(values)} + 1]"
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5('{mix.seed}:' || doc_id) AS ord FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
ranked AS (
  SELECT *, {pick(mix.weights)} AS weight, source_size * {mix.most} AS cap,
    {pick([f"{a}::DOUBLE" for a, _ in mix.schedules])} AS w0,
    {pick([f"{b}::DOUBLE" for _, b in mix.schedules])} AS w1 FROM sources),
levels AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
    (sum(source_size) OVER ()::DOUBLE * {mix.share}::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM ranked
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
settled AS (SELECT arg_min(level, (ratio, rank)) AS level FROM levels WHERE level * weight <= cap),
goals AS (
  SELECT l.source, source_size, w0, w1,
    least(cap::DOUBLE, coalesce(s.level * weight, cap::DOUBLE)) AS target FROM levels l, settled s),
placed AS (
  SELECT d.doc_id, d.size, g.*, coalesce(sum(d.size) OVER (
      PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, len(list_filter(range({mix.most}),
    lambda t: size > 0 AND (t * source_size + begins)::DOUBLE + size::DOUBLE / 2 <= target)) AS times,
    begins::DOUBLE / target * (w0 + w1) / 2 AS area,
    (source_size + begins)::DOUBLE / target * (w0 + w1) / 2 AS second_area FROM placed)
SELECT doc_id, size, source_size, target, (times * size)::BIGINT AS taken,
  CASE WHEN times = 0 THEN NULL WHEN area <= 0 THEN 0.0
    ELSE 2 * area / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * area)) END AS position,
  CASE WHEN times < 2 THEN NULL WHEN second_area <= 0 THEN 0.0
    ELSE 2 * second_area / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * second_area)) END AS second_position
FROM taken"""
