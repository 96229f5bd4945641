"""Pairing the rows of two tables by primary key inside a partition.

Input tables carry their logical columns plus the partition columns added by
``tag_partition``. The result has one row per pair or unpaired row:

    year, month, week, primary_key, occurrence,
    src STRUCT, dest STRUCT, src_cells STRUCT, dest_cells STRUCT

``src`` or ``dest`` is NULL where a side has no row. The ``_cells`` structs
carry what parsing text columns found, so no later step parses again.

Duplicate keys pair by position: the k-th source row meets the k-th
destination row in the order of the compared values, and leftovers stay
unpaired. Rows without a key pair with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymend.functions.cells import (
    DATE_FORMS,
    DAY,
    NUMBER,
    OPAQUE,
    Cell,
    apart,
    carried,
    kind_of,
    literal,
    orderable,
    path,
    raw_text,
    read_cell,
    reading,
)
from tallymend.functions.hashing import NULL_MARK, row_hash
from tallymend.plans.durable import durable
from tallymend.plans.scope import PARTITION

# Sorting by the key first lets Spark's sort compare mostly by key prefix.
KEYS = ("primary_key", "year", "month", "week")
BY_KEY = ", ".join(KEYS)
SRC, DEST = 0, 1

# The sketch follows this many candidates and reports at most HOT_KEYS of them,
# so what reaches the driver is bounded whatever the table size. A key outside
# the sketch holds well under a thousandth of the rows. Where the list is full,
# all hot keys are counted instead and joined as a table.
HOT_KEYS = 10_000
SKETCH_ITEMS = 100_000
SKETCH_LANES = 1_000
# Numbers of a split key that are paired in one task.
COPIES_PER_STEP = 10_000
# Largest key list that is broadcast, and what a listed row takes besides its key.
BROADCAST_BYTES = 256 << 20
ROW_BYTES = 128
# A task that numbers and pairs gets about this much, by a rough size of a parsed
# row. Merging shuffle partitions by their compressed size would give it ten times that.
TASK_BYTES = 256 << 20
FIELD_BYTES = 64
# Up to this many partitions a shuffle writes rows as they come; beyond, it sorts them in
# memory first. So a task gets up to MOST_BYTES before there are more.
PLAIN_PARTITIONS = 200
MOST_BYTES = 4 * TASK_BYTES
# Fewer rows than this do not pay for a task of their own.
TASK_ROWS = 20_000


@dataclass(frozen=True)
class Sides:
    """Both tables in the common layout: KEYS plus the row as one struct.

    The struct is named ``src`` or ``dest``.
    """

    src: DataFrame
    dest: DataFrame
    src_row: T.StructType
    dest_row: T.StructType
    columns: tuple[str, ...]
    forms: tuple[tuple[str, str], ...]

    def on(self, src: DataFrame, dest: DataFrame) -> Sides:
        return Sides(src, dest, self.src_row, self.dest_row, self.columns, self.forms)

    def where(self, condition: str) -> Sides:
        return self.on(self.src.where(condition), self.dest.where(condition))

    def plain_cell(self, name: str, column: str) -> Cell:
        """A compared value of side ``name``, read from its row."""
        row = self.src_row if name == "src" else self.dest_row
        return read_cell(path(name, column), row[column].dataType, self.forms)


def common_key_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type in which keys of the two types compare like values."""
    if a == b:
        return a
    if not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return T.StringType()
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.DecimalType(38, max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b)))


def sides(
    src: DataFrame,
    dest: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    forms: Sequence[tuple[str, str]] = DATE_FORMS,
) -> Sides:
    """Bring two partition-tagged tables into the common layout."""
    for name, df in (("source", src), ("destination", dest)):
        absent = [c for c in (key, *PARTITION) if c not in df.columns]
        if absent:
            raise ValueError(f"the {name} lacks the columns {absent}")
    src_cols = [c for c in src.columns if c not in PARTITION]
    dest_cols = [c for c in dest.columns if c not in PARTITION]
    if columns is None:
        columns = [c for c in src_cols if c in dest_cols and c != key]
    unmapped = [c for c in columns if c not in src_cols or c not in dest_cols]
    if unmapped:
        raise ValueError(f"compared columns missing on one side: {unmapped}")
    key_type = common_key_type(src.schema[key].dataType, dest.schema[key].dataType).simpleString()

    def layout(df: DataFrame, cols: list[str], name: str) -> DataFrame:
        row = ", ".join(f"{_sortable(df, c)} AS {path(c)}" for c in cols)
        year, month, week = PARTITION
        return df.selectExpr(
            f"cast({path(key)} AS {key_type}) AS primary_key",
            f"{year} AS year",
            f"{month} AS month",
            f"{week} AS week",
            f"struct({row}) AS {name}",
        )

    src, dest = layout(src, src_cols, "src"), layout(dest, dest_cols, "dest")
    return Sides(
        src,
        dest,
        src.schema["src"].dataType,
        dest.schema["dest"].dataType,
        tuple(columns),
        tuple(forms),
    )


def _sortable(df: DataFrame, column: str) -> str:
    """The column, as JSON text if its type has no order."""
    dtype = df.schema[column].dataType
    return path(column) if orderable(dtype) else raw_text(path(column), dtype)


def carries_reading(src_type: T.DataType, dest_type: T.DataType) -> bool:
    """Whether a column's cells are parsed once and carried.

    Where both types read alike without parsing, the raw values will do.
    """
    kinds = {kind_of(src_type), kind_of(dest_type)}
    return kinds not in ({NUMBER}, {DAY}, {OPAQUE})


def aligned_cell(src: T.StructType, dest: T.StructType, name: str, column: str) -> Cell:
    """The value of ``column`` on side ``src`` or ``dest`` of an aligned row."""
    src_type, dest_type = src[column].dataType, dest[column].dataType
    dtype = src_type if name == "src" else dest_type
    if carries_reading(src_type, dest_type):
        return carried(path(name, column), dtype, path(f"{name}_cells", column))
    return read_cell(path(name, column), dtype)


def same_keys(a: DataFrame, b: DataFrame, names: Sequence[str] = KEYS) -> Column:
    """Key equality in which an absent week equals an absent week."""
    return reduce(
        and_, (a[n] == b[n] if n == "primary_key" else a[n].eqNullSafe(b[n]) for n in names)
    )


def key_digest() -> str:
    texts = ", ".join(f"coalesce(cast({k} AS string), r'{NULL_MARK}')" for k in KEYS)
    return f"xxhash64({texts})"


def hot_keys(both: Sides, hot_rows: int) -> list[int]:
    """Digests of the keys with at least ``hot_rows`` rows on the two sides together."""
    return _surveyed(both, hot_rows)[0]


def _surveyed(both: Sides, hot_rows: int) -> tuple[list[int], int]:
    """``hot_keys``, and how many rows have a key.

    One pass over the key columns with a bounded frequent-items sketch per
    task: no key is shuffled and at most HOT_KEYS digests come back. The
    sketches are merged in lanes and the lanes once more, so that no single
    task reads a sketch from every task of the scan. The list only decides
    which of two exact ways a key takes.
    """
    src, dest = (
        df.where("primary_key IS NOT NULL").selectExpr(f"{key_digest()} AS digest")
        for df in (both.src, both.dest)
    )
    lanes = (
        src.unionByName(dest)
        .selectExpr("digest", f"pmod(spark_partition_id(), {SKETCH_LANES}) AS lane")
        .groupBy("lane")
        .agg(
            F.expr(f"approx_top_k_accumulate(digest, {SKETCH_ITEMS}) AS sketch"),
            F.count("*").alias("rows"),
        )
    )
    merged = f"approx_top_k_combine(sketch, {SKETCH_ITEMS})"
    # Grouped, so that empty tables give no row: Spark cannot combine no sketches.
    top = lanes.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate({merged}, {HOT_KEYS})").alias("top"), F.sum("rows").alias("rows")
    )
    found = top.collect()
    hot = [row["item"] for r in found for row in r["top"] or () if row["count"] >= hot_rows]
    return sorted(hot), sum(r["rows"] for r in found)


def _rows(both: Sides) -> int:
    """Rows with a key on the two sides together."""
    return sum(df.where("primary_key IS NOT NULL").count() for df in (both.src, both.dest))


def _tasks(both: Sides, rows: int) -> int:
    """How many tasks number and pair ``rows`` rows, so that a task's share does not grow with them."""
    fields = len(KEYS) + len(both.src_row) + len(both.dest_row) + 2 * len(both.columns)
    size = rows * fields * FIELD_BYTES
    # Beyond PLAIN_PARTITIONS only what the cores need, however many the session asks for.
    cores = both.src.sparkSession.sparkContext.defaultParallelism
    at_least = min(_partitions(both), -(-rows // TASK_ROWS), max(PLAIN_PARTITIONS, cores))
    # Two at least, so that rows are dealt by key also where there are hardly any.
    return max(2, at_least, min(-(-size // TASK_BYTES), PLAIN_PARTITIONS), -(-size // MOST_BYTES))


def _partitions(both: Sides) -> int:
    return int(both.src.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def align(
    both: Sides,
    *,
    unique_key: bool = False,
    discard_equal_first: bool = False,
    hot_rows: int | None = 1_000_000,
    keyed: Sides | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Full-outer alignment of the two sides.

    ``unique_key`` states that no key repeats within a side and partition, so
    rows need no numbering; a key that repeats after all fails the job.
    ``discard_equal_first`` drops the keys whose rows all have an equal
    counterpart before any row content is shuffled.
    ``hot_rows`` sets from how many rows on a key its numbering is split over
    the cluster; None skips looking for such keys.
    ``keyed`` holds the rows to look at among those with a key; by default all.
    ``rows`` is how many these are, where that is known; it only sets the number of tasks.
    """
    keyed = both if keyed is None else keyed
    keyed = _drop_equal_keys(keyed) if discard_equal_first else keyed
    keyed = keyed.where("primary_key IS NOT NULL")
    if unique_key:
        parts = [_pair_unique(keyed, rows)]
    else:
        parts = [_pair(part) for part in numbered(keyed, hot_rows, rows)]
    layout = parts[0].schema
    parts += [_without_key(both, name, layout) for name in ("src", "dest")]
    return reduce(DataFrame.unionByName, parts)


def numbered(keyed: Sides, hot_rows: int | None, rows: int | None = None) -> list[DataFrame]:
    """Numbered rows: of the keys one task can number, and of those split over many."""
    hot = []
    if hot_rows:
        hot, rows = _surveyed(keyed, hot_rows)
    elif rows is None:
        rows = _rows(keyed)
    tasks = _tasks(keyed, rows)
    if not hot:
        return [_number(keyed, tasks)]
    if len(hot) < HOT_KEYS:
        is_hot = f"{key_digest()} IN ({', '.join(f'{h}L' for h in hot)})"
        plain, split = keyed.where(f"NOT {is_hot}"), keyed.where(is_hot)
    else:
        listed = all_hot_keys(keyed, hot_rows)
        plain, split = (_by_hot(keyed, listed, how) for how in ("left_anti", "left_semi"))
    return [_number(plain, tasks), _number_split(split, tasks)]


def all_hot_keys(both: Sides, hot_rows: int) -> DataFrame:
    """Digests of all keys with at least ``hot_rows`` rows, counted and written out.

    Digests are counted before the shuffle. There are at most as many as rows divided by ``hot_rows``.
    """
    digests = (df.where("primary_key IS NOT NULL").selectExpr(f"{key_digest()} AS hot") for df in (both.src, both.dest))
    counted = reduce(DataFrame.unionByName, digests).groupBy("hot").agg(F.count("*").alias("n"))
    return durable(counted.where(F.col("n") >= hot_rows).select("hot"))


def _by_hot(both: Sides, listed: DataFrame, how: str) -> Sides:
    """The rows whose key is listed, or is not; the list is broadcast if its size allows."""
    hot = F.broadcast(listed) if listed.count() * ROW_BYTES <= BROADCAST_BYTES else listed
    on = F.expr(f"{key_digest()} = hot")
    return both.on(both.src.join(hot, on, how), both.dest.join(hot, on, how))


def number_rows(
    table: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    hot_rows: int | None = 1_000_000,
) -> DataFrame:
    """One partition-tagged table with the numbers its rows get as a destination.

    KEYS, ``dest`` and ``occurrence``; rows without a key have no number and
    are left out. ``columns`` are the compared ones, in the order of the report.
    """
    keyed = sides(table.limit(0), table, key, columns).where("primary_key IS NOT NULL")
    parts = [p.select(*KEYS, "dest", "occurrence") for p in numbered(keyed, hot_rows)]
    return reduce(DataFrame.unionByName, parts)


def _without_key(both: Sides, name: str, layout: T.StructType) -> DataFrame:
    """Rows of one side that have no key; they meet no shuffle at all."""
    df = (both.src if name == "src" else both.dest).where("primary_key IS NULL")
    have = (*KEYS, name)
    return df.select(
        *(F.col(f.name) if f.name in have else _null(f.name, f.dataType) for f in layout)
    )


def _null(name: str, dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype).alias(name)


def _stack(both: Sides) -> DataFrame:
    """Both sides under one schema, so one shuffle serves numbering and pairing."""
    src_side, dest_side = F.lit(SRC).alias("side"), F.lit(DEST).alias("side")
    return both.src.select(*KEYS, src_side, "src", _null("dest", both.dest_row)).unionByName(
        both.dest.select(*KEYS, dest_side, _null("src", both.src_row), "dest")
    )


def _cells(both: Sides) -> str:
    """What parsing finds in a stacked row: STRUCT<column: reading, ...>.

    Evaluated above the shuffle, so it runs once per row and its result is not
    sent over the network. A column that is text on both sides is parsed by
    one expression whichever side the row is from.
    """
    fields = ["'parsed', true"]  # keeps the struct from being empty
    for c in both.columns:
        src, dest = both.plain_cell("src", c), both.plain_cell("dest", c)
        if not carries_reading(src.dtype, dest.dtype):
            continue
        if src.dtype == dest.dtype:
            found = reading(read_cell(f"coalesce({src.raw}, {dest.raw})", src.dtype, both.forms))
        else:
            found = f"CASE WHEN side = {SRC} THEN {reading(src)} ELSE {reading(dest)} END"
        fields.append(f"{literal(c)}, {found}")
    return apart(f"named_struct({', '.join(fields)})", "side")


def _order(both: Sides) -> list[str]:
    """Position within a key: the compared values, then the row as it is."""
    order = []
    for c in both.columns:
        src, dest = both.plain_cell("src", c), both.plain_cell("dest", c)
        if carries_reading(src.dtype, dest.dtype):
            order += [f"{path('cells', c)}.number", f"{path('cells', c)}.text"]
        elif src.kind == NUMBER:
            order.append(f"coalesce({src.number}, {dest.number})")
        elif src.kind == DAY:
            order.append(f"coalesce(to_date({src.raw}), to_date({dest.raw}))")
        else:
            order.append(f"coalesce({src.text}, {dest.text})")
    return [*order, "src", "dest", *_zero_signs(both)]


def _zero_signs(both: Sides) -> list[str]:
    """What tells rows apart that compare as equal: the sign of a zero.

    Sorting and grouping take -0.0 and 0.0 for one value.
    """
    signs = []
    for name, row in (("src", both.src_row), ("dest", both.dest_row)):
        for field in row:
            cell = path(name, field.name)
            if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
                signs.append(f"coalesce({cell} = 0 AND cast({cell} AS string) LIKE '-%', false)")
            elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
                signs.append(f"to_json(named_struct('v', {cell}))")
    return signs


def _number(both: Sides, tasks: int) -> DataFrame:
    """Number the rows of each key and side. The only shuffle is on the key."""
    position = f"row_number() OVER (PARTITION BY {BY_KEY}, side ORDER BY {', '.join(_order(both))})"
    return (
        _stack(both)
        .repartition(tasks, *KEYS)
        .selectExpr("*", f"{_cells(both)} AS cells")
        .selectExpr("*", f"cast({position} AS bigint) AS occurrence")
    )


def _number_split(both: Sides, tasks: int) -> DataFrame:
    """The numbering of ``_number`` for keys too big for one task.

    Exact copies fold into one counted row before they are shuffled. The rows
    are then range-partitioned in their order; a row's number is its number
    within its slice plus the rows of its key in earlier slices. The slices
    are written out first, so that a lost executor cannot cut them anew.
    """
    row = [*KEYS, "side", "src", "dest"]
    group = f"{BY_KEY}, side"
    folded = _folded(both)
    order = _order(both)
    names = [f"order_{i}" for i in range(len(order))]
    by_order = ", ".join(names)
    slices = max(_partitions(both), tasks)
    sliced = durable(
        folded.selectExpr("*", f"{_cells(both)} AS cells")
        .selectExpr("*", *(f"{o} AS {n}" for o, n in zip(order, names, strict=True)))
        .repartitionByRange(slices, *KEYS, "side", *names)
        .withColumn("slice", F.spark_partition_id())
    )
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    # At most one row per slice plus one per hot key and side.
    offsets = (
        sliced.groupBy(*KEYS, "side", "slice")
        .agg(F.sum("copies").alias("in_slice"))
        .selectExpr(
            *KEYS,
            "side",
            "slice",
            f"coalesce(sum(in_slice) OVER (PARTITION BY {group} ORDER BY slice {before}), 0) AS earlier",
        )
    )
    within = (
        f"coalesce(sum(copies) OVER (PARTITION BY {group}, slice ORDER BY {by_order} {before}), 0)"
    )
    placed = sliced.selectExpr(*row, "cells", "copies", "slice", f"{within} AS within")
    starts = placed.join(offsets, same_keys(placed, offsets, (*KEYS, "side", "slice"))).select(
        *(placed[c] for c in (*row, "cells", "copies")),
        (F.col("earlier") + F.col("within")).alias("start"),
    )
    # Cut into blocks of numbers before the shuffle that the pairing needs anyway, so
    # no task writes out a huge run of copies alone.
    size = COPIES_PER_STEP
    return (
        starts.selectExpr(
            "*", f"explode(sequence(start div {size}, (start + copies - 1) div {size})) AS block"
        )
        .repartition(tasks, *KEYS, "block")
        .selectExpr(
            *row,
            "cells",
            "block",
            f"explode(sequence(greatest(start, block * {size}) + 1,"
            f" least(start + copies, (block + 1) * {size}))) AS occurrence",
        )
    )


def _folded(both: Sides) -> DataFrame:
    """Stacked rows, exact copies as one row with their number ``copies``.

    Grouping rewrites -0.0 in its keys. Where all fields are plain values, the sign is put
    back and the copies are counted in a hash table; else a row of each group is
    carried along, for which Spark sorts them.
    """
    signs = {f"sign_{i}": sign for i, sign in enumerate(_zero_signs(both))}
    stacked = _stack(both).selectExpr("*", *(f"{sign} AS {name}" for name, sign in signs.items()))
    row = [*KEYS, "side", "src", "dest"]
    fields = [(name, f) for name, schema in (("src", both.src_row), ("dest", both.dest_row)) for f in schema]
    if any(isinstance(f.dataType, (T.ArrayType, T.StructType)) for _, f in fields):
        same = [F.col(c).alias(f"by_{c}") for c in ("src", "dest")]
        first = [F.first(c).alias(c) for c in ("src", "dest")]
        found = stacked.groupBy(*KEYS, "side", *same, *signs).agg(*first, F.count("*").alias("copies"))
        return found.select(*row, "copies")
    left, rebuilt = iter(signs), {"src": [], "dest": []}
    for name, f in fields:
        value = path(name, f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            value = f"if({next(left)}, cast('-0.0' AS {f.dataType.simpleString()}), {value})"
        rebuilt[name].append(f"{literal(f.name)}, {value}")
    return stacked.groupBy(*row, *signs).agg(F.count("*").alias("copies")).selectExpr(
        *KEYS,
        "side",
        *(f"CASE WHEN {c} IS NOT NULL THEN named_struct({', '.join(v)}) END AS {c}" for c, v in rebuilt.items()),
        "copies",
    )


def _pair(numbered: DataFrame) -> DataFrame:
    """Put the two rows that share a key and a number side by side."""
    # Numbers of split keys are dealt in blocks.
    slot = [c for c in ("block", "occurrence") if c in numbered.columns]
    over = f"OVER (PARTITION BY {', '.join([*KEYS, *slot])} ORDER BY side)"
    return _paired(
        numbered.selectExpr(
            "*",
            f"lead(named_struct('dest', dest, 'cells', cells)) {over} AS other",
            f"lag(side) {over} AS earlier_side",
        ).where(f"side = {SRC} OR earlier_side IS NULL")
    )


def _pair_unique(both: Sides, rows: int | None = None) -> DataFrame:
    """Pairing for keys stated to be unique: one shuffle, one sort, no numbering."""
    over = f"OVER (PARTITION BY {BY_KEY} ORDER BY side)"
    repeats = "raise_error(concat('key repeats on one side: ', cast(primary_key AS string)))"
    return _paired(
        _stack(both)
        .repartition(_tasks(both, _rows(both) if rows is None else rows), *KEYS)
        .selectExpr("*", f"{_cells(both)} AS cells", "1L AS occurrence")
        .selectExpr(
            "*",
            f"lead(named_struct('dest', dest, 'cells', cells)) {over} AS other",
            f"lag(side) {over} AS earlier_side",
        )
        .where(
            f"CASE WHEN earlier_side = side THEN cast({repeats} AS boolean)"
            f" ELSE side = {SRC} OR earlier_side IS NULL END"
        )
    )


def _paired(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "year",
        "month",
        "week",
        "primary_key",
        "occurrence",
        "src",
        "coalesce(dest, other.dest) AS dest",
        f"CASE WHEN side = {SRC} THEN cells END AS src_cells",
        f"CASE WHEN side = {DEST} THEN cells ELSE other.cells END AS dest_cells",
    )


def dirty_keys(both: Sides) -> DataFrame:
    """Keys whose multiset of row digests differs between the sides.

    Source rows count +1 and destination rows -1 per (key, digest); equal rows
    cancel. Only keys and digests are shuffled, copies fold before the shuffle
    and the digest spreads a repeated key over many tasks.
    """

    def signed(df: DataFrame, name: str, sign: int) -> DataFrame:
        digest = row_hash({c: both.plain_cell(name, c) for c in both.columns})
        return df.where("primary_key IS NOT NULL").selectExpr(
            *KEYS, f"{apart(digest, 'primary_key')} AS digest", f"{sign} AS sign"
        )

    return (
        signed(both.src, "src", 1)
        .unionByName(signed(both.dest, "dest", -1))
        .groupBy(*KEYS, "digest")
        .agg(F.sum("sign").alias("balance"))
        .where("balance <> 0")
        .select(*KEYS)
        .distinct()
    )


def _drop_equal_keys(both: Sides) -> Sides:
    """Keep the rows of dirty keys only.

    The dirty keys are written out and measured first: a small list is
    broadcast, so the wide rows of equal keys are never shuffled; a large one
    is joined by shuffle.
    """
    dirty = durable(dirty_keys(both))
    if list_bytes(dirty) <= BROADCAST_BYTES:
        dirty = F.broadcast(dirty)
    return both.on(
        both.src.join(dirty, same_keys(both.src, dirty), "left_semi"),
        both.dest.join(dirty, same_keys(both.dest, dirty), "left_semi"),
    )


def list_bytes(keys: DataFrame) -> int:
    """Upper estimate of the memory a key list takes when broadcast."""
    size = f"coalesce(octet_length(cast(primary_key AS string)), 0) + {ROW_BYTES}"
    return keys.selectExpr(f"coalesce(sum({size}), 0) AS bytes").first()["bytes"]


def matched_pairs(aligned: DataFrame) -> DataFrame:
    return aligned.where("src IS NOT NULL AND dest IS NOT NULL")


def missing_in_dest(aligned: DataFrame) -> DataFrame:
    return aligned.where("dest IS NULL").drop("dest", "dest_cells")


def extra_in_dest(aligned: DataFrame) -> DataFrame:
    return aligned.where("src IS NULL").drop("src", "src_cells")


def _key_rows(both: Sides) -> DataFrame:
    return both.src.selectExpr(*KEYS, f"{SRC} AS side").unionByName(
        both.dest.selectExpr(*KEYS, f"{DEST} AS side")
    )


SIDE_COUNTS = (f"count_if(side = {SRC}) AS src_rows", f"count_if(side = {DEST}) AS dest_rows")


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*(F.expr(c) for c in SIDE_COUNTS))


def common_keys(both: Sides) -> DataFrame:
    """Keys present on both sides of a partition, each once."""
    rows = _key_rows(both).where("primary_key IS NOT NULL")
    return (
        _counted(rows, "year", "month", "week", "primary_key")
        .where("src_rows > 0 AND dest_rows > 0")
        .drop("src_rows", "dest_rows")
    )


def duplicate_keys(both: Sides) -> DataFrame:
    """Keys that repeat on a side, with their row counts."""
    counted = _counted(_key_rows(both), "year", "month", "week", "primary_key")
    return counted.where("src_rows > 1 OR dest_rows > 1")


def side_row_counts(both: Sides) -> DataFrame:
    """Rows read per partition and side."""
    return _counted(_key_rows(both), "year", "month", "week")


def null_key_counts(both: Sides) -> DataFrame:
    """Rows without a key, per side; they cannot be paired."""
    return (
        _key_rows(both)
        .selectExpr(f"if(side = {SRC}, 'source', 'destination') AS side", "primary_key")
        .groupBy("side")
        .agg(F.expr("count(*) AS rows"), F.expr("count_if(primary_key IS NULL) AS null_keys"))
    )
