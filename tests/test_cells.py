"""Cell semantics on literal values."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tallymend.functions import cells as c
from tallymend.functions.hashing import row_hash

S, D = T.StringType(), T.DoubleType()


def evaluate(spark, expression: str, values: list, dtypes: list[T.DataType]):
    schema = T.StructType([T.StructField(f"v{i}", t) for i, t in enumerate(dtypes)])
    return spark.createDataFrame([tuple(values)], schema).selectExpr(f"{expression} AS x").first()["x"]


EQUAL = [
    (Decimal("-265.23"), T.DecimalType(10, 2), -265.23, D),
    (Decimal("10.00"), T.DecimalType(10, 2), "10", S),
    ("2020-10-04 00:00:00.0000000", S, "2020-10-04", S),
    ("18.20", S, "18.2", S),
    (" a ", S, "a", S),
    ("NaN", S, "nan", S),
    ("-nan", S, math.nan, D),
    ("inf", S, math.inf, D),
    (None, S, None, S),
    (None, D, None, S),
    (1.0, D, 1.000009, D),
    (True, T.BooleanType(), 1, T.IntegerType()),
    (datetime.date(2024, 5, 1), T.DateType(), "2024-05-01 13:14:15", S),
    (datetime.datetime(2024, 5, 1, 9), T.TimestampType(), datetime.date(2024, 5, 1), T.DateType()),
    ("05/01/2024", S, "01-MAY-2024", S),
    ("May 1, 2024", S, "2024/05/01", S),
    (" x　", S, "x", S),
    ("1e3", S, 1000, T.IntegerType()),
]
UNEQUAL = [
    ("a", S, "b", S),
    (10.2, D, 10.4, D),
    ("10.2", S, "10.4", S),
    ("112946.26", S, 112946.99, D),
    ("None", S, None, S),
    ("1d", S, "1", S),
    ("1_000", S, 1000, T.IntegerType()),
    ("2024-05", S, "2024-05-01", S),
    ("inf", S, "-inf", S),
    (1.0, D, 1.00002, D),
    ("20240501", S, "2024-05-01", S),
    (datetime.date(2024, 5, 1), T.DateType(), 20240501, T.IntegerType()),
    ("", S, None, S),
]


@pytest.mark.parametrize("case", EQUAL)
def test_equal(spark, case):
    a, a_type, b, b_type = case
    for x, xt, y, yt in ((a, a_type, b, b_type), (b, b_type, a, a_type)):
        assert evaluate(spark, c.cell_equal("v0", xt, "v1", yt), [x, y], [xt, yt]) is True


@pytest.mark.parametrize("case", UNEQUAL)
def test_unequal(spark, case):
    a, a_type, b, b_type = case
    for x, xt, y, yt in ((a, a_type, b, b_type), (b, b_type, a, a_type)):
        assert evaluate(spark, c.cell_equal("v0", xt, "v1", yt), [x, y], [xt, yt]) is False


def test_strict_numbers(spark):
    strict = c.cell_equal("v0", D, "v1", D, tolerance=0.0)
    assert evaluate(spark, strict, [1.0, 1.000001], [D, D]) is False
    assert evaluate(spark, strict, [1.0, 1.0], [D, D]) is True
    assert evaluate(spark, strict, [math.nan, math.nan], [D, D]) is True


@pytest.mark.parametrize(
    ("value", "dtype", "text"),
    [
        ("18.20", S, "18.20000"),
        (18.2, D, "18.20000"),
        (1e40, D, "1.0E40"),
        (math.nan, D, "NaN"),
        (-0.0000001, D, "0.00000"),
        ("2021-01-01 00:00:00", S, "2021-01-01"),
        ("  padded\t", S, "padded"),
        (bytearray(b"\x01\xff"), T.BinaryType(), "01FF"),
        ([1, 2], T.ArrayType(T.IntegerType()), "[1,2]"),
    ],
)
def test_canonical(spark, value, dtype, text):
    assert evaluate(spark, c.canonical("v0", dtype), [value], [dtype]) == text


def test_sanitize_sets_one_field(spark):
    for value, field in (("1.5", "number"), ("2024-05-01", "day"), ("x y", "text")):
        row = evaluate(spark, c.sanitize("v0", S), [value], [S])
        assert [n for n in ("number", "day", "text") if row[n] is not None] == [field]
    assert evaluate(spark, c.sanitize("v0", S), [None], [S]) is None


def test_bad_day_or_time_is_text(spark):
    for value in ("2024-13-01", "2024-05-01 25:00", "13/45/2020"):
        assert evaluate(spark, c.as_day("v0", S), [value], [S]) is None


def _hash(spark, values, dtypes, algo="md5"):
    cells = {f"c{i}": c.read_cell(f"v{i}", t) for i, t in enumerate(dtypes)}
    return evaluate(spark, row_hash(cells, algo), values, dtypes)


@pytest.mark.parametrize("algo", ["md5", "xxhash64"])
def test_hash(spark, algo):
    assert _hash(spark, ["2021-01-01 00:00:00", "18.20"], [S, S], algo) == _hash(
        spark, ["2021-01-01", 18.2], [S, D], algo
    )
    assert _hash(spark, ["ab", "c"], [S, S], algo) != _hash(spark, ["a", "bc"], [S, S], algo)
    assert _hash(spark, [None, "a"], [S, S], algo) != _hash(spark, ["a", None], [S, S], algo)
    assert _hash(spark, [None], [S], algo) != _hash(spark, ["NULL"], [S], algo)


def test_white_space_is_what_strip_removes():
    assert set(c.WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(
    ("a", "a_type", "b", "b_type", "equal"),
    [
        ("9007199254740993", "bigint", "9007199254740992", "bigint", False),
        ("9007199254740993", "bigint", "9007199254740993", "decimal(38,0)", True),
        ("9007199254740993", "bigint", "9007199254740992", "decimal(20,2)", False),
        ("9" * 38, "decimal(38,0)", "9" * 37 + "8", "decimal(38,0)", False),
        ("9" * 38, "decimal(38,0)", "9" * 38, "decimal(38,0)", True),
        ("1234567890123456789.000001", "decimal(38,6)", "1234567890123456789.000002", "decimal(38,6)", True),
        ("1234567890123456789.00001", "decimal(38,6)", "1234567890123456789.00002", "decimal(38,6)", False),
        ("9007199254740993", "bigint", "9007199254740992", "double", True),
        ("5", "int", "5.000001", "decimal(10,6)", True),
        ("NULL", "bigint", "0", "decimal(38,0)", False),
        ("NULL", "bigint", "NULL", "decimal(38,0)", True),
    ],
)
def test_exact_numbers_are_not_compared_as_doubles(spark, a, a_type, b, b_type, equal):
    quoted = [v if v == "NULL" else f"'{v}'" for v in (a, b)]
    row = spark.range(1).selectExpr(f"cast({quoted[0]} AS {a_type}) AS a", f"cast({quoted[1]} AS {b_type}) AS b")
    types = [row.schema[n].dataType for n in ("a", "b")]
    assert row.selectExpr(c.cell_equal("a", types[0], "b", types[1])).first()[0] is equal
    texts = row.selectExpr(*(c.canonical(n, t) for n, t in zip(("a", "b"), types, strict=True))).first()
    # Equal digests never hide a difference.
    assert equal or texts[0] != texts[1]


def test_a_text_is_tested_for_a_number_once():
    """Digest and alignment test every text cell; each test is a regular expression."""
    cell = c.read_cell("v0", S)
    assert cell.canonical().count(c.NUMBER_FORM) == 1
    assert c.reading(cell).count(c.NUMBER_FORM) == 1
