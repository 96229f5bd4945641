"""Cell semantics: how one value is read, written canonically and compared.

Every function takes and returns Spark SQL expression text, and the column's
Spark type, so a numeric column never pays for text parsing and a text column
gets the full number, then calendar day, then trimmed text reading. Use the
result with ``F.expr`` or ``selectExpr``.

A non-NULL cell is exactly one of

* a number  - numeric and boolean columns, and text that spells a number;
* a day     - date and timestamp columns, and text in one of DATE_FORMS
              (the time of day is dropped);
* a text    - anything else, with surrounding white space removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# The characters Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Text forms read as a full calendar day, each optionally
# followed by a time of day. (pattern of the day part, Spark date format)
ISO_DAY = "yyyy-MM-dd"  # what Spark's own cast reads
DATE_FORMS: tuple[tuple[str, str], ...] = (
    (r"\d{4}-\d{2}-\d{2}", ISO_DAY),
    (r"\d{4}/\d{2}/\d{2}", "yyyy/MM/dd"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}-[A-Za-z]{3}-\d{4}", "d-MMM-yyyy"),
    (r"[A-Za-z]{3} \d{1,2}, \d{4}", "MMM d, yyyy"),
)
TIME_OF_DAY = (
    r"([T ]([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?( ?[AaPp][Mm])?"
    r"( ?(Z|[+-]\d{2}:?\d{2}))?)?"
)

# Text read as a number.
NUMBER_FORM = (
    r"^[+-]?(?:(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)?|(?i:inf|infinity|nan))$"
)

# Two numbers closer than this are the same value.
TOLERANCE = 1e-5

NUMBER, DAY, TEXT, OPAQUE = "number", "day", "text", "opaque"

NO_NUMBER = "cast(NULL AS double)"
NO_DAY = "cast(NULL AS date)"
NO_TEXT = "cast(NULL AS string)"


def path(*names: str) -> str:
    """A column, or a field of a struct column, quoted."""
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_of(dtype: T.DataType) -> str:
    """The reading a column of this type gets."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return NUMBER
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DAY
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    return OPAQUE


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort and group by the type."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def raw_text(col: str, dtype: T.DataType) -> str:
    """The value as text, unnormalised; nested values as JSON, bytes as hex."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return f"to_json({col}, map('ignoreNullFields', 'false'))"
    if isinstance(dtype, T.BinaryType):
        return f"hex({col})"
    return f"cast({col} AS string)"


def apart(expression: str, col: str) -> str:
    """The same value, evaluated by a projection outside whole-stage code.

    Reading and comparing many cells makes one generated method too long for
    the JVM to compile, which runs several times slower. A lambda in a
    projection keeps it out of the whole stage, and its code is then split
    into short methods. ``col`` is any column at hand.
    """
    return f"CASE WHEN size(transform(array({col}), x -> x)) = 1 THEN {expression} END"


def trimmed(col: str) -> str:
    return f"btrim({col}, r'{WHITE_SPACE}')"


def _spells_number(text: str) -> str:
    return f"{text} RLIKE r'{NUMBER_FORM}'"


def _number_spelt(text: str) -> str:
    """The number of a text that spells one; never NULL."""
    # A signed "nan" is the only such text that Spark's cast does not read.
    return f"coalesce(try_cast({text} AS double), double('NaN'))"


def _text_number(text: str) -> str:
    return f"CASE WHEN {_spells_number(text)} THEN {_number_spelt(text)} END"


def _text_day(text: str, forms: Sequence[tuple[str, str]]) -> str:
    """The day a text spells; where forms overlap the first that fits counts."""
    if not forms:
        return NO_DAY
    any_form = "|".join(day for day, _ in forms)
    part = f"regexp_extract({text}, r'^({any_form})', 1)"
    tries = ", ".join(
        # The cast itself passes over a time of day.
        f"try_cast({text} AS date)" if fmt == ISO_DAY else f"try_to_date({part}, {literal(fmt)})"
        for _, fmt in forms
    )
    return f"CASE WHEN {text} RLIKE r'^({any_form}){TIME_OF_DAY}$' THEN coalesce({tries}) END"


def as_number(col: str, dtype: T.DataType) -> str:
    """DOUBLE value of a number cell, NULL for any other cell."""
    kind = kind_of(dtype)
    if kind == NUMBER:
        return f"cast({col} AS double)"
    return _text_number(trimmed(col)) if kind == TEXT else NO_NUMBER


def as_day(col: str, dtype: T.DataType, forms: Sequence[tuple[str, str]] = DATE_FORMS) -> str:
    """DATE value of a day cell, NULL for any other cell."""
    kind = kind_of(dtype)
    if kind == DAY:
        return f"to_date({col})"
    if kind == TEXT:
        text = trimmed(col)
        return f"CASE WHEN ({_text_number(text)}) IS NULL THEN {_text_day(text, forms)} END"
    return NO_DAY


def sanitize(col: str, dtype: T.DataType, forms: Sequence[tuple[str, str]] = DATE_FORMS) -> str:
    """STRUCT<number, day, text> with exactly one field set; NULL for NULL."""
    number, day, kind = as_number(col, dtype), as_day(col, dtype, forms), kind_of(dtype)
    if kind in (NUMBER, DAY):
        text = NO_TEXT
    elif kind == TEXT:
        text = f"CASE WHEN ({number}) IS NULL AND ({day}) IS NULL THEN {trimmed(col)} END"
    else:
        text = raw_text(col, dtype)
    fields = f"'number', {number}, 'day', {day}, 'text', {text}"
    return f"CASE WHEN {col} IS NOT NULL THEN named_struct({fields}) END"


def number_text(number: str) -> str:
    # NaN, infinities and magnitudes beyond DECIMAL(38, 5) keep their own text.
    return (
        f"coalesce(cast(try_cast({number} AS decimal(38,5)) AS string), cast({number} AS string))"
    )


def exact(dtype: T.DataType) -> bool:
    """Whether the type holds numbers that a double may round."""
    return isinstance(dtype, (T.IntegralType, T.DecimalType))


def exact_text(raw: str) -> str:
    """``number_text`` of an exact number, without a detour over a double."""
    return f"coalesce(cast(try_cast({raw} AS decimal(38,5)) AS string), cast({raw} AS string))"


@dataclass(frozen=True)
class Cell:
    """One value, read: ``number`` is set, or ``text`` for anything else.

    ``parsed``, of a text column read where it stands, are the test for a number, that
    number and the text otherwise, so that both together cost one test.
    """

    raw: str
    dtype: T.DataType
    kind: str
    number: str
    text: str
    parsed: tuple[str, str, str] | None = None

    def canonical(self) -> str:
        """One text per value: five decimals, an ISO day, or trimmed text.

        The three forms never collide (a text that looks like a number or a
        day is one), so equal canonical text means equal cells.
        """
        if self.kind == NUMBER:
            return exact_text(self.raw) if exact(self.dtype) else number_text(self.number)
        if self.parsed:
            spells, number, text = self.parsed
            return f"CASE WHEN {spells} THEN {number_text(number)} ELSE {text} END"
        if self.kind == TEXT:
            return f"coalesce({number_text(self.number)}, {self.text})"
        return self.text


def read_cell(
    col: str, dtype: T.DataType, forms: Sequence[tuple[str, str]] = DATE_FORMS
) -> Cell:
    """Read a column where it stands."""
    kind = kind_of(dtype)
    if kind == NUMBER:
        return Cell(col, dtype, kind, f"cast({col} AS double)", NO_TEXT)
    if kind == DAY:
        return Cell(col, dtype, kind, NO_NUMBER, f"cast(to_date({col}) AS string)")
    if kind == OPAQUE:
        return Cell(col, dtype, kind, NO_NUMBER, raw_text(col, dtype))
    text = trimmed(col)
    number = _text_number(text)
    plain = f"coalesce(cast({_text_day(text, forms)} AS string), {text})"
    parsed = (_spells_number(text), _number_spelt(text), plain)
    return Cell(col, dtype, kind, number, f"CASE WHEN ({number}) IS NULL THEN {plain} END", parsed)


def reading(cell: Cell) -> str:
    """STRUCT<number, text>: a cell read once, to be carried along."""
    if cell.parsed:
        spells, number, text = cell.parsed
        return (
            f"CASE WHEN {spells} THEN named_struct('number', {number}, 'text', {NO_TEXT})"
            f" ELSE named_struct('number', {NO_NUMBER}, 'text', {text}) END"
        )
    return f"named_struct('number', {cell.number}, 'text', {cell.text})"


def carried(col: str, dtype: T.DataType, found: str) -> Cell:
    """The cell whose ``reading`` was carried in the column ``found``."""
    return Cell(col, dtype, TEXT, f"{found}.number", f"{found}.text")


def canonical(col: str, dtype: T.DataType, forms: Sequence[tuple[str, str]] = DATE_FORMS) -> str:
    """Canonical text of a column, see ``Cell.canonical``."""
    return read_cell(col, dtype, forms).canonical()


def _close(a: str, b: str, tolerance: float) -> str:
    near = f" OR abs({a} - {b}) < double('{float(tolerance)!r}')" if tolerance > 0 else ""
    return f"{a} = {b}{near}"


# Digits of a decimal whose differences fit Spark's widest decimal without rounding.
DIGITS = 37


def _close_exactly(a: Cell, b: Cell, tolerance: float) -> str:
    """Two integers or decimals; NULL where one is.

    Numbers with too many digits for a common decimal are compared as they are
    if their types agree, else as doubles.
    """
    if isinstance(a.dtype, T.IntegralType) and isinstance(b.dtype, T.IntegralType) and tolerance <= 1:
        return f"{a.raw} = {b.raw}"
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a.dtype, b.dtype))
    wide = f"{a.raw} = {b.raw}" if a.dtype == b.dtype else _close(a.number, b.number, tolerance)
    if scale > DIGITS:
        return wide
    x, y = (f"try_cast({c.raw} AS decimal({DIGITS},{scale}))" for c in (a, b))
    return f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {_close(x, y, tolerance)} ELSE {wide} END"


def cells_equal(a: Cell, b: Cell, tolerance: float = TOLERANCE) -> str:
    """Tolerant, type-blind equality; never NULL, and NULL equals only NULL.

    Numbers are settled by the tolerance alone: strictly less than it, or
    identical, which covers infinities and NaN. A tolerance of zero asks for
    identical numbers. Integers and decimals are compared as such, not as
    doubles. Cells of different kinds differ.
    """
    kinds = {a.kind, b.kind}
    if kinds == {DAY}:
        return f"(to_date({a.raw}) <=> to_date({b.raw}))"
    close = _close(a.number, b.number, tolerance)
    if kinds == {NUMBER} and exact(a.dtype) and exact(b.dtype):
        close = _close_exactly(a, b, tolerance)
    both_null = f"({a.raw} IS NULL AND {b.raw} IS NULL)"
    if kinds == {NUMBER}:
        return f"coalesce({close}, {both_null})"
    return f"(coalesce({close}, false) OR coalesce({a.text} = {b.text}, {both_null}))"


def cell_equal(
    a: str,
    a_type: T.DataType,
    b: str,
    b_type: T.DataType,
    tolerance: float = TOLERANCE,
    forms: Sequence[tuple[str, str]] = DATE_FORMS,
) -> str:
    """``cells_equal`` of two plain columns."""
    return cells_equal(read_cell(a, a_type, forms), read_cell(b, b_type, forms), tolerance)
