"""Column expressions used across the operators. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.schema import CANCEL_PREFIX

MICROS_PER_DAY = 86_400_000_000

# Text layouts accepted for timestamps besides the ISO forms (month before day).
TIMESTAMP_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy"]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column, kind: str = "double") -> Column:
    """Number or null; NaN counts as missing."""
    number = col(c).try_cast(kind)
    return F.nanvl(number, F.lit(None).cast(kind)) if kind in ("double", "float") else number


def number(df: DataFrame, name: str) -> Column:
    """A numeric column as it is, so that filters on it still reach the scan; text is converted."""
    kind = dict(df.dtypes)[name]
    plain = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    return F.col(name) if plain else to_number(name)


def to_time(c: str | Column) -> Column:
    """Timestamp or null, from text in an ISO form or one of the known layouts."""
    text = col(c).cast("string")
    return F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS])


def stripped(c: str | Column) -> Column:
    """Text without white space (of any kind) at both ends; null stays null."""
    return F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")


def is_cancelled(invoice: str | Column = "InvoiceNo") -> Column:
    return F.coalesce(F.startswith(col(invoice).cast("string"), F.lit(CANCEL_PREFIX)), F.lit(False))


def holds(condition: Column) -> Column:
    """A condition as a two-valued flag: unknown is false."""
    return F.coalesce(condition, F.lit(False))


def line_amount(df: DataFrame) -> Column:
    return number(df, "Quantity") * number(df, "UnitPrice")


def amount_of(df: DataFrame) -> Column:
    return number(df, "TotalAmount") if "TotalAmount" in df.columns else line_amount(df)


def year_month(c: str | Column = "InvoiceDate") -> Column:
    return F.date_format(col(c), "yyyy-MM")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed time in complete 24-hour days, which is not the difference of calendar dates."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(MICROS_PER_DAY)).cast("long")


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return safe_divide(part, whole) * 100


def hash_key(seed: int, *parts: str | Column) -> Column:
    """Repeatable pseudo-random order: 32 hex digits of the row's key and a seed."""
    texts = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("-", *texts, F.lit(str(seed))))


def records(one_row: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn the columns of a one-row table into several rows of one layout."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def row_count() -> Column:
    return F.count(F.lit(1))
