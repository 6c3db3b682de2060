"""Raw text to typed values.  Nothing here raises on a bad value: it becomes NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv

# A plain decimal number; used only by the strict form of the numeric parsers,
# because a lenient cast also reads '1d', 'NaN' and 'Infinity'.
PLAIN_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


_NO_VALUE = ", ".join(f"'{word}'" for word in fv.NULL_WORDS)


def text_or_null(column: str) -> Column:
    """Trim spaces; the words that stand for "no value" become NULL."""
    return F.expr(f"CASE WHEN trim(`{column}`) NOT IN ({_NO_VALUE}) THEN trim(`{column}`) END")


def clean_text_columns(df: DataFrame) -> DataFrame:
    """``text_or_null`` on every string column except the ``_audit`` ones."""
    return df.withColumns({
        f.name: text_or_null(f.name)
        for f in df.schema.fields
        if f.dataType.simpleString() == "string" and not f.name.startswith("_")
    })


def to_double(text: Column, strict: bool = False) -> Column:
    """Number with optional thousands commas."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    number = plain.try_cast("double")
    return F.when(plain.rlike(PLAIN_NUMBER), number) if strict else number


def to_int(text: Column, strict: bool = False) -> Column:
    """Whole number, truncated toward zero; out of range is NULL."""
    return to_double(text, strict).try_cast("int")


def to_day(text: Column, pattern: str = fv.DATE_PATTERN) -> Column:
    """Date in exactly the given pattern (two-digit month and day)."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def to_flag(text: Column) -> Column:
    """Yes/no words to a three-valued boolean."""
    word = F.upper(text)
    return F.when(word.isin(fv.YES_WORDS), F.lit(True)).when(word.isin(fv.NO_WORDS), F.lit(False))


def to_flag_or_false(text: Column) -> Column:
    return F.coalesce(to_flag(text), F.lit(False))


def title_case(text: Column) -> Column:
    """First letter after each space in capitals, the rest lower."""
    return F.initcap(text)


def to_zip5(text: Column) -> Column:
    """First run of digits, padded or cut to five."""
    return F.lpad(F.regexp_extract(text, r"\d+", 0), 5, "0")


def add_missing_text(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add absent columns as NULL strings."""
    absent = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in absent}) if absent else df
