"""Missing values.  Everything inside the engine uses null; NaN is turned into null where data come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` with null for NaN in every floating column, in one projection."""
    return df.select(*(F.nullif(F.col(f"`{f.name}`"), F.lit(float("nan")).cast(f.dataType)).alias(f.name) if isinstance(f.dataType, FLOATS) else F.col(f"`{f.name}`") for f in df.schema.fields))


def differs(a: Column, b: Column) -> Column:
    """Unequal, and true if either side is missing (two missing values aren't equal either)."""
    return F.coalesce(a != b, F.lit(True))


def lookup(column: Column, table: dict, default: Column | None = None) -> Column:
    """``table[column]``; a key that isn't there gives ``default``, or null."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), column) if pairs else F.lit(None).cast("string")
    return found if default is None else F.coalesce(found, default)


def text_or(column: Column, missing: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit(missing))


def round_floats(df: DataFrame, places: int, only: list[str] | None = None) -> DataFrame:
    """Half-even rounding of the floating columns (or of ``only``), in one projection."""
    some = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)} & set(df.columns if only is None else only)
    return df.select(*(F.bround(F.col(f"`{c}`"), places).alias(c) if c in some else F.col(f"`{c}`") for c in df.columns))


def significant(x: Column, digits: int = 3) -> Column:
    """``x`` as text with so many significant digits, as C's %g writes it: no trailing zeros, and exponents under 1e-4 and from 10**digits.

    Subnormal numbers with fewer digits of their own than asked for are written with those."""
    # The exponent of the rounded number tells which form is shorter; the plain form is the rounded number itself, as a decimal.
    # DecimalFormat rounds the double's exact value, ties to even, as C does; %e in Java rounds its shortest decimal form, ties up.
    scientific = F.call_function("format_number", x, F.lit("0." + "0" * (digits - 1) + "E0" if digits > 1 else "0E0"))
    exponent = F.regexp_extract(scientific, "E(-?[0-9]+)$", 1).cast("int")
    plain = scientific.cast("decimal(38, 12)").cast("string")
    strip = lambda s: F.regexp_replace(s, "[.]0+$|(?<=[.][0-9]{0,12}[1-9])0+$", "")
    mantissa = strip(F.regexp_extract(scientific, "^(.*)E", 1))
    power = F.format_string("e%+03d", exponent)
    infinite = F.abs(x) == F.lit(float("inf"))
    return (
        F.when(x.isNull() | F.isnan(x), F.lit("nan")).when(infinite, F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(x == 0, F.lit("0")).when(exponent.between(-4, digits - 1), strip(plain)).otherwise(F.concat(mantissa, power))
    )
