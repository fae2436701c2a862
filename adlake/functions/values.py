"""Null-safe conversions of raw text to typed values.

Every function returns NULL for NULL and for text it cannot read; the checks tell the
two apart by looking at the raw value. ``try_cast`` keeps this independent of ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The years 1 to 9999, as Unix seconds.
MIN_UNIX, MAX_UNIX = -62135596800, 253402300799


def to_long(text: Column) -> Column:
    """Whole number, truncated toward zero: ``12.7`` gives 12 and ``-12.7`` gives -12.

    Plain digits are exact at any size; anything else is a JSON real and is read as one.
    Reals are told apart by their point, as a cast that fails is slow.
    """
    digits = F.when(~text.contains("."), text.try_cast("bigint"))
    return F.coalesce(digits, text.try_cast("double").try_cast("bigint"))


def to_double(text: Column) -> Column:
    """A finite number; NaN and the infinities cannot be read."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def to_bool(text: Column) -> Column:
    """Only the JSON literals; ``yes`` or ``1`` are not flags."""
    return F.when(text == "true", True).when(text == "false", False)


def to_date(text: Column) -> Column:
    return text.try_cast("date")


def unix_time(text: Column) -> Column:
    """Unix seconds, whole or fractional, to a timestamp; 0 is 1970-01-01 UTC."""
    seconds = text.try_cast("decimal(20,6)")
    return F.when(seconds.between(MIN_UNIX, MAX_UNIX), F.timestamp_seconds(seconds))


def json_text(text: Column, item: Column, key: str) -> Column:
    """JSON text of a nested value, without loss.

    ``text`` is the value as the JSON reader delivers it: objects and arrays as JSON, but
    bare strings without quotes. ``item`` is the whole object as a variant, which knows
    the type, so that a string is quoted again.
    """
    value = F.variant_get(item, f"$.{key}", "variant")
    is_string = F.schema_of_variant(value) == "STRING"
    return F.when(text.isNotNull() & is_string, F.to_json(value)).otherwise(text)


def json_field(column: Column, path: str) -> Column:
    """Text of one value inside a JSON column."""
    return F.get_json_object(column, path)


def json_typed(column: Column, path: str, data_type: str) -> Column:
    """Typed value inside a JSON column; NULL when absent, unreadable or of another type."""
    return F.try_variant_get(F.try_parse_json(column), path, data_type)


def json_struct(column: Column, schema: str) -> Column:
    """A JSON column read with a schema of the caller's choice."""
    return F.from_json(column, schema)
