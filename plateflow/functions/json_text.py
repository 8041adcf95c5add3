"""Expressions over JSON text and VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blank text and plain number syntax.
BLANK = r"(?U)^[\s\x1c-\x1f]*$"
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def with_parsed_json(df: DataFrame, name: str, text: Column) -> DataFrame:
    """Add the VARIANT of a text that is exactly one JSON document, else NULL.

    ``try_parse_json`` stops after the first document and accepts trailing text.  Inside an array,
    followed by a hash of the text, anything left over either breaks the array or changes its length.
    The parse has a projection of its own, so it runs once.
    """
    items, mark = F.col(f"_{name}_items"), F.xxhash64(text)
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))
    whole = F.try_variant_get(items, "$[1]", "bigint").eqNullSafe(mark) & F.try_variant_get(
        items, "$[2]", "variant"
    ).isNull()
    return (
        df.withColumn(f"_{name}_items", wrapped)
        .withColumn(name, F.when(whole, F.try_variant_get(items, "$[0]", "variant")))
        .drop(f"_{name}_items")
    )


def object_fields(value: Column, names: tuple[str, ...]) -> Column:
    """Struct of the named members as VARIANTs, in one pass; NULL when ``value`` is no object.

    An absent member is SQL NULL; a JSON null is a VARIANT null.
    """
    members = ",".join(f"`{name}`:variant" for name in names)
    return F.try_variant_get(value, "$", f"struct<{members}>")


def object_texts(value: Column, names: tuple[str, ...]) -> Column:
    """Struct of the named members' texts, as of :func:`variant_text`, in one pass; NULL when ``value``
    is no object.  Neither an absent member nor a JSON null has a text."""
    members = ",".join(f"`{name}`:string" for name in names)
    return F.try_variant_get(value, "$", f"struct<{members}>")


def is_object(value: Column) -> Column:
    return object_fields(value, ("event_id",)).isNotNull()


def variant_text(value: Column) -> Column:
    """Text of any VARIANT: strings as they are, the rest as JSON."""
    return F.try_variant_get(value, "$", "string")


def is_blank(text: Column) -> Column:
    """Only white space.  A text whose first byte is a printable ASCII character needs no pattern."""
    printable_start = (text >= "!") & (text < "\x7f")
    return ~printable_start & text.rlike(BLANK)


def is_type(value: Column, name: str) -> Column:
    return F.schema_of_variant(value) == name


def number_of(value: Column, text: Column) -> Column:
    """Double of a VARIANT number, boolean or plain numeric string; NULL for the rest.

    ``text`` is the value's text.  Digits beyond the range of a double give an infinity.
    """
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).when(
        text.isin("true", "false") & is_type(value, "BOOLEAN"),
        F.try_variant_get(value, "$", "double"),
    )


def is_infinite(number: Column) -> Column:
    return F.abs(number) == F.lit(float("inf"))


def json_type_name(value: Column) -> Column:
    """Client-facing name of a JSON value's type."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "str")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "dict")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .otherwise("float")
    )


def scalar_label(value: Column) -> Column:
    """Text of a value as shown in a message; booleans are capitalised."""
    text = variant_text(value)
    return F.when(is_type(value, "BOOLEAN"), F.initcap(text)).otherwise(text)


def float_label(number: Column) -> Column:
    """Shortest text of a double: plain between 1e-4 and 1e16, else with a two-digit exponent."""
    text = number.cast("string")
    size = F.abs(number)
    plain = F.regexp_replace(text.cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    exponent = F.regexp_replace(text, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E([0-9])", "E+$1")
    exponent = F.lower(F.regexp_replace(exponent, r"E([+-])([0-9])$", "E$10$2"))
    small_or_large = (size >= 1e16) | ((size < 1e-4) & (size > 0))
    return F.when(small_or_large, exponent).when(size == 0, text).otherwise(plain)


def members_except(value: Column, names: tuple[str, ...]) -> Column:
    """VARIANT object without the named members."""
    members = value.cast("map<string,variant>")
    return F.to_variant_object(F.map_filter(members, lambda key, _: ~key.isin(*names)))
