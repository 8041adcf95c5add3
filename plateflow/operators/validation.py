"""The event validator: checks in a fixed order, the first failure wins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.functions.json_text import (
    float_label,
    is_blank,
    is_infinite,
    json_type_name,
    number_of,
    object_texts,
    scalar_label,
)
from plateflow.functions.once import with_columns_once
from plateflow.operators.envelope import NOT_AN_OBJECT, NOT_JSON, unwrap_envelope
from plateflow.schema import CATEGORIES, DEVICE_TYPES, EVENT_TYPES, REQUIRED_FIELDS

ACCEPTED, REJECTED = 200, 400

DOMAINS = {"event_type": EVENT_TYPES, "category": CATEGORIES, "device_type": DEVICE_TYPES}


class Check(NamedTuple):
    """One check: when it fails, and what is reported then.

    The message is a text, or an expression where it shows the value.
    """

    failed: Column
    error_type: str
    field: str
    message: str | Column


def _member(field: str) -> Column:
    """The VARIANT of a field.  Looked up in the payload, so only the rows that need it pay for it."""
    return F.try_variant_get(F.col("payload"), f"$.{field}", "variant")


def _text(field: str) -> Column:
    return F.col("_price_text" if field == "price" else field)


def _first(choices: list[tuple[Column, Column]]) -> Column:
    """Value of the first true condition."""
    chosen = F.when(*choices[0])
    for condition, value in choices[1:]:
        chosen = chosen.when(condition, value)
    return chosen


def payload_checks() -> list[Check]:
    """The text is JSON and its content an object."""
    problem = F.col("parse_error")
    return [
        Check(problem == NOT_JSON, "not_json", "body", NOT_JSON),
        Check(problem == NOT_AN_OBJECT, "not_object", "body", NOT_AN_OBJECT),
    ]


def presence_checks() -> list[Check]:
    """Each required field in order: absent, then null or blank.

    A JSON null has no text; an absent field has neither text nor member.
    """
    checks = []
    for name in REQUIRED_FIELDS:
        missing = f"Missing required field: '{name}'"
        empty = f"Required field '{name}' must not be null or empty"
        text = _text(name)
        checks.append(Check(text.isNull() & _member(name).isNull(), "missing", name, missing))
        checks.append(Check(text.isNull() | is_blank(text), "empty", name, empty))
    return checks


def domain_checks() -> list[Check]:
    """Membership of each enumerated field.  The JSON text of a list or object is no member."""
    checks = []
    for name, allowed in DOMAINS.items():
        message = F.concat(
            F.lit(f"Invalid {name} '"),
            scalar_label(_member(name)),
            F.lit(f"'. Must be one of: {sorted(allowed)}"),
        )
        checks.append(Check(~_text(name).isin(*allowed), "domain", name, message))
    return checks


def price_checks() -> list[Check]:
    """A finite number in plain syntax (numeric strings and booleans count), then above zero."""
    price = F.col("price")
    not_numeric = F.concat(
        F.lit("Field 'price' must be a numeric value, got: "), json_type_name(_member("price"))
    )
    not_positive = F.concat(
        F.lit("Field 'price' must be a positive number, got: "), float_label(price)
    )
    return [
        Check(price.isNull() | is_infinite(price), "price", "price", not_numeric),
        Check(price <= 0, "price", "price", not_positive),
    ]


def validate_events(df: DataFrame, text: str = "value") -> DataFrame:
    """Check raw payloads.

    Keeps the input columns and adds ``payload``, the required fields as typed columns (NULL where
    absent), ``status`` (200 or 400), ``error_type``, ``field`` and ``error``.

    The checks yield the number of the first failure.  Everything reported about it is looked up
    from that number, so valid rows pay for the tests alone.  Each step is a stage of its own, which
    keeps its generated code small enough to be compiled to machine code.
    """
    rows = unwrap_envelope(df, text)
    rows = rows.withColumn("_texts", object_texts(F.col("payload"), REQUIRED_FIELDS))
    texts = {
        "_price_text" if name == "price" else name: F.col("_texts")[name] for name in REQUIRED_FIELDS
    }
    rows = with_columns_once(rows, texts).drop("_texts")
    rows = rows.withColumn("price", number_of(_member("price"), F.col("_price_text")))

    checks = payload_checks() + presence_checks() + domain_checks() + price_checks()
    failure = _first([(check.failed, F.lit(n)) for n, check in enumerate(checks, 1)])
    rows = with_columns_once(rows, {"_failure": failure})

    def looked_up(values: list[str | None]) -> Column:
        return F.get(F.array(*[F.lit(value) for value in values]), F.col("_failure") - 1)

    fixed = looked_up([None if isinstance(c.message, Column) else c.message for c in checks])
    shown = {n: check.message for n, check in enumerate(checks, 1) if isinstance(check.message, Column)}
    # In a lambda, which is evaluated outside of the generated code and for these failures only; with the
    # messages in it that code would be too large to be compiled to machine code.
    each = F.when(F.col("_failure").isin(*shown), F.array(F.col("_failure")))
    messages = F.transform(each, lambda number: _first([(number == n, text) for n, text in shown.items()]))
    composed = F.get(messages, F.lit(0))
    # Plain columns over the failure number: a reader of the status alone drops the look-ups and
    # messages, and a filter on it moves no further down than the number.
    judged = rows.withColumns(
        {
            "status": F.when(F.col("_failure").isNull(), ACCEPTED).otherwise(REJECTED),
            "error_type": looked_up([check.error_type for check in checks]),
            "field": looked_up([check.field for check in checks]),
            "error": F.coalesce(fixed, composed),
        }
    )
    return judged.drop("_price_text", "_failure", "parse_error")


def accepted_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("status") == ACCEPTED)


def rejected_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("status") == REJECTED)


def acknowledge(validated: DataFrame) -> DataFrame:
    """Reply per payload: ``status`` and a JSON ``body``, next to the other input columns."""
    success = F.to_json(F.struct(F.lit("ok").alias("status"), F.col("event_id")))
    failure = F.to_json(F.struct(F.col("error"), F.col("field")))
    return validated.withColumn(
        "body", F.when(F.col("status") == ACCEPTED, success).otherwise(failure)
    )
