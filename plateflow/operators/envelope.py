"""Unwrapping of payload envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.json_text import is_object, is_type, variant_text, with_parsed_json
from plateflow.functions.once import with_columns_once

# Messages for payloads that never become an event.
NOT_JSON = "Request body is not valid JSON"
NOT_AN_OBJECT = "Request body must be a JSON object"


def unwrap_envelope(df: DataFrame, text: str = "value") -> DataFrame:
    """Add ``payload`` (VARIANT object or NULL) and ``parse_error`` (message or NULL).

    Three envelopes are understood: the event itself, an object under ``body``, and JSON text under
    ``body``.  A missing or null ``body`` means the event itself.
    """
    record, body, content = F.col("_record"), F.col("_body"), F.col("_content")
    inner = F.col("_inner")
    no_body = body.isNull() | F.is_variant_null(body)
    body_text = F.when(~no_body & is_type(body, "STRING"), variant_text(body))
    parsed = with_parsed_json(df, "_record", F.col(text))
    parsed = parsed.withColumn("_body", F.try_variant_get(record, "$.body", "variant"))
    parsed = parsed.withColumn("_body_text", body_text)
    parsed = with_parsed_json(parsed, "_inner", F.col("_body_text"))
    parsed = parsed.withColumn(
        "_content",
        F.when(no_body, record)
        .when(F.col("_body_text").isNotNull(), inner)
        .when(is_object(body), body),
    )
    parsed = parsed.withColumn("payload", F.when(is_object(content), content))
    unreadable = F.when(content.isNull(), NOT_JSON).when(F.col("payload").isNull(), NOT_AN_OBJECT)
    results = {"payload": F.col("payload"), "parse_error": unreadable}
    return with_columns_once(parsed, results).drop(
        "_record", "_body", "_body_text", "_inner", "_content"
    )
