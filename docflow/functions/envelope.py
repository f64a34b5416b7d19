"""Notification JSON: building, decoding and naming what is wrong with a body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def notification_json(uid: Column | str, bucket: Column | str, key: Column | str) -> Column:
    """Compact JSON of one notification, fields in the order uid, Bucket, Key."""
    fields = [("uid", uid), ("Bucket", bucket), ("Key", key)]
    return F.to_json(
        F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields])
    )


def envelope_json(
    message: Column, attempt: Column | None = None, topic: Column | None = None
) -> Column:
    """Body as the queue delivers it: the message is nested as a JSON string.

    A redelivery also carries the number of the attempt that failed, and a message may
    carry the topic it was sent to.
    """
    fields = [message.alias("Message")]
    if topic is not None:
        fields.append(topic.alias("Topic"))
    if attempt is not None:
        fields.append(attempt.alias("Attempt"))
    return F.to_json(F.struct(*fields))


def attempt_of(body: Column | str) -> Column:
    return F.get_json_object(body, "$.Attempt")


def topic_of(body: Column | str) -> Column:
    return F.get_json_object(body, "$.Topic")


def json_property(document: Column | str, name: str, sql_type: str) -> Column:
    """One typed property of a single-level JSON object."""
    return F.from_json(document, f"`{name}` {sql_type}")[name]


def is_json(text: Column, bad: Column) -> Column:
    """Whether ``text`` is one JSON value and nothing more; ``bad`` is what
    ``fields_of`` could not read of it.

    Parsers stop behind the first value, so what may follow it is found by reading
    the text as the only element of an array. Repeated properties are fine. Only what
    is no object, or broken, is parsed once more to tell the two apart.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(alone, F.lit(False)) & ~(bad.isNotNull() & F.try_parse_json(text).isNull())


def fields_of(document: Column | str, *names: str) -> Column:
    """Some properties of a JSON object in one parse, as variants that know their types.

    Of a repeated property the last one counts. ``_bad`` holds a text that is no object.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_bad",
        "allowSingleQuotes": "false",
    }
    fields = [*(f"`{name}` variant" for name in names), "`_bad` string"]
    return F.from_json(document, ", ".join(fields), options)


def text_of(value: Column | str) -> Column:
    """A property as text: strings as they are, other values as JSON."""
    return F.try_variant_get(value, "$", "string")


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def leaves_store(bucket: Column, key: Column) -> Column:
    """Whether ``bucket/key`` as a path would point outside its bucket."""
    return key.rlike(r"(^|/)\.\.(/|$)") | bucket.rlike(r"^\.{0,2}$|/") | key.startswith("/")


def failure_reason(
    body: Column, bad_body: Column, message: Column, bad_message: Column, bucket: Column, key: Column
) -> Column:
    """Why a body gives no usable notification, null where it does.

    ``message``, ``bucket`` and ``key`` are variants. A body that parses to something
    without a Message (``null``, ``0``, an array) is told apart from one that does
    not parse at all.
    """
    sent = text_of(message)

    def missing(value: Column) -> Column:
        return value.isNull() | F.is_variant_null(value)

    return (
        F.when(~is_json(body, bad_body), "body is not JSON")
        .when(missing(message), "body has no Message")
        .when(~is_string(message), "Message is not a string")
        .when(~is_json(sent, bad_message), "message is not JSON")
        .when(missing(key), "message has no Key")
        .when(missing(bucket), "message has no Bucket")
        .when(~is_string(key) | (text_of(key) == ""), "Key is no text or empty")
        .when(~is_string(bucket) | (text_of(bucket) == ""), "Bucket is no text or empty")
        .when(leaves_store(text_of(bucket), text_of(key)), "Key leaves the store")
    )
