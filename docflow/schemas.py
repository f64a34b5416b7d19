"""Record layouts and the fixed names of queues, topics and output prefixes."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic, bucket and queue names, output prefixes and limits that
# results have to agree with.
TOPIC = "file-stream"
BUCKET = "file-stream"
TEXT_QUEUE = "file-stream-text"
PREVIEW_QUEUE = "file-stream-images"
TEXT_PREFIX = "text-parsed/"
PREVIEW_PREFIX = "image-parsed/"
FLAT_PREFIX = "extracted-text/"
PDF_SUBTYPE = "application/pdf"
DEFAULT_PAGE_CAP = 10
DEFAULT_VISIBILITY_SECONDS = 600
DEFAULT_DELAY_SECONDS = 30

BODY = T.StructType([T.StructField("Body", T.StringType())])

PAGES = T.ArrayType(T.ArrayType(T.StringType()))

ATTACHMENTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("subtype", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("pages", PAGES),
        ]
    )
)

DEFAULT_SUBSCRIPTIONS = [(TOPIC, TEXT_QUEUE), (TOPIC, PREVIEW_QUEUE)]

DOCUMENT_TEXT = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("Bucket", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("output_key", T.StringType()),
        T.StructField("n_pages", T.LongType()),
        T.StructField("pages_processed", T.LongType()),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("text", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

PREVIEW_PAGES = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("Bucket", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("output_key", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("Body", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

RETRY_LEDGER = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("Bucket", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("last_attempt_at", T.TimestampType()),
        T.StructField("next_attempt_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

STAGE_SUMMARY = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("outputs", T.LongType()),
        T.StructField("bytes_written", T.LongType()),
        T.StructField("objects_stored", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

REDELIVERED = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("Bucket", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)
