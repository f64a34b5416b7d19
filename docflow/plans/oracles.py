"""The registered queries as SQL for DuckDB, written without the engine's help."""

from __future__ import annotations

_NOTES = """
notes AS (
  SELECT doc_id, lang, text, md5(CAST(doc_id AS VARCHAR)) AS uid, 'file-stream' AS "Bucket",
         md5(CAST(doc_id AS VARCHAR)) || '-' || source || '.pdf' AS "Key"
  FROM documents
)"""

_BODIES = (
    _NOTES
    + """,
bodies AS (
  SELECT *, CAST(json_object('Message', CAST(
           json_object('uid', uid, 'Bucket', "Bucket", 'Key', "Key") AS VARCHAR)) AS VARCHAR)
         AS "Body"
  FROM notes
)"""
)

_PAGED = (
    _NOTES
    + """,
lines AS (SELECT *, string_split(text, chr(10)) AS l FROM notes),
paged AS (SELECT *, CAST((len(l) + 4) // 5 AS BIGINT) AS n_pages FROM lines),
texts AS (
  SELECT doc_id, uid, "Bucket", "Key", n_pages, least(n_pages, 10) AS pages_processed,
         n_pages > 10 AS truncated,
         array_to_string(list_transform(range(0, least(n_pages, 10)),
           lambda i: array_to_string(l[i * 5 + 1 : i * 5 + 5], ' ')), '') AS text
  FROM paged
),
measured AS (SELECT *, CAST(strlen(text) AS BIGINT) AS content_length FROM texts),
page_rows AS (
  SELECT doc_id, "Bucket", "Key", page_no,
         array_to_string(l[(page_no - 1) * 5 + 1 : page_no * 5], ' ') AS page_text
  FROM (SELECT *, unnest(range(1, n_pages + 1)) AS page_no FROM paged)
),
capped AS (SELECT * FROM page_rows WHERE page_no <= 10)"""
)

_TURNS = """
numbered AS (
  SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page_no
  FROM conversations
),
kept AS (SELECT * FROM numbered WHERE page_no <= 3)"""

_ATTEMPTS = """
attempts AS (
  SELECT event_id, ts,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS attempt
  FROM events
),
wrapped AS (
  SELECT *, CASE WHEN attempt > 10 THEN attempt % 10 ELSE attempt END AS n FROM attempts
)"""

_TEXT = f"""
WITH {_PAGED}
SELECT doc_id, n_pages, pages_processed, truncated, text, content_length FROM measured"""

_RENDERED = f"""
WITH {_PAGED}
SELECT doc_id, page_no, page_text FROM capped WHERE length(page_text) >= 200"""

_STICKY = f"""
WITH {_PAGED},
flags AS (SELECT doc_id, page_no, length(page_text) >= 200 AS ok FROM capped)
SELECT doc_id, page_no, ok,
       bool_and(ok) OVER (PARTITION BY doc_id ORDER BY page_no) AS success
FROM flags"""

_FIBONACCI = """
fib(n, a, b) AS (
  SELECT CAST(0 AS BIGINT), CAST(1 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL SELECT n + 1, b, a + b FROM fib WHERE n < (SELECT max(attempt) FROM attempts)
)"""

# Each (queue, message) as a state machine. A delay keeps a message back only while
# it is still hidden: every link of the chain of delays since its failure has to come
# before the visibility set by the link before.
_VISIBILITY = """
WITH src AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS uid, epoch_us(ts) // 1000 AS at_ms, event_type FROM events
),
outcomes AS (
  SELECT 'file-stream-text' AS queue, uid, at_ms, seq,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS kind, CAST(NULL AS BIGINT) AS seconds
  FROM src
  UNION ALL
  SELECT 'file-stream-images', uid, at_ms, seq,
         CASE WHEN event_type IN ('error', 'view') THEN 'failed' WHEN event_type = 'purchase' THEN 'delay' ELSE 'ok' END,
         CASE WHEN event_type = 'purchase' THEN 3600 END
  FROM src
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY queue, uid
           ORDER BY at_ms, CASE kind WHEN 'failed' THEN 0 WHEN 'delay' THEN 1 ELSE 2 END, seq) AS rn
  FROM outcomes
),
grouped AS (
  SELECT *,
    coalesce(sum(CASE WHEN kind = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY queue, uid ORDER BY rn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok_group,
    sum(CASE WHEN kind <> 'delay' THEN 1 ELSE 0 END) OVER (PARTITION BY queue, uid ORDER BY rn
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM ordered
),
tried AS (
  SELECT *,
    CAST(sum(CASE WHEN kind = 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY queue, uid, ok_group ORDER BY rn
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS attempts,
    first_value(kind) OVER (PARTITION BY queue, uid, seg ORDER BY rn) AS seg_kind
  FROM grouped
),
wanted AS (
  SELECT *,
    CASE kind
      WHEN 'failed' THEN at_ms + (CASE WHEN attempts > 10 THEN attempts % 10 ELSE attempts END)
                               * (CASE WHEN queue = 'file-stream-text' THEN 4000 ELSE 2000 END)
      WHEN 'delay' THEN at_ms + 1000 * seconds
    END AS v_cand
  FROM tried
),
linked AS (
  SELECT *,
    CASE WHEN kind <> 'delay' THEN TRUE
         ELSE coalesce(lag(v_cand) OVER (PARTITION BY queue, uid ORDER BY rn) >= at_ms, FALSE) END AS link
  FROM wanted
),
pending AS (
  SELECT *,
    kind = 'delay' AND seg > 0 AND seg_kind = 'failed'
      AND bool_and(link) OVER (PARTITION BY queue, uid, seg ORDER BY rn
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held
  FROM linked
),
after AS (
  SELECT *,
    CASE WHEN kind = 'failed' OR held THEN v_cand END AS v_after
  FROM pending
),
nexted AS (
  SELECT *, lead(at_ms) OVER (PARTITION BY queue, uid ORDER BY rn) AS next_at,
         max(at_ms) OVER () AS last_at
  FROM after
)
SELECT queue, uid,
       CASE kind WHEN 'failed' THEN 'failed' WHEN 'ok' THEN 'done'
                 ELSE CASE WHEN held THEN 'delayed' ELSE 'ignored' END END AS step,
       attempts AS attempt, at_ms,
       CASE WHEN kind = 'failed' OR held THEN v_cand END AS visible_ms
FROM nexted
UNION ALL
SELECT queue, uid, 'due', attempts + 1, v_after, v_after
FROM nexted
WHERE v_after IS NOT NULL AND v_after < coalesce(next_at, last_at)
"""

ORACLES: dict[str, str] = {
    "extract_text": _TEXT,
    "extract_text_python": _TEXT,
    "page_text": f"""
WITH {_PAGED}
SELECT doc_id, page_no, page_text FROM page_rows""",
    "page_stats": f"""
WITH {_PAGED}
SELECT doc_id, n_pages, pages_processed, truncated FROM texts""",
    "first_n_pages": f"""
WITH {_TURNS}
SELECT conv_id, turn, text, page_no FROM kept""",
    "assemble_pages": f"""
WITH {_TURNS},
joined AS (
  SELECT conv_id, count(*) AS pages_processed, string_agg(text, '' ORDER BY turn) AS text
  FROM kept GROUP BY conv_id
)
SELECT *, CAST(strlen(text) AS BIGINT) AS content_length FROM joined""",
    "attachment_text": f"""
WITH {_PAGED},
appended AS (
  SELECT c.conv_id AS doc_id, count(*) AS n_attachments,
         string_agg(array_to_string(string_split(c.text, chr(10))[1 : t.pages_processed], ''), ''
                    ORDER BY c.turn) AS extra
  FROM conversations c JOIN texts t ON t.doc_id = c.conv_id
  WHERE c.role = 'assistant' GROUP BY c.conv_id
),
merged AS (
  SELECT t.doc_id, t.n_pages, coalesce(a.n_attachments, 0) AS n_attachments,
         t.text || coalesce(a.extra, '') AS text
  FROM texts t LEFT JOIN appended a ON a.doc_id = t.doc_id
)
SELECT *, CAST(strlen(text) AS BIGINT) AS content_length FROM merged""",
    "build_notification": f"""
WITH {_BODIES}
SELECT doc_id, "Key", "Body" FROM bodies""",
    "decode_notification": f"""
WITH {_BODIES},
decoded AS (SELECT doc_id, CAST("Body" AS JSON)->>'$.Message' AS m FROM bodies)
SELECT doc_id, m->>'$.uid' AS uid, m->>'$.Bucket' AS "Bucket", m->>'$.Key' AS "Key" FROM decoded""",
    "output_keys": f"""
WITH {_PAGED}
SELECT doc_id, page_no, 'text-parsed/' || "Key" AS text_key,
       'extracted-text/' || "Key" AS flat_text_key,
       'image-parsed/' || "Key" || '/' || page_no || '.png' AS preview_key,
       'extracted-text/' || "Key" || page_no || '.png' AS flat_preview_key
FROM capped""",
    "json_field": """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events""",
    "quarantine": f"""
WITH {_BODIES}
SELECT doc_id, left("Body", length("Body") - 5) AS "Body", 'body is not JSON' AS reason
FROM bodies WHERE lang = 'fr'""",
    "dedup_notifications": f"""
WITH {_NOTES}
SELECT DISTINCT uid, "Bucket", "Key"
FROM (SELECT * FROM notes UNION ALL SELECT * FROM notes)""",
    "fan_out": f"""
WITH {_NOTES}
SELECT uid, "Bucket", "Key", queue
FROM notes, (VALUES ('file-stream-text'), ('file-stream-images')) AS s(queue)""",
    "fan_out_joined": f"""
WITH {_NOTES},
sent AS (SELECT *, CASE lang WHEN 'de' THEN 'archive' WHEN 'fr' THEN 'nobody'
                   ELSE 'file-stream' END AS topic FROM notes)
SELECT uid, "Bucket", "Key", topic, queue
FROM sent JOIN (VALUES ('file-stream', 'file-stream-text'), ('file-stream', 'file-stream-images'),
                       ('archive', 'file-stream-text')) AS s(topic, queue) USING (topic)""",
    "fetch_objects": f"""
WITH {_NOTES}
SELECT n.uid, n."Bucket", n."Key", o.text
FROM notes n JOIN (SELECT * FROM notes WHERE lang <> 'fr') o
  ON o."Bucket" = n."Bucket" AND o."Key" = n."Key" """,
    "store_lookup": f"""
WITH {_NOTES}
SELECT uid, "Key", text, CAST(NULL AS VARCHAR) AS error FROM notes WHERE lang <> 'fr'
UNION ALL
SELECT uid, '', NULL, 'key is empty or leaves the store' FROM notes WHERE lang = 'de'
UNION ALL
SELECT uid, '../' || "Key", NULL, 'key is empty or leaves the store' FROM notes WHERE lang = 'es'""",
    "missing_objects": f"""
WITH {_NOTES}
SELECT n.uid, n."Bucket", n."Key" FROM notes n
WHERE NOT EXISTS (SELECT 1 FROM notes o
  WHERE o.lang <> 'fr' AND o."Bucket" = n."Bucket" AND o."Key" = n."Key")""",
    "preview_manifest": f"""
WITH {_PAGED}
SELECT c."Bucket", c."Key", p.n_pages, c.page_no,
       'image-parsed/' || c."Key" || '/' || c.page_no || '.png' AS output_key
FROM capped c JOIN paged p ON p.doc_id = c.doc_id""",
    "previews_rendered": _RENDERED,
    "previews_rendered_python": _RENDERED,
    "preview_errors": f"""
WITH {_PAGED}
SELECT doc_id, page_no, 'ValueError: page has ' || length(page_text) || ' characters' AS error
FROM capped WHERE length(page_text) < 200""",
    "sticky_success": _STICKY,
    "sticky_success_flat": _STICKY,
    "retry_schedule": f"""
WITH RECURSIVE {_ATTEMPTS},
{_FIBONACCI}
SELECT w.event_id, w.attempt, w.n * 1000 AS linear_ms, f.a * 1000 AS fibonacci_ms,
       2 * w.n * 2000 AS steep_text_ms, 2 * w.n * 1000 AS steep_preview_ms,
       w.attempt * 1000 AS linear_no_reset_ms, g.a * 1000 AS fibonacci_no_reset_ms
FROM wrapped w JOIN fib f ON f.n = w.n JOIN fib g ON g.n = w.attempt""",
    "retry_strategies": f"""
WITH RECURSIVE {_ATTEMPTS},
{_FIBONACCI}
SELECT w.event_id, w.n * 1000 AS linear_ms, f.a * 1000 AS fibonacci_ms,
       w.n * 4000 AS exponential_2000_ms, w.n * 2000 AS exponential_1000_ms,
       w.n * 1000 AS unknown_ms, w.attempt * 4000 AS exponential_no_reset_ms
FROM wrapped w JOIN fib f ON f.n = w.n""",
    "stream_visibility": _VISIBILITY,
    "stream_progress": f"""
WITH {_PAGED}
SELECT 'text' AS stage, CAST(count(*) AS BIGINT) AS messages, CAST(0 AS BIGINT) AS failed,
       CAST(count(*) AS BIGINT) AS outputs, CAST(sum(content_length) AS BIGINT) AS bytes_written
FROM measured
UNION ALL
SELECT 'previews', (SELECT count(*) FROM notes), 0, count(*), CAST(sum(strlen(page_text)) AS BIGINT)
FROM capped""",
    # Text: done at once. Previews: done at once, but for one language, whose
    # first delivery fails, is hidden 2 s, comes due and is done two minutes on.
    "stream_queue_retries": f"""
WITH {_NOTES}
SELECT 'file-stream-text' AS queue, uid, "Key", 'done' AS step, 0 AS attempt, CAST(0 AS BIGINT) AS at_ms,
       CAST(NULL AS BIGINT) AS hidden_ms
FROM notes
UNION ALL
SELECT 'file-stream-images', uid, "Key", 'done', 0, 0, NULL FROM notes WHERE lang <> 'fr'
UNION ALL
SELECT 'file-stream-images', uid, "Key", s.step, s.attempt, s.at_ms, s.hidden_ms
FROM notes, (VALUES ('failed', 1, 0, 2000), ('due', 2, 2000, 0), ('done', 1, 120000, NULL))
     AS s(step, attempt, at_ms, hidden_ms)
WHERE lang = 'fr'""",
    "retry_due": f"""
WITH {_ATTEMPTS},
planned AS (
  SELECT event_id, attempt, ts + to_milliseconds(n * 1000) AS next_attempt_at FROM wrapped
)
SELECT event_id, attempt, next_attempt_at FROM planned
WHERE next_attempt_at <= TIMESTAMP '2024-01-15 00:00:00'""",
    "run_stages": f"""
WITH {_PAGED}
SELECT "Bucket", "Key", 'text' AS stage, CAST(1 AS BIGINT) AS n_outputs,
       content_length AS bytes_written FROM measured
UNION ALL
SELECT "Bucket", "Key", 'previews', count(*), CAST(sum(strlen(page_text)) AS BIGINT)
FROM capped GROUP BY "Bucket", "Key" """,
    "run_summary": f"""
WITH {_PAGED}
SELECT count(*) AS documents, CAST(sum(n_pages) AS BIGINT) AS pages_found,
       CAST(sum(pages_processed) AS BIGINT) AS pages_processed,
       CAST(count(*) FILTER (WHERE truncated) AS BIGINT) AS documents_truncated,
       CAST(sum(content_length) AS BIGINT) AS bytes_written
FROM measured""",
    "stream_extract_text": f"""
WITH {_PAGED}
SELECT uid, "Bucket", "Key", 'text-parsed/' || "Key" AS output_key, n_pages, pages_processed,
       truncated, text, content_length
FROM measured""",
    "stream_fan_out": f"""
WITH {_PAGED}
SELECT 'text' AS stage, 'text-parsed/' || "Key" AS output_key, content_length FROM measured
UNION ALL
SELECT 'previews', 'image-parsed/' || "Key" || '/' || page_no || '.png',
       CAST(strlen(page_text) AS BIGINT)
FROM capped""",
    "stream_subscriptions": f"""
WITH {_PAGED},
topics AS (SELECT "Key", lang FROM notes)
SELECT 'text' AS stage, 'text-parsed/' || "Key" AS output_key, content_length
FROM measured JOIN topics USING ("Key") WHERE lang <> 'fr'
UNION ALL
SELECT 'previews', 'image-parsed/' || "Key" || '/' || page_no || '.png',
       CAST(strlen(page_text) AS BIGINT)
FROM capped JOIN topics USING ("Key") WHERE lang NOT IN ('de', 'fr')""",
    "stored_outputs": f"""
WITH {_PAGED}
SELECT 'text-parsed/' || "Key" AS output_key, content_length, text AS body FROM measured
UNION ALL
SELECT 'image-parsed/' || "Key" || '/' || page_no || '.png', CAST(strlen(page_text) AS BIGINT),
       page_text
FROM capped""",
    "stream_redeliver": f"""
WITH {_PAGED},
tries AS (SELECT unnest([1, 2]) AS attempt)
SELECT m.uid, m."Key", CAST(t.attempt AS BIGINT) AS attempt,
       CAST(2 * t.attempt * 2000 AS BIGINT) AS delay_ms, m.content_length
FROM measured m JOIN notes n USING ("Key"), tries t WHERE n.lang = 'fr'""",
    "stream_retry_ledger": f"""
WITH {_NOTES}
SELECT uid, "Bucket", "Key", CAST(1 AS BIGINT) AS attempt, 'object is missing' AS reason
FROM notes WHERE lang = 'fr'""",
    "stream_quarantine": f"""
WITH {_BODIES}
SELECT left("Body", length("Body") - 5) AS "Body", 'body is not JSON' AS reason
FROM bodies WHERE lang = 'fr'""",
    "stream_dedup": """
SELECT DISTINCT event_id, user_id, event_type
FROM (SELECT * FROM events UNION ALL SELECT * FROM events)""",
}
# Rewrites of one language leave every text as it was.
ORACLES["stream_compacted_text"] = ORACLES["stream_extract_text"]
