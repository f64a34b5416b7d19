"""Registered queries: each dealt operator over its whole table, and the pipeline's digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import align, ann, chat, decontaminate, fingerprints, hardneg, langid, neardup, packing, sharding, suffixtree, tokens, urls
from docflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
PROBE_CONV, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _crc_mod(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_decontamination(spark, sf_dir):
    return decontaminate.benchmark_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_sharding(spark, sf_dir):
    """Whole documents go to their shards; what is returned is taken from them there."""
    placed = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), SHARDS)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = tokens.token_file_digest(docs, tokenizer_path())
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op6_suffix_tree(spark, sf_dir):
    held_out = _crc_mod(10) == 0
    scored = suffixtree.score_texts(table(spark, sf_dir, "documents"), learn=~held_out)
    return scored.select(
        "doc_id",
        (_crc_mod(10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(PROBE_CONV, turn, role, PROBE_TEXT) for turn, role in enumerate(("user", "assistant"))], rows.schema
    )
    every = rows.unionAll(probe)
    record = F.to_variant_object(F.struct("role", "text"))
    turns = chat.canonical_turns(every.select("conv_id", "turn", record.alias("record")), "record")
    formatted = chat.format_conversations(turns, "conv_id", ["turn"])
    return chat.conversation_digest(chat.read_back(formatted, "conv_id"), "conv_id")


def op8_urls(spark, sf_dir):
    rules = spark.createDataFrame([urls.parse_rule(*r) for r in URL_RULES], urls.RULES)
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _crc_mod(4) == 2
    model = langid.fit(docs.where(~F.coalesce(held_out, F.lit(False))), order=F.xxhash64("doc_id", "text"))
    judged = langid.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op11_hard_negatives(spark, sf_dir):
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark, sf_dir):
    return align.align_documents(
        table(spark, sf_dir, "documents"), tokenizer_path(align.A_TOKENIZER), tokenizer_path(align.B_TOKENIZER)
    )


def op13_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_token_files": op4_token_files,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_chat": op7_chat,
    "op8_urls": op8_urls,
    "op9_language": op9_language,
    "op10_neighbours": op10_neighbours,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_alignment": op12_alignment,
    "op13_fingerprints": op13_fingerprints,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op11_hard_negatives": r"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
anchors AS (SELECT * FROM kept WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS cand_id,
         list_sum(list_transform(range(len(a.q)), lambda i: a.q[i + 1] * c.q[i + 1]))::BIGINT AS score
  FROM anchors a JOIN kept c ON len(a.q) = len(c.q) AND c.vec_id <> a.vec_id
),
pos AS (
  SELECT anchor_id, cand_id AS positive_id, coalesce(score, 0) AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY coalesce(score, 0) DESC, cand_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY coalesce(s.score, 0) DESC, s.cand_id) AS INT) AS rank,
       s.cand_id AS negative_id, p.positive_score, coalesce(s.score, 0) AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * coalesce(s.score, 0) AND 100 * coalesce(s.score, 0) <= 90 * p.positive_score
QUALIFY rank <= 10""",
    "op5_near_duplicates": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE [] END)) AS g
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c >= 85 * (a.n + b.n - c)
),
edges AS (SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links),
reached(u, v) AS (
  SELECT DISTINCT u, u FROM edges
  UNION SELECT r.u, e.v FROM reached r JOIN edges e ON e.u = r.v
),
least AS (SELECT u, min(v) AS c FROM reached GROUP BY u)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.c, d.doc_id) AS component_id,
       coalesce(l.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.u = d.doc_id""",
    "op7_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
-- A marker behind each of three signs; 12, 10 and 11 characters of control strings.
sized AS (
  SELECT *, 33 + length(r || t) + length(regexp_replace(r || t, '[^\<\[]', '', 'g')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
}
