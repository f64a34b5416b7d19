"""A training corpus from raw documents: one language each, no copies, no test items, packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontaminate, langid, neardup, packing
from docflow.llm.common import broadcast_if_small, fresh, short_batches, table, written
from docflow.llm.queries import tokenizer_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; the others go.

    Null texts and texts without a letter are rejected; very long texts are
    judged whole; repeated rows are judged each; an empty table gives an empty
    one; other columns pass through.
    """
    short_batches(spark)
    model = langid.fit(docs, order=F.xxhash64("doc_id", "text"))
    judged = langid.identify(docs.select(*docs.columns), model)
    rejected = judged.columns[-1]
    return judged.where(~F.col(rejected)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least doc_id.

    Every row is judged by its own text, under a key of its own, so rows that
    share a doc_id stay or go each on its own: of two rows equal in id and text
    one stays, and a row with a unique text is never lost for its id. Among
    rows of one doc_id the one with the least hash of its text counts as first.
    Rows with a null doc_id are kept; null or empty texts have no shingles and
    are kept; very long texts are shingled whole; an empty table gives an empty
    one; other columns, whatever their names, pass through unchanged.
    """
    (part,) = fresh(docs, "part")
    rows = docs.withColumn(part, F.xxhash64("text"))
    judged = neardup.near_duplicates(rows.select("doc_id", "text", part), part_col=part)
    texts = judged.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id", F.col("part").alias(part))
    texts = texts.agg(F.first("kept").alias("kept"), F.count("*").alias("n"))
    # Texts to leave out, or to keep of several rows once; no other text is moved.
    held = written(texts.where("NOT kept OR n > 1"), "held", 1)
    key = ["doc_id", part]
    kept = rows.join(broadcast_if_small(held.select(*key), 32), key, "left_anti")
    again = held.where("kept").select(*key)
    if not again.isEmpty():
        once = rows.join(broadcast_if_small(again, 32), key, "left_semi").dropDuplicates(key)
        kept = kept.unionByName(once)
    return kept.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of ``benchmark``.

    Null and empty texts hold none and stay; long texts are searched whole;
    repeated rows are judged each; an empty table gives an empty one; other
    columns pass through.
    """
    short_batches(spark)
    flagged = decontaminate.flag_contaminated(docs, table(spark, sf_dir, "benchmark"))
    flag = flagged.columns[-1]
    return flagged.where(~F.col(flag)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids.

    A null text is empty (its end id alone); long texts are cut into pieces;
    repeated rows are packed each; an empty table gives no pieces.
    """
    short_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("languages", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packed", packed),
]

# Tokenising and clustering are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
