"""Text of embedded documents, appended to that of the main document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import paging
from docflow.schemas import DEFAULT_PAGE_CAP, PDF_SUBTYPE

PART_SIZE = 1000


def is_readable(subtype: Column, content: Column) -> Column:
    """An attachment counts if it has a file and is exactly of the PDF subtype."""
    return content.isNotNull() & (subtype == PDF_SUBTYPE)


def attached_text(attachments: Column | str, limit: Column) -> Column:
    """Nested form: text of a document's ordered ``attachments`` array.

    Attachments keep their order and are read up to the page limit of the main
    document, ``min(cap, its pages)``.
    """
    kept = F.filter(
        F.coalesce(attachments, F.array()), lambda a: is_readable(a["subtype"], a["pages"])
    )
    pages = F.flatten(F.transform(kept, lambda a: F.slice(a["pages"], F.lit(1), limit.cast("int"))))
    return F.array_join(F.transform(pages, paging.page_text), "", "")


def append_attachments(
    main: DataFrame,
    attachments: DataFrame,
    doc_col: str,
    page_texts: Column,
    cap: int = DEFAULT_PAGE_CAP,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Flat form: attachments are rows (doc, ordinal, subtype, content), and
    ``page_texts`` makes an array of page texts of them.

    ``main`` has the document column, ``n_pages`` and ``text``; both sides may be
    of any size. Rows are joined and first put together per run of ``part_size``
    ordinals, so a document with very many attachments is spread over tasks and
    only its finished parts meet.

    Attachments without an ordinal come first; attachments of equal ordinal
    (or of none) follow each other in the order of their page text, so the
    result does not depend on how the rows are partitioned.
    """
    # Attachments without an ordinal come first, in a part of their own.
    part = F.coalesce(
        F.col("ordinal") - F.pmod(F.col("ordinal"), F.lit(part_size)), F.lit(-(1 << 62))
    )
    kept = attachments.where(is_readable(F.col("subtype"), F.col("content"))).select(
        doc_col,
        "ordinal",
        part.alias("_part"),
        # No main document allows more than `cap` pages: cut before the shuffle.
        F.slice(page_texts, 1, paging.check_cap(cap)).alias("_pages"),
    )
    limits = main.select(doc_col, paging.pages_processed(F.col("n_pages"), cap).alias("_limit"))
    # Parts of all attachments, as telling the readable ones takes their contents.
    all_parts = attachments.select(doc_col, part.alias("_part")).distinct()
    part_limits = all_parts.join(limits, doc_col)
    allowed = F.slice("_pages", F.lit(1), F.col("_limit").cast("int"))
    pieces = kept.join(part_limits, [doc_col, "_part"]).select(
        doc_col, "_part", "ordinal", F.array_join(allowed, "", "").alias("_piece")
    )
    parts = pieces.groupBy(doc_col, "_part").agg(
        F.count(F.lit(1)).alias("_n"),
        F.expr("listagg(_piece, '') within group (order by ordinal, _piece)").alias("_text"),
    )
    whole = parts.groupBy(doc_col).agg(
        F.sum("_n").alias("_n"),
        F.expr("listagg(_text, '') within group (order by _part)").alias("_text"),
    )
    others = [c for c in main.columns if c != "text"]
    merged = main.join(whole, doc_col, "left").select(
        *others,
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_attachments"),
        F.concat(F.col("text"), F.coalesce("_text", F.lit(""))).alias("text"),
    )
    return merged.withColumn("content_length", paging.content_length("text"))
