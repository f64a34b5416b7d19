"""Documents to pages, pages to text - nested (a row is a document) and flat."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as win

from docflow.functions import paging
from docflow.operators.attachments import attached_text
from docflow.schemas import DEFAULT_PAGE_CAP, PAGES

# Takes documents and a page cap (None for all pages) and adds `page_texts` (no more
# than the cap), `n_pages` (of the whole document), `readable`, and `error` where it
# is not, which keeps an `error` that is there already.
Extractor = Callable[[DataFrame, int | None], DataFrame]

RANK_SALTS = 32


def line_extractor(
    content_col: str = "content", lines_per_page: int = paging.LINES_PER_PAGE
) -> Extractor:
    """The extractor shipped here: a line is a text item, some lines are a page."""

    def extract(docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP) -> DataFrame:
        # The lines are a projection of their own, or the text would be split
        # again for every page. Pages go straight from lines to text: arrays of
        # arrays in between would be copied from row to row.
        # Bytes that are no text are not split: they would come out damaged.
        content = F.col(content_col).cast("string")
        text = F.when(F.is_valid_utf8(content), content)
        # With a cap only the lines of its pages are split off; the rest stays one item.
        limit = -1 if cap is None else paging.check_cap(cap) * lines_per_page + 1
        lines = docs.withColumns({"_text": text}).withColumn("_lines", F.split("_text", "\n", limit))
        n_pages = paging.line_page_count("_text", lines_per_page)
        wanted = n_pages if cap is None else paging.pages_processed(n_pages, cap)
        texts = F.transform(
            F.sequence(F.lit(0), (wanted - 1).cast("int")),
            lambda i: paging.page_text(
                F.slice("_lines", i * lines_per_page + 1, F.lit(lines_per_page))
            ),
        )
        return lines.withColumns(
            {
                "page_texts": F.when(F.col("_lines").isNotNull(), texts),
                "n_pages": n_pages,
                "readable": F.col("_lines").isNotNull(),
                "error": F.coalesce(
                    F.col("error") if "error" in docs.columns else F.lit(None).cast("string"),
                    F.when(F.col("_lines").isNull(), "content is no UTF-8 text"),
                ),
            }
        ).drop("_lines", "_text")

    return extract


def python_extractor(
    open_document: Callable[[bytes], tuple[int, Iterable[Iterable[str | None]]]],
    content_col: str = "content",
) -> Extractor:
    """Extractor around a Python library reading one document at a time.

    ``open_document`` gives the number of pages and an iterable of them, of which
    only those up to the cap are taken. A document it fails on is not readable and
    goes to the retry ledger with the text of the failure. Contents go to Python
    and do not come back.
    """

    def read(content, cap):
        if content is None:
            return None, None, "document has no content"
        try:
            n_pages, pages = open_document(content)
            return n_pages, [list(items) for items in islice(pages, cap)], None
        except Exception as error:
            return None, None, f"{type(error).__name__}: {error}"[:500]

    def extract(docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP) -> DataFrame:
        kept = [f for f in docs.schema.fields if f.name not in (content_col, "error")]
        schema = T.StructType(
            [
                *kept,
                T.StructField("pages", PAGES),
                T.StructField("n_pages", T.LongType()),
                T.StructField("readable", T.BooleanType()),
                T.StructField("error", T.StringType()),
            ]
        )
        before = "error" in docs.columns

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                read_all = [read(content, cap) for content in batch[content_col]]
                counts = [count for count, _, _ in read_all]
                errors = [error for _, _, error in read_all]
                if before:
                    errors = [old or new for old, new in zip(batch["error"], errors)]
                yield batch[[f.name for f in kept]].assign(
                    pages=pd.Series([p for _, p, _ in read_all], index=batch.index, dtype=object),
                    n_pages=pd.array(counts, dtype="Int64"),
                    readable=[count is not None for count in counts],
                    error=pd.Series(errors, index=batch.index, dtype=object),
                )

        return join_items(docs.mapInPandas(run, schema), cap)

    return extract


def join_items(docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP) -> DataFrame:
    """Replace ``pages``, arrays of text items, by ``page_texts``; adds n_pages."""
    if "n_pages" not in docs.columns:
        docs = docs.withColumn("n_pages", paging.page_count("pages"))
    return docs.withColumn("page_texts", paging.page_texts("pages", cap)).drop("pages")


def page_stats(docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP) -> DataFrame:
    """Add pages_processed and truncated."""
    n_pages = F.col("n_pages")
    return docs.withColumns(
        {
            "pages_processed": paging.pages_processed(n_pages, cap),
            "truncated": paging.is_truncated(n_pages, cap),
        }
    )


def extract_text(docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP) -> DataFrame:
    """Replace ``page_texts`` by the capped document text and its length; no shuffle.

    Where the extractor gave ``attachments`` too, their text is appended.
    """
    text = paging.document_text("page_texts", cap)
    if "attachments" in docs.columns:
        text = F.concat(text, attached_text("attachments", F.col("pages_processed")))
    return (
        page_stats(docs, cap)
        .withColumn("text", text)
        .drop("page_texts", "attachments")
        .withColumn("content_length", paging.content_length("text"))
    )


def page_table(docs: DataFrame, cap: int | None = None) -> DataFrame:
    """One row per page with its 1-based number and text, up to ``cap`` if given."""
    # Never a bare column: Spark would filter on its size below the projection that
    # makes it, and so make the pages twice.
    texts = F.coalesce(paging.first_pages("page_texts", cap), F.array())
    others = [c for c in docs.columns if c != "page_texts"]
    return docs.select(*others, F.posexplode(texts).alias("_at", "page_text")).select(
        *others, (F.col("_at") + 1).cast("bigint").alias("page_no"), "page_text"
    )


def first_n_pages(
    pages: DataFrame, doc_cols: Sequence[str], order_cols: Sequence[str], cap: int
) -> DataFrame:
    """The first ``cap`` rows per document of a flat page table, numbered.

    Spark applies a rank limit to each map task before the shuffle, so no task
    receives more than ``cap`` rows per document and map task, however many pages
    a document has. It does not for large limits: those are first applied to parts
    of a document. ``order_cols`` have to tell the rows of a document apart: which
    of tied rows come first is not defined.
    """
    paging.check_cap(cap)
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    if cap > int(pages.sparkSession.conf.get(setting, "1000")):
        salt = F.pmod(F.xxhash64(*order_cols), F.lit(RANK_SALTS))
        pages = _first_rows(pages.withColumn("_salt", salt), [*doc_cols, "_salt"], order_cols, cap)
        pages = pages.drop("_salt", "_rank")
    first = _first_rows(pages, doc_cols, order_cols, cap)
    return first.withColumn("page_no", F.col("_rank").cast("bigint")).drop("_rank")


def _first_rows(
    pages: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], cap: int
) -> DataFrame:
    ordered = win.Window.partitionBy(*group_cols).orderBy(*order_cols)
    return pages.withColumn("_rank", F.row_number().over(ordered)).where(F.col("_rank") <= cap)


def assemble_pages(
    pages: DataFrame,
    doc_cols: Sequence[str],
    order_cols: Sequence[str],
    text_col: str,
    cap: int,
) -> DataFrame:
    """Document text from a flat page table; uses the one shuffle of the limit."""
    kept = pages.select(*doc_cols, *order_cols, F.col(text_col).alias("_text"))
    first = first_n_pages(kept, doc_cols, order_cols, cap)
    text = F.expr("listagg(_text, '') within group (order by page_no)")
    return (
        first.groupBy(*doc_cols)
        .agg(
            F.count(F.lit(1)).alias("pages_processed"),
            F.coalesce(text, F.lit("")).alias("text"),
        )
        .withColumn("content_length", paging.content_length("text"))
    )
