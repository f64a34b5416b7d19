"""Page arithmetic and page text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.schemas import DEFAULT_PAGE_CAP

LINES_PER_PAGE = 5


def check_cap(cap: int) -> int:
    """The page cap, which has to be a whole number of at least one."""
    if isinstance(cap, bool) or not isinstance(cap, int) or cap < 1:
        raise ValueError(f"page cap must be an integer >= 1, got {cap!r}")
    return cap


def line_page_count(content: Column | str, lines_per_page: int = LINES_PER_PAGE) -> Column:
    """Pages the line splitter would make of ``content``, without building them."""
    content = F.col(content) if isinstance(content, str) else content
    lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1
    return F.ceil(lines / F.lit(lines_per_page)).cast("bigint")


def pages_processed(n_pages: Column, cap: int | None = DEFAULT_PAGE_CAP) -> Column:
    """Pages up to the cap, None meaning all; unknown where the count is."""
    if cap is None:
        return n_pages
    limit = F.lit(check_cap(cap)).cast("bigint")
    return F.when(n_pages.isNotNull(), F.least(n_pages, limit))


def is_truncated(n_pages: Column, cap: int | None = DEFAULT_PAGE_CAP) -> Column:
    return F.when(n_pages.isNotNull(), F.lit(False)) if cap is None else n_pages > check_cap(cap)


def page_text(items: Column | str) -> Column:
    """The items of one page with a space in between; a null item is empty text."""
    return F.array_join(items, " ", "")


def page_count(pages: Column | str) -> Column:
    return F.size(pages).cast("bigint")


def first_pages(pages: Column | str, cap: int | None = DEFAULT_PAGE_CAP) -> Column:
    """Pages up to the cap, None meaning all; a missing array stays missing."""
    column = F.col(pages) if isinstance(pages, str) else pages
    return column if cap is None else F.slice(column, 1, check_cap(cap))


def page_texts(pages: Column | str, cap: int | None = DEFAULT_PAGE_CAP) -> Column:
    """Text of each page; the slice comes first, so no page beyond the cap is joined."""
    return F.transform(first_pages(pages, cap), page_text)


def document_text(texts: Column | str, cap: int | None = DEFAULT_PAGE_CAP) -> Column:
    """Page texts up to the cap put together, without a separator."""
    return F.array_join(first_pages(texts, cap), "", "")


def content_length(text: Column | str) -> Column:
    """Length in bytes of the UTF-8 form."""
    return F.octet_length(text).cast("bigint")
