"""Object keys of sources and outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.schemas import FLAT_PREFIX, PREVIEW_PREFIX, TEXT_PREFIX

LAYOUTS = ("nested", "flat")


def _check(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")


def source_key(uid: Column | str, file: Column | str) -> Column:
    """Key a producer stores a document under; ``.pdf`` is added to any name."""
    return F.concat(uid, F.lit("-"), file, F.lit(".pdf"))


def text_key(key: Column | str, layout: str = "nested") -> Column:
    _check(layout)
    return F.concat(F.lit(TEXT_PREFIX if layout == "nested" else FLAT_PREFIX), key)


def preview_key(key: Column | str, page_no: Column | str, layout: str = "nested") -> Column:
    """Key of one page image, ``page_no`` counting from one.

    ``nested`` gives a folder per document; ``flat`` puts the number straight
    behind the document key, under the prefix of the text outputs.
    """
    _check(layout)
    page = F.col(page_no) if isinstance(page_no, str) else page_no
    if layout == "nested":
        return F.concat(F.lit(PREVIEW_PREFIX), key, F.lit("/"), page.cast("string"), F.lit(".png"))
    return F.concat(F.lit(FLAT_PREFIX), key, page.cast("string"), F.lit(".png"))
