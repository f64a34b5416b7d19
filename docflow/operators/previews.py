"""Per-page preview outputs: manifest, rendering and which pages get stored."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions import keys, paging
from docflow.operators.lookup import null_safe_join
from docflow.schemas import DEFAULT_PAGE_CAP

# Takes pages, gives them back with `ok`, `payload` and `error` columns.
Renderer = Callable[[DataFrame], DataFrame]
NOT_RENDERED = "renderer gave no image"
ROWS_DRAWN = 256


def preview_manifest(
    docs: DataFrame, cap: int | None = DEFAULT_PAGE_CAP, layout: str = "nested"
) -> DataFrame:
    """One row per document and page up to the cap, with the key to store it at."""
    limit = paging.pages_processed(F.col("n_pages"), cap)
    numbers = F.sequence(F.lit(1).cast("bigint"), limit)
    return (
        docs.withColumn("page_no", F.explode(F.when(F.col("n_pages") >= 1, numbers)))
        .withColumn("output_key", keys.preview_key("Key", "page_no", layout))
    )


def column_renderer(
    ok: Column | None = None, payload: Column | None = None, error: Column | None = None
) -> Renderer:
    """Renderer of column expressions; by default a page renders to its own text.

    ``error`` says why a page did not render; by default that no image came.
    """

    def render(pages: DataFrame) -> DataFrame:
        image = F.encode("page_text", "UTF-8") if payload is None else payload
        done = image.isNotNull() if ok is None else F.coalesce(ok, F.lit(False))
        why = F.lit(NOT_RENDERED) if error is None else F.coalesce(error, F.lit(NOT_RENDERED))
        return pages.withColumns({"ok": done, "payload": F.when(done, image), "error": F.when(~done, why)})

    return render


def python_renderer(draw: Callable[[str], bytes | None]) -> Renderer:
    """Renderer around a Python library; ``None`` or an error means not rendered.

    The error of a page that raised is kept in ``error`` as ``Type: message``;
    one that gave ``None`` has ``NOT_RENDERED``.
    """

    def image_of(text):
        try:
            image = draw(text)
        except Exception as failure:
            return None, f"{type(failure).__name__}: {failure}"
        return image, None if image is not None else NOT_RENDERED

    def render(pages: DataFrame) -> DataFrame:
        schema = T.StructType(
            [
                *pages.schema.fields,
                T.StructField("ok", T.BooleanType()),
                T.StructField("payload", T.BinaryType()),
                T.StructField("error", T.StringType()),
            ]
        )

        rows_drawn = ROWS_DRAWN

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                # Some rows at a time: texts and images of a batch are not all held at once.
                for at in range(0, whole.num_rows, rows_drawn):
                    batch = whole.slice(at, rows_drawn)
                    texts = batch.column(batch.schema.get_field_index("page_text")).to_pylist()
                    images, errors = zip(*map(image_of, texts))
                    added = (
                        pa.array([image is not None for image in images], pa.bool_()),
                        pa.array(images, pa.binary()),
                        pa.array(errors, pa.string()),
                    )
                    yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

        return pages.mapInArrow(run, schema)

    return render


def rendered_only(pages: DataFrame) -> DataFrame:
    """Pages whose image exists; one failing page does not stop the later ones."""
    return pages.where("ok")


def page_errors(pages: DataFrame) -> DataFrame:
    """Pages that did not render and why: the second output of a rendering.

    Read both this and ``rendered_only`` from rendered pages that were written
    once, so that no page is drawn twice.
    """
    return pages.where(~F.col("ok")).drop("payload", "ok")


def sticky_success(
    pages: DataFrame, doc_cols: Sequence[str], page_col: str = "page_no", ok_col: str = "ok"
) -> DataFrame:
    """Add ``success``: true up to the first failing page of a document.

    That page number is an aggregate with map-side combine, so no task has to see
    all pages of one document, as a running AND over a window would need. The
    flags are read twice: store rendered pages first if rendering is dear.
    """
    bad = ~F.coalesce(F.col(ok_col), F.lit(False))
    first_bad = pages.where(bad).groupBy(*doc_cols).agg(F.min(page_col).alias("_first_bad"))
    return (
        null_safe_join(pages, first_bad, doc_cols)
        .withColumn("success", F.coalesce(F.col(page_col) < F.col("_first_bad"), F.lit(True)))
        .drop("_first_bad")
    )


def until_failure(pages: DataFrame) -> DataFrame:
    """Pages with ``ok`` false from the first failing page of their document on.

    ``pages`` come as ``page_table`` and a renderer leave them: all of a document
    (Bucket, Key) one after the other in one task. So a running AND needs no shuffle,
    and each image is drawn once and stays where it is.
    """
    place = pages.columns.index("ok")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, failed = None, False
        for batch in batches:
            flags = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("Bucket", "Key", "ok")]
            for bucket, key, ok in zip(*columns):
                if (bucket, key) != last:
                    last, failed = (bucket, key), False
                failed = failed or not ok
                flags.append(not failed)
            yield batch.set_column(place, "ok", pa.array(flags, pa.bool_()))

    return pages.mapInArrow(run, pages.schema)


def sticky_flags(docs: DataFrame, ok_col: str = "ok_flags") -> DataFrame:
    """Nested form of ``sticky_success``: page flags are an array in page order."""
    others = [c for c in docs.columns if c != ok_col]
    # array_position counts from one and gives zero where all pages are fine.
    flags = F.transform(ok_col, lambda ok: F.coalesce(ok, F.lit(False)))
    # Not a bare column, or Spark would filter on its size below, computing it twice.
    exploded = F.coalesce("_flags", F.array())
    return (
        docs.withColumn("_flags", flags)
        .withColumn("_first_bad", F.array_position("_flags", F.lit(False)))
        .select(*others, "_first_bad", F.posexplode(exploded).alias("_at", "ok"))
        .withColumn("page_no", (F.col("_at") + 1).cast("bigint"))
        .withColumn(
            "success", (F.col("_first_bad") == 0) | (F.col("page_no") < F.col("_first_bad"))
        )
        .drop("_at", "_first_bad")
    )
