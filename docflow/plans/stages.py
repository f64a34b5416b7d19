"""Processing stages and their registry.

A stage is a function from prepared documents to output rows. Decoding, lookup,
paging, writing and retries around it are shared; a new stage is one
``register`` call and a subscription of its queue.

Prepared documents have ``uid, Bucket, Key, n_pages``, ``page_texts`` - the latter cut
to the largest page cap of the stages - and ``attachments`` if the extractor gives
them. Whatever a stage returns has ``Bucket, Key, output_key, content_length``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions import keys, paging
from docflow.operators.lookup import OBJECT_KEY, Fetcher, missing_objects
from docflow.operators.pages import Extractor, extract_text, line_extractor, page_table
from docflow.operators.previews import Renderer, column_renderer, rendered_only, until_failure
from docflow.schemas import DEFAULT_PAGE_CAP, PREVIEW_QUEUE, TEXT_QUEUE


@dataclass(frozen=True)
class Stage:
    """``cap`` is how many pages the stage looks at, None for all of them; ``body`` the
    column of its outputs that is stored as an object."""

    name: str
    queue: str
    process: Callable[[DataFrame], DataFrame]
    cap: int | None = None
    body: str | None = None


def text_stage(cap: int | None = DEFAULT_PAGE_CAP, layout: str = "nested") -> Stage:
    def process(docs: DataFrame) -> DataFrame:
        return extract_text(docs, cap).select(
            "uid",
            "Bucket",
            "Key",
            keys.text_key("Key", layout).alias("output_key"),
            "n_pages",
            "pages_processed",
            "truncated",
            "text",
            "content_length",
        )

    return Stage("text", TEXT_QUEUE, process, cap, "text")


def preview_stage(
    cap: int | None = DEFAULT_PAGE_CAP,
    layout: str = "nested",
    render: Renderer | None = None,
    on_failure: str = "skip",
) -> Stage:
    """``on_failure`` "skip" leaves out a page that does not render, "stop" that page
    and all later ones of its document."""
    if on_failure not in ("skip", "stop"):
        raise ValueError(f"on_failure must be 'skip' or 'stop', got {on_failure!r}")
    draw = render or column_renderer()

    def process(docs: DataFrame) -> DataFrame:
        pages = draw(page_table(docs.select("uid", "Bucket", "Key", "page_texts"), cap))
        if on_failure == "stop":
            pages = until_failure(pages)
        return rendered_only(pages).select(
            "uid",
            "Bucket",
            "Key",
            "page_no",
            keys.preview_key("Key", "page_no", layout).alias("output_key"),
            "payload",
            paging.content_length("payload").alias("content_length"),
        )

    return Stage("previews", PREVIEW_QUEUE, process, cap, "payload")


_REGISTRY: dict[str, Stage] = {}


def register(stage: Stage) -> Stage:
    """Make a stage available by name; a later one of the same name replaces it."""
    _REGISTRY[stage.name] = stage
    return stage


def registered(names: Sequence[str] | None = None) -> list[Stage]:
    """Stages by name, all of them by default."""
    if names is None:
        return list(_REGISTRY.values())
    unknown = [n for n in names if n not in _REGISTRY]
    if unknown:
        raise KeyError(f"no such stage: {', '.join(unknown)}")
    return [_REGISTRY[n] for n in names]


register(text_stage())
register(preview_stage())


def pages_needed(stages: Sequence[Stage]) -> int | None:
    """The largest page cap among stages, None if one of them reads all pages."""
    caps = [stage.cap for stage in stages]
    return None if None in caps else max(caps)


def prepare(
    targets: DataFrame,
    fetch: Fetcher,
    extract: Extractor | None = None,
    cap: int | None = DEFAULT_PAGE_CAP,
) -> DataFrame:
    """Look documents up and cut them into pages, at most ``cap`` of them.

    The cap goes into the extractor, so pages beyond it are not even read. Contents
    stay behind. What was found is dealt out by key before it is cut: where targets are
    broadcast, a store of few large files or row groups would leave all pages to the
    few tasks that read it.
    """
    extract = extract or line_extractor()
    return extract(fetch(targets).repartition(*OBJECT_KEY), cap).drop("content")


def readable(prepared: DataFrame) -> DataFrame:
    return prepared.where("readable").drop("readable", "error")


def failed(targets: DataFrame, prepared: DataFrame) -> DataFrame:
    """Targets without a stored object or with one that gives no pages, and why."""
    columns = ["uid", "Bucket", "Key"]
    missing = missing_objects(targets.select(*columns), prepared)
    told = F.lit("document is unreadable")
    if "error" in prepared.columns:
        told = F.coalesce(F.col("error"), told)
    unreadable = prepared.where(~F.coalesce("readable", F.lit(False)))
    return missing.withColumn("reason", F.lit("object is missing")).unionByName(
        unreadable.select(*columns, told.alias("reason"))
    )


def run_stages(delivered: DataFrame, stages: Sequence[Stage]) -> dict[str, DataFrame]:
    """Outputs per stage. With a ``queues`` column a stage gets the documents whose
    queues have its own among them, without one it gets all."""
    outputs = {}
    for stage in stages:
        docs = delivered
        if "queues" in delivered.columns:
            docs = delivered.where(F.array_contains("queues", stage.queue)).drop("queues")
        outputs[stage.name] = docs.transform(stage.process)
    return outputs


def stage_summary(outputs: dict[str, DataFrame]) -> DataFrame:
    """Number and bytes of outputs per document and stage."""
    rows = [
        out.select("Bucket", "Key", F.lit(name).alias("stage"), "content_length")
        for name, out in outputs.items()
    ]
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy("Bucket", "Key", "stage")
        .agg(
            F.count(F.lit(1)).alias("n_outputs"),
            F.sum("content_length").alias("bytes_written"),
        )
    )
