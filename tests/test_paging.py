from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.functions import paging
from docflow.operators.pages import (
    assemble_pages,
    extract_text,
    first_n_pages,
    join_items,
    line_extractor,
    page_table,
    python_extractor,
)


def texts_of(spark, pages, cap=10):
    docs = spark.createDataFrame([(1, pages)], "doc_id long, pages array<array<string>>")
    return extract_text(join_items(docs, cap), cap).first()


@pytest.mark.parametrize(
    ("pages", "text"),
    [
        ([[None, "a"]], " a"),
        ([["a", None]], "a "),
        ([["a", "b"], ["c"]], "a bc"),
        ([[], ["c"]], "c"),
        ([[""]], ""),
        ([["é", "ü"]], "é ü"),
    ],
)
def test_document_text(spark, pages, text):
    row = texts_of(spark, pages)
    assert row.text == text
    assert row.content_length == len(text.encode())


@pytest.mark.parametrize(("n", "processed", "cut"), [(9, 9, False), (10, 10, False), (11, 10, True)])
def test_cap_edges(spark, n, processed, cut):
    row = texts_of(spark, [[str(i)] for i in range(n)])
    assert (row.n_pages, row.pages_processed, row.truncated) == (n, processed, cut)
    assert row.text == "".join(str(i) for i in range(processed))


@pytest.mark.parametrize("cap", [0, -1, None, "3", 2.0, True])
def test_bad_cap(cap):
    with pytest.raises(ValueError):
        paging.check_cap(cap)


def test_line_extractor(spark):
    texts = ["", "a", "a\nb\nc\nd\ne", "a\nb\nc\nd\ne\nf", "\n" * 10, None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, content string")
    rows = {r.doc_id: r for r in line_extractor()(docs, None).collect()}
    capped = {r.doc_id: r for r in line_extractor()(docs, 1).collect()}
    for i, text in enumerate(texts):
        if text is None:
            assert rows[i].page_texts is None and not rows[i].readable
        else:
            lines = text.split("\n")
            assert rows[i].page_texts == [" ".join(lines[k : k + 5]) for k in range(0, len(lines), 5)]
            assert rows[i].readable and rows[i].n_pages == len(rows[i].page_texts)
            assert capped[i].page_texts == rows[i].page_texts[:1] and capped[i].n_pages == rows[i].n_pages
    counts = docs.select("doc_id", paging.line_page_count("content").alias("n")).collect()
    for r in counts:
        assert r.n == rows[r.doc_id].n_pages


def test_binary_content(spark):
    docs = spark.createDataFrame([(1, bytearray("é\nb".encode()))], "doc_id long, content binary")
    assert line_extractor()(docs).first().page_texts == ["é b"]


def test_python_extractor(spark):
    def open_document(content):
        text = bytes(content).decode()
        if text == "broken":
            raise ValueError(text)
        pages = text.split("\f")
        return len(pages), (page.split(" ") for page in pages)

    rows = [(1, bytearray(b"a b\fc")), (2, bytearray(b"broken")), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content binary")
    paged = python_extractor(open_document)(docs, None)
    got = {r.doc_id: (r.page_texts, r.n_pages, r.readable) for r in paged.collect()}
    assert got == {1: (["a b", "c"], 2, True), 2: (None, None, False), 3: (None, None, False)}
    first = python_extractor(open_document)(docs, 1).where("doc_id = 1").first()
    assert (first.page_texts, first.n_pages) == (["a b"], 2)


def test_page_table_is_one_based_and_capped(spark):
    docs = spark.createDataFrame([(7, ["a", "b", "c"])], "doc_id long, page_texts array<string>")
    assert [(r.page_no, r.page_text) for r in page_table(docs).collect()] == [(1, "a"), (2, "b"), (3, "c")]
    assert page_table(docs, 2).count() == 2


def hot_page_table(spark):
    """A third of all rows belongs to one document; pages come in no order."""
    return spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50 + 1).alias("doc"),
        (F.col("id") * 7919 % 3001).alias("page_no"),
        F.concat(F.lit("p"), "id").alias("text"),
    )


@pytest.mark.parametrize("cap", [1, 3, 2000])
def test_flat_matches_brute_force(spark, cap):
    table = hot_page_table(spark)
    by_doc = {}
    for r in table.collect():
        by_doc.setdefault(r.doc, []).append((r.page_no, r.text))
    want = {d: [t for _, t in sorted(rows)[:cap]] for d, rows in by_doc.items()}
    got = {r.doc: r for r in assemble_pages(table, ["doc"], ["page_no"], "text", cap).collect()}
    assert {d: (r.pages_processed, r.text) for d, r in got.items()} == {
        d: (len(t), "".join(t)) for d, t in want.items()
    }
    numbered = first_n_pages(table, ["doc"], ["page_no"], cap).collect()
    assert sorted((r.doc, r.page_no, r.text) for r in numbered) == sorted(
        (d, i + 1, t) for d, texts in want.items() for i, t in enumerate(texts)
    )


def test_nested_equals_flat(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    paged = line_extractor("text")(docs).drop("text")
    nested = extract_text(paged).select("doc_id", "text", "content_length")
    flat = assemble_pages(page_table(line_extractor("text")(docs, None)), ["doc_id"], ["page_no"], "page_text", 10)
    flat = flat.select("doc_id", "text", "content_length")
    assert nested.exceptAll(flat).isEmpty() and flat.exceptAll(nested).isEmpty()
