from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.functions import keys
from docflow.operators import previews
from docflow.operators.previews import (
    column_renderer,
    preview_manifest,
    python_renderer,
    rendered_only,
    sticky_flags,
    sticky_success,
)
from docflow.plans.stages import preview_stage


def test_manifest(spark):
    docs = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3), ("d", None)], "Key string, n_pages long")
    got = [(r.Key, r.page_no, r.output_key) for r in preview_manifest(docs, 2).collect()]
    assert sorted(got) == [
        ("b", 1, "image-parsed/b/1.png"),
        ("c", 1, "image-parsed/c/1.png"),
        ("c", 2, "image-parsed/c/2.png"),
    ]
    flat = preview_manifest(docs, 1, "flat").where("Key = 'b'").first()
    assert flat.output_key == "extracted-text/b1.png"


def test_unknown_layout():
    with pytest.raises(ValueError):
        keys.text_key("Key", "other")


def test_one_bad_page_does_not_stop_the_next(spark):
    pages = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "page_no long, page_text string")
    rendered = column_renderer()(pages)
    assert [r.page_no for r in rendered_only(rendered).collect()] == [1, 3]
    assert [bytes(r.payload) for r in rendered_only(rendered).collect()] == [b"a", b"c"]


def test_python_renderer(spark):
    def draw(text):
        if text == "bad":
            raise RuntimeError(text)
        return None if text == "none" else text.upper().encode()

    pages = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "none"), (4, "d")], "page_no long, page_text string")
    rows = python_renderer(draw)(pages).orderBy("page_no").collect()
    assert [r.ok for r in rows] == [True, False, False, True]
    assert [r.payload for r in rows] == [b"A", None, None, b"D"]


def running_and(flags):
    out, good = [], True
    for flag in flags:
        good = good and bool(flag)
        out.append(good)
    return out


CASES = [[True, True, False, True], [True], [False, True], [True, None, True], [True] * 12]


def test_sticky_flat(spark):
    rows = [(d, p + 1, ok) for d, flags in enumerate(CASES) for p, ok in enumerate(flags)]
    # One document holds most rows and fails once, late.
    rows += [(99, p + 1, p != 700) for p in range(1000)]
    df = spark.createDataFrame(rows, "doc long, page_no long, ok boolean").repartition(5)
    got = {}
    for r in sticky_success(df, ["doc"]).collect():
        got.setdefault(r.doc, {})[r.page_no] = r.success
    for d, flags in [*enumerate(CASES), (99, [p != 700 for p in range(1000)])]:
        assert [got[d][p + 1] for p in range(len(flags))] == running_and(flags)


def test_sticky_nested(spark):
    df = spark.createDataFrame([(d, f) for d, f in enumerate([*CASES, []])], "doc long, ok_flags array<boolean>")
    got = {}
    for r in sticky_flags(df).collect():
        got.setdefault(r.doc, {})[r.page_no] = r.success
    for d, flags in enumerate(CASES):
        assert [got[d][p + 1] for p in range(len(flags))] == running_and(flags)
    assert len(CASES) not in got


@pytest.mark.parametrize(("on_failure", "left"), [("skip", [1, 2, 4, 11]), ("stop", [1, 2, 11])])
def test_stage_skips_or_stops_at_a_bad_page(spark, on_failure, left):
    docs = spark.createDataFrame(
        [("u", "b", "k", ["a", "b", "bad", "d"]), ("u", "b", "l", ["x"])],
        "uid string, Bucket string, Key string, page_texts array<string>",
    )
    draw = python_renderer(lambda text: None if text == "bad" else text.encode())
    rows = preview_stage(render=draw, on_failure=on_failure).process(docs).collect()
    assert sorted(r.page_no + (10 if r.Key == "l" else 0) for r in rows) == left


def test_key_formats(spark):
    row = spark.range(1).select(
        keys.source_key(F.lit("u"), F.lit("flyer.pdf")).alias("source"),
        keys.text_key(F.lit("k")).alias("text"),
        keys.text_key(F.lit("k"), "flat").alias("flat_text"),
        keys.preview_key(F.lit("k"), F.lit(3)).alias("preview"),
        keys.preview_key(F.lit("k"), F.lit(3), "flat").alias("flat_preview"),
    ).first()
    assert tuple(row) == (
        "u-flyer.pdf.pdf", "text-parsed/k", "extracted-text/k", "image-parsed/k/3.png", "extracted-text/k3.png",
    )


def test_page_errors_are_kept(spark):
    from docflow.operators import previews as pv

    def draw(text):
        if text == "boom":
            raise ValueError("cannot draw")
        return None if text == "none" else text.encode()

    pages = spark.createDataFrame(
        [("b", "k", 1, "fine"), ("b", "k", 2, "boom"), ("b", "k", 3, "none")],
        "Bucket string, Key string, page_no long, page_text string",
    )
    rendered = pv.python_renderer(draw)(pages)
    errors = sorted((r.page_no, r.error) for r in pv.page_errors(rendered).collect())
    assert errors == [(2, "ValueError: cannot draw"), (3, pv.NOT_RENDERED)]
    assert [r.page_no for r in pv.rendered_only(rendered).collect()] == [1]
    by_column = pv.column_renderer(F.length("page_text") > 4, error=F.lit("too short"))(pages)
    assert sorted(r.error for r in pv.page_errors(by_column).collect()) == ["too short"] * 3


def test_a_batch_is_drawn_some_rows_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    taken, drawn = [], []
    df = spark.createDataFrame([(1, "x")], "page_no long, page_text string")
    with monkeypatch.context() as patch:
        patch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
        previews.python_renderer(lambda text: drawn.append(text) or text.encode())(df)
    (run,) = taken
    texts = [None if k == 700 else str(k) for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], names=["page_no", "page_text"])
    given = run(iter([batch]))
    first = next(given)
    assert first.num_rows == len(drawn) == 256
    rows = first.to_pylist() + [row for more in given for row in more.to_pylist()]
    assert [r["page_text"] for r in rows] == texts
    assert [r["page_no"] for r in rows if not r["ok"]] == [700]
    assert rows[700]["payload"] is None and rows[700]["error"].startswith("AttributeError")
