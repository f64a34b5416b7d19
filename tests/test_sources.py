from __future__ import annotations

import contextlib
import io
import uuid

import pytest

from docflow.operators.lookup import broadcast_if_small, fetch_objects, missing_objects, row_bytes, table_fetcher
from docflow.operators.notifications import accepted, build_bodies, decode_bodies
from docflow.plans import fixtures as fx
from docflow.schemas import DOCUMENT_TEXT
from docflow.session import INITIAL_PARTITIONS, PARTITIONS_PER_CORE, scratch_dir, widen_shuffles
from docflow.sources.notifications import publish, read_bodies
from docflow.sources.objects import read_objects, save_objects_table, store_fetcher
from docflow.sources.sinks import latest, put_objects, read_or_empty, write_batch

COLUMNS = "uid string, Bucket string, Key string"


def test_fetched_and_missing_are_all(spark, sf_dir):
    sent, stored = fx.notifications(spark, sf_dir), fx.stored(spark, sf_dir)
    found, missing = fetch_objects(sent, stored), missing_objects(sent, stored)
    both = found.select("uid").unionByName(missing.select("uid"))
    assert both.exceptAll(sent.select("uid")).isEmpty() and both.count() == sent.count()
    assert missing.count() > 0


def test_lookup_by_measured_broadcast(spark, sf_dir):
    sent = fx.notifications(spark, sf_dir)
    size = sent.agg(row_bytes(sent)).first()[0]
    assert size > sent.count() * 64
    objects = fx.objects(spark, sf_dir)
    for limit in (size, size - 1):
        got = table_fetcher(objects, "text")(broadcast_if_small(sent, size, limit))
        assert got.count() == sent.count()
        assert set(got.columns) == {"uid", "Bucket", "Key", "content"}
    assert spark.createDataFrame([], COLUMNS).agg(row_bytes(sent)).first()[0] == 0


def test_store_round_trip(spark, tmp_path):
    bodies = [("b", f"text/{i} é.txt", f"text {i}" * 100) for i in range(50)]
    rows = spark.createDataFrame(bodies, "Bucket string, output_key string, text string").repartition(3)
    receipts = put_objects(rows, tmp_path.as_uri(), "text").collect()
    assert {r.output_key: r.content_length for r in receipts} == {k: len(t) for _, k, t in bodies}
    # Written again, nothing doubles and no part files stay.
    put_objects(rows, tmp_path.as_uri(), "text").collect()
    assert len([p for p in tmp_path.rglob("*") if p.is_file()]) == 50

    listed = read_objects(spark, str(tmp_path / "b"), "b")
    assert {(r.Bucket, r.Key, bytes(r.content).decode()) for r in listed.collect()} == set(bodies)

    wanted = [(f"u{i}", "b", f"text/{i} é.txt") for i in range(0, 60, 2)]
    found = store_fetcher(tmp_path.as_uri())(spark.createDataFrame(wanted, COLUMNS)).collect()
    assert {(r.Bucket, r.Key, bytes(r.content).decode()) for r in found} == set(bodies[::2])


def test_store_fetcher_cuts_batches_by_size(spark, tmp_path, monkeypatch):
    (tmp_path / "b").mkdir()
    for i in range(20):
        (tmp_path / "b" / f"k{i}").write_bytes(bytes(10))
    wanted = spark.createDataFrame([("u", "b", f"k{i}") for i in range(25)], COLUMNS).coalesce(1)
    monkeypatch.setattr("docflow.sources.objects.BYTES_PER_BATCH", 25)
    assert store_fetcher(tmp_path.as_uri())(wanted).count() == 20


def test_key_may_not_leave_the_store(spark, tmp_path):
    rows = spark.createDataFrame([("b", "../../x", "t")], "Bucket string, output_key string, text string")
    with pytest.raises(Exception, match="leaves the store"):
        put_objects(rows, tmp_path.as_uri(), "text").collect()


def test_bucketed_objects_stay_in_place(spark, sf_dir):
    name = f"objects_{uuid.uuid4().hex}"
    save_objects_table(fx.objects(spark, sf_dir).select("Bucket", "Key", "text"), name, 8)
    try:
        sent = accepted(decode_bodies(build_bodies(fx.notifications(spark, sf_dir)).select("Body")))
        joined = fetch_objects(sent.hint("merge"), spark.table(name))
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            joined.explain()
        # Only the notifications are shuffled.
        assert text.getvalue().count("Exchange") == 1
        assert joined.count() == 1000
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_publish_and_read(spark, tmp_path):
    sent = spark.createDataFrame([("u", "b", "k")], COLUMNS)
    publish(sent, str(tmp_path / "inbox"))
    publish(sent, str(tmp_path / "inbox"))
    bodies = read_bodies(spark, str(tmp_path / "inbox")).collect()
    assert [r.Body for r in bodies] == ['{"Message":"{\\"uid\\":\\"u\\",\\"Bucket\\":\\"b\\",\\"Key\\":\\"k\\"}"}'] * 2


def test_batches_are_replaced_and_the_last_one_counts(spark, tmp_path):
    path = str(tmp_path / "out")
    assert read_or_empty(spark, path, DOCUMENT_TEXT).isEmpty()

    def batch(n, keys, text):
        rows = spark.createDataFrame([("b", k, text) for k in keys], "Bucket string, output_key string, text string")
        write_batch(rows, path, n)

    batch(0, ["a", "b"], "old")
    batch(1, ["b", "c"], "wrong")
    batch(1, ["b", "c"], "new")
    batch(10, ["c"], "newest")
    rows = latest(read_or_empty(spark, path, DOCUMENT_TEXT), ["Bucket", "output_key"])
    assert {r.output_key: r.text for r in rows.collect()} == {"a": "old", "b": "new", "c": "newest"}
    assert rows.count() == 3


def test_shuffle_width_follows_the_cluster(spark):
    session = spark.newSession()
    widen_shuffles(session)
    want = str(PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
    assert session.conf.get(INITIAL_PARTITIONS) == want
    session.conf.set(INITIAL_PARTITIONS, "7")
    widen_shuffles(session)
    assert session.conf.get(INITIAL_PARTITIONS) == "7"
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if root:
        assert one.startswith(root.rstrip("/"))


def test_read_objects_lists_folders_in_tasks(spark, tmp_path):
    for name in ("a.txt", "x/b é.txt", "x/y/c.txt", "x/y/d.png", "_x/e.txt", "x/.f.txt", "x/g=1/_h.txt", "x/_i=2.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    for path in (str(tmp_path), tmp_path.as_uri(), f"{tmp_path}/"):
        found = read_objects(spark, path, "b", "*.txt")
        # The driver knows the files of the listing, not those listed.
        assert not any(name.endswith(".txt") for name in found.inputFiles())
        rows = found.collect()
        assert sorted(r.Key for r in rows) == ["a.txt", "x/_i=2.txt", "x/b é.txt", "x/y/c.txt"]
        assert all(bytes(r.content).decode() == r.Key and r.length == len(r.content) for r in rows)
        assert all(r.Bucket == "b" and r.modificationTime is not None for r in rows)
    assert [r.Key for r in read_objects(spark, f"{tmp_path}/x/*/c.txt", "b").collect()]
    (tmp_path / "empty").mkdir()
    assert read_objects(spark, str(tmp_path / "empty"), "b").count() == 0


def _run_of(df, monkeypatch, build):
    """The function that ``build`` gives to mapInArrow."""
    taken = []
    with monkeypatch.context() as patch:
        patch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
        build(df)
    return taken[0]


def test_a_batch_is_put_some_rows_at_a_time(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    df = spark.createDataFrame([("b", "k", "t")], "Bucket string, output_key string, text string")
    run = _run_of(df, monkeypatch, lambda rows: put_objects(rows, tmp_path.as_uri(), "text"))
    columns = [["b"] * 1000, [f"{i}.txt" for i in range(1000)], [b"x"] * 1000]
    batch = pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["Bucket", "output_key", "_body"])
    receipts = run(iter([batch]))
    first = next(receipts)
    assert first.num_rows == len(list((tmp_path / "b").iterdir())) == 256
    assert first.num_rows + sum(r.num_rows for r in receipts) == 1000


def test_contents_fetched_are_held_in_small_batches(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    (tmp_path / "b").mkdir()
    for i in range(40):
        (tmp_path / "b" / str(i)).write_bytes(b"x" * (1 << 20))
    df = spark.createDataFrame([("u", "b", "k")], COLUMNS)
    run = _run_of(df, monkeypatch, lambda rows: store_fetcher(tmp_path.as_uri())(rows))
    columns = [["u"] * 40, ["b"] * 40, list(map(str, range(40)))]
    batch = pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["uid", "Bucket", "Key"])
    sizes = [sum(map(len, b.column(3).to_pylist())) for b in run(iter([batch]))]
    assert sum(sizes) == 40 << 20 and max(sizes) <= 16 << 20


OBJECT_ROWS = "Bucket string, output_key string, text string"


def _disk(folder) -> tuple[int, int]:
    """Files below a folder, and the bytes of its disk that they and the folders take."""
    every = [folder, *folder.rglob("*")]
    return sum(p.is_file() for p in every), sum(p.stat().st_blocks * 512 for p in every)


def test_small_objects_in_packs_take_little_more_than_their_bytes(spark, tmp_path):
    words = [f"{i * 7919 % 10007:x}" for i in range(10007)]
    bodies = [("b", f"text/{i}/1.png", " ".join(words[i : i + 100])) for i in range(3000)]
    rows = spark.createDataFrame(bodies, OBJECT_ROWS).repartition(3)
    for _ in range(2):
        receipts = put_objects(rows, tmp_path.as_uri(), "text", packed=True).collect()
        assert sorted((r.Bucket, r.output_key, r.content_length) for r in receipts) == sorted(
            (b, k, len(t)) for b, k, t in bodies
        )
        found = read_objects(spark, str(tmp_path / "b"), "b").collect()
        # Put again, nothing doubles.
        assert sorted((r.Bucket, r.Key, bytes(r.content).decode()) for r in found) == sorted(bodies)
        assert all(r.length == len(r.content) and r.modificationTime is not None for r in found)
    files, size = _disk(tmp_path)
    assert files == 6 and size < 2 * 1.5 * sum(len(t) for _, _, t in bodies)


def test_packs_are_bounded(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("b", f"k{i}", "text") for i in range(1000)], OBJECT_ROWS).coalesce(1)
    monkeypatch.setattr("docflow.sources.packs.PACK_OBJECTS", 256)
    assert put_objects(rows, tmp_path.as_uri(), "text", packed=True).count() == 1000
    assert _disk(tmp_path)[0] == 4
    monkeypatch.setattr("docflow.sources.packs.PACK_OBJECTS", 1 << 14)
    monkeypatch.setattr("docflow.sources.packs.PACK_BYTES", 512)
    large = spark.createDataFrame([("c", f"k{i}", uuid.uuid4().hex) for i in range(1000)], OBJECT_ROWS).coalesce(1)
    assert put_objects(large, tmp_path.as_uri(), "text", packed=True).count() == 1000
    assert _disk(tmp_path / "c")[0] == 4
    monkeypatch.setattr("docflow.sources.packs.BYTES_PER_BATCH", 100)
    assert read_objects(spark, str(tmp_path / "c"), "c").select("Key", "content").distinct().count() == 1000


def test_packed_objects_are_replaced_listed_and_fetched(spark, tmp_path):
    import zipfile

    def put(bodies):
        rows = spark.createDataFrame(bodies, OBJECT_ROWS).repartition(2)
        put_objects(rows, tmp_path.as_uri(), "text", packed=True).collect()

    old = {("b", f"text/{i} é.txt"): f"old {i}" for i in range(40)} | {("c d", "x/_y.png"): "", ("c d", "x"): "folder"}
    new = {("b", f"text/{i} é.txt"): f"new {i}" for i in range(30, 50)}
    put([(*key, text) for key, text in old.items()])
    put([(*key, text) for key, text in new.items()])
    # What a task that died left behind is no pack.
    (tmp_path / "b" / "_packs" / "1-x.zip.part").write_bytes(b"PK")
    # Of two objects of one key in one put, one is kept.
    put([("b", "twice", "one"), ("b", "twice", "one")])
    whole = {**old, **new, ("b", "twice"): "one"}

    found = [r for b in ("b", "c d") for r in read_objects(spark, str(tmp_path / b), b).collect()]
    assert len(found) == len(whole)
    assert {(r.Bucket, r.Key): bytes(r.content).decode() for r in found} == whole
    listed = read_objects(spark, (tmp_path / "b").as_uri(), "b", "1*.txt").collect()
    assert {r.Key for r in listed} == {f"text/{i} é.txt" for i in (1, *range(10, 20))}
    packs = sorted((tmp_path / "c d" / "_packs").glob("*.zip"))
    assert sorted(n for p in packs for n in zipfile.ZipFile(p).namelist()) == ["x", "x/_y.png"]

    asked = [*whole, ("b", "text/50 é.txt"), ("none", "x"), ("b", ""), ("b", "../x"), ("..", "x"), (None, "x"), ("b", None)]
    sent = spark.createDataFrame([(f"u{i}", *key) for i, key in enumerate(asked)], COLUMNS)
    rows = store_fetcher(tmp_path.as_uri(), packed=True)(sent).collect()
    got = {(r.Bucket, r.Key): bytes(r.content).decode() for r in rows if r.error is None}
    assert got == whole and len(rows) == len(whole) + 5
    assert all(r.uid == f"u{asked.index((r.Bucket, r.Key))}" for r in rows)
    files = store_fetcher((tmp_path / "empty").as_uri())(sent).collect()
    assert {(r.uid, r.error) for r in rows if r.error} == {(r.uid, r.error) for r in files}


def test_a_bucket_holds_files_or_packs(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x/k", "t")], OBJECT_ROWS)
    for first in (False, True):
        base = (tmp_path / str(first)).as_uri()
        put_objects(rows, base, "text", packed=first).collect()
        with pytest.raises(Exception, match="bucket holds"):
            put_objects(rows, base, "text", packed=not first).collect()
    sent = spark.createDataFrame([("u", "b", "x/k")], COLUMNS)
    with pytest.raises(Exception, match="bucket holds packed objects"):
        store_fetcher(base)(sent).collect()
    outside = spark.createDataFrame([("b", "../../x", "t")], OBJECT_ROWS)
    with pytest.raises(Exception, match="leaves the store"):
        put_objects(outside, base, "text", packed=True).collect()


def test_stored_outputs_take_few_files(spark, tmp_path, monkeypatch):
    from docflow.plans import queries

    monkeypatch.setattr(queries, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))
    docs = [(i, "\n".join(f"line {n} of {i}" for n in range(60)), "en", f"s{i % 3}", 1) for i in range(400)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table.write.parquet(str(tmp_path / "in/documents.parquet"))
    rows = queries.stored_outputs(spark, str(tmp_path / "in")).collect()
    texts = [r for r in rows if r.output_key.startswith("text-parsed/")]
    assert len(texts) == 400 and len(rows) > 800 and len({r.output_key for r in rows}) == len(rows)
    assert all(r.content_length == len(r.body) for r in rows)
    store = tmp_path / "stream/store"
    files, size = _disk(store)
    # Before, a file of a block or more for each of the objects, and a folder for each document.
    assert files < len(rows) / 4 and size < 4096 * len(rows) / 4
