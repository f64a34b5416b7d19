"""Visibility timers: equal to SQL on close events, whatever the batches, and after a restart."""

from __future__ import annotations

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from docflow.plans import queries
from docflow.plans.oracles import ORACLES
from docflow.streaming import visibility
from docflow.streaming.runner import RetryPolicy

T0 = datetime(2024, 3, 1, 12, 0, 0)


def _events():
    """Events seconds apart, so that delays find messages still hidden."""
    rows = []

    def add(user, seconds, kind):
        rows.append((len(rows), T0 + timedelta(seconds=seconds), user, kind, 1.0, "{}"))

    # Previews: fail, keep back while hidden, fail again while held, then succeed.
    add(1, 0.0, "error")
    add(1, 1.0, "purchase")
    add(1, 2.5, "purchase")
    add(1, 4000.0, "view")
    add(1, 4000.5, "click")
    # A delay after the message came due is ignored; one before any failure too.
    add(2, 0.0, "purchase")
    add(2, 10.0, "view")
    add(2, 20.0, "purchase")
    # Twelve failures in a row: attempts go past the reset.
    for k in range(12):
        add(3, 100.0 + 0.5 * k, "error")
    add(3, 500.0, "signup")
    # Ties of time within one user, and a user whose last failure stays pending.
    add(4, 50.0, "error")
    add(4, 50.0, "view")
    add(4, 50.0, "click")
    add(5, 5000.0, "error")
    # A hot user: a third of all rows.
    for k in range(30):
        add(6, 200.0 + 7.0 * k, ("error", "view", "purchase", "click")[k % 4])
    return rows


@pytest.fixture()
def events_dir(spark, tmp_path):
    df = spark.createDataFrame(
        _events(), "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )
    df.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def _oracle(events_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{events_dir}/events.parquet'")
    return sorted(con.sql(ORACLES["stream_visibility"]).fetchall(), key=str)


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_equal_to_sql_whatever_the_batches(spark, events_dir, monkeypatch, batches):
    monkeypatch.setattr(queries, "MICRO_BATCHES", batches)
    got = sorted((tuple(r) for r in queries.stream_visibility(spark, events_dir).collect()), key=str)
    want = _oracle(events_dir)
    assert got == want
    steps = {r[2] for r in want}
    assert steps == {"failed", "due", "delayed", "ignored", "done"}
    # Only previews are held back for user 1; text has its own attempts.
    mine = [r for r in want if r[1] == "1"]
    assert any(r[0] == "file-stream-images" and r[2] == "delayed" for r in mine)
    assert not any(r[0] == "file-stream-text" and r[2] == "delayed" for r in want)
    assert max(r[3] for r in want if r[1] == "3" and r[2] == "failed") == 12


@pytest.mark.parametrize("slots", [1, 3])
def test_messages_that_share_a_slot_keep_their_own_timers(spark, events_dir, monkeypatch, slots):
    """All messages in few groups: what one does or misses changes nothing for the others."""
    monkeypatch.setattr(queries, "MICRO_BATCHES", 8)
    monkeypatch.setattr(visibility, "SLOTS", slots)
    got = sorted((tuple(r) for r in queries.stream_visibility(spark, events_dir).collect()), key=str)
    assert got == _oracle(events_dir)


def test_restart_from_checkpoint(spark, tmp_path):
    """Half the outcomes, stop, the rest with the same checkpoint: as one run."""
    policies = {"q": RetryPolicy("linear")}
    rows = [("q", "m", T0 + timedelta(seconds=s), k, None, i) for i, (s, k) in enumerate(
        [(0, "failed"), (0.5, "failed"), (10, "failed"), (10.2, "ok"), (20, "failed"), (40, "failed"), (41, "ok")]
    )]
    rows += [("q", "n", T0 + timedelta(seconds=s), "failed", None, 100 + i) for i, s in enumerate([1, 30])]
    df = spark.createDataFrame(rows, visibility.OUTCOMES)

    def run(work, parts):
        for part in parts:
            visibility.ranges_in_time(df.where(F.col("seq").isin(part)), f"{work}/inbox", 1)
            stream = spark.readStream.schema(visibility.OUTCOMES).option("maxFilesPerTrigger", 1).parquet(f"{work}/inbox")
            visibility.visibility_steps(stream, policies).writeStream.format("parquet").option(
                "checkpointLocation", f"{work}/cp"
            ).trigger(availableNow=True).start(f"{work}/out").awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{work}/out").collect())

    first = [0, 1, 2, 100]
    once = run(str(tmp_path / "a"), [list(range(7)) + [100, 101]])
    twice = run(str(tmp_path / "b"), [first, [3, 4, 5, 6, 101]])
    assert once == twice
    steps = [(r[2], r[3]) for r in once if r[1] == "m"]
    assert steps.count(("failed", 1)) == 2 and ("done", 3) in steps and ("done", 2) in steps
    # Linear delays: attempt 1 waits one second, so the retry at 0.5 s comes before it is due.
    assert ("due", 2) in steps


def test_delays_come_from_the_retry_expressions(spark):
    table = visibility.delay_table(spark, {"a": RetryPolicy("exponential", 1000), "b": RetryPolicy("fibonacci")})
    assert table["a"][:4] == [0, 2000, 4000, 6000]
    assert table["b"][:6] == [1000, 1000, 2000, 3000, 5000, 8000]
    with pytest.raises(ValueError):
        visibility.delay_table(spark, {"c": RetryPolicy("linear", reset=False)})


def test_a_group_of_few_rows_costs_less_than_one_sort_in_pandas():
    """A stream has as many groups as messages: what one costs decides how long it takes."""
    import time

    import pandas as pd

    class State:
        exists, hasTimedOut = False, False

        def update(self, value):
            self.value = value

        remove = setTimeoutTimestamp = lambda self, *_: None

    def best(run):
        times = []
        for _ in range(200):
            began = time.perf_counter()
            run()
            times.append(time.perf_counter() - began)
        return min(times)

    kinds = ["failed", "delay", "ok", "failed", None, "delay"]
    rows = [{"at_ms": 1000 - k, "kind": kind, "seconds": None, "seq": k} for k, kind in enumerate(kinds)]
    frame = pd.DataFrame({"queue": "q", "uid": "1", "outcome": rows}).join(pd.DataFrame(rows))
    step = visibility._stepper({"q": [10] * 20}, visibility.STEPS.fieldNames())
    (out,) = step(("q", "1"), iter([frame]), State())
    assert out["step"].tolist() == ["ignored", "failed", "done", "ignored", "failed"]
    spent = best(lambda: list(step(("q", "1"), iter([frame]), State())))
    assert spent < best(lambda: frame[["at_ms", "seq"]].assign(kind=1).sort_values(["at_ms", "kind", "seq"]))
