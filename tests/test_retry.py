from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docflow.functions import retry
from docflow.operators.ledger import due, number_attempts, push_back, schedule

ATTEMPTS = [0, 1, 2, 3, 4, 9, 10, 11, 19, 20, 21]


def delays(spark, strategy, attempts=ATTEMPTS, **options):
    df = spark.createDataFrame([(a,) for a in attempts], "attempt long").coalesce(1)
    return [r.ms for r in df.select(retry.retry_delay_ms("attempt", strategy, **options).alias("ms")).collect()]


def wrap(n):
    return n % 10 if n > 10 else n


def fibonacci(n):
    a, b = 1.0, 1.0
    for _ in range(n):
        a, b = b, a + b
    return a


def test_linear(spark):
    assert delays(spark, "linear") == [wrap(n) * 1000 for n in ATTEMPTS]
    assert delays(spark, "linear", [11], reset=False) == [11000]


def test_fibonacci(spark):
    assert delays(spark, "fibonacci") == [fibonacci(wrap(n)) * 1000 for n in ATTEMPTS]
    assert delays(spark, "fibonacci", [0, 1, 2, 3, 4]) == [1000, 1000, 2000, 3000, 5000]
    tries = [11, 58, 59, 77, 78, 200, 1400]
    assert delays(spark, "fibonacci", tries, reset=False) == [fibonacci(n) * 1000.0 for n in tries]
    assert delays(spark, "fibonacci", [1476, 10**12], reset=False) == [float("inf")] * 2
    assert delays(spark, "fibonacci", [None], reset=False) == [None]


def test_schedule_never_fails(spark):
    at = datetime(2024, 1, 1)
    tries = [57, 58, 59, 60, 77, 78, 200, 1500]
    rows = [(n, "x", at) for n in tries]
    df = spark.createDataFrame(rows, "attempt long, reason string, last_attempt_at timestamp_ntz")
    planned = schedule(df, "last_attempt_at", "fibonacci", reset=False)
    got = {r.attempt: (r.late, r.reason) for r in planned.selectExpr(
        "attempt", "next_attempt_at > timestamp_ntz'9000-01-01' AS late", "reason").collect()}
    assert set(got) == set(tries)
    assert got[57] == got[59] == (True, "x")
    assert got[78][0] is None and got[1500][0] is None and got[78][1].startswith("x; ")


@pytest.mark.parametrize("base", [2000, 1000])
def test_steep(spark, base):
    assert delays(spark, "exponential", base_ms=base) == [2 * wrap(n) * base for n in ATTEMPTS]


def test_unknown_strategy_is_linear(spark):
    assert delays(spark, "no such thing", [3], base_ms=2000) == [3000]


@pytest.mark.parametrize(
    ("hot_rows", "max_hot_keys"), [(10**6, 10), (500, 10), (100, 100), (100, 1), (0, 0)]
)
@pytest.mark.parametrize("grain", ["minute", "day"])
def test_attempt_numbers(spark, grain, hot_rows, max_hot_keys):
    start = datetime(2024, 1, 1)
    # One key holds a third of the rows; some times are equal, some are missing.
    rows = [
        (i, None if i % 97 == 0 else (0 if i % 3 == 0 else i % 20 + 1), None if i % 83 == 0 else start + timedelta(minutes=(i * 37) % 5000 // 4))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id long, key long, at timestamp_ntz").repartition(7)
    numbered = number_attempts(df, ["key"], "at", ["id"], hot_rows, max_hot_keys, grain)
    got = {r.id: r.attempt for r in numbered.collect()}
    by_key = {}
    for i, key, at in rows:
        by_key.setdefault(key, []).append((at is not None, at or start, i))
    want = {i: n + 1 for entries in by_key.values() for n, (_, _, i) in enumerate(sorted(entries))}
    assert got == want


def test_schedule_and_due(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, at), (5, at)], "attempt long, last_attempt_at timestamp_ntz")
    planned = schedule(df, "last_attempt_at", "fibonacci")
    assert [r.next_attempt_at for r in planned.orderBy("attempt").collect()] == [
        at + timedelta(seconds=1),
        at + timedelta(seconds=8),
    ]
    edge = F.lit("2024-01-01 00:00:01").cast("timestamp_ntz")
    assert [r.attempt for r in due(planned, edge).collect()] == [1]
    later = push_back(planned, 30).first()
    assert later.next_attempt_at == at + timedelta(seconds=30)
