"""Redelivery as state with timers, one state for each message and queue, many to a slot.

A queue's consumer reports an outcome for each delivery it handled: ``failed``,
``ok``, or a ``delay`` asked for by a caller. The state of a (queue, message)
holds its attempts, when it last failed, and when it becomes visible again.
Each failure counts one attempt further and hides the message for its queue's
own retry delay; an event-time timer at that moment fires the next delivery
(a ``due`` row); a ``delay`` hides a pending message for ``seconds`` from the
command on; ``ok`` ends the message, and a later failure starts again from
attempt one. Each queue has its own policy, so the same message may be done in
one queue while it is retried in another.

Time is event time in milliseconds, the watermark follows the outcomes with no
delay, and a message becomes due at ``visible_at`` if no outcome of it comes
at or before that moment. Rows of one batch are handled in their time order,
so the rows given out do not depend on how the stream is cut into batches:
they can be recomputed by SQL (see the oracle of ``stream_visibility``).

Given out, in append mode, one row for each step: ``failed``, ``due``,
``delayed``, ``ignored`` (a delay with nothing pending) and ``done``, with
the attempt it concerns, when it happened and the visibility it set.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docflow.functions.retry import MAX_TRIES, retry_delay_ms
from docflow.streaming.runner import RetryPolicy

OUTCOMES = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("seconds", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
STEPS = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("at_ms", T.LongType()),
        T.StructField("visible_ms", T.LongType()),
    ]
)
STEPS_OUT = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("visible_at", T.TimestampType()),
    ]
)
STATE = T.StructType(
    [
        T.StructField("attempts", T.IntegerType()),
        T.StructField("last_failed_ms", T.LongType()),
        T.StructField("visible_ms", T.LongType()),
    ]
)
#: Groups of the stream. A group costs far more than a message's steps, so messages share
#: groups by their hash; each keeps a state of its own there. A checkpoint keeps its number of slots.
SLOTS = 1024
#: Order of outcomes at the same moment.
KIND_ORDER = {"failed": 0, "delay": 1, "ok": 2}


def delay_table(spark: SparkSession, policies: dict[str, RetryPolicy]) -> dict[str, list[int]]:
    """Delay in ms of attempts 0 to ``MAX_TRIES`` for each queue, from the retry expressions.

    Policies that reset after ``MAX_TRIES`` repeat these; only those are accepted.
    """
    table = {}
    attempts = spark.range(MAX_TRIES + 1).select(F.col("id").alias("attempt"))
    for queue, policy in policies.items():
        if not policy.reset:
            raise ValueError(f"queue {queue}: timers need a policy whose attempts start over")
        ms = retry_delay_ms("attempt", policy.strategy, **policy.options())
        rows = attempts.select("attempt", ms.cast("long").alias("ms")).orderBy("attempt").collect()
        table[queue] = [r.ms for r in rows]
    return table


def _wrapped(attempt: int) -> int:
    return attempt % MAX_TRIES if attempt > MAX_TRIES else attempt


def _in_time(row: dict) -> tuple:
    seq = row["seq"]
    return row["at_ms"], KIND_ORDER.get(row["kind"], len(KIND_ORDER)), seq is None, seq or 0


def _stepper(delays: dict[str, list[int]], names: list[str]):
    n_keys = 2 + len(names) - len(STEPS)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Of each message of the slot: its attempts, last failure and visibility.
        held = {}
        if state.exists:
            columns = state.get
            held = dict(zip(zip(*columns[:n_keys]), zip(*columns[n_keys:])))
        out = []

        def emit(message, step_name, attempt, at_ms, visible_ms):
            queue, uid, *carried = message
            out.append((queue, uid, step_name, attempt, at_ms, visible_ms, *carried))

        came = {}
        if not state.hasTimedOut:
            # Plain values: sorting a message's few rows in pandas costs more than all the steps taken.
            keys = [*names[:2], *names[len(STEPS) :]]
            for frame in frames:
                for *message, row in zip(*(frame[k].tolist() for k in (*keys, "outcome"))):
                    came.setdefault(tuple(message), []).append(row)
        for message, rows in came.items():
            attempts, last_failed, visible = held.pop(message, (0, None, None))
            for row in sorted(rows, key=_in_time):
                at, kind = row["at_ms"], row["kind"]
                if visible is not None and visible < at:
                    emit(message, "due", attempts + 1, visible, visible)
                    visible = None
                if kind == "failed":
                    attempts += 1
                    last_failed = at
                    visible = at + delays[message[0]][_wrapped(attempts)]
                    emit(message, "failed", attempts, at, visible)
                elif kind == "ok":
                    emit(message, "done", attempts, at, None)
                    attempts, last_failed, visible = 0, None, None
                elif kind == "delay":
                    if visible is not None:
                        visible = at + 1000 * int(row["seconds"] or 0)
                        emit(message, "delayed", attempts, at, visible)
                    else:
                        emit(message, "ignored", attempts, at, None)
            came[message] = attempts, last_failed, visible
        # The slot's timer is that of its first message: others may have come due with it.
        now = state.getCurrentWatermarkMs() if held else 0
        for message, (attempts, last_failed, visible) in held.items():
            if visible is not None and visible < now:
                emit(message, "due", attempts + 1, visible, visible)
                visible = None
            came[message] = attempts, last_failed, visible
        kept = [(*m, *v) for m, v in came.items() if v[0] or v[2] is not None]
        if not kept:
            state.remove()
        else:
            state.update(tuple(map(list, zip(*kept))))
            pending = [row[-1] for row in kept if row[-1] is not None]
            if pending:
                state.setTimeoutTimestamp(max(min(pending), 1))
        if out:
            # Objects make a frame of one block; the schema given to Spark types them.
            yield pd.DataFrame(out, columns=names, dtype=object)

    return step


def visibility_steps(outcomes: DataFrame, policies: dict[str, RetryPolicy], carry: Sequence[str] = ()) -> DataFrame:
    """Steps of every (queue, uid) of a stream of ``OUTCOMES``; queues without a policy are linear.

    ``carry`` names columns that belong to a message, such as its object: they are
    part of its key and given out with each step. Rows of a kind other than the
    three only move time on.
    """
    spark = outcomes.sparkSession
    carried = [outcomes.schema[c] for c in carry]
    schema = T.StructType([*STEPS.fields, *carried])
    message = ["queue", "uid", *carry]
    state = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in (*STEPS[:2], *carried, *STATE)])
    delays = _DefaultDelays(delay_table(spark, policies), delay_table(spark, {"": RetryPolicy("linear")})[""])
    # Milliseconds as numbers: the timers' unit, free of any time zone.
    timed = outcomes.select(
        F.coalesce("queue", F.lit("")).alias("queue"),
        F.coalesce("uid", F.lit("")).alias("uid"),
        F.timestamp_millis(F.unix_millis("at")).alias("at"),
        # One column: its missing numbers stay apart from its numbers.
        F.struct(F.unix_millis("at").alias("at_ms"), "kind", "seconds", "seq").alias("outcome"),
        *carry,
    ).where(F.col("at").isNotNull())
    steps = (
        timed.withColumn("_slot", F.pmod(F.xxhash64(*message), F.lit(SLOTS)))
        .withWatermark("at", "0 seconds")
        .groupBy("_slot")
        .applyInPandasWithState(
            _stepper(delays, schema.fieldNames()), schema, state, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
    return steps.select(
        "queue",
        "uid",
        "step",
        "attempt",
        F.timestamp_millis("at_ms").alias("at"),
        F.timestamp_millis("visible_ms").alias("visible_at"),
        *carry,
    )


class _DefaultDelays(dict):
    """Delays by queue, linear for a queue without a policy."""

    def __init__(self, known: dict[str, list[int]], fallback: list[int]):
        super().__init__(known)
        self.fallback = fallback

    def __missing__(self, queue: str) -> list[int]:
        return self.fallback


def epoch_ms(df: DataFrame, name: str):
    """Milliseconds since 1970 of a timestamp column; one without time zone counts as UTC."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(name))
    return F.unix_millis(F.col(name))


def ranges_in_time(outcomes: DataFrame, folder: str, ranges: int) -> int:
    """Write outcomes as ``ranges`` files, each later in time than the one before.

    A file stream that takes one file a batch then sees every outcome in time
    order, and nothing comes behind the watermark. Returns the number of files.
    """
    spark = outcomes.sparkSession
    staged = f"{folder}_staged/{uuid.uuid4().hex}"
    outcomes.repartitionByRange(ranges, "at", "seq").withColumn("_range", F.spark_partition_id()).write.partitionBy(
        "_range"
    ).parquet(staged)
    found = sorted(r[0] for r in spark.read.parquet(staged).select("_range").distinct().collect())
    for part in found:
        # One range at a time, so that file times follow event times.
        spark.read.parquet(staged).where(F.col("_range") == part).drop("_range").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
    return len(found)


# Workers need not have this package: the state function goes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
