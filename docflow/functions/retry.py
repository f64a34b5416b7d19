"""Retry delays in milliseconds as expressions over an attempt number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TRIES = 10
STEP_MS = 1000
# Base of the steep curve in the text and in the preview stage.
STEEP_TEXT_MS = 2000
STEEP_PREVIEW_MS = 1000
# Sums of doubles are infinite from here on, so there is nothing to add up.
INFINITE_FROM = 1476
# Delays beyond some 285,000 years end behind the last timestamp there is.
LONGEST_MS = 9.0e15
DAY_MS = 86_400_000


def wrap_attempt(attempt: Column | str, reset: bool = True, max_tries: int = MAX_TRIES) -> Column:
    """Attempt number that starts over behind ``max_tries`` (20 becomes 0)."""
    n = (F.col(attempt) if isinstance(attempt, str) else attempt).cast("bigint")
    return F.when(n > max_tries, n % max_tries).otherwise(n) if reset else n


def linear_ms(attempt: Column | str, reset: bool = True) -> Column:
    return wrap_attempt(attempt, reset) * F.lit(STEP_MS)


def fibonacci_ms(attempt: Column | str, reset: bool = True) -> Column:
    """Attempts 0, 1, 2, 3, 4 wait 1, 1, 2, 3, 5 steps; a double, infinite in the end."""
    n = wrap_attempt(attempt, reset)
    start = F.struct(F.lit(1.0).alias("now"), F.lit(1.0).alias("next"))
    term = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), n),
        start,
        lambda t, _: F.struct(t["next"].alias("now"), (t["now"] + t["next"]).alias("next")),
        lambda t: t["now"],
    )
    steps = F.when(n >= INFINITE_FROM, float("inf")).when(n >= 1, term).when(n.isNotNull(), 1.0)
    return steps * F.lit(float(STEP_MS))


def steep_ms(attempt: Column | str, reset: bool = True, base_ms: int = STEEP_TEXT_MS) -> Column:
    """Twice the attempt number times ``base_ms``."""
    return wrap_attempt(attempt, reset) * F.lit(2 * base_ms)


STRATEGIES: dict[str, Callable[..., Column]] = {
    "linear": linear_ms,
    "fibonacci": fibonacci_ms,
    "exponential": steep_ms,
}


def retry_delay_ms(attempt: Column | str, strategy: str = "linear", **options) -> Column:
    """Delay by strategy name; a name that is not known means linear."""
    chosen = STRATEGIES.get(strategy, linear_ms)
    if chosen is not steep_ms:
        options.pop("base_ms", None)
    return chosen(attempt, **options)


def delayed(at: Column | str, delay_ms: Column) -> Column:
    """Point in time ``delay_ms`` after ``at``, of its timestamp type; null where no
    timestamp is that late."""
    start = F.col(at) if isinstance(at, str) else at
    ms = F.when(delay_ms <= LONGEST_MS, delay_ms)
    days = F.floor(ms / F.lit(DAY_MS))
    seconds = ((ms - days * DAY_MS) / F.lit(1000)).cast("decimal(18,6)")
    return start + F.make_dt_interval(days=days.cast("int"), secs=seconds)
