"""Column builders: labels, buckets, durations, rounding, keys and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payment codes and their labels.
PAYMENT_LABELS = {
    0: "flex_fare",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided",
}

# Day names by weekday number, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Tip buckets as (upper share, label), fare buckets as (upper fare, label).
TIP_BUCKETS = ((0.10, "Under 10%"), (0.20, "10-20%"), (0.30, "20-30%"))
NO_TIP, TOP_TIP = "No tip", "Over 30%"
FARE_BUCKETS = ((5, "under $5"), (20, "$5-$20"))
NO_FARE, TOP_FARE = "zero/negative", "over $20"


def money(total: Column) -> Column:
    """A sum rounded to cents.

    A double sum depends on the order its partial sums meet, so a value that
    lies on a half cent may fall to either side. Rounding to four places first
    drops that noise, and runs with different partitions agree.
    """
    return F.round(F.round(total, 4), 2)


def mean(value: Column) -> Column:
    """An average or a ratio of sums rounded to cents, with the noise dropped likewise."""
    return F.round(F.round(value, 7), 2)


def label_payment(code: Column) -> Column:
    """Payment label; NULL for a code without one."""
    out = F  # F.when starts the chain, Column.when extends it
    for value, label in PAYMENT_LABELS.items():
        out = out.when(code == value, label)
    return out


def bucket_tip(tip: Column, fare: Column) -> Column:
    """Tip share of the fare in five labels; callers keep only fare > 0."""
    share = tip / F.nullif(fare, F.lit(0.0))
    out = F.when(tip == 0, NO_TIP)
    for upper, label in TIP_BUCKETS:
        out = out.when(share < upper, label)
    return out.otherwise(TOP_TIP)


def bucket_fare(fare: Column) -> Column:
    """Fare in four labels."""
    out = F.when(fare <= 0, NO_FARE)
    for upper, label in FARE_BUCKETS:
        out = out.when(fare < upper, label)
    return out.otherwise(TOP_FARE)


def tip_pct(tip: Column, fare: Column) -> Column:
    return F.round(tip / F.nullif(fare, F.lit(0.0)) * 100, 2)


def duration_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes between two timestamps, independent of the session zone."""
    return seconds_between(start, end) / 60


def seconds_between(start: Column, end: Column) -> Column:
    span = (end - start).cast("interval second")
    return span.cast("decimal(20,6)").cast("double")


def day_name(ts: Column) -> Column:
    """Full English day name. A lookup by number, far cheaper per row than formatting."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(ts) + 1)


def trunc_day(ts: Column) -> Column:
    """Midnight of the day as a zone-free timestamp."""
    return ts.cast("date").cast("timestamp_ntz")


def null_guard_ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``part / whole * scale``; NULL where ``whole`` is 0."""
    return part / F.nullif(whole, F.lit(0.0)) * scale


def epoch_slot(df: DataFrame, ts: str, width_s: int, shift_s: int = 0) -> Column:
    """Number of the ``width_s`` second slot that holds ``ts`` moved back by ``shift_s``."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz" if ntz else "timestamp")
    seconds = (F.col(ts) - origin).cast("interval second").cast("bigint")
    return F.floor((seconds - shift_s) / width_s)


def random_id() -> Column:
    """A random UUID per row; a re-run task gives other values."""
    return F.uuid()


def key_id(*cols: str) -> Column:
    """An id that repeats on every run: hash of the row's key columns."""
    return F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in cols]))


def ts_to_string(ts: Column) -> Column:
    return ts.cast("string")


def to_whole(df: DataFrame, name: str, dtype: str) -> Column:
    """Cast to an integer type, rounding fractions half to even instead of cutting them."""
    fractional = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    source = F.rint(F.col(name)) if fractional else F.col(name)
    return source.cast(dtype)


def text_preview(text: Column, length: int = 100) -> Column:
    return F.substring(text, 1, length)
