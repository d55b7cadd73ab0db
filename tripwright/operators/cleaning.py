"""Named cleaning rules, the clean trip projection and the rule audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions import scalar as S

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# Raw column -> clean column, in output order.
RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "total_amount": "total_amount",
}

# Payment codes kept by the first and by the later rule set.
V1 = (1, 4)
V2 = (0, 6)
MONTHS = (1, 2)


def keep_rules(payment: tuple[int, int] = V2, months: Sequence[int] | None = MONTHS) -> dict[str, Column]:
    """Rule name -> condition a kept row meets. ``months=None`` leaves that rule out."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    rules = {
        "fare": fare > 0,
        "distance": distance >= 0,
        "timestamps": F.col(PICKUP) <= F.col(DROPOFF),
        "payment": F.col("payment_type").between(*payment),
        "zero_distance_zero_fare": ~((distance == 0) & (fare <= 0)),
    }
    if months is not None:
        rules["month"] = F.month(PICKUP).isin(*months)
    return rules


def drop_rules(payment: tuple[int, int] = V1, months: Sequence[int] = MONTHS) -> dict[str, Column]:
    """Audit column -> condition of a failing row. A NULL input fails no rule."""
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    return {
        "bad_fare": fare <= 0,
        "bad_payment": ~F.col("payment_type").between(*payment),
        "zero_dist_zero_fare": (distance == 0) & (fare <= 0),
        "bad_timestamps": F.col(PICKUP) > F.col(DROPOFF),
        "wrong_month": ~F.month(PICKUP).isin(*months),
    }


def rename_project(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The raw columns under their clean names; ``keep`` passes further columns through."""
    return raw.select(*[F.col(old).alias(new) for old, new in RENAMES.items()], *keep)


def derive_tip_pct(trips: DataFrame) -> DataFrame:
    return trips.withColumn("tip_pct", S.tip_pct(F.col("tip_amount"), F.col("fare_amount")))


def derive_duration(trips: DataFrame) -> DataFrame:
    minutes = S.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.withColumn("duration_minutes", minutes)


def derive_calendar(trips: DataFrame) -> DataFrame:
    ts = F.col("pickup_datetime")
    return trips.withColumns(
        {"pickup_hour": F.hour(ts), "pickup_day": S.day_name(ts), "pickup_month": F.month(ts)}
    )


def clean_trips(
    raw: DataFrame,
    rules: tuple[int, int] = V2,
    months: Sequence[int] | None = MONTHS,
    keep: Sequence[str] = (),
    period: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows that meet every rule, renamed, with the derived columns.

    ``period`` is an optional half-open pickup range. The month rule admits any
    year and cannot reach the Parquet statistics; a plain range does.
    """
    if period is not None:
        raw = raw.filter((F.col(PICKUP) >= period[0]) & (F.col(PICKUP) < period[1]))
    kept = raw.filter(reduce(and_, keep_rules(rules, months).values()))
    return derive_calendar(derive_duration(derive_tip_pct(rename_project(kept, keep))))


def clean_preview(raw: DataFrame) -> DataFrame:
    """Row count and averages under the first rule set (no month rule)."""
    kept = raw.filter(reduce(and_, keep_rules(V1, None).values()))
    return kept.agg(
        F.count("*").alias("clean_rows"),
        S.mean(F.avg("fare_amount")).alias("avg_fare"),
        S.mean(F.avg("trip_distance")).alias("avg_distance"),
    )


def quality_audit(raw: DataFrame, rules: tuple[int, int] = V1, months: Sequence[int] = MONTHS) -> DataFrame:
    """Failing rows per rule, and rows that fail at least one, in one pass."""
    bad = drop_rules(rules, months)
    return raw.agg(
        F.count("*").alias("total_raw"),
        *[F.count_if(cond).alias(name) for name, cond in bad.items()],
        F.count_if(reduce(or_, bad.values())).alias("total_dropped"),
    )


def quality_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("fare_amount") <= 0).alias("negative_or_zero_fare"),
        F.count_if(F.col("trip_distance") == 0).alias("zero_distance"),
        F.count_if(F.col(PICKUP) > F.col(DROPOFF)).alias("dropoff_before_pickup"),
        F.count_if(F.col("passenger_count") == 0).alias("zero_passengers"),
    )
