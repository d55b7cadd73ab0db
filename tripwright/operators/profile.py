"""Profile reports over raw trips and reports over the versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.functions import scalar as S
from tripwright.operators.cleaning import PICKUP
from tripwright.operators.shares import order_single, pct_of_total


def _trips():
    return F.count("*").alias("total_trips")


def _sum(col: str, name: str):
    return S.money(F.sum(col)).alias(name)


def _avg(col: str, name: str):
    return S.mean(F.avg(col)).alias(name)


def basic_stats(raw: DataFrame) -> DataFrame:
    return raw.agg(
        _trips(),
        _avg("trip_distance", "avg_distance_miles"),
        _avg("fare_amount", "avg_fare"),
        _avg("tip_amount", "avg_tip"),
        F.min(PICKUP).alias("earliest_trip"),
        F.max(PICKUP).alias("latest_trip"),
    )


def revenue_by_weekday(raw: DataFrame) -> DataFrame:
    out = raw.groupBy(S.day_name(F.col(PICKUP)).alias("day_of_week")).agg(
        _trips(), _sum("fare_amount", "total_revenue"), _avg("fare_amount", "avg_fare")
    )
    return order_single(out, "total_revenue", "day_of_week")


def busiest_hours(raw: DataFrame) -> DataFrame:
    out = (
        raw.filter(F.col("fare_amount") > 0)
        .groupBy(F.hour(PICKUP).alias("pickup_hour"))
        .agg(_trips(), _avg("fare_amount", "avg_fare"))
    )
    return order_single(out, "total_trips", "pickup_hour")


def revenue_by_payment_raw(raw: DataFrame) -> DataFrame:
    out = raw.groupBy("payment_type").agg(_trips(), _sum("fare_amount", "total_revenue"))
    return order_single(out, "total_revenue", "payment_type")


def tip_distribution(raw: DataFrame) -> DataFrame:
    counts = (
        raw.filter((F.col("fare_amount") > 0) & (F.col("tip_amount") >= 0))
        .groupBy(S.bucket_tip(F.col("tip_amount"), F.col("fare_amount")).alias("tip_bucket"))
        .agg(_trips())
    )
    return order_single(
        pct_of_total(counts, "total_trips", "pct_of_trips"), "total_trips", "tip_bucket"
    )


def zero_distance_by_payment(raw: DataFrame) -> DataFrame:
    out = (
        raw.filter((F.col("trip_distance") == 0) & (F.col("fare_amount") > 0))
        .groupBy("payment_type")
        .agg(
            _avg("fare_amount", "avg_fare"),
            _avg("tip_amount", "avg_tip"),
            F.count("*").alias("trip_count"),
        )
    )
    return order_single(out, "trip_count", "payment_type")


def zero_distance_fares(raw: DataFrame) -> DataFrame:
    out = (
        raw.filter(F.col("trip_distance") == 0)
        .groupBy(S.bucket_fare(F.col("fare_amount")).alias("fare_bucket"))
        .agg(F.count("*").alias("trip_count"))
    )
    return order_single(out, "trip_count", "fare_bucket")


def revenue_by_payment(trips: DataFrame) -> DataFrame:
    out = trips.groupBy("payment_type").agg(
        _trips(), _sum("fare_amount", "total_revenue"), _avg("fare_amount", "avg_fare")
    )
    return order_single(out, "total_trips", "payment_type")


def top_pickups(trips: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` pickup locations with most trips; equal counts by location."""
    out = trips.groupBy("pickup_location_id").agg(_trips(), _avg("fare_amount", "avg_fare"))
    return order_single(out, "total_trips", "pickup_location_id").limit(k)
