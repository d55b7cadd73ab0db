"""Staging projection and the two marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.functions import scalar as S
from tripwright.operators.shares import pct_of_group

# Staging columns, in output order; payment_method stands for the code.
STAGING_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "duration_minutes",
    "trip_distance",
    "passenger_count",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "tip_pct",
    "payment_method",
    "pickup_hour",
    "pickup_day",
    "pickup_month",
)


def stg_trips(clean: DataFrame) -> DataFrame:
    """Clean trips with the payment code replaced by its label."""
    labelled = clean.withColumn("payment_method", S.label_payment(F.col("payment_type")))
    return labelled.select(*STAGING_COLUMNS)


def daily_revenue(stg: DataFrame) -> DataFrame:
    """Eight measures per pickup day."""
    days = stg.groupBy(
        S.trunc_day(F.col("pickup_datetime")).alias("trip_date"), "pickup_month", "pickup_day"
    ).agg(
        F.count("*").alias("total_trips"),
        S.money(F.sum("fare_amount")).alias("total_fare"),
        S.money(F.sum("tip_amount")).alias("total_tips"),
        S.money(F.sum("total_amount")).alias("total_revenue"),
        S.mean(F.avg("fare_amount")).alias("avg_fare"),
        S.mean(F.avg("trip_distance")).alias("avg_distance"),
        S.mean(F.avg("duration_minutes")).alias("avg_duration_mins"),
        S.mean(
            S.null_guard_ratio(F.sum("tip_amount"), F.sum("fare_amount"), 100)
        ).alias("overall_tip_pct"),
    )
    return days.orderBy("trip_date")


def payment_summary(stg: DataFrame) -> DataFrame:
    """Per month and payment method, with the method's share of the month."""
    methods = stg.groupBy("pickup_month", "payment_method").agg(
        F.count("*").alias("total_trips"),
        S.money(F.sum("fare_amount")).alias("total_fare"),
        S.mean(F.avg("tip_amount")).alias("avg_tip"),
        S.mean(
            S.null_guard_ratio(F.avg("tip_amount"), F.avg("fare_amount"), 100)
        ).alias("avg_tip_pct"),
    )
    shares = pct_of_group(methods, "total_trips", ["pickup_month"], "pct_of_monthly_trips")
    return shares.orderBy("pickup_month", F.desc("total_trips"), "payment_method")
