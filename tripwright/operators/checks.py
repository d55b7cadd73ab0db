"""Data tests. A test gives the failing rows; none means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that may not be NULL, and accepted values per column.
NOT_NULL = ("pickup_datetime", "dropoff_datetime", "fare_amount", "trip_distance", "payment_method")
ACCEPTED = {
    "payment_method": (
        "flex_fare",
        "credit_card",
        "cash",
        "no_charge",
        "dispute",
        "unknown",
        "voided",
    ),
    "pickup_month": (1, 2),
}

# Allowed range per daily measure, and of trips per month and method.
DAILY_BOUNDS = {
    "total_trips": (20_000, 184_000),
    "total_revenue": (600_000, 5_900_000),
    "avg_fare": (15, 32),
}
PAYMENT_BOUNDS = {
    "credit_card": (1_640_000, 2_700_000),
    "flex_fare": (818_000, 1_305_000),
    "cash": (213_000, 365_000),
}

Bounds = Mapping[str, tuple[float, float]]


def _outside(col: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return (col < low) | (col > high)


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts. NULL passes."""
    bad = df.filter(~F.col(column).isin(*values))
    return bad.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def test_daily_bounds(daily: DataFrame, bounds: Bounds = DAILY_BOUNDS) -> DataFrame:
    bad = reduce(or_, [_outside(F.col(name), limits) for name, limits in bounds.items()])
    return daily.filter(bad).select("trip_date", "total_trips", "total_revenue", "avg_fare")


def test_no_future(daily: DataFrame, today: Column | None = None) -> DataFrame:
    limit = F.current_date() if today is None else today
    return daily.filter(F.col("trip_date") > limit).select("trip_date", "total_trips")


def test_payment_bounds(summary: DataFrame, bounds: Bounds = PAYMENT_BOUNDS) -> DataFrame:
    trips, method = F.col("total_trips"), F.col("payment_method")
    bad = reduce(
        or_, [(method == name) & _outside(trips, limits) for name, limits in bounds.items()]
    )
    return summary.filter(bad).select("pickup_month", "payment_method", "total_trips")


def test_suite(tests: Mapping[str, DataFrame]) -> DataFrame:
    """One row per test: failing rows, and whether it passed."""
    counted = [
        failing.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures")
        for name, failing in tests.items()
    ]
    rows = reduce(DataFrame.unionByName, counted)
    return rows.withColumn("passed", F.col("failures") == 0)


def staging_suite(
    stg: DataFrame,
    not_null: Sequence[str] = NOT_NULL,
    accepted: Mapping[str, Sequence] = ACCEPTED,
) -> DataFrame:
    """All column tests of the staging model in one scan, instead of one scan per test.

    Rows collapse to one per combination of the value-tested columns, before
    the shuffle, and every test reads that small aggregate.
    """
    groups = stg.groupBy(*accepted).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    )
    results = [
        (f"not_null_{c}", F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"not_null_{c}"))
        for c in not_null
    ]
    for c, values in accepted.items():
        bad = F.when(~F.col(c).isin(*values), F.col(c))
        results.append((f"accepted_values_{c}", F.count_distinct(bad).alias(f"accepted_values_{c}")))
    one = groups.agg(*[col for _, col in results])
    rows = F.inline(
        F.array(
            *[
                F.struct(F.lit(n).alias("test"), F.col(n).cast("bigint").alias("failures"))
                for n, _ in results
            ]
        )
    )
    return one.select(rows).withColumn("passed", F.col("failures") == 0)
