"""The whole chain: clean, stage, build the marts, test them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import checks
from tripwright.operators.cleaning import clean_trips
from tripwright.operators.sinks import materialize, sink_partitioned
from tripwright.plans.marts import daily_revenue, payment_summary, stg_trips
from tripwright.sources.files import scan_partitioned, scan_raw


def all_tests(
    stg: DataFrame,
    daily: DataFrame,
    summary: DataFrame,
    daily_bounds: checks.Bounds = checks.DAILY_BOUNDS,
    payment_bounds: checks.Bounds = checks.PAYMENT_BOUNDS,
    today=None,
) -> DataFrame:
    """The ten tests: seven on staging columns in one scan, three on the small marts."""
    marts = checks.test_suite(
        {
            "daily_revenue_reasonable": checks.test_daily_bounds(daily, daily_bounds),
            "no_future_trips": checks.test_no_future(daily, today),
            "payment_distribution_reasonable": checks.test_payment_bounds(summary, payment_bounds),
        }
    )
    return checks.staging_suite(stg).unionByName(marts)


def run_pipeline(spark: SparkSession, raw: str | DataFrame, out_dir: str) -> DataFrame:
    """Runs every step below ``out_dir``; one row per step with its row count and path.

    ``raw`` is a path or a frame. Steps: ``clean_trips``, ``stg_trips`` (a
    view), ``daily_revenue`` and ``payment_summary`` (tables), ``tests`` (the
    results table; its count is the number of failing tests).
    """
    trips = scan_raw(spark, raw) if isinstance(raw, str) else raw
    clean_dir = f"{out_dir}/clean"
    clean_rows = sink_partitioned(clean_trips(trips), clean_dir, balance=True)
    stg = materialize(stg_trips(scan_partitioned(spark, clean_dir)), "stg_trips")
    steps = [("clean_trips", clean_rows, clean_dir), ("stg_trips", clean_rows, clean_dir)]
    marts = {}
    for name, build in (("daily_revenue", daily_revenue), ("payment_summary", payment_summary)):
        path = f"{out_dir}/{name}"
        marts[name] = materialize(build(stg), name, "table", path)
        steps.append((name, marts[name].count(), path))
    path = f"{out_dir}/tests"
    results = all_tests(stg, marts["daily_revenue"], marts["payment_summary"])
    failing = materialize(results, "test_results", "table", path).filter(~F.col("passed"))
    steps.append(("tests", failing.count(), path))
    return spark.createDataFrame(steps, "step string, row_count bigint, path string")
