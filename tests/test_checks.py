"""Every data test must fire on bad rows and stay silent on good ones."""

from datetime import datetime

from pyspark.sql import functions as F

from tripwright.operators import checks
from tripwright.plans import chain
from tripwright.sources.trips import raw_trips

STG = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, fare_amount double,"
    " trip_distance double, payment_method string, pickup_month int"
)
NOW = datetime(2024, 1, 1)


def staging(spark, *rows):
    return spark.createDataFrame(list(rows), STG)


GOOD = (NOW, NOW, 1.0, 1.0, "cash", 1)


def test_not_null_and_accepted_fire(spark):
    stg = staging(
        spark, GOOD, (None, NOW, 1.0, 1.0, "cash", 1), (NOW, None, None, 1.0, "bitcoin", 3),
        (NOW, NOW, 1.0, None, None, None), (NOW, NOW, 1.0, 1.0, "bitcoin", 4),
    )
    assert checks.test_not_null(stg, "pickup_datetime").count() == 1
    bad = checks.test_accepted_values(stg, "payment_method", checks.ACCEPTED["payment_method"])
    assert [tuple(r) for r in bad.collect()] == [("bitcoin", 2)]
    results = {r["test"]: r["failures"] for r in checks.staging_suite(stg).collect()}
    assert results == {
        "not_null_pickup_datetime": 1,
        "not_null_dropoff_datetime": 1,
        "not_null_fare_amount": 1,
        "not_null_trip_distance": 1,
        "not_null_payment_method": 1,
        "accepted_values_payment_method": 1,
        "accepted_values_pickup_month": 2,
    }


def test_one_scan_suite_agrees_with_single_tests(spark):
    stg = staging(spark, GOOD, GOOD, (NOW, NOW, None, None, "x", 9), (NOW, NOW, None, 1.0, "y", None))
    single = {f"not_null_{c}": checks.test_not_null(stg, c) for c in checks.NOT_NULL}
    single |= {
        f"accepted_values_{c}": checks.test_accepted_values(stg, c, v) for c, v in checks.ACCEPTED.items()
    }
    assert sorted(map(tuple, checks.test_suite(single).collect())) == sorted(
        map(tuple, checks.staging_suite(stg).collect())
    )


def test_empty_staging_passes(spark):
    results = checks.staging_suite(staging(spark)).collect()
    assert len(results) == 7 and all(r["passed"] for r in results)


def test_mart_bounds(spark):
    daily = spark.createDataFrame(
        [
            (NOW, 20_000, 600_000.0, 15.0), (NOW, 184_000, 5_900_000.0, 32.0),
            (NOW, 19_999, 600_000.0, 15.0), (NOW, 20_000, 5_900_001.0, 15.0), (NOW, 20_000, 600_000.0, 32.1),
        ],
        "trip_date timestamp_ntz, total_trips bigint, total_revenue double, avg_fare double",
    )
    assert checks.test_daily_bounds(daily).count() == 3
    assert checks.test_no_future(daily).count() == 0
    assert checks.test_no_future(daily, F.lit("2023-12-31").cast("date")).count() == 5
    summary = spark.createDataFrame(
        [(1, "credit_card", 1_640_000), (1, "cash", 365_001), (2, "flex_fare", 817_999), (2, "dispute", 1), (2, None, 1)],
        "pickup_month int, payment_method string, total_trips bigint",
    )
    bad = checks.test_payment_bounds(summary)
    assert sorted(r["payment_method"] for r in bad.collect()) == ["cash", "flex_fare"]


def test_chain_writes_every_step(spark, sf_dir, tmp_path):
    raw_path, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw_trips(spark, sf_dir).write.parquet(raw_path)
    steps = {r["step"]: r for r in chain.run_pipeline(spark, raw_path, out).collect()}
    assert steps["clean_trips"]["row_count"] == spark.read.parquet(f"{out}/clean").count() > 0
    assert steps["daily_revenue"]["row_count"] == spark.table("daily_revenue").count()
    assert spark.read.parquet(steps["tests"]["path"]).count() == 10
    again = chain.run_pipeline(spark, raw_path, out)
    assert {r["step"]: r["row_count"] for r in again.collect()} == {k: v["row_count"] for k, v in steps.items()}
