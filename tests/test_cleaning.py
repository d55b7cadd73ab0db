"""Edge frames for the cleaning rules, the derived columns and the labels."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripwright.functions import scalar as S
from tripwright.operators import cleaning, profile, shares
from tripwright.plans import marts
from tripwright.sources.lake import cast_table_schema
from tripwright.sources.trips import spread

RAW = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count bigint,"
    " trip_distance double, PULocationID int, DOLocationID int, payment_type bigint,"
    " fare_amount double, tip_amount double, tolls_amount double, total_amount double"
)


def trip(**changes):
    row = dict(
        up=datetime(2024, 1, 5, 8, 0),
        down=datetime(2024, 1, 5, 8, 30),
        passengers=1,
        distance=2.0,
        payment=1,
        fare=10.0,
        tip=2.0,
    )
    row |= changes
    return (
        row["up"], row["down"], row["passengers"], row["distance"], 1, 2,
        row["payment"], row["fare"], row["tip"], 0.0, 12.0,
    )


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


@pytest.mark.parametrize(
    "changes",
    [
        {"fare": 0.0},
        {"fare": -1.0},
        {"fare": None},
        {"distance": -0.1},
        {"distance": None},
        {"down": datetime(2024, 1, 5, 7, 59)},
        {"payment": 7},
        {"payment": -1},
        {"payment": None},
        {"up": datetime(2024, 3, 1), "down": datetime(2024, 3, 2)},
        {"distance": 0.0, "fare": 0.0},
    ],
)
def test_each_rule_drops(spark, changes):
    assert cleaning.clean_trips(frame(spark, trip(**changes))).count() == 0


def test_kept_edges(spark):
    rows = [
        trip(distance=0.0),
        trip(down=datetime(2024, 1, 5, 8, 0)),
        trip(payment=0),
        trip(payment=6),
        trip(passengers=None),
        trip(up=datetime(1999, 2, 1), down=datetime(1999, 2, 1)),
    ]
    assert cleaning.clean_trips(frame(spark, *rows)).count() == len(rows)


def test_rule_versions(spark):
    raw = frame(spark, trip(payment=0), trip(payment=4), trip(payment=5))
    assert cleaning.clean_trips(raw, rules=cleaning.V1).count() == 1
    assert cleaning.clean_trips(raw, rules=cleaning.V2).count() == 3
    march = frame(spark, trip(up=datetime(2024, 3, 1), down=datetime(2024, 3, 1)))
    assert cleaning.clean_preview(march).first()["clean_rows"] == 1
    assert cleaning.clean_trips(march, months=None).count() == 1


def test_period_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, trip(), trip(up=datetime(2025, 1, 1), down=datetime(2025, 1, 1))).write.parquet(path)
    clean = cleaning.clean_trips(spark.read.parquet(path), period=("2024-01-01", "2025-01-01"))
    assert clean.count() == 1
    length = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
        plan = clean._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", length)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01" in plan


def test_audit_does_not_count_nulls(spark):
    raw = frame(spark, trip(fare=None), trip(payment=None), trip(fare=-1.0), trip())
    audit = cleaning.quality_audit(raw).first()
    assert (audit["total_raw"], audit["bad_fare"], audit["total_dropped"]) == (4, 1, 1)
    assert cleaning.clean_trips(raw).count() == 1


def test_derived_columns(spark):
    raw = frame(
        spark,
        trip(up=datetime(2024, 1, 5, 8, 0, 0, 250000), down=datetime(2024, 1, 5, 8, 1, 31), tip=1.0, fare=3.0),
    )
    row = cleaning.clean_trips(raw).first()
    assert row["duration_minutes"] == pytest.approx(90.75 / 60)
    assert row["tip_pct"] == 33.33
    assert (row["pickup_hour"], row["pickup_day"], row["pickup_month"]) == (8, "Friday", 1)


def test_duration_ignores_the_session_zone(spark):
    raw = frame(spark, trip(up=datetime(2024, 3, 31, 0, 30), down=datetime(2024, 3, 31, 4, 30)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        row = cleaning.clean_trips(raw, months=None).withColumn(
            "day", S.trunc_day(F.col("pickup_datetime"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["duration_minutes"] == 240.0
    assert row["day"] == datetime(2024, 3, 31)


def test_all_day_names(spark):
    days = spark.range(14).select(
        F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id as int))").alias("ts")
    )
    both = days.select(S.day_name(F.col("ts")).alias("a"), F.date_format("ts", "EEEE").alias("b"))
    assert both.filter("a <> b").count() == 0


def test_labels_and_buckets(spark):
    codes = spark.createDataFrame([(c,) for c in (0, 6, 7, None)], "code int")
    assert [r[0] for r in codes.select(S.label_payment(F.col("code"))).collect()] == [
        "flex_fare", "voided", None, None,
    ]
    tips = spark.createDataFrame([(t,) for t in (0.0, 0.9, 1.0, 2.0, 3.0)], "tip double")
    assert [r[0] for r in tips.select(S.bucket_tip(F.col("tip"), F.lit(10.0))).collect()] == [
        "No tip", "Under 10%", "10-20%", "20-30%", "Over 30%",
    ]
    fares = spark.createDataFrame([(t,) for t in (-1.0, 0.0, 4.99, 5.0, 20.0)], "fare double")
    assert [r[0] for r in fares.select(S.bucket_fare(F.col("fare"))).collect()] == [
        "zero/negative", "zero/negative", "under $5", "$5-$20", "over $20",
    ]


def test_unknown_payment_stays_null_in_staging(spark):
    clean = cleaning.clean_trips(frame(spark, trip(payment=9)), rules=(0, 9))
    assert marts.stg_trips(clean).first()["payment_method"] is None


def test_whole_numbers_round_half_to_even(spark):
    names = ["trip_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
             "passenger_count", "fare_amount", "tip_amount", "payment_type", "trip_distance"]
    rows = [("a", "x", "y", 1, 2, p, 1.0, 1.0, 1, 1.0) for p in (2.5, 3.5, 1.7)]
    cast = cast_table_schema(spark.createDataFrame(rows, names))
    assert [r["passenger_count"] for r in cast.collect()] == [2, 4, 2]


def test_ratio_guard_and_empty_input(spark):
    empty = frame(spark)
    assert cleaning.quality_audit(empty).first()["total_dropped"] == 0
    assert marts.daily_revenue(marts.stg_trips(cleaning.clean_trips(empty))).count() == 0
    assert profile.tip_distribution(empty).count() == 0
    zero = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert zero.agg(S.null_guard_ratio(F.sum("a"), F.sum("b"), 100)).first()[0] is None


def test_share_of_total_needs_no_keyless_window(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    out = shares.pct_of_total(counts, "n")
    assert sum(r["pct"] for r in out.collect()) == pytest.approx(100, abs=0.05)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_spread_leaves_many_splits_alone(spark):
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=64)
    assert spread(few, "id").rdd.getNumPartitions() == 8
    assert spread(many, "id") is many
