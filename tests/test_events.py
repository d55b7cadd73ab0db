"""Pairing and interval join against brute force on small, skewed event sets."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripwright.operators import events as E

BASE = datetime(2024, 1, 1)


def make(spark, rows):
    """rows: (event type, trip id, arrival, minutes)."""
    data = [
        (
            kind, trip,
            str(BASE + timedelta(minutes=minute)) if kind == E.START else None,
            str(BASE + timedelta(minutes=minute)) if kind == E.END else None,
            arrival if kind == E.START else None,
            arrival if kind == E.END else None,
            1, 1.0, 1.0, 1, 1.0, BASE + timedelta(minutes=minute), arrival,
        )
        for kind, trip, arrival, minute in rows
    ]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in E.EVENT_SCHEMA)
    return spark.createDataFrame(data, schema + ", event_time timestamp, arrival bigint")


def brute(rows):
    """One pass in arrival order: the latest open start per id."""
    held, completed, orphans = {}, [], []
    for kind, trip, arrival, _ in sorted(rows, key=lambda r: r[2]):
        if kind == E.START:
            held[trip] = arrival
        elif kind == E.END:
            if trip in held:
                completed.append((trip, held.pop(trip), arrival))
            else:
                orphans.append((trip, arrival))
    return sorted(completed), sorted(orphans), sorted(held.items())


def skewed(n, seed):
    rng = random.Random(seed)
    kinds = (E.START, E.END, "trip_paused")
    return [
        (rng.choice(kinds), "hot" if rng.random() < 0.4 else f"t{rng.randrange(30)}", i, i * rng.choice((1, 3)))
        for i in range(n)
    ]


def check(events, rows, **opts):
    completed, orphans, _ = brute(rows)
    done = E.pair_latest_start(events, **opts).collect()
    assert sorted((r["trip_id"], r["pickup_location_id"], r["dropoff_location_id"]) for r in done) == completed
    lost = E.orphan_ends(events, **opts).join(
        events.select("trip_id", "dropoff_datetime", "arrival"), ["trip_id", "dropoff_datetime"]
    )
    assert E.orphan_ends(events, **opts).count() == len(orphans)
    assert lost.select("reason").distinct().count() <= 1


@pytest.mark.parametrize("hot_rows", [1, 2, 7, 50, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_pairing_with_and_without_slices(spark, hot_rows, seed):
    rows = skewed(600, seed)
    events = make(spark, rows)
    check(events, rows, hot_rows=hot_rows)
    completed, orphans, open_starts = brute(rows)
    health = E.health_report(events, hot_rows=hot_rows).first()
    assert tuple(health) == (len(completed), len(orphans), len(open_starts))


def test_slices_with_uneven_arrival(spark):
    rng = random.Random(5)
    arrivals = sorted(rng.sample(range(10), 8) + rng.sample(range(10**9, 2 * 10**9), 80))
    rows = [(rng.choice((E.START, E.END)), "hot", a, i) for i, a in enumerate(arrivals)]
    check(make(spark, rows), rows, hot_rows=5)


def test_slices_of_a_burst_are_even(spark):
    # one early row and a burst, and more hot ids than one
    rows = [(E.START, "hot", 0, 0)] + [(E.START, "hot", 10**9 + i, i) for i in range(1_000)]
    rows += [(E.START, f"warm{i % 9}", 10_000 + i, i) for i in range(900)] + [(E.START, "cold", 7, 1)]
    events = make(spark, rows)
    hot = E.hot_ids(events, "trip_id", "arrival", 60, slices=16)
    assert {r["hot_id"] for r in hot.collect()} == {"hot", *[f"warm{i}" for i in range(9)]}
    sizes = (
        events.join(hot, F.col("trip_id") == F.col("hot_id"))
        .groupBy("hot_id", E.slice_number(F.col("arrival"), F.col("edges"), 16))
        .count()
        .groupBy("hot_id")
        .agg(F.max("count").alias("most"), F.sum("count").alias("all"))
    )
    assert all(r["most"] <= 2 * r["all"] / 16 for r in sizes.collect())


def test_unmatched_starts(spark):
    rows = skewed(400, 3)
    found = E.unmatched_starts(make(spark, rows)).collect()
    assert sorted((r["trip_id"], r["arrival"]) for r in found) == brute(rows)[2]


def test_duplicates_and_order(spark):
    rows = [
        (E.START, "a", 1, 0), (E.START, "a", 2, 1), (E.END, "a", 3, 2), (E.END, "a", 4, 3),
        (E.END, "b", 5, 4), (E.START, "b", 6, 5), ("other", "c", 7, 6),
    ]
    events = make(spark, rows)
    (done,) = E.pair_latest_start(events).collect()
    assert (done["trip_id"], done["pickup_location_id"]) == ("a", 2)
    assert sorted(r["trip_id"] for r in E.orphan_ends(events).collect()) == ["a", "b"]
    assert [r["trip_id"] for r in E.unmatched_starts(events).collect()] == ["b"]


def test_rows_without_an_id_match_nothing(spark):
    rows = [(E.START, None, 1, 0), (E.END, None, 2, 1), (E.START, None, 3, 2), (E.START, "a", 4, 3)]
    events = make(spark, rows)
    for hot_rows in (1, 100):
        assert tuple(E.health_report(events, hot_rows=hot_rows).first()) == (0, 1, 3)
    assert sorted(r["arrival"] for r in E.unmatched_starts(events).collect()) == [1, 3, 4]


@pytest.mark.parametrize("windows", [1, 4])
def test_interval_join_gives_all_pairs_once(spark, monkeypatch, windows):
    monkeypatch.setattr(E, "SLOT_WINDOWS", windows)
    rng = random.Random(9)
    rows = [
        (rng.choice((E.START, E.END)), "hot" if rng.random() < 0.4 else f"t{rng.randrange(5)}", i, rng.randrange(2000) - 900)
        for i in range(300)
    ]
    rows += [(E.START, "edge", 1000, 480), (E.END, "edge", 1001, 600), (E.END, "edge", 1002, 601), (E.END, "edge", 1003, 480), (E.END, "edge", 1004, 479)]
    events = make(spark, rows)
    kind = F.col("event_type")
    joined = E.interval_join(events.filter(kind == E.START), events.filter(kind == E.END))
    found = sorted((r["trip_id"], r["pickup_location_id"], r["dropoff_location_id"]) for r in joined.collect())
    expected = sorted(
        (s[1], s[2], e[2])
        for s in rows
        for e in rows
        if s[0] == E.START and e[0] == E.END and s[1] == e[1] and 0 <= e[3] - s[3] <= 120
    )
    assert found == expected
    assert [f for f in found if f[0] == "edge"] == [("edge", 1000, 1001), ("edge", 1000, 1003)]


def test_interval_join_on_zone_free_time(spark):
    rows = [(E.START, "a", 1, -500), (E.END, "a", 2, -380), (E.END, "a", 3, -379)]
    events = make(spark, rows).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    kind = F.col("event_type")
    joined = E.interval_join(events.filter(kind == E.START), events.filter(kind == E.END))
    assert [r["dropoff_location_id"] for r in joined.collect()] == [2]


def test_json_round_trip_and_quarantine(spark):
    good = make(spark, [(E.START, "a", 1, 0), (E.END, "a", 2, 1)]).drop("event_time", "arrival")
    messages = E.key_value(good)
    assert "dropoff" not in messages.filter(F.col("value").contains("trip_started")).first()["value"]
    bad = spark.createDataFrame(
        [("x", '{"trip_id": "z"'), ("x", "nonsense"), ("x", '{"event_type": "trip_ended"}'), ("x", None)],
        "key string, value string",
    )
    parsed = E.json_decode(messages.unionByName(bad))
    assert parsed.filter("malformed").count() == 4
    assert parsed.filter("malformed and trip_id is not null").count() == 0
    back = parsed.filter("not malformed").select(*good.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, good.collect()))


def test_explode_fills_only_own_columns(spark, sf_dir):
    from tripwright.plans.queries import all_queries

    halves = all_queries()["explode_trip_events"](spark, sf_dir)
    starts = halves.filter(F.col("event_type") == E.START)
    assert starts.filter(F.col("fare_amount").isNotNull() | F.col("pickup_datetime").isNull()).count() == 0
    assert starts.count() * 2 == halves.count()
