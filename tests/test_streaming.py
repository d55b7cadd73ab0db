"""Streams over several files against the batch form."""

from datetime import datetime

from pyspark import TaskContext
from pyspark.sql import functions as F

from tests.test_events import brute, make, skewed
from tripwright.operators import events as E
from tripwright.sources import stream
from tripwright.sources.trips import write_in_order
from tripwright.streaming import joins, pairing, progress
from tripwright.streaming import sinks as S


def stream_of(spark, rows, folder, parts=4):
    """The rows as files in arrival order, one file per micro-batch."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = make(spark, rows[i * size : (i + 1) * size]).coalesce(1)
        part.write.mode("append").parquet(folder)
    return spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def pairs_of(rows):
    return sorted((r["trip_id"], r["pickup_location_id"], r["dropoff_location_id"]) for r in rows)


def test_sliced_pairing_over_batches(spark, tmp_path):
    rows = skewed(400, 11)
    completed, orphans, open_starts = brute(rows)
    out = str(tmp_path / "out")
    events = stream_of(spark, rows, str(tmp_path / "in"))
    pairing.stream_pairing_sink(events, out, hot_rows=9, max_records=20).awaitTermination()
    assert pairs_of(spark.read.parquet(f"{out}/completed").collect()) == completed
    assert spark.read.parquet(f"{out}/orphan").count() == len(orphans)
    assert spark.read.parquet(f"{out}/health").count() == 4
    assert tuple(pairing.read_health(spark, out).first()) == (len(completed), len(orphans), len(open_starts))


def test_sliced_pairing_goes_on_after_a_stop(spark, tmp_path):
    rows = skewed(300, 12)
    out, folder = str(tmp_path / "out"), str(tmp_path / "in")
    pairing.stream_pairing_sink(stream_of(spark, rows[:150], folder, 2), out).awaitTermination()
    pairing.stream_pairing_sink(stream_of(spark, rows[150:], folder, 2), out).awaitTermination()
    assert pairs_of(spark.read.parquet(f"{out}/completed").collect()) == brute(rows)[0]


def test_expiry(spark, tmp_path):
    rows = [(E.START, "late", 0, 0), (E.START, "lost", 1, 1), (E.START, "ok", 2, 60),
            (E.END, "ok", 3, 120), (E.END, "late", 4, 121), (E.START, "new", 5, 130)]
    for parts in (1, 2, 3, 6):
        out = str(tmp_path / f"out{parts}")
        events = stream_of(spark, rows, str(tmp_path / f"in{parts}"), parts)
        pairing.stream_pairing_sink(events, out, ttl="2 hours").awaitTermination()
        done = spark.read.parquet(f"{out}/completed").collect()
        assert [r["trip_id"] for r in done] == ["ok"]
        assert [r["trip_id"] for r in spark.read.parquet(f"{out}/orphan").collect()] == ["late"]
        expired = [r["trip_id"] for r in spark.read.parquet(f"{out}/expired").collect()]
        assert sorted(expired) == ["late", "lost"]
        assert pairing.read_health(spark, out).first()["unmatched_starts"] == 1


def test_printing_hands_on_the_first_rows_of_each_task_and_counts_all(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(0, 5000, 1, 4).write.parquet(folder)
    totals = progress.ProgressTotals("printed_test")
    spark.streams.addListener(totals)
    try:
        rows = spark.readStream.schema("id bigint").parquet(folder)
        shown = S.stream_print_sink(progress.counted(rows, "printed_test"), {"numrows": "2"})
        assert totals.of(shown) == {"rows": 5000}
    finally:
        spark.streams.removeListener(totals)
    assert sum(p.sink.numOutputRows for p in shown.recentProgress) <= 4 * 3


def test_keyed_state_pairing(spark, tmp_path):
    rows = skewed(400, 13)
    completed, orphans, open_starts = brute(rows)
    events = stream_of(spark, rows, str(tmp_path / "in"), 2)
    paired = pairing.stream_health(pairing.stream_pairing(events))
    dirs = [str(tmp_path / d) for d in ("completed", "orphan", "checkpoint")]
    query = S.stream_batch_sink(paired, *dirs, max_records=1000)
    query.awaitTermination()
    assert pairs_of(spark.read.parquet(dirs[0]).collect()) == completed
    assert spark.read.parquet(dirs[1]).count() == len(orphans)
    assert pairing.observed_health(query) == {
        "completed_trips": len(completed),
        "orphaned_ends": len(orphans),
        "unmatched_starts": len(open_starts),
    }


def test_keyed_state_keeps_values(spark, tmp_path):
    schema = "event_type string, trip_id string, pickup_datetime timestamp, dropoff_datetime string, pickup_location_id int, " \
        "dropoff_location_id int, passenger_count int, fare_amount double, tip_amount double, payment_type int, trip_distance double, arrival bigint"  # fmt: skip
    at = datetime(2024, 1, 1, 2, 3, 4, 567891)
    rows = [
        (E.START, "a", at, None, 7, None, None, None, None, None, None, 1),
        (E.END, "a", None, 'é "\\\n', None, -3, None, 0.1 + 0.2, float("inf"), None, -1e-300, 2),
        (E.START, "b", None, None, None, None, None, None, None, None, None, 3),
        (E.END, "b", None, None, None, None, None, None, None, None, None, 4),
        (E.END, "b", None, "", None, 1, None, 1e22, None, 2, None, 5),
    ]
    folder = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    paired = pairing.stream_pairing(spark.readStream.schema(schema).parquet(folder))
    # what passes to Python is a few values per row
    assert "_values" in paired._jdf.queryExecution().toString()
    found = S.run_to_table(spark, paired, str(tmp_path / "out"), str(tmp_path / "checkpoint")).filter("kind <> 'opened'")
    end = lambda row: (row[3], *row[5:6])
    columns = ["kind", "trip_id", "pickup_datetime", "pickup_location_id", "dropoff_datetime", "dropoff_location_id",
               "fare_amount", "tip_amount", "payment_type", "trip_distance", "reason"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == sorted(
        [
            ("completed", "a", at, 7, *end(rows[1]), 0.1 + 0.2, float("inf"), None, -1e-300, None),
            ("completed", "b", None, None, None, None, None, None, None, None, None),
            ("orphan", "b", None, None, "", 1, 1e22, None, 2, None, E.REASON),
        ],
        key=repr,
    )


def test_cuts_are_derived_in_several_tasks_and_written_one_file_a_folder(spark, tmp_path):
    task = F.udf(lambda _: TaskContext.get().partitionId(), "int").asNondeterministic()
    rows = spark.range(0, 4000, 1, 4).select("id", (F.col("id") % 3).alias("part"), task("id").alias("task"))
    write_in_order(rows, str(tmp_path / "out"), "id", 4, "part")
    found = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.col("_metadata.file_path"))
    cuts = found.groupBy("part", "file").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).collect()
    assert sorted(r["part"] for r in cuts) == sorted([0, 1, 2] * 4) and sum(r["n"] for r in cuts) == 4000
    spans = sorted({(r["low"] // 1000, r["high"] // 1000) for r in cuts})
    assert len(spans) <= 8 and all(high - low <= 1 for low, high in spans)
    assert found.select("task").distinct().count() > 1


def test_keyed_state_with_ttl_runs(spark, tmp_path):
    rows = [(E.START, "a", 0, 0), (E.END, "a", 1, 1), (E.END, "a", 2, 2)]
    events = stream_of(spark, rows, str(tmp_path / "in"), 1)
    out = str(tmp_path / "out")
    query = (
        pairing.stream_pairing(events, ttl_ms=3_600_000)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start()
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if any(p.numInputRows for p in query.recentProgress):
                break
    finally:
        query.stop()
    kinds = sorted(r["kind"] for r in spark.read.parquet(out).collect())
    assert kinds == ["completed", "opened", "orphan"]


def test_event_time_expiry_over_batches(spark, tmp_path):
    rows = [(E.START, "late", 0, 0), (E.START, "lost", 1, 1), (E.START, "ok", 2, 60),
            (E.END, "ok", 3, 120), (E.END, "late", 4, 121), (E.START, "new", 5, 130)]
    for parts in (1, 2, 3, 6):
        out = str(tmp_path / f"out{parts}")
        paired = pairing.stream_pairing_expiring(stream_of(spark, rows, str(tmp_path / f"in{parts}"), parts), "2 hours")
        S.stream_kinds_sink(paired, out, f"{out}-checkpoint").awaitTermination()
        found = S.read_kinds(spark, paired, out).collect()
        kinds = sorted((r["kind"], r["trip_id"]) for r in found if r["kind"] != "opened")
        assert kinds == [("completed", "ok"), ("expired", "late"), ("expired", "lost"), ("orphan", "late")], parts


def test_event_time_expiry_on_dense_ids(spark, tmp_path):
    rows = [(k, t, a, a * 7) for k, t, a, _ in skewed(120, 15)]
    results = []
    for parts in (1, 5):
        out = str(tmp_path / f"out{parts}")
        paired = pairing.stream_pairing_expiring(stream_of(spark, rows, str(tmp_path / f"in{parts}"), parts), "1 hour")
        S.stream_kinds_sink(paired, out, f"{out}-checkpoint").awaitTermination()
        found = S.read_kinds(spark, paired, out).filter("kind <> 'opened'")
        results.append(sorted(map(repr, found.drop("batch_id").collect())))
    sliced = str(tmp_path / "sliced")
    pairing.stream_pairing_sink(stream_of(spark, rows, str(tmp_path / "in"), 3), sliced, ttl="1 hour").awaitTermination()
    counts = {k: spark.read.parquet(f"{sliced}/{k}").count() for k in ("completed", "orphan", "expired")}
    assert results[0] == results[1]
    assert {k: sum(f"kind='{k}'" in r for r in results[0]) for k in counts} == counts


def test_repeated_batches_replace_themselves(spark, tmp_path):
    rows = skewed(120, 16)
    out = str(tmp_path / "out")
    for attempt in range(2):
        paired = pairing.stream_pairing(stream_of(spark, rows, str(tmp_path / f"in{attempt}"), 3))
        # a new checkpoint numbers the batches from 0 again, as a repeated run of them would
        S.stream_kinds_sink(paired, out, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
        found = S.read_kinds(spark, paired, out).filter("kind = 'completed'")
        assert pairs_of(found.collect()) == brute(rows)[0]


def test_listener_hears_every_report(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(150).repartition(150).write.parquet(folder)
    files = sum(1 for _ in (tmp_path / "in").glob("part-*"))
    assert files > 100
    totals = progress.ProgressTotals("numbers")
    spark.streams.addListener(totals)
    try:
        numbers = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(folder)
        query = S.drain(progress.counted(numbers, "numbers"), lambda batch, _: batch.collect(), str(tmp_path / "checkpoint"))
        assert totals.of(query) == {"rows": 150}
        assert len(query.recentProgress) <= 100
    finally:
        spark.streams.removeListener(totals)


def test_messages_keep_their_order_per_key(spark, tmp_path):
    rows = skewed(400, 17)
    out = str(tmp_path / "out")
    events = stream_of(spark, rows, str(tmp_path / "in"), 3)
    S.stream_kv_files(events, out, str(tmp_path / "checkpoint"), partitions=4).awaitTermination()
    seen = {}
    for file in sorted((tmp_path / "out").glob("batch_id=*/partition=*/*.parquet"), key=lambda f: f.parent.parent.name):
        for r in spark.read.parquet(str(file)).collect():
            seen.setdefault(r["key"], []).append((file.parent.name, r["position"]))
    assert sum(map(len, seen.values())) == len(rows)
    for places in seen.values():
        assert len({folder for folder, _ in places}) == 1
        assert [at for _, at in places] == sorted(at for _, at in places)


def test_arrival_orders_all_partitions(spark):
    rows = [("2024-01-01 00:00:00.000001", 5, 7), ("2024-01-01 00:00:00.000001", 5, 8), ("2024-01-01 00:00:00.000001", 6, 0),
            ("2024-01-01 00:00:00.000002", 0, 10**15 - 1), ("2024-01-01 00:00:00.000002", 1, 0), ("9999-12-31 00:00:00", 99_999, 3)]
    frame = spark.createDataFrame(rows, "t string, partition int, offset bigint")
    order = stream.arrival_order(F.col("t").cast("timestamp"), F.col("partition"), F.col("offset"))
    got = [r[0] for r in frame.select(order).collect()]
    assert None not in got and got == sorted(set(got))


def test_interval_join_over_batches(spark, tmp_path):
    rows = [(k, t, a, a * 3) for k, t, a, _ in skewed(300, 14)]
    events = stream_of(spark, rows, str(tmp_path / "in"))
    joined = joins.stream_interval_join(events)
    found = S.run_to_table(spark, joined, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = make(spark, rows)
    kind = F.col("event_type")
    expected = E.interval_join(batch.filter(kind == E.START), batch.filter(kind == E.END))
    assert pairs_of(found.collect()) == pairs_of(expected.collect())


def test_unmatched_starts_leave_with_the_watermark(spark, tmp_path):
    rows = [(E.START, "gone", 0, 0), (E.START, "met", 1, 5), (E.END, "met", 2, 30), (E.START, "fresh", 3, 600)]
    events = stream_of(spark, rows, str(tmp_path / "in"), 2)
    out = S.run_to_table(
        spark, joins.stream_unmatched(events), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    )
    assert [r["trip_id"] for r in out.collect()] == ["gone"]


def test_message_frame_is_keyed(spark):
    frame = E.key_value(make(spark, [(E.START, "a", 1, 0), (E.END, "a", 2, 1)]))
    assert [r["key"] for r in frame.collect()] == ["a", "a"]
