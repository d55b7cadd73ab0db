"""Arrival-order pairing on streams.

Two forms with the same result:

``stream_pairing`` (and ``stream_pairing_expiring``, with timers on event time)
keeps the open start of each trip in keyed state. It suits trip ids with a few
events each. All rows one id has in one micro-batch are
ordered in one task, so bound the batch at the source (``maxOffsetsPerTrigger``,
``maxBytesPerTrigger``).

``stream_pairing_sink`` pairs each micro-batch with the batch operators, which
slice a hot id, and carries the open starts in a small table. It suits skewed
ids and large batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tripwright.operators.events import (
    COMPLETED_COLS,
    END,
    END_COLS,
    HOT_ROWS,
    REASON,
    START,
    START_COLS,
    resolve_events,
    trip_halves,
)
from tripwright.streaming.sinks import drain, write_batch, write_kinds

# State tables kept: the one a batch reads, the one it writes, and one to spare.
STATE_SLOTS = 3
# Times in texts of values, to the microsecond.
AS_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stream_pairing(
    events: DataFrame,
    id: str = "trip_id",
    arrival: str = "arrival",
    ttl_ms: int | None = None,
) -> DataFrame:
    """Rows of kind ``opened``, ``completed`` and ``orphan``, with the trip columns.

    With ``ttl_ms`` an open start is dropped that long after it was stored
    (processing time). Needs the RocksDB state store.

    Each value that passes to Python and back costs by itself, more than pairing
    does. So the columns of a start or an end travel, and are kept, as one text.
    """
    fields = {f.name: f.dataType for f in events.schema}
    start_fields, end_fields = (
        T.StructType([T.StructField(c, fields[c]) for c in names]) for names in (START_COLS, END_COLS)
    )
    output = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("trip_id", fields["trip_id"])]
        + [T.StructField(c, T.StringType()) for c in ("start", "end")]
    )
    state = T.StructType([T.StructField("start", T.StringType())])

    class Pairing(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.open = handle.getValueState("open", state, ttl_ms)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            before = self.open.get()[0] if self.open.exists() else None
            held = before
            for row in sorted(rows, key=lambda r: r[arrival]):
                if row["_starts"]:
                    if held is None:
                        yield Row(kind="opened", trip_id=key[0], start=row["_values"], end=None)
                    held = row["_values"]
                elif held is None:
                    yield Row(kind="orphan", trip_id=key[0], start=None, end=row["_values"])
                else:
                    yield Row(kind="completed", trip_id=key[0], start=held, end=row["_values"])
                    held = None
            if held is not None:
                self.open.update((held,))
            elif before is not None:
                self.open.clear()

        def close(self) -> None:
            pass

    starts = F.col("event_type") == START
    values = F.when(starts, F.to_json(F.struct(*START_COLS), AS_TEXT)).otherwise(F.to_json(F.struct(*END_COLS), AS_TEXT))
    paired = (
        trip_halves(events)
        .select(id, arrival, starts.alias("_starts"), values.alias("_values"))
        .groupBy(id)
        .transformWithState(
            statefulProcessor=Pairing(),
            outputStructType=output,
            outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
    )
    whole = paired.select(
        "kind", "trip_id", F.from_json("start", start_fields, AS_TEXT).alias("start"), F.from_json("end", end_fields, AS_TEXT).alias("end")
    )
    columns = [c if c == "trip_id" else f"start.{c}" if c in START_COLS else f"end.{c}" for c in COMPLETED_COLS]
    return whole.select("kind", *columns, F.when(F.col("kind") == "orphan", REASON).alias("reason"))


def stream_pairing_expiring(
    events: DataFrame,
    ttl: str,
    id: str = "trip_id",
    arrival: str = "arrival",
    time: str = "event_time",
    delay: str = "0 seconds",
) -> DataFrame:
    """``stream_pairing`` with rows of kind ``expired`` for starts that no event followed within ``ttl``.

    Each open start sets a timer on event time. It fires once the watermark (the
    latest time seen, less ``delay``) has passed it; an event of the same id that
    comes too late expires the start itself. State and timers are kept per id and
    written by changed ids only. Rows older than the watermark are dropped, so
    ``delay`` must cover how far times may fall behind arrival; with times that
    rise with arrival the rows do not depend on the cut into batches.
    """
    fields = {f.name: f.dataType for f in events.schema}
    output = T.StructType(
        [T.StructField("kind", T.StringType())]
        + [T.StructField(c, fields[c]) for c in COMPLETED_COLS]
        + [T.StructField("reason", T.StringType())]
    )
    state = T.StructType([T.StructField(c, fields[c]) for c in START_COLS] + [T.StructField("until", T.LongType())])
    start_type, end_type, reason = START, END, REASON
    start_cols, end_cols, all_cols = START_COLS, END_COLS, COMPLETED_COLS

    class Expiring(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.open = handle.getValueState("open", state)

        def row(self, kind, key, held=None, end=None, why=None) -> Row:
            values = dict.fromkeys(all_cols)
            values["trip_id"] = key[0]
            if held is not None:
                values.update(zip(start_cols, held))
            if end is not None:
                values.update((c, end[c]) for c in end_cols)
            return Row(kind=kind, **values, reason=why)

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            before = tuple(self.open.get()) if self.open.exists() else None
            held = before
            for row in sorted(rows, key=lambda r: r[arrival]):
                if held is not None and row["_at"] > held[-1]:
                    yield self.row("expired", key, held)
                    held = None
                if row["event_type"] == start_type:
                    if held is None:
                        yield self.row("opened", key, [row[c] for c in start_cols])
                    held = (*(row[c] for c in start_cols), row["_until"])
                elif row["event_type"] == end_type and held is not None:
                    yield self.row("completed", key, held, row)
                    held = None
                elif row["event_type"] == end_type:
                    yield self.row("orphan", key, None, row, reason)
            if held != before:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                if held is None:
                    self.open.clear()
                else:
                    self.open.update(held)
                    # the first whole millisecond behind the last moment that counts
                    self.handle.registerTimer(held[-1] // 1000 + 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            if self.open.exists():
                yield self.row("expired", key, tuple(self.open.get()))
                self.open.clear()

        def close(self) -> None:
            pass

    timed = trip_halves(events.withWatermark(time, delay)).withColumns(
        {"_at": F.unix_micros(time), "_until": F.unix_micros(F.col(time) + F.expr(f"INTERVAL {ttl}"))}
    )
    return timed.groupBy(id).transformWithState(
        statefulProcessor=Expiring(), outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


def stream_health(paired: DataFrame, name: str = "health") -> DataFrame:
    """Attaches the health counters to a paired stream; read them with ``observed_health``."""
    kind = F.col("kind")
    return paired.observe(
        name,
        F.count_if(kind == "completed").alias("completed_trips"),
        F.count_if(kind == "orphan").alias("orphaned_ends"),
        F.count_if(kind == "opened").alias("opened"),
    )


def observed_health(query: StreamingQuery, name: str = "health") -> dict[str, int]:
    """Totals over the progress reports the query still holds."""
    total = {"completed_trips": 0, "orphaned_ends": 0, "opened": 0}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None:
            for key in total:
                total[key] += row[key]
    total["unmatched_starts"] = total.pop("opened") - total["completed_trips"]
    return total


def _state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_pairing_sink(
    events: DataFrame,
    out: str,
    ttl: str | None = None,
    hot_rows: int = HOT_ROWS,
    max_records: int | None = None,
    once: bool = True,
    kinds: Sequence[str] = ("completed", "orphan", "expired", "health", "state", "checkpoint"),
) -> StreamingQuery:
    """Pairs a stream batch by batch into Parquet folders below ``out``.

    ``completed`` and ``orphan`` hold the paired rows, ``expired`` the open
    starts that no event followed within ``ttl`` (by ``event_time``), each once,
    ``health`` one row of counts per batch and the latest event time so far. With
    event times that rise with arrival the rows do not depend on the cut into batches. Open starts pass from batch to batch through ``state``. Batch N
    reads what batch N-1 wrote and replaces only its own folders, so a repeated
    batch gives the same result.
    """
    completed_dir, orphan_dir, expired_dir, health_dir, state_dir, checkpoint = [
        f"{out}/{k}" for k in kinds
    ]
    carried = T.StructType(
        [f for f in events.schema if f.name in (*COMPLETED_COLS, "event_type", "event_time", "arrival")]
    )

    time_type = events.schema["event_time"].dataType
    health_schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("batch", "completed_trips", "orphaned_ends", "unmatched_starts")]
        + [T.StructField("seen", time_type)]
    )

    def pair(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _state(spark, f"{state_dir}/slot={(batch_id - 1) % STATE_SLOTS}", carried)
        if batch_id == 0:
            before = before.limit(0)
        rows = before.unionByName(trip_halves(batch).select(*carried.names))
        resolved = resolve_events(rows, hot_rows=hot_rows, time="event_time", ttl=ttl)
        prior = {c: F.when(F.col("kind") == "completed", F.col(f"prev.{c}")) for c in START_COLS}
        # a start whose next event comes too late has expired, whichever batch brings that event
        lapsed = F.lit(False)
        if ttl:
            late = F.col("event_time") > F.col("prev.event_time") + F.expr(f"INTERVAL {ttl}")
            lapsed = F.coalesce((F.col("prev.event_type") == START) & late, F.lit(False))
        lost = F.when(F.col("lapsed"), F.struct(*[F.col(f"prev.{c}").alias(c) for c in START_COLS]))
        marked = resolved.withColumn("lapsed", lapsed).withColumn("lost", lost)
        paired = marked.filter((F.col("kind") != "closed") | F.col("lapsed")).withColumns(
            {c: F.coalesce(prior[c], F.col(c)) for c in START_COLS} | {"reason": F.lit(REASON)}
        )
        # four outputs read the pairing; the rows can be recomputed from the source
        held = paired.drop("prev", "is_last").persist()
        try:
            write_all(spark, held, batch_id)
        finally:
            held.unpersist()

    def write_all(spark: SparkSession, held: DataFrame, batch_id: int) -> None:
        kind = F.col("kind")
        counts = held.agg(
            F.count_if(kind == "completed").alias("completed_trips"),
            F.count_if(kind == "orphan").alias("orphaned_ends"),
            F.count_if(kind == "open").alias("open"),
            F.max("event_time").alias("seen"),
        ).first()
        earlier = _state(spark, health_dir, health_schema).filter(F.col("batch") < batch_id)
        seen = [x for x in (counts["seen"], earlier.agg(F.max("seen")).first()[0]) if x is not None]
        seen = max(seen) if seen else None
        write_kinds(held, completed_dir, orphan_dir, batch_id, max_records)
        still_open, unmatched = held.filter(kind == "open"), counts["open"]
        if ttl:
            old = F.col("event_time") + F.expr(f"INTERVAL {ttl}") < F.lit(seen).cast(time_type)
            expired = still_open.filter(old).select("trip_id", *START_COLS)
            expired = expired.unionByName(held.filter("lapsed").select("trip_id", "lost.*"))
            write_batch(expired, expired_dir, batch_id, max_records)
            still_open = still_open.filter(~old)
        slot = f"{state_dir}/slot={batch_id % STATE_SLOTS}"
        still_open.select(*carried.names).write.mode("overwrite").parquet(slot)
        if ttl:
            unmatched = spark.read.schema(carried).parquet(slot).count()
        health = [(batch_id, counts["completed_trips"], counts["orphaned_ends"], unmatched, seen)]
        write_batch(spark.createDataFrame(health, health_schema), health_dir, batch_id)

    return drain(events, pair, checkpoint, once)


def read_health(spark: SparkSession, out: str) -> DataFrame:
    """Totals over the batches: completed and orphaned so far, and starts open after the last."""
    batches = spark.read.parquet(f"{out}/health")
    return batches.agg(
        F.sum("completed_trips").alias("completed_trips"),
        F.sum("orphaned_ends").alias("orphaned_ends"),
        F.max_by("unmatched_starts", "batch").alias("unmatched_starts"),
    )
