"""Trip events: expansion, JSON, interval join and arrival-order pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.functions import scalar as S

START, END = "trip_started", "trip_ended"
REASON = "missing_trip_started"

# The wide event schema, and the columns each event type fills.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("dropoff_datetime", T.StringType()),
        T.StructField("pickup_location_id", T.IntegerType()),
        T.StructField("dropoff_location_id", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
    ]
)
START_COLS = ("pickup_datetime", "pickup_location_id", "passenger_count")
END_COLS = (
    "dropoff_datetime",
    "dropoff_location_id",
    "fare_amount",
    "tip_amount",
    "payment_type",
    "trip_distance",
)
COMPLETED_COLS = (
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "payment_type",
    "trip_distance",
)
ORPHAN_COLS = (
    "trip_id",
    "dropoff_datetime",
    "fare_amount",
    "tip_amount",
    "payment_type",
    "trip_distance",
)

# A trip id with more rows than this is cut into slices of its arrival order.
HOT_ROWS = 1_000_000
# Slices of a hot id, of about equal numbers of rows.
HOT_SLICES = 512
# An interval-join slot spans this many windows.
SLOT_WINDOWS = 4


def explode_trip_events(trips: DataFrame, id_col: str) -> DataFrame:
    """Two event rows per trip. Each fills the columns of its own type, the rest is NULL."""

    def event(kind: str, filled: Sequence[str]) -> Column:
        values = {"event_type": F.lit(kind), "trip_id": F.col(id_col).cast("string")}
        for name in filled:
            values[name] = F.col(name)
        fields = [
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA
        ]
        return F.struct(*fields)

    both = F.array(event(START, START_COLS), event(END, END_COLS))
    return trips.select(F.explode(both).alias("event"))


def json_encode(df: DataFrame, cols: Sequence[str], out: str = "value") -> DataFrame:
    """The columns as one JSON text. NULL fields are left out."""
    return df.withColumn(out, F.to_json(F.struct(*cols)))


def key_value(events: DataFrame, id_col: str = "trip_id") -> DataFrame:
    """Message frame: both event types are keyed, so a trip stays in one topic partition."""
    value = F.to_json(F.struct(*[F.col(c) for c in events.columns]))
    return events.select(F.col(id_col).alias("key"), value.alias("value"))


def json_decode(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, col: str = "value") -> DataFrame:
    """Parses JSON text into the schema's columns plus ``malformed``.

    A text that does not parse, or that lacks ``trip_id`` or ``event_type``,
    is marked rather than failing the job: its fields are NULL, and the text
    is kept in ``raw``.
    """
    wide = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(
        F.col(col), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    rows = df.withColumn("_event", parsed)
    required = [n for n in ("trip_id", "event_type") if n in schema.fieldNames()]
    malformed = F.col("_event._corrupt").isNotNull() | F.col("_event").isNull()
    for name in required:
        malformed = malformed | F.col(f"_event.{name}").isNull()
    others = [c for c in df.columns if c != col]
    return rows.select(
        *[F.when(~malformed, F.col(f"_event.{n}")).alias(n) for n in schema.fieldNames()],
        *others,
        malformed.alias("malformed"),
        F.when(malformed, F.col(col)).alias("raw"),
    )


def _window_seconds(within: str) -> int:
    number, unit = within.split()
    unit_s = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(number) * unit_s[unit.rstrip("s")]


def interval_join(
    starts: DataFrame,
    ends: DataFrame,
    id: str = "trip_id",
    start_time: str = "event_time",
    end_time: str = "event_time",
    within: str = "2 hours",
    how: str = "inner",
    matched: str | None = None,
) -> DataFrame:
    """Every start and end of one id with ``start <= end <= start + within``.

    The join key is the id plus a time slot, so the rows of a hot id spread
    over as many groups as it has slots. A start lies in one slot. An end goes
    to each slot its possible starts lie in, which is its own and rarely the
    one before, so each pair meets exactly once. Works on batch and streaming
    frames; ``left_outer`` keeps starts without an end, and ``matched`` names a
    column that tells whether there is one.
    """
    width = _window_seconds(within)
    slot_s = width * SLOT_WINDOWS
    s = starts.select(
        F.col(id).alias("s_id"),
        F.col(start_time).alias("s_time"),
        *[F.col(c).alias(f"s_{c}") for c in START_COLS],
        S.epoch_slot(starts, start_time, slot_s).alias("s_slot"),
    )
    first = S.epoch_slot(ends, end_time, slot_s, shift_s=width)
    last = S.epoch_slot(ends, end_time, slot_s)
    e = ends.select(
        F.col(id).alias("e_id"),
        F.col(end_time).alias("e_time"),
        *[F.col(c).alias(f"e_{c}") for c in END_COLS],
        F.explode(F.sequence(first, last)).alias("e_slot"),
    )
    on = (
        (F.col("s_id") == F.col("e_id"))
        & (F.col("s_slot") == F.col("e_slot"))
        & (F.col("e_time") >= F.col("s_time"))
        & (F.col("e_time") <= F.col("s_time") + F.expr(f"INTERVAL {within}"))
    )
    sides = {"trip_id": "s_id"}
    sides |= {c: f"s_{c}" for c in START_COLS} | {c: f"e_{c}" for c in END_COLS}
    flag = [F.col("e_id").isNotNull().alias(matched)] if matched else []
    return s.join(e, on, how).select(*[F.col(sides[c]).alias(c) for c in COMPLETED_COLS], *flag)


def trip_halves(
    events: DataFrame, kind: str = "event_type", start: str = START, end: str = END
) -> DataFrame:
    """Only start and end events; other types take no part in pairing."""
    return events.filter(F.col(kind).isin(start, end))


def hot_ids(events: DataFrame, id: str, arrival: str, hot_rows: int, slices: int = HOT_SLICES) -> DataFrame:
    """Every id with more than ``hot_rows`` rows and the arrivals at which its slices start.

    The edges are quantiles of the id's arrivals, so a burst is cut as finely as
    it is dense: a slice holds about one in ``slices`` of the id's rows.
    """
    hot = (
        events.groupBy(F.col(id).alias("hot_id"))
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") > hot_rows) & F.col("hot_id").isNotNull())
        .select("hot_id")
    )
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    edges = F.percentile_approx(arrival, shares, 10 * slices)
    return (
        events.join(hot, F.col(id) == F.col("hot_id"))
        .groupBy("hot_id")
        .agg(F.array_sort(F.array_distinct(edges)).alias("edges"))
    )


def slice_number(arrival: Column, edges: Column, slices: int = HOT_SLICES) -> Column:
    """How many of the sorted ``edges`` lie at or before ``arrival``, by halving."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(slices.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(edges, at + step - 1) <= arrival, at + step).otherwise(at),
    )


def with_previous(
    events: DataFrame,
    cols: Sequence[str],
    id: str = "trip_id",
    arrival: str = "arrival",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``prev``, the ``cols`` of the id's event before this one, and ``is_last``.

    Same as ``lag`` over the id by arrival, but a hot id does not land in one
    task. Its arrival order is cut into slices of about equal size, each slice is
    a window partition of its own, and only the last row of each slice travels on
    to the first row of the next. ``arrival`` is a unique, rising whole number
    (log offset, event number). A row without an id has no previous event and is
    its own last one. Spark decides by size how the hot ids are joined.
    """
    hot = hot_ids(events, id, arrival, hot_rows)
    slice_no = slice_number(F.col(arrival), F.col("edges")).cast("long")
    tail = F.struct(F.col(arrival).alias("at"), *[F.col(c) for c in cols])

    tails = (
        events.join(hot, F.col(id) == F.col("hot_id"))
        .groupBy(F.col(id).alias("tail_id"), slice_no.alias("tail_slice"))
        .agg(F.max_by(tail, F.col(arrival)).alias("tail"))
    )
    by_slice = Window.partitionBy("tail_id").orderBy("tail_slice")
    carry = tails.select(
        "tail_id",
        "tail_slice",
        F.lag("tail").over(by_slice).alias("carried"),
        F.lead("tail_slice").over(by_slice).isNotNull().alias("more"),
    )

    rows = events.join(hot, F.col(id) == F.col("hot_id"), "left").withColumn(
        "slice",
        F.when(F.col(id).isNull(), F.col(arrival))
        .when(F.col("edges").isNotNull(), slice_no)
        .otherwise(F.lit(-1)),
    )
    by_arrival = Window.partitionBy(id, "slice").orderBy(arrival)
    rows = rows.withColumns(
        {
            "near": F.lag(tail).over(by_arrival),
            "end_of_slice": F.lead(arrival).over(by_arrival).isNull(),
        }
    )
    joined = rows.join(
        carry,
        (F.col(id) == F.col("tail_id")) & (F.col("slice") == F.col("tail_slice")),
        "left",
    )
    return joined.select(
        *events.columns,
        F.coalesce("near", "carried").alias("prev"),
        (F.col("end_of_slice") & ~F.coalesce("more", F.lit(False))).alias("is_last"),
    )


def resolve_events(
    events: DataFrame,
    id: str = "trip_id",
    type: str = "event_type",
    arrival: str = "arrival",
    start: str = START,
    end: str = END,
    hot_rows: int = HOT_ROWS,
    time: str | None = None,
    ttl: str | None = None,
) -> DataFrame:
    """Adds ``kind`` (completed, orphan, open, closed) and ``prev`` to every event.

    After a start the state of an id is that start, after an end it is empty;
    so the event before an end decides. With ``ttl`` a start counts only for
    ends at most that long after it, by the ``time`` column.
    """
    halves = trip_halves(events, type, start, end)
    cols = [type, *START_COLS] + ([time] if ttl else [])
    rows = with_previous(halves, cols, id, arrival, hot_rows)
    paired = F.coalesce(F.col(f"prev.{type}") == start, F.lit(False))
    if ttl:
        limit = F.col(f"prev.{time}") + F.expr(f"INTERVAL {ttl}")
        paired = paired & (F.col(time) <= limit)
    kind = (
        F.when((F.col(type) == end) & paired, "completed")
        .when(F.col(type) == end, "orphan")
        .when(F.col("is_last"), "open")
        .otherwise("closed")
    )
    return rows.withColumn("kind", kind)


def completed_rows(resolved: DataFrame, id: str = "trip_id") -> DataFrame:
    source = {c: F.col(f"prev.{c}") for c in START_COLS} | {c: F.col(c) for c in END_COLS}
    source["trip_id"] = F.col(id)
    done = resolved.filter(F.col("kind") == "completed")
    return done.select(*[source[c].alias(c) for c in COMPLETED_COLS])


def orphan_rows(resolved: DataFrame, id: str = "trip_id") -> DataFrame:
    return resolved.filter(F.col("kind") == "orphan").select(
        F.col(id).alias("trip_id"), *ORPHAN_COLS[1:], F.lit(REASON).alias("reason")
    )


def pair_latest_start(events: DataFrame, **names) -> DataFrame:
    """Ends that consume the latest open start of their id, as completed trips."""
    return completed_rows(resolve_events(events, **names), names.get("id", "trip_id"))


def orphan_ends(events: DataFrame, **names) -> DataFrame:
    """Ends that found no open start."""
    return orphan_rows(resolve_events(events, **names), names.get("id", "trip_id"))


def unmatched_starts(
    events: DataFrame,
    id: str = "trip_id",
    type: str = "event_type",
    arrival: str = "arrival",
    start: str = START,
    end: str = END,
    cols: Sequence[str] = START_COLS,
) -> DataFrame:
    """Starts still open: the last event of their id. Combined before the shuffle."""
    last = F.max_by(F.struct(type, arrival, *cols), F.col(arrival)).alias("last")
    lone = F.when(F.col(id).isNull(), F.col(arrival))  # rows without an id stay apart
    lasts = (
        trip_halves(events, type, start, end)
        .groupBy(F.col(id).alias("trip_id"), lone.alias("lone"))
        .agg(last)
    )
    return lasts.filter(F.col(f"last.{type}") == start).select(
        "trip_id", *[F.col(f"last.{c}").alias(c) for c in (arrival, *cols)]
    )


def health_report(events: DataFrame, **names) -> DataFrame:
    """Completed trips, orphaned ends and unmatched starts, in one pass over the pairing."""
    return resolve_events(events, **names).agg(
        F.count_if(F.col("kind") == "completed").alias("completed_trips"),
        F.count_if(F.col("kind") == "orphan").alias("orphaned_ends"),
        F.count_if(F.col("kind") == "open").alias("unmatched_starts"),
    )
