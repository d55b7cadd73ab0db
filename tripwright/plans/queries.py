"""The registered queries: every operator on the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.functions import scalar as S
from tripwright.operators import checks, cleaning, collections, events, profile, retrieval, shares, sinks
from tripwright.plans import answers, chain, marts
from tripwright.session import keyed_state, scratch_dir
from tripwright.sources import catalog, files, lake, stream
from tripwright.sources.trips import (
    STREAM_FILES,
    TRIP_KEY,
    raw_trips,
    spread,
    table,
    trip_event_stream,
    trip_events,
    write_in_order,
)
from tripwright.streaming import joins, pairing, progress
from tripwright.streaming import sinks as stream_sinks

Query = Callable[[SparkSession, str], DataFrame]

# Bounds that make some rows of the given tables fail.
DAILY_BOUNDS = {"total_trips": (5, 40), "total_revenue": (200_000, 2_500_000), "avg_fare": (30_000, 60_000)}
PAYMENT_BOUNDS = {"credit_card": (700, 100_000), "flex_fare": (0, 900), "cash": (600, 10_000)}
AS_OF_DATE = "1998-01-01"
SAMPLE_ROWS = 1000
TOPIC_PARTITIONS = 3

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _clean(spark: SparkSession, sf: str, keys: bool = False) -> DataFrame:
    return cleaning.clean_trips(raw_trips(spark, sf), keep=TRIP_KEY if keys else ())


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return marts.stg_trips(_clean(spark, sf))


def _sized(df: DataFrame, name: str) -> DataFrame:
    """A small result as a written table: the planner then knows its size.

    Joined to a large table it is broadcast only if its files are below the
    broadcast threshold. Unwritten, its size is a guess, and the large side
    would be shuffled before the real size is seen.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with_id(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_id", S.key_id(*TRIP_KEY))


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rename_project(raw_trips(spark, sf), keep=TRIP_KEY)


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


# Sources


@query
def scan_raw(spark, sf):
    return files.scan_raw(spark, f"{sf}/lineitem.parquet")


@query
def raw_trip_rows(spark, sf):
    return raw_trips(spark, sf)


@query
def scan_partitioned(spark, sf):
    path = scratch_dir(spark, "clean")
    sinks.sink_partitioned(_clean(spark, sf), path)
    return (
        files.scan_partitioned(spark, path)
        .groupBy(F.col("pickup_month").cast("int").alias("pickup_month"))
        .agg(F.count("*").alias("total_rows"))
    )


@query
def describe_schema(spark, sf):
    return files.describe_schema(raw_trips(spark, sf))


@query
def row_count(spark, sf):
    return files.row_count(raw_trips(spark, sf))


def _topic(spark: SparkSession, sf: str, damaged: bool = False) -> DataFrame:
    """The trip events as a stream of messages from a topic of three partitions, dealt regardless of the trip."""
    rows = trip_events(spark, sf)
    columns = [c for c in rows.columns if c not in ("event_time", "arrival")]
    value = F.to_json(F.struct(*columns))
    if damaged:
        # every error event is sent as a cut-off message, and must be set aside
        value = F.when(F.col("event_type") == "error", value.substr(F.lit(1), F.length(value) - 5)).otherwise(value)
    messages = rows.select(
        value.alias("value"),
        F.col("event_time").alias("timestamp"),
        (F.col("arrival") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("arrival") / TOPIC_PARTITIONS).alias("offset"),
    )
    folder = scratch_dir(spark, "topic")
    write_in_order(messages, folder, "timestamp", STREAM_FILES, "partition")
    options = {"format": "log", "path": folder, "maxFilesPerTrigger": str(TOPIC_PARTITIONS)}
    return stream.stream_json_source(spark, options)


@query
def stream_json_source(spark, sf):
    folder = scratch_dir(spark, "json")
    typed = stream.malformed_apart(_topic(spark, sf, damaged=True))
    stream_sinks.stream_kinds_sink(typed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    out = stream_sinks.read_kinds(spark, typed, f"{folder}/out")
    # each kind lies in folders of its own
    return out.filter((F.col("kind") == "malformed") == F.col("malformed")).drop(
        "raw", "kind", "batch_id", "event_time", "arrival"
    )


@query
def table_scan_versioned(spark, sf):
    return lake.table_scan_versioned(spark, _two_appends(spark, sf)[0])


@query
def doc_load(spark, sf):
    """Every document from a file of its own, below a folder named by its id."""
    folder = scratch_dir(spark, "docs")
    files.doc_write(table(spark, sf, "documents").select("doc_id", "text"), folder)
    found = files.doc_load(spark, folder)
    # the writer ends each text with a newline
    text = F.substr("text", F.lit(1), F.char_length("text") - 1)
    return found.select(
        F.regexp_extract("folder", "=(.*)$", 1).try_cast("bigint").alias("doc_id"),
        F.char_length(text).cast("bigint").alias("n_chars"),
        F.md5(text.cast("binary")).alias("text_md5"),
    )


@query
def catalog_register(spark, sf):
    folder, name = scratch_dir(spark, "crawl"), _name("crawled")
    clean = _clean(spark, sf)
    sinks.sink_partitioned(clean.drop("tip_pct"), folder)
    catalog.catalog_register(spark, name, folder, ["pickup_month"])
    sinks.sink_partitioned(clean.drop("pickup_hour"), folder)
    changes = catalog.catalog_register(spark, name, folder, ["pickup_month"])
    total = spark.table(name).agg(F.count("*")).scalar()
    return changes.withColumn("total_rows", total)


# Sinks and table writes


@query
def sink_partitioned(spark, sf):
    path = scratch_dir(spark, "clean")
    sinks.sink_partitioned(_clean(spark, sf), path, balance=True)
    written = files.scan_partitioned(spark, path)
    return written.withColumn("pickup_month", F.col("pickup_month").cast("int"))


@query
def materialize(spark, sf):
    stg = sinks.materialize(_stg(spark, sf), _name("stg_trips"))
    path = scratch_dir(spark, "mart")
    return sinks.materialize(marts.payment_summary(stg), _name("payment_summary"), "table", path)


@query
def stream_kv_sink(spark, sf):
    """The messages of a drained stream, with their place among those of their key."""
    folder = scratch_dir(spark, "messages")
    halves = events.trip_halves(trip_event_stream(spark, sf))
    stream_sinks.stream_kv_files(halves, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    sent = spark.read.parquet(f"{folder}/out")
    in_key = Window.partitionBy("key", "partition").orderBy("batch_id", "position")
    return sent.select("key", "value", F.row_number().over(in_key).alias("nth"))


@query
def stream_print_sink(spark, sf):
    started = trip_event_stream(spark, sf).filter(F.col("event_type") == events.START)
    totals = progress.ProgressTotals(_name("printed"))
    spark.streams.addListener(totals)
    try:
        shown = stream_sinks.stream_print_sink(progress.counted(started, totals.name), {"numRows": "1"})
        printed = totals.of(shown).get("rows", 0)
    finally:
        spark.streams.removeListener(totals)
    return spark.createDataFrame([(printed,)], "rows_printed bigint")


@query
def stream_batch_sink(spark, sf):
    """Completed trips and orphans of the keyed pairing, each in its folder."""
    folder = scratch_dir(spark, "batches")
    with keyed_state(spark):
        stream_sinks.stream_batch_sink(
            pairing.stream_pairing(trip_event_stream(spark, sf)),
            f"{folder}/completed", f"{folder}/orphan", f"{folder}/checkpoint", max_records=1000,
        ).awaitTermination()
    return _paired_rows(spark, folder)


@query
def table_create(spark, sf):
    path = f"{scratch_dir(spark, 'lake')}/completed_trips"
    lake.table_create(spark, path)
    lake.table_create(spark, path)
    lake.table_append(_with_id(_clean(spark, sf, keys=True)), path)
    return lake.table_scan_versioned(spark, path).agg(F.count("*").alias("total_rows"))


def _two_appends(spark: SparkSession, sf: str) -> tuple[str, int, int]:
    """Month 1, then month 2 of the written clean trips; each append reads its own partition."""
    folder = scratch_dir(spark, "lake")
    sinks.sink_partitioned(_with_id(_clean(spark, sf, keys=True)), f"{folder}/clean")
    path = f"{folder}/completed_trips"
    lake.table_create(spark, path)
    trips = files.scan_partitioned(spark, f"{folder}/clean")
    ids = [lake.table_append(trips.filter(F.col("pickup_month") == month), path) for month in (1, 2)]
    return path, *ids


@query
def table_append(spark, sf):
    path, *ids = _two_appends(spark, sf)
    rows = lake.table_scan_versioned(spark, path)
    return rows.groupBy("payment_type").agg(
        F.count("*").alias("total_trips"), F.lit(max(ids)).cast("bigint").alias("latest_snapshot")
    )


@query
def table_history(spark, sf):
    path, *_ = _two_appends(spark, sf)
    return lake.table_history(spark, path).select("snapshot_id", "row_count")


@query
def time_travel(spark, sf):
    path, first, _ = _two_appends(spark, sf)
    return lake.time_travel(spark, path, first)


@query
def snapshot_compare(spark, sf):
    path, first, last = _two_appends(spark, sf)
    counts = [
        lake.time_travel(spark, path, n).agg(
            F.lit(n).cast("bigint").alias("snapshot_id"), F.count("*").alias("total_rows")
        )
        for n in (first, last)
    ]
    return counts[0].unionByName(counts[1])


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("vector"),
        F.struct(F.concat(F.lit("label_"), "label").alias("source"), "label").alias("payload"),
    )


def _label_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """One query vector per label: the mean of the label's vectors."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    # as many rows per label as a vector has dimensions
    whole = F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    return means.groupBy("label").agg(whole.alias("vector"))


@query
def vector_collection_replace(spark, sf):
    path = scratch_dir(spark, "collection")
    for _ in range(2):
        sinks.vector_collection_replace(_points(spark, sf), path, dim=64)
    return sinks.collection_info(spark, path)


@query
def vector_upsert(spark, sf):
    """A stored collection after two equal upserts: the lowest and a new id of every label get a new point."""
    path = scratch_dir(spark, "collection")
    collections.create_collection(_points(spark, sf), path, dim=64)
    lowest = table(spark, sf, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("vector"), F.min("vec_id").alias("low"))
    turned = F.reverse("vector")
    new = lowest.select(
        F.explode(F.array("low", -F.col("low") - 1)).alias("id"),
        turned.alias("vector"),
        F.struct(F.concat(F.lit("new_"), "label").alias("source"), "label").alias("payload"),
    )
    for _ in range(2):
        collections.upsert(spark, path, new)
    stored = collections.read_collection(spark, path)
    # a sum in which every value has its own weight tells vectors apart
    weighed = F.aggregate(F.transform("vector", lambda x, at: x.cast("double") * (at + 1)), F.lit(0.0), lambda s, x: s + x)
    return stored.select("id", "payload.source", "payload.label", F.size("vector").alias("dim"), F.round(weighed, 6).alias("weighed"))


@query
def clustered_topk(spark, sf):
    """The search of ``vector_topk`` on the points stored by cluster."""
    path = scratch_dir(spark, "clusters")
    collections.build_clusters(_points(spark, sf), path, dim=64)
    queries = _label_vectors(spark, sf).withColumnRenamed("label", "query_id")
    top = collections.clustered_topk(queries, path).withColumn("score", F.round("score", 6))
    return top.select("query_id", "rank", "id", "score", F.col("payload.source").alias("source"))


# Projections and scalar functions


@query
def rename_project(spark, sf):
    return cleaning.rename_project(raw_trips(spark, sf))


@query
def derive_tip_pct(spark, sf):
    paid = _renamed(spark, sf).filter(F.col("fare_amount") > 0)
    return cleaning.derive_tip_pct(paid).select(*TRIP_KEY, "tip_pct")


@query
def derive_duration(spark, sf):
    return cleaning.derive_duration(_renamed(spark, sf)).select(*TRIP_KEY, "duration_minutes")


@query
def derive_calendar(spark, sf):
    names = ("pickup_hour", "pickup_day", "pickup_month")
    return cleaning.derive_calendar(_renamed(spark, sf)).select(*TRIP_KEY, *names)


@query
def label_payment(spark, sf):
    label = S.label_payment(F.col("payment_type")).alias("payment_method")
    return raw_trips(spark, sf).select(*TRIP_KEY, "payment_type", label)


@query
def stg_trips(spark, sf):
    return _stg(spark, sf)


@query
def bucket_tip(spark, sf):
    bucket = S.bucket_tip(F.col("tip_amount"), F.col("fare_amount")).alias("tip_bucket")
    return raw_trips(spark, sf).filter(F.col("fare_amount") > 0).select(*TRIP_KEY, bucket)


@query
def bucket_fare(spark, sf):
    return raw_trips(spark, sf).select(*TRIP_KEY, S.bucket_fare(F.col("fare_amount")).alias("fare_bucket"))


@query
def cast_table_schema(spark, sf):
    # the fractional column shows the rounding of a cast to a whole number
    trips = _with_id(_renamed(spark, sf)).withColumn("passenger_count", F.col("trip_distance") / 2)
    return lake.cast_table_schema(trips)


@query
def ts_to_string(spark, sf):
    return table(spark, sf, "events").select("event_id", S.ts_to_string(F.col("ts")).alias("ts_text"))


@query
def gen_id(spark, sf):
    trips = raw_trips(spark, sf)
    return trips.select(S.key_id(*TRIP_KEY).alias("trip_key"), F.length(S.random_id()).alias("uuid_length"))


@query
def json_encode(spark, sf):
    trips = _with_id(_clean(spark, sf, keys=True))
    return events.json_encode(trips, ["trip_id", *events.START_COLS]).select("trip_id", "value")


@query
def json_decode(spark, sf):
    halves = events.explode_trip_events(_with_id(_clean(spark, sf, keys=True)), "trip_id")
    return events.json_decode(events.key_value(halves.select("event.*")).select("value")).drop("raw")


@query
def null_guard_ratio(spark, sf):
    ratio = S.null_guard_ratio(F.sum("tip_amount"), F.sum("trip_distance"), 100)
    rows = raw_trips(spark, sf).groupBy("PULocationID", "trip_distance")
    return rows.agg(S.mean(ratio).alias("tip_per_distance"))


@query
def trunc_day(spark, sf):
    return table(spark, sf, "events").select("event_id", S.trunc_day(F.col("ts")).alias("day"))


@query
def text_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.text_preview(F.col("text")).alias("preview"))


# Filters


@query
def clean_trips(spark, sf):
    return _clean(spark, sf)


@query
def clean_preview(spark, sf):
    return cleaning.clean_preview(raw_trips(spark, sf))


@query
def partition_filter(spark, sf):
    path = scratch_dir(spark, "clean")
    sinks.sink_partitioned(_clean(spark, sf), path)
    month = files.scan_partitioned(spark, path).filter(F.col("pickup_month") == 1)
    return month.select("pickup_datetime", "pickup_location_id", "fare_amount", "trip_distance")


@query
def predicate_forms(spark, sf):
    fare, distance, kind = F.col("fare_amount"), F.col("trip_distance"), F.col("payment_type")
    forms = {
        "gt": fare > 0,
        "ge": distance >= 0,
        "le": F.col(cleaning.PICKUP) <= F.col(cleaning.DROPOFF),
        "eq": distance == 0,
        "in_between": kind.between(1, 4),
        "not_between": ~kind.between(1, 4),
        "in_list": F.month(cleaning.PICKUP).isin(1, 2),
        "not_in_list": ~F.month(cleaning.PICKUP).isin(1, 2),
        "not_both": ~((distance == 0) & (fare <= 0)),
        "either": (distance == 0) | (fare <= 0),
    }
    return raw_trips(spark, sf).agg(*[F.count_if(cond).alias(name) for name, cond in forms.items()])


# Aggregations


def _over_raw(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    _REGISTRY[name] = lambda spark, sf: build(raw_trips(spark, sf))


for _report in (
    profile.basic_stats,
    profile.revenue_by_weekday,
    profile.busiest_hours,
    profile.revenue_by_payment_raw,
    profile.tip_distribution,
    cleaning.quality_counts,
    profile.zero_distance_by_payment,
    profile.zero_distance_fares,
    cleaning.quality_audit,
):
    _over_raw(_report.__name__, _report)


@query
def daily_revenue(spark, sf):
    return marts.daily_revenue(_stg(spark, sf))


@query
def payment_summary(spark, sf):
    return marts.payment_summary(_stg(spark, sf))


@query
def lake_revenue_by_payment(spark, sf):
    return profile.revenue_by_payment(lake.table_scan_versioned(spark, _two_appends(spark, sf)[0]))


@query
def health_report(spark, sf):
    return events.health_report(trip_events(spark, sf))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents"), "doc_id")
    return retrieval.chunk_docs(docs, keys=("doc_id", "source"))


@query
def chunk_stats(spark, sf):
    return retrieval.chunk_stats(_chunks(spark, sf), keys=("doc_id",))


@query
def chunk_totals(spark, sf):
    return retrieval.chunk_totals(_chunks(spark, sf), keys=("doc_id",))


@query
def lake_top_pickups(spark, sf):
    return profile.top_pickups(lake.table_scan_versioned(spark, _two_appends(spark, sf)[0]))


# Shares and order


@query
def pct_of_total(spark, sf):
    counts = raw_trips(spark, sf).groupBy("PULocationID").agg(F.count("*").alias("total_trips"))
    return shares.pct_of_total(counts, "total_trips", "pct_of_trips")


@query
def pct_of_group(spark, sf):
    counts = _stg(spark, sf).groupBy("pickup_day", "payment_method").agg(F.count("*").alias("total_trips"))
    return shares.pct_of_group(counts, "total_trips", ["pickup_day"], "pct_of_day")


@query
def order_single(spark, sf):
    counts = raw_trips(spark, sf).groupBy("PULocationID").agg(F.count("*").alias("total_trips"))
    return shares.order_single(counts, "total_trips", "PULocationID")


@query
def order_multi(spark, sf):
    counts = _stg(spark, sf).groupBy("pickup_month", "pickup_hour").agg(F.count("*").alias("total_trips"))
    return shares.order_multi(counts, "pickup_month", F.desc("total_trips"), "pickup_hour")


@query
def top_pickups(spark, sf):
    return profile.top_pickups(_clean(spark, sf))


@query
def sample_limit(spark, sf):
    return shares.sample_limit(_clean(spark, sf, keys=True), SAMPLE_ROWS, ["pickup_datetime", *TRIP_KEY])


# Joins and pairing


@query
def explode_trip_events(spark, sf):
    trips = _with_id(_clean(spark, sf, keys=True))
    return events.explode_trip_events(trips, "trip_id").select("event.*")


def _starts_ends(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = trip_events(spark, sf)
    kind = F.col("event_type")
    return rows.filter(kind == events.START), rows.filter(kind == events.END)


@query
def interval_join(spark, sf):
    return events.interval_join(*_starts_ends(spark, sf))


@query
def pair_latest_start(spark, sf):
    return events.pair_latest_start(trip_events(spark, sf))


@query
def orphan_ends(spark, sf):
    return events.orphan_ends(trip_events(spark, sf))


@query
def unmatched_starts(spark, sf):
    return events.unmatched_starts(trip_events(spark, sf))


# Streaming


@query
def stream_interval_join(spark, sf):
    folder = scratch_dir(spark, "interval")
    joined = joins.stream_interval_join(trip_event_stream(spark, sf))
    return stream_sinks.run_to_table(spark, joined, f"{folder}/out", f"{folder}/checkpoint")


@query
def stream_unmatched(spark, sf):
    folder = scratch_dir(spark, "unmatched")
    joined = joins.stream_unmatched(trip_event_stream(spark, sf))
    return stream_sinks.run_to_table(spark, joined, f"{folder}/out", f"{folder}/checkpoint")


def _paired_rows(spark: SparkSession, folder: str) -> DataFrame:
    done = spark.read.parquet(f"{folder}/completed").drop("batch_id")
    orphans = spark.read.parquet(f"{folder}/orphan").drop("batch_id")
    return done.withColumn("kind", F.lit("completed")).unionByName(
        orphans.withColumn("kind", F.lit("orphan")), allowMissingColumns=True
    )


def _kinds(spark: SparkSession, rows: DataFrame, name: str, *kinds: str) -> DataFrame:
    """The rows of these kinds after a run of the keyed pairing over its present input."""
    folder = scratch_dir(spark, name)
    with keyed_state(spark):
        stream_sinks.stream_kinds_sink(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    found = stream_sinks.read_kinds(spark, rows, f"{folder}/out").drop("batch_id").filter(F.col("kind").isin(*kinds))
    # the orphan report has no drop-off place
    place = F.when(F.col("kind") != "orphan", F.col("dropoff_location_id"))
    return found.withColumn("dropoff_location_id", place)


@query
def stream_pairing(spark, sf):
    rows = pairing.stream_pairing(trip_event_stream(spark, sf))
    return _kinds(spark, rows, "pairing", "completed", "orphan")


@query
def stream_pairing_partitions(spark, sf):
    """The pairing of a topic whose partitions share the events of a trip."""
    messages = _topic(spark, sf).filter(~F.col("malformed")).drop("malformed", "raw")
    return _kinds(spark, pairing.stream_pairing(messages), "partitions", "completed", "orphan")


@query
def stream_pairing_sliced(spark, sf):
    """The pairing that slices hot ids, batch by batch."""
    folder = scratch_dir(spark, "pairing")
    pairing.stream_pairing_sink(trip_event_stream(spark, sf), folder).awaitTermination()
    return _paired_rows(spark, folder)


@query
def stream_state_ttl(spark, sf):
    rows = pairing.stream_pairing_expiring(trip_event_stream(spark, sf), "2 hours")
    return _kinds(spark, rows, "expiring", "completed", "orphan", "expired")


@query
def stream_health(spark, sf):
    """Totals that a listener adds up over all progress reports of the keyed pairing."""
    folder = scratch_dir(spark, "health")
    totals = progress.ProgressTotals(_name("health"))
    spark.streams.addListener(totals)
    try:
        with keyed_state(spark):
            paired = pairing.stream_health(pairing.stream_pairing(trip_event_stream(spark, sf)), totals.name)
            query = stream_sinks.stream_kinds_sink(paired, f"{folder}/out", f"{folder}/checkpoint")
            health = progress.health_of(totals.of(query))
    finally:
        spark.streams.removeListener(totals)
    return spark.createDataFrame([tuple(health.values())], ", ".join(f"{name} bigint" for name in health))


# Data tests and the chain


@query
def test_not_null(spark, sf):
    labelled = raw_trips(spark, sf).withColumn("payment_method", S.label_payment(F.col("payment_type")))
    return checks.test_not_null(labelled, "payment_method").select(*TRIP_KEY, "payment_type")


@query
def test_accepted_values(spark, sf):
    months = raw_trips(spark, sf).select(F.month(cleaning.PICKUP).alias("pickup_month"))
    return checks.test_accepted_values(months, "pickup_month", cleaning.MONTHS)


@query
def test_daily_bounds(spark, sf):
    return checks.test_daily_bounds(daily_revenue(spark, sf), DAILY_BOUNDS)


@query
def test_no_future(spark, sf):
    return checks.test_no_future(daily_revenue(spark, sf), F.lit(AS_OF_DATE).cast("date"))


@query
def test_payment_bounds(spark, sf):
    return checks.test_payment_bounds(payment_summary(spark, sf), PAYMENT_BOUNDS)


@query
def test_suite(spark, sf):
    # three models read the clean trips: written once, they are not derived three times
    path = scratch_dir(spark, "clean")
    sinks.sink_partitioned(_clean(spark, sf), path)
    stg = marts.stg_trips(files.scan_partitioned(spark, path))
    models = (marts.daily_revenue(stg), marts.payment_summary(stg))
    today = F.lit(AS_OF_DATE).cast("date")
    return chain.all_tests(stg, *models, DAILY_BOUNDS, PAYMENT_BOUNDS, today)


@query
def run_chain(spark, sf):
    steps = chain.run_pipeline(spark, raw_trips(spark, sf), scratch_dir(spark, "chain"))
    return steps.select("step", "row_count")


# Retrieval


@query
def chunk_docs(spark, sf):
    return _chunks(spark, sf)


@query
def embed_batch(spark, sf):
    vectors = retrieval.embed_batch(_chunks(spark, sf))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    return vectors.select(
        "doc_id", "chunk_index", F.size("vector").alias("dim"), F.round(norm, 3).alias("norm")
    )


@query
def embed_slots(spark, sf):
    """Chunk vectors of the encoder that the search uses, as weighted sums that tell vectors apart."""
    vectors = answers.encoder()(_chunks(spark, sf), "text")
    x = F.transform("vector", lambda v: v.cast("bigint"))

    def total(weight):
        return F.aggregate(F.transform(x, lambda v, at: v * weight(at, v)), F.lit(0).cast("bigint"), lambda s, v: s + v)

    return vectors.select(
        "doc_id",
        "chunk_index",
        F.size("vector").alias("dim"),
        total(lambda at, v: F.lit(1)).alias("words"),
        total(lambda at, v: at + 1).alias("weighed"),
        total(lambda at, v: v).alias("squares"),
    )


def _label_topk(spark: SparkSession, sf: str) -> DataFrame:
    queries = _label_vectors(spark, sf).withColumnRenamed("label", "query_id")
    # ranked by the full score; the score shown is rounded
    return retrieval.vector_topk(queries, _points(spark, sf)).withColumn("score", F.round("score", 6))


@query
def vector_topk(spark, sf):
    top = _label_topk(spark, sf)
    return top.select("query_id", "rank", "id", "score", F.col("payload.source").alias("source"))


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark items as questions."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _searched(spark: SparkSession, sf: str) -> DataFrame:
    """All documents cut, embedded and stored; the best chunks for every question."""
    path, encode = scratch_dir(spark, "chunks"), answers.encoder()
    docs = spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    answers.index_documents(docs, path, encode)
    # ranked by the full score; the score shown is rounded
    return answers.search(spark, _questions(spark, sf), path, encode).withColumn("score", F.round("score", 6))


@query
def search(spark, sf):
    return _searched(spark, sf).select(
        "query_id", "rank", "id", "score", "payload.source", "payload.chunk_index", "payload.token_count", "payload.text"
    )


@query
def build_context(spark, sf):
    return retrieval.build_context(_searched(spark, sf))


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "embeddings").select(F.col("label").alias("query_id")).distinct()
    return labels.select(
        "query_id",
        F.format_string("What belongs to label %d?", "query_id").alias("question"),
        F.concat(F.lit("label_"), "query_id").alias("expected_source"),
    )


@query
def build_prompt(spark, sf):
    return answers.prompts(_searched(spark, sf), _questions(spark, sf))


@query
def recall_at_k(spark, sf):
    return retrieval.recall_at_k(_label_topk(spark, sf), _cases(spark, sf))


@query
def eval_report(spark, sf):
    report = retrieval.eval_report(_label_topk(spark, sf), _cases(spark, sf))
    return report.withColumn("sources", F.array_join("sources", ","))


def _answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """User turns with their words as keywords, and the assistant turn that follows, if any does."""
    turns = table(spark, sf, "conversations")
    key = F.struct("conv_id", "turn").alias("query_id")
    asked = turns.filter(F.col("role") == "user").withColumn("turn", F.col("turn") + 1)
    answered = turns.filter(F.col("role") == "assistant")
    return (
        answered.select(key, F.col("text").alias("answer")),
        asked.select(key, retrieval.tokens(F.lower("text")).alias("expected_keywords")),
    )


@query
def answer_keywords(spark, sf):
    out = retrieval.answer_keywords(*_answers(spark, sf))
    missing, found = (F.array_join(name, " ").alias(name) for name in ("missing", "found"))
    return out.select("query_id.conv_id", "query_id.turn", "all_found", missing, found)


@query
def answer_accuracy(spark, sf):
    return retrieval.answer_accuracy(*_answers(spark, sf))
