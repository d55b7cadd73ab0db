"""Raw trips and trip events built from the order and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.session import scratch_dir

TRIP_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Files, and so micro-batches, that a table is streamed in.
STREAM_FILES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """A scan with at least one partition per core, for work that is heavy per row.

    Shuffles only when the files give fewer splits than there are cores, so
    only inputs of a few splits; a large table is left as it is. ``scan`` must
    be a plain file scan.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines seen as raw trips, with the key columns of the line.

    No hint on the join: Spark broadcasts the orders only where their size on
    disk is below its threshold, and otherwise sorts and merges (with the
    adaptive skew split for a hot order key).
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part, qty, price = F.col("l_partkey"), F.col("l_quantity"), F.col("l_extendedprice")
    minute = part % 1440
    fare, tip, tolls = price - 10000, price * F.col("l_discount"), price * F.col("l_tax")

    def after(minutes):
        zero = F.lit(0)
        return F.col("o_orderdate") + F.make_dt_interval(zero, zero, minutes.cast("int"))

    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        after(minute).alias("tpep_pickup_datetime"),
        after(minute + F.col("l_linenumber") * 10 + qty - 12).alias("tpep_dropoff_datetime"),
        (part % 6).alias("passenger_count"),
        (qty - 1).alias("trip_distance"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        (part % 265).cast("int").alias("DOLocationID"),
        F.when(F.col("l_tax") >= 0.08, 9)
        .otherwise(F.col("l_linenumber") - 1)
        .cast("bigint")
        .alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        (fare + tip + tolls).alias("total_amount"),
        *TRIP_KEY,
    )


def to_trip_events(events: DataFrame) -> DataFrame:
    """User events seen as trip events (views start a trip, purchases end it).

    Works on a batch or a streaming frame. Gives the wide event columns, the
    zoned ``event_time`` and the unique, rising ``arrival`` number.
    """
    kind = F.col("event_type")
    is_start, is_end = kind == "view", kind == "purchase"
    stamp = F.col("ts").cast("string")

    def only(cond, col):
        return F.when(cond, col)

    return events.select(
        F.when(is_start, "trip_started")
        .when(is_end, "trip_ended")
        .otherwise(kind)
        .alias("event_type"),
        F.col("user_id").cast("string").alias("trip_id"),
        only(is_start, stamp).alias("pickup_datetime"),
        only(is_end, stamp).alias("dropoff_datetime"),
        only(is_start, (F.col("event_id") % 265).cast("int")).alias("pickup_location_id"),
        only(is_end, (F.col("event_id") % 263).cast("int")).alias("dropoff_location_id"),
        only(is_start, (F.col("event_id") % 6).cast("int")).alias("passenger_count"),
        only(is_end, F.col("value")).alias("fare_amount"),
        only(is_end, F.col("value") / 4).alias("tip_amount"),
        only(is_end, (F.col("event_id") % 7).cast("int")).alias("payment_type"),
        only(is_end, F.col("value") / 2).alias("trip_distance"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("arrival"),
    )


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_trip_events(table(spark, sf_dir, "events"))


def write_in_order(rows: DataFrame, folder: str, order: str, files: int = STREAM_FILES, *by: str) -> None:
    """Writes ``rows`` as ``files`` files one after the other, cut at quantiles of ``order``.

    A file stream takes files by their time, so it sees the rows in this order.
    With ``by`` each cut is written below folders of these columns, in one file per
    folder; every core reads and derives rows, and each folder has a task that writes.
    """
    shares = [at / files for at in range(1, files)]
    edges = rows.agg(F.percentile_approx(order, shares, 10_000)).first()[0] if files > 1 else []
    bounds = [None, *(edges or []), None]
    cores = rows.sparkSession.sparkContext.defaultParallelism
    for low, high in zip(bounds, bounds[1:]):
        above = F.lit(True) if low is None else F.col(order) > low
        part = rows.filter(above if high is None else above & (F.col(order) <= high))
        part = part.repartition(cores, *by) if by else part.coalesce(1)
        part.write.mode("append").partitionBy(*by).parquet(folder)


def trip_event_stream(spark: SparkSession, sf_dir: str, files: int = STREAM_FILES) -> DataFrame:
    """The same events as a stream of several files, one per micro-batch, in order of arrival."""
    events = table(spark, sf_dir, "events")
    folder = scratch_dir(spark, "events")
    write_in_order(events, folder, "event_id", files)
    return to_trip_events(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder))
