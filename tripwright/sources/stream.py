"""Typed JSON streams from a topic or from files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.operators.events import EVENT_SCHEMA, json_decode


LOG_SCHEMA = "value string, timestamp timestamp, partition int, offset bigint"
# Places of the arrival number for the partition and for the offset, below the microseconds.
OFFSET_PLACES, PARTITION_PLACES = 15, 5


def arrival_order(timestamp: Column, partition: Column, offset: Column) -> Column:
    """A unique number that rises with (timestamp, partition, offset), over all partitions of a topic.

    Offsets under 10^15 and partition numbers under 10^5, in a decimal of 38 places.
    """
    wide = lambda c: c.cast("decimal(38,0)")
    shift = lambda places: F.lit(10**places).cast("decimal(38,0)")
    upper = wide(F.unix_micros(timestamp)) * shift(PARTITION_PLACES) + wide(partition)
    return wide(wide(upper) * shift(OFFSET_PLACES) + wide(offset))


def _ordered(messages: DataFrame) -> DataFrame:
    order = arrival_order(F.col("timestamp"), F.col("partition"), F.col("offset"))
    return messages.select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("event_time"), order.alias("arrival")
    )


def malformed_apart(typed: DataFrame) -> DataFrame:
    """The stream with a ``kind``: ``event``, or ``malformed``, whose text is in ``raw``."""
    return typed.withColumn("kind", F.when(F.col("malformed"), "malformed").otherwise("event"))


def stream_json_source(
    spark: SparkSession, source_opts: Mapping[str, str], schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """A stream of typed events, earliest first, with malformed messages marked.

    ``source_opts["format"]`` is ``kafka`` (needs the connector package),
    ``log`` (a topic as Parquet files of value, timestamp, partition, offset) or
    ``text`` (a folder of JSON lines). From a topic each row also has
    ``event_time`` (the broker's time) and ``arrival``, which orders the messages
    of all partitions (see ``arrival_order``).
    """
    opts = dict(source_opts)
    fmt = opts.pop("format")
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        messages = _ordered(spark.readStream.format("kafka").options(**opts).load())
    elif fmt == "log":
        path = opts.pop("path")
        messages = _ordered(spark.readStream.schema(LOG_SCHEMA).options(**opts).parquet(path))
    elif fmt == "text":
        path = opts.pop("path")
        messages = spark.readStream.options(**opts).text(path)
    else:
        raise ValueError(f"format is kafka, log or text, not {fmt}")
    return json_decode(messages, schema)
