"""Stream sinks: keyed messages, console, and completed/orphan Parquet folders."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripwright.operators.events import COMPLETED_COLS, ORPHAN_COLS, key_value


def stream_kv_sink(events: DataFrame, opts: Mapping[str, str]) -> StreamingQuery:
    """Sends events as JSON keyed by trip id; ``opts`` names the servers, topic and checkpoint."""
    return key_value(events).writeStream.format("kafka").options(**opts).start()


def first_of_tasks(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each partition. All rows are computed, as metrics observed on ``df`` need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = n
        for batch in batches:
            if left > 0:
                yield batch.slice(0, left)
                left -= batch.num_rows

    return df.mapInArrow(run, df.schema)


def stream_print_sink(df: DataFrame, opts: Mapping[str, str] | None = None) -> StreamingQuery:
    """Prints the first rows of each micro-batch (20, or ``numRows``); for development.

    The console sink fetches its whole batch to the driver. So each task passes on
    only what may be printed, and one row more, by which the sink sees that it cuts.
    """
    shown = next((int(value) for name, value in (opts or {}).items() if name.lower() == "numrows"), 20)
    writer = first_of_tasks(df, shown + 1).writeStream.format("console").outputMode("append")
    return writer.options(**(opts or {})).trigger(availableNow=True).start()


def write_batch(rows: DataFrame, directory: str, batch_id: int, max_records: int | None = None) -> None:
    """Writes one micro-batch to its own folder. A repeated batch replaces itself."""
    writer = rows.write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(f"{directory}/batch_id={batch_id}")


def write_kinds(
    paired: DataFrame, completed_dir: str, orphan_dir: str, batch_id: int, max_records: int | None = None
) -> None:
    """Splits paired rows by ``kind`` into the completed and the orphan folder."""
    kind = F.col("kind")
    completed = paired.filter(kind == "completed").select(*COMPLETED_COLS)
    orphans = paired.filter(kind == "orphan").select(*ORPHAN_COLS, "reason")
    write_batch(completed, completed_dir, batch_id, max_records)
    write_batch(orphans, orphan_dir, batch_id, max_records)


def stream_batch_sink(
    paired: DataFrame,
    completed_dir: str,
    orphan_dir: str,
    checkpoint: str,
    max_records: int | None = None,
) -> StreamingQuery:
    """Writes a stream of paired rows to two Parquet folders, once per batch number.

    ``max_records`` bounds the rows per file. Small files suit a few thousand
    events; at scale leave it unset.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # two writes read the batch: keep it, or the stateful part would run twice
        held = batch.persist()
        try:
            write_kinds(held, completed_dir, orphan_dir, batch_id, max_records)
        finally:
            held.unpersist()

    return drain(paired, write, checkpoint)


def stream_kinds_sink(rows: DataFrame, out: str, checkpoint: str, max_records: int | None = None) -> StreamingQuery:
    """Writes a stream with a ``kind`` column below ``out``, one folder per batch number and kind.

    A batch is read once for all its kinds. A repeated batch replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").partitionBy("kind")
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.parquet(f"{out}/batch_id={batch_id}")

    return drain(rows, write, checkpoint)


def read_kinds(spark: SparkSession, rows: DataFrame, out: str) -> DataFrame:
    """What ``stream_kinds_sink`` wrote of ``rows``, with the batch numbers."""
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(out)


def stream_kv_files(
    events: DataFrame, out: str, checkpoint: str, partitions: int = 8, id_col: str = "trip_id", arrival: str = "arrival"
) -> StreamingQuery:
    """Keyed messages as files: (key, value, position) below batch number and partition.

    The file twin of ``stream_kv_sink``: a key's messages lie in one partition, in
    the order of arrival (``position``), as in a topic. A repeated batch replaces
    itself, so every message is there once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        carried = [c for c in batch.columns if c not in (arrival, "event_time")]
        value = F.to_json(F.struct(*carried))
        rows = batch.select(F.col(id_col).alias("key"), value.alias("value"), F.col(arrival).alias("position"))
        rows = rows.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
        ordered = rows.repartition(partitions, "partition").sortWithinPartitions("partition", "position")
        ordered.write.mode("overwrite").partitionBy("partition").parquet(f"{out}/batch_id={batch_id}")

    return drain(events, write, checkpoint)


def drain(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Starts ``write`` for every micro-batch; ``once`` stops at the end of the present input."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def run_to_table(spark: SparkSession, df: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs a stream over its present input into Parquet and reads the result back."""
    query = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)
