"""Versioned tables: create, append, history, as-of reads.

A table is named by a lake catalog identifier (``lake.trips.completed``)
where the session has such a catalog, and by a folder path otherwise. A folder
holds ``data/snapshot_id=N`` and, written after it, ``log/snapshot_id=N`` with
one row. Readers see only snapshots in the log, so a failed append stays
invisible and the next one overwrites it. A folder takes one writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.functions.scalar import to_whole

# Schema of the completed-trips table.
COMPLETED_SCHEMA = T.StructType(
    [
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
_LOG_SCHEMA = "committed_at timestamp, row_count bigint, snapshot_id bigint"


def _in_catalog(table: str) -> bool:
    return "/" not in table


def cast_table_schema(df: DataFrame, schema: T.StructType = COMPLETED_SCHEMA) -> DataFrame:
    """The schema's columns in its order and types; fractions round half to even."""

    def cast(field: T.StructField):
        if isinstance(field.dataType, T.IntegralType):
            return to_whole(df, field.name, field.dataType.simpleString())
        return F.col(field.name).cast(field.dataType)

    return df.select(*[cast(f).alias(f.name) for f in schema])


def table_create(spark: SparkSession, table: str, schema: T.StructType = COMPLETED_SCHEMA) -> None:
    """Creates the table, and its namespace, unless they exist."""
    if _in_catalog(table):
        namespace = table.rsplit(".", 1)[0]
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING iceberg")
        return
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{table}/schema")


def _declared(spark: SparkSession, table: str) -> T.StructType:
    if _in_catalog(table):
        return spark.table(table).schema
    return spark.read.parquet(f"{table}/schema").schema


def _log(spark: SparkSession, table: str) -> DataFrame:
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(f"{table}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG_SCHEMA)


def _latest(spark: SparkSession, table: str) -> int:
    return _log(spark, table).agg(F.max("snapshot_id")).first()[0] or 0


def table_append(df: DataFrame, table: str) -> int:
    """Appends ``df``, cast to the table's schema, as one snapshot; returns its id."""
    spark = df.sparkSession
    rows = cast_table_schema(df, _declared(spark, table))
    if _in_catalog(table):
        rows.writeTo(table).append()
        newest = table_history(spark, table).orderBy(F.desc("committed_at")).first()
        return newest["snapshot_id"]
    number = _latest(spark, table) + 1
    data = f"{table}/data/snapshot_id={number}"
    rows.write.mode("overwrite").parquet(data)
    written = spark.read.parquet(data).count()
    entry = spark.range(1).select(
        F.current_timestamp().alias("committed_at"), F.lit(written).cast("bigint").alias("row_count")
    )
    entry.coalesce(1).write.mode("overwrite").parquet(f"{table}/log/snapshot_id={number}")
    return number


def table_history(spark: SparkSession, table: str) -> DataFrame:
    """One row per snapshot, oldest first."""
    if _in_catalog(table):
        added = F.col("summary")["added-records"].cast("bigint")
        log = spark.table(f"{table}.snapshots").withColumn("row_count", added)
    else:
        log = _log(spark, table)
    return log.select("snapshot_id", "committed_at", "row_count").orderBy("committed_at", "snapshot_id")


def time_travel(spark: SparkSession, table: str, snapshot_id: int) -> DataFrame:
    """The table as it was at a snapshot; 0 is before the first. An id never committed is an error."""
    if _in_catalog(table):
        return spark.sql(f"SELECT * FROM {table} VERSION AS OF {int(snapshot_id)}")
    if snapshot_id and _log(spark, table).filter(F.col("snapshot_id") == snapshot_id).isEmpty():
        raise ValueError(f"{table} has no snapshot {snapshot_id}")
    return _up_to(spark, table, snapshot_id)


def _up_to(spark: SparkSession, table: str, snapshot_id: int) -> DataFrame:
    schema = _declared(spark, table)
    if snapshot_id < 1:
        return spark.createDataFrame([], schema)
    wide = T.StructType(schema.fields + [T.StructField("snapshot_id", T.LongType())])
    data = spark.read.schema(wide).parquet(f"{table}/data")
    # a partition filter: folders of later snapshots are not listed for reading
    return data.filter(F.col("snapshot_id") <= snapshot_id).select(*schema.names)


def table_scan_versioned(spark: SparkSession, table: str) -> DataFrame:
    """The current version of the table."""
    if _in_catalog(table):
        return spark.table(table)
    return _up_to(spark, table, _latest(spark, table))
