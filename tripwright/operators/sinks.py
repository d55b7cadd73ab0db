"""Batch sinks: partitioned Parquet, views and tables, vector collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def sink_partitioned(
    df: DataFrame, path: str, partition_col: str = "pickup_month", balance: bool = False
) -> int:
    """Replaces ``path`` by ``df``, partitioned by folder, and returns the rows written.

    By default no shuffle: each task writes the partitions it holds. A shuffle
    by the partition column alone would leave one task per month. ``balance``
    asks for evenly sized files instead; the rebalance splits a large month.
    """
    rows = df.hint("rebalance", F.col(partition_col)) if balance else df
    # counted in the tasks that write, whose failed attempts don't count
    counted = Observation()
    rows.observe(counted, F.count("*").alias("n")).write.mode("overwrite").partitionBy(partition_col).parquet(path)
    return counted.get["n"]


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Registers ``df`` as a view (evaluated on use) or writes it as a table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"kind is view or table, not {kind}")
    return df.sparkSession.table(name)


def vector_collection_replace(points: DataFrame, table: str, dim: int, metric: str = "cosine") -> DataFrame:
    """Replaces the collection at ``table``; a vector of another size fails the write.

    Size and metric are kept with the column and come back on read.
    """
    fits = F.size("vector") == dim
    wrong = F.raise_error(F.concat(F.lit(f"vector size is not {dim}: "), F.size("vector")))
    checked = F.when(fits, F.col("vector")).otherwise(wrong)
    fixed = points.withColumn("vector", checked).withMetadata("vector", {"dim": dim, "metric": metric})
    fixed.write.mode("overwrite").parquet(table)
    return points.sparkSession.read.parquet(table)


def collection_info(spark: SparkSession, table: str) -> DataFrame:
    """Points stored, vector size and metric of a collection."""
    points = spark.read.parquet(table)
    meta = points.schema["vector"].metadata
    return points.agg(F.count("*").alias("points")).select(
        "points", F.lit(meta["dim"]).alias("dim"), F.lit(meta["metric"]).alias("metric")
    )
