"""Registers a folder of Parquet files as a table and keeps its schema up to date."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_register(
    spark: SparkSession, table: str, path: str, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """Creates or refreshes ``table`` over ``path``; gives one row per schema change.

    Columns new in the files are added to the table. Columns the files no
    longer have are reported as missing and kept. New partition folders are
    picked up.
    """
    if "." in table:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    found = spark.read.option("mergeSchema", "true").parquet(path).dtypes
    changes: list[tuple[str, str]] = []
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{name}` {dtype}" for name, dtype in found)
        layout = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{layout} LOCATION '{path}'")
        changes += [(name, "created") for name, _ in found]
    else:
        known = {name for name, _ in spark.table(table).dtypes}
        new = [(name, dtype) for name, dtype in found if name not in known]
        if new:
            columns = ", ".join(f"`{name}` {dtype}" for name, dtype in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        changes += [(name, "added") for name, _ in new]
        changes += [(name, "missing") for name in sorted(known - {name for name, _ in found})]
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
    # one row per column of one table
    return spark.createDataFrame(changes, "column string, change string").orderBy(F.col("column"))


# Types whose values all fit the later ones of the same row.
WIDER = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"))


def is_wider(new: str, old: str) -> bool:
    """Whether every value of type ``old`` is one of type ``new``."""
    return any(old in row and new in row and row.index(new) > row.index(old) for row in WIDER)


def schema_drift(spark: SparkSession, table: str, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """How the files of each partition differ from the table: partition, column, change, table_type, file_type.

    ``change`` is ``added`` or ``lost`` (a column only the files or only the table
    has), ``widened`` or ``narrowed`` (the files' type holds more or fewer values)
    or ``retyped``. Spark reads the footers of a partition's files in parallel;
    files of one partition that disagree give ``conflict``. Nothing but file names
    is listed, and one row per partition folder comes to the driver.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    folders = [r[0] for r in names.load(path).select(folder.alias("folder")).distinct().orderBy("folder").collect()]
    known = {name: kind for name, kind in spark.table(table).dtypes if name not in partition_cols}
    found: list[tuple[str, str | None, str, str | None, str | None]] = []
    for place in folders:
        partition = "/".join(part for part in place.split("/") if part.split("=")[0] in partition_cols)
        try:
            own = dict(spark.read.option("mergeSchema", "true").parquet(place).dtypes)
        except Py4JJavaError as unfit:
            if "CANNOT_MERGE_SCHEMAS" not in str(unfit.java_exception):
                raise
            found.append((partition, None, "conflict", None, None))
            continue
        for name in sorted({*known, *own}):
            old, new = known.get(name), own.get(name)
            if old == new:
                continue
            if old is None or new is None:
                change = "added" if old is None else "lost"
            else:
                change = "widened" if is_wider(new, old) else "narrowed" if is_wider(old, new) else "retyped"
            found.append((partition, name, change, old, new))
    return spark.createDataFrame(found, "partition string, column string, change string, table_type string, file_type string")


def widen_table(spark: SparkSession, table: str, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Registers the table anew with the widest type of each column, so that all partitions read; gives the drift.

    The files stay as they are: a reader of the wide type takes narrow files.
    Types that no type holds together (``retyped``) keep the table's.
    """
    drift = schema_drift(spark, table, path, partition_cols)
    types = dict(spark.table(table).dtypes)
    # one row per changed column and partition folder
    for row in drift.filter(F.col("change").isin("added", "widened")).orderBy("partition").collect():
        if row["column"] not in types or is_wider(row["file_type"], types[row["column"]]):
            types[row["column"]] = row["file_type"]
    order = [c for c in types if c not in partition_cols] + list(partition_cols)
    columns = ", ".join(f"`{name}` {types[name]}" for name in order)
    layout = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    # the table is external: dropping it leaves the files
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{layout} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return drift
