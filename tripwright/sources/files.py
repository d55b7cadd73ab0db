"""File scans, schema and row-count reports, whole-document reads."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import batched
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileInfo, FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripwright.session import scratch_dir

# Folders that documents are dealt over: enough to list them in tasks, each a share of the documents.
DOC_FOLDERS = 256

# Folders that a task lists and files that a task reads, unless there are fewer than cores; bytes that a task reads.
PATHS_A_TASK, BYTES_A_TASK = 2000, 64 << 20
# Rows and bytes after which a task hands on what it listed or read.
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20

LISTED = "root string, path string, size bigint, is_folder boolean"
FOUND = "source string not null, folder string not null, data binary"
# Packed files that Arrow unpacks, by their ending, and those that only Hadoop unpacks.
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
HADOOP_PACKED = r"\.(deflate|lz4|snappy)$"
# Characters that paths in Spark's file metadata show by their UTF-8 bytes.
QUOTED = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0]|\s""")


def scan_raw(spark: SparkSession, path: str, **opts: str) -> DataFrame:
    """All Parquet files under a path or glob; schema from the footers."""
    return spark.read.options(**opts).parquet(path)


def scan_partitioned(spark: SparkSession, path: str, **opts: str) -> DataFrame:
    """A Hive-partitioned folder; the partition column comes from the folder names."""
    return spark.read.options(basePath=path, **opts).parquet(path)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: name and type."""
    fields = [
        F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("type"))
        for name, dtype in df.dtypes
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def doc_write(docs: DataFrame, path: str) -> None:
    """A text file per document (id, text) below ``path``, in a folder ``<id column>=<id>``, each line end a newline.

    Rows of one id in one task share a file. Null is an empty line; the id null
    has the folder of the empty text. A repeated task writes the same files again.
    Spark's own writer asks for permissions by a process per file on a local disk,
    and moves every folder on the driver; here a task only writes. ``path`` is
    one that Arrow can open (local, HDFS or an object store).
    """
    id_col, text_col = docs.columns

    def write(rows: Iterator[Row]) -> None:
        files, top = FileSystem.from_uri(path)
        task, before, out = TaskContext.get().partitionId(), None, None
        for doc_id, text in rows:
            name = "" if doc_id is None else str(doc_id)
            if name != before:
                if out is not None:
                    out.close()
                folder = f"{top}/{zlib.crc32(name.encode()) % DOC_FOLDERS:03d}/{id_col}={name}"
                files.create_dir(folder)
                before, out = name, files.open_output_stream(f"{folder}/{task}.txt")
            out.write((text or "").encode() + b"\n")
        if out is not None:
            out.close()

    docs.select(id_col, text_col).sortWithinPartitions(id_col).foreachPartition(write)


def doc_load(spark: SparkSession, path: str | list[str], pattern: str = "*.{md,txt}") -> DataFrame:
    """Every matching file below ``path``, each as one row of its name, its folder's name and whole text.

    Tasks list the folders, level by level, and read the files; the driver holds
    the matches of a glob, but no file below them, so its memory does not grow
    with the documents. A folder's entries are held by the task that lists it.
    The list is kept under ``spark.checkpoint.dir``. Files are taken, skipped
    (empty, hidden) and named as by Spark's text reader. That one still reads,
    and holds every file on the driver, where Arrow cannot open ``path`` (as
    with ``s3a``) or a file is packed in a way that only Hadoop knows.
    """
    roots = _roots(spark, path)
    if roots is None:
        return _spark_docs(spark, path, pattern)
    listed = _listed(spark, roots, pattern)
    n, size, hadoop = listed.agg(F.count("*"), F.sum("size"), F.bool_or(F.rlike("path", F.lit(HADOOP_PACKED)))).first()
    if hadoop:
        return _spark_docs(spark, path, pattern)
    dealt = listed.select("root", "path").repartition(max(_tasks(spark, n), (size or 0) // BYTES_A_TASK))
    return dealt.mapInArrow(_reader(), FOUND).select("source", "folder", F.col("data").cast("string").alias("text"))


def _spark_docs(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """``doc_load`` by Spark's text reader, whose driver lists every file."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(
            F.col("_metadata.file_name").alias("source"),
            F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)/[^/]*$", 1).alias("folder"),
            F.col("value").alias("text"),
        )
    )


def _roots(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str, int, bool]] | None:
    """What ``path`` matches, as rows of ``LISTED``; None if that is nothing or Arrow cannot open it."""
    conf, rows = spark._jsparkSession.sessionState().newHadoopConf(), []
    try:
        for one in [path] if isinstance(path, str) else path:
            at = spark._jvm.org.apache.hadoop.fs.Path(one)
            matches = at.getFileSystem(conf).globStatus(at)
            if not matches:
                return None
            for match in matches:
                uri = match.getPath().toUri().toASCIIString()
                files, name = FileSystem.from_uri(uri)
                info = files.get_file_info(name)
                if info.type == FileType.NotFound:
                    return None
                rows.append((uri, name, info.size, info.type == FileType.Directory))
    except (pa.ArrowException, OSError):
        return None
    return rows


def _tasks(spark: SparkSession, paths: int) -> int:
    """Tasks for so many folders to list or files to read."""
    return max(1, min(paths, spark.sparkContext.defaultParallelism), paths // PATHS_A_TASK)


def _listed(spark: SparkSession, roots: list[tuple[str, str, int, bool]], pattern: str) -> DataFrame:
    """The matching files at and below the roots; each level's folders are listed in tasks and written."""
    wanted = re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern(), re.DOTALL)

    # plain closures, so they reach executors that lack this package
    def taken(info: FileInfo) -> bool:
        name = info.base_name
        hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
        if info.type == FileType.Directory:
            return not hidden or name.startswith(("_metadata", "_common_metadata"))
        return info.type == FileType.File and not hidden and info.size > 0 and bool(wanted.fullmatch(name))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        stores = {}
        for batch in batches:
            for row in batch.to_pylist():
                root, path = row["root"], row["path"]
                if root not in stores:
                    stores[root] = FileSystem.from_uri(root)[0]
                for info in stores[root].get_file_info(FileSelector(path) if row["is_folder"] else [path]):
                    if taken(info):
                        yield root, info.path, info.size, info.type == FileType.Directory

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.bool_()]
        for rows in batched(below(batches), BATCH_ROWS):
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, ["root", "path", "size", "is_folder"])

    top, levels = scratch_dir(spark, "listing"), []
    above, n = spark.createDataFrame(roots, LISTED), len(roots)
    while n:
        levels.append(f"{top}/{len(levels)}")
        above.repartition(_tasks(spark, n)).mapInArrow(entries, LISTED).write.parquet(levels[-1])
        above = spark.read.schema(LISTED).parquet(levels[-1]).filter("is_folder")
        n = above.count()
    return spark.read.schema(LISTED).parquet(*levels).filter("NOT is_folder")


def _reader():
    """The in-task part: files of ``LISTED`` as rows of ``FOUND``."""

    def shown(name: str) -> str:
        return QUOTED.sub(lambda found: quote(found[0], safe=""), name)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores, held, size = {}, [], 0

        def handed() -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*held), (pa.string(), pa.string(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["source", "folder", "data"])

        for batch in batches:
            for row in batch.to_pylist():
                root, path = row["root"], row["path"]
                if root not in stores:
                    stores[root] = FileSystem.from_uri(root)[0]
                packing = next((kind for end, kind in PACKED.items() if path.endswith(end)), None)
                with stores[root].open_input_stream(path, compression=packing) as stream:
                    data = stream.read()
                folder, source = ("/" + path).split("/")[-2:]
                held.append((shown(source), shown(folder), data))
                size += len(data)
                if size >= BATCH_BYTES or len(held) == BATCH_ROWS:
                    yield handed()
                    held, size = [], 0
        if held:
            yield handed()

    return read
