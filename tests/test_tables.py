"""Sinks, versioned tables, table registration and file readers."""

import bz2
import gzip
import zlib

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tripwright.operators import sinks
from tripwright.sources import catalog, files, lake
from tripwright.session import scratch_dir

COMPLETED = [
    ("a", "2024-01-01 00:00:00", "2024-01-01 00:10:00", 1, 2, 1, 10.0, 1.0, 1, 2.0),
    ("b", "2024-02-01 00:00:00", "2024-02-01 00:10:00", 1, 2, 1, 20.0, 1.0, 2, 3.0),
]


def completed(spark, *rows):
    return spark.createDataFrame(list(rows), lake.COMPLETED_SCHEMA)


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.table_create(spark, path)
    assert lake.table_scan_versioned(spark, path).count() == 0
    assert lake.table_history(spark, path).count() == 0
    first = lake.table_append(completed(spark, COMPLETED[0]), path)
    second = lake.table_append(completed(spark, *COMPLETED), path)
    lake.table_create(spark, path)
    assert (first, second) == (1, 2)
    assert [(r["snapshot_id"], r["row_count"]) for r in lake.table_history(spark, path).collect()] == [(1, 1), (2, 2)]
    assert [r["trip_id"] for r in lake.time_travel(spark, path, first).collect()] == ["a"]
    assert lake.time_travel(spark, path, 0).count() == 0
    with pytest.raises(ValueError, match="no snapshot 99"):
        lake.time_travel(spark, path, 99)
    current = lake.table_scan_versioned(spark, path)
    assert current.count() == 3 and current.schema.names == lake.COMPLETED_SCHEMA.names


def test_failed_append_stays_invisible(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.table_create(spark, path)
    lake.table_append(completed(spark, COMPLETED[0]), path)
    # files of an append that stopped before its log entry
    completed(spark, *COMPLETED).write.parquet(f"{path}/data/snapshot_id=2")
    assert lake.table_scan_versioned(spark, path).count() == 1
    lake.table_append(completed(spark, COMPLETED[1]), path)
    assert sorted(r["trip_id"] for r in lake.table_scan_versioned(spark, path).collect()) == ["a", "b"]


def test_as_of_read_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.table_create(spark, path)
    for row in COMPLETED:
        lake.table_append(completed(spark, row), path)
    plan = lake.time_travel(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan


def test_partitioned_sink_replaces_all(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("pickup_month"))
    assert sinks.sink_partitioned(rows, path) == 10
    assert sinks.sink_partitioned(rows.filter("pickup_month = 1"), path, balance=True) == 5
    back = files.scan_partitioned(spark, path)
    assert back.filter("pickup_month = 0").count() == 0
    assert back.count() == 5


def test_register_adds_and_reports(spark, tmp_path):
    path, name = str(tmp_path / "c"), "crawl_test"
    base = spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("pickup_month"))
    sinks.sink_partitioned(base.withColumn("old", F.lit(1)), path)
    created = catalog.catalog_register(spark, name, path, ["pickup_month"])
    assert {r["change"] for r in created.collect()} == {"created"}
    assert spark.table(name).count() == 4
    sinks.sink_partitioned(base.withColumn("new", F.lit("x")), path)
    changes = {tuple(r) for r in catalog.catalog_register(spark, name, path, ["pickup_month"]).collect()}
    assert changes == {("new", "added"), ("old", "missing")}
    assert set(spark.table(name).columns) == {"id", "old", "new", "pickup_month"}
    assert spark.table(name).filter("new = 'x' and old is null").count() == 4
    assert catalog.catalog_register(spark, name, path, ["pickup_month"]).filter("change <> 'missing'").count() == 0


def test_drift_of_types(spark, tmp_path):
    path, name = str(tmp_path / "d"), "drift_test"
    base = spark.range(4).select(F.col("id").cast("int").alias("a"), F.col("id").cast("bigint").alias("b"), F.lit("x").alias("c"))
    base.write.parquet(f"{path}/month=1")
    catalog.catalog_register(spark, name, path, ["month"])
    base.select(F.col("a").cast("bigint") + 2**40, F.col("b").cast("int").alias("b"), F.lit(1.5).alias("d")).toDF("a", "b", "d").write.parquet(f"{path}/month=2")
    base.withColumn("c", F.lit(1)).write.parquet(f"{path}/month=3")
    base.write.parquet(f"{path}/month=4")
    base.withColumn("a", F.lit("text")).write.mode("append").parquet(f"{path}/month=4")
    drift = {tuple(r)[:3]: tuple(r)[3:] for r in catalog.schema_drift(spark, name, path, ["month"]).collect()}
    assert drift == {
        ("month=2", "a", "widened"): ("int", "bigint"),
        ("month=2", "b", "narrowed"): ("bigint", "int"),
        ("month=2", "c", "lost"): ("string", None),
        ("month=2", "d", "added"): (None, "double"),
        ("month=3", "c", "retyped"): ("string", "int"),
        ("month=4", None, "conflict"): (None, None),
    }
    catalog.widen_table(spark, name, path, ["month"])
    wide = spark.table(name).filter("month < 3")
    assert dict(wide.dtypes)["a"] == "bigint" and dict(wide.dtypes)["b"] == "bigint"
    assert [tuple(r) for r in wide.groupBy("month").agg(F.sum("a"), F.sum("b"), F.sum("d")).orderBy("month").collect()] == [
        (1, 6, 6, None), (2, 6 + 4 * 2**40, 6, 6.0)
    ]


def test_documents_are_read_whole(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("one\n\ntwo\n", encoding="utf-8")
    (tmp_path / "sub" / "b.txt").write_text("é", encoding="utf-8")
    (tmp_path / "c.csv").write_text("no", encoding="utf-8")
    docs = files.doc_load(spark, str(tmp_path))
    found = sorted((r["source"], r["text"]) for r in docs.collect())
    assert found == [("a.md", "one\n\ntwo\n"), ("b.txt", "é")]
    assert {r["source"]: r["folder"] for r in docs.collect()}["b.txt"] == "sub"


def test_documents_are_written_by_tasks_below_a_fixed_number_of_folders(spark, tmp_path):
    texts = {at: f"é {at}\n\n" * (at % 3) for at in range(600)} | {-5: None}
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    files.doc_write(rows.repartition(5), str(tmp_path / "docs"))
    found = files.doc_load(spark, str(tmp_path / "docs")).collect()
    assert {r["folder"]: r["text"] for r in found} == {f"doc_id={at}": (text or "") + "\n" for at, text in texts.items()}
    assert len(found) == len(texts)
    # the folders at the top are what Spark's listing shares out among tasks
    assert 32 < len(list((tmp_path / "docs").iterdir())) <= files.DOC_FOLDERS


def test_documents_of_one_id_and_of_none(spark, tmp_path):
    rows = spark.createDataFrame([(7, "a"), (None, "b"), (7, "a")], "doc_id bigint, text string")
    files.doc_write(rows.coalesce(1), f"file://{tmp_path}/docs")
    found = files.doc_load(spark, str(tmp_path / "docs")).collect()
    assert sorted((r["folder"], r["text"]) for r in found) == [("doc_id=", "b\n"), ("doc_id=7", "a\na\n")]


def test_documents_are_listed_by_tasks_not_on_the_driver(spark, tmp_path):
    rows = spark.range(400).select("id", F.concat(F.lit("text "), "id").alias("text"))
    files.doc_write(rows, str(tmp_path / "docs"))
    found = files.doc_load(spark, str(tmp_path / "docs"))
    assert not [name for name in found.inputFiles() if name.endswith(".txt")]
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert {r["folder"]: r["text"] for r in found.collect()} == {f"id={at}": f"text {at}\n" for at in range(400)}


def _by_spark(spark, path, pattern):
    read = spark.read.options(recursiveFileLookup="true", pathGlobFilter=pattern).text(path, wholetext=True)
    folder = F.regexp_extract("_metadata.file_path", "([^/]*)/[^/]*$", 1)
    return read.select(F.col("_metadata.file_name").alias("source"), folder.alias("folder"), F.col("value").alias("text"))


def test_documents_are_taken_as_by_the_text_reader(spark, tmp_path, monkeypatch):
    # many small tasks and batches
    monkeypatch.setattr(files, "PATHS_A_TASK", 3)
    monkeypatch.setattr(files, "BATCH_ROWS", 2)
    monkeypatch.setattr(files, "BATCH_BYTES", 4)
    top = tmp_path / "t op %20 é"
    odd = "o d%41 ü#?&+;[]{}'\"!~^`|<>@,$\u00a0\u2028\x85\x01\n"
    texts = {
        "a.md": b"x\r\n\ny", "empty.md": b"", ".h.md": b"h", "_u.md": b"u", "_k=1.md": b"k", "_metadata.md": b"m",
        "c._COPYING_": b"c", "c._COPYING_.md": b"c", "no.MD": b"n", "bad.txt": b"a\xff\xfeb\xc3", "mark.txt": b"\xef\xbb\xbf1",
        ".hidden/a.md": b"1", "_hidden/a.md": b"2", "_p=1/a.md": b"3", "_metadata/a.md": b"4", "x._COPYING_/a.md": b"5",
        "dir.md/in.md": b"6", "d/e/h.txt": b"7", f"{odd}/{odd}.txt": b"8", "p.txt.gz": gzip.compress(b"9"),
        "b.txt.bz2": bz2.compress(b"10"), "z.txt.deflate": zlib.compress(b"11"),
    }
    for name, data in texts.items():
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(data)
    (top / "link").symlink_to(top / "d")
    (top / "gone.md").symlink_to(top / "nowhere")
    every = "*.{md,txt}"
    asked = [(top, every), (top, "*"), (top, "?[!x].m*"), (top, "*.txt.[gb]z*"), (top, "*.deflate"), (top, "*.none")]
    asked += [(top / name, every) for name in ("a.md", "_u.md", ".hidden", "{d,a.*}")]
    counts = []
    for path, pattern in asked:
        found, expected = files.doc_load(spark, str(path), pattern), _by_spark(spark, str(path), pattern)
        assert found.schema == expected.schema
        rows = [sorted(map(tuple, df.select("source", "folder", F.hex("text")).collect())) for df in (found, expected)]
        assert rows[0] == rows[1], (path, pattern)
        counts.append(len(rows[0]))
    assert counts[0] == 11 and counts[3] == 2 and counts[4] == 1 and counts[5] == 0
    for name in ("nowhere", "nowhere*"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            files.doc_load(spark, str(top / name))


def test_vector_collection_keeps_size_and_metric(spark, tmp_path):
    path = str(tmp_path / "v")
    points = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id bigint, vector array<float>")
    sinks.vector_collection_replace(points, path, 2)
    sinks.vector_collection_replace(points.limit(1), path, 2)
    assert tuple(sinks.collection_info(spark, path).first()) == (1, 2, "cosine")
    with pytest.raises(PySparkException, match="vector size is not 3"):
        sinks.vector_collection_replace(points, path, 3)


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(base) and one != two
