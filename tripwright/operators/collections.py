"""Vector collections on files: buckets by id that take upserts, clusters that prune a search."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.operators.retrieval import (
    MAX_QUERY_BYTES,
    SCORE_DECIMALS,
    TOP_K,
    _block_search,
    _query_blocks,
    _rank,
    _schema,
    _sized_vectors,
)
from tripwright.session import scratch_dir

# Buckets of a collection; size them so that one is some hundred MB.
BUCKETS = 64
# Clusters of a collection at most, and points (those of least hash) that their centres are fitted on.
CLUSTERS = 256
FIT_POINTS = 100_000
# Points without a direction have a cluster of their own: their score is 0 for every query.
ZERO = -1
# Slack of angles, far above the noise of the arc cosine.
ANGLE_SLACK = 1e-6


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _sized(points: DataFrame, dim: int) -> DataFrame:
    wrong = F.raise_error(F.concat(F.lit(f"vector size is not {dim}: id "), F.col("id").cast("string")))
    return points.withColumn("vector", F.when(F.size("vector") == dim, F.col("vector")).otherwise(wrong))


def _write_buckets(points: DataFrame, path: str, meta: dict, dynamic: bool) -> None:
    """Writes points to their buckets' folders; ``dynamic`` replaces those folders only."""
    placed = points.withColumn("bucket", bucket_of(F.col("id"), meta["buckets"]))
    kept = placed.withMetadata("vector", meta).hint("rebalance", F.col("bucket"))
    mode = "dynamic" if dynamic else "static"
    kept.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(path)
    _keep_schema(kept, path, "bucket", 0)


def _keep_schema(rows: DataFrame, path: str, by: str, number: int) -> None:
    """Without any row there is no file that tells the columns: adds an empty one."""
    if rows.sparkSession.read.schema(rows.schema).parquet(path).isEmpty():
        rows.drop(by).limit(0).write.mode("overwrite").parquet(f"{path}/{by}={number}")


def _last_points(new: DataFrame, order: str | None) -> DataFrame:
    """One point per id: the last by ``order``, or else the greatest row."""
    row = F.struct(*([order] if order else []), *[c for c in new.columns if c != order])
    last = new.groupBy("id").agg(F.max(row).alias("row"))
    return last.select(*[F.col(f"row.{c}").alias(c) for c in new.columns if c != order])


def create_collection(
    points: DataFrame, path: str, dim: int, buckets: int = BUCKETS, metric: str = "cosine", order: str | None = None
) -> DataFrame:
    """Replaces the collection at ``path`` by ``points`` (id, vector, payload ...), one per id.

    A vector of another size than ``dim`` fails the write. Size, metric and the
    number of buckets are kept with the vector column.
    """
    meta = {"dim": dim, "metric": metric, "buckets": buckets}
    _write_buckets(_sized(_last_points(points, order), dim), path, meta, dynamic=False)
    return read_collection(points.sparkSession, path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def upsert(spark: SparkSession, path: str, new: DataFrame, order: str | None = None) -> list[int]:
    """Adds the points of ``new`` to the stored collection, or puts them in place of the same id.

    Only the buckets that hold a new id are read and rewritten; the numbers of
    these are returned. Of new points with one id the last by ``order`` stays (or
    the greatest row), so an id has one point, also if the same batch comes again.
    A null id is an id like others. New folders replace old ones when the whole
    write is done; a write that is cut short is mended by the same upsert again.
    """
    stored = read_collection(spark, path)
    meta = stored.schema["vector"].metadata
    columns = [c for c in stored.columns if c != "bucket"]
    fresh = _sized(_last_points(new, order).select(*columns), meta["dim"])
    fresh = _written(fresh.withColumn("bucket", bucket_of(F.col("id"), meta["buckets"])), "upsert")
    # as many numbers as there are buckets at most
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
    if touched:
        ids = fresh.select(F.col("id").alias("new_id"), F.col("bucket").alias("new_bucket"))
        same = (F.col("bucket") == F.col("new_bucket")) & F.col("id").eqNullSafe(F.col("new_id"))
        kept = stored.filter(F.col("bucket").isin(touched)).join(ids, same, "left_anti")
        _write_buckets(kept.unionByName(fresh).select(*columns), path, meta, dynamic=True)
    return touched


def _fit_centres(points: DataFrame, clusters: int, fit_points: int, seed: int) -> np.ndarray:
    """Unit centres fitted on at most ``fit_points`` points: as many as the root of these, ``clusters`` at most."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    sample = points.orderBy(F.xxhash64("id")).limit(fit_points).withColumn("norm", norm).filter("norm > 0")
    unit = F.transform("vector", lambda x: x / F.col("norm"))
    rows = _written(sample.select(array_to_vector(unit).alias("features")), "centres_fit")
    many = rows.count()
    if not many:
        return np.zeros((0, 0))
    wanted = max(2, min(clusters, math.isqrt(many)))
    model = KMeans(k=wanted, seed=seed, maxIter=10).fit(rows) if many > 1 else None
    found = np.array(model.clusterCenters() if model else [rows.first()["features"].toArray()])
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    return found[norms[:, 0] > 0] / norms[norms[:, 0] > 0]


def build_clusters(
    points: DataFrame, path: str, dim: int, clusters: int = CLUSTERS, fit_points: int = FIT_POINTS, seed: int = 7
) -> DataFrame:
    """Writes ``points`` (id, vector, payload) as one folder per cluster; gives (cluster, centre, points, radius).

    Each point goes to the centre of least angle; the centres are fitted on a
    bounded sample, the points and radii are those of all. ``radius`` is the
    largest angle between the centre and a point of the cluster. Points without a
    vector take no part.
    """
    spark = points.sparkSession
    sized = _sized(points.filter(F.col("vector").isNotNull()), dim)
    centres = _fit_centres(sized, clusters, fit_points, seed)
    shared = spark.sparkContext.broadcast(centres)
    schema = T.StructType(
        [*sized.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    )
    units, zero = _block_search(1, SCORE_DECIMALS)[0], ZERO

    def place(batches):
        held = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = units(batch.column("vector"))
            if not len(held):
                at, angle = np.zeros(len(own), int), np.zeros(len(own))
            else:
                scores = own @ held.T
                at = scores.argmax(axis=1)
                angle = np.arccos(np.clip(scores[np.arange(len(own)), at], -1, 1))
            at = np.where(own.any(axis=1), at, zero)
            columns = [*batch.columns, pa.array(at.astype("int32")), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cluster", "angle"])

    placed = sized.mapInArrow(place, schema).hint("rebalance", F.col("cluster"))
    placed.write.mode("overwrite").partitionBy("cluster").parquet(f"{path}/points")
    _keep_schema(placed, f"{path}/points", "cluster", ZERO)
    sizes = spark.read.parquet(f"{path}/points").groupBy("cluster").agg(
        F.count("*").alias("points"), F.max("angle").alias("radius")
    )
    # as many rows as clusters
    rows = [(number, [float(x) for x in centre]) for number, centre in enumerate(centres)] + [(ZERO, [0.0] * dim)]
    named = spark.createDataFrame(rows, "cluster int, centre array<double>")
    named.join(sizes, "cluster").write.mode("overwrite").parquet(f"{path}/centres")
    return spark.read.parquet(f"{path}/centres")


def highest_scores(units: np.ndarray, centres: np.ndarray, radii: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each query and cluster, a score that no point of the cluster exceeds.

    The angle between query and point is at least that between query and centre
    less the cluster's radius.
    """
    away = np.arccos(np.clip(units @ centres.T, -1, 1)) - radii - ANGLE_SLACK
    best = np.cos(np.clip(away, 0, np.pi))
    return np.where((numbers == ZERO)[None, :] | ~units.any(axis=1)[:, None], 0.0, best)


def _first_clusters(best: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Per query the clusters of the highest possible scores, until they hold ``k`` points."""
    order = np.argsort(-best, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    mask = np.zeros(best.shape, bool)
    np.put_along_axis(mask, order, before < k, axis=1)
    return mask


def _search_clusters(
    points: DataFrame, query_ids: pa.Array, units: np.ndarray, numbers: np.ndarray, mask: np.ndarray,
    floors: np.ndarray, schema: T.StructType, k: int,
) -> DataFrame:
    """Partial winners of each query among the clusters that ``mask`` names; other folders are not read."""
    wanted = [int(n) for n in numbers[mask.any(axis=0)]]
    _, keep_best, search = _block_search(k, SCORE_DECIMALS)
    shared = points.sparkSession.sparkContext.broadcast((units, query_ids, {int(n): m for n, m in zip(numbers, mask.T)}, floors))
    names = ["query_id", "id", "score"]

    def scan(batches):
        own_units, ids, masks, lowest = shared.value
        held = None
        for batch in batches:
            clusters = np.asarray(batch.column("cluster"))
            for number in np.unique(clusters):
                asking = np.flatnonzero(masks[int(number)])
                part = batch.filter(pa.array(clusters == number))
                floor = lowest[asking] if np.isfinite(lowest[asking]).all() else None
                q, score, row = search(own_units[asking], part, floor)
                winners = pa.Table.from_arrays(
                    [pa.array(asking[q]), part.column("id").take(pa.array(row)), pa.array(score)], names=names
                )
                held = winners if held is None else pa.concat_tables([held, winners])
                order = np.argsort(np.argsort(np.asarray(held.column("id")), kind="stable"))
                best = keep_best(np.asarray(held.column("query_id")), np.asarray(held.column("score")), order)
                held = held.take(pa.array(best)).combine_chunks()
        if held is not None:
            asked = pa.array(np.asarray(held.column("query_id")))
            yield from held.set_column(0, "query_id", ids.take(asked)).to_batches()

    return points.filter(F.col("cluster").isin(wanted)).select("id", "vector", "cluster").mapInArrow(scan, schema)


def clustered_topk(
    queries: DataFrame, path: str, k: int = TOP_K, max_query_bytes: int = MAX_QUERY_BYTES, read: list | None = None
) -> DataFrame:
    """The ``k`` nearest points per query by cosine from a clustered collection, exact.

    Same result as ``vector_topk`` on the points. A first search of the clusters
    that could score highest gives each query a score to beat; a second one reads
    only the clusters that could still reach it. ``read`` collects, per block of
    queries, how many clusters each search read and how many there are.
    """
    spark = queries.sparkSession
    points = spark.read.parquet(f"{path}/points")
    table = spark.read.parquet(f"{path}/centres").orderBy("cluster").toArrow()
    schema = _schema(queries, points)
    unit = _block_search(k, SCORE_DECIMALS)[0]
    partial, searched = spark.createDataFrame([], schema), set()
    wanted = queries.select("query_id", "vector").filter(F.col("vector").isNotNull())
    if table.num_rows:
        centres = np.asarray(table.column("centre").combine_chunks().flatten()).reshape(table.num_rows, -1)
        numbers, sizes, radii = (np.asarray(table.column(c)) for c in ("cluster", "points", "radius"))
        dim = centres.shape[1]
        for block in _query_blocks(_sized_vectors(wanted, "query_id", dim), max_query_bytes, dim):
            units, ids = unit(block.column("vector")), block.column("query_id").combine_chunks()
            best = highest_scores(units, centres, radii, numbers)
            first = _first_clusters(best, sizes, k)
            none = np.full(len(units), -np.inf)
            found = _written(_rank(_search_clusters(points, ids, units, numbers, first, none, schema, k), k), "nearest")
            floors = none.copy()
            # a block's queries, k rows each
            at = {q: row for row, q in enumerate(ids.to_pylist())}
            for row in found.filter(F.col("rank") == k).toLocalIterator():
                floors[at[row["query_id"]]] = row["score"]
            rest = ~first & (best >= floors[:, None])
            if read is not None:
                read.append((int(first.any(axis=0).sum()), int(rest.any(axis=0).sum()), len(numbers)))
            searched |= {int(n) for n in numbers[(first | rest).any(axis=0)]}
            partial = partial.unionByName(found.select("query_id", "id", "score"))
            if rest.any():
                more = _search_clusters(points, ids, units, numbers, rest, floors, schema, k)
                partial = partial.unionByName(more)
    # the payloads, too, are read from the searched folders only
    held = points.filter(F.col("cluster").isin(sorted(searched))).select("id", "payload")
    return _rank(partial, k).join(held, "id").select("query_id", "rank", "id", "score", "payload")
