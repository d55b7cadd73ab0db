"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A feature is the presence of a character n-gram. Its scale is the log of how
much more often it is present in toxic texts than in others. On the scaled
features a logistic regression is fitted, each step a job over the sample's
features unless they are few. A step brings a number per text to the driver, not one
per n-gram: the weights are sums over texts, so the texts' factors stand for them.
N-grams live in a hashed table of fixed size, so the model has a fixed size as well
and is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tripwright.llm.common import groups, written

ORDERS = (2, 3, 4, 5)
BITS = 18
# The model is fitted on at most this many labelled texts of each class, those
# with the least hash of their id. Everything else covers all rows.
FIT_ROWS = 4_000
# Highest score of a model without both classes to learn from.
UNFITTED = 0.25
SMOOTHING = 1.0
RIDGE = 1e-3
# Tasks that count features or take a step of the fit. The first return one or two numbers per table
# place, once; those of a step a number per text, or one per table place if texts are more than NUMBERED.
FIT_TASKS = 6
# A sample has more texts than twice FIT_ROWS only if ids repeat.
NUMBERED = 1 << 16
# A step works through the features of this many table places at a time.
SHARD_PLACES = 1 << 10
# A sample whose features take no more is fitted by the driver, without a job per step.
DRIVER_BYTES = 16 << 20
# Texts are taken together up to about as many bytes of features, one text's at least.
CHUNK_BYTES = 4 << 20
STEPS = 100


@dataclass
class Model:
    weights: np.ndarray  # 2^BITS, ratio times coefficient
    bias: float
    fitted: bool = True  # False: one class or no feature to learn from, so the score tells nothing

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(sums + self.bias, -500, 500)))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, table place) of the distinct n-grams of each text, text by text. A-Z count as a-z."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    # the places by order and start; what would cross the end of all texts gets none
    places = np.zeros((len(ORDERS), len(codes)), np.int32)
    rolled = codes * np.uint32(0x9E3779B1)
    with np.errstate(over="ignore"):
        for order in range(2, max(ORDERS) + 1):
            if len(codes) < order:
                break
            rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            rolled += codes[order - 1 :] * np.uint32(0x9E3779B1)
            if order in ORDERS:
                places[ORDERS.index(order), : len(rolled)] = (rolled * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
    last = np.zeros(1 << BITS, np.int32)
    found, start = [], 0
    for text in texts:
        end = start + len(text)
        place = np.concatenate([row[start : max(start, end - order + 1)] for order, row in zip(ORDERS, places)])
        at = np.arange(len(place), dtype=np.int32)
        # of equal places the one written last stays
        last[place] = at
        found.append(place[last[place] == at])
        start = end
    row = np.repeat(np.arange(len(texts)), [len(place) for place in found])
    return row, np.concatenate(found) if found else np.zeros(0, np.int32)


def fit_sample(labels: DataFrame, id_col: str, label: str, eligible: Column) -> tuple[list, np.ndarray]:
    """Ids and labels to fit on, and the classes' shares of all eligible labels over those of the sample."""
    known = (
        labels.filter(eligible & F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(id_col)
        .agg(F.max(label).cast("int").alias("label"))
    )
    counts = dict(known.groupBy("label").count().collect())
    picked = [
        (row[0], row[1])
        for value in (0, 1)
        for row in known.filter(F.col("label") == value)
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(FIT_ROWS)
        .collect()
    ]
    taken = np.array([min(FIT_ROWS, counts.get(value, 0)) for value in (0, 1)], float)
    return picked, np.array([counts.get(0, 0), counts.get(1, 0)], float) / np.maximum(taken, 1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    eligible: Column | None = None,
) -> Model:
    """Fits the model on labelled rows that are ``eligible`` (a condition on ``labels``).

    Rows without id or label, and labels other than 0 and 1, are left out; an id
    labelled twice counts as toxic if either label says so. Ids that ``docs`` has
    not are no loss. With one class or none, or texts without n-grams, the model is
    not ``fitted``: every text scores the smoothed share of toxic labels, but no
    more than ``UNFITTED``, so that a model that knows nothing condemns nothing.
    """
    spark = docs.sparkSession
    picked, scale = fit_sample(labels, id_col, label, F.lit(True) if eligible is None else eligible)
    ones = sum(value for _, value in picked)
    size = 1 << BITS
    share = min((ones + 0.5) / (len(picked) + 1.0), UNFITTED)
    unfitted = Model(np.zeros(size), float(np.log(share / (1 - share))), False)
    if not 0 < ones < len(picked):
        return unfitted
    id_type = labels.schema[id_col].dataType.simpleString()
    wanted = spark.createDataFrame(picked, f"fit_id {id_type}, fit_label int")
    # at most 2 * FIT_ROWS ids: the texts are not shuffled to find them
    sample = (
        docs.select(F.col(id_col).alias("fit_id"), F.col(text).alias("fit_text"))
        .join(F.broadcast(wanted), "fit_id")
        .select("fit_label", F.coalesce("fit_text", F.lit("")).alias("fit_text"))
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(1).to_pylist(), batch.column(0)
            for low, high in groups(texts):
                row, place = grams(texts[low:high])
                cuts = np.searchsorted(row, np.arange(high - low + 1))
                packed = [place[start:end].tobytes() for start, end in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [marks.slice(low, high - low), pa.array(packed, pa.binary())], names=["mark", "places"]
                )

    # four bytes a feature of a text, written
    found = sample.mapInArrow(features, "mark int, places binary").repartition(FIT_TASKS)
    fitted = written(found, "toxic_features").coalesce(FIT_TASKS).rdd

    def count(rows: Iterator[Row]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        present, seen = np.zeros((2, size), np.int32), np.zeros(2, np.int64)
        for marks, _, places, length in _chunks(rows):
            seen += np.bincount(marks, minlength=2)
            of = np.repeat(marks, length)
            for value in (0, 1):
                present[value] += np.bincount(places[of == value], minlength=size).astype(np.int32)
        yield present, seen

    present, seen = np.zeros((2, size)), np.zeros(2)
    # arrays of fixed size per partition
    for some, rows in fitted.mapPartitions(count).collect():
        present += some
        seen += rows
    if not seen.all() or not present.any():
        return unfitted
    share = (present + SMOOTHING) / (seen[:, None] + 2 * SMOOTHING)
    ratio = np.log(share[1]) - np.log(share[0])
    useful = present.any(axis=0)
    weights, bias = _logistic(fitted, ratio, present, seen, scale / (scale @ seen))
    return Model(weights * ratio * useful, bias)


def _chunks(rows: Iterable[Row]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of some texts at a time the classes, where each starts in the places, the places, and their number per text."""
    marks, held, size = [], [], 0

    def chunk() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        length = np.array([len(places) // 4 for places in held])
        return np.array(marks), np.cumsum(length) - length, np.frombuffer(b"".join(held), np.int32), length

    for mark, places in rows:
        marks.append(mark)
        held.append(places)
        size += len(places)
        if size >= CHUNK_BYTES:
            yield chunk()
            marks, held, size = [], [], 0
    if held:
        yield chunk()


def _rest(total: np.ndarray, marks: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The texts' errors, weighted by class."""
    return weight[marks] * (1.0 / (1.0 + np.exp(-np.clip(total, -500, 500))) - marks)


def _errors(chunks: Iterable[tuple], held: np.ndarray, bias: float, weight: np.ndarray) -> np.ndarray:
    """What the texts' errors under places worth ``held`` sum to, over each place's texts and (last) over all."""
    size = len(held)
    out = np.zeros(size + 1)
    for marks, starts, places, length in chunks:
        total, some = np.full(len(marks), bias), np.flatnonzero(length)
        if len(some):
            total[some] += np.add.reduceat(held[places], starts[some])
        rest = _rest(total, marks, weight)
        out[:size] += np.bincount(places, weights=np.repeat(rest, length), minlength=size)
        out[size] += rest.sum()
    return out


def _task_errors(chunks: RDD, held: np.ndarray, bias: float, weight: np.ndarray) -> np.ndarray:
    """``_errors`` summed up in tasks, each of which returns an array of fixed size."""
    shared = chunks.context.broadcast((held, bias, weight))
    out = np.zeros(len(held) + 1)
    for some in chunks.mapPartitions(lambda part: [_errors(part, *shared.value)]).collect():
        out += some
    shared.destroy()
    return out


def _shards(fitted: RDD, first: np.ndarray) -> RDD:
    """(shard of the table, text numbers, places from the shard's first on) of all features, a shard in one piece.

    Texts are numbered as they lie in ``fitted``, each partition from ``first`` on.
    """

    def deal(part: int, rows: Iterator[Row]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        numbered = ((first[part] + at, row[1]) for at, row in enumerate(rows))
        for numbers, _, places, length in _chunks(numbered):
            shard, text = places // SHARD_PLACES, np.repeat(numbers.astype(np.int32), length)
            order = np.argsort(shard.astype(np.int16), kind="stable")
            found, low = np.unique(shard[order], return_index=True)
            for one, of in zip(found.tolist(), np.split(order, low[1:])):
                yield one, (text[of], (places[of] - one * SHARD_PLACES).astype(np.int16))

    def join(pieces: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for shard, some in groupby(pieces, lambda piece: piece[0]):
            texts, places = zip(*(piece for _, piece in some))
            yield shard, np.concatenate(texts), np.concatenate(places)

    dealt = fitted.mapPartitionsWithIndex(deal).repartitionAndSortWithinPartitions(FIT_TASKS)
    return dealt.mapPartitions(join, preservesPartitioning=True).coalesce(FIT_TASKS)


def _text_sums(shards: Iterable[tuple], factors: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Per text what its places are worth, if a place is worth its texts' factors times its scale squared."""
    out = np.zeros(len(factors))
    for shard, texts, places in shards:
        worth = np.bincount(places, weights=factors[texts], minlength=SHARD_PLACES) * square[shard]
        out += np.bincount(texts, weights=worth[places], minlength=len(factors))
    return out


def _descend(slope: Callable, size: int, bias: float, step: float) -> tuple[np.ndarray, float]:
    """Accelerated gradient from zero and ``bias``; ``slope`` gives both slopes at a point, the first without ridge."""
    w, b = np.zeros(size), bias
    look_w, look_b, t = w, b, 1.0
    for _ in range(STEPS):
        slope_w, slope_b = slope(look_w, look_b)
        new_w = look_w - step * (slope_w + RIDGE * look_w)
        new_b = look_b - step * slope_b
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / new_t * (new_w - w)
        look_b = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, float(b)


def _by_places(errors: Callable, chunks, ratio, weight, bias: float, step: float) -> tuple[np.ndarray, float]:
    """The fit on the places' weights."""

    def slope(look_w: np.ndarray, look_b: float) -> tuple[np.ndarray, float]:
        sums = errors(chunks, look_w * ratio, look_b, weight)
        return sums[:-1] * ratio, sums[-1]

    return _descend(slope, len(ratio), bias, step)


def _by_texts(fitted: RDD, ratio, weight, bias: float, step: float) -> tuple[np.ndarray, float]:
    """The same fit on a factor per text.

    Every step moves a place's weight by its scale times a sum over its texts, so a
    weight always is its scale times the sum of its texts' factors, and the factors
    take the same steps. A task has some shards of the table, with all their texts.
    """
    by_part = fitted.mapPartitions(lambda rows: [np.array([row[0] for row in rows], np.int8)]).collect()
    marks = np.concatenate(by_part)
    shards = _shards(fitted, np.cumsum([0, *map(len, by_part)])).persist(StorageLevel.MEMORY_AND_DISK)
    square = fitted.context.broadcast((ratio**2).reshape(-1, SHARD_PLACES))

    def slope(look: np.ndarray, look_b: float) -> tuple[np.ndarray, float]:
        total = np.full(len(marks), look_b)
        for some in shards.mapPartitions(lambda part: [_text_sums(part, look, square.value)]).collect():
            total += some
        rest = _rest(total, marks, weight)
        return rest, rest.sum()

    factors, bias = _descend(slope, len(marks), bias, step)
    sums = np.zeros((len(ratio) // SHARD_PLACES, SHARD_PLACES))
    for shard, some in shards.map(
        lambda one: (one[0], np.bincount(one[2], weights=factors[one[1]], minlength=SHARD_PLACES))
    ).collect():
        sums[shard] = some
    shards.unpersist()
    square.destroy()
    return ratio * sums.ravel(), bias


def _logistic(fitted: RDD, ratio, present, seen, weight) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on ratio-scaled presence, by accelerated gradient.

    ``fitted`` has the texts' classes and places, ``present`` and ``seen`` count texts
    by class (with a place, and all), ``weight`` is that of a text of each class.
    Each step is one job, unless there are few features.
    """
    ones = float(weight[1] * seen[1])
    bias = float(np.log(max(ones, 1e-9) / max(1 - ones, 1e-9)))
    # a bound on the curvature: the longest row, scaled
    step = 1.0 / (0.25 * float(weight @ (present @ ratio**2 + seen)) + RIDGE)
    if 4 * present.sum() > DRIVER_BYTES and seen.sum() <= NUMBERED:
        return _by_texts(fitted, ratio, weight, bias, step)
    chunks = fitted.mapPartitions(_chunks)
    if 4 * present.sum() <= DRIVER_BYTES:
        return _by_places(_errors, chunks.collect(), ratio, weight, bias, step)
    chunks.persist(StorageLevel.MEMORY_AND_DISK)
    found = _by_places(_task_errors, chunks, ratio, weight, bias, step)
    chunks.unpersist()
    return found


def text_scores(model: Model, texts: list[str]) -> np.ndarray:
    row, place = grams(texts)
    return model.score(np.bincount(row, weights=model.weights[place], minlength=len(texts)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``score``, 0 to 1.

    Only the text decides. Null reads as empty, and the empty text gets the score
    of a text without features. Whole texts; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    rows = docs.select(id_col, text)
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            for low, high in groups(texts):
                found = text_scores(Model(*shared.value), texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(found)], names=[id_col, "score"]
                )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns as they are.

    A model that is not ``fitted`` rejects none.
    """
    if not model.fitted:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.fieldNames().index(text)
        for batch in batches:
            texts = [value or "" for value in batch.column(at).to_pylist()]
            for low, high in groups(texts):
                clean = pa.array(text_scores(Model(*shared.value), texts[low:high]) < threshold)
                yield batch.slice(low, high - low).filter(clean)

    return docs.mapInArrow(run, schema)
