import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.llm import toxicity
from tripwright.llm.queries import TOXIC_FROM, toxic_model

RUDE = ("blorfgit", "snazzwit")


def _texts(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 8))) for _ in range(60)]
        toxic = i % 3 == 0
        if toxic:
            words[draw.randrange(60)] = draw.choice(RUDE).upper() if i % 2 else draw.choice(RUDE)
        out.append((i, " ".join(words), int(toxic)))
    return out


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(spark, documents):
    rows = _texts(400, 1)
    labels = _labels(spark, [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (9_999, 0, 1), (5, 0, None), (7, None, 2)])
    return toxicity.train(documents(*[(i, t) for i, t, _ in rows]), labels)


def test_grams_are_distinct_and_stay_in_their_text():
    row, place = toxicity.grams(["abab", "", "AB", "x"])
    assert set(row.tolist()) == {0, 2}
    # ab, ba; aba, bab; abab
    assert (row == 0).sum() == 5 and (row == 2).sum() == 1
    assert place[row == 2][0] in place[row == 0]
    assert all(len(x) == 0 for x in toxicity.grams(["", ""]))


def test_held_out_accuracy(model):
    rows = _texts(200, 2)
    scores = toxicity.text_scores(model, [t for _, t, _ in rows])
    assert np.mean((scores >= 0.5) == np.array([y for *_, y in rows])) > 0.97


def test_order_of_texts_does_not_matter(model):
    texts = [t for _, t, _ in _texts(50, 3)]
    alone = [toxicity.text_scores(model, [t])[0] for t in texts]
    assert np.allclose(alone, toxicity.text_scores(model, texts))


def test_rows(documents, model):
    long = " ".join(t for _, t, _ in _texts(300, 4))
    docs = documents((1, None), (2, ""), (None, f"you {RUDE[0]} you"), (3, "same"), (3, "same"), (4, long))
    docs = docs.withColumnRenamed("lang", "score")
    rows = toxicity.score(docs, model).collect()
    assert [r["doc_id"] for r in rows] == [1, 2, None, 3, 3, 4]
    scores = [r["score"] for r in rows]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] and scores[3] == scores[4] and scores[2] > 0.5
    kept = toxicity.keep_clean(docs, model, 0.5)
    assert kept.columns == docs.columns and None not in [r["doc_id"] for r in kept.collect()]
    assert toxicity.score(documents(), model).count() == 0


def test_without_two_classes_the_share_decides(spark, documents):
    docs = documents((1, "a b"), (2, "c d"))
    none = toxicity.train(docs, _labels(spark, []))
    clean = toxicity.train(docs, _labels(spark, [(1, 1, 0), (2, 1, 0)]))
    assert toxicity.text_scores(none, ["x"])[0] == pytest.approx(toxicity.UNFITTED)
    assert toxicity.text_scores(clean, ["x"])[0] == pytest.approx(0.5 / 3)


def test_ineligible_labels_are_not_learned(spark, documents):
    rows = _texts(120, 6)
    docs = documents(*[(i, t) for i, t, _ in rows])
    eligible = F.col("doc_id") % 2 == 0
    one = toxicity.train(docs, _labels(spark, [(i, 1, y) for i, _, y in rows]), eligible=eligible)
    other = toxicity.train(docs, _labels(spark, [(i, 1, y if i % 2 == 0 else 1 - y) for i, _, y in rows]), eligible=eligible)
    assert np.allclose(one.weights, other.weights) and one.bias == pytest.approx(other.bias)


def _recall(spark, name):
    docs, labels = (spark.read.parquet(f"/root/testdata/{name}/{table}.parquet") for table in ("documents", "labels"))
    scored = toxicity.score(docs, toxic_model(docs, labels)).join(labels, "doc_id").filter("toxic is not null")
    rows = scored.select((F.col("score") >= TOXIC_FROM).alias("hit"), "toxic").collect()
    return np.mean([r["hit"] for r in rows if r["toxic"] == 1]), np.mean([not r["hit"] for r in rows if r["toxic"] == 0])


def test_predicted_is_the_threshold_on_any_labels(spark, documents, tmp_path):
    from tripwright.llm.queries import QUERIES

    documents((0, "aa"), (1, "bb"), (2, None), (None, "")).write.parquet(f"{tmp_path}/documents.parquet")
    for at, labels in enumerate(([], [(0, 1, 1), (1, 1, 1)], [(0, 1, 0)], [(0, 1, 1), (1, 1, 0)])):
        _labels(spark, labels).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        rows = QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
        assert len(rows) == 4
        for row in rows:
            assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= TOXIC_FROM)
        if at < 3:
            assert not any(row["predicted"] for row in rows)


def _held_out(spark, name):
    """Toxic texts found, rejected and in all, among rows that the model never saw."""
    from tripwright.llm.queries import QUERIES

    labels = spark.read.parquet(f"/root/testdata/{name}/labels.parquet").filter("toxic IS NOT NULL")
    scored = QUERIES["op2_toxicity"](spark, f"/root/testdata/{name}").filter("held_out").join(labels, "doc_id")
    toxic = F.col("toxic") == 1
    return tuple(scored.agg(F.count_if(toxic & (F.col("predicted") == 1)), F.sum("predicted"), F.count_if(toxic)).first())


@pytest.mark.parametrize(("name", "recall", "precision"), [("sf0.01", 0.65, 0.95), ("sf0.1", 0.6, 0.95)])
def test_held_out_recall(spark, name, recall, precision):
    found, rejected, toxic = _held_out(spark, name)
    assert found >= recall * toxic and found >= precision * rejected


# of check_s, which takes minutes, the README has a sample's figures
@pytest.mark.parametrize(("name", "least"), [("sf0.001", 0.7), ("sf0.01", 0.85)])
def test_small_tables_find_toxic_texts(spark, name, least):
    recall, spared = _recall(spark, name)
    assert recall >= least and spared >= 0.95


def test_rare_words_tell(spark, documents):
    # each word is in 4 toxic texts of 60 and in no clean one
    draw = random.Random(8)
    words = [f"{a}xq{b}j{a}" for a in "bdfgh" for b in "klm"]
    rows = [(i, " ".join(draw.choice(("la", "lo", "na", "no", "ti")) for _ in range(30))) for i in range(240)]
    rows = [(i, f"{text} {words[i // 4 % 15]}" if i < 60 else text) for i, text in rows]
    model = toxicity.train(documents(*rows), _labels(spark, [(i, 1, int(i < 60)) for i, _ in rows]))
    scores = toxicity.text_scores(model, [f"la lo na {word} ti" for word in words] + ["la lo na ti ti"])
    assert (scores[:-1] >= TOXIC_FROM).all() and scores[-1] < TOXIC_FROM


def test_what_reaches_the_driver_does_not_grow_with_the_texts(spark, documents, monkeypatch):
    from pyspark import RDD
    from pyspark.sql.classic.dataframe import DataFrame

    def sent(words):
        rows = [(i, f"{'bad' if i % 2 else 'good'} " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(words))) for i in range(60)]
        most, collect, to_arrow, collect_rdd = [], DataFrame.collect, DataFrame.toArrow, RDD.collect

        def collected(df):
            rows = collect(df)
            most.append(sum(len(value) for row in rows for value in row if isinstance(value, (bytes, bytearray))))
            return rows

        def arrow(df):
            table = to_arrow(df)
            most.append(table.nbytes)
            return table

        def of_rdd(rdd):
            found = collect_rdd(rdd)
            arrays = [x for one in found for x in (one if isinstance(one, tuple) else [one]) if isinstance(x, np.ndarray)]
            most.append(sum(x.nbytes for x in arrays))
            return found

        with monkeypatch.context() as patch:
            patch.setattr(RDD, "collect", of_rdd)
            patch.setattr(DataFrame, "collect", collected)
            patch.setattr(DataFrame, "toArrow", arrow)
            model = toxicity.train(documents(*rows), _labels(spark, [(i, 1, i % 2) for i, _ in rows]))
        scores = toxicity.text_scores(model, ["bad " * 9, "good " * 9])
        assert scores[0] > scores[1]
        return max(most)

    draw = random.Random(11)
    monkeypatch.setattr(toxicity, "STEPS", 3)
    monkeypatch.setattr(toxicity, "FIT_TASKS", 2, raising=False)
    monkeypatch.setattr(toxicity, "DRIVER_BYTES", 1 << 20, raising=False)
    # sums of fixed size per task; the places of 60 long texts take three times as much
    fixed = 2 * 8 * ((1 << toxicity.BITS) + 2)
    assert sent(100) <= fixed and sent(20_000) <= fixed


def test_fit_in_tasks_is_the_fit_on_the_driver(spark, documents, monkeypatch):
    rows = _texts(60, 12) + [(900, "", 1), (901, "", 0)]
    docs, labels = documents(*[(i, t) for i, t, _ in rows], (900, None)), _labels(spark, [(i, 1, y) for i, _, y in rows])
    monkeypatch.setattr(toxicity, "STEPS", 5)
    one = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "DRIVER_BYTES", 0)
    other = toxicity.train(docs, labels)
    assert np.allclose(one.weights, other.weights, atol=1e-12) and one.bias == pytest.approx(other.bias)


def test_steps_of_the_fit_bring_a_number_per_text_to_the_driver(spark, documents, monkeypatch):
    from pyspark import RDD, SparkContext

    def moved(steps):
        """Bytes of arrays that the driver gets from tasks or hands to them in a fit of so many steps."""
        held, collect, broadcast = [], RDD.collect, SparkContext.broadcast

        def size(value):
            return value.nbytes if isinstance(value, np.ndarray) else sum(map(size, value)) if isinstance(value, (tuple, list)) else 8

        def of_rdd(rdd):
            found = collect(rdd)
            held.append(size(found))
            return found

        def shared(context, value):
            held.append(size(value))
            return broadcast(context, value)

        with monkeypatch.context() as patch:
            patch.setattr(RDD, "collect", of_rdd)
            patch.setattr(SparkContext, "broadcast", shared)
            patch.setattr(toxicity, "STEPS", steps)
            toxicity.train(docs, labels)
        return sum(held)

    rows = _texts(60, 12)
    docs, labels = documents(*[(i, t) for i, t, _ in rows]), _labels(spark, [(i, 1, y) for i, _, y in rows])
    monkeypatch.setattr(toxicity, "DRIVER_BYTES", 0)
    # before: 16 MB a step
    assert moved(6) - moved(2) <= 4 * toxicity.FIT_TASKS * 8 * len(rows)


def test_more_texts_than_are_numbered(spark, documents, monkeypatch):
    # ids repeat, so that the sample has more texts than ids
    rows = [*_texts(60, 12), *_texts(60, 15), (900, "", 1), (901, "", 0)]
    docs, labels = documents(*[(i, t) for i, t, _ in rows], (900, None)), _labels(spark, [(i, 1, y) for i, _, y in rows])
    monkeypatch.setattr(toxicity, "STEPS", 5)
    monkeypatch.setattr(toxicity, "DRIVER_BYTES", 0)
    one = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "NUMBERED", 0, raising=False)
    other = toxicity.train(docs, labels)
    assert np.allclose(one.weights, other.weights, atol=1e-12) and one.bias == pytest.approx(other.bias)
    assert one.weights.any()
