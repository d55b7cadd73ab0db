import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.llm import components as comp
from tripwright.llm import minhash_join as mj
from tripwright.llm.common import row_key, words_of


def _shingles(text):
    words = words_of((text or "").encode())
    if not words:
        return None
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _classes(rows, threshold=0.8):
    """Brute force: (class, links) per row, all pairs."""
    sets = [_shingles(t) for _, t in rows]
    n = len(rows)
    group, links = list(range(n)), [0] * n
    for a in range(n):
        for b in range(a):
            if sets[a] is None or sets[b] is None:
                alike = sets[a] is None and sets[b] is None and (rows[a][1] or "") == (rows[b][1] or "")
            else:
                both = len(sets[a] & sets[b])
                alike = both >= threshold * (len(sets[a]) + len(sets[b]) - both)
            if alike:
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return [(doc_id, least.get(g), link) for (doc_id, _), g, link in zip(rows, group, links)]


def _rows(n, seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.2:
            texts.append(draw.choice(texts))
        elif texts and kind < 0.6:
            words = draw.choice(texts).split()
            for _ in range(draw.randint(1, 3)):
                if words:
                    words[draw.randrange(len(words))] = word()
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(word() for _ in range(draw.randint(20, 150))) + (" " + passage if kind > 0.8 else ""))
    return list(enumerate(texts))


def _result(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=repr)


EDGES = [(1000, None), (1001, ""), (1002, "!!! ..."), (1003, "!!! ..."), (1004, "one two"), (1005, "One, TWO!"),
         (None, "one two"), (1006, "a b c d e"), (1006, "a b c d e"), (1007, "w " * 40_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(documents, seed):
    rows = _rows(250, seed) + EDGES
    docs = documents(*rows).withColumnRenamed("lang", "class_id").withColumnRenamed("source", "root")
    assert _result(mj.jaccard_join(docs)) == sorted(_classes(rows), key=repr)


def test_blocks_meet_each_pair_once(documents, monkeypatch):
    monkeypatch.setattr(mj, "BLOCK_ROWS", 5)
    rows = _rows(150, 3)
    assert _result(mj.jaccard_join(documents(*rows))) == sorted(_classes(rows), key=repr)


def test_empty_table(documents):
    assert mj.jaccard_join(documents()).count() == 0


def test_keep_one(documents):
    rows = _rows(120, 4) + EDGES
    docs = documents(*rows)
    kept = mj.keep_one(docs)
    assert kept.columns == docs.columns
    classes = _classes(rows)
    # rows without an id come last in their class
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted({c for _, c, _ in classes}, key=repr)


def test_keep_one_leaves_columns_and_takes_the_least_of_equal_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents((1, text), (1, text), (2, text), (3, "other words here")).withColumn("kept_key", F.lit("mine"))
    extra = documents((1, text)).withColumn("kept_key", F.lit("less"))
    kept = {r["doc_id"]: r["kept_key"] for r in mj.keep_one(docs.unionByName(extra)).collect()}
    assert kept == {1: "less", 3: "mine"}


def test_row_keys_differ(spark):
    rows = [("1", "a|null"), ("1|text|a", None), (None, None), ("null", None), ("1", "a"), ("1:1", "a"), (None, "null"), ("", "")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    assert frame.select(row_key()).distinct().count() == len(rows)


def test_pruning_keeps_pairs_at_the_threshold():
    least = mj.least_matches(0.8, mj.TOLERANCE)
    draw = np.random.default_rng(0)
    one = np.zeros(mj.VALUES, np.uint8)
    others = (draw.random((2_000, mj.VALUES)) >= 0.8).astype(np.uint8)
    assert len(mj.survivors(one, others, least)) >= 1_999
    far = (draw.random((2_000, mj.VALUES)) >= 0.3).astype(np.uint8)
    assert len(mj.survivors(one, far, least)) == 0


def test_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1_000, 1_100)]
    group = {x: x for e in edges for x in e}
    for a, b in edges:
        old, new = group[a], group[b]
        group = {k: new if v == old else v for k, v in group.items()}
    frame = spark.createDataFrame([(bytes(str(a), "ascii"), bytes(str(b), "ascii")) for a, b in edges], "a binary, b binary")
    roots = {int(bytes(r["node"])): bytes(r["root"]) for r in comp.components(frame).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert set(roots) == touched
    assert len(set(roots.values())) == len({group[x] for x in touched})
    assert all(roots[a] == roots[b] for a, b in edges if a != b)
    assert comp.components(frame.filter(F.lit(False))).count() == 0


def test_another_threshold(documents):
    rows = _rows(120, 5)
    assert _result(mj.jaccard_join(documents(*rows), Fraction(9, 10))) == sorted(_classes(rows, 0.9), key=repr)


def test_pruning_loses_less_than_banding():
    agree = 0.8 + 0.2 / 256
    least = mj.least_matches(0.8, mj.TOLERANCE)
    step = [math.comb(mj.LOOK, k) * agree**k * (1 - agree) ** (mj.LOOK - k) for k in range(mj.LOOK + 1)]
    alive, lost = np.ones(1), 0.0
    for seen in range(mj.LOOK, mj.VALUES + 1, mj.LOOK):
        alive = np.convolve(alive, step)
        lost += alive[: least[seen]].sum()
        alive[: least[seen]] = 0
    assert lost < 0.1 * (1 - agree**mj.BAND_VALUES) ** mj.BANDS
