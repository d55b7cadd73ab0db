from collections import Counter

import pytest

from tripwright.llm import sharding

NAMES = tuple(f"s{i}" for i in range(7))


def _plain_fill(shards, size):
    """Turns over full preference lists."""
    prefs = []
    for name in shards:
        at, step = sharding._number(name, "offset") % size, sharding._number(name, "skip") % (size - 1) + 1
        prefs.append([(at + j * step) % size for j in range(size)])
    owner, nxt = [-1] * size, [0] * len(shards)
    while True:
        for i in range(len(shards)):
            while owner[prefs[i][nxt[i]]] >= 0:
                nxt[i] += 1
            owner[prefs[i][nxt[i]]] = i
            if -1 not in owner:
                return owner


def test_fill():
    for size in (7, 13, 251):
        owner = sharding.fill(NAMES, size)
        assert owner == _plain_fill(NAMES, size)
        counts = Counter(owner)
        assert max(counts.values()) - min(counts.values()) <= 1
    with pytest.raises(ValueError):
        sharding.fill((), 7)
    with pytest.raises(ValueError):
        sharding.fill(NAMES, 12)


def test_few_keys_move():
    before, after = sharding.fill(NAMES, 5_003), sharding.fill(NAMES[:-1], 5_003)
    stayed = [b == a for b, a in zip(before, after) if b != len(NAMES) - 1]
    assert sum(stayed) / len(stayed) > 0.8


def test_rows(documents):
    docs = documents((1, "a"), (1, "a"), (None, None), (2, "")).withColumnRenamed("lang", "shard")
    rows = sharding.assign(docs, "doc_id", NAMES, 251).collect()
    assert len(rows) == 4 and all(r["shard"] in NAMES for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    owner = sharding.fill(NAMES, 251)
    slots = docs.select("doc_id", sharding.slot_of(docs.doc_id, 251).alias("slot")).collect()
    assert sorted((str(r["doc_id"]), NAMES[owner[r["slot"]]]) for r in slots) == sorted((str(r["doc_id"]), r["shard"]) for r in rows)
    assert sharding.assign(documents(), "doc_id", NAMES, 251).count() == 0


def test_written_shards(documents, tmp_path):
    docs = documents(*[(i, f"t{i}") for i in range(100)])
    sharding.write_shards(docs, "doc_id", str(tmp_path / "out"), NAMES, 251)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and set(back.columns) == {*docs.columns, "shard"}
