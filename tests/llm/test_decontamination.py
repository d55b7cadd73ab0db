import random
import re

from tripwright.llm import decontamination as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for item, item_text in items:
            asked = _words(item_text)
            size = min(window, len(asked))
            for at in range(len(asked) - size + 1) if asked else ():
                phrase = asked[at : at + size]
                for start in range(len(words) - size + 1):
                    if words[start : start + size] == phrase:
                        hit |= set(range(start, start + size))
                        found.add("null" if item is None else str(item))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


def _got(index, matches):
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in dec.contamination(index, matches).collect()), key=repr
    )


def _case(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["é", "É", "the"]
    text = lambda n: " ".join(draw.choice(words).upper() if draw.random() < 0.2 else draw.choice(words) for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(3, text(4)), (None, "only here w1"), (77, None)]
    docs = []
    for i in range(60):
        parts = [text(draw.randint(0, 40))]
        if i % 3 == 0:
            parts.append(draw.choice(items)[1] or "")
        docs.append((i, ", ".join(parts + [text(3)])))
    docs += [(60, None), (61, ""), (None, "no id, only here w1"), (62, "x " * 60_000 + "only here W1"), (5, "only HERE w1!"), (5, "only HERE w1!")]
    return docs, items


def _tables(spark, documents, docs, items):
    return documents(*docs).withColumnRenamed("lang", "items"), spark.createDataFrame(items, "item_id long, text string")


def test_matches_a_plain_search(spark, documents, monkeypatch):
    for seed, shard, block in ((1, 2_000_000, 500_000), (2, 50, 20)):
        monkeypatch.setattr(dec, "SHARD_WORDS", shard)
        docs, items = _case(seed)
        table, benchmark = _tables(spark, documents, docs, items)
        monkeypatch.setattr(dec.blocks, "__defaults__", (block,))
        index = dec.build_index(table, dec.asked_terms(benchmark))
        assert _got(index, dec.search(index, benchmark)) == _plain(docs, items)


def test_full_index_serves_any_benchmark(spark, documents):
    docs, items = _case(3)
    table, benchmark = _tables(spark, documents, docs, items)
    index = dec.build_index(table)
    assert _got(index, dec.search(index, benchmark, window=5)) == _plain(docs, items, 5)


def test_proximity(spark, documents):
    docs = documents((1, "red x blue y green"), (2, "red x x x x x blue green"), (3, "green blue red"), (4, "red blue"))
    items = spark.createDataFrame([(9, "red blue green")], "item_id long, text string")
    index = dec.build_index(docs)
    near = dec.search(index, items, slack=4)
    assert [r[0] for r in _got(index, near) if r[2]] == [1, 3]
    assert [r[0] for r in _got(index, dec.search(index, items)) if r[2]] == []


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    index = dec.build_index(documents((1, "a b")), dec.asked_terms(none))
    assert _got(index, dec.search(index, none)) == [(1, 2, 0, [])]
    index = dec.build_index(documents())
    assert _got(index, dec.search(index, spark.createDataFrame([(1, "a")], "item_id long, text string"))) == []


def test_query_matches_a_plain_search(spark, sf_dir):
    import hashlib

    from tripwright.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    windows = {}
    for item, text in items:
        words = _words(text)
        for at in range(max(1, len(words) - 9)) if words else ():
            windows.setdefault(tuple(words[at : at + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    got = {r["doc_id"]: r for r in QUERIES["op6_decontamination"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if (named := windows.get(tuple(words[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= named
        row = got[doc_id]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (len(words), len(hit), len(found), bool(hit))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
