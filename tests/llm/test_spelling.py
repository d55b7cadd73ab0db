import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tripwright.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _plain(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall((text or "").translate(LOW)):
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and _near(a, b):
                near[a].append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def _got(docs):
    return sorted((tuple(r) for r in spelling.variants(docs).collect()), key=repr)


def _dense(seed, letters, sizes, many):
    """Words over few letters, so that bigrams repeat and many words are near, with counts that make chains."""
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(draw.choice(sizes))) for _ in range(many)]
    for word in words[: many // 2]:
        at = draw.randrange(len(word))
        words.append(word[:at] + draw.choice(letters) + word[at + draw.choice([0, 1]) :])
    return [(i, " ".join([word] * draw.choice([5, 5, 6, 30, 31, 160, 800]))) for i, word in enumerate(words)]


def test_matches_all_pairs_on_dense_words(spark, documents):
    for seed, letters, sizes, many in ((1, "ab", (6, 7, 8), 150), (2, "aé×z", (6, 7, 9, 12), 200), (3, "ab", (31, 32, 33, 34), 150)):
        docs = _dense(seed, letters, sizes, many)
        table = documents(*docs).withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("key", F.lit(0))
        assert _got(table) == _plain(docs), seed


def test_chains_of_forms(spark, documents):
    chain = ["aaaaaa", "baaaaa", "bbaaaa", "bbbaaa", "bbbbaa", "bbbbba"]
    docs = [(i, " ".join([w] * 5**i * 5)) for i, w in enumerate(chain)]
    got = {r[0]: r for r in _got(documents(*docs))}
    assert _got(documents(*docs)) == _plain(docs)
    assert {r[2] for r in got.values()} == {"bbbbba"}
    assert got["aaaaaa"][1] == "baaaaa" and got["bbbbba"][1] is None


def test_ties_go_to_the_least_word(spark, documents):
    docs = [(1, "abcdef " * 5), (2, "abcdex " * 25), (3, "abcdea " * 25), (4, "ÀBCDEÉ " * 5), (5, "Àbcdeé " * 4 + "àbcdeé " * 26)]
    assert _got(documents(*docs)) == _plain(docs)


def test_nulls_long_words_and_empty_tables(spark, documents):
    long = "a" * 100_000
    docs = [(None, "wordly " * 3), (None, "wordly " * 3), (1, None), (2, ""), (3, "1 2 3 ,.;"), (4, "short " * 9)]
    assert _got(documents(*docs)) == _plain(docs)
    for other in (long + "b", long[:50_000] + "b" + long[50_000:], long[:-1]):
        docs = [(i, long) for i in range(5)] + [(i, other) for i in range(5, 10)]
        assert _got(documents(*docs)) == _plain(docs)
    assert _got(documents()) == []


def test_deletion_follows_id_and_run(spark, documents):
    docs = [(i, f"banana Bananas {i}") for i in range(3000)]
    got = _got(documents(*docs))
    assert got == _plain(docs) and 6000 - sum(r[3] for r in got) > 0


def test_query_matches_a_plain_version(spark, sf_dir):
    from tripwright.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf_dir).collect()), key=repr)
    assert got == _plain(docs)
