"""Spelling variants: words that one edit parts, found by pivotal grams.

Bigrams have a global order, the rarest first. A word's prefix is its three
first bigrams; among any three, two don't overlap. Of these, a fold over the
positions (dynamic programming) chooses the two disjoint ones, the pivots, that
the fewest words hold. One edit leaves at least one of a word's pivots whole.
So of two near words, the pivots of the one whose prefix ends earlier in the
order meet the prefix of the other. Position limits make that meeting narrow:
where the pivots stand says which parts of the word the edit cannot have
touched, and these are part of the key under which both words are indexed.
What meets is verified by the edit distance itself. All of it is DataFrame
expressions; nothing but a table of bigram counts, bounded by the alphabet, is
sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import written

LEAST_CHARS = 6
LEAST_COUNT = 5
# A near word this many times as frequent is the word's form.
TIMES = 5
# Letters of a word, and the share of runs that lose a code point.
RUN = "[A-Za-zÀ-ÿ]+"
LOSING = 199
# Letters after lower-casing: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64
# Bigrams of a word's prefix; any three hold two that are disjoint.
PREFIX = 3
# An edit adds two bigrams at most, so an equal bigram moves up to two places back among its equals.
ADDED = 2
# Longer words have keys of one fixed part instead of two (see ``index_keys``).
LONG = 32
# A form has TIMES the count, so no chain of forms is longer than the powers of 5 below 2^63.
DOUBLINGS = 5


def lowered(run: Column) -> Column:
    """A-Z lowered, nothing else."""
    low = F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(run.rlike("[A-Z]"), low).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): results of at least ``LEAST_CHARS`` code points with at least ``LEAST_COUNT`` occurrences.

    A run whose crc32 (of id, colon and run) is divisible by ``LOSING`` loses the
    code point at that number modulo its length. A null id reads as ``null``; a
    null text has no runs.
    """
    named = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    runs = docs.select(named.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.char_length("run") >= LEAST_CHARS).withColumn("run", lowered(F.col("run")))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % LOSING == 0, less).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.char_length("word") >= LEAST_CHARS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def grams(word: Column) -> Column:
    """The bigrams of a word as numbers, by position."""
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    codes = F.transform(letters, lambda c: F.when(F.ascii(c) < 128, F.ascii(c) - 97).otherwise(F.ascii(c) - 192 + 26))
    pairs = lambda held: F.transform(
        F.sequence(F.lit(0), F.size(held) - 2), lambda at: F.get(held, at) * LETTERS + F.get(held, at + 1)
    )
    return F.get(F.transform(F.array(codes), pairs), F.lit(0))


def gram_weights(words: DataFrame) -> Column:
    """How often each bigram number stands in the distinct words: one constant array of LETTERS squared numbers."""
    held = words.select(F.explode("grams").alias("gram")).groupBy("gram").count().collect()
    weights = [0] * (LETTERS * LETTERS)
    for row in held:
        weights[row["gram"]] = row["count"]
    # one literal, which the planner folds, in place of one per number
    return F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")


def pivots(ordered: Column) -> Column:
    """Struct (first, second) of the positions of the two disjoint prefix grams of least weight.

    The prefix is walked by position. A gram overlaps with none but the one just
    before it, so the best partner is the best of those before that, or that one
    if there is a gap.
    """
    gram = "struct<weight:bigint,pos:int>"
    by_pos = F.sort_array(F.transform(F.slice(ordered, 1, PREFIX), lambda g: F.struct(g["pos"].alias("pos"), g["weight"].alias("weight"))))
    state = F.struct(
        F.lit(None).cast(gram).alias("best"),
        F.lit(None).cast(gram).alias("last"),
        F.lit(None).cast("struct<weight:bigint,first:int,second:int>").alias("pair"),
    )

    def walk(s: Column, g: Column) -> Column:
        partner = F.least(s["best"], F.when(g["pos"] - s["last"]["pos"] >= 2, s["last"]))
        pair = F.when(
            partner.isNotNull(),
            F.struct(
                (partner["weight"] + g["weight"]).alias("weight"), partner["pos"].alias("first"), g["pos"].alias("second")
            ),
        )
        return F.struct(
            F.least(s["best"], s["last"]).alias("best"),
            F.struct(g["weight"].alias("weight"), g["pos"].alias("pos")).alias("last"),
            F.least(s["pair"], pair).alias("pair"),
        )

    return F.aggregate(by_pos, state, walk, lambda s: s["pair"])


def key(kind: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def head(size: Column) -> Column:
    return F.substr("word", F.lit(1), size)


def tail(start: Column) -> Column:
    """The word from position ``start``, counted from 0."""
    return F.substr("word", start + 1)


def pivot_keys() -> Column:
    """The keys under which a word looks for near words, one per place where the edit may be.

    Before the first pivot, the rest from there on is untouched; after the second,
    all up to its end; within the second or between them, all up to the first
    one's end and all behind the second; within the first or between them, all
    before the first and all from the second on. For words over ``LONG``, the last
    two and the first two are merged: all up to the first one's end, or all from
    the second on.
    """
    first, second = F.col("pivot")["first"], F.col("pivot")["second"]
    short = F.array(
        key(1, tail(first)),
        key(2, head(second + 2)),
        key(3, head(first + 2), tail(second + 2)),
        key(4, head(first), tail(second)),
    )
    return F.when(F.col("length") <= LONG, short).otherwise(F.array(key(1, tail(second)), key(2, head(first + 2))))


def index_keys() -> Column:
    """The keys under which a word is found, for each gram of its prefix that could be another's pivot.

    The other part's size is the other word's matter, so there is a key for every
    size; words over ``LONG`` have the keys of one part only, so that the keys stay
    few. A word at the border has both.
    """
    length, none = F.col("length"), F.array().cast("array<bigint>")

    def of(gram: Column) -> Column:
        at = gram["pos"]
        one = F.array(key(1, tail(at)), key(2, head(at + 2)))
        behind = F.transform(F.sequence(F.lit(0), length - at - 3), lambda size: key(3, head(at + 2), tail(length - size)))
        before = F.transform(F.sequence(F.lit(0), at - 1), lambda size: key(4, head(size), tail(at)))
        short = F.concat(F.when(length - at >= 3, behind).otherwise(none), F.when(at >= 1, before).otherwise(none))
        return F.concat(one, F.when(length <= LONG + 1, short).otherwise(none))

    last = F.get("ordered", F.lit(PREFIX - 1))
    held = F.filter(
        F.slice("ordered", 1, PREFIX + 2 * ADDED),
        lambda g: F.struct(g["weight"], g["gram"]) <= F.struct(last["weight"], last["gram"]),
    )
    return F.array_distinct(F.flatten(F.transform(held, of)))


def one_edit() -> Column:
    """Whether exactly one edit parts ``word`` and ``other_word``, different words of like length.

    The edit distance takes time quadratic in the length. For long words the
    length of the common start is found by halving, and the rests are compared.
    """
    size, other_size = F.col("length"), F.col("other_length")

    def longer(start: Column, step: Column) -> Column:
        more = start + step
        same = F.substr("word", F.lit(1), more) == F.substr("other_word", F.lit(1), more)
        return F.when((more <= F.least(size, other_size)) & same, more).otherwise(start)

    def rests(start: Column) -> Column:
        rest = F.substr("word", start + F.when(size >= other_size, 2).otherwise(1))
        return rest == F.substr("other_word", start + F.when(other_size >= size, 2).otherwise(1))

    by_rests = F.aggregate(F.array(*(F.lit(1 << bit) for bit in reversed(range(30)))), F.lit(0), longer, rests)
    return F.when(F.greatest(size, other_size) > LONG, by_rests).otherwise(F.levenshtein("word", "other_word", 1) == 1)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): pairs of ``words`` (word, n) one edit apart, each once, in one direction."""
    cut = written(
        words.withColumn("length", F.char_length("word")).withColumn("grams", grams(F.col("word"))), "spelling_grams"
    )
    weights = gram_weights(cut)
    ranked = F.transform(
        "grams",
        lambda g, at: F.struct(F.get(weights, g).alias("weight"), g.alias("gram"), at.alias("pos")),
    )
    # beyond the prefix and what may stand behind it, no gram is looked at
    ordered = F.slice(F.sort_array(ranked), 1, PREFIX + 2 * ADDED)
    placed = written(cut.select("word", "n", "length", ordered.alias("ordered")).withColumn("pivot", pivots(F.col("ordered"))), "spelling_pivots")
    last = F.get("ordered", F.lit(PREFIX - 1))
    ends = F.struct(last["weight"].alias("weight"), last["gram"].alias("gram")).alias("ends")
    asking = placed.select(F.explode(pivot_keys()).alias("key"), "word", "n", "length", ends)
    index = placed.select(F.explode(index_keys()).alias("key"), "word", "n", "length", ends)
    asking, index = written(asking, "spelling_asking"), written(index, "spelling_index")
    other = index.select("key", *(F.col(c).alias(f"other_{c}") for c in ("word", "n", "length", "ends")))
    found = asking.join(other, "key").filter(
        (F.col("word") != F.col("other_word"))
        & (F.col("ends") <= F.col("other_ends"))
        & (F.abs(F.col("length") - F.col("other_length")) <= 1)
        & one_edit()
    )
    # words whose prefixes end alike find each other from both sides
    one = F.struct("word", "n")
    two = F.struct(F.col("other_word").alias("word"), F.col("other_n").alias("n"))
    once = found.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    return once.select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms ends, by doubling the steps, from (word, form)."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling_forms")
    for _ in range(DOUBLINGS):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = written(
            at.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")),
            "spelling_roots",
        )
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest count (ties: least in code-point order)
    if it has ``TIMES`` the word's count, else null; ``root`` follows forms to
    their end. Repeated rows count as often as they stand there; other columns
    are ignored; texts and words of any length are whole. Without words there are
    no rows.
    """
    words = written(word_counts(docs, id_col, text), "spelling_words")
    pairs = written(near_pairs(words), "spelling_pairs")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    held = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    fits = F.col("form_n") >= TIMES * F.col("n")
    named = written(
        held.select(
            "word",
            F.when(fits, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("form_n")).alias("form_n"),
        ),
        "spelling_named",
    )
    ends = roots(named.filter("form IS NOT NULL"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
