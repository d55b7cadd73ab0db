"""Quality rules whose cutoffs limit the false rejections of every stratum.

All of it is DataFrame expressions. A rule rejects texts whose measure passes a
cutoff. One fold of the labelled texts proposes a path of cutoffs, from lenient
to strict, each step rejecting all that the step before does. The other folds
are the holdout: per stratum (language), the steps are tested in order. A step
passes if the exact binomial probability of seeing so few rejected good texts,
were a share ``RISK`` of all good texts rejected, is at most ``MISS`` divided by
the number of strata; testing ends at the first step that fails. So with
probability 1 - ``MISS`` no stratum loses more than ``RISK`` of its good texts,
whichever of the passed steps is taken. The one taken tells good and bad best.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import written

# Share of good texts that a stratum may lose, and the chance that any stratum loses more.
RISK = 0.05
MISS = 0.05
# One in so many labelled texts proposes cutoffs, the others test them.
FOLDS = 4
# A language is a stratum of its own from so many good texts in the holdout; the others form one together.
LEAST_LABELS = 100
# At most so many languages are strata of their own (those with the most labels): the table is broadcast.
MAX_STRATA = 1_000
POOLED = "(few labels)"
# Words per window in which repetition is counted.
WINDOW = 8
# Base rule: fewer words than this, or over so many of a hundred words repeated.
LEAST_WORDS = 20
MOST_REPEATED = 30
# Shares of the good texts of the proposing fold that a rule by itself may reject, step by step.
STEPS = (0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.04)
# Cutoffs a rule may take, from strict to lenient.
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0)
CUTOFFS = {
    "symbols_per_word": SHARES,
    "bangs_per_word": SHARES,
    "capitals_per_char": SHARES,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "chars_per_word": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0),
}
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where lambdas inside ``use`` refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words that the array holds twice or more.

    Windows are told apart by 64-bit hashes. Equal ones meet by sorting, in time
    n log n, and only where there are any.
    """

    def covered(keys: Column) -> Column:
        def twins(ordered: Column) -> Column:
            def twin(item: Column, at: Column) -> Column:
                same = lambda other: F.coalesce(F.get(ordered, other)["key"] == item["key"], F.lit(False))
                return F.when(same(at - 1) | same(at + 1), item["at"])

            starts = F.sort_array(F.array_compact(F.transform(ordered, twin)))
            state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(
                starts,
                state,
                lambda s, at: F.struct(
                    (s["n"] + at + WINDOW - F.greatest(s["end"], at)).alias("n"), (at + WINDOW).alias("end")
                ),
                lambda s: s["n"],
            )

        ordered = F.sort_array(F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(bind(ordered, twins))

    keys = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda at: F.xxhash64(*(F.get(words, at + ahead) for ahead in range(WINDOW))),
    )
    return F.when(F.size(words) <= WINDOW, 0).otherwise(bind(keys, covered))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text but with the struct ``m`` of counts and rule measures.

    A null text has no words, like an empty one; its measures are 0. Work per text
    is linear but for the sorting of windows, whatever the text's length.
    """

    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # trimmed, so that a split leaves no empty words
    inner = F.btrim(body, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            F.char_length(F.array_join(words, "")).alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            bind(
                lines,
                lambda held: F.struct(F.size(held).alias("n"), (F.size(held) - F.size(F.array_distinct(held))).alias("dup")),
            ).alias("lines"),
            F.regexp_count(body, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
            F.regexp_count(body, F.lit("!")).alias("n_bangs"),
            F.regexp_count(body, F.lit("[A-Z]")).alias("n_capitals"),
        )

    def with_shares(c: Column) -> Column:
        def per(part: Column, whole: Column) -> Column:
            return part / F.greatest(whole, F.lit(1))

        held = {name: c[name] for name in COUNTS if name != "n_dup_lines"} | {"n_dup_lines": c["lines"]["dup"]}
        shares = {
            "symbols_per_word": per(c["n_symbols"], c["n_words"]),
            "bangs_per_word": per(c["n_bangs"], c["n_words"]),
            "capitals_per_char": per(c["n_capitals"], c["word_chars"]),
            "dup_line_share": per(c["lines"]["dup"], c["lines"]["n"]),
            "repeat_share": per(c["n_repeat_words"], c["n_words"]),
            "chars_per_word": per(c["word_chars"], c["n_words"]),
        }
        return F.struct(
            *(value.cast("long").alias(name) for name, value in held.items()),
            *(value.alias(name) for name, value in shares.items()),
        )

    # one expression, so that no step of it is planned, and worked out, several times
    return docs.withColumn("m", bind(bind(words, counts), with_shares)).drop(text)


def propose(good: DataFrame) -> list[dict[str, float]]:
    """The path: per step the cutoff of every rule that applies, from the measures of good texts.

    A step gives a rule its strictest cutoff that no more than the step's share of
    the good texts pass. Without any text there is no step.
    """
    passing = {
        (rule, cutoff): F.count(F.when(F.col("m")[rule] > cutoff, 1)).alias(f"{rule}_{at}")
        for rule, cutoffs in CUTOFFS.items()
        for at, cutoff in enumerate(cutoffs)
    }
    row = good.agg(F.count("*").alias("n"), *passing.values()).first()
    if not row["n"]:
        return []
    counts = dict(zip(passing, row[1:]))
    path = []
    for share in STEPS:
        fits = {rule: [c for c in cutoffs if counts[rule, c] <= share * row["n"]] for rule, cutoffs in CUTOFFS.items()}
        path.append({rule: min(cutoffs) for rule, cutoffs in fits.items() if cutoffs})
    return path


def rejecting_step(path: list[dict[str, float]]) -> Column:
    """The first step whose cutoffs reject the text; null if none does."""
    step = F.lit(None).cast("int")
    for at in reversed(range(len(path))):
        hits = [F.col("m")[rule] > cutoff for rule, cutoff in path[at].items()]
        if hits:
            step = F.when(F.greatest(*hits, F.lit(False)), at).otherwise(step)
    return step


def log_factorial(n: Column) -> Column:
    """ln(n!) of a whole number: from the factorial up to 20, above by Stirling's series (error under 1e-14)."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5))) - 1 / (1680 * F.pow(x, F.lit(7)))
    large = (x + 0.5) * F.ln(x) - x + 0.9189385332046727 + series  # the constant is ln(2 pi) / 2
    return F.when(n <= 20, F.ln(F.factorial(n.cast("int")))).otherwise(large)


def chance_of_so_few(k: Column, n: Column, share: float = RISK) -> Column:
    """P(X <= k) of a binomial X of ``n`` draws with ``share``; exact for k below the mean, else 1.

    The terms are summed from k downwards, where they shrink. The part behind
    the last one summed is bounded by the number of terms left, so the result is
    never too small, and no more than some nine standard deviations are summed.
    """
    top = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k * F.lit(log(share)) + (n - k) * F.lit(log1p(-share))
    )
    summed = F.least(k, F.ceil(F.sqrt(F.lit(80 * share) * n)))
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def down(s: Column, by: Column) -> Column:
        at = k - by + 1
        term = s["term"] * at * F.lit((1 - share) / share) / (n - at + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    steps = F.when(summed > 0, F.sequence(F.lit(1).cast("long"), summed.cast("long"))).otherwise(F.array().cast("array<long>"))
    rest = F.aggregate(steps, state, down, lambda s: s["sum"] + s["term"] * (k - summed))
    return F.when(k >= n * share, 1.0).otherwise(F.least(F.exp(top) * rest, F.lit(1.0)))


def certify(holdout: DataFrame, n_steps: int) -> DataFrame:
    """(lang, own, step, n_good, n_bad): per stratum the step taken, null where none passes.

    ``holdout`` has lang, good (boolean) and step (that rejects the text, or null).
    Languages with few labels share the stratum ``POOLED`` (``own`` false).
    """
    held = [
        F.count(F.when((F.col("good") == good) & (F.col("step") <= at), 1)).alias(f"{name}_{at}")
        for name, good in (("good", True), ("bad", False))
        for at in range(n_steps)
    ]
    sizes = [F.count(F.when(F.col("good"), 1)).alias("n_good"), F.count(F.when(~F.col("good"), 1)).alias("n_bad")]
    by_lang = written(holdout.groupBy("lang").agg(*sizes, *held), "quality_counts")
    own = by_lang.filter(F.col("n_good") >= LEAST_LABELS).orderBy(F.desc("n_good"), "lang").limit(MAX_STRATA)
    own = own.select("lang", F.lit(True).alias("own"))
    sums = [F.sum(c).alias(c) for c in by_lang.columns[1:]]
    strata = written(
        by_lang.join(F.broadcast(own), "lang", "left")
        .withColumn("own", F.coalesce("own", F.lit(False)))
        .groupBy("own", F.when(F.col("own"), F.col("lang")).otherwise(POOLED).alias("lang"))
        .agg(*sums),
        "quality_strata",
    )
    n_strata = strata.filter("n_good > 0").count()
    passed, best = F.lit(True), F.lit(None).cast("struct<gain:double,back:int>")
    for at in range(n_steps):
        passed = passed & (chance_of_so_few(F.col(f"good_{at}"), F.col("n_good")) <= MISS / max(n_strata, 1))
        gain = F.col(f"bad_{at}") / F.greatest("n_bad", F.lit(1)) - F.col(f"good_{at}") / F.col("n_good")
        # among equal gains the more lenient step, which is the smaller one
        best = F.greatest(best, F.when(passed, F.struct(gain.alias("gain"), F.lit(-at).alias("back"))))
    return strata.select("lang", "own", (-best["back"]).alias("step_taken"), "n_good", "n_bad")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, counts, base_failed, kept, stratum, and the steps behind it.

    ``labels`` has the id and quality (1 good, 0 bad). Of several labels of one id
    the worst counts; null ids and labels teach nothing. A text fails the base
    rule with under ``LEAST_WORDS`` words or over ``MOST_REPEATED`` % of its words
    in repeated windows. Others are kept unless the cutoffs of their stratum
    reject them; a stratum with too few labels to prove any cutoff rejects none,
    and so does an empty label table. Null and empty texts have no words and fail
    the base rule. A null language is ``und``. Repeated rows get equal results;
    other columns of ``docs`` and ``labels`` are ignored. Empty in, empty out.
    """
    measured = written(
        measure(
            docs.select(
                F.col(id_col).alias("id"),
                F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                F.col(text).alias("text"),
            )
        ),
        "quality_measures",
    )
    worst = labels.groupBy(F.col(id_col).alias("id")).agg((F.min("quality") == 1).alias("good")).filter("good IS NOT NULL")
    labelled = written(measured.join(worst, "id"), "quality_labelled")
    # four hex digits of a digest that every SQL engine has
    proposing = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 4), 16, 10).cast("int") % FOLDS == 0
    path = propose(labelled.filter(proposing & F.col("good")))
    step = rejecting_step(path)
    strata = certify(labelled.filter(~proposing).select("lang", "good", step.alias("step")), len(path))
    table = strata.select("lang", "own", "step_taken")
    own = table.filter("own").select("lang", F.col("lang").alias("stratum"), "step_taken")
    pooled = table.filter(~F.col("own")).first()
    m = F.col("m")
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    taken = F.when(F.col("stratum").isNull(), F.lit(pooled and pooled["step_taken"]).cast("int")).otherwise(F.col("step_taken"))
    rejected = F.coalesce(F.col("step") <= taken, F.lit(False))
    return (
        measured.withColumn("step", step)
        .join(F.broadcast(own), "lang", "left")
        .select(
            F.col("id").alias(id_col),
            *(m[name].alias(name) for name in COUNTS),
            failed.alias("base_failed"),
            (~failed & ~rejected).alias("kept"),
            F.coalesce("stratum", F.lit(POOLED)).alias("stratum"),
            F.col("step").alias("rejecting_step"),
            taken.alias("step_taken"),
        )
    )
