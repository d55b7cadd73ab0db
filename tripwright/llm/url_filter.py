"""URL filter: host and path rules, and a character language-model ratio for the rest.

All of it is DataFrame expressions. Two smoothed variable-order Markov models of
characters, one of accepted and one of rejected URLs, are learned from the URLs
that the rules decide. A URL's score is the log-likelihood difference per
character, and the threshold is calibrated on rule-decided URLs that the models
have not seen. Models are tables of distinct n-grams, so counting and scoring an
n-gram is done once however many URLs hold it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import written

# Characters of context at most.
ORDER = 4
# Weight of the shorter context's probability, in counts, and the number of characters it bottoms out in.
BACKOFF = 2.0
ALPHABET = 256
# One in so many rule-decided URLs calibrates instead of training.
FOLDS = 5
# N-grams that stand in very many URLs are joined in this many parts.
SALTS = 8


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def lowered(value: Column) -> Column:
    """A-Z lowered, nothing else."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` and the path behind it; both empty without one."""
    after = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"^([^?#]*)", 1)
    empty = F.lit("")
    return lowered(F.coalesce(host, empty)), F.coalesce(path, empty)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, allow) of the longest rule that fits; null if none does."""
    out = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.allow).alias("allow"))).otherwise(out)
    return out


def grams(host: Column, path: Column) -> Column:
    """The n-grams of a URL, one for each character and one for its end, with the longest context."""
    body = F.filter(F.split(F.concat(host, path), ""), lambda c: c != "")
    chars = F.concat(F.array_repeat(F.lit("^"), ORDER), body, F.array(F.lit("$")))

    # the characters are bound once, and single ones taken, so that a long URL takes linear time
    def all_of(c: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(c) - ORDER - 1),
            lambda at: F.concat(*(F.get(c, at + ahead) for ahead in range(ORDER + 1))),
        )

    return F.get(F.transform(F.array(chars), all_of), 0)


def learn(urls: DataFrame) -> DataFrame:
    """(gram, llr): the log-likelihood ratio of every distinct n-gram of ``urls``.

    ``urls`` has host, path, ``n`` (how many rows have it) and ``label``: true for
    accepted, false for rejected, null for URLs to score only. A character's
    probability after a context is mixed with that after the next shorter one,
    down to a uniform guess. Counts of shorter n-grams and of contexts are sums
    over the table of distinct n-grams.
    """
    held = urls.select(F.explode(grams(F.col("host"), F.col("path"))).alias("gram"), "n", "label")

    def count(label: bool) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))

    table = written(held.groupBy("gram").agg(count(True).alias("a"), count(False).alias("r")), "url_grams")
    total = table.agg(F.sum("a"), F.sum("r")).first()
    out = table
    chance = {"a": F.lit(1.0 / ALPHABET), "r": F.lit(1.0 / ALPHABET)}
    for order in range(ORDER + 1):
        # the n-gram's last characters, and the context before the last one
        for key, start, length in ((f"g{order}", ORDER + 1 - order, order + 1), (f"c{order}", ORDER + 1 - order, order)):
            if length == 0:
                out = out.withColumns({f"a_{key}": F.lit(total[0]), f"r_{key}": F.lit(total[1])})
                continue
            part = F.substring("gram", start, length)
            sums = table.groupBy(part.alias("part")).agg(F.sum("a").alias(f"a_{key}"), F.sum("r").alias(f"r_{key}"))
            out = out.withColumn("part", part).join(sums, "part").drop("part")
        chance = {
            x: (F.coalesce(f"{x}_g{order}", F.lit(0)) + BACKOFF * chance[x]) / (F.coalesce(f"{x}_c{order}", F.lit(0)) + BACKOFF)
            for x in chance
        }
    return out.select("gram", (F.ln(chance["a"]) - F.ln(chance["r"])).alias("llr"))


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """(url_no, score): the mean log-likelihood ratio of a URL's n-grams."""
    salt = F.pmod(F.col("url_no"), F.lit(SALTS)).cast("int")
    held = urls.select("url_no", salt.alias("salt"), F.explode(grams(F.col("host"), F.col("path"))).alias("gram"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    joined = held.join(model.select("gram", "llr", every), ["gram", "salt"])
    return joined.groupBy("url_no").agg(F.avg("llr").alias("score"))


def calibrate(scored: DataFrame) -> tuple[float, float]:
    """Slope and offset of the log odds of acceptance, from ``score`` and ``allow``.

    With both classes normal and of one spread, the log odds are linear in the
    score. With one class only, or one score, the score's sign decides. Each
    distinct URL counts once.
    """
    row = scored.agg(
        *(
            f(F.when(F.col("allow") == allow, F.col("score"))).alias(f"{name}_{int(allow)}")
            for allow in (True, False)
            for name, f in (("mean", F.avg), ("var", F.var_pop), ("n", F.count))
        )
    ).first()
    if not row["n_1"] or not row["n_0"]:
        return 1.0, 0.0
    n1, n0 = row["n_1"], row["n_0"]
    spread = (n1 * row["var_1"] + n0 * row["var_0"]) / (n1 + n0)
    if spread <= 0 or row["mean_1"] <= row["mean_0"]:
        return 1.0, 0.0
    slope = (row["mean_1"] - row["mean_0"]) / spread
    return slope, log(n1 / n0) - slope * (row["mean_1"] + row["mean_0"]) / 2


def judge(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: the id, host, path, rule, verdict, score, odds.

    A rule fits its host and the host's subdomains where the path starts with the
    rule's; the longest one decides. Where none fits, ``odds`` (calibrated log
    odds of acceptance by the models) decides: allow from 0 on. A null URL, or one
    without ``://``, has an empty host and path and no rule. Repeated rows get
    equal results; other columns are ignored. Without rule-decided URLs to learn
    from, all scores are 0.
    """
    host, path = host_and_path(F.col(url))
    named = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn(
        "match", matching_rule(F.col("host"), F.col("path"), rules)
    )
    allow = F.col("match.allow")
    held = F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS)) == 0
    urls = written(
        named.groupBy("host", "path")
        .agg(F.count("*").alias("n"), F.first(allow).alias("allow"))
        .withColumn("label", F.when(~held, F.col("allow")))
        .withColumn("url_no", F.monotonically_increasing_id()),
        "urls",
    )
    scored = written(urls.join(score(urls, written(learn(urls), "url_model")), "url_no"), "url_scores")
    slope, offset = calibrate(scored.filter(F.col("label").isNull() & F.col("allow").isNotNull()))
    return (
        named.join(scored.select("host", "path", "score"), ["host", "path"])
        .withColumn("odds", F.col("score") * slope + offset)
        .select(
            id_col,
            "host",
            "path",
            F.col("match.rule").alias("rule"),
            F.when(F.coalesce(allow, F.col("odds") >= 0), "allow").otherwise("block").alias("verdict"),
            "score",
            "odds",
        )
    )
