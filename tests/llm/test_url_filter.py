import math
import random
import re
from collections import Counter

import pytest

from tripwright.llm import url_filter as uf
from tripwright.llm.queries import QUERIES, URL_RULES

SCHEMA = "page_id long, url string, html string, host int"
RULES = [("org/", "org", "/", "allow"), ("example.org/es/", "example.org", "/es/", "block"),
         ("example.org/en/1", "example.org", "/en/1", "block"), ("com/fr/", "com", "/fr/", "allow"), ("com/de/", "com", "/de/", "block")]


def _plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[0]), default=(None, None, None, None))
    return host, path, best[0], best[3]


URLS = [None, "", "no scheme/org/", "http://EXAMPLE.org/es/x", "https://a.Example.org/en/12?x#y", "x://org", "x://org/", "x://xorg/",
        "http://shop.com/fr/a", "http://com/de/", "http://b.com/DE/", "http://h?/a", "http://h#://b.org/", "http://ü.org/é\n?z",
        "http://b.net/" + "long" * 20_000, "http://u@h.org:80/a://b", "http://b.com/fr", "http://Ä.COM/fr/", "://", ":// "]


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", 1) for i, u in enumerate(urls)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    rows = uf.judge(_pages(spark, URLS + URLS[:4]), URL_RULES).collect()
    assert len(rows) == len(URLS) + 4
    for row in rows:
        host, path, rule, verdict = _plain((URLS + URLS)[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), row
        assert row["verdict"] in (("allow", "block") if verdict is None else (verdict,))


def _plain_scores(urls, order=4, backoff=2.0, alphabet=256):
    """(label, text, n) URLs to mean log-likelihood ratios, by dictionaries."""
    grams, contexts, totals = {}, {}, {}
    for label in (True, False):
        grams[label], contexts[label] = Counter(), Counter()
        for own, text, n in urls:
            chars = "^" * order + text + "$"
            for at in range(order, len(chars)) if own is label else ():
                for k in range(order + 1):
                    grams[label][chars[at - k : at + 1]] += n
                    contexts[label][chars[at - k : at]] += n
        totals[label] = contexts[label][""]

    def chance(label, gram):
        p = 1 / alphabet
        for k in range(order + 1):
            p = (grams[label][gram[order - k :]] + backoff * p) / (contexts[label][gram[order - k : order]] + backoff)
        return p

    out = []
    for _, text, _ in urls:
        chars = "^" * order + text + "$"
        parts = [chars[at - order : at + 1] for at in range(order, len(chars))]
        out.append(sum(math.log(chance(True, g) / chance(False, g)) for g in parts) / len(parts))
    return out


def test_scores_match_dictionaries(spark):
    draw = random.Random(1)
    urls = [(draw.choice([True, False, None]), "".join(draw.choice("abc/") for _ in range(draw.randint(0, 12))), draw.randint(1, 3)) for _ in range(80)]
    urls = list({t: (l, t, n) for l, t, n in urls}.values())
    frame = spark.createDataFrame([(i, "", t, n, l) for i, (l, t, n) in enumerate(urls)], "url_no long, host string, path string, n long, label boolean")
    got = dict(uf.score(frame, uf.learn(frame)).collect())
    assert [got[i] for i in range(len(urls))] == pytest.approx(_plain_scores(urls))


def _made(n, seed):
    draw = random.Random(seed)
    name = lambda a: "".join(draw.choice(a) for _ in range(6))
    out = []
    for i in range(n):
        good = i % 2 == 0
        word = name("aeioulmn") if good else name("xzqkwv")
        tld = draw.choice(["com", "net"])
        path = draw.choice(["/fr/", "/en/"]) if good else draw.choice(["/de/", "/en/"])
        out.append((f"http://{word}.{tld}{path}{draw.randint(0, 99)}", good))
    return out


def test_models_decide_the_rest(spark):
    made = _made(600, 2)
    rows = uf.judge(_pages(spark, [u for u, _ in made]), URL_RULES).collect()
    free = [r for r in rows if r["rule"] is None]
    right = [(r["verdict"] == "allow") == made[r["page_id"]][1] for r in free]
    assert len(free) > 300 and sum(right) / len(right) > 0.95


def test_without_decided_urls_or_rows(spark):
    rows = uf.judge(_pages(spark, ["http://a.net/x", "http://b.net/y", None]), URL_RULES).collect()
    assert {r["score"] for r in rows} == {0.0} and {r["verdict"] for r in rows} == {"allow"}
    assert uf.judge(_pages(spark, []), URL_RULES).count() == 0


def test_query(spark, sf_dir):
    urls = dict(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect())
    rows = QUERIES["op3_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(urls)
    for row in rows:
        host, path, rule, verdict = _plain(urls[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert verdict in (None, row["verdict"])
