import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from starledger.llm import url_filter as uf
from starledger.llm.queries import URL_RULES, op4_url_filter
from starledger.llm.url_filter import Rule, filter_urls

SF = "/root/testdata/sf0.01"


def ruled(url, rules):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


def test_rules_equal_brute_force(spark):
    urls = dict(map(tuple, spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()))
    rows = op4_url_filter(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for row in rows:
        host, path, rule, verdict = ruled(urls[row.page_id], URL_RULES)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or ("allow" if row.score > 0 else "block"))


def places(url):
    """For each character and order, the bucket of its context and of both, by plain numbers."""
    mask = (1 << 64) - 1
    for i, character in enumerate(url):
        code = 0
        for n in range(uf.ORDER + 1):
            if n:
                code = ((code ^ (ord(url[i - n]) + 1 if i >= n else 0)) * 0x9E3779B97F4A7C15) & mask
                code ^= code >> 29
            gram = ((code ^ (ord(character) + 1)) * 0xBF58476D1CE4E5B9) & mask
            yield n, code % uf.BUCKETS, (gram ^ gram >> 31) % uf.BUCKETS


def model(urls):
    """Counts of contexts and of characters after them, of each URL as often as it is there."""
    contexts, grams = Counter(), Counter()
    for url in urls:
        for n, context, gram in places(url):
            contexts[n, context] += 1
            grams[n, gram] += 1
    return contexts, grams


def likelihood(url, counted):
    contexts, grams = counted
    total = 0.0
    for n, context, gram in places(url):
        chance = 1 / 256 if n == 0 else chance
        seen, all_ = grams[n, gram], contexts[n, context]
        chance = (seen + uf.WEIGHT * chance) / (max(seen, all_) + uf.WEIGHT)
        total += math.log(chance) if n == uf.ORDER else 0
    return total / max(1, len(url))


def score(url, allow, block):
    return likelihood(url, allow) - likelihood(url, block)


def test_scores_and_threshold_equal_brute_force(spark):
    urls = dict(map(tuple, spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()))
    labelled = {verdict: [u for u in urls.values() if u and ruled(u, URL_RULES)[3] == verdict] for verdict in ("allow", "block")}
    assert all(labelled.values())
    fold = lambda url: xxhash.xxh64_intdigest(url.encode(), 42) % 2
    # Each half is scored by models of the other half; the middle one of the best steps parts them.
    halves = [[model(u for u in labelled[v] if fold(u) == f) for v in ("allow", "block")] for f in (0, 1)]
    steps = {
        v: [math.floor((score(u, *halves[1 - fold(u)]) + uf.SPAN) * uf.STEPS) for u in found]
        for v, found in labelled.items()
    }
    right = [
        sum(x >= edge for x in steps["allow"]) / len(steps["allow"])
        + sum(x < edge for x in steps["block"]) / len(steps["block"])
        for edge in range(2 * uf.SPAN * uf.STEPS + 1)
    ]
    best = [edge for edge, share in enumerate(right) if share >= max(right) - 1e-12]
    threshold = best[len(best) // 2] / uf.STEPS - uf.SPAN
    whole = [model(labelled[v]) for v in ("allow", "block")]
    rows = op4_url_filter(spark, SF).collect()
    assert len(rows) == len(urls)
    for row in rows:
        want = score(urls[row.page_id] or "", *whole) - threshold
        assert row.score == pytest.approx(want, abs=1e-9)
        assert row.verdict == (ruled(urls[row.page_id], URL_RULES)[3] or ("allow" if want > 0 else "block"))


def test_models_agree_with_rules_on_urls_they_have_not_seen(spark):
    urls = [(i, f"http://h{i % 97}.good.org/shop/item-{i}", "allow") for i in range(2000)]
    urls += [(i + 5000, f"http://x{i % 89}.bad.org/casino/{i}.php", "block") for i in range(2000)]
    urls += [(9000 + i, f"http://n{i}.new.info/{word}{i}", None)
             for i in range(40) for word in ("shop/item-", "casino/")]
    pages = spark.createDataFrame(urls, "page_id long, url string, host string")
    rules = [Rule("allow", "good.org", "/"), Rule("block", "bad.org", "/")]
    got = filter_urls(pages, rules)
    new = got.where("rule is null").groupBy("verdict", F.col("path").startswith("/casino").alias("bad")).count()
    table = {(r.verdict, r.bad): r["count"] for r in new.collect()}
    assert table == {("allow", False): 40, ("block", True): 40}


def test_nulls_empty_repeated(spark):
    rows = [(1, None), (2, ""), (None, "http://A.COM/x"), (3, "no scheme"), (3, "no scheme"),
            (4, "HTTP://a.com"), (5, "http://x.NET/es/?q"), (6, "a://b://c/d#e"), (7, "http://" + "é" * 50_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, path string")
    got = sorted(map(tuple, filter_urls(pages, URL_RULES).drop("score", "verdict").collect()), key=str)
    assert got == sorted(((i, *ruled(u, URL_RULES)[:3]) for i, u in rows), key=str)
    assert filter_urls(pages.limit(0), URL_RULES).count() == 0
    # Nothing is blocked by the rules, so nothing is learnt.
    allowed = filter_urls(pages, [Rule("allow", "com", "/")])
    assert {r.verdict for r in allowed.collect()} == {"allow"}
