import random

import pytest

from namewake.llm.url_filters import MAX_BLOCKS, RULES, bloom_filter, canonical, rules_table, url_filter
from pyspark.sql import functions as F


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def plain_rule(host, path, rules):
    fit = [(len(h + p), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, default=(0, None, None))[1:]


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "https://a.net?x#y", "x://y://net/",
    "http://notnet/a", "http://example.net/en", "http://example.net/en/", "http://www.Example.NET/en/1?q=2",
    "http://m.example.com/de/3#top", "http://a.org/fr/", "http://org/fr/x/", "http://ÄÖ.net/de/", "http://a.net/en/\n?z",
    "http://" + "a." * 3000 + "net/" + "p" * 5000,
]


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, "h", "p", "r", "v") for i, u in rows],
        "page_id bigint, url string, host string, path string, rule string, verdict string",
    )


def listed(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "canonical string")


def test_odd_urls_rules_and_repeated_rows(spark):
    rows = list(enumerate(URLS)) + [(6, URLS[6]), (6, URLS[6]), (None, URLS[5]), (6, None)]
    got = url_filter(pages(spark, rows), rules_table(spark, RULES), listed(spark, [None]))
    want = []
    for i, u in rows:
        host, path = plain_host_path(u)
        rule, verdict = plain_rule(host, path, RULES)
        want.append((i, u, host, path, rule, False, verdict or "allow"))
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("limit", ["0", str(64 << 20)])
def test_listed_urls_exactly_with_a_crowded_filter(spark, monkeypatch, limit):
    from namewake.llm import url_filters

    monkeypatch.setattr(url_filters, "MAX_BLOCKS", 1)  # nearly everything passes the filter
    spark.conf.set("spark.namewake.broadcastBytes", limit)
    try:
        rng = random.Random(1)
        urls = [f"http://www.h{rng.randint(0, 9)}.com/p{rng.randint(0, 40)}?b=1&a=2&utm_x=3" for _ in range(300)]
        urls += ["http://hot.com/same"] * 200
        bad = {f"h{i}.com/p{j}?a=2&b=1" for i in range(9) for j in range(0, 40, 3)} | {"hot.com/same"}
        df = pages(spark, list(enumerate(urls)))
        got = url_filter(df, rules_table(spark, []), listed(spark, sorted(bad) * 2))
        forms = {r[0]: r[1] for r in df.select("page_id", canonical(F.col("url"))).collect()}
        assert {r.page_id: r.verdict == "block" for r in got.collect()} == {i: f in bad for i, f in forms.items()}
    finally:
        spark.conf.unset("spark.namewake.broadcastBytes")


def test_canonical_forms(spark):
    forms = {
        "http://www.A.com/": "a.com", "https://a.com/x/?ref=1#f": "a.com/x", "http://a.com?z=1&b=2": "a.com?b=2&z=1",
        "nothing": None, "http:///path": None, "http://a.com/?UTM_source=q&c": "a.com?c",
    }
    df = spark.createDataFrame([(u,) for u in forms], "url string")
    assert {r[0]: r[1] for r in df.select("url", canonical(F.col("url"))).collect()} == forms


def test_filter_has_few_false_positives_and_a_bound(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    bloom, blocks = bloom_filter(keys, "key", 5000)
    assert bloom.count() <= blocks <= MAX_BLOCKS
    assert bloom_filter(keys, "key", 1 << 40)[1] == MAX_BLOCKS


def test_no_pages(spark):
    assert url_filter(pages(spark, []), rules_table(spark, RULES), listed(spark, ["a"])).count() == 0
