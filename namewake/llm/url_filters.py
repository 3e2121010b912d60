"""Operator 1: URL filters. A blocked Bloom filter in front of an exact hash join.

Listed keys are of two kinds: whole canonical URLs, and rules made of a host and a path
prefix. A page URL has one canonical form and a few (host suffix, path prefix) pairs that
a rule could have. Each of these candidates is first looked up in the filter: one block of
256 bits, found by the key's hash, in which the key has eight bits. What passes is joined
with the listed keys, exactly, so that false positives go. JVM-side throughout.

The filter has at most ``MAX_BLOCKS`` blocks however long the list is, so it may be
broadcast; a fuller filter passes more to the exact join and changes no result. The listed
keys themselves are broadcast when counted to fit, else joined by salted shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and is not listed. Repeated rows are judged alike and come back as often as they
went in. Empty lists leave every page to the default. Null keys in lists are ignored.
Other columns of ``pages`` are not read; join the result on its key and url to get them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewake.llm.common import save
from namewake.operators.joins import lookup_join

BITS_PER_KEY, BLOCK_BITS, MAX_BLOCKS = 16, 256, 1 << 17

#: Query parameters that do not tell pages apart.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sid|session)="

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^([^/?#]*)([^?#]*)(\?([^#]*))?"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), _PARTS, 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a closing slash, other parameters sorted.

    Scheme, fragment and tracking parameters go. Null where there is no host.
    """
    host = F.regexp_replace(host_of(url), "^www[.]", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    asked = F.split(F.regexp_extract(_after_scheme(url), _PARTS, 4), "&")
    left = F.array_sort(F.filter(asked, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    query = F.when(F.size(left) > 0, F.concat(F.lit("?"), F.array_join(left, "&")))
    return F.when(host != "", F.concat(host, path, F.coalesce(query, F.lit(""))))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """Four words, each with one bit set in its lower and one in its upper half."""
    h = F.xxhash64(key, F.lit("bits"))

    def bit(i: int) -> Column:
        return F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")

    one = F.lit(1).cast("bigint")
    return [
        F.call_function("shiftleft", one, bit(2 * w)).bitwiseOR(
            F.call_function("shiftleft", one, bit(2 * w + 1) + 32)
        )
        for w in range(4)
    ]


def bloom_filter(keys: DataFrame, key: str, count: int) -> tuple[DataFrame, int]:
    """One row (block, w0..w3) for each block that has bits; the number of blocks."""
    blocks = max(1, min(MAX_BLOCKS, count * BITS_PER_KEY // BLOCK_BITS))
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(key)))]
    bits = keys.select(_block(F.col(key), blocks).alias("block"), *masks)
    words = [F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]
    return bits.groupBy("block").agg(*words), blocks


def _rule_keys(rules: DataFrame) -> DataFrame:
    named = rules.select(
        F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), "path", "verdict"
    )
    rule = F.concat("host", "path")
    return named.filter(rule.isNotNull()).select(
        F.concat(F.lit("r "), rule).alias("key"),
        rule.alias("listed_rule"),
        F.col("verdict").alias("listed_verdict"),
    )


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    *,
    page_key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Judge every row of ``pages``.

    ``rules``: host, path, verdict (``allow`` or ``block``); the longest fitting rule
    wins, of equally long ones the greater. ``listed``: a column ``canonical`` of blocked
    URLs. Returns the key, url, host, path, rule, whether the URL is listed, and the
    verdict: the rule's, else block where listed, else allow.
    """
    spark = pages.sparkSession
    rule_keys = _rule_keys(rules)
    url_keys = listed.filter(F.col("canonical").isNotNull()).select(
        F.concat(F.lit("u "), "canonical").alias("key"),
        F.lit(None).cast("string").alias("listed_rule"),
        F.lit("block").alias("listed_verdict"),
    )
    keys = rule_keys.unionByName(url_keys).groupBy("key").agg(
        F.max("listed_rule").alias("listed_rule"), F.max("listed_verdict").alias("listed_verdict")
    )
    keys = save(keys, "url-keys")
    # How far candidates must reach: no longer hosts or paths than any rule has.
    spans = rules.agg(F.max(F.size(F.split("host", "[.]"))).alias("labels")).first()
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None]
    bloom, blocks = bloom_filter(keys, "key", keys.count())

    own = F.col(url)
    parts = pages.select(
        F.col(page_key), own, host_of(own).alias("host"), path_of(own).alias("path")
    )
    labels = F.split(F.col("host"), "[.]")
    deep = F.least(F.size(labels), F.lit(spans["labels"] or 0))
    suffixes = F.transform(
        F.when(deep > 0, F.sequence(F.lit(1), deep)).otherwise(F.array().cast("array<int>")),
        lambda k: F.array_join(F.slice(labels, -k, k), "."),
    )

    def rule_candidates(n: int) -> Column:
        none = F.array().cast("array<string>")
        return F.transform(
            F.when(F.length("path") >= n, suffixes).otherwise(none),
            lambda s: F.concat(F.lit("r "), s, F.substring("path", 1, n)),
        )

    by_rule = [rule_candidates(n) for n in sorted(lengths)]
    whole = F.array(F.lit(None).cast("string"), F.concat(F.lit("u "), canonical(own)))
    tried = parts.select(
        page_key, url, F.posexplode(F.concat(whole, *by_rule)).alias("at", "cand")
    ).filter((F.col("at") == 0) | F.col("cand").isNotNull())
    masks = {f"m{i}": m for i, m in enumerate(_masks(F.col("cand")))}
    passed = (
        tried.withColumns(masks | {"own_block": _block(F.col("cand"), blocks)})
        .join(
            F.broadcast(bloom),
            (F.col("own_block") == F.col("block")) & (F.col("at") > 0),
            "left",
        )
        .filter(
            (F.col("at") == 0)
            | (
                F.col("block").isNotNull()
                & (F.col("w0").bitwiseAND(F.col("m0")) == F.col("m0"))
                & (F.col("w1").bitwiseAND(F.col("m1")) == F.col("m1"))
                & (F.col("w2").bitwiseAND(F.col("m2")) == F.col("m2"))
                & (F.col("w3").bitwiseAND(F.col("m3")) == F.col("m3"))
            )
        )
        .select(page_key, url, "at", "cand")
    )
    hits = lookup_join(passed, keys, "cand", "key", "left", row_id=[page_key, url])
    fits = F.struct(
        F.length("listed_rule").alias("n"), F.col("listed_rule"), F.col("listed_verdict")
    )
    judged = hits.groupBy(page_key, url).agg(
        F.sum((F.col("at") == 0).cast("int")).alias("times"),
        F.max(F.when(F.col("listed_rule").isNotNull(), fits)).alias("best"),
        F.max(F.col("listed_rule").isNull() & F.col("listed_verdict").isNotNull()).alias("in_list"),
    )
    own_verdict = F.when(F.col("in_list"), "block").otherwise("allow")
    return judged.select(
        page_key,
        url,
        host_of(own).alias("host"),
        path_of(own).alias("path"),
        F.col("best.listed_rule").alias("rule"),
        F.col("in_list").alias("listed"),
        F.coalesce("best.listed_verdict", own_verdict).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("__copy"),
    ).drop("__copy")


#: Host labels of link farms; their pages make up the list of blocked URLs.
FARM_LABELS = "(^|[.-])(spam|pills|casino|viagra|porn|xxx|warez|lottery)([.-]|$)"

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def farm_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of all pages on hosts with a link farm's label."""
    on_farm = pages.filter(host_of(F.col("url")).rlike(FARM_LABELS))
    return on_farm.select(canonical(F.col("url")).alias("canonical")).distinct()


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = url_filter(pages, rules_table(spark, RULES), farm_urls(pages))
    return found.select("page_id", "host", "path", "rule", "listed", "verdict")


ORACLE = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0
                         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS asked
    FROM cut
), forms AS (
    SELECT *, list_sort(list_filter(string_split(asked, '&'),
               lambda p: p <> '' AND NOT regexp_matches(lower(p),
                         '^(utm_[a-z]+|ref|fbclid|gclid|sid|session)='))) AS kept
    FROM parts
), whole AS (
    SELECT *, CASE WHEN regexp_replace(host, '^www[.]', '') <> '' THEN
        regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
    FROM forms
), farm AS (
    SELECT DISTINCT canonical FROM whole
    WHERE regexp_matches(host, '(^|[.-])(spam|pills|casino|viagra|porn|xxx|warez|lottery)([.-]|$)')
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
    SELECT page_id, max({'n': length(rule_host || rule_path), 'r': rule_host || rule_path,
                         'v': rule_verdict}) AS best
    FROM whole JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT w.page_id, host, path, best.r AS rule, f.canonical IS NOT NULL AS listed,
       coalesce(best.v, CASE WHEN f.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM whole w LEFT JOIN farm f ON w.canonical = f.canonical
LEFT JOIN fits ON w.page_id = fits.page_id
"""
