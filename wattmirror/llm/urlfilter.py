"""Judging URLs by path rules and by a list, with DataFrame functions only.

The list is held as canonical URLs. A blocked Bloom filter of it is broadcast: a URL's hash names one block of 512 bits
and one bit in each of its eight words, so a probe reads one row. What the filter lets pass goes to an exact hash join
with the list, which takes out the false positives; all other rows are never shuffled.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import pin

# Fixed by the contract: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
# Host labels whose pages make up the list of the registered query.
LISTED_LABELS = ("casino-win", "free-bets", "cheap-pills", "ads-track")
# Query parameters that do not change a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

WORDS = 8                       # of 64 bits, in a block
BITS_PER_KEY = 16
# 16 MB of bits: the bound of what is broadcast. Longer lists fill it more densely, and more rows go to the join.
MOST_BLOCKS = 1 << 18
SALTS = 16                      # parts into which one URL's pages are dealt for the join
ADDED = ("host", "path", "rule", "verdict", "listed")


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path of a URL; both empty without :// and for null."""
    text, pattern = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return _lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def canonical(url: Column) -> Column:
    """The form under which a URL is listed; null if it has no host.

    Scheme, a leading www. or m., default ports, fragment, tracking parameters, index pages and trailing slashes go;
    the other parameters are sorted.
    """
    host, path = host_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", ""), r"/+$", "")
    given = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(given, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, query))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; of equally long ones that of the longer host,
    then the first in code point order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r), reverse=True):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule = F.when(fits, own_host + own_path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _places(key: Column, blocks: int) -> list[Column]:
    """The block of a key, and its bit in each word of the block."""
    bits = F.xxhash64(F.lit(17), key)
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"),
            *[F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int").alias(f"bit{i}")
              for i in range(WORDS)]]


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The blocks (block, w0 to w7) of the keys; at most `blocks` rows."""
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"bit{i}"))).alias(f"w{i}") for i in range(WORDS)]
    return keys.select(*_places(F.col("key"), blocks)).groupBy("block").agg(*words)


def judge(pages: DataFrame, listed: DataFrame, keep: list[str], rules: Sequence[tuple[str, str, str]] = RULES,
          url: str = "url", most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The kept columns with host, path, rule, verdict and listed, one row per page.

    listed: any table with a column `url`; nulls and URLs without a host list nothing, repeats count once, an empty list
    lists nothing. rules: a short list that is written into the plan; long ones belong into `listed`. verdict: that of
    the longest rule that fits, else block if the canonical URL is listed, else allow. Null URLs have an empty host and
    path and are allowed. Repeated pages give repeated rows; an empty table gives none. A kept column that has the name
    of an added one is replaced by it. The driver sees one count; the filter is bounded by `most_blocks`.
    """
    keys = pin(listed.select(canonical(F.col("url")).alias("key")).where("key IS NOT NULL").distinct(), "listed")
    blocks = min(most_blocks, max(1, -(-keys.count() * BITS_PER_KEY // (64 * WORDS))))
    keep = [c for c in keep if c not in ADDED]
    rows = pages.select(F.struct(*keep).alias("page"), F.col(url).alias("url"), canonical(F.col(url)).alias("key"))
    rows = rows.select("page", "url", "key", *_places(F.col("key"), blocks))
    probed = rows.join(F.broadcast(bloom_filter(keys, blocks)), "block", "left")
    hit = F.col("key").isNotNull() & F.col("w0").isNotNull()
    for i in range(WORDS):
        hit = hit & (F.call_function("shiftright", F.col(f"w{i}"), F.col(f"bit{i}")).bitwiseAND(F.lit(1)) == 1)
    hit = F.coalesce(hit, F.lit(False))
    salted = keys.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                         F.lit(True).alias("found"))
    salt = F.pmod(F.xxhash64("page", "url"), F.lit(SALTS)).cast("int")
    possible = probed.where(hit).select("page", "url", "key", salt.alias("salt")) \
        .join(salted.hint("merge"), ["key", "salt"], "left")
    judged = probed.where(~hit).select("page", "url", F.lit(False).alias("listed")).union(
        possible.select("page", "url", F.coalesce("found", F.lit(False))))
    host, path = host_path(F.col("url"))
    judged = judged.select("page", "listed", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(*[F.col("page")[c].alias(c) for c in keep], "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, other).alias("verdict"), "listed")


def labelled(pages: DataFrame, labels: Sequence[str] = LISTED_LABELS) -> DataFrame:
    """The URLs whose host has one of the labels: the list of the registered query."""
    host, _ = host_path(F.col("url"))
    return pages.where(F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, labels)))).select("url")


_CANONICAL = r"""
    CASE WHEN host <> '' THEN
        regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', '')
        || regexp_replace(regexp_replace(path, '/index\.html?$', ''), '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END"""

ORACLE = rf"""
WITH cut AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
        list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\?([^#]*)', 1), '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))) AS kept
    FROM pages),
forms AS (SELECT page_id, host, path, {_CANONICAL} AS form FROM cut),
listing AS (
    SELECT DISTINCT form FROM forms
    WHERE form IS NOT NULL AND len(list_filter(string_split(host, '.'),
        lambda x: x IN ({', '.join(f"'{x}'" for x in LISTED_LABELS)}))) > 0),
rules(rule_host, rule_path, says) AS (VALUES {', '.join(map(str, RULES))}),
fitting AS (
    SELECT page_id, host, path, form, rule_host || rule_path AS rule, says,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
    FROM forms LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule,
    coalesce(says, CASE WHEN listing.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
    listing.form IS NOT NULL AS listed
FROM fitting LEFT JOIN listing ON fitting.form = listing.form WHERE place = 1
"""
