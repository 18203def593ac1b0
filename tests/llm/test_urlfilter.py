import random
import re

import pytest
from pyspark.sql import functions as F

from wattmirror.llm import urlfilter
from wattmirror.llm.queries import QUERIES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def plain_canonical(url):
    host, path = plain_parts(url)
    if not host:
        return None
    host = re.sub(r"^(www|m)\.", "", re.sub(r":(80|443)\Z", "", host))
    path = re.sub(r"/+\Z", "", re.sub(r"/index\.html?\Z", "", path))
    query = url.split("#", 1)[0].split("?", 1)
    kept = sorted(p for p in (query[1].split("&") if len(query) > 1 else []) if p and not re.match(urlfilter.TRACKING, p))
    return host + path + ("?" + "&".join(kept) if kept else "")


def plain_verdict(url, listed):
    host, path = plain_parts(url)
    best = max(((len(h + p), h + p, v) for h, p, v in urlfilter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best[1] if best else None, best[2] if best else "block" if listed else "allow", listed


URLS = [None, "", "no scheme", "http://", "://x.org", "http://EXAMPLE.net/en/a", "http://example.net/EN/", "https://a.net",
        "https://a.net?x=/", "http://net/", "http://planet/", "http://a.b.example.com/de/?q#f", "http://org/fr/x",
        "http://a.org/fr", "https://www.a.com:443/x/index.html?b=2&utm_source=q&a=1#z", "http://m.a.com/x?a=1&b=2",
        "http://a.com/x//?ref=1", "http://a.com/x", "x http://a.com/x?u=http://b.com/", "http://É.com/\n\tü", "http://a.com/x?refs=1"]


def test_verdicts_equal_plain_ones(spark):
    rng = random.Random(4)
    listed = [u for u in URLS if rng.random() < .5] + ["http://only.listed/"]
    forms = {plain_canonical(u) for u in listed} - {None}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string")
    out = urlfilter.judge(pages, spark.createDataFrame([(u,) for u in listed], "url string"), ["page_id"])
    got = {r["page_id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {i: plain_verdict(u, plain_canonical(u) in forms) for i, u in enumerate(URLS * 2)}


@pytest.mark.parametrize("most_blocks", [1, 1 << 18])
def test_a_full_filter_changes_nothing(spark, most_blocks):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://h', id % 50, '.com/', id % 1000) AS url")
    listed = pages.where("page_id % 3 = 0")
    out = urlfilter.judge(pages, listed, ["page_id"], most_blocks=most_blocks)
    forms = {r["url"] for r in listed.collect()}
    assert {r["page_id"]: r["listed"] for r in out.collect()} == \
        {r["page_id"]: r["url"] in forms for r in pages.collect()}


def test_filter_passes_all_listed_and_few_others(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    blocks = -(-5000 * urlfilter.BITS_PER_KEY // 512)
    held = urlfilter.bloom_filter(keys, blocks)
    assert held.count() <= blocks

    def passed(rows):
        probe = rows.select("key", *urlfilter._places(F.col("key"), blocks)).join(held, "block")
        return probe.where(" AND ".join(f"(shiftright(w{i}, bit{i}) & 1) = 1" for i in range(urlfilter.WORDS))).count()

    assert passed(keys) == 5000
    assert passed(spark.range(5000, 25000).selectExpr("concat('k', id) AS key")) < 400


def test_one_url_with_most_pages_nulls_repeats_and_empty_tables(spark):
    rows = [(i, "http://hot.com/a") for i in range(500)] + [(1, None), (1, None), (None, "http://hot.com/a/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "'x' AS host", "1 AS key", "'y' AS salt", "2 AS block", "3 AS w0", "'z' AS page", "true AS found")
    listed = spark.createDataFrame([("https://www.hot.com/a",), (None,), ("https://www.hot.com/a",)], "url string")
    out = urlfilter.judge(pages, listed, pages.columns)
    assert out.count() == 503 and out.where("verdict = 'block'").count() == 501
    assert set(out.columns) == {"page_id", "url", "key", "salt", "block", "w0", "page", "found", *urlfilter.ADDED}
    assert out.where("page = 'z' AND key = 1 AND block = 2 AND found").count() == 503
    none = listed.where("false")
    assert urlfilter.judge(pages, none, ["page_id"]).where("listed").count() == 0
    assert urlfilter.judge(pages.where("false"), listed, ["page_id"]).count() == 0


def test_plan_has_no_python_and_joins_exactly(spark):
    out = QUERIES["op11_url_filter"](spark, "/root/testdata/sf0.01")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    assert out.where("verdict = 'block' AND rule IS NULL").count() > 0
