"""Hosts, paths and rules against plain versions; verdicts of the trees."""

import math
from collections import Counter

from pyspark.sql import functions as F

from headway.llm import urltrees
from headway.llm.queries import URL_RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    met = None
    for action, rule in URL_RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and len(rule) > len((met or ("", ""))[1]):
            met = (action, rule)
    return met


URLS = [
    None, "", "no scheme", "http://", "http:///en/", "HTTP://WWW.Example.COM/en/1?a=b#c", "https://example.com", "https://example.com?x=/en/",
    "https://a.example.com/en/", "https://www.example.com/en/x", "https://x.www.example.com/en/", "https://notexample.com/en/", "https://com/",
    "https://b.net/es/1", "https://b.net/fr/1", "https://b.net/de/1", "https://b.org/en/1#/es/", "ftp://ÄÖ.net/es/\n2", "a://b://c.com/", "x://net/es/",
]


def test_parts_and_rules(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "h"), (None, "https://b.com/", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = urltrees.judge(pages, URL_RULES, trees=2).collect()
    assert len(out) == len(rows)
    got = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule) for r in out)
    want = []
    for i, u, _ in rows:
        host, path = plain_parts(u)
        met = plain_rule(host, path)
        want.append((i is None, i or 0, host, path, met[1] if met else None))
    assert sorted(want, key=str) == sorted(got, key=str)
    for r in out:
        met = plain_rule(r.host, r.path)
        assert r.verdict == met[0] if met else r.verdict in ("allow", "block")


def test_entropy(spark):
    texts = ["", "a", "aab", "https://x.example.com/?a=1", "ÄÄö"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", urltrees.entropy(F.col("t")).alias("e")).collect():
        n = Counter(r.t)
        assert math.isclose(r.e, -sum(c / len(r.t) * math.log2(c / len(r.t)) for c in n.values()), abs_tol=1e-9)


def test_trees_learn_from_ruled_urls(spark):
    rows = [(i, f"https://s{i % 7}.example.com/en/{i}?utm={i}&b={i % 3}") for i in range(200)]
    rows += [(1000 + i, f"http://good.com/{i % 9}") for i in range(200)]
    rows += [(2000 + i, f"https://s{i % 5}.other.org/en/{i}?utm={i}&b=2") for i in range(20)] + [(3000 + i, f"http://nice.org/{i}") for i in range(20)]
    out = urltrees.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).where("rule is null").collect()
    assert {r.verdict for r in out if r.page_id < 3000} == {"block"} and {r.verdict for r in out if r.page_id >= 3000} == {"allow"}


def test_without_labels(spark):
    pages = spark.createDataFrame([(1, "https://a.org/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urltrees.judge(pages, URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in urltrees.judge(pages, [("block", "a.org/")]).collect()} == {"block"}
    assert urltrees.judge(pages.limit(0), URL_RULES).count() == 0
    assert urltrees.judge(pages, []).count() == 2


def test_no_host_sees_its_own_labels(spark):
    pages = spark.createDataFrame([(i, f"https://h{i % 9}.example.com/{'en' if i % 2 else 'de'}/{i}") for i in range(60)], "page_id long, url string")
    some = [("block", f"h{k}.example.com/") for k in range(9)]
    for k in range(9):
        flipped = [("allow" if n == k else action, rule) for n, (action, rule) in enumerate(some)]
        mine, other = (
            urltrees.featured(pages, rules).where(F.col("host") == f"h{k}.example.com").select("id", *urltrees.FEATURES).collect() for rules in (some, flipped)
        )
        assert sorted(map(tuple, mine)) == sorted(map(tuple, other))


def test_shares_are_those_of_the_other_folds(spark):
    pages = spark.createDataFrame([(i, f"https://h{i % 40}.{'net' if i % 2 else 'com'}/{'es' if i % 3 else 'en'}/") for i in range(300)], "page_id long, url string")
    rows = urltrees.featured(pages, URL_RULES).collect()
    for r in rows:
        others = [x.action for x in rows if x.suffix == r.suffix and x.fold != r.fold and x.action]
        assert math.isclose(r.suffix_block, (others.count("block") + 1) / (len(others) + 2))


def test_statistics_of_suffixes(spark):
    urls = ["https://a.x.com/", "https://a.x.com/1", "https://b.x.com/", "https://abc.y.com/", None, "https://a.x.org/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    found = {r.id: r for r in urltrees.featured(pages, []).collect()}
    assert math.isclose(found[0].suffix_host_urls, math.log(1 + 4 / 3)) and math.isclose(found[0].domain_host_urls, math.log(1 + 3 / 2))
    assert math.isclose(found[3].suffix_host_length, (7 + 7 + 9) / 3) and found[3].domain_host_length == 9
    assert found[4].suffix == "" and found[4].suffix_host_length == 0


def test_unseen_hosts_of_the_sample_are_told_apart_and_verdicts_are_of_both_kinds(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert urltrees.held_out_auc(pages, URL_RULES) > 0.8
    free = urltrees.judge(pages, URL_RULES).where("rule is null").groupBy("verdict").count().collect()
    assert {r.verdict for r in free} == {"allow", "block"}


def test_very_long_urls(spark):
    long = "https://a.net/" + "x1/" * 100_000 + "?" + "a=1&" * 100_000
    rows = [(1, long), (2, "https://b.com/"), (3, "https://b.net/es/"), (4, "https://" + "h" * 100_000)]
    out = {r.page_id: r for r in urltrees.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES, trees=2).collect()}
    assert out[1].path == "/" + "x1/" * 100_000 and len(out[4].host) == 100_000 and out[1].rule is None
