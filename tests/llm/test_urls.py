import random

import pytest
from pyspark.sql import functions as F

from conewise.llm import url_filter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut].translate(UP), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = (None, None)
    for verdict, rule in url_filter.RULES:
        own, _, more = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + more) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


@pytest.fixture
def pages(spark):
    def make(urls):
        return spark.createDataFrame([(i, u, "<html>", 1, "x") for i, u in enumerate(urls)],
                                     "page_id long, url string, html string, host int, features string").repartition(3)
    return make


ODD_URLS = [None, "", "://", "http://", "no scheme", "http://COM/x", "http://a.com", "http://a.com?x=/", "http://xcom/", "http://a.NET/es/1",
            "https://www.example.com/en/1", "https://www.example.com/EN/1", "http://example.com/en/", "http://b.example.com/en/x#y", "http://net/fr/",
            "a://b://c.com/d", "http://a.com:80/", "http://ü.com/é\nz", "http://a.org/" + "x" * 20_000, "http://a.com/1", "http://a.com/1"]


def test_rules_equal_brute_force(pages):
    rng = random.Random(1)
    hosts = ["a.com", "example.com", "www.example.com", "x.www.example.com", "b.net", "org", "free-bets.example.org"]
    urls = ODD_URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{i}{rng.choice(['', '?a=1&b', '#t', '.html'])}" for i in range(300)]
    got = {r.page_id: r for r in url_filter.judged(pages(urls), url_filter.RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
        assert (got[i].score is None) == (rule is not None)


def test_trees_learn_lexical_features(spark):
    """Held-out accuracy on URLs whose label follows from digits, length and suffix."""
    rng = random.Random(2)

    def url(bad, i):
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        if bad:
            return f"http://{name}-{rng.randrange(10**6)}.{rng.choice(['biz', 'info'])}/{rng.randrange(10**9)}/{i}?a={i}&b={i}&c=1"
        return f"https://www.{name}.{rng.choice(['org', 'edu'])}/{name}/about.html"

    rows = [(url(i % 2 == 0, i), int(i % 2 == 0), i % 4 == 0 or i % 4 == 1) for i in range(1200)]
    frame = url_filter.featured(spark.createDataFrame(rows, "url string, blocked int, held boolean"))
    train = frame.filter("not held")
    statistics = url_filter.suffix_statistics(train).cache()
    model = url_filter.train(train, statistics, rows=400)
    from pyspark.ml.feature import VectorAssembler
    ready = url_filter.with_statistics(frame.filter("held"), statistics, own=False)
    scored = model.transform(VectorAssembler(inputCols=url_filter.FEATURES, outputCol="features").transform(ready))
    right, total = scored.selectExpr("avg(cast(prediction = blocked as double)) as a", "count(*) as n").first()
    assert total == 600 and right >= 0.95


def test_suffix_statistics_have_a_fixed_size(spark):
    urls = [(f"http://h{i}.x{i}/", i % 2) for i in range(20_000)]
    frame = url_filter.featured(spark.createDataFrame(urls, "url string, blocked int"))
    assert url_filter.suffix_statistics(frame).count() <= 2 * url_filter.SUFFIX_SLOTS


def test_statistics_are_those_of_the_suffix_itself(spark, monkeypatch):
    """More suffixes than the broadcast table holds: each has its own counts, and unlabelled ones have none."""
    monkeypatch.setattr(url_filter, "SUFFIX_SLOTS", 8)
    rows = [(f"http://h{i}.x{j}/{c}", j % 2) for j in range(20) for i in range(3) for c in range(1 + (i + j) % 4)]
    frame = url_filter.featured(spark.createDataFrame(rows, "url string, blocked int"))
    counts = url_filter.suffix_counts(frame).cache()
    hot = url_filter.commonest(counts)
    others = counts.join(hot, ["labels", "suffix"], "left_anti")
    assert hot.count() == 16 and others.count() == 20 + 60 - 16
    n = {(k, x): 0 for k in (1, 2) for x in range(20)}
    two = {}
    for url, _ in rows:
        host = url[7:].split("/")[0]
        two[host] = two.get(host, 0) + 1
        n[1, int(host.split("x")[1])] += 1
    new = url_filter.featured(spark.createDataFrame([(u,) for u, _ in rows] + [("http://h0.y/",), ("http://q.x3/",)], "url string").distinct())
    for r in url_filter.with_statistics(new, hot, own=False, others=others).collect():
        label = r.host.split(".")[1]
        blocked, one, both = (int(label[1:]) % 2, n[1, int(label[1:])], two.get(r.host, 0)) if label != "y" else (0, 0, 0)
        assert (r.f_rate_1, r.f_rate_2) == ((blocked * one + 1) / (one + 2), (blocked * both + 1) / (both + 2))
        assert (r.f_count_1, r.f_count_2) == ((one + 1).bit_length() - 1, (both + 1).bit_length() - 1)


def test_more_suffixes_than_the_broadcast_table_holds(pages, monkeypatch):
    rules = [("block", "bad/"), ("allow", "good/")]
    urls = [f"http://h{i}.{'bad' if i % 2 else 'good'}/{i}" for i in range(60)] + [f"http://h{i}.org/{i}" for i in range(40)]
    plain = {r.page_id: r.score for r in url_filter.judged(pages(urls), rules).collect()}
    monkeypatch.setattr(url_filter, "SUFFIX_SLOTS", 4)
    few = {r.page_id: r.score for r in url_filter.judged(pages(urls), rules).collect()}
    assert len(few) == 100 and few == plain


def test_no_hot_suffix_in_the_exchange(spark):
    """5,000 suffixes, two of them with most URLs: one in the broadcast table, one that no label knows."""
    urls = [(f"http://h{i}.com/", i, 0) for i in range(3000)] + [(f"http://h{i}.dev/", i, 0) for i in range(3000)]
    urls += [(f"http://h.x{i}/", i, i % 2) for i in range(5000)]
    frame = url_filter.featured(spark.createDataFrame(urls, "url string, page_id long, blocked int").repartition(6))
    counts = url_filter.suffix_counts(frame.filter("suffix_1 <> 'dev'")).cache()
    hot = url_filter.commonest(counts).cache()
    others = counts.join(hot, ["labels", "suffix"], "left_anti").cache()
    assert others.filter("labels = 1").count() == 5001 - url_filter.SUFFIX_SLOTS
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = url_filter.with_statistics(frame, hot, own=False, others=others)
        tasks = got.filter("suffix_1 = 'dev'").groupBy(F.spark_partition_id()).count().collect()
        rates = {r.suffix_1: r.f_rate_1 for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in tasks) < 1000
    assert rates["com"] == 1 / 3002 and rates["dev"] == 0.5 and rates["x7"] == 2 / 3 and rates["x8"] == 1 / 3


def test_without_both_verdicts(pages):
    assert {r.verdict for r in url_filter.judged(pages(["http://a.org/", None]), url_filter.RULES).collect()} == {"allow"}
    only = url_filter.judged(pages(["http://a.net/es/", "http://a.org/"]), url_filter.RULES).collect()
    assert {r.verdict for r in only} == {"block"}
    assert url_filter.judged(pages(["http://a.org/"]).filter("page_id > 5"), url_filter.RULES).count() == 0


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("aaaa",), ("",), ("abcd",)], "u string").select(url_filter.entropy(url_filter.F.col("u"))).collect()
    assert [r[0] for r in got] == [1.0, 0.0, 0.0, 2.0]
