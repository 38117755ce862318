"""The url filter against a plain version of its rules, and its edge cases."""

import math
from collections import Counter

from episodica.llm import urls
from episodica.llm.queries import URL_RULES, op7_url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    return host, path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_rules_over_all_pages(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = op7_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = parts(pages[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.block_score >= urls.BLOCK_AT else "allow")


ODD = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/ES/x", "http://example.org/es/x", "http://example.org", "http://é.ORG/É",
    "http://badexample.org/es/x", "a://b://c.com/de/x", "http://x.com?de=/fr/", "http://x.com#/de/", "http://y.com/de/\n?q",
    "http://www.example.org/en/17?x#y", "x" * 50_000, "http://h.net/" + "a/" * 20_000,
]


def test_odd_urls(spark):
    df = spark.createDataFrame(
        [(i, u, "r", "h", 1.0) for i, u in enumerate(ODD * 2)],
        "page_id int, url string, rule string, host string, block_score double",
    )
    rows = urls.judge(df, URL_RULES).collect()
    assert len(rows) == 2 * len(ODD)
    for r in rows:
        host, path = parts(ODD[r.page_id % len(ODD)])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict in ("allow", "block")
    assert urls.judge(df.limit(0), URL_RULES).count() == 0


def test_one_class_or_no_labels_give_one_verdict(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/de/1")], "page_id int, url string")
    assert {r.verdict for r in urls.judge(df, URL_RULES).collect()} == {"block"}
    assert {r.verdict for r in urls.judge(df.where("page_id = 1"), URL_RULES).collect()} == {"allow"}


def test_features(spark):
    url = "https://shop-1.example.com/a/b2/c.html?x=1&y=22#top"
    df = urls.with_lexical(urls.with_parts(spark.createDataFrame([(1, url)], "page_id int, url string")))
    r = df.first()
    n = len(url)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(url).values())
    assert abs(r.entropy - entropy) < 1e-9
    assert (r.depth, r.parameters, r.labels, r.hyphens, r.has_fragment) == (3, 2, 3, 1, 1)
    assert abs(r.digit_ratio - sum(c.isdigit() for c in url) / n) < 1e-12
    assert (r.top_suffix, r.domain_suffix) == ("com", "example.com")


def test_trees_learn_from_labelled_urls(spark):
    rows = [(i, f"http://host{i}.example.net/{'x' * 3}/{i}" if i % 2 else f"http://h{i}.example.com/a/b/c/d/{i}?p=1&q=2") for i in range(200)]
    df = urls.with_lexical(urls.with_parts(spark.createDataFrame(rows, "page_id int, url string")))
    model = urls.fit(df.withColumn("label", (1 - df.page_id % 2).cast("int")))
    scored = model.score(df).select("page_id", "block_score").collect()
    assert all((r.block_score >= 0.5) == (r.page_id % 2 == 0) for r in scored)


def test_the_plan_runs_no_python(spark, capsys):
    op7_url_filter(spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert plan and not any(x in plan for x in ("Python", "Pandas", "Arrow"))
