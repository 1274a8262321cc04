from pyspark.sql import functions as F

from payloom.llm.queries import URL_RULES
from payloom.llm.url_templates import Tree, UrlRule, judge_urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[:min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])]
    path = rest[len(host):]
    path = path[:min([len(path), *(path.find(c) for c in "?#" if c in path)])]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_hosts_paths_and_rules(spark, sf):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/1?x=1#y", "http://a.net", "http://a.net?x/", "http://notexample.com/de/1", "http://example.com/de/",
           "x://É.org/fr/#", "http://b.org/fr", "http://u@h.net:80/p//q", "a://b://c/d", "http://net/", "http://x.net/\n/y", "http://example.net/EN/1"]
    df = spark.createDataFrame(list(enumerate(odd)) + [(None, odd[4]), (1, odd[4])], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("label", F.lit(1))
    table = spark.read.parquet(f"{sf}/pages.parquet")
    for pages in (df, table):
        got = judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
        want = []
        for p, u in pages.select("page_id", "url").collect():
            rule = rule_of(*parts(u))
            want.append((p, *parts(u), rule.text if rule else None, rule.action if rule else "allow"))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_learned_templates(spark):
    """Labelled spam below one branch of a host; other branches, hosts and unlabelled ones stay."""
    rows = []
    for i in range(300):
        rows += [(f"http://h.org/cheap/{i}", 1 if i % 3 else None), (f"http://h.org/news/{i}.html", 0 if i % 3 else None), (f"http://h.org/blog/post-{i}", None),
                 (f"http://h.org/ab{chr(97 + i % 26)}{chr(97 + i // 26)}x/offer", 1 if i % 2 else None), (f"http://ok.org/cheap/{i}", 0)]
    df = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    out = judge_urls(df, [UrlRule("allow", "h.org", "/cheap/7")], blocked="bad").join(df, "page_id").collect()
    for r in out:
        spam = r.url.startswith("http://h.org/cheap/") and not r.path.startswith("/cheap/7") or r.url.endswith("/offer")
        assert r.verdict == ("block" if spam else "allow"), r.url
    assert {r.template for r in out if r.url.endswith("/offer")} == {"*/offer"}
    assert {r.template for r in out if "h.org/cheap/" in r.url} == {"cheap/{n}"}


def test_like_branches_merge(spark):
    """Two labelled branches with the same share of blocked pages and the same paths below become one template."""
    rows = [(f"http://m.org/{b}/{i}", int(i % 10 != 0)) for b in ("red", "blue") for i in range(100)] + [(f"http://m.org/green/{i}", 0) for i in range(100)]
    df = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    out = judge_urls(df.filter("url NOT LIKE '%green%'"), [], Tree(), blocked="bad").select("template").distinct().collect()
    assert [r.template for r in out] == ["*/{n}"]
    verdicts = {r.path.split("/")[1]: r.verdict for r in judge_urls(df, [], Tree(), blocked="bad").collect()}
    assert verdicts == {"red": "block", "blue": "block", "green": "allow"}


def slug(i):
    """A word of letters: no digits that count as wildcards."""
    return "s" + "".join(chr(103 + i // 17 ** k % 17) for k in range(3))


def test_deep_paths(spark):
    """Spam and clean branches below the fourth segment part, and a path of very many segments costs no rounds."""
    rows = [(f"http://d.org/a/b/c/{b}/{slug(i)}/{slug(i * 7)}", int(b == "spam")) for b in ("spam", "clean") for i in range(100)] + [("http://d.org/" + "x/" * 500, None)]
    df = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    out = judge_urls(df, [], blocked="bad").collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.verdict == ("block" if "/spam/" in r.path else "allow"), r.path
    assert {r.template for r in out if "/spam/" in r.path} == {"a/b/c/spam/*/*"}


def test_like_branches_of_slugs_merge(spark):
    """Branches with words below are compared by their generalised paths; thinly labelled ones join, clean ones part."""
    rows = [(f"http://m.org/spam{chr(103 + b)}/{slug(i * 20 + b)}", 1 if i < 2 else None) for b in range(16) for i in range(40)]
    rows += [(f"http://m.org/news{chr(103 + b)}/{slug(i * 20 + b)}", 0 if i < 30 else None) for b in range(3) for i in range(40)]
    rows += [(f"http://m.org/about/{x}/a/b", None) for x in ("team", "jobs")] + [("http://one.org/ads/7", 1), ("http://one.org/help/7", None)]
    df = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    out = judge_urls(df, [], blocked="bad").collect()
    for r in out:
        assert r.verdict == ("block" if r.path.startswith("/spam") else "allow"), r.path
    assert {r.template for r in out if r.path.startswith("/spam")} == {"*+/*"}


def test_unlabelled_branches_join(spark):
    rows = [(f"http://j.org/{'abcd'[b]}x/{slug(i * 4 + b)}", 1 if b < 2 and i < 20 else None) for b in range(4) for i in range(40)] + [(f"http://ok.org/n/{slug(i)}", 0) for i in range(40)]
    df = spark.createDataFrame([(k, u, b) for k, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    assert {(r.host, r.template, r.verdict) for r in judge_urls(df, [], blocked="bad").collect()} == {("j.org", "*/*", "block"), ("ok.org", None, "allow")}
