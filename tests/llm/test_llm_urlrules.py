import random
import re

import pytest
from pyspark.sql import functions as F

from skuflow.llm import urlrules as U

CONTRACT = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
            ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in CONTRACT if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2], None
    words = [w for w in U.SPAM_WORDS if w in re.split(r"[.\-]", host)]
    word = min(words, key=lambda w: (-len(w), w)) if words else None
    return host, path, None, "block" if word else "allow", word


def urls():
    rng = random.Random(5)
    hosts = ["org", "a.org", "EXAMPLE.org", "b.example.org", "xexample.org", "com", "a.b.com", "com.net", "m.casino-x.com",
             "cheap-pills.example.org", "É.com", "org:80", "", "viagra-pills.net", "porno.net"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/EN/1", "/fr/", "/fr", "/de/a/b", "/de/?q", "?/de/", "#/fr/", "/a//de/"]
    return [f"{rng.choice(['http', 'https', 'x'])}://{h}{p}{rng.choice(['', '?a=b://c', '#t'])}" for h in hosts for p in paths] + [
        None, "", "no scheme", "http:/a.org/", "://org/", "http://a.org\n/es/", "http://" + "a." * 20_000 + "org/"]


def test_equals_brute_force(spark):
    rows = list(enumerate([*urls(), *urls()[:5]])) + [(None, "http://a.org/"), (3, "http://a.org/")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, host string")
    got = sorted(map(tuple, U.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "word_rule").collect()), key=str)
    assert got == sorted(((i, *brute(u)) for i, u in rows), key=str)


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(pages).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in U.filter_urls(one, rules=()).collect()] == [(1, "a.org", "/", None, "allow", None)]


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(k, f"http://a{k}.example.org/en/1") for k in range(5)] + [(9, "http://b.org/es/")],
                                  "page_id long, url string")
    host, path = U.url_parts(F.col("url"))
    index = U.rarest_tokens(pages.select(U.url_tokens(host, path).alias("tokens")), U.HOST_RULES)
    where = {r.name: t for t, rs in index.items() for r in rs}
    assert where["example.org/es/"] == "p:es" and where["org/"] == "h:org" and where["com/de/"] in ("h:com", "p:de")


def test_rules_without_a_token_are_always_tried(spark):
    bare = U.Rule("block", "digits", r"\d{4}", ())
    pages = spark.createDataFrame([(1, "http://a.net/1234"), (2, "http://a.net/x")], "page_id long, url string")
    assert [r["verdict"] for r in U.filter_urls(pages, rules=(bare,)).orderBy("page_id").collect()] == ["block", "allow"]
    both = U.filter_urls(pages, rules=(bare, U.host_rule("allow", "net", "/12"))).orderBy("page_id").collect()
    assert [r["rule"] for r in both] == ["digits", None]


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        U.filter_urls(spark.createDataFrame([], "page_id long, url string"), rules=[U.HOST_RULES[0]] * (U.MAX_RULES + 1))
