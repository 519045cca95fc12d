"""URL filters against a loop over all rules."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import url_filter as U


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3] if best else None, best[4] if best else default)


def got(spark, urls, rules, **kw):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, rules, **kw).collect()}


LABEL = st.sampled_from(["org", "com", "a", "b", "example", "", "ORG"])
URL = st.one_of(st.none(), st.builds(lambda s, h, p: s + ".".join(h) + p, st.sampled_from(["http://", "", "x://y://"]),
                                     st.lists(LABEL, min_size=1, max_size=4), st.text(alphabet="/ab?#\n", max_size=6)))


@settings(max_examples=8, deadline=None)
@given(st.lists(URL, min_size=1, max_size=60))
def test_random_urls(spark, urls):
    rules = [("block", "org", ""), ("allow", "example.org", "/a"), ("block", "a.example.org", "/"), ("allow", "org", "/ab"),
             ("block", "b.com", "/b/"), ("allow", "com", "/"), ("block", "example.org", "/a/b")]
    assert got(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_blocks_of_rules_give_the_same(spark):
    rnd = random.Random(3)
    hosts = [".".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    rules = [(rnd.choice(["allow", "block"]), h, "/" * rnd.randint(0, 1) + rnd.choice(["", "a", "ab"])) for h in hosts]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = ["http://" + ".".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) + rnd.choice(["", "/", "/a", "/abc", "a"]) for _ in range(500)]
    want = {i: brute(u, rules) for i, u in enumerate(urls)}
    assert got(spark, urls, rules) == want
    assert got(spark, urls, rules, block=7) == want


def test_edges(spark):
    long = "http://x.org/" + "p" * 100000
    urls = [None, "", "no scheme", "http://", "http://org", "HTTP://A.ORG/x#y", long, long, "a://b://org/"]
    assert got(spark, urls, U.RULES) == {i: brute(u, U.RULES) for i, u in enumerate(urls)}
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(df).count() == 0
    clash = spark.createDataFrame([(None, "http://org/", "h", "r")], "page_id long, url string, host string, rkey string")
    assert [tuple(r) for r in U.judge_urls(clash).collect()] == [(None, "org", "/", "org/", "allow")]
    assert got(spark, ["http://org/"], []) == {0: ("org", "/", None, "allow")}


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages).collect()}
    assert out == {r.page_id: brute(r.url, U.RULES) for r in pages.select("page_id", "url").collect()}


def test_many_path_rules_of_one_host(spark):
    import time

    rnd = random.Random(4)
    rules = list({(h, p): ("block" if rnd.random() < 0.5 else "allow", h, p) for h, p in
                  (("x.org", "/" + "".join(rnd.choice("ab/") for _ in range(rnd.randint(0, 9)))) for _ in range(3000))}.values())
    urls = ["http://www.x.org/" + "".join(rnd.choice("ab/") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    assert got(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}
    paths = U.Paths([("block", "x.org", f"/p{i}") for i in range(200_000)])
    began = time.process_time()
    assert all(paths.longest(f"/p{i}/q") == ("block", f"x.org/p{i}") for i in range(20_000))
    assert time.process_time() - began < 2


def test_a_task_is_sent_one_block_of_rules():
    from pyspark import cloudpickle

    rules = [("block", f"h{i}.org", f"/{i}") for i in range(5000)]
    one = len(cloudpickle.dumps(U._sweep(U.build(rules[:50]))))
    assert len(cloudpickle.dumps(U._sweep(U.build(rules)))) > 20 * one
