from wareloom.llm.url_filters import PAGE_RULES, judge_urls

RULES = "host string, path string, verdict string"


def judged(spark, urls, rules):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return {r.url: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, spark.createDataFrame(rules, RULES)).collect()}


def test_rules_and_edges(spark):
    got = judged(spark, ["http://A.Example.NET/en/1?x#y", "https://example.net/de/", "http://example.com", "x://example.com/de/a/b", "nothing", None,
                         "http://notexample.com/de/", "a://b.org/fr/x://c.net/", "http://net/", "http://x.net", "ftp://Y.ORG/FR/", "://a.net/?", ""], PAGE_RULES)
    assert got["http://A.Example.NET/en/1?x#y"] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got["https://example.net/de/"][2:] == ("net/", "block")
    assert got["http://example.com"] == ("example.com", "", None, "allow")  # an empty path starts with no rule path
    assert got["x://example.com/de/a/b"][2:] == ("example.com/de/", "block")
    assert got["nothing"] == got[None] == got[""] == ("", "", None, "allow")
    assert got["http://notexample.com/de/"][2:] == (None, "allow")
    assert got["a://b.org/fr/x://c.net/"] == ("b.org", "/fr/x://c.net/", "org/fr/", "allow")
    assert got["http://net/"][2:] == ("net/", "block")
    assert got["http://x.net"][2:] == (None, "allow")
    assert got["ftp://Y.ORG/FR/"] == ("y.org", "/FR/", None, "allow")
    assert got["://a.net/?"][2:] == ("net/", "block")


def test_rule_paths_off_the_slash_against_brute_force(spark):
    rules = [("a.b", "/x", "block"), ("b", "/x/y", "allow"), ("b", "", "block"), ("a.b", "/x/yz/", "allow"), ("c", "/", "block"), ("c", "/", "allow"),
             (None, "/", "block"), ("c", None, "block"), ("d", "/q", None)]
    urls = [f"h://{h}{p}" for h in ("a.b", "b", "z.a.b", "ab", "c", "d", "") for p in ("", "/", "/x", "/xy", "/x/y", "/x/yz", "/x/yz/w", "/q", "//", "/x//y")]
    got = judged(spark, urls, rules)
    for u in urls:
        host, path = got[u][:2]
        fits = [(-len(h + p), -len(h), h + p, v != "block", v) for h, p, v in rules if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = (min(fits)[2], min(fits)[4]) if fits else (None, "allow")
        assert got[u][2:] == want, u


def test_empty_tables_clashing_columns_long_url(spark):
    rules = spark.createDataFrame(PAGE_RULES, RULES)
    urls = spark.createDataFrame([(None, "http://a.net/" + "p/" * 20_000, "x", "y"), (None, None, None, None)], "page_id long, url string, host string, verdict string")
    rows = judge_urls(urls, rules).collect()
    assert sorted(r.verdict for r in rows) == ["allow", "block"] and rows[0].asDict().keys() >= {"host", "path", "rule", "verdict"}
    assert judge_urls(urls.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(urls, rules.limit(0), default="block").collect()} == {"block"}
    assert "Python" not in judge_urls(urls, rules)._jdf.queryExecution().executedPlan().toString()


def test_clashing_names_and_a_hot_url(spark):
    rows = [(i, "http://a.example.com/de/x" if i % 2 else f"http://h{i}.org/fr/", "v", "k", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, _verdict string, at string, its_rule int")
    rules = spark.createDataFrame(PAGE_RULES, "host string, path string, verdict string")
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                               "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(was, ("-1", "-1", "2k", "2k", "false", "1.5")):
            spark.conf.set(k, v)
        out = judge_urls(df.repartition(16), rules)
        got = out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 3000 and out.columns == [*df.columns, "host", "path", "rule", "verdict"]
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") and r._verdict == "v" and r["at"] == "k" for r in got)
