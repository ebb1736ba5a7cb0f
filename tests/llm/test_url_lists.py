from pickwise.llm import url_lists

URLS = ["http://Example.com/a/b/c/d?q=1", "http://example.com/a/b/cc/d", "https://u@EXAMPLE.com:80/a//b/c", "http://example.com/A/b/c",
        "http://sub.example.com/a/b/c", "http://example.com", None, "no url"]


def blocked(spark, entries, urls=URLS, at="2024-06-01"):
    captures = spark.createDataFrame([(i, u, at) for i, u in enumerate(urls)], "n long, url string, fetched string")
    log = spark.createDataFrame(entries, "list_name string, kind string, key string, action string, at string")
    rows = url_lists.blocked_lists(captures, log).collect()
    assert len(rows) == len(urls) and all(r.allowed == (not r.blocked_by) for r in rows)
    return {r.n: r.blocked_by for r in rows if r.blocked_by}


def test_prefixes_of_any_depth_and_hosts_in_any_case(spark):
    entries = [("three", "prefix", "Example.com/a/b/c/", "add", "2024-01-01"),
               ("four", "prefix", "example.com/a/b/c/d", "add", "2024-01-01"),
               ("sub", "prefix", "SUB.example.COM/a", "add", "2024-01-01")]
    assert blocked(spark, entries) == {0: ["four", "three"], 2: ["three"], 4: ["sub"]}
    assert blocked(spark, [("all", "prefix", "example.com/", "add", "2024-01-01")]) == {i: ["all"] for i in (0, 1, 2, 3, 5)}


def test_hosts_domains_and_dates(spark):
    entries = [("h", "host", "Example.com", "add", "2024-01-01"), ("h", "host", "example.com", "remove", "2024-05-01"),
               ("d", "domain", "example.com", "add", "2024-03-01")]
    assert blocked(spark, entries) == {i: ["d"] for i in range(6)}
    assert blocked(spark, entries, at="2024-02-01") == {i: ["h"] for i in (0, 1, 2, 3, 5)}
    assert blocked(spark, entries, at="2023-12-31") == {}


def test_empty_lists_block_nothing(spark):
    assert blocked(spark, []) == {}
