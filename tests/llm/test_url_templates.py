import pytest
from pyspark.sql import functions as F

from shiftwell.llm import url_templates
from shiftwell.llm.queries import URL_RULES
from shiftwell.llm.url_templates import Rule, host_of, path_of, url_verdicts


@pytest.fixture
def judged(spark):
    def judge(urls, rules=URL_RULES, **options):
        rows = [(i, url) for i, url in enumerate(urls)]
        pages = spark.createDataFrame(rows, "page_id bigint, url string")
        found = url_verdicts(pages, rules, **options).collect()
        return [row for row in sorted(found, key=lambda r: r.page_id)]

    return judge


PARTS = [
    (None, "", ""),
    ("", "", ""),
    ("no scheme/at/all", "", ""),
    ("http://", "", ""),
    ("http:///only/path", "", "/only/path"),
    ("HTTP://WWW.Exämple.ORG/Ab", "www.exämple.org", "/Ab"),
    ("http://ÄB.org", "Äb.org", ""),
    ("http://u:p@h.org:80/x?y=/z#w", "u:p@h.org:80", "/x"),
    ("http://a.org?q=1/2", "a.org", ""),
    ("http://a.org#f/g", "a.org", ""),
    ("http://a.org/b#c?d", "a.org", "/b"),
    ("x://a.org/http://b.org/c", "a.org", "/http://b.org/c"),
    ("http://a.org/b\nc?d", "a.org", "/b\nc"),
]


def test_hosts_and_paths(spark):
    frame = spark.createDataFrame([(url,) for url, _, _ in PARTS], "url string")
    found = frame.select(host_of(F.col("url")), path_of(F.col("url"))).collect()
    assert [tuple(row) for row in found] == [(host, path) for _, host, path in PARTS]


def test_longest_rule_wins(judged):
    urls = {
        "http://a.org/x": ("org/", "allow"),
        "http://a.org": (None, None),
        "http://example.org/es/1": ("example.org/es/", "block"),
        "http://m.example.org/es/1": ("example.org/es/", "block"),
        "http://notexample.org/es/1": ("org/", "allow"),
        "http://m.example.org/es": ("org/", "allow"),
        "http://example.org/en/17": ("example.org/en/1", "block"),
        "http://example.org/en/27": ("org/", "allow"),
        "http://shop.com/fr/1": ("com/fr/", "allow"),
        "http://shop.com/de/1": ("com/de/", "block"),
        "http://shop.com.net/de/1": (None, None),
        "http://com/de/": ("com/de/", "block"),
    }
    for row, (rule, verdict) in zip(judged(urls), urls.values()):
        assert row.rule == rule
        assert verdict is None or row.verdict == verdict


def test_templates_generalise_merge_and_reject(judged):
    rules = [Rule("block", "a.com", "/spam/1"), Rule("allow", "a.com", "/news/1")]
    rules.append(Rule("block", "a.com", "/ads/1"))
    urls = [
        f"http://a.com/{part}/{digit}{i:03}/view"
        for part in ("spam", "news", "ads")
        for digit in "12"
        for i in range(40)
    ]
    rows = judged(urls, rules)
    assert {row.template for row in rows} == {"a.com/ads|spam/*/view", "a.com/news/*/view"}
    for row in rows:
        assert row.verdict == ("allow" if "/news/" in row.path else "block")
        assert (row.rule is None) == (row.path.split("/")[2][0] == "2")


def test_unlabelled_host_takes_the_share_of_all(judged):
    rules = [Rule("block", "a.com", "/")]
    rows = judged(["http://a.com/x"] * 9 + ["http://b.com/y"], rules)
    assert rows[-1].rule is None and rows[-1].verdict == "block"
    assert rows[-1].purity == pytest.approx(10 / 11)


def test_signs_of_templates_in_segments(judged):
    urls = ["http://a.com/*/x"] * 6 + ["http://a.com/p|q/x"] * 6 + ["http://a.com/rare/x"]
    templates = {row.template for row in judged(urls, [])}
    assert templates == {"a.com/%2A|p%7Cq/x", "a.com/*/*"}


def test_depth_joins_what_lies_beyond(judged):
    urls = ["http://a.com/a/b/c/d/e"] * 6
    assert {r.template for r in judged(urls, [], depth=2)} == {"a.com/a/b/c/d/e"}
    assert {r.template for r in judged(urls, [], depth=4)} == {"a.com/a/b/c/d/e"}
    long = "http://a.com/" + "s/" * 5000
    assert judged([long] * 3, [])[0].template == "a.com/*/*/*/*"


def test_nulls_repeats_and_clashing_columns(spark, judged):
    rows = judged([None, "", "x", "http://a.org/", None])
    assert [(r.host, r.path, r.rule) for r in rows] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.org", "/", "org/"), ("", "", None)
    ]
    assert all(row.verdict == "allow" for row in rows)
    assert judged([]) == []
    data = [(None, "http://a.com/de/1", "h", "n"), (None, "http://a.com/de/1", "h", "n")]
    pages = spark.createDataFrame(data, "page_id bigint, url string, host string, node string")
    found = url_verdicts(pages, URL_RULES).collect()
    assert [(r.page_id, r.host, r.verdict) for r in found] == [(None, "a.com", "block")] * 2


def test_no_python_runs(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x/y")], "page_id bigint, url string")
    plan = url_verdicts(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nodes_too_large_to_send(judged, monkeypatch):
    urls = [f"http://{h}.com/{p}/{i}" for h in "ab" for p in ("de", "fr", "x") for i in range(9)]
    sent = judged(urls)
    monkeypatch.setattr(url_templates, "SENT_BYTES", -1)
    assert judged(urls) == sent
