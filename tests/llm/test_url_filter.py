from collections import Counter

import pytest

from aerostar.llm import url_filter as U
from aerostar.llm.queries import URL_RULES

CASES = [  # url -> host, path, rule, verdict
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("no scheme/fr/", "", "", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("http://A.Example.ORG/es/x?q=1", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://m.x.com/de/1#/fr/", "m.x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/DE/1", "x.com", "/DE/1", None, "allow"),
    ("http://x.com?/de/", "x.com", "", None, "allow"),
    ("http://x.com/fr/a://b.org/es/", "x.com", "/fr/a://b.org/es/", "com/fr/", "allow"),
    ("http://x.com.net/de/", "x.com.net", "/de/", None, "allow"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, c[0], "r", "v") for k, c in enumerate(CASES)] + [(4, CASES[4][0], "r", "v"), (None, CASES[9][0], None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string")


def test_cases(spark, pages):
    want = Counter((k, *c[1:]) for k, c in enumerate(CASES)) + Counter([(4, *CASES[4][1:]), (None, *CASES[9][1:])])
    assert Counter(tuple(r) for r in U.filter_urls(spark, pages, URL_RULES).collect()) == want


def test_no_rules_rules_without_host_and_ties(spark, pages):
    assert {r.verdict for r in U.filter_urls(spark, pages, [], default="block").collect()} == {"block"}
    rules = [U.Rule("block", "", "/es/"), U.Rule("block", "com", "/de/"), U.Rule("allow", "com", "/de/")]
    got = {r.page_id: r.rule for r in U.filter_urls(spark, pages, rules).collect() if r.page_id is not None}
    assert got[4] == "/es/" and got[9] == "com/de/"
    assert {r.verdict for r in U.filter_urls(spark, pages, rules).collect() if r.page_id == 9} == {"allow"}


def test_empty_table_and_quoted_paths(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(spark, empty, URL_RULES).count() == 0
    odd = spark.createDataFrame([(1, "http://a.b/x+(y)/z"), (2, "http://axb/x+(y)/z")], "page_id long, url string")
    assert [r.rule for r in U.filter_urls(spark, odd, [U.Rule("block", "a.b", "/x+(y)/")]).orderBy("page_id").collect()] == ["a.b/x+(y)/", None]


def test_no_python_in_the_plan(spark, pages):
    plan = U.filter_urls(spark, pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
