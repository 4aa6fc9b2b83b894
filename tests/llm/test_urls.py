import pytest

from reviewlab.llm import urls


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://x.net/", "x.net", "/", "net/", "block"),
        ("https://x.net", "x.net", "", None, "allow"),
        ("https://net/a", "net", "/a", "net/", "block"),
        ("https://example.com/de/x#y", "example.com", "/de/x", "example.com/de/", "block"),
        ("https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        ("ftp://q.org?/fr/", "q.org", "", None, "allow"),
        ("a\nb://ÄQ.org/fr/://z", "Äq.org", "/fr/://z", "org/fr/", "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    row = urls.judge_urls(pages, labels).first()
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_templates(spark):
    pages, labels = [], []
    for i in range(60):
        kind = "spam" if i % 2 else "news"
        pages.append((i, f"https://h.com/{kind}/{i}/title-{i}.html"))
        if i < 40:
            labels.append((i, kind == "spam"))
    pages += [(100, "https://h.com/a"), (100, "https://h.com/a"), (None, None)]
    found = urls.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels + [(None, True), (1, None)], "page_id long, bad boolean"),
    ).collect()
    assert len(found) == 63
    by_id = {r["page_id"]: r for r in found}
    assert by_id[59]["template"] == "/spam/*/*" and by_id[59]["verdict"] == "block"
    assert by_id[58]["template"] == "/news/*/*" and by_id[58]["verdict"] == "allow"
    assert by_id[100]["template"] == "/*"


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, host string, row int")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    assert urls.judge_urls(pages, labels).count() == 0


def judged(spark, pages, labels):
    found = urls.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "page_id long, bad boolean"),
    ).collect()
    return {r["page_id"]: r for r in found}


def test_a_bad_section_is_found_on_a_host_of_any_size(spark):
    pages = [(i, f"https://h.com/{'spam' if i < 20 else f'part{chr(97 + i % 26)}'}/{i}") for i in range(2000)]
    found = judged(spark, pages, [(i, i < 20) for i in range(0, 2000, 2)])
    assert found[1]["template"] == "/spam/*" and found[1]["verdict"] == "block"
    assert found[21]["template"] == "/*/*" and found[21]["verdict"] == "allow"


def test_branches_below_deep_paths(spark):
    above = "/".join("abcdefghij")
    pages = [(i, f"https://h.com/{above}/{'spam' if i % 2 else 'news'}/x/{i}") for i in range(40)]
    pages += [(100, f"https://h.com/{above}"), (101, "https://h.com"), (102, f"https://h.com/{above}/q")]
    found = judged(spark, pages, [(i, i % 2 == 1) for i in range(30)])
    assert found[39]["template"] == "/*" * 10 + "/spam/*/*" and found[39]["verdict"] == "block"
    assert found[38]["template"] == "/*" * 10 + "/news/*/*" and found[38]["verdict"] == "allow"
    assert found[100]["template"] == "/*" * 10 and found[101]["template"] == ""
    assert found[102]["template"] == "/*" * 11
