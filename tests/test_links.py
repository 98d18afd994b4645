"""References, query strings, amounts, status factors and gaps against literal cases."""

import pytest
from pyspark.sql import functions as F

from tidewell.functions import coerce, names
from tidewell.operators import analytics, extract

#: RFC 3986, 5.4: references and their targets for the base http://a/b/c/d;p?q.
RFC = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s",
    "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/",
    "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
}


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").coalesce(1).select(f(F.col("x"))).collect()]


def test_references(spark):
    assert column(spark, list(RFC), lambda x: names.resolved(F.lit("http://a/b/c/d;p?q"), x)) == list(RFC.values())
    cases = [("https://b.org/p", "../a.pdf", "https://b.org/a.pdf"), ("https://b.org/p", "//h.org/x", "https://h.org/x"), ("https://b.org", "x", "https://b.org/x"), ("https://b.org?q", "", "https://b.org?q"), ("https://b.org", "?y", "https://b.org?y"), (None, "/x", "/x"), ("/no/scheme", "x", "x"), ("https://b.org/p", None, "https://b.org/p"), ("https://b.org/p", " mailto:a@b.org ", "mailto:a@b.org"), ("https://b.org/a//b/c", "../x", "https://b.org/a//x"), ("https://b.org/p", "https://c.org/../d/./e", "https://c.org/d/e")]
    df = spark.createDataFrame(cases, "base string, ref string, want string")
    assert all(r.got == r.want for r in df.select("want", names.resolved(F.col("base"), F.col("ref")).alias("got")).collect())


def test_resolved_links(spark):
    html = '<base target=x href="/docs/"><a href="a.pdf">1</a><A HREF=\'../a.pdf\'></a><a href="a.pdf#2"></a><a href="mailto:x@y.org"><a href="?p=1&amp;q=2"><a href="https://H.org/Z/">'
    df = spark.createDataFrame([(1, html, "https://h.org/start/page"), (2, None, "https://h.org/x"), (3, '<a href="page"><a href="a b">', "https://h.org/start/page")], "id int, html string, url string")
    got = {(r.id, r.pos, r.url) for r in extract.resolved_links(df, "id", "html", "url").collect()}
    # a link's target ends at white space
    assert got == {(1, 0, "https://h.org/docs/a.pdf"), (1, 1, "https://h.org/a.pdf"), (1, 4, "https://h.org/docs?p=1&q=2"), (1, 5, "https://h.org/Z"), (3, 1, "https://h.org/start/a")}


def test_query_strings(spark):
    cases = {
        "https://h.org/p?b=%2F&a=x+y": "https://h.org/p?a=x+y&b=%2F", "https://h.org/p?a=2&b=1&a=1": "https://h.org/p?a=2&a=1&b=1", "https://h.org/p?z&%61=1": "https://h.org/p?a=1&z=", "https://h.org?x=%zz%": "https://h.org/?x=%25zz%25",
        "https://h.org/?x=a=b&&": "https://h.org/?x=a%3Db", "https://h.org/?UTM_a=1&%75tm_b=2&Ref=3&y=~*": "https://h.org/?y=~%2A", "https://h.org/a%2Fb/?q=é": "https://h.org/a%2Fb?q=%C3%A9", "//h.org/x?b&a": "https://h.org/x?b&a", " no url ": "no url", "": "",
        "https://h.org/?x=%ff": "https://h.org/?x=%EF%BF%BD",
    }
    assert column(spark, [*cases, None], names.normal_url) == [*cases.values(), ""]


def test_amounts(spark):
    got = column(spark, ["Rs. 1,200 of 3 crore", "1,200 crore", "12 (lakh", "5 of 7", "3 km or 4 miles", "crore", None, "1.5 %", "12 nos."], coerce.amount)
    assert [tuple(r) for r in got] == [(3.0, "crore"), (1200.0, "crore"), (12.0, "lakh"), (5.0, None), (3.0, None), (None, "crore"), (None, None), (1.5, "%"), (12.0, "count")]


@pytest.mark.parametrize(("status", "score"), [("OK", 1.0), (" Automated", 0.5), ("Disabled", 0.22 * 0.35 + 0.22 * 0.25 + 0.25 * 0.2 + 0.22 * 0.2), (None, 0.5), ("else", 0.5)])
def test_status_in_any_case(spark, status, score):
    one = F.lit(1.0)
    got = column(spark, [status], lambda s: analytics.overall(one, one, one, one, s)["score"])
    assert abs(got[0] - score) < 6e-4


def test_gaps_by_last_source(spark):
    listed = spark.createDataFrame([("a", True, 1), ("a", False, 2), ("b", False, 1), ("b", True, 5), ("b", None, 3)], "theme string, open boolean, n int")
    need = spark.createDataFrame([("a",), ("b",), ("c",)], "theme string")
    status = lambda seq: {r.theme: r.status for r in analytics.gap_report(need, listed, seq).collect()}
    assert status(None) == {"a": "covered", "b": "covered", "c": "missing"}
    assert status("n") == {"a": "restricted", "b": "covered", "c": "missing"}
