"""Candidates of several seeds, and rows of pages, against literal cases."""

from tidewell.operators import harvest

RECORDS = "seed_id int, page_no int, record_no int, title string, payload string"
SEEDS = "seed_id int, seq int, title string, terms array<string>, pages int, page_size int, suffix string, first_year int, last_year int, template string"


def test_pages_that_are_read(spark):
    seeds = spark.createDataFrame([(i, i, "t", ["a"], 3, 2, "h.org", 1, 2, "") for i in range(5)], SEEDS)
    full = lambda seed, page, n: [(seed, page, i, "", "") for i in range(n)]
    rows = full(0, 0, 2) + full(0, 1, 1) + full(0, 2, 2) + full(1, 1, 2) + full(2, 0, 2) + full(2, 1, 2) + full(2, 2, 2) + full(2, 3, 2) + full(3, 0, 1)
    got = harvest.read_pages(spark.createDataFrame(rows, RECORDS), seeds).groupBy("seed_id", "page_no").count().collect()
    assert sorted((r.seed_id, r.page_no, r["count"]) for r in got) == [(0, 0, 2), (0, 1, 1), (2, 0, 2), (2, 1, 2), (2, 2, 2), (3, 0, 1)]


def test_candidates(spark):
    seeds = spark.createDataFrame([(1, 2, "One", ["Annual"], 2, 9, "h.org", 2019, 2020, "https://h.org/{year}.pdf"), (2, 1, "Two", ["annual"], 2, 9, "H.org", None, None, ""), (3, 3, "Three", [], 1, 9, "h.org", 2020, 2019, "x"), (4, 4, "Four", ["zzz"], 1, 9, "h.org", 1999, 2000, "https://other.org/{year}.pdf")], SEEDS)
    page = '{"url": "https://www.h.org/annual-report/1.pdf", "more": ["https://h.org/x/2.PDF?utm_a=1 https://evil.net/annual-report/3.pdf http://10.0.0.1/annual-report.pdf https://h.org/annual-report.html"]}'
    rows = [(2, 0, 0, "Annual Report 2019-20", page), (1, 0, 0, None, page), (2, 0, 1, "Other annual things", "https://h.org/nothing.pdf"), (4, 0, 0, "Annual Report", page)]
    got = {(r.seed_id, r.title, r.url, r.hint, r.score) for r in harvest.candidates(spark.createDataFrame(rows, RECORDS), seeds).collect()}
    assert got == {(2, "Annual Report 2019-20", "https://www.h.org/annual-report/1.pdf", "endpoint", 0.85), (2, "Annual Report 2019-20", "https://h.org/x/2.PDF", "endpoint", 0.85)}
    nothing = harvest.candidates(spark.createDataFrame(rows[3:], RECORDS), seeds).collect()
    assert {(r.seed_id, r.title, r.url, r.hint, r.score) for r in nothing} == {(1, "One 2019-20", "https://h.org/2019-20.pdf", "financial_year_pattern", None), (1, "One 2020-21", "https://h.org/2020-21.pdf", "financial_year_pattern", None)}


def test_page_rows(spark):
    lines = [(1, 0, 0, "Chairman's words"), (1, 0, 1, None), (1, 0, 2, "  "), (1, 0, 3, "second"), (1, 1, 0, "3. Bridges   1,234"), (1, 1, 1, "Cost: Rs. 5 crore"), (1, 1, 2, "words only"), (1, 1, 3, "Label: ,"), (1, 2, 0, "TOTAL of it"), (1, 2, 1, "x" * 261), (1, 3, 0, "after"), (1, 3, 1, "and after"), (None, 0, 0, "a null document"), (2, 0, 0, "123"), (1, 2, 2, "Page 12")]
    df = spark.createDataFrame(lines, "doc_id int, page_no int, line_no int, line string").repartition(5)
    got = {(r.doc_id, r.row_no): (r.page_no, r.col_no, r.table_id, r.record_type, r.metric_name, r.value, r.value_text, r.line_type, r.confidence, r.quality) for r in harvest.page_rows(df).collect()}
    text = lambda page, line: (page, 0, f"p{page:04d}:text", "toc_row", "text_line", None, line, "text_fallback", 0.35, "low")
    assert got == {
        (1, 0): text(0, "Chairman's words"), (1, 1): text(0, "second"), (1, 2): (1, 1, "p0001:kv", "kv_line", "Bridges", 1234.0, "1,234", "numbered", 0.84, "medium"),
        (1, 3): (1, 2, "p0001:kv", "kv_line", "Cost", 5.0, "Rs. 5 crore", "labelled", 0.78, "medium"), (1, 4): (1, 2, "p0001:kv", "kv_line", "Label", None, ",", "labelled", 0.55, "low"),
        (1, 5): text(3, "after"), (None, 0): text(0, "a null document"),
    }
    assert harvest.page_rows(df.limit(0)).count() == 0
