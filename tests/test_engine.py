"""Operators on literal frames, and every registered query against its SQL on the smallest tables."""

import datetime
import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewell.functions import coerce, dates, names
from tidewell.operators import analytics, extract, filters, relational, reshape, validate
from tidewell.plans import registry
from tidewell.sources import catalog, io

SF = "/root/testdata/sf0.001"
c = F.col


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(c("x"))).collect()]


def test_headers():
    assert [names.header(x) for x in ("Sl. No.", "Length (in KM)", "Progress (%)", "State/UT", "a\nb")] == ["sl._no.", "length_in_km", "progress_pct", "state/ut", "a_b"]
    assert names.resolve(["State/UT", "x"], ["state_ut"]) == "State/UT"
    assert names.resolve_tokens(["total length km"], ["length", "KM"]) == "total length km"
    assert names.first_present(["a", "b"], ["z", "b"]) == "b"


def test_numbers(spark):
    assert column(spark, ["1,200", "NA", "", " 12 ", "12d", None], coerce.number) == [1200.0, None, None, 12.0, None, None]
    assert column(spark, ["NA", " x ", "", None], coerce.missing) == [None, " x ", None, None]
    assert column(spark, [1.5, None, math.nan, math.inf], coerce.num0, "double") == [1.5, 0, 0, 0]
    assert column(spark, [5.0, None, -1.0, 300.0], lambda x: coerce.clamp(x, 0, 100), "double") == [5, 0, 0, 100]
    assert one(spark.createDataFrame([(0.0, None, 3.0)], "a double, b double, c double"), coerce.first_truthy(c("a"), c("b"), c("c"))) == [(3.0,)]
    assert column(spark, ["Rs. 1,200", "12.5 crore"], coerce.amount) == [(1200.0, None), (12.5, "crore")]
    assert column(spark, ["3 bn", "7 Nos.", "8 percent", "2 lakhs", "x"], coerce.amount) == [(3.0, "billion"), (7.0, "count"), (8.0, "%"), (2.0, "lakh"), (None, None)]


def test_dates(spark):
    d = datetime.date
    got = column(spark, ["2019-20", "2003-04", "2024", "FY 2019-20", "2024-05-06", "x", None], dates.date_value)
    assert got == [d(2020, 3, 31), d(2003, 4, 1), d(2024, 12, 31), d(2019, 12, 31), d(2024, 5, 6), None, None]
    assert column(spark, ["2019-20", "in 2021", None], dates.fiscal_label) == ["2019-20", "2021", None]
    assert column(spark, ["x 05/06/2021", None], dates.date_hint) == [d(2021, 6, 5), None]


def test_keys_and_urls(spark):
    assert column(spark, ["Jammu  & Kashmir", None], names.spaced_key) == ["jammu kashmir", None]
    assert column(spark, ["Jammu & Kashmir"], names.bare_key) == ["jammukashmir"]
    assert column(spark, [" Orissa "], lambda x: names.mapped(x, {"Orissa": "Odisha"})) == ["Odisha"]
    assert column(spark, ["HTTP://A.com//x//y?b=1&utm_s=2&a=3#f"], names.normal_url) == ["http://a.com/x/y?a=3&b=1"]
    urls = ["https://a.org/x", "http://u:p@a.org", "http://localhost/", "http://10.0.0.1/", "ftp://a.org", "https://evil-a.org", None]
    assert column(spark, urls, lambda x: names.is_public_url(x, ["a.org"])) == [True, False, False, False, False, False, False]


def test_row_choice(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 3, 3), ("b", 2, 4)], "k string, t int, seq int")
    assert sorted(one(relational.latest(df, ["k"], "t", "seq"), "k", "seq")) == [("a", 1), ("b", 3)]
    assert sorted(one(relational.last_wins(df, ["k"], "seq"), "k", "seq")) == [("a", 2), ("b", 4)]
    other = spark.createDataFrame([("a", 9, 1), ("z", 9, 5), ("z", 8, 6)], "k string, t int, seq int")
    assert sorted(one(relational.fill_gaps(df, other, ["k"], "seq"), "k", "seq"))[-1] == ("z", 5)
    assert sorted(one(relational.priority_merge([df, other], ["k"]), "k", "seq")) == [("a", 2), ("b", 4), ("z", 5)]
    assert one(relational.overlap(df, other, "k"), "n_a", "n_b", "n_both") == [(2, 2, 1)]
    assert relational.set_difference(df, df, ["k"]).count() == 0
    empty = df.limit(0)
    assert relational.value_share(empty, "k").count() == 0 and relational.overlap(empty, empty, "k").first()["overlap"] == 0


def test_shapes(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 4.0)], "s string, `2003` double, `2004` double")
    assert reshape.year_columns(wide) == ["2003", "2004"]
    long = reshape.to_long(wide, ["s"], ["2003", "2004"])
    back = reshape.to_wide(long, ["s"], "metric", "value", ["2003", "2004"])
    assert sorted(one(back, "s", "2003", "2004")) == [("a", 1.0, None), ("b", 3.0, 4.0)]
    assert one(reshape.canonical(wide, {"s": "string", "n": "int"}).where("s = 'a'"), "s", "n") == [("a", None)]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(["pre", "#a", "b", None, "#c"])], "d int, i int, x string")
    assert sorted(one(reshape.chunks(rows, "d", "i", "x", c("x").startswith("#")), "chunk", "text")) == [(0, "pre"), (1, "#a b "), (2, "#c")]
    assert sorted(one(reshape.between_markers(rows, "d", "i", c("x") == "#a", c("x") == "#c"), "i")) == [(1,), (2,), (3,)]


def test_correlation(spark):
    data = [(e, y, m, v) for e, y in (("a", 1), ("a", 2), ("b", 1)) for m, v in (("x", float(y)), ("y", -2.0 * y), ("k", 1.0))] + [("a", 1, None, 3.0)]
    got = one(analytics.pairwise_correlation(spark.createDataFrame(data, "entity string, year int, metric string, value double")), "metric_a", "metric_b", "correlation", "overlap_records")
    assert got == [("x", "y", -1.0, 3)]


def test_scores(spark):
    df = spark.range(1)
    lit = lambda x: F.lit(x)
    got = one(df.select(analytics.overall(lit(1.0), lit(1.0), lit(0.6), lit(1.0), lit("model")).alias("s")), "s.score", "s.badge")
    assert got == [(0.46, "Low")]  # the stored score of the synthetic panel
    assert one(df, analytics.provenance(F.lit("B"), F.lit(True)) * 0.98)[0][0] == pytest.approx(0.833)
    assert [r[0] for r in spark.createDataFrame([(10,), (400,), (800,), (9999,), (None,)], "d int").select(analytics.recency(c("d"), F.lit("annual"))).collect()] == [1.0, 0.7, 0.4, 0.2, 0.25]
    assert one(analytics.completeness(df.limit(0)), "completeness") == [(0.0,)]
    seed = one(df, analytics.stable_seed(F.lit(2026), F.lit("x"), F.lit(0), F.lit(1)))[0][0]
    assert seed == int(hashlib.sha256(b"2026|x|0|1").hexdigest()[:12], 16)


def test_extract(spark):
    lines = ["ab", "Page 3", "https://x", "----", "|1|2|3|4|5|", "a good line", None, "Page 3 summary of works", "12345", "Contents", "annual  report", "|1|2|3|4|5|a", "1|2|3|4"]
    assert column(spark, lines, extract.is_noise) == [True, True, True, True, True, False, True, False, True, True, True, False, False]
    assert column(spark, ["Total: 1,234.5", "no"], extract.key_value) == [("Total", 1234.5), (None, None)]
    assert column(spark, ["12345.6 and 1,000"], extract.numbers) == [[12345.6, 1000.0]]
    assert column(spark, ['{"data":[{"a":1}]}', '[{"a":2}]', "{}"], lambda x: extract.json_records(x, "a:int")) == [[(1,)], [(2,)], None]
    df = spark.createDataFrame([(1, "a b"), (2, "boom"), (3, None)], "d int, x string")

    def parse(text):
        if text == "boom":
            raise ValueError("bad")
        return [{"w": w} for w in text.split()]

    assert sorted(one(extract.per_document(df, "d", "x", parse, "w string"), "d", "w", "error"), key=str) == [(1, "a", None), (1, "b", None), (2, None, "ValueError: bad")]


def test_validate_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "1,0"), (None, -1.0, "x")], "k string, v double, t string")
    got = dict(one(validate.check(df, [validate.required("k"), validate.non_negative("v"), validate.parses("t")]), "rule_id", "n_bad"))
    assert got == {"k_required": 1, "v_non_negative": 1, "t_numeric": 1}
    with pytest.raises(ValueError):
        validate.gate(spark.createDataFrame([("error",)], "severity string"))
    entries = spark.createDataFrame([("s", 2)], "source_id string, n int")
    once = catalog.upsert(spark.createDataFrame([("s", 1), ("t", 1)], "source_id string, n int"), entries)
    assert sorted(one(once, "source_id", "n")) == sorted(one(catalog.upsert(once, entries), "source_id", "n")) == [("s", 2), ("t", 1)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/s1.csv").write_text("State/UT,Length (in KM)\nA,NA\nB,2\n")
    con = catalog.manual_connector("manual", ("s1", "s2"), str(tmp_path / "in"))
    out = catalog.ingest(spark, [catalog.Source("s1"), catalog.Source("s2"), catalog.Source("s3")], [con], str(tmp_path / "out"), "2026-01-01")
    assert sorted(one(out, "source_id", "status", "row_count")) == [("s1", "manual_ingest", 2), ("s2", "stubbed_manual_gap", 0), ("s3", "not_mapped", 0)]
    assert one(spark.read.parquet(str(tmp_path / "out/s1")).orderBy("state/ut"), "`length_in_km`", "retrieved_at") == [(None, "2026-01-01"), ("2", "2026-01-01")]
    assert io.safe(spark, lambda: spark.read.parquet(str(tmp_path / "none")), "a int").count() == 0


def test_catalog_upsert_query(spark, tmp_path, monkeypatch):
    big = 5_000_000_000
    rows = [("old only", big, "a"), ("new later", 2, "a"), ("new later", 3, "b"), ("old later", big + 2, "a"), ("old later", 1, "b"), ("new only", big + 1, "b")]
    spark.createDataFrame(rows, "user_id string, event_id bigint, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    replaced, upsert = [], catalog.upsert
    monkeypatch.setattr(catalog, "upsert", lambda old, entries, key: replaced.extend(r[0] for r in entries.select(key).collect()) or upsert(old, entries, key))
    got = sorted(one(registry.QUERIES["catalog_upsert"](spark, str(tmp_path)), "user_id", "event_id"))
    assert got == [("new later", 3), ("new only", big + 1), ("old later", big + 2), ("old only", big)]
    assert sorted(replaced) == ["new later", "new only"]


def test_unpivot_has_every_line(spark):
    lines = registry.Tables(spark, SF).lineitem
    got = registry.QUERIES["union_all_unpivot_lines"](spark, SF)
    assert dict(one(got.groupBy("metric").count(), "metric", "count")) == dict.fromkeys(("quantity", "discount", "tax"), lines.count())
    assert one(got.agg(F.count("amount"), F.count("rate")), "*") == [(lines.count(), 2 * lines.count())]


def test_rules_of_lines(spark):
    assert column(spark, ["12. Bridges built   1,234.5", "Cost (2019) - Rs. 1,200 crore", "Length – 12 km", "no value: none", "Page 12"], extract.line_value) == [
        ("numbered", "Bridges built", "1,234.5", 1234.5), ("labelled", "Cost (2019)", "Rs. 1,200 crore", 1200.0), ("labelled", "Length", "12", 12.0), (None,) * 4, (None,) * 4,
    ]
    pages = ["a 1 2\nb 3 4\n\nc  d e", "a 1 2\nb 3 4", "x | y | z\np | q | r\n1 2", None, "plain\ntext\nonly"]
    assert column(spark, pages, extract.has_table_signal) == [True, False, True, False, False]
    assert column(spark, ["3 State of x 12 7 1,234.5", "4 Total 1 2", "5 One 7"], extract.two_last_numbers) == [("State of x", 7.0, 1234.5), (None,) * 3, (None,) * 3]
    assert column(spark, ["AG, Some  State 12,345", "AG, x", "Total 3"], extract.marked_row) == [("Some State", 12345.0), (None, None), (None, None)]
    cells = spark.createDataFrame([(["a  b", None, "1,200", "7"],), ([None, "x 5"],), ([],)], "x array<string>")
    assert [tuple(r[0]) for r in cells.select(extract.table_row(c("x"))).collect()] == [("a b", "a  b | 1,200 | 7", 1200.0, 1), ("table_row", "5", 5.0, 2), (None,) * 4]


def test_rules_of_urls(spark):
    urls = ["//a.org/x", "no url", " HTTPS://A.org ", "http://a.org/p/?ref=1&b=2&source=x&a=1&a=0&igshid=3&c", None]
    assert column(spark, urls, names.normal_url) == ["https://a.org/x", "no url", "https://a.org/", "http://a.org/p?a=1&a=0&b=2&c=&igshid=3", ""]
    hosts = ["https://a.org", "https://x.a.org", "https://b.net", "https://x.b.net", "https://xb.net", "http://100.64.0.1", "http://203.0.113.9", "http://8.8.8.8", "http://[2606:4700::1]/", "http://[fe80::1]/"]
    assert column(spark, hosts, lambda x: names.is_public_url(x, ["a.org"], ["b.net"])) == [True, False, True, True, False, False, False, False, False, False]
    assert column(spark, hosts, names.is_public_url) == [True, True, True, True, True, True, False, True, True, False]


def test_scores_of_rows(spark):
    one_row, lit = spark.range(1), F.lit
    got = one_row.select(analytics.row_confidence(lit("ocr"), lit("ocr"), lit(False), lit(False), lit(True), lit(True), lit(True), True, False).alias("x")).first().x
    assert (got.score, got.flag, got.notes) == (0.34, "low", ["ocr_fallback", "numeric_missing", "ocr_tool_unavailable"])
    got = one_row.select(analytics.overall(lit(0.8496), lit(0.8496), lit(0.8496), lit(0.8496), lit("ok")).alias("x")).first().x
    assert (got.score, got.badge, got.reasons) == (0.85, "Med", [])
    assert one_row.select(analytics.overall(lit(0.1), lit(1.0), lit(1.0), lit(1.0), lit("ok")).alias("x")).first().x.reasons == ["low completeness"]
    assert analytics.LOW_CAVEAT in one_row.select(analytics.overall(lit(0.1), lit(0.5), lit(0.5), lit(1.0), lit("ok")).alias("x")).first().x.reasons
    titles = [("Annual Report of 2019-20", "https://x.org/annual-report/a.pdf"), ("Tender notice 2020", "https://x.org/t"), (None, None)]
    df = spark.createDataFrame(titles, "t string, u string")
    assert [r[0] for r in df.select(analytics.relevance(c("t"), c("u"))).collect()] == [0.85, 0.0, 0.0]


def test_coverage_is_by_equal_names(spark):
    sources = spark.createDataFrame([("s1", "Roads", None, ["State", "mileage"]), ("s2", None, "Age", None), ("s3", "x", "y", ["age"])], "source_id string, title string, dataset string, columns array<string>")
    aliases = spark.createDataFrame([("person", "age"), ("place", "state"), ("place", "S2"), ("none", "zzz")], "entity string, alias string")
    assert dict(one(analytics.coverage(sources, aliases), "entity", "n_sources")) == {"person": 2, "place": 2, "none": 0}
    got = analytics.relation_evidence(sources, aliases, spark.createDataFrame([("person", "place"), ("place", "none")], "from_entity string, to_entity string"))
    assert {r[0]: (r[2], r[3]) for r in got.collect()} == {"person": (1, ["s2"]), "place": (0, [])}


def test_choices(spark):
    df = spark.createDataFrame([("a", i, float(i % 4)) for i in range(13)] + [("b", 0, None), ("b", 1, 2.0)], "k string, i int, x double")
    assert sorted(r.i for r in relational.every_nth(df.where("k = 'a'"), ["k"], 6, c("i")).collect()) == list(range(0, 13, 2))
    assert one(relational.mode(df, ["k"], "x", "i").orderBy("k"), "k", "x", "n") == [("a", 0.0, 4), ("b", None, 1)]
    assert sorted(one(relational.arg_max(df, ["k"], "x", "i"), "k", "i")) == [("a", 3), ("b", 1)]
    assert filters.by_key(df, "k", "All").count() == 15 and filters.by_key(df, "k", " A!").count() == 13 and filters.by_source(df, col="k").count() == 0
    assert validate.exit_code(spark.createDataFrame([("warning",)], "severity string")) == 0
    assert validate.exit_code(spark.createDataFrame([("warning",)], "severity string"), strict=True) == 1
    empty = df.limit(0)
    assert relational.every_nth(empty, ["k"], 6, c("i")).count() == relational.mode(empty, ["k"], "x", "i").count() == 0


PAGES = [f'{{"i": {i}}}' for i in range(23)]


def some_pages(offset, limit):
    return PAGES[offset : offset + limit]


def test_sources(spark, tmp_path, monkeypatch):
    root = tmp_path / "in"
    root.mkdir()
    (root / "s1.csv").write_bytes("Name,Größe\nJosé,1\n".encode("cp1252"))
    (root / "s1_b.csv").write_text("\ufeffname\tsize\nx\t2\n")
    (root / "s2.json").write_text('[{"A B": 1}, {"A B": 2}]')
    (root / "s2_x.pdf").write_bytes(b"%PDF-1.4 x")
    assert io.encoding_of(spark, str(root / "s1.csv")) == "windows-1252"
    assert one(io.csv(spark, str(root / "s1.csv")), "name", "größe") == [("José", "1")]
    assert one(io.csv(spark, str(root / "s1_b.csv")), "name", "size") == [("x", "2")]
    both = io.manual(spark, str(root), "s2")
    assert sorted(one(both, "a_b", "file_name"), key=str) == [(1, None), (2, None), (None, "s2_x.pdf")] and io.manual(spark, str(root), "s9") is None
    out = str(tmp_path / "cat")
    entries = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "source_id string, n int, t string")
    catalog.write_catalog(spark, entries, out, "2026-01-01")
    assert sorted(one(catalog.read_catalog(spark, out), "source_id", "n", "t"), key=str) == [("a", 1, None), ("b", 2, "x")]
    (tmp_path / "bad.json").write_text('{"x": 1}')
    with pytest.raises(ValueError):
        catalog.read_catalog(spark, str(tmp_path / "bad.json"))
    sources = [catalog.Source("a", theme="roads", columns=("x", "y"), extra={"url": "https://a.org"}), catalog.Source("b", official=False)]
    catalog.write_inventory(spark, sources, str(tmp_path / "inv"), "2026-01-01")
    assert catalog.read_inventory(spark, str(tmp_path / "inv")) == sources and catalog.read_inventory(spark, str(tmp_path / "none.json")) == []
    assert catalog.sources_table(spark, sources).count() == 2
    assert io.read_json(spark, str(tmp_path / "none.json"), "a int").count() == 0
    catalog.write_manifests(entries, str(tmp_path / "man"))
    assert (tmp_path / "man" / "source_id=a").is_dir()
    at = io.snapshot(entries, str(tmp_path / "raw"), "20260101_000000")
    assert io.merged(spark, str(tmp_path / "raw")).count() == 2 and at.endswith("raw_20260101_000000")
    sums = io.checksums(spark, str(root))
    assert sums.count() == 4 and validate.checksum_findings(sums, sums).count() == 0
    assert column(spark, ["/old/a", "/older/a"], lambda x: io.rebased(x, "/old", "/new")) == ["/new/a", "/older/a"]
    assert catalog.markdown(entries.orderBy("source_id"), 1).endswith("| a | 1 |  |\n1 further rows")
    spark.dataSource.register(io.PagedSource)
    read = lambda **o: spark.read.format("tidewell_pages").options(fetch="tests.test_engine.some_pages", limit="5", **o).load().count()
    assert read(total="23") == read() == 23
    with pytest.raises(Exception, match="pages"):
        read(total="23", pages="2")


def test_stream_again_and_late(spark, tmp_path):
    from tidewell.streaming.events import current, upsert_stream, windowed

    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    at = lambda day, hour=1: datetime.datetime(2024, 1, day, hour)
    first = [(1, at(1), 1, "a", 1.0), (2, at(1), 2, "a", 2.0)]
    for name, rows in (("f1", first), ("f2", [(3, at(5), 1, "a", 5.0)]), ("f3", [(5, at(6), 3, "a", 1.0)]), ("f4", [(4, at(1, 2), 1, "a", 9.0)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / name))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a second run finds nothing new, and changes nothing
        upsert_stream(spark, stream(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(one(current(spark, str(tmp_path / "out"), ["user_id"], "event_id"), "user_id", "event_id")) == [(1, 4), (2, 2), (3, 5)]
    q = windowed(stream(), "1 day").writeStream.outputMode("append").format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert one(spark.table("late"), "start", "n") == [(at(1, 0), 2)]  # the row that came after the watermark had passed its day isn't counted


def test_stream(spark, tmp_path):
    from tidewell.streaming.events import upsert_stream, windowed

    events = spark.read.parquet(f"{SF}/events.parquet")
    (tmp_path / "in").mkdir()
    events.write.parquet(str(tmp_path / "in/a"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in/a"))
    upsert_stream(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()
    assert windowed(events).agg(F.sum("n")).first()[0] == events.count()


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in registry.TABLES:
        out.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return out


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v if isinstance(v, (int, str, bool, type(None))) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[x]) for x in cols]) for r in df.collect())
    if name in registry.SQL:
        ref = con.sql(registry.SQL[name])
        assert sorted(ref.columns) == cols
        assert got == sorted(repr([plain(r[ref.columns.index(x)]) for x in cols]) for r in ref.fetchall())


def test_entry():
    """Every query of the engine has SQL; names don't clash; the flagship is one of them."""
    import __spark_entry__

    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(registry.SQL) == set(registry.QUERIES) and set(sql) <= set(queries) and registry.FLAGSHIP in queries
