"""Queries of whole-table positions, moments, stored tables, documents, links, files, table functions and rules."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import names
from ..operators import analytics, extract, harvest, moments, ordering, rulebook, tablefunctions
from ..sources import buckets, catalog, documents, files, io
from .base import query

c = F.col


def _folder(t, name: str) -> str:
    return f"{io.scratch_dir(t._spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT l_shipdate, l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate NULLS LAST, l_orderkey, l_linenumber) - 1 AS row_index FROM lineitem")
def row_index_whole(t):
    """Every line's position by date and key, without a task that sees all of them."""
    lines = t.lineitem.select("l_shipdate", "l_orderkey", "l_linenumber")
    return ordering.global_index(lines, c("l_shipdate").asc_nulls_last(), c("l_orderkey"), c("l_linenumber"))


@query("SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber) - 1 AS row_index FROM lineitem")
def row_index_hot_keys(t):
    """Positions within three keys that share all rows."""
    lines = t.lineitem.select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber")
    return ordering.index_in_key(lines, ["l_returnflag"], c("l_shipdate").desc_nulls_last(), c("l_orderkey"), c("l_linenumber"))


@query("SELECT o_orderkey, CAST(i % 7 AS INTEGER) AS shard, i // 7 AS shard_row FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) - 1 AS i FROM orders)")
def dealt_shards(t):
    """Shards by position."""
    return ordering.deal(t.orders.select("o_orderkey", "o_orderdate"), 7, c("o_orderdate").desc_nulls_last(), c("o_orderkey")).drop("o_orderdate")


@query("""WITH n AS (SELECT count(*) AS n FROM orders), s AS (SELECT i % 5 AS shard, count(*) AS want, count(*) FILTER (WHERE i % 5 <> 1 OR i // 5 <> 3) + CASE WHEN i % 5 = 2 THEN 1 ELSE 0 END AS rows FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY i % 5)
SELECT CAST(shard AS INTEGER) AS shard, 'row_count' AS rule, rows AS found, want AS wanted FROM s WHERE rows <> want
UNION ALL SELECT CAST(shard AS INTEGER), 'row_order', want, rows FROM s WHERE shard IN (1, 2)""")
def shard_agreement(t):
    """Shards of which one lacks a row and one has a row twice."""
    orders = t.orders.select("o_orderkey")
    shards = ordering.deal(orders, 5, c("o_orderkey"))
    twice = shards.where("shard = 2 and shard_row = 0")
    broken = shards.where("not (shard = 1 and shard_row = 3)").unionAll(twice)
    return ordering.shard_findings(broken, orders.count(), 5)


@query("SELECT event_id, ts FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, greatest(1, (SELECT count(*) FROM events) // 50) AS step FROM events) WHERE i % step = 0")
def axis_points_whole(t):
    """W11 over a whole table."""
    return ordering.every_nth(t.events.select("event_id", "ts"), 50, c("ts"), c("event_id"))


def _vector_metrics(t, some: str = "true"):
    """Of each vector its 64 components, their squares, their products with the next one and where they
    are positive: 256 metrics with gaps, an entity-year a vector."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = t.embeddings.where(some).select(c("vec_id").cast("string").alias("entity"), (c("vec_id") % 40 + 1980).cast("int").alias("year"), x.alias("x"))
    kinds = F.transform("x", lambda v, i: F.array(F.struct(F.format_string("x%02d", i).alias("m"), v.alias("v")), F.struct(F.format_string("square%02d", i).alias("m"), (v * v).alias("v")),
        F.struct(F.format_string("product%02d", i).alias("m"), (v * F.get("x", (i + 1) % 64)).alias("v")), F.struct(F.format_string("positive%02d", i).alias("m"), F.when(v > 0, v).alias("v"))))
    return rows.select("entity", "year", F.explode(F.flatten(kinds)).alias("p")).select("entity", "year", c("p.m").alias("metric"), c("p.v").alias("value"))


_CELLS = """WITH x AS (SELECT vec_id, vec_id % 40 + 1980 AS year, i - 1 AS i, CAST(embedding[i] AS DOUBLE) AS v, CAST(embedding[i % 64 + 1] AS DOUBLE) AS w FROM embeddings, range(1, 65) r(i)),
m AS (SELECT vec_id, year, printf('x%02d', i) AS metric, v FROM x UNION ALL SELECT vec_id, year, printf('square%02d', i), v * v FROM x UNION ALL SELECT vec_id, year, printf('product%02d', i), v * w FROM x UNION ALL SELECT vec_id, year, printf('positive%02d', i), v FROM x WHERE v > 0)"""
_PAIRS = """SELECT a.metric AS metric_a, b.metric AS metric_b, regexp_extract(a.metric, '^[a-z]+') AS source_a, regexp_extract(b.metric, '^[a-z]+') AS source_b, round(corr(a.v, b.v), 6) AS correlation, count(*) AS overlap_records,
CAST(min(a.year) AS INTEGER) AS year_min, CAST(max(a.year) AS INTEGER) AS year_max, 'pearson_pairwise_entity_year' AS method FROM m a JOIN m b ON a.vec_id = b.vec_id AND a.metric < b.metric GROUP BY 1, 2 HAVING count(*) >= 2 AND min(a.v) < max(a.v) AND min(b.v) < max(b.v)"""


def _with_sources(t, table, found):
    named = found.select("metric").distinct().select("metric", F.regexp_extract("metric", "^[a-z]+", 0).alias("source_id"))
    return moments.correlations(table, sources=named)


@query(f"{_CELLS} {_PAIRS}")
def correlation_many(t):
    """256 metrics, each two of them, without a row for a pair before the last step."""
    long = _vector_metrics(t)
    return _with_sources(t, moments.moments(moments.cells(long), blocks=4), long)


@query(f"{_CELLS.replace('m AS (', 'every AS (')}, m AS (SELECT * FROM every WHERE metric LIKE 'x%' OR metric LIKE 'positive%') {_PAIRS}")
def correlation_update(t):
    """Moments of earlier years are stored; those of later ones are added to what is read back."""
    stored, some = _folder(t, "moments"), c("metric").startswith("x") | c("metric").startswith("positive")
    early, late = (_vector_metrics(t, f"vec_id % 40 {op} 30").where(some) for op in ("<", ">="))
    moments.moments(moments.cells(early), blocks=2).write.parquet(stored)
    old = t._spark.read.schema(moments.SCHEMA).parquet(stored)
    return _with_sources(t, moments.merged([old, moments.moments(moments.cells(late), blocks=2)]), early.unionAll(late))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id DESC) AS rn FROM events WHERE event_id % 3 <> 0) WHERE rn = 1")
def bucketed_upsert(t):
    """Two loads put into a table of hash buckets, the second of them twice, and read back."""
    e, path = t.events.select("user_id", "event_id", "event_type", "value"), _folder(t, "upserts")
    for load in (1, 2, 2):
        buckets.upsert(t._spark, path, e.where(c("event_id") % 3 == load), ["user_id"], c("event_id").desc(), buckets=16)
    return buckets.read(t._spark, path, "user_id bigint, event_id bigint, event_type string, value double")


@query("SELECT CAST(c_custkey AS VARCHAR) AS source_id, c_name AS title, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS theme, CAST(length(c_name) AS BIGINT) AS row_count, (SELECT count(*) FROM customer) AS entries, '2026-01-01T00:00:00Z' AS generated_at FROM customer")
def catalog_document(t):
    """A catalog that many tasks write and a manifest publishes at once, read back and verified."""
    path = _folder(t, "catalog")
    entries = t.customer.select(c("c_custkey").cast("string").alias("source_id"), c("c_name").alias("title"), F.when(c("c_custkey") % 4 != 0, c("c_mktsegment")).alias("theme"), F.length("c_name").cast("bigint").alias("row_count"))
    documents.write(entries.limit(1), path, generated_at="2025-01-01T00:00:00Z")  # replaced as a whole
    documents.write(entries, path, generated_at="2026-01-01T00:00:00Z")
    head = documents.manifest(t._spark, path)
    rows = documents.read(t._spark, path, "source_id string, title string, theme string, row_count bigint", verify=True)
    return rows.withColumns({"entries": F.lit(head["row_count"]).cast("bigint"), "generated_at": F.lit(head["generated_at"])})


@query("""WITH l AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS flag, l_quantity FROM lineitem)
SELECT 'lines' AS source_id, count(*) AS row_count, round(1 - (count(*) FILTER (WHERE l_orderkey IS NULL) + count(*) FILTER (WHERE flag IS NULL) + count(*) FILTER (WHERE l_quantity IS NULL)) / (3.0 * count(*)), 3) AS completeness, 'flag' AS name, count(*) FILTER (WHERE flag IS NULL) AS nulls, min(flag) AS min, max(flag) AS max FROM l
UNION ALL SELECT 'lines', count(*), round(1 - (count(*) FILTER (WHERE l_orderkey IS NULL) + count(*) FILTER (WHERE flag IS NULL) + count(*) FILTER (WHERE l_quantity IS NULL)) / (3.0 * count(*)), 3), 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL), CAST(min(l_orderkey) AS VARCHAR), CAST(max(l_orderkey) AS VARCHAR) FROM l""")
def observed_manifest(t):
    """A manifest with column statistics, counted while the table is written."""
    lines = t.lineitem.select("l_orderkey", F.when(c("l_linenumber") % 2 == 0, c("l_returnflag")).alias("flag"), "l_quantity")
    row = catalog.written(lines, _folder(t, "lines"), catalog.Source("lines"), "ok", stats=True)
    return row.select("source_id", "row_count", "completeness", F.explode("stats").alias("s")).select("source_id", "row_count", "completeness", "s.*").where("name <> 'l_quantity'")


@query("SELECT source AS theme, count(*) AS n_sources, CASE WHEN max_by(doc_id % 3, doc_id) = 0 THEN 'restricted' ELSE 'covered' END AS status FROM documents WHERE source IS NOT NULL GROUP BY 1")
def gap_report_last(t):
    """The last listed source of a theme decides."""
    listed = t.documents.select(c("source").alias("theme"), (c("doc_id") % 3 != 0).alias("open"), "doc_id")
    return analytics.gap_report(t.documents.where("source is not null").select(c("source").alias("theme")).distinct(), listed, seq="doc_id")


#: References as pages hold them, and what RFC 3986 makes of each for a base with the path /a/b/c.
_FORMS = (
    ("x.pdf", "/a/b/x.pdf"), ("./x.pdf", "/a/b/x.pdf"), ("../x.pdf", "/a/x.pdf"), ("../../../../x", "/x"), ("/r/./s/../t", "/r/t"), ("?y=1", "/a/b/c?y=1"),
    ("#s", "/a/b/c?q=0#s"), ("", "/a/b/c?q=0"), (".", "/a/b/"), ("..", "/a/"), ("x/../y;z=1/./w?u=/../v#/../f", "/a/b/y;z=1/w?u=/../v#/../f"), ("...", "/a/b/..."), ("x//../y", "/a/b/x/y"),
)


@query("WITH f AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') AS site FROM pages) SELECT page_id, CAST(i AS INTEGER) AS i, site || want AS url FROM f, (VALUES " + ", ".join(f"({i}, '{w}')" for i, (_, w) in enumerate(_FORMS)) + ") v(i, want)")
def resolved_forms(t):
    """Every form of a reference against every page's site."""
    base = F.concat(F.regexp_extract("url", "^https?://[^/?#]+", 0), F.lit("/a/b/c?q=0#f"))
    forms = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("ref")) for i, (r, _) in enumerate(_FORMS)])
    return t.pages.select("page_id", base.alias("base"), F.explode(forms).alias("x")).select("page_id", "x.i", names.resolved(c("base"), c("x.ref")).alias("url"))


@query(
    r"""WITH f AS (SELECT page_id, url, unnest(l) AS ref, generate_subscripts(l, 1) - 1 AS i FROM (SELECT page_id, url, list_distinct(l) AS d, list_filter(l, lambda x, j: list_position(l, x) = j) AS l FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"''\s>]+)', 1) AS l FROM pages))),
g AS (SELECT page_id, i, regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)', 1) AS s, lower(regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)', 2)) AS h, ref, regexp_replace(regexp_replace(ref, '/{2,}', '/', 'g'), '/+$', '') AS p FROM f)
SELECT page_id, s || '://' || h || CASE WHEN p = '' THEN '/' ELSE p END AS url, CAST(min(i) AS INTEGER) AS pos FROM g GROUP BY 1, 2"""
)
def page_targets(t):
    """Where the links of every page lead."""
    return extract.resolved_links(t.pages, "page_id", "html", "url")


_CODEC = "'b=1+2&A%2fB=x%20y&b=%7E*&a=%26%3D&%C3%A9=' || page_id || '&ref=q&UTM%5Fid=3&c&c=%zz'"


@query(f"""WITH q AS (SELECT page_id, unnest(string_split({_CODEC}, '&')) AS item, generate_subscripts(string_split({_CODEC}, '&'), 1) AS i FROM pages),
d AS (SELECT page_id, i, url_decode(replace(split_part(item, '=', 1), '+', ' ')) AS k, CASE WHEN contains(item, '=') THEN CASE WHEN item = 'c=%zz' THEN '%zz' ELSE url_decode(replace(split_part(item, '=', 2), '+', ' ')) END ELSE '' END AS v FROM q)
SELECT page_id, 'https://h.org/p?' || string_agg(replace(url_encode(k), '%20', '+') || '=' || replace(url_encode(v), '%20', '+'), '&' ORDER BY encode(k), i) AS url FROM d WHERE lower(k) NOT IN ('ref') AND NOT starts_with(lower(k), 'utm_') GROUP BY 1""")
def query_codec(t):
    """a query string is decoded, sorted by decoded key, and encoded again."""
    items = F.concat(F.lit("b=1+2&A%2fB=x%20y&b=%7E*&a=%26%3D&%C3%A9="), c("page_id").cast("string"), F.lit("&ref=q&UTM%5Fid=3&c&c=%zz"))
    return t.pages.select("page_id", names.normal_url(F.concat(F.lit("HTTPS://H.org//p/?"), items, F.lit("#f"))).alias("url"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name || ' é' AS name, CASE WHEN s_suppkey % 3 <> 2 THEN CAST(s_nationkey AS VARCHAR) END AS nation, CASE WHEN s_suppkey % 3 = 2 THEN 'x; \"' || s_suppkey || '\"' END AS note FROM supplier")
def mixed_text_tables(t):
    """Files of three encodings, two separators and different columns in one read."""
    path = _folder(t, "texts")
    key, name = c("s_suppkey").cast("string").alias("Key"), F.concat("s_name", F.lit(" é")).alias("Name ")
    third = lambda i: t.supplier.where(c("s_suppkey") % 3 == i)
    third(0).select(key, name, c("s_nationkey").alias("Nation")).write.option("header", True).option("encoding", "UTF-8").csv(f"{path}/a")
    third(1).select(c("s_nationkey").alias("nation"), key, name).write.option("header", True).option("encoding", "ISO-8859-1").option("sep", "\t").csv(f"{path}/b")
    note = F.concat(F.lit('x; "'), c("s_suppkey").cast("string"), F.lit('"')).alias("note")
    third(2).select(name, note, key).write.option("header", True).option("encoding", "UTF-16").option("escape", '"').csv(f"{path}/c")
    return files.text_tables(t._spark, f"{path}/*/*.csv").select("key", "name", "nation", "note")


def _measured(text: str) -> list[dict]:
    """Words by their number of letters, up to three; a text that begins with E is an error after its first row."""
    counts: dict[int, int] = {}
    for w in text.split(" "):
        counts[min(len(w), 3)] = counts.get(min(len(w), 3), 0) + 1
    for i, n in enumerate(sorted(counts.items())):
        if i == 1 and text.startswith("E"):
            raise ValueError("begins with E")
        yield {"size": n[0], "n": n[1]}


@query("""WITH w AS (SELECT doc_id, starts_with(coalesce(text,''), 'E') AS e, least(length(unnest(string_split(coalesce(text,''), ' '))), 3) AS size FROM documents),
k AS (SELECT doc_id, e, size, count(*) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY size) AS i, count(*) OVER (PARTITION BY doc_id) AS kinds FROM w GROUP BY 1, 2, 3)
SELECT doc_id, CAST(size AS INTEGER) AS size, n, CAST(NULL AS VARCHAR) AS error FROM k WHERE NOT e OR i = 1 UNION ALL SELECT doc_id, NULL, NULL, 'ValueError: begins with E' FROM k WHERE e AND i = 1 AND kinds > 1""")
def table_function(t):
    """A parser called from SQL for each document, its errors as rows."""
    tablefunctions.register(t._spark, "tidewell_measured", _measured, "size int, n bigint")
    return t._spark.sql("SELECT d.doc_id, m.size, m.n, m.error FROM {d} d, LATERAL tidewell_measured(d.text) m", d=t.documents)


def _turns(rows: list[dict]) -> list[dict]:
    """Who speaks first and last, and the turns of each speaker, in order of their first turn."""
    said: dict[str, int] = {}
    for r in rows:
        said[r["role"]] = said.get(r["role"], 0) + 1
    return [{"role": role, "n": n, "opens": role == rows[0]["role"], "ends": role == rows[-1]["role"]} for role, n in said.items()]


@query("""SELECT conv_id, role, count(*) AS n, role = (SELECT min_by(x.role, x.turn) FROM conversations x WHERE x.conv_id = c.conv_id) AS opens, role = (SELECT max_by(x.role, x.turn) FROM conversations x WHERE x.conv_id = c.conv_id) AS ends, CAST(NULL AS VARCHAR) AS error FROM conversations c GROUP BY 1, 2""")
def grouped_table_function(t):
    """A parser of whole conversations, which asks for its partitioning and order itself."""
    tablefunctions.register_grouped(t._spark, "tidewell_turns", _turns, "role string, n bigint, opens boolean, ends boolean", "conv_id", "turn")
    return t._spark.sql("SELECT * FROM tidewell_turns(TABLE(SELECT conv_id, turn, role FROM {c}))", c=t.conversations)


#: A snapshot of pairs: of each nation its suppliers and their balance, some rows missing, double, or with another date.
_PAIR_ROWS = """WITH n AS (SELECT n_name AS entity, n_nationkey AS k, count(s_suppkey) AS c, sum(s_acctbal) AS b FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2),
p AS (SELECT CASE WHEN k = 5 THEN 'nowhere' ELSE entity END AS entity, 'count' AS metric, CAST(c AS DOUBLE) + CASE WHEN k % 7 = 1 THEN 0.5 ELSE 0 END AS value, '2026-01-01' AS as_of, k FROM n WHERE k <> 9
UNION ALL SELECT CASE WHEN k = 5 THEN 'nowhere' ELSE entity END, 'length', CASE WHEN k % 5 = 2 THEN NULL ELSE CAST(coalesce(b, 0) AS DOUBLE) END, CASE WHEN k = 3 THEN '2025-01-01' ELSE '2026-01-01' END, k FROM n WHERE k <> 9 AND k <> 11
UNION ALL SELECT entity, 'count', 1.0, '', k FROM n WHERE k = 12),
w AS (SELECT p.entity, max(CASE WHEN metric = 'count' THEN value END) AS c, max(CASE WHEN metric = 'length' THEN value END) AS l, count(*) FILTER (WHERE metric = 'count') AS nc, count(*) FILTER (WHERE metric = 'length') AS nl FROM p GROUP BY 1),
x AS (SELECT 'pair_rows' AS rule_id, count(*) AS n_bad, min(entity || '::' || metric) AS first FROM (SELECT entity, metric FROM p GROUP BY 1, 2 HAVING count(*) <> 1)
UNION ALL SELECT 'expected_missing', count(*), min(n_name) FROM nation WHERE n_name NOT IN (SELECT entity FROM p)
UNION ALL SELECT 'unexpected', count(*), min(entity) FROM w WHERE entity NOT IN (SELECT n_name FROM nation)
UNION ALL SELECT 'coverage', count(*), min(entity) FROM w WHERE nc = 0 OR nl = 0
UNION ALL SELECT 'single_as_of', CASE WHEN count(DISTINCT nullif(as_of, '')) <> 1 THEN 1 ELSE 0 END, NULL FROM p
UNION ALL SELECT 'paired_values', count(*), min(entity) FROM w WHERE c IS NULL OR l IS NULL
UNION ALL SELECT 'positive', count(*), min(entity) FROM w WHERE c <= 0 OR l <= 0
UNION ALL SELECT 'whole_count', count(*), min(entity) FROM w WHERE abs(c - round(c)) > 0.001
UNION ALL SELECT 'count_cap', count(*), min(entity) FROM w WHERE c > 150
UNION ALL SELECT 'length_cap', count(*), min(entity) FROM w WHERE l > 25000
UNION ALL SELECT 'ratio', count(*), min(entity) FROM w WHERE c > 0 AND l > 0 AND NOT (l / greatest(c, 1.0) BETWEEN 5 AND 5000))
SELECT rule_id, CAST(n_bad AS BIGINT) AS n_bad, first FROM x"""


@query(_PAIR_ROWS)
def pair_rules(t):
    """The whole rule set of pairs, read from a table of rules, over suppliers and nations."""
    per = t.nation.join(t.supplier, c("s_nationkey") == c("n_nationkey"), "left").groupBy(c("n_name").alias("entity"), c("n_nationkey").alias("k")).agg(F.count("s_suppkey").alias("c"), F.sum("s_acctbal").alias("b"))
    of = lambda metric, value, as_of, when: F.when(when, F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"), as_of.alias("as_of")))
    k, now = c("k"), F.lit("2026-01-01")
    entries = F.array_compact(F.array(
        of("count", c("c") + F.when(k % 7 == 1, 0.5).otherwise(0.0), now, k != 9),
        of("length", F.when(k % 5 != 2, F.coalesce("b", F.lit(0.0))), F.when(k == 3, "2025-01-01").otherwise(now), ~k.isin(9, 11)),
        of("count", F.lit(1.0), F.lit(""), k == 12),
    ))
    snapshot = per.select(F.when(k == 5, "nowhere").otherwise(c("entity")).alias("entity"), F.explode(entries).alias("x")).select("entity", "x.*")
    rules = rulebook.load(rulebook.table_of(t._spark, rulebook.pair_rules("count", "length")))
    both = rulebook.with_references(snapshot, {"expected": t.nation.select(c("n_name").alias("entity"))}, "entity")
    return rulebook.check(both, rules).select("rule_id", "n_bad", "first")


@query(r"""WITH r AS (SELECT page_id % 25 AS seed_id, page_id // 25 // 2 AS page_no, page_id // 25 % 2 AS record_no, page_id % 4 AS kind, page_id AS id FROM pages WHERE page_id % 7 <> 3),
f AS (SELECT seed_id, page_no FROM r GROUP BY 1, 2 HAVING count(*) >= 2),
l AS (SELECT n_nationkey AS seed_id, least(2, (SELECT min(k) FROM range(0, 4) q(k) WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.seed_id = n_nationkey AND f.page_no = k))) AS last FROM nation),
a AS (SELECT r.*, CASE kind WHEN 0 THEN 'Annual Report 2019-20' WHEN 1 THEN 'Tender notice 2021' WHEN 2 THEN 'Report of the year' ELSE '' END AS title FROM r JOIN l ON l.seed_id = r.seed_id AND page_no <= last),
b AS (SELECT a.*, n_name AS seed_title, n_nationkey % 2 = 0 AS even FROM a JOIN nation ON n_nationkey = seed_id),
u AS (SELECT seed_id, page_no, record_no, 0 AS pos, CASE WHEN title = '' THEN seed_title ELSE title END AS title, CASE WHEN kind = 3 THEN 'https://other.net/annual-reports/' || id || '.pdf' ELSE 'https://docs.example.org/annual-reports/' || id % 60 || '.pdf' END AS url, kind, even FROM b
UNION ALL SELECT seed_id, page_no, record_no, 1, CASE WHEN title = '' THEN seed_title ELSE title END, 'https://docs.example.org/plain/' || id || '.html', kind, even FROM b),
c AS (SELECT *, CASE kind WHEN 0 THEN 0.85 WHEN 1 THEN 0.4 ELSE 0.65 END AS score FROM u WHERE pos = 0 AND kind <> 3 AND (even OR kind <> 0)),
e AS (SELECT seed_id, page_no, record_no, pos, title, url, 'endpoint' AS hint, CAST(score AS DOUBLE) AS score FROM c
UNION ALL SELECT n_nationkey, 0, 0, y, n_name || ' ' || printf('%d-%02d', y, (y + 1) % 100), 'https://files.example.org/' || n_nationkey || '/' || printf('%d-%02d', y, (y + 1) % 100) || '.pdf', 'financial_year_pattern', NULL FROM nation, range(2018, 2021) q(y) WHERE n_nationkey NOT IN (SELECT seed_id FROM c))
SELECT seed_id, title, url, hint, score FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seed_id, page_no, record_no, pos) AS rn FROM e) WHERE rn = 1""")
def harvested(t):
    """Candidates of 25 seeds: pages until one isn't full, terms, allowed hosts, scores, addresses by fiscal year where nothing is found."""
    i, n = c("page_id"), c("n_nationkey")
    kind = (i % 4 + 1).cast("int")
    title = F.element_at(F.array(*map(F.lit, ("Annual Report 2019-20", "Tender notice 2021", "Report of the year", ""))), kind)
    main = F.when(kind == 4, F.concat(F.lit("https://other.net/annual-reports/"), i.cast("string"), F.lit(".pdf"))).otherwise(F.concat(F.lit("https://docs.example.org//annual-reports/"), (i % 60).cast("string"), F.lit(".pdf")))
    payload = F.to_json(F.struct(main.alias("file_url"), F.concat(F.lit("see https://docs.example.org/plain/"), i.cast("string"), F.lit(".html")).alias("note")))
    records = t.pages.where(i % 7 != 3).select((i % 25).cast("int").alias("seed_id"), F.floor(i / 50).cast("int").alias("page_no"), (F.floor(i / 25) % 2).cast("int").alias("record_no"), title.alias("title"), payload.alias("payload"))
    terms = F.when(n % 2 == 0, F.array(F.lit("ANNUAL"))).otherwise(F.array(F.lit("tender"), F.lit("Of the Year")))
    seeds = t.nation.select(n.cast("int").alias("seed_id"), n.alias("seq"), c("n_name").alias("title"), terms.alias("terms"), F.lit(3).alias("pages"), F.lit(2).alias("page_size"), F.lit("example.org").alias("suffix"), F.lit(2018).alias("first_year"), F.lit(2020).alias("last_year"), F.concat(F.lit("https://files.example.org/"), n.cast("string"), F.lit("/{year}.pdf")).alias("template"))
    return harvest.candidates(records, seeds).withColumn("seed_id", c("seed_id").cast("long"))


@query(r"""WITH RECURSIVE o AS (SELECT o_orderkey AS doc_id, l_linenumber AS n, l_quantity AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber <= 7),
d AS (SELECT doc_id, n, max(q) AS q FROM o GROUP BY 1, 2),
k AS (SELECT doc_id, (n - 1) // 3 AS page_no, n AS line_no, CASE WHEN doc_id % 3 = 0 AND n < 4 THEN 'plain words ' || n WHEN n % 3 = 1 THEN n || '. Bridges built   ' || CAST(q AS INTEGER) WHEN n % 3 = 2 THEN 'Cost of part: Rs. ' || CAST(q AS INTEGER) || ' crore' ELSE 'TOTAL of all' END AS line FROM d),
x AS (SELECT *, CASE WHEN line LIKE '%. Bridges%' THEN 'numbered' WHEN line LIKE 'Cost%' THEN 'labelled' END AS kind, line NOT LIKE 'TOTAL%' AS is_text FROM k),
p AS (SELECT doc_id, page_no, count(kind) AS n_kv, count(*) FILTER (WHERE is_text) AS n_text, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS i FROM x WHERE kind IS NOT NULL OR is_text GROUP BY 1, 2),
f AS (SELECT doc_id, i, page_no, n_kv, 0 AS begins, CASE WHEN n_kv > 0 THEN n_kv ELSE least(n_text, 5) END AS taken FROM p WHERE i = 1 UNION ALL
SELECT p.doc_id, p.i, p.page_no, p.n_kv, f.begins + f.taken, CASE WHEN p.n_kv > 0 THEN p.n_kv ELSE least(p.n_text, greatest(1, 5 - f.begins - f.taken)) END FROM f JOIN p ON p.doc_id = f.doc_id AND p.i = f.i + 1),
y AS (SELECT x.*, f.begins, f.taken, f.n_kv, row_number() OVER (PARTITION BY x.doc_id, x.page_no ORDER BY line_no) - 1 AS j FROM x JOIN f ON f.doc_id = x.doc_id AND f.page_no = x.page_no WHERE CASE WHEN n_kv > 0 THEN kind IS NOT NULL ELSE is_text END)
SELECT doc_id, CAST(page_no AS INTEGER) AS page_no, begins + j AS row_no, printf('p%04d:', page_no) || CASE WHEN n_kv > 0 THEN 'kv' ELSE 'text' END AS table_id, CASE WHEN n_kv = 0 THEN 'text_line' WHEN kind = 'numbered' THEN 'Bridges built' ELSE 'Cost of part' END AS metric_name,
CASE WHEN n_kv > 0 THEN CAST(regexp_extract(line, '(\d+)( crore)?$', 1) AS DOUBLE) END AS value, CAST(CASE WHEN n_kv = 0 THEN 0.35 WHEN kind = 'numbered' THEN 0.84 ELSE 0.78 END AS DOUBLE) AS confidence, CASE WHEN n_kv > 0 THEN 'medium' ELSE 'low' END AS quality FROM y WHERE j < taken""")
def page_rows(t):
    """rows of pages with table ids, confidences and running numbers; an order is a document, three of its lines a page."""
    n = harvest.tasks_for(t.lineitem)
    lines = t.orders.repartition(n, "o_orderkey").join(t.lineitem.repartition(n, "l_orderkey"), c("l_orderkey") == c("o_orderkey")).where("l_linenumber <= 7").groupBy(c("o_orderkey").alias("doc_id"), c("l_linenumber").alias("n")).agg(F.max("l_quantity").cast("int").cast("string").alias("q"))
    n = c("n")
    line = (
        F.when((c("doc_id") % 3 == 0) & (n < 4), F.concat(F.lit(" plain words "), n.cast("string"))).when(n % 3 == 1, F.concat(n.cast("string"), F.lit(". Bridges built   "), "q"))
        .when(n % 3 == 2, F.concat(F.lit("Cost of part: Rs. "), "q", F.lit(" crore"))).otherwise("TOTAL of all")
    )
    out = harvest.page_rows(lines.select("doc_id", F.floor((n - 1) / 3).cast("int").alias("page_no"), n.alias("line_no"), line.alias("line")))
    return out.select("doc_id", "page_no", "row_no", "table_id", "metric_name", "value", "confidence", "quality")


@query("SELECT page_id, page_id % 5 AS doc_index, CAST(2000 + page_id % 7 AS INTEGER) AS year, url, row_number() OVER (ORDER BY page_id % 5, 2000 + page_id % 7, url, page_id) - 1 AS position FROM pages")
def ordered_results(t):
    """Results of a parallel run in the order of document, year and address."""
    rows = t.pages.select("page_id", (c("page_id") % 5).alias("doc_index"), (c("page_id") % 7 + 2000).cast("int").alias("year"), "url")
    return ordering.global_index(rows, c("doc_index"), c("year"), c("url"), c("page_id"), name="position")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upserts(t):
    """A stream in several batches, later events first, kept in a bucketed table: the last event of each user."""
    from ..streaming.events import upsert_buckets

    out = _folder(t, "stream")
    e = t.events.select("user_id", "event_id", "event_type", "value")
    e.repartitionByRange(4, c("event_id").desc()).write.parquet(f"{out}/in")
    stream = t._spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{out}/in")
    upsert_buckets(stream, f"{out}/rows", f"{out}/checkpoint", ["user_id"], c("event_id").desc()).awaitTermination()
    return buckets.read(t._spark, f"{out}/rows", "user_id bigint, event_id bigint, event_type string, value double")
