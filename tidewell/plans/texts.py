"""Queries of lines, rows from text, URLs, documents' relevance, dates and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, names
from ..operators import analytics, extract, reshape
from ..sources import catalog, io
from .base import query, r

c = F.col
_N = r"-?\d+(?:,\d{3})*(?:\.\d+)?"


def _strip(x: str) -> str:
    return rf"regexp_replace(coalesce({x},''),'^\s+|\s+$','','g')"


def _noise(x: str) -> str:
    t = rf"regexp_replace({_strip(x)},'\s{{2,}}',' ','g')"
    titles = ", ".join(f"'{w}'" for w in extract.RUNNING_TITLES)
    return (
        rf"(length({t})<4 OR regexp_matches({t},'(?i)^(page\s+\d+|\d+|https?://\S+|www\.\S+)$') OR lower({t}) IN ({titles}) OR NOT regexp_matches({t},'[\p{{L}}\p{{N}}]')"
        rf" OR (length({t})-length(replace({t},'|',''))>=6 AND NOT regexp_matches({t},'\p{{L}}')))"
    )


#: Lines of documents, and of parts in the forms that the rules look for.
_LINES = """(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents UNION ALL
SELECT -1 - p_partkey, CASE p_partkey % 6 WHEN 0 THEN '  ' || p_partkey || '. ' || p_name || '   ' || p_size || ',500.5' WHEN 1 THEN 'Page  ' || p_partkey WHEN 2 THEN 'Page ' || p_partkey || ' summary' WHEN 3 THEN 'Annual  Report' WHEN 4 THEN '|1|2|3|4|5|' || p_size || '|' ELSE p_name || ' – Rs. ' || p_size || ',000 crore' END FROM part)"""


def _lines(t):
    k, size = c("p_partkey").cast("string"), c("p_size").cast("string")
    forms = [F.concat(F.lit("  "), k, F.lit(". "), "p_name", F.lit("   "), size, F.lit(",500.5")), F.concat(F.lit("Page  "), k), F.concat(F.lit("Page "), k, F.lit(" summary")), F.lit("Annual  Report"), F.concat(F.lit("|1|2|3|4|5|"), size, F.lit("|")), F.concat("p_name", F.lit(" – Rs. "), size, F.lit(",000 crore"))]
    made = t.part.select((-1 - c("p_partkey")).alias("doc_id"), F.element_at(F.array(*forms), (c("p_partkey") % 6 + 1).cast("int")).alias("line"))
    return reshape.lines(t.documents, "doc_id", "text").select("doc_id", "line").unionAll(made)


@query(f"SELECT doc_id, CAST(sum(CASE WHEN {_noise('line')} THEN 1 ELSE 0 END) AS BIGINT) AS n_noise FROM {_LINES} GROUP BY 1")
def noise_filter(t):
    """P22."""
    return _lines(t).groupBy("doc_id").agg(F.sum(extract.is_noise(c("line")).cast("bigint")).alias("n_noise"))


_TABULAR = rf"(len(regexp_extract_all(x,'{_N}'))>=2 OR (regexp_matches(x,'\s{{2,}}') AND len(string_split_regex(x,'\s+'))>=3) OR (contains(x,'|') AND len(list_filter(string_split(x,'|'), lambda p: regexp_replace(p,'^\s+|\s+$','','g')<>''))>=3))"


@query(
    rf"""WITH d AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - p_partkey, 'Head' || chr(10) || p_name || '   ' || p_size || '  x' || chr(10) || '1 ' || p_size || chr(10) || chr(10) || CASE WHEN p_size % 2 = 0 THEN 'a | b | ' || p_size ELSE 'a | b |' END FROM part)
SELECT doc_id, len(list_filter(list_filter(list_transform(string_split_regex(coalesce(text,''),'\r\n|\n|\r'), lambda x: {_strip("x")}), lambda x: x<>'')[1:80], lambda x: {_TABULAR})) >= 3 AS tabular FROM d"""
)
def table_signal(t):
    """P23."""
    size = c("p_size").cast("string")
    last = F.when(c("p_size") % 2 == 0, F.concat(F.lit("a | b | "), size)).otherwise("a | b |")
    made = t.part.select((-1 - c("p_partkey")).alias("doc_id"), F.concat(F.lit("Head\n"), "p_name", F.lit("   "), size, F.lit("  x\n1 "), size, F.lit("\n\n"), last).alias("text"))
    return t.documents.select("doc_id", "text").unionAll(made).select("doc_id", extract.has_table_signal(c("text")).alias("tabular"))


_KV = rf"""WITH l AS (SELECT doc_id, {_strip("line")} AS t, {_noise("line")} AS noise FROM {_LINES}),
m AS (SELECT doc_id, t, nullif(regexp_extract(t,'{extract.NUMBERED}',2),'') AS numbered, regexp_extract(t,'{extract.NUMBERED}',3) AS nv, regexp_extract(t,'{extract.LABELLED}',1) AS lab, regexp_extract(t,'{extract.LABELLED}',2) AS lv FROM l WHERE NOT noise),
k AS (SELECT doc_id, CASE WHEN numbered IS NOT NULL THEN 'numbered' ELSE 'labelled' END AS kind, CASE WHEN numbered IS NOT NULL THEN {_strip("numbered")} ELSE regexp_replace({_strip("lab")},'\s{{2,}}',' ','g') END AS label, CASE WHEN numbered IS NOT NULL THEN nv ELSE {_strip("lv")} END AS value_text FROM m)
SELECT doc_id, kind, substr(label,1,220) AS label, value_text, TRY_CAST(regexp_replace(regexp_extract(value_text,'(-?\s*[\d,]+(?:\.\d+)?)',1),'[,\s]','','g') AS DOUBLE) AS value FROM k WHERE label<>''"""


@query(_KV)
def kv_extract(t):
    """F37, F15."""
    return extract.key_values(_lines(t), "line").drop("line")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'table_row' ELSE p_name END AS name, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name || ' | ' END || p_brand || ' | ' || p_size || ',000' AS text, CAST(regexp_extract(p_brand,'\\d+') AS DOUBLE) AS value, CAST(CASE WHEN p_size % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS col_no FROM part""")
def table_rows(t):
    """cells of a table's row."""
    first = F.when(c("p_size") % 3 == 0, "").otherwise(c("p_name"))
    cells = F.array(first, "p_brand", F.lit(None).cast("string"), F.concat(c("p_size").cast("string"), F.lit(",000")))
    return t.part.select("p_partkey", extract.table_row(cells).alias("x")).select("p_partkey", "x.*")


@query("SELECT n_nationkey, 'State of x' AS label, CAST(n_regionkey AS DOUBLE) AS first, CAST(n_nationkey * 1000 + 234.5 AS DOUBLE) AS second FROM nation WHERE n_regionkey <> 3")
def appendix_rows(t):
    """Numbered rows: a label, other numbers, then the two that count; totals go."""
    label = F.when(c("n_regionkey") == 3, "Total of x").otherwise("State of  x ")
    chunk = F.concat((c("n_nationkey") + 1).cast("string"), F.lit(". ").substr(2, 1), label, F.lit(" 7 NH-"), c("n_regionkey").cast("string"), F.lit(" "), F.format_number(c("n_nationkey") * 1000 + 234.5, 1))
    return t.nation.select("n_nationkey", extract.two_last_numbers(chunk).alias("x")).where("x.label is not null").select("n_nationkey", "x.*")


@query("SELECT n_nationkey, n_name AS label, CAST(n_nationkey * 1000 AS DOUBLE) AS value FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey > 0")
def permit_rows(t):
    """lines of a marked form."""
    amount = F.format_number(c("n_nationkey") * 1000, 0)
    line = F.when(c("n_nationkey") % 2 == 0, F.concat(F.lit(" AG,  "), "n_name", F.lit("  "), amount)).otherwise(F.concat(F.lit("Total "), amount))
    return t.nation.where("n_nationkey > 0").select("n_nationkey", extract.marked_row(line).alias("x")).where("x.value is not null").select("n_nationkey", "x.*")


_MESSY = "replace(replace(url,'https://','HTTPS://WWW.'),'/en/','//EN//') || CASE WHEN contains(url,'#') THEN '' WHEN contains(url,'?') THEN '&b=1&UTM_x=1&a=2&b=0&gclid=z&x&source=q' ELSE '//' END"


def _messy(url):
    tail = F.when(url.contains("#"), "").when(url.contains("?"), "&b=1&UTM_x=1&a=2&b=0&gclid=z&x&source=q").otherwise("//")
    return F.concat(F.replace(F.replace(url, F.lit("https://"), F.lit("HTTPS://WWW.")), F.lit("/en/"), F.lit("//EN//")), tail)


_U = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


@query(
    rf"""WITH u AS (SELECT page_id, {_MESSY} AS m FROM pages), p AS (SELECT page_id, lower(regexp_extract(m,'{_U}',1)) AS scheme, lower(regexp_extract(m,'{_U}',2)) AS host, regexp_replace(regexp_replace(regexp_extract(m,'{_U}',3),'/{{2,}}','/','g'),'/+$','') AS path, regexp_extract(m,'{_U}',4) AS q FROM u),
i AS (SELECT page_id, unnest(string_split(q,'&')) AS item, generate_subscripts(string_split(q,'&'),1) AS nth FROM p),
k AS (SELECT page_id, string_agg(CASE WHEN contains(item,'=') THEN item ELSE item || '=' END, '&' ORDER BY split_part(item,'=',1), nth) AS query FROM i WHERE item<>'' AND NOT starts_with(lower(item),'utm_') AND lower(split_part(item,'=',1)) NOT IN ('fbclid','gclid','mc_cid','mc_eid','ref','source') GROUP BY 1)
SELECT p.page_id, scheme || '://' || host || CASE WHEN path='' THEN '/' ELSE path END || CASE WHEN query IS NULL THEN '' ELSE '?' || query END AS url FROM p LEFT JOIN k ON k.page_id=p.page_id"""
)
def url_normalise(t):
    """F17."""
    return t.pages.select("page_id", names.normal_url(_messy(c("url"))).alias("url"))


@query("""SELECT page_id, page_id % 10 IN (0, 7, 8, 9) AS open, page_id % 10 IN (7, 8) AS listed FROM pages""")
def url_safety(t):
    """P25: local, closed, other schemes and credentials aren't public; with a list, hosts by name and suffixes with what is below them."""
    k = c("page_id").cast("string")
    forms = [F.regexp_replace("url", r"//", "//x."), F.concat(F.lit("http://LOCALHOST/"), k), F.concat(F.lit("https://10.0.3."), (c("page_id") % 200).cast("string")), F.concat(F.lit("ftp://a.org/"), k), F.concat(F.lit("https://me:pw@a.org/"), k), F.concat(F.lit("http://169.254.1.1/"), k), F.concat(F.lit("http://[::1]/"), k), F.concat(F.lit("https://Data.Org:8443/"), k), F.concat(F.lit("https://deep.below.net/"), k), F.concat(F.lit("https://sub.data.org/"), k)]
    url = F.element_at(F.array(*forms), (c("page_id") % 10 + 1).cast("int"))
    return t.pages.select("page_id", names.is_public_url(url).alias("open"), names.is_public_url(url, ["data.org"], ["below.net"]).alias("listed"))


@query(r"""SELECT page_id, list_sort(list_distinct(['sub.example.org','b.example.com', regexp_extract(url,'^https?://([^/?#]+)',1)])) AS hosts FROM pages""")
def allowed_hosts(t):
    """P26."""
    return t.pages.select("page_id", names.allowed_hosts(F.array("url"), F.array(F.lit("Sub.Example.org"), F.lit(None).cast("string")), F.array(F.lit("https://B.example.com:8080/x"))).alias("hosts"))


_HREFS = r"""f AS (SELECT page_id, unnest(l) AS url, generate_subscripts(l,1) AS i FROM (SELECT page_id, regexp_extract_all(html,'(?i)href\s*=\s*["'']([^"''\s>]+)',1) AS l FROM pages)), g AS (SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS INTEGER) AS pos FROM f GROUP BY 1,2)"""


@query(f"WITH {_HREFS} SELECT page_id, pos, url FROM g")
def href_discovery(t):
    """S14, S19, U07."""
    return extract.links(t.pages, "page_id", "html")


@query(
    rf"""WITH {_HREFS}, m AS (SELECT page_id, pos, replace(url,'/t','/system/files/t') AS u FROM g), a AS (SELECT page_id, pos, CASE WHEN regexp_matches(u,'(?i)^https?://') THEN u WHEN starts_with(u,'/') THEN 'https://www.example.org' || u ELSE 'https://www.example.org/' || u END AS u FROM m)
SELECT page_id, pos, u AS url FROM a UNION ALL SELECT page_id, pos, 'https://' || substr(u,13) FROM a WHERE starts_with(u,'https://www.') UNION ALL SELECT page_id, pos, replace(u,'/system/files/','/sites/default/files/') FROM a WHERE contains(u,'/system/files/') AND NOT contains(u,'/sites/default/files/')"""
)
def link_variants(t):
    """The URLs under which a link may be served."""
    moved = F.replace("url", F.lit("/t"), F.lit("/system/files/t"))
    return extract.links(t.pages, "page_id", "html").select("page_id", "pos", F.explode(extract.link_variants(names.file_url(moved), "https://www.example.org")).alias("url"))


@query("SELECT page_id, 0 AS pos, url FROM pages UNION ALL SELECT page_id, 1, 'https://b.org/' || page_id || '.pdf' FROM pages")
def nested_urls(t):
    """URLs anywhere in nested columns."""
    nested = t.pages.select("page_id", F.array(F.struct(c("url").alias("a"), F.lit(3).alias("n"))).alias("x"), F.concat(F.lit("see https://b.org/"), c("page_id").cast("string"), F.lit(".pdf and "), "url").alias("y"))
    return extract.text_urls(nested, "page_id", "x", "y")


@query("SELECT o_custkey, printf('%d-%02d', y, (y + 1) % 100) AS label, 'https://a.org/' || o_custkey || '/' || printf('%d-%02d', y, (y + 1) % 100) || '.pdf' AS url FROM (SELECT o_custkey, unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders GROUP BY 1)")
def year_candidates(t):
    """For each customer's first to last year."""
    per = t.orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"))
    template = F.concat(F.lit("https://a.org/"), c("o_custkey").cast("string"), F.lit("/{year}.pdf"))
    return extract.year_candidates(per, c("first"), c("last"), template).select("o_custkey", "label", "url")


_TITLE = "CASE doc_id % 5 WHEN 0 THEN 'Annual Report 2019-20' WHEN 1 THEN 'Tender notice 2021' WHEN 2 THEN 'Report, annual, 1998 - 99' WHEN 3 THEN 'Green Cover Index annual_report' ELSE '' END"
_TERMS = lambda words: " OR ".join(f"contains(b,'{w}')" for w in words)


@query(
    rf"""WITH x AS (SELECT doc_id, coalesce(text,'') AS text, lower(concat_ws(' ', nullif({_TITLE},''), 'https://a.org/' || CASE WHEN doc_id % 3 = 0 THEN 'annual-reports/' ELSE '' END || doc_id, nullif(substr(trim(coalesce(text,'')),1,2000),''))) AS b FROM documents),
s AS (SELECT doc_id, CASE WHEN {_TERMS(analytics.REPORT_TERMS)} THEN 0.45 WHEN contains(b,'annual') AND contains(b,'report') THEN 0.3 ELSE 0 END + CASE WHEN {_TERMS(("annual-reports", "annual_report", "annual-report"))} THEN 0.2 ELSE 0 END
+ CASE WHEN regexp_matches(b,'\b20\d{{2}}[-/]\d{{2}}\b') OR regexp_matches(b,'\b(19|20)\d{{2}}\s*-\s*(?:19|20)?\d{{2}}\b') THEN 0.2 WHEN regexp_matches(b,'\b(19|20)\d{{2}}\b') THEN 0.1 ELSE 0 END
+ CASE WHEN text<>'' AND ({_TERMS(analytics.BODY_TERMS)}) THEN 0.15 ELSE 0 END - CASE WHEN {_TERMS(analytics.OTHER_TERMS)} THEN 0.35 ELSE 0 END - CASE WHEN contains(b,'green cover index') THEN 0.25 ELSE 0 END AS v FROM x)
SELECT doc_id, CAST(round(greatest(0, least(1, v)), 3) AS DOUBLE) AS score FROM s WHERE round(v, 3) >= 0.4"""
)
def doc_relevance(t):
    """Candidates that reach the threshold."""
    titles = F.element_at(F.array(*map(F.lit, ("Annual Report 2019-20", "Tender notice 2021", "Report, annual, 1998 - 99", "Green Cover Index annual_report", ""))), (c("doc_id") % 5 + 1).cast("int"))
    url = F.concat(F.lit("https://a.org/"), F.when(c("doc_id") % 3 == 0, "annual-reports/").otherwise(""), c("doc_id").cast("string"))
    return t.documents.select("doc_id", analytics.relevance(titles, url, c("text")).alias("score")).where("score >= 0.4")


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 5 WHEN 0 THEN CASE WHEN year(o_orderdate) >= 2000 THEN o_orderdate ELSE date_trunc('month', o_orderdate) END WHEN 1 THEN CASE WHEN year(o_orderdate) >= 2000 THEN o_orderdate ELSE date_trunc('year', o_orderdate) END
WHEN 2 THEN date_trunc('month', o_orderdate) WHEN 3 THEN date_trunc('year', o_orderdate) END AS DATE) AS day FROM orders""")
def date_hints(t):
    """the date that a text names."""
    day = lambda form: F.concat(F.lit("as of "), F.date_format("o_orderdate", form), F.lit(" (final)"))
    text = F.element_at(F.array(day("yyyy-MM-dd"), day("dd/MM/yyyy"), day("yyyy-MM"), day("yyyy"), F.lit("no date 12")), (c("o_orderkey") % 5 + 1).cast("int"))
    return t.orders.select("o_orderkey", dates.date_hint(F.lit(None).cast("string"), text).alias("day"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN strftime(o_orderdate,'%Y') || '-' || printf('%02d', (year(o_orderdate) + 1) % 100) ELSE strftime(o_orderdate,'%Y') END AS fiscal, strftime(o_orderdate,'%Y') || '-' || printf('%02d', (year(o_orderdate) + 1) % 100) AS period, CAST(year(o_orderdate) AS INTEGER) AS starts, 'unknown' AS none FROM orders""")
def fiscal_labels(t):
    """F12, F13, F06."""
    y = F.year("o_orderdate")
    label = F.concat(y.cast("string"), F.lit("-"), F.format_string("%02d", (y + 1) % 100))
    text = F.concat(F.lit("FY "), label, F.lit(" (rev.)"))
    return t.orders.select("o_orderkey", dates.fiscal_label(text).alias("fiscal"), dates.period_label(text).alias("period"), dates.fiscal_start(label).alias("starts"), dates.period_label(F.lit(" ")).alias("none"))


@query("SELECT event_id, strftime(ts,'%Y-%m-%d') AS day, '' AS none FROM events")
def date_only(t):
    """F09."""
    return t.events.select("event_id", dates.date_only(c("ts").cast("string")).alias("day"), dates.date_only(F.lit("soon")).alias("none"))


@query("SELECT greatest(max(CAST(o_orderdate AS DATE)), max(CAST(strftime(o_orderdate,'%Y') || '-12-31' AS DATE))) AS latest FROM orders")
def latest_date(t):
    """The latest date of a table's date columns, which are found by name."""
    return dates.latest_date(t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), F.year("o_orderdate").alias("observation_year"), F.lit("2999-01-01").alias("remark")))


@query("SELECT max(strftime(ts,'%Y-%m-%d')) AS latest FROM events WHERE event_type IN ('view','click')")
def latest_retrieved(t):
    """A25."""
    return dates.latest_retrieved(t.events.select(c("event_type").alias("source_id"), c("ts").cast("string").alias("retrieved_at")), ["view", "click"])


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'https://a.org/list' WHEN p_size % 4 = 1 THEN 'https://a.org/r/' || p_partkey || '?f=json' END AS url,
CASE WHEN p_size % 4 >= 2 THEN 'missing_or_unresolved_url' WHEN p_type='PROMO' THEN 'auto_fetch_skipped_auth=captcha' WHEN p_size % 8 >= 4 THEN 'auto_fetch_disabled_in_inventory' END AS status FROM part""")
def scan_ladder(t):
    """templates resolved, and why a source isn't fetched."""
    kind = c("p_size") % 4
    template = F.when(kind == 0, "https://a.org/list").otherwise("https://a.org/r/{resource_id}?f=json")
    resource = F.when(kind == 1, c("p_partkey").cast("string")).when(kind == 2, F.concat(F.lit("PLACEHOLDER_"), c("p_partkey").cast("string")))
    url = names.from_template(template, resource)
    status = catalog.scan_status(url, names.is_public_url(url), F.when(c("p_type") == "PROMO", "captcha"), c("p_size") % 8 < 4)
    return t.part.select("p_partkey", url.alias("url"), status.alias("status"))


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'json' WHEN 1 THEN 'sheet' WHEN 2 THEN 'tsv' WHEN 3 THEN 'json' ELSE 'csv' END AS kind FROM pages")
def payload_kinds(t):
    """S15."""
    ending = F.element_at(F.array(*map(F.lit, ("/a", "/a.XLSX?x=1", "/a.tsv#y", "/a.json", "/a.html"))), (c("page_id") % 5 + 1).cast("int"))
    mime = F.when(c("page_id") % 5 == 0, "application/JSON; charset=utf-8").otherwise("text/plain")
    return t.pages.select("page_id", io.payload_kind(mime, F.concat(F.lit("https://a.org"), ending)).alias("kind"))


@query("SELECT CAST(p_partkey AS BIGINT) AS k, CAST(i AS INTEGER) AS a FROM part, range(3) r(i) WHERE p_size % 4 < 3")
def api_records(t):
    """Rows of payloads with their records under different names."""
    items = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.struct(c("p_partkey").alias("k"), i.alias("a")))
    text = F.to_json(items)
    payload = F.when(c("p_size") % 4 == 0, text).when(c("p_size") % 4 == 1, F.concat(F.lit('{"records":'), text, F.lit("}"))).when(c("p_size") % 4 == 2, F.concat(F.lit('{"total":3,"data":'), text, F.lit("}"))).otherwise("{}")
    return t.part.select(F.explode(extract.json_records(payload, "k:bigint,a:int")).alias("x")).select("x.*")


@query("""SELECT event_id, '{"k":"' || json_extract_string(props,'$.k') || '","parser":"p' || event_id % 3 || '"}' AS trace FROM events""")
def parser_trace(t):
    """a JSON object with a key added, keys sorted."""
    return t.events.select("event_id", extract.merged_json(c("props"), parser=F.concat(F.lit("p"), (c("event_id") % 3).cast("string"))).alias("trace"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN true ELSE false END AS pdf FROM documents")
def pdf_payload(t):
    """by a payload's first bytes."""
    head = F.when(c("doc_id") % 7 == 0, "%PDF-1.7 ").otherwise("<html>%PDF-")
    return t.documents.select("doc_id", extract.is_pdf(F.encode(F.concat(head, F.substring("text", 1, 20)), "UTF-8")).alias("pdf"))


def _measure(text: str) -> list[dict]:
    if text.startswith(("A", "T")):
        raise ValueError(text[:1])
    return [{"n": len(text)}]


@query("SELECT doc_id, CASE WHEN substr(text,1,1) IN ('A','T') THEN NULL ELSE CAST(length(text) AS BIGINT) END AS n, CASE WHEN substr(text,1,1) IN ('A','T') THEN 'ValueError: ' || substr(text,1,1) END AS error FROM documents")
def per_document(t):
    """A parser's rows, or the row of its error."""
    return extract.per_document(t.documents, "doc_id", "text", _measure, "n bigint")


@query("""SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: NOT (starts_with(x,'Th') OR starts_with(x,'E')))) AS BIGINT) AS n FROM documents""")
def prefix_lines(t):
    """P24."""
    return t.documents.select("doc_id", F.size(extract.without_prefixes(F.split("text", "\n"), ["Th", "E"])).cast("bigint").alias("n"))


@query(f"SELECT doc_id, CAST(len(n) AS BIGINT) AS n, round(coalesce(list_sum(list_transform(n, lambda x: TRY_CAST(replace(x,',','') AS DOUBLE))),0),2) AS total FROM (SELECT doc_id, regexp_extract_all(coalesce(text,''),'{_N}') AS n FROM documents)")
def all_numbers(t):
    """T14."""
    found = extract.numbers(c("text"))
    return t.documents.select("doc_id", F.size(found).cast("bigint").alias("n"), r(F.aggregate(found, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), 2).alias("total"))
