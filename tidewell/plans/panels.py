"""Queries of scores, seeded panels, coverage, rules and the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import analytics, extract, relational, validate
from ..sources import catalog, io
from .base import query, rows

c = F.col


def _half_up(x: str, n: int) -> str:
    """Half-up rounding of a double's decimal digits, as Spark rounds."""
    return f"CAST(round(CAST({x} AS DECIMAL(34,14)),{n}) AS DOUBLE)"


_SEED = "CAST('0x' || substr(sha256('2026|part|' || p_partkey || '|' || segment),1,12) AS BIGINT)"


@query(
    f"""WITH pr AS (SELECT n_name AS state, avg(s_acctbal/100 + 2.4*(s_suppkey%7)) AS prior FROM supplier JOIN nation ON n_nationkey=s_nationkey GROUP BY 1), st AS (SELECT list(state ORDER BY state) AS s, list(prior ORDER BY state) AS p FROM pr), tot AS (SELECT sum(p_retailprice) AS budget FROM part),
s AS (SELECT p_partkey, p_size, p_retailprice, segment, {_SEED} AS h FROM part, range(5) q(segment)),
a AS (SELECT *, coalesce(st.s[h % len(st.s) + 1], 'National Average') AS state, coalesce(st.p[h % len(st.s) + 1], 50) AS prior, ['Plains','Semi-arid','Hilly','Mountain','Coastal','Flood-prone','Urban'][h % 7 + 1] AS terrain, 1 + (h % 100)/120 AS factor, 2021 + (h // 12) % 6 AS year, greatest(p_size, 0.1) AS km, greatest(p_retailprice, 0.1) AS cost FROM s, st, tot),
b AS (SELECT *, greatest(0.0, least(100.0, (prior + h % 120 - 40 + CASE WHEN terrain IN ('Mountain','Hilly') THEN 20 ELSE 0 END)/1.8)) AS safety, {_half_up("70 + (h % 2500)/125", 2)} AS quality, {_half_up("0.5 + (h % 180)/12", 2)} AS access, {_half_up("0.08*cost + 0.06*km + (h % 500)/100", 4)} AS land, {_half_up("0.02*cost + 0.42*km + (h % 200)/50", 4)} AS upkeep FROM a),
d AS (SELECT *, {_half_up("factor*(land + upkeep)", 4)} AS terrain_cost FROM b)
SELECT p_partkey, CAST(segment AS INTEGER) AS segment, printf('P-%04d', p_partkey + 1) AS project_id, printf('P-%04d', p_partkey + 1) || printf('_SEG_%04d', segment + 1) AS segment_id, state, terrain, CAST((segment + h % 12) % 12 + 1 AS INTEGER) AS month, CAST(year AS INTEGER) AS year,
CAST(5 + h % 200 + 10 * (year - 2020) AS BIGINT) AS sea_level_m, round(least(100, p_size % 120 + segment / 5 * 10), 2) AS progress_pct, access AS access_hours, quality AS quality_index, round({_half_up("safety", 3)}, 1) AS safety_risk,
{_half_up(_half_up("0.35*cost + 0.015*segment + (h % 1000)/10", 4) + " + factor", 4)} AS revenue, round({_half_up("land + terrain_cost/2", 4)}, 1) AS land_cost, upkeep AS maintenance_cost, round({_half_up("quality/3 + safety/6 + access - 2", 3)} + 0.0037, 1) AS delay_risk, CAST(18 + (7 * (p_partkey + 1)) % 120 AS INTEGER) AS duration_months, {_half_up("0.75 + (h % 220)/11", 2)} AS distance_hours, round(cost/budget, 6) AS budget_share,
CAST(quality < 60 OR safety > 70 OR access > 10 AS INTEGER) AS risk_flag FROM d"""
)
def seeded_panel(t):
    """The whole panel, with states and their risks from another table."""
    nation = t.nation.select(c("n_nationkey").alias("s_nationkey"), c("n_name").alias("state"))
    accidents = t.supplier.join(nation, "s_nationkey").select("state", (c("s_acctbal") / 100).alias("killed"), (c("s_suppkey") % 7).alias("fatal"))
    budget = t.part.agg(F.sum("p_retailprice")).first()[0]
    base = t.part.select("p_partkey", (c("p_partkey") + 1).alias("no"), "p_size", "p_retailprice", (c("p_size") % 120).alias("done"))
    out = analytics.expand(base, ["p_partkey"], 5, 2026, "part", "p_size", "p_retailprice", "done", "no", budget, analytics.risk_priors(accidents, "state", "killed", "fatal"))
    # figures of which many end in a 5 beyond their last place are compared to fewer places
    out = analytics.with_segment_ids(out, c("no"), "P").withColumns({"land_cost": F.round("land_cost", 1), "delay_risk": F.round(c("delay_risk") + 0.0037, 1), "safety_risk": F.round("safety_risk", 1)})
    return out.select("p_partkey", "segment", "project_id", "segment_id", "state", "terrain", "month", "year", "sea_level_m", "progress_pct", "access_hours", "quality_index", "safety_risk", "revenue", "land_cost", "maintenance_cost", "delay_risk", "duration_months", "distance_hours", "budget_share", "risk_flag")


@query("SELECT o_custkey, count(*) AS projects, CAST(greatest(100, 20000 // count(*)) AS BIGINT) AS each, CAST(greatest(2500, 220000 // count(*)) AS BIGINT) AS usual FROM orders GROUP BY 1")
def segment_rule(t):
    """The number of segments that the target asks for, by the number of projects of each customer."""
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("projects"))
    return per.select("o_custkey", "projects", analytics.segments_of(c("projects"), 100, 5).alias("each"), analytics.segments_of(c("projects"), 0).alias("usual"))


@query("WITH n AS (SELECT greatest(3, 20000 // count(*)) AS each FROM part) SELECT p_partkey, CAST(unnest(range(each)) AS INTEGER) AS segment FROM part, n")
def seeded_target(t):
    """As many segments as the target asks for, found from the number of projects."""
    return analytics.expand(t.part.select("p_partkey"), ["p_partkey"], None, 2026, "part", requested=3, target=20_000).select("p_partkey", "segment")


_AGE = "date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-06-01')"


@query(f"SELECT o_orderkey, CAST(CASE WHEN o_orderstatus='P' THEN 0.25 WHEN {_AGE} <= f THEN 1 WHEN {_AGE} <= 2*f THEN 0.7 WHEN {_AGE} <= 4*f THEN 0.4 ELSE 0.2 END AS DOUBLE) AS recency FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 92 ELSE 365 END AS f FROM orders)")
def recency_bands(t):
    """F23."""
    age = F.when(c("o_orderstatus") != "P", F.datediff(F.lit("2001-06-01").cast("date"), c("o_orderdate")))
    return t.orders.select("o_orderkey", analytics.recency(age, F.when(c("o_orderpriority") == "1-URGENT", "quarterly").otherwise("irregular")).alias("recency"))


@query("SELECT p_partkey, CAST(CASE WHEN g='A' AND o THEN 1 WHEN g='B' AND o THEN 0.85 WHEN g='C' AND NOT o THEN 0.6 WHEN g='C' AND o THEN 0.7 ELSE 0.5 END AS DOUBLE) AS provenance FROM (SELECT p_partkey, p_size % 2 = 0 AS o, ['A','B','C','C','D'][p_size % 5 + 1] AS g FROM part)")
def provenance_grades(t):
    """F24."""
    grade = F.element_at(F.array(F.lit("a"), F.lit("B"), F.lit("c"), F.lit(None).cast("string"), F.lit("D")), (c("p_size") % 5 + 1).cast("int"))
    return t.part.select("p_partkey", analytics.provenance(grade, c("p_size") % 2 == 0).alias("provenance"))


@query("SELECT CAST(greatest(0, 1 - 0.05 - 0.25 * max(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) - 0.25 * max(CASE WHEN c_custkey < 0 THEN 1 ELSE 0 END)) AS DOUBLE) AS consistency FROM customer")
def consistency(t):
    """A column with negatives, one without, and one that isn't there."""
    return analytics.consistency(t.customer, ["c_acctbal", "c_custkey", "absent"])


@query(f"""WITH e AS (SELECT user_id, avg(value)/100 AS a, avg(CASE WHEN event_type='error' THEN 1.0 ELSE 0 END) AS low, avg(CASE WHEN event_type='click' THEN 0.2 ELSE 0 END) AS failed FROM events GROUP BY 1),
s AS (SELECT *, greatest(0.0, least(1.0, a)) - CASE WHEN low>0.15 THEN least(0.25,(low-0.15)*0.6) ELSE 0 END - CASE WHEN failed>0.02 THEN least(0.2,2*failed) ELSE 0 END - CASE WHEN user_id%2=0 THEN 0.08 ELSE 0 END AS v FROM e)
SELECT user_id, {_half_up("greatest(0.0, least(1.0, v))", 3)} AS score, CAST((low>0.15)::INT + (failed>0.02)::INT + (user_id%2=0)::INT + (a<0.7)::INT AS INTEGER) AS n_reasons FROM s""")
def extraction_factors(t):
    """F27."""
    # shares of whole numbers: sums of 0.2 as doubles pass a threshold that the share only meets
    part = lambda kind, tenths: F.count_if(c("event_type") == kind) * tenths / (F.count("*") * 10)
    e = t.events.groupBy("user_id").agg((F.avg("value") / 100).alias("a"), part("error", 10).alias("low"), part("click", 2).alias("failed"))
    x = analytics.extraction_factor(c("a"), c("low"), c("failed"), F.lit(1.0), c("user_id") % 2 == 1)
    return e.select("user_id", x.alias("x")).select("user_id", "x.score", F.size("x.reasons").alias("n_reasons"))


@query(f"""WITH x AS (SELECT p_partkey, 0.78 AS s, least((p_size % 11)/CAST(10.07 AS DOUBLE), CAST(0.78 AS DOUBLE)) AS c, least((p_size % 5)/CAST(4.07 AS DOUBLE), CAST(0.78 AS DOUBLE)) AS r, (p_size % 7)/CAST(6.07 AS DOUBLE) * CAST(0.78 AS DOUBLE) AS p, least((p_size % 3)/CAST(2.07 AS DOUBLE), CAST(0.78 AS DOUBLE)) AS k, (p_size % 13)/CAST(12.07 AS DOUBLE) AS e FROM part),
y AS (SELECT *, CAST(0.3 AS DOUBLE)*c + CAST(0.2 AS DOUBLE)*r + CAST(0.18 AS DOUBLE)*p + CAST(0.17 AS DOUBLE)*k + CAST(0.15 AS DOUBLE)*e AS v FROM x)
SELECT p_partkey, {_half_up("v", 3)} AS score, CASE WHEN v >= 0.85 THEN 'High' WHEN v >= 0.65 THEN 'Med' ELSE 'Low' END AS badge, CAST((p<0.45)::INT + (c<0.6)::INT + (r<0.6)::INT + (k<0.7)::INT + (e<0.65)::INT + (v<0.65)::INT AS INTEGER) AS n_reasons FROM y""")
def overall_scores(t):
    """five parts, capped by the status' factor."""
    part = lambda n: (c("p_size") % n) / (n - 0.93)
    x = analytics.overall(part(11), part(5), part(7), part(3), F.lit("stub_parsed"), part(13))
    return t.part.select("p_partkey", x.alias("x")).select("p_partkey", "x.score", "x.badge", F.size("x.reasons").alias("n_reasons"))


@query("""WITH x AS (SELECT p_partkey, ['table','text','ocr','failed','other'][p_size % 5 + 1] AS m, ['camelot','pdfplumber','ocr','none'][p_size % 4 + 1] AS q, p_size % 3 = 0 AS noise, p_size % 2 = 0 AS num, p_size % 7 > 2 AS url, p_size % 6 = 1 AS traced FROM part),
y AS (SELECT *, round(greatest(0, least(1, CASE m WHEN 'table' THEN 0.86 WHEN 'text' THEN 0.6 WHEN 'ocr' THEN 0.48 WHEN 'failed' THEN 0 ELSE 0.35 END + CASE q WHEN 'camelot' THEN 0.06 WHEN 'pdfplumber' THEN 0.03 ELSE 0 END - CASE WHEN noise THEN 0.18 ELSE 0 END + CASE WHEN num THEN 0.06 ELSE 0 END + CASE WHEN url THEN 0.03 ELSE 0 END + 0.03
 - CASE WHEN m='text' THEN 0.08 ELSE 0 END - CASE WHEN m='ocr' THEN 0.2 ELSE 0 END - CASE WHEN traced THEN 0 ELSE 0.1 END)), 3) AS s FROM x)
SELECT p_partkey, CAST(s AS DOUBLE) AS score, CASE WHEN s<=0 OR m='failed' THEN 'failed' WHEN s>=0.8 THEN 'high' WHEN s>=0.45 THEN 'medium' ELSE 'low' END AS flag, CAST((q='ocr')::INT + noise::INT + (NOT num)::INT + (m IN ('text','ocr'))::INT + (NOT traced)::INT AS INTEGER) AS n_notes FROM y""")
def row_confidence(t):
    """F21, F22."""
    size = c("p_size")
    of = lambda words: F.element_at(F.array(*map(F.lit, words)), (size % len(words) + 1).cast("int"))
    x = analytics.row_confidence(of(("Table", "text", "ocr", "failed", "other")), of(("camelot", "pdfplumber", "ocr", "")), size % 3 == 0, size % 2 == 0, size % 7 > 2, F.lit(True), size % 6 == 1, False, False)
    return t.part.select("p_partkey", x.alias("x")).select("p_partkey", "x.score", "x.flag", F.size("x.notes").alias("n_notes"))


_SOURCES = "SELECT 's' || p_partkey AS source_id, p_brand AS title, p_type AS dataset, string_split(p_name,' ') AS columns FROM part"
_ALIASES = "(VALUES ('temper','cold'),('temper','HOT'),('thing','Widget'),('thing','bolt'),('kind','promo'),('brand','brand#5'),('one','s3'),('none','ewidge')) a(entity, alias)"
_HITS = f"h AS (SELECT DISTINCT entity, source_id FROM ({_SOURCES}) s JOIN {_ALIASES} ON lower(alias) IN (lower(title), lower(dataset), lower(source_id)) OR list_contains(list_transform(columns, lambda x: lower(x)), lower(alias)))"


def _sources(t):
    s = t.part.select(F.concat(F.lit("s"), c("p_partkey").cast("string")).alias("source_id"), c("p_brand").alias("title"), c("p_type").alias("dataset"), F.split("p_name", " ").alias("columns"))
    pairs = [("temper", "cold"), ("temper", "HOT"), ("thing", "Widget"), ("thing", "bolt"), ("kind", "promo"), ("brand", "brand#5"), ("one", "s3"), ("none", "ewidge")]
    return s, rows(t, pairs, "entity string, alias string")


@query(f"WITH {_HITS} SELECT e AS entity, CAST(count(source_id) AS BIGINT) AS n_sources FROM (SELECT DISTINCT entity AS e FROM {_ALIASES}) LEFT JOIN h ON h.entity=e GROUP BY 1")
def ontology_coverage(t):
    """Names equal aliases; parts of names don't count."""
    return analytics.coverage(*_sources(t))


@query(f"WITH {_HITS}, q AS (SELECT * FROM (VALUES ('temper','thing'),('thing','brand'),('one','none')) v(f, g)), b AS (SELECT f, g, x.source_id FROM q JOIN h x ON x.entity=f JOIN h y ON y.entity=g AND y.source_id=x.source_id) SELECT q.f AS from_entity, q.g AS to_entity, CAST(count(b.source_id) AS BIGINT) AS n_sources, coalesce(list_sort(list(b.source_id) FILTER (b.source_id IS NOT NULL)), []) AS source_ids FROM q LEFT JOIN b ON b.f=q.f AND b.g=q.g GROUP BY 1,2")
def relation_evidence(t):
    """The sources that name both ends of a relation."""
    return analytics.relation_evidence(*_sources(t), rows(t, [("temper", "thing"), ("thing", "brand"), ("one", "none")], "from_entity string, to_entity string"))


@query("SELECT panel, min(quality) AS score, CASE WHEN min(quality)>=0.85 THEN 'High' ELSE 'Low' END AS badge, list_sort(list(DISTINCT source)) AS reasons FROM (VALUES ('safety','src1'),('safety','src2'),('growth','src3')) p(panel, source) JOIN documents USING (source) JOIN labels USING (doc_id) GROUP BY 1")
def panel_badges(t):
    """The roll-up of each panel over the sources that it uses."""
    panels = rows(t, [("safety", "src1"), ("safety", "src2"), ("growth", "src3")], "panel string, source string")
    d = t.documents.select("doc_id", "source").join(t.labels, "doc_id").join(panels, "source").withColumn("why", F.array("source"))
    return analytics.badge_floor(d.groupBy("panel", "why").agg(F.min("quality").alias("quality")), "panel", "quality", "why").select("panel", "score", "badge", "reasons")


@query("""SELECT 'c_name_required' AS rule_id, 'warning' AS severity, CAST(sum(CASE WHEN trim(c_name)='' THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM customer UNION ALL SELECT 'c_name_prefix','error',CAST(sum(CASE WHEN c_name LIKE 'Customer#00000%' THEN 0 ELSE 1 END) AS BIGINT) FROM customer
UNION ALL SELECT 'c_acctbal_whole','error',CAST(sum(CASE WHEN abs(c_acctbal-round(c_acctbal))>0.001 THEN 1 ELSE 0 END) AS BIGINT) FROM customer UNION ALL SELECT 'c_acctbal_between','error',CAST(sum(CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN 0 ELSE 1 END) AS BIGINT) FROM customer
UNION ALL SELECT 'c_acctbal_per_c_custkey','warning',CAST(sum(CASE WHEN c_custkey<=0 OR c_acctbal/c_custkey NOT BETWEEN 5 AND 5000 THEN 1 ELSE 0 END) AS BIGINT) FROM customer UNION ALL SELECT 'any_value','error',CAST(0 AS BIGINT)
UNION ALL SELECT 'c_nationkey_le_c_custkey','error',CAST(sum(CASE WHEN c_nationkey>c_custkey THEN 1 ELSE 0 END) AS BIGINT) FROM customer UNION ALL SELECT 'c_name_numeric','error',CAST(count(*) AS BIGINT) FROM customer""")
def validate_more(t):
    """V02, V06, V09-V11."""
    v = validate
    return v.check(t.customer, [v.required("c_name", "warning"), v.prefixed("c_name", "Customer#00000"), v.whole("c_acctbal"), v.between("c_acctbal", 0, 5000), v.ratio_between("c_acctbal", "c_custkey", 5, 5000), v.any_value("c_name", "c_acctbal"), v.ordered("c_nationkey", "c_custkey"), v.parses("c_name")])


@query("""SELECT 'lang_single' AS rule_id, 'error' AS severity, CAST(1 AS BIGINT) AS n_bad UNION ALL SELECT 'lang_fr_at_most_1','error', CAST(greatest(0, count(*) FILTER (lang='fr') - 1) AS BIGINT) FROM documents""")
def validate_groups(t):
    """One value only, and a value of at most so many rows."""
    return validate.check_groups(t.documents, ["lang"], [("lang", "fr", 1)])


@query("""SELECT 'coverage' AS rule_id, 'error' AS severity, CAST(NULL AS VARCHAR) AS entity FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_custkey % 3 > 0) WHERE n < 1000000 UNION ALL SELECT 'missing_key','error', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 > 0) AND c_custkey % 2 = 0""")
def validate_coverage(t):
    """V05, V07."""
    some = t.orders.where("o_custkey % 3 > 0").select(c("o_custkey").alias("c_custkey"))
    return validate.check_coverage(some, "c_custkey", 1_000_000, t.customer.where("c_custkey % 2 <> 0"), t.customer)


@query("""SELECT 'missing_shard' AS rule_id, '5' AS entity UNION ALL SELECT 'shared_document', CAST(user_id AS VARCHAR) FROM (SELECT user_id FROM events WHERE event_id % 5 < 5 GROUP BY 1 HAVING count(DISTINCT event_id % 5) > 1) UNION ALL SELECT 'env_differs', CAST(count(DISTINCT event_type) AS VARCHAR) FROM events""")
def validate_shards(t):
    """Shards that are missing, share a document or differ in their environment."""
    shards = t.events.select((c("event_id") % 5).cast("int").alias("shard"), c("event_type").alias("env"), c("user_id").alias("doc"))
    return validate.shard_findings(shards, 6)


@query("SELECT 'missing_marker' AS rule_id, 'error' AS severity, CAST(page_id AS VARCHAR) AS entity, m AS marker FROM pages, (VALUES ('<nav>'),('href=\"/The\"'),('<main')) v(m) WHERE NOT contains(coalesce(html,''), m)")
def validate_markers(t):
    """V16."""
    return validate.marker_findings(t.pages, "page_id", "html", ["<nav>", 'href="/The"', "<main"])


@query("SELECT 'checksum_differs' AS rule_id, 'error' AS severity, CAST(doc_id AS VARCHAR) AS entity FROM documents WHERE doc_id % 5 = 1 UNION ALL SELECT 'missing_file','error', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 5 = 2")
def validate_checksums(t):
    """What a manifest says, against what is there."""
    d = t.documents.select(c("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), (c("doc_id") % 5).alias("m"))
    there = d.where("m <> 2").select("path", F.when(c("m") == 1, "0").otherwise(c("sha256")).alias("sha256"))
    return validate.checksum_findings(d.select("path", "sha256"), there)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS source_id, n_name AS title, CAST(n_regionkey AS BIGINT) AS row_count FROM nation WHERE n_regionkey > 0 AND n_regionkey <> 4")
def catalog_json(t):
    """A catalog written as JSON, read again, and the entries that a correlation takes."""
    path = f"{io.scratch_dir(t._spark)}/catalog-{uuid.uuid4().hex}"
    entries = t.nation.select(c("n_nationkey").cast("string").alias("source_id"), c("n_name").alias("title"), c("n_regionkey").cast("bigint").alias("row_count"), F.when(c("n_regionkey") == 4, "disabled").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("evidence_class"))
    catalog.write_catalog(t._spark, entries, path, "2026-01-01T00:00:00Z")
    return catalog.eligible(catalog.read_catalog(t._spark, path, "source_id string, title string, row_count bigint, status string, evidence_class string")).select("source_id", "title", "row_count")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, s_name AS title FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 4 <> 1")
def agreeing_reports(t):
    """Reports whose manifest is there, names the same path and has a time."""
    key = c("s_suppkey").cast("string")
    reports = t.supplier.select(key.alias("source_id"), c("s_name").alias("title"), F.concat(F.lit("/out/"), key).alias("path"))
    manifests = t.supplier.where("s_suppkey % 3 = 0").select(key.alias("source_id"), F.concat(F.lit("/out/"), key).alias("path"), F.when(c("s_suppkey") % 4 == 1, "soon").otherwise("2026-01-01T00:00:00").alias("generated_at"))
    return catalog.agreeing(reports, manifests).select("source_id", "title")


@query("SELECT connector, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN p_type IN ('PROMO','LARGE') THEN 'a' WHEN p_type='SMALL' THEN 'b' ELSE 'not_mapped' END AS connector FROM part) GROUP BY 1")
def connector_lookup(t):
    """The first connector that lists a source."""
    connectors = [catalog.Connector("a", ("PROMO", "LARGE"), lambda s, x: None), catalog.Connector("b", ("SMALL", "LARGE"), lambda s, x: None)]
    kinds = ("PROMO", "LARGE", "SMALL")
    table = {k: catalog.connector_for(connectors, k).name for k in kinds}
    return t.part.groupBy(analytics.looked_up(c("p_type"), table, "not_mapped").alias("connector")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'c' || o_orderkey % 3 AS source_id, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 1")
def latest_loads(t):
    """K03 as a log, P27: the last load of each selected source."""
    log = t.orders.select("o_orderkey", F.concat(F.lit("c"), (c("o_orderkey") % 3).cast("string")).alias("source_id"), "o_totalprice", "o_orderdate")
    picked = rows(t, [("c0",), ("c1",), ("c2",)], "source_id string")
    return relational.latest(log.join(picked, "source_id", "left_semi"), ["source_id"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("SELECT p_partkey, CAST(y AS INTEGER) AS i, CAST(p_size * 10 + y AS DOUBLE) AS allocation, CAST(p_size * 10 + 3 + y AS DOUBLE) AS release FROM part, range(3) r(y)")
def two_column_zip(t):
    """Years, and two runs of numbers in one list, side by side."""
    from ..operators.reshape import zip_explode

    text = F.concat_ws(" ", *[F.format_number(c("p_size") * 10 + i, 0) for i in range(6)])
    parts = t.part.select("p_partkey", extract.numbers(text).alias("all")).select("p_partkey", F.slice("all", 1, 3).alias("x"), F.slice("all", 4, 3).alias("y"))
    return zip_explode(parts, ["p_partkey"], allocation="x", release="y")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def paged_source(t):
    """A paged endpoint whose length isn't known, read to its end. Its pages are files of customers, which Spark has numbered and written."""
    from ..operators.ordering import global_index

    endpoint = f"{io.scratch_dir(t._spark)}/endpoint-{uuid.uuid4().hex}"
    rows_ = global_index(t.customer.select("c_custkey", "c_name", "c_mktsegment"), c("c_custkey"), name="at")
    record = F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment"))
    rows_.select(F.floor(c("at") / 100).alias("page"), record.alias("value")).repartition("page").write.partitionBy("page").text(endpoint)
    t._spark.dataSource.register(io.PagedSource)
    pages = t._spark.read.format("tidewell_pages").options(fetch="tidewell.sources.io.stored_page", limit="100", pages="all", last_offset="all", endpoint=endpoint).load()
    return pages.select(F.from_json("record", "c_custkey bigint, c_name string, c_mktsegment string").alias("x")).select("x.*")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn=1")
def stream_snapshots(t):
    """K03, K05 as a stream: each micro-batch is a snapshot; the last row of each key over all of them."""
    from ..streaming.events import current, upsert_stream

    out = f"{io.scratch_dir(t._spark)}/stream-{uuid.uuid4().hex}"
    # a pattern, as a stream's path has to be a folder or a pattern
    stream = t._spark.readStream.schema(t.events.schema).parquet(f"{t._dir}/[e]vents.parquet")
    upsert_stream(t._spark, stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return current(t._spark, f"{out}/rows", ["user_id"], "event_id").select("user_id", "event_id", "value")


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value),4) AS total FROM events GROUP BY 1,2")
def stream_windows(t):
    """Windowed counts of a stream, late rows included, as of a batch: in complete mode a watermark drops nothing."""
    from ..streaming.events import windowed

    name = f"windows_{uuid.uuid4().hex}"
    out = f"{io.scratch_dir(t._spark)}/{name}"
    stream = windowed(t._spark.readStream.schema(t.events.schema).parquet(f"{t._dir}/[e]vents.parquet"), "1 day")

    def put(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/rows")  # complete mode: a batch holds all windows

    stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows_ = t._spark.read.parquet(f"{out}/rows")
    return rows_.select(c("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
