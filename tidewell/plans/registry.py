"""All registered queries of the evidence engine, each with DuckDB SQL for the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce, dates, names
from ..operators import analytics, relational, reshape, validate
from ..sources import catalog
from .base import QUERIES, SQL, TABLES, Tables, query, r

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "TABLES", "Tables"]
FLAGSHIP = "ratio_panel"
c = F.col


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n FROM {t}" for t in TABLES))
def scan_row_counts(t):
    parts = [getattr(t, x).agg(F.count("*").alias("n")).select(F.lit(x).alias("table_name"), "n") for x in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL")
def project_cast_filter(t):
    return t.orders.where(c("o_totalprice").isNotNull() & c("o_orderdate").isNotNull()).select("o_orderkey", c("o_totalprice").cast("double").alias("price"), F.year("o_orderdate").alias("year"), c("o_orderstatus").alias("status"))


@query("SELECT l_returnflag, round(sum(coalesce(l_quantity,0)+coalesce(l_discount,0)+coalesce(l_tax,0)),2) AS total FROM lineitem GROUP BY 1")
def rowwise_coalesce_sum(t):
    z = lambda x: F.coalesce(c(x), F.lit(0.0))
    return t.lineitem.groupBy("l_returnflag").agg(r(F.sum(z("l_quantity") + z("l_discount") + z("l_tax")), 2).alias("total"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) NOT IN ('building','total')")
def label_exclusion(t):
    return t.customer.where(~F.lower(F.trim("c_mktsegment")).isin("building", "total")).select("c_custkey", "c_mktsegment")


_LONG = """SELECT metric, CAST(count(value) AS BIGINT) AS n, round(sum(value),2) AS total FROM (
SELECT 'lineitem.l_quantity' AS metric, CAST(l_quantity AS DOUBLE) AS value FROM lineitem UNION ALL
SELECT 'lineitem.l_discount', CAST(l_discount AS DOUBLE) FROM lineitem UNION ALL
SELECT 'lineitem.l_tax', CAST(l_tax AS DOUBLE) FROM lineitem) GROUP BY 1"""


@query(_LONG)
def dynamic_unpivot(t):
    return reshape.to_long(t.lineitem, ["l_orderkey"], ["l_quantity", "l_discount", "l_tax"], "lineitem").groupBy("metric").agg(F.count("value").alias("n"), r(F.sum("value"), 2).alias("total"))


@query("SELECT 1 AS year, l_orderkey, l_linenumber, l_quantity AS killed, CAST(NULL AS DOUBLE) AS injured FROM lineitem UNION ALL SELECT 2, l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem")
def union_all_unpivot(t):
    """A branch a year over all lines, with a typed null where a year lacks a measure."""
    one = t.lineitem.select(F.lit(1).alias("year"), "l_orderkey", "l_linenumber", c("l_quantity").alias("killed"), F.lit(None).cast("double").alias("injured"))
    return one.unionAll(t.lineitem.select(F.lit(2), "l_orderkey", "l_linenumber", "l_quantity", "l_tax"))


@query("""SELECT 'quantity' AS metric, l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS rate FROM lineitem
UNION ALL SELECT 'discount', l_orderkey, l_linenumber, CAST(NULL AS DOUBLE), CAST(l_discount AS DOUBLE) FROM lineitem
UNION ALL SELECT 'tax', l_orderkey, l_linenumber, CAST(NULL AS DOUBLE), CAST(l_tax AS DOUBLE) FROM lineitem""")
def union_all_unpivot_lines(t):
    none = F.lit(None).cast("double")
    branch = lambda metric, amount, rate: t.lineitem.select(F.lit(metric).alias("metric"), "l_orderkey", "l_linenumber", amount.cast("double").alias("amount"), rate.cast("double").alias("rate"))
    return branch("quantity", c("l_quantity"), none).unionAll(branch("discount", none, c("l_discount"))).unionAll(branch("tax", none, c("l_tax")))


@query("SELECT l_returnflag, round(avg(l_quantity),4) AS quantity, round(avg(l_extendedprice),4) AS price, round(avg(l_discount),6) AS discount FROM lineitem GROUP BY 1")
def avg_one_key(t):
    return t.lineitem.groupBy("l_returnflag").agg(r(F.avg("l_quantity")).alias("quantity"), r(F.avg("l_extendedprice")).alias("price"), r(F.avg("l_discount"), 6).alias("discount"))


@query("SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, round(avg(l_quantity),4) AS quantity, round(avg(l_tax),6) AS tax FROM lineitem GROUP BY 1,2")
def avg_two_keys(t):
    return t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("year")).agg(r(F.avg("l_quantity")).alias("quantity"), r(F.avg("l_tax"), 6).alias("tax"))


@query("SELECT o_orderkey, TRY_CAST(substr(o_orderpriority,1,1) AS INTEGER) AS priority FROM orders WHERE TRY_CAST(substr(o_orderpriority,1,1) AS INTEGER) IS NOT NULL")
def cast_in_predicate(t):
    p = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return t.orders.select("o_orderkey", p.alias("priority")).where("priority is not null")


@query("SELECT trim(regexp_replace(regexp_replace(lower(trim(n_name)),'[^a-z0-9 ]','','g'),'\\s+',' ','g')) AS nation, CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal),2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def norm_key_join(t):
    return t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).groupBy(names.spaced_key(c("n_name")).alias("nation")).agg(F.count("*").alias("n"), r(F.sum("c_acctbal"), 2).alias("balance"))


@query("""WITH y AS (SELECT max(year(l_shipdate)) AS y FROM lineitem), s AS (SELECT l_suppkey, sum(l_extendedprice*(1-l_discount)) AS revenue FROM lineitem, y WHERE year(l_shipdate)=y.y GROUP BY 1)
SELECT s_suppkey, round(revenue,2) AS revenue, round(revenue*100/s_acctbal,4) AS per_100 FROM s JOIN supplier ON s_suppkey=l_suppkey WHERE s_acctbal>0""")
def ratio_panel(t):
    # the one date that bounds the scan comes first, so that the filter reaches the files
    last = t.lineitem.agg(F.max("l_shipdate")).first()[0]
    lines = t.lineitem.where(c("l_shipdate") >= F.make_date(F.lit(last.year if last else 1), F.lit(1), F.lit(1)).cast("timestamp"))
    sums = lines.groupBy("l_suppkey").agg(F.sum(c("l_extendedprice") * (1 - c("l_discount"))).alias("revenue"))
    return sums.join(t.supplier, c("s_suppkey") == c("l_suppkey")).where("s_acctbal > 0").select("s_suppkey", r(c("revenue"), 2).alias("revenue"), r(coerce.per(c("revenue"), c("s_acctbal"), 100)).alias("per_100"))


@query("""SELECT o_orderkey, c_custkey, n_name, greatest(1, coalesce(n_regionkey, 0)) AS region FROM orders JOIN customer ON c_custkey=o_custkey LEFT JOIN nation ON n_nationkey=c_nationkey AND n_regionkey>1""")
def inner_plus_left(t):
    n = t.nation.where("n_regionkey > 1")
    return t.orders.join(t.customer, c("c_custkey") == c("o_custkey")).join(n, c("n_nationkey") == c("c_nationkey"), "left").select("o_orderkey", "c_custkey", "n_name", F.greatest(F.lit(1), F.coalesce("n_regionkey", F.lit(0))).alias("region"))


@query("SELECT p_partkey, coalesce(n, 0) AS n FROM part LEFT JOIN (SELECT l_partkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY 1) ON l_partkey=p_partkey")
def left_default_zero(t):
    facts = t.lineitem.where("l_quantity > 49").groupBy(c("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return relational.complete_domain(t.part.select("p_partkey"), facts, ["p_partkey"], {"n": 0})


@query("""WITH m AS (SELECT l_partkey AS k, 'sold' AS origin FROM lineitem WHERE l_quantity>49 GROUP BY 1) SELECT * FROM m UNION ALL SELECT p_partkey, 'listed' FROM part WHERE p_partkey NOT IN (SELECT k FROM m)""")
def anti_fill(t):
    sold = t.lineitem.where("l_quantity > 49").select(c("l_partkey").alias("k")).distinct().withColumn("origin", F.lit("sold"))
    return relational.fill_gaps(sold, t.part.select(c("p_partkey").alias("k"), F.lit("listed").alias("origin")), ["k"])


@query("""WITH a AS (SELECT user_id, event_id, 'error' AS kind FROM events WHERE event_type='error'), b AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type<>'error' AND user_id NOT IN (SELECT user_id FROM a) GROUP BY 1) SELECT * FROM a UNION ALL SELECT user_id, event_id, 'other' FROM b""")
def incremental_anti(t):
    e = t.events.select("user_id", "event_id", F.when(c("event_type") == "error", "error").otherwise("other").alias("kind"))
    return relational.fill_gaps(e.where("kind = 'error'"), e.where("kind = 'other'"), ["user_id"], distinct_by="event_id")


@query("""WITH u AS (SELECT user_id, event_id, value, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 END AS p FROM events)
SELECT user_id, event_id, value, CAST(p AS INTEGER) AS tier FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p, CASE WHEN p=0 THEN -event_id ELSE event_id END) AS rn FROM u WHERE p IS NOT NULL) WHERE rn=1""")
def priority_merge(t):
    tiers = [t.events.where(c("event_type") == k).select("user_id", "event_id", "value", F.lit(i).alias("tier"), c("event_id").alias("seq")) for i, k in enumerate(("purchase", "signup", "click"))]
    return relational.priority_merge(tiers, ["user_id"]).drop("seq")


@query("""SELECT coalesce(a.m,b.m) AS month, n_orders, n_lines FROM (SELECT strftime(o_orderdate,'%Y-%m') AS m, CAST(count(*) AS BIGINT) AS n_orders FROM orders GROUP BY 1) a FULL JOIN (SELECT strftime(l_shipdate,'%Y-%m') AS m, CAST(count(*) AS BIGINT) AS n_lines FROM lineitem GROUP BY 1) b ON a.m=b.m""")
def full_outer_metrics(t):
    a = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n_orders"))
    return a.join(t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n_lines")), "month", "full_outer")


_LATEST = "SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn=1"


@query(_LATEST)
def latest_per_key(t):
    return relational.latest(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query(f"SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_custkey IN (SELECT o_custkey FROM ({_LATEST}) ORDER BY o_totalprice DESC, o_custkey LIMIT 8)")
def semi_topk(t):
    return relational.top_groups(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderkey")


@query("""SELECT o_custkey, CASE WHEN y2000>0 THEN '2000' WHEN y1999>0 THEN '1999' WHEN y1998>0 THEN '1998' END AS label, round(CASE WHEN y2000>0 THEN y2000 WHEN y1999>0 THEN y1999 WHEN y1998>0 THEN y1998 END,2) AS value
FROM (SELECT o_custkey, sum(o_totalprice) FILTER (year(o_orderdate)=1998) AS y1998, sum(o_totalprice) FILTER (year(o_orderdate)=1999) AS y1999, sum(o_totalprice) FILTER (year(o_orderdate)=2000) AS y2000 FROM orders GROUP BY 1)""")
def latest_available_in_list(t):
    years = ["1998", "1999", "2000"]
    wide = reshape.to_wide(t.orders.withColumn("y", F.year("o_orderdate").cast("string")), ["o_custkey"], "y", "o_totalprice", years, F.sum)
    return wide.withColumn("x", relational.latest_available([(y, y) for y in years])).select("o_custkey", c("x.label").alias("label"), r(c("x.value"), 2).alias("value"))


@query("SELECT user_id, event_type, arg_max(value, event_id) AS last_value, arg_min(value, event_id) AS first_value FROM events GROUP BY 1,2")
def first_last_wins(t):
    e = t.events.select("user_id", "event_type", "event_id", "value")
    last = relational.last_wins(e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", c("value").alias("last_value"))
    return last.join(relational.first_wins(e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", c("value").alias("first_value")), ["user_id", "event_type"])


@query("SELECT user_id, round(avg(value) FILTER (event_type='view'),7) AS view, round(avg(value) FILTER (event_type='purchase'),7) AS purchase FROM events GROUP BY 1")
def conditional_avg(t):
    out = reshape.to_wide(t.events, ["user_id"], "event_type", "value", ["view", "purchase"])
    return out.select("user_id", r(c("view"), 7).alias("view"), r(c("purchase"), 7).alias("purchase"))


_METRICS = """m AS (SELECT strftime(o_orderdate,'%Y') AS entity, CAST(month(o_orderdate) AS INTEGER) AS year, 'orders.price' AS metric, o_totalprice AS value FROM orders
UNION ALL SELECT strftime(l_shipdate,'%Y'), CAST(month(l_shipdate) AS INTEGER), 'lines.quantity', l_quantity FROM lineitem
UNION ALL SELECT strftime(l_shipdate,'%Y'), CAST(month(l_shipdate) AS INTEGER), 'lines.tax', l_tax FROM lineitem
UNION ALL SELECT strftime(l_shipdate,'%Y'), CAST(month(l_shipdate) AS INTEGER), 'lines.constant', 1.0 FROM lineitem)"""


@query(f"""WITH {_METRICS}, a AS (SELECT entity, year, metric, avg(value) AS v FROM m GROUP BY 1,2,3)
SELECT x.metric AS metric_a, y.metric AS metric_b, round(corr(x.v,y.v),6) AS correlation, CAST(count(*) AS BIGINT) AS overlap_records, min(x.year) AS year_min, max(x.year) AS year_max
FROM a x JOIN a y ON x.entity=y.entity AND x.year=y.year AND x.metric<y.metric GROUP BY 1,2 HAVING min(x.v)<max(x.v) AND min(y.v)<max(y.v) AND count(*)>=2""")
def pairwise_corr(t):
    # means per entity and year first: what is made long is a row a cell, not a row a line
    o = t.orders.groupBy(F.date_format("o_orderdate", "yyyy").alias("entity"), F.month("o_orderdate").alias("year")).agg(F.avg("o_totalprice").alias("value")).select("entity", "year", F.lit("orders.price").alias("metric"), "value")
    lines = t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy").alias("entity"), F.month("l_shipdate").alias("year")).agg(F.avg("l_quantity").alias("quantity"), F.avg("l_tax").alias("tax"), F.lit(1.0).alias("constant"))
    return analytics.pairwise_correlation(o.unionByName(reshape.to_long(lines, ["entity", "year"], ["quantity", "tax", "constant"], "lines")))


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1,2 HAVING count(*)>1")
def duplicate_keys(t):
    return relational.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(count(*)/(SELECT count(*) FROM events),6) AS share FROM events GROUP BY 1")
def value_share(t):
    return relational.value_share(t.events, "event_type").withColumn("share", r(c("share"), 6))


@query("SELECT lang, round(avg(coalesce(quality,0)),6) AS avg_confidence, CAST(min(coalesce(quality,0)) AS DOUBLE) AS min_confidence, CAST(max(coalesce(quality,0)) AS DOUBLE) AS max_confidence, CAST(sum(CASE WHEN coalesce(quality,0)<0.45 THEN 1 ELSE 0 END) AS BIGINT) AS n_low FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def confidence_stats(t):
    out = analytics.confidence_stats(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left"), ["lang"], "quality")
    return out.withColumn("avg_confidence", r(c("avg_confidence"), 6))


@query("SELECT CAST(count(*) AS BIGINT) AS n, round(1 - (sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END)+sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END)+sum(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END))/(3.0*count(*)),3) AS completeness FROM documents LEFT JOIN labels USING (doc_id)")
def completeness(t):
    return analytics.completeness(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality"))


@query("SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 0.78 ELSE 0.5 END AS DOUBLE) AS factor FROM events")
def status_factor_lookup(t):
    return t.events.select("event_id", analytics.looked_up(c("event_type"), {"view": 1.0, "click": 0.78}, 0.5).alias("factor"))


@query("SELECT source, round(0.35*avg(quality)+0.65,3) AS score, CASE WHEN 0.35*avg(quality)+0.65>=0.85 THEN 'High' WHEN 0.35*avg(quality)+0.65>=0.65 THEN 'Med' ELSE 'Low' END AS badge FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def score_badge(t):
    per = t.documents.select("doc_id", "source").join(t.labels, "doc_id").groupBy("source").agg(F.avg("quality").alias("q"))
    one = F.lit(1.0)
    return per.select("source", analytics.overall(c("q"), one, one, one, F.lit("ok")).alias("s")).select("source", c("s.score").alias("score"), c("s.badge").alias("badge"))


@query("SELECT lang, min(quality) AS score, list_sort(list(DISTINCT source))[1] AS first_reason, CASE WHEN min(quality)>=0.85 THEN 'High' ELSE 'Low' END AS badge FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def badge_floor(t):
    d = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id").withColumn("why", F.array("source")).groupBy("lang", "why").agg(F.min("quality").alias("quality"))
    return analytics.badge_floor(d, "lang", "quality", "why").select("lang", "score", F.element_at("reasons", 1).alias("first_reason"), "badge")


@query("SELECT evidence, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN source='src1' THEN 'proxy' ELSE 'official' END AS evidence FROM documents) GROUP BY 1")
def evidence_class_counts(t):
    return t.documents.select(analytics.evidence_class(c("source") != "src1", F.lit("text")).alias("evidence")).groupBy("evidence").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, last_day(o_orderdate) AS month_end, CAST(strftime(o_orderdate,'%Y') || '-12-31' AS DATE) AS year_end, CAST(year(o_orderdate)+1 || '-03-31' AS DATE) AS fiscal_end, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
def date_ladder(t):
    y = F.date_format("o_orderdate", "yyyy")
    return t.orders.select("o_orderkey", F.last_day("o_orderdate").alias("month_end"), dates.date_value(y).alias("year_end"), dates.date_value(F.concat(y, F.lit("-99"))).alias("fiscal_end"), dates.year_number(F.concat(F.lit("FY "), y)).alias("y"))


@query("SELECT event_id, least(100.0, greatest(0.0, value)) AS clamped, coalesce(nullif(value,0),0) AS truthy, CAST(json_extract_string(props,'$.k') AS DOUBLE) AS k FROM events")
def num_default(t):
    return t.events.select("event_id", coerce.clamp(c("value"), 0, 100).alias("clamped"), coerce.first_truthy(c("value")).alias("truthy"), coerce.number(F.get_json_object("props", "$.k")).alias("k"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name),'[^a-z0-9]+','_','g'),'_') AS metric, regexp_replace(lower(trim(p_type)),'[^a-z0-9]+','','g') AS bare FROM part")
def metric_name_norm(t):
    return t.part.select("p_partkey", names.metric_name(c("p_name")).alias("metric"), names.bare_key(c("p_type")).alias("bare"))


@query("SELECT lang, n_chars, min(doc_id) AS doc_id FROM documents GROUP BY lang, n_chars, lower(trim(regexp_replace(text,'\\s+',' ','g')))")
def dedupe_composite(t):
    # 128 bits of the text stand for it, and minima are combined before the shuffle
    k = F.lower(names.squeezed(c("text")))
    keys = [c("lang"), c("n_chars"), F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"), k.isNull().alias("none")]
    return t.documents.groupBy(*keys).agg(F.min("doc_id").alias("doc_id")).select("lang", "n_chars", "doc_id")


@query("SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS n_a, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_b, (SELECT count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)) AS n_both")
def intersect_overlap(t):
    return relational.overlap(t.customer.select(c("c_custkey").alias("k")), t.orders.select(c("o_custkey").alias("k")), "k").select("n_a", "n_b", "n_both")


@query("SELECT c_custkey AS k, 'only_a' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_custkey, 'only_b' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def except_sets(t):
    return relational.set_difference(t.customer.select(c("c_custkey").alias("k")), t.orders.select(c("o_custkey").alias("k")), ["k"])


@query("SELECT DISTINCT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) - 1 AS row_index FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)")
def shard_merge(t):
    o = t.orders.select("o_custkey", "o_orderstatus")
    return relational.merge_shards([relational.shard(o, "o_custkey", 4, i) for i in range(4)], ["o_custkey"], c("o_orderstatus")).withColumn("row_index", c("row_index").cast("bigint"))


_SEED = "CAST('0x' || substr(sha256('2026|part|' || p_partkey || '|' || segment),1,12) AS BIGINT)"


@query(f"""WITH s AS (SELECT p_partkey, segment, {_SEED} AS seed FROM part, range(5) r(segment))
SELECT p_partkey, CAST(segment AS INTEGER) AS segment, seed, CAST((segment + seed % 12) % 12 + 1 AS INTEGER) AS month, CAST(2021 + (seed // 12) % 6 AS INTEGER) AS year, round(0.5 + (seed % 180)/12, 2) AS access_hours FROM s""")
def seeded_expand(t):
    return analytics.expand(t.part.select("p_partkey"), ["p_partkey"], 5, 2026, "part").select("p_partkey", "segment", "seed", "month", "year", "access_hours")


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN length(trim(l))<4 THEN 1 ELSE 0 END) AS BIGINT) AS n_short FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY 1")
def line_explode(t):
    return reshape.lines(t.documents, "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum((F.length(F.trim("line")) < 4).cast("bigint")).alias("n_short"))


@query("""WITH n AS (SELECT *, sum(CASE WHEN role='user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS chunk FROM conversations)
SELECT conv_id, CAST(chunk AS BIGINT) AS chunk, string_agg(coalesce(text,''), ' ' ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS n_rows FROM n GROUP BY 1,2""")
def row_chunking(t):
    return reshape.chunks(t.conversations, "conv_id", "turn", "text", c("role") == "user")


@query("SELECT doc_id, CASE WHEN lower(text) LIKE '%is%' THEN true ELSE false END AS hit FROM documents")
def contains_filter(t):
    return t.documents.select("doc_id", F.lower("text").contains("is").alias("hit"))


@query("SELECT theme, CAST(coalesce(n,0) AS BIGINT) AS n_sources, CASE WHEN n IS NULL THEN 'missing' WHEN o=0 THEN 'restricted' ELSE 'covered' END AS status FROM (VALUES ('src1'),('src2'),('none')) q(theme) LEFT JOIN (SELECT source, count(*) AS n, max(CASE WHEN source<>'src2' THEN 1 ELSE 0 END) AS o FROM documents GROUP BY 1) ON source=theme")
def gap_report(t):
    need = t._spark.createDataFrame([("src1",), ("src2",), ("none",)], "theme string")
    return analytics.gap_report(need, t.documents.select(c("source").alias("theme"), (c("source") != "src2").alias("open")))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn=1")
def catalog_upsert(t):
    e = t.events.select("user_id", "event_id", "event_type")
    old, new = (catalog.latest_load(e.where(f), "user_id", "event_id") for f in ("event_id % 2 = 0", "event_id % 2 <> 0"))
    # of a new load, only what is later than the catalog's row of its key replaces it
    entries = new.join(old.select("user_id", c("event_id").alias("was")), "user_id", "left").where("was is null or event_id > was").drop("was")
    return catalog.upsert(old, entries, "user_id")


@query("""SELECT 'c_name_required' AS rule_id, 'error' AS severity, CAST(sum(CASE WHEN c_name IS NULL OR trim(c_name)='' THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM customer
UNION ALL SELECT 'c_mktsegment_in_set','error', CAST(sum(CASE WHEN c_mktsegment NOT IN ('BUILDING') THEN 1 ELSE 0 END) AS BIGINT) FROM customer
UNION ALL SELECT 'c_acctbal_non_negative','error', CAST(sum(CASE WHEN c_acctbal<0 THEN 1 ELSE 0 END) AS BIGINT) FROM customer""")
def validate_rules(t):
    return validate.check(t.customer, [validate.required("c_name"), validate.one_of("c_mktsegment", ["BUILDING"]), validate.non_negative("c_acctbal")])


@query("""WITH m AS (SELECT strftime(o_orderdate,'%Y-%m') AS month, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1), p AS (SELECT strftime(l_shipdate,'%Y-%m') AS month, CAST(count(*) AS DOUBLE)/4 AS n FROM lineitem GROUP BY 1)
SELECT m.month, m.n AS now, p.n AS then, m.n-p.n AS delta, CASE WHEN abs(m.n-p.n)>greatest(10, abs(p.n)*0.5) THEN 'error' WHEN abs(m.n-p.n)>1 THEN 'warning' ELSE 'ok' END AS severity FROM m JOIN p ON m.month=p.month""")
def drift_bands(t):
    a = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").cast("double").alias("n"))
    b = t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg((F.count("*").cast("double") / 4).alias("n"))
    return validate.drift(a, b, "month", "n", 1, 10)


@query("SELECT s_suppkey, round(3+(s_acctbal-lo)/(hi-lo)*9,6) AS radius, round(least(100,greatest(5,s_acctbal/hi*100)),6) AS width FROM supplier, (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier)")
def minmax_scale(t):
    ends = t.supplier.agg(F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi"))
    return t.supplier.crossJoin(F.broadcast(ends)).select("s_suppkey", r(relational.scaled(c("s_acctbal"), c("lo"), c("hi"), (3.0, 12.0)), 6).alias("radius"), r(coerce.clamp(c("s_acctbal") / c("hi") * 100, 5, 100), 6).alias("width"))


@query("SELECT event_type, CAST(count(DISTINCT date_trunc('day', ts)) AS BIGINT) AS n_points, CAST(strftime(min(ts), '%Y-%m-%d') AS VARCHAR) AS first_x FROM events GROUP BY 1")
def nested_series(t):
    days = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n"))
    return reshape.series(days, "event_type", "d", "n").select("event_type", F.size("points").cast("bigint").alias("n_points"), c("points")[0]["x"].alias("first_x"))


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) - 1 AS INTEGER) AS row_index FROM orders")
def stable_multikey_sort_index(t):
    return relational.with_row_index(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], c("o_orderdate").asc_nulls_last(), c("o_orderkey")).drop("o_orderdate")


@query("SELECT vec_id, CAST(i-1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS x, CAST(embedding[65-i] AS DOUBLE) AS y FROM embeddings, range(1,65) r(i)")
def zip_explode(t):
    e = t.embeddings.withColumn("back", F.reverse("embedding"))
    return reshape.zip_explode(e, ["vec_id"], x="embedding", y="back").select("vec_id", "i", c("x").cast("double").alias("x"), c("y").cast("double").alias("y"))


@query("SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, CAST(count(*) AS BIGINT) AS n, round(sum(value),4) AS total FROM events GROUP BY 1,2")
def windowed_events(t):
    from ..streaming.events import windowed

    return windowed(t.events).withColumn("total", r(c("total")))


@query("SELECT l_orderkey, l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem) GROUP BY 1,2,3")
def exact_distinct(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").dropDuplicates().groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.count("*").alias("n"))


from . import choices, panels, stores, tables, texts  # noqa: E402, F401  they register their queries
