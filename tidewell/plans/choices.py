"""Queries of filters, row choice, sorting, merges and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce, names
from ..operators import analytics, display, filters, relational, reshape, validate
from .base import query, r, rows

c = F.col


@query("SELECT c_mktsegment AS state, * FROM customer WHERE c_mktsegment IS NOT NULL")
def computed_and_star(t):
    """Q10, Q11."""
    return t.customer.where("c_mktsegment is not null").select(c("c_mktsegment").alias("state"), "*")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderstatus AS VARCHAR) AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def cast_to_text(t):
    """Q16."""
    return t.orders.select(c("o_orderkey").cast("string").alias("order_key"), c("o_custkey").cast("string").alias("customer"), c("o_orderstatus").cast("string").alias("status"), c("o_orderdate").cast("date").cast("string").alias("day"))


@query("""SELECT 'All' AS wanted, c_custkey, c_mktsegment FROM customer UNION ALL SELECT ' Furniture!', c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'FURNITURE'""")
def parameter_filter(t):
    """The same filter with two choices."""
    few = lambda w: filters.by_key(t.customer, "c_mktsegment", w).select(F.lit(w).alias("wanted"), "c_custkey", "c_mktsegment")
    return few("All").unionAll(few(" Furniture!"))


_FLAGS = """m AS (SELECT CAST(l_orderkey AS BIGINT) AS k, l_linenumber AS line, 'Quantity (units)' AS metric_name, l_quantity AS metric_value FROM lineitem
UNION ALL SELECT CAST(l_orderkey AS BIGINT), l_linenumber, 'Tax-Rate', l_tax FROM lineitem UNION ALL SELECT CAST(l_orderkey AS BIGINT), l_linenumber, 'Tax Due', l_tax * l_extendedprice FROM lineitem)"""


def _metrics(t):
    one = lambda name, value: t.lineitem.select(c("l_orderkey").cast("bigint").alias("k"), c("l_linenumber").alias("line"), F.lit(name).alias("metric_name"), value.alias("metric_value"))
    return one("Quantity (units)", c("l_quantity")).unionAll(one("Tax-Rate", c("l_tax"))).unionAll(one("Tax Due", c("l_tax") * c("l_extendedprice")))


@query(f"WITH {_FLAGS} SELECT k, line, 'quantity_units' AS metric_name, round(metric_value, 4) AS metric_value FROM m WHERE metric_name = 'Quantity (units)'")
def metric_pick(t):
    """P17, P18."""
    return filters.by_metric(_metrics(t), ["quantity_units"]).withColumn("metric_value", r(c("metric_value")))


@query(f"WITH {_FLAGS} SELECT CASE metric_name WHEN 'Tax Due' THEN 'tax_due' ELSE 'tax_rate' END AS metric_name, CAST(count(*) AS BIGINT) AS n, round(sum(metric_value), 2) AS total FROM m WHERE metric_name LIKE 'Tax%' GROUP BY 1")
def metric_family(t):
    """P31."""
    return filters.by_metric(_metrics(t), prefix="tax").groupBy("metric_name").agg(F.count("*").alias("n"), r(F.sum("metric_value"), 2).alias("total"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN lower(o_orderstatus)='p' THEN 'provisional' ELSE 'final' END AS part, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1,2")
def provisional_split(t):
    """P19."""
    final, provisional = filters.split_provisional(t.orders, "o_orderstatus", "p")
    both = final.withColumn("part", F.lit("final")).unionAll(provisional.withColumn("part", F.lit("provisional")))
    return both.groupBy(F.year("o_orderdate").alias("year"), "part").agg(F.count("*").alias("n"))


@query("SELECT doc_id, source, CASE WHEN source='src1' OR lang='de' THEN 'proxy' ELSE 'model' END AS evidence FROM documents WHERE (CASE WHEN source='src1' OR lang='de' THEN 'proxy' WHEN lang='fr' THEN 'model' ELSE 'official' END) IN ('proxy','model')")
def evidence_filter(t):
    """P20, P21."""
    category = F.when(c("lang") == "de", "Proxy index").when(c("lang") == "fr", "MODEL output").otherwise("measured")
    d = t.documents.select("doc_id", "source", analytics.evidence_class(c("source") != "src1", category).alias("evidence"))
    return filters.by_evidence(d, c("evidence"), "proxy").unionAll(filters.by_evidence(d, c("evidence"), "model"))


@query("SELECT doc_id, source FROM documents WHERE source='src3' OR source='src7' OR contains(source,'rc1')")
def source_pick(t):
    """P32."""
    return filters.by_source(t.documents.select("doc_id", "source"), ["src3", "src7"], ["rc1"], "source")


@query("SELECT doc_id FROM documents WHERE lower(coalesce(text,'')) LIKE '%schön%' OR lower(coalesce(text,'')) LIKE '%tion on%' OR lower(source) LIKE '%src9%'")
def words_filter(t):
    """One of several words in one of two columns."""
    return filters.matching(t.documents, ["text", "source"], ["Schön", "TION on", "src9"]).select("doc_id")


@query("SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment='BUILDING' THEN 'all building' ELSE lower(c_mktsegment) END AS label FROM customer WHERE c_mktsegment <> 'BUILDING'")
def aggregate_labels(t):
    """Labels of totals go."""
    label = F.when(c("c_mktsegment") == "BUILDING", "All  Building").otherwise(c("c_mktsegment"))
    return t.customer.where(~names.is_aggregate_label(names.spaced_key(label))).select("c_custkey", "c_acctbal", names.spaced_key(label).alias("label"))


_TOTALS = "SELECT s_nationkey AS k, round(sum(s_acctbal),2) AS a, CAST(count(*) AS DOUBLE) AS b FROM supplier GROUP BY 1"


@query(f"SELECT k, a, b, CAST(row_number() OVER (ORDER BY a+b DESC, k) AS INTEGER) AS place FROM ({_TOTALS})")
def sorted_by_sum(t):
    """The place in the sorted table; its rows are one a nation."""
    by = t.supplier.groupBy(c("s_nationkey").alias("k")).agg(r(F.sum("s_acctbal"), 2).alias("a"), F.count("*").cast("double").alias("b"))
    ordered = relational.best_first(by, "a", "b", tie="k").agg(F.collect_list(F.struct("k", "a", "b")).alias("x"))
    return ordered.select(F.posexplode("x").alias("i", "x")).select("x.k", "x.a", "x.b", (c("i") + 1).alias("place"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def first_examples(t):
    """O06."""
    return relational.examples(t.orders.select("o_orderkey", "o_totalprice"), 30, c("o_totalprice").desc(), c("o_orderkey"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE i % greatest(1, n // 6) = 0""")
def axis_labels(t):
    """W11."""
    return relational.every_nth(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], 6, c("o_orderdate"), c("o_orderkey")).select("o_custkey", "o_orderkey")


@query("""SELECT l_suppkey, l_returnflag, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f, l_returnflag) AS rn FROM (SELECT l_suppkey, l_returnflag, count(*) AS n, min(l_orderkey * 8 + l_linenumber) AS f FROM lineitem GROUP BY 1,2)) WHERE rn=1""")
def most_frequent(t):
    """A19."""
    return relational.mode(t.lineitem.withColumn("seq", c("l_orderkey") * 8 + c("l_linenumber")), ["l_suppkey"], "l_returnflag", "seq")


@query("SELECT CASE c_mktsegment WHEN 'FURNITURE' THEN 'HOME' WHEN 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS c_mktsegment, round(sum(c_acctbal),2) AS c_acctbal FROM customer GROUP BY 1")
def remapped_sum(t):
    """A13."""
    return relational.remapped_sum(t.customer, "c_mktsegment", "c_acctbal", {"FURNITURE": "HOME", "HOUSEHOLD": "HOME"}).withColumn("c_acctbal", r(c("c_acctbal"), 2))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn=1")
def arg_max(t):
    """O07."""
    return relational.arg_max(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", "o_orderkey")


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN value>100 THEN 1 ELSE 0 END) AS BIGINT) AS n_large FROM events GROUP BY 1")
def merged_counts(t):
    """The counts of four shards, summed."""
    shards = [relational.shard(t.events, "event_id", 4, i).groupBy("event_type").agg(F.count("*").alias("n"), F.sum((c("value") > 100).cast("bigint")).alias("n_large")) for i in range(4)]
    return relational.merged_counts(shards, "event_type", ["n", "n_large"])


@query("""SELECT user_id, arg_min(value, event_id) FILTER (event_type='view') AS "view", arg_min(value, event_id) FILTER (event_type='purchase') AS purchase FROM events GROUP BY 1""")
def first_wide(t):
    """A05, J12."""
    return relational.first_wide(t.events, ["user_id"], "event_type", "value", ["view", "purchase"], "event_id")


@query("SELECT n.n_name, CAST(greatest(0, coalesce(c.n,0) - coalesce(s.n,0)) AS DOUBLE) AS left_over FROM nation n LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) c ON c.k=n.n_nationkey LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON s.k=n.n_nationkey")
def remaining_counts(t):
    """F32, J06."""
    x = t.customer.groupBy(c("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("a"))
    y = t.supplier.groupBy(c("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("b"))
    return t.nation.join(x, "n_nationkey", "left").join(y, "n_nationkey", "left").select("n_name", relational.remaining(c("a"), c("b")).alias("left_over"))


@query("SELECT CAST(p_partkey AS BIGINT) AS p_partkey, coalesce(f, 'missing') AS flag FROM part LEFT JOIN (SELECT l_partkey, max(l_returnflag) AS f FROM lineitem WHERE l_quantity>49 GROUP BY 1) ON l_partkey=p_partkey")
def text_default(t):
    """J20."""
    found = t.lineitem.where("l_quantity > 49").groupBy(c("l_partkey").alias("p_partkey")).agg(F.max("l_returnflag").alias("flag"))
    return relational.with_defaults(t.part, found, "p_partkey", "flag", "missing")


@query("SELECT side, k FROM (SELECT 'only_a' AS side, user_id AS k FROM events WHERE event_type='purchase' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type='error') UNION SELECT 'only_b', user_id FROM events WHERE event_type='error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type='purchase') UNION SELECT 'only_a', user_id*7 FROM events WHERE user_id % 3 = 0)")
def set_differences(t):
    """J16, J21, U09, U10 on sets that differ."""
    e = t.events.select(c("user_id").alias("k"), "event_type")
    a = e.where("event_type = 'purchase'").select("k")
    out = relational.set_difference(a, e.where("event_type = 'error'").select("k"), ["k"])
    sevens = e.where("k % 3 = 0").select((c("k") * 7).alias("k"))
    none = sevens.limit(0)
    return out.unionAll(relational.set_difference(sevens, none, ["k"])).distinct().select("side", "k")


@query("SELECT list_sort(list(DISTINCT k)) AS keys FROM (SELECT lower(trim(c_mktsegment)) AS k FROM customer UNION ALL SELECT lower(trim(p_type)) FROM part) WHERE k IS NOT NULL AND k <> ''")
def sorted_key_set(t):
    """The sorted set of the keys of two tables, which are few."""
    k = t.customer.select(F.lower(F.trim("c_mktsegment")).alias("k")).unionAll(t.part.select(F.lower(F.trim("p_type"))))
    return k.where("k is not null and k <> ''").agg(F.array_sort(F.collect_set("k")).alias("keys"))


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang, source, n_chars, lower(trim(regexp_replace(substr(text,1,40),'\\s+',' ','g'))), lower(trim(regexp_replace(text,'\\s+',' ','g'))), n_chars % 7 ORDER BY doc_id) AS rn FROM documents) WHERE rn=1""")
def dedupe_six_part(t):
    """The first of rows that agree in six parts, texts squeezed and in lower case."""
    squeezed = lambda x: F.lower(names.squeezed(x))
    keyed = t.documents.select("doc_id", "lang", "source", "n_chars", squeezed(F.substring("text", 1, 40)).alias("name"), F.sha2(squeezed(c("text")), 256).alias("body"), (c("n_chars") % 7).alias("number"))
    return relational.first_wins(keyed, ["lang", "source", "n_chars", "name", "body", "number"], "doc_id").select("doc_id")


@query("SELECT sha256(coalesce(text,'')) AS sha256, source, min(doc_id) AS doc_id FROM documents GROUP BY 1,2")
def document_dedupe(t):
    """The first document of each checksum and source."""
    d = t.documents.select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    return relational.first_wins(d, ["sha256", "source"], "doc_id")


@query("""SELECT l_returnflag, CAST(count(*) FILTER (l_linestatus='O') AS BIGINT) AS n_open, CAST(count(*) FILTER (l_quantity<10) AS BIGINT) AS n_small, round(avg(l_quantity),4) AS avg_quantity, CAST(count(*) FILTER (l_linestatus='F') AS BIGINT) AS n_filled FROM lineitem GROUP BY 1""")
def conditional_counts(t):
    """Counts under a condition, and the mix of a column."""
    mix = [F.sum((c("l_linestatus") == k).cast("bigint")).alias(n) for k, n in (("O", "n_open"), ("F", "n_filled"))]
    return t.lineitem.groupBy("l_returnflag").agg(*mix, F.sum((c("l_quantity") < 10).cast("bigint")).alias("n_small"), r(F.avg("l_quantity")).alias("avg_quantity"))


@query("SELECT CAST(count(DISTINCT c_nationkey) AS BIGINT) AS n_keys, CAST(count(DISTINCT c_acctbal) AS BIGINT) AS n_scores, count(DISTINCT c_nationkey) >= 10 AND count(DISTINCT c_acctbal) > 1 AS shown FROM customer")
def distinct_gate(t):
    """A30."""
    return validate.distinct_gate(t.customer, "c_nationkey", "c_acctbal")


@query("SELECT event_id, user_id, CASE WHEN value IS NULL OR value = 0 OR isnan(value) THEN 0.0 ELSE value END AS safe, CASE WHEN event_type IS NULL OR event_type='' THEN 'Unknown' ELSE event_type END AS label, greatest(0.0, least(1.0, value / 100)) AS share, CASE WHEN value >= 66.67 THEN 'High' WHEN value >= 33.34 THEN 'Medium' ELSE 'Low' END AS band FROM events")
def scalar_guards(t):
    """F01, F02, F30, F43."""
    return t.events.select("event_id", "user_id", coerce.num0(c("value")).alias("safe"), names.safe_label(c("event_type")).alias("label"), coerce.clamp(c("value") / 100, 0, 1).alias("share"), analytics.bands(c("value")).alias("band"))


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) * 1234.5 AS value, CASE p_size % 4 WHEN 0 THEN 'crore' WHEN 1 THEN 'lakh' WHEN 2 THEN 'km' END AS unit FROM part""")
def amounts(t):
    """values with thousands commas, currency and unit."""
    unit = F.element_at(F.array(F.lit(" crore"), F.lit(" Lakh"), F.lit(" km"), F.lit("")), (c("p_size") % 4 + 1).cast("int"))
    text = F.concat(F.lit("Rs. "), F.format_number(c("p_size") * 1234.5, 1), unit)
    return t.part.select("p_partkey", coerce.amount(text).alias("x")).select("p_partkey", "x.value", "x.unit")


@query("SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Promotion' ELSE trim(p_type) END AS label, p_brand || '|' || p_type || '|' AS key FROM part")
def label_aliases(t):
    """F05, F36, F41."""
    padded = F.concat(F.lit("  "), F.replace("p_type", F.lit(" "), F.lit("   ")), F.lit(" "))
    return t.part.select("p_partkey", names.mapped(padded, {"PROMO": "Promotion"}).alias("label"), names.document_key(c("p_brand"), c("p_type"), F.lit(None).cast("string")).alias("key"))


@query("""SELECT p_partkey, "sl._no.", length_km, progress_pct, "kind_of/part" FROM (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS "sl._no.", CAST(p_size AS VARCHAR) AS length_km, CAST(p_size % 100 AS VARCHAR) AS progress_pct, p_type AS "kind_of/part" FROM part)""")
def header_normal(t):
    """Messy headers in normal form."""
    messy = t.part.select("p_partkey", c("p_partkey").cast("string").alias("Sl. No."), c("p_size").cast("string").alias("Length (KM)"), (c("p_size") % 100).cast("string").alias(" Progress %"), c("p_type").alias("Kind  of/Part"))
    return names.normal_headers(messy)


@query("SELECT p_partkey, p_name AS name, CAST(p_retailprice AS DOUBLE) AS price, CAST(NULL AS INTEGER) AS stock, 'official' AS source_type, 'r1' AS retrieved_at FROM part")
def canonical_frame(t):
    """Aliases renamed, constants added or overwritten, then exactly the contract's columns and types."""
    raw = t.part.select("p_partkey", c("p_name").alias("title"), c("p_retailprice").cast("string").alias("price"), F.lit("x").alias("retrieved_at"))
    named = names.rename_aliases(raw, {"name": ["label", "title"]})
    full = names.with_missing(named, {"source_type": "official", "retrieved_at": "r1"}, overwrite=["retrieved_at"])
    return reshape.canonical(full, {"p_partkey": "bigint", "name": "string", "price": "double", "stock": "int", "source_type": "string", "retrieved_at": "string"})


@query("SELECT 'p_size' AS col, 'size' AS asked UNION ALL SELECT 'p_retailprice', 'tokens' UNION ALL SELECT 'p_type', 'first'")
def column_resolution(t):
    """P07-P09, on a table's schema."""
    cols = t.part.columns
    found = [(names.resolve(cols, ["size", "P-Size"]), "size"), (names.resolve_tokens(cols, ["retail", "PRICE"]), "tokens"), (names.first_present(cols, ["kind", "p_type", "p_name"]), "first")]
    return rows(t, found, "col string, asked string")


@query("SELECT c, CAST(row_number() OVER (ORDER BY c) AS BIGINT) AS n FROM (VALUES ('l_discount'),('l_extendedprice'),('l_linenumber'),('l_orderkey'),('l_partkey'),('l_quantity'),('l_tax'),('qty_text')) v(c)")
def metric_columns(t):
    """P10: numeric columns and text columns with a number, without the excluded ones."""
    df = t.lineitem.withColumn("qty_text", F.when(c("l_linenumber") == 1, F.concat(c("l_quantity").cast("string"), F.lit(""))).otherwise("n/a"))
    found = sorted(coerce.numeric_columns(df, {"l_suppkey"}))
    return rows(t, [(x, i + 1) for i, x in enumerate(found)], "c string, n bigint")


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE CAST(p_size AS DOUBLE) * 1000 END AS a, p_name AS b FROM part")
def mixed_columns(t):
    """A text column of which most cells are numbers becomes one; another stays."""
    raw = t.part.select("p_partkey", F.when(c("p_size") == 1, "NA").otherwise(F.format_number(c("p_size") * 1000, 0)).alias("a"), c("p_name").alias("b"))
    return coerce.coerce_mixed(raw)


@query("""SELECT 'part.p_size' AS metric, CAST(count(*) AS BIGINT) AS n, CAST(sum(p_size) AS DOUBLE) AS total FROM part UNION ALL SELECT 'part.retail_price', CAST(count(*) AS BIGINT), round(sum(p_retailprice),2) FROM part""")
def long_passthrough(t):
    """Tables that are long already, with normalised names."""
    one = lambda name, col: t.part.select(reshape.metric_passthrough("part", F.lit(name)).alias("metric"), c(col).cast("double").alias("value"))
    return one(" P_Size", "p_size").unionAll(one("Retail Price ", "p_retailprice")).groupBy("metric").agg(F.count("*").alias("n"), r(F.sum("value"), 2).alias("total"))


@query("SELECT o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS metric, round(sum(o_totalprice),2) AS value FROM orders WHERE year(o_orderdate) IN (1998, 1999) GROUP BY 1,2")
def year_columns_long(t):
    """Year columns found by their name, and made long."""
    wide = reshape.to_wide(t.orders.withColumn("y", F.year("o_orderdate").cast("string")), ["o_custkey"], "y", "o_totalprice", ["1998", "1999"], F.sum)
    return reshape.to_long(wide, ["o_custkey"], reshape.year_columns(wide)).where("value is not null").withColumn("value", r(c("value"), 2))


@query("""WITH x AS (SELECT conv_id, max(turn) FILTER (role='user') AS f FROM conversations GROUP BY 1), y AS (SELECT conv_id, f, (SELECT min(turn) FROM conversations d WHERE d.conv_id=x.conv_id AND d.turn>f AND d.role<>'user') AS e FROM x WHERE f IS NOT NULL)
SELECT d.conv_id, d.turn FROM conversations d JOIN y ON y.conv_id=d.conv_id WHERE d.turn>=f AND (e IS NULL OR d.turn<e)""")
def between_markers(t):
    """From the last turn of the user up to the first one after it that isn't the user's."""
    return reshape.between_markers(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", c("role") == "user", c("role") != "user").select("conv_id", "turn")


@query("""WITH p AS (SELECT s_nationkey AS panel, s_suppkey AS id, s_suppkey % 97 AS x, s_acctbal / 100 AS y FROM supplier), d AS (SELECT n_nationkey AS panel, 40.0 AS px, 50.0 AS py FROM nation),
j AS (SELECT d.panel, id, (x - px) * (x - px) + (y - py) * (y - py) AS far FROM d LEFT JOIN p ON p.panel=d.panel), r AS (SELECT panel, arg_min(id, struct_pack(a := far, b := id)) AS id, min(far) AS far FROM j WHERE far <= 300 GROUP BY 1)
SELECT d.panel, r.id, round(CAST(r.far AS DOUBLE), 6) AS distance FROM d LEFT JOIN r ON r.panel=d.panel""")
def nearest_point(t):
    """O10."""
    points = t.supplier.select(c("s_nationkey").alias("panel"), c("s_suppkey").alias("id"), (c("s_suppkey") % 97).alias("x"), (c("s_acctbal") / 100).alias("y"))
    pointers = t.nation.select(c("n_nationkey").alias("panel"), F.lit(40.0).alias("px"), F.lit(50.0).alias("py"))
    return display.nearest(points, pointers, "panel", 300).select("panel", "id", r(c("distance"), 6).alias("distance"))


@query("""SELECT n_nationkey, CAST(CASE n_nationkey % 3 WHEN 2 THEN n_nationkey ELSE 0 END AS DOUBLE) AS low, CAST(CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN n_nationkey * 2 ELSE n_nationkey + 4 END AS DOUBLE) AS high, CAST(CASE n_nationkey % 3 WHEN 0 THEN 0.5 WHEN 1 THEN n_nationkey ELSE n_nationkey + 2 END AS DOUBLE) AS middle FROM nation""")
def axis_ranges(t):
    """ranges that aren't finite, empty, and plain."""
    n = c("n_nationkey").cast("double")
    low = F.when(c("n_nationkey") % 3 == 0, F.lit(float("nan"))).otherwise(n)
    high = F.when(c("n_nationkey") % 3 == 2, n + 4).otherwise(n)
    x = display.finite_range(low, high)
    return t.nation.select("n_nationkey", x["low"].alias("low"), x["high"].alias("high"), display.ticks(x["low"], x["high"], 5)[2].alias("middle"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN CASE WHEN o_orderkey >= 1000 THEN 'large' ELSE printf('%d', o_orderkey) || 'Cr' END
ELSE CASE WHEN v >= 100000 THEN printf('%d,%02d,%03d', v // 100000, v // 1000 % 100, v % 1000) WHEN v >= 1000 THEN printf('%d,%03d', v // 1000, v % 1000) ELSE printf('%d', v) END || CASE WHEN o_orderkey % 5 = 3 THEN '.5' ELSE '' END END AS text FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)""")
def number_texts(t):
    """F42."""
    kind, whole = c("o_orderkey") % 5, F.floor("o_totalprice").cast("double")
    value = F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, c("o_orderkey") * 1e7).when(kind == 3, whole + 0.5).otherwise(whole)
    return t.orders.select("o_orderkey", F.when((kind == 1) & (c("o_orderkey") >= 1000), "large").otherwise(display.number_text(value)).alias("text"))


@query("SELECT page_id, url, 'https://a.org/my%20file%20' || page_id || '.csv' AS file FROM pages")
def unescaped_urls(t):
    """F18, F19."""
    escaped = F.replace("url", F.lit("/"), F.lit("\\u002F"))
    return t.pages.select("page_id", names.unescaped(escaped).alias("url"), names.file_url(F.concat(F.lit(" https://a.org/my file "), c("page_id").cast("string"), F.lit(".csv "))).alias("file"))
