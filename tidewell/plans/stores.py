"""Queries that go through files: views, drop folders, partitioned stores, checksums, inventories, manifests and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import validate
from ..sources import catalog, io
from .base import query

c = F.col


def _folder(t, name: str) -> str:
    return f"{io.scratch_dir(t._spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1")
def view_by_alias(t):
    """A file under the alias of its path, from SQL."""
    name = io.as_view(t._spark, f"{t._dir}/part.parquet")
    return t._spark.sql(f"SELECT p_brand, count(*) AS n, sum(p_size) AS size FROM {name} GROUP BY p_brand")


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 3 <> 2 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey AS VARCHAR) END AS nation_no FROM customer")
def drop_folder(t):
    """All that lies in a drop folder for one source: text, JSON and Parquet with different columns."""
    root = _folder(t, "drop")
    key, third = c("c_custkey").cast("string").alias("Key"), lambda i: t.customer.where(c("c_custkey") % 3 == i)
    third(0).select(key, c("c_name").alias("Name")).write.option("header", True).csv(f"{root}/s1.csv")
    row = F.struct(key, c("c_name").alias("name"), c("c_nationkey").cast("string").alias("Nation No"))
    documents = third(1).groupBy((c("c_custkey") % 7).alias("file")).agg(F.to_json(F.collect_list(row)).alias("value"))  # a JSON list a file
    documents.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/s1.json")
    third(2).select(key, c("c_mktsegment").alias("segment")).write.parquet(f"{root}/s1_later.parquet")
    assert io.first_existing(t._spark, [f"{root}/none.csv", f"{root}/s1.json"]).endswith("s1.json")
    return io.manual(t._spark, root, "s1").select("key", "name", "segment", "nation_no")


@query("SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS customer FROM orders")
def partitioned_store(t):
    """A store by status, of which the second half has a column more."""
    root = _folder(t, "store")
    half = lambda i, *cols: t.orders.where(c("o_orderkey") % 2 == i).select("o_orderkey", c("o_orderstatus").alias("status"), c("o_totalprice").alias("price"), *cols)
    io.write(half(0), f"{root}/a", by=("status",))
    io.write(half(1, c("o_custkey").alias("customer")), f"{root}/b", by=("status",))
    parts = [t._spark.read.option("basePath", f"{root}/{x}").parquet(f"{root}/{x}") for x in "ab"]
    whole = io.merged(t._spark, root)
    assert set(whole.columns) == {"o_orderkey", "price", "customer"}  # without the folders' column
    return io.union_by_name(parts).select("o_orderkey", "status", "price", "customer")


@query("SELECT n_nationkey, CAST(octet_length(encode(n_name)) + 1 AS BIGINT) AS size_bytes, sha256(n_name || chr(10)) AS sha256, '/moved/n=' || n_nationkey AS folder FROM nation")
def file_checksums(t):
    """Sizes and checksums of the files below a folder, and their paths below another one."""
    root = _folder(t, "files")
    t.nation.select(c("n_nationkey").alias("n"), c("n_name").alias("value")).repartition("n").write.partitionBy("n").text(root)
    found = io.checksums(t._spark, root).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    path = io.rebased(c("path"), root.replace("file:///", "/").replace("file:/", "/"), "/moved")
    return found.select(F.regexp_extract("path", r"/n=(\d+)/", 1).cast("bigint").alias("n_nationkey"), "size_bytes", "sha256", F.regexp_extract(path, "^(.*)/", 1).alias("folder")).withColumn("n_nationkey", c("n_nationkey").cast("int"))


@query("SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT NULL, 'none:stubbed:0'")
def first_readable(t):
    """The first reader that gives rows, a query that can't be analysed, and the row of a source without input."""
    root, schema = _folder(t, "json"), "k int, name string"
    t.region.select(c("r_regionkey").cast("int").alias("k"), c("r_name").alias("name")).write.json(root)
    found = io.first_non_empty([lambda: io.table(t._spark, f"{root}/missing"), lambda: io.read_json(t._spark, f"{root}/none.json", schema), lambda: None, lambda: t._spark.read.schema(schema).json(root)])
    broken = io.safe(t._spark, lambda: t.region.select("no_such_column"), schema)
    empty = io.placeholder(t._spark, "none", "stubbed").select(F.lit(None).cast("int").alias("k"), F.concat_ws(":", "source_id", "status", "row_count").alias("name"))
    return found.unionAll(broken).unionAll(empty)


@query("SELECT 'n' || n_nationkey AS source_id, n_regionkey > 0 AS official, n_name AS theme, ['key', lower(n_name)] AS columns, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def inventory_document(t):
    """The descriptors of 25 sources as one document, and back as a table."""
    path = _folder(t, "inventory")
    sources = [catalog.Source(f"n{r.n_nationkey}", r.n_regionkey > 0, r.n_name, columns=("key", r.n_name.lower()), extra={"region": r.n_regionkey}) for r in t.nation.limit(1000).collect()]
    catalog.write_inventory(t._spark, sources, path, "2026-01-01")
    back = catalog.sources_table(t._spark, catalog.read_inventory(t._spark, path))
    return back.select("source_id", "official", "theme", "columns", c("extra")["region"].alias("region"))


@query("SELECT o_orderpriority AS source_id, count(*) AS row_count, round(1 - count(*) FILTER (WHERE o_orderkey % 4 = 0) / (2.0 * count(*)), 3) AS completeness, 'ok' AS status FROM orders GROUP BY 1")
def manifest_folders(t):
    """A manifest for each source, a folder a source, and all of them read back."""
    path = _folder(t, "manifests")
    priorities = [r[0] for r in t.orders.select("o_orderpriority").distinct().limit(100).collect()]
    of = lambda p: t.orders.where(c("o_orderpriority") == p).select("o_orderkey", F.when(c("o_orderkey") % 4 != 0, c("o_totalprice")).alias("price"))
    catalog.write_manifests(io.union_by_name([catalog.manifest(of(p), catalog.Source(p), "ok") for p in priorities]), path)
    return t._spark.read.schema("theme string, official boolean, status string, row_count bigint, columns array<string>, completeness double, source_id string").json(path).select("source_id", "row_count", "completeness", "status")


@query(r"SELECT '| n_nationkey | n_name | extra |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' | a\|b |', chr(10) ORDER BY n_nationkey) FILTER (WHERE n_nationkey < 9) || chr(10) || (count(*) - 9) || ' further rows' AS report FROM nation")
def markdown_report(t):
    """A report with the first rows of a table."""
    text = catalog.markdown(t.nation.select("n_nationkey", "n_name", F.lit("a|b").alias("extra")).orderBy("n_nationkey"), 9)
    return t.nation.agg(F.lit(text).alias("report"))


@query("SELECT l_returnflag, CAST(max(CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END) AS INTEGER) AS code, CAST(max(CASE WHEN l_tax > 0.07 OR l_discount > 0.09 THEN 1 ELSE 0 END) AS INTEGER) AS strict FROM lineitem GROUP BY 1")
def exit_codes(t):
    """The exit code of each group's findings, plain and strict."""
    flags = [r[0] for r in t.lineitem.select("l_returnflag").distinct().limit(100).collect()]
    severity = F.when(c("l_tax") > 0.07, "error").when(c("l_discount") > 0.09, "warning").otherwise("ok")
    codes = [(f, *(validate.exit_code(t.lineitem.where(c("l_returnflag") == f).select(severity.alias("severity")), strict) for strict in (False, True))) for f in flags]
    known = F.create_map(*[x for f, *v in codes for x in (F.lit(f), F.array(*map(F.lit, v)))])
    return t.lineitem.select("l_returnflag").distinct().select("l_returnflag", known[c("l_returnflag")][0].alias("code"), known[c("l_returnflag")][1].alias("strict"))
