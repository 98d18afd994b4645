"""Positions, moments, bucketed tables and documents."""

import json
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import moments, ordering
from tidewell.sources import buckets, documents

c = F.col


def test_global_index(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), None if k == 3 else float(k % 5), f"s{k % 3}") for k in rng.integers(0, 40, 900)] + [(7, 2.0, "s1")] * 300
    df = spark.createDataFrame(rows, "k int, x double, s string").repartition(6)
    for parts in (1, 9):
        got = ordering.global_index(df, c("k").desc(), c("x").asc_nulls_last(), partitions=parts).collect()
        assert sorted(r.row_index for r in got) == list(range(1200))
        assert [r.k for r in sorted(got, key=lambda r: r.row_index)] == sorted((k for k, _, _ in rows), reverse=True)
        assert Counter((r.k, r.x, r.s) for r in got) == Counter(rows)
    # one value holds a quarter of the rows and still goes to several partitions
    dealt = ordering.global_index(df, F.lit(1), partitions=8).withColumn("p", F.input_file_name()).groupBy("p").count().collect()
    assert max(r["count"] for r in dealt) < 800
    assert ordering.global_index(df.limit(0), c("k")).count() == 0
    plan = ordering.global_index(df, c("k"))._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_index_in_key_of_any_size(spark):
    rows = [(None if i % 11 == 0 else i % 3, i) for i in range(500)] + [(1, i) for i in range(1000, 1800)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = ordering.index_in_key(df, ["k"], c("v").desc(), partitions=7).collect()
    want = {}
    for k in {k for k, _ in rows}:
        for i, v in enumerate(sorted((v for q, v in rows if q == k), reverse=True)):
            want[(k, v)] = i
    assert {(r.k, r.v): r.row_index for r in got} == want and len(got) == len(rows)


def test_deal_and_shard_findings(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"t{i}") for i in range(101)], "k int, t string")
    shards = ordering.deal(df, 4, c("k"))
    assert {(r.k, r.shard, r.shard_row) for r in shards.collect()} == {(i, i % 4, i // 4) for i in range(101)}
    assert {(r.k, r.row_index) for r in ordering.undealt(shards, 4).collect()} == {(i, i) for i in range(101)}
    assert ordering.shard_findings(shards, 101, 4).count() == 0
    broken = shards.where("shard <> 2 and not (shard = 1 and shard_row = 5)").unionAll(shards.where("shard = 3 and shard_row = 0"))
    found = {(r.shard, r.rule): (r.found, r.wanted) for r in ordering.shard_findings(broken, 101, 4).collect()}
    assert found == {(2, "row_count"): (0, 25), (1, "row_count"): (24, 25), (3, "row_count"): (26, 25), (1, "row_order"): (25, 24), (3, "row_order"): (25, 26)}
    assert sorted(r.k for r in ordering.every_nth(df, 6, c("k")).collect()) == list(range(0, 101, 16))
    assert ordering.every_nth(df.limit(3), 6, c("k")).count() == 3


def _long(spark, rng, years, metrics=30):
    rows = []
    for e in range(12):
        for y in years:
            for m in range(metrics):
                if rng.random() < 0.6:
                    v = 5.0 if m == 3 else float(rng.normal() * 10 + (y if m % 2 else e)) if m != 7 else 1e9 + e
                    rows.append((f"e{e}", y, f"m{m:02d}", v))
    rows += [("e0", years[0], "m01", 4.0), ("e0", years[0], "m01", None), (None, years[0], "m02", 1.0), ("e1", None, "m02", 1.0), ("e1", years[0], None, 1.0), ("e2", years[0], "lone", 1.0), ("e3", years[0], "m04", float("nan"))]
    return spark.createDataFrame(rows, "entity string, year int, metric string, value double"), rows


def corr_by_brute_force(rows):
    cells = {}
    for e, y, m, v in rows:
        if None not in (e, y, m, v):
            cells.setdefault((e, y, m), []).append(v)
    by = {}
    for (e, y, m), vs in cells.items():
        v = sum(vs) / len(vs)
        if v == v:
            by.setdefault(m, {})[(e, y)] = v
    out = {}
    for a in by:
        for b in by:
            both = sorted(by[a].keys() & by[b].keys())
            if a < b and len(both) >= 2:
                x, z = [by[a][k] for k in both], [by[b][k] for k in both]
                if len(set(x)) > 1 and len(set(z)) > 1:
                    out[(a, b)] = (float(np.corrcoef(x, z)[0, 1]), len(both), min(y for _, y in both), max(y for _, y in both))
    return out


@pytest.mark.parametrize("blocks", [1, 3])
def test_moments(spark, blocks):
    rng = np.random.default_rng(3)
    old, rows_a = _long(spark, rng, [2001, 2002, 2003])
    new, rows_b = _long(spark, rng, [2010])
    sources = spark.createDataFrame([("m00", "s1"), ("m00", "s2"), ("m01", "s1")], "metric string, source_id string")
    first, later = (moments.moments(moments.cells(x), blocks, at_once=5) for x in (old.repartition(3), new))
    for table, rows in ((first, rows_a), (moments.merged([first, later]), rows_a + rows_b)):
        got = moments.correlations(table, sources=sources, created_at="2026-01-01").collect()
        want = corr_by_brute_force(rows)
        assert {(r.metric_a, r.metric_b) for r in got} == set(want) and len(got) == len(want)
        for r in got:
            value, n, lo, hi = want[(r.metric_a, r.metric_b)]
            assert abs(r.correlation - value) < 2e-6 and (r.overlap_records, r.year_min, r.year_max) == (n, lo, hi)
            assert r.source_a == {"m00": "s2", "m01": "s1"}.get(r.metric_a) and r.method == moments.METHOD and r.created_at == "2026-01-01"
    assert moments.correlations(first, min_overlap=10**6).count() == 0
    assert moments.correlations(moments.moments(moments.cells(old.limit(0)), blocks)).count() == 0


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_bucketed_upsert(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k bigint, v string, at int"
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    one = spark.createDataFrame([(i, f"a{i}", 0) for i in range(200)] + [(None, "null key", 0)], schema)
    assert buckets.read(spark, path, schema).count() == 0
    assert buckets.upsert(spark, path, one, ["k"], buckets=16) == list(range(16))
    assert rows(buckets.read(spark, path, schema)) == rows(one)
    before = _files(path)
    two = spark.createDataFrame([(5, "older", 1), (5, "newer", 2), (900, "new", 1), (None, "null again", 1)], schema)
    touched = buckets.upsert(spark, path, two, ["k"], c("at").desc(), c("v"), buckets=16)
    assert 1 <= len(touched) <= 3
    want = rows(one) - Counter([(5, "a5", 0), (None, "null key", 0)]) + Counter([(5, "newer", 2), (900, "new", 1), (None, "null again", 1)])
    assert rows(buckets.read(spark, path, schema)) == want
    after = _files(path)
    untouched = [f for f in before if not any(f"bucket={b}/" in f for b in touched)]
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert buckets.upsert(spark, path, two, ["k"], c("at").desc(), c("v"), buckets=16) == touched
    assert rows(buckets.read(spark, path, schema)) == want
    assert buckets.upsert(spark, path, two.limit(0), ["k"], buckets=16) == []
    # a new column, and one that the entries lack
    buckets.upsert(spark, path, spark.createDataFrame([(6, 1.5)], "k bigint, w double"), ["k"], buckets=16)
    got = {r.k: (r.v, r.w) for r in buckets.read(spark, path, "k bigint, v string, w double").where("k in (6, 7)").collect()}
    assert got == {6: (None, 1.5), 7: ("a7", None)}
    gone = buckets.delete(spark, path, spark.createDataFrame([(i,) for i in range(200) if i != 7], "k bigint"), ["k"], buckets=16)
    assert len(gone) == 16 and {r.k for r in buckets.read(spark, path, schema).collect()} == {7, 900, None}
    with pytest.raises(ValueError):
        buckets.upsert(spark, path, one.withColumn("bucket", F.lit(1)), ["k"])


def test_upsert_that_was_cut_off(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k bigint, v string"
    buckets.upsert(spark, path, spark.createDataFrame([(i, "a") for i in range(50)], schema), ["k"], buckets=4)
    entries = spark.createDataFrame([(i, "b") for i in range(10)], schema)

    def broken(*_):
        raise OSError("cut off")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_replace", broken)
        with pytest.raises(OSError):
            buckets.upsert(spark, path, entries, ["k"], buckets=4)
    count = lambda: Counter(r.v for r in buckets.read(spark, path, schema).collect())
    assert count() == {"a": 50}
    # the next upsert finishes it first; what has no mark of success is dropped
    os.makedirs(f"{path}/_pending/half/bucket=0")
    buckets.upsert(spark, path, entries.limit(0), ["k"], buckets=4)
    assert count() == {"a": 40, "b": 10} and not os.listdir(f"{path}/_pending")


def test_documents(spark, tmp_path):
    path, schema = str(tmp_path / "d"), "source_id string, n bigint, note string"
    df = spark.createDataFrame([(f"s{i}", i, None if i % 2 else 'q"\n') for i in range(30)], schema).repartition(4)
    documents.write(df, path, generated_at="2026-01-01", version="1")
    known = documents.manifest(spark, path)
    assert known["row_count"] == 30 and known["generated_at"] == "2026-01-01" and known["rows"] == "datasets"
    assert Counter(tuple(r) for r in documents.read(spark, path, schema, verify=True).collect()) == Counter(tuple(r) for r in df.collect())
    documents.single(spark, path, str(tmp_path / "one" / "catalog.json"))
    text = json.load(open(tmp_path / "one" / "catalog.json"))
    assert len(text["datasets"]) == 30 and text["version"] == "1" and os.listdir(tmp_path / "one") == ["catalog.json"]
    with pytest.raises(ValueError):
        documents.single(spark, path, str(tmp_path / "two.json"), most=10)
    # a write that fails leaves the document as it was, and nothing else
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="."):
        documents.write(df.select("source_id", (F.when(c("n") < 29, c("n")).otherwise(F.raise_error(F.lit("broken")).cast("bigint"))).alias("n")), path)
    assert sorted(os.listdir(path)) == before and documents.read(spark, path, schema).count() == 30
    documents.write(df.limit(0), path, field="items")
    assert documents.read(spark, path, schema).count() == 0 and documents.manifest(spark, path)["rows"] == "items"
    assert [f for f in os.listdir(path) if f.startswith(("part-", "_part-"))] == [p["name"] for p in documents.manifest(spark, path)["parts"]]
    documents.write(df, path)
    part = next(p["name"] for p in documents.manifest(spark, path)["parts"] if p["rows"])
    with open(os.path.join(path, part), "a") as f:
        f.write("{}\n")
    with pytest.raises(ValueError):
        documents.read(spark, path, schema, verify=True)


def test_manifest_of_a_write(spark, tmp_path):
    from tidewell.sources import catalog, io

    df = spark.createDataFrame([(i, None if i % 3 else f"v{i:02d}", {"a": i}) for i in range(40)], "k int, v string, m map<string,int>").repartition(3).dropDuplicates(["k"])
    source, path = catalog.Source("s", theme="t"), str(tmp_path / "s")
    got = catalog.written(df, path, source, "ok", stats=True).collect()
    want = catalog.manifest(io.table(spark, path), source, "ok").collect()
    assert [tuple(r)[:-1] for r in got] == [tuple(r) for r in want]
    assert [tuple(s) for s in got[0].stats] == [("k", 0, "0", "39"), ("v", 26, "v00", "v39"), ("m", 0, None, None)]
    empty = catalog.written(df.limit(0), str(tmp_path / "e"), source, "ok", stats=True).first()
    assert (empty.row_count, empty.completeness) == (0, 0.0) and empty.stats[1].nulls == 0 and empty.stats[1].min is None


def test_best_rows_in_any_order(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k bigint, at int"
    put = lambda rows: buckets.upsert(spark, path, spark.createDataFrame(rows, schema), ["k"], c("at").desc(), buckets=4, best=True)
    for rows in ([(1, 5), (2, 1)], [(1, 3), (2, 7), (3, 0)], [(1, 5), (2, 1)]):
        put(rows)
    assert sorted(tuple(r) for r in buckets.read(spark, path, schema).collect()) == [(1, 5), (2, 7), (3, 0)]


def test_stream_into_buckets(spark, tmp_path):
    from tidewell.streaming.events import upsert_buckets

    schema = "k bigint, at int"
    given, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(([(1, 9), (2, 2)], [(1, 1), (3, 3)], [(2, 8)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(given)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(given)
        upsert_buckets(stream, f"{out}/rows", f"{out}/checkpoint", ["k"], c("at").desc(), buckets=2).awaitTermination()
    assert sorted(tuple(r) for r in buckets.read(spark, f"{out}/rows", schema).collect()) == [(1, 9), (2, 8), (3, 3)]
