"""Queries and sources beyond the size of the test tables, and sums that only just meet a threshold (round 3)."""

import duckdb
import pytest

from tidewell.plans import registry
from tidewell.sources import io


def hundreds(offset: int, limit: int) -> list[str]:
    """The pages of an endpoint with 230,500 records."""
    return [f"{i}" for i in range(offset, min(offset + limit, 230_500))]


def test_pages_beyond_all_bounds(spark):
    spark.dataSource.register(io.PagedSource)
    read = lambda **o: spark.read.format("tidewell_pages").options(fetch="tests.test_sizes.hundreds", limit="100", **o).load()
    for bounds in ({"pages": "all", "last_offset": "all"}, {"pages": "all", "last_offset": "all", "total": "230500"}):
        got = read(**bounds)
        assert got.rdd.getNumPartitions() <= io.PAGE_TASKS and got.count() == got.distinct().count() == 230_500
    assert read(pages="all").count() == 200_100 and read(pages="3", last_offset="299").count() == 300
    with pytest.raises(Exception, match="pages"):
        read().count()


def test_paged_source_of_many_pages(spark, tmp_path):
    rows = spark.range(20_450).selectExpr("id as c_custkey", "'n' || id as c_name", "'m' as c_mktsegment")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    got = registry.QUERIES["paged_source"](spark, str(tmp_path))
    assert got.count() == 20_450 and got.exceptAll(rows).count() == 0


def test_extraction_factors_at_thresholds(spark, tmp_path):
    rows = [(1, "click" if i < 3 else "view", 56.25) for i in range(30)]  # a share of failed rows of just 0.02
    rows += [(2, "error" if i < 3 else "view", 38.65) for i in range(20)]  # of low ones 0.15; the score is a tie
    rows += [(u, "view", u / 100 + 0.05) for u in range(10_000, 10_200)]
    spark.createDataFrame(rows, "user_id bigint, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    got = {r.user_id: (r.score, r.n_reasons) for r in registry.QUERIES["extraction_factors"](spark, str(tmp_path)).collect()}
    assert got == {r[0]: r[1:] for r in con.execute(registry.SQL["extraction_factors"]).fetchall()}
    assert got[1] == (0.563, 1) and got[2] == (0.307, 2)


def test_words_are_joined_by_shuffles(spark):
    from tidewell.llm import spelling

    words = spark.createDataFrame([("bridges", 9), ("bridgse", 2), ("bridged", 2), ("bridge", 5)], "word string, n bigint")
    pairs = spelling.near_pairs(words)
    assert {(r.a, r.b) for r in pairs.collect()} == {("bridge", "bridges"), ("bridge", "bridgse"), ("bridge", "bridged"), ("bridged", "bridges")}
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_page_rows_in_bounded_tasks(spark, monkeypatch):
    from tidewell.operators import harvest

    monkeypatch.setattr(harvest, "TASK_LINES", 50)
    lines = spark.range(3_000).selectExpr("id div 6 as doc_id", "cast(id div 2 % 3 as int) as page_no", "cast(id % 2 as int) as line_no", "'Cost of part: Rs. ' || id as line")
    out = harvest.page_rows(lines)
    per_task = [len(x) for x in out.select("doc_id").rdd.glom().collect()]
    assert sum(per_task) == 3_000 and max(per_task) <= 200 and len(per_task) >= 60
    assert out.where("value <> doc_id * 6 + row_no").count() == 0


def test_full_sets_are_shuffled_once(spark, monkeypatch):
    from tidewell.llm import near_dup

    names, kept = [], near_dup.staged
    monkeypatch.setattr(near_dup, "staged", lambda df, name: names.append(name) or kept(df, name))
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(words), " ".join(words[:85]), " ".join(words[:60] + ["other"] * 9), " ".join(words[::-1]), None]
    got = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), 2)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(0, 0), (1, 0), (2, 2), (3, 3), (4, 4)}
    assert "links" in names and "sets" not in names


def test_full_sets_travel_as_texts(spark, monkeypatch):
    """Half of the sets' hashes or less is moved, and the sets are the same, however few texts are unpacked at a time."""
    import numpy as np
    from pyspark.sql import functions as F

    from tidewell.llm import near_dup

    r = np.random.default_rng(5)
    texts = [" ".join(f"Wo{r.integers(0, 300)}" for _ in range(int(r.integers(1, 600)))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = near_dup.sketches(docs, 2, 64)
    classes = near_dup.staged(rows.groupBy("n", "s1", "s2", "c").agg(F.min("doc_id").alias("first")), "classes")
    got = near_dup.full_sets(docs, classes, classes.select("c"), 2).join(classes, "c").select("first", "n", "own").toArrow()
    own, n = got.column("own"), got.column("n").to_pylist()
    assert len(n) == 40 and sum(len(x.as_py()) for x in own) < 4 * sum(n)
    twice = [x for x in own for _ in range(2)]
    for size in (near_dup._SLICE, 1000):
        monkeypatch.setattr(near_dup, "_SLICE", size)
        sets = list(near_dup._unpacked(twice, 2))
        assert len(sets) == 80
        for i, at in enumerate(got.column("first").to_pylist()):
            want = near_dup.shingle_sets([texts[at]], 2)[0]
            assert (sets[2 * i] == want).all() and (sets[2 * i + 1] == want).all() and len(want) == n[i]


def test_pairs_by_chance_move_no_sketches(spark):
    """Every pair that is similar enough stays, unrelated ones go, and only bit maps of their sketches are shuffled."""
    import numpy as np
    from pyspark.sql import functions as F

    from tidewell.llm import near_dup

    r, sets = np.random.default_rng(6), []
    for i in range(60):
        base = [f"b{i}x{j}" for j in range(int(r.choice([10, 30, 50, 55, 63, 64, 65, 70, 90, 300])))]
        sets += [base, base[: int(len(base) * r.uniform(0.7, 0.95))] if i % 2 else base + [f"z{i}y{j}" for j in range(int(len(base) * r.uniform(0.05, 0.4)))]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(sets)], "doc_id bigint, text string")
    classes = near_dup.staged(near_dup.sketches(docs, 1, 64).select("c", "n", "sketch", F.col("doc_id").alias("first")), "classes")
    pairs = near_dup.staged(classes.select(F.col("c").alias("a")).join(classes.select(F.col("c").alias("b"))).where("a < b"), "pairs")
    near = near_dup._estimated(pairs, classes, 64, 80)
    name = {x.c: x.first for x in classes.select("c", "first").collect()}
    met = {tuple(sorted((name[x.a], name[x.b]))) for x in near.collect()}
    alike = {(2 * i, 2 * i + 1) for i in range(60) if 100 * len({*sets[2 * i]} & {*sets[2 * i + 1]}) >= 80 * len({*sets[2 * i]} | {*sets[2 * i + 1]})}
    assert len(alike) > 25 and alike <= met and all(x // 2 == y // 2 for x, y in met)
    assert "array_union" not in near._jdf.queryExecution().optimizedPlan().toString()
