"""Rules as data and table functions."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewell.operators import rulebook, tablefunctions, validate


def lines(*rows):
    return [rulebook.Line(*r) for r in rows]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([("a", 1, 2.0), ("a", 1, None), ("b", -1, 3.0), (None, 5, 9.0)], "k string, n int, x double")


def test_scopes(spark, table):
    rules = lines(("neg", "row", "error", "n < 0"), ("x_there", "row", "warning", "x is null"), ("one_row", "key k, n", "error", "count(*) > 1"), ("small", "key k", "error", "sum(n) < 3"), ("rows", "table", "error", "count(*) <> 4"), ("spread", "table", "warning", "max(x) - min(x) > 5"), ("null_is_kept", "row", "error", "x > 100"))
    loaded = rulebook.load(rulebook.table_of(spark, rules))
    assert loaded == sorted(rules, key=lambda r: r.rule_id)
    got = {r.rule_id: (r.n_bad, r["first"]) for r in rulebook.check(table, loaded, entity="k").collect()}
    assert got == {"neg": (1, "b"), "x_there": (1, "a"), "one_row": (1, "a::1"), "small": (2, "a"), "rows": (0, None), "spread": (1, None), "null_is_kept": (0, None)}
    assert {(r.rule_id, r.entity) for r in rulebook.findings(table, loaded).collect()} == {("one_row", "a::1"), ("small", "a"), ("small", "b")}
    empty = {r.rule_id: r.n_bad for r in rulebook.check(table.limit(0), loaded, entity="k").collect()}
    assert empty == {"neg": 0, "x_there": 0, "one_row": 0, "small": 0, "rows": 1, "spread": 0, "null_is_kept": 0}
    with pytest.raises(ValueError):
        validate.gate(rulebook.check(table, loaded).where("n_bad > 0"))


def test_rules_that_do_not_fit(spark, table):
    bad = lines(("no_column", "row", "error", "missing > 1"), ("no_sql", "row", "error", "n >"), ("number", "row", "error", "n + 1"), ("fine", "row", "error", "n > 1"), ("no_key", "key zz", "error", "count(*) > 1"), ("aggregate", "row", "error", "count(*) > 1 and n > 1"))
    found = [p.split(":")[0] for p in rulebook.problems(table, bad)]
    assert {"no_column", "no_sql", "number", "no_key"} <= set(found) and "fine" not in found
    with pytest.raises(ValueError, match="no_column"):
        rulebook.check(table, bad)
    for row in (("a", "cell", "error", "n > 1"), ("a", "row", "fatal", "n > 1"), ("a", "row", "error", None), ("a", "key ", "error", "true")):
        with pytest.raises(ValueError):
            rulebook.load(rulebook.table_of(spark, lines(row)))
    with pytest.raises(ValueError):
        rulebook.load(rulebook.table_of(spark, lines(("a", "row", "error", "n > 1"), ("a", "row", "error", "n > 2"))))


def test_pairs(spark):
    rows = [("A", "c", 10.0, "d"), ("A", "l", 1000.0, "d"), ("B", "c", 151.0, "d"), ("B", "l", 25001.0, "d"), ("C", "c", 2.5, "d"), ("C", "l", 5.0, ""), ("D", "c", 0.0, "d"), ("D", "l", 7.0, None), ("E", "c", 3.0, "e"), ("E", "c", 3.0, "d"), ("X", "c", 1.0, "d"), ("X", "l", 6000.0, "d")]
    df = spark.createDataFrame(rows, "entity string, metric string, value double, as_of string")
    expected = spark.createDataFrame([(e,) for e in "ABCDEF"], "entity string")
    both = rulebook.with_references(df, {"expected": expected}, "entity")
    got = {r.rule_id: (r.n_bad, r["first"]) for r in rulebook.check(both, rulebook.pair_rules("c", "l")).collect()}
    assert got == {
        "pair_rows": (1, "E::c"), "expected_missing": (1, "F"), "unexpected": (1, "X"), "coverage": (1, "E"), "single_as_of": (1, None), "paired_values": (1, "E"), "positive": (1, "D"),
        "whole_count": (1, "C"), "count_cap": (1, "B"), "length_cap": (1, "B"), "ratio": (2, "C"),
    }
    clean = rulebook.with_references(df.where("entity = 'A'"), {"expected": expected.where("entity = 'A'")}, "entity")
    assert {r.n_bad for r in rulebook.check(clean, rulebook.pair_rules("c", "l")).collect()} == {0}


def test_table_functions(spark):
    def parse(text):
        for i, w in enumerate(text.split()):
            if w == "stop":
                raise KeyError("stop")
            yield {"i": i, "w": w, "more": 1}

    tablefunctions.register(spark, "words_of", parse, "i int, w string")
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "x stop y"), (4, "stop")], "k int, t string")
    got = [tuple(r) for r in spark.sql("SELECT k, w.* FROM {df}, LATERAL words_of(t) w", df=df).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, "a", None), (1, 1, "b", None), (3, 0, "x", None), (3, None, None, "KeyError: 'stop'"), (4, None, None, "KeyError: 'stop'")], key=str)
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM words_of(3)").collect()

    def joined(rows):
        if rows[0]["k"] == 2:
            raise ValueError("two")
        return [{"text": "".join(r["w"] for r in rows), "n": len(rows)}]

    tablefunctions.register_grouped(spark, "joined_words", joined, "text string, n int", "k", "at")
    words = spark.createDataFrame([(1, 3, "c"), (2, 1, "x"), (1, 1, "a"), (None, 1, "n"), (1, 2, "b")], "k int, at int, w string").repartition(4)
    got = [tuple(r) for r in spark.sql("SELECT * FROM joined_words(TABLE({w}))", w=words).collect()]
    assert sorted(got, key=str) == sorted([(1, "abc", 3, None), (2, None, None, "ValueError: two"), (None, "n", 1, None)], key=str)
    assert spark.sql("SELECT * FROM joined_words(TABLE({w}))", w=words.limit(0)).count() == 0
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM joined_words(TABLE({w}))", w=words.select("k", F.col("w").alias("z"))).collect()
    with pytest.raises(ValueError):
        tablefunctions.register(spark, "clash", parse, "error string")
