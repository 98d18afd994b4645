"""Rules as data (V01-V12, V15-V17, A27): a table of rules, checked and compiled to one aggregate for each scope.

A rule has an id, a scope, an expression in SQL that is true where it is broken (null: kept), and
a severity. Scopes: `row`, for each row; `key a, b`, for the rows of each key, with aggregate
functions; `table`, for all rows, with aggregate functions. Expressions may name the table's
columns, and `in_<name>` and `in_data` for reference tables whose keys are compared with it.

All rules of a scope are one aggregate over one scan: for each rule, how many rows or keys break
it, and the first of them by name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("rule_id", "scope", "severity", "expression")


@dataclass(frozen=True)
class Line:
    rule_id: str
    scope: str
    severity: str
    expression: str

    @property
    def keys(self) -> list[str]:
        return [k.strip() for k in self.scope.removeprefix("key").split(",") if k.strip()] if self.scope.startswith("key") else []


#: The rules of a snapshot of pairs (V11) with the columns entity, metric, value and as_of:
#: two metrics for each entity, a count and a length, and what each pair must satisfy.
PAIRS = (
    ("pair_rows", "key entity, metric", "error", "count(*) <> 1 and max(in_data)"),
    ("expected_missing", "key entity", "error", "max(in_expected) and not max(in_data)"),
    ("unexpected", "key entity", "error", "max(in_data) and not max(in_expected)"),
    ("coverage", "key entity", "error", "max(in_data) and not (count_if(metric = '{count}') > 0 and count_if(metric = '{length}') > 0)"),
    ("single_as_of", "table", "error", "count(distinct nullif(as_of, '')) <> 1"),
    ("paired_values", "key entity", "error", "max(in_data) and (max({c}) is null or max({l}) is null)"),
    ("positive", "key entity", "error", "max({c}) <= 0 or max({l}) <= 0"),
    ("whole_count", "key entity", "error", "abs(max({c}) - round(max({c}))) > 0.001"),
    ("count_cap", "key entity", "error", "max({c}) > 150"),
    ("length_cap", "key entity", "error", "max({l}) > 25000"),
    ("ratio", "key entity", "error", "max({c}) > 0 and max({l}) > 0 and not (max({l}) / greatest(max({c}), 1.0) between 5 and 5000)"),
)


def pair_rules(count: str, length: str) -> list[Line]:
    """The rules of pairs for the names of the two metrics."""
    of = lambda m: f"if(metric = '{m}', value, null)"
    return [Line(i, s, v, e.format(count=count, length=length, c=of(count), l=of(length))) for i, s, v, e in PAIRS]


def load(rules: DataFrame) -> list[Line]:
    """The rules of a table with the columns rule_id, scope, severity and expression, by id; an error
    if one is missing, repeated, or of an unknown scope or severity."""
    lines = [Line(*(r[c] for c in COLUMNS)) for r in rules.select(*COLUMNS).orderBy("rule_id").toLocalIterator()]
    ids = [x.rule_id for x in lines]
    for x in lines:
        known = x.scope in ("row", "table") or (x.scope or "").startswith("key ") and x.keys
        if None in (x.rule_id, x.scope, x.severity, x.expression) or ids.count(x.rule_id) > 1 or not known or x.severity not in ("error", "warning"):
            raise ValueError(f"not a rule: {x}")
    return lines


def table_of(spark: SparkSession, lines: Sequence[Line]) -> DataFrame:
    """Rules as a table that load() reads."""
    return spark.createDataFrame([tuple(getattr(x, c) for c in COLUMNS) for x in lines], ", ".join(f"{c} string" for c in COLUMNS))


def with_references(df: DataFrame, references: Mapping[str, DataFrame], key: str) -> DataFrame:
    """df and a row for each reference key that it lacks (its other columns null), with in_data and an in_<name> for each reference table."""
    out = df.withColumn("in_data", F.lit(True))
    for name, other in references.items():
        keys = other.select(F.col(key).alias("_key")).where("_key is not null").distinct()
        joined = out.join(keys, out[key] == keys["_key"], "full_outer")
        kept = [F.coalesce(key, "_key").alias(key) if c == key else F.coalesce(c, F.lit(False)).alias(c) if c.startswith("in_") else F.col(f"`{c}`") for c in out.columns]
        out = joined.select(*kept, F.col("_key").isNotNull().alias(f"in_{name}"))
    return out


def problems(df: DataFrame, lines: Sequence[Line]) -> list[str]:
    """What keeps rules from being compiled for a table: columns that it lacks, expressions that aren't boolean, or no SQL. Nothing is run."""
    out = []
    for x in lines:
        try:
            bad = F.expr(x.expression).alias("bad")
            found = df.select(bad) if x.scope == "row" else df.groupBy(*x.keys).agg(bad)
            if found.schema["bad"].dataType.typeName() not in ("boolean", "void"):
                out.append(f"{x.rule_id}: not true or false")
        except (AnalysisException, ParseException) as e:
            out.append(f"{x.rule_id}: {e.getCondition() or 'no SQL'}")
    return out


def _summary(bad: DataFrame, lines: Sequence[Line], entity: Column) -> DataFrame:
    """One row a rule of what bad says in its columns 0, 1, ...: one aggregate."""
    is_bad = lambda i: F.coalesce(F.col(f"`{i}`"), F.lit(False))
    one = bad.agg(*[F.struct(F.count_if(is_bad(i)).alias("n"), F.min(F.when(is_bad(i), entity)).alias("first")).alias(f"r{i}") for i in range(len(lines))])
    rows = F.array(*[F.struct(F.lit(x.rule_id).alias("rule_id"), F.lit(x.scope).alias("scope"), F.lit(x.severity).alias("severity"), F.col(f"r{i}.n").alias("n_bad"), F.col(f"r{i}.first").alias("first")) for i, x in enumerate(lines)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def check(df: DataFrame, lines: Sequence[Line], entity: str | None = None) -> DataFrame:
    """rule_id, scope, severity, n_bad and first (the smallest entity that breaks it: of rows, the
    column entity; of keys, their values joined by ::; none for the table) of every rule.

    An error that names the rules, before anything is run, if one doesn't fit the table. An empty
    table breaks rules of its scope only. validate.gate() takes the rows that n_bad is above 0 of.
    """
    wrong = problems(df, lines)
    if wrong:
        raise ValueError("; ".join(wrong))
    parts = []
    for scope in dict.fromkeys(x.scope for x in lines):
        own = [x for x in lines if x.scope == scope]
        bad = [F.expr(x.expression).alias(str(i)) for i, x in enumerate(own)]
        if scope == "row":
            name = F.col(f"`{entity}`").cast("string") if entity else F.lit(None).cast("string")
            parts.append(_summary(df.select(*bad, name.alias("_entity")), own, F.col("_entity")))
        elif scope == "table":
            parts.append(_summary(df.agg(*bad), own, F.lit(None).cast("string")))
        else:
            keys = own[0].keys
            grouped = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(*bad)
            name = F.concat_ws("::", *[F.coalesce(F.col(f"_k{i}").cast("string"), F.lit("")) for i in range(len(keys))])
            parts.append(_summary(grouped, own, name))
    return reduce(DataFrame.unionAll, parts)


def findings(df: DataFrame, lines: Sequence[Line]) -> DataFrame:
    """rule_id, severity and entity of every key that breaks a rule of one of the key scopes: the list behind check()'s numbers."""
    parts = []
    for scope in dict.fromkeys(x.scope for x in lines if x.keys):
        own = [x for x in lines if x.scope == scope]
        name = F.concat_ws("::", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in own[0].keys])
        each = F.array(*[F.when(F.coalesce(F.expr(x.expression), F.lit(False)), F.struct(F.lit(x.rule_id).alias("rule_id"), F.lit(x.severity).alias("severity"))) for x in own])
        parts.append(df.groupBy(*own[0].keys).agg(F.array_compact(each).alias("_broken")).select(F.explode("_broken").alias("r"), name.alias("entity")).select("r.*", "entity"))
    return reduce(DataFrame.unionAll, parts)
