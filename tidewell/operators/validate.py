"""Declarative rules over tables (V01-V12, V14-V17, J14, A27, A30): each finding is a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """bad: rows that break it (null counts as kept)."""

    rule_id: str
    bad: Column
    severity: str = "error"


def required(col: str, severity: str = "error") -> Rule:
    """There and not blank."""
    return Rule(f"{col}_required", F.col(col).isNull() | (F.trim(F.col(col).cast("string")) == ""), severity)


def prefixed(col: str, prefix: str, severity: str = "error") -> Rule:
    """Begins with the prefix; null breaks it."""
    return Rule(f"{col}_prefix", ~F.coalesce(F.col(col).startswith(prefix), F.lit(False)), severity)


def whole(col: str, within: float = 0.001) -> Rule:
    """A whole number, but for a rounding error."""
    return Rule(f"{col}_whole", F.abs(F.col(col) - F.round(F.col(col))) > within)


def between(col: str, low: float, high: float, severity: str = "error") -> Rule:
    """Caps."""
    return Rule(f"{col}_between", ~F.col(col).between(low, high), severity)


def ratio_between(top: str, bottom: str, low: float, high: float, severity: str = "warning") -> Rule:
    """A ratio's bounds; a denominator that isn't positive breaks it."""
    return Rule(f"{top}_per_{bottom}", (F.col(bottom) <= 0) | ~F.try_divide(F.col(top), F.col(bottom)).between(low, high), severity)


def one_of(col: str, values: Sequence) -> Rule:
    """V03, V09."""
    return Rule(f"{col}_in_set", ~F.col(col).isin(*values))


def non_negative(col: str) -> Rule:
    """V06."""
    return Rule(f"{col}_non_negative", F.col(col) < 0)


def ordered(low: str, high: str) -> Rule:
    """Low <= high."""
    return Rule(f"{low}_le_{high}", F.col(low) > F.col(high))


def parses(col: str) -> Rule:
    """Text that is no number."""
    return Rule(f"{col}_numeric", F.col(col).isNotNull() & F.regexp_replace(F.col(col), ",", "").try_cast("double").isNull())


def any_value(*cols: str) -> Rule:
    """V10."""
    return Rule("any_value", F.coalesce(*[F.col(c).cast("string") for c in cols]).isNull())


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule_id, severity and n_bad of every rule: one pass over the table for all of them."""
    one = df.agg(*[F.coalesce(F.sum(F.coalesce(r.bad, F.lit(False)).cast("bigint")), F.lit(0)).alias(str(i)) for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.col(str(i)).alias("n_bad")) for i, r in enumerate(rules)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def check_coverage(df: DataFrame, key: str, least: int, allowed_missing: DataFrame | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Too few distinct keys, and expected keys that are missing and not excused."""
    few = df.agg(F.countDistinct(key).alias("n")).where(F.col("n") < least).select(F.lit("coverage").alias("rule_id"), F.lit("error").alias("severity"), F.lit(None).cast("string").alias("entity"))
    if expected is None:
        return few
    lost = expected.select(key).join(df.select(key), key, "left_anti")
    if allowed_missing is not None:
        lost = lost.join(allowed_missing.select(key), key, "left_anti")
    return few.unionAll(lost.select(F.lit("missing_key"), F.lit("error"), F.col(key).cast("string")))


def check_groups(df: DataFrame, single: Sequence[str] = (), at_most: Sequence[tuple[str, str, int]] = ()) -> DataFrame:
    """rule_id, severity and n_bad: columns that must have one value, and (column, value,
    most) values that at most so many rows may have. One pass."""
    parts = [(f"{c}_single", (F.countDistinct(c) != 1).cast("bigint")) for c in single]
    parts += [(f"{c}_{v}_at_most_{n}", F.greatest(F.lit(0).cast("bigint"), F.coalesce(F.sum((F.col(c) == v).cast("bigint")), F.lit(0)) - n)) for c, v, n in at_most]
    one = df.agg(*[x.alias(str(i)) for i, (_, x) in enumerate(parts)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule_id"), F.lit("error").alias("severity"), F.col(str(i)).alias("n_bad")) for i, (n, _) in enumerate(parts)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def distinct_gate(df: DataFrame, key: str, score: str, least: int = 10) -> DataFrame:
    """One row: numbers of keys and of scores, and whether there are enough keys and more than one score."""
    one = df.agg(F.countDistinct(key).alias("n_keys"), F.countDistinct(score).alias("n_scores"))
    return one.withColumn("shown", (F.col("n_keys") >= least) & (F.col("n_scores") > 1))


def checksum_findings(manifest: DataFrame, files: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """Files of a manifest that are missing or differ from its digest, as findings."""
    both = manifest.select(key, F.col(digest).alias("_want")).join(files.select(key, F.col(digest).alias("_is")), key, "left")
    rule = F.when(F.col("_is").isNull(), "missing_file").when(F.col("_is") != F.col("_want"), "checksum_differs")
    return both.select(rule.alias("rule_id"), F.lit("error").alias("severity"), F.col(key).alias("entity")).where("rule_id is not null")


def marker_findings(texts: DataFrame, key: str, text: str, markers: Sequence[str]) -> DataFrame:
    """Markers that a text should hold and doesn't; a null text holds none."""
    rows = texts.select(F.col(key).alias("entity"), F.coalesce(text, F.lit("")).alias("_t"), F.explode(F.array(*map(F.lit, markers))).alias("marker"))
    return rows.where(~F.contains("_t", "marker")).select(F.lit("missing_marker").alias("rule_id"), F.lit("error").alias("severity"), F.col("entity").cast("string").alias("entity"), "marker")


def drift(current: DataFrame, reference: DataFrame, key: str, value: str, warn: float, error: float, share: float = 0.5) -> DataFrame:
    """Difference of shared keys and its severity: error beyond max(error, share of the reference)."""
    both = current.select(key, F.col(value).alias("now")).join(reference.select(key, F.col(value).alias("then")), key)
    delta = F.abs(F.col("now") - F.col("then"))
    return both.select(key, "now", "then", (F.col("now") - F.col("then")).alias("delta"), F.when(delta > F.greatest(F.lit(float(error)), F.abs("then") * share), "error").when(delta > warn, "warning").otherwise("ok").alias("severity"))


def shard_findings(shards: DataFrame, n: int) -> DataFrame:
    """Shards (shard, env, doc) that are missing, disagree on env, or share a document."""
    want = shards.sparkSession.range(n).select(F.col("id").cast("int").alias("shard"))
    parts = [
        want.join(shards.select("shard"), "shard", "left_anti").select(F.lit("missing_shard").alias("rule_id"), F.col("shard").cast("string").alias("entity")),
        shards.groupBy("doc").agg(F.countDistinct("shard").alias("n")).where("n > 1").select(F.lit("shared_document"), F.col("doc").cast("string")),
        shards.agg(F.countDistinct("env").alias("n")).where("n > 1").select(F.lit("env_differs"), F.col("n").cast("string")),
    ]
    return reduce(DataFrame.unionAll, parts)


def exit_code(findings: DataFrame, strict: bool = False) -> int:
    """1 if there are errors, or, if strict, warnings; else 0."""
    return int(not findings.where(F.col("severity").isin("error", *(["warning"] if strict else []))).isEmpty())


def gate(findings: DataFrame, strict: bool = False) -> None:
    """Raises if there are errors, or, if strict, warnings."""
    if exit_code(findings, strict):
        raise ValueError(f"{findings.where(F.col('severity') != 'ok').count()} findings")
