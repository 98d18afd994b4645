"""Correlation, scores, panels and coverage."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import clamp
from ..functions.names import let, normal_url


def pairwise_correlation(long: DataFrame, entity: str = "entity", year: str = "year", metric: str = "metric", value: str = "value", min_overlap: int = 2) -> DataFrame:
    """Pearson correlation of each two metrics over the entity-years that both
    have, with their number and first and last year. Pairs are in lexical order (T9); constant
    sides have no correlation and make no row (T8). The table stays long: a self-join on
    (entity, year) and one aggregate, no pivot.
    """
    cells = long.where(F.col(metric).isNotNull() & F.col(entity).isNotNull() & F.col(year).isNotNull()).groupBy(entity, year, metric).agg(F.avg(value).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    a = cells.select(entity, year, F.col(metric).alias("metric_a"), F.col("v").alias("x"))
    b = cells.select(entity, year, F.col(metric).alias("metric_b"), F.col("v").alias("y"))
    pairs = a.join(b, [entity, year]).where("metric_a < metric_b").groupBy("metric_a", "metric_b")
    out = pairs.agg(F.count("*").alias("overlap_records"), F.min(year).alias("year_min"), F.max(year).alias("year_max"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("xy"), (F.min("x") < F.max("x")).alias("dx"), (F.min("y") < F.max("y")).alias("dy"))
    return out.where(F.col("dx") & F.col("dy") & (F.col("overlap_records") >= min_overlap)).select("metric_a", "metric_b", F.round(F.try_divide("xy", F.sqrt(F.col("vx") * F.col("vy"))), 6).alias("correlation"), "overlap_records", "year_min", "year_max")


#: Days between updates; how far a dataset's status is trusted.
FREQUENCY_DAYS = {"daily": 1, "monthly": 31, "quarterly": 92, "annual": 365}
STATUS = {
    "ok": 1.0, "automated": 1.0, "manual_ingest": 0.98, "stub_parsed": 0.78, "metadata_only": 0.62, "candidate_ready": 0.44,
    "proxy_stub": 0.38, "stubbed_manual_gap": 0.34, "stubs_disabled": 0.3, "disabled": 0.22,
}


def looked_up(c: Column, table: dict, default: float) -> Column:
    """a constant table as a column expression."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), F.lit(default))


def completeness(df: DataFrame) -> DataFrame:
    """Share of non-null cells, to three places; 0 for an empty table. One pass."""
    nulls = sum((F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("bigint")), F.lit(0)) for c in df.columns), F.lit(0))
    return df.agg(F.count("*").alias("n"), nulls.alias("nulls")).select("n", completeness_of(F.col("n"), F.col("nulls"), len(df.columns)).alias("completeness"))


def completeness_of(n: Column, nulls: Column, columns: int) -> Column:
    """Completeness of n rows with so many null cells."""
    return F.when(n == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), 1 - nulls / (n * columns)), 3))


def recency(age_days: Column, frequency: Column) -> Column:
    """bands of the age in update intervals; 0.25 if unknown."""
    f = looked_up(frequency, FREQUENCY_DAYS, 365)
    return F.when(age_days.isNull(), 0.25).when(age_days <= f, 1.0).when(age_days <= 2 * f, 0.7).when(age_days <= 4 * f, 0.4).otherwise(0.2)


def provenance(grade: Column, official: Column) -> Column:
    """by reliability grade (C if missing) and whether the source is official."""
    g = F.upper(F.coalesce(grade, F.lit("C")))
    return F.when((g == "A") & official, 1.0).when((g == "B") & official, 0.85).when((g == "C") & ~official, 0.6).when((g == "C") & official, 0.7).otherwise(0.5)


def consistency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1 less 0.05 for an absent column and 0.25 for one with a negative; 0.3 for an empty table."""
    there = [c for c in columns if c in df.columns]
    bad = sum((F.coalesce(F.max((F.col(f"`{c}`") < 0).cast("int")), F.lit(0)) for c in there), F.lit(0))
    lost = 0.05 * (len(columns) - len(there))
    return df.agg(F.count("*").alias("n"), bad.alias("bad")).select(F.when(F.col("n") == 0, 0.3).otherwise(clamp(F.lit(1.0 - lost) - 0.25 * F.col("bad"), 0, 1)).alias("consistency"))


def extraction_factor(avg: Column, low_share: Column, failed_share: Column, text_share: Column, structured: Column) -> Column:
    """struct of score and reasons: mean confidence, less penalties for low, failed and text-only rows; null shares count as 0, a null mean as 1.
    A score in the middle of two is rounded up also where the doubles' last digits put it below."""
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    avg, low, failed = F.coalesce(avg.cast("double"), F.lit(1.0)), zero(low_share), zero(failed_share)
    bare = (zero(text_share) > 0.95) & ~F.coalesce(structured, F.lit(False))
    out = clamp(avg, 0, 1) - F.when(low > 0.15, F.least(F.lit(0.25), (low - 0.15) * 0.6)).otherwise(0.0) - F.when(failed > 0.02, F.least(F.lit(0.2), 2 * failed)).otherwise(0.0) - F.when(bare, 0.08).otherwise(0.0)
    why = ((low > 0.15, "many rows of low confidence"), (failed > 0.02, "rows failed"), (bare, "text only, no structured parser"), (avg < 0.7, "mean confidence is low"))
    return F.struct(F.round(clamp(out, 0, 1).cast("decimal(34,14)"), 3).cast("double").alias("score"), F.array_compact(F.array(*[F.when(x, F.lit(n)) for x, n in why])).alias("reasons"))


#: The reason that every dataset with the lowest badge has.
LOW_CAVEAT = "fit for trends and rankings, not for exact decisions"


def overall(c: Column, r: Column, p: Column, k: Column, status: Column, extraction: Column | None = None) -> Column:
    """struct of overall score, badge and reasons; the status' factor (in any case; 0.5 where
    it is unknown or null) caps each part. The badge goes by the score before it is rounded to three places."""
    s = looked_up(F.lower(status), STATUS, 0.5)
    c, r, p, k = F.least(c, s), F.least(r, F.greatest(F.lit(0.2), s)), p * F.greatest(F.lit(0.25), s), F.least(k, F.greatest(F.lit(0.2), s))
    if extraction is None:
        score = 0.35 * c + 0.25 * r + 0.2 * p + 0.2 * k
    else:
        score = 0.3 * c + 0.2 * r + 0.18 * p + 0.17 * k + 0.15 * extraction
    checks = [(p < 0.45, "low provenance"), (c < 0.6, "low completeness"), (r < 0.6, "low recency"), (k < 0.7, "low consistency")] + ([] if extraction is None else [(extraction < 0.65, "low extraction")])
    reasons = F.array_compact(F.array(*[F.when(x, F.lit(n)) for x, n in [*checks, (badge(score) == "Low", LOW_CAVEAT)]]))
    return F.struct(F.round(score, 3).alias("score"), badge(score).alias("badge"), reasons.alias("reasons"))


def badge(score: Column) -> Column:
    """bands of the overall score."""
    return F.when(score >= 0.85, "High").when(score >= 0.65, "Med").otherwise("Low")


def badge_floor(df: DataFrame, key: str, score: str, reasons: str, legacy_floor: bool = False) -> DataFrame:
    """The lowest contributing badge and the reasons of all. legacy_floor: always Low for a non-empty list (T5)."""
    out = df.groupBy(key).agg(F.min(score).alias("score"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(reasons)))).alias("reasons"))
    return out.withColumn("badge", F.lit("Low") if legacy_floor else badge(F.col("score")))


def confidence_stats(df: DataFrame, keys: Sequence[str], confidence: str, low: float = 0.45) -> DataFrame:
    """Mean, least, greatest and number of low confidences; null counts as 0."""
    x = F.coalesce(F.col(confidence).cast("double"), F.lit(0.0))
    return df.groupBy(*keys).agg(F.avg(x).alias("avg_confidence"), F.min(x).alias("min_confidence"), F.max(x).alias("max_confidence"), F.sum((x < low).cast("bigint")).alias("n_low"))


def row_confidence(method: Column, parser: Column, noise: Column, numeric: Column, url: Column, checksum: Column, traced: Column, text_tool: Column | bool = True, ocr_tool: Column | bool = True) -> Column:
    """struct of score, flag and notes of an extracted row. noise, numeric, url, checksum and
    traced (a parser trace is there) are booleans, null as false; text_tool and ocr_tool say whether
    the tool of the method was at hand."""
    method, parser = F.lower(F.coalesce(F.nullif(method, F.lit("")), F.lit("failed"))), F.lower(F.coalesce(F.nullif(parser, F.lit("")), F.lit("none")))
    yes = lambda c: F.coalesce(c if isinstance(c, Column) else F.lit(c), F.lit(False))
    base = F.when(method == "table", 0.86).when(method == "text", 0.6).when(method == "ocr", 0.48).when(method.isin("error", "failed"), 0.0).otherwise(0.35)
    more = F.when(parser == "camelot", 0.06).when(parser.isin("pdfplumber", "tabula"), 0.03).otherwise(0.0)
    no_text, no_ocr = (method == "text") & ~yes(text_tool), (method == "ocr") & ~yes(ocr_tool)
    steps = ((yes(noise), -0.18), (yes(numeric), 0.06), (yes(url), 0.03), (yes(checksum), 0.03), (no_text, -0.08), (no_ocr, -0.2), (~yes(traced), -0.1))
    score = F.round(clamp(sum((F.when(c, x).otherwise(0.0) for c, x in steps), base + more), 0, 1), 3)
    notes = ((parser == "ocr", "ocr_fallback"), (yes(noise), "noise_suspected"), (~yes(numeric), "numeric_missing"), (no_text, "text_tool_unavailable"), (no_ocr, "ocr_tool_unavailable"), (~yes(traced), "missing_parser_trace"))
    return F.struct(score.alias("score"), quality_flag(score, method).alias("flag"), F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in notes])).alias("notes"))


def quality_flag(score: Column, method: Column) -> Column:
    """failed, high, medium or low."""
    return F.when((score <= 0) | method.isin("failed", "error"), "failed").when(score >= 0.8, "high").when(score >= 0.45, "medium").otherwise("low")


def evidence_class(official: Column, category: Column) -> Column:
    """Official, proxy or model."""
    kind = F.lower(F.coalesce(category, F.lit("")))
    return F.when(~F.coalesce(official, F.lit(True)) | kind.contains("proxy"), "proxy").when(kind.contains("model"), "model").otherwise("official")


def stable_seed(*parts: Column) -> Column:
    """A 48-bit number from parts joined by |."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 12), 16, 10).cast("bigint")


#: The terrains of the seeded panel, in their order.
TERRAINS = ("Plains", "Semi-arid", "Hilly", "Mountain", "Coastal", "Flood-prone", "Urban")


def risk_priors(accidents: DataFrame, state: str, killed: str, fatal: str) -> DataFrame:
    """State and prior, the mean of killed + 2.4 * fatal; null counts as 0, a null state as Unknown."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return accidents.groupBy(F.coalesce(F.col(state).cast("string"), F.lit("Unknown")).alias("state")).agg(F.avg(zero(killed) + 2.4 * zero(fatal)).alias("prior"))


def segments_each(projects: int, requested: int = 2500, target: int = 220_000) -> int:
    """Segments of a project, so that there are at least `target` rows (20,000 at least) in all."""
    requested, target = requested if requested > 0 else 2500, max(target, 20_000)
    return max(requested, target // projects) if projects else requested


def segments_of(projects: Column, requested: int = 2500, target: int = 220_000) -> Column:
    """segments_each() for a number of projects in a column."""
    least = F.lit(requested if requested > 0 else 2500).cast("bigint")
    return F.when(projects > 0, F.greatest(least, F.floor(F.lit(max(target, 20_000)) / projects))).otherwise(least)


def expand(df: DataFrame, keys: Sequence[str], segments: int | None, seed: int, source: str, length: str | None = None, cost: str | None = None, progress: str | None = None, project_no: str | None = None, budget: float | None = None, priors: DataFrame | None = None, requested: int = 2500, target: int = 220_000) -> DataFrame:
    """`segments` rows for each row of df with figures derived from a stable seed; rows
    are generated where the input lies, with no shuffle and no driver loop. Without segments, there
    are as many as segments_each() gives for the number of rows (which are counted first),
    requested and target.

    length, cost, progress and project_no name columns of df (0.1, 0.1, 35 and 1 where they aren't
    given or null; length and cost are 0.1 at least). priors (state, prior) are the states that
    segments are assigned to, by name, with their risk; a fixed, small table. Without it the
    state is "National Average", with a risk of 50.
    """
    segments = segments or segments_each(df.count(), requested, target)
    h, segment = F.col("seed"), F.col("segment")
    out = df.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
    out = out.withColumn("seed", stable_seed(F.lit(seed), F.lit(source), *map(F.col, keys), segment))
    number = lambda name, default: F.coalesce(F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double")), F.lit(default)) if name else F.lit(default)
    km, crore = F.greatest(number(length, 0.1), F.lit(0.1)), F.greatest(number(cost, 0.1), F.lit(0.1))
    if priors is None:
        state, prior = F.lit("National Average"), F.lit(50.0)
    else:
        one = priors.agg(F.array_sort(F.collect_list(F.struct("state", "prior"))).alias("_states"))
        out = out.crossJoin(F.broadcast(one))
        mine = F.try_element_at("_states", (F.pmod(h, F.greatest(F.size("_states"), F.lit(1))) + 1).cast("int"))
        state, prior = F.coalesce(mine["state"], F.lit("National Average")), F.coalesce(mine["prior"], F.lit(50.0))
    month, year = F.pmod(segment + h % 12, F.lit(12)) + 1, 2021 + F.floor(h / 12) % 6
    factor = 1 + (h % 100) / 120
    out = out.withColumns({"state": state, "_prior": prior, "terrain": F.element_at(F.array(*map(F.lit, TERRAINS)), (h % 7 + 1).cast("int")), "_factor": factor, "month": month.cast("int"), "year": year.cast("int")})
    land = F.round(0.08 * crore + 0.06 * km + (h % 500) / 100, 4)
    upkeep = F.round(0.02 * crore + 0.42 * km + (h % 200) / 50, 4)
    steep = F.when(F.col("terrain").isin("Mountain", "Hilly"), 20).otherwise(0)
    out = out.withColumns({
        "length_km": km, "cost": crore,
        "progress_pct": F.round(F.least(F.lit(100.0), clamp(number(progress, 35.0), 0, 100) + segment / max(segments, 1) * 10), 2),
        "sea_level_m": 5 + h % 200 + 10 * (F.col("year") - 2020),
        "access_hours": F.round(0.5 + (h % 180) / 12, 2), "quality_index": F.round(70 + (h % 2500) / 125, 2),
        "_safety": clamp((F.col("_prior") + h % 120 - 40 + steep) / 1.8, 0, 100),
        "revenue": F.round(F.round(0.35 * crore + 0.015 * segment + (h % 1000) / 10, 4) + F.col("_factor"), 4),
        "_land": land, "maintenance_cost": upkeep, "_terrain_cost": F.round(F.col("_factor") * (land + upkeep), 4),
        "duration_months": (18 + (7 * (F.col(project_no) if project_no else F.lit(1))) % 120).cast("int"),
        "distance_hours": F.round(0.75 + (h % 220) / 11, 2),
        "budget_share": F.round(crore / budget, 6) if budget else F.lit(0.0),
    })
    out = out.withColumns({"safety_risk": F.round("_safety", 3), "land_cost": F.round(F.col("_land") + F.col("_terrain_cost") / 2, 4), "delay_risk": F.round(F.col("quality_index") / 3 + F.col("_safety") / 6 + F.col("access_hours") - 2, 3)})
    out = out.withColumn("risk_flag", ((F.col("quality_index") < 60) | (F.col("_safety") > 70) | (F.col("access_hours") > 10)).cast("int"))
    return out.drop("_prior", "_factor", "_safety", "_land", "_terrain_cost", "_states")


def with_segment_ids(df: DataFrame, project_no: Column, prefix: str, segment: str = "segment") -> DataFrame:
    """project_id (prefix-0001) and segment_id (prefix-0001_SEG_0001, from 1)."""
    project = F.format_string(prefix + "-%04d", project_no.cast("int"))
    return df.withColumns({"project_id": project, "segment_id": F.concat(project, F.format_string("_SEG_%04d", F.col(segment).cast("int") + 1))})


def named_entities(sources: DataFrame, aliases: DataFrame) -> DataFrame:
    """The distinct (entity, source_id) where one of a source's names equals one of an entity's aliases, in any case.

    sources: source_id, title, dataset and columns (an array); a source's names are its columns,
    its title (its id, if it has none), its dataset and its id. aliases (entity, alias): an
    ontology's. A hash join on the name.
    """
    title = F.coalesce(F.nullif("title", F.lit("")), "source_id")
    every = F.array_distinct(F.transform(F.concat(F.coalesce("columns", F.array().cast("array<string>")), F.array(title, F.col("dataset"), F.col("source_id"))), F.lower))
    named = sources.select("source_id", F.explode(F.array_compact(every)).alias("name"))
    return named.join(aliases.select("entity", F.lower("alias").alias("name")).distinct(), "name").select("entity", "source_id").distinct()


def coverage(sources: DataFrame, aliases: DataFrame) -> DataFrame:
    """For each entity of aliases, the number of sources that name it."""
    hit = named_entities(sources, aliases)
    return aliases.select("entity").distinct().join(hit.groupBy("entity").agg(F.count("*").alias("n")), "entity", "left").select("entity", F.coalesce("n", F.lit(0)).alias("n_sources"))


def relation_evidence(sources: DataFrame, aliases: DataFrame, relations: DataFrame) -> DataFrame:
    """For each relation (from_entity, to_entity) the number and the sorted ids of the sources that name both ends."""
    hit = named_entities(sources, aliases)
    a, b = hit.select(F.col("entity").alias("from_entity"), "source_id"), hit.select(F.col("entity").alias("to_entity"), "source_id")
    both = relations.join(a, "from_entity").join(b, ["to_entity", "source_id"]).groupBy("from_entity", "to_entity").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("source_id")).alias("ids"))
    return relations.join(both, ["from_entity", "to_entity"], "left").select("from_entity", "to_entity", F.coalesce("n", F.lit(0)).alias("n_sources"), F.coalesce("ids", F.array().cast("array<string>")).alias("source_ids"))


def gap_report(required: DataFrame, sources: DataFrame, seq: str | None = None) -> DataFrame:
    """Each required theme: covered, restricted or missing. A theme is restricted if the last of its
    sources by seq isn't open; without seq, if none of them is."""
    is_open = F.col("open").cast("int")
    have = sources.groupBy("theme").agg(F.count("*").alias("n"), (F.max_by(is_open, F.col(seq)) if seq else F.max(is_open)).alias("open"))
    return required.join(have, "theme", "left").select("theme", F.coalesce("n", F.lit(0)).alias("n_sources"), F.when(F.col("n").isNull(), "missing").when(F.col("open") == 0, "restricted").otherwise("covered").alias("status"))


#: Terms that raise and lower a document's relevance.
REPORT_TERMS = ("annual report", "annual-report", "annual_report", "annualreport", "annual reports")
OTHER_TERMS = ("press release", "press-release", "notice", "circular", "tender", "rfp", "corrigendum")
BODY_TERMS = ("annual report of", "chairman", "management discussion", "performance overview")


def relevance(title: Column, url: Column, text: Column | None = None, hint: Column | None = None) -> Column:
    """Additive term weights of a document's title, URL, hint and first 2,000 characters,
    clamped to 0..1; 0.4 is the usual threshold."""
    text, hint = text if text is not None else F.lit(""), hint if hint is not None else F.lit("")
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    parts = F.filter(F.array(low(title), F.lower(normal_url(url)), low(hint), F.lower(F.substring(F.trim(F.coalesce(text, F.lit(""))), 1, 2000))), lambda p: p != "")

    def score(t: Column) -> Column:
        any_of = lambda words: t.rlike("|".join(map(re.escape, words)))
        report = F.when(any_of(REPORT_TERMS), 0.45).when(t.contains("annual") & t.contains("report"), 0.3).otherwise(0.0)
        styled = F.when(any_of(("annual-reports", "annual_report", "annual-report")), 0.2).otherwise(0.0)
        fiscal = t.rlike(r"\b20\d{2}[-/]\d{2}\b|\b(19|20)\d{2}\s*-\s*(?:19|20)?\d{2}\b")
        year = F.when(fiscal, 0.2).when(t.rlike(r"\b(19|20)\d{2}\b"), 0.1).otherwise(0.0)
        body = F.when((F.coalesce(text, F.lit("")) != "") & any_of(BODY_TERMS), 0.15).otherwise(0.0)
        less = F.when(any_of(OTHER_TERMS), 0.35).otherwise(0.0) + F.when(t.contains("green cover index"), 0.25).otherwise(0.0)
        return F.round(clamp(report + styled + year + body - less, 0, 1), 3)

    return let(F.array_join(parts, " "), score)


def bands(c: Column) -> Column:
    """thirds of a hundred."""
    return F.when(c >= 66.67, "High").when(c >= 33.34, "Medium").otherwise("Low")
