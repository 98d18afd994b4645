"""Descriptors, connectors, manifests and the catalog."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.analytics import completeness, completeness_of
from ..operators.relational import last_wins
from . import io


@dataclass(frozen=True)
class Source:
    """A descriptor: what is known of a source before it is read; other fields are in extra."""

    source_id: str
    official: bool = True
    theme: str = ""
    access: str = "manual"
    frequency: str = "annual"
    grade: str = "C"
    columns: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Connector:
    """Reads the sources it lists: run(spark, source) -> table, or None without input."""

    name: str
    source_ids: tuple[str, ...]
    run: Callable[[SparkSession, Source], DataFrame | None]


def manual_connector(name: str, source_ids: tuple[str, ...], root: str) -> Connector:
    """The one connector of all hand-fed sources."""
    return Connector(name, source_ids, lambda spark, s: io.manual(spark, root, s.source_id))


def connector_for(connectors: list[Connector], source_id: str) -> Connector | None:
    return next((c for c in connectors if source_id in c.source_ids), None)


def manifest(df: DataFrame, source: Source, status: str) -> DataFrame:
    """One row: the source, number of rows, column names, status and completeness; one pass over the table."""
    return _manifest_row(completeness(df), df.columns, source, status)


def _manifest_row(counts: DataFrame, columns: list[str], source: Source, status: str) -> DataFrame:
    return counts.select(
        F.lit(source.source_id).alias("source_id"), F.lit(source.theme).alias("theme"), F.lit(source.official).alias("official"),
        F.lit(status).alias("status"), F.col("n").alias("row_count"), F.array(*map(F.lit, columns)).alias("columns"), "completeness",
    )


def written(df: DataFrame, path: str, source: Source, status: str, by: tuple[str, ...] = (), stats: bool = False) -> DataFrame:
    """Writes a table and gives its manifest() from what was counted while it was written: the
    table isn't read again, and what it is made from isn't computed twice. Metrics are observed in
    the last stage, whose tasks count once however often they are tried.

    stats: a further column of structs, one a column of the table: name, nulls, and least and
    greatest value as text (null for columns without an order, and without values).
    """
    quoted = [F.col(f"`{c}`") for c in df.columns]
    ordered = [f.dataType.typeName() not in ("map", "struct", "array", "binary", "variant") for f in df.schema.fields]
    metrics = [F.count(F.lit(1)).alias("n"), *[F.count_if(c.isNull()).alias(f"nulls_{i}") for i, c in enumerate(quoted)]]
    if stats:
        metrics += [f(c).cast("string").alias(f"{name}_{i}") for i, (c, o) in enumerate(zip(quoted, ordered, strict=True)) if o for name, f in (("min", F.min), ("max", F.max))]
    seen = Observation()
    io.write(df.observe(seen, *metrics), path, by=by)
    found = seen.get
    nulls = [found[f"nulls_{i}"] for i in range(len(df.columns))]
    counts = df.sparkSession.createDataFrame([(found["n"], sum(nulls))], "n bigint, nulls bigint")
    row = counts.select("n", completeness_of(F.col("n"), F.col("nulls"), len(df.columns)).alias("completeness"))
    out = _manifest_row(row, df.columns, source, status)
    if stats:
        entries = [F.struct(F.lit(c).alias("name"), F.lit(n).cast("bigint").alias("nulls"), *[F.lit(found.get(f"{k}_{i}")).cast("string").alias(k) for k in ("min", "max")]) for i, (c, n) in enumerate(zip(df.columns, nulls, strict=True))]
        out = out.withColumn("stats", F.array(*entries))
    return out


def ingest(spark: SparkSession, sources: list[Source], connectors: list[Connector], out: str, retrieved_at: str, selected: list[str] | None = None) -> DataFrame:
    """Reads each source in turn, writes its table, and returns the manifests, which are counted during
    the write. A source without connector or input gets a status row and no table."""
    rows = []
    for s in [s for s in sources if selected is None or s.source_id in selected]:
        c = connector_for(connectors, s.source_id)
        df = c.run(spark, s) if c else None
        if df is None:
            empty = io.placeholder(spark, s.source_id, "").limit(0)
            rows.append(manifest(empty, s, "not_mapped" if c is None else "stubbed_manual_gap"))
            continue
        df = io.provenance(df.dropDuplicates(), retrieved_at, source_type="official" if s.official else "proxy", source_id=s.source_id, metric_category=s.theme, dataset_source=c.name)
        rows.append(written(df, f"{out}/{s.source_id}", s, "manual_ingest"))
    return io.union_by_name(rows) if rows else spark.createDataFrame([], "source_id string, theme string, official boolean, status string, row_count bigint, columns array<string>, completeness double")


def upsert(catalog: DataFrame, entries: DataFrame, key: str = "source_id") -> DataFrame:
    """Entries replace rows with their key; the same entries twice change nothing more."""
    return catalog.join(entries.select(key), key, "left_anti").unionByName(entries, allowMissingColumns=True)


def latest_load(entries: DataFrame, key: str = "source_id", load: str = "load") -> DataFrame:
    """K03 as a log: the last load of each key."""
    return last_wins(entries, [key], load)


def eligible(catalog: DataFrame) -> DataFrame:
    """What the correlation reads: not disabled, no model output, with rows."""
    return catalog.where(~F.col("status").isin("disabled", "stubs_disabled") & (F.coalesce("evidence_class", F.lit("official")) != "model") & (F.col("row_count") > 0))


def scan_status(url: Column, public: Column, auth: Column, auto: Column) -> Column:
    """why a source isn't fetched, in this order; null if it may be."""
    unknown = url.isNull() | (url == "")
    return (
        F.when(unknown, "missing_or_unresolved_url").when(~F.coalesce(public, F.lit(False)), "invalid_or_unsafe_url")
        .when(auth.isin("captcha", "restricted"), F.concat(F.lit("auto_fetch_skipped_auth="), auth)).when(~F.coalesce(auto, F.lit(False)), "auto_fetch_disabled_in_inventory")
    )


def write_catalog(spark: SparkSession, entries: DataFrame, path: str, generated_at: str) -> None:
    """The catalog as one JSON document a part: generated_at and its datasets, in the
    written table's parts, so that no entry passes through the driver. documents.write() publishes
    a catalog as a whole."""
    io.write_json(entries.select(F.lit(generated_at).alias("generated_at"), F.array(F.struct("*")).alias("datasets")), path)


def read_catalog(spark: SparkSession, path: str, schema: str | None = None, lines: bool = True) -> DataFrame:
    """The datasets of a catalog, a row each; an error if a document has no field of that name.
    schema: the entries' columns as DDL (without it, they are found by a pass over the text).
    lines: a document is a line, as write_catalog() writes them; otherwise it is a file."""
    reader = spark.read.option("multiLine", not lines)
    raw = reader.schema(f"generated_at string, datasets array<struct<{schema}>>").json(path) if schema else reader.json(path)
    if "datasets" not in raw.columns:
        raise ValueError(f"{path}: no datasets field")
    return raw.select(F.explode("datasets").alias("d")).select("d.*")


def sources_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """Descriptors as a table."""
    schema = "source_id string, official boolean, theme string, access string, frequency string, grade string, columns array<string>, extra map<string,string>"
    return spark.createDataFrame([(s.source_id, s.official, s.theme, s.access, s.frequency, s.grade, list(s.columns), {k: str(v) for k, v in s.extra.items()}) for s in sources], schema)


def read_inventory(spark: SparkSession, path: str) -> list[Source]:
    """The descriptors of an inventory, a JSON document (or YAML, where a YAML parser is
    installed) with the fields version and sources; fields that a descriptor lacks are in extra.
    A missing file is an empty inventory."""
    found = spark.read.text(path, wholetext=True).first() if io.exists(spark, path) else None
    payload = _parsed(found.value if found else "{}", path)
    known = {"source_id", "official", "theme", "access", "frequency", "grade", "columns"}
    return [Source(**{k: tuple(v) if k == "columns" else v for k, v in row.items() if k in known}, extra={k: v for k, v in row.items() if k not in known}) for row in payload.get("sources", [])]


def _parsed(text: str, path: str) -> dict:
    if path.endswith((".yaml", ".yml")):
        import yaml  # optional

        return yaml.safe_load(text) or {}
    return json.loads(text)


def write_inventory(spark: SparkSession, sources: list[Source], path: str, generated_at: str, version: int = 1) -> None:
    """The descriptors as one JSON document; they are few, so the driver writes it."""
    rows = [{**{k: v for k, v in asdict(s).items() if k != "extra"}, **s.extra} for s in sources]
    io.write_json(spark.createDataFrame([(json.dumps({"generated_at": generated_at, "version": version, "sources": rows}),)], "value string"), path, text=True)


def agreeing(reports: DataFrame, manifests: DataFrame) -> DataFrame:
    """Report rows whose manifest is there, names the same path and has a readable time."""
    joined = reports.join(manifests.select("source_id", F.col("path").alias("_path"), "generated_at"), "source_id")
    return joined.where((F.col("path") == F.col("_path")) & F.try_to_timestamp("generated_at").isNotNull()).drop("_path")


def write_manifests(manifests: DataFrame, path: str) -> None:
    """The manifests as JSON lines, a folder a source."""
    io.write_json(manifests, path, by=("source_id",))


def markdown(df: DataFrame, limit: int | None = None) -> str:
    """A report as a Markdown table, read row by row; with a limit, a last line says how many rows are left out."""
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    rows = [line(r) for r in (df if limit is None else df.limit(limit)).toLocalIterator()]
    left = 0 if limit is None or len(rows) < limit else df.count() - limit
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *rows, *([f"{left} further rows"] if left > 0 else [])])
