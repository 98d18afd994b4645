"""Documents found over several seeds, and the rows of their pages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import host_of, is_public_url, let, normal_url
from ..sources.io import scratch_dir
from .analytics import relevance
from .extract import is_noise, line_value, stripped, text_urls, year_candidates

#: The least score of a candidate; confidences of rows by how they were found.
LEAST_SCORE = 0.4
NUMBERED_CONFIDENCE, LABELLED_CONFIDENCE, BARE_CONFIDENCE, TEXT_CONFIDENCE = 0.84, 0.78, 0.55, 0.35
#: Characters of a line that may stand for itself, and rows of a document up to which such lines are taken.
TEXT_CHARS, TEXT_ROWS = 260, 5
#: Lines of pages that go to one task: Spark would put up to 64 MB of shuffled lines there, which take 30 times as much of its memory.
TASK_LINES = 100_000


def read_pages(records: DataFrame, seeds: DataFrame) -> DataFrame:
    """The records of the pages that a harvest reads: of each seed the first `pages` pages, and
    none after the first that has fewer than page_size records (a page without any ends it too)."""
    sizes = records.groupBy("seed_id", "page_no").agg(F.count("*").alias("n")).join(seeds.select("seed_id", "pages", "page_size"), "seed_id")
    full = sizes.where("n >= page_size")
    # pages 0 .. k - 1 are full if the k full pages with the smallest numbers are these
    ends = full.groupBy("seed_id").agg(F.array_sort(F.collect_set("page_no")).alias("_full"))
    limits = seeds.select("seed_id", "pages").join(ends, "seed_id", "left")
    run = F.aggregate(F.coalesce("_full", F.array().cast("array<int>")), F.lit(0), lambda k, p: F.when(p == k, k + 1).otherwise(k))
    last = limits.select("seed_id", F.least(run, F.col("pages") - 1).alias("_last"))
    return records.join(last, "seed_id").where(F.col("page_no") <= F.col("_last")).drop("_last")


def _allowed(url: Column, suffix: Column) -> Column:
    host = let(host_of(url), lambda h: (h == F.lower(suffix)) | h.endswith(F.concat(F.lit("."), F.lower(suffix))))
    return is_public_url(url) & host


def candidates(records: DataFrame, seeds: DataFrame) -> DataFrame:
    """One row for each distinct URL of a document: seed_id, title, url, hint and score.

    seeds: seed_id, seq (their order), title, terms (array), pages, page_size, suffix (of allowed
    hosts), first_year, last_year and template (an address with {year}). records: seed_id, page_no
    and record_no (from 0), title and payload (any text, such as JSON). Of the records of the
    pages that are read, those that name a term (in any case) in title or payload count; of their
    URLs those of a PDF on an allowed public host whose score is LEAST_SCORE or more. Where a
    seed has no candidate at all, its addresses by fiscal year are (hint
    financial_year_pattern, no score). A URL of several is its first by seed, page, record and place.
    """
    asked = seeds.select("seed_id", "seq", "terms", "suffix", F.col("title").alias("_seed_title"))
    found = read_pages(records, seeds).join(asked, "seed_id").withColumn("_blob", F.lower(F.concat_ws(" ", "title", "payload")))
    found = found.where(F.exists("terms", lambda t: F.col("_blob").contains(F.lower(t)))).drop("_blob", "terms")
    row = F.struct("seq", "page_no", "record_no", "seed_id", "suffix", F.coalesce(F.nullif(stripped(F.col("title")), F.lit("")), "_seed_title").alias("title"), F.coalesce("payload", F.lit("")).alias("payload"))
    urls = text_urls(found.select(row.alias("_row"), F.col("payload").alias("_p")), "_row", "_p").select("_row.*", "pos", normal_url(F.col("url")).alias("url"))
    pdfs = urls.where(F.lower("url").contains(".pdf") & _allowed(F.col("url"), F.col("suffix")))
    scored = pdfs.withColumn("score", relevance(F.col("title"), F.col("url"), hint=F.col("payload"))).where(F.col("score") >= LEAST_SCORE)
    own = scored.select("seq", "page_no", "record_no", "pos", "seed_id", "title", "url", F.lit("endpoint").alias("hint"), "score")
    without = seeds.join(own.select("seed_id").distinct(), "seed_id", "left_anti")
    years = year_candidates(without, F.col("first_year"), F.col("last_year"), F.col("template"))
    years = years.select("seq", F.lit(0).alias("page_no"), F.lit(0).alias("record_no"), F.substring("label", 1, 4).cast("int").alias("pos"), "seed_id", F.concat_ws(" ", "title", "label").alias("title"), normal_url(F.col("url")).alias("url"), F.lit("financial_year_pattern").alias("hint"), F.lit(None).cast("double").alias("score"), "suffix")
    every = own.unionByName(years.where(_allowed(F.col("url"), F.col("suffix"))).drop("suffix"))
    first = every.groupBy("url").agg(F.min(F.struct("seq", "page_no", "record_no", "pos", "seed_id", "title", "hint", "score")).alias("x"))
    return first.select("x.seed_id", "x.title", "url", "x.hint", "x.score")


def tasks_for(rows: DataFrame) -> int:
    """Into how many tasks the rows of a stored table go, so that one has TASK_LINES or so at any size."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_LINES))


def page_rows(lines: DataFrame, key: str = "doc_id", first: int = 0) -> DataFrame:
    """the rows of documents' pages: key, page_no, row_no, col_no, table_id, record_type, metric_name,
    value, value_text, line_type, confidence, quality and raw_line.

    lines: key, page_no, line_no and line. Numbered lines and labels with a value are rows
    (kv_line). A page without any gives its plain lines instead (toc_row: letters, no noise, no
    total, TEXT_CHARS at most), while the document has fewer than TEXT_ROWS rows, but one at
    least. Rows are numbered through a document by page and line; blank lines and noise aren't rows.
    """
    fine = lines.where("line is not null").withColumn("line", stripped(F.col("line"))).where("line <> ''")
    text = (F.length("line") <= TEXT_CHARS) & F.col("line").rlike(r"\p{L}") & ~F.upper("line").startswith("TOTAL")
    seen = fine.withColumn("_x", F.explode(F.array(F.struct(is_noise(F.col("line")).alias("noise"), line_value(F.col("line")).alias("kv"))))).where("not _x.noise")
    rows = seen.select(key, "page_no", "line_no", "line", F.col("_x.kv").alias("kv"), F.col("_x.kv.label").isNotNull().alias("is_kv"), text.alias("is_text")).where("is_kv or is_text")
    # written once: lines are parsed once, and how many there are tells into how many tasks they go
    path = f"{scratch_dir(rows.sparkSession)}/page-rows-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    tasks = tasks_for(rows)
    # a page's numbers of rows, and with them where its rows begin: a fold over the pages of a document
    per_page = rows.select(key, "page_no", "is_kv", "is_text").repartition(tasks, key, "page_no").groupBy(key, "page_no").agg(F.count_if("is_kv").alias("n_kv"), F.count_if("is_text").alias("n_text"))
    pages = per_page.repartition(tasks, key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_no", "n_kv", "n_text"))).alias("pages"))
    taken = lambda at, p: F.when(p["n_kv"] > 0, p["n_kv"]).otherwise(F.least(p["n_text"], F.greatest(F.lit(1), TEXT_ROWS - at)))
    held = F.struct(F.lit(first).cast("bigint").alias("at"), F.array().cast("array<struct<page_no:int,at:bigint,n:bigint,kv:boolean>>").alias("done"))
    step = lambda s, p: F.struct((s["at"] + taken(s["at"], p)).alias("at"), F.concat(s["done"], F.array(F.struct(p["page_no"].cast("int").alias("page_no"), s["at"].alias("at"), taken(s["at"], p).cast("bigint").alias("n"), (p["n_kv"] > 0).alias("kv")))).alias("done"))
    starts = pages.select(key, F.explode(F.aggregate("pages", held, step)["done"]).alias("p")).select(key, F.col("p.page_no").cast(rows.schema["page_no"].dataType).alias("page_no"), F.struct("p.at", "p.n", "p.kv").alias("start"))
    # a page's lines meet its start by the same grouping, which numbers those that are rows: pages are small
    line = F.struct("line_no", "line", "kv", "is_kv", "is_text")
    both = rows.select(key, "page_no", line.alias("r")).unionByName(starts, allowMissingColumns=True).repartition(tasks, key, "page_no")
    whole = both.groupBy(key, "page_no").agg(F.max("start").alias("start"), F.array_sort(F.collect_list(F.when(F.col("start").isNull(), F.struct("r.line_no", "r.line", "r.kv", "r.is_kv", "r.is_text")))).alias("held"))
    asked = F.filter("held", lambda x: F.when(F.col("start.kv"), x["is_kv"]).otherwise(x["is_text"]))
    numbered = whole.select(key, "page_no", F.col("start.at").alias("_at"), F.col("start.n").alias("_n"), F.col("start.kv").alias("_kv"), F.posexplode(asked).alias("i", "r")).where(F.col("i") < F.col("_n"))
    is_kv, kv = F.col("_kv"), F.col("r.kv")
    sure = F.when(kv["kind"] == "numbered", NUMBERED_CONFIDENCE).when(kv["value"].isNotNull(), LABELLED_CONFIDENCE).otherwise(BARE_CONFIDENCE)
    return numbered.select(
        key, "page_no", (F.col("_at") + F.col("i")).alias("row_no"), F.when(~is_kv, 0).when(kv["kind"] == "numbered", 1).otherwise(2).alias("col_no"),
        F.concat(F.format_string("p%04d:", "page_no"), F.when(is_kv, "kv").otherwise("text")).alias("table_id"), F.when(is_kv, "kv_line").otherwise("toc_row").alias("record_type"),
        F.when(is_kv, kv["label"]).otherwise("text_line").alias("metric_name"), F.when(is_kv, kv["value"]).alias("value"), F.when(is_kv, kv["value_text"]).otherwise(F.col("r.line")).alias("value_text"),
        F.when(is_kv, kv["kind"]).otherwise("text_fallback").alias("line_type"), F.when(is_kv, sure).otherwise(TEXT_CONFIDENCE).alias("confidence"),
        F.when(is_kv & (sure > BARE_CONFIDENCE), "medium").otherwise("low").alias("quality"), F.col("r.line").alias("raw_line"),
    )
