"""Declarative checks, review states and job states.

Checks are rows (id, type, expected map); every type is one branch of set
operations over the record tables, so any number of checks costs one pass per
type. Defined results: a check with an unknown type or severity or a missing expectation fails;
null equals null in ``metadata_field_equals``; ids absent everywhere fail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.functions import rules
from clauseworks.functions.text import shortened
from clauseworks.operators import search
from clauseworks.operators.collect import manifest
from clauseworks.operators.quality import keyword_counts

SCHEMA = "id string, type string, severity string, expected map<string,string>"


def _exists(checks: DataFrame, kind: str, on: dict[str, str], rows: DataFrame) -> DataFrame:
    """Checks of one kind pass where ``rows`` has their expected values (column -> expected key)."""
    mine = checks.where(F.col("type") == kind).select("id", *[F.col("expected")[k].alias(c) for c, k in on.items()])
    passed = mine.join(rows.select(*on).distinct(), list(on), "left_semi").select("id").withColumn("passed", F.lit(True))
    return mine.select("id").join(passed, "id", "left").select("id", F.coalesce("passed", F.lit(False)).alias("passed"))


def _quoted(checks: DataFrame, provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """Evidence checks against texts, titles and quotes of provisions and requirements of the document.

    ``label`` and ``id``, where stated, have to fit: a provision's own, a requirement's
    id and the label within its provision_id. Checks are a table far smaller than the
    records and go out by Spark's own size check.
    """
    e = F.col("expected")
    mine = checks.where(F.col("type") == "evidence_quote_exists").select("id", e["document_id"].alias("document_id"), e["quote_substring"].alias("needle"), e["label"].alias("wanted_label"), e["id"].alias("wanted_id"))
    columns = ("document_id", "own_id", "own_label", "provision_of")
    texts = lambda *cs: F.explode(F.array_distinct(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in cs]))).alias("body")
    rows = provisions.select("document_id", F.col("provision_id").alias("own_id"), F.col("label").alias("own_label"), F.lit(None).cast("string").alias("provision_of"), texts("text", "title", "evidence.quote"))
    rows = rows.unionByName(requirements.select("document_id", F.col("requirement_id").alias("own_id"), F.lit(None).cast("string").alias("own_label"), F.coalesce("provision_id", F.lit("")).alias("provision_of"), texts("evidence_quote")))
    fits = F.col("wanted_label").isNull() | F.coalesce(F.contains("provision_of", "wanted_label"), F.col("own_label") == F.col("wanted_label"), F.lit(False))
    fits = fits & (F.col("wanted_id").isNull() | F.col("own_id").eqNullSafe(F.col("wanted_id")))
    joined = mine.join(rows.select(*columns, "body"), "document_id").where((F.col("needle") != "") & F.contains("body", "needle") & fits)
    hit = joined.select("id").distinct().withColumn("passed", F.lit(True))
    return mine.select("id").join(hit, "id", "left").select("id", F.coalesce("passed", F.lit(False)).alias("passed"))


def keyword_totals(checks: DataFrame, provisions: DataFrame, requirements: DataFrame, at_once: int = 200) -> DataFrame:
    """(name, n) of the keywords that ``keyword_search`` checks ask for; one pass over the records per ``at_once`` keywords."""
    asked = checks.where(F.col("type") == "keyword_search").select(F.col("expected")["keyword"].alias("k")).where("k <> ''").distinct()
    words = sorted(r["k"] for r in asked.collect())  # as many as checks state
    out = checks.sparkSession.createDataFrame([], "name string, n long")
    for lo in range(0, len(words), at_once):
        out = out.unionByName(keyword_counts(provisions, requirements, words[lo : lo + at_once]).withColumnRenamed("keyword", "name"))
    return out


def search_totals(checks: DataFrame, tables: dict[str, DataFrame], limit: int = 20) -> DataFrame:
    """(query, mode, n) of the searches that ``sqlite_fts_result`` checks ask for; an unknown mode has no row."""
    e = F.col("expected")
    asked = checks.where(F.col("type") == "sqlite_fts_result").select(e["query"].alias("q"), e["mode"].alias("m")).distinct().where("q is not null").collect()
    out = checks.sparkSession.createDataFrame([], "query string, mode string, n long")
    for q, m in sorted((r["q"], r["m"] or "all") for r in asked):
        if m in search.MODES:
            hits = search.search_all(tables, q, limit) if m == "all" else search.search_mode(tables[m], m, q, limit)
            out = out.unionByName(hits.agg(F.count(F.lit(1)).alias("n")).select(F.lit(q).alias("query"), F.lit(m).alias("mode"), "n"))
    return out


def run(checks: DataFrame, tables: dict[str, DataFrame], node_table: DataFrame | None = None, edge_table: DataFrame | None = None, counts: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """(id, type, category, severity, passed) of every check.

    Keyword, table and search checks count for themselves; ``counts`` (name, n) and
    ``hits`` (query, mode, n) take the place of their counts where given. Checks on
    absent inputs fail.
    """
    docs, provs, reqs, tags = (tables[n] for n in ("documents", "provisions", "requirements", "tags"))
    ids = docs.select("document_id").union(provs.select("document_id")).union(reqs.select("document_id"))
    parts = [
        _exists(checks, "document_id_exists", {"document_id": "document_id"}, ids),
        _exists(checks, "provision_label_exists", {"document_id": "document_id", "label": "label"}, provs),
        _exists(checks, "requirement_modality_exists", {"document_id": "document_id", "modality": "modality"}, reqs),
        _exists(checks, "topic_tag_exists", {"document_id": "document_id", "topic": "topic"}, tags.select("document_id", F.explode("topics").alias("topic"))),
        _quoted(checks, provs, reqs),
    ]
    fields = [F.struct(F.lit(f.name).alias("field"), F.col(f.name).cast("string").alias("value")) for f in docs.schema.fields if f.name not in ("text", "source_text")]
    # the first record by document_id or standard_id decides; an unknown field is null, an unknown document fails
    equal = checks.where("type = 'metadata_field_equals'").select("id", F.col("expected")["document_id"].alias("key"), F.col("expected")["field"].alias("field"), F.col("expected")["value"].alias("wanted"))
    order = F.col("doc_id") if "doc_id" in docs.columns else F.lit(0)
    keyed = docs.select(F.explode(F.array_distinct(F.array("document_id", "standard_id"))).alias("key"), order.alias("at"), "document_id", F.map_from_entries(F.array(*fields)).alias("values"))
    first = keyed.join(equal.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min_by("values", F.struct("at", "document_id")).alias("values"))
    parts.append(equal.join(first, "key", "left").select("id", (F.col("values").isNotNull() & F.try_element_at("values", F.col("field")).eqNullSafe(F.col("wanted"))).alias("passed")))
    if counts is None:
        counts = keyword_totals(checks, provs, reqs).unionByName(manifest(tables).select(F.col("table_name").alias("name"), F.col("n_rows").alias("n")))
    if hits is None:
        hits = search_totals(checks, tables)
    if counts is not None:
        for kind, key in (("keyword_search", "keyword"), ("sqlite_table_row_count", "table")):
            mine = checks.where(F.col("type") == kind).select("id", F.col("expected")[key].alias("name"), F.coalesce(F.col("expected")["min_count"].cast("long"), F.lit(0)).alias("least"))
            parts.append(mine.join(counts, "name", "left").select("id", (F.coalesce("n", F.lit(-1)) >= F.col("least")).alias("passed")))
    if hits is not None:
        mine = checks.where("type = 'sqlite_fts_result'").select("id", F.col("expected")["query"].alias("query"), F.coalesce(F.col("expected")["mode"], F.lit("all")).alias("mode"), F.col("expected")["min_count"].cast("long").alias("least"))
        parts.append(mine.join(hits, ["query", "mode"], "left").select("id", (F.coalesce("n", F.lit(0)) >= F.coalesce("least", F.lit(0))).alias("passed")))
    if node_table is not None:
        once = node_table.groupBy(F.col("id").alias("node_id")).agg(F.min("type").alias("node_type"))
        mine = checks.where("type = 'graph_node_exists'").select("id", F.col("expected")["id"].alias("node_id"), F.col("expected")["type"].alias("wanted"))
        parts.append(mine.join(once, "node_id", "left").select("id", (F.col("node_type").isNotNull() & (F.col("wanted").isNull() | (F.col("wanted") == F.col("node_type")))).alias("passed")))
    if node_table is not None and edge_table is not None:
        parts.append(_exists(checks.withColumn("id", F.col("id")), "graph_edge_exists", {"source": "source", "target": "target", "edge": "type"}, edge_table.withColumnRenamed("type", "edge")))
        from clauseworks.operators.graph import dangling

        whole = dangling(node_table, edge_table).agg((F.count(F.lit(1)) == 0).alias("passed"))
        parts.append(checks.where("type = 'graph_edge_integrity'").select("id").crossJoin(whole))  # one row
    done = parts[0]
    for p in parts[1:]:
        done = done.unionByName(p)
    category = F.create_map(*[F.lit(x) for kv in rules.CHECK_CATEGORIES.items() for x in kv])
    severity = F.coalesce("severity", F.lit("error"))
    stated = F.col("expected").isNotNull() & severity.isin(*rules.SEVERITIES)
    return checks.join(done, "id", "left").select(
        "id", "type", F.coalesce(F.element_at(category, F.col("type")), F.lit("missed_document")).alias("category"),
        severity.alias("severity"), (stated & F.coalesce("passed", F.lit(False))).alias("passed"),
    )


def totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"))


# review


def review_manifest(provisions: DataFrame) -> DataFrame:
    """One pending row per provision: label, title, locator (label and offset), confidence and the opening of its quote."""
    quote = shortened(F.coalesce("evidence.quote", F.lit("")), rules.SHORT_QUOTE, "...")
    where = F.concat_ws("@", "locator.label", F.col("locator.source_offset").cast("string"))
    most = [F.max(c).alias(n) for n, c in (("label", F.col("label")), ("title", F.col("title")), ("locator", where), ("confidence", F.col("confidence")), ("short_quote", quote))]
    return provisions.where("provision_id is not null").groupBy("provision_id").agg(*most).withColumn("review_status", F.lit("pending"))


MANIFEST = "provision_id string, label string, title string, locator string, confidence string, short_quote string, review_status string"


def save_manifest(manifest_: DataFrame, path: str) -> None:
    """As JSON lines, one per provision."""
    manifest_.select(*[c.split()[0] for c in MANIFEST.split(", ")]).write.mode("overwrite").json(path, ignoreNullFields=False)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path, mode="FAILFAST")


def reviewed_pages(promoted: DataFrame, provisions: DataFrame) -> DataFrame:
    """(provision_id, page) of promoted provisions: status, label and text as Markdown."""
    text = provisions.where("provision_id is not null").groupBy("provision_id").agg(F.max("text").alias("text"))
    head = F.concat(F.lit("---\nprovision_id: "), "provision_id", F.lit("\nreview_status: "), "review_status", F.lit("\n---\n\n# "), F.coalesce("label", F.lit("")), F.lit("\n\n"))
    return promoted.join(text, "provision_id").select("provision_id", F.concat(head, F.coalesce("text", F.lit(""))).alias("page"))


def mark_reviewed(manifest: DataFrame, ids: DataFrame) -> DataFrame:
    """The manifest with the given provision_ids reviewed; earlier marks stay."""
    marked = ids.select("provision_id").distinct().withColumn("_hit", F.lit(True))
    status = F.when(F.col("_hit"), "reviewed").otherwise(F.col("review_status"))
    return manifest.join(marked, "provision_id", "left").withColumn("review_status", status).drop("_hit")


def promote(manifest: DataFrame, provisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviewed provisions to write out, and reviewed ids that the candidates lack."""
    wanted = manifest.where("review_status = 'reviewed'").select("provision_id").distinct()
    have = provisions.where("provision_id is not null").groupBy("provision_id").agg(F.max("label").alias("label"))
    return have.join(wanted, "provision_id", "left_semi").withColumn("review_status", F.lit("reviewed")), wanted.join(have, "provision_id", "left_anti")


# jobs


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """The last state of every job: by update, else creation time; ties by status."""
    order = [F.desc_nulls_last(F.coalesce("updated_at", "created_at")), F.desc("status"), F.desc_nulls_last("error"), F.desc_nulls_last("input")]
    nth = F.row_number().over(Window.partitionBy("job_id").orderBy(*order))
    return jobs.where("job_id is not null").withColumn("_nth", nth).where("_nth = 1").drop("_nth")


JOB_COLUMNS = ("job_id", "input_type", "input", "status", "created_at", "updated_at", "error")


def created_jobs(jobs: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """``jobs`` with a pending row for every (job_id, input_type, input) of ``new``; states are appended, never overwritten."""
    rows = new.select("job_id", "input_type", "input", F.lit("pending").alias("status"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"), F.lit(None).cast("string").alias("error"))
    return jobs.select(*JOB_COLUMNS).unionByName(rows)


def updated_jobs(jobs: DataFrame, changes: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """``jobs`` with a further state per (job_id, status, error) of ``changes``, and the job_ids that don't exist.

    A null error keeps the earlier one; statuses other than the four known ones are an error.
    """
    known = F.when(F.col("new_status").isin(*rules.JOB_STATES), F.col("new_status")).otherwise(F.raise_error(F.concat(F.lit("unknown job status "), F.coalesce("new_status", F.lit("null")))))
    asked = changes.select("job_id", F.col("status").alias("new_status"), F.col("error").alias("new_error"))
    last = latest_jobs(jobs)
    rows = last.join(asked, "job_id").select("job_id", "input_type", "input", known.alias("status"), "created_at", F.lit(now).alias("updated_at"), F.coalesce("new_error", "error").alias("error"))
    return jobs.select(*JOB_COLUMNS).unionByName(rows), asked.join(last, "job_id", "left_anti").select("job_id")


def job(jobs: DataFrame, job_id: str) -> dict | None:
    """The last state of one job, None if there is none."""
    row = latest_jobs(jobs.where(F.col("job_id") == job_id)).select(*JOB_COLUMNS).first()
    return row.asDict() if row else None


def listed_jobs(jobs: DataFrame, status: str | None = None) -> DataFrame:
    """The last state of every job, or of those in one status."""
    last = latest_jobs(jobs).select(*JOB_COLUMNS)
    return last if status is None else last.where(F.col("status") == status)


def job_counts(jobs: DataFrame) -> DataFrame:
    return latest_jobs(jobs).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
