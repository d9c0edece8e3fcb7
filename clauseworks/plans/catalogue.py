"""Queries of the core: (spark, sf_dir) -> DataFrame, each with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseworks.functions import metadata as md
from clauseworks.functions import rules
from clauseworks.functions import text as tx
from clauseworks.operators import checks, collect, graph, provisions as pv, quality, references, search
from clauseworks.plans import oracle
from clauseworks.session import checkpointed, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf, n) for n in names}


# problem 5


@_query
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    found = references.all_orphans(_tables(spark, sf, "documents", "provisions", "requirements"))
    return found.select("field_name", "rec_id", "reason", "period").distinct()


@_query
def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    return references.orphan_report(_tables(spark, sf, "documents", "provisions", "requirements"))


# sources (S) and text functions (T)


@_query
def tag_union_merge(spark: SparkSession, sf: str) -> DataFrame:
    merged = pv.merged_tags(table(spark, sf, "tags"))
    return merged.select("id", F.array_join("topics", ",").alias("topics"), F.array_join("entities", ",").alias("entities"))


@_query
def tag_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    joined = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), ",")
    tags = table(spark, sf, "tags").select("id", joined("topics").alias("topics"), joined("entities").alias("entities"))
    return pv.last_tags(tags, [F.col("topics"), F.col("entities")])


@_query
def slugify(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.slugify(F.col("title")).alias("slug"))


@_query
def clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    c = tx.normalise_standard_tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(c).alias("md5"), F.length(c).alias("n"))


@_query
def clean_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    c = tx.drop_breaks(tx.split_joined_english(tx.drop_pictures(F.col("source_text"))))
    return table(spark, sf, "documents").select("doc_id", F.md5(c).alias("md5"), F.length(c).alias("n"))


@_query
def unwrap_brackets(spark: SparkSession, sf: str) -> DataFrame:
    c = tx.unwrap_brackets(F.col("text"))
    return table(spark, sf, "provisions").select("provision_id", F.md5(c).alias("md5"), F.length(c).alias("n"))


@_query
def cjk_collapse(spark: SparkSession, sf: str) -> DataFrame:
    c = tx.collapse_cjk_gaps(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(c).alias("md5"), F.length(c).alias("n"))


@_query
def blank_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = tx.collapse_blank_lines(F.col("source_text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(c).alias("md5"), F.length(c).alias("n"))


@_query
def table_title_dedup(spark: SparkSession, sf: str) -> DataFrame:
    # a table under the document's title whose first row says the title again
    titled = F.concat("source_text", F.lit("\n"), "title", F.lit("\nof\n| "), "title", F.lit(" |\n|---|"))
    docs = table(spark, sf, "documents").withColumn("source_text", titled).where("source_text is not null")
    lines = tx.lines_of(docs, "doc_id", "source_text")
    return tx.table_title_lines(lines, "doc_id").where("repeats").select("doc_id", "pos", "line")


@_query
def page_noise(spark: SparkSession, sf: str) -> DataFrame:
    lines = tx.lines_of(table(spark, sf, "documents").where("source_text is not null"), "doc_id", "source_text")
    return tx.page_noise_lines(lines, "doc_id").where("noise").select("doc_id", "pos", "line")


@_query
def clean_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    done = tx.cleaned(table(spark, sf, "documents").where("source_text is not null"), "doc_id", "source_text")
    return done.select("doc_id", F.length("source_text").alias("n"), F.md5("source_text").alias("md5"))


@_query
def quality_assess(spark: SparkSession, sf: str) -> DataFrame:
    pages = F.lit(2)
    docs = table(spark, sf, "documents").where("source_text is not null")
    return docs.select("doc_id", *[c.alias(n) for n, c in tx.quality(F.col("source_text"), pages).items()])


@_query
def ocr_required(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "provisions").where("document_id is not null")
    enough = F.length(tx.strip(F.coalesce("text", F.lit("")))) > rules.TEXT_PAGE
    return pages.groupBy("document_id").agg(F.count_if(enough).alias("n_text_pages"), (F.count_if(enough) < rules.FEW_TEXT_PAGES).alias("ocr_required"))


@_query
def engine_selection(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "provisions").where("document_id is not null").groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("chars"))
    docs = table(spark, sf, "documents").where("document_id is not null").groupBy("document_id").agg(F.bool_or("ocr_required").alias("ocr"))
    engine = F.when(~F.coalesce("ocr", F.lit(False)) & (F.col("pages") >= rules.HEAVY_PAGES), "layout").when(F.col("chars") < rules.SPARSE, "fallback").otherwise("plain")
    return pages.join(docs, "document_id", "left").select("document_id", "pages", engine.alias("engine"))


@_query
def html_title(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("source_text is not null")
    return docs.select("doc_id", tx.html_title(F.col("source_text"), F.col("document_id")).alias("title"))


@_query
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("source_text is not null")
    return docs.select("doc_id", F.md5(tx.html_markdown(F.col("source_text"))).alias("md5"))


@_query
def attachments(spark: SparkSession, sf: str) -> DataFrame:
    page = F.concat(F.lit('<p><a class="x" href="'), "raw_path", F.lit('">a</a> <A HREF="/b/C.DOCX">b</A> <a href="c.html">c</a></p>'))
    docs = table(spark, sf, "documents").where("raw_path is not null")
    links = tx.attachment_links(page, F.coalesce("source_url", F.lit("https://files.example.org/x/y")))
    return docs.select("doc_id", F.array_join(links, " ").alias("links"))


@_query
def snippets(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions")
    return p.select("provision_id", tx.shortened(F.col("text"), rules.SNIPPET).alias("snippet"), tx.like_escaped(F.left("text", F.lit(40))).alias("like_escaped"), tx.has_cjk(F.col("text")).alias("has_cjk"))


# classification and metadata (C)


@_query
def classify(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", md.standard_type(F.col("text")).alias("by_text"), md.standard_type(F.col("standard_id")).alias("by_id"), md.standard_type(F.col("raw_path")).alias("by_path"), md.raw_folder(F.col("document_type")).alias("folder"))


@_query
def standard_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", md.standard_id(F.col("text")).alias("from_text"), md.standard_id_from_path(F.col("raw_path")).alias("from_path"))


@_query
def titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", md.title(F.coalesce("source_text", F.lit("")), F.col("raw_path")).alias("title"))


def _dated() -> F.Column:
    """Texts with dates in each shape, from the documents' own dates."""
    r, e, kind = F.col("release_date"), F.col("effective_date"), F.pmod(F.col("doc_id"), F.lit(5))
    han = lambda d: F.concat(F.left(d, F.lit(4)), F.lit("年"), F.substring(d, 6, 2), F.lit("月"), F.substring(d, 9, 2), F.lit("日"))
    return (
        F.when(kind == 0, F.concat(F.lit("发布日期："), r, F.lit("\n实施 "), F.replace(e, F.lit("-"), F.lit("/"))))
        .when(kind == 1, F.concat(r, F.lit(" 发布\n"), e, F.lit(" 实施")))
        .when(kind == 2, F.concat(F.replace(r, F.lit("-"), F.lit("")), F.lit("发布\n"), F.replace(e, F.lit("-"), F.lit("")), F.lit(" effective")))
        .when(kind == 3, F.concat(r, F.lit(" (first) release\n"), e, F.lit(" is effective")))
        .otherwise(F.concat(F.lit("公布："), han(r), F.lit("\n施行 "), han(e)))
    )


@_query
def dates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("body", _dated())
    return docs.select("doc_id", md.release_date(F.col("body")).alias("release"), md.effective_date(F.col("body")).alias("effective"))


@_query
def publisher(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    named = F.concat(F.coalesce("text", F.lit("")), F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(F.lit("\n发布部门： "), "publisher")).when(F.pmod("doc_id", F.lit(3)) == 1, F.concat(F.lit("\nIssued by: "), "publisher")).otherwise(""))
    return docs.select("doc_id", md.publisher(named).alias("found"))


@_query
def publisher_directory(spark: SparkSession, sf: str) -> DataFrame:
    docs, known = table(spark, sf, "documents"), table(spark, sf, "publishers")
    return docs.join(known, "publisher", "left").groupBy("publisher", "jurisdiction").agg(F.count(F.lit(1)).alias("n"))


# splitting, obligations, tags (P, R, K, W13)


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return pv.split_provisions(pv.latest_documents(table(spark, sf, "documents")))


@_query
def split_provisions(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("document_id", "provision_id", "label", "kind", "title", "occurrence", "source_offset", "confidence", F.md5("text").alias("md5"))


@_query
def provision_kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@_query
def requirements_extracted(spark: SparkSession, sf: str) -> DataFrame:
    found = pv.extract_requirements(_split(spark, sf))
    return found.select("requirement_id", "document_id", "provision_id", "modality", "confidence", F.md5("evidence_quote").alias("md5"))


@_query
def modality_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return pv.extract_requirements(_split(spark, sf)).groupBy("document_id", "modality").agg(F.count(F.lit(1)).alias("n"))


@_query
def modality_of_provisions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "provisions").groupBy(pv.modality_of(F.col("text")).alias("modality")).agg(F.count(F.lit(1)).alias("n"))


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions")
    return pv.tagged(p, pv.tagging_text(F.col("text"), F.col("title"), F.col("source_text"), F.col("evidence.quote")))


@_query
def tag_topics(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf).select("provision_id", F.array_join("topics", ",").alias("topics"), F.array_join("entities", ",").alias("entities"))


@_query
def tagged_records(spark: SparkSession, sf: str) -> DataFrame:
    both = pv.tagged_records(table(spark, sf, "provisions"), table(spark, sf, "requirements"))
    return both.select("record_type", "id", F.array_join("topics", ",").alias("topics"), F.array_join("entities", ",").alias("entities"))


@_query
def matched_keywords(spark: SparkSession, sf: str) -> DataFrame:
    exploded = _tagged(spark, sf).select("provision_id", F.explode("topic_keywords").alias("topic", "words"))
    return exploded.select("topic", F.explode("words").alias("keyword")).groupBy("topic", "keyword").agg(F.count(F.lit(1)).alias("n"))


@_query
def tag_junction(spark: SparkSession, sf: str) -> DataFrame:
    return pv.junction(table(spark, sf, "tags"), "topics", "topic")


@_query
def provision_tags(spark: SparkSession, sf: str) -> DataFrame:
    joined = collect.with_tags(table(spark, sf, "provisions").select("provision_id").distinct(), table(spark, sf, "tags"))
    return joined.select("provision_id", F.array_join("topics", ",").alias("topics"), F.size("entities").alias("n_entities"))


@_query
def requirement_tags(spark: SparkSession, sf: str) -> DataFrame:
    joined = collect.requirement_tags(table(spark, sf, "requirements").select("requirement_id", "provision_id").distinct(), table(spark, sf, "tags"))
    return joined.select("requirement_id", "provision_id", F.array_join("topics", ",").alias("topics"))


# collection (J, W, A12, X5, X6)


@_query
def draft_merge(spark: SparkSession, sf: str) -> DataFrame:
    meta = table(spark, sf, "documents").where("document_id is not null").groupBy("document_id").agg(F.max("title").alias("title"), F.max("review_status").alias("review_status"))
    drafts = table(spark, sf, "provisions").where("document_id is not null").groupBy("document_id").agg(F.max("title").alias("title"), F.concat(F.lit("drafts/"), F.max("document_id"), F.lit(".md")).alias("draft_path"))
    return collect.merge_drafts(meta, drafts)


@_query
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf, "documents", "provisions", "requirements")
    docs = collect.duplicate_ids(t["documents"], "document_id", "document", False)
    provs = collect.duplicate_ids(t["provisions"], "provision_id", "provision", True)
    return docs.unionByName(provs).unionByName(collect.duplicate_ids(t["requirements"], "requirement_id", "requirement", True))


@_query
def effective_dates_index(spark: SparkSession, sf: str) -> DataFrame:
    return collect.dates_index(pv.latest_documents(table(spark, sf, "documents")))


@_query
def exported_documents(spark: SparkSession, sf: str) -> DataFrame:
    return collect.exported_documents(pv.latest_documents(table(spark, sf, "documents"))).select("document_id", "title", "publisher", F.md5("record").alias("md5"))


@_query
def manifest_counts(spark: SparkSession, sf: str) -> DataFrame:
    return collect.manifest(_tables(spark, sf, "documents", "provisions", "requirements", "tags", "jobs"))


@_query
def duplicate_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return collect.fingerprints(table(spark, sf, "documents"))


@_query
def provision_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions").groupBy("provision_id").agg(F.max("review_status").alias("review_status"), F.max("label").alias("label"), F.max("text").alias("text")).where("provision_id is not null")
    r = table(spark, sf, "requirements").groupBy("requirement_id").agg(F.max("provision_id").alias("provision_id"), F.max("modality").alias("modality"))
    return collect.rendered_provisions(p, r).select("provision_id", F.md5("page").alias("md5"))


@_query
def timeline(spark: SparkSession, sf: str) -> DataFrame:
    docs = pv.latest_documents(table(spark, sf, "documents"))
    events = F.explode(F.array(*[F.struct(F.lit(k).alias("event"), F.col(f"{k}_date").alias("day")) for k in ("release", "effective")]))
    return docs.select("document_id", events.alias("e")).where("e.day is not null").groupBy(F.left("e.day", F.lit(7)).alias("month"), F.col("e.event").alias("event")).agg(F.count(F.lit(1)).alias("n"))


# audits and validation (A, V)


@_query
def audit_short(spark: SparkSession, sf: str) -> DataFrame:
    return quality.short_provisions(table(spark, sf, "provisions").withColumn("text", F.col("label")))  # the texts themselves are long


@_query
def audit_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fallback_only(table(spark, sf, "provisions"))


@_query
def audit_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_labels(table(spark, sf, "provisions"))


@_query
def audit_toc(spark: SparkSession, sf: str) -> DataFrame:
    entry = F.concat("label", F.lit("  Scope "), F.lit(" ..... "), F.col("locator.source_offset").cast("string"))  # provisions as a table of contents lists them
    return quality.toc_noise(table(spark, sf, "provisions").withColumn("text", entry))


@_query
def audit_density(spark: SparkSession, sf: str) -> DataFrame:
    return quality.density(table(spark, sf, "provisions"), table(spark, sf, "requirements"))


@_query
def audit_weak_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return quality.weak_evidence(table(spark, sf, "requirements"))


@_query
def audit_total(spark: SparkSession, sf: str) -> DataFrame:
    return quality.audit(table(spark, sf, "provisions"), table(spark, sf, "requirements"))


@_query
def keyword_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.keyword_counts(table(spark, sf, "provisions"), table(spark, sf, "requirements"), list(oracle.KEYWORDS))


@_query
def validate_documents(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_documents(table(spark, sf, "documents"))


@_query
def validate_provisions(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_provisions(table(spark, sf, "provisions"))


@_query
def validate_requirements(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_requirements(table(spark, sf, "requirements"))


@_query
def validation_totals(spark: SparkSession, sf: str) -> DataFrame:
    every = validate_documents(spark, sf).unionByName(validate_provisions(spark, sf)).unionByName(validate_requirements(spark, sf))
    return every.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


# search (Q)


@_query
def search_substring(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf, "documents", "provisions", "requirements")
    return search.substring_search(t["documents"], t["provisions"], t["requirements"], "BEARING", 40)


def _mode(mode: str, query: str, **options) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return search.search_mode(table(spark, sf, mode), mode, query, limit=None, tags=table(spark, sf, "tags"), **options)

    return run


_QUERIES["search_documents"] = _mode("documents", "标志")
_QUERIES["search_provisions"] = _mode("provisions", "制动 隔热")
_QUERIES["search_requirements"] = _mode("requirements", "housing must", review_status="reviewed")
_QUERIES["search_filtered"] = _mode("provisions", "不得", review_status="reviewed")
_QUERIES["search_topic_entity"] = _mode("provisions", "应", topic="seats", entity="component")


@_query
def search_all(spark: SparkSession, sf: str) -> DataFrame:
    return search.search_all(_tables(spark, sf, "documents", "provisions", "requirements"), "制动", 20)


@_query
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25(table(spark, sf, "provisions"), "provision_id", "text", "brake heated", 20).select("id", F.round("score", 6).alias("score"))


@_query
def search_trigram(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions")
    return search.search_postings(search.postings(p, "provision_id", "text"), p, "provision_id", "text", "Bearing")


# graph (G, X1..X4)


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t = _tables(spark, sf, "documents", "provisions", "requirements", "tags")
    args = t["documents"], t["provisions"], t["requirements"], t["tags"]
    return graph.nodes(*args), graph.edges(*args)


@_query
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _graph(spark, sf)[0]


@_query
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _graph(spark, sf)[1]


@_query
def graph_props(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf, "documents", "provisions", "requirements")
    return graph.node_props(t["documents"], t["provisions"], t["requirements"]).select("id", "type", F.explode("props").alias("name", "value"))


@_query
def graph_assembled(spark: SparkSession, sf: str) -> DataFrame:
    return graph.assemble(*map(checkpointed, _graph(spark, sf)))[1].groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@_query
def graph_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return graph.dangling(*map(checkpointed, _graph(spark, sf)))


@_query
def graph_subsection(spark: SparkSession, sf: str) -> DataFrame:
    return graph.subsections(table(spark, sf, "provisions"))


@_query
def graph_next(spark: SparkSession, sf: str) -> DataFrame:
    return graph.neighbours(table(spark, sf, "provisions"))


@_query
def graph_version_chain(spark: SparkSession, sf: str) -> DataFrame:
    return graph.version_chains(table(spark, sf, "documents"))


@_query
def graph_citations(spark: SparkSession, sf: str) -> DataFrame:
    return graph.citations(table(spark, sf, "provisions"), table(spark, sf, "documents"))


@_query
def topic_requirements(spark: SparkSession, sf: str) -> DataFrame:
    return graph.topic_requirements(table(spark, sf, "requirements"), table(spark, sf, "tags"))


# checks, review, jobs (E, N, B)


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    """One check of several types for every document."""
    docs = table(spark, sf, "documents").where("document_id is not null").select("document_id").distinct()
    make = lambda kind, **e: F.struct(F.concat(F.lit(kind + ":"), "document_id").alias("id"), F.lit(kind).alias("type"), F.create_map(*[x for k, v in e.items() for x in (F.lit(k), v)]).alias("expected"))
    d = F.col("document_id")
    kinds = [
        make("document_id_exists", document_id=d),
        make("provision_label_exists", document_id=d, label=F.lit("2.1")),
        make("requirement_modality_exists", document_id=d, modality=F.lit("must")),
        make("topic_tag_exists", document_id=d, topic=F.lit("seats")),
        make("evidence_quote_exists", document_id=d, quote_substring=F.lit("shall")),
        make("metadata_field_equals", document_id=d, field=F.lit("review_status"), value=F.lit("draft")),
        make("no_such_type", document_id=d),
    ]
    return docs.select(F.explode(F.array(*kinds)).alias("c")).select("c.*").withColumn("severity", F.lit("error"))


@_query
def checks_run(spark: SparkSession, sf: str) -> DataFrame:
    return checks.run(_checks(spark, sf), _tables(spark, sf, "documents", "provisions", "requirements", "tags"))


@_query
def checks_more(spark: SparkSession, sf: str) -> DataFrame:
    """The checks that count, search and look into the graph, and those with further conditions."""
    t = _tables(spark, sf, "documents", "provisions", "requirements", "tags", "jobs")
    docs = t["documents"].where("document_id is not null").select("document_id").distinct()
    make = lambda name, kind, **e: F.struct(name.alias("id"), F.lit(kind).alias("type"), F.create_map(*[x for k, v in e.items() for x in (F.lit(k), v if not isinstance(v, str) else F.lit(v))]).alias("expected"))
    d, named = F.col("document_id"), lambda prefix: F.concat(F.lit(prefix + ":"), "document_id")
    each = docs.select(F.explode(F.array(
        make(named("label"), "evidence_quote_exists", document_id=d, quote_substring="shall", label="2.1"), make(named("within"), "evidence_quote_exists", document_id=d, quote_substring="shall", label="2-1"),
        make(named("id"), "evidence_quote_exists", document_id=d, quote_substring="shall", id=F.concat("document_id", F.lit("-1"))),
        make(named("node"), "graph_node_exists", id=d, type="Document"), make(named("other"), "graph_node_exists", id=d, type="Topic"), make(named("edge"), "graph_edge_exists", source=d, target=F.concat("document_id", F.lit("-1")), type="HAS_PROVISION"),
    )).alias("c")).select("c.*")
    numbers = t["documents"].where("standard_id is not null").select(F.col("standard_id").alias("document_id")).distinct()
    by_number = numbers.select(make(named("number"), "metadata_field_equals", document_id=d, field="document_type", value="standard").alias("c")).select("c.*")
    fixed = [
        ("keyword", "keyword_search", {"keyword": "制动", "min_count": "1"}), ("no keyword", "keyword_search", {"keyword": "zzzz", "min_count": "1"}), ("table", "sqlite_table_row_count", {"table": "jobs", "min_count": "1"}), ("no table", "sqlite_table_row_count", {"table": "none"}),
        ("hits", "sqlite_fts_result", {"query": "制动", "mode": "provisions", "min_count": "20"}), ("more hits than the limit", "sqlite_fts_result", {"query": "制动", "mode": "provisions", "min_count": "21"}), ("whole graph", "graph_edge_integrity", {}),
    ]
    every = each.unionByName(by_number).unionByName(spark.createDataFrame(fixed, "id string, type string, expected map<string,string>")).withColumn("severity", F.lit("warn"))
    return checks.run(checkpointed(every), t, *map(checkpointed, _graph(spark, sf)))


@_query
def check_totals(spark: SparkSession, sf: str) -> DataFrame:
    return checks.totals(checks_run(spark, sf))


def _reviewed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "requirements").where("review_status = 'reviewed' and provision_id is not null").select("provision_id")


@_query
def review_mark(spark: SparkSession, sf: str) -> DataFrame:
    return checks.mark_reviewed(checks.review_manifest(table(spark, sf, "provisions")), _reviewed(spark, sf))


@_query
def review_promote(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions")
    return checks.promote(checks.mark_reviewed(checks.review_manifest(p), _reviewed(spark, sf)), p)[0]


@_query
def review_missing(spark: SparkSession, sf: str) -> DataFrame:
    wanted = _reviewed(spark, sf).withColumn("review_status", F.lit("reviewed"))
    return checks.promote(wanted, table(spark, sf, "provisions"))[1]


@_query
def review_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "provisions")
    done = checks.promote(checks.mark_reviewed(checks.review_manifest(p), _reviewed(spark, sf)), p)[0]
    return checks.reviewed_pages(done, p).select("provision_id", F.md5("page").alias("md5"))


def _restarted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The jobs after every pending one and one that doesn't exist are set to running."""
    jobs = table(spark, sf, "jobs")
    changes = checks.listed_jobs(jobs, "pending").select("job_id", F.lit("running").alias("status"), F.lit(None).cast("string").alias("error"))
    absent = spark.createDataFrame([("no such job", "running", None)], changes.schema)
    return checks.updated_jobs(jobs, changes.unionByName(absent), "2099-01-01T00:00:00Z")


@_query
def job_updates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.listed_jobs(_restarted(spark, sf)[0], "running")


@_query
def jobs_not_found(spark: SparkSession, sf: str) -> DataFrame:
    return _restarted(spark, sf)[1]


@_query
def job_creation(spark: SparkSession, sf: str) -> DataFrame:
    new = table(spark, sf, "documents").where("raw_path is not null").groupBy(F.concat(F.lit("import:"), "raw_path").alias("job_id"), F.col("raw_path").alias("input")).agg(F.lit("pdf").alias("input_type"))
    return checks.listed_jobs(checks.created_jobs(table(spark, sf, "jobs"), new, "2099-01-01T00:00:00Z"), "pending")


@_query
def latest_job_state(spark: SparkSession, sf: str) -> DataFrame:
    return checks.latest_jobs(table(spark, sf, "jobs")).select("job_id", "status", "created_at", "updated_at")


@_query
def job_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.job_counts(table(spark, sf, "jobs"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Obligations of each modality per document: split, detect, count."""
    return modality_distribution(spark, sf)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
