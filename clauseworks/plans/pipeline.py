"""Whole runs: ingest of page texts, and compile -> split -> extract -> tag -> validate -> report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseworks.functions import metadata as md
from clauseworks.functions import text as tx
from clauseworks.operators import provisions as pv, quality


def ingest_texts(texts: DataFrame) -> DataFrame:
    """Document records of extracted texts (document_id, raw_path, text[, pages]).

    A text that cannot be used (null or blank) becomes a row with status ``failed``.
    """
    pages = F.col("pages") if "pages" in texts.columns else F.lit(1)
    usable = F.length(tx.strip(F.coalesce("text", F.lit("")))) > 0
    cleaned = tx.cleaned(texts.where(usable), "document_id", "text").withColumnRenamed("text", "clean_text")
    rows = texts.join(cleaned, "document_id", "left")
    meta = {k: F.when(usable, c) for k, c in md.metadata(F.col("clean_text"), F.col("raw_path")).items()}
    return rows.select(
        "document_id", "raw_path", F.col("clean_text").alias("text"), *[c.alias(k) for k, c in meta.items()],
        F.when(usable, tx.quality(F.col("clean_text"), pages)["is_poor"]).alias("is_poor"),
        F.when(usable, "completed").otherwise("failed").alias("status"),
    )


def ingest_pages(pages: DataFrame) -> DataFrame:
    """Document records of web pages (url, html): Markdown text, title, attachments; always policy notices."""
    slug = tx.slugify(F.regexp_replace(F.regexp_extract(F.regexp_replace("url", r"[?#].*$|/+$", ""), "([^/]*)$", 1), r"\.[a-z]+$", ""))
    body = tx.html_markdown(F.col("html"))
    return pages.select(
        slug.alias("document_id"), F.col("url").alias("source_url"), body.alias("text"), tx.html_title(F.col("html"), slug).alias("title"),
        tx.attachment_links(F.col("html"), F.col("url")).alias("attachments"), F.sha2(body.cast("binary"), 256).alias("sha256"), F.lit("policy_notice").alias("document_type"),
    )


def compile_run(documents: DataFrame) -> dict[str, DataFrame]:
    """Provisions, requirements, findings and the report of one run over documents (document_id, text ...)."""
    split = pv.split_provisions(pv.latest_documents(documents))
    tagged = pv.tagged(split, pv.tagging_text(F.col("text"), F.col("title"), F.col("quote")))
    found = pv.extract_requirements(split)
    checked = tagged.withColumns({"locator": F.struct("label", "occurrence", "source_offset"), "evidence": F.struct("quote"), "ingested_at": F.lit(None).cast("timestamp")})
    findings = quality.validate_provisions(checked).unionByName(quality.validate_requirements(found))
    report = (
        split.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_provisions"))
        .join(found.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_requirements")), "document_id", "left")
        .select("document_id", "n_provisions", F.coalesce("n_requirements", F.lit(0)).alias("n_requirements"), F.lit("completed").alias("status"))
    )
    return {"provisions": tagged, "requirements": found, "findings": findings, "report": report}
