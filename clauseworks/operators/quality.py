"""Audits and validation rules over the record tables.

Defined results: null texts and quotes count as empty; documents without rows of a
kind count zero; every rule is one row of the findings it breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.functions import rules
from clauseworks.functions.text import strip


def _bare(c: str) -> Column:
    return strip(F.coalesce(F.col(c), F.lit("")))


def short_provisions(provisions: DataFrame) -> DataFrame:
    return provisions.where(F.length(_bare("text")) < rules.SHORT_TEXT).select("document_id", "provision_id", F.length(_bare("text")).alias("n_chars"))


def fallback_only(provisions: DataFrame) -> DataFrame:
    """Documents that have a fallback provision and no other."""
    fallback = F.col("label") == "fallback"
    flags = provisions.where("document_id is not null").groupBy("document_id").agg(F.bool_or(F.coalesce(fallback, F.lit(False))).alias("some"), F.bool_or(F.coalesce(~fallback, F.lit(True))).alias("other"))
    return flags.select("document_id", (F.col("some") & ~F.col("other")).alias("fallback_only"))


def duplicate_labels(provisions: DataFrame) -> DataFrame:
    """Labels used more than once in a document, with the first few ids as examples.

    Examples are picked by rank before they are gathered, so a label of any
    frequency costs a handful of rows.
    """
    labelled = provisions.where((F.coalesce("label", F.lit("")) != "") & (F.col("label") != "fallback") & F.col("document_id").isNotNull())
    counts = labelled.groupBy("document_id", "label").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    nth = F.row_number().over(Window.partitionBy("document_id", "label").orderBy("provision_id"))
    shown = labelled.select("document_id", "label", "provision_id", nth.alias("nth")).where(F.col("nth") <= rules.EXAMPLES)
    examples = shown.groupBy("document_id", "label").agg(F.array_join(F.array_sort(F.collect_list("provision_id")), ",").alias("examples"))
    return counts.join(examples, ["document_id", "label"])


def toc_noise(provisions: DataFrame) -> DataFrame:
    """Provisions that look like entries of a table of contents; the label is the stronger reason."""
    reason = F.when(F.coalesce("label", F.lit("")).rlike(rules.TOC_LABEL), "label").when(F.coalesce("text", F.lit("")).rlike(rules.TOC_TEXT), "text")
    return provisions.select("document_id", "provision_id", reason.alias("reason")).where("reason is not null")


def density(provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """Requirements per provision of each document, numerator and denominator exposed."""
    p = provisions.where("document_id is not null").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_provisions"))
    r = requirements.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_requirements"))
    n = F.coalesce("n_requirements", F.lit(0))
    return p.join(r, "document_id", "left").select("document_id", "n_provisions", n.alias("n_requirements"), (n > rules.DENSE * F.col("n_provisions")).alias("dense"))


def weak_evidence(requirements: DataFrame) -> DataFrame:
    size = F.length(_bare("evidence_quote"))
    return requirements.where(size < rules.WEAK_QUOTE).select("document_id", "requirement_id", F.when(size == 0, "missing").otherwise("short").alias("reason"))


def audit(provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """Issue counts per document and their total."""
    by = lambda df, name: df.groupBy("document_id").agg(F.count(F.lit(1)).alias(name))
    out = fallback_only(provisions)
    out = out.join(by(short_provisions(provisions), "n_short"), "document_id", "left")
    out = out.join(by(duplicate_labels(provisions), "n_duplicate_labels"), "document_id", "left")
    out = out.join(by(toc_noise(provisions), "n_toc"), "document_id", "left")
    out = out.join(by(weak_evidence(requirements), "n_weak"), "document_id", "left")
    counts = ["n_short", "n_duplicate_labels", "n_toc", "n_weak"]
    out = out.select("document_id", F.col("fallback_only").cast("int").alias("n_fallback"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    return out.withColumn("n_issues", F.col("n_fallback") + sum(F.col(c) for c in counts))


def keyword_occurrences(text: Column, keyword: str) -> Column:
    """Non-overlapping, case-sensitive occurrences of ``keyword``."""
    c = F.coalesce(text, F.lit(""))
    return ((F.length(c) - F.length(F.replace(c, F.lit(keyword), F.lit("")))) / len(keyword)).cast("long")


def keyword_counts(provisions: DataFrame, requirements: DataFrame, keywords: list[str]) -> DataFrame:
    """(keyword, n) over texts, titles and quotes of provisions and quotes of requirements; one pass per table."""
    each = lambda df, cols: df.agg(*[F.sum(sum(keyword_occurrences(F.col(c), k) for c in cols)).alias(k) for k in keywords])
    both = each(provisions, ("text", "title", "evidence.quote")).unionByName(each(requirements, ("evidence_quote",)))
    total = both.agg(*[F.coalesce(F.sum(F.col(f"`{k}`")), F.lit(0)).alias(k) for k in keywords])
    return total.select(F.explode(F.array(*[F.struct(F.lit(k).alias("keyword"), F.col(f"`{k}`").alias("n")) for k in keywords])).alias("x")).select("x.keyword", "x.n")


def findings(df: DataFrame, key: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """(id, level, message) for every broken rule of every row: one pass, one explode."""
    broken = F.filter(F.array(*[F.struct(F.lit(level).alias("level"), F.lit(message).alias("message"), F.coalesce(cond, F.lit(False)).alias("bad")) for level, message, cond in checks]), lambda x: x["bad"])
    return df.select(F.col(key).alias("id"), F.explode(broken).alias("f")).select("id", "f.level", "f.message")


def _absent(c: str) -> Column:
    return F.col(c).isNull() | F.col(c).isin("", "unknown")


def validate_documents(documents: DataFrame) -> DataFrame:
    checks = [("error", f"missing {c}", _absent(c)) for c in ("document_id", "title", "review_status")]
    checks += [("warning", f"missing {c}", F.col(c).isNull()) for c in ("source_text", "raw_path")]
    return findings(documents, "document_id", checks)


def validate_provisions(provisions: DataFrame) -> DataFrame:
    apart = F.when(F.col("provision_id").isNull(), F.xxhash64("label", "text"))  # rows without an id are not gathered
    nth = F.row_number().over(Window.partitionBy("provision_id", apart).orderBy("ingested_at"))
    checks = [
        ("error", "missing provision_id", _absent("provision_id")),
        ("error", "duplicate provision_id", F.col("provision_id").isNotNull() & (F.col("_nth") > 1)),
        ("warning", "missing locator", F.col("locator").isNull()),
        ("error", "missing quote", _bare_struct("evidence.quote") == ""),
    ]
    return findings(provisions.withColumn("_nth", nth), "provision_id", checks)


def _bare_struct(path: str) -> Column:
    return strip(F.coalesce(F.col(path), F.lit("")))


def validate_requirements(requirements: DataFrame) -> DataFrame:
    checks = [("error", f"missing {c}", _absent(c)) for c in ("requirement_id", "modality", "document_id", "provision_id")]
    return findings(requirements, "requirement_id", [*checks, ("error", "missing quote", _bare("evidence_quote") == "")])
