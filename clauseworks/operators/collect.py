"""Collecting records: merges, duplicate diagnostics, indexes, manifests and exports.

Defined results: null keys take no part; duplicates are reported and, where one row
is needed, the latest import is kept; empty inputs give empty outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseworks.operators.provisions import merged_tags


def merge_drafts(metadata: DataFrame, drafts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Metadata and drafts by document_id: metadata wins, drafts add ``draft_path`` and what is absent."""
    shared = [c for c in metadata.columns if c != "document_id" and c in drafts.columns]
    m, d = metadata.alias("m"), drafts.alias("d")
    cols = [F.coalesce("m.document_id", "d.document_id").alias("document_id")]
    cols += [F.coalesce(f"m.{c}", f"d.{c}").alias(c) if c in shared else F.col(f"m.{c}").alias(c) for c in metadata.columns if c != "document_id"]
    cols += [F.col("d.draft_path").alias("draft_path"), *[F.col(f"d.{c}").alias(c) for c in extra], F.col("m.document_id").isNull().alias("draft_only")]
    return m.join(d, F.col("m.document_id") == F.col("d.document_id"), "full_outer").select(*cols)


def duplicate_ids(df: DataFrame, key: str, record_kind: str, per_extra: bool) -> DataFrame:
    """(record_kind, id, copies, nth): once per repeated id, or once per copy beyond the first."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    nth = F.explode(F.sequence(F.lit(2).cast("long"), F.col("copies"))) if per_extra else F.col("copies")
    return repeated.select(F.lit(record_kind).alias("record_kind"), "id", "copies", nth.alias("nth"))


def dates_index(documents: DataFrame) -> DataFrame:
    """One line of the effective-dates table per document; absent dates as a dash."""
    shown = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("—")).alias(c)
    out = documents.select("document_id", F.coalesce("title", F.lit("unknown")).alias("title"), shown("release_date"), shown("effective_date"))
    return out.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", "document_id", "title", "release_date", "effective_date"), F.lit(" |")))


def with_tags(provisions: DataFrame, tags: DataFrame) -> DataFrame:
    """Provisions with the merged tags of their id; absent tags are empty arrays."""
    empty = F.array().cast("array<string>")
    merged = merged_tags(tags).withColumnRenamed("id", "provision_id")
    return provisions.join(merged, "provision_id", "left").withColumns({c: F.coalesce(c, empty) for c in ("topics", "entities")})


def requirement_tags(requirements: DataFrame, tags: DataFrame) -> DataFrame:
    """Requirements with their own tags, else their provision's; an own empty record counts as own."""
    merged = merged_tags(tags)
    own = merged.select(F.col("id").alias("requirement_id"), F.col("topics").alias("own_topics"), F.col("entities").alias("own_entities"))
    via = merged.select(F.col("id").alias("provision_id"), F.col("topics").alias("via_topics"), F.col("entities").alias("via_entities"))
    empty = F.array().cast("array<string>")
    joined = requirements.join(own, "requirement_id", "left").join(via, "provision_id", "left")
    return joined.withColumns({c: F.coalesce(f"own_{c}", f"via_{c}", empty) for c in ("topics", "entities")}).drop("own_topics", "own_entities", "via_topics", "via_entities")


#: Columns of the exported documents.
EXPORTED = ("document_id", "title", "document_type", "standard_id", "publisher", "release_date", "effective_date", "source_url", "raw_path", "confidence", "review_status")


def exported_documents(documents: DataFrame) -> DataFrame:
    """One row per document as exported: absent values empty, and the whole record as JSON."""
    rows = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in EXPORTED])
    return rows.withColumn("record", F.to_json(F.struct(*EXPORTED)))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of every table."""
    out = None
    for name, df in sorted(tables.items()):
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def fingerprints(documents: DataFrame, text: str = "text") -> DataFrame:
    """Contents imported more than once: (sha256, n_rows, first_id)."""
    sha = F.sha2(F.col(text).cast("binary"), 256)
    return (
        documents.where(F.col(text).isNotNull())
        .groupBy(sha.alias("sha256"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_id"))
        .where("n_rows > 1")
    )


def rendered_provisions(provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """One Markdown page per provision with its obligations listed."""
    items = requirements.groupBy("provision_id").agg(F.array_sort(F.collect_list(F.struct("requirement_id", "modality"))).alias("reqs"))
    listed = F.array_join(F.transform(F.coalesce("reqs", F.array().cast("array<struct<requirement_id:string,modality:string>>")), lambda r: F.concat(F.lit("- "), r["requirement_id"], F.lit(": "), r["modality"])), "\n")
    front = F.concat(F.lit("---\nprovision_id: "), "provision_id", F.lit("\nreview_status: "), F.coalesce("review_status", F.lit("draft")), F.lit("\n---\n\n# "))
    page = F.concat(front, F.coalesce("label", F.lit("")), F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n\n"), listed)
    return provisions.join(items, "provision_id", "left").select("provision_id", page.alias("page"))
