"""Splitting documents into provisions, obligations in them, and dictionary tags.

Row-local work first (one regular expression marks all labels, the text is cut
there), then windows whose keys all start with ``document_id``: one exchange
serves the offsets, the occurrence counts and the requirement numbers.

Defined results: a null text gives no provision; a text without labels one
``fallback`` row; what stands before the first label is dropped; the sentinels
U+0001..U+0003 are removed from the text first; nulls in tagged columns are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.functions import rules
from clauseworks.functions.text import strip


def split_parts(text: Column) -> Column:
    """The text cut before every label; a part is label, U+0002, separator, U+0003, body (the first one body alone)."""
    marked = F.regexp_replace(F.regexp_replace(text, "[\u0001-\u0003]", ""), rules.LABELS, "\u0001$1$3$5\u0002$2$4$6\u0003")
    return F.split(marked, "\u0001", -1)


def kind_of(label: Column) -> Column:
    return (
        F.when(label == "fallback", "unknown")
        .when(label.rlike("^第.+条"), "article")
        .when(label.rlike("^(?i:附录|Annex|Appendix)"), "annex")
        .when(label.contains("."), "clause")
        .otherwise("section")
    )


def provision_id(document_id: Column, label: Column) -> Column:
    return F.concat(document_id, F.lit("-"), F.lower(F.translate(strip(label), " .", "--")))


def split_provisions(docs: DataFrame, text: str = "text", *carried: str) -> DataFrame:
    """Provisions of every row of ``docs`` (document_id, text).

    Occurrence and duplicate suffix count in order of the offset; a document stored
    several times should be reduced to one row first (``latest_documents``).
    """
    parts = docs.where(F.col(text).isNotNull()).select("document_id", *carried, split_parts(F.col(text)).alias("parts"))
    cut = parts.select("document_id", *carried, F.posexplode("parts").alias("pos", "p"), F.size("parts").alias("n_parts"))
    size = F.length(F.translate("p", "\u0002\u0003", ""))
    before = F.sum(size).over(Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size
    labelled = cut.select(
        "document_id", *carried, "pos", "n_parts", before.cast("int").alias("source_offset"),
        F.when(F.col("pos") > 0, F.substring_index("p", "\u0002", 1)).alias("own_label"),
        strip(F.when(F.col("pos") > 0, F.substring_index("p", "\u0003", -1)).otherwise(F.col("p"))).alias("body"),
    ).where(((F.col("pos") > 0) & (F.col("body") != "")) | (F.col("n_parts") == 1))
    fallback = F.col("n_parts") == 1
    label = F.when(fallback, "fallback").otherwise(F.col("own_label"))
    body = F.col("body")
    head, rest = strip(F.substring_index(body, "\n", 1)), strip(F.expr("substring(body, instr(body, '\n') + 1)"))
    split_head = ~fallback & body.contains("\n") & (rest != "")
    rows = labelled.select(
        "document_id", *carried, label.alias("label"), kind_of(label).alias("kind"),
        F.when(split_head, head).otherwise("unknown").alias("title"),
        F.when(split_head, rest).when(body.contains("\n") & ~fallback, head).otherwise(body).alias("text"),
        F.when(fallback, 0).otherwise(F.col("source_offset")).alias("source_offset"),
        provision_id(F.col("document_id"), label).alias("base_id"),
    )
    by_label = F.row_number().over(Window.partitionBy("document_id", "label").orderBy("source_offset"))
    by_base = F.row_number().over(Window.partitionBy("document_id", "base_id").orderBy("source_offset"))
    rows = rows.withColumns({"occurrence": by_label, "nth": by_base})
    again = F.col("nth") > 1
    quote = F.when(F.col("label") == "fallback", strip(F.left("text", F.lit(rules.FALLBACK_QUOTE)))).otherwise(F.left("text", F.lit(rules.FALLBACK_QUOTE)))
    return rows.select(
        "document_id", *carried,
        F.when(again, F.concat("base_id", F.lit("-dup-"), F.col("nth").cast("string"))).otherwise(F.col("base_id")).alias("provision_id"),
        "label", "kind", "title", "text", "occurrence", "source_offset",
        F.when(again | (F.col("label") == "fallback"), "low").otherwise("medium").alias("confidence"),
        quote.alias("quote"),
    )


def latest_documents(documents: DataFrame) -> DataFrame:
    """One row per document_id: the import that came last (ties: the greatest doc_id)."""
    last = F.row_number().over(Window.partitionBy("document_id").orderBy(F.desc_nulls_last("ingested_at"), F.desc("doc_id")))
    return documents.where("document_id is not null").withColumn("_nth", last).where("_nth = 1").drop("_nth")


def latest_rows(df: DataFrame, key: str, *ties: str) -> DataFrame:
    """One row per key: the one that came last, ties by the given columns."""
    order = [F.desc_nulls_last("ingested_at"), *[F.asc_nulls_first(t) for t in ties]]
    return df.where(F.col(key).isNotNull()).withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def modality_of(text: Column) -> Column:
    """Ordered first match over the modality signals; texts with a Chinese signal never reach the English ones."""
    out = None
    for name, pattern in rules.MODALITY:
        out = (F if out is None else out).when(text.rlike(pattern), name)
    return out.otherwise("unknown")


def extract_requirements(provisions: DataFrame) -> DataFrame:
    """Obligations of provisions (document_id, provision_id, text, quote, source_offset, confidence).

    Numbered through each document in order of offset and id, after the ones without modality are gone.
    """
    # a generator instead of a filter: Catalyst would copy the splitting into every branch of the pushed-down CASE
    known = F.filter(F.array(modality_of(F.col("text"))), lambda m: m != "unknown")
    found = provisions.select("*", F.explode(known).alias("modality"))
    nth = F.row_number().over(Window.partitionBy("document_id").orderBy("source_offset", "provision_id"))
    quote = F.coalesce(F.nullif("quote", F.lit("")), F.left("text", F.lit(rules.FALLBACK_QUOTE)))
    return found.withColumn("nth", nth).select(
        F.concat("provision_id", F.lit("-r"), F.col("nth").cast("string")).alias("requirement_id"), "document_id", "provision_id", "modality",
        *[F.lit("unknown").alias(c) for c in ("subject", "action", "object", "condition", "exception")],
        quote.alias("evidence_quote"), "confidence", F.lit("machine_extracted").alias("review_status"),
    )


def tagging_text(*columns: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in columns]))


def _hits(text: Column, dictionary: dict[str, tuple[str, ...]]) -> Column:
    """Map of tag -> sorted keywords found in ``text``."""
    entries = []
    for tag in sorted(dictionary):
        words = F.array(*[F.lit(w) for w in sorted(dictionary[tag])])
        entries.append(F.struct(F.lit(tag).alias("tag"), F.filter(words, lambda w: F.contains(text, w)).alias("words")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["words"]) > 0))


def tagged(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with topics, entities (sorted arrays) and the keywords that gave them; no shuffle."""
    hits = df.withColumns({"_t": text}).withColumns({"topic_keywords": _hits(F.col("_t"), rules.TOPICS), "entity_keywords": _hits(F.col("_t"), rules.ENTITIES)})
    return hits.withColumns({"topics": F.array_sort(F.map_keys("topic_keywords")), "entities": F.array_sort(F.map_keys("entity_keywords"))}).drop("_t")


def tagged_records(provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """(record_type, id, topics, entities) of provisions and requirements.

    The id is the provision_id, where that is absent or empty the requirement_id, else empty.
    """
    own = F.col("requirement_id") if "requirement_id" in provisions.columns else F.lit(None).cast("string")
    columns = ["id", "topics", "entities"]
    p = tagged(provisions, tagging_text(F.col("text"), F.col("title"), F.col("source_text"), F.col("evidence.quote"))).withColumn("id", F.coalesce(F.nullif("provision_id", F.lit("")), own, F.lit("")))
    r = tagged(requirements, tagging_text(F.col("evidence_quote"))).withColumn("id", F.coalesce(F.nullif("provision_id", F.lit("")), F.col("requirement_id"), F.lit("")))
    return p.select(F.lit("provision").alias("record_type"), *columns).unionByName(r.select(F.lit("requirement").alias("record_type"), *columns))


def merged_tags(tags: DataFrame) -> DataFrame:
    """Repeated ids as one: sorted union of topics and of entities."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    return tags.where("id is not null").groupBy("id").agg(union(F.col("topics")).alias("topics"), union(F.col("entities")).alias("entities"))


def last_tags(tags: DataFrame, order: list[Column]) -> DataFrame:
    """Repeated ids as one: the last by ``order`` replaces the others."""
    return tags.where("id is not null").groupBy("id").agg(F.max_by(F.struct("topics", "entities"), F.struct(*order)).alias("t")).select("id", "t.topics", "t.entities")


def junction(tags: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct (id, tag) rows of an array column."""
    return tags.select("id", F.explode(column).alias(name)).where(F.col(name).isNotNull() & F.col("id").isNotNull()).distinct()
