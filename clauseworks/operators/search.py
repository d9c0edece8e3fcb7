"""Substring and ranked search over the record tables.

Terms are case-insensitive substrings, all of them must occur in the indexed
columns. Every branch keeps its best ``limit`` rows by id before the union, so a
top-k never sorts the whole table. BM25 counts terms in one pass per table.

Defined results: an empty query matches nothing; null columns are empty; an
unknown mode is a ValueError; a boolean, prefix or column query is refused.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseworks.functions import rules
from clauseworks.functions.text import shortened

#: Searched columns per mode.
INDEXED = {"documents": ("title", "raw_path"), "provisions": ("label", "title", "text"), "requirements": ("modality", "subject", "action", "object", "evidence_quote")}
IDS = {"documents": "document_id", "provisions": "provision_id", "requirements": "requirement_id"}
MODES = (*INDEXED, "all")


def contains(c: Column, term: str) -> Column:
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(term.lower()))


def terms_of(query: str) -> list[str]:
    if re.search(r"\b(?:AND|OR|NOT|NEAR)\b|\*\s*$|^\w+:", query):
        raise ValueError("boolean, prefix and column queries are not supported; give plain terms")
    return query.split()


def substring_search(documents: DataFrame, provisions: DataFrame, requirements: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """First matching field per record: documents, then provisions, then requirements, by id."""
    if not query:
        return documents.select(F.lit(0).alias("kind_order"), F.col("document_id").alias("id"), F.lit("").alias("matched_field"), F.lit("").alias("hit_text")).limit(0)

    def branch(df: DataFrame, order: int, key: str, fields: tuple[str, ...]) -> DataFrame:
        matched = hit = None
        for f in fields:
            matched = (F if matched is None else matched).when(contains(F.col(f), query), f)
            hit = (F if hit is None else hit).when(contains(F.col(f), query), F.col(f))
        rows = df.select(F.lit(order).alias("kind_order"), F.col(key).alias("id"), matched.alias("matched_field"), F.left(hit, F.lit(rules.HIT_TEXT)).alias("hit_text"))
        return rows.where("matched_field is not null and id is not null").distinct().orderBy("id", "matched_field", "hit_text").limit(limit)

    parts = branch(documents, 0, "document_id", ("title", "document_id", "standard_id"))
    parts = parts.unionByName(branch(provisions, 1, "provision_id", ("label", "text"))).unionByName(branch(requirements, 2, "requirement_id", ("evidence_quote",)))
    return parts.orderBy("kind_order", "id", "matched_field", "hit_text").limit(limit)


def search_mode(df: DataFrame, mode: str, query: str, limit: int | None = 20, tags: DataFrame | None = None, topic: str | None = None, entity: str | None = None, **equal: str) -> DataFrame:
    """Hits of one mode: (id, snippet). Filters are equalities; tag filters are semi-joins.

    Documents have no tags, so a tag filter on them gives nothing; ``review_status``
    is ignored for requirements.
    """
    if mode not in INDEXED:
        raise ValueError(f"unknown mode {mode!r}; one of {MODES}")
    terms = terms_of(query)
    key, cols = IDS[mode], INDEXED[mode]
    hit = F.lit(bool(terms))
    for term in terms:
        any_column = F.lit(False)
        for c in cols:
            any_column = any_column | contains(F.col(c), term)
        hit = hit & any_column
    rows = df.where(hit & F.col(key).isNotNull())
    for column, value in equal.items():
        if not (column == "review_status" and mode == "requirements"):
            rows = rows.where(F.col(column) == value)
    for column, value in (("topics", topic), ("entities", entity)):
        if value is not None:
            if mode == "documents" or tags is None:
                return rows.limit(0).select(F.col(key).alias("id"), F.lit("").alias("snippet"))
            wanted = tags.where(F.array_contains(column, value)).select(F.col("id").alias(key))
            rows = rows.join(wanted, key, "left_semi")
    body = {"documents": "title", "provisions": "text", "requirements": "evidence_quote"}[mode]
    out = rows.select(F.col(key).alias("id"), shortened(F.coalesce(F.col(body), F.lit("")), rules.SNIPPET).alias("snippet")).distinct()
    return out if limit is None else out.orderBy("id", "snippet").limit(limit)


def search_all(tables: dict[str, DataFrame], query: str, limit: int = 20) -> DataFrame:
    """All modes, each cut to ``limit`` and the union again: provisions, documents, requirements."""
    out = None
    for order, mode in enumerate(("provisions", "documents", "requirements")):
        part = search_mode(tables[mode], mode, query, limit).withColumn("kind_order", F.lit(order))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("kind_order", "id", "snippet").limit(limit)


def bm25(df: DataFrame, key: str, text: str, query: str, limit: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The best rows by BM25 over substring terms: (id, score), ties by id.

    Term counts and lengths are taken where the text is read, so only numbers are
    shuffled: copies of an id count once (the longest, then the one with most hits),
    the document frequencies and the mean length are a single row.
    """
    terms = [t.lower() for t in terms_of(query)]
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    counts = [((F.length(body) - F.length(F.replace(body, F.lit(t), F.lit("")))) / len(t)).alias(f"t{i}") for i, t in enumerate(terms)]
    numbers = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.length(body).alias("n_chars"), *counts)
    fields = ["n_chars", *[f"t{i}" for i in range(len(terms))]]
    rows = numbers.groupBy("id").agg(F.max(F.struct(*fields)).alias("x")).select("id", *[f"x.{f}" for f in fields])
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean"), *[F.count_if(F.col(f"t{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf = F.col(f"t{i}")
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("n_chars") / F.col("mean")))
    scored = rows.crossJoin(F.broadcast(stats)).select("id", score.alias("score"))  # stats is one row
    return scored.where("score > 0").orderBy(F.desc("score"), "id").limit(limit)


def trigrams(c: Column) -> Column:
    """Distinct three-character pieces of the lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.array_distinct(F.regexp_extract_all(low, F.lit("(?s)(?=(...))"), F.lit(1)))  # one pass, overlapping


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """Trigram index: distinct (gram, id). Written once, it turns a search into a lookup of a few grams."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.explode(trigrams(F.col(text))).alias("gram")).distinct()


def search_postings(index: DataFrame, df: DataFrame, key: str, text: str, term: str) -> DataFrame:
    """Ids whose text holds ``term`` (three characters or more): all its grams by the index, then verified."""
    low = term.lower()
    grams = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    if not grams:
        raise ValueError("a term for the trigram index has three characters or more")
    likely = index.where(F.col("gram").isin(grams)).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams))
    return df.where(contains(F.col(text), term)).select(F.col(key).alias("id")).join(likely, "id", "left_semi").distinct()
