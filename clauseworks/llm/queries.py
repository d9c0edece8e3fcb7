"""Queries of the text operators: (spark, sf_dir) -> DataFrame, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseworks.llm import lookalikes, markup, mixing, packing, scan_noise, sentences, shared_spans, splitting
from clauseworks.llm.fields import field_values
from clauseworks.llm.tokens import with_token_counts
from clauseworks.session import checkpointed, table

Query = Callable[[SparkSession, str], DataFrame]

SCANNED = ("documents", "provisions")
LOOKALIKE_FIELDS = ("provisions.text", "provisions.label", "requirements.evidence_quote")
SPLIT_FIELDS = ("documents.source_text", "provisions.text", "provisions.label")
SENTENCE_FIELDS = ("provisions.text", "requirements.evidence_quote")


def _tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf, n) for n in names}


def _lookalike_values(spark: SparkSession, sf: str) -> DataFrame:
    return field_values(_tables(spark, sf, "provisions", "requirements"), LOOKALIKE_FIELDS)


def _markup_values(spark: SparkSession, sf: str) -> DataFrame:
    docs, provs = table(spark, sf, "documents"), table(spark, sf, "provisions")
    docs = docs.select(F.lit("documents.source_text").alias("field_name"), F.col("document_id").alias("rec_id"), F.col("source_text").alias("value"), markup.site_of(docs).alias("site"))
    provs = markup.with_document_sites(provs.select("document_id", "provision_id", "text"), table(spark, sf, "documents"))
    provs = provs.select(F.lit("provisions.text").alias("field_name"), F.col("provision_id").alias("rec_id"), F.col("text").alias("value"), "site")
    return docs.unionByName(provs).where((F.col("value") != "") & F.col("rec_id").isNotNull())


def _split_values(spark: SparkSession, sf: str) -> DataFrame:
    return field_values(_tables(spark, sf, "documents", "provisions"), SPLIT_FIELDS)


def _sentence_values(spark: SparkSession, sf: str, verified: bool) -> DataFrame:
    where = F.col("review_status") == "verified" if verified else None
    return field_values(_tables(spark, sf, "provisions", "requirements"), SENTENCE_FIELDS, where=where)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return scan_noise.found(_tables(spark, sf, *SCANNED))


def p1_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return scan_noise.repaired(_tables(spark, sf, *SCANNED))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.found(_lookalike_values(spark, sf))


def p2_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.normalised(_lookalike_values(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.found(_markup_values(spark, sf))


def p3_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return markup.cleaned(_markup_values(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.found(_split_values(spark, sf), table(spark, sf, "size_limits"))


def p4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_oversized(_split_values(spark, sf), table(spark, sf, "size_limits"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.found(_sentence_values(spark, sf, True))


def p6_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentence_units(_sentence_values(spark, sf, False))


def p7_pack(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("doc_id is not null")
    return packing.pack(with_token_counts(docs), table(spark, sf, "token_windows"))


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    windows = table(spark, sf, "token_windows")
    return packing.fill_report(p7_pack(spark, sf), windows)


def _described(spark: SparkSession, sf: str) -> DataFrame:
    return checkpointed(mixing.described(table(spark, sf, "documents").where("doc_id is not null")))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_described(spark, sf), table(spark, sf, "mix_targets"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.share_report(checkpointed(p8_mix(spark, sf)), table(spark, sf, "mix_targets"))


def p8_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.classifier_report(_described(spark, sf), table(spark, sf, "mix_targets"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return shared_spans.shared_pairs(table(spark, sf, "documents"))


def p9_shared(spark: SparkSession, sf: str) -> DataFrame:
    return shared_spans.shared_amounts(table(spark, sf, "documents"))


def p9_groups(spark: SparkSession, sf: str) -> DataFrame:
    return shared_spans.group_members(table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (p1_found, p1_repaired, p2_found, p2_normalised, p3_found, p3_cleaned, p4_found, p4_pieces, p6_found, p6_sentences, p7_pack, p7_fill, p8_mix, p8_shares, p8_classifier, p9_found, p9_shared, p9_groups)
    }


#: All windows of 200 characters by brute force, exact copies as one class.
_WINDOWS = """
    t AS (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 200),
    c AS (SELECT min(doc_id) AS rep, count(*) AS n_copies, text FROM t GROUP BY text),
    m AS (SELECT t.doc_id, c.rep, c.n_copies, length(t.text) AS n_chars FROM t JOIN c ON c.text = t.text),
    w AS (SELECT rep, i, hash(substr(text, i, 200)) AS k FROM (SELECT rep, text, unnest(range(1, length(text) - 198)) AS i FROM c)),
    g AS (SELECT * FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(DISTINCT rep) > 1)),
    p AS (SELECT DISTINCT a.rep AS x, b.rep AS y FROM (SELECT DISTINCT rep, k FROM g) a JOIN (SELECT DISTINCT rep, k FROM g) b ON a.k = b.k WHERE a.rep <> b.rep)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the results that don't hang on how a text is cut or judged."""
    return {
        "p4_found": """
            SELECT DISTINCT v.field_name, v.rec_id FROM (
                SELECT 'documents.source_text' AS field_name, document_id AS rec_id, length(source_text) AS n FROM documents
                UNION ALL SELECT 'provisions.text', provision_id, length(text) FROM provisions
                UNION ALL SELECT 'provisions.label', provision_id, length(label) FROM provisions
            ) v JOIN size_limits l ON v.field_name = l.field_name
            WHERE v.n > l.max_chars AND v.rec_id IS NOT NULL
        """,
        "p9_found": f"""
            WITH {_WINDOWS} SELECT DISTINCT least(a.doc_id, b.doc_id) AS doc_a, greatest(a.doc_id, b.doc_id) AS doc_b
            FROM (SELECT x, y FROM p UNION ALL SELECT rep, rep FROM c) q JOIN m a ON a.rep = q.x JOIN m b ON b.rep = q.y WHERE a.doc_id <> b.doc_id
        """,
        "p9_shared": f"""
            WITH {_WINDOWS}, covered AS (
                SELECT rep, sum(least(200, coalesce(following - i, 200))) AS n FROM (SELECT rep, i, lead(i) OVER (PARTITION BY rep ORDER BY i) AS following FROM g) GROUP BY rep
            ), linked AS (SELECT x AS rep, count(*) AS n FROM p GROUP BY x),
            sets AS (SELECT rep, count(DISTINCT s) AS n FROM (SELECT k, list(DISTINCT rep ORDER BY rep) AS s FROM g GROUP BY k) JOIN (SELECT DISTINCT rep, k FROM g) USING (k) GROUP BY rep)
            SELECT m.doc_id, m.n_chars, CASE WHEN m.n_copies > 1 THEN m.n_chars ELSE coalesce(covered.n, 0) END::BIGINT AS shared_chars, m.n_copies,
                   coalesce(sets.n, 0) AS n_groups, coalesce(linked.n, 0) AS n_linked_classes, m.rep AS class_id
            FROM m LEFT JOIN covered USING (rep) LEFT JOIN linked USING (rep) LEFT JOIN sets USING (rep)
        """,
    }
