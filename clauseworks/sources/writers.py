"""Writers: tables, JSON lines, Markdown pages and indexes, the graph interchange files.

Data is written in parallel; only the interchange files whose order is their
feature (indexes, graph files) are range-sorted, and stay split in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_KEYS = ("title", "document_type", "standard_id", "publisher", "release_date", "effective_date", "source_url", "confidence", "review_status")


def _json(df: DataFrame, sort_keys: bool = False) -> DataFrame:
    cols = sorted(df.columns) if sort_keys else df.columns
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists", sort_keys: bool = False) -> None:
    _json(df, sort_keys).write.mode(mode).text(path)


def by_document(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in a folder per document_id; the few writers per document come from its hash."""
    cols = [c for c in df.columns if c != "document_id"]
    rows = df.select("document_id", F.to_json(F.struct("document_id", *cols), {"ignoreNullFields": "false"}).alias("value"))
    rows.repartition("document_id").write.mode(mode).partitionBy("document_id").text(path)


def page(body: Column, keys: tuple[str, ...] = HEADER_KEYS) -> Column:
    """A Markdown page: frontmatter of the given columns (nulls as unknown), then the body."""
    lines = F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), F.coalesce(F.col(k).cast("string"), F.lit("unknown"))) for k in keys])
    return F.concat(F.lit("---\n"), lines, F.lit("\n---\n\n"), F.coalesce(body, F.lit("")))


def yaml_record(keys: tuple[str, ...]) -> Column:
    """A flat YAML mapping of the given columns; strings quoted the JSON way, nulls as null."""
    quoted = lambda k: F.when(F.col(k).isNull(), "null").otherwise(F.regexp_replace(F.to_json(F.struct(F.col(k).alias("v"))), r'^\{"v":|\}$', ""))
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), quoted(k)) for k in keys])


def pages_not_yet_there(pages: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Pages whose key has no page yet; the others are skipped."""
    return pages.join(existing.select(key).distinct(), key, "left_anti")


def index(df: DataFrame, columns: tuple[str, ...], order: str, path: str, mode: str = "overwrite") -> None:
    """A Markdown pipe table in order of ``order``."""
    shown = [F.replace(F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("—")), F.lit("|"), F.lit("\\|")) for c in columns]
    df.orderBy(order).select(F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |")).alias("value")).write.mode(mode).text(path)


def export_tables(tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Rebuild every table as Parquet under ``root``; returns the row counts as written."""
    counts = {}
    for name, df in sorted(tables.items()):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{root}/{name}").count()
    return counts


def export_json(tables: dict[str, DataFrame], root: str, warnings: int = 0, errors: int = 0) -> dict[str, int]:
    """Records with sorted keys and a manifest of their counts."""
    counts = {}
    for name, df in sorted(tables.items()):
        jsonl(df, f"{root}/{name}", "overwrite", sort_keys=True)
        counts[name] = df.count()
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(*counts.values(), warnings, errors)], ", ".join(f"{k} long" for k in (*counts, "warnings", "errors"))).write.mode("overwrite").json(f"{root}/manifest")
    return counts


def graph(nodes: DataFrame, edges: DataFrame, root: str) -> tuple[int, int]:
    """Node and edge files, sorted by (type, id) and (type, source, target)."""
    _json(nodes.orderBy("type", "id"), True).write.mode("overwrite").text(f"{root}/nodes")
    _json(edges.orderBy("type", "source", "target"), True).write.mode("overwrite").text(f"{root}/edges")
    spark = nodes.sparkSession
    return spark.read.text(f"{root}/nodes").count(), spark.read.text(f"{root}/edges").count()
