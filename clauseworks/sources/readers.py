"""Readers: record files as DataFrames with declared schemas.

Folders that don't exist give empty tables. Broken rows are kept with their text
in ``corrupt`` instead of failing the read; strict readers raise on a missing path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LOCATOR = "struct<label:string,occurrence:int,source_offset:int>"
PROVISIONS = f"document_id string, provision_id string, label string, kind string, title string, text string, locator {LOCATOR}, source_text string, raw_path string, confidence string, review_status string, evidence struct<quote:string>"
REQUIREMENTS = f"requirement_id string, document_id string, provision_id string, modality string, subject string, action string, object string, condition string, exception string, evidence struct<quote:string,source_text:string,raw_path:string,locator:{LOCATOR}>, confidence string, review_status string"
TAG_ITEM = "array<struct<id:string,topics:array<string>,entities:array<string>>>"
TAG_FILES = f"document_id string, provisions {TAG_ITEM}, requirements {TAG_ITEM}"
CHECKS = "id string, type string, category string, severity string, expected string, notes string"
METADATA_KEYS = (
    "title", "document_type", "standard_id", "publisher", "release_date", "effective_date", "source_url", "raw_path", "source_text", "sha256", "retrieved_at", "confidence", "review_status", "replaces", "replaced",
)


def _or_empty(read, spark: SparkSession, schema: str, strict: bool) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if strict or "PATH_NOT_FOUND" not in str(e):
            raise FileNotFoundError(str(e).split("\n")[0]) from e
        return spark.createDataFrame([], schema)


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Records of JSON lines; ``file`` names the file, ``corrupt`` holds a line that is no record."""
    full = f"{schema}, corrupt string"
    read = lambda: spark.read.schema(full).option("columnNameOfCorruptRecord", "corrupt").json(path).withColumn("file", F.col("_metadata.file_path"))
    return _or_empty(read, spark, f"{full}, file string", strict)


def frontmatter(text: Column) -> tuple[Column, Column]:
    """(header, body) of a Markdown page; without a closed header the header is null."""
    at = F.locate("\n---", text, 4)
    closed = text.startswith("---") & (at > 0)
    header = F.when(closed, F.substring(text, F.lit(4), at - 4))
    rest = F.substring(text, at + 4, F.length(text))
    return header, F.when(closed, F.regexp_replace(rest, "^\n+", "")).otherwise(text)


def markdown(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(document_id, header map, body) of Markdown pages with a frontmatter of plain ``key: value`` lines."""

    def read() -> DataFrame:
        pages = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
        header, body = frontmatter(F.col("value"))
        lines = F.filter(F.split(F.coalesce(header, F.lit("")), "\n"), lambda x: x.rlike("^[^:#\\s][^:]*:"))
        pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.trim(F.regexp_replace(x, "^[^:]*:", ""))))
        name = F.regexp_extract("file", r"([^/]*?)(?:\.[^./]*)?$", 1)
        return pages.select(name.alias("document_id"), F.map_from_entries(pairs).alias("header"), body.alias("body"), "file")

    return _or_empty(read, spark, "document_id string, header map<string,string>, body string, file string", strict)


def metadata_yaml(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Metadata files, one row each; a root that is no mapping gives nulls, a broken file its text in ``corrupt``."""
    schema = "document_id string, " + ", ".join(f"{k} string" for k in METADATA_KEYS) + ", ocr_required boolean, corrupt string"

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for frame in frames:
            rows = []
            for name, value in zip(frame["name"], frame["value"]):
                row = dict.fromkeys(("document_id", *METADATA_KEYS, "ocr_required", "corrupt"))
                row["document_id"] = name
                try:
                    data = yaml.safe_load(value)
                    if isinstance(data, dict):
                        row |= {k: None if data.get(k) is None else str(data[k]) for k in METADATA_KEYS}
                        row["ocr_required"] = data.get("ocr_required") if isinstance(data.get("ocr_required"), bool) else None
                except yaml.YAMLError:
                    row["corrupt"] = value
                rows.append(row)
            yield pd.DataFrame(rows, columns=["document_id", *METADATA_KEYS, "ocr_required", "corrupt"])

    def read() -> DataFrame:
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)(?:\.[^./]*)?$", 1)
        files = spark.read.text(path, wholetext=True).select(name.alias("name"), "value")
        return files.mapInPandas(parse, schema)

    return _or_empty(read, spark, schema, strict)


def tag_files(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, record_type, id, topics, entities, file, pos) of tag files; unreadable files are left out."""
    empty = "document_id string, record_type string, id string, topics array<string>, entities array<string>, file string, pos int"

    def read() -> DataFrame:
        files = spark.read.schema(f"{TAG_FILES}, corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "corrupt").json(path)
        files = files.withColumn("file", F.col("_metadata.file_path")).where("corrupt is null")
        out = None
        for kind in ("provisions", "requirements"):
            part = files.select("document_id", F.lit(kind).alias("record_type"), F.posexplode(kind).alias("pos", "t"), "file").select("document_id", "record_type", "t.id", "t.topics", "t.entities", "file", "pos")
            out = part if out is None else out.unionByName(part)
        return out

    return _or_empty(read, spark, empty, False)


def checks(spark: SparkSession, *paths: str) -> DataFrame:
    """Check files together: (id, type, severity, expected map); a bare string is the expected document_id."""
    out = None
    for p in paths:
        df = jsonl(spark, p, CHECKS, strict=True)
        out = df if out is None else out.unionByName(df)
    expected = F.when(F.col("expected").startswith("{"), F.from_json("expected", "map<string,string>")).otherwise(F.create_map(F.lit("document_id"), F.col("expected")))
    return out.where("corrupt is null").select("id", "type", "severity", expected.alias("expected"))


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of raw snapshots; bytes never leave the executors."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def page_texts(pages: DataFrame) -> DataFrame:
    """Documents from extracted page texts (document_id, page_no, text): joined in page order, with their page count."""
    rows = F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.where("document_id is not null").groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"), F.array_join(F.transform(rows, lambda r: r["text"]), "\n\n").alias("text"))


def table_rows(spark: SparkSession, name: str) -> int:
    """Rows of a catalogued table; an unknown name is a KeyError."""
    if not spark.catalog.tableExists(name):
        raise KeyError(name)
    return spark.table(name).count()


def record_folder(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The record tables under one folder, each of them optional."""
    return {
        "metadata": metadata_yaml(spark, f"{root}/metadata/*.yaml"),
        "drafts": markdown(spark, f"{root}/drafts/*.md"),
        "provisions": jsonl(spark, f"{root}/provisions/*.jsonl", PROVISIONS),
        "requirements": jsonl(spark, f"{root}/requirements/*.jsonl", REQUIREMENTS),
        "tags": tag_files(spark, f"{root}/tags/*.json"),
    }
