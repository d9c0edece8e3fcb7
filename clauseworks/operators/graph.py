"""The document-provision-requirement-topic graph as node and edge tables.

Defined results: rows without ids give no node; edges whose ends don't exist are
dropped by ``assemble``; of equal edges one is kept; of nodes with one id the first
in the order documents, provisions, requirements, topics, entities; replacement
chains stop at a node already on the chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseworks.session import checkpointed

_NODE = ("id", "type", "name")
#: Columns that become properties of each kind of node.
PROPS = {
    "Document": ("title", "document_type", "standard_id", "publisher", "confidence", "review_status"),
    "Provision": ("label", "kind", "title", "confidence", "review_status"),
    "Requirement": ("modality", "confidence", "review_status"),
}
#: Characters of a document that are ordered in one task.
BLOCK = 1_000_000
_ORDER = ("Document", "Provision", "Requirement", "Topic", "Entity")


def _edges(df: DataFrame, source, target, kind: str) -> DataFrame:
    return df.select(source.alias("source"), target.alias("target"), F.lit(kind).alias("type"))


def nodes(documents: DataFrame, provisions: DataFrame, requirements: DataFrame, tags: DataFrame) -> DataFrame:
    """(id, type, name) of every node; replaced documents without a record are stubs."""
    docs = documents.where("document_id is not null").groupBy("document_id").agg(F.max("title").alias("name"))
    parts = docs.select(F.col("document_id").alias("id"), F.lit("Document").alias("type"), "name")
    named = [documents.select(F.col(c).alias("document_id")) for c in ("replaces", "replaced") if c in documents.columns]
    stubs = reduce(DataFrame.union, named).where("document_id is not null").distinct().join(docs, "document_id", "left_anti")
    parts = parts.unionByName(stubs.select(F.col("document_id").alias("id"), F.lit("Document").alias("type"), F.lit(None).cast("string").alias("name")))
    for df, key, kind, name in ((provisions, "provision_id", "Provision", "label"), (requirements, "requirement_id", "Requirement", "modality")):
        rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(name).alias("name"))
        parts = parts.unionByName(rows.select("id", F.lit(kind).alias("type"), "name"))
    for column, kind, prefix in (("topics", "Topic", "topic:"), ("entities", "Entity", "entity:")):
        names = tags.select(F.explode(column).alias("name")).where("name is not null").distinct()
        parts = parts.unionByName(names.select(F.concat(F.lit(prefix), "name").alias("id"), F.lit(kind).alias("type"), "name"))
    return parts


def subsections(provisions: DataFrame) -> DataFrame:
    """SUBSECTION_OF: each provision to the one whose label is its own less the last dotted part.

    Of several parents in the document the last one counts, and only if it stands
    before the child.
    """
    at = F.col("locator.source_offset")
    rows = provisions.where("provision_id is not null and document_id is not null").groupBy("provision_id").agg(
        F.max("document_id").alias("document_id"), F.max("label").alias("label"), F.max(at).alias("at")
    )
    parents = rows.groupBy("document_id", F.col("label").alias("parent_label")).agg(F.max(F.struct("at", "provision_id")).alias("parent"))
    children = rows.where(F.col("label").contains(".")).withColumn("parent_label", F.regexp_replace("label", r"\.[^.]*$", ""))
    joined = children.join(parents, ["document_id", "parent_label"]).where(F.col("parent.at") < F.col("at"))
    return _edges(joined, F.col("provision_id"), F.col("parent.provision_id"), "SUBSECTION_OF")


def neighbours(provisions: DataFrame) -> DataFrame:
    """NEXT edges between provisions of a document in order of their offset.

    A document is ordered in blocks of ``BLOCK`` characters, so one of any length is
    spread; the last provision of a block goes on with the first of the next one.
    """
    rows = provisions.where("provision_id is not null and document_id is not null").groupBy("document_id", "provision_id").agg(F.min("locator.source_offset").alias("at"))
    rows = rows.withColumn("block", F.floor(F.coalesce("at", F.lit(-1)) / BLOCK))
    following = F.lead("provision_id").over(Window.partitionBy("document_id", "block").orderBy("at", "provision_id"))
    rows = rows.withColumn("following", following)
    heads = rows.groupBy("document_id", "block").agg(F.min_by("provision_id", F.struct("at", "provision_id")).alias("head"))
    after = heads.withColumn("head", F.lead("head").over(Window.partitionBy("document_id").orderBy("block"))).where("head is not null")
    last = rows.where("following is null").drop("following").join(after, ["document_id", "block"]).withColumnRenamed("head", "following")
    both = rows.where("following is not null").select("provision_id", "following").union(last.select("provision_id", "following"))
    return _edges(both, F.col("provision_id"), F.col("following"), "NEXT")


def edges(documents: DataFrame, provisions: DataFrame, requirements: DataFrame, tags: DataFrame) -> DataFrame:
    """All edges before assembly, equal ones already merged."""
    present = lambda df, *cols: df.where(" and ".join(f"{c} is not null" for c in cols))
    parts = _edges(present(provisions, "document_id", "provision_id"), F.col("document_id"), F.col("provision_id"), "HAS_PROVISION")
    parts = parts.unionByName(_edges(present(requirements, "provision_id", "requirement_id"), F.col("provision_id"), F.col("requirement_id"), "HAS_REQUIREMENT"))
    replaced = present(documents, "document_id", "replaces")
    parts = parts.unionByName(_edges(replaced, F.col("document_id"), F.col("replaces"), "REPLACES"))
    parts = parts.unionByName(_edges(replaced, F.col("replaces"), F.col("document_id"), "REPLACED_BY"))
    if "replaced" in documents.columns:
        parts = parts.unionByName(_edges(present(documents, "document_id", "replaced"), F.col("document_id"), F.col("replaced"), "REPLACED_BY"))
    for column, kind, prefix in (("topics", "ABOUT", "topic:"), ("entities", "MENTIONS", "entity:")):
        tagged = present(tags, "id").select("id", F.explode(column).alias("name")).where("name is not null")
        parts = parts.unionByName(_edges(tagged, F.col("id"), F.concat(F.lit(prefix), "name"), kind))
    return parts.unionByName(subsections(provisions)).dropDuplicates(["source", "target", "type"])


def dangling(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """(source, target, type, missing) of edges with an end that is no node."""
    ids = node_table.select("id").distinct()
    lost = None
    for end in ("source", "target"):
        part = edge_table.join(ids, F.col(end) == F.col("id"), "left_anti").withColumn("missing", F.col(end))
        lost = part if lost is None else lost.unionByName(part)
    return lost.select("source", "target", "type", "missing").distinct()


def assemble(node_table: DataFrame, edge_table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes once per id, and the edges whose both ends are among them."""
    order = F.array_position(F.array(*map(F.lit, _ORDER)), F.col("type"))
    others = [c for c in node_table.columns if c != "id"]
    once = node_table.groupBy("id").agg(F.min_by(F.struct(*others), F.struct(order, "name")).alias("n")).select("id", *[f"n.{c}" for c in others])
    ids = once.select("id")
    kept = edge_table.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return once, kept


def node_props(documents: DataFrame, provisions: DataFrame, requirements: DataFrame) -> DataFrame:
    """(id, type, props): the properties of record nodes, absent ones empty; of several rows of an id the greatest values."""
    out = None
    for kind, df, key in (("Document", documents, "document_id"), ("Provision", provisions, "provision_id"), ("Requirement", requirements, "requirement_id")):
        have = [c for c in PROPS[kind] if c in df.columns]
        rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*[F.max(c).alias("p_" + c) for c in have])
        props = F.create_map(*[x for c in PROPS[kind] for x in (F.lit(c), F.coalesce(F.col("p_" + c), F.lit("")) if c in have else F.lit(""))])
        part = rows.select("id", F.lit(kind).alias("type"), props.alias("props"))
        out = part if out is None else out.unionByName(part)
    return out


def version_chains(documents: DataFrame) -> DataFrame:
    """(document_id, ancestor, steps): everything a document replaces, directly or not.

    One join per step of the longest chain, until no chain goes on.
    """
    step = documents.where("document_id is not null and replaces is not null").select("document_id", "replaces").distinct()
    reached = step.select("document_id", F.col("replaces").alias("ancestor"), F.lit(1).alias("steps"), F.array("document_id", "replaces").alias("path")).where("document_id <> replaces")
    out, link = reached, step.select(F.col("document_id").alias("ancestor"), F.col("replaces").alias("older"))
    n = 1
    while not reached.isEmpty():
        n += 1
        reached = reached.join(link, "ancestor").where(~F.array_contains("path", F.col("older"))).select(
            "document_id", F.col("older").alias("ancestor"), F.lit(n).alias("steps"), F.array_append("path", F.col("older")).alias("path")
        )
        reached = checkpointed(reached)
        out = out.unionByName(reached)
    return out.groupBy("document_id", "ancestor").agg(F.min("steps").alias("steps"))


def topic_requirements(requirements: DataFrame, tags: DataFrame) -> DataFrame:
    """(topic, modality, n): requirements by the topics of their provision, counted once each."""
    topics = tags.where("id is not null").select(F.col("id").alias("provision_id"), F.explode("topics").alias("topic")).where("topic is not null").distinct()
    reqs = requirements.select("requirement_id", "provision_id", "modality").distinct()
    return reqs.join(topics, "provision_id").groupBy("topic", "modality").agg(F.count(F.lit(1)).alias("n"))


def citations(provisions: DataFrame, documents: DataFrame) -> DataFrame:
    """CITES edges: provisions to documents whose number their text names (spaces and dash style ignored)."""
    squeeze = lambda c: F.regexp_replace(F.upper(c), r"[\s —–-]+", "")
    numbers = documents.where("standard_id is not null and document_id is not null").select(squeeze(F.col("standard_id")).alias("number"), "document_id").distinct()
    named = F.regexp_extract_all("text", F.lit(r"(?:GB/T|GB|ISO|IEC|ECE R|REG) ?[0-9]+(?:\.[0-9]+)?(?:[—:/-][0-9]{4})?"), F.lit(0))
    cited = provisions.where("provision_id is not null").select("provision_id", F.explode(F.array_distinct(F.transform(named, squeeze))).alias("number"))
    return _edges(cited.join(numbers, "number"), F.col("provision_id"), F.col("document_id"), "CITES").distinct()
