"""Problem 5: references to records that do not exist.

Foreign keys are reduced to their distinct non-null values, with the earliest
time a record names them, before they meet the parents. A left anti-join finds
keys without a parent, an inner join those of deleted parents and those whose
parent came in after some record; only these bad keys are joined back to the
referring records. A key of ``HOT_ROWS`` records or more is never shuffled with
its records: there can be no more such keys than records / ``HOT_ROWS``, so they
are broadcast.

Defined results: a null key is no reference and gives no row; an empty string is
a key like any other; a record stored several times counts once, from its
earliest ``ingested_at`` (null where no row has one, then the period is null and
``late`` cannot hold); a record whose copies name different keys is checked for
each; an empty parent table makes every reference ``missing``; extra columns are
never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: A key that so many records name is joined back by broadcast.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Reference:
    """One referring field: ``child.key`` must name a row of ``parent.parent_key``."""

    child: str
    record_id: str
    key: str
    parent: str
    parent_key: str

    @property
    def field_name(self) -> str:
        return f"{self.child}.{self.key}"


#: The referring fields of the project's tables.
REFERENCES = (
    Reference("requirements", "requirement_id", "provision_id", "provisions", "provision_id"),
    Reference("provisions", "provision_id", "document_id", "documents", "document_id"),
    Reference("requirements", "requirement_id", "document_id", "documents", "document_id"),
)


def parent_states(parent: DataFrame, key: str, deleted_at: str = "deleted_at") -> DataFrame:
    """One row per key of the parent: when it first came in, whether it is deleted."""
    deleted = F.col(deleted_at).isNotNull() if deleted_at in parent.columns else F.lit(False)
    return (
        parent.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("ref_key"))
        .agg(F.min("ingested_at").alias("parent_first"), F.max(deleted).alias("parent_deleted"))
    )


def referring_records(child: DataFrame, ref: Reference) -> DataFrame:
    """Distinct (record, key) with the earliest time the record came in.

    The two-column aggregate combines map-side; the window then only sees one
    row per record and key.
    """
    per_key = child.groupBy(F.col(ref.record_id).alias("rec_id"), F.col(ref.key).alias("ref_key")).agg(
        F.min("ingested_at").alias("first_in")
    )
    earliest = F.min("first_in").over(Window.partitionBy("rec_id"))
    return per_key.withColumn("first_in", earliest).where(F.col("ref_key").isNotNull() & F.col("rec_id").isNotNull())


def bad_keys(records: DataFrame, states: DataFrame) -> DataFrame:
    """(ref_key, n, parent_first, state): keys with a missing or deleted parent, or one later than some record."""
    keys = records.groupBy("ref_key").agg(F.count(F.lit(1)).alias("n"), F.min("first_in").alias("key_first"))
    missing = keys.join(states, "ref_key", "left_anti").select("ref_key", "n", F.lit(None).cast(states.schema["parent_first"].dataType).alias("parent_first"), F.lit("missing").alias("state"))
    state = F.when(F.col("parent_deleted"), "deleted").when(F.col("parent_first") > F.col("key_first"), "late")
    present = keys.join(states, "ref_key").select("ref_key", "n", "parent_first", state.alias("state"))
    return missing.unionByName(present.where("state is not null"))


def orphans(child: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """(field_name, rec_id, ref_key, reason, period) of every broken reference."""
    records = referring_records(child, ref)
    bad = bad_keys(records, parent_states(parent, ref.parent_key))
    hot = records.groupBy("ref_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_ROWS).select("ref_key")
    columns = ["ref_key", "parent_first", "state"]
    many = records.join(F.broadcast(bad.where(F.col("n") >= HOT_ROWS).select(*columns)), "ref_key")  # at most records / HOT_ROWS keys
    few = records.join(F.broadcast(hot), "ref_key", "left_anti").join(bad.where(F.col("n") < HOT_ROWS).select(*columns), "ref_key")
    broken = many.unionByName(few).where((F.col("state") != "late") | (F.col("parent_first") > F.col("first_in")))
    return broken.select(
        F.lit(ref.field_name).alias("field_name"),
        "rec_id",
        "ref_key",
        F.col("state").alias("reason"),
        F.date_format("first_in", "yyyy-MM").alias("period"),
    )


def all_orphans(tables: dict[str, DataFrame], references: tuple[Reference, ...] = REFERENCES) -> DataFrame:
    """Broken references of every referring field, one union."""
    out = None
    for ref in references:
        part = orphans(tables[ref.child], tables[ref.parent], ref)
        out = part if out is None else out.unionByName(part)
    return out


def orphan_report(tables: dict[str, DataFrame], references: tuple[Reference, ...] = REFERENCES) -> DataFrame:
    """Per referring field and period: records with a reference, and broken ones by reason."""
    broken = (
        all_orphans(tables, references)
        .groupBy("field_name", "period")
        .agg(
            F.count_if(F.col("reason") == "missing").alias("n_missing"),
            F.count_if(F.col("reason") == "deleted").alias("n_deleted"),
            F.count_if(F.col("reason") == "late").alias("n_late"),
        )
    )
    total = None
    for ref in references:
        part = (
            referring_records(tables[ref.child], ref)
            .groupBy(F.date_format("first_in", "yyyy-MM").alias("period"))
            .agg(F.count(F.lit(1)).alias("n_references"))
            .select(F.lit(ref.field_name).alias("field_name"), "period", "n_references")
        )
        total = part if total is None else total.unionByName(part)
    same = F.col("t.field_name").eqNullSafe(F.col("b.field_name")) & F.col("t.period").eqNullSafe(F.col("b.period"))
    return (
        total.alias("t")
        .join(broken.alias("b"), same, "left")
        .select(
            "t.field_name",
            "t.period",
            "t.n_references",
            *[F.coalesce(F.col(f"b.{c}"), F.lit(0)).alias(c) for c in ("n_missing", "n_deleted", "n_late")],
        )
    )
