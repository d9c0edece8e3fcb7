"""Text fields of several tables as one table of (field_name, rec_id, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rec_id column of each table that holds text fields.
RECORD_ID = {"documents": "document_id", "provisions": "provision_id", "requirements": "requirement_id"}


def field_values(tables: dict[str, DataFrame], fields: tuple[str, ...], *extra: str, where: Column | None = None) -> DataFrame:
    """One row per stored row and field whose value is not null or empty.

    ``extra`` columns are carried along where the table has them, else null.
    Only the named columns are read from the files.
    """
    out = None
    for name in fields:
        table, column = name.split(".")
        df = tables[table]
        if where is not None:
            df = df.where(where)
        more = [(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in extra]
        part = df.select(F.lit(name).alias("field_name"), F.col(RECORD_ID[table]).alias("rec_id"), F.col(column).alias("value"), *more)
        part = part.where((F.col("value") != "") & F.col("rec_id").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out


def arrow_rows(batch, *names: str):
    """Columns of an Arrow batch as Python lists, row by row."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))
