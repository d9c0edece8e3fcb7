"""Incremental ingest: new document files become provisions, requirements and tags.

Each micro-batch runs the same batch operators (a document is whole within its
file, so its windows never cross batches) and appends Parquet tables; the batch id
names the folder, so a batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clauseworks.operators import provisions as pv


def document_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of documents, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def derived(documents: DataFrame) -> dict[str, DataFrame]:
    """Provisions with tags, and requirements, of one batch of documents."""
    split = pv.split_provisions(pv.latest_documents(documents))
    tagged = pv.tagged(split, pv.tagging_text(F.col("text"), F.col("title"), F.col("quote")))
    return {"provisions": tagged.drop("topic_keywords", "entity_keywords"), "requirements": pv.extract_requirements(split)}


def ingest(stream: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append every batch's tables under ``root``/<table>/batch=<id>."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        for name, out in derived(df).items():
            out.write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")
        df.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per type and window; rows later than ``late`` behind the newest are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
