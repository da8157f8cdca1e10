"""The review queue over documents as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lectern.plans.blocks import stylistic
from lectern.sources.tables import text_blocks, with_features


def review_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of issues of new documents: the batch transforms, which need no state."""
    docs = spark.readStream.schema(schema).parquet(path)
    return stylistic(with_features(text_blocks(docs, ["doc_id", "lang"]))).select("doc_id", "lang", "block_index", "paragraph_index", "kind", "severity")


def write_reviews(issues: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Every issue once: files are committed with the stream's checkpoint."""
    return issues.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("lang", "kind").agg(F.count("*").alias("n"))
