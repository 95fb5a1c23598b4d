"""Streams of documents: segmentation as they arrive, exact duplicates within a watermark.

The expressions of folioforge.functions are stateless and run unchanged on
streaming frames; this module wires them to sources and sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.functions.segmentation import segment_cascade


def document_stream(spark: SparkSession, path: str, schema: str, max_files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def segmented(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, pos, piece) of each document as it arrives."""
    return docs.select(id_col, F.posexplode(segment_cascade(F.col(text))).alias("pos", "piece"))


def without_repeats(docs: DataFrame, text: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Documents whose text has not come within the delay; state is a hash for each text of that time."""
    hashed = docs.withColumn("__hash", F.sha2(F.col(text), 256)).withWatermark(time, delay)
    return hashed.dropDuplicatesWithinWatermark(["__hash"]).drop("__hash")


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs over what is there and stops; the checkpoint makes a restart go on where it was."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
