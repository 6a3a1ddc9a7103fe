"""New documents as a stream through the same transforms as a batch. Goes beyond one-shot conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import strip
from folioscope.operators import damage
from folioscope.operators import elements as E


def documents(spark: SparkSession, folder: str, schema: str = "doc_id long, text string") -> DataFrame:
    """Parquet files as they arrive."""
    return spark.readStream.schema(schema).parquet(folder)


def roles(stream: DataFrame) -> DataFrame:
    """doc_id, body_pos, text, role and level of each line; stateless, so it needs no watermark."""
    text, style = F.col("text"), F.lit(None).cast("string")
    out = E.lines(stream).withColumn("text", strip("raw_text"))
    return out.select("doc_id", "body_pos", "text", E.role(text, style).alias("role"), E.level(text, style).alias("level"), damage.score(text).alias("damage"))


def role_counts(stream: DataFrame, time: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Roles by window of a time column; state of windows older than the watermark is dropped."""
    text, style = F.col("text"), F.lit(None).cast("string")
    rows = stream.withWatermark(time, late).select(time, F.explode(F.split("text", "\n")).alias("raw_text")).withColumn("text", strip("raw_text"))
    return rows.groupBy(F.window(time, window), E.role(text, style).alias("role")).count()


def start(out: DataFrame, folder: str, checkpoint: str, once: bool = True):  # noqa: ANN201
    writer = out.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
