"""Features as a stream: an extension, since the batch plans have no streaming form of their own.

New payload files are read as they arrive, cleaned by the same expressions as in batch, and
counted by voltage level; updates of one element within the watermark count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh.functions import tags

SCHEMA = "id string, country string, voltage string, power string, ts timestamp"


def feature_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Flat features from JSON lines in a folder, as they arrive."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def cleaned_stream(features: DataFrame, min_volts: int, delay: str = "1 hour") -> DataFrame:
    """Distinct features of at least the minimum, with clean voltages."""
    df = features.withColumn("voltage", tags.clean_voltage(F.col("voltage")))
    return df.where(tags.voltage_at_least(F.col("voltage"), min_volts)).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])


def levels_by_window(features: DataFrame, window: str = "1 day") -> DataFrame:
    """(start, voltage, n): parts at each voltage in each window of time."""
    parts = features.select("ts", F.explode(F.split("voltage", ";")).alias("voltage"))
    return parts.groupBy(F.window("ts", window).alias("w"), "voltage").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "voltage", "n")
