"""Pages and events as streams: the same projections as the batch sources, kept up to date.

For tables that grow while they are read; the batch jobs regenerate everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as X


def page_stream(spark: SparkSession, folder: str, glob: str = "*.{htm,HTM,html,HTML}") -> DataFrame:
    """New pages of a folder as they arrive: path, title and article."""
    raw = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return raw.select(F.col("_metadata.file_path").alias("path"), X.title_of(F.col("value")).alias("title"), X.article_of(F.col("value")).alias("article"))


def once_within(df: DataFrame, key: str, at: str, lateness: str = "7 days") -> DataFrame:
    """Each key once while its repeats come within the lateness; the state is dropped after it."""
    return df.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(df: DataFrame, at: str, by: str, width: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """(window_start, by, n) over windows of event time; rows later than the lateness are left out."""
    counts = df.withWatermark(at, lateness).groupBy(F.window(at, width), by).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), by, "n")
