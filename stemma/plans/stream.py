"""Event-time windows in batch form; the stream runs the same expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.plans.registry import query, table
from stemma.streaming import ids


@query("""SELECT CAST(epoch(time_bucket(INTERVAL 1 hour, ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL""")
def windowed_events(spark: SparkSession, folder: str) -> DataFrame:
    out = ids.windowed_counts(table(spark, folder, "events"))
    return out.select(F.unix_timestamp(F.col("window.start").cast("timestamp")).alias("start"), "event_type", "n", F.round("value", 4).alias("value"))
