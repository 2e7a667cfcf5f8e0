"""Object changes as a stream: facts of events, and counts in windows of event time.

An extension beyond the batch facts: the same projections over a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.facts import Facts, exploded


def read_events(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def change_rows(events: DataFrame) -> DataFrame:
    """Events (event_id, ts, user_id, event_type) as metadata of the object they change."""
    return events.select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 3).alias("changeset"),
        F.unix_timestamp(F.date_trunc("second", "ts")).alias("seconds"),
        F.col("event_type").alias("user"),
        F.col("user_id").alias("uid"),
        F.lit(1).cast("long").alias("version"),
        F.lit(True).alias("visible"),
    )


def meta_triples(events: DataFrame, facts: Facts) -> DataFrame:
    """(s, p, o) of each change; works alike on a table and on a stream."""
    return exploded(change_rows(events), facts.meta(T.id_iri("osmway", "id", facts.fmt)))


def windowed_counts(events: DataFrame, *, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, users) per window of event time.

    On a stream, state older than the watermark is dropped and its window is final.
    """
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return (
        timed.groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "users")
    )


def write_stream(triples: DataFrame, path: str, checkpoint: str):
    """Lines appended as files; the checkpoint makes each row appear once."""
    return (
        triples.select(T.line().alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
