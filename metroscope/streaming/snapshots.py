"""Structured Streaming over raw snapshot files.

Every sink goes through ``foreachBatch`` into a table partitioned by batch number and replaced
partition by partition, so a batch that is replayed after a failure overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lake import PART, scan_table

BATCH = "batch"


def read_snapshots(spark: SparkSession, path: str, schema, fmt: str = "json", files_per_batch: int | None = None, **options) -> DataFrame:
    """New snapshot files as a stream under a fixed schema."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _publish_batch(table: str, partitions: Sequence[str], prepare: Callable[[DataFrame], DataFrame] | None) -> Callable[[DataFrame, int], None]:
    def publish(rows: DataFrame, batch_id: int) -> None:
        (
            (prepare(rows) if prepare else rows).withColumn(BATCH, F.lit(batch_id))
            .hint("rebalance", *partitions)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partitions, BATCH)
            .parquet(table)
        )

    return publish


def run_available(
    stream: DataFrame, table: str, checkpoint: str, partitions: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Process what has arrived, each batch through ``prepare``, then return the table."""
    query = (
        stream.writeStream.foreachBatch(_publish_batch(table, partitions, prepare))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return scan_table(stream.sparkSession, table)


def stream_snapshots(stream: DataFrame, table: str, checkpoint: str, stamp: Column | str = "polled_at") -> DataFrame:
    """Incremental ingest: one partition per poll stamp, split by batch.

    A stamp whose files straddle two batches keeps both, because a batch only replaces its own
    part of the stamp.
    """
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    return run_available(stream.withColumn(PART, stamp.cast("string")), table, checkpoint, [PART])


def stream_dedupe(stream: DataFrame, keys: Sequence[str], table: str, checkpoint: str) -> DataFrame:
    """A replayed row counts once, whenever it comes again and whichever batch brings it.

    Each batch drops its own repeats and publishes the rest; a key that several batches brought is
    read from the first of them. Nothing is kept in state and no row is late.
    """
    stored = run_available(stream, table, checkpoint, prepare=lambda rows: rows.dropDuplicates(list(keys)))
    values = [c for c in stored.columns if c not in (*keys, BATCH)]
    if not values:
        return stored.select(*keys).distinct()
    first = stored.groupBy(*keys).agg(F.min_by(F.struct(*values), F.col(BATCH).cast("bigint")).alias("_v"))
    return first.select(*[c if c in keys else F.col(f"_v.{c}").alias(c) for c in stored.columns if c != BATCH])


def stream_delay_windows(stream: DataFrame, table: str, checkpoint: str, line: str, aimed: str, delay: str, window: str, slide: str | None = None) -> DataFrame:
    """Delay by line in tumbling (or sliding) windows of planned time.

    Every batch publishes its own counts, sums and maxima; reading adds them up, so late rows count
    and the result does not depend on how files fall into batches.
    """
    span = F.window(aimed, window, slide) if slide else F.window(aimed, window)

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(line, span.alias("_w")).agg(
            F.count(F.lit(1)).alias("departures"), F.sum(delay).alias("total_delay_s"), F.max(delay).alias("max_delay_s"),
        ).select(line, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "departures", "total_delay_s", "max_delay_s")

    parts = run_available(stream, table, checkpoint, prepare=partial)
    return parts.groupBy(line, "window_start", "window_end").agg(
        F.sum("departures").alias("departures"), F.sum("total_delay_s").alias("total_delay_s"), F.max("max_delay_s").alias("max_delay_s"))


def stream_dock_state(stream: DataFrame, table: str, checkpoint: str, ts: str = "polled_at", window: str = "1 day", poll_seconds: int = 300) -> DataFrame:
    """Per station and window: the latest counts, and the time spent empty and full.

    Polls are periodic, so time is polls times the period. Batches publish partial results, as above.
    """

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy("stationcode", F.window(ts, window).alias("_w")).agg(
            F.count(F.lit(1)).alias("polls"),
            F.max(F.struct(F.col(ts).alias("at"), F.col("numbikesavailable").alias("bikes"), F.col("numdocksavailable").alias("docks"))).alias("last"),
            F.count_if(F.col("numbikesavailable") == 0).alias("empty"),
            F.count_if(F.col("numdocksavailable") == 0).alias("full"),
        ).select("stationcode", F.col("_w.start").alias("window_start"), "polls", "last", "empty", "full")

    parts = run_available(stream, table, checkpoint, prepare=partial)
    state = parts.groupBy("stationcode", "window_start").agg(
        F.sum("polls").alias("polls"), F.max("last").alias("last"), F.sum("empty").alias("empty"), F.sum("full").alias("full"))
    return state.select(
        "stationcode", "window_start", "polls", F.col("last.bikes").alias("last_bikes"), F.col("last.docks").alias("last_docks"),
        (F.col("empty") * F.lit(poll_seconds)).alias("seconds_empty"), (F.col("full") * F.lit(poll_seconds)).alias("seconds_full"))


def compact(table: DataFrame, keys: Sequence[str], merged: Sequence[Column], path: str) -> DataFrame:
    """Partial results of many batches as one row per key, written to ``path``: a new table to go on from."""
    table.groupBy(*keys).agg(*merged).withColumn(BATCH, F.lit(-1)).write.mode("overwrite").option("compression", "zstd").partitionBy(BATCH).parquet(path)
    return scan_table(table.sparkSession, path)
