"""Incremental runs: raw files are compared with the manifest, and only what new ones touch is read and rebuilt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..archives import base_name, stage
from ..lake import REPORT_SCHEMA, append_manifest, scan_manifest
from . import registry

STAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"


def listed_files(spark: SparkSession, raw: str) -> DataFrame:
    """(path, bytes, changed) of every raw file, from the listing alone: no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def compared_files(spark: SparkSession, listed: DataFrame, known: DataFrame, force: bool = False) -> DataFrame:
    """Files that may hold something new: (path, bytes, sha256, is_new).

    A file of the size and path of its last entry that has not changed since that run is left out unread. The others are hashed: one
    is new unless its last entry has the same digest or, if it has no entry, any file did. ``force`` takes all for new.
    """
    last = known.groupBy("path").agg(F.max_by(F.struct("bytes", "sha256", "fetched_at"), "fetched_at").alias("last"))
    with_last = listed.join(last, "path", "left")
    unchanged = (F.col("bytes") == F.col("last.bytes")) & (F.col("changed") <= F.to_timestamp("last.fetched_at", STAMP))
    candidates = with_last if force else with_last.where(~F.coalesce(unchanged, F.lit(False)))
    # Paths of candidates pass through the driver, as those of any files that Spark is told to read.
    paths = [r["path"] for r in candidates.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "path string, bytes bigint, sha256 string, is_new boolean")
    hashed = spark.read.format("binaryFile").load(paths).select("path", F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    digests = known.select(F.col("sha256").alias("_known")).distinct()
    told = hashed.join(last, "path", "left").join(digests, F.col("sha256") == F.col("_known"), "left")
    same = F.when(F.col("last").isNotNull(), F.col("last.sha256") == F.col("sha256")).otherwise(F.col("_known").isNotNull())
    return told.select("path", "bytes", "sha256", (F.lit(force) | ~F.coalesce(same, F.lit(False))).alias("is_new"))


def files_to_read(listed: DataFrame, new: DataFrame, label: str | None) -> list[str]:
    """Every file of a partition that a new file fills; a partition is replaced as a whole, so it needs all of its files."""
    if label is None:
        return [] if new.isEmpty() else [r["path"] for r in listed.select("path").collect()]
    unit = lambda files: files.withColumn("unit", F.regexp_extract(base_name(F.col("path")), label, 1))
    touched = unit(new).select("unit").distinct()
    return [r["path"] for r in unit(listed).join(touched, "unit", "left_semi").select("path").collect()]


def collect_new(spark: SparkSession, name: str, raw: str, lake: str, staging: str, manifest: str, force: bool = False, isolate: bool = False) -> DataFrame:
    """``collect_feed`` for what is new in ``raw`` since the manifest was last written; the report of that.

    A run with nothing new reads no content and reports nothing. The manifest gets an entry per file looked at, stamped with the
    time at which the run began, after its rows were published: a run that fails is repeated in full. With ``isolate`` files of
    refused partitions get no entry, so the next run tries them again.
    """
    if name not in (known := registry.feeds()):
        raise KeyError(f"unknown feed {name!r}; known: {sorted(known)}")
    feed, began = known[name], spark.sql(f"SELECT date_format(current_timestamp(), \"{STAMP}\") AS t").first()["t"]
    entries = scan_manifest(spark, manifest).where(F.col("source") == feed.table)
    listed = listed_files(spark, raw)
    compared = stage(compared_files(spark, listed, entries, force), f"{staging}/files")
    paths = files_to_read(listed, compared.where("is_new"), feed.label)
    report = spark.createDataFrame([], REPORT_SCHEMA)
    if paths:
        report = stage(registry.collect_feed(spark, name, paths, lake, f"{staging}/run", isolate), f"{staging}/report")
    done = compared
    if isolate and paths:
        refused = report.where(F.exists("notes", lambda n: n.startswith("refused: "))).select(F.col("partition").alias("unit")).distinct()
        if feed.label is None:
            done = done if refused.isEmpty() else done.limit(0)
        else:
            unit = F.regexp_extract(base_name(F.col("path")), feed.label, 1)
            done = done.withColumn("unit", unit).join(refused, "unit", "left_anti").drop("unit")
    if not compared.isEmpty():
        append_manifest(done.select(
            F.lit(began).alias("fetched_at"), F.lit(feed.table).alias("source"), F.col("path").alias("url"), "path", "bytes", "sha256",
            F.when(F.col("is_new"), F.lit("")).otherwise("content known").alias("note")), manifest)
    return report
