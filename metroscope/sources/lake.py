"""The lake on disk: one Parquet table per source, partitioned by ``part``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "part"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("fetched_at", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("note", T.StringType()),
    ]
)
REPORT_SCHEMA = "source string, partition string, rows bigint, path string, notes array<string>"
VENUE_SCHEMA = (
    "venue_id string, name string, commune string, lat double, lon double, "
    "serving_zdc string, radius_m int, notes string"
)
CAPACITY_SCHEMA = (
    "venue_id string, config string, capacity bigint, unit string, confidence string, "
    "capacity_source string, verified_on date"
)


# -- paths (any file system Spark can reach) ------------------------------------------------

def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    if not path_exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == folders]
    return sorted(n for n in names if not n.startswith(("_", ".")))


# -- scans ----------------------------------------------------------------------------------

def _read_parts(spark: SparkSession, table: str, folders: Iterable[str], merge: bool) -> DataFrame:
    """Partition labels stay text: inference would turn ``01`` into 1."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.option("mergeSchema", merge).option("basePath", table).parquet(*folders)
    finally:
        spark.conf.set(key, before)


def scan_table(spark: SparkSession, table: str, merge: bool = True) -> DataFrame:
    """All partitions as one relation, columns matched by name.

    ``merge=False`` takes the columns from one file and skips the pass over all footers; right
    when only counts are wanted or every partition was written by the same job.
    """
    return _read_parts(spark, table, [table], merge)


def scan_partitions(spark: SparkSession, table: str, parts: Iterable[str]) -> DataFrame:
    """Only the named partitions; an error when none of them exists.

    Other partitions are not even listed, so their footers are not merged.
    """
    folders = [f"{table}/{PART}={p}" for p in parts]
    present = [f for f in folders if path_exists(spark, f)]
    if not present:
        raise FileNotFoundError(f"none of {folders} exists")
    return _read_parts(spark, table, present, merge=True)


def scan_reference_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A curated CSV. Small by nature; Spark broadcasts it after seeing its file size."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_venues(spark: SparkSession, path: str) -> DataFrame:
    from ..functions.text import split_id_list

    venues = scan_reference_csv(spark, path, VENUE_SCHEMA)
    return venues.withColumns(
        {"serving_zdc": split_id_list(F.col("serving_zdc")), "notes": F.coalesce("notes", F.lit(""))}
    )


def read_capacities(spark: SparkSession, path: str) -> DataFrame:
    return scan_reference_csv(spark, path, CAPACITY_SCHEMA)


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The provenance log; an empty table of the same schema when there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def register_views(spark: SparkSession, lake: str, reference: str | None = None) -> list[str]:
    """Every source and every reference CSV as a temporary view, under its own name."""
    names = []
    for source in list_names(spark, lake, folders=True):
        scan_table(spark, f"{lake}/{source}").createOrReplaceTempView(f"`{source}`")
        names.append(source)
    for file in list_names(spark, reference, folders=False) if reference else []:
        if file.endswith(".csv"):
            view = file.removesuffix(".csv")
            frame = spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(f"{reference}/{file}")
            frame.createOrReplaceTempView(f"`{view}`")
            names.append(view)
    return names


def sql_over_lake(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Any SQL over the registered views, uncut; a limit for display runs inside the query."""
    result = spark.sql(text)
    return result if limit is None else result.limit(limit)


# -- sinks ----------------------------------------------------------------------------------

def publish_partition(df: DataFrame, table: str, part: str | Column | None = None) -> None:
    """Replace whole partitions: a re-run never duplicates, other partitions stay.

    ``part`` labels the rows; without it the frame must already have a ``part`` column. The
    rebalance hint sizes files by bytes, so a hot partition is written by many tasks and a
    small one does not scatter into tiny files. A frame without rows leaves the table as it was.
    """
    if part is not None:
        df = df.withColumn(PART, part if isinstance(part, Column) else F.lit(part))
    (
        df.hint("rebalance", PART)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(PART)
        .parquet(table)
    )


def publish_snapshot(df: DataFrame, table: str, stamp_col: str = "polled_at", within: Sequence[str] = ()) -> None:
    """One immutable partition per poll: what the table has of a stamp is left untouched.

    ``within`` names columns that tell the polls of one stamp apart, such as the stop that was asked: a stop that
    arrives later joins its stamp's partition, a stop already there is not written twice. Known stamps come from
    the table's partition column (and ``within``) and never pass through the driver. New polls are added by one
    write, which appears as a whole or not at all.
    """
    out = df.withColumn(PART, F.date_format(stamp_col, "yyyyMMdd'T'HHmmss'Z'") if not isinstance(
        df.schema[stamp_col].dataType, T.StringType) else F.col(stamp_col))
    if path_exists(df.sparkSession, table):
        stored = df.sparkSession.read.parquet(table).withColumn(PART, F.col(PART).cast("string"))
        known = stored.select(PART, *within).distinct()
        same = F.lit(True)
        for c in (PART, *within):
            same = same & out[c].eqNullSafe(known[c])
        out = out.join(known, same, "left_anti")
    out.hint("rebalance", PART).write.mode("append").option("compression", "zstd").partitionBy(PART).parquet(table)


def append_manifest(entries: DataFrame, path: str) -> None:
    """Append provenance rows; history is never rewritten."""
    known = set(entries.columns)
    row = [
        (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA
    ]
    entries.select(*row).write.mode("append").json(path)


def skip_known_digest(files: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Only payloads whose content was never archived before."""
    if force:
        return files
    return files.join(manifest.select("sha256").where(F.col("sha256").isNotNull()), "sha256", "left_anti")


# -- incremental maintenance ----------------------------------------------------------------

def month_bounds(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def month_spine(bounds: DataFrame) -> DataFrame:
    """Months ``YYYY-MM`` from first to last, both included; none when they are reversed.

    ``bounds`` is a one-row table (first, last): ``month_bounds`` or an aggregate of the data.
    """
    start, end = (F.to_date(F.concat(F.col(c), F.lit("-01"))) for c in ("first", "last"))
    months = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("_day")).select(F.date_format("_day", "yyyy-MM").alias("month"))


def months_to_refresh(spine: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """Months not published yet, and always the latest: it is still being filled at the source."""
    if force:
        return spine
    latest = spine.agg(F.max("month").alias("month"))
    missing = spine.join(existing.select("month"), "month", "left_anti")
    return missing.unionByName(latest).distinct()


def run_report(df: DataFrame, source: str, table: str, notes: Mapping[str, Column] | None = None) -> DataFrame:
    """What a run wrote, per partition: rows, path and the notes whose count is not zero.

    ``notes`` maps a text to an aggregate, as ``{"masked counts": F.count_if("nb_vald_masked")}``.
    """
    notes = notes or {}
    columns = {text: f"_note{i}" for i, text in enumerate(notes)}
    agg = df.groupBy(PART).agg(
        F.count(F.lit(1)).alias("rows"), *[expr.alias(columns[text]) for text, expr in notes.items()]
    )
    texts = [F.when(F.col(c) != 0, F.concat(F.col(c).cast("string"), F.lit(f" {text}"))) for text, c in columns.items()]
    listed = F.array_compact(F.array(*texts)) if texts else F.array().cast("array<string>")
    return agg.select(
        F.lit(source).alias("source"),
        F.col(PART).cast("string").alias("partition"),
        "rows",
        F.concat(F.lit(f"{table}/{PART}="), F.col(PART).cast("string")).alias("path"),
        listed.alias("notes"),
    )


def lake_status(spark: SparkSession, lake: str) -> DataFrame:
    """Per source: partitions, rows and megabytes. No data column is read."""
    def one(source: str) -> DataFrame:
        per_file = (
            scan_table(spark, f"{lake}/{source}", merge=False)
            .groupBy(PART, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"))
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        return per_file.agg(
            F.lit(source).alias("source"),
            F.count_distinct(PART).alias("partitions"),
            F.sum("_rows").alias("rows"),
            F.round(F.sum("_size") / F.lit(1e6), 1).alias("mb"),
        )

    sources = list_names(spark, lake, folders=True)
    if not sources:
        return spark.createDataFrame([], "source string, partitions bigint, rows bigint, mb double")
    return reduce(DataFrame.unionByName, map(one, sources))


def idempotency_check(df: DataFrame, table: str) -> DataFrame:
    """Rows per partition after publishing twice, beside the rows handed in."""
    publish_partition(df, table)
    publish_partition(df, table)
    handed = df.groupBy(F.col(PART).cast("string").alias(PART)).agg(F.count(F.lit(1)).alias("handed"))
    stored = scan_table(df.sparkSession, table, merge=False).groupBy(PART).agg(F.count(F.lit(1)).alias("stored"))
    return handed.join(stored, PART, "full")
