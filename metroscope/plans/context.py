"""Companion analyses: supply, sensors, weather, calendar, flows and punctuality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Upper ends of the availability and rain bands.
AVAILABILITY_BANDS = (0.10, 0.50, 0.90)
AVAILABILITY_LABELS = ("<10%", "10-50%", "50-90%", ">90%")
RAIN_BANDS_MM = (0.0, 2.0, 8.0)
RAIN_LABELS = ("dry", "0-2", "2-8", ">8")


# -- sensors -----------------------------------------------------------------------------

def sensor_shares(readings: DataFrame, sensor: str = "iu_ac", flow: str = "q") -> DataFrame:
    """Share of hours with a reading, per sensor."""
    known, total = F.count(flow), F.count(F.lit(1))
    return readings.groupBy(sensor).agg((known.cast("double") / total.cast("double")).alias("availability"))


def sensor_availability(readings: DataFrame, sensor: str = "iu_ac", flow: str = "q") -> DataFrame:
    """How many sensors fall into each availability band."""
    share = F.col("availability")
    low, middle, high = AVAILABILITY_BANDS
    band = (
        F.when(share < low, AVAILABILITY_LABELS[0])
        .when(share < middle, AVAILABILITY_LABELS[1])
        .when(share <= high, AVAILABILITY_LABELS[2])
        .otherwise(AVAILABILITY_LABELS[3])
    )
    return sensor_shares(readings, sensor, flow).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("sensors"))


def availability_weighted_flow(readings: DataFrame, by: Column | str, sensor: str = "iu_ac", flow: str = "q") -> DataFrame:
    """Mean flow with each reading weighted by its sensor's availability.

    Readings shrink to (sensor, group) first; the availability then comes from a window over
    those few rows, so readings are scanned and shuffled once.
    """
    by = F.col(by) if isinstance(by, str) else by
    partial = readings.groupBy(F.col(sensor).alias("_sensor"), by.alias("grp")).agg(
        F.sum(flow).alias("_flow"), F.count(flow).alias("_known"), F.count(F.lit(1)).alias("_all")
    )
    own = Window.partitionBy("_sensor")
    weight = F.sum("_known").over(own).cast("double") / F.sum("_all").over(own).cast("double")
    return (
        partial.withColumn("_w", weight)
        .groupBy("grp")
        .agg(F.try_divide(F.sum(F.col("_flow") * F.col("_w")), F.sum(F.col("_known") * F.col("_w"))).alias("weighted_flow"))
    )


def hourly_profile(readings: DataFrame, ts: str = "t_1h", flow: str = "q") -> DataFrame:
    return readings.groupBy(F.hour(ts).alias("hour")).agg(
        F.count(flow).alias("readings"), F.avg(flow).alias("mean_flow")
    )


# -- supply and independent measures ------------------------------------------------------

def compare_measures(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str, right_value: str, how: str = "inner") -> DataFrame:
    """Sum two measures per key, then relate them. Both sides shrink before they are joined."""
    a = left.groupBy(*keys).agg(F.sum(left_value).alias(left_value))
    b = right.groupBy(*keys).agg(F.sum(right_value).alias(right_value))
    ratio = F.try_divide(F.col(left_value).cast("double"), F.col(right_value).cast("double"))
    return a.join(b, list(keys), how).withColumn("ratio", ratio)


def load_factor(demand: DataFrame, supply: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Validations over planned trips."""
    return compare_measures(demand, supply, keys, "validations", "trips").withColumnRenamed("ratio", "load")


def calibrate_counts(validations: DataFrame, boardings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Validations against boardings counted on board, an independent measure."""
    joined = compare_measures(validations, boardings, keys, "validations", "boardings")
    return joined.withColumnRenamed("ratio", "capture")


def capture_ratio(scored: DataFrame, attendance: DataFrame, keys: Sequence[str] = ("venue_id",)) -> DataFrame:
    """Excess validations over attendance (or capacity) for every configuration of the venue."""
    return scored.join(attendance, list(keys)).withColumn(
        "capture", F.try_divide(F.col("excess"), F.col("capacity").cast("double"))
    )


# -- calendar -----------------------------------------------------------------------------

def interval_days(intervals: DataFrame, start: str, end: str, day_col: str = "jour") -> DataFrame:
    """The distinct days covered by a set of date intervals: turns BETWEEN into an equi join."""
    valid = intervals.where(F.col(start) <= F.col(end)).select(start, end).distinct()
    return valid.select(F.explode(F.sequence(start, end)).alias(day_col)).distinct()


def calendar_features(days: DataFrame, holidays: DataFrame, school: DataFrame, day_col: str = "jour", works: DataFrame | None = None) -> DataFrame:
    """Day typology: weekend, public holiday, school holiday, and days with roadworks.

    ``holidays`` has (date); ``school`` and ``works`` have (start_date, end_date), both inclusive.
    """
    def flagged(frame: DataFrame, marks: DataFrame, name: str) -> DataFrame:
        return frame.join(marks.withColumn(name, F.lit(True)), day_col, "left").withColumn(
            name, F.coalesce(name, F.lit(False))
        )

    out = days.withColumn("is_weekend", F.weekday(day_col) >= 5)
    out = flagged(out, holidays.select(F.col("date").alias(day_col)).distinct(), "is_holiday")
    out = flagged(out, interval_days(school, "start_date", "end_date", day_col), "is_school_holiday")
    if works is not None:
        out = flagged(out, interval_days(works, "start_date", "end_date", day_col), "has_works")
    return out


# -- weather ------------------------------------------------------------------------------

def rain_band(mm: Column) -> Column:
    dry, light, heavy = RAIN_BANDS_MM
    return (
        F.when(mm <= dry, RAIN_LABELS[0])
        .when(mm <= light, RAIN_LABELS[1])
        .when(mm <= heavy, RAIN_LABELS[2])
        .when(mm > heavy, RAIN_LABELS[3])
    )


def rain_band_effect(daily: DataFrame, rain: DataFrame, value: str = "validations") -> DataFrame:
    """Days and mean daily count per rain band. Raw: it also measures the season."""
    joined = daily.join(rain.where(F.col("rr").isNotNull()), "jour")
    return joined.groupBy(rain_band(F.col("rr")).alias("band")).agg(
        F.count(F.lit(1)).alias("days"), F.avg(value).alias("mean_count")
    )


def month_normalised_effect(daily: DataFrame, rain: DataFrame, value: str = "validations") -> DataFrame:
    """Each day over the median of its month, averaged per band: the season is gone.

    The median is taken over all days of the month, before the join can lose any.
    """
    month = Window.partitionBy(F.year("jour"), F.month("jour"))
    relative = daily.withColumn("_relative", F.try_divide(F.col(value), F.median(value).over(month)))
    joined = relative.join(rain.where(F.col("rr").isNotNull()), "jour")
    return joined.groupBy(rain_band(F.col("rr")).alias("band")).agg(
        F.count(F.lit(1)).alias("days"), F.avg("_relative").alias("mean_ratio")
    )


# -- punctuality --------------------------------------------------------------------------

def delay_by_line_minute(calls: DataFrame, line: str = "line_ref", aimed: str = "aimed_departure", delay: str = "delay_s") -> DataFrame:
    """Planned against actual service by line by minute."""
    minute = F.date_trunc("minute", F.col(aimed))
    return (
        calls.where(F.col(aimed).isNotNull())
        .groupBy(line, minute.alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("departures"),
            F.median(delay).alias("median_delay_s"),
            F.avg(delay).alias("mean_delay_s"),
            F.max(delay).alias("max_delay_s"),
        )
    )


def feed_freshness(docks: DataFrame, polled: str = "polled_at", own: str = "duedate") -> DataFrame:
    """Age of each station's own timestamp at poll time."""
    age = F.timestamp_diff("SECOND", F.col(own), F.col(polled))
    return (
        docks.withColumn("_age", age)
        .groupBy("stationcode")
        .agg(
            F.count(F.lit(1)).alias("polls"),
            F.min("_age").alias("freshest_s"),
            F.max("_age").alias("stalest_s"),
            F.median("_age").alias("median_age_s"),
        )
    )


# -- flows and accidents ------------------------------------------------------------------

def flow_totals(flows: DataFrame, keys: Sequence[str] = ("CODGEO", "DCLT"), weight: str = "nb_actifs") -> DataFrame:
    return flows.groupBy(*keys).agg(F.sum(weight).alias("workers"))


def top_od_flows(flows: DataFrame, n: int = 20, keys: Sequence[str] = ("CODGEO", "DCLT"), weight: str = "nb_actifs") -> DataFrame:
    """The largest residence-to-work pairs. The limit is the report's; the sort keeps only n rows per task."""
    return flow_totals(flows, keys, weight).orderBy(F.desc("workers"), *keys).limit(n)


def trip_purpose_breakdown(users: DataFrame, characteristics: DataFrame) -> DataFrame:
    """Accident users of the region by trip purpose. A semi join: accidents only filter."""
    kept = users.join(characteristics.select("num_acc"), "num_acc", "left_semi")
    return kept.groupBy("trajet").agg(F.count(F.lit(1)).alias("users"))


def partition_row_counts(df: DataFrame, part: Column | str = "part") -> DataFrame:
    """Rows per partition beside its neighbour's: catches a half-lost year.

    The window runs over one row per partition.
    """
    part = F.col(part) if isinstance(part, str) else part
    counts = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("total_rows"))
    previous = F.lag("total_rows").over(Window.orderBy("part"))
    return counts.withColumn("previous_rows", previous).withColumn(
        "change", F.try_divide(F.col("total_rows").cast("double"), F.col("previous_rows").cast("double"))
    )
