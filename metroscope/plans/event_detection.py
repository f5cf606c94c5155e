"""Event detection: score a day against the median of its own weekday.

Raw counts are summed to (venue, day) once, with partial sums before the only shuffle that
depends on the size of the counts. Everything after works on venue calendars.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import day_name, iso_weekday
from ..functions.numbers import round_half_away
from ..operators.filters import (
    BASELINE_EXCLUDED_MONTHS,
    filter_baseline_months,
    filter_ids_not_null,
    filter_wanted_dates,
)
from ..operators.windows import percentile_rank_average, top_per_group

VENUE = ("venue_id",)


def daily_series(counts: DataFrame, stop_ids: Iterable[int] | DataFrame, stop_col="id_refa_lda", count_col="nb_vald") -> DataFrame:
    """Total per day over a set of stations. Masked counts are absent, never zero."""
    known = filter_ids_not_null(counts, stop_ids, stop_col, count_col)
    return known.groupBy("jour").agg(F.sum(count_col).alias("validations"))


def venue_bridge(venues: DataFrame) -> DataFrame:
    """(venue_id, id_refa_lda): one row per serving station."""
    return venues.select("venue_id", F.explode(F.array_distinct("serving_zdc")).alias("id_refa_lda"))


def venue_days(counts: DataFrame, bridge: DataFrame, stop_col="id_refa_lda", count_col="nb_vald") -> DataFrame:
    """Daily totals of every venue in one pass.

    Counts shrink to (station, day) before they meet the bridge, so whichever join Spark picks
    moves calendars and not raw rows, and a station with a third of all rows is no hot spot.
    """
    stations = (
        counts.where(F.col(count_col).isNotNull())
        .groupBy(F.col(stop_col).alias("id_refa_lda"), "jour")
        .agg(F.sum(count_col).alias("_total"))
    )
    return (
        stations.join(bridge, "id_refa_lda").groupBy("venue_id", "jour").agg(F.sum("_total").alias("validations"))
    )


def calendar_parts(series: DataFrame, day_col: str = "jour") -> DataFrame:
    return series.withColumns(
        {"dow": iso_weekday(F.col(day_col)), "month": F.month(day_col), "year": F.year(day_col)}
    )


def dow_baseline(series: DataFrame, by: Sequence[str] = VENUE) -> DataFrame:
    """Median per (year, weekday) outside the excluded months; exact, as groups hold 53 days at most."""
    usable = filter_baseline_months(calendar_parts(series))
    return usable.groupBy(*by, "year", "dow").agg(F.median("validations").alias("dow_median"))


def join_baseline(series: DataFrame, baseline: DataFrame, by: Sequence[str] = VENUE) -> DataFrame:
    """Attach a baseline computed elsewhere (another period, another lake) and the ratio to it."""
    joined = calendar_parts(series).join(baseline, [*by, "year", "dow"], "left")
    return joined.withColumn("ratio", F.try_divide("validations", "dow_median"))


def with_dow_baseline(series: DataFrame, by: Sequence[str] = VENUE) -> DataFrame:
    """``dow_baseline`` and ``join_baseline`` of a series with itself, as one window.

    A self join would read the counts twice; the window reads them once. Calendars are hashed
    by venue here, which serves this window and the ranking after it with one shuffle.
    """
    if by:
        series = series.repartition(*by)
    weekday = Window.partitionBy(*by, "year", "dow")
    usable = F.when(~F.col("month").isin(*BASELINE_EXCLUDED_MONTHS), F.col("validations"))
    scored = calendar_parts(series).withColumn("dow_median", F.median(usable).over(weekday))
    return scored.withColumn("ratio", F.try_divide("validations", "dow_median"))


def event_scores(series: DataFrame, dates: Iterable | DataFrame | None = None, by: Sequence[str] = VENUE, within: Sequence[str] = ()) -> DataFrame:
    """Ratio, excess and percentile of every day; dates are picked after ranking.

    ``within=("year",)`` ranks a day inside its own year instead of the whole series.
    """
    scored = with_dow_baseline(series, by).where(F.col("ratio").isNotNull())
    ranked = percentile_rank_average(scored, "ratio", [*by, *within])
    ranked = ranked.withColumn("excess", F.col("validations") - F.col("dow_median"))
    if dates is not None:
        ranked = filter_wanted_dates(ranked, dates)
    return ranked.select(*by, "jour", "validations", "dow_median", "excess", "ratio", "pctile")


def event_scores_by_year(series: DataFrame, dates=None, by: Sequence[str] = VENUE) -> DataFrame:
    return event_scores(series, dates, by, within=("year",))


def negative_control(series: DataFrame, dates, by: Sequence[str] = VENUE, ceiling: float = 25.0) -> DataFrame:
    """Dates expected to score low, with a flag telling whether they do."""
    scored = event_scores(series, dates, by)
    return scored.withColumn("low_as_expected", F.col("pctile") <= F.lit(ceiling))


def round_scores(scored: DataFrame) -> DataFrame:
    """Presentation only: a day name and the published number of digits."""
    digits = {"ratio": 2, "dow_median": 0, "excess": 0, "pctile": 1}
    rounded = {c: round_half_away(F.col(c), n) for c, n in digits.items() if c in scored.columns}
    return scored.withColumns({"day": day_name(F.col("jour")), **rounded})


def outliers(series: DataFrame, top: int = 15, by: Sequence[str] = VENUE) -> DataFrame:
    """The most anomalous days of each venue, earliest first among equals."""
    scored = with_dow_baseline(series, by).where(F.col("ratio").isNotNull())
    best = top_per_group(scored, by, [F.desc("ratio"), F.asc("jour")], top)
    return best.select(*by, "jour", "validations", "dow_median", "ratio")


def event_verdict(scored: DataFrame, by: Sequence[str] = VENUE, wanted: DataFrame | None = None) -> DataFrame:
    """PASS from the 90th median percentile, PASS (weak) from the 75th, else FAIL.

    ``wanted`` lists the venues to judge: those without a scored date are there with NO DATA.
    """
    summary = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.median("pctile").alias("median_pctile"),
        F.count_if(F.col("pctile") >= 90.0).alias("top_decile"),
    )
    if wanted is not None:
        summary = wanted.select(*by).distinct().join(summary, list(by), "left").withColumns(
            {"n": F.coalesce("n", F.lit(0).cast("bigint")), "top_decile": F.coalesce("top_decile", F.lit(0).cast("bigint"))})
    verdict = (
        F.when(F.col("n") == 0, "NO DATA")
        .when(F.col("median_pctile") >= 90.0, "PASS")
        .when(F.col("median_pctile") >= 75.0, "PASS (weak)")
        .otherwise("FAIL")
    )
    return summary.withColumn("verdict", verdict)


def venue_summary(series: DataFrame, by: Sequence[str] = VENUE) -> DataFrame:
    return series.groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"),
        F.min("jour").alias("first_day"),
        F.max("jour").alias("last_day"),
        F.median("validations").cast("bigint").alias("median"),
        F.max("validations").alias("peak"),
    )


def venue_signal_quality(series: DataFrame, by: Sequence[str] = VENUE) -> DataFrame:
    """Best ratio per venue and year: how learnable a venue is."""
    scored = with_dow_baseline(series, by).where(F.col("ratio").isNotNull())
    return scored.groupBy(*by, "year").agg(F.max("ratio").alias("best_ratio"))
