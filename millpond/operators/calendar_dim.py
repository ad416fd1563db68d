"""Calendar dimension: one row per day with shop-relevant flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The earthquake and the length of its recovery period.
EARTHQUAKE = date(2016, 4, 16)
RECOVERY_DAYS = 50


def date_range(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Every day from start to end, generated on the executors."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def dates_between(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last one in a table's column."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return ends.filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("date"))


def national_days(holidays: DataFrame) -> DataFrame:
    """One row per date with a national holiday; two entries on a date fold into one."""
    return (
        holidays.filter(F.col("locale") == "National")
        .groupBy("date")
        .agg(
            F.bool_or(~F.col("transferred")).alias("is_national_holiday"),
            F.bool_or("transferred").alias("is_national_holiday_transferred"),
        )
    )


def with_flags(
    days: DataFrame,
    event_day: date | str = EARTHQUAKE,
    recovery_days: int = RECOVERY_DAYS,
    weekend_days: tuple[int, ...] = (1, 7),
) -> DataFrame:
    """Payday, weekday, weekend and recovery columns; day numbers start at Sunday = 1."""
    day = F.col("date")
    event = F.lit(str(event_day)).cast("date")
    since = F.datediff(day, event)
    recovering: Column = since.between(0, recovery_days)
    return days.select(
        "date",
        ((F.dayofmonth(day) == 15) | (day == F.last_day(day))).alias("is_payday"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(*weekend_days).alias("is_weekend"),
        recovering.alias("is_earthquake_recovery"),
        F.when(recovering, since).alias("days_since_earthquake"),
    )


def build(days: DataFrame, holidays: DataFrame, **options) -> DataFrame:
    """The whole date dimension: flags plus the two national-holiday columns."""
    joined = with_flags(days, **options).join(national_days(holidays), "date", "left")
    return joined.fillna(False, ["is_national_holiday", "is_national_holiday_transferred"])
