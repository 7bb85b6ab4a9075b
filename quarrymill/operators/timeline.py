"""Day numbers, time splits, day series and conversion rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import row_numbers
from ..plans.scalars import Scalars
from ..plans.skew import lookup_join


def day_num(df: DataFrame, date: str, name: str = "day_num") -> DataFrame:
    """0-based number of the day among the sorted distinct days."""
    days = row_numbers(df.select(date).filter(F.col(date).isNotNull()).distinct(), [date], name=name)
    return lookup_join(df, days.withColumn(name, (F.col(name) - 1).cast("int")), [date])


def daily_average(df: DataFrame, ts: str) -> DataFrame:
    """Number of distinct days and rows per day."""
    per_day = df.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(F.count("date").alias("days"), F.try_divide(F.sum("n"), F.count("date")).alias("avg_rows"))


def time_split(df: DataFrame, day: str, ratio: float, name: str = "split") -> DataFrame:
    """``train`` up to the day ``int(ratio * last day)``, ``valid`` after it."""
    last = Scalars(df, last=F.max(day))["last"]
    cut = F.floor(F.lit(ratio) * last)
    return df.withColumn(name, F.when(F.col(day) <= cut, "train").otherwise("valid"))


def daily_series(df: DataFrame, ts: str, value: str, mask: Column) -> DataFrame:
    """Per day: rows, mean and sum of a value, rows of a subset and its share. Runs on streams as well."""
    hit = F.count_if(mask)
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean_value"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("sum_value"),
        hit.alias("n_subset"),
        F.try_divide(hit, F.count(F.lit(1))).alias("subset_ratio"),
    )


def conversion(df: DataFrame, base: Column, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows in the base, rows in the base with the event, and the rate."""
    flags = df.select(*by, base.alias("__base"), event.alias("__event"))
    both = F.count_if(F.col("__base") & F.col("__event"))
    return flags.groupBy(*by).agg(
        F.count_if("__base").alias("n_base"),
        both.alias("n_event"),
        F.try_divide(both, F.count_if("__base")).alias("rate"),
    )
