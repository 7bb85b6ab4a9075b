"""D: date and time features, and the flagship user-day payment features."""

from pyspark.sql import functions as F

from ..functions.dates import date_parts, holiday_flag, time_class
from ..operators import timeline as T
from ..operators.aggregate import GroupStats, recipe
from ..plans.scalars import Scalars
from .registry import load, query, r


@query("d01_date_parts", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, CAST(day(ts) AS INTEGER) AS day, CAST(week(ts) AS INTEGER) AS week FROM events""")
def parts(spark, d):
    out = load(spark, d, "events").select("event_id", *date_parts("ts"))
    return out.withColumn("date", F.col("date").cast("string"))


@query("d02_day_num", "SELECT event_id, CAST(dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS INTEGER) AS day_num FROM events")
def day_num(spark, d):
    events = load(spark, d, "events").withColumn("date", F.to_date("ts"))
    return T.day_num(events, "date").select("event_id", "day_num")


@query("d03_time_class", """
SELECT event_id, CASE WHEN hour(ts) <= 7 THEN 'night' WHEN hour(ts) <= 12 THEN 'morning' WHEN hour(ts) <= 18 THEN 'afternoon' ELSE 'evening' END AS time_class FROM events""")
def time_classes(spark, d):
    return load(spark, d, "events").select("event_id", time_class("ts").alias("time_class"))


@query("d04_holiday_flag", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) BETWEEN DATE '1998-02-13' AND DATE '1998-02-22' OR CAST(o_orderdate AS DATE) BETWEEN DATE '1997-10-01' AND DATE '1997-10-07' AS INTEGER) AS holiday FROM orders""")
def holidays(spark, d):
    ranges = [("1998-02-13", "1998-02-22"), ("1997-10-01", "1997-10-07")]
    return load(spark, d, "orders").select("o_orderkey", holiday_flag("o_orderdate", ranges).alias("holiday"))


@query("d05_daily_average", "SELECT count(DISTINCT CAST(ts AS DATE)) AS days, round(count(*) / count(DISTINCT CAST(ts AS DATE)), 6) AS avg_rows FROM events")
def daily_average(spark, d):
    return T.daily_average(load(spark, d, "events"), "ts").withColumn("avg_rows", r("avg_rows"))


@query("d06_time_split", """
WITH n AS (SELECT event_id, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS day_num FROM events)
SELECT event_id, CASE WHEN day_num <= floor(0.8 * (SELECT max(day_num) FROM n)) THEN 'train' ELSE 'valid' END AS split FROM n""")
def time_split(spark, d):
    events = T.day_num(load(spark, d, "events").withColumn("date", F.to_date("ts")), "date")
    return T.time_split(events, "day_num", 0.8).select("event_id", "split")


@query("d07_daily_series", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, round(avg(value), 6) AS mean_value, round(sum(value), 4) AS sum_value,
  count(*) FILTER (WHERE event_type = 'purchase') AS n_subset, round(count(*) FILTER (WHERE event_type = 'purchase') / count(*), 6) AS subset_ratio FROM events GROUP BY 1""")
def daily_series(spark, d):
    out = T.daily_series(load(spark, d, "events"), "ts", "value", F.col("event_type") == "purchase")
    return out.select(F.col("date").cast("string").alias("date"), "n", r("mean_value").alias("mean_value"), r("sum_value", 4).alias("sum_value"), "n_subset", r("subset_ratio").alias("subset_ratio"))


@query("d08_conversion", """
WITH c AS (SELECT min(CAST(ts AS DATE)) + 7 AS cut FROM events),
u AS (SELECT user_id, bool_or(event_type = 'purchase' AND CAST(ts AS DATE) < cut) AS early, bool_or(event_type = 'purchase' AND CAST(ts AS DATE) >= cut) AS late, user_id % 3 AS grp FROM events, c GROUP BY user_id)
SELECT grp, count(*) FILTER (WHERE early) AS n_base, count(*) FILTER (WHERE early AND late) AS n_event,
  round(CASE WHEN count(*) FILTER (WHERE early) > 0 THEN count(*) FILTER (WHERE early AND late) / count(*) FILTER (WHERE early) END, 6) AS rate FROM u GROUP BY grp""")
def conversion(spark, d):
    events = load(spark, d, "events").withColumn("date", F.to_date("ts"))
    cut = F.date_add(Scalars(events, first=F.min("date"))["first"], 7)
    paid = F.col("event_type") == "purchase"
    users = events.groupBy("user_id").agg(F.bool_or(paid & (F.col("date") < cut)).alias("early"), F.bool_or(paid & (F.col("date") >= cut)).alias("late"))
    users = users.withColumn("grp", F.col("user_id") % 3)
    return T.conversion(users, F.col("early"), F.col("late"), ["grp"]).withColumn("rate", r("rate"))


# Value bands
BANDS = [-0.01, 0, 1, 10, 100, 1000, 5000]

FLAGSHIP_RECIPES = [
    recipe(["day_num"], [("value", f) for f in ("mean", "sum", "q_range", "skew", "median", "range")]),
    recipe(["band"], [("value", f) for f in ("mean", "sum", "skew", "median", "range", "var")]),
]

_FNS = {
    "mean": "avg(value)",
    "sum": "sum(value)",
    "q_range": "quantile_cont(value, 0.99) - quantile_cont(value, 0.01)",
    "skew": "CASE WHEN count(value) >= 3 AND var_pop(value) > 0 THEN skewness(value) END",
    "median": "median(value)",
    "range": "max(value) - min(value)",
    "var": "var_samp(value)",
}


# Statistics with few decimals are summed per user and the others averaged, so that both engines round alike.
_SUMMED = ("_sum", "_median", "_range")


def _per_user(c: str):
    return r(F.sum(c), 6) if c.endswith(_SUMMED) else r(F.avg(c), 5 if c.endswith("_var") else 8)


def _per_user_sql(c: str) -> str:
    return f"round(sum({c}), 6)" if c.endswith(_SUMMED) else f"round(avg({c}), {5 if c.endswith('_var') else 8})"


def _flagship_sql():
    def stats(key):
        fns = [f for k in FLAGSHIP_RECIPES if k.keys == (key,) for _, f in k.specs]
        cols = ", ".join(f"coalesce({_FNS[f]}, 0) AS {key}_value_{f}" for f in fns)
        return f"SELECT {key}, {cols} FROM b GROUP BY {key}", [f"{key}_value_{f}" for f in fns]

    day, day_cols = stats("day_num")
    band, band_cols = stats("band")
    names = day_cols + band_cols
    per_user = ", ".join(f"{_per_user_sql(n)} AS {n}, round(avg(value / ({n} + 1)), 8) AS {n}_neutral" for n in names)
    return f"""
WITH b AS (SELECT user_id, value, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS day_num,
  CASE WHEN value > -0.01 AND value <= 0 THEN 0 WHEN value > 0 AND value <= 1 THEN 1 WHEN value > 1 AND value <= 10 THEN 2
  WHEN value > 10 AND value <= 100 THEN 3 WHEN value > 100 AND value <= 1000 THEN 4 WHEN value > 1000 AND value <= 5000 THEN 5 END AS band FROM events),
dd AS ({day}), bb AS ({band})
SELECT user_id, count(*) AS n, {per_user} FROM b LEFT JOIN dd USING (day_num) LEFT JOIN bb USING (band) GROUP BY user_id"""


@query("flagship_user_day", _flagship_sql())
def flagship(spark, d):
    """Day numbers, value bands, group statistics by day and band joined back, neutral ratios, then one row per user."""
    from ..functions.binning import cut_code

    events = load(spark, d, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("date"))
    rows = T.day_num(events, "date").withColumn("band", cut_code("value", BANDS))
    stats = GroupStats(FLAGSHIP_RECIPES, live_key="day_num").fit(rows)
    wide = stats.transform(rows, salt_on=["event_id"])
    features = [c for c in wide.columns if c.startswith(("day_num_", "band_"))]
    return wide.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), *[_per_user(c).alias(c) for c in features])
