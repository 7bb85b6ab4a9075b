"""Column selection, missing values, casts and type shrinking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.hashing import key_uniform
from ..plans.scalars import Scalars

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# Largest number each type holds
INT_LIMITS = {"tinyint": 127, "smallint": 32767, "int": 2147483647, "bigint": 9223372036854775807}
FLOAT_LIMITS = {"float": 3.4028235e38, "double": 1.7976931348623157e308}


def cols_like(df: DataFrame, pattern: str) -> list[str]:
    """Names that match a regular expression anywhere."""
    return [c for c in df.columns if re.search(pattern, c)]


def variable_dictionary(
    df: DataFrame, contains: Mapping[str, str] | None = None, by_range: Mapping[str, tuple[int, int]] | None = None
) -> dict[str, str]:
    """Category of each column: the part before the first ``_``, overridden by substring and then by place."""
    out = {c: c.split("_")[0] for c in df.columns}
    for part, category in (contains or {}).items():
        out.update({c: category for c in out if part in c})
    for category, (first, last) in (by_range or {}).items():
        out.update({c: category for c in df.columns[first:last]})
    return out


def cols_of(dictionary: Mapping[str, str], category: str) -> list[str]:
    return [c for c, found in dictionary.items() if found == category]


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL + FRACTIONAL)]


def categorical_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def select_features(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), ignore: Sequence[str] = ()):
    """Split the columns by type with configured overrides; a configured name that does not exist is an error."""
    unknown = [c for c in [*numeric, *categorical, *ignore] if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    nums = [c for c in dict.fromkeys([*numeric_cols(df), *numeric]) if c not in categorical and c not in ignore]
    cats = [c for c in dict.fromkeys([*categorical_cols(df), *categorical]) if c not in numeric and c not in ignore]
    return nums, cats


def assign_where(df: DataFrame, mask: Column, column: str, value) -> DataFrame:
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))


def fill_missing(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls, NaN and the text ``None`` become the constant, in the type of each column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if cols is not None and f.name not in cols:
            out.append(c)
            continue
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == "None", None).otherwise(c)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        elif not isinstance(f.dataType, INTEGRAL):
            out.append(c)
            continue
        out.append(F.coalesce(c, F.lit(value).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Nulls become the most frequent value, the lowest one on ties."""
    return df.withColumn(column, F.coalesce(F.col(column), Scalars(mode_table(df, column), mode=F.first(column))["mode"]))


def mode_table(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value (per group); counted per value first, so that no buffer holds all values of a group."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(column).alias("v")))
    top = counts.groupBy(*keys).agg(best.alias("__best"))
    return top.select(*keys, F.col("__best.v").alias(column), (-F.col("__best.n")).alias("n"))


def sentinel_to_null(df: DataFrame, pattern: str, value) -> DataFrame:
    """A marker value becomes null in every column whose name matches."""
    return df.withColumns({c: F.when(F.col(c) != value, F.col(c)) for c in cols_like(df, pattern)})


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct non-null values per column as rows; two plain aggregates over (column, value) pairs."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("p")).select("p.feature", "p.value").distinct()
    return long.groupBy("feature").agg(F.count("value").alias("n_unique"))


def drop_low_information(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop columns without two different values. Min and max decide it, so no distinct set is built."""
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    names = [c for c in names if cols is None or c in cols]
    spread = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in names]).first()
    return df.drop(*[c for c in names if not spread[c]])


def nonzero_columns(df: DataFrame, mask: Column, cols: Sequence[str] | None = None) -> DataFrame:
    """On the masked rows, keep the numeric columns that are never 0."""
    names = list(cols) if cols is not None else numeric_cols(df)
    rows = df.filter(mask)
    kept = rows.agg(*[F.coalesce(F.bool_and(F.coalesce(F.col(c) != 0, F.lit(True))), F.lit(True)).alias(c) for c in names]).first()
    return rows.select(*[c for c in names if kept[c]])


def hash_sample(df: DataFrame, key: str, share: float, seed: str = "sample") -> DataFrame:
    """Row sample that depends on the key alone."""
    return df.filter(key_uniform(key, seed) < share)


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    seen: set[str] = set()
    places = [i for i, c in enumerate(df.columns) if not (c in seen or seen.add(c))]
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in places])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; values that do not fit the type become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def _extremes(df: DataFrame, names: Sequence[str]):
    if not names:
        return {}
    aggs = [F.min(c).alias(f"min_{i}") for i, c in enumerate(names)] + [F.max(c).alias(f"max_{i}") for i, c in enumerate(names)]
    row = df.agg(*aggs).first()
    return {c: (row[f"min_{i}"], row[f"max_{i}"]) for i, c in enumerate(names)}


def shrink_by_max(df: DataFrame) -> dict[str, str]:
    """Smallest type that holds the column's minimum and maximum: 16 bits and up for integers, 32 bits and up for floats."""
    out = {}
    seen = _extremes(df, numeric_cols(df))
    for f in df.schema.fields:
        if f.name not in seen or seen[f.name][1] is None:
            continue
        low, top = seen[f.name]
        whole = isinstance(f.dataType, INTEGRAL)
        limits = {k: v for k, v in INT_LIMITS.items() if k != "tinyint"} if whole else FLOAT_LIMITS
        out[f.name] = next((t for t, most in limits.items() if -most - whole <= low and top <= most), list(limits)[-1])
    return out


def shrink_by_range(df: DataFrame, skip: str | None = None) -> dict[str, str]:
    """Smallest type that holds minimum and maximum strictly inside its range: 8 bits and up for integers; the
    half-precision target has no Spark type and becomes ``float``. Names that contain ``skip`` are left alone."""
    out = {}
    names = [c for c in numeric_cols(df) if not (skip and skip in c)]
    seen = _extremes(df, names)
    for f in df.schema.fields:
        if f.name not in seen or seen[f.name][1] is None:
            continue
        low, high = seen[f.name]
        limits = INT_LIMITS if isinstance(f.dataType, INTEGRAL) else FLOAT_LIMITS
        floor = 1 if isinstance(f.dataType, INTEGRAL) else 0
        fits = [t for t, most in limits.items() if low > -most - floor and high < most]
        out[f.name] = fits[0] if fits else f.dataType.simpleString()
    return out


def compress_dtypes(df: DataFrame) -> DataFrame:
    return cast_exact(df, shrink_by_max(df))


def reduce_mem_usage(df: DataFrame, skip: str | None = None) -> DataFrame:
    return cast_exact(df, shrink_by_range(df, skip))


def cast_exact(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()}) if types else df


def dtype_report(df: DataFrame, cut: float = 0.5) -> DataFrame:
    """Old and recommended type per column; text with few distinct values per row is called a category."""
    numbers = shrink_by_range(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    spark = df.sparkSession
    old = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, old[c], t) for c, t in numbers.items()]
    fixed = spark.createDataFrame(rows, "feature string, old_type string, new_type string")
    if not texts:
        return fixed
    total = Scalars(df, n=F.count(F.lit(1)))["n"]
    labelled = distinct_counts(df, texts).select(
        "feature",
        F.lit("string").alias("old_type"),
        F.when(F.try_divide(F.col("n_unique"), total) < cut, "category").otherwise("string").alias("new_type"),
    )
    return fixed.unionByName(labelled)


def split_by_max(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns whose maximum is 1 (flags) and those above 1."""
    top = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return [c for c in cols if top[c] == 1], [c for c in cols if top[c] is not None and top[c] > 1]
