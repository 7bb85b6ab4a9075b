"""Categorical encoders, quantile bins and feature dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordering import attach_ranks, group_quantiles, row_numbers
from ..plans.scalars import Scalars
from ..plans.session import materialise
from ..plans.skew import lookup_join
from .columns import distinct_counts

MAX_ONE_HOT = 2000


def quantile_edges(df: DataFrame, column: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The ``n + 1`` exact quantile edges per group as columns ``e0 .. en``."""
    return group_quantiles(df, column, {f"e{i}": i / n for i in range(n + 1)}, keys)


def qcut(df: DataFrame, column: str, n: int, labels: Sequence[str] | None = None, name: str | None = None) -> DataFrame:
    """Quantile bin of each row as an ordinal or a label. Equal edges are merged before the numbering."""
    s = Scalars(materialise(quantile_edges(df, column, n)), **{f"e{i}": F.first(f"e{i}") for i in range(n + 1)})
    edges = [s[f"e{i}"] for i in range(n + 1)]
    out = df.withColumn(name or f"{column}_bin", _merged_code(column, edges))
    if labels:
        names = F.array(*[F.lit(x) for x in labels])
        out = out.withColumn(name or f"{column}_bin", F.get(names, F.col(name or f"{column}_bin")))
    return out


def _merged_code(column: str, edges) -> Column:
    """Bin ordinal over quantile edges: first bin closed on both sides, empty bins skipped in the numbering."""
    x = F.col(column)
    code = F.lit(-1)
    for i in range(len(edges) - 1):
        counts = (edges[i] < edges[i + 1]) & ((x > edges[i]) if i else (x >= edges[0]))
        code = code + F.when(counts, 1).otherwise(0)
    first = F.when(x == edges[0], 0).otherwise(code)
    return F.when(x.isNotNull(), first).cast("int")


def group_qcut(df: DataFrame, keys: Sequence[str], column: str, n: int, name: str | None = None, salt_on=None) -> DataFrame:
    """Quantile bin of the average rank within each group."""
    ranked = attach_ranks(df, column, keys, columns=("rank_avg",), salt_on=salt_on)
    edges = quantile_edges(ranked, "rank_avg", n, keys)
    joined = lookup_join(ranked, edges, keys, salt_on=salt_on)
    out = joined.withColumn(name or f"{column}_q", _merged_code("rank_avg", [F.col(f"e{i}") for i in range(n + 1)]))
    return out.drop("rank_avg", *[f"e{i}" for i in range(n + 1)])


def value_codes(df: DataFrame, column: str, start: int = 0) -> DataFrame:
    """Distinct non-null values with a code in value order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return row_numbers(values, [column], name="code").withColumn("code", F.col("code") - 1 + start)


class OrdinalEncoder:
    """Codes from 1 in value order, fitted on one table; unseen values and nulls become 0."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.state: dict[str, DataFrame] = {}

    def fit(self, df: DataFrame) -> "OrdinalEncoder":
        self.state = {c: materialise(value_codes(df, c, start=1)) for c in self.cols}
        return self

    def transform(self, df: DataFrame, salt_on=None) -> DataFrame:
        for c in self.cols:
            table = self.state[c].withColumnRenamed("code", "__code")
            df = lookup_join(df, table, [c], salt_on=salt_on, ready=True)
            df = df.withColumn(c, F.coalesce("__code", F.lit(0)).cast("int")).drop("__code")
        return df

    def save(self, path: str) -> None:
        for c, table in self.state.items():
            table.write.mode("overwrite").parquet(f"{path}/{c}")

    def load(self, spark, path: str) -> "OrdinalEncoder":
        self.state = {c: spark.read.parquet(f"{path}/{c}") for c in self.cols}
        return self


def label_encode(df: DataFrame, column: str, name: str = "label") -> DataFrame:
    """Codes from 0 in value order."""
    return lookup_join(df, value_codes(df, column).withColumnRenamed("code", name), [column])


def category_values(df: DataFrame, column: str, most: int = MAX_ONE_HOT) -> list:
    """Distinct values for the naming of one-hot columns; a column with more than ``most`` values is refused."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values; use one_hot_sparse, which has no bound")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per distinct value, in place of the column."""
    added = []
    for c in cols:
        added += [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in category_values(df, c)]
    return df.select(*[c for c in df.columns if c not in cols], *added)


def factorize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """More than two distinct values: one-hot columns; otherwise a 0/1 code in value order."""
    wide = {r["feature"]: r["n_unique"] > 2 for r in distinct_counts(df, cols).collect()}
    for c in cols:
        if wide.get(c):
            df = one_hot(df, [c])
        else:
            values = category_values(df, c, 2)
            code = F.lit(None).cast("int")
            for i, v in reversed(list(enumerate(values))):
                code = F.when(F.col(c) == v, i).otherwise(code)
            df = df.withColumn(c, code)
    return df


def _sparse(df: DataFrame, key: str, cols: Sequence[str], codes: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """((key, indices), (index, name)) from tables (value, code, name) per column; codes of a column start where the one before
    ends. An entry of a row without a code stays out."""
    names, start, parts = None, F.lit(0).cast("long"), []
    for c in cols:
        # the number of codes so far is a one-row subquery
        table = materialise(codes[c].select("value", (F.col("code") + start).alias("index"), F.lit(c).alias("column"), "name"))
        start = start + Scalars(table, n=F.count_distinct("index"))["n"]
        parts.append(table)
        block = table.select("index", "name").filter("name IS NOT NULL").distinct()
        names = block if names is None else names.unionByName(block)
    table = parts[0].select("column", "value", "index")
    for more in parts[1:]:
        table = table.unionByName(more.select("column", "value", "index"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(key, F.explode(pairs).alias("p")).select(key, "p.*").filter("value IS NOT NULL")
    found = lookup_join(long, table, ["column", "value"], "inner", [key])
    lists = found.groupBy(key).agg(F.array_sort(F.collect_list("index")).alias("indices"))
    empty = F.array().cast("array<bigint>")
    return df.select(key).join(lists, key, "left").select(key, F.coalesce("indices", empty).alias("indices")), names


def one_hot_sparse(df: DataFrame, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """((key, indices), (index, name)): one-hot encoding of any width. ``indices`` holds the positions of the ones in ascending
    order, ``name`` is ``<column>_<value>``; positions go by column and then by the text of the value, and are numbered by a
    distributed sort, so nothing is collected. Nulls have no entry. ``key`` is unique."""
    texts = df.select(F.col(key).alias("__key"), *[F.col(c).cast("string").alias(c) for c in cols])
    codes = {}
    for c in cols:
        table = value_codes(texts, c).withColumnRenamed(c, "value")
        codes[c] = table.withColumn("name", F.concat(F.lit(f"{c}_"), "value"))
    rows, names = _sparse(texts, "__key", cols, codes)
    return rows.withColumnRenamed("__key", key), names


def factorize_sparse(df: DataFrame, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """As ``one_hot_sparse`` for columns of more than two values; a column of one or two values has one position, named like the
    column, which holds the higher of two values."""
    texts = df.select(F.col(key).alias("__key"), *[F.col(c).cast("string").alias(c) for c in cols])
    wide = {r["feature"]: r["n_unique"] > 2 for r in distinct_counts(texts, cols).collect()}
    codes = {}
    for c in cols:
        table = value_codes(texts, c).withColumnRenamed(c, "value")
        if wide.get(c):
            codes[c] = table.withColumn("name", F.concat(F.lit(f"{c}_"), "value"))
        else:
            low = texts.sparkSession.createDataFrame([(None, 0, c)], "value string, code long, name string")
            high = table.filter("code = 1").select("value", (F.col("code") - 1).alias("code"), F.lit(None).cast("string").alias("name"))
            codes[c] = low.unionByName(high)
    rows, names = _sparse(texts, "__key", cols, codes)
    return rows.withColumnRenamed("__key", key), names


def binary_encode(df: DataFrame, cols: Sequence[str], salt_on=None) -> DataFrame:
    """Binary digits of the ordinal code, lowest digit last, in columns ``<column>_<place>``."""
    encoder = OrdinalEncoder(cols).fit(df)
    widths = {c: max(1, (encoder.state[c].agg(F.max("code")).first()[0] or 0).bit_length()) for c in cols}
    out = encoder.transform(df, salt_on)
    for c in cols:
        w = widths[c]
        out = out.withColumns({f"{c}_{i}": F.shiftright(F.col(c), w - 1 - i).bitwiseAND(F.lit(1)) for i in range(w)})
    return out


def build_feature_index(df: DataFrame, cols: Sequence[str], tags: Sequence[str] = (), min_share: float = 0.001) -> DataFrame:
    """One index per ``column:value`` in lexical order. Values below the share are pooled to ``column:others``; comma
    lists (``tags``) are split, keep every tag and always get an ``others`` entry."""
    total = Scalars(df, n=F.count(F.lit(1)))["n"]
    parts = []
    if cols:
        pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols])
        counts = (
            df.select(F.explode(pairs).alias("p"))
            .select("p.field", "p.value")
            .filter(F.col("value").isNotNull())
            .groupBy("field", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        pooled = F.when(F.col("n") / total < min_share, "others").otherwise(F.col("value"))
        parts.append(counts.select("field", pooled.alias("value")))
    for t in tags:
        split = df.select(F.explode(F.split(t, ",")).alias("value")).filter(F.col("value") != "")
        parts.append(split.select(F.lit(t).alias("field"), "value"))
        # an empty group still yields one row, so the entry exists without reading the rows
        parts.append(df.select(t).limit(0).agg(F.lit(t).alias("field"), F.lit("others").alias("value")))
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    named = everything.distinct().withColumn("feature", F.concat_ws(":", "field", "value"))
    return row_numbers(named, ["feature"], name="idx").withColumn("idx", F.col("idx") - 1)


def encode_long(df: DataFrame, key: str, index: DataFrame, cols: Sequence[str], tags: Sequence[str] = ()) -> DataFrame:
    """(key, field, idx) per known entry: the value's index, else the index of ``others``, else nothing.

    Every row also keeps one entry without a field, so that a row without known values is not lost."""
    plain = [F.struct(F.lit(c).alias("field"), F.array(F.col(c).cast("string")).alias("items")) for c in cols]
    lists = [F.struct(F.lit(t).alias("field"), F.split(F.col(t), ",").alias("items")) for t in tags]
    anchor = F.struct(F.lit(None).cast("string").alias("field"), F.array(F.lit(None).cast("string")).alias("items"))
    long = (
        df.select(key, F.explode(F.array(anchor, *plain, *lists)).alias("p"))
        .select(key, "p.field", F.explode("p.items").alias("value"))
        .filter(F.col("field").isNull() | (F.col("value").isNotNull() & (F.col("value") != "")))
    )
    table = materialise(index.select("field", "value", "idx"))
    others = table.filter(F.col("value") == "others").select("field", F.col("idx").alias("other_idx"))
    found = lookup_join(long, table, ["field", "value"], salt_on=[key], ready=True)
    # at most one row per field, so the table is as small as the list of columns
    found = found.join(F.broadcast(others), "field", "left")
    return found.select(key, "field", F.coalesce("idx", "other_idx").alias("idx"))


def encode_rows(df: DataFrame, key: str, index: DataFrame, cols: Sequence[str], tags: Sequence[str] = ()) -> DataFrame:
    """One sorted index list per row key; an index repeats as often as the row has it."""
    long = encode_long(df, key, index, cols, tags)
    return long.groupBy(key).agg(F.array_sort(F.collect_list("idx")).alias("indices"))


def field_offsets(index: DataFrame) -> DataFrame:
    """Per field: its number of indices and where they start, in lexical order of the fields."""
    sizes = index.groupBy("field").agg(F.count(F.lit(1)).alias("size"), F.min("idx").alias("offset"))
    return sizes


def split_fields(df: DataFrame, indices: str, offsets: DataFrame) -> DataFrame:
    """Index list cut into one list per field, shifted to start at 0; the field list is read to name the columns."""
    fields = offsets.orderBy("offset").collect()

    def part(low: int, high: int) -> Column:
        inside = F.filter(indices, lambda x: (x >= low) & (x < high))
        return F.transform(inside, lambda x: x - low)

    cols = [part(f["offset"], f["offset"] + f["size"]).alias(f["field"]) for f in fields]
    return df.select(*[c for c in df.columns if c != indices], *cols)


class FeatureDictionary:
    """Field-aware dictionary: one index per numeric column, one per value of a categorical column, numbered by
    (place of the column, value)."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str]):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.state: DataFrame | None = None

    def fit(self, *frames: DataFrame) -> "FeatureDictionary":
        parts = None
        for df in frames:
            pairs = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("field"), F.lit("").alias("value")) for i, c in enumerate(self.numeric)]
            shift = len(self.numeric)
            pairs += [
                F.struct(F.lit(shift + i).alias("place"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                for i, c in enumerate(self.categorical)
            ]
            long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter(F.col("value").isNotNull()).distinct()
            parts = long if parts is None else parts.unionByName(long)
        numbered = row_numbers(parts.distinct(), ["place", "value"], name="idx")
        self.state = materialise(numbered.withColumn("idx", F.col("idx") - 1))
        return self

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        """Index list and value list per row: the number itself for numeric columns, 1.0 for a category."""
        pairs = [
            F.struct(F.lit(i).alias("place"), F.lit(c).alias("field"), F.lit("").alias("value"), F.col(c).cast("double").alias("x"))
            for i, c in enumerate(self.numeric)
        ]
        shift = len(self.numeric)
        pairs += [
            F.struct(
                F.lit(shift + i).alias("place"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), F.lit(1.0).alias("x")
            )
            for i, c in enumerate(self.categorical)
        ]
        long = df.select(key, F.explode(F.array(*pairs)).alias("p")).select(key, "p.*").filter(F.col("value").isNotNull())
        found = lookup_join(long, self.state.select("place", "value", "idx"), ["place", "value"], "inner", [key], ready=True)
        rows = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "idx", "x"))).alias("__e"))
        return rows.select(key, F.col("__e.idx").alias("xi"), F.col("__e.x").alias("xv"))


def to_items(df: DataFrame, cols: Sequence[str], name: str = "items") -> DataFrame:
    """``column:value`` strings of a row."""
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in cols]
    return df.withColumn(name, F.array_compact(F.array(*parts)))


def detect_categoricals(df: DataFrame, cols: Sequence[str], most: int = 100) -> list[str]:
    """Columns that look like category codes: few distinct values, no gaps to speak of, whole and not negative."""
    aggs = []
    for c in cols:
        whole = F.coalesce((F.col(c) == F.floor(c)) & (F.col(c) >= 0), F.lit(True))
        aggs += [F.min(c).cast("double").alias(f"{c}|lo"), F.max(c).cast("double").alias(f"{c}|hi"), F.bool_and(whole).alias(f"{c}|whole")]
    row = df.agg(*aggs).first()
    uniques = {r["feature"]: r["n_unique"] for r in distinct_counts(df, cols).collect()}
    out = []
    for c in cols:
        n, lo, hi = uniques.get(c, 0), row[f"{c}|lo"], row[f"{c}|hi"]
        if n and n < most and hi <= n + 1 and hi - lo >= n - 1 and row[f"{c}|whole"]:
            out.append(c)
    return out
