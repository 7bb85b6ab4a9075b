"""Table profiling: describe, missing values, correlation, histograms, rasters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import key_hash
from ..plans.ordering import group_quantiles, row_numbers, running_sums
from ..plans.scalars import Scalars
from ..plans.skew import attach_groups, lookup_join
from ..plans.session import materialise
from .columns import distinct_counts, numeric_cols

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


#: Ranks that a task gathers before it adds up the products of their rows.
HELD_RANKS = 1 << 19


def _long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")


def _rows_of(one: DataFrame, per_column: dict[str, dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per column."""
    structs = [
        F.struct(F.lit(c).alias("feature"), *[expr.alias(k) for k, expr in parts.items()]) for c, parts in per_column.items()
    ]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    return describe_by(_long(df, cols or numeric_cols(df)), ["feature"], "value")


def describe_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    keys = list(keys)
    basic = df.groupBy(*keys).agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return basic.join(group_quantiles(df, column, QUARTILES, keys), keys, "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value and their share."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = Scalars(counts, n=F.sum("n"))["n"]
    return counts.withColumn("share", F.col("n") / total)


def missing_report(df: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Missing rows and share per column, for columns above the threshold."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(f"__k{i}") for i, c in enumerate(cols)])
    report = _rows_of(
        one,
        {
            c: {"missing": F.col("__n") - F.col(f"__k{i}"), "fraction": F.try_divide(F.col("__n") - F.col(f"__k{i}"), F.col("__n"))}
            for i, c in enumerate(cols)
        },
    )
    return report.filter(F.col("fraction") > threshold) if threshold > 0 else report


def unique_report(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per column and whether the column is constant."""
    cols = list(cols or df.columns)
    if approx:
        one = df.agg(*[F.approx_count_distinct(c).alias(f"k{i}") for i, c in enumerate(cols)])
        out = _rows_of(one, {c: {"n_unique": F.col(f"k{i}")} for i, c in enumerate(cols)})
    else:
        out = distinct_counts(df, cols)
    return out.withColumn("single_valued", (F.col("n_unique") <= 1).cast("int"))


def minmax_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum and whether all values are missing, per numeric column."""
    cols = list(cols or numeric_cols(df))
    one = df.agg(
        *[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)],
    )
    return _rows_of(
        one,
        {c: {"min": F.col(f"lo{i}"), "max": F.col(f"hi{i}"), "all_null": F.col(f"lo{i}").isNull().cast("int")} for i, c in enumerate(cols)},
    )


def pivot_percent(df: DataFrame, group: str, row: str, column: str) -> DataFrame:
    """Counts per (group, row) and column value, plus the margin ``All``, as rounded percentages of the group."""
    cells = df.groupBy(group, row, F.col(column).cast("string").alias("column")).agg(F.count(F.lit(1)).alias("n"))
    margin = cells.groupBy(group, row).agg(F.sum("n").alias("n")).select(group, row, F.lit("All").alias("column"), "n")
    both = cells.unionByName(margin)
    totals = both.groupBy(group, "column").agg(F.sum("n").alias("total"))
    return lookup_join(both, totals, [group, "column"]).select(
        group, row, "column", "n", F.round(F.col("n") * 100 / F.col("total"), 2).alias("percent")
    )


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Counts of value pairs, one column per value of ``b``."""
    pivot = df.groupBy(a).pivot(b, list(values)) if values else df.groupBy(a).pivot(b)
    return pivot.agg(F.count(F.lit(1))).na.fill(0)


def group_share(df: DataFrame, group: str, column: str) -> DataFrame:
    """Rows per (group, value) and their share within the group."""
    counts = df.groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(group).agg(F.sum("n").alias("__total"))
    return lookup_join(counts, totals, [group]).select(group, column, "n", (F.col("n") / F.col("__total")).alias("share"))


def corr_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson", key: str | None = None, sample: float | None = None):
    """Correlation of column pairs in long form, upper triangle (``a`` before ``b`` in the column order)."""
    cols = list(cols)
    if sample is not None:
        if key is None:
            raise ValueError("a sample needs the row key")
        from .columns import hash_sample

        df = hash_sample(df, key, sample)
    sums = _shared_rank_sums(df, cols) if method == "spearman" else _pairwise_sums(df, cols)
    return _correlations(sums, cols)


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


def _shared_rank_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sums of products of ranks for every pair, where a value is ranked among the rows that have both columns.

    That rank depends on the other column only by which rows miss it, so columns that miss the same rows share it. All columns
    are ranked in one range partition over (column, value), with one running count per such pattern; each value then
    takes its ranks back, and the sums are gathered row by row. NaN counts as missing."""
    p = len(cols)
    names = [f"c{i}" for i in range(p)]
    wide = materialise(df.select(F.monotonically_increasing_id().alias("rid"), *[_number(c).alias(a) for c, a in zip(cols, names)]))
    missing = [F.sum(F.when(F.col(a).isNull(), F.xxhash64("rid").cast("decimal(20,0)"))).alias(a) for a in names]
    found = wide.agg(*missing).first()
    kinds = {x: k for k, x in enumerate(dict.fromkeys(found))}
    kind = np.array([kinds[x] for x in found])
    m = len(kinds)
    first = [int(np.flatnonzero(kind == k)[0]) for k in range(m)]
    has = F.array(*[F.col(names[i]).isNotNull().cast("int") for i in first]).alias("has")
    long = wide.select("rid", has, F.posexplode(F.array(*names)).alias("i", "value")).filter("value IS NOT NULL")
    seen = [F.sum(F.col("has")[k]).alias(f"n{k}") for k in range(m)]
    counts = materialise(long.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"), *seen))
    run = running_sums(counts, ["value"], [f"n{k}" for k in range(m)], ["i"])
    # ranks as shares of their total, about 0: the correlation is the same, and sums of squares stay small
    share = lambda k: F.coalesce(F.try_divide(F.col(f"cum_n{k}") - (F.col(f"n{k}") - 1) / 2, F.col(f"tot_n{k}")) - 0.5, F.lit(0.0))
    table = run.select("i", "value", F.array(*[share(k) for k in range(m)]).alias("ranks"))
    ranked = lookup_join(long.select("rid", "i", "value"), table, ["i", "value"], "inner", ["rid"], counts.select("i", "value", "n"))
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"

    most = HELD_RANKS

    def gather(batches):
        import pyarrow as pa

        total = np.zeros((4, p, p))
        groups = [np.flatnonzero(kind == k) for k in range(m)]

        def add(rid, i, ranks):
            row = np.cumsum(np.r_[0, rid[1:] != rid[:-1]])
            x, there = np.zeros((row[-1] + 1, p, m)), np.zeros((row[-1] + 1, p))
            x[row, i], there[row, i] = ranks, 1.0
            for a, ga in enumerate(groups):
                for b, gb in enumerate(groups):
                    mine, other = x[:, ga, b], x[:, gb, a]
                    at = np.ix_(ga, gb)
                    total[0][at] += there[:, ga].T @ there[:, gb]
                    total[1][at] += mine.T @ there[:, gb]
                    total[2][at] += (mine * mine).T @ there[:, gb]
                    total[3][at] += mine.T @ other

        waiting, held = [], 0
        for batch in batches:
            waiting.append([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy().reshape(-1, m)])
            held += batch.num_rows
            if held * m < most:
                continue
            now = [np.concatenate(x) for x in zip(*waiting)]
            whole = int(np.searchsorted(now[0], now[0][-1]))  # the last row may go on
            if whole:
                add(*[x[:whole] for x in now])
            waiting, held = [[x[whole:] for x in now]], held - whole
        if held:
            add(*[np.concatenate(x) for x in zip(*waiting)])
        i, j = np.triu_indices(p, 1)
        n, s, q, t = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("i4")), pa.array(j.astype("i4")), *[pa.array(v) for v in (n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], t[i, j])]],
            ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    dealt = ranked.select("rid", "i", "ranks").repartition("rid").sortWithinPartitions("rid")
    return dealt.mapInArrow(gather, schema)


def _pairwise_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sums of products of every pair over the rows where both are present, in one pass: each task keeps the masked sums of its
    rows. NaN counts as missing."""
    low = df.agg(*[F.min(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([0.0 if m is None else m for m in low])
    names = [f"c{i}" for i in range(len(cols))]
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"

    def run(parts):
        total = np.zeros((4, len(cols), len(cols)))
        for part in parts:
            x = part.to_numpy("f8") - shift
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            seen = there.astype("f8")
            total += np.stack([seen.T @ seen, x.T @ seen, (x * x).T @ seen, x.T @ x])
        n, s, q, p = total
        i, j = np.triu_indices(len(cols), 1)
        yield pd.DataFrame({"i": i.astype("i4"), "j": j.astype("i4"), "n": n[i, j], "sx": s[i, j], "sy": s[j, i], "sxx": q[i, j], "syy": q[j, i], "sxy": p[i, j]})

    rows = df.select(*[F.col(c).cast("double").alias(a) for c, a in zip(cols, names)])
    return rows.mapInPandas(run, schema)


def _correlations(parts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of every pair from the tasks' sums, which meet in one row a pair. Null where fewer than two rows have both or
    one does not vary."""
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])

    def varies(s, q):
        v = F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
        return F.when(v > F.col(q) * 1e-12, v)

    both = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    corr = both / F.sqrt(varies("sx", "sxx") * varies("sy", "syy"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), corr.alias("corr"))


def correlated_pairs(df: DataFrame, cols: Sequence[str], threshold: float, method: str = "pearson") -> DataFrame:
    """Pairs above the threshold in absolute value; the later column of a pair is the one to drop."""
    pairs = corr_matrix(df, cols, method).filter(F.abs("corr") > threshold)
    return pairs.select(F.col("b").alias("drop_feature"), F.col("a").alias("corr_feature"), F.col("corr").alias("corr_value"))


def one_hot_correlated_pairs(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], threshold: float) -> DataFrame:
    """Pairs above the threshold (above 0) among number columns and the 0/1 columns ``<category>_<value>``, the later one to drop:
    numbers first, then categories, their values in the order of their text. The table is never widened: two 0/1 columns
    correlate by the counts of their values and of the pair, a number and a 0/1 column by the value's count and sum.

    Values that never meet correlate at -sqrt(odds * odds), so one of them has odds above the threshold: at most
    (1 + t) / t values of a category have, and only those are paired with all values. Rows without a category count as 0
    everywhere; a number's missing rows are left out of its pairs; columns that do not vary have no pairs."""
    numbers, categories = list(numbers), list(categories)
    rows = materialise(df.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(numbers)], *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categories)]))
    xs, cs = range(len(numbers)), range(len(categories))
    total = rows.count()
    means = rows.agg(F.lit(0), *[F.avg(f"x{i}").alias(f"x{i}") for i in xs]).first()
    centred = {i: F.col(f"x{i}") - F.lit(means[f"x{i}"]) for i in xs}
    here = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"c{i}").alias("v")) for i in cs]) if categories else F.array()
    long = rows.select(F.explode(here).alias("p"), *[f"x{i}" for i in xs]).select("p.c", "p.v", *[f"x{i}" for i in xs]).filter("v IS NOT NULL") if categories else None
    found = None
    add = lambda part: part if found is None else found.unionByName(part)
    name = lambda c, v: F.concat(F.get(F.array(*[F.lit(x) for x in categories]), c), F.lit("_"), v)
    if len(numbers) > 1:
        found = add(corr_matrix(df, numbers).select(F.col("b").alias("drop_feature"), F.col("a").alias("corr_feature"), F.col("corr").alias("corr_value")))
    if categories and numbers:
        spread = rows.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in xs], *[F.sum(centred[i] * centred[i]).alias(f"q{i}") for i in xs]).first()
        sums = long.groupBy("c", "v").agg(*[F.count(f"x{i}").alias(f"n{i}") for i in xs], *[F.sum(centred[i]).alias(f"s{i}") for i in xs])
        for i in xs:
            n, q = spread[f"n{i}"], spread[f"q{i}"]
            if not n or not q:
                continue
            varies = F.col(f"n{i}") - F.col(f"n{i}") * F.col(f"n{i}") / n
            corr = F.when(varies > 0, F.col(f"s{i}") / F.sqrt(varies * q))
            found = add(sums.select(name(F.col("c"), F.col("v")).alias("drop_feature"), F.lit(numbers[i]).alias("corr_feature"), corr.alias("corr_value")))
    if categories:
        counts = materialise(long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < total))
        joint = [F.struct(F.lit(i).alias("c"), F.col(f"c{i}").alias("v"), F.lit(j).alias("d"), F.col(f"c{j}").alias("w")) for i in cs for j in cs if i < j]
        empty = F.array().cast("array<struct<c:int,v:string,d:int,w:string>>")
        met = rows.select(F.explode(F.array(*joint) if joint else empty).alias("p")).select("p.*").na.drop(subset=["v", "w"])
        met = materialise(met.groupBy("c", "v", "d", "w").agg(F.count(F.lit(1)).alias("nn")))
        # at most (1 + t) / t values of each category
        odds = F.col("n") / (total - F.col("n"))
        often = counts.filter(odds > threshold).collect()
        strong = F.array(*[F.struct(F.lit(r["c"]).alias("c"), F.lit(r["v"]).alias("v"), F.lit(r["n"]).alias("m")) for r in often])
        if often:
            other = counts.select("c", "v", "n", F.explode(strong).alias("o")).filter((F.col("c") != F.col("o.c")) | (F.col("v") != F.col("o.v")))
            first = F.least(F.struct("c", "v", "n"), F.struct(F.col("o.c").alias("c"), F.col("o.v").alias("v"), F.col("o.m").alias("n")))
            last = F.greatest(F.struct("c", "v", "n"), F.struct(F.col("o.c").alias("c"), F.col("o.v").alias("v"), F.col("o.m").alias("n")))
            apart = other.select(first.alias("a"), last.alias("b")).distinct()
            apart = apart.select(F.col("a.c").alias("c"), F.col("a.v").alias("v"), F.col("a.n").alias("na"), F.col("b.c").alias("d"), F.col("b.v").alias("w"), F.col("b.n").alias("nb"))
            apart = apart.join(met, ["c", "v", "d", "w"], "left_anti").withColumn("nn", F.lit(0).cast("long"))
        ends = [counts.select("c", "v", F.col("n").alias("na")), counts.select(F.col("c").alias("d"), F.col("v").alias("w"), F.col("n").alias("nb"))]
        pairs = lookup_join(lookup_join(met, ends[0], ["c", "v"], "inner", ["d", "w"]), ends[1], ["d", "w"], "inner", ["c", "v"])
        pairs = pairs.unionByName(apart) if often else pairs
        a, b = F.col("na"), F.col("nb")
        corr = (F.col("nn") - a * b / total) / F.sqrt(a * (1 - a / total) * b * (1 - b / total))
        found = add(pairs.select(name(F.col("d"), F.col("w")).alias("drop_feature"), name(F.col("c"), F.col("v")).alias("corr_feature"), corr.alias("corr_value")))
    if found is None:
        return df.sparkSession.createDataFrame([], "drop_feature string, corr_feature string, corr_value double")
    return found.filter(F.abs("corr_value") > threshold)


def correlated_families(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Number of correlated pairs per name prefix of the column to drop."""
    pairs = correlated_pairs(df, cols, threshold)
    return pairs.groupBy(F.split("drop_feature", "_")[0].alias("family")).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Rows per class and the ratio of the largest class to it."""
    counts = df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", Scalars(counts, top=F.max("n"))["top"] / F.col("n"))


def rate_compare(df: DataFrame, p: str, y: str, cut: float) -> DataFrame:
    """Share of rows predicted above the cut against the actual rate."""
    return df.agg(F.avg((F.col(p) >= cut).cast("double")).alias("predicted_rate"), F.avg(F.col(y).cast("double")).alias("actual_rate"))


def histogram(df: DataFrame, column: str, bins: int | None = None, width: float | None = None) -> DataFrame:
    """Rows per bin of equal width between minimum and maximum (last bin closed), or of a given width from 0."""
    x = F.col(column)
    rows = df.filter(x.isNotNull())
    if width is not None:
        code = F.floor(x / width)
        return rows.groupBy(code.alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumn("low", F.col("bin") * width)
    s = Scalars(df, lo=F.min(x).cast("double"), hi=F.max(x).cast("double"))
    spread = s["hi"] - s["lo"]
    place = F.coalesce(F.floor(F.try_divide((x - s["lo"]) * bins, spread)), F.lit(0))
    counts = rows.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("low", s["lo"] + F.col("bin") * spread / bins)


def _pixel(x: Column, low: Column, high: Column, size: int) -> Column:
    place = F.floor(F.try_divide((x - low) * size, high - low))
    return F.least(F.coalesce(place, F.lit(0)), F.lit(size - 1)).cast("int")


def raster(df: DataFrame, x: Column, y: Column, width: int, height: int) -> DataFrame:
    """Points per pixel of a canvas that spans the data; only the pixels travel."""
    points = df.select(x.cast("double").alias("x"), y.cast("double").alias("y")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    s = Scalars(points, x0=F.min("x"), x1=F.max("x"), y0=F.min("y"), y1=F.max("y"))
    px = _pixel(F.col("x"), s["x0"], s["x1"], width)
    py = _pixel(F.col("y"), s["y0"], s["y1"], height)
    return points.groupBy(px.alias("px"), py.alias("py")).agg(F.count(F.lit(1)).alias("n"))


def line_raster(df: DataFrame, t: Column, value: str, width: int) -> DataFrame:
    """Per pixel column: lowest, highest, first and last value of a series."""
    points = df.select(t.cast("double").alias("t"), F.col(value).alias("v")).filter(F.col("t").isNotNull() & F.col("v").isNotNull())
    s = Scalars(points, t0=F.min("t"), t1=F.max("t"))
    return points.groupBy(_pixel(F.col("t"), s["t0"], s["t1"], width).alias("px")).agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.min_by("v", F.struct("t", "v")).alias("first"),
        F.max_by("v", F.struct("t", "v")).alias("last"),
    )


def decimate(df: DataFrame, key: str, n: int, seed: str = "decimate") -> DataFrame:
    """At most ``n`` rows, those with the lowest key hash."""
    hashed = df.withColumn("__h", key_hash(key, seed))
    return row_numbers(hashed, ["__h", key], name="__row").filter(F.col("__row") <= n).drop("__h", "__row")


def box_stats(df: DataFrame, group: str, column: str) -> DataFrame:
    """Quartiles, whisker ends (most extreme values within 1.5 quartile ranges) and outliers per group."""
    quartiles = materialise(group_quantiles(df, column, QUARTILES, [group]))
    x, spread = F.col(column), (F.col("q75") - F.col("q25")) * 1.5
    inside = (x >= F.col("q25") - spread) & (x <= F.col("q75") + spread)
    joined = lookup_join(df.filter(x.isNotNull() & F.col(group).isNotNull()), quartiles, [group], ready=True)
    return joined.groupBy(group, "q25", "q50", "q75").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def vs_global(df: DataFrame, column: str, statistic: str = "mean", name: str = "above") -> DataFrame:
    """1 where the value is at least the mean or the exact median of the whole column."""
    if statistic == "mean":
        level = Scalars(df, level=F.avg(column))["level"]
    else:
        level = Scalars(materialise(group_quantiles(df, column, {"level": 0.5})), level=F.first("level"))["level"]
    return df.withColumn(name, (F.col(column) >= level).cast("int"))


def group_transform(df: DataFrame, keys: Sequence[str], salt_on=None, **aggs: Column) -> DataFrame:
    """Group values on every row."""
    return attach_groups(df, keys, salt_on=salt_on, **aggs)
