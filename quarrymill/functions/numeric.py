"""Row-wise numeric features as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_sum(cols: Sequence) -> Column:
    """Sum over a column family, nulls counted as 0."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(as_col(c).cast("double"), F.lit(0.0))
    return total


def row_count(cols: Sequence) -> Column:
    return sum((F.when(as_col(c).isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))


def row_mean(cols: Sequence) -> Column:
    """Mean of the non-null values, null when all are null."""
    return F.try_divide(row_sum(cols), row_count(cols))


def row_var(cols: Sequence) -> Column:
    """Population variance of the non-null values."""
    mean = row_mean(cols)
    squares = F.lit(0.0)
    for c in cols:
        d = as_col(c).cast("double") - mean
        squares = squares + F.coalesce(d * d, F.lit(0.0))
    return F.try_divide(squares, row_count(cols))


def row_min(cols: Sequence) -> Column:
    return F.least(*[as_col(c) for c in cols]) if len(cols) > 1 else as_col(cols[0])


def row_max(cols: Sequence) -> Column:
    return F.greatest(*[as_col(c) for c in cols]) if len(cols) > 1 else as_col(cols[0])


ROW_FUNCTIONS = {"sum": row_sum, "mean": row_mean, "var": row_var, "min": row_min, "max": row_max}


def row_stats(df: DataFrame, cols: Sequence[str], prefix: str, fns: Sequence[str] = ("sum", "mean", "var", "min", "max")):
    """Add ``<prefix>_<fn>`` for a column family in one projection."""
    return df.select("*", *[ROW_FUNCTIONS[fn](cols).alias(f"{prefix}_{fn}") for fn in fns])


def ratio_plus1(a, b) -> Column:
    return F.try_divide(as_col(a).cast("double"), as_col(b) + 1)


def safe_ratio(a, b, default: float = 0.0) -> Column:
    """a / b, and ``default`` where b is 0 or a part is missing."""
    return F.coalesce(F.try_divide(as_col(a).cast("double"), as_col(b)), F.lit(default))


def per_hour(amount, minutes, divisor: float = 60.0) -> Column:
    """Amount per minutes, scaled by ``divisor``, 0 where no minutes were spent."""
    return safe_ratio(amount, as_col(minutes)) / F.lit(divisor)


def interactions(pairs: Sequence[tuple[str, str]]) -> list[Column]:
    """Product, shifted ratio and square root of the product for each pair of columns."""
    out = []
    for a, b in pairs:
        product = F.col(a) * F.col(b)
        out.append(product.alias(f"{a}_x_{b}"))
        out.append(ratio_plus1(a, b).alias(f"{a}_per_{b}"))
        out.append(F.when(product >= 0, F.sqrt(product)).alias(f"sqrt_{a}_x_{b}"))
    return out


def log_features(cols: Sequence[str]) -> list[Column]:
    """ln and log10 (null for values not above 0), log1p, and its inverse expm1 of log1p."""
    out = []
    for c in cols:
        out += [
            F.when(F.col(c) > 0, F.ln(c)).alias(f"{c}_ln"),
            F.when(F.col(c) > 0, F.log10(c)).alias(f"{c}_log10"),
            F.when(F.col(c) > -1, F.log1p(c)).alias(f"{c}_log1p"),
            F.when(F.col(c) > -1, F.expm1(F.log1p(c))).alias(f"{c}_back"),
        ]
    return out


def net_features(columns: Sequence[str], add: str = "_add_", reduce: str = "_reduce_") -> list[Column]:
    """Net, gain and loss columns for every ``<item>_add_<x>`` / ``<item>_reduce_<x>`` pair; a missing partner skips."""
    out = []
    for gain in columns:
        if add not in gain:
            continue
        loss = gain.replace(add, reduce)
        if loss in columns:
            item = gain.split(add)[0]
            out.append((F.col(gain) - F.col(loss)).alias(f"{item}_net"))
            out.append(ratio_plus1(loss, gain).alias(f"{item}_use_rate"))
    gains = [c for c in columns if add in c]
    losses = [c for c in columns if reduce in c]
    if gains and losses:
        out.append(row_sum(gains).alias("total_gain"))
        out.append(row_sum(losses).alias("total_loss"))
        out.append((row_sum(gains) - row_sum(losses)).alias("total_net"))
    return out


def recode(c, mapping: Mapping, default=None) -> Column:
    """Piecewise value replacement; values without an entry keep themselves or take ``default``."""
    expr = None
    for key, value in mapping.items():
        expr = F.when(as_col(c) == key, F.lit(value)) if expr is None else expr.when(as_col(c) == key, F.lit(value))
    return expr.otherwise(as_col(c) if default is None else F.lit(default))


def finalize_prediction(p, base) -> Column:
    """Negative predictions become 0, then the base amount is added."""
    return F.greatest(as_col(p), F.lit(0.0)) + as_col(base)


def future_target(later, early) -> Column:
    return as_col(later) - as_col(early)


def adjusted_skew(c) -> Column:
    """Sample skewness with the bias correction, as an aggregate; null below 3 values or at zero spread."""
    n = F.count(c).cast("double")
    return F.when((n >= 3) & (F.var_pop(c) > 0), F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
