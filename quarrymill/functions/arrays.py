"""Vector functions over array columns, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .numeric import as_col


def doubles(c) -> Column:
    return as_col(c).cast("array<double>")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that an array of one entry holds, so that it is worked out once and not for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot(a, b) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(doubles(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a) -> Column:
    """Vector divided by its length; a zero vector stays as it is."""
    return _once(norm(a), lambda size: F.transform(doubles(a), lambda x: F.coalesce(F.try_divide(x, size), x)))


def argmax(a) -> Column:
    """0-based place of the largest entry, the first one on ties."""
    return (F.array_position(as_col(a), F.array_max(as_col(a))) - 1).cast("int")


def softmax(a) -> Column:
    """Shifted by the largest entry before the exponential."""
    raised = lambda v: _once(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    shares = lambda e: _once(total(e), lambda t: F.transform(e, lambda x: x / t))
    return _once(doubles(a), lambda v: _once(raised(v), shares))


def one_hot_vector(y, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == as_col(y)).cast("int"))


def array_mean(a) -> Column:
    return F.try_divide(F.aggregate(doubles(a), F.lit(0.0), lambda s, x: s + x), F.size(as_col(a)))


def pad_right(ids: Column, length: int, pad: int) -> Column:
    """Cut an id array at ``length`` and fill it up with ``pad``."""
    head = F.slice(ids, 1, length)
    return F.concat(head, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(head), F.lit(0))))


def keep_tail(ids: Column, length: int) -> Column:
    """The last ``length`` entries."""
    return F.slice(ids, F.greatest(F.size(ids) - length + 1, F.lit(1)), F.lit(length))
