"""Interval bins with pandas-style labels and an integer ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .numeric import as_col


def _text(edge: float) -> str:
    return str(int(edge)) if float(edge).is_integer() else str(edge)


def interval_labels(edges: Sequence[float], right: bool = True) -> list[str]:
    opening, closing = ("(", "]") if right else ("[", ")")
    return [f"{opening}{_text(a)}, {_text(b)}{closing}" for a, b in zip(edges, edges[1:])]


def cut_code(c, edges: Sequence, right: bool = True, include_lowest: bool = False) -> Column:
    """Ordinal of the interval that holds the value, null outside. Edges may be numbers or columns."""
    x = as_col(c)
    edges = [e if isinstance(e, Column) else F.lit(e) for e in edges]
    expr = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        if right:
            above = x >= low if include_lowest and i == 0 else x > low
            inside = above & (x <= high)
        else:
            inside = (x >= low) & (x < high)
        expr = F.when(inside, i) if expr is None else expr.when(inside, i)
    return expr


def cut(c, edges: Sequence[float], right: bool = True, include_lowest: bool = False, labels: Sequence[str] | None = None):
    """Interval label of the value, null outside the edges; intervals are right-closed unless ``right`` is False."""
    names = list(labels) if labels else interval_labels(edges, right)
    if len(names) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    code = cut_code(c, edges, right, include_lowest)
    return F.get(F.array(*[F.lit(n) for n in names]), code)


def cut_step(c, step: float, n: int, start: float = 0.0) -> Column:
    """Ordinal of right-closed intervals of equal width, null outside ``n`` intervals."""
    code = (F.ceil((as_col(c) - start) / F.lit(step)) - 1).cast("int")
    return F.when((code >= 0) & (code < n), code)
