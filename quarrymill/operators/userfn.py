"""User functions: on cells, on rows, as pipeline steps that are saved with the pipeline, and as scores with a direction."""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T


def map_cells(df: DataFrame, column: str, fn: Callable, kind: str | T.DataType, name: str | None = None) -> DataFrame:
    """``fn`` of every value of a column, null for null, in Arrow batches."""

    @F.pandas_udf(kind)
    def each(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else fn(v) for v in values.astype(object).where(values.notna(), None)], dtype=object)

    return df.withColumn(name or column, each(F.col(column)))


def apply_rows(df: DataFrame, cols: Sequence[str], fn: Callable, kind: str | T.DataType, name: str) -> DataFrame:
    """``fn(row)`` of every row, ``row`` being a dictionary of ``cols`` with None for null, in Arrow batches."""
    cols = list(cols)

    @F.pandas_udf(kind)
    def each(rows: pd.DataFrame) -> pd.Series:
        values = [rows[c].astype(object).where(rows[c].notna(), None) for c in cols]
        return pd.Series([fn(dict(zip(cols, row))) for row in zip(*values)], dtype=object)

    return df.withColumn(name, each(F.struct(*cols)))


class FunctionStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Any function from frame to frame as a pipeline step. The function is saved with the pipeline, pickled by value, and comes back
    in a session that has never seen it; load pipelines from trusted places only, since loading one loads code."""

    def __init__(self, fn: Callable[[DataFrame], DataFrame] | None = None):
        super().__init__()
        self.code = Param(self, "code", "pickled function")
        if fn is not None:
            self._set(code=base64.b64encode(cloudpickle.dumps(fn)).decode())

    def _transform(self, df: DataFrame) -> DataFrame:
        return cloudpickle.loads(base64.b64decode(self.getOrDefault(self.code)))(df)


class FunctionEvaluator(Evaluator):
    """A score of a scored frame with its own direction: larger is better only if ``maximize``. Grid and random search follow it."""

    def __init__(self, score: Callable[[DataFrame], float], maximize: bool = True):
        super().__init__()
        self.score, self.maximize = score, maximize

    def _evaluate(self, df: DataFrame) -> float:
        return float(self.score(df))

    def isLargerBetter(self) -> bool:
        return self.maximize
