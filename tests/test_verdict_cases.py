"""Cases that earlier versions got wrong."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrymill.functions.text import strip, tokens
from quarrymill.operators import columns, models, profile, stats
from quarrymill.operators.metrics import gini_norm
from quarrymill.sources.pages import extract_links


def test_wide_correlation_with_missing_values(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 200)) @ np.diag(rng.uniform(0.1, 1000, 200)) + 50
    x[:, 7] = x[:, 3] * 2 + 1
    x[:, 9] = 4.25  # constant
    x[rng.random(x.shape) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(200)])
    df = spark.createDataFrame(frame).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in frame.columns])
    got = {(r.a, r.b): r.corr for r in profile.corr_matrix(df, frame.columns).collect()}
    expected = frame.corr()
    assert len(got) == 200 * 199 // 2
    for (a, b), value in got.items():
        if "c9" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(expected.loc[a, b], abs=1e-9)
    pairs = profile.correlated_pairs(df, frame.columns, 0.95).collect()
    assert [(r.corr_feature, r.drop_feature) for r in pairs] == [("c3", "c7")]


def test_shrink_looks_at_both_ends(spark):
    df = spark.createDataFrame([(-40_000, -1e300, -5), (5, 1.0, 3)], "a long, b double, c long")
    assert columns.shrink_by_max(df) == {"a": "int", "b": "double", "c": "smallint"}


@pytest.mark.parametrize("power", [0.2, 0.5, -0.25])
def test_boxcox_bracket_moves(spark, power):
    u = np.arange(1, 2000) / 2000
    df = spark.createDataFrame([(float(v),) for v in u**power], "x double")
    x = u**power / np.exp(np.mean(np.log(u**power)))

    def likelihood(lam):
        return -np.log(np.var((x**lam - 1) / lam))

    best = stats.boxcox_lambda(df, "x")
    assert all(likelihood(best) >= likelihood(best + d) - 1e-12 for d in (-0.01, 0.01, -1e-4, 1e-4))
    assert abs(best) > 1


def test_rows_without_a_model_stay(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), (None, 1.0, 1.0), ("z", 1.0, 1.0)], "k string, x double, y double")
    fitted = models.fit_by_category("linear", df.filter("k = 'a'"), "k", "y", ["x"])
    assert models.predict_by_category(fitted, df, "k").filter("prediction IS NULL").count() == 2
    table = models.linear_by_category(df.filter("k = 'a'"), "k", "y", ["x"])
    out = models.predict_linear_by_category(table, df, "k", ["x"])
    assert sorted((str(r.k), r.prediction if r.prediction is None else round(r.prediction, 6)) for r in out.collect()) == [
        ("None", None), ("a", 2.0), ("a", 4.0), ("a", 6.0), ("z", None)]


def test_linear_by_many_categories(spark):
    df = spark.range(3000).select((F.col("id") % 600).alias("k"), F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + F.col("id") % 600).alias("y"))
    table = models.linear_by_category(df, "k", "y", ["x"]).collect()
    assert len(table) == 600 and all(abs(r.weights[0] - 3) < 1e-6 and abs(r.intercept - r.category) < 1e-4 for r in table)


def test_white_space_of_any_script(spark):
    df = spark.createDataFrame([("\u3000a\u3000b\xa0c\u2028d \u0085",)], "t string")
    assert df.select(tokens("t")).first()[0] == ["a", "b", "c", "d"]
    assert df.select(strip("t")).first()[0] == "a\u3000b\xa0c\u2028d"


def test_links_of_any_spelling(spark):
    page = "<A HREF='/one'>x</A><a class=k href = \"/two\">y</a><a data-href=no href=/three>z</a><a name=q>w</a><abbr href=no>"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    assert [r.href for r in extract_links(df, "id", "html").orderBy("pos").collect()] == ["/one", "/two", "/three"]


@pytest.mark.parametrize("parts", [1, 7])
def test_gini_with_equal_keys(spark, parts):
    rows = [(i % 5, float(i % 3), (i % 4) / 4) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, y double, p double").repartition(parts)
    by_p = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    by_y = sorted((r[1] for r in rows), reverse=True)
    part = lambda ys: (len(ys) + 1) / 2 - sum(y * (i + 1) for i, y in enumerate(ys)) / sum(ys)
    assert gini_norm(df, "y", "p", "k").first()[0] == pytest.approx(part([r[1] for r in by_p]) / part(by_y))
