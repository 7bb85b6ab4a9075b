"""User functions, evaluators with a direction, sparse one-hot."""

import subprocess
import sys

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F
import pytest

from quarrymill.operators import encoding, models, select, userfn


def test_function_steps_load_in_a_new_session(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, s string")
    shift = 10
    steps = [userfn.FunctionStep(lambda d: d.filter("s IS NOT NULL")), userfn.FunctionStep(lambda d: d.withColumn("id", F.col("id") + shift))]
    want = [tuple(r) for r in Pipeline(stages=steps).fit(df).transform(df).orderBy("id").collect()]
    assert want == [(11, "a"), (13, "c")]
    Pipeline(stages=steps).fit(df).write().overwrite().save(str(tmp_path / "steps"))
    again = PipelineModel.load(str(tmp_path / "steps")).transform(df)
    assert [tuple(r) for r in again.orderBy("id").collect()] == want
    code = f"""
from quarrymill.plans.session import build_session
from pyspark.ml import PipelineModel
spark = build_session("other", 2, 2)
df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, s string")
print([tuple(r) for r in PipelineModel.load({str(tmp_path / "steps")!r}).transform(df).orderBy("id").collect()])
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.strip() == str(want)


def test_cells_and_rows(spark):
    df = spark.createDataFrame([(1, "ab", 2.0), (2, None, None)], "id long, s string, x double")
    out = userfn.map_cells(df, "s", len, "long", "n")
    out = userfn.apply_rows(out, ["s", "x"], lambda r: None if r["x"] is None else r["s"] * int(r["x"]), "string", "t")
    assert [tuple(r) for r in out.select("id", "n", "t").orderBy("id").collect()] == [(1, 2, "abab"), (2, None, None)]


def test_grid_search_follows_the_direction(spark):
    rows = [(i, float(i % 7), float(i % 7 > 3)) for i in range(140)]
    df = select.assemble(spark.createDataFrame(rows, "id long, x double, y double"), ["x"])
    est = models.make_classifier("decision_tree", "y", {})
    grid = ParamGridBuilder().addGrid(est.maxDepth, [0, 2]).build()
    hits = lambda d: d.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    for maximize, depth in ((True, 2), (False, 0)):
        found = models.grid_search(est, grid, df, userfn.FunctionEvaluator(hits, maximize), "id", "y", 2)
        assert found.bestModel.getOrDefault("maxDepth") == depth


def test_one_hot_of_a_hundred_thousand_values(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("v"), "id").alias("a"), (F.col("id") % 2).alias("b"))
    rows, names = encoding.one_hot_sparse(df, "id", ["a", "b"])
    assert names.count() == names.select("index").distinct().count() == 100_002
    wide = rows.select("id", F.explode("indices").alias("index")).join(names, "index")
    want = F.col("name").isin("b_0", "b_1") | (F.col("name") == F.concat(F.lit("a_v"), "id"))
    assert wide.filter(want).count() == 200_000 == wide.count()


def test_sparse_one_hot_odd_values(spark, big):
    df = spark.createDataFrame([(1, "x", 1), (2, None, None), (3, "", 2), (4, "x", 2)], "id long, a string, b int")
    rows, names = encoding.one_hot_sparse(df, "id", ["a", "b"])
    assert {r["index"]: r["name"] for r in names.collect()} == {0: "a_", 1: "a_x", 2: "b_1", 3: "b_2"}
    assert {r["id"]: r["indices"] for r in rows.collect()} == {1: [1, 2], 2: [], 3: [0, 3], 4: [1, 3]}
    rows, names = encoding.factorize_sparse(df, "id", ["b", "id"])
    assert {r["index"]: r["name"] for r in names.collect()} == {0: "b", 1: "id_1", 2: "id_2", 3: "id_3", 4: "id_4"}
    assert {r["id"]: r["indices"] for r in rows.collect()} == {1: [1], 2: [2], 3: [0, 3], 4: [0, 4]}


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        models.sample_params({"a": [1, 2, "sometimes"]}, 1)
