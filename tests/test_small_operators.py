"""Small sources and functions that other tests don't reach."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays, text
from tessera.operators import prep
from tessera.plans import models
from tessera.sources import tables


def test_rows_are_appended_and_read_back(spark):
    df = tables.from_rows(spark, [(1, "a,b"), (2, None)], "id int, note string")
    path = tables.scratch_path(spark, "rows")
    tables.write_table_csv(df, path)
    tables.append_rows(tables.from_rows(spark, [(3, 'say "x"')], "id int, note string"), path)
    back = tables.read_table_csv(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a,b"), (2, None), (3, 'say "x"')]


def test_labelled_matrix(spark):
    df = tables.from_rows(spark, [(1.0, 2.0, 0), (3.0, 4.0, 1)], "a double, b double, y int")
    rows = tables.load_labelled(df, ["a", "b"], "y").orderBy("y").collect()
    assert [(r.features.toArray().tolist(), r.y) for r in rows] == [([1.0, 2.0], 0), ([3.0, 4.0], 1)]


def test_callers_embedding(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "")], "id int, t string")
    out = models.embed_with(df, "t", lambda s: pd.Series([[float(len(x)), 1.0] for x in s]))
    assert {r.id: list(r.vec) for r in out.collect()} == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_arrays(spark):
    r = spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>").select(
        arrays.slice_from("a", 2, 2).alias("s"), arrays.reversed_array("a").alias("r"), arrays.push("a", 5).alias("p"),
        arrays.check_size("a", 4).alias("c")).first()
    assert (list(r.s), list(r.r), list(r.p), list(r.c)) == ([2, 3], [4, 3, 2, 1], [1, 2, 3, 4, 5], [1, 2, 3, 4])
    with pytest.raises(Exception, match="array size differs"):
        spark.createDataFrame([([1],)], "a array<int>").select(arrays.check_size("a", 4)).collect()


def test_prompt_texts(spark):
    df = spark.createDataFrame([(2, "second"), (1, "first")], "r int, t string")
    context = df.agg(text.join_ranked("r", "t").alias("c"))
    r = context.select("c", text.guard_short("c", F.lit("answer"), 5).alias("long"), text.guard_short("c", F.lit("answer"), 50).alias("short"),
                       text.render_prompt("c", F.lit("why?")).alias("p"), text.messages("sys", F.lit("u")).alias("m")).first()
    assert r.c == "first\nsecond" and r.long == "answer" and r.short == text.NOT_ENOUGH_CONTEXT
    assert "first\nsecond" in r.p and "why?" in r.p
    assert [(m.role, m.content) for m in r.m] == [("system", "sys"), ("user", "u")]


def test_approximate_classes_and_routed_scores(spark):
    df = spark.createDataFrame([(i, "ab?"[i % 3], float(i)) for i in range(30)], "id int, m string, x double")
    assert prep.approx_classes(df, "m").first().n_classes == 3
    out = prep.score_routed(df, "m", {"a": F.when(F.col("x") > 6, F.lit(1)), "b": F.sqrt(F.col("x") - 10)})
    want = {i: (int(i > 6) if i % 3 == 0 else int((i - 10) ** 0.5) if i % 3 == 1 and i >= 10 else 0) for i in range(30)}
    assert {r.id: r.pred for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan  # one projection
