"""Model plans: structure and bounds (values are solver-dependent)."""

from pyspark.sql import functions as F

from tessera.functions import activations as ACT
from tessera.functions import text as TX
from tessera.operators import prep
from tessera.plans import models
from tessera.sources import tables
from tessera.sources.tables import TRAINING_SCHEMA, scratch_path


def _training_table(spark, n=400):
    # six-column table with the fixture's value ranges, labels from a rule
    rows = []
    for i in range(n):
        vx = [-8, -6, -5][i % 3]
        hx = -75 + (i * 37) % 776
        vy = 5
        y = (i * 13) % 401
        accion = 1 if hx < 60 and i % 4 == 0 else 0
        salto = 1 if hx < 120 else 0
        rows.append((vx, hx, vy, y, accion, salto))
    rows.append((-5, 10, 5, 0, -1, 0))  # an action the trainer must drop
    return spark.createDataFrame(rows, TRAINING_SCHEMA).withColumn("row_id", F.monotonically_increasing_id())


def test_train_all_tree_and_mlp(spark):
    df = _training_table(spark)
    feats = ["velocidad_balax", "bala_h_x", "velocidad_balay", "bala_v_y"]
    res = models.train_all(df, [
        {"name": "jump_tree", "kind": "tree", "features": feats, "label": "salto"},
        {"name": "jump_mlp", "kind": "mlp", "features": feats, "label": "salto", "hidden": (8, 4), "max_iter": 200},
    ], id_col="row_id")
    for name in ("jump_tree", "jump_mlp"):
        model, report = res[name]
        rows = {r["class"]: r for r in report.collect()}
        assert rows["accuracy"].f1 >= 0.7  # well above chance on a separable rule
        assert {"macro avg", "weighted avg"} <= set(rows)


def test_tree_table_and_dot(spark):
    df = _training_table(spark)
    feats = ["bala_h_x", "bala_v_y"]
    m = models.fit_tree(df.where("salto in (0,1)"), feats, "salto", max_depth=3)
    nodes = models.tree_table(m, feats, [0, 1], scratch_path(spark, "tree"))
    rows = nodes.collect()
    assert rows and all(r.samples > 0 for r in rows)
    # a parent's counts are the sum of its children's
    by_id = {r.id: r for r in rows}
    for r in rows:
        if r.left >= 0:
            assert [a + b for a, b in zip(by_id[r.left].value, by_id[r.right].value)] == list(r.value)
    assert models.edges_to_dot(nodes).first().dot.startswith("digraph Tree {")


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    st = models.scaler_stage(df, ["x"])
    z = [r.z_x for r in st.transform(df).collect()]
    assert abs(sum(z)) < 1e-12 and abs(sum(v * v for v in z) / 4 - 1.0) < 1e-12


def test_save_load_csv_and_reset(spark):
    df = _training_table(spark, 20).drop("row_id")
    path = scratch_path(spark, "train_csv")
    tables.write_table_csv(df, path)
    back = tables.read_table_csv(spark, path)  # types inferred
    assert back.count() == df.count() and dict(back.dtypes)["salto"] == "int"
    tables.reset_table(spark, TRAINING_SCHEMA, path)
    empty = tables.read_table_csv(spark, path, TRAINING_SCHEMA)
    assert empty.count() == 0 and empty.columns == TRAINING_SCHEMA.fieldNames()


def test_small_functions(spark):
    df = spark.createDataFrame([("a/b/eutanasia_dividido.txt", "3-4", 1, 0, 4, 5)],
                               "p string, lab string, r1 int, c1 int, r2 int, c2 int")
    r = df.select(TX.replace_suffix("p", ".txt", ".npy").alias("n"), TX.split_label("lab").alias("s"),
                  ACT.manhattan10("r1", "c1", "r2", "c2").alias("m"),
                  ACT.round_js(F.lit(-2.5)).alias("rj"), ACT.clamp(F.lit(900), 0, 800).alias("cl")).first()
    assert r.n.endswith("eutanasia_dividido.npy") and list(r.s) == ["3", "4"]
    assert r.m == 80 and r.rj == -2 and r.cl == 800
    assert prep.select_pos(df, 0, 2).columns == ["p", "lab"]


def test_score_routed_unknown_is_zero(spark):
    df = spark.createDataFrame([(1, "tree"), (2, "knn"), (3, "other")], "id int, model string")
    models_ = {"tree": lambda d: d.withColumn("pred", F.lit(1)),
               "knn": lambda d: d.withColumn("pred", F.lit(None))}
    out = {r.id: r.pred for r in prep.score_routed(df, "model", models_).collect()}
    assert out == {1: 1, 2: 0, 3: 0}


def test_mlp_training_rows_are_dealt_to_tasks(spark):
    # narrow rows lie in one part, as Spark leaves them after a join; a pass needs the cores
    rows = spark.range(0, 3 * models.LEAST_ROWS, 1, 1).selectExpr("double(id) AS x", "double(id % 7) AS z", "int(id % 2) AS y", "'-' AS other")
    dealt = models.training_rows(rows, ["x", "z", "y"])
    assert dealt.columns == ["x", "z", "y"]
    assert dealt.rdd.getNumPartitions() == min(3, max(1, spark.sparkContext.defaultParallelism))
    assert dealt.agg(F.count("x"), F.sum("x"), F.sum("y")).first() == rows.agg(F.count("x"), F.sum("x"), F.sum("y")).first()
    assert models.training_rows(rows.limit(100), ["x", "y"]).rdd.getNumPartitions() == 1


def test_mlp_of_many_rows_learns(spark):
    # the pipeline scales new rows itself
    rows = spark.range(0, 2 * models.LEAST_ROWS, 1, 1).selectExpr("double(id % 100) AS x", "double(id % 7) AS z", "int(id % 100 >= 50) AS y")
    model = models.fit_mlp(rows, ["x", "z"], "y", hidden=(4,), max_iter=60)
    scored = model.transform(spark.createDataFrame([(10.0, 1.0), (90.0, 1.0)], "x double, z double"))
    assert [r.pred_y for r in scored.orderBy("x").collect()] == [0.0, 1.0]


def test_split_reads_kept_features(spark, monkeypatch):
    from paths import SF_SMALL

    from tessera.plans import catalog

    seen = []
    monkeypatch.setattr(catalog.prep, "stratified_split", lambda df, *_: seen.append(df) or df.withColumn("split", F.lit("train")))
    catalog._split_docs(spark, SF_SMALL)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "Join" not in plan
