"""Known answers from FIXTURES.md (values copied as test data)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import graph, network, prep, sequences, spatial, text, trees
from tessera.operators.prep import MissingColumns


def test_block_split_example(spark):
    s = "=== TEXTO 1 ===\nuno\n\n=== TEXTO NUEVO ===\ndos\n  === TEXTO 3 === x\n=== TEXTO 12 ===\n\n"
    df = spark.createDataFrame([("t", s)], "topic string, body string")
    rows = text.text_blocks(df, "topic", "body").orderBy("block_id").collect()
    assert [(r.block_id, r.text) for r in rows] == [(1, "uno"), (2, "dos\n  === TEXTO 3 === x")]


def test_question_key_example(spark):
    df = spark.createDataFrame([(" ¿Qué es la AUTONOMÍA? ",)], "text string")
    assert text.question_keys(df).first().key == " qué es la autonomía "


def test_guard_and_prompt(spark):
    df = spark.createDataFrame([("corto", "p"), ("x" * 30, "q")], "ctx string, q string")
    out = df.select(TX.guard_short("ctx", TX.render_prompt("ctx", "q")).alias("a")).collect()
    assert out[0].a == TX.NOT_ENOUGH_CONTEXT
    assert out[1].a.startswith("Contexto relevante") and "Pregunta:\nq" in out[1].a


def test_gini_of_tree_nodes(spark):
    # node 0: [50,50,50] gini .667; node 2: [0,50,50] .5; node 3: [0,49,5] .168
    rows = []
    for node, counts in [(0, [50, 50, 50]), (2, [0, 50, 50]), (3, [0, 49, 5])]:
        for cls, n in zip(["setosa", "versicolor", "virginica"], counts):
            rows += [(node, cls)] * n
    df = spark.createDataFrame(rows, "node int, label string")
    got = {r.node: r for r in trees.node_stats(df, "node", "label").collect()}
    assert round(got[0].gini, 3) == 0.667 and got[0].samples == 150
    assert round(got[2].gini, 3) == 0.5 and list(got[2].value) == [0, 50, 50]
    assert round(got[3].gini, 3) == 0.168 and got[3]["class"] == "versicolor"


def test_best_split_separates_classes(spark):
    df = spark.createDataFrame([(float(x), 1 if x > 2.45 else 0) for x in [1.0, 1.4, 1.5, 3.5, 4.0, 5.1]],
                               "petal double, y int")
    r = trees.best_split(df, "petal", "y").first()
    assert r.threshold == pytest.approx((1.5 + 3.5) / 2) and r.impurity == 0.0


def _reber_inner():
    return {("i", "B"): "6", ("6", "T"): "4", ("6", "P"): "5", ("4", "X"): "2", ("4", "S"): "4",
            ("3", "V"): "1", ("3", "P"): "2", ("5", "V"): "3", ("5", "T"): "5", ("2", "S"): "1",
            ("2", "X"): "5", ("1", "E"): "end"}


def _words_df(spark, words):
    rows = [(w, i, c) for w in words for i, c in enumerate(w)]
    return spark.createDataFrame(rows, "word string, pos int, sym string")


def test_inner_grammar_words(spark):
    words = ["BTXSE", "BPVVE", "BTSSXXTVVE", "BTV", "BTXSEE", "BTX"]
    out = {r.word: r for r in sequences.conforms(
        _words_df(spark, words), ["word"], ["pos"], "sym", _reber_inner(), "i", accept=["end"]).collect()}
    for w in ["BTXSE", "BPVVE", "BTSSXXTVVE"]:
        assert out[w].prefix_ok and out[w].complete_ok
    for w in ["BTV", "BTXSEE"]:
        assert not out[w].prefix_ok
    assert out["BTX"].prefix_ok and not out["BTX"].complete_ok


def test_embedded_grammar_words(spark):
    tr = {}
    for tag, (first, last) in {"a": ("P", "T"), "b": ("T", "P")}.items():
        for (s, c), t in _reber_inner().items():
            tr[(f"{tag}{s}", c)] = f"{tag}{t}"
        tr[("n2", first)] = f"{tag}i"
        tr[(f"{tag}end", last)] = "n1"
    tr[("start", "B")] = "n2"
    tr[("n1", "E")] = "end"
    words = ["BPBTXSETE", "BTBPVVEPE", "BTBTXSETE"]
    out = {r.word: r for r in sequences.conforms(
        _words_df(spark, words), ["word"], ["pos"], "sym", tr, "start", accept=["end"], fan_in=2).collect()}
    assert out["BPBTXSETE"].complete_ok and out["BTBPVVEPE"].complete_ok
    assert not out["BTBTXSETE"].prefix_ok


def test_grid_edges_11x11(spark):
    cells = spark.createDataFrame([(r, c) for r in range(11) for c in range(11)], "r int, c int")
    assert graph.grid_edges(cells).count() == 840


def test_shortest_paths_open_grid(spark):
    cells = spark.createDataFrame([(r, c) for r in range(6) for c in range(6)], "r int, c int")
    e = graph.grid_edges(cells).select((F.col("src_r") * 100 + F.col("src_c")).alias("src"),
                                       (F.col("dst_r") * 100 + F.col("dst_c")).alias("dst"), "w")
    d = {r.node: r.cost for r in graph.shortest_paths(e, spark.createDataFrame([(0,)], "node int")).collect()}
    for r in range(6):
        for c in range(6):
            assert d[r * 100 + c] == 14 * min(r, c) + 10 * abs(r - c)


def test_rectangles(spark):
    rects = spark.createDataFrame([(1, 50.0, 300.0, 32.0, 48.0), (2, 750.0, 310.0, 16.0, 16.0),
                                   (3, 60.0, 310.0, 16.0, 16.0), (4, 82.0, 300.0, 5.0, 5.0)],
                                  "id long, x double, y double, w double, h double")
    pairs = {(r.a_id, r.b_id) for r in spatial.rect_overlap(rects, cell=32.0).collect()}
    assert pairs == {(1, 3)}  # (1,4) only touch at x = 82
    pts = spark.createDataFrame([(10, 50.0, 300.0), (11, 82.0, 320.0)], "id long, px double, py double")
    hit = {(r.pid, r.rid) for r in spatial.points_in_rect(pts, rects).collect()}
    # half-open: (50, 300) is inside rect 1; (82, 320) is outside rect 4 (y range 300..305)
    assert hit == {(10, 1)}


def test_require_columns_and_guard(spark):
    df = spark.createDataFrame([(1, 0)] * 5, "a int, salto int")
    with pytest.raises(MissingColumns):
        prep.require_columns(df, ["a", "velocidad"])
    assert prep.training_guard(df, "salto").first().status == "too_few_rows"
    assert prep.training_guard(df.union(df).union(df), "salto").first().status == "one_class"


def test_network_json_roundtrip(spark):
    js = ('{"neurons":[{"trace":{"elegibility":{"0":0.5},"extended":{}},"state":0.25,"layer":"input","bias":0.0,'
          '"squash":"LOGISTIC"},{"layer":"output","bias":0.5,"squash":"LOGISTIC"}],'
          '"connections":[{"from":0,"to":1,"weight":2.0,"gater":1}]}')
    n, c = network.network_from_json(spark.createDataFrame([(js,)], "json string"))
    assert [r.id for r in n.orderBy("id").collect()] == [0, 1]
    assert n.where("id = 0").first().trace.elegibility == {"0": 0.5}
    assert c.first().weight == 2.0 and c.first().gater == 1
    back = network.network_to_json(n, c).first().json
    n2, c2 = network.network_from_json(spark.createDataFrame([(back,)], "json string"))
    assert n2.orderBy("id").collect() == n.orderBy("id").collect()
    assert c2.collect() == c.collect()


def test_xor_network_scores(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "a double, b double")
    layers = [{"weights": [[20.0, 20.0], [-20.0, -20.0]], "bias": [-10.0, 30.0], "squash": "LOGISTIC"},
              {"weights": [[20.0, 20.0]], "bias": [-30.0], "squash": "LOGISTIC"}]
    out = network.score_network(df, [F.col("a"), F.col("b")], layers).collect()
    assert [round(r.out0) for r in out] == [0, 1, 1, 0]
