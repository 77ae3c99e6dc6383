"""Model plans on Spark ML.

Training is ``Pipeline.fit`` (driver loop over distributed jobs); scoring is
``PipelineModel.transform`` (a projection, batch or streaming). The scaler
uses the *population* std like the reference (MLlib ``StandardScaler`` uses
the sample std), so it is a ``SQLTransformer`` whose literals come from one
aggregate row; it is saved and loaded inside the pipeline.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    IDF,
    PCA,
    BucketedRandomProjectionLSH,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.prep import fit_scaler, require_columns
from tessera.plans.exact_trees import TreeModel, grow_trees
from tessera.session import ensure_checkpoint_dir


def scaler_stage(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> SQLTransformer:
    """G3 as a pipeline stage: (x - mean) / std_pop, std 0 -> 1."""
    row = fit_scaler(df, cols).first()
    parts = []
    for c in cols:
        m = row[f"{c}_mean"] or 0.0
        s = row[f"{c}_std"] or 0.0
        s = s if s != 0 else 1.0
        parts.append(f"(CAST({c} AS DOUBLE) - {float(m)!r}D) / {float(s)!r}D AS {prefix}{c}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def fit_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = 5,
             max_bins: int | None = None, seed: int = 42) -> TreeModel | PipelineModel:
    """M1: Gini decision tree on raw features (depth 5 by default), every split
    between two values tried (``exact_trees``). With ``max_bins``: Spark ML's
    tree over that many bins of each feature, as a pipeline."""
    require_columns(df, list(features) + [label])
    if max_bins is None:
        return grow_trees(df, features, [label], max_depth)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=max_depth,
                               maxBins=max_bins, impurity="gini", seed=seed,
                               predictionCol=f"pred_{label}", rawPredictionCol=f"raw_{label}",
                               probabilityCol=f"prob_{label}"),
    ]).fit(df)


def fit_multi_tree(df: DataFrame, features: Sequence[str], labels: Sequence[str],
                   max_depth: int | None = 5) -> list[TreeModel]:
    """M2: one tree per output label, all grown in the same passes (one model)."""
    return [grow_trees(df, features, labels, max_depth)]


def score_multi(df: DataFrame, models: Sequence[PipelineModel], keep: Sequence[str]) -> DataFrame:
    """M2/M6: apply several models in one pass (one prediction column each)."""
    out = df
    for m in models:
        out = m.transform(out).drop("features")
    preds = [c for c in out.columns if c.startswith("pred_")]
    return out.select(*keep, *preds)


#: rows of a training task: fewer aren't worth a task, more don't fit its memory
LEAST_ROWS, MOST_ROWS = 20_000, 500_000


def training_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``df``, computed once and dealt to the cluster's cores: they
    are much narrower than what they come from, so Spark joins them into few
    parts, and each of some hundred passes would keep as few cores busy."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*dict.fromkeys(columns)).checkpoint(eager=True)
    n = rows.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(-(-n // LEAST_ROWS), max(cores, -(-n // MOST_ROWS)))
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def fit_mlp(df: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int] = (16, 8),
            n_classes: int = 2, max_iter: int = 500, seed: int = 42) -> PipelineModel:
    """MLP on standardised features (sigmoid hidden units, l-bfgs)."""
    require_columns(df, list(features) + [label])
    rows = training_rows(df, [*features, label])
    scaler = scaler_stage(rows, features)
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol="features")
    # each pass sends the plan behind its rows to every task: of a checkpoint, next to nothing
    vectors = assembler.transform(scaler.transform(rows)).select("features", label).checkpoint(eager=True)
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=[len(features), *hidden, n_classes],
                                         maxIter=max_iter, seed=seed, predictionCol=f"pred_{label}",
                                         rawPredictionCol=f"raw_{label}", probabilityCol=f"prob_{label}")
    return PipelineModel([scaler, assembler, mlp.fit(vectors)])


def save_model(model, path: str) -> None:
    """The scaler travels inside a pipeline; exact trees and k-NN models
    save their tables."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str, kind: str | None = None):
    """Load once per job (not per row). ``kind``: "tree" (exact), "knn" or
    "pipeline"; without it, what the folder holds."""
    spark = SparkSession.getActiveSession()
    loaders = {"tree": lambda: TreeModel.load(spark, path), "knn": lambda: KnnModel.load(spark, path),
               "pipeline": lambda: PipelineModel.load(path)}
    if kind is None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists
        kind = next((k for k, f in (("tree", "nodes"), ("knn", "base")) if exists(spark._jvm.org.apache.hadoop.fs.Path(folder, f))), "pipeline")
    return loaders[kind]()


def tree_table(model, features: Sequence[str] = (), classes: Sequence = (), path: str | None = None) -> DataFrame:
    """A fitted tree as a node table ``(id, feature, threshold, gini,
    samples, value, class, left, right)``. An exact tree is such a table; of a
    Spark ML tree, the saved model's data folder (``path``) already has one row
    per node and is read back, not walked on the driver."""
    if isinstance(model, TreeModel):
        return model.table().withColumn("class", F.col("class").cast(model.label_types[0]).cast("string"))
    save_model(model, path)
    nodes = SparkSession.getActiveSession().read.parquet(f"{path}/stages/1_*/data")
    fnames = F.array(*[F.lit(f) for f in features])
    cls = F.array(*[F.lit(str(c)) for c in classes])
    stats = F.col("impurityStats")
    return nodes.select(
        F.col("id"),
        F.when(F.col("leftChild") >= 0, F.element_at(fnames, F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(F.col("leftChild") >= 0, F.element_at(F.col("split.leftCategoriesOrThreshold"), 1)).alias("threshold"),
        F.col("impurity").alias("gini"),
        F.col("rawCount").alias("samples"),
        F.transform(stats, lambda x: F.round(x).cast("long")).alias("value"),
        F.element_at(cls, F.col("prediction").cast("int") + 1).alias("class"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
    )


def edges_to_dot(nodes: DataFrame) -> DataFrame:
    """Node table -> one DOT text (nodes then edges, in id order)."""
    lab = F.format_string("%d [label=\"%s\\ngini = %.3f\\nsamples = %d\\nclass = %s\"] ;",
                          F.col("id"), F.coalesce(F.format_string("%s <= %.2f", "feature", "threshold"), F.lit("leaf")),
                          F.col("gini"), F.col("samples"), F.col("class"))
    n = nodes.select(F.col("id"), lab.alias("line"))
    e = nodes.where(F.col("left") >= 0).select(
        F.col("id"), F.format_string("%d -> %d ;\n%d -> %d ;", "id", "left", "id", "right").alias("line"))
    allx = n.unionByName(e)
    return allx.agg(F.concat(F.lit("digraph Tree {\n"),
                             F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))),
                                                      lambda s: s["line"]), "\n"),
                             F.lit("\n}")).alias("dot"))


def compare_models(df: DataFrame, models: dict, label: str) -> DataFrame:
    """M7: name -> accuracy on one common test set, one pass over it. Models
    are anything with ``transform``: pipelines, exact trees, k-NN models."""
    out = df
    cols = []
    for name, m in models.items():
        out = m.transform(out)
        pc = [c for c in out.columns if c.startswith("pred_")][-1]
        out = out.withColumnRenamed(pc, f"_p_{name}").drop("features")
        out = out.drop(*[c for c in out.columns if c.startswith(("raw_", "prob_", "z_"))])
        cols.append(name)
    stack = ", ".join(f"'{n}', CAST(`_p_{n}` AS DOUBLE)" for n in cols)
    long = out.select(F.col(label).cast("double").alias("_y"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (model, _p)"))
    return long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("_y") == F.col("_p"), 1.0).otherwise(0.0)).alias("accuracy"))


def fit_pca(df: DataFrame, vec: str, k: int) -> PipelineModel:
    """M8: PCA on array vectors."""
    return PCA(k=k, inputCol="_v", outputCol="_pca").fit(df.withColumn("_v", array_to_vector(vec)))


def project_pca(model, df: DataFrame, vec: str, out: str = "pc") -> DataFrame:
    return model.transform(df.withColumn("_v", array_to_vector(vec))).withColumn(
        out, vector_to_array("_pca")).drop("_v", "_pca")


def lsh_pairs(df: DataFrame, id_col: str, vec: str, threshold: float, bucket_length: float = 1.0,
              num_tables: int = 4, seed: int = 42) -> DataFrame:
    """S7 (approximate): pairs closer than ``threshold`` by random-projection
    LSH (a join on hash buckets, not all pairs). Returns (a, b, dist), a < b.
    Spark ML's own similarity join carries both vectors of every candidate
    through a shuffle; here tiles of a bucket meet (``vectors.bucket_pairs``).
    Rows without a vector take no part, equal rows count once."""
    from tessera.operators import vectors

    rows = df.select(F.col(id_col).alias("id"), F.col(vec).alias("x")).where("id is not null and x is not null").dropDuplicates()
    v = rows.withColumn("v", array_to_vector("x"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="_h", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(v)
    buckets = F.array(*[vector_to_array(F.col("_h")[t])[0].cast("long") for t in range(num_tables)])
    return vectors.bucket_pairs(model.transform(v).select("id", "x", buckets.alias("h")), threshold)


def fit_text_vectors(df: DataFrame, text: str, num_features: int = 1 << 18) -> PipelineModel:
    """Text -> unit TF-IDF vector (tokens = runs of letters/digits)."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[^\p{L}\p{N}_]+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="vector", p=2.0),
    ]).fit(df)


#: a term is common if it has more than this share of all (text, term) rows:
#: at most so many terms are, and their weights are broadcast
COMMON_TERMS = 10_000
#: bytes of text, and (text, term) rows, of one task of ``term_weights``
TASK_BYTES, TASK_ROWS = 8 << 20, 1 << 20


def term_weights(df: DataFrame, id_col: str | Sequence[str], text: str, n: int | None = None,
                 keep_idf: bool = False) -> DataFrame:
    """M14 with plain terms: ``(id, term, tf, weight)``, the weights of
    ``fit_text_vectors`` (count times ``ln((texts + 1) / (texts with the term +
    1))``, unit length a text) before hashing, so without collisions. Texts
    without terms give no rows; a length of zero gives zero weights.

    A term may be in most texts: the common ones (``COMMON_TERMS`` at most) meet
    their counts by a broadcast, the others by an equi-join. Texts and rows are
    dealt to as many tasks as their size asks for, so a task's memory doesn't
    grow with the table. ``n``: the number of texts, if it is known;
    ``keep_idf``: also ``idf``. Several ``id_col`` name a text together."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    n = size.n if n is None else n
    df = df.repartition(max(default, -(-(size.bytes or 0) // TASK_BYTES)), *ids)
    tok = df.select(*ids, F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}_]+")).alias("term")).where("term <> ''")
    tf = tok.groupBy(*ids, "term").agg(F.count(F.lit(1)).alias("tf")).checkpoint(eager=True)
    vocabulary = tf.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    vocabulary = vocabulary.withColumn("idf", F.log((F.lit(float(n)) + 1) / (F.col("_df") + 1.0)))
    n_rows = tf.count()
    least, parts = n_rows / COMMON_TERMS, -(-n_rows // TASK_ROWS)
    deal = (lambda x, *keys: x.repartition(parts, *keys)) if parts > default else (lambda x, *keys: x)
    common = F.broadcast(vocabulary.where(F.col("_df") > least).select("term", F.col("idf").alias("_common")))
    w = tf.join(common, "term", "left")
    rare = deal(w.where("_common is null").drop("_common"), "term").join(deal(vocabulary.where(F.col("_df") <= least).select("term", "idf"), "term"), "term")
    w = w.where("_common is not null").withColumnRenamed("_common", "idf").unionByName(rare)
    w = deal(w, *ids).withColumn("_w", F.col("tf") * F.col("idf"))
    # a window holds the distinct terms of one text
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*ids)))
    w = w.withColumn("_len", length)
    weight = F.when(F.col("_len") > 0, F.col("_w") / F.col("_len")).otherwise(0.0)
    return w.select(*ids, "term", "tf", *(["idf"] if keep_idf else []), weight.alias("weight"))


def embed_with(df: DataFrame, text: str, embed, out: str = "vec") -> DataFrame:
    """A caller's embedding function, applied as an iterator pandas UDF
    (Arrow batches; the model is loaded once per task by the caller's code).
    ``embed(pandas.Series[str]) -> pandas.Series[list[float]]``."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<float>")
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield embed(b)

    return df.withColumn(out, _embed(F.col(text)))


def knn_predict(train: DataFrame, test: DataFrame, features: list[str], label: str, id_col: str,
                k: int = 5) -> DataFrame:
    """M3: ``test`` plus ``pred_<label>``, the vote of the ``k`` nearest training
    rows (L2 on the raw features). Copies of a row in ``train`` vote each."""
    from tessera.operators import vectors

    vec = F.array(*[F.col(c).cast("double") for c in features]).alias("vec")
    base = train.select(F.xxhash64(id_col, *(["copy"] if "copy" in train.columns else [])).alias("bid"), vec, label)
    asked = test.select(F.xxhash64(id_col).alias("qid"), vec).dropDuplicates(["qid"])
    near = vectors.nearest_k(asked, base.select("bid", "vec"), k)
    votes = vectors.knn_vote(near, base.select("bid", label), "qid", "bid", label, f"pred_{label}")
    return test.join(votes, F.xxhash64(id_col) == F.col("qid")).drop("qid")


@dataclass
class KnnModel:
    """M3 as a model: its training rows, the features and k."""

    base: DataFrame
    features: list[str]
    label: str
    id_col: str
    k: int = 5

    def transform(self, df: DataFrame) -> DataFrame:
        return knn_predict(self.base, df, self.features, self.label, self.id_col, self.k)

    def save(self, path: str) -> None:
        keep = [c for c in self.base.columns if c in {*self.features, self.label, self.id_col, "copy"}]
        self.base.select(*keep).write.mode("overwrite").parquet(f"{path}/base")
        meta = json.dumps({"features": self.features, "label": self.label, "id_col": self.id_col, "k": self.k})
        self.base.sparkSession.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KnnModel:
        return KnnModel(spark.read.parquet(f"{path}/base"), **json.loads(spark.read.text(f"{path}/meta").first()[0]))


KINDS = ("tree", "mlp", "knn")


def train_all(df: DataFrame, spec: list[dict], id_col: str, test_pct: int = 20,
              balance: str = "after_split", seed: int = 42, save_to: str | None = None,
              as_models: bool = False) -> dict:
    """M5: per target: guard -> select -> (balance) -> split -> fit -> report.

    ``spec`` items: {"name", "kind": one of KINDS, "features", "label", ...}.
    Rows whose label is outside {0, 1} are dropped first (the reference trains
    on 0/1 only and can log -1). ``balance`` is "after_split" (default: copies
    stay in the train side), "before_split" (the reference's order) or None.
    Returns {name: (model, report DataFrame)} and skips specs that fail the guard
    (the status takes the report's place; a class without rows fails it too).
    ``save_to``: a folder for each model. A k-NN item's model is ``("knn", k)``,
    as it learns nothing; with ``save_to`` or ``as_models``, a ``KnnModel`` that
    holds its training rows. ``dropped_rows`` reports the rows that
    training leaves out."""
    from tessera.operators import metrics, prep

    if unknown := {s.get("kind", "tree") for s in spec} - set(KINDS):
        raise ValueError(f"unknown kinds of model: {sorted(unknown)}")
    out = {}
    for s in spec:
        label, feats = s["label"], s["features"]
        prep.require_columns(df, feats + [label, id_col])
        data = df.where(F.col(label).isin(0, 1)).select(id_col, *feats, label)
        status = prep.training_guard(data, label, classes=(0, 1)).first().status
        if status != "ok":
            out[s["name"]] = (None, status)
            continue
        if balance == "before_split":
            data = prep.oversample_even(data, id_col, label, seed).drop("copy")
        split = prep.stratified_split(data, id_col, label, test_pct, seed)
        train = split.where(F.col("split") == "train").drop("split")
        test = split.where(F.col("split") == "test").drop("split")
        if balance == "after_split":
            train = prep.oversample_even(train, id_col, label, seed)
        if s.get("kind", "tree") == "knn":
            model = KnnModel(train, list(feats), label, id_col, s.get("k", 5))
        elif s.get("kind", "tree") == "mlp":
            model = fit_mlp(train, feats, label, hidden=s.get("hidden", (16, 8)),
                            max_iter=s.get("max_iter", 500), seed=seed)
        else:
            model = fit_tree(train, feats, label, max_depth=s.get("max_depth", 5))
        if save_to is not None:
            save_model(model, f"{save_to}/{s['name']}")
        report = metrics.classification_report(model.transform(test), label, f"pred_{label}")
        if isinstance(model, KnnModel) and save_to is None and not as_models:
            model = ("knn", model.k)
        out[s["name"]] = (model, report)
    return out


def dropped_rows(df: DataFrame, spec: list[dict]) -> DataFrame:
    """M5: (name, n_rows, n_dropped): rows of ``df``, and those whose label isn't
    0 or 1, for each item of ``train_all``'s ``spec``; one pass."""
    kept = [F.count(F.when(F.col(s["label"]).isin(0, 1), 1)).alias(f"_{i}") for i, s in enumerate(spec)]
    rows = F.array(*[F.struct(F.lit(s["name"]).alias("name"), F.col("n_rows"), (F.col("n_rows") - F.col(f"_{i}")).alias("n_dropped"))
                     for i, s in enumerate(spec)])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *kept).select(F.inline(rows))
