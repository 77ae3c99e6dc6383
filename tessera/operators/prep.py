"""Table preparation: guards, filters, splits, balancing, standardisation,
per-key ordered selections (P4-P9, U3-U6, G1-G3, W4-W6).

Random rules are order-free hashes of ``seed:id`` (md5), never ``rand()``:
the same rows are picked on every run, on any partitioning, and in DuckDB.
Split sizes use integer arithmetic: ``ceil(n * pct / 100) = (n*pct + 99) div 100``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P5: fail at analysis time with the missing names (no job runs)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df


def seeded_hash(id_col: str | Column, seed: int = 42) -> Column:
    """md5 of ``seed:id`` as hex text; portable across engines."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def hash_unit(id_col: str | Column, seed: int = 42) -> Column:
    """First 32 bits of the seeded md5 as a non-negative bigint in [0, 2^32)."""
    return F.conv(F.substring(seeded_hash(id_col, seed), 1, 8), 16, 10).cast("bigint")


def training_guard(df: DataFrame, label: str, min_rows: int = 10, classes: Sequence = ()) -> DataFrame:
    """One status row from one aggregation (not four actions). With
    ``classes``, each of them must have a row ("empty_class")."""
    agg = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(label)).alias("n_classes"),
        *[F.count(F.when(F.col(label) == c, 1)).alias(f"_n{i}") for i, c in enumerate(classes)],
    )
    status = F.when(F.col("n_rows") == 0, "empty").when(F.col("n_rows") < min_rows, "too_few_rows")
    if classes:
        status = status.when(F.least(*[F.col(f"_n{i}") for i in range(len(classes))], F.lit(1)) == 0, "empty_class")
    status = status.when(F.col("n_classes") < 2, "one_class").otherwise("ok")
    return agg.withColumn("status", status).select("n_rows", "n_classes", "status")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """G1 + G2: rows per class and the number of classes.

    The grouped result has one row per class, so the window over it is tiny."""
    from pyspark.sql import Window

    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("n_classes", F.count(F.lit(1)).over(Window.partitionBy()))


def random_split(df: DataFrame, id_col: str, test_pct: int = 20, seed: int = 42,
                 out: str = "split") -> DataFrame:
    """U4: a row is in the test side when its hash falls in the first
    ``test_pct`` percent of [0, 2^32); no shuffle, no order needed."""
    u = hash_unit(id_col, seed)
    return df.withColumn(
        out, F.when(u * 100 < F.lit(test_pct * 4294967296), "test").otherwise("train")
    )


def stratified_split(df: DataFrame, id_col: str, label: str, test_pct: int = 20,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Per class, the ``ceil(n*pct/100)`` rows first in hash order are test.

    Uses the skew-safe keyed scan: a class may hold most of the rows."""
    h = df.withColumn("_h", seeded_hash(id_col, seed))
    s = keyed_scan(h, [label], ["_h", id_col], totals=True)
    n_test = F.expr(f"(cnt * {int(test_pct)} + 99) div 100")
    return s.withColumn(
        out, F.when(F.col("rn") <= n_test, "test").otherwise("train")
    ).drop("_h", "rn", "cnt")


def tail_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], test_pct: int = 20,
               out: str = "split") -> DataFrame:
    """Per key, the first ``ceil((100-pct)*n/100)`` rows in order train, rest test."""
    s = keyed_scan(df, keys, order, totals=True)
    n_train = F.expr(f"(cnt * {100 - int(test_pct)} + 99) div 100")
    return s.withColumn(out, F.when(F.col("rn") <= n_train, "train").otherwise("test")).drop("cnt")


def every_nth(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Keep positions 0, n, 2n, ... (zero-based) of every key."""
    s = keyed_scan(df, keys, order)
    return s.where((F.col("rn") - 1) % n == 0)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """Last writer wins per key: ``max_by`` is a partial aggregate, so a hot
    key is reduced map-side before the shuffle."""
    ordk = F.struct(*[F.col(c) for c in order])
    val = F.struct(*[F.col(c) for c in values])
    return df.groupBy(*keys).agg(F.max_by(val, ordk).alias("_v")).select(*keys, "_v.*")


def oversample_even(df: DataFrame, id_col: str, label: str, seed: int = 42,
                    out: str = "copy", base=0, chunk: int = 1000) -> DataFrame:
    """Resample every class to the row count of class ``base``, up or down:
    a row of a class with n rows gets ``N div n`` copies, plus one for the
    first ``N mod n`` rows in hash order (N = rows of ``base``). The base class
    keeps its rows once. Copies are numbered from 1 in ``out``.

    A row's copies are cut into chunk rows that are spread over the cluster
    before they are expanded, so a small class is not expanded in the few
    tasks it lies in."""
    n = df.where(F.col(label) == F.lit(base)).count()
    s = keyed_scan(df.withColumn("_h", seeded_hash(id_col, seed)), [label], ["_h", id_col], totals=True)
    s = s.withColumn("_copies", F.expr(f"{n}L div cnt + if(rn <= {n}L % cnt, 1L, 0L)")).where("_copies > 0")
    s = s.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {int(chunk)})")))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = s.repartition(parts, id_col, "_chunk")
    copies = F.expr(f"sequence(_chunk * {int(chunk)} + 1, least(_copies, (_chunk + 1) * {int(chunk)}))")
    s = s.withColumn(out, F.explode(copies))
    return s.drop("_h", "rn", "cnt", "_copies", "_chunk")


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """G3 fit: one row of mean and population std per column (std 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}_mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std")]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, stats: DataFrame, cols: Sequence[str],
                 prefix: str = "z_") -> DataFrame:
    """G3 transform: (x - mean) / std, dividing by 1 where std is 0.

    ``stats`` is the one-row result of ``fit_scaler``: broadcasting it is bounded."""
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        s = F.when(F.col(f"{c}_std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}_std"))
        j = j.withColumn(f"{prefix}{c}", (F.col(c).cast("double") - F.col(f"{c}_mean")) / s)
    return j.drop(*[f"{c}_mean" for c in cols], *[f"{c}_std" for c in cols])


def with_distance(a: str, b: str, signed: bool = True) -> Column:
    """Relative distance, signed (new) or absolute (old)."""
    d = F.col(a) - F.col(b)
    return d if signed else F.abs(d)


def encode_flag(cond: Column) -> Column:
    """Boolean -> 0/1."""
    return F.when(cond, 1).otherwise(0)


def encode_move(left: Column, right: Column) -> Column:
    """Two keys -> -1 / 0 / 1."""
    return F.when(left, -1).when(right, 1).otherwise(0)


def decode_class(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    """P10: class id -> name through a literal map."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return df.withColumn(out, F.element_at(F.create_map(*kv), F.col(col)))


def shuffle_rows(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """A seeded, order-free shuffle (a range-partitioned sort on the hash)."""
    return df.orderBy(seeded_hash(id_col, seed), F.col(id_col))


def select_pos(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """Select columns by position (``df.columns[start:stop]``)."""
    return df.select(*df.columns[start:stop])


def decision_gate(pred: str | Column, *conditions: Column) -> Column:
    """Act only when the prediction is 1 and every state condition holds."""
    p = F.col(pred) if isinstance(pred, str) else pred
    cond = p == 1
    for c in conditions:
        cond = cond & c
    return cond


def approx_classes(df: DataFrame, label: str) -> DataFrame:
    """G2 at scale: approximate distinct label count (HyperLogLog++)."""
    return df.agg(F.approx_count_distinct(label).alias("n_classes"))


def score_routed(df: DataFrame, name_col: str, models: dict, out: str = "pred") -> DataFrame:
    """Pick the scoring model by name per row; rows of unknown names get 0,
    and so do rows that a model can't score (NULL or NaN). A model is a column of scores, and all
    of them are one projection, evaluated for their own rows only; or a function
    of a DataFrame, which scores its own rows in a scan of its own."""
    columns = {n: m for n, m in models.items() if isinstance(m, Column)}
    plans = {n: m for n, m in models.items() if not isinstance(m, Column)}
    score = F.lit(None).cast("double")
    for name, column in columns.items():
        score = F.when(F.col(name_col) == name, column.cast("double")).otherwise(score)
    named = F.coalesce(F.col(name_col).isin(list(plans)), F.lit(False)) if plans else F.lit(False)
    clean = F.when(F.isnan(score), 0).otherwise(F.coalesce(score.cast("int"), F.lit(0)))
    res = df.where(~named).withColumn(out, clean)
    for name, plan in plans.items():
        scored = plan(df.where(F.col(name_col) == name))
        res = res.unionByName(scored.withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(0))).select(*df.columns, out))
    return res
