"""A stored inverted index of text blocks, and exact top-k over it.

Blocks are unit vectors of term weights (``models.term_weights``). The index is
five tables in one folder:

* ``blocks(topic, b, bid)``: blocks are numbered in the order of their ids;
* ``postings(topic, term, part, b, weight)``: posting lists are cut into
  parts by bands of weight (part 0 has the largest weights, each next part
  weights smaller by ``BAND``), written in that order, so that a reader of some
  terms skips row groups;
* ``parts(topic, term, part, high, n)``: a part's largest weight and size;
* ``vocabulary(term, idf)``;
* ``centroids(topic, term, weight)``: unit vectors of the topics' means.

A search weighs the questions' terms, finds each question's topic, and the top
k blocks there by inner product (equal to nine decimals: the smaller id first):

1. of each term its ``HEAD`` largest weights give lower bounds of scores; the
   k-th is a bound ``theta`` that a block has to reach;
2. a part of a list is skipped when its largest weight and the greatest shares
   of all other terms stay below ``theta`` for every question of the topic that
   has the term: no block of it can enter, so that sums over the parts left are
   whole for all blocks that can;
3. the postings left meet the questions of their topic in tiles of
   ``TILE_BLOCKS`` block numbers and ``TILE_QUESTIONS`` questions: a tile adds
   up each question's lists over its blocks and passes on the k best from
   ``theta`` on; a last top-k merges the tiles.

So the result equals that of all scores. A tile's memory doesn't depend on the
size of either side, and no (question, block) pair but a tile's best leaves it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import keyed_scan

TERM = r"[\p{L}\p{N}_]"
TERM_BREAK = r"[^\p{L}\p{N}_]+"
BAND = 1.15
TILE_BLOCKS = 1 << 14
TILE_QUESTIONS = 1 << 15
HEAD = 64
DIGITS = 9
_SLACK = 1e-8  # sums in another order differ by less


def _terms(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term, tf): words of each text and how often it has them."""
    each = df.select(id_col, F.explode(F.split(F.lower(text), TERM_BREAK)).alias("term")).where("term <> ''")
    return each.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass
class InvertedIndex:
    vocabulary: DataFrame
    parts: DataFrame
    postings: DataFrame
    centroids: DataFrame
    blocks: DataFrame

    TABLES = ("vocabulary", "parts", "postings", "centroids", "blocks")

    @staticmethod
    def open(spark: SparkSession, path: str) -> InvertedIndex:
        return InvertedIndex(*[spark.read.parquet(f"{path}/{t}") for t in InvertedIndex.TABLES])

    def weigh(self, questions: DataFrame, qid: str = "qid", text: str = "text") -> DataFrame:
        """(qid, term, q): unit vectors of the questions over known terms (a
        question without known terms has no row)."""
        w = _terms(questions, qid, text).join(self.vocabulary, "term").select(F.col(qid).alias("qid"), "term", (F.col("tf") * F.col("idf")).alias("q"))
        length = F.sqrt(F.sum(F.col("q") * F.col("q")).over(Window.partitionBy("qid")))  # the terms of one question
        return w.withColumn("_len", length).where("_len > 0").select("qid", "term", (F.col("q") / F.col("_len")).alias("q"))

    def route(self, weights: DataFrame) -> DataFrame:
        """(qid, topic): the topic whose centroid has the largest cosine (ties:
        the largest topic); questions without a common term have no row."""
        dots = weights.join(self.centroids, "term").groupBy("qid", "topic").agg(F.round(F.sum(F.col("q") * F.col("weight")), 12).alias("c"))
        return dots.where("c > 0").groupBy("qid").agg(F.max_by("topic", F.struct("c", "topic")).alias("topic"))

    def last_topic(self) -> DataFrame:
        """One row: where questions without a common term are sent."""
        return self.centroids.agg(F.max("topic").alias("topic"))

    def _numbered(self, weights: DataFrame, topics: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Numbers ``q`` in place of the questions' ids: (weights, topics)."""
        known = topics.withColumn("i", F.monotonically_increasing_id()).checkpoint(eager=True)
        return weights.join(known.select("qid", "i", "topic"), "qid").select("i", "topic", "term", "q"), known

    def _heads(self, heads: DataFrame, k: int) -> DataFrame:
        """(topic, term, b, weight): the ``HEAD`` (k at least) largest weights of
        each term of ``heads(topic, term, _upto)``, whose k largest are in bands up
        to ``_upto``. A band of a common term has as many blocks as the table asks
        for; each question of the term would meet them all."""
        rows = self.postings.join(heads.select("topic", "term", "_upto"), ["topic", "term"]).where("part <= _upto")
        order = Window.partitionBy("topic", "term").orderBy(F.desc("weight"), "b")
        return rows.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= max(k, HEAD)).select("topic", "term", "b", "weight")

    def _top(self, asked: DataFrame, k: int) -> DataFrame:
        """(i, topic, b, score, rank) of ``asked(i, topic, term, q)``."""
        bands = self.parts.join(asked.select("topic", "term").distinct(), ["topic", "term"], "left_semi")
        before = Window.partitionBy("topic", "term").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a few dozen bands
        bands = bands.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        # the largest weight, and the last band of the k largest
        heads = bands.groupBy("topic", "term").agg(F.max("high").alias("_high"), F.max(F.when(F.col("_before") < k, F.col("part"))).alias("_upto"))
        share = asked.join(heads, ["topic", "term"]).withColumn("most", F.col("q") * F.col("_high"))
        # terms by their greatest share: what those below it can reach together
        below = Window.partitionBy("i").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, -1)
        share = share.withColumns({
            "under": F.coalesce(F.sum("most").over(below), F.lit(0.0)), "all": F.sum("most").over(Window.partitionBy("i")),
        }).drop("_high").checkpoint(eager=True)
        first = share.join(self._heads(heads, k), ["topic", "term"])
        first = first.groupBy("i", "b").agg(F.sum(F.col("q") * F.col("weight")).alias("s"))
        best = Window.partitionBy("i").orderBy(F.desc("s"))
        theta = first.withColumn("_i", F.row_number().over(best)).where(F.col("_i") <= k).groupBy("i").agg(
            F.when(F.count(F.lit(1)) == k, F.min("s")).otherwise(0.0).alias("theta"))
        share = share.join(theta, "i").checkpoint(eager=True)
        n_chunks = max(1, -(-share.select("i").distinct().count() // TILE_QUESTIONS))
        share = share.withColumn("chunk", F.pmod(F.xxhash64("i"), F.lit(n_chunks)).cast("int"))
        needed = share.join(self.parts, ["topic", "term"]).where(F.col("q") * F.col("high") + F.col("all") - F.col("most") >= F.col("theta") - _SLACK)
        # parts are in order of weight: those needed of a list are the first ones;
        # a chunk of questions gets the lists of its own terms only
        upto = needed.groupBy("topic", "term", "chunk").agg(F.max("part").alias("_upto"))
        own = self.postings.join(upto, ["topic", "term"]).where("part <= _upto")
        own = own.select("topic", "term", "b", "weight", F.expr(f"b div {TILE_BLOCKS}").alias("tile"), F.expr("chunk + 0").alias("chunk"))
        tiles = self.blocks.select("topic", F.expr(f"b div {TILE_BLOCKS}").alias("tile")).distinct()
        asked = share.join(tiles, "topic").select("topic", "tile", "chunk", "i", "term", "q", "theta")
        key = ["topic", "tile", "chunk"]
        found = asked.groupBy(*key).cogroup(own.groupBy(*key)).applyInArrow(_tile(k), f"i long, topic {asked.schema['topic'].dataType.simpleString()}, b long, score double")
        return _ranked(found, k)

    def _named(self, hits: DataFrame, known: DataFrame) -> DataFrame:
        out = hits.join(known.select("i", "qid"), "i").join(self.blocks.select("b", "bid"), "b")
        return out.select("qid", "topic", "bid", "score", "rank")

    def top(self, weights: DataFrame, topics: DataFrame, k: int) -> DataFrame:
        """(qid, topic, bid, score, rank): the k best blocks of each question of
        ``topics(qid, topic)``, by positive scores."""
        asked, known = self._numbered(weights, topics)
        return self._named(self._top(asked, k), known)

    def nearest(self, weights: DataFrame, topics: DataFrame, k: int) -> DataFrame:
        """``top``, filled up to k with the topic's smallest block ids (score 0,
        at one distance from the question) where fewer share a term with it."""
        asked, known = self._numbered(weights, topics)
        hits = self._top(asked, k).checkpoint(eager=True)
        few = known.select("i", "topic").join(hits.groupBy("i").agg(F.count(F.lit(1)).alias("n")), "i", "left").where(F.coalesce("n", F.lit(0)) < k).drop("n")
        low = self.blocks.select("topic", "b").withColumn("_i", F.row_number().over(Window.partitionBy("topic").orderBy("b")))
        low = low.where(F.col("_i") <= 2 * k).drop("_i")
        fill = few.join(low, "topic").join(hits.select("i", "b"), ["i", "b"], "left_anti").select("i", "topic", "b", F.lit(0.0).alias("score"))
        return self._named(_ranked(hits.drop("rank").unionByName(fill), k), known)


def _tile(k: int):
    """The k best blocks of a tile for each of its questions."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(asked: pa.Table, postings: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if asked.num_rows and postings.num_rows:
            postings, asked = postings.sort_by("term"), asked.sort_by("i")
            term = postings["term"].combine_chunks().dictionary_encode()
            names, code = term.dictionary, term.indices.to_numpy()
            bound = np.searchsorted(code, np.arange(len(names) + 1))  # codes ascend, as the terms are in order
            blocks, row = np.unique(postings["b"].to_numpy(), return_inverse=True)
            weight = postings["weight"].to_numpy()
            which = pc.index_in(asked["term"], names).fill_null(-1).to_numpy()
            i, q, theta = asked["i"].to_numpy(), asked["q"].to_numpy(), asked["theta"].to_numpy()
            starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
            for a, z in zip(starts, np.append(starts[1:], len(i))):
                score = np.zeros(len(blocks))
                for t, x in zip(which[a:z], q[a:z]):
                    if t >= 0:  # a list has a block once
                        own = slice(bound[t], bound[t + 1])
                        score[row[own]] += x * weight[own]
                score = np.round(score, DIGITS)
                hit = np.flatnonzero((score > 0) & (score >= theta[a] - 2 * _SLACK))
                if len(hit) > k:
                    least = np.partition(score[hit], len(hit) - k)[len(hit) - k]
                    hit = hit[score[hit] >= least]  # ties stay
                    hit = hit[np.lexsort((hit, -score[hit]))[:k]]  # blocks are in order of number
                out[0].append(np.full(len(hit), i[a]))
                out[1].append(blocks[hit])
                out[2].append(score[hit])
        i, b, score = (np.concatenate(x) for x in out)
        topic = pa.array([asked["topic"][0].as_py()] * len(i), asked.schema.field("topic").type) if len(i) else pa.nulls(0, asked.schema.field("topic").type)
        return pa.table({"i": i, "topic": topic, "b": b, "score": score})

    return run


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("i").orderBy(F.desc("score"), "b")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def build(blocks: DataFrame, path: str, band: float = BAND) -> InvertedIndex:
    """Index ``blocks(bid, topic, text)`` in the folder ``path``. Blocks without
    terms aren't in it. ``bid`` may be of any type that has an order."""
    from tessera.plans.models import term_weights

    spark = blocks.sparkSession
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{path}/{name}")
    blocks = blocks.where("bid is not null and topic is not null and text is not null").select("bid", "topic", "text")
    numbered = keyed_scan(blocks, [], ["bid", "topic"], rn="b")
    rows = term_weights(numbered, ["b", "topic"], "text", n=numbered.count(), keep_idf=True).where("weight > 0")
    write(numbered.where(F.col("text").rlike(TERM)).select("topic", "b", "bid"), "blocks")
    part = F.floor(-F.log("weight") / F.log(F.lit(band))).cast("int")
    rows = rows.select("topic", "term", F.greatest(part, F.lit(0)).alias("part"), "b", "weight", "idf")
    write(rows.repartitionByRange("topic", "term", "part", "b").sortWithinPartitions("topic", "term", "part"), "postings")
    postings = spark.read.parquet(f"{path}/postings")
    write(postings.groupBy("term").agg(F.max("idf").alias("idf")), "vocabulary")
    write(postings.groupBy("topic", "term", "part").agg(F.max("weight").alias("high"), F.count(F.lit(1)).alias("n")), "parts")
    sums = postings.groupBy("topic", "term").agg(F.sum("weight").alias("w"))
    norms = sums.groupBy("topic").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    write(sums.join(norms, "topic").select("topic", "term", (F.col("w") / F.col("_norm")).alias("weight")), "centroids")
    return InvertedIndex.open(spark, path)
