"""The inverted index against scores of all blocks."""

import math
import random
import re
from collections import Counter

import pytest

from tessera.plans import inverted_index, retrieval
from tessera.sources.tables import scratch_path


def terms(text):
    return Counter(w for w in re.split(r"[^\w]+", text.lower()) if w)


def exhaustive(blocks, questions, k):
    """{qid: (topic, [(bid, score)])} by plain sums over all blocks of a topic."""
    df = Counter(t for _, _, text in blocks for t in terms(text))
    n = len(blocks)
    idf = {t: math.log((n + 1) / (c + 1)) for t, c in df.items()}

    def unit(text):
        w = {t: c * idf[t] for t, c in terms(text).items() if idf.get(t)}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()} if length else {}

    vectors = [(b, topic, unit(text)) for b, topic, text in blocks if unit(text)]
    cents = {}
    for _, topic, v in vectors:
        for t, x in v.items():
            cents.setdefault(topic, Counter())[t] += x
    out = {}
    for qid, text in questions:
        q = unit(text)
        cos = {p: round(sum(q.get(t, 0) * x for t, x in c.items()) / math.sqrt(sum(x * x for x in c.values())), 12) for p, c in cents.items()}
        topic = max(cents, key=lambda p: (cos[p], p))
        scored = [(b, round(sum(q.get(t, 0) * x for t, x in v.items()), 9)) for b, p, v in vectors if p == topic]
        out[qid] = (topic, sorted(scored, key=lambda s: (-s[1], s[0]))[:k])
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(200)]
    share = [1 / (i + 1) for i in range(200)]
    text = lambda n: " ".join(rng.choices(vocabulary, share, k=n))
    blocks = [(i, f"t{i % 4}" if i % 3 else "t0", text(rng.randrange(1, 25))) for i in range(900)]
    blocks += [(900 + i, "t1", blocks[1][2]) for i in range(30)]  # equal scores
    blocks += [(990, "t2", "?!"), (991, "t2", "")]
    questions = [(i, text(rng.randrange(1, 8))) for i in range(60)] + [(60, "unknown words only"), (61, ""), (62, "w199 w198 w197"), (63, "w0"), (64, blocks[1][2])]
    return blocks, questions


@pytest.mark.parametrize(("k", "band"), [(3, 1.15), (40, 2.0)])
def test_equals_all_scores(spark, data, k, band):
    blocks, questions = data
    path = scratch_path(spark, "index")
    df = spark.createDataFrame(blocks, "bid long, topic string, text string").repartition(5)
    inverted_index.build(df, path, band)
    index = inverted_index.InvertedIndex.open(spark, path)  # as a later job does
    q = spark.createDataFrame(questions, "qid long, text string")
    weights = index.weigh(q)
    topics = q.select("qid").join(index.route(weights), "qid", "left").fillna("t3")
    want = exhaustive(blocks, questions, k)
    got = {}
    for r in index.nearest(weights, topics, k).collect():
        got.setdefault(r.qid, {})[r["rank"]] = (r.topic, r.bid, r.score)
    for qid, (topic, best) in want.items():
        mine = [got[qid][i + 1] for i in range(len(best))]
        assert [m[0] for m in mine] == [topic] * len(best) and len(got[qid]) == len(best)
        assert [m[2] for m in mine] == pytest.approx([s for _, s in best], abs=2e-9)
        assert [m[1] for m in mine] == [b for b, _ in best]


def test_parts_are_skipped(spark):
    """A word in all blocks: only the blocks with the rare word are scored."""
    rng = random.Random(3)
    blocks = [(i, "t", "common " * rng.randrange(1, 9) + ("rare" if i % 100 == 0 else f"x{i}")) for i in range(1000)] + [(2000, "t", "other")]
    path = scratch_path(spark, "index")
    index = inverted_index.build(spark.createDataFrame(blocks, "bid long, topic string, text string"), path)
    q = spark.createDataFrame([(1, "common rare")], "qid long, text string")
    got = index.top(index.weigh(q), spark.createDataFrame([(1, "t")], "qid long, topic string"), 3).collect()
    assert all(r.bid % 100 == 0 for r in got) and len(got) == 3
    assert index.parts.where("term = 'common'").count() >= 8
    plan = index.postings.where("topic = 't' and term = 'rare'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(topic), IsNotNull(term), EqualTo(topic,t), EqualTo(term,rare)]" in plan


def test_struct_keys_and_empty_tables(spark):
    from pyspark.sql import functions as F

    big = 1 << 21  # would collide in a packed key
    rows = [(1, big, "a", "alpha beta gamma delta epsilon"), (3, 0, "a", "alpha zeta eta theta iota kappa")]
    blocks = spark.createDataFrame(rows, "doc_id long, block_id long, topic string, text string")
    blocks = blocks.select(retrieval.block_key("doc_id", "block_id").alias("bid"), "topic", "text")
    q = spark.createDataFrame([(1, "what is zeta?")], "qid long, text string")
    out = retrieval.retrieve(q, blocks, k=1).first()
    assert out.context.startswith("alpha zeta") and out.status == "ready"
    none = retrieval.retrieve(q, blocks.where(F.lit(False)), k=1).first()
    assert none.status != "ready" and none.context is None
    assert retrieval.retrieve(q.limit(0), blocks).count() == 0


def test_questions_of_the_same_words_are_searched_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    index = inverted_index.build(spark.createDataFrame([(1, "a", "the red fox"), (2, "a", "a blue whale"), (3, "a", "the grey wolf")], "bid long, topic string, text string"), scratch_path(spark, "same-words"))
    asked = []
    weigh = inverted_index.InvertedIndex.weigh
    monkeypatch.setattr(inverted_index.InvertedIndex, "weigh", lambda self, df, *a: asked.append(df.count()) or weigh(self, df, *a))
    q = spark.createDataFrame([(i, "k", t) for i, t in enumerate(["Red fox?", "fox, RED", "whale", "Whale!", None])], "qid long, key string, text string")
    out = {r.qid: r.context for r in retrieval.answer_from(index, q, index.blocks.select("bid").withColumn("text", F.format_string("block %d", "bid")), 1).collect()}
    assert asked == [3] and out == {0: "block 1", 1: "block 1", 2: "block 2", 3: "block 2", 4: "block 1"}


def test_chunks_of_questions_get_their_own_lists(spark, monkeypatch):
    monkeypatch.setattr(inverted_index, "TILE_QUESTIONS", 2)
    blocks = spark.createDataFrame([(i, "a", f"w{i} w{i % 5} common") for i in range(40)], "bid long, topic string, text string")
    index = inverted_index.build(blocks, scratch_path(spark, "chunks"))
    q = spark.createDataFrame([(i, f"w{i}") for i in range(40)], "qid long, text string")
    topics = q.selectExpr("qid", "'a' as topic")
    got = {r.qid: r.bid for r in index.top(index.weigh(q), topics, 1).collect()}
    monkeypatch.setattr(inverted_index, "TILE_QUESTIONS", 4096)
    assert got == {r.qid: r.bid for r in index.top(index.weigh(q), topics, 1).collect()} and len(got) == 40


def test_bounds_take_a_few_blocks_of_a_term(spark, monkeypatch):
    """A band of equal weights isn't met whole by each question of the term."""
    monkeypatch.setattr(inverted_index, "HEAD", 4)
    blocks = [(i, "t", f"common word{i} other{i % 3}") for i in range(200)] + [(200, "t", "else")]
    path = scratch_path(spark, "index")
    index = inverted_index.build(spark.createDataFrame(blocks, "bid long, topic string, text string"), path)
    heads = index.parts.groupBy("topic", "term").agg({"part": "max"}).withColumnRenamed("max(part)", "_upto")
    rows = index._heads(heads, 3).groupBy("term").count().collect()
    assert {r.term: r["count"] for r in rows}["common"] == 4 and max(r["count"] for r in rows) == 4
    questions = [(1, "common other1"), (2, "common"), (3, "other2 word5")]
    q = spark.createDataFrame(questions, "qid long, text string")
    weights = index.weigh(q).checkpoint(eager=True)
    got = {}
    for r in index.top(weights, index.route(weights), 3).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((r.bid, round(r.score, 9)))
    assert got == {i: s for i, (_, s) in exhaustive(blocks, questions, 3).items()}
