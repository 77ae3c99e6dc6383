"""Word model of the quality rules."""

import collections
import glob
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import kn_quality, kn_words
from tessera.llm._letters import texts_to_bytes
from tessera.llm._text import hash_spans


def prose(rng, words, n=80):
    """Words that each have four followers."""
    at, out = rng.randrange(len(words)), []
    for _ in range(n):
        out.append(words[at])
        at = (7 * at + rng.choice((3, 11, 64, 90))) % len(words)
    return out


def test_shuffled_words_go(spark):
    rng = random.Random(4)
    # equal ends, so that symbols tell nothing about the word before
    words = ["an" + "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(3, 9))) + "en" for _ in range(307)]
    rows = [(i, "en", " ".join(prose(rng, words))) for i in range(400)]
    for i in range(8):
        mixed = prose(rng, words)
        rng.shuffle(mixed)
        rows.append((1000 + i, "en", " ".join(mixed)))
    out = kn_quality.judge_documents(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert sum(kept[i] for i in range(400)) >= 0.97 * 400
    assert not any(kept[1000 + i] for i in range(8))


def test_characters_without_blanks_are_words():
    data, offs = texts_to_bytes(["你好 Αβγ", None, "ไทย abc,ABC"])
    h, bounds = kn_words.word_hashes(data, offs)
    assert bounds.tolist() == [0, 3, 3, 8]
    assert h[-1] == h[-2] and len(set(h.tolist())) == 7


def test_probabilities_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    keyed = docs.select(kn_words.text_key().alias("key"), "text")
    grams = collections.defaultdict(collections.Counter)  # of each fold
    for r in keyed.collect():
        w = ["", "", *r.text.split()]
        grams[r.key % kn_words.FOLDS].update(zip(w, w[1:], w[2:]))

    def levels(folds):
        tri = sum((grams[f] for f in folds), collections.Counter())
        bi = collections.Counter(g[1:] for g in tri)
        return [collections.Counter(g[1:] for g in bi), bi, tri]

    def discount(c):
        n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
        return min(max(n1 / max(1, n1 + 2 * n2), 0.1), 0.95)

    d = [discount(c) for c in levels(list(grams))]

    def p(model, gram):
        if not gram:
            return 1 / (len(model[0]) + 1)
        counts = model[len(gram) - 1]
        own = {g: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(model, gram[1:])
        x = d[len(gram) - 1]
        return (max(counts[gram] - x, 0) + x * len(own) * p(model, gram[1:])) / sum(own.values())

    total, n = collections.Counter(), collections.Counter()
    for r in keyed.collect():
        model = levels([f for f in grams if f != r.key % kn_words.FOLDS])
        w = ["", "", *r.text.split()]
        total[r.key] -= sum(math.log(p(model, g)) for g in zip(w, w[1:], w[2:]))
        n[r.key] += len(w) - 2
    got = {r.key: r for r in kn_words.score(docs).collect()}
    assert {k: r.n_scored for k, r in got.items()} == dict(n)
    assert all(r.word_ppl == pytest.approx(total[k] / n[k], rel=1e-9) for k, r in got.items())


def test_odd_texts(spark):
    docs = spark.createDataFrame([(None,), ("",), ("1 2 !",), ("one",), ("one",)], "text string")
    assert [r.n_scored for r in kn_words.score(docs).collect()] == [2]
    assert kn_words.score(docs.where(F.lit(False))).count() == 0


def test_dealt_words_equal_one_slot(spark, monkeypatch):
    """Several passes and slots, and frequent words dealt by the word after them."""
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [" ".join(words[min(99, int(rng.expovariate(0.1)))] for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    docs = spark.createDataFrame([(t,) for t in rows + rows[:40] * 3], "text string").repartition(3)
    one = {r.key: r for r in kn_words.score(docs).collect()}
    monkeypatch.setattr(kn_words, "BUCKET", 500)
    monkeypatch.setattr(kn_words, "HOT", 400)
    keyed = docs.select(kn_words.text_key().alias("key"), "text")
    assert len(kn_words._sizes(keyed)[1]) > 3
    many = {r.key: r for r in kn_words.score(docs).collect()}
    assert {k: r.n_scored for k, r in many.items()} == {k: r.n_scored for k, r in one.items()}
    assert all(r.word_ppl == pytest.approx(one[k].word_ppl, rel=1e-9) for k, r in many.items())


def test_several_slots_of_a_task(spark, monkeypatch):
    """Words that several slots of one task have, rare ones, frequent ones."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    rows = [" ".join(words[min(599, int(rng.expovariate(0.02)))] for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in rows + rows[:20] * 2], "text string").repartition(3)
    one = {r.key: r for r in kn_words.score(docs).collect()}
    monkeypatch.setattr(kn_words, "BUCKET", 100)
    monkeypatch.setattr(kn_words, "HOT", 150)
    monkeypatch.setattr(kn_words, "TASKS", 3)
    many = {r.key: r for r in kn_words.score(docs).collect()}
    assert {k: r.n_scored for k, r in many.items()} == {k: r.n_scored for k, r in one.items()}
    assert all(r.word_ppl == pytest.approx(one[k].word_ppl, rel=1e-9) for k, r in many.items())


def test_texts_are_read_twice(spark, monkeypatch):
    """Once for the sizes, once to store the words, whatever the passes."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    docs = spark.range(300).select(F.concat(F.lit("some words of text "), F.col("id") % 7, F.lit(" and more")).alias("text"))
    monkeypatch.setattr(kn_words, "BUCKET", 100)
    assert kn_words.score(docs.mapInArrow(count, "text string")).count() == 7
    assert seen.value == 600


def test_disk_of_words(spark, tmp_path, monkeypatch):
    """Neither the exchanges that stay nor the tables have many bytes a word."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200))
    spark.createDataFrame([(text(),) for _ in range(1000)], "text string").repartition(4).write.parquet(f"{tmp_path}/texts")
    docs = spark.read.parquet(f"{tmp_path}/texts")
    monkeypatch.setattr(kn_words, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    local = os.environ.get("SPARK_LOCAL_DIRS", spark.conf.get("spark.local.dir", "/tmp"))

    def size(pattern):
        return {p: os.path.getsize(p) for p in glob.glob(pattern, recursive=True) if os.path.isfile(p)}

    before = size(f"{local}/**/blockmgr-*/**/shuffle_*.data")
    assert kn_words.score(docs).count() == 1000
    after = size(f"{local}/**/blockmgr-*/**/shuffle_*.data")
    assert sum(n for p, n in after.items() if p not in before) < 10 * 200_000
    assert sum(size(f"{tmp_path}/words-*/**").values()) < 20 * 200_000


def test_hashes_of_spans():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    words = [data[a : a + n] for a, n in zip(rng.integers(0, 199_000, 300).tolist(), rng.integers(1, 90, 300).tolist())]
    alone = [hash_spans(w, np.array([0]), np.array([len(w)]))[0] for w in words]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    order = rng.permutation(len(words))
    together = hash_spans(np.concatenate([*words, data]), starts[order], ends[order])
    assert (together == np.array(alone)[order]).all()
