"""Similarity join, nearest neighbours, classifiers, quality rules, pipeline."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import conv_toxicity, crf_language, factor_quality, kn_quality, partition_join, vamana_index
from tessera.llm._letters import texts_to_bytes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MID = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ similarity join


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows, percent=75):
    """(doc_id, shingles, component) by counting common shingles of all pairs."""
    nodes = [(r.doc_id, shingles(r.text)) for r in rows if r.doc_id is not None]
    at = collections.defaultdict(list)
    for i, (_, s) in enumerate(nodes):
        for x in s:
            at[x].append(i)
    parent = {d: d for d, _ in nodes}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (d, s) in enumerate(nodes):
        common = collections.Counter(j for x in s for j in at[x] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(nodes[j][1]) - n):
                a, b = find(d), find(nodes[j][0])
                parent[max(a, b)] = min(a, b)
    return collections.Counter((d, len(s), find(d)) for d, s in nodes)


def got_components(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)


def near_copies(seed, sizes, copies):
    rng = random.Random(seed)
    base, rows = [f"w{rng.randrange(500)}" for _ in range(5000)], []
    for n in sizes:
        at = rng.randrange(4000)
        words = base[at : at + n + 4] if n else []
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randrange(1 + max(1, n // 18))):
                if own:
                    i = rng.choice([0, len(own) - 1, rng.randrange(len(own))])
                    own[i : i + 1] = rng.choice([[], [f"x{rng.randrange(9)}"], [own[i], f"y{rng.randrange(9)}"]])
            rows.append((len(rows), " ".join(own).upper() if len(rows) % 7 == 0 else "\t".join(own), None, None, None))
    return rows


def test_join_small_and_large_sets(spark):
    df = spark.createDataFrame(near_copies(3, [*range(40), 60, 90, 200, 420], 6), DOCS).repartition(5)
    assert got_components(partition_join.link_documents(df)) == brute_components(df.collect())


def test_join_of_documents(docs):
    assert got_components(partition_join.link_documents(docs)) == brute_components(docs.collect())


def test_join_with_hot_groups_and_common_passages(spark):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = near_copies(4, [120] * 2, 60)  # two large groups of near copies
    n = len(rows)
    rows += [(n + i, "one exact copy of a text that many rows have in common", None, None, None) for i in range(80)]
    n = len(rows)
    for i in range(120):  # a passage that a third of the rows share
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.choice([20, 60, 200]))]
        rows.append((n + i, " ".join(own[:10] + passage + own[10:]), None, None, None))
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    expect = brute_components(df.collect())
    assert got_components(partition_join.link_documents(df)) == expect
    # frequent shingles, buckets and tiles steer cost only
    assert got_components(partition_join.link_documents(df, sample_one_in=1, popular_least=2, bucket_rows=500)) == expect


def test_join_of_odd_rows(odd_docs):
    out = partition_join.link_documents(odd_docs)
    assert out.count() == odd_docs.count()
    assert got_components(out) == brute_components(odd_docs.collect())
    assert out.where("doc_id is null and component_id is not null").count() == 0
    assert partition_join.link_documents(odd_docs.limit(0)).count() == 0


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for n, extra in ((5, 1), (100, 10), (700, 300)):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[extra // 2 :], rng.integers(0, 2**63, extra, dtype=np.uint64)]))
        x, y = partition_join.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert partition_join.parity_distance(x, y) <= len(np.setxor1d(a, b))
        assert partition_join.parity_distance(x, x) == 0


# ------------------------------------------------------------------ nearest neighbours


def recall(df, out, k=20):
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in df.collect()}
    ids = np.array(sorted(rows))
    v = np.stack([rows[i] for i in ids])
    got = collections.defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r["rank"]))
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = v @ rows[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        own = got[q]
        assert [x[2] for x in own] == list(range(1, len(order) + 1))
        assert all(x[0] != q and x[1] == pytest.approx(rows[q] @ rows[x[0]], abs=1e-9) for x in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        hit += len({x[0] for x in own} & set(ids[order].tolist()))
        total += len(order)
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    return hit / total


def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{MID}/embeddings.parquet")
    assert recall(df, vamana_index.search_embeddings(df)) >= 0.95
    assert recall(df, vamana_index.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=100, block_rows=7)) >= 0.95


def test_neighbours_of_unequal_lengths(spark):
    rng = np.random.default_rng(0)
    v = (rng.normal(size=(1500, 8)) * rng.uniform(0.2, 5, (1500, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    assert recall(df, vamana_index.search_embeddings(df)) >= 0.9


def test_neighbours_of_odd_rows(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(60).withColumn("score", F.lit("clash"))
    odd = [(10**6, None), (None, [1.0] * 64), (10**6 + 20, [0.0] * 64), (10**6 + 40, [float("nan")] * 64), (10**6 + 60, [1.0, None] + [0.0] * 62), (10**6 + 80, [1.0])]
    odd = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    first = df.orderBy("vec_id").limit(1)
    hot = first.crossJoin(spark.range(100).withColumnRenamed("id", "k")).select((F.col("k") + 2000).alias("vec_id"), "embedding")
    every = df.select("vec_id", "embedding").unionByName(odd).unionByName(hot).unionByName(df.select("vec_id", "embedding").limit(3))
    out = vamana_index.search_embeddings(every).collect()
    asked = [r.vec_id for r in df.collect() if r.vec_id % 20 == 0] + [2000 + i for i in range(0, 100, 20)]
    assert collections.Counter(r.query_id for r in out) == {q: 20 for q in asked}
    own = first.collect()[0].vec_id
    assert sorted(r.vec_id for r in out if r.query_id == 2020) == [own, *range(2000, 2019)]  # ties: smallest ids
    assert vamana_index.search_embeddings(df.limit(0)).count() == 0
    few = vamana_index.search_embeddings(df.where("vec_id < 3")).collect()
    assert all(r.vec_id != r.query_id for r in few)


def test_an_id_with_several_vectors_has_its_best_score(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 3.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5]), (2, [0.0, 9.0])]
    out = vamana_index.search_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"])] == [(20, 1, 2, 27.0), (20, 2, 1, 3.0)]


# ------------------------------------------------------------------ classifiers


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    out = crf_language.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_labels_code_switched_words(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    model = crf_language.fit(docs.where(~crf_language.held_out()))
    held = {lang: [r.text for r in docs.where(crf_language.held_out() & (F.col("lang") == lang)).limit(8).collect()] for lang in ("en", "de")}
    ok = total = 0
    for en, de in zip(held["en"], held["de"]):
        en, de = en.split()[:40], de.split()[:40]
        df = spark.createDataFrame([(1, " ".join(en + de))], "doc_id long, text string")
        labels = crf_language.label_spans(df, model).first().word_labels
        half = len(re.findall(r"[^\W\d_]+", " ".join(en)))
        ok += sum(x == "en" for x in labels[:half]) + sum(x == "de" for x in labels[half:])
        total += len(labels)
    assert ok >= 0.85 * total


def test_posteriors_equal_plain_forward_backward():
    rng = np.random.default_rng(3)
    model = crf_language.Crf(["a", "b", "c"], None, None, rng.normal(size=(3, 3)).astype(np.float32))
    e = rng.normal(size=(400, 3)).astype(np.float32)
    bounds = np.array([0, 0, 1, 65, 130, 400])
    got = model.posteriors(e, bounds)
    a = np.exp(model.transitions.astype(np.float64))
    for s, z in zip(bounds[:-1], bounds[1:]):
        if s == z:
            continue
        x = np.exp(e[s:z].astype(np.float64))
        alpha, beta = np.zeros_like(x), np.ones_like(x)
        now = np.full(3, 1 / 3)
        for t in range(z - s):
            now = (now @ a) * x[t]
            now /= now.sum()
            alpha[t] = now
        for t in range(z - s - 2, -1, -1):
            beta[t] = a @ (x[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        p = alpha * beta
        assert np.allclose(got[s:z], p / p.sum(axis=1, keepdims=True), atol=1e-4)


def test_language_of_odd_rows(odd_docs):
    out = {r.doc_id: r for r in crf_language.identify_documents(odd_docs).collect()}
    for i in (4, 5, 6, 8):
        assert out[i].lang_pred == "und" and out[i].score == 0
    assert out[9].lang_pred in ("en", "fr")
    assert crf_language.identify_documents(odd_docs.limit(0)).count() == 0
    unlabelled = crf_language.identify_documents(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def toxic_table(spark):
    rng = random.Random(8)
    words = {"en": [f"the{i}" for i in map(chr, range(97, 123))], "fr": [f"les{i}" for i in map(chr, range(97, 123))]}
    bad = {"en": "verynasty", "fr": "mechante"}
    rows, labels = [], []
    for i in range(900):
        lang, toxic = rng.choice(["en", "fr"]), int(rng.random() < 0.3)
        own = [rng.choice(words[lang]) for _ in range(rng.randrange(5, 120))]
        if toxic:
            own[rng.randrange(len(own))] = bad[lang] + rng.choice(["", "s", "ly"])
        rows.append((i, " ".join(own), lang, "s", 1))
        labels.append((i, 1 - toxic, toxic))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = toxic_table(spark)
    out = conv_toxicity.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in out)
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)


def test_toxicity_ignores_everything_but_the_text(spark):
    docs, labels = toxic_table(spark)
    model = conv_toxicity.fit(docs, labels)
    score = lambda df: {r.k: r.score for r in conv_toxicity.score_texts(df, model).collect()}
    one = docs.select(F.col("doc_id").alias("k"), "text")
    assert score(one) == score(docs.select(F.col("doc_id").alias("k"), "text", F.lit("xx").alias("lang")).repartition(7))


def test_classifiers_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (20, None, None), *[(i, i % 2, i % 2) for i in range(21, 60)]], "doc_id long, quality int, toxic int")
    for module in (conv_toxicity, factor_quality):
        out = module.score_documents(odd_docs, labels).collect()
        assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if r.doc_id in (4, 5)}) <= 2
        assert module.score_documents(odd_docs.limit(0), labels).count() == 0
        assert module.score_documents(odd_docs, labels.limit(0)).count() == odd_docs.count()
        one = module.score_documents(odd_docs, labels.withColumns({"quality": F.lit(1), "toxic": F.lit(1)})).collect()
        assert len(one) == odd_docs.count()


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")
    out = factor_quality.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in out)
    assert sum(r.predicted == r.quality for r in held) >= 0.85 * len(held)


def test_factor_machine_sum_of_squares():
    rng = np.random.default_rng(0)
    fm = factor_quality.FactorMachine(0.3, rng.normal(size=20).astype(np.float32), rng.normal(size=(20, 4)).astype(np.float32), None, None, None)
    idx, x, at = rng.integers(0, 20, 11), rng.normal(size=11).astype(np.float32), np.array([0, 5, 11])
    got, _ = fm.forward(idx, x, at)
    for d in (0, 1):
        i, v = idx[at[d] : at[d + 1]], x[at[d] : at[d + 1]]
        plain = 0.3 + fm.w[i] @ v + sum(fm.v[i[a]] @ fm.v[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a + 1, len(i)))
        assert got[d] == pytest.approx(plain, rel=1e-4)


# ------------------------------------------------------------------ quality rules


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    hit = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_quality_rules(spark, odd_docs):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    for df in (docs, odd_docs):
        expect = collections.Counter((r.doc_id, *base_rules(r.text)) for r in df.collect())
        out = kn_quality.judge_documents(df).collect()
        assert collections.Counter((r.doc_id, *(r[c] for c in kn_quality.COUNTS), r.base_failed) for r in out) == expect
        assert not any(r.kept and r.base_failed for r in out)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    out = kn_quality.judge_documents(docs).collect()
    good = [r.kept for r in out if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.97 * len(good)
    assert kn_quality.judge_documents(docs.limit(0)).count() == 0


def test_kneser_ney_sums_to_one_and_equals_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aab bcd.") for _ in range(200)) for _ in range(30)]
    model = kn_quality.fit(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    grams = collections.Counter()
    for t in texts:
        s, bounds = kn_quality.symbols(*texts_to_bytes([t]))
        s = [0, 0, 0, *s.tolist()]
        grams.update(tuple(s[i : i + 4]) for i in range(len(s) - 3))

    levels = [dict(grams)]
    for _ in range(3):
        levels.append(dict(collections.Counter(g[1:] for g in levels[-1])))

    def discounts(counts):
        n = [max(1, sum(c == k for c in counts.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) for k in (1, 2, 3)]

    def p(gram):
        if not gram:
            return 1 / 64
        counts = levels[4 - len(gram)]
        d = discounts(counts)
        own = {g[-1]: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        c = own.get(gram[-1], 0)
        return max(c - d[min(c, 3)], 0) / total + sum(d[min(x, 3)] for x in own.values()) / total * p(gram[1:])

    code = lambda g: sum(x << 6 * (3 - i) for i, x in enumerate(g))
    some = rng.sample(sorted(grams), 15) + [(60, 61, 62, 63), (1, 2, 3, 50), (60, 1, 2, 3)]
    got = np.exp(model.log_probability(0, np.array([code(g) for g in some], np.int64)))
    assert np.allclose(got, [p(g) for g in some], rtol=1e-4)
    row, table = model.rows(0)
    assert np.allclose(np.exp(table.astype(np.float64)).sum(axis=1), 1, atol=1e-3)


def test_perplexity_rejects_unlike_texts(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang", "text")
    rng = random.Random(2)
    noise = [(10**6 + i, "en", " ".join("".join(rng.choice("qxzjkvw") for _ in range(8)) for _ in range(80))) for i in range(5)]
    out = kn_quality.judge_documents(docs.unionByName(spark.createDataFrame(noise, docs.schema))).where("doc_id >= 1000000").collect()
    assert len(out) == 5 and not any(r.kept for r in out)


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mix", "pack"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        if name != "pack":
            assert out.columns == docs.columns
        rows = out.collect()
        if name == "near_duplicates":
            groups = brute_components(now.collect())
            assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in groups})
        if name in ("quality", "language"):
            assert 0.7 * now.count() < len(rows) <= now.count()
        now = out if name == "pack" else spark.createDataFrame(rows, docs.schema)
    assert now.count() > 0


def test_near_duplicates_of_shared_ids(spark):
    """Unlike texts that share an id stay; copies go, under whatever id."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (1, two), (2, one), (2, three), (1, one), (3, two + " more"), (None, one), (4, ""), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(1, one), (1, two), (2, three), (None, one), (4, ""), (4, None)], key=str)


def test_pipeline_of_odd_rows(spark, odd_docs):
    now = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        empty = stage(spark, now.limit(0), SF)
        assert empty.count() == 0
        if name != "pack":
            assert out.columns == odd_docs.columns
            now = spark.createDataFrame(out.collect(), odd_docs.schema)
    assert out.count() > 0


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    # a word that a sample of 2500 rows a label would hardly hold: 24 of 9000 toxic rows
    rng = random.Random(2)
    plain = [a + b + c for a in "abcdef" for b in "aeiou" for c in "lmnrst"]
    rows, labels = [], []
    for i in range(18_000):
        own = [rng.choice(plain) for _ in range(6)]
        if i % 2:
            own[rng.randrange(6)] = "quizzed" if i < 48 else "nastyword"
        rows.append((i, " ".join(own), "en", "s", 1))
        labels.append((i, 0, i % 2))
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    seen = []
    count_rows = conv_toxicity._count_rows
    monkeypatch.setattr(conv_toxicity, "_count_rows", lambda dealt, names: (seen.append((dealt.count(), dealt.rdd.getNumPartitions())), count_rows(dealt, names))[1])
    model = conv_toxicity.fit(docs, labels)
    assert seen == [(18_000, 5)]
    again = conv_toxicity.fit(docs.repartition(3), labels)
    assert (model.embeddings == again.embeddings).all() and (model.thresholds == again.thresholds).all() and model.bias == again.bias
    asked = spark.createDataFrame([(1, "bal quizzed cem"), (2, "bal cem dor"), (3, "nastyword bal"), (4, "")], "k long, text string")
    assert [r.predicted for r in conv_toxicity.score_texts(asked, model).orderBy("k").collect()] == [1, 0, 1, 0]
