"""Language identification with more languages than a chain's blocks are for."""

import random

import numpy as np

from tessera.llm import crf_language


def test_every_language_is_learned(spark):
    rng = random.Random(8)
    rows = []
    for lang in range(crf_language.MANY + 8):
        parts = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(4)) for _ in range(8)]
        for _ in range(3 if lang < 8 else 5):  # the first are the rarest
            rows.append((len(rows), " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(60)), f"l{lang:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = crf_language.fit(docs)
    assert model.labels == sorted({r[2] for r in rows})
    out = crf_language.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in out if r.lang < "l08")
    assert sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(rows)


def test_posteriors_of_many_labels_equal_plain_forward_backward():
    rng = np.random.default_rng(3)
    n = crf_language.MANY + 6
    model = crf_language.Crf([f"{i:03d}" for i in range(n)], None, None, rng.normal(size=(n, n)).astype(np.float32))
    e = rng.normal(size=(300, n)).astype(np.float32)
    bounds = np.array([0, 0, 1, 65, 130, 300])
    got = model.posteriors(e, bounds)
    a = np.exp(model.transitions.astype(np.float64))
    for s, z in zip(bounds[:-1], bounds[1:]):
        x = np.exp(e[s:z].astype(np.float64))
        alpha, beta = np.zeros_like(x), np.ones_like(x)
        now = np.full(n, 1 / n)
        for t in range(z - s):
            now = (now @ a) * x[t]
            now /= now.sum()
            alpha[t] = now
        for t in range(z - s - 2, -1, -1):
            beta[t] = a @ (x[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        p = alpha * beta
        assert np.allclose(got[s:z], p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300), atol=1e-4)
