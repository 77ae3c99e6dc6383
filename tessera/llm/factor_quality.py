"""Quality by a factorisation machine.

The features of a document are its hashed letter words (each occurrence counts
1/n), statistics of its structure (shares of letters, capitals, digits,
symbols, pipes and line ends, lengths, shares of different words and lines) and
of its metadata (the recorded ``n_chars`` against the text's own length), the
last two as standard scores and as bins. The score is logistic in

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

where the pairwise sum takes linear time: half the sum over the factors of
(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2. Training is numpy (Adagrad) on a
bounded sample of labelled rows; the threshold with the best balanced accuracy
is mapped to ``DECISION``. Whole texts are scored.

Defined results: a null text is an empty one; an empty text has no words and
zero statistics and gets the score of such a text; a null or missing
``n_chars`` counts as the text's own length; rows with null label or id are
kept out of training; a sample without both labels gives the score 0.5
everywhere; an empty table gives an empty result. Input columns named like an
output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._letters import around, by_score, fold, in_buckets, labelled_sample, letter_words, texts_to_bytes
from tessera.llm._text import IS_WORD, hash_spans, map_texts, spans

BITS = 14
BINS = 8
DECISION = 0.7


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_KINDS = [
    _table(bytes([*range(97, 123)])), _table(bytes([*range(65, 91)])), _table(b"0123456789"),
    _table(b"#*$%&<>"), _table(b"|"), _table(b"!?"), _table(b".,;:"), _table(b"\n"), _table(b" \t"),
    _table(bytes(range(128, 256))), _table(b"@/_{}[]()="),
]


def _distinct_share(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    counts = np.bincount(doc, minlength=n_docs)
    at = np.concatenate([[0], np.cumsum(counts)])
    h = hashes.copy()
    for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
        h[a:z].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[at[:-1][counts > 0]] = True
    return np.bincount(doc, weights=new, minlength=n_docs) / np.maximum(counts, 1)


def features(data: np.ndarray, offs: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, their bounds per text, and the statistics (texts x number)."""
    n_docs = len(offs) - 1
    size = np.diff(offs).astype(np.float64)
    full = np.flatnonzero(size)
    some = np.maximum(size, 1)
    stats = []
    for kind in _KINDS:
        total = np.zeros(n_docs)
        if len(full):
            total[full] = np.add.reduceat(kind[data].astype(np.int32), offs[full])
        stats.append(total / some)
    starts, ends, doc = spans(IS_WORD[data], offs)
    words = np.bincount(doc, minlength=n_docs)
    stats += [np.log1p(size), np.log1p(words), (size / np.maximum(words, 1)).clip(0, 50)]
    l_starts, l_ends, l_doc = spans(data != 10, offs)
    lines = np.bincount(l_doc, minlength=n_docs)
    stats.append(np.log1p(words / np.maximum(lines, 1)))
    stats.append(_distinct_share(hash_spans(data, l_starts, l_ends), l_doc, n_docs) * (lines > 0))
    low, starts, ends, doc = letter_words(data, offs)
    hashes = hash_spans(low, starts, ends)
    letters = np.bincount(doc, minlength=n_docs)
    stats.append(_distinct_share(hashes, doc, n_docs) * (letters > 0))
    stats.append((np.bincount(doc, weights=ends - starts, minlength=n_docs) / np.maximum(letters, 1)).clip(0, 50))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    stats.append(np.bincount(doc, weights=same, minlength=n_docs) / np.maximum(letters, 1))
    stats += [np.log1p(np.maximum(n_chars, 0)), (n_chars / some).clip(0, 4)]
    return in_buckets(hashes, BITS, 3), np.concatenate([[0], np.cumsum(letters)]), np.stack(stats, axis=1)


@dataclass
class FactorMachine:
    bias: float
    w: np.ndarray  # words, then bins of the statistics, then the statistics
    v: np.ndarray  # the same rows, one column for each factor
    mean: np.ndarray
    std: np.ndarray
    edges: np.ndarray  # (statistics, BINS - 1)
    threshold: float = 0.5

    def inputs(self, rows: np.ndarray, bounds: np.ndarray, stats: np.ndarray):
        """Feature rows and values, text after text, and their bounds."""
        n_docs, n_stats = stats.shape
        n = np.diff(bounds)
        z = ((stats - self.mean) / self.std).clip(-4, 4)
        bins = np.stack([np.searchsorted(self.edges[j], stats[:, j], "right") for j in range(n_stats)], axis=1)
        bins = (1 << BITS) + np.arange(n_stats) * BINS + bins
        dense = (1 << BITS) + n_stats * BINS + np.broadcast_to(np.arange(n_stats), (n_docs, n_stats))
        at = bounds + np.arange(n_docs + 1) * 2 * n_stats
        idx, x = np.empty(at[-1], np.int64), np.empty(at[-1], np.float32)
        word = np.ones(at[-1], bool)
        tail = (at[1:, None] - 2 * n_stats + np.arange(2 * n_stats)).ravel()
        word[tail] = False
        idx[word], x[word] = rows, np.repeat(1 / np.maximum(n, 1), n)
        idx[tail] = np.concatenate([bins, dense], axis=1).ravel()
        x[tail] = np.concatenate([np.full(z.shape, 0.3), 0.3 * z], axis=1).ravel()
        return idx, x, at

    def forward(self, idx, x, at):
        """Logits, and the sums of v x of each text; time linear in the features."""
        if len(at) < 2:
            return np.zeros(0), np.zeros((0, self.v.shape[1]))
        vx = self.v[idx] * x[:, None]
        sums = np.add.reduceat(vx, at[:-1], axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), at[:-1])
        linear = np.add.reduceat(self.w[idx] * x, at[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, data: np.ndarray, offs: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
        logits, _ = self.forward(*self.inputs(*features(data, offs, n_chars)))
        return around(1 / (1 + np.exp(-np.clip(logits, -30, 30))), self.threshold, DECISION)


def train(
    texts: list[str], labels: list[int], n_chars: list[int | None], *, factors: int = 6, epochs: int = 8,
    batch: int = 64, rate: float = 0.05, decay: float = 1e-5, seed: int = 4,
) -> FactorMachine:
    rng = np.random.default_rng(seed)
    data, offs = texts_to_bytes(texts)
    meta = np.array([len(t or "") if c is None else c for t, c in zip(texts, n_chars)], np.float64)
    rows, bounds, stats = features(data, offs, meta)
    n_stats = stats.shape[1]
    size = (1 << BITS) + n_stats * (BINS + 1)
    y = np.array(labels, np.float32)
    empty = not len(y)
    fm = FactorMachine(
        0.0, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, factors)).astype(np.float32),
        np.zeros(n_stats) if empty else stats.mean(axis=0), np.ones(n_stats) if empty else stats.std(axis=0) + 1e-6,
        np.zeros((n_stats, BINS - 1)) if empty else np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T,
    )
    if not 0 < y.sum() < len(y):
        fm.v[:] = 0
        fm.threshold = 0.7
        return fm
    idx, x, at = fm.inputs(rows, bounds, stats)
    own = rng.permutation(len(y))
    learn, check = own[len(own) // 5 :], own[: len(own) // 5]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    mem_w, mem_v, mem_b = np.full(size, 1e-2, np.float32), np.full(size, 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        rng.shuffle(learn)
        for i in range(0, len(learn), batch):
            chosen = learn[i : i + batch]
            n = at[chosen + 1] - at[chosen]
            local = np.concatenate([[0], np.cumsum(n)])
            pick = np.repeat(at[chosen] - local[:-1], n) + np.arange(local[-1])
            f, fx = idx[pick], x[pick]
            logits, sums = fm.forward(f, fx, local)
            p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            d = ((p - y[chosen]) * balance[chosen] / len(chosen)).astype(np.float32)
            gx = np.repeat(d, n) * fx
            gv = gx[:, None] * (np.repeat(sums, n, axis=0) - fm.v[f] * fx[:, None])
            used, inverse = np.unique(f, return_inverse=True)
            tw = np.bincount(inverse, weights=gx, minlength=len(used)).astype(np.float32) + decay * fm.w[used]
            tv = np.stack([np.bincount(inverse, weights=gv[:, j], minlength=len(used)) for j in range(factors)], 1)
            tv = tv.astype(np.float32) + decay * fm.v[used]
            mem_w[used] += tw * tw
            mem_v[used] += (tv * tv).mean(axis=1)
            fm.w[used] -= rate * tw / np.sqrt(mem_w[used])
            fm.v[used] -= rate * tv / np.sqrt(mem_v[used])[:, None]
            mem_b += float(d.sum()) ** 2
            fm.bias -= rate * float(d.sum()) / mem_b**0.5
    logits, _ = fm.forward(idx, x, at)
    p = 1 / (1 + np.exp(-np.clip(logits[check], -30, 30)))
    fm.threshold = by_score(p, y[check]) if 0 < y[check].sum() < len(check) else 0.5
    return fm


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, **settings) -> FactorMachine:
    """Fit on a bounded sample of each label of ``labels(doc_id, quality)``,
    with the rows of ``docs(doc_id, text, n_chars)``."""
    found = labelled_sample(docs.select("doc_id", "text", "n_chars"), labels.select("doc_id", "quality"), "quality", per_class)
    return train([r.text for r in found], [int(r.quality) for r in found], [r.n_chars for r in found], **settings)


def score_quality(docs: DataFrame, model: FactorMachine, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Add ``score`` and ``predicted`` to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of hashed rows

    def make():
        fm = shared.value

        def run(part, data, offs):
            own = np.diff(offs).astype(np.float64)
            at = part.schema.get_field_index(n_chars)
            if at >= 0:
                given = part.column(at).cast(pa.float64()).to_numpy(zero_copy_only=False)
                own = np.where(np.isnan(given), own, given)
            s = np.asarray(fm.scores(data, offs, own), np.float64)
            return [pa.array(s), pa.array((s >= DECISION).astype(np.int32))]

        return run

    return map_texts(docs, text, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], make)


def held_out(row_id: str | Column = "doc_id") -> Column:
    return fold(row_id, 4) == 2


def score_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Train on the labelled rows that aren't held out; score every document."""
    if "n_chars" not in docs.columns:
        docs = docs.withColumn("n_chars", F.lit(None).cast("long"))
    model = fit(docs, labels.where(~held_out()), **settings)
    rows = docs.select("doc_id", "text", "n_chars", held_out().alias("held_out"))
    return score_quality(rows, model).select("doc_id", "held_out", "score", "predicted")
