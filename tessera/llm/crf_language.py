"""Language identification by a linear-chain conditional random field.

Every word of a text gets a label, so code-switched text is labelled piece by
piece. The emission score of a word sums learned weights of its byte n-grams
(those that touch the word's border are its affixes) and of the word itself
(lexicon); learned transition weights tie neighbouring words. Forward-backward
gives each word's label probabilities; a text's score for a language is their
mean over the words.

The chain of a long text is cut into blocks of ``BLOCK`` words whose transfer
matrices are multiplied first, so all blocks of a slice of texts go through
numpy together: the number of steps depends on the block, not on the text.

The model is trained in numpy on a sample of labelled texts of every language
(``per_class`` texts a language, ``words_each`` consecutive words of each, from
a place fixed by a hash). With more than ``MANY`` languages none is left out:
each has a smaller share (``MANY * per_class`` texts in all, but ``LEAST`` a
language), tables of more than ``WEIGHTS`` weights get fewer hashed rows,
and chains are walked word by word, as transfer matrices would cost the cube of
the languages; slices and parts of texts shrink as the languages grow. Training
chains join stretches of several texts, so that transitions between languages
are seen. Everything that is predicted uses whole texts.

Defined results: null text, or no letter: ``und`` with score 0; a training
sample without any label: every text is ``und``; null labels and ids are kept
out of training and change nothing else; very long texts are cut into parts of
``PART`` words (fewer with more than ``MANY`` languages) between which only the chain's link is dropped; an empty table
gives an empty result. Input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._letters import fold, letter_words, texts_to_bytes
from tessera.llm._text import SLICE_BYTES, hash_spans, map_texts, release_memory

BITS = 16
BLOCK = 64
PART = 1 << 18
MANY = 64
LEAST = 16
WEIGHTS = 1 << 24
UNKNOWN = "und"
_HAS_LETTER = re.compile(r"[^\W\d_]")
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def word_features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, bits: int = BITS):
    """Features of words (rows of 2**bits): n-gram rows and the word each belongs to, by length
    of the n-grams, and the lexicon row of each word."""
    n = len(starts)
    if not n:
        return [], [], np.zeros(0, np.int64)
    # words with one border byte on either side
    length = ends - starts
    at = np.concatenate([[0], np.cumsum(length + 2)])
    s = np.zeros(at[-1], np.uint32)
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = False
    inner[at[1:] - 1] = False
    word = np.repeat(np.arange(n), length + 2)
    s[inner] = low[np.repeat(starts - (at[:-1] + 1), length + 2)[inner] + np.flatnonzero(inner)]
    # an n-gram may start at any byte from which it stays in its word
    grams, owners = [], []
    code = s.astype(np.uint64)
    for k in (2, 3, 4):
        code = (code[:-1] << np.uint64(8)) | s[k - 1 :].astype(np.uint64)
        whole = word[: len(code)] == word[k - 1 :]
        grams.append(((code[whole] * _M[k - 2]) >> np.uint64(64 - bits)).astype(np.int32))
        owners.append(word[: len(code)][whole])
    return grams, owners, (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _words(data: np.ndarray, offs: np.ndarray):
    low, starts, ends, doc = letter_words(data, offs)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offs) - 1))])
    return low, starts, ends, hash_spans(low, starts, ends), bounds


@dataclass
class Crf:
    labels: list[str]
    grams: np.ndarray  # (2**bits, labels)
    lexicon: np.ndarray  # (2**bits, labels)
    transitions: np.ndarray  # (labels, labels)

    def emissions(self, features) -> np.ndarray:
        grams, owners, lexicon = features
        out = self.lexicon[lexicon].astype(np.float32)
        for g, o in zip(grams, owners):
            # owners ascend; a word of one letter has no n-gram of four
            heads = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]])) if len(o) else np.zeros(0, np.int64)
            if len(heads):
                out[o[heads]] += np.add.reduceat(self.grams[g], heads, axis=0)
        return out

    def posteriors(self, emissions: np.ndarray, bounds: np.ndarray, want_pairs: bool = False):
        """Label probabilities of each word; chains by ``bounds``. With
        ``want_pairs`` also the expected number of each transition."""
        n_labels = len(self.labels)
        n = np.diff(bounds)
        chains = np.flatnonzero(n)
        block = BLOCK if n_labels <= MANY else max(BLOCK, int(n.max(initial=0)))
        blocks = -(-n[chains] // block)
        first = np.concatenate([[0], np.cumsum(blocks)])
        total = int(first[-1])
        out = np.zeros((len(emissions), n_labels), np.float32)
        if not total:
            return (out, np.zeros((n_labels, n_labels))) if want_pairs else out
        chain = np.repeat(np.arange(len(chains)), blocks)
        begin = bounds[chains][chain] + (np.arange(total) - first[chain]) * block
        size = np.minimum(bounds[chains + 1][chain] - begin, block)
        order = np.argsort(-size, kind="stable")  # step t concerns a prefix of the blocks
        begin, size = begin[order], size[order]
        live = np.searchsorted(-size, -np.arange(1, block + 1), "right")
        e = np.exp(emissions - emissions.max(axis=1, keepdims=True))
        a = np.exp(self.transitions).astype(np.float32)
        # transfer matrix of each block, where a chain has several
        linked = int(blocks.max()) > 1
        m = np.broadcast_to(np.eye(n_labels, dtype=np.float32), (total if linked else 0, n_labels, n_labels)).copy()
        for t in range(block if linked else 0):
            k = live[t]
            if not k:
                break
            x = (m[:k] @ a) * e[begin[:k] + t][:, None, :]
            m[:k] = x / x.sum(axis=(1, 2), keepdims=True)
        rank = np.empty(total, np.int64)
        rank[order] = np.arange(total)
        # messages into each block from the left and from the right, chain by chain in step
        left = np.full((total, n_labels), 1 / n_labels, np.float32)
        right = np.full((total, n_labels), 1 / n_labels, np.float32)
        by_blocks = np.argsort(-blocks, kind="stable")
        starts, counts = first[:-1][by_blocks], blocks[by_blocks]
        alive = np.searchsorted(-counts, -np.arange(1, int(counts[0]) + 1), "right")
        for j in range(1, len(alive)):
            b = starts[: alive[j]] + j
            x = np.einsum("ci,cij->cj", left[rank[b - 1]], m[rank[b - 1]])
            left[rank[b]] = x / x.sum(axis=1, keepdims=True)
        for j in range(1, len(alive)):
            c = slice(0, alive[j])
            b = starts[c] + counts[c] - 1 - j
            x = np.einsum("cij,cj->ci", m[rank[b + 1]], right[rank[b + 1]])
            right[rank[b]] = x / x.sum(axis=1, keepdims=True)
        # inside the blocks; ``out`` holds the forward messages first
        now = left
        for t in range(block):
            k = live[t]
            if not k:
                break
            x = (now[:k] @ a) * e[begin[:k] + t]
            now = x / x.sum(axis=1, keepdims=True)
            out[begin[:k] + t] = now
        pairs = np.zeros((n_labels, n_labels))
        beta = right.copy()
        for t in range(block - 1, -1, -1):
            k = live[t]
            if not k:
                continue
            x = out[begin[:k] + t] * beta[:k]
            out[begin[:k] + t] = x / x.sum(axis=1, keepdims=True)
            behind = e[begin[:k] + t] * beta[:k]
            if want_pairs:
                before = out[begin[:k] + t - 1] if t else left[:k]
                whole = ((before @ a) * behind).sum(axis=1, keepdims=True)
                pairs += a * ((before / whole).T @ behind)
            x = behind @ a.T
            beta[:k] = x / x.sum(axis=1, keepdims=True)
        return (out, pairs) if want_pairs else out

    def label_parts(self, data: np.ndarray, offs: np.ndarray):
        """Bounds of the words of all texts, and an iterator of (first word,
        label probabilities of the words from there)."""
        low, starts, ends, hashes, bounds = _words(data, offs)
        most = PART if len(self.labels) <= MANY else max(1024, PART * MANY // len(self.labels))
        bits = len(self.lexicon).bit_length() - 1

        def parts():
            at = 0  # texts are taken together up to ``most`` words
            cuts = np.unique(np.concatenate([bounds, *[np.arange(a, b, most) for a, b in zip(bounds[:-1], bounds[1:]) if b - a > most]]))
            while at < len(cuts) - 1:
                stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + most, "right")) - 1)
                a, b = cuts[at], cuts[stop]
                known, first, which = np.unique(hashes[a:b], return_index=True, return_inverse=True)
                emissions = self.emissions(word_features(low, starts[a:b][first], ends[a:b][first], known, bits))[which]
                yield int(a), self.posteriors(emissions, cuts[at : stop + 1] - a)
                at = stop

        return bounds, parts()

    def slice_bytes(self) -> int:
        """Bytes of text that are labelled together."""
        return SLICE_BYTES if len(self.labels) <= MANY else max(1 << 16, SLICE_BYTES * MANY // len(self.labels))


def train(
    texts: list[str], labels: list[str], *, words_each: int = 120, epochs: int = 4, batch: int = 256,
    rate: float = 0.15, decay: float = 1e-6, seed: int = 5,
) -> Crf:
    """Fit by gradient steps (Adagrad) on the log-likelihood of chains that
    join stretches of 5 to 40 words of different texts."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    cut = []
    for text in texts:  # consecutive words from a place by chance; white space is enough to cut at
        words = text.split()
        a = int(rng.integers(0, max(1, len(words) - words_each + 1)))
        cut.append(" ".join(words[a : a + words_each]))
    data, offs = texts_to_bytes(cut)
    low, starts, ends, hashes, bounds = _words(data, offs)
    bits = min(BITS, max(8, (WEIGHTS // max(1, len(names))).bit_length() - 1))
    batch = max(16, min(batch, batch * 256 // max(1, len(names))))
    grams, owners, lexicon = word_features(low, starts, ends, hashes, bits)
    known = {v: i for i, v in enumerate(names)}
    y_of = np.array([known[v] for v in labels], np.int64)
    gram_at = [np.searchsorted(o, np.arange(len(lexicon) + 1)) for o in owners]
    stretches = []
    for i in range(len(texts) if len(lexicon) else 0):
        a, b = int(bounds[i]), int(bounds[i + 1])
        while a < b:
            n = int(rng.integers(5, 41))
            stretches.append((a, min(b, a + n), int(y_of[i])))
            a += n
    model = Crf(names, np.zeros((1 << bits, len(names)), np.float32), np.zeros((1 << bits, len(names)), np.float32), np.zeros((len(names), len(names)), np.float32))
    seen = [np.full_like(x, 1e-2) for x in (model.grams, model.lexicon, model.transitions)]

    def step(weights, memory, rows, gradient, scale):
        rows, inverse = np.unique(rows, return_inverse=True)
        total = np.stack([np.bincount(inverse, weights=gradient[:, j], minlength=len(rows)) for j in range(gradient.shape[1])], 1)
        total = (total / scale).astype(np.float32) - decay * weights[rows]
        memory[rows] += total * total
        weights[rows] += rate * total / np.sqrt(memory[rows])

    for _ in range(epochs if len(names) > 1 else 0):
        shuffled = rng.permutation(len(stretches))
        for i in range(0, len(shuffled), batch):
            own = [stretches[j] for j in shuffled[i : i + batch]]
            words = np.concatenate([np.arange(a, b) for a, b, _ in own])
            y = np.concatenate([np.full(b - a, v) for a, b, v in own])
            ends = np.cumsum([b - a for a, b, _ in own])
            chain = np.concatenate([[0], ends[3::4], ends[-1:]]) if len(ends) % 4 else np.concatenate([[0], ends[3::4]])
            g, o = [], []
            for k in range(3):
                n = gram_at[k][words + 1] - gram_at[k][words]
                pick = np.repeat(gram_at[k][words] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                g.append(grams[k][pick])
                o.append(np.repeat(np.arange(len(words)), n))
            e = model.emissions((g, o, lexicon[words]))
            p, pairs = model.posteriors(e, np.unique(chain), want_pairs=True)
            gradient = -p
            gradient[np.arange(len(y)), y] += 1
            scale = float(len(own))
            for k in range(3):
                step(model.grams, seen[0], g[k], gradient[o[k]], scale)
            step(model.lexicon, seen[1], lexicon[words], gradient, scale)
            inside = np.ones(len(y), bool)
            inside[np.unique(chain)[:-1]] = False
            observed = np.zeros((len(names), len(names)))
            np.add.at(observed, (y[:-1][inside[1:]], y[1:][inside[1:]]), 1)
            # the first word of a chain has a uniform left message; its expected transition counts as observed
            observed += pairs * (~inside).sum() / max(pairs.sum(), 1)
            d = ((observed - pairs) / scale).astype(np.float32)
            seen[2] += d * d
            model.transitions += rate * d / np.sqrt(seen[2])
    return model


def language_sample(rows: DataFrame, per_class: int) -> DataFrame:
    """About ``per_class`` rows of every language of ``rows(doc_id, text,
    lang)``, fewer with more than ``MANY`` languages, by a hash of the id."""
    rows = rows.where("lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).collect()  # a row for each language, as the model has
    share = min(per_class, max(LEAST, MANY * per_class // max(1, len(counts))))
    sizes = rows.sparkSession.createDataFrame(counts, T.StructType([rows.schema["lang"], T.StructField("_n", T.LongType())]))
    part = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("fit")), 11) / F.lit(float(1 << 53))
    chosen = rows.join(F.broadcast(sizes), "lang").where(part * F.col("_n") < share).drop("_n")
    # repeated ids can't make the sample larger than a fixed number of rows
    return chosen.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(2 * share * max(1, len(counts)))


def fit(rows: DataFrame, per_class: int = 1000, **settings) -> Crf:
    """Fit on ``rows(doc_id, text, lang)``: a bounded sample of each language."""
    rows = rows.where("text is not null").select("doc_id", "text", "lang")
    found = language_sample(rows, per_class).collect()
    texts, labels = [r.text for r in found], [r.lang for r in found]
    del found
    model = train(texts, labels, **settings)
    del texts
    release_memory()  # the driver lives on; training took more than the model holds
    return model


def identify(docs: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS rows of weights per language

    def make():
        crf = shared.value

        def run(part, data, offs):
            column = part.column(part.schema.get_field_index(text))
            n = len(column)
            label, score = [UNKNOWN] * n, np.zeros(n)
            if crf.labels:
                bounds, parts = crf.label_parts(data, offs)
                words = np.diff(bounds)
                total = np.zeros((n, len(crf.labels)))
                for a, p in parts:
                    own = np.searchsorted(bounds, np.arange(a, a + len(p)), "right") - 1
                    heads = np.flatnonzero(np.diff(own, prepend=-1))
                    total[own[heads]] += np.add.reduceat(p, heads, axis=0, dtype=np.float64)
                for i in np.flatnonzero(words):
                    if _HAS_LETTER.search(column[i].as_py()):
                        best = int(np.argmax(total[i]))
                        label[i], score[i] = crf.labels[best], min(1.0, total[i, best] / words[i])
            return [pa.array(label, pa.string()), pa.array(score, pa.float64())]

        return run

    return map_texts(docs, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make, model.slice_bytes())


def label_spans(docs: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """Add ``word_labels``: the most probable label of each letter word."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        crf = shared.value

        def run(part, data, offs):
            bounds, parts = crf.label_parts(data, offs)
            names = np.array(crf.labels or [UNKNOWN], object)
            best = [p.argmax(axis=1) for _, p in parts if p.size]
            flat = pa.array(names[np.concatenate(best)] if best else [], pa.string())
            return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)]

        return run

    return map_texts(docs, text, [T.StructField("word_labels", T.ArrayType(T.StringType()))], make, model.slice_bytes())


def held_out(row_id: str | Column = "doc_id") -> Column:
    return fold(row_id, 3) == 1


def identify_documents(docs: DataFrame, **settings) -> DataFrame:
    """Train on the rows of ``docs`` that aren't held out; predict all."""
    model = fit(docs.where(~held_out()), **settings)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
