"""Toxicity by a convolutional text classifier.

The embedding of a word is the sum of the rows that the word and its first
bytes (``PREFIXES``) hash to, so inflected forms share what their stem has
learned; filters of several widths slide over the words, and the largest
response of each filter in the text (max pooling) goes through a logistic
layer. The first dimension starts as the log-odds of a row among the labels.
Because pooling keeps one place for each filter, a single phrase marks a long
text, and the gradient of a text touches one window for each filter only.

All labelled rows train. They are dealt by hash to shards of about
``SHARD_ROWS`` rows or ``SHARD_BYTES`` bytes, a partition each, and the counts
that the model starts from are summed over them. In each epoch every shard takes
the common parameters, goes through its rows with Adagrad, and Spark averages
the changes (an embedding's over the shards that changed it, as whole numbers,
so that their order doesn't matter). The driver holds the parameters, whose
number is fixed, and never a row. Scoring reads whole texts, and each different
word of a slice is multiplied with the filters once.

The threshold is calibrated for each language: a small table of hashed words,
counted on all labelled rows, guesses a text's language from its words (the
``lang`` column is a target there, never an input of a score); for each language
the threshold with the best balanced accuracy is found on the fifth of the
labelled rows (by a hash of the id) that the other parameters don't learn from, pulled towards the
common one where few texts speak for it, and the score is stretched so that the
threshold lies at ``DECISION``.

Defined results: a null or empty text, or one without letters, has the pooled
responses of no window (zero) and so a constant low score; rows with null label
or id are kept out of training; labels that aren't both there give the score 0
everywhere; an empty table gives an empty result. Input columns named like an
output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._letters import around, fold, in_buckets, known_labels, letter_words
from tessera.llm._text import arrow_map, hash_spans, map_texts, text_slices

BITS = 16
LANG_BITS = 15
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)
DECISION = 0.7
#: labelled rows, and bytes of their texts, of one task of an epoch
SHARD_ROWS, SHARD_BYTES = 4096, 16 << 20
#: labelled ids that are broadcast; more are joined by a shuffle
MOST_BROADCAST = 1_000_000
#: whole numbers in one, of changes that are summed
UNIT = float(1 << 32)
#: bins of the thresholds for one unit of the log-odds
BINS = 64


def word_rows(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Embedding rows of each word: the word's, and those of its prefixes."""
    spans_of = [ends, *[np.minimum(ends, starts + k) for k in PREFIXES]]
    return np.stack([in_buckets(hash_spans(low, starts, z), BITS, i) for i, z in enumerate(spans_of)], axis=1)


@dataclass
class ConvNet:
    embeddings: np.ndarray  # (2**BITS, dims)
    filters: list[np.ndarray]  # per width: (width, dims, n)
    biases: list[np.ndarray]
    weights: np.ndarray  # all filters
    bias: float
    languages: list[str] = field(default_factory=list)
    words: np.ndarray | None = None  # (2**LANG_BITS, languages): log-probabilities
    thresholds: np.ndarray | None = None  # per language, the last one for all

    def pooled(self, rows: np.ndarray, which: np.ndarray, bounds: np.ndarray, places: bool = False):
        """Largest response of each filter in each text (0 where none is
        positive), and the window's first word. ``rows`` has the embedding
        rows of the different words, ``which`` the word at each place."""
        n_texts, n = len(bounds) - 1, len(which)
        full = np.flatnonzero(np.diff(bounds))
        x = self.embeddings[rows].sum(axis=1)
        out, spots = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.biases):
            tables = [np.ascontiguousarray((x @ f[j]).T) for j in range(w)]
            beyond = []  # windows that leave their text
            for j in range(1, min(w, n)):
                at = (bounds[1:-1, None] - np.arange(1, j + 1)).ravel()
                beyond.append(at[(at >= 0) & (at < n - j)])
            best = np.zeros((n_texts, f.shape[2]), np.float32)
            at = np.zeros((n_texts, f.shape[2]), np.int64)
            for k in range(f.shape[2]):
                r = tables[0][k][which]
                for j, out_at in enumerate(beyond, 1):
                    nxt = tables[j][k][which[j:]]
                    nxt[out_at] = 0
                    r[: n - j] += nxt
                if len(full):
                    best[full, k] = np.maximum.reduceat(r, bounds[full]) + b[k]
                if places:
                    for i in full:
                        at[i, k] = bounds[i] + np.argmax(r[bounds[i] : bounds[i + 1]])
            spots.append(at)
            out.append(np.maximum(best, 0))
        return (out, spots) if places else out

    def probabilities(self, rows: np.ndarray, which: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        h = np.concatenate(self.pooled(rows, which, bounds), axis=1)
        return 1 / (1 + np.exp(-np.clip(h @ self.weights + self.bias, -30, 30)))

    def language(self, lang_rows: np.ndarray, which: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of each text's likeliest language; the count of languages if it has no word."""
        n = np.diff(bounds)
        out = np.full(len(n), len(self.languages))
        full = np.flatnonzero(n)
        if len(full) and self.languages:
            total = [np.add.reduceat(self.words[lang_rows, j][which], bounds[full]) for j in range(len(self.languages))]
            out[full] = np.argmax(total, axis=0)
        return out

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        rows, lang_rows, which, bounds = _different_words(data, offs)
        p = self.probabilities(rows, which, bounds)
        return around(p, self.thresholds[self.language(lang_rows, which, bounds)], DECISION)


def _different_words(data: np.ndarray, offs: np.ndarray):
    low, starts, ends, doc = letter_words(data, offs)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offs) - 1))])
    hashes = hash_spans(low, starts, ends)
    known, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return word_rows(low, starts[first], ends[first]), in_buckets(known, LANG_BITS, 9), which, bounds


def _start(dims: int, filters: int, seed: int) -> ConvNet:
    rng = np.random.default_rng(seed)
    return ConvNet(
        rng.normal(0, 0.05, (1 << BITS, dims)).astype(np.float32),
        [rng.normal(0, 0.1, (w, dims, filters)).astype(np.float32) for w in WIDTHS],
        [np.zeros(filters, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, filters * len(WIDTHS)).astype(np.float32), -2.0,
    )


def _count_rows(dealt: DataFrame, names: list[str]) -> DataFrame:
    """(kind, key, n) of all labelled rows: words of each language (kind: its
    number) in hashed rows, and learning texts of label 0 (-2) or 1 (-1) that
    have an embedding row."""
    number = {v: j for j, v in enumerate(names)}

    def run(batches):
        counts = {}
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text"):
                rows, lang_rows, which, bounds = _different_words(data, offs)
                part = batch.slice(start, stop - start)
                lang, toxic, learn = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("lang", "toxic", "learn"))
                for i in range(stop - start):
                    own = which[bounds[i] : bounds[i + 1]]
                    if lang[i] is not None:
                        j = number[lang[i]]
                        if j not in counts:
                            counts[j] = np.zeros(1 << LANG_BITS, np.int64)
                        counts[j] += np.bincount(lang_rows[own], minlength=1 << LANG_BITS)
                    if learn[i]:
                        counts.setdefault(toxic[i] - 2, np.zeros(1 << BITS, np.int64))[np.unique(rows[own])] += 1
        for kind, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at])], names=["kind", "key", "n"])

    return arrow_map(dealt, run, "kind int, key int, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _dense(net: ConvNet, mem: list) -> list[np.ndarray]:
    """All parameters and Adagrad sums but the embeddings'; biases as arrays."""
    return [*net.filters, *net.biases, net.weights, *mem[1:]]


def _epoch(net: ConvNet, mem: list, rows, which, bounds, y, balance, rng, batch: int, rate: float, longest: int):
    """Go once through all texts with Adagrad (a step reads a stretch of at most
    ``longest`` words of each); changes ``net`` and ``mem``, the sums of squares of
    embeddings, filters, biases, weights and the last bias."""
    filters = net.filters[0].shape[2]
    mem_e, mem_f, mem_b, mem_w, mem_c = mem[0], mem[1:4], mem[4:7], mem[7], mem[8]
    learn = rng.permutation(len(y))
    for i in range(0, len(learn), batch):
        chosen = learn[i : i + batch]
        parts = []
        for t in chosen:
            a, z = int(bounds[t]), int(bounds[t + 1])
            if z - a > longest:
                a += int(rng.integers(0, z - a - longest))
                z = a + longest
            parts.append(which[a:z])
        local = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        used, place = np.unique(np.concatenate(parts), return_inverse=True)
        pooled, spots = net.pooled(rows[used], place, local, places=True)
        h = np.concatenate(pooled, axis=1)
        p = 1 / (1 + np.exp(-np.clip(h @ net.weights + net.bias, -30, 30)))
        d = ((p - y[chosen]) * balance[chosen] / len(chosen)).astype(np.float32)
        dh = d[:, None] * net.weights[None] * (h > 0)
        g = h.T @ d + 1e-4 * net.weights
        mem_w += g * g
        net.weights -= rate * g / np.sqrt(mem_w)
        mem_c += float(d.sum()) ** 2
        net.bias -= rate * float(d.sum()) / float(mem_c[0]) ** 0.5
        touched, change = [], []
        for k, w in enumerate(WIDTHS):
            t, f = np.nonzero(dh[:, k * filters : (k + 1) * filters])
            if not len(t):
                continue
            first, amount = spots[k][t, f], dh[t, k * filters + f]
            gf = np.zeros_like(net.filters[k])
            for j in range(w):
                inside = first + j < local[t + 1]
                word = rows[used[place[np.minimum(first + j, len(place) - 1)]]][inside]
                x = net.embeddings[word].sum(axis=1)
                np.add.at(gf[j].T, f[inside], amount[inside, None] * x)
                touched.append(word.ravel())
                change.append(np.repeat(amount[inside, None] * net.filters[k][j].T[f[inside]], word.shape[1], axis=0))
            gb = np.bincount(f, weights=amount, minlength=filters).astype(np.float32)
            mem_f[k] += gf * gf
            net.filters[k] -= rate * gf / np.sqrt(mem_f[k])
            mem_b[k] += gb * gb
            net.biases[k] -= rate * gb / np.sqrt(mem_b[k])
        if touched:
            word, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(word), net.embeddings.shape[1]), np.float32)
            np.add.at(total, inverse, np.concatenate(change))
            mem_e[word] += (total * total).sum(axis=1)
            net.embeddings[word] -= rate * total / np.sqrt(mem_e[word])[:, None]


def _held(batches):
    """(bytes, offsets, labels) of a shard's texts; in several parts if they have
    more than twice ``SHARD_BYTES`` (an id that many rows share)."""
    held, size = [], 0
    for batch in batches:
        toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy()
        for start, stop, data, offs in text_slices(batch, "text"):
            held.append((data.copy(), np.diff(offs), toxic[start:stop]))
            size += len(data)
            if size > 2 * SHARD_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    data, n, toxic = (np.concatenate(x) for x in zip(*held))
    return data, np.concatenate([[0], np.cumsum(n)]), toxic.astype(np.float32)


def _shard_changes(learn: DataFrame, net: ConvNet, mem: list, n0: int, n1: int, seed: list[int], **steps) -> DataFrame:
    """(row, c0, c1, ..., shards): the sums of what an epoch of each shard changes, in
    units of 1 / ``UNIT``, and the number of shards that changed it. Rows are
    embeddings with their Adagrad sum, then the other parameters in a row."""
    width = net.embeddings.shape[1] + 1
    shared = learn.sparkSession.sparkContext.broadcast((net, mem))  # of fixed size
    names = [f"c{i}" for i in range(width)]

    def run(batches):
        old, old_mem = shared.value
        own = ConvNet(old.embeddings.copy(), [f.copy() for f in old.filters], [b.copy() for b in old.biases], old.weights.copy(), old.bias)
        own_mem = [m.copy() for m in old_mem]
        rng = np.random.default_rng([*seed, TaskContext.get().partitionId()])
        texts = 0
        for data, offs, y in _held(batches):
            texts += len(y)
            rows, _, which, bounds = _different_words(data, offs)
            balance = np.where(y == 1, 0.5 * (n0 + n1) / n1, 0.5 * (n0 + n1) / n0).astype(np.float32)
            _epoch(own, own_mem, rows, which, bounds, y, balance, rng, **steps)
        if not texts:
            return
        change = np.column_stack([own.embeddings.astype(np.float64) - old.embeddings, own_mem[0].astype(np.float64) - old_mem[0]])
        at = np.flatnonzero((change != 0).any(axis=1))
        flat = [(a.astype(np.float64) - b).ravel() for a, b in zip(_dense(own, own_mem), _dense(old, old_mem))]
        flat = np.concatenate([*flat, [own.bias - old.bias]])
        flat = np.append(flat, np.zeros(-len(flat) % width)).reshape(-1, width)
        key = np.concatenate([at, (1 << BITS) + np.arange(len(flat))]).astype(np.int32)
        units = np.rint(np.concatenate([change[at], flat]) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(np.ascontiguousarray(units[:, i])) for i in range(width))], names=["row", *names])

    changes = arrow_map(learn, run, ", ".join(["row int", *(f"{c} long" for c in names)]))
    return changes.groupBy("row").agg(*[F.sum(c).alias(c) for c in names], F.count(F.lit(1)).alias("shards"))


def _step(net: ConvNet, mem: list, changes) -> None:
    """Add the averaged changes (an Arrow table of fixed size)."""
    width, row = net.embeddings.shape[1] + 1, changes["row"].to_numpy()
    mean = np.column_stack([changes[f"c{i}"].to_numpy() for i in range(width)]) / UNIT / changes["shards"].to_numpy()[:, None]
    own = row < 1 << BITS
    net.embeddings[row[own]] += mean[own, :-1].astype(np.float32)
    mem[0][row[own]] += mean[own, -1].astype(np.float32)
    flat = mean[~own][np.argsort(row[~own])].ravel()
    at = 0
    for x in _dense(net, mem):
        x += flat[at : at + x.size].reshape(x.shape).astype(x.dtype)
        at += x.size
    if len(flat):
        net.bias += float(flat[at])


def _best_cut(bins: list) -> float:
    """The threshold with the best balanced accuracy between bins (pos, neg, low,
    high), from the highest down."""
    pos, neg, low, high = (np.array(v, float) for v in zip(*bins))
    tp, fp = np.cumsum(pos), np.cumsum(neg)
    best = int(np.argmax(tp / max(tp[-1], 1) - fp / max(fp[-1], 1)))
    return float((low[best] + (high[best + 1] if best + 1 < len(low) else 0.0)) / 2)


def _check_bins(check: DataFrame, net: ConvNet) -> list:
    """(lang, bin, pos, neg, low, high): labels and probabilities of the check
    rows by guessed language and bin of the log-odds, the highest first; bins are
    a fixed number for each language."""
    shared = check.sparkSession.sparkContext.broadcast(net)

    def make():
        def run(part, data, offs):
            rows, lang_rows, which, bounds = _different_words(data, offs)
            p = shared.value.probabilities(rows, which, bounds).astype(np.float64)
            odds = np.log(np.maximum(p, 1e-13)) - np.log(np.maximum(1 - p, 1e-13))
            return [pa.array(shared.value.language(lang_rows, which, bounds).astype(np.int32)), pa.array(np.floor(odds * BINS).astype(np.int32)), pa.array(p)]

        return run

    fields = [T.StructField("guess", T.IntegerType()), T.StructField("bin", T.IntegerType()), T.StructField("p", T.DoubleType())]
    rows = map_texts(check.select("text", "toxic"), "text", fields, make).groupBy("guess", "bin")
    rows = rows.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"), F.min("p").alias("low"), F.max("p").alias("high"))
    return sorted(rows.collect(), key=lambda r: (-r.bin, r.guess))


def _thresholds(bins: list, n_languages: int) -> np.ndarray:
    by_bin: dict = {}
    for r in bins:
        x = by_bin.setdefault(r.bin, [0, 0, 1.0, 0.0])
        by_bin[r.bin] = [x[0] + r.pos, x[1] + r.neg, min(x[2], r.low), max(x[3], r.high)]
    every = list(by_bin.values())
    both = every and sum(x[0] for x in every) and sum(x[1] for x in every)
    common = _best_cut(every) if both else 0.5
    out = np.full(n_languages + 1, common)
    for j in range(n_languages):
        own = [(r.pos, r.neg, r.low, r.high) for r in bins if r.guess == j]
        few = min(sum(x[0] for x in own), sum(x[1] for x in own))
        if few:
            out[j] = (few * _best_cut(own) + 10 * common) / (few + 10)
    return out


def _dealt(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled rows (lang, text, toxic, learn) in partitions of a shard each."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("text is not null")
    known = known_labels(labels, "toxic")
    size = rows.select("doc_id", F.octet_length("text").alias("b")).join(known, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    shards = max(1, -(-size.n // SHARD_ROWS), -(-(size.b or 0) // SHARD_BYTES))
    # a bounded number of ids is broadcast, so that texts without a label aren't shuffled
    rows = rows.join(F.broadcast(known) if known.count() <= MOST_BROADCAST else known, "doc_id")
    rows = rows.repartition(shards, "doc_id", "text").sortWithinPartitions(F.xxhash64("doc_id", "text"), "doc_id", "lang")
    learn = F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(5)) > 0
    return rows.select("lang", "text", F.col("toxic").cast("int").alias("toxic"), learn.alias("learn")).checkpoint(eager=True)


def fit(
    docs: DataFrame, labels: DataFrame, *, dims: int = 8, filters: int = 6, epochs: int = 4,
    batch: int = 64, rate: float = 0.03, longest: int = 4096, seed: int = 3,
) -> ConvNet:
    """Fit on all rows of ``labels(doc_id, toxic)`` that have a text in
    ``docs(doc_id, text, lang)``."""
    dealt = _dealt(docs, labels)
    sizes = dealt.groupBy("lang", "toxic", "learn").agg(F.count(F.lit(1)).alias("n")).collect()  # a few rows a language
    net = _start(dims, filters, seed)
    net.languages = names = sorted({r.lang for r in sizes} - {None})
    net.thresholds = np.full(len(names) + 1, 1.0)
    n_all = [sum(r.n for r in sizes if r.toxic == v) for v in (0, 1)]
    n0, n1 = (sum(r.n for r in sizes if r.toxic == v and r.learn) for v in (0, 1))
    if not (n0 and n1):  # a fifth can't be left out
        dealt = dealt.withColumn("check", F.lit(True)).withColumn("learn", F.lit(True))
        n0, n1 = n_all
    else:
        dealt = dealt.withColumn("check", ~F.col("learn"))
    found = _count_rows(dealt, names).toArrow()  # hashed rows of both labels and each language
    kind, key, n = (found[c].to_numpy() for c in ("kind", "key", "n"))
    counts = np.ones((1 << LANG_BITS, max(len(names), 1)))
    counts[key[kind >= 0], kind[kind >= 0]] += n[kind >= 0]
    net.words = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    if not (n0 and n1):
        net.bias = -30.0
        return net
    seen = np.zeros((2, 1 << BITS))  # texts of each label that have a row
    seen[kind[kind < 0] + 2, key[kind < 0]] = n[kind < 0]
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    sure = seen.sum(axis=0)
    net.embeddings[:, 0] = odds * sure / (sure + 3)  # rows of few texts say little
    for f in net.filters:
        f[0, 0, 0] = 0.7
    net.weights[[k * filters for k in range(len(WIDTHS))]] = 0.5
    like = [*net.filters, *net.biases, net.weights, np.zeros(1, np.float32)]
    mem = [np.full(1 << BITS, 1e-2, np.float32), *(np.full_like(x, 1e-2) for x in like)]
    learn = dealt.where("learn").select("text", "toxic")
    for e in range(epochs):
        changes = _shard_changes(learn, net, mem, n0, n1, [seed, e], batch=batch, rate=rate, longest=longest)
        _step(net, mem, changes.toArrow())
    net.thresholds = _thresholds(_check_bins(dealt.where("check"), net), len(names))
    return net


def score_texts(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` by a model with ``scores(bytes, offsets)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of hashed rows

    def make():
        net = shared.value

        def run(part, data, offs):
            s = np.asarray(net.scores(data, offs), np.float64)
            return [pa.array(s), pa.array((s >= DECISION).astype(np.int32))]

        return run

    return map_texts(docs, text, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], make)


def held_out(row_id: str | Column = "doc_id") -> Column:
    return fold(row_id, 3) == 1


def score_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Train on the labelled rows that aren't held out; score every document."""
    model = fit(docs, labels.where(~held_out()), **settings)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return score_texts(rows, model).select("doc_id", "held_out", "score", "predicted")
