"""Hashed letter words, the input of the text models of this subpackage.

A word is a run of letters (ASCII letters and non-ASCII bytes), lower-cased in
ASCII, and known to the models by its 64-bit hash only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import IS_LETTER, LOWER, hash_spans, spans


def letter_words(data: np.ndarray, offs: np.ndarray):
    """Lower-cased bytes, and starts, ends and row numbers of the words."""
    starts, ends, doc = spans(IS_LETTER[data], offs)
    return LOWER[data], starts, ends, doc


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and where each text's words start (n + 1)."""
    low, starts, ends, doc = letter_words(data, offs)
    counts = np.bincount(doc, minlength=len(offs) - 1)
    return hash_spans(low, starts, ends), np.concatenate([[0], np.cumsum(counts)])


def in_buckets(h: np.ndarray, bits: int, salt: int = 0) -> np.ndarray:
    """Model rows (2**bits of them) of hashes."""
    return ((h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(64 - bits)).astype(np.int64)


def texts_to_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The (bytes, offsets) form of a list of texts (null: empty)."""
    raw = [(t or "").encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offs


def fold(row_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id as an empty text)."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % n


def class_sample(rows: DataFrame, label: str, per_class: int, max_classes: int) -> DataFrame:
    """About ``per_class`` rows of each value of ``label``, which has at most
    ``max_classes`` values, chosen by a hash of
    the id (``doc_id``), so by the same rule on every run. Only a model's fit
    uses this; it has at most ``2 * per_class * max_classes`` rows."""
    rows = rows.where(F.col(label).isNotNull())
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), label).limit(max_classes)
    part = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("fit")), 11) / F.lit(float(1 << 53))
    chosen = rows.join(F.broadcast(counts), label).where(part * F.col("_n") < per_class).drop("_n")
    return chosen.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(2 * per_class * max_classes)


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``labels(doc_id, label)`` whose label is 0 or 1, a row for each id: of
    several labels of an id the largest holds."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    return known.groupBy("doc_id").agg(F.max(label).alias(label))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list:
    """Rows of ``docs`` for a bounded sample of each value of ``label`` (0 or 1)
    in ``labels(doc_id, label)``. The sample is drawn from the labels and its
    ids broadcast, so the texts aren't shuffled. Of several labels of an id the
    largest holds."""
    chosen = class_sample(known_labels(labels, label), label, per_class, 2)
    rows = docs.where("text is not null").join(F.broadcast(chosen), "doc_id")
    # repeated ids can't make the sample larger than a fixed number of rows
    return rows.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id", F.xxhash64("text")).limit(4 * per_class).collect()


def by_score(score: np.ndarray, labels: np.ndarray) -> float:
    """The threshold on ``score`` with the best balanced accuracy."""
    order = np.argsort(-score, kind="stable")
    y, s = labels[order].astype(float), score[order]
    tp, fp = np.cumsum(y), np.cumsum(1 - y)
    gain = tp / max(tp[-1], 1) - fp / max(fp[-1], 1)
    gain[:-1][s[:-1] == s[1:]] = -np.inf  # equal scores can't be parted
    best = int(np.argmax(gain))
    nxt = s[best + 1] if best + 1 < len(s) else 0.0
    return float((s[best] + nxt) / 2)


def around(p: np.ndarray, threshold: np.ndarray | float, to: float = 0.7) -> np.ndarray:
    """Map probabilities so that ``threshold`` becomes ``to``, 0 and 1 stay."""
    t = np.clip(threshold, 1e-6, 1 - 1e-6)
    return np.clip(np.where(p < t, p / t * to, to + (p - t) / (1 - t) * (1 - to)), 0.0, 1.0)
