"""Spelling variants of words by neighbourhoods over a reduced alphabet.

Every task counts the words of its texts itself; Spark adds the counts up. The
words frequent enough are the vocabulary, held as a table. Two words are near
if one inserted, deleted or replaced code point makes one of the other:

* a word becomes a reduced word by hashing its letters to ``symbols`` symbols;
  one edit of a word is at most one edit of its reduced word;
* for every different reduced word all strings one edit away (and itself) are
  generated over the few symbols: about ``2 * symbols`` times its length,
  where the letters themselves would give a hundred times its length;
* these are joined with the different reduced words (both as 64-bit hashes;
  a hash that two strings share only adds a pair to be verified), and the words
  with their reduced words, so that no pair is compared that doesn't agree;
* pairs are verified on the original words by their edit distance.

A word's form is its most frequent near word if that is ``ratio`` times as
frequent; roots follow forms to the last. Each step multiplies the frequency
by ``ratio``, so chains are short, and jumping over two steps at a time ends
after five rounds at most.

Nothing is gathered: counts, neighbourhoods and pairs are tables partitioned by
hash. Words of a reduced word, and near words of a word, are never in an array.

Defined results: null and empty texts have no words; a null id counts as an
empty one in the id that seeds deletions; repeated rows count each; very long
texts and words are taken whole; an empty table gives an empty result; extra
columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import LOWER, arrow_map, hash_spans, mix, spans, text_slices
from tessera.session import ensure_checkpoint_dir

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN = 0xC3  # fixed value: the first UTF-8 byte of U+00C0 to U+00FF

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):  # the table of zlib's crc32, from its polynomial
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)

_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span's bytes, going on from the crc32 ``before`` it."""
    length = ends - starts
    c = ~before.astype(np.uint32)
    live, k = np.flatnonzero(length > 0), 0
    while len(live):
        own = c[live]
        c[live] = _CRC[(own ^ data[starts[live] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
        k += 1
        live = live[length[live] > k]
    return ~c


def counted_words(docs: DataFrame, every: int = 199, least_length: int = 6, most: int = 400_000) -> DataFrame:
    """(word, n) of ``docs(doc_id, text)``: runs of letters (A to Z folded) of
    at least ``least_length`` code points. A run whose crc32 with its document's
    id is divisible by ``every`` (0: never) first loses the code point at that
    number modulo its length. A task sends what it counted when ``most``
    different words are held, and at its end."""

    def run(batches):
        held: dict[bytes, int] = {}

        def sent():
            words, counts = list(held), list(held.values())
            held.clear()
            for a in range(0, len(words), 50_000):
                part = pa.array([w.decode() for w in words[a : a + 50_000]], pa.string())
                yield pa.RecordBatch.from_arrays([part, pa.array(counts[a : a + 50_000], pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, _stop, data, offs in text_slices(batch, "text"):
                latin = data == _LATIN
                inside = _LETTER[data] | latin
                inside[1:] |= latin[:-1]
                starts, ends, doc = spans(inside, offs)
                seconds = np.concatenate([[0], np.cumsum(latin)])
                length = ends - starts - (seconds[ends] - seconds[starts])
                long = length >= least_length
                starts, ends, doc, length = starts[long], ends[long], doc[long], length[long]
                if not len(starts):
                    continue
                low = LOWER[data]
                if every:
                    known = np.unique(doc)
                    seed = np.zeros(len(offs) - 1, np.uint32)
                    seed[known] = [zlib.crc32(f"{ids[start + i] or ''}:".encode()) for i in known.tolist()]
                    h = crc32_spans(low, starts, ends, seed[doc])
                    for i in np.flatnonzero(h % every == 0).tolist():
                        word = low[starts[i] : ends[i]].tobytes().decode()
                        at = int(h[i]) % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) >= least_length:
                            held[word.encode()] = held.get(word.encode(), 0) + 1
                    plain = h % every != 0
                    starts, ends = starts[plain], ends[plain]
                _, first, count = np.unique(hash_spans(low, starts, ends), return_index=True, return_counts=True)
                raw = low.tobytes()
                for a, z, n in zip(starts[first].tolist(), ends[first].tolist(), count.tolist()):
                    word = raw[a:z]
                    held[word] = held.get(word, 0) + n
                if len(held) > most:
                    yield from sent()
        yield from sent()

    source = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return arrow_map(source, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def symbols_of(words: list[str], symbols: int) -> list[np.ndarray]:
    """The reduced word of each word: 1 to ``symbols`` for each code point."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    reduced = (mix(points + np.uint64(17)) % np.uint64(symbols)).astype(np.uint64) + np.uint64(1)
    return np.split(reduced, np.cumsum([len(w) for w in words])[:-1])


def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _R, np.uint64)]), dtype=np.uint64)


def _named(polynomial: np.ndarray, length: int) -> np.ndarray:
    return mix(polynomial + np.uint64(length * 0xD1B54A32D192ED03 % 2**64))


def reduced_hashes(rows: np.ndarray) -> np.ndarray:
    """Hash of each reduced word (a row each, of one length)."""
    power = _powers(rows.shape[1])[:-1]
    return _named((rows * power).sum(axis=1, dtype=np.uint64), rows.shape[1])


def neighbourhoods(rows: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all strings at most one edit away from each reduced word (a
    row each; equal strings may repeat)."""
    n, size = rows.shape
    power = _powers(size + 1)
    term = rows * power[:size]
    before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
    whole = before[:, -1:]
    after = whole - before  # terms from each place on
    out = [_named(whole, size)]
    out.append(_named(before[:, :-1] + after[:, 1:] * np.uint64(_R_INVERSE), size - 1))
    for s in range(1, symbols + 1):
        symbol = np.uint64(s)
        out.append(_named(whole + (symbol - rows) * power[:size], size))
        out.append(_named(before + symbol * power[: size + 1] + after * np.uint64(_R), size + 1))
    return np.concatenate(out, axis=1)


def _by_length(words: list[str], symbols: int, cells: int = 1 << 21):
    """(indexes, reduced words as rows) of words of one length, a few at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for size, own in groups.items():
        step = max(1, cells // (size * 2 * symbols))
        for a in range(0, len(own), step):
            part = own[a : a + step]
            yield part, np.stack(symbols_of([words[i] for i in part], symbols))


def _stored(rows: DataFrame) -> DataFrame:
    """``rows`` as Parquet in the shared folder."""
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/spelling-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def reduced_words(words: DataFrame, symbols: int) -> DataFrame:
    """``words(word, n)`` with the hash ``reduced`` of the reduced word."""

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_pylist()
            out = np.zeros(len(own), np.uint64)
            for at, rows in _by_length(own, symbols):
                out[at] = reduced_hashes(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], names=["word", "n", "reduced"])

    return arrow_map(words.select("word", "n"), run, "word string, n long, reduced long")


def reduced_pairs(reduced: DataFrame, symbols: int) -> DataFrame:
    """(reduced, other): reduced words at most one edit apart, both ways and
    each with itself."""

    def run(batches):
        for batch in batches:
            own = batch.column(1).to_pylist()
            name = batch.column(0).to_numpy()
            for at, rows in _by_length(own, symbols):
                around = np.sort(neighbourhoods(rows, symbols), axis=1)
                # being one edit apart holds both ways: the smaller hash sends the pair
                new = around >= reduced_hashes(rows)[:, None]
                new[:, 1:] &= around[:, 1:] != around[:, :-1]
                who = np.repeat(name[at], new.sum(axis=1))
                other = around[new].view(np.int64)
                for a in range(0, len(who), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(who[a : a + 100_000]), pa.array(other[a : a + 100_000])], names=["reduced", "other"])

    # any of a reduced word's words stands for it
    distinct = reduced.groupBy("reduced").agg(F.min("word").alias("word"))
    around = arrow_map(distinct, run, "reduced long, other long")
    one_way = around.join(distinct.select(F.col("reduced").alias("other")), "other", "left_semi")
    both = F.when(F.col("reduced") == F.col("other"), F.array(F.struct("reduced", "other")))
    both = both.otherwise(F.array(F.struct("reduced", "other"), F.struct(F.col("other").alias("reduced"), F.col("reduced").alias("other"))))
    return one_way.select(F.inline(both))


def symbols_for(n: int, least_length: int = 6) -> int:
    """Symbols for ``n`` words: the least power of two, 8 or more, that has four
    times as many strings of the least length. Fewer make more pairs to verify,
    more a larger neighbourhood; both give the same pairs in the end."""
    symbols = 8
    while symbols**least_length < 4 * n:
        symbols *= 2
    return symbols


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, other, other_n): all pairs of ``words(word, n)`` whose edit
    distance is 1, both ways. Words are distinct."""
    symbols = symbols or symbols_for(words.count())
    reduced = _stored(reduced_words(words, symbols))
    pairs = reduced_pairs(reduced, symbols)
    mine = reduced.join(pairs, "reduced")
    theirs = reduced.select(F.col("reduced").alias("other"), F.col("word").alias("_word"), F.col("n").alias("_n"))
    both = mine.join(theirs, "other").where(F.abs(F.length("word") - F.length("_word")) <= 1)
    both = both.where(F.levenshtein(F.col("word"), F.col("_word"), 1) == 1)
    return both.select("word", "n", F.col("_word").alias("other"), F.col("_n").alias("other_n"))


def forms(words: DataFrame, symbols: int | None = None, ratio: int = 5) -> DataFrame:
    """``words(word, n)`` with ``n_near``, ``form``, ``form_n`` and ``root``."""
    near = near_pairs(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("_top")
    )
    rows = words.select("word", "n").join(near, "word", "left")
    form_n = -F.col("_top.less")
    good = form_n >= ratio * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("_top.form")).alias("form"), F.when(good, form_n).alias("form_n"),
    )
    rows = _stored(rows)
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # every round doubles the steps that a link jumps
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = links.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        jumped = _stored(jumped)
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    out = rows.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(
    docs: DataFrame, *, every: int = 199, least_length: int = 6, least_count: int = 5, symbols: int | None = None, ratio: int = 5
) -> DataFrame:
    """Words of ``docs(doc_id, text)`` with at least ``least_length`` code points
    and ``least_count`` occurrences, their forms and roots."""
    words = counted_words(docs, every, least_length).where(F.col("n") >= least_count)
    return forms(_stored(words), symbols, ratio)
