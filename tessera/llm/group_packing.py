"""Best-fit packing of documents into sequences by a linear grouping scheme.

Tokenised documents, cut into pieces of at most ``capacity`` tokens, are packed
into sequences. There are at most ``capacity`` different lengths, so the whole
packing is planned from the histogram of lengths, whatever the table's size:

1. large pieces, in order of length, form groups of equal cardinality; in a
   group every length is rounded up to the largest (linear grouping);
2. configurations of few sizes are chosen one after the other: the largest
   size left plus the subset of the others that fills the sequence best
   (a knapsack over the rounded sizes), used as often as the groups allow;
3. the documents themselves are put in place of the rounded sizes, which
   leaves room that is known for each run of equal sequences;
4. small pieces go, largest first, where they fit best, and into new sequences
   when no room is left.

The plan is a list of runs: pieces of one length with ranks r .. r+n-1 go to
sequences s .. s+n-1 at one offset. Spark numbers the pieces of each length
(hash buckets of bounded size, bucket totals, and a window inside a bucket, so
a length that a third of all pieces have is spread) and looks the runs up.

Defined results: a null text is an empty one, which is the closing id alone; a
null doc_id is an id like others; repeated rows are packed each; an empty
table gives an empty result; a very long text is cut into pieces and only it.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._text import IS_WORD, LOWER, arrow_map, hash_spans, spans, text_slices

CAPACITY = 2048
SEPARATOR = "<|endoftext|>"  # fixed value: the vocabulary's end token, id 49407
SEPARATOR_ID = 49407
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_ASCII_PUNCT = np.zeros(256, bool)
_ASCII_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_WHOLE = np.zeros(256, bool)  # words with these are encoded uncut and in their own case
_WHOLE[[ord("'"), ord("<")]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _units(data: np.ndarray, offs: np.ndarray):
    """Parts of the text that the vocabulary's rules always encode apart: words
    between white space, also cut where an ASCII letter meets ASCII punctuation
    (unless the word has an apostrophe or may hold a special token)."""
    starts, ends, doc = spans(IS_WORD[data], offs)
    if not len(starts):
        return data, starts, ends, doc
    whole = np.zeros(len(starts), bool)
    marks = np.flatnonzero(_WHOLE[data])
    whole[np.searchsorted(starts, marks, "right") - 1] = True
    low = LOWER[data]
    for i in np.flatnonzero(whole):
        low[starts[i] : ends[i]] = data[starts[i] : ends[i]]
    letter, punct = _ASCII_LETTER[data], _ASCII_PUNCT[data]
    cuts = np.flatnonzero((letter[:-1] & punct[1:]) | (punct[:-1] & letter[1:])) + 1
    word = np.searchsorted(starts, cuts, "right") - 1
    good = (cuts > starts[word]) & (cuts < ends[word]) & ~whole[word]
    cuts, word = cuts[good], word[good]
    all_starts = np.sort(np.concatenate([starts, cuts]))
    all_ends = np.sort(np.concatenate([ends, cuts]))
    return low, all_starts, all_ends, doc[np.searchsorted(starts, all_starts, "right") - 1]


class Encoder:
    """Encodes texts. Each different unit is encoded once and kept, by its
    64-bit hash, until ``most`` units are known; then the table starts anew."""

    def __init__(self, path: str, most: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encoded(self, units: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after the other, and how many each has."""
        sep, flat = SEPARATOR.encode(), []
        apart = {i: bytes(u).decode() for i, u in enumerate(units) if 60 in bytes(u)}  # "<" may spell a special token
        for i in range(0, len(units), 2048):
            text = sep.join([b"" if j in apart else units[j] for j in range(i, min(i + 2048, len(units)))]).decode()
            flat.append(np.array([*self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, SEPARATOR_ID], np.uint32))
        ids = np.concatenate(flat)
        stops = np.flatnonzero(ids == SEPARATOR_ID)
        size = np.diff(np.concatenate([[-1], stops])) - 1
        ids = ids[ids != SEPARATOR_ID]
        if apart:
            parts = np.split(ids, np.cumsum(size)[:-1])
            for i, text in apart.items():
                parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                size[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, size

    def _learn(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray):
        """Add units (their hashes ascend) to the table."""
        view = memoryview(low)
        ids, size = self._encoded([view[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.used += len(ids)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice and where each text's ids start (n + 1)."""
        low, starts, ends, doc = _units(data, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        keys, first, which = np.unique(hash_spans(low, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._forget()
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys
        if new.any():
            self._learn(low, starts[first[new]], ends[first[new]], keys[new])
        unit = np.searchsorted(self.keys, keys)[which]
        n = self.size[unit]
        stop = np.cumsum(n)
        out = self.ids[np.arange(stop[-1]) + np.repeat(self.begin[unit] - (stop - n), n)]
        per_doc = np.bincount(doc, weights=n, minlength=len(offs) - 1).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_doc)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process (a worker runs many tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, closing_id: int = 0
) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``: each document's ids and a closing id,
    cut into pieces of ``capacity`` (``PIECES_SCHEMA``)."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterable[pa.RecordBatch]):
        import zlib

        tokens = encoder(path)
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text", 4 << 20):
                ids, at = tokens.encode(data, offs)
                rows = [[], [], [], []]
                owner = []
                for i in range(stop - start):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(closing_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        piece = own[s : s + capacity]
                        owner.append(start + i)
                        for c, v in zip(rows, (k, s, len(piece), zlib.crc32(piece.tobytes()))):
                            c.append(v)
                cols = [batch.column(0).take(pa.array(owner, pa.int64()))]
                cols += [pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, PIECES_SCHEMA)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = 256) -> list[tuple]:
    """Runs (length, first rank, pieces, first sequence, offset) that place
    ``counts[length]`` pieces of each length."""
    placed: list[tuple] = []
    used = {n: 0 for n in counts}
    sequences = 0
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # room -> (first sequence, sequences)
    small = capacity // 8
    large = sorted((n for n in counts if n > small), reverse=True)
    runs = [(n, counts[n]) for n in large]
    total = sum(c for _, c in runs)
    if total:
        # groups of equal cardinality over the sorted pieces; index -> length by the run borders
        lengths = np.array([n for n, _ in runs])
        border = np.concatenate([[0], np.cumsum([c for _, c in runs])])
        groups = min(groups, total)
        edges = [total * g // groups for g in range(groups + 1)]
        length_at = lambda i: int(lengths[np.searchsorted(border, i, "right") - 1])
        rounded = [length_at(edges[g]) for g in range(groups)]
        free = [edges[g + 1] - edges[g] for g in range(groups)]
        next_at = edges[:-1].copy()
        while any(free):
            config = _best_configuration(rounded, free, capacity)
            times = min(free[g] // config.count(g) for g in set(config))
            slots = []
            for g in config:
                slots.append(next_at[g])
                next_at[g] += times
                free[g] -= times
            done = 0
            while done < times:  # sequences whose slots keep their lengths
                n, sizes = times - done, []
                for s in slots:
                    r = int(np.searchsorted(border, s + done, "right")) - 1
                    sizes.append(int(lengths[r]))
                    n = min(n, int(border[r + 1]) - (s + done))
                offset = 0
                for s, size in zip(slots, sizes):
                    r = int(np.searchsorted(border, s + done, "right")) - 1
                    placed.append((size, s + done - int(border[r]), n, sequences, offset))
                    offset += size
                if capacity > offset:
                    gaps[capacity - offset].append((sequences, n))
                sequences += n
                done += n
    for size in sorted((n for n in counts if n <= small), reverse=True):
        left = counts[size]
        while left:
            room = next((g for g in range(size, capacity + 1) if gaps[g]), None)
            if room is None:
                per = capacity // size
                n = -(-left // per)
                gaps[capacity].append((sequences, n))
                sequences += n
                continue
            first, n = gaps[room].pop()
            per = min(room // size, left)  # the tightest sequence stays the tightest
            take = min(n, left // per)
            if take < n:
                gaps[room].append((first + take, n - take))
            for k in range(per):
                placed.append((size, used[size], take, first, capacity - room + k * size))
                used[size] += take
            left -= per * take
            if room - per * size:
                gaps[room - per * size].append((first, take))
    return placed


def _best_configuration(rounded: list[int], free: list[int], capacity: int) -> list[int]:
    """Groups of one sequence: the largest size left, then the fullest subset."""
    live = [g for g, n in enumerate(free) if n]
    first = live[0]
    room = capacity - rounded[first]
    smallest = rounded[live[-1]]
    if room < smallest:
        return [first]
    # reach[c]: last group used to fill exactly c, first fitting found; few items, so c is small work
    last = np.full(room + 1, -1)
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    for g in live:
        size, n = rounded[g], free[g] - (g == first)
        for _ in range(min(n, room // size)):
            new = np.zeros(room + 1, bool)
            new[size:] = reach[:-size]
            new &= ~reach
            if not new.any():
                break
            last[new] = g
            reach |= new
        if reach[room]:
            break
    c, config = int(np.flatnonzero(reach)[-1]), [first]
    while c:
        config.append(int(last[c]))
        c -= rounded[last[c]]
    return config


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = 256, bucket_rows: int = 50_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces(doc_id, piece, length, ...)``.
    ``pieces`` is read three times: give a table that is written."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if max(counts, default=0) > capacity or min(counts, default=1) < 1:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    by_length: dict[int, list] = {n: [] for n in counts}
    for size, rank, n, sequence, offset in plan_packing(counts, capacity, groups):
        by_length[size].append((rank, sequence, offset))
    plan = [(n, -(-counts[n] // bucket_rows), sorted(runs)) for n, runs in by_length.items()]
    plan_schema = "length long, _buckets long, _runs array<struct<rank: long, sequence: long, offset: long>>"
    known = F.broadcast(spark.createDataFrame(plan, plan_schema))  # at most `capacity` rows
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.col("_buckets"))
    rows = pieces.join(known.drop("_runs"), "length").withColumn("_b", spread).drop("_buckets")
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    totals = totals.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("length", "_b").orderBy("doc_id", "piece")
    ranked = rows.withColumn("_r", F.row_number().over(inner)).join(totals, ["length", "_b"])
    ranked = ranked.withColumn("_r", F.col("_r") + F.col("_before") - 1).join(known.drop("_buckets"), "length")
    run = F.expr("element_at(filter(_runs, x -> x.rank <= _r), -1)")
    return ranked.withColumn("_run", run).select(
        *pieces.columns,
        (F.col("_run.sequence") + F.col("_r") - F.col("_run.rank")).alias("sequence_id"),
        F.col("_run.offset").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    return pack(token_pieces(docs, tokenizer).checkpoint(eager=True))
