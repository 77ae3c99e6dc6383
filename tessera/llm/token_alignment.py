"""Alignment of two tokenizers' tokens, and how often their ids are linked.

Both tokenizers' tokens are byte ranges of the same text. A batch of documents
at a time, two ``pandas.merge_asof`` joins (keyed by document) find for each
token start the token of the other side that covers it; the union of both
directions is every overlapping pair. Pairs whose ends are equal are links of
the kind ``"end"``: after each the text is cut into groups. Pairs that overlap
are links of the kind ``"overlap"``.

Texts are encoded by the public libraries in units: parts of a text before
blanks where neither tokenizer joins what stands on both sides (checked
against the vocabulary when it is loaded). Ids of the units met are kept.

Counts over the corpus don't go through documents one by one. A chunk is a run
of documents of one task (about ``chunk_bytes`` of text, at least a document):

1. each chunk numbers its different id pairs; a document is one row with its
   numbers and digests and its pairs as packed (number, times);
2. chunks' pair counts are added up to counts of the corpus, and to the highest
   of each id of the second side;
3. each chunk gets the counts of its pairs back (a row for each pair of a chunk;
   even a pair that all texts have is one row a chunk), and its documents add
   them up in ``cogroup`` by chunk, whose size ``chunk_bytes`` bounds.

The rows of step 1 are written once in the shared folder and read three times,
so that nothing is encoded again.

Defined results: texts that are null or empty, and those whose tokens' bytes
aren't a blank and the text, have no tokens (zeros and an empty digest);
repeated rows and ids count each; null ids stay null; an empty table gives an
empty result; a very long text is aligned whole, a chunk by itself; extra
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import arrow_map, hash_spans, text_slices
from tessera.llm.bpe_automaton import byte_symbols
from tessera.session import ensure_checkpoint_dir

CHUNK_BYTES = 2 << 20
KINDS = ("end", "overlap")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """First side: byte-level vocabulary; special tokens' strings are plain text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(byte_symbols())}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.entries = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.entries[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()

    def encode(self, units: list[str]) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class Pieces:
    """Second side: pieces with byte fallback; the library puts a blank before
    the text that it encodes."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        normal = proto.normalizer_spec
        self.entries = []
        joins = False
        for p in proto.pieces:
            if p.type == pb.ModelProto.SentencePiece.BYTE:
                self.entries.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.entries.append(p.piece.replace("▁", " ").encode())
                joins |= "▁" in p.piece.lstrip("▁") and p.type != pb.ModelProto.SentencePiece.UNUSED
        #: a unit can be encoded alone if no piece goes over a blank and nothing is rewritten
        self.by_unit = not joins and not normal.precompiled_charsmap and not normal.remove_extra_whitespaces and normal.add_dummy_prefix

    def encode(self, units: list[str]) -> list:
        return self.model.encode([u[1:] for u in units], num_threads=1)  # its own blank is put back


_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True


def units_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units start: at each text's start, and at each single blank
    between two characters of which neither can be white space (ASCII, or
    U+00C0 to U+00FF)."""
    n = len(data)
    cut = data == 32
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    latin = data == 0xC3
    fine = _PLAIN[data]
    before[1:] = fine[:-1]
    before[2:] |= latin[:-2]
    after[:-1] = fine[1:] | latin[1:]
    cut &= before & after
    cut[starts] = True
    return np.flatnonzero(cut)


class Side:
    """Ids of units met, by their 64-bit hash, until ``most`` are known."""

    def __init__(self, tokenizer, most: int = 300_000):
        self.tokenizer, self.most = tokenizer, most
        self.entry_size = np.array([len(e) for e in tokenizer.entries], np.int64)
        self.entry_at = np.cumsum(self.entry_size) - self.entry_size
        self.entry = np.frombuffer(b"".join(tokenizer.entries), np.uint8)
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after the other, and how many each has."""
        keys, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._forget()
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys
        if new.any():
            at = first[new]
            raw = data.tobytes()
            found = self.tokenizer.encode([raw[a:z].decode() for a, z in zip(starts[at].tolist(), ends[at].tolist())])
            size = np.array([len(x) for x in found], np.int64)
            ids = np.concatenate([np.asarray(x, np.int32) for x in found])
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.int32)])
            self.ids[self.used : self.used + len(ids)] = ids
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.begin = np.insert(self.begin, at, self.used + np.cumsum(size) - size)
            self.size = np.insert(self.size, at, size)
            self.used += len(ids)
        unit = np.searchsorted(self.keys, keys)[which]
        n = self.size[unit]
        stop = np.cumsum(n)
        return self.ids[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.begin[unit] - (stop - n), n)], n

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.entry_size[ids]
        stop = np.cumsum(n)
        return self.entry[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.entry_at[ids] - (stop - n), n)]


def spaced(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty texts with a blank before each, and where each starts (n + 1)."""
    size = np.diff(offs)
    size = size + (size > 0)
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.full(at[-1], 32, np.uint8)
    text = np.ones(at[-1], bool)
    text[at[:-1][size > 0]] = False
    out[text] = data
    return out, at


def tokens(first: Side, second: Side, data: np.ndarray, offs: np.ndarray):
    """For each side (ids, document, byte start, byte end) of all documents
    whose tokens' bytes are a blank and the text."""
    data, at = spaced(data, offs)
    n_docs = len(offs) - 1
    heads = np.unique(at[:-1][np.diff(at) > 0])
    starts = units_of(data, heads) if len(data) else np.zeros(0, np.int64)
    good = np.diff(at) > 0
    sides = []
    for side in (first, second):
        own = starts if getattr(side.tokenizer, "by_unit", True) else heads
        ids, count = side.ids_of(data, own, np.append(own[1:], len(data))) if len(own) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        doc = np.repeat(np.searchsorted(at, own, "right") - 1, count)
        size = side.entry_size[ids]
        total = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)
        good &= total == np.diff(at)
        sides.append((ids, doc, size))
    out = []
    for side, (ids, doc, size) in zip((first, second), sides):
        keep = good[doc]
        ids, doc, size = ids[keep], doc[keep], size[keep]
        stop = np.cumsum(size)
        shift = np.zeros(n_docs, np.int64)  # to where the document lies in the data
        low, here = np.unique(doc, return_index=True)
        shift[low] = at[low] - (stop - size)[here]
        stop = stop + shift[doc]
        # a wrong byte anywhere takes a document's tokens away
        spelt = side.bytes_of(ids)
        place = np.repeat(stop - size, size) + (np.arange(len(spelt)) - np.repeat(np.cumsum(size) - size, size))
        wrong = spelt != data[place]
        bad = np.unique(np.searchsorted(at, place[wrong], "right") - 1)
        out.append((ids, doc, stop - size, stop))
        good[bad] = False
    return [tuple(x[good[doc]] for x in (ids, doc, start, stop)) for ids, doc, start, stop in out], good


def overlaps(a, b) -> tuple[np.ndarray, np.ndarray]:
    """(token of a, token of b) of all overlapping pairs, in order of place;
    each side is (ids, document, start, stop) of tokens in order."""
    frames = [pd.DataFrame({"start": start, "doc": doc, f"t{i}": np.arange(len(ids))}) for i, (ids, doc, start, _) in enumerate((a, b))]
    if not len(frames[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = pd.merge_asof(frames[0], frames[1], on="start", by="doc")  # the token of b that covers the start of a's
    two = pd.merge_asof(frames[1], frames[0], on="start", by="doc")
    x, y = two["t0"].to_numpy(), two["t1"].to_numpy()
    new = a[2][x] != b[2][y]  # where both start, the first join has the pair
    x, y = np.append(one["t0"].to_numpy(), x[new]), np.append(one["t1"].to_numpy(), y[new])
    by = np.argsort(x + y, kind="stable")  # from pair to pair one token or both go on
    return x[by], y[by]


_DIGITS = 10  # of a 32-bit number


def _spelt(ids: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each with its mark behind it, and where each ends."""
    size = 2 + np.searchsorted(10 ** np.arange(1, _DIGITS), ids, "right")
    stop = np.cumsum(size)
    out = np.zeros(int(stop[-1]), np.uint8)
    out[stop - 1] = mark
    rest, at, live = ids.astype(np.int64), stop - 2, np.arange(len(ids))
    while len(live):
        rest, digit = np.divmod(rest, 10)
        out[at] = 48 + digit
        more = rest > 0
        rest, at, live = rest[more], at[more] - 1, live[more]
    return out, stop


def group_digests(a, b, ends_a: np.ndarray, ends_b: np.ndarray, n_docs: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2`` of each document: ids of its groups.
    ``ends_a`` and ``ends_b`` are the last tokens of the groups, in order."""
    out = [""] * n_docs
    if not len(ends_a):
        return out
    n_a, n_b = len(a[0]), len(b[0])
    # a group's tokens of a stand before its tokens of b
    place_a = np.arange(n_a) + np.concatenate([[0], ends_b + 1])[np.searchsorted(ends_a, np.arange(n_a))]
    place_b = np.arange(n_b) + (ends_a + 1)[np.searchsorted(ends_b, np.arange(n_b))]
    ids, mark = np.zeros(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a[0], b[0]
    mark[place_a[ends_a]], mark[place_b[ends_b]] = ord("|"), ord(";")
    text, stop = _spelt(ids, mark)
    docs, heads = np.unique(a[1], return_index=True)
    head = np.append(np.concatenate([[0], stop])[place_a[heads]], len(text))
    raw = memoryview(text)
    for d, x, z in zip(docs.tolist(), head[:-1].tolist(), head[1:].tolist()):
        out[d] = hashlib.sha256(raw[x : z - 1]).hexdigest()
    return out


_SIDES: dict = {}  # of this process; a worker runs many tasks


def sides(paths: tuple[str, str]) -> tuple[Side, Side]:
    if paths not in _SIDES:
        _SIDES[paths] = Side(ByteLevel(paths[0])), Side(Pieces(paths[1]))
    return _SIDES[paths]


def chunks(docs: DataFrame, paths: tuple[str, str], kind: str = "end", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Step 1: a row for each of ``docs(doc_id, text)`` (its numbers, digest, and
    its pairs as two arrays of 32-bit numbers), and a row for each chunk (``pair``
    and ``times``: different id pairs, ascending, and their counts)."""
    if kind not in KINDS:
        raise ValueError(f"kind of link is one of {KINDS}")

    def run(batches):
        from pyspark import TaskContext

        first, second = sides(paths)
        part = TaskContext.get().partitionId()
        n = 0
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text", chunk_bytes):
                n_docs = stop - start
                (a, b), _ = tokens(first, second, data, offs)
                x, y = overlaps(a, b)
                same = a[3][x] == b[3][y]
                ends_a, ends_b = x[same], y[same]
                link_a, link_b = (ends_a, ends_b) if kind == "end" else (x, y)
                doc = a[1][link_a]
                pair = a[0][link_a].astype(np.int64) << 32 | b[0][link_b]
                known, number, times = np.unique(pair, return_inverse=True, return_counts=True)
                own, own_times = np.unique(doc * len(known) + number, return_counts=True)
                own_doc = own // max(1, len(known))
                bound = np.searchsorted(own_doc, np.arange(n_docs + 1)).astype(np.int32)
                slot = (own % max(1, len(known))).astype(np.int32)
                per_doc = lambda d: pa.array(np.bincount(d, minlength=n_docs).astype(np.int64))
                cols = [
                    pa.array(np.full(n_docs, part << 32 | n, np.int64)), pa.array(np.ones(n_docs, bool)), batch.column(0).slice(start, n_docs),
                    per_doc(a[1]), per_doc(b[1]), per_doc(a[1][ends_a]), per_doc(a[1][x]), per_doc(doc),
                    pa.array(group_digests(a, b, ends_a, ends_b, n_docs), pa.string()),
                    pa.ListArray.from_arrays(pa.array(bound), pa.array(slot)),
                    pa.ListArray.from_arrays(pa.array(bound), pa.array(own_times.astype(np.int32))),
                    pa.nulls(n_docs, pa.list_(pa.int64())), pa.nulls(n_docs, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                edge = pa.array(np.array([0, len(known)], np.int32))
                zero = pa.array([0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [cols[0].slice(0, 1), pa.array([False]), pa.nulls(1, pa.int64()), zero, zero, zero, zero, zero, pa.array([""]),
                     pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
                     pa.ListArray.from_arrays(edge, pa.array(known)), pa.ListArray.from_arrays(edge, pa.array(times.astype(np.int32)))],
                    names=names,
                )
                n += 1

    schema = (
        "chunk long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, "
        "groups_sha256 string, slots array<int>, slot_times array<int>, pairs array<long>, pair_times array<int>"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def pair_counts(chunk_rows: DataFrame) -> DataFrame:
    """(chunk, pair, n): the pairs of each chunk and their counts there."""
    rows = chunk_rows.where("not is_doc").select("chunk", F.explode(F.arrays_zip("pairs", "pair_times")).alias("p"))
    return rows.select("chunk", F.col("p.pairs").alias("pair"), F.col("p.pair_times").alias("n"))


def corpus_counts(chunk_rows: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus join the two ids (the
    first in the upper 32 bits), and whether that is its second id's highest."""
    count = pair_counts(chunk_rows).groupBy("pair").agg(F.sum("n").alias("count"))
    top = count.groupBy(F.expr("int(pair & 4294967295)").alias("b")).agg(F.max("count").alias("top"))
    rows = count.withColumn("b", F.expr("int(pair & 4294967295)")).join(top, "b")
    return rows.select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _add_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of a chunk with the counts of its pairs (ascending: their numbers)."""
    pairs = pairs.combine_chunks()
    by = np.argsort(pairs["pair"].to_numpy())
    count = pairs["count"].to_numpy()[by]
    best = pairs["best"].to_numpy(zero_copy_only=False)[by]
    docs = docs.combine_chunks()
    slots, times = docs["slots"].combine_chunks(), docs["slot_times"].combine_chunks()
    doc = np.repeat(np.arange(len(docs)), np.asarray(slots.value_lengths()))
    at, times = slots.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = {}
    for name, v in (("n_best", best[at] * times), ("count_sum", count[at] * times)):
        own = np.zeros(len(docs), np.int64)
        np.add.at(own, doc, v)
        sums[name] = pa.array(own)
    names = [c.split()[0] for c in DOCUMENT.split(", ")]
    return pa.table({c: sums[c] if c in sums else docs[c] for c in names})


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None, kind: str = "end", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row (``DOCUMENT``) for each row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    rows = chunks(docs, tokenizers or default_tokenizers(), kind, chunk_bytes)
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    asked = pair_counts(stored).select(F.col("chunk").alias("_chunk"), "pair").join(corpus_counts(stored), "pair")
    own = spark.read.schema(rows.schema).parquet(path).where("is_doc").drop("is_doc", "pairs", "pair_times")
    return own.groupBy("chunk").cogroup(asked.groupBy("_chunk")).applyInArrow(_add_up, DOCUMENT)


def align_documents(docs: DataFrame) -> DataFrame:
    """The ``documents`` table: links are pairs whose ends are equal."""
    return align(docs.select("doc_id", "text"))
