"""Held-out log-probabilities of texts by a Kneser-Ney model of their words.

A word is a run of letters (ASCII letters folded, non-ASCII bytes as they are);
each character of scripts written without blanks (Han, Kana, Thai, Lao, Khmer,
Myanmar) is a word of its own. Words are 64-bit hashes. Nothing of the model is
gathered: Spark deals all sequences of three words by their middle word to
slots of about ``BUCKET`` sequences, where their counts, continuation counts and
back-off weights are made together; the sequences of a middle word that occurs
``HOT`` times or more lie in as many slots as hold them. What slots know in part (after how
many words a word stands, contexts of frequent words) is summed by name in a
second exchange and given back to the slots that asked.

Most sequences of a corpus occur once, so an exchange of them has several times
the bytes of the texts. They cross packed (columns of a block of texts, zstd),
and in ``PASSES`` passes over the slots, whose shuffle files go when the pass is
written. Counts come first, for all slots, then probabilities, as discounts hang
on all counts. The texts are cut into words twice: to count them, and to store
them packed, which the passes read. Frequent words cross as numbers by frequency
(``CODES`` of them; others as hashes): a numbering changes bytes, not results.

A task has up to ``GROUP`` slots, makes one after the other and passes on what
they know of a name, or add to a text, summed and packed: not a row for each text
and slot, of which there are as many as words in a large corpus. The sums of the
numbered words are given to all tasks of the second round.

A text would predict itself, as most of its sequences occur nowhere else. Texts
are therefore dealt to ``FOLDS`` folds by a hash of the text, and each is judged
by the counts of all other folds, at every order: a sequence that only the
text's own fold has is unknown to it. Copies of a text are in one fold.

Interpolated Kneser-Ney with a discount for each order (n1 / (n1 + 2 n2)); an
unknown word has the share that the discount of single words leaves, over all
known words and it. One model serves all languages, so texts may mix them.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._text import IS_LETTER, LOWER, arrow_map, hash_spans, mix, release_memory, runs, text_slices
from tessera.session import ensure_checkpoint_dir

FOLDS = 16
_FOLD_BITS = 4
#: parts of the model that are made one after the other; only one part's exchanges lie on disk
PASSES = 4
#: sequences of a slot, and from which on a middle word's sequences are dealt to several slots
BUCKET, HOT = 500_000, 1_000_000
#: tasks of a pass from which on a task has several slots, and the most that it has
TASKS, GROUP = 10, 16
#: sequences that a task of texts deals at a time
BLOCK = 1_000_000
#: words that are counted together, and how often one is among them to be passed on
COUNTED, LEAST = 4_000_000, 3
#: numbers of the most frequent words; 0 stands before a text, the last for any other word
CODES = 1 << 18
_OTHER = CODES - 1
_CODED = "n int, m int, e int, size binary, code binary, other binary, own binary, weight binary"
_DEALT = "part int, n int, m int, e int, counts binary, a binary, b binary, c binary, other binary, unit binary, own binary, weight binary"
_ASKED = "part int, slot int, n int, m int, word binary, at binary, kind binary, value binary"
_SUMS = "part int, n int, key binary, log binary, scored binary"
_KINDS, _TOTAL = 2 * FOLDS + 1, 2 * FOLDS  # of a context: below are a value for each fold, twice
_SLOTS = 2 * FOLDS + 2  # of a name that several slots of one task have
_ALL = -1  # stands for all tasks


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash (``CODES`` or more) of each word, and where each text's words start."""
    at = np.flatnonzero(data >= 0xE0)
    lead, after = data[at], data[np.minimum(at + 1, len(data) - 1)]
    alone = (lead >= 0xE3) & (lead <= 0xE9) | (lead == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    alone |= (lead == 0xE1) & ((after >= 0x80) & (after <= 0x82) | (after >= 0x9E) & (after <= 0x9F))
    at = at[alone]
    cuts = np.unique(np.concatenate([offs, at, np.minimum(at + 3, len(data))])) if len(at) else offs
    starts, ends = runs(IS_LETTER[data], cuts)
    h = np.maximum(hash_spans(LOWER[data], starts, ends), np.uint64(CODES))
    return h, np.searchsorted(starts, offs)


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpack(rows: list[dict], name: str, dtype, size: str) -> list[np.ndarray]:
    width = np.dtype(dtype).itemsize
    return [np.frombuffer(pa.decompress(r[name], r[size] * width, codec="zstd", asbytes=True), dtype) for r in rows]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    types = {"int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], names=[f for f, _ in fields])


def _rows(batch: pa.RecordBatch):
    for i in range(len(batch)):  # rows are large: one after the other
        yield batch.slice(i, 1).to_pylist()[0]


def _freed(run):
    """``run`` that gives its memory back when it ends."""

    def made(batches):
        yield from run(batches)
        release_memory()

    return made


def _words(batch: pa.RecordBatch):
    """Slices of ``batch(key, text)``: (keys, copies of each in the slice, text
    of each word, its place there, its hash)."""
    for start, stop, data, offs in text_slices(batch, "text"):
        key = batch.column(0).slice(start, stop - start).to_numpy()
        _, first, again, copies = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        c, bounds = word_hashes(data, offs)
        n = np.diff(bounds)
        place = np.arange(len(c)) - np.repeat(bounds[:-1], n)
        text = np.repeat(np.arange(len(n), dtype=np.uint32), n)
        if len(first) < len(key):  # copies count by weight
            one = (first[again] == np.arange(len(key)))[text]
            text, place, c = text[one], place[one], c[one]
        yield key, copies[again], text, place, c


def _before(word: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The word ``k`` places before each; 0 stands before a text."""
    out = np.zeros_like(word)
    out[k:] = word[:-k]
    out[place < k] = 0
    return out


def _sizes(docs: DataFrame) -> tuple[int, list[tuple[int, int]], np.ndarray]:
    """The number of sequences in ``docs(key, text)``, frequent middle words with
    how often they stand there, and words to be numbered, the most frequent first."""

    def run(batches):
        total, held = 0, []

        def frequent():
            word, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LEAST
            return pa.RecordBatch.from_arrays([pa.array(word[often].view(np.int64)), pa.array(n[often])], names=["word", "n"])

        for batch in batches:
            for _, _, _, place, c in _words(batch):
                total += len(c)
                held.append(_before(c, place, 1))
                if sum(map(len, held)) > COUNTED:
                    yield frequent()
                    held = []
        if held:
            yield frequent()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], names=["word", "n"])

    counts = arrow_map(docs, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.col("word").isNotNull(), F.desc("n"), "word").limit(CODES).toArrow()  # the first row: all
    word, n = rows["word"].fill_null(0).to_numpy()[1:], rows["n"].to_numpy()
    often = n[1:] >= HOT  # at most a word for HOT sequences
    return int(n[0]) if len(n) else 0, list(zip(word[often].tolist(), n[1:][often].tolist())), word[word != 0][: CODES - 2].view(np.uint64)


class _Codes:
    """Numbers of words. A number only stands for the hash in an exchange; a word
    without one crosses as hash."""

    BITS = 21

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([np.zeros(1, np.uint64), words])
        self.table = np.zeros(1 << self.BITS, np.int32)
        self.table[self._at(words[::-1])] = np.arange(len(words), 0, -1)  # the most frequent of a place stays

    def _at(self, h):
        return (h >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, h: np.ndarray) -> np.ndarray:
        code = self.table[self._at(h)]
        return np.where(self.words[code] == h, code.astype(np.uint64), h)

    def hashes(self, value: np.ndarray) -> np.ndarray:
        """The hashes of words that may be numbers."""
        return np.where(value < CODES, self.words[np.minimum(value, np.uint64(len(self.words) - 1))], value)


def _slot_of(b: np.ndarray, slots: int) -> np.ndarray:
    return ((mix(b + np.uint64(1)) >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)


def _planes(code: np.ndarray) -> np.ndarray:
    """Numbers below 2**24, each byte of all together."""
    return code.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T


def _numbers(row: dict, name: str) -> np.ndarray:
    n = row["n"]
    x = np.frombuffer(pa.decompress(row[name], 3 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, n).astype(np.uint32)
    return x[0] | x[1] << np.uint32(8) | x[2] << np.uint32(16)


def _coded(docs: DataFrame, words) -> DataFrame:
    """The words of ``docs(key, text)`` in order, a row of packed columns for each
    slice of texts; copies in a slice count by weight."""

    def run(batches):
        codes = _Codes(words.value)
        for batch in batches:
            for key, copies, text, _, c in _words(batch):
                size = np.bincount(text, minlength=len(key))
                there = np.flatnonzero(size)
                word = codes.of(c)
                other = word[word >= CODES]
                code = np.minimum(word, np.uint64(_OTHER))
                yield _batch([(len(c), len(there), len(other), *map(_pack, (size[there].astype(np.int32), _planes(code), other, key[there], copies[there].astype(np.uint32))))], _CODED)

    return arrow_map(docs, _freed(run), _CODED)


def _dealt(coded: DataFrame, words, frequent: np.ndarray, pieces: np.ndarray, slots: int, low: int, high: int, group: int) -> DataFrame:
    """Sequences of the slots from ``low`` to ``high``, a row of packed columns
    for each ``group`` of slots and block of texts. A middle word's sequences are
    in one slot, those of frequent ones dealt by their last word to ``pieces``."""

    def run(batches):
        codes = _Codes(words.value)
        slot_of, hot = np.zeros(CODES, np.int32), np.zeros(CODES, bool)
        slot_of[: len(codes.words)], hot[: len(codes.words)] = _slot_of(codes.words, slots), _isin(codes.words, frequent)
        held, units = [], 0

        def packed():
            slot, a, b, c, unit, own, weight = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(slot.astype(np.uint16) if high - low < 1 << 16 else slot, kind="stable")
            slot, a, b, c, unit = slot[order], a[order], b[order], c[order], unit[order]
            part = slot // group
            cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
            for i, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                p = int(part[i])
                used, number = _present(unit[i:z], len(own))
                counts = np.bincount(slot[i:z] - p * group, minlength=group).astype(np.int32)
                three = [x[i:z] for x in (a, b, c)]
                other = np.concatenate([x[x >= CODES] for x in three])
                three = [_pack(_planes(np.minimum(x, np.uint64(_OTHER)))) for x in three]
                row = (p, z - i, len(used), len(other), _pack(counts), *three, _pack(other))
                yield _batch([(*row, _pack(np.diff(number, prepend=np.int32(0))), _pack(own[used]), _pack(weight[used]))], _DEALT)

        for batch in batches:
            for r in _rows(batch):
                if not r["n"]:
                    continue
                code, size, own, weight = _numbers(r, "code"), *(_unpack([r], x, t, "m")[0] for x, t in (("size", np.int32), ("own", np.int64), ("weight", np.uint32)))
                rest = np.flatnonzero(code == _OTHER)
                word = code.astype(np.uint64)
                word[rest] = _unpack([r], "other", np.uint64, "e")[0]
                first = np.cumsum(size) - size
                b = np.concatenate([np.zeros(1, np.uint32), code[:-1]])
                b[first] = 0
                slot = slot_of[b]
                rest = rest[: np.searchsorted(rest, len(code) - 1)] + 1
                rest = rest[b[rest] > 0]
                slot[rest] = _slot_of(word[rest - 1], slots)
                if len(frequent):
                    often = hot[b]
                    often[rest] = _isin(word[rest - 1], frequent)
                    often = np.flatnonzero(often)
                    middle = np.where(b[often] > 0, codes.hashes(word[often - 1]), np.uint64(0))
                    piece = (mix(codes.hashes(word[often])) >> np.uint64(32)) * pieces[np.searchsorted(frequent, middle)] >> np.uint64(32)
                    slot[often] = _slot_of(mix(middle + np.uint64(1)) + piece, slots)
                mine = np.flatnonzero((slot >= low) & (slot < high))
                short = np.zeros(len(code), bool)  # less than two words before
                short[first] = True
                short[first[size > 1] + 1] = True
                two = np.where(short[mine], np.uint64(0), word[np.maximum(mine - 2, 0)])
                one = np.where(b[mine] > 0, word[mine - 1], np.uint64(0))
                held.append((slot[mine] - low, two, one, word[mine], np.repeat(np.arange(len(size)), size)[mine] + units, own, weight))
                units += len(size)
                if sum(len(x[0]) for x in held) > BLOCK or units > BLOCK:
                    if sum(len(x[0]) for x in held):
                        yield from packed()
                    held, units = [], 0
                    release_memory()
        if held and sum(len(x[0]) for x in held):
            yield from packed()

    return arrow_map(coded, _freed(run), _DEALT)


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _slots(rows: list[dict], group: int):
    """Keys of the texts of a task, and each slot's (a, b, c, text, weight), where
    a, b and c are (numbers of words, hashes of those without)."""
    parts, key, weight = [], [], []
    units = 0
    for r in rows:
        counts = _unpack([r | {"g": group}], "counts", np.int32, "g")[0]
        ends = np.cumsum(counts).tolist()
        three = [_numbers(r, x) for x in "abc"]
        where = [np.flatnonzero(x == _OTHER) for x in three]
        other = np.split(_unpack([r], "other", np.uint64, "e")[0], np.cumsum([len(x) for x in where])[:-1])
        cuts = [np.searchsorted(x, ends).tolist() for x in where]
        unit = np.cumsum(_unpack([r], "unit", np.uint32, "n")[0], dtype=np.uint32)
        parts.append((ends, three, other, cuts, unit + np.uint32(units)))
        key.append(_unpack([r], "own", np.int64, "m")[0])
        weight.append(_unpack([r], "weight", np.uint32, "m")[0])
        units += r["m"]
    key, weight = np.concatenate(key), np.concatenate(weight)

    def each():
        for s in range(group):
            three, unit = [([], []) for _ in "abc"], []
            for ends, code, other, cuts, of in parts:
                i, z = ends[s - 1] if s else 0, ends[s]
                if z > i:
                    unit.append(of[i:z])
                    for x, w, o, at in zip(three, code, other, cuts):
                        x[0].append(w[i:z])
                        x[1].append(o[at[s - 1] if s else 0 : at[s]])
            if unit:
                yield *((np.concatenate(x), np.concatenate(o)) for x, o in three), np.concatenate(unit)

    return key, weight, each()


def _dense(code: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 of the words of a column, and the words."""
    used = np.zeros(CODES, bool)
    used[code] = True
    used[_OTHER] = False
    known = np.flatnonzero(used)
    out = (np.cumsum(used, dtype=np.int32) - 1)[code].astype(np.int64)
    names, at = np.unique(other, return_inverse=True)
    out[code == _OTHER] = len(known) + at
    return out, np.concatenate([known.astype(np.uint64), names])


def _starts(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values start, and the run of each."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _present(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that there are, and the place of each row's code among them."""
    there = np.zeros(size, bool)
    there[code] = True
    found = np.flatnonzero(there)
    place = np.empty(size, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[code]


class _Slot:
    """Counts of the sequences of a slot by all folds but the own one: rows
    (sequence, fold), pairs (b, c, fold), and sums of contexts. Without ``texts``
    only what discounts and other slots need."""

    def __init__(self, a, b, c, unit, key, weight, codes: _Codes, frequent: np.ndarray, texts: bool):
        (a, names_a), (b, names_b), (c, names_c) = (_dense(*x) for x in (a, b, c))
        names_a, names_b = codes.hashes(names_a), codes.hashes(names_b)
        bits_a, bits_c = (int(len(x)).bit_length() for x in (names_a, names_c))
        bc, pairs = b << bits_c | c, None
        if int(len(names_b)).bit_length() + bits_c + bits_a + _FOLD_BITS > 62:
            pairs, bc = np.unique(bc, return_inverse=True)
        code = (bc << bits_a | a) << _FOLD_BITS | (key % FOLDS)[unit]
        del a, b, c, bc
        plain = bool((weight == 1).all())
        if texts or not plain:
            order = np.argsort(code)
            code, self.unit = code[order], unit[order]
            self.weight = weight[self.unit].astype(np.float64)
        else:
            code.sort()
        at, self.row = _starts(code)
        own = np.diff(at, append=len(code)).astype(np.float64) if plain else np.add.reduceat(self.weight, at)
        code = code[at]
        fold = code & (1 << _FOLD_BITS) - 1
        code >>= _FOLD_BITS
        at, three = _starts(code)
        n = np.add.reduceat(own, at)
        self.n3, gone, self.counts3 = n[three] - own, own == n[three], n
        code = code[at]
        a = code & (1 << bits_a) - 1
        at, two = _starts(code >> bits_a)
        bc = code[at] >> bits_a
        bc = bc if pairs is None else pairs[bc]
        b, c = bc >> bits_c, bc & (1 << bits_c) - 1
        # contexts of two words; the other slots need those of frequent words only
        hot = _isin(names_b, frequent)
        self.contexts = []
        if texts or hot.any():
            ab, group = np.unique(b[two] << bits_a | a, return_inverse=True)
            word = ab >> bits_a
            name = np.maximum(mix(mix(names_b[word]) + names_a[ab & (1 << bits_a) - 1]), np.uint64(CODES))
            self.after_two = _Context(group[three], fold, own, gone, np.bincount(group, n), np.bincount(group), name, hot[word])
            self.contexts.append(self.after_two)
        # pairs: before how many words
        before = np.bincount(two).astype(np.float64)
        code, self.pair = _present(two[three] * FOLDS + fold, len(b) * FOLDS)
        pair, fold = code // FOLDS, code % FOLDS
        lost = np.bincount(self.pair, gone, len(code))
        self.n2, gone, self.counts2, self.fold2 = before[pair] - lost, lost == before[pair], before, fold
        name = np.maximum(mix(names_b + np.uint64(2)), np.uint64(CODES))
        self.after_one = _Context(b[pair], fold, lost, gone, np.bincount(b, before, len(names_b)), np.bincount(b, minlength=len(names_b)), name, hot)
        # words: after how many words
        size = len(names_c)
        self.words = _Context(c[pair], fold, gone.astype(np.float64), np.zeros(len(gone)), np.bincount(c, minlength=size), np.zeros(size), names_c, None)
        self.contexts += [self.after_one, self.words]


class _Context:
    """Sums of the groups of rows, over all folds and for each; those that have
    rows in other slots are asked for (of words all)."""

    def __init__(self, group, fold, own, gone, total, kinds, name, shared):
        code, self.row = _present(group * FOLDS + fold, len(name) * FOLDS)
        self.group, self.fold = code // FOLDS, code % FOLDS
        self.own, self.gone = np.bincount(self.row, own, len(code)), np.bincount(self.row, gone, len(code))
        self.total, self.kinds, self.name = total.astype(np.float64), kinds.astype(np.float64), name
        self.shared, self.is_word = np.ones(len(name), bool) if shared is None else shared, shared is None

    def asked(self):
        """(name, kind, value) of what other slots may add to."""
        mine = self.shared[self.group]
        rows = [(self.name[self.shared], np.full(self.shared.sum(), _TOTAL), self.total[self.shared])]
        rows.append((self.name[self.group[mine]], self.fold[mine], self.own[mine]))
        if not self.is_word:
            rows.append((self.name[self.shared], np.full(self.shared.sum(), _KINDS), self.kinds[self.shared]))
            rows.append((self.name[self.group[mine]], FOLDS + self.fold[mine], self.gone[mine]))
        name, kind, value = (np.concatenate(x) for x in zip(*rows))
        there = value > 0
        return name[there], kind[there].astype(np.uint8), value[there].astype(np.int64)

    def told(self, names, at, kind, value):
        """Take the sums over all slots: ``names`` ascend, ``at`` is a place in them."""
        if not len(names) or not self.shared.any():
            return
        place = np.minimum(np.searchsorted(names, self.name), len(names) - 1)
        known = (names[place] == self.name) & self.shared
        where = np.full(len(names), -1, np.int64)
        where[place[known]] = np.flatnonzero(known)
        group = where[at]
        mine = group >= 0
        group, kind, value = group[mine], kind[mine], value[mine]
        for k, sums in ((_TOTAL, self.total), (_KINDS, self.kinds)):
            one = kind == k
            sums[group[one]] = value[one]
        place = np.full(len(self.name) * FOLDS, -1, np.int32)
        place[self.group * FOLDS + self.fold] = np.arange(len(self.group))
        for shift, sums in ((0, self.own), (FOLDS, self.gone)):
            one = (kind >= shift) & (kind < shift + FOLDS)
            spot = place[group[one] * FOLDS + kind[one] - shift]
            sums[spot[spot >= 0]] = value[one][spot >= 0]

    def numbered(self, total, own):
        """Take the sums over all slots of the numbered words."""
        known = self.name < CODES
        self.total[known] = total[self.name[known].astype(np.int64)]
        mine = known[self.group]
        self.own[mine] = own[self.name[self.group[mine]].astype(np.int64) * FOLDS + self.fold[mine]]

    def rest(self):
        """Total and kinds of each row, without its fold."""
        return (self.total[self.group] - self.own)[self.row], (self.kinds[self.group] - self.gone)[self.row]


def _bounds(parts: int, top: int = 2**64) -> np.ndarray:
    return np.array([i * top // parts for i in range(1, parts)], np.uint64)


def _asked_of(dealt: DataFrame, words, frequent: np.ndarray, parts: int, low: int, group: int) -> DataFrame:
    """What the slots of a task know of words and shared contexts, for the part
    of each name; and a row without a part: how many sequences and pairs were
    found once and twice."""

    def run(batches):
        rows = [r for batch in batches for r in _rows(batch)]
        if not rows:
            return
        part = low + rows[0]["part"]
        codes = _Codes(words.value)
        key, weight, slots = _slots(rows, group)
        rows, found, held, lists = None, np.zeros(4, np.int64), [], []
        for a, b, c, unit in slots:
            slot = _Slot(a, b, c, unit, key, weight, codes, frequent, False)
            asked = [x.asked() for x in slot.contexts]
            lists += [x.name[x.shared] for x in slot.contexts]  # a name is of one context
            held += asked
            found += np.array([(x == k).sum() for x in (slot.counts3, slot.counts2) for k in (1, 2)], np.int64)
        names, n = np.unique(np.concatenate(lists), return_counts=True)
        name, kind, value = (np.concatenate(x) for x in zip(*held))
        several = np.flatnonzero(n > 1)
        code, value = np.concatenate([np.searchsorted(names, name) * 64 + kind, several * 64 + _SLOTS]), np.concatenate([value, n[several]])
        order = np.argsort(code)
        code, value = code[order], value[order]
        at, _ = _starts(code)
        code, value = code[at], np.add.reduceat(value, at)
        at, kind = code // 64, (code % 64).astype(np.uint8)
        first = int(np.searchsorted(names, np.uint64(CODES)))  # numbers, then hashes
        for low_name, high_name, top in ((0, first, CODES), (first, len(names), 2**64)):
            cuts = low_name + np.concatenate([[0], np.searchsorted(names[low_name:high_name], _bounds(parts, top)), [high_name - low_name]])
            for p, (i, z) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if z > i:
                    x, y = np.searchsorted(at, [i, z]).tolist()
                    word = _pack(np.diff(names[i:z], prepend=np.uint64(0)))
                    yield _batch([(p, part, z - i, y - x, word, _pack(np.diff(at[x:y], prepend=i).astype(np.uint32)), _pack(kind[x:y]), _pack(value[x:y]))], _ASKED)
        yield _batch([(None, part, 0, len(found), None, None, None, _pack(found))], _ASKED)

    return arrow_map(dealt, _freed(run), _ASKED)


def _answers(asked: DataFrame, parts: int) -> DataFrame:
    """For each task the sums over all slots of what several slots have, but of
    numbered words for all together; and a row without a task: sums over words
    (all, then by fold)."""

    def run(batches):
        rows = [r for batch in batches for r in _rows(batch)]
        if not rows:
            return
        names = [np.cumsum(x) for x in _unpack(rows, "word", np.uint64, "n")]
        every, of = np.unique(np.concatenate(names), return_inverse=True)
        of = np.split(of, np.cumsum([len(x) for x in names])[:-1])
        at = [np.cumsum(x.astype(np.int64)) for x in _unpack(rows, "at", np.uint32, "m")]
        kind, value = (np.concatenate(_unpack(rows, x, t, "m")) for x, t in (("kind", np.uint8), ("value", np.int64)))
        code, group = np.unique(np.concatenate([o[x] for o, x in zip(of, at)]) * 64 + kind, return_inverse=True)
        value = np.bincount(group, value).astype(np.int64)
        owner, kind = code // 64, (code % 64).astype(np.uint8)
        first = np.searchsorted(owner, np.arange(len(every) + 1))
        shared = np.bincount(np.concatenate(of), minlength=len(every)) > 1
        shared[owner[kind == _SLOTS]] = True
        for r, o in zip(rows, of):
            o = o[shared[o] & (every[o] >= CODES)]
            if len(o):
                n = first[o + 1] - first[o]
                at = np.repeat(np.arange(len(o)), n)
                pick = np.repeat(first[o] - (np.cumsum(n) - n), n) + np.arange(len(at))
                row = (None, r["slot"], len(o), len(at), _pack(np.diff(every[o], prepend=np.uint64(0))), _pack(np.diff(at, prepend=0).astype(np.uint32)), _pack(kind[pick]), _pack(value[pick]))
                yield _batch([row], _ASKED)
        mine = np.flatnonzero((every[owner] < CODES) & (kind != _SLOTS))
        number = np.diff(every[owner[mine]], prepend=np.uint64(0)).astype(np.uint32)
        yield _batch([(None, _ALL, 0, len(mine), None, _pack(number), _pack(kind[mine]), _pack(value[mine]))], _ASKED)
        word = np.ones(len(every), bool)
        word[owner[kind == _KINDS]] = False
        mine = word[owner]
        total = np.zeros(len(every), np.int64)
        total[owner[kind == _TOTAL]] = value[kind == _TOTAL]
        own = mine & (kind < FOLDS)
        sums = [total[word].sum(), word.sum(), (total[word] == 1).sum(), (total[word] == 2).sum()]
        lost = np.bincount(kind[own], value[own], FOLDS)
        gone = np.bincount(kind[own & (value == total[owner])], minlength=FOLDS)
        found = np.concatenate([sums, lost, gone]).astype(np.int64)
        yield _batch([(None, None, 0, len(found), None, None, None, _pack(found))], _ASKED)

    return arrow_map(asked.repartitionById(parts, "part"), _freed(run), _ASKED)


def _numbered(packed: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the numbered words: over all folds, and for each word and fold."""
    total, own = np.zeros(CODES), np.zeros(CODES * FOLDS, np.int32)
    for r in packed:
        at, kind, value = (_unpack([r], x, t, "m")[0] for x, t in (("at", np.uint32), ("kind", np.uint8), ("value", np.int64)))
        word = np.cumsum(at.astype(np.int64))
        every = kind == _TOTAL
        total[word[every]] = value[every]
        own[word[~every] * FOLDS + kind[~every]] = value[~every]
    return total, own


def _mixed(count, discount, total, kinds, below):
    """Interpolation of a discounted count with the probability below; only the
    latter where the context is unknown."""
    plain = (np.maximum(count - discount, 0.0) + discount * kinds * below) / np.maximum(total, 1)
    return np.where(total > 0, plain, below)


def _text_sums(both: DataFrame, words, sums, frequent: np.ndarray, discounts, total: np.ndarray, kinds: np.ndarray, group: int, parts: int) -> DataFrame:
    """Sums of the texts of each task, packed for the part of each key."""
    d3, d2, d1 = discounts

    def run(batches):
        rows, told = [], []
        for batch in batches:
            for r in _rows(batch):
                (rows if r["a"] is not None else told).append(r)
        if not rows:
            return
        codes = _Codes(words.value)
        key, weight, slots = _slots(rows, group)
        told = [[_unpack([r], x, t, s)[0] for x, t, s in (("word", np.uint64, "n"), ("at", np.uint32, "m"), ("kind", np.uint8, "m"), ("value", np.int64, "m"))] for r in told]
        told.sort(key=lambda x: int(x[0][0]))  # parts of the names, which ascend
        names = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(x[0]) for x in told)])
        before = np.cumsum([0] + [len(x[0]) for x in told])
        at = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(x[1].astype(np.int64)) + i for x, i in zip(told, before))])
        kind, value = (np.concatenate([np.zeros(0, t), *(x[i] for x in told)]) for i, t in ((2, np.uint8), (3, np.int64)))
        of_words = _numbered(sums.value)
        rows, log, n = None, np.zeros(len(key)), np.zeros(len(key))
        for a, b, c, unit in slots:
            slot = _Slot(a, b, c, unit, key, weight, codes, frequent, True)
            for context in slot.contexts:
                context.told(names, at, kind, value)
            slot.words.numbered(*of_words)
            n1, _ = slot.words.rest()
            f = slot.fold2
            p = _mixed(n1, d1, total[f], kinds[f], 1 / (kinds[f] + 1.0))
            p = _mixed(slot.n2, d2, *slot.after_one.rest(), p)[slot.pair]
            p = _mixed(slot.n3, d3, *slot.after_two.rest(), p)
            log += np.bincount(slot.unit, slot.weight * np.log(p)[slot.row], len(key))
            n += np.bincount(slot.unit, slot.weight, len(key))
        key, at = np.unique(key, return_inverse=True)
        log, n = np.bincount(at, log), np.bincount(at, n).astype(np.int64)
        cuts = np.concatenate([[0], np.searchsorted(key, _bounds(parts, 2**63).view(np.int64)), [len(key)]])
        for p, (i, z) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if z > i:
                yield _batch([(p, z - i, _pack(np.diff(key[i:z], prepend=0)), _pack(log[i:z]), _pack(n[i:z]))], _SUMS)

    return arrow_map(both, _freed(run), _SUMS)


def _added(sums: DataFrame) -> DataFrame:
    """(key, _log, n_scored) of each text: the sums of all tasks."""

    def run(batches):
        rows = [r for batch in batches for r in _rows(batch)]
        if rows:
            key, at = np.unique(np.concatenate([np.cumsum(x) for x in _unpack(rows, "key", np.int64, "n")]), return_inverse=True)
            log, n = (np.bincount(at, np.concatenate(_unpack(rows, x, t, "n"))) for x, t in (("log", np.float64), ("scored", np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(log), pa.array(n.astype(np.int64))], names=["key", "_log", "n_scored"])

    return arrow_map(sums, _freed(run), "key long, _log double, n_scored long")


@contextmanager
def _cleaned(spark: SparkSession):
    """Shuffle files of a query go when it ends, not when the driver collects
    garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` as Parquet in the shared folder; their exchanges are removed."""
    spark = rows.sparkSession
    with _cleaned(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _emptied(spark: SparkSession, path: str):
    """Overwrite a table that isn't needed any more."""
    spark.createDataFrame([], _ASKED).write.mode("overwrite").parquet(path)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sums(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the packed numbers of rows that belong to no part."""

    def run(batches):
        out = np.zeros(size, np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                out += _unpack([r], "value", np.int64, "m")[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], names=["i", "n"])

    found = {r.i: r.n for r in arrow_map(rows, run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return np.array([found.get(i, 0) for i in range(size)])


def _discount(n1: int, n2: int) -> float:
    return float(min(max(n1 / max(1, n1 + 2 * n2), 0.1), 0.95))


def text_key(text: str = "text"):
    """Column: the number that stands for a text (never negative)."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, word_ppl, n_scored): mean negative log-probability of a word of
    each text with words, by ``text_key``, and its words (of all copies)."""
    keyed = docs.where(F.col(text).isNotNull()).select(text_key(text).alias("key"), F.col(text).alias("text"))
    size, often, words = _sizes(keyed)
    often = sorted((w % 2**64, n) for w, n in often)
    frequent = np.array([w for w, _ in often], np.uint64)
    pieces = np.array([-(-n // BUCKET) for _, n in often], np.uint64)
    passes = max(1, min(PASSES, -(-size // BUCKET)))
    each = max(1, -(-size // (BUCKET * passes)))  # slots of a pass
    group = max(1, min(GROUP, each // TASKS))  # slots of a task
    tasks = -(-each // group)  # of a pass
    slots, parts = each * passes, max(1, -(-each * passes // 6))  # parts of the names and of the texts
    spark, folder = docs.sparkSession, f"{ensure_checkpoint_dir(docs.sparkSession)}/words-{uuid.uuid4().hex}"
    words = spark.sparkContext.broadcast(words)

    coded = _stored(_coded(keyed, words), f"{folder}/coded")

    def dealt(k):
        return _dealt(coded, words, frequent, pieces, slots, k * each, (k + 1) * each, group)

    def asked_of(k):
        return _asked_of(dealt(k).repartitionById(tasks, "part"), words, frequent, parts, k * tasks, group)

    asked = [_stored(asked_of(k), f"{folder}/asked-{k}") for k in range(passes)]
    found = _sums(_union(asked).where("part is null"), 4)
    answers = _stored(_answers(_union(asked).where("part is not null"), parts), f"{folder}/answers")
    total, known, once, twice, *by_fold = _sums(answers.where("slot is null"), 4 + 2 * FOLDS).tolist()
    numbered = [r.asDict() for r in answers.where(F.col("slot") == _ALL).select("m", "at", "kind", "value").collect()]  # at most CODES words
    numbered = spark.sparkContext.broadcast([{k: bytes(v) if k != "m" else v for k, v in r.items()} for r in numbered])
    for k in range(passes):
        _emptied(spark, f"{folder}/asked-{k}")
    discounts = _discount(found[0], found[1]), _discount(found[2], found[3]), _discount(once, twice)
    totals, kinds = total - np.array(by_fold[:FOLDS]), known - np.array(by_fold[FOLDS:])

    def sums_of(k):
        own = answers.where(F.col("slot").between(k * tasks, (k + 1) * tasks - 1)).withColumn("part", F.col("slot") - k * tasks)
        both = dealt(k).unionByName(own.drop("slot"), allowMissingColumns=True).repartitionById(tasks, "part")
        sums = _text_sums(both, words, numbered, frequent, discounts, totals, kinds, group, parts)
        return _added(sums.repartitionById(parts, "part"))

    sums = _union([_stored(sums_of(k), f"{folder}/sums-{k}") for k in range(passes)])
    _emptied(spark, f"{folder}/coded")
    out = sums.groupBy("key").agg(F.sum("_log").alias("_log"), F.sum("n_scored").alias("n_scored"))
    return out.select("key", (-F.col("_log") / F.col("n_scored")).alias("word_ppl"), "n_scored")
