"""Byte-pair encoding by a deterministic automaton over tokens.

``compile_merges`` turns a list of merges into the automaton that accepts just
the correct tokenisations. It starts with one state in which every symbol of
the alphabet loops (symbols that end a word lead to the last state), and each
merge ``u v -> t``, in order of rank, is one gadget: the target of ``u`` is
copied without its arc ``v``, ``u`` now leads to the copy, and wherever ``u``
goes out, ``t`` goes out too, to the target of ``v``. All arcs of a token so
have one target, and there is at most a state more for every merge.

Arcs are stored as tables. A copied state lacks the arc ``v`` and, as they
take their place from it, all later tokens whose chain of left parts holds
``v``. With tokens numbered by a walk over the tree of left parts (newest
first) that is one run of numbers, so the missing arcs of a state are a sorted
list of runs, and a transition is a search in it. A merge of a token with
itself has no second arc after the first: its copy lacks the new token too,
which is in the same run.

A text is cut into words by the tokenizer's own rules (``words_of``: special
tokens, normaliser, splitter; public library code that a unit of text meets
once). Encoding reads a word from left to right: the arcs that spell it from
each place on come from a trie, all places at once, and an arc is taken when the state
reached has it. Exactly one arc arrives at each place, so the path read back
from the end is the tokenisation. Equal words are encoded once in a while.
Decoding emits the labels of the arcs.

Defined results: null and empty texts have no ids and decode to the empty text;
special tokens inside a text are one id, as the library reads them; a symbol
that the vocabulary lacks is left out; long words and texts are encoded whole;
each of several equal rows (null or repeated ids too) gives a row; an empty
table gives an empty result; input columns named like an output are replaced.
Merges whose parts aren't symbols or made by earlier merges raise: only then
could the order of merges differ from the rank of pairs.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm._text import hash_spans, map_texts
from tessera.llm.group_packing import _units, default_tokenizer

LONG_WORD = 256  # symbols; longer words are read one after the other


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, then code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@dataclass
class Automaton:
    """Tables of the automaton. Tokens are numbered as in the vocabulary."""

    target: np.ndarray  # token -> state
    order: np.ndarray  # token -> its number in the walk over left parts
    first: np.ndarray  # state -> where its runs of missing arcs start (states + 1)
    run_start: np.ndarray  # runs of walk numbers without an arc, ascending in a state
    run_stop: np.ndarray
    trie_key: np.ndarray  # node * 512 + symbol, ascending
    trie_next: np.ndarray
    trie_token: np.ndarray  # node -> token or -1

    def __post_init__(self):
        state = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.run_key = state.astype(np.int64) << 32 | self.run_start

    def has_arc(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each state has an arc with each token."""
        at = np.searchsorted(self.run_key, state.astype(np.int64) << 32 | self.order[token], "right") - 1
        inside = (at >= self.first[state]) & (self.run_stop[np.maximum(at, 0)] > self.order[token])
        return ~inside

    def walk(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next trie nodes (-1: none)."""
        key = node.astype(np.int64) * 512 + symbol
        at = np.minimum(np.searchsorted(self.trie_key, key), len(self.trie_key) - 1)
        return np.where(self.trie_key[at] == key, self.trie_next[at], -1)


def compile_merges(spelling: dict[int, tuple[int, ...]], merges: list[tuple[int, int, int]]) -> Automaton:
    """``spelling``: the tokens that are one symbol (0 to 511; from 256 on they
    end a word); ``merges``: (left, right, token) in order of rank."""
    size = 1 + max([*spelling, *(t for _, _, t in merges)])
    made = dict.fromkeys(spelling, -1)
    dead: set[int] = set()  # tokens of merges whose parts never meet: no text has them
    left, target = [-1] * size, [0] * size
    symbols = [()] * size
    for t, s in spelling.items():
        target[t], symbols[t] = int(s[0] >= 256), s
    # states 0 (inside a word) and 1 (behind its end, no arcs)
    parent, removed, born = [-1, -1], [-1, -1], [-1, -1]

    def has(state: int, token: int) -> bool:
        """Undo the newer of state and token until both are as at the start."""
        while True:
            if state == 1:
                return False
            if born[state] < 0 and made[token] < 0:
                return True
            if born[state] >= made[token]:
                if removed[state] == token or (born[state] == made[token] and left[token] == removed[state]):
                    return False
                state = parent[state]
            else:
                token = left[token]

    for rank, (u, v, t) in enumerate(merges):
        if u not in made or v not in made or t in made:
            raise ValueError(f"merge {rank} has a part that no earlier merge makes, or makes a known token")
        meets = u not in dead and v not in dead and has(target[u], v)
        made[t], left[t], target[t], symbols[t] = rank, u, target[v], symbols[u] + symbols[v]
        if meets:
            parent.append(target[u])
            removed.append(v)
            born.append(rank)
            target[u] = len(parent) - 1
        else:
            dead.add(t)

    # numbers of the walk: a token, then what it is the left part of, newest first
    below: list[list[int]] = [[] for _ in range(size)]
    for t in sorted(made, key=made.get, reverse=True):
        if left[t] >= 0:
            below[left[t]].append(t)
    order, last, n = [0] * size, [0] * size, 0
    stack = [(t, False) for t in sorted(spelling, reverse=True)]
    while stack:
        t, done = stack.pop()
        if done:
            last[t] = n
            continue
        order[t] = n
        n += 1
        stack.append((t, True))
        stack += [(c, False) for c in reversed(below[t])]
    newest = [[-made[c] for c in below[t]] for t in range(size)]

    # runs without an arc: of the parent, and what the removed arc carries since then
    runs: list[list[tuple[int, int]]] = [[], [(0, n)]]
    for s in range(2, len(parent)):
        v, k = removed[s], born[s]
        j = bisect_right(newest[v], -k)  # those made at rank k or later
        stop = order[below[v][j]] if j < len(below[v]) else last[v]
        runs.append(_joined(runs[parent[s]], (order[v], stop)))
    first = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    flat = np.array([x for r in runs for x in r], np.int32).reshape(-1, 2)

    nodes: dict[tuple[int, int], int] = {}
    token_of = [-1]
    for t in made.keys() - dead:
        node = 0
        for c in symbols[t]:
            key = (node, c)
            if key not in nodes:
                nodes[key] = len(token_of)
                token_of.append(-1)
            node = nodes[key]
        token_of[node] = t
    key = np.array([a * 512 + c for a, c in nodes], np.int64)
    by = np.argsort(key)
    following = np.fromiter(nodes.values(), np.int32, len(nodes))
    return Automaton(
        np.array(target, np.int32), np.array(order, np.int32), first, flat[:, 0].copy(), flat[:, 1].copy(),
        key[by], following[by], np.array(token_of, np.int32),
    )


def _joined(runs: list[tuple[int, int]], new: tuple[int, int]) -> list[tuple[int, int]]:
    """Ascending disjoint runs with one more; touching ones become one."""
    a, z = new
    i = bisect_right(runs, (a, -1))
    if i and runs[i - 1][1] >= a:
        i -= 1
        a = runs[i][0]
    j = i
    while j < len(runs) and runs[j][0] <= z:
        z = max(z, runs[j][1])
        j += 1
    return [*runs[:i], (a, z), *runs[j:]]


def read_vocabulary(path: str) -> tuple[Automaton, list[bytes]]:
    """The automaton of a tokenizer file of byte-level symbols with word ends,
    and the label of every id (the entry's own text in UTF-8)."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, end = whole["model"], whole["model"]["end_of_word_suffix"] or ""
    if model["type"] != "BPE" or model["continuing_subword_prefix"] or whole["decoder"]:
        raise ValueError("expected a byte-pair vocabulary without prefixes and decoder")
    vocab = model["vocab"]
    spelling = {vocab[c]: (b,) for b, c in enumerate(byte_symbols()) if c in vocab}
    if end:
        spelling |= {vocab[c + end]: (256 + b,) for b, c in enumerate(byte_symbols()) if c + end in vocab}
    merges = []
    for pair in model["merges"]:
        u, v = pair if isinstance(pair, list) else pair.split(" ")
        merges.append((vocab[u], vocab[v], vocab[u + v]))
    labels = [b""] * (1 + max([*vocab.values(), *(a["id"] for a in whole["added_tokens"])]))
    for text, i in vocab.items():
        labels[i] = text.encode()
    for a in whole["added_tokens"]:
        labels[a["id"]] = a["content"].encode()
    return compile_merges(spelling, merges), labels


class Coder:
    """Encodes and decodes texts in a task. Ids of the units met are kept, by
    their 64-bit hash, until ``most`` units are known; then the table starts anew."""

    def __init__(self, path: str, automaton: Automaton, labels: list[bytes], most: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.rules, self.automaton, self.most = Tokenizer.from_file(path), automaton, most
        special = {t.content: i for i, t in self.rules.get_added_tokens_decoder().items()}
        self.special = special
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.byte = {c: b for b, c in enumerate(byte_symbols())}
        size = np.array([len(x) + 1 for x in labels])
        self.label_at, self.label_size = np.cumsum(size) - size, size
        self.label = np.frombuffer(b"".join(b" " + x for x in labels), np.uint8)  # labels are parted by a blank
        self._forget()

    def _forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def words_of(self, text: str) -> list:
        """Words as bytes, and special tokens as ids, by the tokenizer's rules."""
        out, at = [], 0
        for m in [*(self.cut.finditer(text) if self.cut else ()), None]:
            part = text[at : m.start() if m else len(text)]
            if part:
                normal = self.rules.normalizer.normalize_str(part) if self.rules.normalizer else part
                for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(normal):
                    out.append(bytes(map(self.byte.__getitem__, w)))
            if m:
                out.append(self.special[m.group()])
                at = m.end()
        return out

    def _words_of_units(self, units: list[bytes]) -> tuple[list, list[int]]:
        """Words of all units, and how many each has. A unit of lower-case ASCII
        letters is a word as it is."""
        words, count = [], []
        for unit in units:
            own = [unit] if unit.isalpha() and unit.isascii() and unit.islower() else self.words_of(unit.decode())
            words += own
            count.append(len(own))
        return words, count

    def encode_words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (bytes; an int stands for itself), one after the other,
        and how many each has."""
        distinct: dict = {}
        which = np.array([distinct.setdefault(w, len(distinct)) for w in words], np.int64)
        parts: list = [None] * len(distinct)
        by_size: dict[int, list] = {}
        for w, i in distinct.items():
            if isinstance(w, int):
                parts[i] = np.array([w], np.uint32)
            elif len(w) > LONG_WORD:
                parts[i] = self._read_long(w)
            else:
                by_size.setdefault(len(w), []).append((w, i))
        for size, own in by_size.items():
            for a in range(0, len(own), 1 << 15):
                some = own[a : a + (1 << 15)]
                for ids, (_, i) in zip(self._read_all(np.frombuffer(b"".join(w for w, _ in some), np.uint8).reshape(-1, size)), some):
                    parts[i] = ids
        size = np.array([len(p) for p in parts], np.int64)
        ids = np.concatenate([np.zeros(0, np.uint32), *(parts[i] for i in which.tolist())])
        return ids, size[which]

    def _arcs(self, symbol: np.ndarray):
        """(word, from, to, token) of all tokens that spell a part of a word;
        ``symbol`` has a word a row, its last symbol marked as the end."""
        n, size = symbol.shape
        word, start = np.divmod(np.arange(n * size), size)
        node = np.zeros(n * size, np.int64)
        found = []
        for length in range(1, size + 1):
            live = start + length <= size
            word, start, node = word[live], start[live], node[live]
            node = self.automaton.walk(node, symbol[word, start + length - 1])
            live = node >= 0
            word, start, node = word[live], start[live], node[live]
            if not len(word):
                break
            token = self.automaton.trie_token[node]
            hit = token >= 0
            found.append((word[hit], start[hit], start[hit] + length, token[hit]))
        return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4

    def _ends(self, data: np.ndarray) -> np.ndarray:
        symbol = data.astype(np.int64)
        symbol[:, -1] += 256
        return symbol

    def _read_all(self, data: np.ndarray) -> list[np.ndarray]:
        """Ids of words of one length (a row each), place by place."""
        n, size = data.shape
        word, start, stop, token = self._arcs(self._ends(data))
        by = np.argsort(start, kind="stable")
        word, start, stop, token = word[by], start[by], stop[by], token[by]
        bound = np.searchsorted(start, np.arange(size + 1))
        arrived = np.full((n, size + 1), -1, np.int64)  # token of the arc that arrives at a place
        came = np.zeros((n, size + 1), np.int64)
        for at in range(size):
            own = slice(bound[at], bound[at + 1])
            w, t, z = word[own], token[own], stop[own]
            before = arrived[w, at]
            state = np.where(at == 0, 0, self.automaton.target[before])
            take = self.automaton.has_arc(state, t) & ((before >= 0) | (at == 0))
            arrived[w[take], z[take]] = t[take]
            came[w[take], z[take]] = at
        ids, count = np.zeros((n, size), np.uint32), np.zeros(n, np.int64)
        place, row = np.full(n, size), np.arange(n)
        while len(row):
            t = arrived[row, place]
            good = t >= 0  # a word with an unknown symbol has no path
            row, place, t = row[good], place[good], t[good]
            ids[row, size - 1 - count[row]] = t
            count[row] += 1
            place = came[row, place]
            row, place = row[place > 0], place[place > 0]
        return [ids[i, size - c :] for i, c in enumerate(count.tolist())]

    def _read_long(self, word: bytes) -> np.ndarray:
        """Ids of one word, arcs looked up in parts of it."""
        data = np.frombuffer(word, np.uint8)
        symbol = self._ends(data[None, :])
        size = len(data)
        node, start = np.zeros(size, np.int64), np.arange(size)
        arcs: list[list] = [[] for _ in range(size)]
        length = 0
        while len(start):
            length += 1
            live = start + length <= size
            start, node = start[live], node[live]
            node = self.automaton.walk(node, symbol[0, start + length - 1])
            start, node = start[node >= 0], node[node >= 0]
            token = self.automaton.trie_token[node]
            for s, t in zip(start[token >= 0].tolist(), token[token >= 0].tolist()):
                arcs[s].append((s + length, t))
        arrived, came = [-1] * (size + 1), [0] * (size + 1)
        target, order = self.automaton.target, self.automaton.order
        for at in range(size):
            if at and arrived[at] < 0:
                continue
            state = int(target[arrived[at]]) if at else 0
            lo, hi = int(self.automaton.first[state]), int(self.automaton.first[state + 1])
            for z, t in arcs[at]:
                i = lo + int(np.searchsorted(self.automaton.run_start[lo:hi], order[t], "right")) - 1
                if i < lo or self.automaton.run_stop[i] <= order[t]:
                    arrived[z], came[z] = t, at
        out, at = [], size
        while at > 0 and arrived[at] >= 0:
            out.append(arrived[at])
            at = came[at]
        return np.array(out[::-1], np.uint32)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and where each text's ids start (n + 1)."""
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

    def _learn(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray):
        """Add units (their hashes ascend) to the table."""
        raw = low.tobytes()
        words, count = self._words_of_units([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
        ids, size = self.encode_words(words)
        unit = np.repeat(np.arange(len(count)), count)
        size = np.bincount(unit, weights=size, minlength=len(count)).astype(np.int64)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.used += len(ids)

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the ids, parted by blanks, as the library joins entries
        of a vocabulary without a decoder."""
        if not len(ids):
            return b""
        n = self.label_size[ids]
        stop = np.cumsum(n)
        return self.label[np.arange(stop[-1]) + np.repeat(self.label_at[ids] - (stop - n), n)].tobytes()[1:]


_CODERS: dict = {}  # of this process; a worker runs many tasks


def coder(path: str, tables=None) -> Coder:
    """The coder of this process. ``tables``: the compiled automaton and labels."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path, *(tables or read_vocabulary(path)))
    return _CODERS[path]


def encode_documents(docs: DataFrame, tokenizer: str | None = None, text: str = "text", ids: bool = True, decoded: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    32-bit integers) and, if asked for, ``ids`` (array), ``decoded`` (text) and
    always ``decoded_sha256``. The automaton (its size is set by the vocabulary,
    about 40 MB for 49,000 merges) is compiled once and broadcast."""
    path = tokenizer or default_tokenizer()
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        own = coder(path, shared.value if path not in _CODERS else None)

        def run(part, data, offs):
            flat, at = own.encode(data, offs)
            flat = flat.astype("<u4")
            spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
            texts = (own.decode(flat[a:z]) for a, z in spans)
            if decoded:
                texts = list(texts)
            out = [
                pa.array(np.diff(at).astype(np.int64)),
                pa.array([hashlib.sha256(flat[a:z]).hexdigest() for a, z in spans], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
            ]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32))))
            if decoded:
                out.append(pa.array([x.decode() for x in texts], pa.string()))
            return out

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    return map_texts(docs, text, fields, make)


def digest_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The ``documents`` table: counts and digests, a row each."""
    rows = encode_documents(docs.select("doc_id", "text"), tokenizer, ids=False, decoded=False)
    return rows.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
