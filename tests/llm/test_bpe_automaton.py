"""Byte-pair encoding by an automaton, against merging pair by pair and the library."""

import functools
import hashlib
import random

import numpy as np
import pytest

from tessera.llm import bpe_automaton
from tessera.llm.group_packing import default_tokenizer


def merge_by_rank(symbols, merges):
    """Plain encoding: the pair of lowest rank merges, leftmost first."""
    rank = {(u, v): (i, t) for i, (u, v, t) in enumerate(merges)}
    ids = list(symbols)
    while True:
        found = [(rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        if not found:
            return ids
        _, i = min(found)
        ids[i : i + 2] = [rank[ids[i], ids[i + 1]][1]]


class Tables(bpe_automaton.Coder):
    """A coder without a tokenizer file."""

    def __init__(self, automaton):
        self.automaton = automaton


@pytest.mark.parametrize("seed", range(12))
def test_random_merges(seed):
    rng = random.Random(seed)
    spelling = {i: (97 + i,) for i in range(3)} | {3 + i: (256 + 97 + i,) for i in range(3)}
    merges, tokens, spelt = [], list(spelling), {i: s for i, s in spelling.items()}
    while len(merges) < 40:  # some merges never meet, as an earlier one takes a part away
        u, v = rng.choice(tokens), rng.choice(tokens)
        whole = spelt[u] + spelt[v]
        if spelt[u][-1] >= 256 or len(whole) > 8 or whole in spelt.values():
            continue
        t = len(tokens)
        merges.append((u, v, t))
        tokens.append(t)
        spelt[t] = whole
    own = Tables(bpe_automaton.compile_merges(spelling, merges))
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))).encode() for _ in range(400)]
    words += [b"a" * n for n in range(1, 30)] + [b"ab" * n for n in range(1, 12)]
    ids, size = own.encode_words(words)
    got = np.split(ids, np.cumsum(size)[:-1])
    for w, g in zip(words, got):
        want = merge_by_rank([b - 97 for b in w[:-1]] + [w[-1] - 97 + 3], merges)
        assert g.tolist() == want
        assert own._read_long(w).tolist() == want


def test_merge_out_of_order_raises():
    with pytest.raises(ValueError):
        bpe_automaton.compile_merges({0: (97,), 1: (98,)}, [(2, 0, 3), (0, 1, 2)])


@functools.cache
def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def _library(text):
    t = _tokenizer()
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_equals_the_library(spark, docs, odd_docs):
    rng = random.Random(8)
    odd = [
        "Hello <|endoftext|> World's", "a<|startoftext|>b<|endoftext|><|endoftext", "don't we'll it'S I'M '''s ''", "ÉΣ İstanbul ﬁ x́ é",
        "你好 αβΣ 　  x y\u0085z", "\x00 \x01a \x7f", "=======!!!!!!??", "x" * 3000, "ab1" * 900, "'" * 700, "", None,
    ]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x250), rng.randrange(32, 0x3000)])) for _ in range(150)) for _ in range(60)]
    own = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for df in (own, docs.select("doc_id", "text"), odd_docs):
        rows = bpe_automaton.encode_documents(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            ids, text = _library(r.text)
            assert r.ids == ids and r.decoded == text and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_digests(spark, docs):
    assert bpe_automaton.digest_documents(docs.limit(0)).count() == 0
    out = bpe_automaton.digest_documents(docs)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    some = {r.doc_id: r.n_tokens for r in out.collect()}
    for r in docs.collect():
        assert some[r.doc_id] == len(_library(r.text)[0])
