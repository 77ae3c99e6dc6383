"""Alignment of two tokenizers against the libraries on whole texts and all
pairs of tokens."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import token_alignment as A
from tessera.llm._letters import texts_to_bytes

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = A.default_tokenizers()
    first = Tokenizer.from_file(a)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=b)


def byte_of():
    """Byte-level characters by the rule of the public vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)})
    return out


BYTES = byte_of()


def plain_tokens(text):
    """(ids of a, ids of b, ends of a, ends of b) of whole texts."""
    if not text:
        return [], [], [], []
    first, second = libraries()
    e = first.encode(" " + text, add_special_tokens=False)
    part_a = [bytes(BYTES[c] for c in t) for t in e.tokens]
    ids_b = second.encode(text)
    part_b = []
    for i in ids_b:
        piece = second.id_to_piece(i)
        part_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(part_a) != whole or b"".join(part_b) != whole:
        return [], [], [], []
    return e.ids, ids_b, np.cumsum([len(p) for p in part_a]).tolist(), np.cumsum([len(p) for p in part_b]).tolist()


def plain_alignment(rows, kind="end"):
    """Expected rows of ``align``, from all pairs of a document's tokens."""
    found, count = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, end_a, end_b = plain_tokens(text)
        start_a, start_b = [0, *end_a[:-1]], [0, *end_b[:-1]]
        over = []
        low = 0
        for i in range(len(ids_a)):
            while end_b[low] <= start_a[i]:
                low += 1
            j = low
            while j < len(ids_b) and start_b[j] < end_a[i]:
                over.append((i, j))
                j += 1
        ends = sorted(set(end_a) & set(end_b))
        groups, x, y = [], 0, 0
        for z in ends:
            i, j = end_a.index(z, x) + 1, end_b.index(z, y) + 1
            groups.append(",".join(map(str, ids_a[x:i])) + "|" + ",".join(map(str, ids_b[y:j])))
            x, y = i, j
        links = over if kind == "overlap" else [(i, j) for i, j in over if end_a[i] == end_b[j]]
        links = [(ids_a[i], ids_b[j]) for i, j in links]
        count.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        found.append((doc_id, len(ids_a), len(ids_b), len(groups), links, digest, len(over)))
    top: Counter = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, digest, n_over in found:
        best = sum(count[p] == top[p[1]] for p in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(count[p] for p in links), digest, n_over))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select(COLUMNS).collect()], key=str)


def odd_texts():
    rng = random.Random(8)
    out = [
        "Hello <|endoftext|> World's ÉΣ é x́<s> </s> <unk> <0x41>", "  two  blanks  here ", " ", "\n\n a\tb \n", "你好 αβΣ　x y\u0085z  w", "ab" * 3000,
        "a\x00b \x7f", "é è à  é", "don't we'll", "", None, "word word   word", "▁ a▁b",
    ]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x250), rng.randrange(32, 0x3000), 32, 10])) for _ in range(150)) for _ in range(40)]
    return out + ["".join(rng.choice("aehlnot  \n") for _ in range(300)) for _ in range(20)]


@pytest.mark.parametrize("kind", A.KINDS)
def test_odd_texts(spark, kind):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts())]
    rows += rows[:4] + [(5, "the same text"), (5, "the same text"), (5, "another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_alignment(rows, kind)
    assert result(A.align(df, kind=kind)) == want
    assert result(A.align(df, kind=kind, chunk_bytes=200)) == want  # many chunks share pairs


def test_documents(spark, docs, odd_docs):
    for df in (docs, odd_docs):
        got = result(A.align_documents(df))
        assert got == plain_alignment([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert A.align_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        A.align(docs, kind="start")


def test_pieces_that_do_not_spell_the_text_take_all_tokens_away():
    class Wrong:
        entries = [b" ", b"a", b"b", b"?"]

        def encode(self, units):
            return [[3 if c == "b" and self is two else " ab".index(c) for c in u] for u in units]

    one, two = Wrong(), Wrong()
    data, offs = texts_to_bytes(["a a", "ab a", "", "aa"])
    (a, b), good = A.tokens(A.Side(one), A.Side(two), data, offs)
    assert good.tolist() == [True, False, False, True]
    assert a[1].tolist() == [0, 0, 0, 0, 3, 3, 3] == b[1].tolist()
