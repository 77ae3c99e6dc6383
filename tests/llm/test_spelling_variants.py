"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import spelling_variants as S
from tessera.llm.queries import op12_spelling

LETTERS = "abcdefghijklmnopqrstuvwxyzéèßÿ×"


def plain_words(rows, every=199):
    out = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(words):
    near = {w: [o for o in words if o != w and abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = top if top and words[top] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def variant_rows(seed, n_words=60):
    """Documents with words, their misspellings and chains of them."""
    rng = random.Random(seed)
    base = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(6, 12))) for _ in range(n_words)]
    count = Counter()
    for w in base:
        n = rng.choice([5, 30, 150, 700])
        count[w] += n
        while n >= 25:  # a chain of ever rarer variants
            at, n = rng.randrange(len(w)), n // 5
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(LETTERS) + w[at:], w[:at] + rng.choice(LETTERS) + w[at + 1 :]])
            count[w] += n
    every = [w if rng.random() < 0.7 else w.upper().replace("SS", "ß") for w, n in count.items() for _ in range(n)]
    rng.shuffle(every)
    return [(i if i % 7 else None, " ".join(every[i * 50 : i * 50 + 50]) + rng.choice([" 12!", "\n\t", "..."])) for i in range(len(every) // 50 + 1)]


@pytest.mark.parametrize("symbols", [None, 2, 8])
def test_equals_all_pairs(spark, symbols):
    docs = spark.createDataFrame(variant_rows(3), "doc_id long, text string").repartition(5)
    got = result(S.variants(docs, symbols=symbols))
    want = plain_forms(plain_words(docs.collect()))
    assert got == want
    assert sum(1 for w, f, r, *_ in want if f and r != f) > 0  # chains of more than one step


def test_long_words_and_odd_rows(spark, odd_docs):
    long = "ab" * 2_000
    rows = [(i, f"{long} {long}x {long[:-1]} Ünïcode Ünïcöde") for i in range(6)] + [(None, None), (9, ""), (9, "\xd7\xf7\xd7\xf7\xd7\xf7 " * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(S.variants(docs, every=0))
    assert got == plain_forms(plain_words(docs.collect(), every=10**12))
    assert {r[0]: r[4] for r in got}[long] == 2
    assert result(S.variants(odd_docs)) == plain_forms(plain_words(odd_docs.collect()))
    assert S.variants(odd_docs.limit(0)).count() == 0


def test_crc32_of_spans():
    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    ends = np.cumsum([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    seed = np.array([zlib.crc32(b"%d:" % i) for i in range(200)], np.uint32)
    got = S.crc32_spans(data, ends - [len(p) for p in parts], ends, seed)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + p) for i, p in enumerate(parts)]


def test_neighbourhood_holds_every_edit():
    rng = random.Random(4)
    for size in (1, 2, 6, 9):
        row = np.array([[rng.randrange(1, 4) for _ in range(size)]], np.uint64)
        around = set(S.neighbourhoods(row, 3).ravel().tolist())
        word, edits = row[0].tolist(), {tuple(row[0].tolist())}
        for i in range(size + 1):
            edits |= {tuple(word[:i] + [s] + word[i:]) for s in (1, 2, 3)}
            if i < size:
                edits |= {tuple(word[:i] + [s] + word[i + 1 :]) for s in (1, 2, 3)} | {tuple(word[:i] + word[i + 1 :])}
        assert around == {int(S.reduced_hashes(np.array([e], np.uint64).reshape(1, -1))[0]) for e in edits}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = result(op12_spelling(spark, sf))
    assert got == plain_forms(plain_words(spark.read.parquet(f"{sf}/documents.parquet").collect()))
