"""Quality rules with a perplexity filter.

Base rules come from the words of a text (counts of characters, symbols,
repeated lines and words in repeated five-word windows). Texts that pass them
are judged by two n-gram language models, of words and of symbols.

Words (``kn_words``): sequences of three words of all texts, dealt by Spark to
slots that grow with the corpus; each text is scored by the counts of other
texts. Each language has an upper limit, ``above_words`` robust deviations over
the median of its distinct texts that aren't near copies (half of the ninth
decile or more); shuffled words and lists of words lie over it. There is no
lower limit, since copies are predictable and near duplicates are another
operator's work. ``log_ppl`` is this measure, 0 for texts without words.

Symbols, for spelling and marks:

* Texts become symbols (64 classes: letters, capitals in a row, digits, kinds
  of punctuation, line ends, classes of other code points); Spark counts all
  four-symbol sequences of all texts by language, summed in every task first.
* A modified Kneser-Ney model (three discounts an order, continuation counts
  below the highest) is computed from the counts and stored as sorted arrays of
  64-bit hashes of (language, n-gram) with log-probabilities and back-off
  weights. The alphabet bounds it: at most 64**4 sequences a language, of
  which texts use about one in a hundred; languages beyond the ``languages``
  most frequent share one model.
* A text's symbol log-perplexity is its mean negative log-probability a symbol, each
  stretch of 64 symbols by the best of its language's model and those of the
  ``MIXED`` most frequent languages, as clean texts may mix languages. Each
  language has a lower and an upper limit, ``below`` and ``above`` robust
  deviations from its median, widened for short texts by their larger sampling
  error; a text outside is rejected: too predictable, or unlike the language.
  Letters beyond ASCII are told apart by their first two UTF-8 bytes only; the
  words judge those.

Defined results: a null or empty text has no words and fails the base rules; a
null ``lang`` is a language of its own; a language with few texts still has a
band from deviations of at least ``floor`` nats; repeated rows count and are judged alike; an
empty table gives an empty result. Input columns named like an output are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import kn_words
from tessera.llm._text import IS_WORD, arrow_map, hash_spans, map_texts, mix, spans, text_slices, without

ORDER = 4
SYMBOL_BITS = 6
SYMBOLS = 1 << SYMBOL_BITS
WINDOW = 5
STRETCH = 64
MIXED = 8
#: of the rows of the MIXED languages' models, if they have rows for all their contexts
MIXED_BYTES = 64 << 20
#: fixed values: characters that count as symbols of the base rules
SYMBOL_CHARS = b"#*$%&|<>"
OTHER = "\x00other"  # the shared model of rare languages

_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = 28
for _chars, _c in ((b".,;:", 29), (b"'\"()-", 30), (b"!?", 31), (SYMBOL_CHARS, 32), (b"@/_=+~^`\\{}[]", 33), (b"\n", 34)):
    _CLASS[list(_chars)] = _c
_CLASS[[b for b in range(32) if b not in (9, 10, 11, 12, 13)] + [127]] = 35
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def symbols(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, one for each code point (a run of one mark or
    blank counts once), and their bounds."""
    lead = (data & 0xC0) != 0x80
    s = _CLASS[data]
    again = np.zeros(len(data), bool)
    again[1:] = (data[1:] == data[:-1]) & ((s[1:] == 0) | (s[1:] > 28)) & (data[1:] < 128)
    again[offs[:-1][offs[:-1] < len(data)]] = False
    lead &= ~again
    capital = _CAPITAL[data]
    run = np.zeros(len(data), bool)
    run[1:] = capital[1:] & capital[:-1]
    s[run] = 27
    wide = np.flatnonzero(data >= 0xC0)
    after = data[np.minimum(wide + 1, len(data) - 1)]
    s[wide] = 36 + (data[wide].astype(np.int32) * 31 + after) % 28
    return s[lead], np.concatenate([[0], np.cumsum(lead)])[offs]


def grams(s: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sequence of ORDER symbols that ends at each symbol (24 bits); blanks
    stand before a text."""
    code = s.astype(np.int32)
    starts = bounds[:-1][np.diff(bounds) > 0]
    for k in range(1, ORDER):
        before = np.zeros(len(s), np.int32)
        before[k:] = s[:-k]
        ends = bounds[1:][np.diff(bounds) > 0]
        for j in range(k):
            at = starts + j
            before[at[at < ends]] = 0
        code |= before << (SYMBOL_BITS * k)
    return code


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, code, n): four-symbol sequences of all texts of ``docs(lang, text)``."""

    def run(batches):
        names: dict = {}
        held, total = [], 0

        def merged():
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            keys, inverse = np.unique(keys, return_inverse=True)
            return keys, np.bincount(inverse, weights=counts).astype(np.int64)

        for batch in batches:
            for start, stop, data, offs in text_slices(batch, "text"):
                s, bounds = symbols(data, offs)
                own = [names.setdefault(v, len(names)) for v in batch.column(0).slice(start, stop - start).to_pylist()]
                key = grams(s, bounds).astype(np.int64) | np.repeat(np.array(own, np.int64), np.diff(bounds)) << (ORDER * SYMBOL_BITS)
                if len(names) < 1 << (31 - ORDER * SYMBOL_BITS):
                    key = key.astype(np.int32)  # sorted faster
                key, n = np.unique(key, return_counts=True)
                held.append((key.astype(np.int64), n))
                total += len(held[-1][0])
                if total > 2_000_000:
                    held = [merged()]
                    total = len(held[0][0])
        if held:
            keys, counts = merged()
            lang = keys >> (ORDER * SYMBOL_BITS)
            known = pa.array(list(names), pa.string())
            for a in range(0, len(keys), 500_000):
                z = a + 500_000
                yield pa.RecordBatch.from_arrays(
                    [known.take(pa.array(lang[a:z])), pa.array((keys[a:z] & ((1 << ORDER * SYMBOL_BITS) - 1)).astype(np.int32)), pa.array(counts[a:z])],
                    names=["lang", "code", "n"],
                )

    counted = arrow_map(docs.select(F.col("lang").cast("string"), "text"), run, "lang string, code int, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more (Chen and Goodman)."""
    n = [max(1, int((counts == k).sum())) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.1), k - 0.05) for k, x in enumerate(d, 1))])


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """For orders 1 to ORDER: (n-grams, probabilities, contexts, back-off weights)."""
    levels = [(codes, counts)]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts a shorter one ends a longer one
        levels.append(np.unique(levels[-1][0] & ((1 << SYMBOL_BITS * k) - 1), return_counts=True))
    out, lower = [], None
    for code, c in reversed(levels):
        context, at = np.unique(code >> SYMBOL_BITS, return_inverse=True)
        d = _discounts(c)[np.minimum(c, 3)]
        total = np.bincount(at, weights=c)
        weight = np.bincount(at, weights=d) / total
        if lower is None:
            below = np.full(len(code), 1 / SYMBOLS)
        else:
            below = lower[1][np.searchsorted(lower[0], code & ((1 << SYMBOL_BITS * len(out)) - 1))]
        p = np.maximum(c - d, 0) / total[at] + weight[at] * below
        lower = (code, p)
        out.append((code, p, context, weight))
    return out


def _key(language: int, order: int, code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) | np.uint64(language << 40 | order << 32))


@dataclass
class SymbolModel:
    languages: dict  # name (None for null) -> number
    p_keys: np.ndarray  # ascending hashes of (language, order, n-gram)
    p_values: np.ndarray  # log-probabilities
    b_keys: np.ndarray  # ascending hashes of (language, order, context)
    b_values: np.ndarray  # logs of back-off weights
    contexts: dict  # language -> contexts of the highest order, ascending

    def log_probability(self, language: int, code: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last symbol of each n-gram after the others."""
        if order == 0:
            return np.full(len(code), -np.log(SYMBOLS))
        code = code & ((1 << SYMBOL_BITS * order) - 1)
        key = _key(language, order, code)
        at = np.minimum(np.searchsorted(self.p_keys, key), len(self.p_keys) - 1)
        out = self.p_values[at].astype(np.float64)
        miss = np.flatnonzero(self.p_keys[at] != key)
        if len(miss):
            key = _key(language, order, code[miss] >> SYMBOL_BITS)
            at = np.minimum(np.searchsorted(self.b_keys, key), len(self.b_keys) - 1)
            weight = np.where(self.b_keys[at] == key, self.b_values[at], 0.0)
            out[miss] = weight + self.log_probability(language, code[miss], order - 1)
        return out

    def _filled(self, language: int, context: np.ndarray, order: int = ORDER) -> np.ndarray:
        """``log_probability`` of all symbols after each context; those of
        shorter contexts are made once."""
        if order == 0:
            return np.full((len(context), SYMBOLS), -np.log(SYMBOLS))
        shorter = 1 << SYMBOL_BITS * max(order - 2, 0)
        below = self._filled(language, np.arange(shorter), order - 1)[context & (shorter - 1)]
        key = _key(language, order, context)
        at = np.minimum(np.searchsorted(self.b_keys, key), len(self.b_keys) - 1)
        out = np.where(self.b_keys[at] == key, self.b_values[at], 0.0)[:, None] + below
        key = _key(language, order, (context[:, None] << SYMBOL_BITS) | np.arange(SYMBOLS))
        at = np.minimum(np.searchsorted(self.p_keys, key), len(self.p_keys) - 1)
        return np.where(self.p_keys[at] == key, self.p_values[at], out)

    def number(self, lang) -> int:
        return self.languages.get(lang, self.languages.get(OTHER, 0))

    def rows(self, language: int, context: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The model resolved for scoring: row of each context (or -1), and
        log-probabilities of all next symbols in a row; by default of the
        contexts that the language has."""
        context = self.contexts[language] if context is None else context
        row = np.full(1 << SYMBOL_BITS * (ORDER - 1), -1, np.int32)
        row[context] = np.arange(len(context))
        return row, self._filled(language, context).astype(np.float32)

    def mixed(self) -> dict:
        """Language -> rows of the MIXED most frequent ones that have contexts,
        all with the rows of all their contexts; without any if those are large."""
        some = [i for i in range(min(MIXED, len(self.languages))) if len(self.contexts[i])]
        context = np.unique(np.concatenate([self.contexts[i] for i in some])) if some else np.zeros(0, np.int64)
        if len(some) * len(context) * SYMBOLS * 4 > MIXED_BYTES:
            return {}
        rows = {i: self.rows(i, context) for i in some}
        return {i: (rows[some[0]][0], table) for i, (_, table) in rows.items()}


def fit(docs: DataFrame, languages: int = 64) -> SymbolModel:
    """Count all of ``docs(lang, text)`` and make the model."""
    counts = count_grams(docs).checkpoint(eager=True)
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = [r.lang for r in sizes]
    known = {v: i for i, v in enumerate(names)}
    p, b, contexts = [], [], {}
    if len(names) == languages:
        known[OTHER] = len(names)
    for name, i in known.items():  # a language at a time: at most 64**4 counts
        if name == OTHER:
            plain = [v for v in names if v is not None]
            rest = ~F.coalesce(F.col("lang").isin(plain), F.lit(None in names))
            own = counts.where(rest).groupBy("code").agg(F.sum("n").alias("n"))
        else:
            own = counts.where(F.col("lang").eqNullSafe(F.lit(name)))
        table = own.select("code", "n").toArrow()
        code, n = table["code"].to_numpy().astype(np.int64), table["n"].to_numpy()
        order = np.argsort(code)
        for k, (gram, prob, context, weight) in enumerate(kneser_ney(code[order], n[order]) if len(code) else [], 1):
            p.append((_key(i, k, gram), np.log(prob)))
            b.append((_key(i, k, context), np.log(np.maximum(weight, 1e-12))))
            contexts[i] = context
        contexts.setdefault(i, np.zeros(0, np.int64))

    def table_of(parts):
        keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(1, np.uint64)
        values = np.concatenate([v for _, v in parts]).astype(np.float32) if parts else np.zeros(1, np.float32)
        order = np.argsort(keys)
        return keys[order], values[order]

    return SymbolModel(known, *table_of(p), *table_of(b), contexts)


_RESOLVED: dict = {}  # of the last model in this process


def _resolved(tag: str, model: SymbolModel, language: int):
    if _RESOLVED.get("tag") != tag:
        _RESOLVED.clear()
        _RESOLVED.update(model.mixed())
        _RESOLVED["tag"] = tag
    if language not in _RESOLVED:
        _RESOLVED[language] = model.rows(language)
    return _RESOLVED[language]


def _sequence_scores(tag, model, data, offs, langs) -> tuple[np.ndarray, np.ndarray]:
    """Mean negative log-probability a symbol of each text, and its symbols.
    Each stretch of STRETCH symbols is scored by the best of the text's own
    model and those of the MIXED most frequent languages."""
    s, bounds = symbols(data, offs)
    code, n = grams(s, bounds), np.diff(bounds)
    if not len(code):
        return np.zeros(len(n)), n
    numbers = np.array([model.number(v) for v in langs], np.int64)
    stretches = -(-n // STRETCH)
    owner = np.repeat(np.arange(len(n)), stretches)
    heads = bounds[owner] + (np.arange(len(owner)) - (np.cumsum(stretches) - stretches)[owner]) * STRETCH
    best = np.full(len(owner), -np.inf)
    context, last = code >> SYMBOL_BITS, code & (SYMBOLS - 1)
    rows = at = miss = None
    for language in sorted({*numbers.tolist(), *range(min(MIXED, len(model.languages)))}):
        row, table = _resolved(tag, model, language)
        if not len(table):
            continue
        if row is not rows:  # languages with the same rows follow each other
            rows, at = row, row[context]
            miss = np.flatnonzero(at < 0)
            at = (at << SYMBOL_BITS) + last
            at[miss] = 0
        logp = table.ravel()[at]
        if len(miss):
            logp[miss] = model.log_probability(language, code[miss].astype(np.int64))
        total = np.add.reduceat(logp, heads, dtype=np.float64)
        best = np.where((numbers[owner] == language) | (language < MIXED), np.maximum(best, total), best)
    return -np.bincount(owner, weights=best, minlength=len(n)) / np.maximum(n, 1), n


def repeated_words(words: list[bytes], k: int = WINDOW, starts=None) -> int:
    """Words inside a k-word window that occurs twice or more; ``starts``: the
    windows that may."""
    places: dict = {}
    for i in range(len(words) - k + 1) if starts is None else starts:
        places.setdefault(tuple(words[i : i + k]), []).append(i)
    hit = bytearray(len(words))
    for at in places.values():
        if len(at) > 1:
            for i in at:
                hit[i : i + k] = b"\1" * k
    return sum(hit)


def base_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of texts."""
    n_docs = len(offs) - 1
    inside = IS_WORD[data]
    starts, ends, doc = spans(inside, offs)
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(n_words)])

    def per_doc(mask):
        return np.diff(np.searchsorted(np.flatnonzero(mask), offs))

    symbol = np.zeros(256, bool)
    symbol[list(SYMBOL_CHARS)] = True
    out = {"n_words": n_words, "word_chars": np.diff(offs) - per_doc(~inside | ((data & 0xC0) == 0x80)), "n_symbols": per_doc(symbol[data])}
    words = hash_spans(data, starts, ends)
    repeats, lines = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    window = np.zeros(0, np.uint64)
    if len(words) >= WINDOW:
        window = words[: len(words) - WINDOW + 1].copy()
        for j in range(1, WINDOW):
            window *= np.uint64(0x9E3779B97F4A7C15)
            window += words[j : len(words) - WINDOW + 1 + j]
    has_break = per_doc(data == 10)
    raw = data.tobytes()
    for i in range(n_docs):
        a, z = int(first[i]), int(first[i + 1]) - WINDOW + 1
        if z - a > 1:
            own = np.sort(window[a:z])
            again = own[1:][own[1:] == own[:-1]]
            if len(again):  # equal hashes; the words decide
                own = window[a:z]
                starts = np.flatnonzero(again[np.minimum(np.searchsorted(again, own), len(again) - 1)] == own)
                repeats[i] = repeated_words(raw[offs[i] : offs[i + 1]].split(), starts=starts.tolist())
        if has_break[i]:
            own = [x for x in raw[offs[i] : offs[i + 1]].split(b"\n") if x and x.strip()]
            lines[i] = len(own) - len(set(own))
    return out | {"n_dup_lines": lines, "n_repeat_words": repeats}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: SymbolModel, text: str = "text", lang: str = "lang") -> DataFrame:
    """Add the base counts, ``base_failed``, ``log_ppl`` and ``n_codes``."""
    import uuid

    shared, tag = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def make():
        def run(part, data, offs):
            base = base_counts(data, offs)
            langs = part.column(part.schema.get_field_index(lang)).to_pylist()
            nll, n = _sequence_scores(tag, shared.value, data, offs, langs)
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            return [*(pa.array(base[c].astype(np.int64)) for c in COUNTS), pa.array(failed), pa.array(nll), pa.array(n.astype(np.int64))]

        return run

    fields = [T.StructField(c, T.LongType()) for c in COUNTS]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("log_ppl", T.DoubleType()), T.StructField("n_codes", T.LongType())]
    return map_texts(docs, text, fields, make)


def perplexity_bands(measured: DataFrame, below: float = 4.0, above: float = 3.5, floor: float = 0.02, lang: str = "lang") -> DataFrame:
    """(lang, mid, low, high): limits of the log-perplexity from the texts that
    pass the base rules; a robust deviation is at least ``floor``."""
    good = measured.where(~F.col("base_failed") & (F.col("n_codes") > 0)).select(F.col(lang).alias("lang"), "log_ppl")
    q = good.groupBy("lang").agg(F.percentile_approx("log_ppl", [0.25, 0.5, 0.75], 10_000).alias("q"))
    spread = F.greatest(F.lit(floor), (F.col("q")[2] - F.col("q")[0]) / 1.349)
    return q.select("lang", F.col("q")[1].alias("mid"), (F.col("q")[1] - below * spread).alias("low"), (F.col("q")[1] + above * spread).alias("high"))


def word_limits(measured: DataFrame, above: float = 3.5, floor: float = 0.25) -> DataFrame:
    """(lang, high): upper limits of ``word_ppl``; a robust deviation is at
    least ``floor``. Copies count once, near copies (predictable by each other)
    not at all."""
    good = measured.where(~F.col("base_failed") & F.col("word_ppl").isNotNull()).select("lang", "_key", "word_ppl").dropDuplicates(["lang", "_key"])
    top = good.groupBy(F.col("lang").alias("_lang")).agg(F.percentile_approx("word_ppl", 0.9, 10_000).alias("_top"))
    good = good.join(F.broadcast(top), F.col("lang").eqNullSafe(F.col("_lang"))).where("word_ppl >= _top / 2")
    q = good.groupBy("lang").agg(F.percentile_approx("word_ppl", [0.25, 0.5, 0.75], 10_000).alias("q"))
    spread = F.greatest(F.lit(floor), (F.col("q")[2] - F.col("q")[0]) / 1.349)
    return q.select("lang", (F.col("q")[1] + above * spread).alias("high"))


def judge(docs: DataFrame, *, keep_text: bool = True, short: float = 2.5, above_words: float = 3.5, short_words: float = 4.0, **band) -> DataFrame:
    """``docs(lang, text, ...)`` with the base counts, ``base_failed``,
    ``log_ppl`` and ``kept``. ``short`` and ``short_words``: how many nats a
    text's limits are widened, divided by the root of its number of symbols or
    words."""
    model = fit(docs.select("lang", "text"))
    words = kn_words.score(docs).select(F.col("key").alias("_key"), "word_ppl")
    rows = measure(without(docs, ["kept", "word_ppl", "_key"]), model).withColumn("_key", kn_words.text_key())
    rows = (rows if keep_text else rows.drop("text")).join(words, "_key", "left").checkpoint(eager=True)
    bands = perplexity_bands(rows, **band).collect()  # a row for each language
    low, high = {r.lang: r.low for r in bands}, {r.lang: r.high for r in bands}
    high_words = {r.lang: r.high for r in word_limits(rows, above_words).collect()}

    def edge(values, other):
        out = F.lit(other)
        for name, v in values.items():
            out = F.when(F.col("lang").eqNullSafe(F.lit(name)), F.lit(float(v))).otherwise(out)
        return out

    def slack(nats, n):
        return F.lit(nats) / F.sqrt(F.greatest(F.col(n), F.lit(1)).cast("double"))

    inside = F.col("log_ppl").between(edge(low, -1e9) - slack(short, "n_codes"), edge(high, 1e9) + slack(short, "n_codes"))
    log_ppl = F.coalesce("word_ppl", F.lit(0.0))
    inside &= log_ppl <= edge(high_words, 1e9) + slack(short_words, "n_words")
    rows = rows.withColumn("kept", ~F.col("base_failed") & inside)
    return rows.withColumn("log_ppl", log_ppl).drop("n_codes", "word_ppl", "_key")


def judge_documents(docs: DataFrame, **settings) -> DataFrame:
    """The ``documents`` table: one row each, without the text."""
    rows = judge(docs.select("doc_id", "lang", "text"), keep_text=False, **settings)
    return rows.select("doc_id", *COUNTS, "base_failed", "kept", "log_ppl")
