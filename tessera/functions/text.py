"""Scalar text functions (F1-F11, F24) as Column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; the same regexes run unchanged in DuckDB (RE2) for the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour):
# - white space removed by Python's str.strip(): these code points;
# - block separator lines: "=== TEXTO NUEVO ===" or "=== TEXTO <n> ===" at a
#   line start, followed by any white space;
# - the reply used when the retrieved context is shorter than 20 characters;
# - the system message of the chat request.
WS_CODEPOINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
                 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
                 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS_CHARS = "".join(chr(c) for c in WS_CODEPOINTS)
WS_SQL = " || ".join(f"chr({c})" for c in WS_CODEPOINTS)  # the same set in SQL
WS_CLASS = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BLOCK_SEPARATOR = r"(?m)^=== TEXTO(?: NUEVO| \d+) ===\s*"
NOT_ENOUGH_CONTEXT = "Lo siento, no tengo información suficiente para responder a esa pregunta."
SYSTEM_MESSAGE = "Eres un debatiente experto."
PROMPT_TEMPLATE = (
    "Contexto relevante extraído exclusivamente de mis textos:\n%s\n\n"
    "Pregunta:\n%s\n\n"
    "RESPONDE SOLO con la información proporcionada en el contexto anterior.\n"
    "Sé breve y preciso."
)
QUIT_WORD = "salir"
MIN_CONTEXT_CHARS = 20

STRIP_PATTERN = f"^{WS_CLASS}+|{WS_CLASS}+$"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """remove leading and trailing white space (not only spaces): a
    character-set ``trim`` (codegen, no regex)."""
    return F.trim(_c(c), F.lit(WS_CHARS))


def question_key(c: str | Column) -> Column:
    """trim, lower-case, then every run of non-word characters -> one space.

    Trimming happens before punctuation is replaced, so a key may start or end
    with one space (kept on purpose)."""
    return F.regexp_replace(F.lower(strip_ws(c)), NON_WORD_RUN, " ")


def split_blocks(c: str | Column, pattern: str = BLOCK_SEPARATOR) -> Column:
    """F4 + S4: split on a (multi-line) regex, strip every piece, drop empties."""
    return F.filter(
        F.transform(F.split(_c(c), pattern), lambda x: strip_ws(x)), lambda x: x != F.lit("")
    )


def join_ranked(rank: str | Column, text: str | Column) -> Column:
    """F5 aggregate: newline-joined texts in rank order (use inside agg)."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(_c(rank).alias("r"), _c(text).alias("t")))),
                    lambda s: s["t"]),
        "\n",
    )


def guard_short(context: str | Column, answer: Column, n: int = MIN_CONTEXT_CHARS) -> Column:
    """fixed reply when the stripped context is shorter than ``n``."""
    return F.when(F.length(strip_ws(context)) < n, F.lit(NOT_ENOUGH_CONTEXT)).otherwise(answer)


def render_prompt(context: str | Column, question: str | Column) -> Column:
    """the prompt text around a context and a question."""
    return F.format_string(PROMPT_TEMPLATE, _c(context), _c(question))


def block_header(i: str | Column) -> Column:
    """numbered block header used when blocks are written back."""
    return F.format_string("=== TEXTO %d ===", _c(i))


def format_fixed(c: str | Column, decimals: int = 4) -> Column:
    """fixed number of decimals as text."""
    return F.format_string(f"%.{decimals}f", _c(c))


def is_question(c: str | Column) -> Column:
    """neither the quit word nor blank."""
    s = strip_ws(c)
    return (F.lower(s) != F.lit(QUIT_WORD)) & (s != F.lit(""))


def messages(system: str | Column, user: str | Column) -> Column:
    """chat request as array<struct<role, content>>."""
    sys_c = F.lit(system) if isinstance(system, str) else system
    return F.array(
        F.struct(F.lit("system").alias("role"), sys_c.alias("content")),
        F.struct(F.lit("user").alias("role"), _c(user).alias("content")),
    )


def replace_suffix(c: str | Column, old: str, new: str) -> Column:
    """F8: replace a trailing suffix (e.g. a file extension)."""
    import re

    return F.regexp_replace(_c(c), re.escape(old) + "$", new.replace("\\", "\\\\").replace("$", "\\$"))


def split_label(c: str | Column, sep: str = "-") -> Column:
    """split a delimited label into an array."""
    import re

    return F.split(_c(c), re.escape(sep))
