"""Arrow helpers shared by the operators of this subpackage.

Texts are handled as UTF-8 bytes, straight from the Arrow buffers, in slices
of a few megabytes, so that the memory of a task depends neither on the number
of rows in an Arrow batch nor on the size of the table.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1000

_SPACE = [0x20, *range(0x09, 0x0E)]
IS_WORD = np.ones(256, bool)
IS_WORD[_SPACE] = False
#: letters for the hashed-word models: ASCII letters and every non-ASCII byte
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim(0)
except (OSError, AttributeError):  # another C library
    _LIBC = None

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64
_STRETCH = 1 << 16
#: powers of _R and of its inverse
_UP, _DOWN = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(_STRETCH + _LONG_WORD, r, np.uint64)]), dtype=np.uint64) for r in (_R, np.uint64(pow(int(_R), -1, 2**64))))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a new array)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def release_memory():
    """Give freed memory back to the system: Python workers live on between
    tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def text_slices(batch: pa.RecordBatch, name: str, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple]:
    """Yield (start row, stop row, bytes, offsets) for runs of rows whose texts
    have about ``slice_bytes`` together; a null text is an empty one and a row
    is never divided."""
    col = batch.column(batch.schema.get_field_index(name))
    n = len(col)
    if n == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offs, offs[start] + slice_bytes, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop, raw[offs[start] : offs[stop]], offs[start : stop + 1] - offs[start]
        start = stop
    del raw, offs, col, data, offsets
    release_memory()


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that no row border cuts."""
    n = len(inside)
    if n == 0:
        return (np.zeros(0, np.int64),) * 2
    border = np.zeros(n + 1, bool)
    border[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the runs of True that no row border cuts."""
    starts, ends = runs(inside, offs)
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes, equal hash.

    That of a short one is a polynomial of its bytes, the difference of two
    running sums; those are made for a stretch of spans at a time."""
    length = ends - starts
    h = length.astype(np.uint64) * _R
    short = length <= _LONG_WORD
    at = np.flatnonzero(short)
    ordered = (starts[at[1:]] >= starts[at[:-1]]).all()
    at = at if ordered else at[np.argsort(starts[at], kind="stable")]
    first, every = starts[at], ordered and len(at) == len(starts)
    i = 0
    while i < len(at):
        low = int(first[i])
        z = int(np.searchsorted(first, low + _STRETCH, "right"))
        own = slice(i, z) if every else at[i:z]
        part = data[low : low + _STRETCH + _LONG_WORD]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _DOWN[: len(part)], out=sums[1:])
        a, e = starts[own] - low, ends[own] - low
        h[own] = h[own] * _UP[length[own]] + (sums[e] - sums[a]) * _UP[np.maximum(e, 1) - 1]
        i = z
    for i in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    return mix(h)


def arrow_map(df: DataFrame, f, schema) -> DataFrame:
    """``mapInArrow`` in batches of at most BATCH_ROWS rows: texts are long, and
    Spark bounds its batches by rows only. A smaller setting of the session is
    kept."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(f, schema)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add."""
    low = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def map_texts(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Append ``fields`` to every row. ``make()`` runs once in each task and
    returns ``f(rows, bytes, offsets) -> one array for each field``. Columns of
    the input with the name of a new field are replaced."""
    df = without(df, [f.name for f in fields])
    schema = T.StructType([*df.schema.fields, *fields])

    def run(batches):
        f = make()
        for batch in batches:
            for start, stop, data, offs in text_slices(batch, text, slice_bytes):
                part = batch.slice(start, stop - start)
                new = [x if isinstance(x, pa.Array) else pa.array(x) for x in f(part, data, offs)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return arrow_map(df, run, schema)


def nonspace_count(text):
    """Column: number of runs of ``[^\\x20\\x09-\\x0D]`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def unsalted_fraction(*cols):
    """Column in [0, 1): a fixed pseudo-random number from the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))
