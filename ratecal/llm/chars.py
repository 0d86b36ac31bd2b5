"""Texts as arrays of code points, so that words and n-grams are hashed without a loop over them.

All functions run inside tasks on one Arrow batch at a time. A batch is cut into chunks of
about a million characters; a longer text is a chunk of its own and is never cut, so memory
in a task follows the longest single text (about 60 bytes a character).
"""

import ctypes
import gc
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {}


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix32(x):
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def _power(base, n):
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if len(known) <= 2 * CHUNK:
            _powers[base] = known
    return known[:n]


@lru_cache(maxsize=1)
def letter_table():
    """Whether each code point is a letter, and the code point of its lower case (its own
    where that is longer than one)."""
    every = [chr(c) for c in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in every), dtype=bool, count=len(every))
    lower = np.fromiter((ord(s) if len(s := c.lower()) == 1 else ord(c) for c in every), dtype=np.uint32, count=len(every))
    return letter, lower


def _ranges(lengths, limit):
    start = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length + 1
    if start < len(lengths):
        yield start, len(lengths)


def chunks(texts, limit=CHUNK):
    """Ranges [start, stop) of texts of about `limit` characters together."""
    return _ranges([len(t) for t in texts], limit)


def parts(column, limit=CHUNK):
    """Ranges [start, stop) of an Arrow column of about `limit` characters together, and the texts there, NULL as an
    empty one. Only one range at a time is unpacked."""
    for a, b in _ranges(pc.fill_null(pc.utf8_length(column), 0).to_pylist(), limit):
        yield a, b, [t or "" for t in column.slice(a, b - a).to_pylist()]


def release():
    """Gives back to the system what a task does not need any more: its process lives on and takes other tasks, also
    of other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def free_name(df, name):
    """`name`, or with underscores behind it, so that no column of `df` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Codes:
    """Texts joined by line feeds; every text ends with one, so a word never spans two."""

    def __init__(self, texts):
        joined = "\n".join(texts) + "\n"
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        self.n = len(texts)

    def owner(self, positions):
        """The text in which each position lies."""
        return np.searchsorted(self.ends, positions, side="right")


def ascii_lower(points):
    return np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)


def ascii_space(points):
    return (points == 32) | ((points >= 9) & (points <= 13))


def runs(inside):
    """Start and end of each run of True; the last element must be False."""
    change = np.diff(inside.view(np.int8), prepend=np.int8(0))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def segment_hashes(points, start, end):
    """A 64-bit hash of each segment's code points, by prefix sums of a polynomial."""
    n = len(points)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(points.astype(np.uint64) * _power(BASE, n), out=sums[1:])
    value = (sums[end] - sums[start]) * _power(INVERSE, n)[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(points, n):
    """A 32-bit hash of the n code points from every position on which n of them are left."""
    size = len(points) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint32)
    value = np.full(size, n, dtype=np.uint32)
    for k in range(n):
        value *= np.uint32(0x01000193)
        value ^= points[k : k + size]
        value *= np.uint32(0x9E3779B1)
    return mix32(value)


def add_columns(df, text, fields, score, limit=CHUNK, done=None):
    """`df` with further columns that `score` finds from the text column.

    `score` takes a list of texts (NULL is an empty text) and returns one array per field, in
    the order of `fields`, a Spark schema. Columns of `df` with the names of new ones are
    replaced; all others pass through. One pass, no shuffle. `score` gets texts of about `limit` characters at a
    time; `done` is called at the end of a task, to drop what it has kept.
    """
    from pyspark.sql import types as T

    kept = df.drop(*[f.name for f in fields])
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *fields])
    arrow = [to_arrow(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            found = [score(texts) for _, _, texts in parts(batch.column(at), limit)]
            new = [
                pa.chunked_array([pa.array(part[k], type=kind) for part in found], type=kind).combine_chunks()
                for k, kind in enumerate(arrow)
            ]
            new = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in new]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[f.name for f in schema])
        if done:
            done()
        release()

    return kept.mapInArrow(run, schema)


def grouped(batches, keys):
    """Each group of rows that agree in `keys` (numbers), as a table; rows of a group lie together, and a
    group may span batches."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch[k].to_numpy() for k in keys])
        cuts = (np.flatnonzero((np.diff(values, axis=1) != 0).any(axis=0)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            part = batch.slice(a, b - a)
            if held and any(held[0][k][0] != part[k][0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def packed(numbers):
    """Numbers as bytes: all first bytes of them, all second ones and so on, compressed, behind their size."""
    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(held, kind):
    size = int.from_bytes(held[:8], "little")
    planes = np.frombuffer(pa.decompress(held[8:], size, codec="zstd", asbytes=True) if size else b"", dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def to_arrow(kind):
    from pyspark.sql import types as T

    if isinstance(kind, T.ArrayType):
        return pa.list_(to_arrow(kind.elementType))
    return {
        "string": pa.string(), "double": pa.float64(), "float": pa.float32(), "bigint": pa.int64(), "int": pa.int32(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }[kind.simpleString()]
