"""Byte-level BPE encoding and decoding with the `tokenizers` library over Arrow batches.

A file of ranks lists tokens as bytes. The library works on characters, so every byte stands
for one printable character (the byte table), and ids are decoded by the reverse table. As
tokens are bytes, one may end inside a character: offsets are counted in bytes of the text
and mapped to the characters that they touch, and only the joined bytes of all ids are read
as UTF-8.
"""

import base64
import hashlib
import os
import re
import sys
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.llm import chars


def byte_table():
    """Character of each byte: printable ones stand for themselves, the others for 256 and on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(kept))
    table = {b: chr(b) for b in kept}
    table.update({b: chr(256 + n) for n, b in enumerate(rest)})
    return table


def read_ranks(path):
    """Token bytes by id, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


def _merges(tokens):
    """The pair that each token is merged from, in the order of ranks: what is left of the token's
    own bytes after all merges of lower rank."""
    ranks = {token: rank for rank, token in tokens.items()}
    for rank in sorted(tokens):
        parts = [tokens[rank][i : i + 1] for i in range(len(tokens[rank]))]
        while len(parts) > 2:
            best, at = min((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            yield parts[0], parts[1]


@lru_cache(maxsize=2)
def load(path, pattern):
    """(tokenizer, token bytes by id), once for each worker. The text `<|endoftext|>` and the like
    are ordinary text: the tokenizer has no special tokens."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    tokens, table = read_ranks(path), byte_table()
    spell = lambda token: "".join(table[b] for b in token)
    model = models.BPE(
        vocab={spell(token): rank for rank, token in tokens.items()},
        merges=[(spell(a), spell(b)) for a, b in _merges(tokens)],
        cache_capacity=0,  # Pieces remembers, and forgets at the end of a task
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer, [tokens.get(i, b"") for i in range(max(tokens) + 1)]


#: Where a text may be cut before matching: in front of a blank between two other characters. Every
#: alternative of the usual byte-level patterns that takes such a blank starts with it, so a match
#: begins there in any case; a pattern that is not of that kind needs `cut=None`.
CUT = re.compile(r"(?<=\S)(?= \S)")
KEPT = 32 << 20  # bytes of pieces and ids that a task remembers
LONG = 200  # characters of a piece that is not remembered


class Pieces:
    """Ids of pieces of text that a task has seen: each distinct piece is encoded once, and everything is
    forgotten when it takes more than KEPT bytes, and at the end of the task. Long pieces, as in texts without
    blanks, are encoded whenever they occur."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self):
        self.place, self.ids, self.cuts, self.size = {}, np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64), 0

    def encode(self, texts, cut):
        split = [[t] if cut is None else cut.split(t) for t in texts]
        pieces = list(chain.from_iterable(split))
        if self.size > KEPT:
            self.forget()
        new = list(dict.fromkeys(p for p in pieces if p not in self.place))
        if new:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype="<u4", count=lengths.sum())])
            self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(lengths)])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.size += sum(map(sys.getsizeof, new)) + 100 * len(new) + 4 * int(lengths.sum())
        at = np.fromiter(map(self.place.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        lengths = self.cuts[at + 1] - self.cuts[at]
        stops = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.cuts[at] - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)]
        last = np.cumsum([len(s) for s in split]) - 1
        if any(len(p) > LONG for p in new):
            self.size = KEPT + 1  # not worth its room
        return np.split(ids, stops[last][:-1])


@lru_cache(maxsize=2)
def _pieces(path, pattern):
    return Pieces(load(path, pattern)[0])


def encode_texts(texts, path, pattern, cut=CUT):
    """Ids of each text, as numpy arrays."""
    return _pieces(path, pattern).encode(texts, cut) if texts else []


def forget(path, pattern):
    """At the end of a task."""
    _pieces(path, pattern).forget()


def decode_ids(ids, path, pattern):
    """Bytes of a sequence of ids; an id that the vocabulary lacks is an error."""
    _, tokens = load(path, pattern)
    return b"".join([tokens[i] for i in ids])


def character_spans(text, ids, path, pattern):
    """For each id the first character that it touches and the one after the last: tokens that
    split a character both cover it."""
    _, tokens = load(path, pattern)
    stop = np.cumsum([len(tokens[i]) for i in ids], dtype=np.int64)
    start = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
    return character[start], character[stop - 1] + 1


def encode(docs: DataFrame, path: str, pattern: str, spans: bool = False) -> DataFrame:
    """`docs` with `ids` (array of ints, empty for an empty or NULL text) and, with `spans`, arrays
    `starts` and `stops` in characters. Columns of these names are replaced."""
    from pyspark.sql import types as T

    names = ["ids", "starts", "stops"] if spans else ["ids"]

    def run(texts):
        ids = encode_texts(texts, path, pattern)
        if not spans:
            return [ids]
        where = [character_spans(t, x, path, pattern) for t, x in zip(texts, ids)]
        return [ids, [a for a, _ in where], [b for _, b in where]]

    return chars.add_columns(docs, "text", [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names], run, done=lambda: forget(path, pattern))


def decode(encoded: DataFrame, path: str, pattern: str, name: str = "text") -> DataFrame:
    """`encoded` with the text that its `ids` spell; ids cut inside a character give U+FFFD there.
    NULL ids give a NULL text."""
    from pyspark.sql import types as T

    kept = encoded.drop(name)
    at = kept.columns.index("ids")
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        for batch in batches:
            rows = batch.column(at).to_pylist()
            texts = [None if x is None else decode_ids(x, path, pattern).decode("utf-8", "replace") for x in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every whole text encoded, and its ids decoded
    again. Ids stay in the task, so nothing but the digests leaves it."""
    from pyspark.sql import types as T

    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ]

    def run(texts):
        ids = encode_texts(texts, path, pattern)
        return [
            [len(x) for x in ids],
            [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
            [hashlib.sha256(decode_ids(x.tolist(), path, pattern)).hexdigest() for x in ids],
        ]

    return chars.add_columns(docs.select("doc_id", F.col("text")), "text", fields, run, done=lambda: forget(path, pattern)).drop("text")
