"""Collocations: the phrases of two to five words whose words occur together far more often than apart.

Texts are written once as sequences of word codes, with a break wherever a piece ends or a word is too rare. A
phrase can only be frequent if both phrases of one word less in it are (Apriori), so the candidates of a length are
those the corpus holds whose two parts pass a bitmap of the frequent ones before; a bitmap may let more pass, never
fewer. Most such phrases are rare still, so they must also fall in a bucket of enough phrases. Candidates go
out as double-array tries of bounded size. All positions of a text step through a trie together, one level at a
time; the states that accept are counted, and the counts of all tasks summed.
"""

import math
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecal.llm import bits, chars
from ratecal.session import new_folder


@dataclass(frozen=True)
class Settings:
    """`least`: occurrences of a phrase; `longest`: words of one; `top`: phrases of each language;
    `percent`: of a phrase's occurrences within one longer phrase that make it go; `buckets`: of phrases of one length,
    a power of two, at least; `load`: words for each of them, beyond which there are more (up to `_BUCKETS`); `block`:
    candidates of a trie; `gathered`: positions that a task looks at together."""

    least: int = 100
    longest: int = 5
    top: int = 2000
    percent: int = 100
    buckets: int = 1 << 27
    load: int = 8
    block: int = 1 << 19
    gathered: int = 1 << 20


_BUCKETS = 1 << 30  # at most: bits of a map that every task holds
_FACTORS = chars.mix(np.arange(101, 164, dtype=np.uint64)) | np.uint64(1)


def phrase_keys(codes, k):
    """A hash of the k codes from every position on which k are left; 0 where one of them is a break. A
    single code is its own key."""
    size = max(len(codes) - k + 1, 0)
    if k == 1:
        return codes
    keys, whole = np.zeros(size, dtype=np.uint64), np.ones(size, dtype=bool)
    for j in range(k):
        part = codes[j : j + size]
        keys += part * _FACTORS[j]
        whole &= part != 0
    return np.where(whole, chars.mix(keys), np.uint64(0))


def phrase_places(codes, k, parts):
    """Keys as `phrase_keys`, and where the phrase may be frequent, as both its parts of k - 1 words pass the bitmap `parts`
    (None: any may)."""
    keys = phrase_keys(codes, k)
    if parts is None:
        return keys, keys != 0
    part = phrase_keys(codes, k - 1)
    may = (part != 0) & bits.member(parts, part)
    return keys, may[:-1] & may[1:]


@contextmanager
def _sent(spark, value):
    """`value` as a broadcast, which goes from all disks afterwards."""
    shared = spark.sparkContext.broadcast(value)
    try:
        yield shared
    finally:
        shared.destroy()


def _few(rows):
    """`rows` in as many partitions as the session's cores can use, not one for each file: every task of a step
    tells each word or candidate that it holds."""
    return rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)


class Words:
    """The words of some texts in order: code (a hash of language and word, never 0), text, and whether the
    word begins a piece."""

    def __init__(self, texts, langs):
        self.codes = chars.Codes(texts)
        points = self.points = chars.ascii_lower(self.codes.points)
        blank = (points == 32) | (points == 9)
        ends = (points >= 10) & (points <= 13)
        for mark in b".,;:!?":
            ends |= points == mark
        self.start, self.end = chars.runs(~(blank | ends))
        self.owner = self.codes.owner(self.start)
        salt = chars.mix(np.array(langs, dtype=np.int64).view(np.uint64) + np.uint64(1))
        hashes = chars.segment_hashes(points, self.start, self.end)
        self.code = np.maximum(chars.mix(hashes ^ salt[self.owner]), np.uint64(1))
        breaks = np.cumsum(ends)
        self.first = np.diff(breaks[self.start], prepend=-1) != 0

    def spelled(self, which):
        """The words at `which` as strings."""
        start, end = self.start[which], self.end[which]
        lengths = end - start
        cuts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(start - cuts[:-1], lengths) + np.arange(cuts[-1])
        text = self.points[at].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return pa.array([text[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], type=pa.string())


def _rows(docs):
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), "text").withColumn("salt", F.xxhash64("lang"))


def _chunked(batches):
    """Languages, salts and texts of about a million characters at a time."""
    for batch in batches:
        langs, salts = batch.column(0), batch.column(2).to_numpy()
        for a, b, texts in chars.parts(batch.column(1), 1 << 19):
            yield langs.slice(a, b - a), salts[a:b], texts
    chars.release()


def _gathered(batches, size):
    """Codes of many rows together, each with a break at its end."""
    held, n = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            codes = chars.unpacked(batch.column(0)[i].as_py(), np.uint64)[chars.unpacked(batch.column(1)[i].as_py(), np.int32)]
            held += [codes, np.zeros(1, np.uint64)]
            n += len(codes) + 1
            if n >= size:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _ranged(part, *columns):
    """Arrays of one length as one row for each part: its number, and the arrays of its rows as steps from one to the next, in
    the order of all columns, the first one first. Steps are small where a column is sorted or repeats, and packed."""
    order = np.lexsort((*columns[::-1], part))
    parts, first = np.unique(part[order], return_index=True)
    cuts = np.append(first, len(part)).tolist()
    packed = [[chars.packed(np.diff(c[order[x:y]], prepend=c.dtype.type(0))) for x, y in zip(cuts, cuts[1:])] for c in columns]
    names = ["part", *[f"c{k}" for k in range(len(columns))]]
    return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int64)), *[pa.array(c, type=pa.binary()) for c in packed]], names=names)


def _opened(table, column, kind):
    """One array for each row of a column that `_ranged` has packed."""
    return [np.cumsum(chars.unpacked(x, kind), dtype=kind) for x in table[column].to_pylist()]


def _by_part(rows):
    return rows.repartition("part").sortWithinPartitions("part")


def _summed(keys, n):
    """Distinct keys, and the sum of the numbers of each."""
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(n), minlength=len(found)).astype(np.int64)


PARTS = 1024  # of words and candidates, which meet in one group each


def word_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """code and f of the words (of a language each) that occur often enough; and, in rows without a code, lang and n: all word
    occurrences of some texts. Only hashes are counted: most words are rare, and the others are spelled by `coded`."""

    def told(code, n, sizes):
        rows = _ranged((code >> np.uint64(54)).astype(np.int64), code, n)
        empty = [pa.nulls(rows.num_rows, pa.string()), pa.nulls(rows.num_rows, pa.int64())]
        yield pa.RecordBatch.from_arrays([*rows.columns, *empty], names=names)
        part = pa.array([PARTS + int(salt) % PARTS for salt, _ in sizes], type=pa.int64())
        empty, langs = pa.nulls(len(sizes), pa.binary()), pa.array([lang for _, lang in sizes], type=pa.string())
        yield pa.RecordBatch.from_arrays([part, empty, empty, langs, pa.array(list(sizes.values()), type=pa.int64())], names=names)

    names = ["part", "c0", "c1", "lang", "n"]

    def run(batches):
        held, sizes = [], {}
        for langs, salts, texts in _chunked(batches):
            words = Words(texts, salts)
            if not len(words.code):
                continue
            held.append(np.unique(words.code, return_counts=True))
            for at, n in enumerate(np.bincount(words.owner, minlength=len(texts)).tolist()):
                if n:
                    key = int(salts[at]), langs[at].as_py()
                    sizes[key] = sizes.get(key, 0) + n
            if sum(len(code) for code, _ in held) >= 2 * settings.gathered:
                held = [_summed(*zip(*held))]
                if len(held[0][0]) >= settings.gathered or len(sizes) >= settings.gathered:
                    yield from told(*held[0], sizes)
                    held, sizes = [], {}
        if held:
            yield from told(*_summed(*zip(*held)), sizes)

    def add(batches):
        out = ["code", "f", "lang", "n"]
        for t in chars.grouped(batches, ("part",)):
            if t["part"][0].as_py() >= PARTS:
                empty = pa.nulls(t.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([empty, empty, t["lang"].combine_chunks(), t["n"].combine_chunks()], names=out)
                continue
            code, n = _summed(_opened(t, "c0", np.uint64), _opened(t, "c1", np.int64))
            code, n = code[n >= settings.least].view(np.int64), n[n >= settings.least]
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), pa.array(n), pa.nulls(len(code), pa.string()), pa.nulls(len(code), pa.int64())], names=out
            )

    rows = _rows(docs).mapInArrow(run, "part long, c0 binary, c1 binary, lang string, n long")
    return _by_part(rows).mapInArrow(add, "code long, f long, lang string, n long")


def coded(docs: DataFrame, shared) -> DataFrame:
    """The words of some texts whose codes pass the bitmap `shared` (others may be among them, by chance), 0 for one
    or more breaks; words between two breaks are left out. `codes` has the distinct ones, the commonest first, and `places`
    where each word is among them, both packed: tasks then hold little of what they read. In rows of their own, code, lang and word of
    such words."""
    names = ["codes", "places", "code", "lang", "word"]

    def run(batches):
        spelled = np.zeros(0, dtype=np.uint64)  # what the task has already sent
        for langs, salts, texts in _chunked(batches):
            words = Words(texts, salts)
            code = np.where(bits.member(shared.value, words.code), words.code, np.uint64(0))
            found, first = np.unique(code, return_index=True)
            new = (found != 0) & ~np.isin(found, spelled, assume_unique=True)
            found, first = found[new], first[new]
            spelled = np.concatenate([spelled if len(spelled) < _SPELLED else spelled[:0], found])
            if len(found):
                empty = pa.nulls(len(found), pa.binary())
                own = [empty, empty, pa.array(found.view(np.int64)), langs.take(pa.array(words.owner[first])), words.spelled(first)]
                yield pa.RecordBatch.from_arrays(own, names=names)
            at = np.arange(len(code)) + np.cumsum(words.first)
            codes = np.zeros(len(code) + int(words.first.sum()) + 1, dtype=np.uint64)
            codes[at] = code
            held = codes != 0
            beside = np.zeros(len(codes), dtype=bool)
            beside[1:] |= held[:-1]
            beside[:-1] |= held[1:]
            codes[~beside] = 0
            keep = codes != 0
            keep[1:] |= codes[:-1] != 0
            if len(codes := codes[keep]):
                distinct, where, often = np.unique(codes, return_inverse=True, return_counts=True)
                order = np.argsort(-often, kind="stable")
                place = np.empty(len(order), dtype=np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                packed = [pa.array([chars.packed(x)], type=pa.binary()) for x in (distinct[order], place[where])]
                empty = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string())]
                yield pa.RecordBatch.from_arrays([*packed, *empty], names=names)

    return _few(_rows(docs)).mapInArrow(run, CODED)


CODED = "codes binary, places binary, code long, lang string, word string"
_SPELLED = 1 << 20  # codes that a task remembers


def buckets(texts: DataFrame, k: int, shared, size: int, settings: Settings = Settings()) -> np.ndarray:
    """The bitmap of those of `size` buckets in which enough phrases of k words fall, of whatever words; `shared` is a bitmap of the
    frequent phrases of k - 1 words, or None. Counts travel as arrays, one for each range of 2**16 buckets, and are added
    up there."""
    mask = np.uint64(size - 1)

    def summed(held):
        bucket, n = np.unique(np.concatenate(held), return_counts=True)
        return _ranged(bucket >> 16, (bucket & 0xFFFF).astype(np.uint16), np.minimum(n, settings.least).astype(np.uint32))

    def run(batches):
        held = []  # buckets are half as wide as codes, so more positions are counted together
        for codes in _gathered(batches, settings.gathered):
            keys, may = phrase_places(codes, k, shared.value)
            held.append((keys[may] & mask).astype(np.int32))
            if sum(map(len, held)) >= 4 * settings.gathered:
                yield summed(held)
                held = []
        if held:
            yield summed(held)
        chars.release()

    def add(batches):
        for t in chars.grouped(batches, ("part",)):
            total = np.zeros(1 << 16, dtype=np.int64)
            for at, n in zip(_opened(t, "c0", np.uint16), _opened(t, "c1", np.uint32)):
                total[at] += n
            if (often := total >= settings.least).any():
                held = [chars.packed(np.packbits(often, bitorder="little"))]
                yield pa.RecordBatch.from_arrays([t["part"].slice(0, 1).combine_chunks(), pa.array(held, type=pa.binary())], names=["part", "held"])

    counted = _by_part(texts.mapInArrow(run, "part long, c0 binary, c1 binary")).mapInArrow(add, "part long, held binary").toArrow()
    out = np.zeros((max(size >> 16, 1), 1 << 13), dtype=np.uint8)
    for part, held in zip(counted["part"].to_pylist(), counted["held"].to_pylist()):
        out[part] = chars.unpacked(held, np.uint8)
    return out.ravel().view(np.uint64)[: size >> 6]


def candidates(texts: DataFrame, k: int, shared, settings: Settings = Settings()) -> DataFrame:
    """key and words (codes) of the phrases of k words in `texts` that may be frequent: `shared` are two bitmaps, of the
    frequent phrases of k - 1 words (None for pairs), and of the buckets of k words."""

    def run(batches):
        told = np.zeros(0, dtype=np.uint64)  # what the task has already sent
        parts, often = shared.value
        for codes in _gathered(batches, settings.gathered):
            keys, may = phrase_places(codes, k, parts)
            at = np.flatnonzero(may)
            at = at[bits.member(often, keys[at], 64 * len(often))]
            found, first = np.unique(keys[at], return_index=True)
            new = ~np.isin(found, told, assume_unique=True)
            found, first = found[new], first[new]
            told = np.concatenate([told if len(told) < settings.gathered else told[:0], found])
            if len(found):
                words = [codes[at[first] + j] for j in range(k)]  # most of the first word are together, the commonest in eight parts
                part = (words[0] >> np.uint64(57) << np.uint64(3)) | (words[1] >> np.uint64(61))
                yield _ranged(part.astype(np.int64), *words)
        chars.release()

    def once(batches):
        for t in chars.grouped(batches, ("part",)):
            words = np.stack([np.concatenate(_opened(t, f"c{j}", np.uint64)) for j in range(k)], axis=1)
            keys = chars.mix((words * _FACTORS[:k]).sum(axis=1, dtype=np.uint64))  # as phrase_keys
            found, first = np.unique(keys, return_index=True)
            words = words[first].ravel().view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * k), pa.array(words))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), lists], names=["key", "words"])

    columns = ", ".join(f"c{j} binary" for j in range(k))
    return _by_part(texts.mapInArrow(run, f"part long, {columns}")).mapInArrow(once, "key long, words array<long>")


_WINDOW = (1 << 4096) - 1


class Trie:
    """A double-array trie of phrases of one length. Its letters are the distinct codes, numbered from 1 by frequency; the state
    behind letter c of state s is base[s] + c if check of that place is s. State 0 is the root.

    States with many children are placed first, each at the first base where all their places are free;
    those with one child fill what is free."""

    def __init__(self, words):
        self.letters, letter, often = np.unique(words, return_inverse=True, return_counts=True)
        n, depth = words.shape
        # frequent letters have low numbers, so the children of a state lie close to each other
        self.number = np.empty(len(often), dtype=np.int64)
        self.number[np.argsort(-often, kind="stable")] = np.arange(1, len(often) + 1)
        letter = self.number[letter.reshape(n, depth)]
        self.depth = depth
        size = len(self.letters) + 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        state = np.zeros(n, dtype=np.int64)
        self.open, self.used = 1, 0  # places from `open` on that are taken, as bits; of those below hardly any is free
        for j in range(depth):
            edges, which = np.unique((state << 32) | letter[:, j], return_inverse=True)
            edges = np.stack([edges >> 32, edges & 0xFFFFFFFF])
            parents, first, count = np.unique(edges[0], return_index=True, return_counts=True)
            place = np.zeros(edges.shape[1], dtype=np.int64)
            for p in np.argsort(-count, kind="stable")[: int((count > 1).sum())]:
                part = slice(first[p], first[p] + count[p])
                place[part] = self._place(edges[1][part]) if parents[p] else edges[1][part]
                self._take(place[part], parents[p])
                if not parents[p]:
                    self._mark()
            single = first[count == 1]
            place[single] = self._fill(edges[1][single])
            self._take(place[single], edges[0][single])
            self._mark()
            self.base[edges[0]] = place - edges[1]
            state = place[which.reshape(-1)]
        self.accepts = np.full(len(self.base), -1, np.int64)
        self.accepts[state] = np.arange(n)

    def _grow(self, size):
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _mark(self):
        """Reads `used` anew, after places were taken without it."""
        taken = np.packbits(self.check[self.open :] >= 0, bitorder="little")
        self.used = int.from_bytes(taken.tobytes(), "little")

    def _take(self, place, parents):
        self._grow(int(place.max()) + 1 if len(place) else 0)
        self.check[place] = parents

    def _place(self, letters):
        """The first places, of one base, that are free for all letters. Bits of all taken places, moved by the
        distance of each letter from the first one, leave open the bases that fit all of them."""
        wrong = shape = 0
        for far in (letters - letters[0]).tolist():
            wrong |= self.used >> far
            shape |= 1 << far
        first = (~wrong & (wrong + 1)).bit_length() - 1
        self.used |= shape << first
        place = self.open + first + letters - letters[0]
        while (self.used & _WINDOW).bit_count() > 0.6 * _WINDOW.bit_length():
            self.used >>= _WINDOW.bit_length()
            self.open += _WINDOW.bit_length()
        return place

    def _fill(self, letters):
        """A free place for each letter; any is right for a state with one child."""
        open_ = np.flatnonzero(self.check[1:] < 0) + 1
        if len(open_) < len(letters):
            self._grow(len(self.check) + len(letters))
            open_ = np.flatnonzero(self.check[1:] < 0) + 1
        return open_[: len(letters)]

    def count(self, codes):
        """How often each phrase begins at a position of `codes`."""
        letter = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter = np.where(self.letters[letter] == codes, self.number[letter], 0)
        at = np.flatnonzero(letter)
        state = np.zeros(len(at), dtype=np.int64)
        for j in range(self.depth):
            inside = at + j < len(letter)
            at, state = at[inside], state[inside]
            step = letter[at + j]
            to = self.base[state] + step
            on = (step > 0) & (to > 0) & (to < len(self.check))
            on[on] = self.check[to[on]] == state[on]
            at, state = at[on], to[on]
        return np.bincount(self.accepts[state], minlength=int(self.accepts.max()) + 1)


def trie_of(wanted):
    """The keys and the trie of phrases, an Arrow table of key and words."""
    keys = wanted["key"].to_numpy()
    return keys, Trie(wanted["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(keys), -1))


def counts(texts: DataFrame, shared, settings: Settings = Settings()) -> DataFrame:
    """key and f, the occurrences in `texts`, of phrases that are given as `trie_of` them."""

    def run(batches):
        keys, trie = shared.value
        total = np.zeros(len(keys), dtype=np.int64)
        for codes in _gathered(batches, settings.gathered):
            total += trie.count(codes)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys[held]), pa.array(total[held])], names=["key", "f"])
        chars.release()

    return texts.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def _stored(rows):
    """`rows`, written and read again."""
    spark, where = rows.sparkSession, new_folder(rows.sparkSession)
    rows.write.parquet(where)
    return spark.read.schema(rows.schema).parquet(where)


def frequent(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: frequent words (code, lang, word, f); frequent phrases of two and more words (key, words, f); and
    n, all word occurrences, of each lang."""
    spark = docs.sparkSession
    phrases_at = new_folder(spark)
    counted = _stored(word_counts(docs, settings))
    often = counted.filter("code IS NOT NULL").select("code", "f")
    with _sent(spark, bits.bitmap(often.select("code"))) as shared:
        written = _stored(coded(docs, shared))
    spelled = written.filter("code IS NOT NULL").groupBy("code").agg(F.min(F.struct("lang", "word")).alias("w"))
    words = often.join(spelled, "code").select("code", "w.lang", "w.word", "f")
    texts = _few(written.filter("codes IS NOT NULL").select("codes", "places"))
    schema = "key long, words array<long>, f long"
    spark.createDataFrame([], schema).write.parquet(phrases_at)
    n = counted.agg(F.sum("n")).first()[0] or 0
    size = max(settings.buckets, min(_BUCKETS, 1 << (n // settings.load).bit_length()))
    passing = None
    for k in range(2, settings.longest + 1):
        with _sent(spark, passing) as shared:
            enough = buckets(texts, k, shared, size, settings)
        with _sent(spark, (passing, enough)) as shared:
            found = _stored(candidates(texts, k, shared, settings))
        blocks = math.ceil(found.count() / settings.block)
        for block in range(blocks):
            wanted = found.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
            with _sent(spark, trie_of(wanted.toArrow())) as shared:
                enough = counts(texts, shared, settings).filter(F.col("f") >= settings.least)
                wanted.join(enough, "key").select("key", "words", "f").write.mode("append").parquet(phrases_at)
        kept = spark.read.schema(schema).parquet(phrases_at).filter(F.size("words") == k)
        passing = bits.bitmap(kept.select("key"))
        if not passing.any():
            break
    sizes = counted.filter("code IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    return words, spark.read.schema(schema).parquet(phrases_at), sizes


def _parts(phrases, longest):
    """key, part, from, length: all shorter runs of words of each phrase; a part of one word has its code."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            cuts, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            sizes = np.diff(cuts)
            for length in range(1, longest):
                keys = phrase_keys(flat, length)
                for start in range(longest - length + 1):
                    own = np.flatnonzero((sizes >= start + length) & (sizes > length))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(own)), pa.array(keys[cuts[own] + start].view(np.int64)),
                            pa.array(np.full(len(own), start, np.int32)), pa.array(np.full(len(own), length, np.int32)),
                        ],
                        names=["key", "part", "start", "length"],
                    )

    return phrases.select("key", "words").mapInArrow(run, "key long, part long, start int, length int")


def mined(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` collocations of each language.

    Texts are lower-cased (A-Z) and split at . , ; : ! ? and line ends into pieces and these at blanks and tabs into words. A
    phrase of `a` occurrences, cut in two with `l` and `r` occurrences, scores floor(1000 * a * n / (l * r)) by its
    weakest cut (ties: the first). Phrases that always occur within one longer candidate are left out (`percent`). A NULL
    language is `und`, a NULL text empty; every row counts, also repeated ones and those without an id.
    """
    words, phrases, sizes = frequent(docs, settings)
    spelling = _stored(words)
    parts = _parts(phrases, settings.longest).join(phrases.select("key", F.col("f").alias("a"), F.size("words").alias("k")), "key")
    known = spelling.select(F.col("code").alias("part"), "f").union(phrases.select("key", "f"))
    parts = _stored(parts.join(known, "part"))
    first = parts.filter("start = 0").select("key", "a", "k", F.col("length").alias("cut"), F.col("f").alias("l"))
    rest = parts.filter("start > 0 AND start + length = k").select("key", F.col("start").alias("cut"), F.col("f").alias("r"))
    long = parts.filter("length > 1").groupBy(F.col("part").alias("key")).agg(F.max("a").alias("longer"))
    text = phrases.select("key", F.posexplode("words").alias("at", "code")).join(spelling.select("code", "lang", "word"), "code")
    text = text.groupBy("key").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    text = text.select("key", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    scores = first.join(rest, ["key", "cut"]).join(text, "key").join(sizes, "lang")
    whole = "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))"
    scores = scores.withColumn("score", F.expr(f"({whole}) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"))
    weakest = scores.groupBy("key", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    weakest = weakest.join(long, "key", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < settings.percent * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= settings.top)
    return ranked.select("lang", "rank", "phrase", "a", "x.l", "x.r", "n", "x.score")
