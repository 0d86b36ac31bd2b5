"""Language-model scores by a hierarchical Pitman-Yor model of words and their spelling.

A token's context is the word before it, whichever that is, and the class of the last common word
before it in the text. Each context has a restaurant of words; those of one class share the class's
restaurant as parent, all classes share one restaurant of words, and that one's new
words are spelled by its own parent, a model of characters. There, the restaurant of each context
of up to four characters shares the restaurant of the context without its first character as
parent, down to a uniform choice of characters. So every token has a probability, a word that was
never seen by its spelling. Classes are clusters of common words that occur in the same documents. Seating is sampled by Gibbs sweeps, in which all customers of a dish leave
and are seated again one by one. The seating behind previous words is drawn given the restaurants
above it, those are seated anew below it, and their predictive probabilities are averaged over samples.

How it runs: tasks turn chunks of documents into token indices, distinct words, and distinct pairs of
a word and the one before. Pairs meet in halls by the previous word; the restaurants of a common
one (and of the start of a text) are spread over all halls by the next word, and their sums are on the driver. A
hall's tables are the customers of the classes, which meet in buckets of the word's hash; sweeps pass over
the distinct words in parallel; their probabilities go back to the halls, and those of pairs to
the chunks. Only the character model, of a fixed number of hashed cells, and sums are on the driver.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.llm import chars, folds
from ratecal.session import new_folder, shuffles_dropped

LEVELS = 5  # contexts of 0 to 4 characters
START, END, STOP = 0x110000, 0x110001, 0x110002  # no code points: before and after a word, end of a text
UNIFORM = 1 / 0x110003
CLASSES = 8  # of contexts: no common word yet, and seven clusters; the low bits of a word's hash say which


@dataclass(frozen=True)
class Settings:
    """`tokens`: of a chunk; `buckets`: shares of the vocabulary, a power of two, each worked on by one
    task at a time; `hall`: bytes of text whose pairs of words are in one hall; `seatings`: of pairs, after that of
    one table each; `cells`, `contexts`: bits of the hashed character restaurants (cells that collide
    share their customers); `samples`: averaged states of the seating, after one that is not used;
    `sweeps`: over the characters for each of them; `common`: words that have a class, counted in
    all training documents; `strength`: of all restaurants."""

    tokens: int = 1_500_000
    buckets: int = 256
    hall: int = 1 << 24
    seatings: int = 1
    cells: int = 20
    contexts: int = 18
    samples: int = 2
    sweeps: int = 3
    common: int = 128
    strength: float = 1.0
    seed: int = 13


# --- seating ---------------------------------------------------------------------------------


def seat(customers, opening, discount, random):
    """Tables of each dish after all its customers are seated one by one.

    The next of n customers at t tables opens a table with probability a / (a + n - discount * t), where
    `opening` is a. Between two openings the chance that none opens is a ratio of gamma functions,
    close to a power of n, so the next opening is drawn directly. Where several are expected among the
    next n / 16 customers, the chance hardly changes in between, and their number is drawn at once by the
    chance in the middle. So the work follows the logarithm of the customers, also of the commonest words.
    """
    tables = (customers > 0).astype(np.int64)
    seated = tables.astype(np.float64)
    active = np.flatnonzero(customers > 1)
    while len(active):
        stretch = np.minimum(np.maximum(seated[active] // 16, 1), customers[active] - seated[active])
        chance = opening[active] / (opening[active] + seated[active] - discount * tables[active])
        often = chance * stretch >= 1
        if often.any():
            at, stretch, chance = active[often], stretch[often], chance[often]
            middle = seated[at] - discount * tables[at] + (1 - discount * chance) * (stretch - 1) / 2
            tables[at] += random.binomial(stretch.astype(np.int64), opening[at] / (opening[at] + middle))
            seated[at] += stretch
        at, active = active[often], active[~often]
        a, t, n = opening[active], tables[active], seated[active]
        free = n - discount * t
        half = (a - 1) / 2
        base = np.maximum(free + half, free / 4)
        with np.errstate(over="ignore", divide="ignore"):
            event = base * random.random(len(active)) ** (-1 / a) - half + discount * t
        event = np.maximum(np.floor(event), n)
        opens = event < customers[active]
        active, event = active[opens], event[opens]
        tables[active] += 1
        seated[active] = event + 1
        active = np.concatenate([at, active])
        active = active[seated[active] < customers[active]]
    return tables


def discount_of(ones, twos):
    """The usual estimate of a discount from the numbers of dishes with one and two customers."""
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.9))


# --- the character model -----------------------------------------------------------------------


class Model:
    """The averaged predictive probability of a character on each level: own[level, cell] plus
    rest[level, context] times the parent's. Sent between processes without the unused cells."""

    def __init__(self, own, rest):
        self.own, self.rest = own.astype(np.float32), rest.astype(np.float32)

    def __getstate__(self):
        cells, contexts = np.flatnonzero(self.own), np.flatnonzero(self.rest != 1)
        return (
            self.own.shape, cells.astype(np.uint32), self.own.ravel()[cells],
            self.rest.shape, contexts.astype(np.uint32), self.rest.ravel()[contexts],
        )

    def __setstate__(self, state):
        own_shape, cells, own, rest_shape, contexts, rest = state
        self.own, self.rest = np.zeros(own_shape, dtype=np.float32), np.ones(rest_shape, dtype=np.float32)
        self.own.ravel()[cells], self.rest.ravel()[contexts] = own, rest


class Spelling:
    """Cells and contexts of all characters of some words, for every level."""

    def __init__(self, words, settings):
        text = "".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        size = LEVELS - 1
        ends = np.cumsum(lengths + size + 1)
        starts = ends - (lengths + size + 1)
        row = np.full(ends[-1] if len(ends) else 0, START, dtype=np.uint32)
        at = np.arange(len(points)) + np.repeat(starts + size - (np.cumsum(lengths) - lengths), lengths)
        # U+0000 alone is how the end of a text comes here; a word of that one character shares its spelling
        row[at] = np.where(points == 0, STOP, points)
        row[ends - 1] = END
        place = np.sort(np.concatenate([at, ends - 1]))
        self.first = np.cumsum(lengths + 1) - (lengths + 1)
        self.n = len(words)
        self.lengths = lengths + 1
        cell_mask, context_mask = np.uint32((1 << settings.cells) - 1), np.uint32((1 << settings.contexts) - 1)
        self.cells, self.contexts = [], []
        for level in range(LEVELS):
            grams = chars.gram_hashes(row, level + 1)
            self.cells.append((grams[place - level] & cell_mask).astype(np.int32))
            if level:
                self.contexts.append((chars.gram_hashes(row, level)[place - level] & context_mask).astype(np.int32))
            else:
                self.contexts.append(np.zeros(len(place), dtype=np.int32))

    def log_probability(self, model):
        """Natural logarithm of the probability of each word's spelling."""
        if not self.n:
            return np.zeros(0)
        own, rest = model.own, model.rest
        p = np.full(len(self.cells[0]), UNIFORM)
        for level in range(LEVELS):
            p = own[level, self.cells[level]] + rest[level, self.contexts[level]] * p
        return np.add.reduceat(np.log(p), self.first)

    def customers(self, tables):
        """Of each top cell that occurs: the number of characters that `tables` of each word send there,
        and its cells and contexts on all levels."""
        weight = np.repeat(tables, self.lengths)
        cell, index, where = np.unique(self.cells[-1], return_index=True, return_inverse=True)
        n = np.bincount(where, weights=weight, minlength=len(cell)).astype(np.int64)
        some = n > 0
        index = index[some]
        return [n[some], *[c[index] for c in self.cells], *[c[index] for c in self.contexts]]


def character_model(table, settings, seed):
    """The model after Gibbs sweeps over the characters' seating. `table`: customers, cells and contexts
    of the top cells."""
    n, cells, contexts = table[0], table[1 : 1 + LEVELS], table[1 + LEVELS :]
    own, rest = np.zeros((LEVELS, 1 << settings.cells)), np.ones((LEVELS, 1 << settings.contexts))
    if not len(n):
        return Model(own, rest)
    random = np.random.default_rng(seed)
    dish, parent, context = [], [], []
    # the distinct cells of each level, the place of each one's parent, and its context
    below = np.arange(len(n))
    for level in range(LEVELS - 1, -1, -1):
        found, first, where = np.unique(cells[level][below], return_index=True, return_inverse=True)
        dish.insert(0, found)
        context.insert(0, contexts[level][below][first])
        parent.insert(0, where)  # of the level above in this one
        below = below[first]
    customers = [None] * LEVELS
    tables = [None] * LEVELS
    customers[-1] = np.bincount(parent[-1], weights=n)
    discounts = [0.0] * LEVELS
    for level in range(LEVELS - 1, -1, -1):
        tables[level] = np.ones(len(dish[level]), dtype=np.int64)
        discounts[level] = discount_of((customers[level] == 1).sum(), (customers[level] == 2).sum())
        if level:
            customers[level - 1] = np.bincount(parent[level - 1], weights=tables[level])
    size, kept = 1 << settings.contexts, max(1, settings.sweeps - 1)
    total_own, total_rest = np.zeros(own.shape), np.zeros(rest.shape)
    for sweep in range(settings.sweeps):
        share, p = [None] * LEVELS, np.full(len(dish[0]), UNIFORM)
        base = [None] * LEVELS
        for level in range(LEVELS):
            base[level] = p
            d, c = discounts[level], context[level]
            all_customers = np.bincount(c, weights=customers[level], minlength=size)
            all_tables = np.bincount(c, weights=tables[level], minlength=size)
            back = (settings.strength + d * all_tables) / (settings.strength + all_customers)
            share[level] = (customers[level] - d * tables[level]) / (settings.strength + all_customers[c])
            if sweep >= settings.sweeps - kept:
                total_own[level, dish[level]] += share[level]
                total_rest[level] += back
            p = share[level] + back[c] * p
            if level < LEVELS - 1:
                p = p[parent[level]]
        if sweep == settings.sweeps - 1:
            break
        for level in range(LEVELS - 1, -1, -1):
            d, c = discounts[level], context[level]
            all_tables = np.bincount(c, weights=tables[level], minlength=size)
            tables[level] = seat(customers[level], (settings.strength + d * all_tables[c]) * base[level], d, random)
            if level:
                customers[level - 1] = np.bincount(parent[level - 1], weights=tables[level])
    return Model(total_own / kept, total_rest / kept)


# --- words in chunks and buckets -------------------------------------------------------------


def _words(texts):
    """The hash of each word, its place, and the bounds of each text's words; the lowest bits are 0."""
    codes = chars.Codes(texts)
    points = chars.ascii_lower(codes.points)
    start, end = chars.runs(~chars.ascii_space(points))
    return chars.segment_hashes(points, start, end) & KEY, start, end, np.searchsorted(start, np.concatenate([[0], codes.ends]))


def common_words(docs: DataFrame, settings: Settings):
    """(hashes, classes) of the most common words of the training documents, by hash.

    Spherical k-means on which documents they share. What comes to the driver is one row for each
    common word and their table of shared documents.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("text").isNotNull() & (folds.remainder("doc_id", 10) != 0)
    )
    rows = rows.select("text")

    def count(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in chars.chunks(texts):
                found, n = np.unique(_words(texts[a:b])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["word", "n"])

    counted = rows.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(settings.common).toArrow()["word"].to_numpy()
    words = np.sort(top.view(np.uint64))

    def meet(batches):
        total = np.zeros((len(words), len(words)), dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in chars.chunks(texts):
                word, _, _, cuts = _words(texts[a:b])
                at = np.minimum(np.searchsorted(words, word), len(words) - 1)
                has = np.zeros((b - a, len(words)), dtype=np.int64)
                hit = np.flatnonzero(words[at] == word)
                has[np.searchsorted(cuts, hit, side="right") - 1, at[hit]] = 1
                total += has.T @ has
        x, y = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(total[x, y])], names=["x", "y", "n"])

    if not len(words):
        return words, np.zeros(0, dtype=np.uint64)
    pairs = rows.mapInArrow(meet, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(words), len(words)))
    table[pairs["x"].to_numpy(), pairs["y"].to_numpy()] = pairs["n"].to_numpy()
    size = np.sqrt(np.diag(table))
    near = table / np.outer(size, size)
    near /= np.linalg.norm(near, axis=1)[:, None]
    centres = near[[int(np.argmax(size))]]
    while len(centres) < min(CLASSES - 1, len(words)):  # the word that is farthest from all so far
        centres = np.vstack([centres, near[int(np.argmin((near @ centres.T).max(axis=1)))]])
    for _ in range(20):
        label = (near @ centres.T).argmax(axis=1)
        sums = np.stack([near[label == k].sum(axis=0) if (label == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1)[:, None]
    return words, (label + 1).astype(np.uint64)


def _packed_words(words):
    """Words, in which there is no white space, as compressed bytes behind their size."""
    text = "\n".join(words).encode()
    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _unpacked_words(packed):
    text = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    return pa.array(text.decode().split("\n"), type=pa.string())


def _packed_hashes(hashes):
    """Distinct hashes in their order, as the steps between them."""
    return chars.packed(np.diff(hashes, prepend=np.uint64(0)))


def _unpacked_hashes(held):
    return np.cumsum(chars.unpacked(held, np.uint64), dtype=np.uint64)


def _packed_repeated(hashes):
    """Hashes of which many repeat: the distinct ones behind the size of their bytes, and which of them each is."""
    distinct, which = np.unique(hashes, return_inverse=True)
    distinct = _packed_hashes(distinct)
    return len(distinct).to_bytes(8, "little") + distinct + chars.packed(which.astype(np.int32))


def _unpacked_repeated(held):
    """(distinct hashes in their order, which of them each is)"""
    cut = 8 + int.from_bytes(held[:8], "little")
    return _unpacked_hashes(held[8:cut]), chars.unpacked(held[cut:], np.int32)


class Chunk:
    """Tokens of several texts, until there are enough of them."""

    def __init__(self, common):
        self.common = common
        self.tokens, self.sizes, self.ids, self.held, self.train, self.words, self.n = [], [], [], [], [], {int(STOP_HASH): "\0"}, 0

    def add(self, texts, ids, held, train):
        joined = "\n".join(texts).encode().lower().decode() + "\n"  # bytes: A-Z only
        word, start, end, cuts = _words(texts)
        found, first = np.unique(word, return_index=True)
        for h, a, b in zip(found.tolist(), start[first].tolist(), end[first].tolist()):
            if h not in self.words:
                self.words[h] = joined[a:b]
        # an end of text comes after the words of every document, as the last of its tokens
        sizes = np.diff(cuts) + 1
        stops = np.cumsum(sizes) - 1
        tokens = np.full(stops[-1] + 1, STOP_HASH, dtype=np.uint64)
        inside = np.ones(len(tokens), dtype=bool)
        inside[stops] = False
        tokens[inside] = word
        words, classes = self.common
        if len(words):
            at = np.minimum(np.searchsorted(words, tokens), len(words) - 1)
            place = np.arange(len(tokens))
            last = np.maximum.accumulate(np.where(words[at] == tokens, place, -1))
            last = np.concatenate([[-1], last[:-1]])  # before the token
            tokens |= np.where(last >= np.repeat(stops + 1 - sizes, sizes), classes[at[last]], np.uint64(0))
        self.tokens.append(tokens)
        self.sizes.append(sizes)
        self.ids += ids
        self.held += held
        self.train += train
        self.n += len(tokens)

    def rows(self, settings):
        """The chunk's documents as one row, and its distinct words as one row for each bucket. Tokens are numbered from
        the commonest on, so most of their bytes are few."""
        chunk = uuid.uuid4().hex
        sizes = np.concatenate(self.sizes)
        keys, where = np.unique(np.concatenate(self.tokens), return_inverse=True)
        train = np.repeat(np.array(self.train, dtype=bool), sizes)
        order = np.argsort(-np.bincount(where, minlength=len(keys)), kind="stable")
        number = np.empty(len(order), dtype=np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        yield [0, chunk, None, chars.packed(keys[order]), None, None, self.ids, self.held, self.train, sizes, chars.packed(number[where])]
        own, word = np.unique(keys & KEY, return_inverse=True)
        counts = np.bincount(word[where[train]], minlength=len(own))
        cuts = np.searchsorted(_top(own, settings.buckets), np.arange(settings.buckets + 1, dtype=np.uint64))
        for bucket in np.flatnonzero(np.diff(cuts)):
            at = slice(cuts[bucket], cuts[bucket + 1])
            words = _packed_words([self.words[h] for h in own[at].tolist()])
            yield [1, chunk, int(bucket), _packed_hashes(own[at]), chars.packed(counts[at]), words, None, None, None, None, None]


class Pairs:
    """The distinct pairs of a token and the word before it in a chunk: hall after hall (`cuts`), in the order of
    their hashes within each. `place`: the pair of each token. Found from the chunk's row of documents whenever they are needed."""

    def __init__(self, row, common, halls):
        sizes = _list(row, "sizes").astype(np.int64)
        keys, number = np.unique(chars.unpacked(row["keys"][0].as_py(), np.uint64), return_inverse=True)
        where = number[chars.unpacked(row["tokens"][0].as_py(), np.int32)]
        words, word = np.unique(keys & KEY, return_inverse=True)
        before = np.concatenate([[0], word[where[:-1]]])
        before[np.cumsum(sizes) - sizes] = len(words)
        words = np.append(words, START_HASH)
        code, place = np.unique(before * len(keys) + where, return_inverse=True)
        previous, token = words[code // len(keys)], keys[code % len(keys)]
        hall = _top(np.where(_spread(previous, common), token, previous), halls)
        order = np.argsort(hall, kind="stable")
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        self.previous, self.keys, self.place = previous[order], token[order], number[place]
        self.cuts, self.sizes = np.searchsorted(hall[order], np.arange(halls + 1, dtype=np.uint64)), sizes


def _top(hashes, parts):
    """Which of the parts, a power of two, each hash falls in; in the order of the hashes."""
    return hashes >> np.uint64(64 - parts.bit_length() + 1) if parts > 1 else np.zeros(len(hashes), dtype=np.uint64)


def _spread(previous, common):
    """Whether the restaurant behind a previous word is spread over the halls: common words and starts of texts."""
    return np.isin(previous, np.append(common, START_HASH))


def _run_lengths(sorted_values):
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return sorted_values[first], np.diff(np.append(first, len(sorted_values)))


KEY = ~np.uint64(CLASSES - 1)
STOP_HASH = np.uint64(0x5DEECE66D1CE4E58)
START_HASH = KEY  # the word before the first one of a text
CHUNKS = (
    "kind int, chunk string, bucket int, keys binary, counts binary, words binary, ids array<long>, "
    "held array<boolean>, train array<boolean>, sizes array<long>, tokens binary"
)
CHUNK_TYPES = [
    pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
    pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(),
]
CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _batch(rows, types, names):
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)], names=names)


def _chunks(docs: DataFrame, common, settings: Settings) -> DataFrame:
    def run(batches):
        chunk = Chunk(common)
        for batch in batches:
            ids, held, train = (batch.column(k).to_pylist() for k in (0, 2, 3))
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chars.chunks(texts):
                chunk.add(texts[a:b], ids[a:b], held[a:b], train[a:b])
                if chunk.n >= settings.tokens:
                    for row in chunk.rows(settings):
                        yield _batch([row], CHUNK_TYPES, CHUNK_NAMES)
                    chunk = Chunk(common)
        if chunk.ids:
            for row in chunk.rows(settings):
                yield _batch([row], CHUNK_TYPES, CHUNK_NAMES)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", folds.held_out("doc_id", 10, 0).alias("held"),
        F.coalesce(folds.remainder("doc_id", 10) != 0, F.lit(False)).alias("train"),
    )
    return rows.mapInArrow(run, CHUNKS)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1)


def _list(row, name):
    """The array in a column of a batch of one row."""
    return row[name].flatten().to_numpy(zero_copy_only=False)


# --- the restaurants behind previous words -------------------------------------------------------

HALLS = (
    "hall int, previous binary, runs binary, keys binary, counts binary, tables binary, chunks array<string>, "
    "places array<binary>, spread array<long>, customers array<long>, seated array<long>, ones long, twos long"
)
HALL_TYPES = [
    pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.binary()),
    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(),
]
HALL_NAMES = [c.split()[0] for c in HALLS.split(", ")]


class Hall:
    """The pairs of a hall, and customers and tables of the context of each. Contexts that are spread over the
    halls have those of all halls if `totals` are given."""

    def __init__(self, number, previous, runs, keys, counts, tables, common, totals=None):
        """`keys`: (distinct ones, which of them each pair has)."""
        self.number, self.previous, self.runs, self.keys, self.counts, self.tables = number, previous, runs, keys, counts, tables
        code = np.repeat(np.arange(len(previous)) * CLASSES, runs) + (keys[0] & ~KEY).astype(np.int64)[keys[1]]
        context, self.at = np.unique(code, return_inverse=True)
        self.context = previous[context // CLASSES] | (context % CLASSES).astype(np.uint64)
        self.customers, self.seated = (np.bincount(self.at, weights=x, minlength=len(context)) for x in (counts, tables))
        self.spread = _spread(self.context & KEY, common)
        if totals is not None and self.spread.any():
            contexts, *sums = totals
            place = np.searchsorted(contexts, self.context[self.spread])
            self.customers[self.spread], self.seated[self.spread] = (x[place] for x in sums)

    @classmethod
    def of(cls, row, common, totals=None):
        counted = {c: chars.unpacked(row[c][0].as_py(), np.int64) for c in ("runs", "counts", "tables")}
        previous, keys = _unpacked_hashes(row["previous"][0].as_py()), _unpacked_repeated(row["keys"][0].as_py())
        return cls(row["hall"][0].as_py(), previous, counted["runs"], keys, counted["counts"], counted["tables"], common, totals)

    def row(self, chunks, places):
        held = [_packed_hashes(self.previous), chars.packed(self.runs), _packed_repeated(self.keys[0][self.keys[1]])]
        held += [chars.packed(self.counts), chars.packed(self.tables)]
        some = self.spread
        sums = [self.context[some].view(np.int64), *[x[some].astype(np.int64) for x in (self.customers, self.seated)]]
        return _batch([[self.number, *held, chunks, places, *sums, int((self.counts == 1).sum()), int((self.counts == 2).sum())]], HALL_TYPES, HALL_NAMES)


def _hall_count(docs: DataFrame, settings: Settings) -> int:
    """Halls, a power of two, for all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << max(0, -(-size // settings.hall) - 1).bit_length()


def _halls(chunks: DataFrame, common, halls: int) -> DataFrame:
    """The pairs of each hall with their counts in training texts, one table for each that has any, and which pairs each chunk asks for."""
    common = common[0]
    types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    schema = "chunk string, hall int, previous binary, runs binary, keys binary, counts binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def pairs(batches):
        for row in _rows(batches):
            pairs = Pairs(row, common, halls)
            train = np.repeat(_list(row, "train"), pairs.sizes)
            counts = np.bincount(pairs.place[train], minlength=len(pairs.keys))
            for hall in np.flatnonzero(np.diff(pairs.cuts)):
                at = slice(pairs.cuts[hall], pairs.cuts[hall + 1])
                previous, runs = _run_lengths(pairs.previous[at])
                held = [_packed_hashes(previous), chars.packed(runs), _packed_repeated(pairs.keys[at]), chars.packed(counts[at])]
                yield _batch([[row["chunk"][0].as_py(), int(hall), *held]], types, names)

    def merged(hall, rows):
        keys = [own[which] for own, which in (_unpacked_repeated(r["keys"][0].as_py()) for r in rows)]
        previous = np.concatenate([np.repeat(_unpacked_hashes(r["previous"][0].as_py()), chars.unpacked(r["runs"][0].as_py(), np.int64)) for r in rows])
        counts = np.concatenate([chars.unpacked(r["counts"][0].as_py(), np.int64) for r in rows])
        ends = np.cumsum([len(x) for x in keys])[:-1]
        keys = np.concatenate(keys)
        order = np.lexsort((keys, previous))
        previous, keys = previous[order], keys[order]
        new = np.concatenate([[True], (previous[1:] != previous[:-1]) | (keys[1:] != keys[:-1])])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        counts = np.bincount(place, weights=counts).astype(np.int64)
        made = Hall(hall, *_run_lengths(previous[new]), np.unique(keys[new], return_inverse=True), counts, (counts > 0).astype(np.int64), common)
        places = [chars.packed(np.diff(x, prepend=0).astype(np.int32)) for x in np.split(place, ends)]
        return made.row([r["chunk"][0].as_py() for r in rows], places)

    def run(batches):
        held, hall = [], None
        for row in _rows(batches):
            if held and row["hall"][0].as_py() != hall:
                yield merged(hall, held)
                held = []
            hall = row["hall"][0].as_py()
            held.append(row)
        if held:
            yield merged(hall, held)

    rows = chunks.filter("kind = 0").select("chunk", "keys", "tokens", "sizes", "train").mapInArrow(pairs, schema)
    return rows.repartition("hall").sortWithinPartitions("hall", "chunk").mapInArrow(run, HALLS)


def _hall_totals(halls: DataFrame):
    """((contexts, customers, tables) of the contexts that are spread over the halls, the discount of pairs)."""
    rows = halls.select(F.explode(F.arrays_zip("spread", "customers", "seated")).alias("x")).select("x.*")
    found = rows.groupBy("spread").agg(F.sum("customers").alias("customers"), F.sum("seated").alias("seated")).toArrow()
    context = found["spread"].to_numpy().view(np.uint64)
    order = np.argsort(context)
    sums = halls.agg(F.sum("ones").alias("ones"), F.sum("twos").alias("twos")).first()
    return (context[order], *[found[c].to_numpy()[order] for c in ("customers", "seated")]), discount_of(sums["ones"] or 0, sums["twos"] or 0)


def _asks(halls: DataFrame, settings: Settings) -> DataFrame:
    """The distinct words in their classes of each hall, for each bucket, with the tables at which they are served."""
    types, schema = [pa.int32(), pa.int32(), pa.binary(), pa.binary()], "hall int, bucket int, keys binary, counts binary"

    def run(batches):
        for row in _rows(batches):
            keys, where = _unpacked_repeated(row["keys"][0].as_py())
            tables = chars.unpacked(row["tables"][0].as_py(), np.int64)
            tables = np.bincount(where, weights=tables, minlength=len(keys)).astype(np.int64)
            cuts = np.searchsorted(_top(keys, settings.buckets), np.arange(settings.buckets + 1, dtype=np.uint64))
            for bucket in np.flatnonzero(np.diff(cuts)):
                at = slice(cuts[bucket], cuts[bucket + 1])
                yield _batch([[row["hall"][0].as_py(), int(bucket), _packed_hashes(keys[at]), chars.packed(tables[at])]], types, ["hall", "bucket", "keys", "counts"])

    return halls.select("hall", "keys", "tables").mapInArrow(run, schema)


def _meeting(halls: DataFrame, answers: DataFrame, use, schema, common, totals, settings) -> DataFrame:
    """The rows that `use` makes of each hall, its row, and for each of its pairs the logarithm of the word's
    probability in its class and its count."""
    common, (totals, discount) = common[0], totals

    def run(batches):
        logs, trained = [], []
        for row in _rows(batches):
            if row["kind"][0].as_py() == 0:
                logs.append(chars.unpacked(row["logs"][0].as_py(), np.float64))
                trained.append(chars.unpacked(row["trained"][0].as_py(), np.int64))
                continue
            hall = Hall.of(row, common, totals)
            yield from use(hall, row, *(np.concatenate(x)[hall.keys[1]] for x in (logs, trained)), discount)
            logs, trained = [], []

    rows = answers.withColumn("kind", F.lit(0)).unionByName(halls.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return rows.repartition("hall").sortWithinPartitions("hall", "kind", "bucket").mapInArrow(run, schema)


def _seated(halls, answers, common, totals, number, settings) -> DataFrame:
    """The halls after all customers of their pairs have left and are seated again."""

    def use(hall, row, log, count, discount):
        random = np.random.default_rng([settings.seed, number, hall.number])
        opening = np.maximum((settings.strength + discount * hall.seated[hall.at]) * 10**log, 1e-300)
        tables = seat(hall.counts, opening, discount, random)
        now = Hall(hall.number, hall.previous, hall.runs, hall.keys, hall.counts, tables, common[0])
        yield now.row(row["chunks"][0].as_py(), row["places"][0].as_py())

    return _meeting(halls, answers, use, HALLS, common, totals, settings)


def _predicted(halls, answers, common, totals, settings) -> DataFrame:
    """(chunk, hall, logs, counts): for the pairs that a chunk asked for, in its order, the logarithm of the
    predictive probability and the word's count in training texts."""
    types, schema = [pa.string(), pa.int32(), pa.binary(), pa.binary()], "chunk string, hall int, logs binary, counts binary"

    def use(hall, row, log, count, discount):
        customers = settings.strength + hall.customers[hall.at]
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(hall.counts - discount * hall.tables, 0) / customers)
        back = np.log((settings.strength + discount * hall.seated[hall.at]) / customers)
        logs = (np.logaddexp(own, back + log * np.log(10)) / np.log(10)).astype(np.float32)
        for chunk, places in zip(row["chunks"][0].as_py(), row["places"][0].as_py()):
            at = np.cumsum(chars.unpacked(places, np.int32), dtype=np.int64)
            yield _batch([[chunk, hall.number, chars.packed(logs[at]), chars.packed(count[at])]], types, ["chunk", "hall", "logs", "counts"])

    return _meeting(halls, answers, use, schema, common, totals, settings)


SUMS = ["total", "known", "ones", "twos", "single", "double", *[f"context{k}" for k in range(CLASSES)]]


def _told(rows):
    """The distinct words that (keys, counts, packed words) tell of, with their counts added up."""
    own, first, where = np.unique(np.concatenate([x for x, _, _ in rows]), return_index=True, return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([x for _, x, _ in rows]), minlength=len(own)).astype(np.int64)
    return own, counts, pa.concat_arrays([_unpacked_words(x) for _, _, x in rows]).take(pa.array(first)).to_pylist()


def _words_of(chunks: DataFrame) -> DataFrame:
    """The distinct words of all chunks with their counts in training texts, one row for each bucket."""
    types, schema = [pa.int32(), pa.binary(), pa.binary(), pa.binary()], "bucket int, keys binary, counts binary, words binary"

    def merged(bucket, rows):
        own, counts, words = _told(rows)
        return _batch([[bucket, _packed_hashes(own), chars.packed(counts), _packed_words(words)]], types, ["bucket", "keys", "counts", "words"])

    def run(batches):
        held, bucket = [], None
        for row in _rows(batches):
            if held and row["bucket"][0].as_py() != bucket:
                yield merged(bucket, held)
                held = []
            bucket = row["bucket"][0].as_py()
            held.append((_unpacked_hashes(row["keys"][0].as_py()), chars.unpacked(row["counts"][0].as_py(), np.int64), row["words"][0].as_py()))
        if held:
            yield merged(bucket, held)

    rows = chunks.filter("kind = 1").select("bucket", "keys", "counts", "words")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _vocabulary(words: DataFrame, asks: DataFrame, settings: Settings) -> DataFrame:
    """The distinct words of each bucket in the order of their hashes, with their counts in training
    texts (`trained`) and their customers in each class (CLASSES numbers a word), in rows of at most 50,000 words."""
    types = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), *[pa.int64()] * len(SUMS)]
    schema = "bucket int, part int, keys array<long>, counts array<long>, trained array<long>, words array<string>, " + ", ".join(f"{c} long" for c in SUMS)
    names = [c.split()[0] for c in schema.split(", ")]

    def merged(bucket, told, asked):
        own, trained, words = told
        counts = np.zeros(len(own) * CLASSES, dtype=np.int64)
        for keys, tables in asked:
            counts[np.searchsorted(own, keys & KEY) * CLASSES + (keys & ~KEY).astype(np.int64)] += tables
        counts = counts.reshape(-1, CLASSES)
        for part, at in enumerate(range(0, len(own), 50_000)):
            c, n = counts[at : at + 50_000], trained[at : at + 50_000]
            contexts = (c > 0).sum(axis=1)
            sums = [n.sum(), (n > 0).sum(), (c == 1).sum(), (c == 2).sum(), (contexts == 1).sum(), (contexts == 2).sum()]
            sums = [int(x) for x in (*sums, *c.sum(axis=0))]
            yield _batch([[bucket, part, own[at : at + 50_000].view(np.int64), c.ravel(), n, words[at : at + 50_000], *sums]], types, names)

    def run(batches):
        told, asked, bucket = None, [], None
        for row in _rows(batches):
            if told and row["bucket"][0].as_py() != bucket:
                yield from merged(bucket, told, asked)
                told, asked = None, []
            bucket = row["bucket"][0].as_py()
            keys, counts = _unpacked_hashes(row["keys"][0].as_py()), chars.unpacked(row["counts"][0].as_py(), np.int64)
            if row["words"][0].is_valid:
                told = keys, counts, _unpacked_words(row["words"][0].as_py()).to_pylist()
            else:
                asked.append((keys, counts))
        if told:
            yield from merged(bucket, told, asked)

    rows = words.unionByName(asks.select("bucket", "keys", "counts"), allowMissingColumns=True)
    # the words before those that are asked for
    return rows.repartition("bucket").sortWithinPartitions("bucket", F.col("words").isNull()).mapInArrow(run, schema)


# --- sweeps over the words and their answers ----------------------------------------------------


@dataclass(frozen=True)
class State:
    """One state of the seating: the tables of each context's restaurant, those of the restaurant that
    they share, and the character model that follows from them."""

    contexts: np.ndarray
    tables: int
    model: Model


class Seating:
    """Tables of the words of a part of the vocabulary, state after state. They are drawn again whenever
    they are needed, always the same, so nothing but the vocabulary is stored."""

    def __init__(self, row, states, discounts, settings, every=False):
        """`every`: also spell the words without customers, for `log_probability`."""
        self.counts = _list(row, "counts").reshape(-1, CLASSES)
        self.some = self.counts.any(axis=1)
        self.place = [row["bucket"][0].as_py(), row["part"][0].as_py()]
        words = row["words"].flatten()
        self.spelling = Spelling((words if every else words.filter(pa.array(self.some))).to_pylist(), settings)
        self.seated = self.some if every else slice(None)
        self.states, self.discounts, self.settings, self.known = states, discounts, settings, {}

    def log_probability(self, state):
        """Of each word's spelling in a state; kept for the next call."""
        if id(state) not in self.known:
            self.known[id(state)] = self.spelling.log_probability(state.model)
        return self.known[id(state)]

    def __iter__(self):
        """(tables in each context, tables of the shared restaurant) for the state after each of `states`,
        that of one table for each word and context first."""
        counts = self.counts[self.some]
        inner, outer, strength = *self.discounts, self.settings.strength
        own = (counts > 0).astype(np.int64)
        shared = np.ones(len(counts), dtype=np.int64)
        yield own, shared
        for number, state in enumerate(self.states):
            random = np.random.default_rng([self.settings.seed, number, *self.place])
            spelled = (strength + outer * state.tables) * np.exp(self.log_probability(state)[self.seated])
            word = np.maximum(own.sum(axis=1) - outer * shared + spelled, 1e-300) / (strength + state.contexts.sum())
            opening = word[:, None] * (strength + inner * state.contexts)
            own = seat(counts.ravel(), opening.ravel(), inner, random).reshape(-1, CLASSES)
            shared = seat(own.sum(axis=1), np.maximum(spelled, 1e-300), outer, random)
            yield own, shared


def _sweep(vocabulary, states, discounts, settings) -> State:
    """The state after `states`. The customers of the character model come to the driver by cells, of
    which there is a fixed number."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(states)
    names = ["n", *[f"cell{k}" for k in range(LEVELS)], *[f"context{k}" for k in range(LEVELS)]]
    top = f"cell{LEVELS - 1}"

    def run(batches):
        for row in _rows(batches):
            seating = Seating(row, sent.value, discounts, settings)
            *_, (own, shared) = seating
            found = seating.spelling.customers(shared)
            # further rows, of no cells, count the tables of the restaurants
            sums = np.append(own.sum(axis=0), shared.sum())
            arrays = [np.append(found[0], sums), *[np.append(x, -1 - np.arange(len(sums))).astype(np.int32) for x in found[1:]]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)

    rows = vocabulary.select("bucket", "part", "counts", "words").mapInArrow(run, "n long, " + ", ".join(f"{c} int" for c in names[1:]))
    others = [F.min(c).alias(c) for c in names[1:] if c != top]
    found = rows.groupBy(top).agg(F.sum("n").alias("n"), *others).select(names).toArrow()
    sent.destroy()
    columns = {c: found[c].to_numpy() for c in names}
    order = np.argsort(columns[top])
    columns = {c: x[order] for c, x in columns.items()}
    some = columns[top] >= 0
    sums = np.zeros(CLASSES + 1, dtype=np.int64)
    sums[-1 - columns[top][~some]] = columns["n"][~some]
    model = character_model([columns[c][some] for c in names], settings, [settings.seed, len(states)])
    return State(sums[:-1], int(sums[-1]), model)


def _answers(asks, vocabulary, states, sums, discounts, settings) -> DataFrame:
    """(hall, bucket, logs, trained): for the words in classes that a hall asked for, in its
    order, the logarithm of the averaged predictive probability and the word's count in training texts."""
    spark = vocabulary.sparkSession
    sent = spark.sparkContext.broadcast(states)
    per_context = np.array([sums[f"context{k}"] for k in range(CLASSES)])
    (inner, outer), strength = discounts, settings.strength
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    schema = "hall int, bucket int, logs binary, trained binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def predicted(row):
        """Logarithms for one part of the vocabulary in each context, averaged over the states."""
        states = sent.value
        seating = Seating(row, states[:-1], discounts, settings, every=True)
        out = np.full(seating.counts.shape, -np.inf)
        for number, ((own, shared), state) in enumerate(zip(seating, states)):
            if not number:
                continue
            tables, outer_tables = np.zeros(out.shape), np.zeros(len(out))
            tables[seating.some], outer_tables[seating.some] = own, shared
            with np.errstate(divide="ignore"):
                seated = np.log(np.maximum(tables.sum(axis=1) - outer * outer_tables, 0))
                here = np.log(np.maximum(seating.counts - inner * tables, 0) / (strength + per_context))
            word = np.logaddexp(seated, np.log(strength + outer * state.tables) + seating.log_probability(state))
            word -= np.log(strength + state.contexts.sum())
            back = np.log((strength + inner * state.contexts) / (strength + per_context))
            out = np.logaddexp(out, np.logaddexp(here, back + word[:, None]))
        return (out - np.log(len(states) - 1)) / np.log(10)

    def run(batches):
        bucket, parts, ready = None, [], None
        for row in _rows(batches):
            if row["bucket"][0].as_py() != bucket:
                bucket, parts, ready = row["bucket"][0].as_py(), [], None
            if row["kind"][0].as_py() == 0:
                parts.append((_list(row, "keys"), predicted(row), _list(row, "trained")))
                continue
            if ready is None:
                ready = [np.concatenate(x) for x in zip(*parts)]
            keys, logs, trained = ready
            asked = _unpacked_hashes(row["asked"][0].as_py())
            at = np.searchsorted(keys.view(np.uint64), asked & KEY)
            found = logs[at, (asked & ~KEY).astype(np.int64)]
            yield _batch([[row["hall"][0].as_py(), bucket, chars.packed(found), chars.packed(trained[at])]], types, names)

    words = vocabulary.select(F.lit(0).alias("kind"), "bucket", "part", "keys", "counts", "trained", "words")
    asked = asks.select(F.lit(1).alias("kind"), "bucket", F.lit(0).alias("part"), F.col("keys").alias("asked"), "hall")
    words = words.unionByName(asked, allowMissingColumns=True)
    rows = words.repartition("bucket").sortWithinPartitions("bucket", "kind", "part")
    return rows.mapInArrow(run, schema)


def _totals(chunks, answers, sums, common, halls) -> DataFrame:
    """The rows of the documents, from the answers that each chunk got."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [c.split()[0] for c in schema.split(", ")]
    total, known, common = sums["total"], sums["known"], common[0]

    def run(batches):
        logs, counts = [], []
        for row in _rows(batches):
            if row["kind"][0].as_py() == 0:
                for held, name, kind in ((logs, "logs", np.float32), (counts, "counts", np.int64)):
                    held.append(chars.unpacked(row[name][0].as_py(), kind))
                continue
            pairs = Pairs(row, common, halls)
            place, sizes = pairs.place, pairs.sizes
            first = np.cumsum(sizes) - sizes
            log, count = (np.concatenate(x) for x in (logs, counts))
            log, base = log.astype(np.float64), np.log10((count + 0.1) / (total + 0.1 * (known + 1)))
            score, base = (np.add.reduceat(x[place], first) for x in (log, base))
            found = np.add.reduceat((count > 0)[place].astype(np.int64), first)
            yield pa.RecordBatch.from_arrays(
                [
                    row["ids"].flatten(), row["held"].flatten(), pa.array(sizes), pa.array(found),
                    pa.array(np.full(len(sizes), total, dtype=np.int64)), pa.array(base), pa.array(score),
                ],
                names=names,
            )
            logs, counts = [], []

    texts = chunks.filter("kind = 0").select(F.lit(1).alias("kind"), "chunk", "ids", "held", "sizes", "keys", "tokens")
    rows = answers.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    return rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "hall").mapInArrow(run, schema)


def scores(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `docs`.

    A NULL or empty text has one token, its end. Rows without an id are scored but neither held out
    nor learned from; repeated rows count each time. Without any training text the model is the
    uniform choice of characters, and the base score 0 for each token.
    """
    # the two kinds of rows of a chunk are written side by side, without a sort
    with shuffles_dropped(docs.sparkSession, spark_sql_maxConcurrentOutputFileWriters="2"):
        stored = _steps(docs, settings)
    return _totals(*stored)


def _steps(docs, settings):
    common, halls = common_words(docs, settings), _hall_count(docs, settings)
    chunks = _stored(_chunks(docs, common, settings), by=["kind"])
    words = _stored(_words_of(chunks))
    _drop(chunks, "/kind=1/")
    pairs = _stored(_halls(chunks, common, halls))
    for number in range(settings.seatings + 1):
        asks = _stored(_asks(pairs, settings))
        vocabulary = _stored(_vocabulary(words, asks, settings))
        sums = _sums(vocabulary)
        discounts = discount_of(sums["ones"], sums["twos"]), discount_of(sums["single"], sums["double"])
        last, states = number == settings.seatings, []
        for _ in range((settings.samples if last else 1) + 1):
            states.append(_sweep(vocabulary, states, discounts, settings))
        answers = _stored(_answers(asks, vocabulary, states, sums, discounts, settings), asks, vocabulary)
        totals = _hall_totals(pairs)
        if not last:
            pairs = _stored(_seated(pairs, answers, common, totals, number, settings), pairs, answers)
    return chunks, _stored(_predicted(pairs, answers, common, totals, settings), pairs, answers, words), sums, common, halls


def _stored(rows: DataFrame, *used: DataFrame, by=()) -> DataFrame:
    """The rows as a table of the work folder; the tables of `used`, which are needed no more, are taken off the disks."""
    where = new_folder(rows.sparkSession)
    rows.write.partitionBy(*by).parquet(where)
    for table in used:
        _drop(table)
    return rows.sparkSession.read.schema(rows.schema).parquet(where)


def _drop(table: DataFrame, within: str = "") -> None:
    """Takes a stored table, or its files `within` a part, off the disks."""
    spark = table.sparkSession
    for file in table.inputFiles():
        if within in file:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def _sums(vocabulary) -> dict:
    """Numbers of tokens and words in training texts, and of customers in each class."""
    return {k: v or 0 for k, v in vocabulary.agg(*[F.sum(c).alias(c) for c in SUMS]).first().asDict().items()}
