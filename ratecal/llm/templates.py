"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, so a question with other values has the same
template. Windows of five tokens are hashed and joined with those of the benchmark; where they
hold placeholders, an item's value must stand for one value, as it does in a question with new
parameters, and windows that contradict it do not count. What the values stand for is taken from
one occurrence of the item in a document at a time, and the best one counts.
"""

import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.llm import bits, chars

# Common units, which are typed only after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml l cl kb mb gb tb s sec min h hr ms hz khz mhz ghz v w kw kwh j kj pa bar c f k "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon gallons second seconds minute minutes "
    "hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees usd eur gbp"
).split()


@dataclass(frozen=True)
class Settings:
    """`window`: tokens; `literal`: least tokens of a window that are no placeholders; `coverage`: least share
    of an item's tokens in windows that a document has."""

    window: int = 5
    literal: int = 2
    coverage: float = 0.8


@lru_cache(maxsize=1)
def _tables():
    """Kinds of all code points: 1 letter, 2 digit (upper case: 5), 0 other; and lower cases."""
    letter, lower = chars.letter_table()
    kind = letter.astype(np.uint8)
    kind[[c for c in range(0x110000) if chr(c).isdigit()]] = 2
    kind[(lower != np.arange(len(lower))) & letter] |= 4
    units = np.sort(_hash_words(UNITS))
    return kind, lower, units


def _hash_words(words):
    codes = chars.Codes(list(words))
    return chars.segment_hashes(codes.points, codes.ends - np.diff(codes.ends, prepend=0), codes.ends - 1)


NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x9D3F1A5B77C2E4A1, 0xC1B2A3948576E5D3, 0xE7A95D3C1B2F4687))
EXACT, BACK, ON = (np.uint64(x) for x in (0x8F14E45FCEEA167A, 0xA87FF679A2F3E71D, 0xE4DA3B7FBBCE2345))


class Templates:
    """Tokens of texts: `literal` hashes of their lower case, `typed` ones with placeholders, the text of
    each (`cuts`), and whether a token is typed (`slot`)."""

    def __init__(self, texts):
        kind, lower, units = _tables()
        codes = chars.Codes(texts)
        kinds = kind[codes.points]
        start, end = chars.runs(kinds > 0)
        self.literal = chars.segment_hashes(lower[codes.points], start, end)
        self.cuts = np.searchsorted(start, np.concatenate([[0], codes.ends]))
        number = kinds[start] & 2 != 0
        # a capital makes a name unless the word opens a sentence
        opens = np.zeros(len(start), dtype=bool)
        opens[self.cuts[:-1][self.cuts[:-1] < len(start)]] = True
        stops = np.concatenate([[0], np.cumsum(np.isin(codes.points, STOPS))])
        opens[1:] |= stops[start[1:]] > stops[end[:-1]]
        name = (kinds[start] & 4 != 0) & ~opens & ~number
        unit = np.zeros(len(start), dtype=bool)
        unit[1:] = number[:-1] & ~number[1:]
        unit &= np.isin(self.literal, units) & ~opens
        self.typed = self.literal.copy()
        self.typed[number], self.typed[name], self.typed[unit] = NUMBER, NAME, UNIT
        # a copy without capitals has no names: windows are also taken with names as they are
        self.plain = np.where(name, self.literal, self.typed)
        self.slot, self.plain_slot = number | name | unit, number | unit

    def windows(self, settings):
        """(window hash, first token, slots of the text's tokens) of every window within one text.

        A window of too few literal tokens, as within a list of numbers, says little as a template. It
        is taken by its literal values (no slots), and as a template together with the tokens back to
        the nearest enough literal ones, and on to the next ones.
        """
        n, least = settings.window, settings.literal
        size = len(self.literal) - n + 1
        if size <= 0:
            return
        first = np.repeat(self.cuts[:-1], np.diff(self.cuts))[:size]
        last = np.repeat(self.cuts[1:], np.diff(self.cuts))[:size]
        inside = np.arange(size) + n <= last
        differs = np.concatenate([[0], np.cumsum(self.slot != self.plain_slot)])
        for tokens, slot, named in ((self.typed, self.slot, True), (self.plain, self.plain_slot, False)):
            upto = np.concatenate([[0], np.cumsum(~slot)])
            literal = upto[n:] - upto[:-n]
            # with names as they are: only where names make a difference
            at = np.flatnonzero(inside & (literal >= least) & (named | (differs[n:] > differs[:-n])))
            yield self._hash(tokens, at, n), at, slot
            few = np.flatnonzero(inside & (literal < least))
            if named:
                yield chars.mix(self._hash(self.literal, few, n).view(np.uint64) ^ EXACT).view(np.int64), few, np.zeros_like(slot)
            places = np.flatnonzero(~slot)
            k = upto[few + n] - least
            at, start = few[k >= 0], places[k[k >= 0]]
            far = (start >= first[at]) & (named | (differs[at + n] > differs[start]))
            at, start = at[far], start[far]
            yield chars.mix(chars.segment_hashes(tokens, start, at + n) ^ BACK).view(np.int64), at, slot
            k = upto[few] + least - 1
            at, end = few[k < len(places)], places[k[k < len(places)]] + 1
            far = (end <= last[at]) & (named | (differs[end] > differs[at]))
            at, end = at[far], end[far]
            yield chars.mix(chars.segment_hashes(tokens, at, end) ^ ON).view(np.int64), at, slot

    def _hash(self, tokens, at, n):
        factors = chars.mix(np.arange(11, 11 + n, dtype=np.uint64)) | np.uint64(1)
        return chars.mix((tokens[at[:, None] + np.arange(n)] * factors).sum(axis=1, dtype=np.uint64)).view(np.int64)

    def owner(self, at):
        return np.searchsorted(self.cuts, at, side="right") - 1

    def values(self, at, slot, n):
        """Hashes of the literal tokens of each window in its slots, 0 elsewhere."""
        where = at[:, None] + np.arange(n)
        return np.where(slot[where], self.literal[where], np.uint64(0)).view(np.int64)


STOPS = np.array([ord(c) for c in ".!?:;\n\r\"“”«»()[]¿¡•|"], dtype=np.uint32)


def _found(rows: DataFrame, key: str, settings: Settings, keep=None) -> DataFrame:
    """(key, window, place, tokens, slots) of the windows of each text: all, or those that may be in the
    bitmap `keep`. `place` counts tokens, `tokens` is the number in the text. Places of different texts
    among those that `keep` is for lie far apart, as an id may have several."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chars.chunks(texts):
                t = Templates(texts[a:b])
                far = np.zeros(b - a, dtype=np.int64)
                if keep is not None:
                    far[:] = [zlib.crc32(x.encode("utf-8", "surrogatepass")) >> 2 << 32 for x in texts[a:b]]
                for window, at, slot in t.windows(settings):
                    if keep is not None:
                        may = bits.member(keep.value, window)
                        window, at = window[may], at[may]
                    owner = t.owner(at)
                    slots = t.values(at, slot, settings.window)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(owner + a)), pa.array(window), pa.array(at - t.cuts[owner] + far[owner]),
                            pa.array(np.diff(t.cuts)[owner]),
                            pa.ListArray.from_arrays(np.arange(0, slots.size + 1, settings.window, dtype=np.int32), slots.ravel()),
                        ],
                        names=[key, "window", "place", "tokens", "slots"],
                    )

    return rows.select(key, "text").mapInArrow(run, f"{key} {kind}, window long, place long, tokens long, slots array<long>")


class Hits:
    """Windows that a document and an item have in common. Each has the item's and the document's slots
    (`theirs`, `ours`), and its places in the item and in the document."""

    def __init__(self, hits, tokens, window):
        self.tokens, self.window = tokens, window
        theirs, ours = (np.array([h[k] for h in hits], dtype=np.int64) for k in ("item_slots", "slots"))
        self.q, self.p = ([np.array(h[k], dtype=np.int64) for h in hits] for k in ("item_places", "places"))
        typed = theirs != 0
        names, at = np.unique(theirs[typed], return_inverse=True)
        self.x = np.full(theirs.shape, -1)
        self.x[typed] = at
        self.n = len(names)
        self.y = np.unique(ours, return_inverse=True)[1].reshape(ours.shape)  # in the order of the values
        self.typed = typed.any(axis=1)

    def covered(self, which):
        """Tokens of the item in these windows."""
        steps = np.zeros(self.tokens + 1, dtype=np.int64)
        if len(which):
            q = np.concatenate([self.q[r] for r in which])
            np.add.at(steps, q, 1)
            np.add.at(steps, q + self.window, -1)
        return int(np.count_nonzero(np.cumsum(steps)))

    def agree(self, meaning, rows=slice(None)):
        """Windows without a slot that stands for something else."""
        x, y = self.x[rows], self.y[rows]
        known = meaning[x]
        return ((x < 0) | (known < 0) | (known == y)).all(axis=1)

    def common(self, rows, times):
        """For each x its most frequent y, the smallest of several."""
        x, y = self.x[rows], self.y[rows]
        pairs, at = np.unique(np.stack([x[x >= 0], y[x >= 0]]), axis=1, return_inverse=True)
        count = np.bincount(at.ravel(), weights=np.broadcast_to(times[:, None], x.shape)[x >= 0])
        order = np.lexsort((pairs[1], -count, pairs[0]))
        first = order[np.unique(pairs[0][order], return_index=True)[1]]
        return pairs[0][first], pairs[1][first], count[first]

    def whole(self):
        """What values stand for in most windows of the document."""
        meaning = np.full(self.n, -1)
        rows = np.flatnonzero(self.typed)
        x, y, _ = self.common(rows, np.array([len(self.q[r]) for r in rows]))
        meaning[x] = y
        return meaning

    def occurrences(self):
        """What values stand for in each run of windows that lie as far from each other as in the item, those
        of most windows first; where tokens were put in or left out, in the nearest other windows too."""
        rows = np.flatnonzero(self.typed)
        shifts = [(self.p[r][:, None] - self.q[r]).ravel() for r in rows]
        row, shift = np.repeat(rows, [len(s) for s in shifts]), np.concatenate(shifts)
        order = np.argsort(shift, kind="stable")
        row, shift = row[order], shift[order]
        start = np.flatnonzero(np.diff(shift, prepend=shift[0] - 1))
        end = np.append(start[1:], len(shift))
        for k in np.argsort(start - end, kind="stable"):
            meaning = np.full(self.n, -1)
            own = row[start[k] : end[k]]
            while True:  # the most frequent value first, then those that go with it
                own = own[self.agree(meaning, own) & ((self.x[own] >= 0) & (meaning[self.x[own]] < 0)).any(axis=1)]
                if not len(own):
                    break
                x, y, count = self.common(own, np.ones(len(own)))
                open_ = meaning[x] < 0
                best = np.flatnonzero(open_)[count[open_].argmax()]
                meaning[x[best]] = y[best]
            near = slice(*np.searchsorted(shift, [shift[start[k]] - self.tokens, shift[start[k]] + self.tokens + 1]))
            others = row[near][np.argsort(np.abs(shift[near] - shift[start[k]]), kind="stable")]
            while (meaning < 0).any():
                others = others[self.agree(meaning, others) & ((self.x[others] >= 0) & (meaning[self.x[others]] < 0)).any(axis=1)]
                if not len(others):
                    break
                x, y = self.x[others[0]], self.y[others[0]]
                meaning[x[x >= 0]] = y[x >= 0]
            yield meaning

    def best(self, least):
        """The most tokens of the item in windows that agree with each other; 0 if below `least`."""
        every = self.covered(range(len(self.q)))
        if every < least or not self.typed.any():
            return every if every >= least else 0
        whole = self.whole()
        found = self.covered(np.flatnonzero(self.agree(whole)))
        seen = set()
        if found < every:
            for meaning in self.occurrences():
                meaning = np.where(meaning < 0, whole, meaning)
                if meaning.tobytes() not in seen:
                    seen.add(meaning.tobytes())
                    found = max(found, self.covered(np.flatnonzero(self.agree(meaning))))
                    if found == every:
                        break
        return found


def required(items: DataFrame, settings: Settings) -> DataFrame:
    """item_id, tokens, window: the windows of which a document that holds enough of an item has at least one. An item's other
    windows, those that most items share, cover less than `coverage` of its tokens."""
    shared = items.select("item_id", "window").distinct().groupBy("window").agg(F.count(F.lit(1)).alias("df"))
    listed = items.join(shared, "window").groupBy("item_id", "tokens").agg(
        F.sort_array(F.collect_list(F.struct("df", "window", "place")), asc=False).alias("w")
    )

    def run(batches):
        for batch in batches:
            rows, windows = [], []
            for i, (n, w) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                common, known, covered = set(), np.zeros(n + settings.window, dtype=bool), 0
                for x in w:
                    covered += settings.window - int(known[x["place"] : x["place"] + settings.window].sum())
                    if covered >= settings.coverage * n:
                        common.discard(x["window"])  # not all of its places fit
                        break
                    known[x["place"] : x["place"] + settings.window] = True
                    common.add(x["window"])
                rare = {x["window"] for x in w} - common
                rows += [i] * len(rare)
                windows += sorted(rare)
            at = pa.array(rows, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(windows, type=pa.int64())], names=["item_id", "tokens", "window"]
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return listed.mapInArrow(run, f"item_id {kind}, tokens long, window long")


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, covered, tokens, coverage for each document that has at least `coverage` of the
    tokens of a benchmark item in common windows.

    Empty and NULL texts, and items of fewer tokens than a window, match nothing; rows without an id
    are left out. Repeated rows of an id are judged as one, by the windows of all of them.

    A document may hold an item more than once, with other values each time. Coverage is the best over
    what the values stand for in each occurrence, and in most windows of the document; windows
    anywhere in it count if they agree with that.

    A bitmap of fixed size holds the benchmark's windows, so of all windows of the documents only
    those that may be the benchmark's leave their task; a hash join with the windows decides. Documents and items first meet
    by the items' required windows alone, so an opening that many items share pairs nothing by itself.
    """
    items = _found(benchmark.filter("item_id IS NOT NULL"), "item_id", settings).checkpoint()
    keep = docs.sparkSession.sparkContext.broadcast(bits.bitmap(items.select("window")))
    found = _found(docs.filter("doc_id IS NOT NULL"), "doc_id", settings, keep)
    found = found.groupBy("doc_id", "window", "slots").agg(F.collect_set("place").alias("places")).checkpoint()
    pairs = found.select("doc_id", "window").join(required(items, settings), "window").select("doc_id", "item_id", "tokens").distinct()
    theirs = items.withColumnRenamed("slots", "item_slots").groupBy("item_id", "tokens", "window", "item_slots").agg(
        F.collect_set("place").alias("item_places")
    )
    wanted = pairs.join(theirs, ["item_id", "tokens"])
    hits = wanted.join(found, ["doc_id", "window"]).groupBy("doc_id", "item_id", "tokens").agg(
        F.collect_list(F.struct("item_slots", "slots", "item_places", "places")).alias("hits")
    )

    def run(batches):
        for batch in batches:
            covered = [
                Hits(h, n, settings.window).best(settings.coverage * n)
                for h, n in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(covered, type=pa.int64()), batch.column(2)],
                names=["doc_id", "item_id", "covered", "tokens"],
            )

    kinds = [hits.schema[k].dataType.simpleString() for k in ("doc_id", "item_id")]
    covered = hits.mapInArrow(run, "doc_id {}, item_id {}, covered long, tokens long".format(*kinds))
    share = F.col("covered") / F.col("tokens")
    return covered.select("doc_id", "item_id", "covered", "tokens", share.alias("coverage")).filter(
        (F.col("covered") > 0) & (F.col("coverage") >= settings.coverage)
    )


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no benchmark item. Rows without an id stay."""
    name = chars.free_name(docs, "_flagged")
    flagged = matches(docs, benchmark, settings).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(flagged, docs["doc_id"] == F.col(name), "left_anti")
