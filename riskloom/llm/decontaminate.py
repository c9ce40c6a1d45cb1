"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Distance: word edit distance between a benchmark item and the best fitting run of document words
(Unicode lower-cased).  An item of n words allows ``n * (100 - percent) // 100`` edits.

Method (CGK: Chakraborty, Goldenberg, Koucky 2016).  A walk reads a window: at step j it writes the
current word and moves on if a random bit of (j, word) is 1, so close windows mostly write equal
words.  A repetition samples three steps as its key; windows that share a key with an item are
candidates.  Steps are sampled from the first 2 * f, f being the item's length class (8, 10, 12,
15, ... words), so that keys cover item-sized windows.  The number of repetitions is chosen on
edited copies of the items, so that ``target`` of those with all allowed edits are found, at random places and evenly
spread; unedited passages always are.  A candidate is verified exactly by the fitting edit distance.

Before the walk, a count filter drops windows that cannot be within the edit limit: with e edits at
least ``n - 2 - 3 e`` of an item's 3-word grams stay, whatever the item.  It loses nothing.

The work is one map over the documents without a shuffle.  The items go to the tasks in blocks of
``block`` items (a bound, not a cap: there are as many passes as blocks).

Defined results: items without words or with null text match nothing; a null item id is reported as null; ids keep
their types; equal items (id and text) count once; null or blank documents match nothing; a repeated document
row gives its rows again; several places of one item in a document give the best one, the earliest among equals; a very
long text is searched alone in its task; extra columns, whatever their names, play no part; empty tables give no
rows.  Where ``MOST_KEYS`` repetitions miss ``target`` on the edited copies, an error is raised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm import arrowtext as T
from riskloom.llm.state import map_rows, prepare

SAMPLED = 3      #: steps in a key
MOST_KEYS = 256  #: repetitions at most
GRAM = 3
_FOUND = "doc_id {doc}, item_id {item}, distance int, item_words int, first_word int, last_word int"


def allowed(n, percent: int):
    return n * (100 - percent) // 100


def _floors(smallest: int, largest: int) -> list[int]:
    out = [smallest]
    while out[-1] * 5 // 4 <= largest:
        out.append(out[-1] * 5 // 4)
    return out


def fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, start, end) of the run of ``text`` that fits ``item`` best."""
    one, m = np.int64(1 << 32), len(text)
    place = np.arange(m + 1, dtype=np.int64)
    row = place.copy()  # cost << 32 | start
    for i, word in enumerate(item, 1):
        step = np.empty(m + 1, np.int64)
        step[0] = i * one
        np.minimum(row[:-1] + (text != word) * one, row[1:] + one, out=step[1:])
        row = np.minimum.accumulate(step - place * one) + place * one
    cost = row >> 32
    end = int(np.argmin(cost))
    return int(cost[end]), int(row[end] & (one - 1)), end


class Index:
    """Keys of a block of items; made on the driver, sent to the tasks."""

    def __init__(self, ids: list, words: list[np.ndarray], percent: int, min_words: int, target: float):
        order = sorted(range(len(ids)), key=lambda i: len(words[i]) < min_words)  # the searched with edits, then the short
        ids, words = [ids[i] for i in order], [words[i] for i in order]
        long = sum(len(w) >= min_words for w in words)
        self.ids, self.percent, self.all_sizes = ids, percent, [len(w) for w in words]
        self.short = {}  # length: (sorted hashes of the runs, their items)
        for n in sorted(set(self.all_sizes[long:])):
            items = np.array([i for i in range(long, len(words)) if len(words[i]) == n])
            runs = np.array([T.window_hashes(words[i], n)[0] for i in items], np.uint64)
            self.short[n] = (np.sort(runs), items[np.argsort(runs, kind="stable")])
        self.words = words = words[:long]
        if not words:
            return
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.floors = np.array(_floors(min_words, int(self.sizes.max())))
        self.of = np.searchsorted(self.floors, self.sizes, side="right") - 1
        rng = np.random.RandomState(20)
        self.steps = int(2 * self.floors[-1])
        self.coins = rng.randint(0, 1 << 62, (MOST_KEYS, self.steps), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.sampled = [[np.sort(rng.choice(2 * f, SAMPLED, replace=False)) for f in self.floors] for _ in range(MOST_KEYS)]
        self.repeats = MOST_KEYS
        self.repeats = self._enough(target)
        text, starts = self._joined(words)
        own = [np.stack(k) for k in self.keys(text, starts)]
        flat = np.concatenate([k[self.of, np.arange(len(words))] for k in own])
        order = np.argsort(flat, kind="stable")
        self.key, self.item = flat[order], np.tile(np.arange(len(words)), self.repeats)[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.key & np.uint64((1 << 20) - 1)] = True
        grams = [T.window_hashes(w, GRAM) for w in words]
        self.grams = np.unique(np.concatenate(grams))
        self.gram_bits = np.zeros(1 << 20, bool)
        self.gram_bits[self.grams & np.uint64((1 << 20) - 1)] = True

    @staticmethod
    def _joined(words) -> tuple[np.ndarray, np.ndarray]:
        size = max(len(w) for w in words)
        text = np.concatenate([np.concatenate([w, np.zeros(2 * size, np.uint64)]) for w in words])
        starts = np.cumsum([0] + [len(w) + 2 * size for w in words[:-1]])
        return text, starts

    def keys(self, text: np.ndarray, starts: np.ndarray):
        """For each repetition, the keys of the windows at ``starts`` in every length class."""
        last = len(text) - 1
        for r in range(self.repeats):
            at = starts.copy()
            took = {}
            for g, steps in enumerate(self.sampled[r]):
                for s in steps:
                    took.setdefault(int(s), []).append(g)
            keys = [np.full(len(starts), np.uint64(r * 64 + g + 1)) for g in range(len(self.floors))]
            for j in range(max(took) + 1):
                word = text[at]
                for g in took.get(j, ()):
                    keys[g] = T.mix(keys[g] ^ word) + np.uint64(j)
                at = np.minimum(at + ((word * self.coins[r, j]) >> np.uint64(63)).astype(np.int64), last)
            yield keys

    def _enough(self, target: float) -> int:
        """Repetitions that find ``target`` of the copies with all allowed edits, of each of two kinds: edits of any sort
        at random places, and changed words spread evenly, which leave the shortest runs."""
        rng = np.random.RandomState(21)

        def other():
            return np.uint64(rng.randint(1, 1 << 62, dtype=np.int64))

        some = range(0, len(self.words), max(1, len(self.words) // 200))
        clean, edited, group, spread = [], [], [], []
        for i in some:
            word = self.words[i]
            edits = int(allowed(len(word), self.percent))
            for even in (False, False, True, True):
                copy = list(word)
                for k in range(edits):
                    kind, p = rng.randint(3), rng.randint(len(copy))
                    if even:
                        copy[(2 * k + 1) * len(copy) // (2 * edits)] = other()
                    elif kind == 0:
                        copy[p] = other()
                    elif kind == 1:
                        copy.insert(p, other())
                    elif len(copy) > 1:
                        del copy[p]
                clean.append(word)
                edited.append(np.array(copy + [other() for _ in range(len(copy) + edits)], np.uint64))  # a document goes on
                group.append(self.of[i])
                spread.append(even)
        group, spread, column = np.array(group), np.array(spread), np.arange(len(group))
        found = np.zeros(len(group), bool)
        for r, (x, y) in enumerate(zip(self.keys(*self._joined(clean)), self.keys(*self._joined(edited))), 1):
            found |= np.stack(x)[group, column] == np.stack(y)[group, column]
            if min(found[spread].mean(), found[~spread].mean()) >= target:
                return r
        raise ValueError(f"decontamination: {found.mean():.3f} of the edited copies found by {MOST_KEYS} repetitions, "
                         f"{target} wanted; allow fewer edits or lower the target")

    def short_hits(self, words: np.ndarray, ptr: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, first word, last word) of the first place of each short item in each row."""
        out = []
        for n, (runs, items) in self.short.items():
            grams = T.window_hashes(words, n)
            a, b = np.searchsorted(runs, grams, "left"), np.searchsorted(runs, grams, "right")
            at = np.flatnonzero(b > a)
            row = np.searchsorted(ptr, at, side="right") - 1
            inside = at + n <= ptr[row + 1]
            at, row = at[inside], row[inside]
            many = b[at] - a[at]
            item = items[np.repeat(a[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            both, place = np.unique(np.repeat(row, many) * len(self.ids) + item, return_index=True)
            first = np.repeat(at - ptr[row], many)[place]
            out += [(*divmod(x, len(self.ids)), f, f + n - 1) for x, f in zip(both.tolist(), first.tolist())]
        return out

    def regions(self, words: np.ndarray, ptr: np.ndarray) -> list[tuple[int, int]]:
        """Runs of words, each inside one document, that pass the count filter for some item size."""
        if not self.words:
            return []
        if (self.sizes - GRAM + 1 - GRAM * allowed(self.sizes, self.percent)).min() < 1:
            return [(int(a), int(b)) for a, b in zip(ptr, ptr[1:]) if b > a]
        grams = T.window_hashes(words, GRAM)
        hit = self.gram_bits[grams & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(hit)
        at = at[np.isin(grams[at], self.grams)]
        row = np.searchsorted(ptr, at, side="right") - 1
        inside = at + GRAM <= ptr[row + 1]
        at, row = at[inside], row[inside]
        if not len(at):
            return []
        good, reach = np.zeros(len(at), bool), np.zeros(len(at), np.int64)
        for n in np.unique(self.sizes):
            edits = int(allowed(n, self.percent))
            need, span = int(n) - GRAM + 1 - GRAM * edits, int(n) + edits
            ok = np.ones(len(at), bool)
            if need > 1:  # the need-th hit from here on lies within the span
                far = np.full(len(at), np.iinfo(np.int64).max)
                far[:max(0, len(at) - need + 1)] = at[need - 1:]
                ok = far <= at + span - GRAM
            good |= ok
            reach[ok] = span
        at, row, reach = at[good], row[good], reach[good]
        out: list[tuple[int, int]] = []
        for p, d, w in zip(at.tolist(), row.tolist(), reach.tolist()):
            a, b = max(int(ptr[d]), p - w), min(int(ptr[d + 1]), p + w)
            if out and a <= out[-1][1] and out[-1][0] >= ptr[d]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def candidates(self, texts: list[np.ndarray]) -> list[tuple[int, int]]:
        """(region, item) pairs with a common key."""
        size = int(self.floors[-1]) * 2
        text = np.concatenate([np.concatenate([t, np.zeros(size, np.uint64)]) for t in texts])
        lengths = np.array([len(t) for t in texts])
        base = np.concatenate([[0], np.cumsum(lengths + size)[:-1]])
        region = np.repeat(np.arange(len(texts)), lengths)
        starts = np.arange(len(region)) + np.repeat(base - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        found = []
        for keys in self.keys(text, starts):
            for key in keys:
                at = np.flatnonzero(self.bits[key & np.uint64((1 << 20) - 1)])
                a = np.searchsorted(self.key, key[at], "left")
                b = np.searchsorted(self.key, key[at], "right")
                many = b - a
                if many.any():
                    owner = np.repeat(region[at], many)
                    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    found.append(np.unique(owner * len(self.words) + self.item[np.repeat(a, many) + offset]))
        if not found:
            return []
        return [divmod(int(x), len(self.words)) for x in np.unique(np.concatenate(found))]


def _words(text: str) -> np.ndarray:
    if not text:
        return np.zeros(0, np.uint64)
    _, _, data, offsets = next(T.chunks(pc.utf8_lower(pa.array([text]))))
    starts, ends, _ = T.word_spans(data, offsets)
    return T.span_hashes(data, starts, ends)


def _regions(index: Index, column: pa.Array, number: int) -> tuple[list, dict]:
    """(row number, first word, words) of the runs to search, each in one document; places of the short items."""
    out, short = [], {}
    for lo, _, text, offsets in T.chunks(pc.utf8_lower(column)):
        starts, ends, ptr = T.word_spans(text, offsets)
        words = T.span_hashes(text, starts, ends)
        for a, b in index.regions(words, ptr):
            d = int(np.searchsorted(ptr, a, side="right")) - 1
            out.append((number + lo + d, int(a - ptr[d]), words[a:b].copy()))
        short |= {(number + lo + row, i): (0, a, b) for row, i, a, b in index.short_hits(words, ptr)}
    return out, short


def _best(index: Index, regions: list) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(distance, first word, last word) of the best place, by row number and item."""
    best: dict = {}
    for r, i in index.candidates([words for *_, words in regions]) if regions else ():
        row, first, words = regions[r]
        distance, a, b = fit(index.words[i], words)
        if distance <= allowed(len(index.words[i]), index.percent):
            now = (distance, first + a, first + b - 1)
            best[row, i] = min(best.get((row, i), now), now)
    return best


def _search(shared, item_type: pa.DataType):
    def rows(index, found, ids, doc_type) -> pa.RecordBatch:
        table = [(ids[row], index.ids[i], x, index.all_sizes[i], a, b) for (row, i), (x, a, b) in found.items()]
        types = [doc_type, item_type, *[pa.int32()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table), types)],
                                          names=["doc_id", "item_id", "distance", "item_words", "first_word", "last_word"])

    def run(batches):
        index, regions, ids, number, kind = shared.value, [], {}, 0, None
        for batch in batches:
            kind = batch.column(0).type
            new, short = _regions(index, batch.column(1), number)
            for row in {row for row, *_ in new} | {row for row, _ in short}:
                ids[row] = batch.column(0)[row - number].as_py()
            if short:
                yield rows(index, short, ids, kind)
            regions += new
            number += batch.num_rows
            if sum(len(words) for *_, words in regions) > 200_000:
                if found := _best(index, regions):
                    yield rows(index, found, ids, kind)
                regions, ids = [], {}
        if found := _best(index, regions):
            yield rows(index, found, ids, kind)

    return run


def _keep(shared, at: int):
    def run(batches):
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            regions, short = _regions(shared.value, batch.column(at).cast(pa.string()), 0)
            for row, _ in [*_best(shared.value, regions), *short]:
                clean[row] = False
            yield batch.filter(pa.array(clean))

    return run


def _indexes(benchmark: DataFrame, item_col: str, item_text_col: str, percent: int, min_words: int, shortest: int, target: float, block: int):
    """Broadcast indexes of the items, block by block; one block is on the driver at a time."""
    items = benchmark.select(F.col(item_col), F.col(item_text_col).cast("string")).dropDuplicates()
    ids, words = [], []
    for item_id, text in items.toLocalIterator():
        w = _words(text or "")
        if len(w) >= max(1, shortest):
            ids.append(item_id)
            words.append(w)
        if len(ids) == block:
            yield benchmark.sparkSession.sparkContext.broadcast(Index(ids, words, percent, min_words, target))
            ids, words = [], []
    if ids:
        yield benchmark.sparkSession.sparkContext.broadcast(Index(ids, words, percent, min_words, target))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", percent: int = 80, min_words: int = 8,
                 target: float = 0.9, block: int = 20_000) -> DataFrame:
    """(doc_id, item_id, distance, item_words, first_word, last_word) of every match; see the module text."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item_field = benchmark.select(F.col(item_col).alias("item_id")).schema[0].dataType
    schema = _FOUND.format(doc=texts.schema[0].dataType.simpleString(), item=item_field.simpleString())
    out = None
    for index in _indexes(benchmark, item_col, item_text_col, percent, min_words, 1, target, block):
        found = texts.mapInArrow(_search(index, to_arrow_type(item_field)), schema)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", percent: int = 80, min_words: int = 8, target: float = 0.9,
                         block: int = 20_000, shortest: int | None = None) -> DataFrame:
    """The rows of ``docs`` in which no item of ``shortest`` words or more is found, in the map that searches them."""
    prepare(docs.sparkSession)
    least = min_words if shortest is None else shortest
    for index in _indexes(benchmark, item_col, item_text_col, percent, min_words, least, target, block):
        docs = map_rows(docs, _keep(index, docs.columns.index(text_col)))
    return docs
