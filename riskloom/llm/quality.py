"""Quality rules: base counts, and divergence of a text from its language.

Each language of the table has two reference histograms, summed over all its documents: code points
by character class, and words (lower-cased letter runs) over the language's ``COMMON`` most frequent
words and all others.  A document's two histograms are compared with them by Jensen-Shannon
distance (square root of the divergence in bits).  Short texts scatter, so the character rule needs
``CHAR_WORDS`` words, the word rule ``WORD_WORDS``, and the word limit falls with the root of the
length: ``WORD_LIMIT + WORD_NOISE / sqrt(words)``.

The common words are exact and do not depend on how the rows are spread.  A first map counts words by
hash bucket and language; a second counts each word of a language's ``HEAVY`` fullest buckets.  A word elsewhere
occurs at most as often as its bucket, so a language is done when its next bucket holds fewer words than its
``COMMON``-th word; for any other, a third map counts the words of every bucket that reaches that number, and no word outside
can be common.  A last map counts per document.  References are summed from the checkpointed counts and hold a
row per language.

Defined results: equal counts are ordered by word hash; extra columns, whatever their names, play no part; a very
long text is counted alone in its task; null or blank text has zero counts and fails the base rules; a null language is a
language of its own; a language with fewer than ``REFERENCE_WORDS`` words is compared by characters
with the whole corpus and by words not at all; repeated rows are judged each; an empty table gives
no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import arrowtext as T
from riskloom.llm.state import cut, prepare

COMMON = 30
BUCKETS_LOG2, HEAVY = 14, 64
MOST_HELD = 1 << 20     #: partial counts in a task before it sends them
CHAR_WORDS, CHAR_LIMIT = 30, 0.30
WORD_WORDS, WORD_LIMIT, WORD_NOISE = 50, 0.16, 2.2
REFERENCE_WORDS = 2000
MOST_LANGS = 5000

#: Character classes by byte; continuation bytes of UTF-8 are left out (class 9).
CLASSES = ("lower", "upper", "digit", "blank", "newline", "mark", "symbol", "other", "beyond")
_CLASS = np.full(256, 7, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 5
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 6
_CLASS[128:192], _CLASS[192:] = 9, 8
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[97:123] = _NOT_LETTER[65:91] = _NOT_LETTER[128:] = False
_NOT_LINE = np.zeros(256, bool)
_NOT_LINE[10] = True


def _counter(key_of):
    """A map to (lang, key, n): the counts of the keys that ``key_of(lang, words)`` gives for the words of a language."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: dict = {}
        size = 0

        def sent():
            for lang, parts in held.items():
                key, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)], schema=schema)

        for batch in batches:
            langs = np.array(batch.column(2).to_pylist(), dtype=object)
            for lo, hi, data, offsets in T.chunks(batch.column(1)):
                text = T.lower(data)
                starts, ends, ptr = T.word_spans(text, offsets, _NOT_LETTER)
                words = T.span_hashes(text, starts, ends).view(np.int64)
                own = np.repeat(langs[lo:hi], np.diff(ptr))
                for lang in set(own.tolist()):
                    key, n = np.unique(key_of(lang, words[own == lang]), return_counts=True)
                    if len(key):
                        held.setdefault(lang, []).append((key, n))
                        size += len(key)
                if size > MOST_HELD:
                    yield from sent()
                    held, size = {}, 0
        yield from sent()

    return run


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words.view(np.uint64) >> np.uint64(64 - BUCKETS_LOG2)).view(np.int64)


def _counted(texts: DataFrame, key_of) -> DataFrame:
    return (texts.mapInArrow(_counter(key_of), "lang string, key long, n long")
            .groupBy("lang", "key").agg(F.sum("n").alias("n")))


def _best(df: DataFrame, most: int) -> DataFrame:
    """The ``most`` largest counts of each language, as (lang, key, n, place); partial limits come before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _words_in(texts: DataFrame, buckets: list) -> list:
    """The COMMON most frequent words of each language among those in ``buckets``, rows of (lang, key)."""
    spark, marks = texts.sparkSession, {}
    for r in buckets:
        marks.setdefault(r["lang"], np.zeros(1 << BUCKETS_LOG2, bool))[r["key"]] = True
    shared = spark.sparkContext.broadcast({k: np.packbits(v) for k, v in marks.items()})  # 2 KB a language
    none = np.zeros(0, np.int64)

    def key_of(lang, words):
        mark = shared.value.get(lang)
        return none if mark is None else words[np.unpackbits(mark)[_bucket(words)] > 0]

    return _best(_counted(texts, key_of), COMMON).collect()


def common_words(texts: DataFrame) -> list:
    """(lang, key, n, place) of the COMMON most frequent words of each language with REFERENCE_WORDS words; see the module text."""
    buckets = cut(_counted(texts, lambda lang, words: _bucket(words)))
    langs = (buckets.groupBy("lang").agg(F.sum("n").alias("words")).where(F.col("words") >= REFERENCE_WORDS)
             .limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"quality: more than {MOST_LANGS} languages")
    if not langs:
        return []
    known = F.broadcast(texts.sparkSession.createDataFrame([(r["lang"],) for r in langs], "known string"))  # a row per language
    buckets = buckets.join(known, F.col("lang").eqNullSafe(F.col("known"))).drop("known")
    heavy = _best(buckets, HEAVY + 1).collect()
    found = _words_in(texts, [r for r in heavy if r["place"] <= HEAVY])
    least = {r["lang"]: r["n"] for r in found if r["place"] == COMMON}
    unsure = {r["lang"]: least.get(r["lang"], 1) for r in heavy if r["place"] > HEAVY and r["n"] >= least.get(r["lang"], 1)}
    if unsure:
        table = F.broadcast(texts.sparkSession.createDataFrame(list(unsure.items()), "known string, least long"))  # a row per language
        more = (buckets.join(table, F.col("lang").eqNullSafe(F.col("known"))).where("n >= least")
                .groupBy("lang").agg(F.collect_list("key").alias("keys")))  # at most 2**BUCKETS_LOG2 a language
        some = [{"lang": r["lang"], "key": k} for r in more.toLocalIterator() for k in r["keys"]]
        found = [r for r in found if r["lang"] not in unsure] + _words_in(texts, some)
    return found


class Vocabulary:
    """The common words of all languages as sorted hashes of (language, word), with the place of each."""

    def __init__(self, rows: list):
        self.langs = {lang: i for i, lang in enumerate(sorted({r["lang"] for r in rows}, key=lambda x: (x is None, x or "")))}
        keys = self.keys(np.array([r["key"] for r in rows], np.int64), np.array([self.langs[r["lang"]] for r in rows], np.int64))
        order = np.argsort(keys)
        self.words, self.slots = keys[order], np.array([r["place"] - 1 for r in rows], np.int64)[order]
        self.bits = np.zeros(1 << 16, bool)
        self.bits[np.array([r["key"] for r in rows], np.int64) & 0xFFFF] = True

    @staticmethod
    def keys(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
        return T.mix(words.view(np.uint64) ^ T.mix(langs.astype(np.uint64) + np.uint64(1)))

    def count(self, words: np.ndarray, langs: list, ptr: np.ndarray) -> np.ndarray:
        """Rows of COMMON + 1 counts."""
        rows = len(langs)
        row = np.repeat(np.arange(rows), np.diff(ptr))
        out = np.zeros((rows, COMMON + 1), np.int64)
        out[:, COMMON] = np.diff(ptr)
        at = np.flatnonzero(self.bits[words & 0xFFFF])
        of = np.array([self.langs.get(x, -1) for x in langs], np.int64)
        at = at[of[row[at]] >= 0]
        keys = self.keys(words[at], of[row[at]])
        i = np.minimum(np.searchsorted(self.words, keys), max(0, len(self.words) - 1))
        mine = self.words[i] == keys if len(self.words) else np.zeros(0, bool)
        common = np.bincount(row[at][mine] * (COMMON + 1) + self.slots[i[mine]], minlength=rows * (COMMON + 1)).reshape(rows, -1)
        out += common
        out[:, COMMON] -= common.sum(axis=1)
        return out


def _repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: equal to an earlier (row, key); equal to any other."""
    both = T.mix(key + T.mix(row.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = any_[order[:-1][same]] = True
    return later, any_


def base_counts(data: np.ndarray, offsets: np.ndarray, window: int = 8) -> tuple[np.ndarray, ...]:
    """n_words, n_dup_lines, n_repeat_words and the counts by character class, per row."""
    rows = len(offsets) - 1
    kinds = _CLASS[data]
    chars = np.stack([np.bincount(kinds[a:b], minlength=10)[:9] for a, b in zip(offsets, offsets[1:])])
    starts, ends, ptr = T.word_spans(data, offsets)
    n_words = np.diff(ptr)

    first, last, line_ptr = T.word_spans(data, offsets, _NOT_LINE)
    filled = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    row = np.repeat(np.arange(rows), np.diff(line_ptr))[filled]
    lines = T.span_hashes(data, first[filled], last[filled])
    dup = np.bincount(row[_repeats(lines, row)[0]], minlength=rows)

    words = T.span_hashes(data, starts, ends)
    windows = T.window_hashes(words, window)
    row = np.repeat(np.arange(rows), n_words)
    inside = np.flatnonzero(row[:len(windows)] == row[window - 1:]) if len(windows) else np.zeros(0, np.int64)
    found = inside[_repeats(windows[inside], row[inside])[1]]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)]) if len(words) else np.zeros(1, np.int64)
    return n_words, dup, covered[ptr[1:]] - covered[ptr[:-1]], chars


_ROW = ("doc_id {id}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "chars array<long>, words array<long>")


def _count(shared):
    def run(batches):
        vocabulary = shared.value
        for batch in batches:
            langs = batch.column(2).to_pylist()
            parts = []
            for lo, hi, data, offsets in T.chunks(batch.column(1)):
                n_words, dup, repeat, chars = base_counts(data, offsets)
                text = T.lower(data)
                starts, ends, ptr = T.word_spans(text, offsets, _NOT_LETTER)
                words = vocabulary.count(T.span_hashes(text, starts, ends).view(np.int64), langs[lo:hi], ptr)
                parts.append((n_words, chars.sum(axis=1) - chars[:, 3] - chars[:, 4], chars[:, 6], dup, repeat, chars, words))
            if not parts:
                continue
            *flat, chars, words = (np.concatenate(x) for x in zip(*parts))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().astype(np.int64)))
                     for x in (chars, words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(x.astype(np.int64)) for x in flat), *lists],
                names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "words"])

    return run


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance of histograms; 0 where a histogram is empty."""
    full = (p.sum(axis=1) > 0) & (q.sum(axis=1) > 0)
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = q / np.maximum(q.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = [np.where(x > 0, x * np.log2(x / m), 0).sum(axis=1) for x in (p, q)]
    return np.where(full, np.sqrt(np.maximum(0, (part[0] + part[1]) / 2)), 0.0)


def _judge(shared):
    def run(batches):
        chars_of, words_of = shared.value
        for batch in batches:
            langs, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            if not len(langs):
                continue
            chars = batch.column(7).flatten().to_numpy().reshape(len(langs), -1)
            words = batch.column(8).flatten().to_numpy().reshape(len(langs), -1)
            whole = chars_of["whole corpus"]
            by_char = js_distance(chars, np.stack([chars_of.get((x,), whole) for x in langs]))
            by_word = js_distance(words, np.stack([words_of.get((x,), np.zeros(COMMON + 1)) for x in langs]))
            by_char, by_word = np.where(n >= CHAR_WORDS, by_char, 0.0), np.where(n >= WORD_WORDS, by_word, 0.0)
            base = (n < 20) | (100 * batch.column(6).to_numpy() > 30 * n)
            kept = ~base & (by_char <= CHAR_LIMIT) & (by_word <= WORD_LIMIT + WORD_NOISE / np.sqrt(np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:7], pa.array(base), pa.array(kept), pa.array(by_char), pa.array(by_word)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       "char_distance", "word_distance"])

    return run


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, distances and verdict of every row; see the module text."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    kind = dict(texts.dtypes)["doc_id"]
    counted = cut(texts.mapInArrow(_count(spark.sparkContext.broadcast(Vocabulary(common_words(texts)))), _ROW.format(id=kind)))
    sums = counted.groupBy("lang").agg(*[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES))],
                                       *[F.sum(F.col("words")[i]).alias(f"w{i}") for i in range(COMMON + 1)])
    chars_of, words_of, whole = {}, {}, np.zeros(len(CLASSES))
    for r in sums.collect():
        c = np.array([r[f"c{i}"] for i in range(len(CLASSES))], float)
        w = np.array([r[f"w{i}"] for i in range(COMMON + 1)], float)
        whole += c
        if w.sum() >= REFERENCE_WORDS:
            chars_of[(r["lang"],)], words_of[(r["lang"],)] = c, w
    chars_of["whole corpus"] = whole
    return counted.mapInArrow(
        _judge(spark.sparkContext.broadcast((chars_of, words_of))),
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, char_distance double, word_distance double")
