"""N-gram Jaccard self-join by T-occurrence search with DivideSkip, as Spark jobs.

A document is the set of its distinct k-word shingles (64-bit hashes, A-Z lower-cased); the
inverted list of a shingle holds the documents with it.  Two documents link when
``100 * intersection >= percent * union``.

Method.  DivideSkip splits the lists of a record into L long ones, set aside, and short ones,
merged; a candidate needs T - L occurrences in the short lists and is then probed in the long
ones.  Here:

1. Documents with equal sets are one class.  A bounded counter table over all shingles gives
   every list a length rank (any total order keeps the search exact; a good one keeps it cheap).
2. A class of n shingles can only link at T = ceil(percent * n / 100) or more occurrences.  Its
   T - need longest lists are set aside, the others are posted; any linked pair then meets in at
   least ``need`` posted lists, ``need = 1 + n // 20`` (smaller of both).  A class with fewer posted
   lists that hold another class than its smallest possible partner needs is left out.
3. Posted lists are merged by a sort-merge shuffle.  Each posting meets the head of its list
   (linear); pairs with enough occurrences are verified, which joins most of each large group.
4. Lists that now hold one component are done.  In the others, of the s lists of a class all but its
   shortest s - need + 1 can be set aside again: a linked pair meets in one of those of its smaller
   class.  In lists of up to ``SHORT`` classes these pairs are candidates and verified; in longer ones
   the sets themselves meet in blocks of bounded bytes, occurrences are counted over the block's
   inverted lists, and one link per component found is kept.
5. Verifying probes one sorted set in the other by binary search.  Nothing is capped; pairs inside
   one component need no further test.

Defined results: null or blank text has no shingles, links with nothing and is its own
component; equal texts (and repeated rows) share a component; a null id never is a component's
name unless all ids of it are null; an empty table gives an empty result; other columns, of any
name, are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from riskloom.llm import arrowtext as T
from riskloom.llm.graph import components
from riskloom.llm.state import bitmap, cut, in_bitmap, map_rows, prepare, unused

SKETCH_LOG2 = 21    #: counters of the list-length table: 2**21 at every input size
SKETCH_BLOCK = 1 << 14
SHORT = 64          #: classes of a list whose pairs are candidates one by one
LIST_BLOCK, BLOCK_HASHES = 4096, 1 << 21  #: classes and shingles of a longer list in one block


def _need(n):
    return 1 + n // 20


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _scan(k: int):
    """One row per document (n, class digest) and, per task, the blocks of its counter table."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()),
                        ("part", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen, part = np.zeros(1 << SKETCH_LOG2, np.uint32), set(), TaskContext.get().partitionId()
        for batch in batches:
            n, cls = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            for lo, hi, data, offsets in T.chunks(batch.column(1)):
                fresh = []
                for i, s in enumerate(T.shingle_sets(data, offsets, k), lo):
                    n[i] = len(s)
                    if len(s):
                        cls[i] = digest = T.set_digest(s)
                        if digest not in seen:
                            seen.add(digest)
                            fresh.append(s)
                if fresh:
                    slots = np.concatenate(fresh) & np.uint64((1 << SKETCH_LOG2) - 1)
                    slot, times = np.unique(slots, return_counts=True)
                    table[slot.view(np.int64)] += times.astype(np.uint32)
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(cls.view(np.int64), mask=n == 0), none, none,
                 pa.nulls(batch.num_rows, pa.binary())], schema=schema)
        if table.any():
            parts = table.reshape(-1, SKETCH_BLOCK)
            m, nothing = len(parts), pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nothing, nothing, nothing, pa.array([part] * m, pa.int32()), pa.array(range(m), pa.int32()),
                 pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())], schema=schema)

    return run


def _add_tables(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64) for x in pdf["counts"])
    total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})


def _length_ranks(scan: DataFrame) -> np.ndarray:
    """One byte per counter: 0 for lists of usual length, growing with the log of the length."""
    tables = scan.where("block is not null").select("part", "block", "counts")
    top = tables.agg(F.max("part")).first()[0]
    salts = 1 + math.isqrt(top or 0)
    for key in (F.pmod("part", F.lit(salts)), F.lit(0)):
        tables = (tables.withColumn("part", key).groupBy("block", "part")
                  .applyInPandas(lambda pdf: _add_tables(pdf).assign(part=0), "block int, counts binary, part int"))
    total = np.zeros((1 << SKETCH_LOG2) // SKETCH_BLOCK * SKETCH_BLOCK, np.float64).reshape(-1, SKETCH_BLOCK)
    for row in tables.select("block", "counts").collect():  # 128 rows at any input size
        total[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    total = total.ravel()
    usual = total.mean() + 3 * math.sqrt(total.mean()) + 4
    return np.where(total > usual, 1 + np.minimum(254, 4 * np.log2(np.maximum(total / usual, 1))), 0).astype(np.uint8)


def _postings(k: int, percent: int, ranks) -> callable:
    """(shingle, class, n) for the shortest lists of every class."""
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])
    mask = np.uint64((1 << SKETCH_LOG2) - 1)

    def run(batches):
        seen, table = set(), ranks.value
        for batch in batches:
            for _, _, data, offsets in T.chunks(batch.column(1)):
                out, sizes, keys = [], [], []
                for s in T.shingle_sets(data, offsets, k):
                    if not len(s) or (digest := T.set_digest(s)) in seen:
                        continue
                    seen.add(digest)
                    n = len(s)
                    posted = n + _need(n) - -(-n * percent // 100)
                    order = np.argsort(table[s & mask], kind="stable")[:posted]
                    out.append(s[order])
                    sizes.append(n)
                    keys.append(digest)
                if out:
                    times = [len(x) for x in out]
                    yield pa.RecordBatch.from_arrays(
                        [_i64(np.concatenate(out)), _i64(np.repeat(np.array(sizes, np.int64), times)),
                         _i64(np.repeat(np.array(keys, np.uint64), times))], schema=schema)

    return run


def _shared(batches):
    """Of rows sorted by (shingle, n, cls): one row per shingle and class, lists of one class dropped."""
    held, joined = None, False  # the last row so far, and whether its list has an earlier row
    schema = None
    for batch in batches:
        schema = batch.schema
        if not batch.num_rows:
            continue
        cols = [np.asarray(c) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate([[h], c]) for h, c in zip(held, cols)]
        x, n, c = cols
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(new)
        x, n, c = x[at], n[at], c[at]
        same = x[1:] == x[:-1]
        before, after = np.concatenate([[joined], same]), np.concatenate([same, [False]])
        keep = before | after
        held, joined = (x[-1], n[-1], c[-1]), bool(before[-1])
        keep[-1] = False  # it waits for the next batch
        yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (x, n, c)], schema=schema)
    if held is not None and joined:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([h])) for h in held], schema=schema)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("need", pa.int64())])
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _pairs(a, b, na, nb) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(_need(np.minimum(na, nb)))], schema=_PAIR)


def _with_heads(percent: int):
    """Each posting with the head of its list, that is the smallest class whose size may link with it."""
    def run(batches):
        head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n, c = (np.asarray(v) for v in batch.columns)
            if head is not None:
                x, n, c = (np.concatenate([[h], v]) for h, v in zip(head, (x, n, c)))
            start = np.ones(len(x), bool)
            start[1:] = x[1:] != x[:-1]
            index = np.arange(len(x))
            while True:
                top = np.maximum.accumulate(np.where(start, index, 0))
                far = percent * n > 100 * n[top]
                if not far.any():
                    break
                first = far.copy()
                first[1:] &= ~(far[:-1] & (top[1:] == top[:-1]))
                start |= first
            tail = np.flatnonzero(~start)
            yield _pairs(c[tail], c[top[tail]], n[tail], n[top[tail]])
            head = tuple(v[top[-1]] for v in (x, n, c))

    return run


def _by_piece(keys: int, work):
    """Calls ``work(columns)`` on each run of rows that agree in the first ``keys`` columns; rows come sorted by them."""
    def run(batches):
        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(v) for v in zip(held, cols)]
            if not len(cols[0]):
                continue
            edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:keys]], axis=0)) + 1
            for a, b in zip([0, *edge[:-1]], edge):
                if (out := work([v[a:b] for v in cols])) is not None:
                    yield out
            held = [v[edge[-1] if len(edge) else 0:] for v in cols]
        if held is not None and (out := work(held)) is not None:
            yield out

    return run


def _short_pairs(percent: int):
    """Candidates in one list: classes of different components, in a list that the smaller one needs."""
    def work(cols):
        _, c, n, comp, chosen = cols
        i, j = np.triu_indices(len(c), 1)
        smaller = np.where((n[i] < n[j]) | ((n[i] == n[j]) & (c[i] < c[j])), i, j)
        ok = (comp[i] != comp[j]) & (percent * np.maximum(n[i], n[j]) <= 100 * np.minimum(n[i], n[j])) & chosen[smaller]
        i, j = i[ok], j[ok]
        return _pairs(c[i], c[j], n[i], n[j]) if len(i) else None

    return _by_piece(1, work)


def _long_links(percent: int):
    """Links in one block (shingle, lo, hi) of a list, by counting occurrences over the block's inverted lists."""
    def work(cols):
        _, lo, hi, at, c, n, comp, chosen, hashes = cols
        if (comp == comp[0]).all():
            return None
        sets = [np.frombuffer(h, np.uint64) for h in hashes]
        own = np.repeat(np.arange(len(sets)), n)
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(column, kind="stable")
        member, start = own[order], np.concatenate([[0], np.cumsum(np.bincount(column))])
        first = np.concatenate([[0], np.cumsum(n)])
        us, vs = [], []
        label = np.unique(comp, return_inverse=True)[1]  # of what is joined, here as well
        for i in np.flatnonzero(chosen):
            lists = column[first[i]:first[i + 1]]
            met = np.concatenate([member[start[x]:start[x + 1]] for x in lists])
            both = np.bincount(met, minlength=len(sets))
            ok = (100 * both >= percent * (n[i] + n - both)) & (label != label[i])
            ok &= (n[i] < n) | ((n[i] == n) & (c[i] < c))
            if lo[0] != hi[0]:
                ok &= at != at[i]
            if ok.any():
                to = np.flatnonzero(ok)
                others, one = np.unique(label[to], return_index=True)
                us += [c[i]] * len(one)
                vs += c[to[one]].tolist()
                label[np.isin(label, others)] = label[i]
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=_EDGE) if us else None

    return _by_piece(3, work)


def _sets_of(k: int, wanted):
    schema = pa.schema([("cls", pa.int64()), ("hashes", pa.binary())])

    def run(batches):
        seen, words = set(), wanted.value
        for batch in batches:
            for _, _, data, offsets in T.chunks(batch.column(1)):
                keys, sets = [], []
                for s in T.shingle_sets(data, offsets, k):
                    if not len(s) or (digest := T.set_digest(s)) in seen:
                        continue
                    if in_bitmap(words, np.array([digest]))[0]:
                        seen.add(digest)
                        keys.append(digest)
                        sets.append(s.tobytes())
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [_i64(np.array(keys, np.uint64)), pa.array(sets, pa.binary())], schema=schema)

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)  # the binary probe
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], schema=_EDGE)

    return run


def _linked(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the candidates (a, b) whose sets link, as (u, v)."""
    return (candidates.select("a", "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b")
            .select("a", "b", "ha", "hb").mapInArrow(_verify(percent), "u long, v long"))


def _joined(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls) of every row, and (cls, comp) of the classes that link with others."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scan = cut(texts.mapInArrow(_scan(k), "doc_id long, n long, cls long, part int, block int, counts binary"))
    rows = scan.where("block is null").select("doc_id", "n", "cls")
    ranks = spark.sparkContext.broadcast(_length_ranks(scan))

    lists = cut(texts.mapInArrow(_postings(k, percent, ranks), "shingle long, n long, cls long")
                .repartition("shingle").sortWithinPartitions("shingle", "n", "cls")
                .mapInArrow(_shared, "shingle long, n long, cls long"))
    own = Window.partitionBy("cls")  # the posted lists of one document
    need, least = 1 + F.floor(F.col("n") / 20), 1 + F.floor(F.col("n") * percent / 2000)  # least: with a smaller partner
    lists = cut(lists.join(lists.groupBy("shingle").agg(F.count("*").alias("m")), "shingle")
                .withColumn("s", F.count("*").over(own)).where(F.col("s") >= least)
                .withColumn("chosen", F.row_number().over(own.orderBy("m", "shingle")) <= F.col("s") - need + 1)
                .select("shingle", "n", "cls", "chosen").repartition("shingle").sortWithinPartitions("shingle", "n", "cls"))
    wanted = spark.sparkContext.broadcast(bitmap(lists, F.col("cls")))
    sets = cut(texts.mapInArrow(_sets_of(k, wanted), "cls long, hashes binary")
               .groupBy("cls").agg(F.first("hashes").alias("hashes")))

    heads = cut(lists.select("shingle", "n", "cls").mapInArrow(_with_heads(percent), "a long, b long, need long")
                .groupBy("a", "b").agg(F.count("*").alias("met"), F.first("need").alias("need"))
                .where("2 * met >= need").select("a", "b"))
    edges = cut(_linked(heads, sets, percent))
    joined = cut(components(edges).select(F.col("node").alias("cls"), F.col("root").alias("comp")))

    marked = lists.join(joined, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    mixed = (marked.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m"),
                                           F.sum("n").alias("hashes"), F.max("chosen").alias("any"))
             .where("x < y and any")
             .select("shingle", "m", F.greatest(F.ceil(F.col("m") / LIST_BLOCK), F.ceil(F.col("hashes") / BLOCK_HASHES))
                     .cast("long").alias("blocks")))
    open_lists = cut(marked.join(mixed, "shingle"))
    short = (open_lists.where(F.col("m") <= SHORT).select("shingle", "cls", "n", "comp", "chosen")
             .repartition("shingle").sortWithinPartitions("shingle")
             .mapInArrow(_short_pairs(percent), "a long, b long, need long").select("a", "b").distinct()
             .join(heads, ["a", "b"], "left_anti"))
    blocks = (open_lists.where(F.col("m") > SHORT).withColumn("at", F.pmod(F.xxhash64("cls"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("shingle", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi"), "at",
                      "cls", "n", "comp", "chosen").join(sets, "cls")
              .select("shingle", "lo", "hi", "at", "cls", "n", "comp", "chosen", "hashes")
              .repartition("shingle", "lo", "hi").sortWithinPartitions("shingle", "lo", "hi"))
    more = cut(_linked(short, sets, percent).union(blocks.mapInArrow(_long_links(percent), "u long, v long")))
    if more.limit(1).count():
        joined = components(edges.union(more)).select(F.col("node").alias("cls"), F.col("root").alias("comp"))

    return rows, joined


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_equal) for every row of ``docs``; see the module text.

    ``component_id`` is the smallest id reachable by links; ``n_equal`` counts the rows of
    ``docs`` with the same shingle set (null without shingles).
    """
    rows, joined = _joined(docs, id_col, text_col, k, percent)
    classes = (rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_equal"))
               .join(joined, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
    names = classes.groupBy("comp").agg(F.min("low").alias("component_id"))
    classes = classes.join(names, "comp").select("cls", "component_id", "n_equal")
    return (rows.where("cls is not null").join(classes, "cls")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_equal")
            .union(rows.where("cls is null").select("doc_id", F.lit(0).cast("long"), F.col("doc_id"), F.lit(None).cast("long"))))


def _with_class(k: int, at: int, wanted):
    """Appends the class digest to every row whose class is in the bitmap, null to the others."""
    def run(batches):
        for batch in batches:
            sets = (s for _, _, data, offsets in T.chunks(batch.column(at).cast(pa.string())) for s in T.shingle_sets(data, offsets, k))
            cls = [T.set_digest(s) if len(s) else None for s in sets]
            keys = np.array([c or 0 for c in cls], np.uint64)
            none = np.array([c is None for c in cls], bool) | ~in_bitmap(wanted.value, keys)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64), mask=none)], names=[*batch.schema.names, "cls"])

    return run


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                      percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, the one with the smallest id (null last; then by class digest).

    Rows without shingles are components of their own and stay, all of them.  The only row of a class that links with
    no other stays as well, so a bitmap of the other classes keeps most texts out of the shuffle.
    """
    rows, joined = _joined(docs, id_col, text_col, k, percent)
    classes = cut(rows.where("cls is not null").groupBy("cls")
                  .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("low"), F.count("*").alias("times"))
                  .join(joined, "cls", "left"))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(classes.where("times > 1 or comp is not null"), F.col("cls")))
    stays = (classes.groupBy(F.coalesce("comp", "cls").alias("comp")).agg(F.min(F.struct("low.none", "low.doc_id", "cls")).alias("x"))
             .select(F.col("x.doc_id").alias("_doc"), F.col("x.cls").alias("_cls")))
    own, ident = unused(docs, "cls"), F.col(id_col).cast("long")
    marked = map_rows(docs, _with_class(k, docs.columns.index(text_col), wanted), (StructField(own, LongType()),))
    stays = stays.withColumnsRenamed({"_doc": unused(docs, "_doc"), "_cls": unused(docs, "_cls")})
    kept = (marked.where(F.col(own).isNotNull()).dropDuplicates([id_col, own])
            .join(stays, (F.col(own) == stays[stays.columns[1]]) & ident.eqNullSafe(stays[stays.columns[0]]), "left_semi"))
    return kept.union(marked.where(F.col(own).isNull())).drop(own)
