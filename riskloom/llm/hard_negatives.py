"""Hard-negative mining by slot-decomposed selection.

A row is (id, label, vector).  Components become ``floor(scale * x)`` and a score is the integer inner product with an
anchor row.  An anchor's positives are its ``positives`` best other rows of the same label.  The negatives of a positive
with score p are the ``negatives`` best rows of other labels with ``low * p <= 100 * score <= high * p``; higher scores
come first, ties by smaller id.

The windows of an anchor's positives overlap.  Their upper limits, in falling order, split the scores into disjoint slots;
a row falls into one slot, and every task keeps the best ``negatives`` rows of each (anchor, slot) only.  Merged over the
tasks, the window of the j-th positive is answered by the slots from j on, in falling order, up to its own lower limit:
a suffix of at most ``positives * negatives`` rows holds the answers of all windows.

Anchors are dealt into blocks of at most ``BLOCK_BYTES`` of integers.  Each block is broadcast and meets all rows in two
passes (positives, then slots), by matrix products of tiles; rows are never shuffled, only the tasks' best rows are.  A
task holds a tile of scores and ``positives * negatives`` rows for each anchor of the block.

Scores are exact: they are computed as doubles below 2**52, and larger vectors (``dim * max|component|**2``) raise an
error instead of a rounded score.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; a shorter
vector counts as padded with zeros, so an empty one scores 0; repeated rows are rows of their own (an anchor's equal copy
may be its positive, the anchor itself never is); rows of equal id and score are interchangeable; an anchor without other
rows of its label, and a positive without a negative in its window, give no rows; a negative positive score has an empty
window; an empty table, or one without anchors, gives no rows.  Ids and labels are integers (cast to long); extra columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.state import cut, prepare

BLOCK_BYTES = 8 << 20   #: of anchors that are broadcast at once
TILE_ROWS, TILE_ANCHORS = 1024, 1024
PENDING = 1 << 18       #: entries that a combiner gathers before it keeps the best
EXACT = 1 << 52


class Best:
    """Combiner: the best ``k`` (score, id) of each group; higher scores first, ties by smaller id."""

    def __init__(self, groups: int, k: int):
        self.k, self.floor = k, np.full(groups, -EXACT, np.int64)  # below a group's floor nothing can enter
        self.parts, self.pending = [], 0

    def add(self, group: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if len(group):
            self.parts.append((group, score, row))
            self.pending += len(group)
            if self.pending >= PENDING:
                self.kept()

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            none = np.zeros(0, np.int64)
            return none, none, none
        group, score, row = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((row, -score, group))
        group, score, row = group[order], score[order], row[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        best = place < self.k
        self.parts, self.pending = [(group[best], score[best], row[best])], 0
        last = place == self.k - 1
        self.floor[group[last]] = score[last]
        return self.parts[0]


def _vectors(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """Rows of integers (as doubles), padded to ``dim``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy().astype(np.float64))
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _pack(dim: int, scale: float):
    """Anchors as blocks: ids, labels and integer vectors in binary."""
    most = max(1, BLOCK_BYTES // (8 * max(dim, 1)))

    def block(ids, labels, rows):
        return pa.RecordBatch.from_arrays([pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (ids, labels, rows)],
                                          names=["ids", "labels", "vectors"])

    def run(batches):
        held: list = []
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), _vectors(batch.column(2), dim, scale)))
            while sum(len(x[0]) for x in held) >= most:
                ids, labels, rows = (np.concatenate(x) for x in zip(*held))
                yield block(ids[:most], labels[:most], rows[:most])
                held = [(ids[most:], labels[most:], rows[most:])]
        if held and sum(len(x[0]) for x in held):
            yield block(*(np.concatenate(x) for x in zip(*held)))

    return run


def _tiles(batches, anchors: np.ndarray, dim: int, scale: float):
    """(first anchor, ids, labels, scores) of anchors x rows, a tile at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, TILE_ROWS):
            part = batch.slice(a, TILE_ROWS)
            ids, labels, rows = part.column(0).to_numpy(), part.column(1).to_numpy(), _vectors(part.column(2), dim, scale).T
            for first in range(0, len(anchors), TILE_ANCHORS):
                yield first, ids, labels, (anchors[first:first + TILE_ANCHORS] @ rows).astype(np.int64)


def _entries(best: Best, columns: int):
    group, score, row = best.kept()
    yield pa.RecordBatch.from_arrays([pa.array((group // columns).astype(np.int32)), pa.array((group % columns).astype(np.int32)),
                                      pa.array(score), pa.array(row)], names=["anchor", "slot", "score", "id"])


def _same_label(shared, dim: int, scale: float, k: int):
    def run(batches):
        _, labels_of, anchors = shared.value
        best = Best(len(anchors), k)
        for first, ids, labels, scores in _tiles(batches, anchors, dim, scale):
            own = slice(first, first + len(scores))
            at, row = np.nonzero((labels_of[own, None] == labels) & (scores >= best.floor[own, None]))
            best.add(at + first, scores[at, row], ids[row])
        yield from _entries(best, 1)

    return run


def _slots(shared, dim: int, scale: float, k: int, low: int, high: int):
    def run(batches):
        labels_of, anchors, limits, lows = shared.value
        n_slots = limits.shape[1]
        best = Best(len(anchors) * n_slots, k)
        for first, ids, labels, scores in _tiles(batches, anchors, dim, scale):
            own = slice(first, first + len(scores))
            inside = (scores <= limits[own, :1]) & (scores >= lows[own, :].min(axis=1)[:, None]) & (labels_of[own, None] != labels)
            at, row = np.nonzero(inside)
            score = scores[at, row]
            at += first
            slot = (limits[at] >= score[:, None]).sum(axis=1) - 1  # falling limits: the last that is not below the score
            group = at * n_slots + slot
            wanted = (score >= lows[at, slot]) & (score >= best.floor[group])
            best.add(group[wanted], score[wanted], ids[row][wanted])
        yield from _entries(best, n_slots)

    return run


def _limits(scores: np.ndarray, counts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest negative score of each positive's window; an empty window is (-EXACT, EXACT)."""
    there = np.arange(scores.shape[1]) < counts[:, None]
    top, bottom = (high * scores) // 100, -((-low * scores) // 100)
    return np.where(there, top, -EXACT), np.where(there, bottom, EXACT)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors; see the module text."""
    if not 0 <= low <= high:
        raise ValueError("hard_negatives: 0 <= low <= high is needed")
    spark = rows.sparkSession
    prepare(spark, rows=8192)
    number = F.col(vector_col).cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    data = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), number.alias("vector"))
    size = rows.agg(F.max(F.size(number)).alias("dim"), F.count_if(is_anchor).alias("anchors"),
                    F.max(F.aggregate(number, F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x * scale) + 1))).alias("top")).first()
    dim, top = size["dim"] or 0, size["top"] or 0.0
    if dim * top * top * max(high, 100) >= EXACT:
        raise ValueError(f"hard_negatives: {dim} components up to {top:.3g} after scaling exceed exact scores")
    chosen = rows.where(is_anchor).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                                          number.alias("vector"))
    blocks = max(1, -(-size["anchors"] * 8 * max(dim, 1) // BLOCK_BYTES))
    packed = cut(chosen.repartition(blocks).mapInArrow(_pack(dim, scale), "ids binary, labels binary, vectors binary"))
    found = []
    for block in packed.toLocalIterator():  # one bounded block at a time
        ids, labels = (np.frombuffer(block[c], np.int64) for c in ("ids", "labels"))
        anchors = np.frombuffer(block["vectors"], np.int64).reshape(len(ids), dim).astype(np.float64)
        found.append(_block(data, ids, labels, anchors, dim, scale, positives, negatives, low, high))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if len(found) > 1:
        found = [cut(x) for x in found]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _best_of(entries: DataFrame, k: int) -> DataFrame:
    """The best k of each (anchor, slot); tasks have sent k rows of each at most."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return entries.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _block(data: DataFrame, ids, labels, anchors, dim, scale, n_positives, n_negatives, low, high) -> DataFrame:
    context = data.sparkSession.sparkContext
    kind = "anchor int, slot int, score long, id long"
    # the anchor itself scores among its own label: one row more, of which one equal to the anchor goes
    shared = context.broadcast((ids, labels, anchors))
    near = _best_of(data.mapInArrow(_same_label(shared, dim, scale, n_positives + 1), kind), n_positives + 1)
    scores, counts = np.zeros((len(ids), n_positives), np.int64), np.zeros(len(ids), np.int64)
    near_ids, left = np.zeros_like(scores), np.ones(len(ids), bool)
    own = (anchors ** 2).sum(axis=1).astype(np.int64)
    for r in sorted(near.collect(), key=lambda r: (r["anchor"], r["place"])):  # positives + 1 rows for each anchor of the block
        a = r["anchor"]
        if left[a] and r["id"] == ids[a] and r["score"] == own[a]:
            left[a] = False
        elif counts[a] < n_positives:
            scores[a, counts[a]], near_ids[a, counts[a]] = r["score"], r["id"]
            counts[a] += 1
    limits, lows = _limits(scores, counts, low, high)
    entries = data.mapInArrow(_slots(context.broadcast((labels, anchors, limits, lows)), dim, scale, n_negatives, low, high), kind)
    slots = _best_of(entries, n_negatives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("fall"), "id", "slot"))).alias("entries"))  # positives * negatives at most
    wanted = context.broadcast((ids, near_ids, scores, counts))

    def windows(batches):
        table = wanted.value
        for batch in batches:
            at = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(table[0][at]), batch.column(1),
                 *(pa.array([table[i][a, :table[3][a]].tolist() for a in at], pa.list_(pa.int64())) for i in (1, 2))],
                names=["anchor", "anchor_id", "entries", "positives", "scores"])

    told = slots.mapInArrow(windows, "anchor int, anchor_id long, entries array<struct<fall:long,id:long,slot:int>>, "
                            "positives array<long>, scores array<long>")
    each = told.select("anchor_id", "entries", F.posexplode(F.arrays_zip("positives", "scores")).alias("at", "positive"))
    suffix = F.filter("entries", lambda x: (x["slot"] >= F.col("at")) & (-x["fall"] * 100 >= low * F.col("positive.scores"))
                      & (-x["fall"] * 100 <= high * F.col("positive.scores")))
    return (each.select("anchor_id", F.col("positive.positives").alias("positive_id"), F.col("positive.scores").alias("positive_score"),
                        F.posexplode(F.slice(suffix, 1, n_negatives)).alias("place", "negative"))
            .select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
                    "positive_score", (-F.col("negative.fall")).alias("negative_score")))
