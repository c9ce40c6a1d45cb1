"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the 4-, 5- and 6-byte grams of the text (lower-cased, blanks as spaces), hashed to 2**20
slots.  A slot's rate in a text is ``1000 * count / (bytes + PRIOR)``; the prior keeps one hit in a short
text from weighing as much as many in a long one.  From the rates of the training rows come the ratio
r = log(P(slot | toxic) / P(slot | not)), smoothed by one row at the mean rate, and a logistic regression
with L2 penalty on the values r * rate (Wang and Manning 2012).  It uses all slots whose mean rates differ by
at least ``MIN_Z`` standard errors, and in any case the ``LEAST`` most telling (equal ones by slot number).

Training rows are a bounded sample: of each class the ``sample`` rows with the smallest hash of the
id, one per text.  Counting is a Spark aggregation; the fit is on the driver, on at most 2 * ``sample``
rows of slot numbers, with rows weighted back to the class sizes.  Scoring is one map over all whole
texts without a shuffle.

Defined results: null or blank text scores as the intercept alone; without training rows of both
classes every score is the share of toxic rows (0 without rows); null labels are not learned from; a
null id is scored, never learned from; repeated rows score each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import arrowtext as T
from riskloom.llm.state import cut, map_rows, prepare, smallest_hashes

SIZES = (4, 5, 6)
SLOTS_LOG2 = 20
MIN_Z, LEAST = 4.0, 64
PRIOR = 600
CHUNK_BYTES = 1 << 18  #: each byte begins three grams of a few 8-byte numbers
PENALTY = 1e-3
SAMPLE = 4096


@dataclass
class Model:
    slots: np.ndarray    # sorted
    weights: np.ndarray  # of a present slot: coefficient times log-count ratio
    intercept: float

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums + self.intercept, -50, 50)))


_BLANK = np.arange(256, dtype=np.uint64)
_BLANK[[9, 10, 11, 12, 13]] = 32


def _rates(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, rate) of the slots in each row, by row; only slots marked in ``wanted``, if given.

    The text is read in slices that overlap by a gram, so one very long text needs no more memory.
    """
    found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(data), CHUNK_BYTES):
        text = _BLANK[data[a:a + CHUNK_BYTES + max(SIZES) - 1]]
        code, both = text.copy(), []
        for n in range(2, max(SIZES) + 1):
            if len(text) < n:
                break
            code = code[:-1] | (text[n - 1:] << np.uint64(8 * (n - 1)))
            if n not in SIZES:
                continue
            slot = ((code[:CHUNK_BYTES] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS_LOG2)).view(np.int64)
            at = np.flatnonzero(wanted[slot]) if wanted is not None else np.arange(len(slot))
            row = np.searchsorted(offsets, at + a, side="right") - 1
            inside = at + a + n <= offsets[row + 1]
            both.append((row[inside] << SLOTS_LOG2) | slot[at[inside]])
        if both:
            one, times = np.unique(np.concatenate(both), return_counts=True)
            found.append(one)
            counts.append(times)
    both, place = np.unique(np.concatenate(found), return_inverse=True)
    times = np.bincount(place, np.concatenate(counts), len(both))
    row = both >> SLOTS_LOG2
    return row, both & ((1 << SLOTS_LOG2) - 1), 1000.0 * times / (np.diff(offsets)[row] + PRIOR)


def _texts(column: pa.Array):
    return T.chunks(pc.utf8_lower(column), CHUNK_BYTES)


def _sums(batches):
    """Per task: number of rows (slot -1), sums and square sums of the rates of each slot, by class."""
    table, total = np.zeros((4, 1 << SLOTS_LOG2)), np.zeros(2)
    for batch in batches:
        label = batch.column(1).to_numpy()
        total += np.bincount(label, minlength=2)
        for lo, _, data, offsets in _texts(batch.column(0)):
            rows, slots, rates = _rates(data, offsets)
            for c in (0, 1):
                own = label[lo + rows] == c
                table[c] += np.bincount(slots[own], rates[own], 1 << SLOTS_LOG2)
                table[2 + c] += np.bincount(slots[own], rates[own] ** 2, 1 << SLOTS_LOG2)
    slot = np.flatnonzero(table.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([[-1], slot])), *(pa.array(np.concatenate([total[i:i + 1] if i < 2 else [0.0], table[i, slot]])) for i in range(4))],
        names=["slot", "s0", "s1", "q0", "q1"])


def _vectors(slots: np.ndarray):
    def run(batches):
        wanted = np.zeros(1 << SLOTS_LOG2, bool)
        wanted[slots] = True
        for batch in batches:
            at, values = [], []
            for _, _, data, offsets in _texts(batch.column(0)):
                rows, slot, rates = _rates(data, offsets, wanted)
                ends = np.searchsorted(rows, np.arange(1, len(offsets)))[:-1]
                at += np.split(np.searchsorted(slots, slot).astype(np.int32), ends)
                values += np.split(rates.astype(np.float32), ends)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                                             names=["label", "at", "rates"])

    return run


def _fit(rows: list, ratio: np.ndarray, weight: dict[int, float], penalty: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on ratio * rate by accelerated gradient steps."""
    y = np.array([r["label"] for r in rows], float)
    w = np.array([weight[r["label"]] for r in rows])
    w /= w.sum()
    at = np.concatenate([np.array(r["at"], np.int64) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    x = np.concatenate([np.array(r["rates"], float) for r in rows]) * ratio[at]
    n, m = len(rows), len(ratio)
    top, lead = np.ones(m + 1), 1.0
    for _ in range(30):  # power steps for the curvature's bound
        z = w * (np.bincount(row, x * top[at], n) + top[m])
        top = np.append(np.bincount(at, x * z[row], m), z.sum())
        lead = np.linalg.norm(top)
        top /= max(lead, 1e-12)
    step = 1 / (0.25 * 1.1 * lead + penalty)
    beta, ahead = np.zeros(m + 1), np.zeros(m + 1)
    beta[m] = ahead[m] = math.log((w @ y) / (1 - w @ y))
    for k in range(steps):
        z = np.bincount(row, x * ahead[at], n) + ahead[m]
        error = w * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        slope = np.append(np.bincount(at, x * error[row], m) + penalty * ahead[:m], error.sum())
        new = ahead - step * slope
        ahead, beta = new + k / (k + 3) * (new - beta), new
    return beta[:m], float(beta[m])


def remainder(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Fit on rows of ``labels`` whose remainder is not 1; see the module text."""
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.where((remainder(id_col) != 1) & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct())
    size = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not size.get(0) or not size.get(1):
        share = size.get(1, 0) / max(1, sum(size.values()))
        return Model(np.zeros(0, np.int64), np.zeros(0), 50.0 * (2 * share - 1))
    some = [smallest_hashes(known.where(F.col("label") == c), F.xxhash64("id"), ["id"], size[c], sample) for c in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # at most 2 * sample rows of 12 bytes
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
               .join(chosen, "id").where("text is not null").dropDuplicates(["text", "label"]).select("text", "label"))
    table = cut(rows.mapInArrow(_sums, "slot long, s0 double, s1 double, q0 double, q1 double").groupBy("slot")
                .agg(*[F.sum(c).alias(c) for c in ("s0", "s1", "q0", "q1")]))
    total = table.where("slot = -1").first()
    n0, n1 = (total["s0"], total["s1"]) if total else (0.0, 0.0)
    if not n0 or not n1:
        return Model(np.zeros(0, np.int64), np.zeros(0), math.log((size[1] + 1) / (size[0] + 1)))
    both = n0 + n1
    mean, spread = f"(s0 + s1) / {both}", f"((q0 + q1) / {both} - pow((s0 + s1) / {both}, 2))"  # of all rows: a class may be small
    told = (table.where("slot >= 0")
            .withColumn("z", F.expr(f"round(abs(s1 / {n1} - s0 / {n0}) / sqrt(greatest({spread} * {1 / n0 + 1 / n1}, 1e-12)), 6)"))
            .withColumn("ratio", F.expr(f"ln((s1 + {mean}) / {n1 + 1}) - ln((s0 + {mean}) / {n0 + 1})"))
            .select("slot", "z", "ratio"))
    told = sorted({(r["slot"], r["ratio"]) for part in (told.where(F.col("z") >= MIN_Z), told.orderBy(F.desc("z"), "slot").limit(LEAST))
                   for r in part.collect()})  # at most 2**SLOTS_LOG2
    if not told:
        return Model(np.zeros(0, np.int64), np.zeros(0), math.log((size[1] + 1) / (size[0] + 1)))
    slots, ratio = np.array([x[0] for x in told], np.int64), np.array([x[1] for x in told])
    vectors = rows.mapInArrow(_vectors(slots), "label int, at array<int>, rates array<float>").collect()  # at most 2 * sample rows
    vectors.sort(key=lambda r: (r["label"], r["at"], r["rates"]))
    beta, b0 = _fit(vectors, ratio, {0: size[0] / n0, 1: size[1] / n1}, PENALTY)
    return Model(slots, beta * ratio, b0)


def _score(shared):
    def run(batches):
        model = shared.value
        wanted = np.zeros(1 << SLOTS_LOG2, bool)
        wanted[model.slots] = True
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, data, offsets in _texts(batch.column(1)):
                rows, slots, rates = _rates(data, offsets, wanted)
                parts.append(np.bincount(rows, model.weights[np.searchsorted(model.slots, slots)] * rates, len(offsets) - 1)
                             if len(rows) else np.zeros(len(offsets) - 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(np.concatenate(parts)))], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             sample: int = SAMPLE, model: Model | None = None) -> DataFrame:
    """(id, score) of every row of ``docs``; see the module text."""
    spark = docs.sparkSession
    prepare(spark)
    model = model or train(docs, labels, id_col, text_col, label_col, sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    return (texts.mapInArrow(_score(spark.sparkContext.broadcast(model)), f"doc_id {kind}, score double")
            .withColumnRenamed("doc_id", id_col))


def _clean(shared, at: int, limit: float):
    def run(batches):
        for batch in batches:
            one = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(at).cast(pa.string())], names=["id", "text"])
            for scored in _score(shared)([one]):
                yield batch.filter(pa.array(scored.column(1).to_numpy() < limit))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.7, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, in the map that scores them."""
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, text_col=text_col, **options))
    return map_rows(docs, _clean(model, docs.columns.index(text_col), limit))
