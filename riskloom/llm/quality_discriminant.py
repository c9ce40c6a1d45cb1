"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One map turns every whole text into ``len(STATISTICS)`` numbers: lengths and rates of character classes, words,
repeated words and repeated lines, each by a logarithm or a root so that a class of documents is near a normal
distribution.  The two classes have their own mean and covariance.  A class covariance is shrunk twice,
``(1 - b) * ((1 - a) * S_class + a * S_pooled) + b * mean variance * I`` (Friedman 1989), over statistics that are
first scaled to unit pooled variance.  Of the grid ``POOLED`` x ``ROUND`` the pair with the least log loss wins, each
training row judged by a model without its fold (``FOLDS`` folds by a hash of the id).

The score is the logistic of ``log prior ratio + log density of class 1 - log density of class 0``.  A log density is
``-(Mahalanobis distance + log det) / 2``; both come from a Cholesky factor that is computed once and broadcast, the
distance by forward substitution.

Counts, sums and sums of products are added up in Spark over all labelled rows: no sample is drawn, the driver gets
``2 * FOLDS * (1 + d + d * d)`` sums.  Texts are read once; their statistics are checkpointed (some 200 bytes a row).

Defined results: null, empty and blank texts have zero counts and score like any other; a very long text is one row
of one task; without training rows of both classes every score is the share of class 1 (0.5 without rows); null or
other labels are not learned from; a null id is scored, never learned from; repeated rows score, and teach, each;
repeated equal labels of an id count once, contradicting ones teach both; ties of the grid go to the stronger
shrinkage; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import arrowtext as T
from riskloom.llm.quality import base_counts
from riskloom.llm.state import cut, prepare
from riskloom.llm.toxicity import remainder

STATISTICS = ("words", "word_length", "upper", "digit", "newline", "mark", "symbol", "other", "beyond", "repeated_lines",
              "repeated_words", "distinct_words", "top_word", "short_words", "long_words", "unlettered_ends")
POOLED = (0.5, 0.25, 0.1, 0.0)
ROUND = (0.1, 0.03, 0.01, 0.001)
FOLDS = 4
SHORT, LONG = 3, 15     #: bytes of a short word at most, of a long word at least
PRIOR_WORDS = 5.0       #: a rate counts as if so many more words without the trait had been read

_ENDS_WORD = np.zeros(256, bool)
_ENDS_WORD[48:58] = _ENDS_WORD[65:91] = _ENDS_WORD[97:123] = _ENDS_WORD[128:] = True
_ENDS_WORD[[ord(c) for c in ".,;:"]] = True


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each text of an Arrow buffer."""
    rows = len(offsets) - 1
    n_words, dup_lines, repeat_words, chars = base_counts(data, offsets)
    text = T.lower(data)
    starts, ends, ptr = T.word_spans(text, offsets)
    row, length = np.repeat(np.arange(rows), n_words), ends - starts
    words = T.span_hashes(text, starts, ends)
    own = T.mix(words + T.mix(row.astype(np.uint64)))
    _, first, place, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    distinct = np.bincount(row[first], minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, row, times[place].astype(float))
    lines = np.bincount(np.repeat(np.arange(rows), np.diff(offsets))[data == 10], minlength=rows) + 1
    size, n = chars.sum(axis=1), n_words + PRIOR_WORDS

    def count(mask):
        return np.bincount(row[mask], minlength=rows)

    def per_word(x):
        return np.sqrt(x / n)

    return np.stack([
        np.log1p(n_words), np.log((size + 1) / (n_words + 1)),
        per_word(chars[:, 1]), per_word(chars[:, 2]), per_word(chars[:, 4]), per_word(chars[:, 5]), per_word(chars[:, 6]),
        per_word(chars[:, 7]), per_word(chars[:, 8]), np.sqrt(dup_lines / (lines + 1)), per_word(repeat_words),
        np.log((distinct + 1) / (n_words + 1)), per_word(most), per_word(count(length <= SHORT)), per_word(count(length >= LONG)),
        per_word(count(~_ENDS_WORD[text[ends - 1]]) if len(ends) else np.zeros(rows))], axis=1)


def _map_statistics(batches):
    for batch in batches:
        parts = [statistics(data, offsets) for _, _, data, offsets in T.chunks(batch.column(1))]
        x = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(x)], names=["id", "x"])


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _moments(batches):
    """Per task and (label, fold): count, sums and sums of products, one row for each place of that vector."""
    size = 1 + len(STATISTICS)
    total = np.zeros((2, FOLDS, size, size))
    for batch in batches:
        label, fold, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
        x = np.column_stack([np.ones(len(x)), x])
        for c in (0, 1):
            for f in range(FOLDS):
                part = x[(label == c) & (fold == f)]
                total[c, f] += part.T @ part
    place = np.arange(size * size)
    for c in (0, 1):
        for f in range(FOLDS):
            if total[c, f, 0, 0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), c, np.int32)), pa.array(np.full(len(place), f, np.int32)), pa.array(place.astype(np.int32)),
                     pa.array(total[c, f].ravel())], names=["label", "fold", "place", "value"])


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, their log determinants and the log prior ratio."""

    scale: np.ndarray
    means: list
    factors: list
    log_dets: list
    prior: float

    def distance(self, x: np.ndarray, c: int) -> np.ndarray:
        """Squared Mahalanobis distances of rows from the mean of class c, by forward substitution."""
        left, factor = (x / self.scale - self.means[c]).T, self.factors[c]
        solved = np.zeros_like(left)
        for j in range(len(left)):
            solved[j] = (left[j] - factor[j, :j] @ solved[:j]) / factor[j, j]
        return (solved ** 2).sum(axis=0)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior)
        density = [-(self.distance(x, c) + self.log_dets[c]) / 2 for c in (0, 1)]
        return self.prior + density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def discriminant(moments: np.ndarray, pooled: float, round_: float) -> Discriminant:
    """From (class, 1 + d, 1 + d) sums of products of (1, statistics)."""
    n = moments[:, 0, 0]
    if not n.all():
        share = (n[1] + 0.5) / (n.sum() + 1) if not n.any() else n[1] / n.sum()
        return Discriminant(np.ones(1), [], [], [], 700.0 * (2 * share - 1) if n.any() else 0.0)
    means = [m[0, 1:] / m[0, 0] for m in moments]
    scatter = [m[1:, 1:] - k * np.outer(mu, mu) for m, mu, k in zip(moments, means, n)]
    shared = sum(scatter) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(shared), 1e-9))
    grid = np.outer(scale, scale)
    shared, means = shared / grid, [mu / scale for mu in means]
    factors = []
    for s, k in zip(scatter, n):
        cov = (1 - pooled) * s / k / grid + pooled * shared
        cov = (1 - round_) * cov + max(round_, 1e-6) * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        factors.append(np.linalg.cholesky(cov))
    return Discriminant(scale, means, factors, [2 * np.log(np.diag(f)).sum() for f in factors], math.log(n[1] / n[0]))


def _losses(shared):
    """Per task: summed log loss of the training rows for each pair of the grid, by the models without their fold."""
    def run(batches):
        models = shared.value
        total = np.zeros(len(models))
        for batch in batches:
            label, fold, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            sign = np.where(label == 1, 1.0, -1.0)
            for g, folds in enumerate(models):
                for f, model in enumerate(folds):
                    own = fold == f
                    if own.any():
                        total[g] += np.logaddexp(0, -sign[own] * model.log_odds(x[own])).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["pair", "loss"])

    return run


def train(known: DataFrame) -> tuple[Discriminant, dict]:
    """The model of ``known(label, fold, x)`` and the chosen shrinkage."""
    d = 1 + len(STATISTICS)
    sums = (known.mapInArrow(_moments, "label int, fold int, place int, value double").groupBy("label", "fold", "place")
            .agg(F.sum("value").alias("value")).collect())
    table = np.zeros((2, FOLDS, d * d))
    for r in sums:
        table[r["label"], r["fold"], r["place"]] = r["value"]
    table = table.reshape(2, FOLDS, d, d)
    whole = table.sum(axis=1)
    if not whole[:, 0, 0].all():
        return discriminant(whole, 0, 0), {}
    pairs = [(a, b) for a in POOLED for b in ROUND]
    models = [[discriminant(whole - table[:, f], a, b) for f in range(FOLDS)] for a, b in pairs]
    shared = known.sparkSession.sparkContext.broadcast(models)
    losses = {r["pair"]: r["loss"] for r in known.mapInArrow(_losses(shared), "pair int, loss double").groupBy("pair")
              .agg(F.sum("loss").alias("loss")).collect()}
    best = min(range(len(pairs)), key=lambda i: (round(losses[i], 6), i))
    return discriminant(whole, *pairs[best]), {"pooled": pairs[best][0], "round": pairs[best][1], "loss": losses[best] / whole[:, 0, 0].sum()}


def _score(shared):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(_matrix(batch.column(1))))], names=["id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """(id, score) of every row of ``docs``; labels of rows whose remainder is 1 are never read.  See the module text."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(texts.dtypes)["id"]
    found = cut(texts.mapInArrow(_map_statistics, f"id {kind}, x array<double>"))
    told = (labels.where((remainder(id_col) != 1) & F.col(label_col).isin(0, 1))
            .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct())
    fold = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(FOLDS)).cast("int")
    known = cut(found.join(told, "id").select("label", fold.alias("fold"), "x"))
    model, _ = train(known)
    return found.mapInArrow(_score(spark.sparkContext.broadcast(model)), f"id {kind}, score double").withColumnRenamed("id", id_col)
