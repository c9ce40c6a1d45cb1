"""Mixing sources to token targets by entropy balancing.

Among all document rates of at most ``max_rate``, the mix takes those nearest to 1 in relative entropy,
``sum(w * (r log r - r + 1))`` with ``w = size ** spare`` over the documents, that give every source its
target words: ``sum(size * r) = target``.  The dual is convex with one unknown per source, and its solution
tilts each document's rate exponentially by its own length:

    r = min(max_rate, exp(lambda[source] * z)),   z = size ** (1 - spare)

``spare = 0`` is plain entropy balancing, which empties a shortened source of its long documents first; the
default of a half spares them by the root of their length.  Distributed Newton steps solve the dual: each
sums gradient and curvature over all documents (their counts by source and size, which say the same and
hold a row per distinct length), and the driver moves one lambda per source, by the logarithm of the
words and inside a bracket.  Steps end when every source is within ``NEAR`` of its target; lambdas are
then rounded to twelve digits, so that reruns agree whatever the order of sums.

Rates become copies by error diffusion: documents of a source are dealt by hash into blocks of about
``block`` rows (so no source is one task); within a block, from long to short, a document gets the
whole part of its rate, and one copy more whenever the words still owed reach half its size.  A
block ends within about one short document of its share.

Defined results: null or blank text has size 0 and rate 1; the null source is a source; documents of a
source without target words get no copy; a source whose target is all that ``max_rate`` allows has that
rate; a very long text is one document of its size; documents of equal size have equal rates and are
dealt in the order of their hash; repeated rows are documents of their own; other columns, whatever their
names, play no part; an empty table gives no rows.
Sources are few: more than ``MOST_SOURCES`` raise an error, since their table is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.state import cut, prepare, unused

MOST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_shares(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Split ``share * sum(sizes)`` by weight; what is above ``cap * size`` is split again among the rest."""
    left, target = share * sum(sizes), [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    while free:
        unit = left / math.fsum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > cap * sizes[i]]
        if not full:
            for i in free:
                target[i] = weights[i] * unit
            break
        for i in full:
            target[i] = float(cap * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(full)]
    return target


def cyclic_targets(weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> Callable:
    """Targets for sources in code-point order, null last, with ``weights`` repeating."""
    def targets(names: list[str | None], sizes: list[int]) -> list[float]:
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, (names[i] or "").encode()))
        by = capped_shares([sizes[i] for i in order], [weights[k % len(weights)] for k in range(len(order))], share, cap)
        out = [0.0] * len(names)
        for i, t in zip(order, by):
            out[i] = t
        return out
    return targets


NEAR, STEPS = 1e-10, 200


def newton_step(tilt, lo, hi, taken, slope, target):
    """(tilt, lo, hi) after a step on the logarithm of the words; by halving where that leaves the bracket."""
    lo, hi = np.where(taken < target, tilt, lo), np.where(taken > target, tilt, hi)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        new = tilt + np.log(target / taken) * taken / slope
    out = ~((new > lo) & (new < hi))  # also where every document is at its most
    low = np.where(np.isfinite(lo), lo, 2 * hi - np.abs(hi) - 1)
    return np.where(out, (low + hi) / 2, new), lo, hi


def tilts(sized: DataFrame, names: list, targets: list[float], max_rate: float) -> list[float | None]:
    """The lambda of each source: by Newton steps over the rows (source, z, words); None where all are at their most."""
    spark = sized.sparkSession
    target, top, tilt = np.array(targets, float), math.log(max_rate), [None] * len(names)
    by = {r["source"]: r for r in sized.where("words > 0").groupBy("source").agg(
        F.sum("words").alias("words"), F.min("z").alias("z")).collect()}
    open_ = [i for i, n in enumerate(names) if n in by and 0 < target[i] < max_rate * by[n]["words"] * (1 - 1e-12)]
    if not open_:
        return tilt
    at = np.array(open_)
    goal = target[at]
    lo, hi = np.full(len(at), -np.inf), np.array([max(top, 0.0) / by[names[i]]["z"] + 1e-9 for i in open_])
    now = np.minimum(np.zeros(len(at)), hi)
    rows = sized.where("words > 0")
    raw = F.col("tilt") * F.col("z")
    for _ in range(STEPS):
        table = spark.createDataFrame([(k, names[i], float(t)) for k, (i, t) in enumerate(zip(open_, now))],
                                      "k int, name string, tilt double")
        taken = F.col("words") * F.exp(F.least(raw, F.lit(top)))
        sums = (rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")))  # a row per source
                .groupBy("k").agg(F.sum(taken).alias("taken"), F.sum(F.when(raw < top, taken * F.col("z")).otherwise(0.0)).alias("slope"))
                .collect())
        sums.sort(key=lambda r: r["k"])
        words, slope = np.array([r["taken"] for r in sums]), np.array([r["slope"] for r in sums])
        if (np.abs(words - goal) <= NEAR * goal).all():
            break
        done = np.abs(words - goal) <= NEAR * goal
        new, lo, hi = newton_step(now, lo, hi, words, slope, goal)
        now = np.where(done, now, new)
    else:
        raise ArithmeticError(f"mix: no balance after {STEPS} steps")
    for i, t in zip(open_, now):
        tilt[i] = float(f"{t:.12g}")
    return tilt


def _diffuse(max_copies: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "tie"], ascending=[False, True], kind="stable")
        rate = pdf["rate"].to_numpy(float)
        copies = np.floor(rate + 1e-9).astype(np.int64)
        part, owed = np.maximum(0.0, rate - copies), 0.0
        for i, (size, p) in enumerate(zip(pdf["size"].tolist(), part.tolist())):
            owed += p * size
            if size and owed >= size / 2 and copies[i] < max_copies:
                copies[i] += 1
                owed -= size
        pdf["copies"] = copies
        return pdf[["doc_id", "size", "source", "source_size", "target", "rate", "copies"]]

    return run


def mix(docs: DataFrame, targets: Callable = cyclic_targets(), max_rate: float = 2.0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block: int = 2000, spare: float = 0.5) -> DataFrame:
    """(doc_id, size, source, source_size, target, rate, copies) of every row; see the module text.

    ``targets(names, sizes)`` gives the target words of each source; they must be at most ``max_rate`` times its size.
    """
    spark = docs.sparkSession
    prepare(spark)
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col).cast("string")).alias("size"),
                            F.col(source_col).cast("string").alias("source")))
    z = F.pow(F.col("size").cast("double"), F.lit(1.0 - spare))
    lengths = cut(sized.groupBy("source", "size").agg(F.count("*").alias("rows"))
                  .select("source", "rows", z.alias("z"), (F.col("rows") * F.col("size")).alias("words")))
    known = lengths.groupBy("source").agg(F.sum("words").alias("size"), F.sum("rows").alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(known) > MOST_SOURCES:
        raise ValueError(f"mix: more than {MOST_SOURCES} sources")
    names = [r["source"] for r in known]
    wanted = [float(t) for t in targets(names, [r["size"] for r in known])]
    if any(t > max_rate * r["size"] * (1 + 1e-9) for r, t in zip(known, wanted)):
        raise ValueError("mix: a target above max_rate times its source's size")
    table = spark.createDataFrame(
        [(r["source"], r["size"], -(-r["rows"] // block), t, x) for r, t, x in zip(known, wanted, tilts(lengths, names, wanted, max_rate))],
        "name string, source_size long, blocks long, target double, tilt double")  # a row per source
    rate = (F.when(F.col("target") <= 0, 0.0).when(F.col("size") == 0, float(min(1.0, max_rate)))
            .when(F.col("tilt").isNull(), float(max_rate)).otherwise(F.least(F.lit(float(max_rate)), F.exp(F.col("tilt") * z))))
    tie = F.xxhash64("doc_id", "size")
    dealt = (sized.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name"))).withColumn("rate", rate).drop("name", "tilt")
             .withColumn("tie", tie).withColumn("block", F.pmod("tie", "blocks")))
    kind = dict(sized.dtypes)["doc_id"]
    return dealt.groupBy("source", "block").applyInPandas(
        _diffuse(math.floor(max_rate)),
        f"doc_id {kind}, size long, source string, source_size long, target double, rate double, copies long")


def mixed_documents(docs: DataFrame, targets: Callable = cyclic_targets(), max_rate: float = 2.0, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows with equal id, size and source share the larger number."""
    size = word_count(F.col(text_col).cast("string"))
    own = [unused(docs, name) for name in ("_id", "_size", "_source", "_copies", "_copy")]
    taken = (mix(docs, targets, max_rate, id_col, text_col, source_col)
             .groupBy(F.col("doc_id").alias(own[0]), F.col("size").alias(own[1]), F.col("source").alias(own[2]))
             .agg(F.max("copies").cast("int").alias(own[3])).where(F.col(own[3]) > 0))
    on = (F.col(id_col).eqNullSafe(F.col(own[0])) & size.eqNullSafe(F.col(own[1]))
          & F.col(source_col).cast("string").eqNullSafe(F.col(own[2])))
    return docs.join(taken, on).withColumn(own[4], F.explode(F.array_repeat(F.lit(0), F.col(own[3])))).drop(*own)
