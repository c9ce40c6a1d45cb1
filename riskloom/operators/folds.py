"""K1-K6: deterministic folds, undersampling and class weights.

Row order in the reference carries fold membership; here a fold is a column.
Rows are ordered by a seeded md5-derived 60-bit integer (tie broken by id), so
the assignment is reproducible across engines and re-runs (a lost executor
recomputes the same folds).  Within-class positions use the bucketed
cumulative count plan (no ``Window.partitionBy(label)``, which would put each
class in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import _positions, with_row_number


def seeded_hash(id_col: str, seed: int) -> Column:
    """60-bit integer from md5(f"{seed}:{id}") — same value in SQL engines with md5."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def stratified_folds(df: DataFrame, id_col: str = "SK_ID_CURR", label: str = "TARGET", k: int = 5,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """K1: per class, rows in seeded-hash order dealt round-robin into k folds.

    Fold sizes per class differ by at most one.
    """
    d = df.withColumn("_h", seeded_hash(id_col, seed))
    r = with_row_number(d, "_h", [id_col], group=[label], out="_rn")
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn", "n")


def kfold(df: DataFrame, id_col: str = "SK_ID_CURR", k: int = 5, seed: int = 50, out: str = "fold") -> DataFrame:
    """K2: plain k folds over seeded-hash order."""
    d = df.withColumn("_h", seeded_hash(id_col, seed))
    r = with_row_number(d, "_h", [id_col], out="_rn")
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn", "n")


def undersample(df: DataFrame, id_col: str = "SK_ID_CURR", label: str = "TARGET", ratio: float = 3.0,
                seed: int = 42) -> DataFrame:
    """K3: keep all positives and the first ratio * P negatives in seeded-hash order."""
    pos = df.where(F.col(label) == 1)
    p = df.agg(F.sum((F.col(label) == 1).cast("long")).alias("_p")).withColumn("_j", F.lit(0))
    neg = df.where(F.col(label) == 0).withColumn("_h", seeded_hash(id_col, seed))
    neg = with_row_number(neg, "_h", [id_col], out="_rn")
    neg = (neg.withColumn("_j", F.lit(0)).join(F.broadcast(p), "_j")
              .where(F.col("_rn") <= F.floor(F.col("_p") * ratio)).select(*df.columns))
    return pos.unionByName(neg)


def fold_undersample(df: DataFrame, id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold",
                     ratio: float = 3.0, seed: int = 42, out: str = "keep_for") -> DataFrame:
    """K3 inside each fold's training part: every row of ``df`` with ``out``, the folds whose model learns from it.

    For fold k these are all positives outside k and the first ``ratio`` * P_k negatives outside k in
    seeded-hash order, P_k being the positives outside k (all rows, where that keeps no negative).  One
    running count over the negatives, with one per fold beside it, gives the place in every training part:
    the place among all less the place among those of fold k.
    """
    parts = {r[fold]: r for r in fold_class_counts(df, label, fold).collect()}  # a row per fold
    ks = sorted(parts)
    limit = {k: int(min(parts[k]["neg"], ratio * parts[k]["pos"])) for k in ks}
    negative = df.where(F.col(label) == 0).withColumn("_h", seeded_hash(id_col, seed)).withColumn("cnt", F.lit(1))
    for i, k in enumerate(ks):
        negative = negative.withColumn(f"_in{i}", (F.col(fold) == k).cast("long"))
    placed = _positions(negative, [], ["_h", id_col], None, [f"_in{i}" for i in range(len(ks))])
    learns = [F.when((F.col(fold) != k) & ((F.col("cum") - F.col(f"cum__in{i}") <= limit[k]) | F.lit(limit[k] <= 0)), F.lit(int(k)))
              for i, k in enumerate(ks)]
    others = [F.when(F.col(fold) != k, F.lit(int(k))) for k in ks]
    rest = df.where((F.col(label) != 0) | F.col(label).isNull())
    return (placed.select(*df.columns, F.array_compact(F.array(*learns)).alias(out))
            .unionByName(rest.select(*df.columns, F.array_compact(F.array(*others)).alias(out))))


def fold_class_counts(df: DataFrame, label: str = "TARGET", fold: str = "fold") -> DataFrame:
    """Per fold f: N and P of the TRAINING part (all rows outside fold f)."""
    c = df.groupBy(fold).agg(F.sum((F.col(label) == 0).cast("long")).alias("_n"),
                             F.sum((F.col(label) == 1).cast("long")).alias("_p"))
    tot = c.agg(F.sum("_n").alias("_tn"), F.sum("_p").alias("_tp")).withColumn("_j", F.lit(0))
    return (c.withColumn("_j", F.lit(0)).join(F.broadcast(tot), "_j")
             .select(fold, (F.col("_tn") - F.col("_n")).alias("neg"), (F.col("_tp") - F.col("_p")).alias("pos")))


def positive_weights(df: DataFrame, label: str = "TARGET", fold: str = "fold", cap: float | None = 50.0
                     ) -> DataFrame:
    """K4 (cap=50) / K5 (cap=None, "auto" scale_pos_weight): (fold, pos_weight = min(N/P, cap))."""
    c = fold_class_counts(df, label, fold)
    w = F.when(F.col("pos") > 0, F.col("neg") / F.col("pos"))
    if cap is not None:
        w = F.least(w, F.lit(float(cap)))
    return c.select(fold, "neg", "pos", w.alias("pos_weight"))


def balanced_weight(df: DataFrame, label: str = "TARGET", out: str = "weight") -> DataFrame:
    """K6: n / (2 * n_class) per row (class counts: a two-row broadcast table)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = c.agg(F.sum("_nc").alias("_n")).withColumn("_j", F.lit(0))
    cw = (c.withColumn("_j", F.lit(0)).join(F.broadcast(n), "_j")
           .select(label, (F.col("_n") / (F.lit(2.0) * F.col("_nc"))).alias(out)))
    return df.join(F.broadcast(cw), label, "left")
