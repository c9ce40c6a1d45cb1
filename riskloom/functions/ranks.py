"""Exact global ranks without a single-partition window (§4-P5).

``Window.orderBy(x)`` with no partition key moves every row into ONE task.
Here positions come from one plan at every size:

1. rows (or, for tie-averaged ranks, distinct (group, value) with their counts,
   combined map-side) are range-partitioned by (group, value, tiebreak), so a
   value held by a third of all rows is cut by its tiebreak like any other range;
2. the partitions are written to the shared checkpoint folder, which fixes them;
3. totals per (group, partition) -> exclusive running offsets: at most
   groups + partitions rows, since ranges are contiguous;
4. running count inside each (group, partition) window + offset.

The number of partitions (``buckets``, else the session's shuffle partitions)
only decides where the work is split; ranks are exact and rows complete
whatever it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def _positions(rows: DataFrame, group: Sequence[str], order: Sequence[str], buckets: int | None,
               also: Sequence[str] = ()) -> DataFrame:
    """``rows`` (with ``cnt``) plus ``cum`` (inclusive running ``cnt`` in ``order`` within group) and ``n``.

    Columns named in ``also`` get ``cum_<name>`` and ``n_<name>`` in the same pass.
    """
    summed = {"cnt": ("cum", "n"), **{c: (f"cum_{c}", f"n_{c}") for c in also}}
    g = list(group)
    parts = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(rows.repartitionByRange(parts, *g, *order)).withColumn("_rk_p", F.spark_partition_id())
    totals = fixed.groupBy(*g, "_rk_p").agg(*[F.sum(c).alias(f"_rk_t_{c}") for c in summed])
    wg = W.partitionBy(*g) if g else W.partitionBy(F.lit(0))  # a row per partition
    before = wg.orderBy("_rk_p").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(c).alias(f"_rk_{i}") for i, c in enumerate(g)], F.col("_rk_p").alias("_rk_q"),
        *[F.coalesce(F.sum(f"_rk_t_{c}").over(before), F.lit(0)).alias(f"_rk_off_{c}") for c in summed],
        *[F.sum(f"_rk_t_{c}").over(wg).alias(n) for c, (_, n) in summed.items()])
    inner = W.partitionBy(*g, "_rk_p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    on = [F.col("_rk_p") == F.col("_rk_q")] + [F.col(c).eqNullSafe(F.col(f"_rk_{i}")) for i, c in enumerate(g)]
    run = fixed.select("*", *[F.sum(c).over(inner).alias(f"_rk_cum_{c}") for c in summed]).join(totals, on)
    return run.select(*rows.columns, *[(F.col(f"_rk_off_{c}") + F.col(f"_rk_cum_{c}")).alias(cum) for c, (cum, _) in summed.items()],
                      *[n for _, n in summed.values()])


def cumulative_counts(df: DataFrame, value: str, group: Sequence[str] = (),
                      weight: str | Column | None = None, extra: Sequence[Column] = (),
                      buckets: int | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Rows of ``(group..., value, cnt, extra..., cum, n)``, one per distinct (group, value).

    ``cnt``  rows (or summed ``weight``) with this value,
    ``cum``  inclusive cumulative count in ascending value order within group,
    ``n``    total count in the group.
    NULL values are excluded (pandas ranks leave them NaN).
    """
    w = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.sum(w).alias("cnt"), *extra)
    return _positions(counts, group, [value], buckets, also)


def average_rank_table(df: DataFrame, value: str, group: Sequence[str] = (),
                       buckets: int | None = None) -> DataFrame:
    """(group..., value, cnt, n, avg_rank) — pandas ``rank(method="average")``."""
    t = cumulative_counts(df, value, group, buckets=buckets)
    return t.withColumn("avg_rank", F.col("cum") - (F.col("cnt") - F.lit(1)) / F.lit(2.0))


def with_average_rank(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "rank",
                      pct: bool = False, buckets: int | None = None) -> DataFrame:
    """H1: attach the tie-averaged rank of ``value`` (1-based; ``pct`` divides by n).

    The rank table is joined back on (group, value); a value held by a third
    of all rows is a skewed join key on the big side only, which AQE's skew
    join splits.
    """
    t = average_rank_table(df, value, group, buckets)
    r = (F.col("avg_rank") / F.col("n")) if pct else F.col("avg_rank")
    t = t.select(*group, value, r.alias(out))
    return df.join(t, [*group, value], "left")


def with_row_number(df: DataFrame, value: str, tiebreak: Sequence[str], group: Sequence[str] = (),
                    out: str = "rn", buckets: int | None = None) -> DataFrame:
    """H3: unique rank ordered by (value, tiebreak) — ``rank(method="first")``.

    Returns every input row with a non-NULL ``value``, with ``out`` and the group
    size ``n``.  NULL tiebreaks come first; rows equal in value and tiebreak get
    different numbers in any order.
    """
    if not tiebreak:
        raise ValueError("with_row_number needs at least one tiebreak column (e.g. the id)")
    rows = df.where(F.col(value).isNotNull()).withColumn("cnt", F.lit(1))
    return (_positions(rows, group, [value, *tiebreak], buckets)
            .withColumn(out, F.col("cum").cast("long")).drop("cnt", "cum"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (),
                    buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``quantile`` / SQL ``quantile_cont``).

    Unlike the exact ``percentile`` aggregate — which buffers every value of a
    group in one task — this reads the cumulative value-count table: the
    needed 0-based positions k = floor/ceil((n - 1) p) form a small table
    (groups x probabilities x 2; Spark broadcasts it if its size allows) that is
    matched to the one value row whose position range [cum - cnt, cum) contains k.
    Output (group..., p, q).
    """
    g = list(group)
    t = cumulative_counts(df, value, g, buckets=buckets)
    key = g if g else ["_q_g"]
    if not g:
        t = t.withColumn("_q_g", F.lit(0))
    ns = t.groupBy(*key).agg(F.max("n").alias("_n"))
    h = (F.col("_n") - 1) * F.col("p")
    pos = (ns.select(*[F.col(c).alias(f"_p_{c}") for c in key],
                     F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"), "_n")
             .select(*[f"_p_{c}" for c in key], "p", h.alias("_h"))
             .select(*[f"_p_{c}" for c in key], "p", "_h",
                     F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_k")))
    tt = t.select(*key, value, "cnt", "cum")
    cond = ([F.col(c) == F.col(f"_p_{c}") for c in key]
            + [(F.col("cum") - F.col("cnt")) <= F.col("_k"), F.col("_k") < F.col("cum")])
    j = tt.join(pos, cond).select(*key, "p", "_h", "_k", F.col(value).alias("_v"))
    v = j.groupBy(*key, "p").agg(F.min_by("_v", "_k").alias("_vlo"), F.max_by("_v", "_k").alias("_vhi"),
                                 F.first("_h").alias("_h"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    out = v.select(*key, "p", (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).cast("double").alias("q"))
    return out if g else out.drop("_q_g")
