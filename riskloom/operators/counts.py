"""One count table for every column statistic.

``count_table`` reads the wide frame once and keeps, for each (feature, value), the number of rows and,
per fold, the labelled rows and positives.  ``ranked`` adds running sums in value order within each feature
(ranges, not one window task per feature; see ``functions.ranks``).  Everything that screening, binning and
auditing ask of a column is then a grouped sum over distinct values:

* quantiles, of all rows or of the rows outside a fold: the value whose running count reaches a position;
* codes of sorted categories: the running number of distinct values;
* average ranks, hence AUC and Spearman: running count less half of the value's own count;
* bins and mutual information: sums of counts between edges.

Both frames are checkpointed, so each metric reads the counts, never the rows.  A numeric value is held in
``num``, a category in ``cat`` (missing categories as ``MISSING``, with their number in ``gaps``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import _positions, cumulative_counts
from ..session import cut_lineage

MISSING = "__MISSING__"


def melt_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                keep: Sequence[Column] = ()) -> DataFrame:
    """(keep..., feature, num, cat, gap): one row per row and column, by one generator over a single scan."""
    def cell(c: str, is_num: bool) -> Column:
        x = F.col(f"`{c}`")
        # adding 0.0 makes -0.0 and 0.0 one value
        return F.struct(F.lit(c).alias("feature"),
                        (x.cast("double") + F.lit(0.0) if is_num else F.lit(None).cast("double")).alias("num"),
                        (F.lit(None).cast("string") if is_num else F.coalesce(x.cast("string"), F.lit(MISSING))).alias("cat"),
                        x.isNull().alias("gap"))

    cells = [cell(c, True) for c in numeric] + [cell(c, False) for c in categorical]
    if not cells:
        raise ValueError("no columns to count")
    return df.select(*keep, F.explode(F.array(*cells)).alias("_cell")).select(*[c for c in df.select(*keep).columns], "_cell.*")


def count_table(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), label: str | None = None,
                fold: str | None = None, k: int = 1) -> DataFrame:
    """(feature, num, cat, rows, gaps, w, pos, w0.., p0..), one row per distinct value; checkpointed.

    ``w`` and ``pos`` count labelled rows and those with label 1; ``w{f}`` and ``p{f}`` those of fold f.  Rows
    without a label (test rows) count in ``rows`` and ``gaps`` only; without ``label`` every row is labelled 0.
    """
    y = F.lit(0) if label is None else F.col(label)
    f = F.lit(0) if fold is None else F.col(fold)
    long = melt_values(df, numeric, categorical, [y.cast("int").alias("_y"), f.cast("int").alias("_f")])
    known = F.col("_y").isNotNull() & F.col("_f").isNotNull()
    one = known.cast("long")
    positive = F.coalesce((known & (F.col("_y") == 1)).cast("long"), F.lit(0))
    per_fold = []
    for i in range(k):
        own = F.coalesce((F.col("_f") == i).cast("long"), F.lit(0))
        per_fold += [F.sum(one * own).alias(f"w{i}"), F.sum(positive * own).alias(f"p{i}")]
    return cut_lineage(long.groupBy("feature", "num", "cat").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("gap").cast("long")).alias("gaps"),
        F.sum(one).alias("w"), F.sum(positive).alias("pos"), *per_fold))


def ranked(table: DataFrame, k: int = 1, buckets: int | None = None) -> DataFrame:
    """The present values of a count table with ``code`` (from 0) and running sums ``cum_*`` / totals ``n_*`` of
    rows, w, pos and every w{f}; checkpointed."""
    sums = ["rows", "w", "pos", *[f"w{i}" for i in range(k)]]
    rows = (table.where(F.col("num").isNotNull() | F.col("cat").isNotNull())
            .select("feature", "num", "cat", F.lit(1).alias("cnt"), "rows", "w", "pos", *[f"{x}{i}" for i in range(k) for x in "wp"]))
    out = _positions(rows, ["feature"], ["num", "cat"], buckets, sums)
    return cut_lineage(out.withColumn("code", (F.col("cum") - 1).cast("long")).drop("cnt", "cum", "n"))


def missing_counts(table: DataFrame, k: int = 1) -> DataFrame:
    """Per feature: the share of missing values over all rows, and the labelled rows and positives of numeric gaps."""
    gap = F.col("num").isNull() & F.col("cat").isNull()
    named = ["w", "pos", *[f"{x}{i}" for i in range(k) for x in "wp"]]
    return table.groupBy("feature").agg(
        (F.sum("gaps") / F.sum("rows")).alias("missing_rate"),
        *[F.coalesce(F.sum(F.when(gap, F.col(c))), F.lit(0)).alias(f"m_{c}") for c in named])


def _at(position: Column, running: Column, own: Column, value: Column) -> Column:
    """Aggregate: the value that holds the 0-based ``position`` of a running count."""
    return F.max(F.when((running - own <= position) & (position < running), value))


def quantile_columns(probs: Sequence[float], value: str = "num", own: Column | None = None, running: Column | None = None,
                     total: Column | None = None) -> list[Column]:
    """Aggregates over ``ranked`` rows of one feature: linear-interpolated quantiles, in the order of ``probs``."""
    own = F.col("w") if own is None else own
    running = F.col("cum_w") if running is None else running
    total = F.col("n_w") if total is None else total
    out = []
    for p in probs:
        h = (total - 1) * F.lit(float(p))
        low, high = _at(F.floor(h), running, own, F.col(value)), _at(F.ceil(h), running, own, F.col(value))
        part = F.max(h - F.floor(h))
        out.append(low + part * (high - low))
    return out


def sorted_codes(df: DataFrame, columns: Sequence[str], fill: str | None = None, buckets: int | None = None) -> DataFrame:
    """Long (feature, v, code): dense codes of the sorted categories of each column, from 0.

    The distinct values are cut into ranges, so a column with many categories is numbered by many tasks.
    Missing values become ``fill``, or are left out without one.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    long = df.select(F.explode(cells).alias("x")).select("x.*")
    if fill is not None:
        long = long.withColumn("v", F.coalesce("v", F.lit(fill)))
    rows = long.where(F.col("v").isNotNull()).distinct().withColumn("cnt", F.lit(1))
    return _positions(rows, ["feature"], ["v"], buckets).select("feature", "v", (F.col("cum") - 1).cast("int").alias("code"))


# ------------------------------------------------------------------ metrics over ranked counts
def fold_medians(values: DataFrame, k: int) -> DataFrame:
    """Per feature: ``med{f}``, the exact median of the labelled rows outside fold f."""
    out = []
    for f in range(k):
        out.append(quantile_columns([0.5], own=F.col("w") - F.col(f"w{f}"), running=F.col("cum_w") - F.col(f"cum_w{f}"),
                                    total=F.col("n_w") - F.col(f"n_w{f}"))[0].alias(f"med{f}"))
    return values.groupBy("feature").agg(*out)


def oof_rank_scores(values: DataFrame, gaps: DataFrame, k: int) -> DataFrame:
    """J3 numeric: (feature, score, cnt, pos).

    A missing value of fold f takes the median of the other folds; the score is the average rank in the fold over
    the fold's size.  Filled rows shift the ranks above their median by their number and form, with the rows
    that hold the median itself, one tie.
    """
    # one row per column: bounded by the schema
    told = F.broadcast(fold_medians(values, k).join(gaps, "feature"))
    rows = values.join(told, "feature")
    parts, ties = [], []
    for f in range(k):
        own, median = F.col(f"w{f}"), F.col(f"med{f}")
        filled = F.when(median.isNotNull(), F.col(f"m_w{f}")).otherwise(0)
        size = F.col(f"n_w{f}") + filled
        rank = F.col(f"cum_w{f}") - (own - 1) / 2.0 + F.when(F.col("num") > median, filled).otherwise(0)
        in_tie = F.coalesce(F.col("num") == median, F.lit(False))
        parts.append(F.struct((rank / size).alias("score"), F.when(in_tie, 0).otherwise(own).cast("long").alias("cnt"),
                              F.col(f"p{f}").alias("pos")))
        below = F.coalesce(F.sum(F.when(F.col("num") < median, own)), F.lit(0))
        at = F.coalesce(F.sum(F.when(in_tie, own)), F.lit(0)) + F.max(filled)
        at_pos = F.coalesce(F.sum(F.when(in_tie, F.col(f"p{f}"))), F.lit(0)) + F.max(F.when(median.isNotNull(), F.col(f"m_p{f}")).otherwise(0))
        ties.append(F.struct(((below + (at + 1) / 2.0) / F.max(size)).alias("score"), at.cast("long").alias("cnt"), at_pos.alias("pos")))
    plain = rows.select("feature", F.explode(F.array(*parts)).alias("s")).select("feature", "s.*")
    tied = rows.groupBy("feature").agg(F.array(*ties).alias("t")).select("feature", F.explode("t").alias("s")).select("feature", "s.*")
    return plain.union(tied).where("cnt > 0")


def oof_frequency_scores(values: DataFrame, k: int) -> DataFrame:
    """J3 categorical (C7): (feature, score, cnt, pos); the score is the category's share of the rows outside the fold."""
    parts = [F.struct(((F.col("w") - F.col(f"w{f}")) / F.greatest(F.col("n_w") - F.col(f"n_w{f}"), F.lit(1))).alias("score"),
                      F.col(f"w{f}").alias("cnt"), F.col(f"p{f}").alias("pos")) for f in range(k)]
    return values.select("feature", F.explode(F.array(*parts)).alias("s")).select("feature", "s.*").where("cnt > 0")


def auc_of_counts(scores: DataFrame) -> DataFrame:
    """(feature, auc) from (feature, score, cnt, pos) counts."""
    t = cumulative_counts(scores, "score", ["feature"], weight="cnt", extra=[F.sum("pos").alias("pos")])
    g = t.groupBy("feature").agg(F.sum(F.col("pos") * (F.col("cum") - (F.col("cnt") - 1) / 2.0)).alias("ranks"),
                                 F.sum("pos").cast("double").alias("p"), F.max("n").alias("n"))
    p, neg = F.col("p"), F.col("n") - F.col("p")
    return g.select("feature", F.when((p > 0) & (neg > 0), (F.col("ranks") - p * (p + 1) / 2.0) / (p * neg)).alias("auc"))


def spearman_of_counts(values: DataFrame, group: Sequence[str] = ("feature",)) -> DataFrame:
    """|rho| of value and 0/1 label; ranks of the label follow from the class sizes."""
    n, pos, total, total_pos = F.col("w").cast("double"), F.col("pos").cast("double"), F.col("n_w").cast("double"), F.col("n_pos").cast("double")
    rank = F.col("cum_w") - (n - 1) / 2.0
    low, high = (total - total_pos + 1) / 2.0, total - total_pos + (total_pos + 1) / 2.0
    mid = (total + 1) / 2.0  # both sides have this mean rank
    s = values.where("w > 0").groupBy(*group).agg(
        F.sum(n * (rank - mid) * (rank - mid)).alias("xx"),
        F.sum((rank - mid) * ((n - pos) * (low - mid) + pos * (high - mid))).alias("xy"),
        F.sum((n - pos) * (low - mid) * (low - mid) + pos * (high - mid) * (high - mid)).alias("yy"))
    ok = (F.col("xx") > 0) & (F.col("yy") > 0)
    return s.select(*group, F.abs(F.when(ok, F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))).alias("spearman_abs"))


def _entropy_sum(x: Column) -> Column:
    """Sum of c ln c over counts."""
    c = x.cast("double")
    return F.sum(F.when(c > 0, c * F.log(c)).otherwise(0.0))


def information_of_cells(cells: DataFrame) -> DataFrame:
    """(feature, mi) in nats from (feature, x, w, pos) cell counts of a 0/1 label."""
    s = cells.groupBy("feature").agg(F.sum("w").cast("double").alias("n"), F.sum("pos").cast("double").alias("p"), _entropy_sum(F.col("w")).alias("x"),
                                     (_entropy_sum(F.col("pos")) + _entropy_sum(F.col("w") - F.col("pos"))).alias("xy"))
    def part(c):
        return F.when(c > 0, c * F.log(c)).otherwise(0.0)

    n, p = F.col("n"), F.col("p")
    mi = (F.col("xy") - F.col("x") - part(p) - part(n - p)) / n + F.log(n)
    return s.where("n > 0").select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def binned_information(values: DataFrame, gaps: DataFrame, bins: int) -> DataFrame:
    """J4 over category codes, J5 over numeric values cut at exact quantiles, missing ones at the median."""
    probs = [i / bins for i in range(1, bins)]
    quantiles = quantile_columns([0.5, *probs])
    edges = values.where(F.col("num").isNotNull()).groupBy("feature").agg(
        quantiles[0].alias("middle"), F.array(*quantiles[1:]).alias("edges"))
    def below(x):
        return F.size(F.filter("edges", lambda e: e < x)).cast("long")

    told = F.broadcast(edges.join(gaps, "feature"))  # one row per column
    x = F.when(F.col("cat").isNotNull(), F.col("code")).otherwise(below(F.col("num")))
    cells = values.join(F.broadcast(edges), "feature", "left").select("feature", x.alias("x"), "w", "pos")
    filled = told.select("feature", below(F.col("middle")).alias("x"), F.col("m_w").alias("w"), F.col("m_pos").alias("pos"))
    cells = cells.union(filled).where("w > 0").groupBy("feature", "x").agg(F.sum("w").alias("w"), F.sum("pos").alias("pos"))
    return information_of_cells(cells)
