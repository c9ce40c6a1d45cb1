"""Column statistics and evaluation metrics.

Per-feature loops of the reference become ONE long-format job: the wide frame
is melted to (id, feature, value, y) with a single ``unpivot`` projection and
every metric is a grouped aggregation keyed by feature (plus value where ranks
are needed).  Ranks come from value counts, so ties and hot values collapse
before any shuffle-heavy step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import cumulative_counts, exact_quantiles
from ..session import cut_lineage
from .counts import count_table, melt_values, spearman_of_counts
from .encode import melt

KERNEL_REACH = 8.6  #: bandwidths: exp(-8.6 ** 2 / 2) < 1e-16

NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in exclude and f.dataType.typeName().split("(")[0] in NUMERIC]


def long_numeric(df: DataFrame, id_cols: Sequence[str], columns: Sequence[str],
                 var: str = "feature", val: str = "value") -> DataFrame:
    """Melt numeric columns to (ids..., feature, value double)."""
    d = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in columns])
    return melt(d, id_cols, columns, var, val)


# ------------------------------------------------------------------ F14-F16
def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) — missing kept as its own value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def category_target_rate(df: DataFrame, column: str, target: str = "TARGET") -> DataFrame:
    """(category, count, default_rate) sorted by rate descending."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"), F.avg(target).alias("default_rate"))
              .orderBy(F.desc("default_rate"), column))


def binned_target_rate(df: DataFrame, bin_col: str, target: str = "TARGET") -> DataFrame:
    """F16: count and mean target per bin."""
    return df.groupBy(bin_col).agg(F.count(F.lit(1)).alias("count"), F.avg(target).alias("default_rate"))


# ------------------------------------------------------------------ F17 / F18
def missing_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_pct 1 decimal) for columns with missing values,
    sorted by count descending.  One aggregation over every column, stacked to long.
    """
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    stacked = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("missing_count")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.feature", "s.missing_count", "_n")
    return (stacked.where(F.col("missing_count") > 0)
                   .select("feature", "missing_count",
                           F.round(F.col("missing_count") * 100.0 / F.col("_n"), 1).alias("missing_pct"))
                   .orderBy(F.desc("missing_count"), "feature"))


def missing_over(df: DataFrame, columns: Sequence[str] | None = None, limits: Sequence[float] = (20.0, 50.0)) -> DataFrame:
    """F17 counts: (limit, columns with a larger share of missing values, in percent)."""
    cols = list(columns or df.columns)
    share = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100).alias(f"m{i}") for i, c in enumerate(cols)])
    shares = F.array(*[F.col(f"m{i}") for i in range(len(cols))])

    def over(limit: float) -> Column:
        return F.size(F.filter(shares, lambda m: m > limit)).cast("long")

    rows = F.array(*[F.struct(F.lit(float(x)).alias("limit"), over(x).alias("columns")) for x in limits])
    return share.select(F.explode(rows).alias("x")).select("x.*")


def column_audit(df: DataFrame, exclude: Sequence[str] = (), high_missing: float = 0.98,
                 near_constant_ratio: float = 1e-8) -> DataFrame:
    """per column dtype, missing_rate, nunique, near_constant, high_missing.

    One (column, value) count table over a single scan: exact distinct counts of all
    columns without copying the rows per distinct aggregate.  Values are compared as
    strings of their own type (-0.0 as 0.0).  near_constant = nunique / rows <= ratio
    OR nunique <= 1.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = [c for c in df.columns if c not in exclude]

    def text(c: str) -> Column:
        x = F.col(f"`{c}`")
        return ((x + F.lit(0.0).cast(types[c])) if types[c] in ("float", "double") else x).cast("string")

    cells = F.array(*[F.struct(F.lit(i).alias("i"), text(c).alias("v")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(cells).alias("x")).select("x.*").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    st = counts.groupBy("i").agg(F.sum("n").alias("_n"), F.count("v").alias("nunique"),
                                 F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("_gaps"))
    names = df.sparkSession.createDataFrame([(i, c, types[c]) for i, c in enumerate(cols)], "i int, feature string, dtype string")
    st = names.join(st, "i", "left").withColumn("nunique", F.coalesce("nunique", F.lit(0)))
    return st.select(
        "feature", "dtype", (F.col("_gaps") / F.col("_n")).alias("missing_rate"), "nunique",
        ((F.col("nunique") / F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)) <= near_constant_ratio)
         | (F.col("nunique") <= 1)).alias("near_constant"),
        F.coalesce(F.col("_gaps") / F.col("_n") > high_missing, F.lit(False)).alias("high_missing"),
    )


# ------------------------------------------------------------------ F19
def duplicate_columns(df: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """columns whose content equals an earlier column (first kept).

    Pass 1 fingerprints every column in one aggregation: an order-free
    ``bit_xor(xxhash64(id, value))`` plus the null count, typed by family
    (integral / fractional / string are never equal, as in the reference).
    Pass 2 confirms candidate pairs with a null-safe mismatch count, so a hash
    collision cannot drop a column.  Returns (column, duplicate_of).
    """
    fam = {}
    for f in df.schema.fields:
        t = f.dataType.typeName()
        fam[f.name] = "int" if t in ("byte", "short", "integer", "long", "boolean") else \
            ("float" if t in ("float", "double") or t.startswith("decimal") else "str")
    cols = list(columns)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        v = v.cast("long") if fam[c] == "int" else (v.cast("double") if fam[c] == "float" else v.cast("string"))
        aggs.append(F.bit_xor(F.xxhash64(F.col(id_col), v)).alias(f"h{i}"))
        aggs.append(F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{i}"))
    row = df.agg(*aggs).first()
    seen: dict[tuple, str] = {}
    pairs = []
    for i, c in enumerate(cols):
        key = (fam[c], row[f"h{i}"], row[f"n{i}"])
        if key in seen:  # the class's first column stands for all equal to it
            pairs.append((c, seen[key]))
        else:
            seen[key] = c
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, duplicate_of string")
    checks = [F.sum((~F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).cast("long")).alias(f"d{i}")
              for i, (a, b) in enumerate(pairs)]
    r2 = df.agg(*checks).first()
    out, dropped = [], set()
    for i, (a, b) in enumerate(pairs):
        if r2[f"d{i}"] == 0 and a not in dropped and b not in dropped:
            out.append((a, b))
            dropped.add(a)
    return df.sparkSession.createDataFrame(out, "column string, duplicate_of string")


# ------------------------------------------------------------------ F20 / F21
def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """one-row frame of exact per-column medians (linear interpolation; see ``exact_quantiles``)."""
    q = quantiles_long(df, columns, [0.5])
    return q.groupBy().pivot("feature", list(columns)).agg(F.first("q"))


def quantiles_long(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """exact quantiles of many columns in one plan -> (feature, p, q)."""
    long = long_numeric(df, [], columns)
    return exact_quantiles(long, "value", probs, ["feature"])


def fill_medians(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Median imputation; the one-row statistics frame is broadcast."""
    fit_df = df if fit_df is None else fit_df
    m = medians(fit_df, columns)
    m = m.select(*[F.col(c).alias(f"_med_{c}") for c in columns]).withColumn("_j", F.lit(0))
    out = df.withColumn("_j", F.lit(0)).join(F.broadcast(m), "_j")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def standardize(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None,
                center: bool = True, suffix: str = "") -> DataFrame:
    """(x - mean) / population sd, fitted on ``fit_df``; sd 0 -> divisor 1."""
    fit_df = df if fit_df is None else fit_df
    s = fit_df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_mu_{c}") for c in columns],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"_sd_{c}") for c in columns])
    # divisors are made in the one row of statistics, not for every row
    divisor = {c: F.when(F.coalesce(F.col(f"_sd_{c}"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}")) for c in columns}
    s = s.select(*[f"_mu_{c}" for c in columns], *[divisor[c].alias(f"_sd_{c}") for c in columns], F.lit(0).alias("_j"))
    out = df.withColumn("_j", F.lit(0)).join(F.broadcast(s), "_j")
    res = []
    for c in df.columns:
        if c in columns:
            num = F.col(c) - F.col(f"_mu_{c}") if center else F.col(c)
            res.append((num / F.col(f"_sd_{c}")).alias(c + suffix))
            if suffix:
                res.append(F.col(c))
        else:
            res.append(F.col(c))
    return out.select(*res)


def mean_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """long (feature, mean, std ddof 1)."""
    agg = df.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(columns)],
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(columns)])).alias("x")).select("x.*")


# ------------------------------------------------------------------ J1 / J2
def auc_by_group(long_df: DataFrame, score: str, label: str, group: Sequence[str] = (),
                 buckets: int | None = None) -> DataFrame:
    """Exact tie-aware ROC AUC per group (rank-sum / Mann-Whitney).

    AUC = (sum of average ranks of positives - P(P+1)/2) / (P * N).
    Built from (group, score) value counts with their positive counts — no
    per-row sort, no single partition.  NULL when a class is empty.
    """
    t = cumulative_counts(long_df.where(F.col(label).isNotNull()), score, group,
                          extra=[F.sum(F.col(label).cast("long")).alias("pos")], buckets=buckets)
    avg_rank = F.col("cum") - (F.col("cnt") - 1) / 2.0
    g = t.groupBy(*group).agg(F.sum(F.col("pos") * avg_rank).alias("rs"), F.sum("pos").alias("P"),
                              F.first("n").alias("n"))
    P, N = F.col("P").cast("double"), (F.col("n") - F.col("P")).cast("double")
    auc = F.when((P > 0) & (N > 0), (F.col("rs") - P * (P + 1) / 2.0) / (P * N))
    return g.select(*group, auc.alias("auc"))


def auc(df: DataFrame, score: str, label: str) -> float | None:
    r = auc_by_group(df, score, label).first()
    return None if r is None else r["auc"]


def average_precision_by_group(long_df: DataFrame, score: str, label: str,
                               group: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Average precision = sum over thresholds (descending score) of (dTP / P) * precision.

    Descending order = ascending order of the negated score.  One cumulative table
    over the distinct thresholds runs both sums, rows (``cum``) and positives
    (``cum_dtp``); thresholds without positives add 0.
    """
    d = long_df.where(F.col(label).isNotNull() & F.col(score).isNotNull()) \
        .withColumn("_neg", -F.col(score).cast("double")).withColumn("_y", F.col(label).cast("long"))
    t = cumulative_counts(d, "_neg", group, extra=[F.sum("_y").alias("dtp")], buckets=buckets, also=["dtp"])
    term = F.when(F.col("dtp") > 0, (F.col("dtp") / F.col("n_dtp")) * (F.col("cum_dtp") / F.col("cum")))
    return t.groupBy(*group).agg(F.sum(term).alias("average_precision"))


# ------------------------------------------------------------------ J4-J8
def mutual_information(long_df: DataFrame, x: str, y: str, group: Sequence[str] = ()) -> DataFrame:
    """J4 (and J5 on binned x): exact plug-in MI in nats from the contingency table.

    n * MI = sum nxy ln nxy - sum nx ln nx - sum ny ln ny + n ln n, four grouped sums
    over the cell counts; no window, so no task holds a feature's whole table.
    """
    g = list(group)
    cells = long_df.groupBy(*g, x, y).agg(F.count(F.lit(1)).alias("_k"))
    ent = lambda c: F.sum(F.col(c) * F.log(F.col(c).cast("double")))
    parts = [cells.groupBy(*g).agg(F.sum("_k").alias("_n"), ent("_k").alias("_xy"))]
    for side, name in ((x, "_x"), (y, "_y")):
        parts.append(cells.groupBy(*g, side).agg(F.sum("_k").alias("_k")).groupBy(*g).agg(ent("_k").alias(name)))
    if not g:
        parts = [p.withColumn("_j", F.lit(0)) for p in parts]  # one row each
    j = parts[0].join(parts[1], g or ["_j"]).join(parts[2], g or ["_j"])
    mi = (F.col("_xy") - F.col("_x") - F.col("_y")) / F.col("_n") + F.log(F.col("_n").cast("double"))
    return j.select(*g, F.greatest(mi, F.lit(0.0)).alias("mi"))


def spearman_with_label(long_df: DataFrame, value: str, label: str, group: Sequence[str] = (),
                        buckets: int | None = None) -> DataFrame:
    """|Spearman rho| of value vs 0/1 label on pairwise-complete rows.

    One table of (group, value) counts with running sums; the label has two ranks,
    which follow from the class sizes, so every sum is a grouped aggregation.
    """
    d = long_df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    t = cumulative_counts(d, value, group, extra=[F.sum(F.col(label).cast("long")).alias("pos")], buckets=buckets, also=["pos"])
    t = t.select(*group, F.col("cnt").alias("w"), "pos", F.col("cum").alias("cum_w"), F.col("n").alias("n_w"), "n_pos")
    return spearman_of_counts(t, group)


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation for every pair, long output (col_a, col_b, corr).

    With X the values (0 where missing) and P the presence mask of a task's rows, P'P, X'P, (X*X)'P and X'X hold
    the counts, sums, squares and products of every pair over the rows where both are present.  Tasks send
    these matrices, which are added up per pair.  Columns are first shifted by their means, so that no
    digits cancel; a pair whose common rows hold one value only has no correlation (NULL).
    """
    cols = list(columns)
    values = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"))
    means = df.agg(*[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = [means[f"m{i}"] or 0.0 for i in range(len(cols))]
    sums = (values.mapInArrow(_pair_sums(shift), "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    ok = (vx > F.lit(1e-12) * n * F.col("sxx")) & (vy > F.lit(1e-12) * n * F.col("syy"))
    corr = F.when(ok, (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"),
                       F.when(corr.isNotNull(), F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0))).alias("corr"))


def _pair_sums(shift: Sequence[float]):
    """Arrow map: arrays of doubles (missing: null or NaN) to the pair sums of the task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        d = len(shift)
        total = np.zeros((6, d, d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, d) - np.array(shift)
            there = ~np.isnan(x)
            x, p = np.where(there, x, 0.0), there.astype(float)
            sx, sxx = x.T @ p, (x * x).T @ p
            total += np.stack([p.T @ p, sx, sx.T, sxx, sxx.T, x.T @ x])
        i, j = np.divmod(np.arange(d * d, dtype=np.int32), d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *(pa.array(t.ravel()) for t in total)],
                                         names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def spearman_matrix(df: DataFrame, columns: Sequence[str], id_col: str,
                    buckets: int | None = None) -> DataFrame:
    """Spearman matrix = Pearson on per-column average ranks (H1 then J7)."""
    long = long_numeric(df, [id_col], columns)
    t = cumulative_counts(long, "value", ["feature"], buckets=buckets) \
        .select("feature", "value", (F.col("cum") - (F.col("cnt") - 1) / 2.0).alias("r"))
    ranked = long.join(t, ["feature", "value"], "left")
    wide = ranked.groupBy(id_col).pivot("feature", list(columns)).agg(F.first("r"))
    return pearson_matrix(wide, columns)


def kde_curves(df: DataFrame, columns: Sequence[str], label: str, points: int = 200) -> DataFrame:
    """Class-conditional Gaussian density of every column on a grid (Scott bandwidth): the data behind the
    plots, (feature, y, i, g, density).

    Rows are first reduced to counts per (feature, class, value) by one scan; the kernel sum runs over the distinct
    values themselves.  A value reaches the grid points within ``KERNEL_REACH`` bandwidths, beyond which a kernel
    is below 1e-16 of its height; sums are combined per task, so ``points`` rows a class and column are shuffled.
    Columns of one value, and classes with fewer than two rows, have no bandwidth and no curve.
    """
    d = df.where(F.col(label).isNotNull())
    long = melt_values(d, list(columns), (), [F.col(label).alias("y")]).where(F.col("num").isNotNull())
    counts = cut_lineage(long.groupBy("feature", "y", F.col("num").alias("x")).agg(F.count(F.lit(1)).cast("double").alias("c")))
    # one row per column, or per column and class, from here on
    span = counts.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    mean = counts.groupBy("feature", "y").agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("mean"))
    near = counts.join(F.broadcast(mean), ["feature", "y"])
    spread = near.groupBy("feature", "y").agg(F.max("n").alias("n"), F.sum(F.col("c") * F.pow(F.col("x") - F.col("mean"), F.lit(2))).alias("ss"))
    told = spread.join(span, "feature").select(
        "feature", "y", "n", "lo", ((F.col("hi") - F.col("lo")) / F.lit(max(points - 1, 1))).alias("step"),
        (F.sqrt(F.col("ss") / (F.col("n") - 1)) * F.pow("n", F.lit(-0.2))).alias("h")).where((F.col("n") > 1) & (F.col("h") > 0))
    j = counts.join(F.broadcast(told), ["feature", "y"])
    x, h = F.col("x") - F.col("lo"), F.col("h")
    first = F.greatest(F.ceil((x - h * KERNEL_REACH) / F.col("step")), F.lit(0))
    last = F.least(F.floor((x + h * KERNEL_REACH) / F.col("step")), F.lit(points - 1))
    j = j.withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn("g", F.col("lo") + F.col("step") * F.col("i"))
    z = (F.col("x") - F.col("g")) / h
    kernel = F.col("c") * F.exp(-0.5 * z * z) / (h * F.lit((2 * math.pi) ** 0.5) * F.col("n"))
    found = j.groupBy("feature", "y", "i").agg(F.sum(kernel).alias("density"))
    grid = told.select("feature", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("i"),
                       "lo", "step")
    return (grid.join(found, ["feature", "y", "i"], "left")
            .select("feature", "y", "i", (F.col("lo") + F.col("step") * F.col("i")).alias("g"), F.coalesce("density", F.lit(0.0)).alias("density")))


def feature_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "TARGET", bins: int = 10) -> DataFrame:
    """Q14: (feature, kind, bucket, count, default_rate) of every column from one count table.

    Categories by value (F14, F15); numbers in ``bins`` equal-width right-closed bins over [min, max] whose first
    bin leaves the minimum out, as the profile's cut does (F16); missing values are left out of both.
    """
    counts = count_table(df, numeric, categorical, label)
    span = counts.groupBy("feature").agg(F.min("num").alias("lo"), F.max("num").alias("hi"))  # one row per column
    j = counts.join(F.broadcast(span), "feature")
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    place = F.least(F.greatest(F.ceil((F.col("num") - F.col("lo")) / width) - 1, F.lit(0)), F.lit(bins - 1))
    bucket = F.when(F.col("num") > F.col("lo"), place.cast("string")).when((F.col("gaps") == 0) & F.col("cat").isNotNull(), F.col("cat"))
    cells = j.select("feature", F.when(F.col("cat").isNull(), "bin").otherwise("value").alias("kind"), bucket.alias("bucket"), "w", "pos")
    return (cells.where("bucket is not null and w > 0").groupBy("feature", "kind", "bucket")
            .agg(F.sum("w").alias("count"), (F.sum("pos") / F.sum("w")).alias("default_rate")))


def label_balance(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """One row (neg, pos, ratio = neg / pos)."""
    r = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("neg"),
               F.sum((F.col(label) == 1).cast("long")).alias("pos"))
    return r.select("neg", "pos", F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).alias("ratio"))


def pass_rule(metrics: DataFrame, auc_thr: float = 0.51, mi_q: float = 0.60, rho_thr: float = 0.05) -> DataFrame:
    """pass = auc >= thr OR mi >= q-quantile(mi) OR |rho| >= thr (quantile broadcast as one row)."""
    q = metrics.agg(F.percentile(F.col("mi"), mi_q).alias("_mi_thr")).withColumn("_j", F.lit(0))
    m = metrics.withColumn("_j", F.lit(0)).join(F.broadcast(q), "_j")
    p = (F.coalesce(F.col("auc_single") >= auc_thr, F.lit(False))
         | F.coalesce(F.col("mi") >= F.col("_mi_thr"), F.lit(False))
         | F.coalesce(F.col("spearman_abs") >= rho_thr, F.lit(False)))
    return m.withColumn("pass_stage1", p.cast("int")).drop("_j", "_mi_thr")


def top_k(df: DataFrame, by: Sequence[str | Column], k: int) -> DataFrame:
    """H5/H6: sorted top-k (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*by).limit(k)
