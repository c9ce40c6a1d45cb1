"""Encoders and binning.

Every fitted encoder is a small dictionary DataFrame (category -> code, bin ->
WOE, ...) computed by a grouped aggregation and joined back.  Dictionaries are
*not* hinted for broadcast when their size depends on the data (a category
column could have millions of values): AQE measures the materialised
dictionary at runtime and switches to a broadcast join only under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, falling back to a shuffle
join above it.  Dictionaries bounded by construction (one row per bin) are
broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import _positions, with_row_number
from ..session import cut_lineage
from . import counts as C
from .counts import MISSING

CATEGORY_GAP = "__CAT_NA__"  #: bin of missing categories
MOST_DUMMIES = 10_000        #: dense one-hot columns; more are an error, ``onehot_sparse`` has no limit
MOST_LITERALS = 1_000        #: categories of a column whose codes are written into the plan; more are joined


def _train(df: DataFrame, split_col: str | None, value: str = "train") -> DataFrame:
    return df if split_col is None else df.where(F.col(split_col) == value)


# ------------------------------------------------------------------ C1/C2/C3
def label_dictionaries(df: DataFrame, columns: Sequence[str], fill: str = MISSING) -> DataFrame:
    """C1 for many columns at once: long (feature, v, code), one melt + one distinct, numbered in ranges."""
    return C.sorted_codes(df, columns, fill)


def _apply_dictionary(df: DataFrame, columns: Sequence[str], dic: DataFrame, key_of, default=None) -> DataFrame:
    """Replace each column by its code from a long (feature, v, code) dictionary.

    Every per-column join reads the same dictionary frame, so the plan grows
    linearly with the number of columns.
    """
    out = df
    for c in columns:
        d = dic.where(F.col("feature") == c).select(F.col("v").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = out.join(d, key_of(c) == F.col(f"_v_{c}"), "left")
        code = F.col(f"_c_{c}") if default is None else F.coalesce(F.col(f"_c_{c}"), F.lit(default))
        out = out.withColumn(c, code).drop(f"_v_{c}", f"_c_{c}")
    return out


def label_encode(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None,
                 fill: str = MISSING, unseen: int | None = None) -> DataFrame:
    """Replace string columns by integer codes.

    ``fit_df`` (default ``df``) fixes the dictionary: train+test for C1,
    train only for C3 (then ``unseen=-1`` codes categories absent from train).
    """
    fit_df = df if fit_df is None else fit_df
    dic = label_dictionaries(fit_df, columns, fill)
    return _apply_dictionary(df, columns, dic, lambda c: F.coalesce(F.col(c).cast("string"), F.lit(fill)), unseen)


def binary_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """C2 selection: string columns with <= 2 distinct values, missing counted as a value.

    Distinct (column, value) pairs, then one count per column.
    """
    if not columns:
        return []
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("v")) for c in columns])
    sizes = df.select(F.explode(cells).alias("x")).select("x.*").distinct().groupBy("feature").count()
    found = {r["feature"]: r["count"] for r in sizes.collect()}  # one row per column
    return [c for c in columns if found.get(c, 0) <= 2]


# ------------------------------------------------------------------ C4 / B31
def mode_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-missing value (ties -> smallest), one-row frame."""
    m = modes(df, [column])
    return m.select(F.col("mode").alias("_mode"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B31 for many columns: (feature, mode) with ties broken by the smallest value.

    One melt + one (feature, value) count; the result has one row per column.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([], list(columns), "feature", "v").where(F.col("v").isNotNull())
    vc = long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    return vc.groupBy("feature").agg(F.min_by(F.col("v"), F.struct(-F.col("n"), F.col("v"))).alias("mode"))


def fill_mode(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Fill missing with the (train) mode of each column.

    The mode table has one row per column (bounded by the schema), pivoted to
    one row and broadcast.
    """
    fit_df = df if fit_df is None else fit_df
    m = modes(fit_df, columns).groupBy().pivot("feature", list(columns)).agg(F.first("mode"))
    m = m.select(*[F.col(c).alias(f"_mode_{c}") for c in columns]).withColumn("_j", F.lit(0))
    out = df.withColumn("_j", F.lit(0)).join(F.broadcast(m), "_j", "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_mode_{c}").cast(df.schema[c].dataType)).alias(c)
                        if c in columns else F.col(c) for c in df.columns])


def target_order_dictionaries(df: DataFrame, columns: Sequence[str], target: str = "TARGET") -> DataFrame:
    """C4 for many columns: long (feature, v, code) from one melt + one grouped mean."""
    long = df.select(F.col(target), *[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([target], list(columns), "feature", "v").where(F.col("v").isNotNull())
    g = long.groupBy("feature", "v").agg(F.avg(target).alias("_m"))
    return (_positions(g.withColumn("cnt", F.lit(1)), ["feature"], ["_m", "v"], None)
            .select("feature", "v", (F.col("cum") - 1).cast("int").alias("code")))


def target_order_encode(df: DataFrame, columns: Sequence[str], target: str = "TARGET",
                        split_col: str | None = "split") -> DataFrame:
    """C4 with B31: train-mode fill, then mean-target ordinal codes; unseen -> NULL.

    Each column's code depends only on that column and the target, so all
    dictionaries come from one pass over the filled train rows.
    """
    filled = fill_mode(df, columns, _train(df, split_col))
    dic = target_order_dictionaries(_train(filled, split_col), columns, target)
    return _apply_dictionary(filled, columns, dic, lambda c: F.col(c).cast("string"))


# ------------------------------------------------------------------ C5 / C6
def onehot_categories(df: DataFrame, columns: Sequence[str], split_col: str | None = "split"
                      ) -> dict[str, list[str]]:
    """Categories per column present in every split (get_dummies + inner align).

    One pass: explode (column, value) pairs, distinct with the split.  Each
    category becomes a column of the schema, so more than ``MOST_DUMMIES`` of
    them are an error; ``onehot_sparse`` takes any number.
    """
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in columns]))
    sel = [pairs.alias("p")] + ([F.col(split_col)] if split_col else [])
    e = df.select(*sel).select("p.c", "p.v", *([split_col] if split_col else [])).where(F.col("v").isNotNull())
    if split_col:
        nsplit = df.select(split_col).distinct().count()
        e = e.groupBy("c", "v").agg(F.countDistinct(split_col).alias("k")).where(F.col("k") == nsplit)
    else:
        e = e.distinct()
    out: dict[str, list[str]] = {c: [] for c in columns}
    found = e.select("c", "v").limit(MOST_DUMMIES + 1).collect()
    if len(found) > MOST_DUMMIES:
        raise ValueError(f"onehot: more than {MOST_DUMMIES} categories; use onehot_sparse")
    for r in sorted(found, key=lambda r: (r["c"], r["v"])):
        out[r["c"]].append(r["v"])
    return out


def onehot(df: DataFrame, columns: Sequence[str], categories: dict[str, list[str]] | None = None,
           split_col: str | None = "split", sep: str = "_") -> DataFrame:
    """Dense one-hot ``{col}_{value}`` int columns; missing -> all zero; source dropped."""
    cats = categories if categories is not None else onehot_categories(df, columns, split_col)
    keep = [F.col(c) for c in df.columns if c not in columns]
    dummies = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}{sep}{v}")
               for c in columns for v in cats.get(c, [])]
    return df.select(*keep, *dummies)


@dataclass(frozen=True)
class SlotEncoder:
    """Slots of a sparse vector: the numeric columns first, then the sorted categories of each column.

    ``slots`` (feature, v, slot) is a distributed table; only the number of categories per column is known here.
    """
    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    slots: DataFrame
    width: int

    def indices(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_slot_{i}`` for each categorical column, NULL where the category was not seen."""
        names = {c: f"_slot_{i}" for i, c in enumerate(self.columns)}
        copies = df.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(n) for c, n in names.items()])
        dic = self.slots.select(F.col("feature"), "v", F.col("slot").alias("code"))
        for c, n in names.items():
            d = dic.where(F.col("feature") == c).select(F.col("v").alias("_v"), F.col("code").alias("_c"))
            copies = copies.join(d, F.col(n) == F.col("_v"), "left").withColumn(n, F.col("_c")).drop("_v", "_c")
        return copies

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with the sparse vector column ``out``; unseen categories set no slot, missing numbers are NaN."""
        from pyspark.ml.linalg import VectorUDT
        from pyspark.sql.types import StructField, StructType
        found = self.indices(df).select(
            *df.columns, F.array(*[F.col(c).cast("double") for c in self.numeric]).cast("array<double>").alias("_numbers"),
            F.array(*[F.col(f"_slot_{i}").cast("int") for i in range(len(self.columns))]).cast("array<int>").alias("_slots"))
        schema = StructType([*df.schema.fields, StructField(out, VectorUDT())])
        return found.mapInArrow(_sparse_vectors(len(self.numeric), len(self.columns), self.width), schema)


def _sparse_vectors(n_numbers: int, n_slots: int, width: int):
    """Arrow map: the last two columns (numbers, slots) become one sparse vector."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            rows = batch.num_rows
            numbers = batch.column(batch.num_columns - 2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, n_numbers)
            slots = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, n_slots)
            index = np.column_stack([np.tile(np.arange(n_numbers, dtype=float), (rows, 1)), slots])
            value = np.column_stack([numbers, np.ones((rows, n_slots))])
            there = ~np.isnan(index)
            ends = pa.array(np.append(0, np.cumsum(there.sum(axis=1))).astype(np.int32))
            vector = pa.StructArray.from_arrays(
                [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)),
                 pa.ListArray.from_arrays(ends, pa.array(index[there].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value[there]))],
                names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], vector], names=[f"c{i}" for i in range(batch.num_columns - 1)])

    return run


def slot_encoder(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> SlotEncoder:
    """C6 fit: sorted categories of every column numbered in ranges, columns side by side."""
    codes = cut_lineage(C.sorted_codes(df, columns, MISSING))
    sizes = {r["feature"]: r["count"] for r in codes.groupBy("feature").count().collect()}  # one row per column
    first, start = len(numeric), {}
    for c in columns:
        start[c] = first
        first += sizes.get(c, 0)
    offset = F.create_map(*[F.lit(x) for c in columns for x in (c, start[c])])[F.col("feature")] if columns else F.lit(0)
    return SlotEncoder(tuple(columns), tuple(numeric), codes.select("feature", "v", (F.col("code") + offset).alias("slot")), first)


def onehot_sparse(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (),
                  out: str = "features") -> tuple[SlotEncoder, DataFrame]:
    """Sparse one-hot of ``columns`` (missing is a category) behind the numeric columns.

    Categories are counted, numbered and joined in Spark; none reaches the driver.
    """
    encoder = slot_encoder(df, columns, numeric)
    return encoder, encoder.transform(df, out)


# ------------------------------------------------------------------ C7
def oof_frequency(df: DataFrame, column: str, fold: str = "fold", out: str | None = None) -> DataFrame:
    """Out-of-fold frequency encoding.

    Each row's value is encoded with its frequency among rows of the OTHER
    folds (missing is a category; values unseen there -> 0).  Counts per
    (fold, value) and per value come from one grouped aggregation; no
    per-fold loop.
    """
    out = out or f"{column}_FREQ"
    key = F.coalesce(F.col(column).cast("string"), F.lit(MISSING))
    d = df.withColumn("_fk", key)
    per = d.groupBy(fold, "_fk").agg(F.count(F.lit(1)).alias("_cf"))
    tot = per.groupBy("_fk").agg(F.sum("_cf").alias("_cv"))
    nf = d.groupBy(fold).agg(F.count(F.lit(1)).alias("_nf"))
    n_all = nf.agg(F.sum("_nf").alias("_n")).withColumn("_j", F.lit(0))
    enc = (per.join(tot, "_fk").join(F.broadcast(nf), fold)
              .withColumn("_j", F.lit(0)).join(F.broadcast(n_all), "_j")
              .select(fold, "_fk", ((F.col("_cv") - F.col("_cf")) /
                                    F.greatest(F.col("_n") - F.col("_nf"), F.lit(1))).alias(out)))
    return d.join(enc, [fold, "_fk"], "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).drop("_fk")


# ------------------------------------------------------------------ C8
def rank_quantile_bin(df: DataFrame, column: str, q: int = 64, id_col: str = "SK_ID_CURR",
                      out: str | None = None) -> DataFrame:
    """``qcut(rank(method="first"), q, labels=False)`` in integer arithmetic.

    r = unique rank (ties by id), n = non-missing rows;
    bin = max(((r - 1) * q + n - 2) div (n - 1) - 1, 0); n == 1 -> 0; missing -> NULL.
    """
    out = out or f"{column}_QBIN"
    r = with_row_number(df.select(id_col, column), column, [id_col], out="_r")
    n, rr = F.col("n"), F.col("_r")
    b = F.when(n <= 1, F.lit(0)).otherwise(
        F.greatest(F.floor(((rr - 1) * q + n - 2) / (n - 1)) - 1, F.lit(0)))
    r = r.select(id_col, b.cast("int").alias(out))
    return df.join(r, id_col, "left")


# ------------------------------------------------------------------ C9 / C10
def safe_qcut_edges(df: DataFrame, columns: Sequence[str], q_max: int = 10, q_min: int = 2,
                    min_bin: int = 200) -> dict[str, list[float] | None]:
    """Per column, the largest q in [q_min, q_max] whose quantile bins all hold >= min_bin rows
    (q_min itself is accepted as is; a column without two distinct edges gets the ALL bin).

    Returns the chosen (deduplicated) edge list per column, or None (single ALL bin).
    """
    return edges_of_counts(C.ranked(C.count_table(df, columns)), columns, q_max, q_min, min_bin)


def edges_of_counts(values: DataFrame, columns: Sequence[str], q_max: int = 10, q_min: int = 2,
                    min_bin: int = 200) -> dict[str, list[float] | None]:
    """C9 from the ranked counts of all columns: two grouped aggregations over distinct values.

    The first reads every quantile that some q needs, the second the running row count at each of them; a bin holds
    the difference of two.  One row per column reaches the driver.
    """
    qs = list(range(q_max, q_min - 1, -1))
    probs = sorted({i / q for q in qs for i in range(q + 1)})
    quantiles = C.quantile_columns(probs, own=F.col("rows"), running=F.col("cum_rows"), total=F.col("n_rows"))
    nums = values.where(F.col("num").isNotNull())
    edges = cut_lineage(nums.groupBy("feature").agg(F.array(*quantiles).alias("e")))
    at = [F.max(F.when(F.col("num") <= F.col("e")[j], F.col("cum_rows"))) for j in range(len(probs))]
    counts = nums.join(F.broadcast(edges), "feature").groupBy("feature").agg(F.array(*at).alias("at"))
    chosen: dict[str, list[float] | None] = {c: None for c in columns}
    for r in edges.join(counts, "feature").collect():
        running = dict(zip(r["e"], r["at"]))
        for q in qs:
            e = sorted({r["e"][probs.index(i / q)] for i in range(q + 1)})
            if len(e) < 2:
                continue
            held = [running[b] - (running[a] if i else 0) for i, (a, b) in enumerate(zip(e, e[1:]))]
            if min(held) >= min_bin or q == q_min:  # the smallest q is accepted whatever its bin sizes
                chosen[r["feature"]] = [float(x) for x in e]
                break
    return chosen


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bins over sorted edges, first bin includes the lowest edge.

    Returns 0..len(edges)-2, NULL outside the range or for missing.
    """
    e = list(edges)
    expr = None
    for i in range(len(e) - 1):
        lo_ok = (x >= F.lit(e[i])) if i == 0 else (x > F.lit(e[i]))
        cond = lo_ok & (x <= F.lit(e[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr if expr is not None else F.lit(None).cast("int")


def safe_qcut(df: DataFrame, columns: Sequence[str], edges: dict[str, list[float] | None] | None = None,
              fit_df: DataFrame | None = None, suffix: str = "_BIN", **kw) -> DataFrame:
    """C9 transform: string bin labels ``b{i}``, missing -> 'NA', unfittable column -> 'ALL'."""
    edges = edges if edges is not None else safe_qcut_edges(fit_df if fit_df is not None else df, columns, **kw)
    cols = []
    for c in columns:
        e = edges.get(c)
        if e is None:
            lab = F.when(F.col(c).isNull(), F.lit("NA")).otherwise(F.lit("ALL"))
        else:
            b = bin_index(F.col(c).cast("double"), e)
            lab = (F.when(F.col(c).isNull(), F.lit("NA"))
                   .when(b.isNull() & (F.col(c) < e[0]), F.lit("b0"))
                   .when(b.isNull(), F.lit(f"b{len(e) - 2}"))
                   .otherwise(F.concat(F.lit("b"), b.cast("string"))))
        cols.append(lab.alias(f"{c}{suffix}"))
    return df.select("*", *cols)


def equal_width_bin(df: DataFrame, column: str, bins: int = 10, include_lowest: bool = True,
                    out: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max], right-closed.

    ``include_lowest=False`` reproduces the reference, whose minimum falls
    outside every bin (NULL).  min/max come from a one-row aggregate that is
    broadcast (bounded by construction).
    """
    out = out or f"{column}_WBIN"
    mm = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi")).withColumn("_j", F.lit(0))
    x = F.col(column).cast("double")
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    width = (hi - lo) / bins
    raw = F.ceil((x - lo) / width) - 1
    b = (F.when(x.isNull(), None)
         .when(hi == lo, F.lit(0))
         .when(x == lo, F.lit(0) if include_lowest else F.lit(None))
         .otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))))
    return (df.withColumn("_j", F.lit(0)).join(F.broadcast(mm), "_j")
              .withColumn(out, b.cast("int")).drop("_j", "_lo", "_hi"))


# ------------------------------------------------------------------ C11 / C12
def woe_table(long_bins: DataFrame, target: str = "TARGET", alpha: float = 0.5) -> DataFrame:
    """C11: WOE per (feature, bin) from a long (id, feature, bin, target) train frame.

    woe = ln(((neg + a) / (pos + a)) / ((N + a) / (P + a))), N/P = class totals.
    """
    per = long_bins.groupBy("feature", "bin").agg(
        F.sum(F.col(target)).alias("pos"), F.count(F.lit(1)).alias("cnt"))
    return _woe_of_cells(per, alpha)


def _woe_of_cells(cells: DataFrame, alpha: float) -> DataFrame:
    """(feature, bin, pos, cnt, woe) of (feature, bin, pos, cnt); class totals per feature are one row each."""
    tot = cells.groupBy(F.col("feature").alias("_f")).agg(F.sum("pos").alias("P"), F.sum("cnt").alias("T"))
    a = F.lit(alpha)
    neg, N = F.col("cnt") - F.col("pos"), F.col("T") - F.col("P")
    woe = F.log(((neg + a) / (F.col("pos") + a)) / ((N + a) / (F.col("P") + a)))
    return cells.join(F.broadcast(tot), F.col("feature") == F.col("_f")).select("feature", "bin", "pos", "cnt", woe.alias("woe"))


def melt(df: DataFrame, id_cols: Sequence[str], columns: Sequence[str], var: str = "feature",
         val: str = "value") -> DataFrame:
    """Wide -> long with one ``stack`` projection (no per-column jobs)."""
    if not columns:
        raise ValueError("no columns to melt")
    return df.unpivot(list(id_cols), list(columns), var, val)


@dataclass(frozen=True)
class WoeModel:
    """Edges of the numeric columns and the table (feature, bin, pos, cnt, woe) of the bins that train rows fill."""
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    edges: dict[str, list[float] | None]
    table: DataFrame


def fit_woe(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), target: str = "TARGET", q_max: int = 10,
            q_min: int = 2, min_bin: int = 200, alpha: float = 0.5, suffix: str = "_BIN") -> WoeModel:
    """C9 + C11 of all columns from one count table.

    Edges come from all rows of ``df``; WOE from the rows with a target.  A category is a bin, a missing one
    ``CATEGORY_GAP``; a missing number is the bin NA.
    """
    counts = C.count_table(df, numeric, categorical, target)
    values = C.ranked(counts)
    edges = edges_of_counts(values, numeric, q_max, q_min, min_bin)
    told = df.sparkSession.createDataFrame([(c, edges[c]) for c in numeric], "feature string, e array<double>")  # one row per column
    upper = F.slice("e", 2, F.size("e") - 2)  # inner edges: a bin is the number of them below the value
    place = _below(upper, F.col("num"))
    label = (F.when(F.col("cat") == MISSING, CATEGORY_GAP).when(F.col("cat").isNotNull(), F.col("cat"))
             .when(F.col("num").isNull(), "NA").when(F.col("e").isNull(), "ALL").otherwise(F.concat(F.lit("b"), place.cast("string"))))
    cells = (counts.where("w > 0").join(F.broadcast(told), "feature", "left")
             .groupBy("feature", label.alias("bin")).agg(F.sum("pos").alias("pos"), F.sum("w").alias("cnt")))
    return WoeModel(tuple(numeric), tuple(categorical), edges,
                    cut_lineage(_woe_of_cells(cells, alpha).withColumn("feature", F.concat("feature", F.lit(suffix)))))


def _below(edges: Column, x: Column) -> Column:
    """The number of edges below ``x``."""
    return F.size(F.filter(edges, lambda e: e < x))


def woe_transform(df: DataFrame, model: WoeModel, bin_suffix: str = "_BIN", suffix: str = "_WOE") -> DataFrame:
    """``{column}{bin_suffix}{suffix}`` for train and test rows; bins without train rows -> 0 (the global WOE).

    A projection: at most a dozen numbers per numeric column, and the codes of a category column of up to
    ``MOST_LITERALS`` categories, are written into the plan.  Larger dictionaries are joined.
    """
    of = {c: f"{c}{bin_suffix}" for c in (*model.numeric, *model.categorical)}
    sizes = {r["feature"]: r["count"] for r in model.table.groupBy("feature").count().collect()}  # one row per column
    small = [n for n in of.values() if sizes.get(n, 0) <= MOST_LITERALS]
    told: dict[str, dict[str, float]] = {n: {} for n in small}
    for r in model.table.where(F.col("feature").isin(small)).collect():
        told[r["feature"]][r["bin"]] = r["woe"]
    out, large = [], []
    for c in model.numeric:
        woe, e, x = told[of[c]], model.edges[c], F.col(c).cast("double")
        if e is None:
            value = F.lit(woe.get("ALL", 0.0))
        else:
            # looked up by the number of inner edges below the value: a branch per bin of all columns would make a
            # method too long for the JIT compiler
            by_bin = F.array(*[F.lit(woe.get(f"b{i}", 0.0)) for i in range(len(e) - 1)])
            tops = F.array(*[F.lit(float(top)) for top in e[1:-1]]).cast("array<double>")
            value = F.element_at(by_bin, _below(tops, x) + 1)
        out.append(F.when(x.isNull(), F.lit(woe.get("NA", 0.0))).otherwise(value).alias(f"{of[c]}{suffix}"))
    for c in model.categorical:
        key = F.coalesce(F.col(c).cast("string"), F.lit(CATEGORY_GAP))
        if of[c] in told:
            pairs = [F.lit(x) for pair in sorted(told[of[c]].items()) for x in pair]
            value = F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)
            out.append(value.alias(f"{of[c]}{suffix}"))
        else:
            large.append(c)
            out.append(key.alias(f"{of[c]}{suffix}"))
    res = df.select("*", *out)
    for c in large:
        name = f"{of[c]}{suffix}"
        d = model.table.where(F.col("feature") == of[c]).select(F.col("bin").alias("_v"), F.col("woe").alias("_w"))
        res = (res.join(d, F.col(name) == F.col("_v"), "left").withColumn(name, F.coalesce("_w", F.lit(0.0))).drop("_v", "_w"))
    return res


def scale_sparse(df: DataFrame, input_col: str = "features", output_col: str = "scaled"):
    """Divide every vector slot by its standard deviation without centring
    (keeps one-hot vectors sparse).  Returns (fitted scaler, frame)."""
    from pyspark.ml.feature import StandardScaler
    m = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=False, withStd=True).fit(df)
    return m, m.transform(df)


def rank_quantile_bins(df: DataFrame, columns: Sequence[str], q: int = 64, id_col: str = "SK_ID_CURR",
                       suffix: str = "_QBIN") -> DataFrame:
    """C8 for many columns at once (L9 input): one melted row-number plan grouped by
    feature, bins computed in integers, pivoted back with explicit column values."""
    long = melt(df.select(id_col, *[F.col(c).cast("double").alias(c) for c in columns]), [id_col], columns,
                "feature", "value")
    r = with_row_number(long, "value", [id_col], group=["feature"], out="_r")
    n, rr = F.col("n"), F.col("_r")
    b = F.when(n <= 1, F.lit(0)).otherwise(F.greatest(F.floor(((rr - 1) * q + n - 2) / (n - 1)) - 1, F.lit(0)))
    wide = (r.select(id_col, "feature", b.cast("int").alias("_b"))
             .groupBy(id_col).pivot("feature", list(columns)).agg(F.first("_b")))
    wide = wide.select(id_col, *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    return df.join(wide, id_col, "left")
