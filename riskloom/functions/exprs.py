"""Column expressions (scalar, row-wise).  All return ``Column`` objects and stay
inside whole-stage codegen: no Python UDFs.

Missing values are SQL NULL throughout (NaN is normalised away at load time).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
# Day-count sentinel meaning "missing" in the credit tables.
DAYS_SENTINEL = 365243


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(a: str | Column, b: str | Column, zero: str = "null") -> Column:
    """a / b without ANSI errors.

    b != 0 -> a / b.  b == 0: ``zero="inf"`` gives +inf / -inf for a > 0 / a < 0 and
    NULL for 0/0 (the IEEE/pandas behaviour); ``zero="null"`` gives NULL.
    """
    a, b = col(a), col(b)
    out = F.when(b != 0, a.cast("double") / b)
    if zero == "inf":
        out = out.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    elif zero != "null":
        raise ValueError("zero must be 'inf' or 'null'")
    return out


def nullif(c: str | Column, value) -> Column:
    c = col(c)
    return F.when(c != F.lit(value), c)


def sentinel_to_null(c: str | Column, sentinel=DAYS_SENTINEL) -> Column:
    """B1: sentinel -> missing."""
    return nullif(c, sentinel)


def sentinel_flag(c: str | Column, sentinel=DAYS_SENTINEL) -> Column:
    """B2: 1 where the column holds the sentinel, else 0 (missing -> 0)."""
    return F.coalesce((col(c) == F.lit(sentinel)).cast("int"), F.lit(0))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 with missing -> 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip keeping NULL."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.when(c.isNull(), None).otherwise(F.greatest(out, F.lit(lo)))
    if hi is not None:
        out = F.when(c.isNull(), None).otherwise(F.least(out, F.lit(hi)))
    return out


def logit(p: str | Column, eps: float = 1e-6) -> Column:
    """log(p / (1 - p)) after clipping to [eps, 1 - eps]."""
    q = clip(p, eps, 1.0 - eps)
    return F.log(q / (F.lit(1.0) - q))


def sigmoid(z: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Row-wise sum with missing = 0."""
    if not cols:
        return F.lit(0)
    return sum((F.coalesce(col(c), F.lit(0)) for c in cols[1:]), F.coalesce(col(cols[0]), F.lit(0)))


def row_null_count(cols: Sequence[str | Column]) -> Column:
    """Number of missing values in a row."""
    if not cols:
        return F.lit(0)
    parts = [col(c).isNull().cast("int") for c in cols]
    return sum(parts[1:], parts[0])


def row_null_ratio(cols: Sequence[str | Column]) -> Column:
    """Share of missing values in a row."""
    return row_null_count(cols) / F.lit(float(max(len(cols), 1)))


def _present(cols: Sequence[str | Column]) -> Column:
    return F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda x: x.isNotNull())


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Row mean skipping missing; NULL when all missing."""
    arr = _present(cols)
    return F.when(F.size(arr) > 0,
                  F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr))


def row_std(cols: Sequence[str | Column]) -> Column:
    """Row standard deviation (ddof 1) skipping missing; NULL below two values."""
    arr = _present(cols)
    n = F.size(arr)
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / n
    ss = F.aggregate(arr, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def row_min(cols: Sequence[str | Column]) -> Column:
    return F.array_min(_present(cols))


def row_max(cols: Sequence[str | Column]) -> Column:
    return F.array_max(_present(cols))


def bround_int(c: str | Column, fill: int = 0) -> Column:
    """Half-even rounding, missing / non-finite -> fill, then int."""
    c = col(c)
    ok = c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.when(ok, F.bround(c, 0).cast("long")).otherwise(F.lit(fill).cast("long"))


def annuity_rate(n: str | Column, pmt: str | Column, pv: str | Column,
                 iterations: int = 55, lo: float = -0.5, hi: float = 1.0) -> Column:
    """Per-period rate r solving ``pv = pmt * (1 - (1 + r)^-n) / r``.

    Fixed-step bisection on the bracket (lo, hi) written as one Catalyst
    ``aggregate`` over a literal step array, so it is evaluated per row in
    codegen.  NULL when n <= 0, pmt <= 0, pv <= 0 or any input is missing;
    0 when pmt * n == pv exactly.  The present-value function decreases in r,
    so the step moves r up while the annuity is worth more than pv.
    """
    n, pmt, pv = col(n).cast("double"), col(pmt).cast("double"), col(pv).cast("double")
    start = (lo + hi) / 2.0
    first = (hi - lo) / 4.0
    steps = F.transform(F.sequence(F.lit(1), F.lit(iterations)),
                        lambda k: F.lit(first) / F.pow(F.lit(2.0), k - 1))

    def pv_gap(r: Column) -> Column:
        return pmt * (F.lit(1.0) - F.pow(F.lit(1.0) + r, -n)) / r - pv

    root = F.aggregate(steps, F.lit(start), lambda r, w: r + F.signum(pv_gap(r)) * w)
    valid = n.isNotNull() & pmt.isNotNull() & pv.isNotNull() & (n > 0) & (pmt > 0) & (pv > 0)
    return (F.when(~valid, F.lit(None).cast("double"))
            .when(pmt * n == pv, F.lit(0.0))
            .otherwise(root))


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Normalise NaN -> NULL on float columns (never store NaN)."""
    names = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and (names is None or f.name in names):
            out.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def days_to_years(c: str | Column) -> Column:
    """Relative day count (negative = past) -> years."""
    return col(c) / F.lit(-365.0)
