"""Declarative grouped aggregation.

A spec is ``{column: [fn, ...]}`` with fns from count, min, max, mean, sum,
nunique.  Output names are ``PREFIX + COLUMN_FN`` upper-cased, the prefix taken
literally (some reference prefixes carry no separator).

Several *windows* (all-history, a status subset, a recency filter) are computed
in ONE ``groupBy().agg()`` by conditional aggregation: each windowed aggregate
reads ``CASE WHEN cond THEN x END``.  That is one scan and one shuffle on the
key instead of one per window; partial (map-side) aggregation applies unless the
rows are dealt by key first (``by_key``).

Missing semantics (pandas-compatible):
  * sum over a group whose values are all missing -> 0 (not NULL);
  * a window in which the key has no row -> every aggregate NULL, counts too
    (the reference left-merges a block the key is absent from).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AggSpec = Mapping[str, Sequence[str]]

SUPPORTED = ("count", "min", "max", "mean", "sum", "nunique")


@dataclass(frozen=True)
class Window:
    """One aggregation window: a name prefix and an optional row condition
    (a SQL predicate string, or a Column)."""
    prefix: str
    cond: str | Column | None = None
    spec: AggSpec | None = None  # None -> use the block's spec
    extra: dict = field(default_factory=dict)


def feature_name(prefix: str, column: str, fn: str) -> str:
    return f"{prefix}{column}_{fn}".upper()


def _agg(fn: str, x: Column) -> Column:
    if fn == "count":
        return F.count(x)
    if fn == "min":
        return F.min(x)
    if fn == "max":
        return F.max(x)
    if fn == "mean":
        return F.avg(x)
    if fn == "sum":
        return F.sum(x)
    if fn == "nunique":
        return F.countDistinct(x)
    raise ValueError(f"unsupported aggregate {fn!r}; use one of {SUPPORTED}")


def _sum_zero(x: Column, dtype: str) -> Column:
    zero = F.lit(0.0) if dtype in ("double", "float") else F.lit(0).cast("long")
    return F.coalesce(F.sum(x), zero)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_agg(fn: str, x: str, dtype: str) -> str:
    if fn == "count":
        return f"count({x})"
    if fn in ("min", "max"):
        return f"{fn}({x})"
    if fn == "mean":
        return f"avg({x})"
    if fn == "sum":
        zero = "CAST(0 AS DOUBLE)" if dtype in ("double", "float") else "CAST(0 AS BIGINT)"
        return f"coalesce(sum({x}), {zero})"
    if fn == "nunique":
        return f"count(DISTINCT {x})"
    raise ValueError(f"unsupported aggregate {fn!r}; use one of {SUPPORTED}")


def spec_exprs(df: DataFrame, spec: AggSpec, prefix: str, cond: str | None = None) -> list[str]:
    """Aggregate expressions of one window as SQL text (``cond`` None = all rows).

    Text keeps plan construction to one call per expression instead of a
    dozen Column round trips; Catalyst sees the same expressions either way.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out: list[str] = []
    present = None if cond is None else f"count(CASE WHEN {cond} THEN 1 END) > 0"
    for column, fns in spec.items():
        if column not in types:
            raise KeyError(f"spec column {column!r} not in frame")
        x = _q(column) if cond is None else f"CASE WHEN {cond} THEN {_q(column)} END"
        for fn in fns:
            a = _sql_agg(fn, x, types[column])
            if present is not None:
                a = f"CASE WHEN {present} THEN {a} END"
            out.append(f"{a} AS {_q(feature_name(prefix, column, fn))}")
    return out


def spec_columns(df: DataFrame, spec: AggSpec, prefix: str,
                 cond: str | Column | None = None) -> list[Column]:
    """Aggregate columns for one window (``cond`` None = all rows)."""
    if cond is None or isinstance(cond, str):
        return [F.expr(e) for e in spec_exprs(df, spec, prefix, cond)]
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out: list[Column] = []
    present = F.count(F.when(cond, F.lit(1))) > 0
    for column, fns in spec.items():
        if column not in types:
            raise KeyError(f"spec column {column!r} not in frame")
        x = F.when(cond, F.col(column))
        for fn in fns:
            a = _sum_zero(x, types[column]) if fn == "sum" else _agg(fn, x)
            out.append(F.when(present, a).alias(feature_name(prefix, column, fn)))
    return out


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by key, so that the grouped aggregation behind it needs no further exchange.

    A block has more than a hundred aggregates and a key only some rows: partial states would be many times
    wider than the rows, and hardly fewer.  The rows themselves travel, once, before columns are derived from them.
    """
    return df.repartition(*keys)


def aggregate(df: DataFrame, key: str | Sequence[str], spec: AggSpec, prefix: str,
              windows: Sequence[Window] = ()) -> DataFrame:
    """Group by ``key`` and compute ``spec`` over all rows plus each window, in one pass.

    A spec with ``nunique`` on one column takes the two-level path
    (``_two_level``) instead of ``countDistinct``, whose Expand rewrite copies
    every input row once per distinct aggregate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = [(prefix, None, spec)] if prefix is not None else []
    parts += [(w.prefix, w.cond, w.spec or spec) for w in windows]
    distinct = {c for _, _, sp in parts for c, fns in sp.items() if "nunique" in fns}
    if len(distinct) == 1:
        return _two_level(df, keys, parts, distinct.pop())
    cols = []
    for pre, cond, sp in parts:
        cols += spec_columns(df, sp, pre, cond)
    return df.groupBy(*keys).agg(*cols)


def _two_level(df: DataFrame, keys: list[str], parts, dcol: str) -> DataFrame:
    """Exact aggregation with one distinct column, without Expand.

    Level 1 groups by (key, dcol) and keeps mergeable partial states (count,
    sum, min, max, window row counts); level 2 groups by key, merges them and
    counts the dcol values present (per window).  Rows dealt by (key, dcol) need
    no exchange before level 1; level 2 combines the states of a key map-side.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    l1, l2 = [], []
    for wi, (pre, cond, sp) in enumerate(parts):
        if cond is not None and not isinstance(cond, str):
            raise TypeError("two-level aggregation takes SQL string window conditions")
        l1.append(("count(1)" if cond is None else f"count(CASE WHEN {cond} THEN 1 END)") + f" AS _r{wi}")
        present = None if cond is None else f"sum(_r{wi}) > 0"
        for ci, (column, fns) in enumerate(sp.items()):
            x = _q(column) if cond is None else f"CASE WHEN {cond} THEN {_q(column)} END"
            tag = f"{wi}_{ci}"
            need = set(fns)
            if "mean" in need or "count" in need:
                l1.append(f"count({x}) AS _c{tag}")
            if "mean" in need or "sum" in need:
                l1.append(f"sum({x}) AS _s{tag}")
            if "min" in need:
                l1.append(f"min({x}) AS _mn{tag}")
            if "max" in need:
                l1.append(f"max({x}) AS _mx{tag}")
            if "nunique" in need and column != dcol:
                raise ValueError("two-level path supports one distinct column")
            for fn in fns:
                if fn == "count":
                    a = f"sum(_c{tag})"
                elif fn == "sum":
                    zero = "CAST(0 AS DOUBLE)" if types[column] in ("double", "float") else "CAST(0 AS BIGINT)"
                    a = f"coalesce(sum(_s{tag}), {zero})"
                elif fn == "mean":
                    a = f"CAST(sum(_s{tag}) AS DOUBLE) / sum(_c{tag})"
                elif fn == "min":
                    a = f"min(_mn{tag})"
                elif fn == "max":
                    a = f"max(_mx{tag})"
                elif fn == "nunique":
                    a = f"count(CASE WHEN _r{wi} > 0 THEN {_q(dcol)} END)"
                else:
                    raise ValueError(fn)
                if present is not None:
                    a = f"CASE WHEN {present} THEN {a} END"
                l2.append(f"{a} AS {_q(feature_name(pre, column, fn))}")
    lvl1 = df.groupBy(*keys, dcol).agg(*[F.expr(e) for e in l1])
    return lvl1.groupBy(*keys).agg(*[F.expr(e) for e in l2])


def feature_names(spec: AggSpec, prefix: str) -> list[str]:
    return [feature_name(prefix, c, fn) for c, fns in spec.items() for fn in fns]
