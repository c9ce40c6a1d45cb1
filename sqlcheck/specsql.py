"""Render aggregation specs as DuckDB SQL (oracle side only)."""

from __future__ import annotations


def fname(prefix: str, column: str, fn: str) -> str:
    return f"{prefix}{column}_{fn}".upper()


def _agg(fn: str, x: str, integral: bool) -> str:
    if fn == "count":
        return f"count({x})"
    if fn == "nunique":
        return f"count(DISTINCT {x})"
    if fn == "mean":
        return f"avg({x})"
    if fn == "min":
        return f"min({x})"
    if fn == "max":
        return f"max({x})"
    if fn == "sum":
        return f"coalesce(sum({x}), 0)::BIGINT" if integral else f"coalesce(sum({x}), 0.0)::DOUBLE"
    raise ValueError(fn)


def spec_sql(spec: dict, prefix: str, cond: str | None = None,
             int_cols: set[str] = frozenset()) -> tuple[list[str], set[str]]:
    """Return (select items, integral output names) for one window."""
    items, ints = [], set()
    for col, fns in spec.items():
        x = col if cond is None else f"CASE WHEN {cond} THEN {col} END"
        integral_in = col in int_cols
        for fn in fns:
            a = _agg(fn, x, integral_in)
            if cond is not None:
                a = f"CASE WHEN count(CASE WHEN {cond} THEN 1 END) > 0 THEN {a} END"
            name = fname(prefix, col, fn)
            items.append(f"{a} AS {name}")
            if fn in ("count", "nunique") or (integral_in and fn in ("min", "max", "sum")):
                ints.add(name)
    return items, ints


def canon(inner: str, columns: list[str], ints: set[str], strings: set[str] = frozenset()) -> str:
    """Outer SELECT: integral -> BIGINT, fractional -> DOUBLE rounded to 6 places."""
    out = []
    for c in columns:
        if c in strings:
            out.append(c)
        elif c in ints:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(f"round(CAST({c} AS DOUBLE) + 3.7e-8, 6) AS {c}")
    return f"SELECT {', '.join(out)} FROM (\n{inner}\n) q"


def names_of(items: list[str]) -> list[str]:
    return [i.rsplit(" AS ", 1)[1].strip() for i in items]
