"""Q10: table integration on the customer key.

Main table + any number of feature tables, left-joined on the id; TARGET and
``split`` come from the main table only, so train and test end with the same
columns (B40 alignment is implicit when both travel in one frame).  Column
name clashes get a suffix instead of silently duplicating.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

ID, TARGET, SPLIT = "SK_ID_CURR", "TARGET", "split"


def integrate(main: DataFrame, others: Sequence[DataFrame], names: Sequence[str] | None = None,
              id_col: str = ID) -> DataFrame:
    out = main
    seen = set(main.columns)
    for i, o in enumerate(others):
        tag = names[i] if names else f"t{i}"
        keep = [c for c in o.columns if c not in (TARGET, SPLIT)]
        sel = []
        for c in keep:
            if c == id_col:
                sel.append(o[c])
            elif c in seen:
                sel.append(o[c].alias(f"{c}_{tag}"))
                seen.add(f"{c}_{tag}")
            else:
                sel.append(o[c])
                seen.add(c)
        out = out.join(o.select(*sel), id_col, "left")
    return out


def column_difference(train_cols: Sequence[str], test_cols: Sequence[str], target: str = TARGET) -> dict:
    """B40 report: columns only in train / only in test (TARGET excluded)."""
    a, b = set(train_cols) - {target}, set(test_cols)
    return {"train_only": sorted(a - b), "test_only": sorted(b - a)}
