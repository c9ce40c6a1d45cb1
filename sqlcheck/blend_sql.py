"""Oracle SQL for folds, weights, blends and binning."""

from __future__ import annotations

from .fixtures_sql import with_fixtures
from .specsql import canon

MODELS = ["m1", "m2", "m3", "m4"]
WEIGHTS = {"m1": 0.79, "m2": 0.77, "m3": 0.78, "m4": 0.5}


def _h(seed: int, col: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({col} AS VARCHAR)), 1, 15))::BIGINT"


def folds_sql(k: int = 5, seed: int = 42) -> str:
    body = with_fixtures("app") + (
        f"SELECT SK_ID_CURR, TARGET, ((row_number() OVER (PARTITION BY TARGET ORDER BY {_h(seed, 'SK_ID_CURR')}, "
        f"SK_ID_CURR) - 1) % {k})::INTEGER AS fold FROM app WHERE split = 'train'")
    return body


def folds_canon(k: int = 5, seed: int = 42) -> str:
    return canon(folds_sql(k, seed), ["SK_ID_CURR", "TARGET", "fold"], {"SK_ID_CURR", "TARGET", "fold"})


def pos_weight_sql(cap: float = 50.0) -> str:
    body = (f"WITH f AS ({folds_sql()}), c AS (SELECT fold, sum((TARGET = 0)::INTEGER) AS n0, "
            f"sum((TARGET = 1)::INTEGER) AS p0 FROM f GROUP BY fold), "
            f"t AS (SELECT fold, (SELECT sum(n0) FROM c) - n0 AS neg, (SELECT sum(p0) FROM c) - p0 AS pos FROM c) "
            f"SELECT fold, neg, pos, CASE WHEN pos > 0 THEN least(neg::DOUBLE / pos, {cap}) END AS pos_weight FROM t")
    return canon(body, ["fold", "neg", "pos", "pos_weight"], {"fold", "neg", "pos"})


def undersample_sql(ratio: float = 3.0, seed: int = 42) -> str:
    body = with_fixtures("app", extra={"tr": "SELECT * FROM app WHERE split = 'train'"}) + (
        f"SELECT SK_ID_CURR, TARGET FROM tr WHERE TARGET = 1 UNION ALL "
        f"SELECT SK_ID_CURR, TARGET FROM (SELECT SK_ID_CURR, TARGET, row_number() OVER (ORDER BY "
        f"{_h(seed, 'SK_ID_CURR')}, SK_ID_CURR) AS rn FROM tr WHERE TARGET = 0) "
        f"WHERE rn <= floor((SELECT count(*) FROM tr WHERE TARGET = 1) * {ratio})")
    return canon(body, ["SK_ID_CURR", "TARGET"], {"SK_ID_CURR", "TARGET"})


def _complete() -> str:
    return (with_fixtures("preds", extra={
        "ok": f"SELECT id FROM preds WHERE model IN ({', '.join(repr(m) for m in MODELS)}) GROUP BY id "
              f"HAVING count(DISTINCT model) = {len(MODELS)}",
        "c": "SELECT p.* FROM preds p SEMI JOIN ok USING (id)",
        "r": "SELECT id, model, pred, (rank() OVER (PARTITION BY model ORDER BY pred) + "
             "(count(*) OVER (PARTITION BY model, pred) - 1) / 2.0) / count(*) OVER (PARTITION BY model) AS rk FROM c",
        "a": "SELECT id, list(pred ORDER BY model) AS v, list(rk ORDER BY model) AS rv FROM r GROUP BY id"}))


def _clip(x: str, eps: float = 1e-6) -> str:
    return f"least(greatest({x}, {eps}), {1 - eps})"


def _wmean(col: str) -> str:
    s = sum(WEIGHTS[m] for m in MODELS)
    ws = [WEIGHTS[m] / s for m in sorted(MODELS)]
    return " + ".join(f"{col}[{i + 1}] * {w!r}" for i, w in enumerate(ws))


def blend_body(method: str, power: float = 1.0, trim_frac: float = 0.1) -> str:
    m = len(MODELS)
    col = "rv" if method.startswith("rank_") else "v"
    base = method.replace("rank_", "")
    if base == "mean":
        e = f"list_avg({col})"
    elif base == "median":
        e = f"(list_sort({col})[{(m - 1) // 2 + 1}] + list_sort({col})[{m // 2 + 1}]) / 2.0"
    elif base == "trimmed_mean":
        k = int(trim_frac * m)
        e = f"list_avg({col})" if k == 0 else f"list_avg(list_slice(list_sort({col}), {k + 1}, {m - k}))"
    elif base == "weighted_mean":
        e = _wmean(col)
    elif base == "power_mean":
        if power == 0:
            e = f"exp(list_avg(list_transform({col}, lambda x: ln(greatest(x, 1e-12)))))"
        else:
            e = f"pow(list_avg(list_transform({col}, lambda x: pow(x, {power}))), {1.0 / power})"
    elif base == "logit_mean":
        z = f"list_transform({col}, lambda x: ln({_clip('x')} / (1 - {_clip('x')})))"
        e = f"1.0 / (1.0 + exp(-list_avg({z})))"
    else:
        raise ValueError(method)
    return _complete() + f"SELECT id, {_clip(e)} AS pred FROM a"


def blend_sql(method: str, power: float = 1.0, trim_frac: float = 0.1) -> str:
    return canon(blend_body(method, power, trim_frac), ["id", "pred"], {"id"})


def alpha_blend_sql() -> str:
    a = blend_body("rank_mean")
    b = blend_body("weighted_mean")
    body = f"SELECT id, 0.5 * x.pred + 0.5 * y.pred AS pred FROM ({a}) x JOIN ({b}) y USING (id)"
    return canon(body, ["id", "pred"], {"id"})


def pct_rank_sql() -> str:
    body = with_fixtures("preds") + (
        "SELECT id, model, (rank() OVER (PARTITION BY model ORDER BY pred) + "
        "(count(*) OVER (PARTITION BY model, pred) - 1) / 2.0) / count(*) OVER (PARTITION BY model) AS rank FROM preds")
    return canon(body, ["id", "model", "rank"], {"id"}, strings={"model"})


def balanced_sql() -> str:
    body = with_fixtures("app", extra={"tr": "SELECT SK_ID_CURR, TARGET FROM app WHERE split = 'train'"}) + (
        "SELECT SK_ID_CURR, TARGET, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY TARGET)) AS weight FROM tr")
    return canon(body, ["SK_ID_CURR", "TARGET", "weight"], {"SK_ID_CURR", "TARGET"})


def _auc_weighted(select: str) -> str:
    """``select`` over r (id, model, clipped p, rank rk) and auc (model, w on the labelled train ids)."""
    from .fixtures_sql import APPLICATION, PREDS
    ms = ", ".join(repr(m) for m in MODELS)
    return (f"WITH preds AS ({PREDS}), app AS ({APPLICATION}), "
            f"lab AS (SELECT p.model, p.pred, a.TARGET FROM preds p JOIN app a ON p.id = a.SK_ID_CURR "
            f"  WHERE a.split = 'train'), "
            f"lr AS (SELECT model, TARGET, rank() OVER (PARTITION BY model ORDER BY pred) + "
            f"  (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS ar FROM lab), "
            f"auc AS (SELECT model, (sum(CASE WHEN TARGET = 1 THEN ar ELSE 0 END) - sum(TARGET) * (sum(TARGET) + 1) / 2.0)"
            f"  / (sum(TARGET)::DOUBLE * (count(*) - sum(TARGET))) AS w FROM lr GROUP BY model), "
            f"ok AS (SELECT id FROM preds WHERE model IN ({ms}) GROUP BY id HAVING count(DISTINCT model) = {len(MODELS)}), "
            f"c AS (SELECT p.* FROM preds p SEMI JOIN ok USING (id)), "
            f"r AS (SELECT id, model, least(greatest(pred, 0), 1) AS p, (rank() OVER (PARTITION BY model ORDER BY pred) + "
            f"  (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0) / count(*) OVER (PARTITION BY model) AS rk FROM c) {select}")


def auc_weighted_blend_sql(rank: bool = True) -> str:
    """Per-model AUC (labelled train ids) as weights of a blend of ranks, or of predictions clipped to [0, 1]."""
    return canon(_auc_weighted(f"SELECT id, sum(r.{'rk' if rank else 'p'} * auc.w) / sum(auc.w) AS pred "
                               "FROM r JOIN auc USING (model) GROUP BY id"), ["id", "pred"], {"id"})


def auc_weighted_run_sql() -> str:
    """Q16: both blends."""
    return canon(_auc_weighted("SELECT id, sum(p * w) / sum(w) AS probability, sum(rk * w) / sum(w) AS rank "
                               "FROM r JOIN auc USING (model) GROUP BY id"), ["id", "probability", "rank"], {"id"})


def auc_shares_sql() -> str:
    """(model, weight): AUC over the sum of AUCs."""
    return _auc_weighted("SELECT model, w / sum(w) OVER () AS weight FROM auc")


def weight_sources_sql() -> str:
    """Weights by hand with m4 counting 1, and equal ones."""
    from .fixtures_sql import PREDS
    hand = {m: WEIGHTS[m] if m != "m4" else 1.0 for m in MODELS}
    rows = ", ".join([f"('hand', '{m}', {w / sum(hand.values())!r})" for m, w in hand.items()]
                     + [f"('equal', '{m}', {1 / len(MODELS)!r})" for m in MODELS])
    body = (f"WITH preds AS ({PREDS}), w AS (SELECT * FROM (VALUES {rows}) t(given, model, weight)), "
            "a AS (SELECT model, avg(pred) AS mean FROM preds GROUP BY model) "
            "SELECT given, model, weight, weight * mean AS part FROM w JOIN a USING (model)")
    return canon(body, ["given", "model", "weight", "part"], set(), strings={"given", "model"})
