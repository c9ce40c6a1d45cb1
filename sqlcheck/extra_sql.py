"""Oracle SQL for encoders, summaries, reports and integration."""

from __future__ import annotations

from .application_sql import LABELS, v7_body, v7_sql
from .blend_sql import MODELS, WEIGHTS, folds_sql
from .blocks_sql import assembly_sql, prev_block_sql
from .encode_sql import financial_sql
from .fixtures_sql import APPLICATION, PREDS, with_fixtures
from .specsql import canon
from .stats_sql import NUM_COLS, dtype

MISSING = "'__MISSING__'"


def label_sorted_sql() -> str:
    codes = ", ".join(f"(dense_rank() OVER (ORDER BY coalesce({c}, {MISSING})) - 1)::INTEGER AS {c}" for c in LABELS)
    body = with_fixtures("app") + f"SELECT SK_ID_CURR, {codes} FROM app"
    return canon(body, ["SK_ID_CURR", *LABELS], {"SK_ID_CURR", *LABELS})


def label_train_sql() -> str:
    extra = {}
    joins, sel = [], []
    for i, c in enumerate(LABELS):
        extra[f"d{i}"] = (f"SELECT cat, (dense_rank() OVER (ORDER BY cat) - 1)::INTEGER AS code FROM "
                          f"(SELECT DISTINCT coalesce({c}, {MISSING}) AS cat FROM app WHERE split = 'train')")
        joins.append(f"LEFT JOIN d{i} ON coalesce(app.{c}, {MISSING}) = d{i}.cat")
        sel.append(f"coalesce(d{i}.code, -1) AS {c}")
    body = with_fixtures("app", extra=extra) + f"SELECT app.SK_ID_CURR, app.split, {', '.join(sel)} FROM app {' '.join(joins)}"
    return canon(body, ["SK_ID_CURR", "split", *LABELS], {"SK_ID_CURR", *LABELS}, strings={"split"})


def oof_frequency_sql() -> str:
    c = "NAME_TYPE_SUITE"
    body = (f"WITH f AS ({folds_sql()}), app AS ({APPLICATION}), "
            f"d AS (SELECT a.SK_ID_CURR, a.TARGET, a.{c}, f.fold, coalesce(a.{c}, {MISSING}) AS v FROM app a "
            f"  JOIN f USING (SK_ID_CURR) WHERE a.split = 'train'), "
            f"per AS (SELECT fold, v, count(*) AS cf FROM d GROUP BY fold, v), "
            f"tot AS (SELECT v, sum(cf) AS cv FROM per GROUP BY v), "
            f"nf AS (SELECT fold, count(*) AS n_f FROM d GROUP BY fold), "
            f"enc AS (SELECT per.fold, per.v, (tot.cv - per.cf)::DOUBLE / greatest((SELECT count(*) FROM d) - nf.n_f, 1) AS e "
            f"  FROM per JOIN tot USING (v) JOIN nf USING (fold)) "
            f"SELECT d.SK_ID_CURR, d.TARGET, d.{c}, d.fold, coalesce(enc.e, 0.0) AS {c}_FREQ FROM d "
            f"LEFT JOIN enc ON d.fold = enc.fold AND d.v = enc.v")
    return canon(body, ["SK_ID_CURR", "TARGET", c, "fold", f"{c}_FREQ"], {"SK_ID_CURR", "TARGET", "fold"},
                 strings={c})


def mean_std_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std FROM app"
             for c in NUM_COLS]
    body = with_fixtures("app") + " UNION ALL ".join(parts)
    return canon(body, ["feature", "mean", "std"], set(), strings={"feature"})


def top_k_sql() -> str:
    body, _, _ = prev_block_sql()
    inner = f"SELECT SK_ID_CURR, PREV_AMT_CREDIT_SUM FROM ({body}) ORDER BY PREV_AMT_CREDIT_SUM DESC, SK_ID_CURR LIMIT 10"
    return canon(inner, ["SK_ID_CURR", "PREV_AMT_CREDIT_SUM"], {"SK_ID_CURR"})


def binned_rate_sql() -> str:
    x = "AMT_INCOME_TOTAL::DOUBLE"
    b = (f"CASE WHEN {x} IS NULL THEN NULL WHEN hi = lo THEN 0 WHEN {x} = lo THEN 0 "
         f"ELSE least(greatest(ceil(({x} - lo) / ((hi - lo) / 10)) - 1, 0), 9) END")
    body = with_fixtures("app", extra={
        "tr": "SELECT * FROM app WHERE split = 'train'",
        "mm": "SELECT min(AMT_INCOME_TOTAL)::DOUBLE AS lo, max(AMT_INCOME_TOTAL)::DOUBLE AS hi FROM tr"}) + (
        f"SELECT ({b})::INTEGER AS AMT_INCOME_TOTAL_WBIN, count(*) AS count, avg(TARGET) AS default_rate "
        f"FROM tr, mm GROUP BY 1")
    return canon(body, ["AMT_INCOME_TOTAL_WBIN", "count", "default_rate"], {"AMT_INCOME_TOTAL_WBIN", "count"})


def blend_report_sql(shares: str | None = None) -> str:
    ms = ", ".join(repr(m) for m in MODELS)
    s = sum(WEIGHTS[m] for m in MODELS)
    wv = ", ".join(f"('{m}', {WEIGHTS[m] / s!r})" for m in sorted(MODELS))
    body = (f"WITH preds AS ({PREDS}), "
            f"ok AS (SELECT id FROM preds WHERE model IN ({ms}) GROUP BY id HAVING count(DISTINCT model) = {len(MODELS)}), "
            f"c AS (SELECT p.* FROM preds p SEMI JOIN ok USING (id)), "
            f"st AS (SELECT model, avg(pred) AS mean, stddev_samp(pred) AS std FROM c GROUP BY model), "
            f"r AS (SELECT id, model, rank() OVER (PARTITION BY model ORDER BY pred) + "
            f"  (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS rk FROM c), "
            f"pc AS (SELECT a.model AS ma, b.model AS mb, corr(a.rk, b.rk) AS rho FROM r a JOIN r b "
            f"  ON a.id = b.id AND a.model <> b.model GROUP BY a.model, b.model), "
            f"sp AS (SELECT ma AS model, avg(rho) AS avg_spearman FROM pc GROUP BY ma), "
            f"w AS ({shares or f'SELECT * FROM (VALUES {wv}) t(model, weight)'}) "
            f"SELECT w.model, w.weight, st.mean, st.std, sp.avg_spearman FROM w JOIN st USING (model) "
            f"LEFT JOIN sp USING (model)")
    return canon(body, ["model", "weight", "mean", "std", "avg_spearman"], set(), strings={"model"})


def integration_sql() -> str:
    return (f"SELECT v.*, a.* EXCLUDE (SK_ID_CURR, split, TARGET), f.* EXCLUDE (SK_ID_CURR) "
            f"FROM ({v7_sql()}) v LEFT JOIN ({assembly_sql()}) a ON v.SK_ID_CURR = a.SK_ID_CURR "
            f"LEFT JOIN ({financial_sql()}) f ON v.SK_ID_CURR = f.SK_ID_CURR")


def onehot_long_sql() -> str:
    cats = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS v FROM app WHERE {c} IS NOT NULL GROUP BY {c} "
        f"HAVING count(DISTINCT split) = (SELECT count(DISTINCT split) FROM app)" for c in LABELS)
    body = with_fixtures("app", extra={
        "cats": cats,
        "l": f"SELECT * FROM (SELECT SK_ID_CURR, {', '.join(LABELS)} FROM app) "
             f"UNPIVOT INCLUDE NULLS (val FOR col IN ({', '.join(LABELS)}))"}) + (
        "SELECT l.SK_ID_CURR, cats.col || '_' || cats.v AS feature, coalesce((l.val = cats.v)::INTEGER, 0) AS value "
        "FROM l JOIN cats ON l.col = cats.col")
    return canon(body, ["SK_ID_CURR", "feature", "value"], {"SK_ID_CURR", "value"}, strings={"feature"})


def kde_sql(points: int = 200) -> str:
    """Every row's kernel at every grid point."""
    cols = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM_COLS)
    body = with_fixtures("app", extra={
        "l": f"SELECT * FROM (SELECT TARGET AS y, {cols} FROM app WHERE split = 'train') UNPIVOT (x FOR feature IN ({', '.join(NUM_COLS)}))",
        "r": "SELECT feature, min(x) AS lo, max(x) AS hi FROM l GROUP BY feature",
        "st": "SELECT feature, y, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h FROM l GROUP BY feature, y",
        "g": f"SELECT feature, i, lo + (hi - lo) / {points - 1} * i AS g FROM r, range({points}) t(i)",
        "v": "SELECT feature, y, x, count(*) AS c FROM l GROUP BY ALL",
    }) + ("SELECT v.feature, v.y, g.i, g.g, sum(v.c * exp(-0.5 * pow((v.x - g.g) / st.h, 2))) / any_value(st.n * st.h * sqrt(2 * pi())) AS density "
          "FROM v JOIN st USING (feature, y) JOIN g USING (feature) WHERE st.h > 0 GROUP BY v.feature, v.y, g.i, g.g")
    return canon(body, ["feature", "y", "i", "g", "density"], {"y", "i"}, strings={"feature"})


def profile_sql(bins: int = 10) -> str:
    """Q14: counts and rates by value, and by equal-width bin without the minimum."""
    cols = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM_COLS)
    body = with_fixtures("app", extra={
        "l": f"SELECT * FROM (SELECT TARGET AS y, {cols} FROM app WHERE split = 'train') UNPIVOT (x FOR feature IN ({', '.join(NUM_COLS)}))",
        "r": "SELECT feature, min(x) AS lo, max(x) AS hi FROM l GROUP BY feature",
        "b": f"SELECT feature, 'bin' AS kind, least(greatest(ceil((x - lo) / ((hi - lo) / {bins})) - 1, 0), {bins - 1})::INTEGER::VARCHAR AS bucket, y "
             "FROM l JOIN r USING (feature) WHERE x > lo",
        "c": f"SELECT feature, 'value' AS kind, v AS bucket, y FROM (SELECT TARGET AS y, {', '.join(LABELS)} FROM app WHERE split = 'train') "
             f"UNPIVOT (v FOR feature IN ({', '.join(LABELS)}))",
    }) + ("SELECT feature, kind, bucket, count(*) AS count, avg(y) AS default_rate FROM (SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY ALL")
    return canon(body, ["feature", "kind", "bucket", "count", "default_rate"], {"count"}, strings={"feature", "kind", "bucket"})


def versions_sql() -> str:
    """Q7: present values and sums of every column of v0..v7, each set written out."""
    from .application_sql import APP_COLS
    plain = [c for c in APP_COLS if c not in LABELS] + ["DAYS_EMPLOYED_ANOM", "MISS__OWN_CAR_AGE", "ROW_MISSING_RATIO"]
    domain = ["CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "GOODS_TO_INCOME", "ANNUITY_TO_CREDIT", "TERM_MONTHS_EST", "CREDIT_TO_GOODS", "INCOME_PER_PERSON"]
    age = ["EMPLOY_TO_AGE", "OWN_CAR_AGE_NORM", "CHILDREN_PER_10Y"]
    ext = ["EXT_MEAN", "EXT_STD", "EXT_MIN", "EXT_MAX", "EXT_MEAN_X_AGE", "EXT_MEAN_X_LOG_INCOME", "EXT_MISSING_CNT"]
    document = ["DOCS_SUBMITTED_CNT", "DOCS_ANY", "CONTACT_FLAGS_SUM"]
    region = ["REGION_RATING_DIFF", "ADDR_MISMATCH_SUM"]
    sets = {0: [], 2: domain, 3: age, 4: region, 5: ext, 6: document}
    rows = [(v, c) for v, cols in sets.items() for c in plain + cols]
    rows += [(1, c) for c in plain] + [(7, c) for c in plain + domain + age + ext + document]
    numbers = list(dict.fromkeys([*plain, *domain, *age, *ext, *document]))
    sums = [f"SELECT '{c}' AS feature, count({c}) AS present, sum({c})::DOUBLE AS total FROM w" for c in numbers]
    sums += [f"SELECT '{c}__CODE', count({c}), sum({c})::DOUBLE FROM w" for c in LABELS]
    sums += [f"SELECT feature, present, total::DOUBLE FROM (SELECT '{c}' AS feature, count({c}) AS present, sum({c}) AS total FROM rg)" for c in region]
    dummies = " UNION ALL ".join(
        f"SELECT '{c}_' || {c} AS feature, (SELECT count(*) FROM app) AS present, count(*)::DOUBLE AS total FROM app WHERE {c} IS NOT NULL "
        f"GROUP BY {c} HAVING count(DISTINCT split) = 2" for c in LABELS)
    addr = ["REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
            "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"]
    values = ", ".join(f"({v}, '{c}')" for v, c in rows + [(v, f"{c}__CODE") for v in (1, 7) for c in LABELS])
    body = with_fixtures("app", extra={
        "w": v7_body(),
        "rg": f"SELECT REGION_RATING_CLIENT - REGION_RATING_CLIENT_W_CITY AS REGION_RATING_DIFF, {' + '.join(f'coalesce({c}, 0)' for c in addr)} "
              "AS ADDR_MISMATCH_SUM FROM app",
        "s": " UNION ALL ".join(sums), "dm": dummies,
        "m": f"SELECT * FROM (VALUES {values}) t(version, feature) UNION ALL SELECT v, feature FROM dm, (VALUES (0), (2), (3), (4), (5), (6)) t(v)",
    }) + "SELECT m.version, m.feature, present, total FROM m JOIN (SELECT * FROM s UNION ALL SELECT * FROM dm) USING (feature)"
    return canon(body, ["version", "feature", "present", "total"], {"version", "present"}, strings={"feature"})


def prediction_files_sql() -> str:
    body = f"WITH preds AS ({PREDS}) SELECT id, model, pred FROM preds WHERE model IN ({', '.join(repr(m) for m in MODELS)})"
    return canon(body, ["id", "model", "pred"], {"id"}, strings={"model"})


def spearman_matrix_sql() -> str:
    ms = ", ".join(repr(m) for m in MODELS)
    body = (f"WITH preds AS ({PREDS}), "
            f"ok AS (SELECT id FROM preds WHERE model IN ({ms}) GROUP BY id HAVING count(DISTINCT model) = {len(MODELS)}), "
            f"c AS (SELECT p.* FROM preds p SEMI JOIN ok USING (id)), "
            f"r AS (SELECT id, model, rank() OVER (PARTITION BY model ORDER BY pred) + "
            f"  (count(*) OVER (PARTITION BY model, pred) - 1) / 2.0 AS rk FROM c) "
            f"SELECT a.model AS col_a, b.model AS col_b, corr(a.rk, b.rk) AS corr FROM r a JOIN r b ON a.id = b.id "
            f"GROUP BY a.model, b.model")
    return canon(body, ["col_a", "col_b", "corr"], set(), strings={"col_a", "col_b"})


def stage0_body() -> str:
    """Q11: audit over train (without TARGET) + test, plus the duplicate-column flag."""
    from .application_sql import APP_COLS, INT_APP
    cols = ["SK_ID_CURR"] + APP_COLS
    fam = {c: ("str" if c in LABELS else ("int" if c in INT_APP or c == "SK_ID_CURR" else "float")) for c in cols}
    pairs = [(c, p) for i, c in enumerate(cols) for p in cols[:i]
             if c != "SK_ID_CURR" and p != "SK_ID_CURR" and fam[c] == fam[p]]
    mism = ", ".join(f"count(*) FILTER (WHERE {c} IS DISTINCT FROM {p}) AS m{i}" for i, (c, p) in enumerate(pairs))
    pv = ", ".join(f"({i}, '{c}', '{p}')" for i, (c, p) in enumerate(pairs))
    stats = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{dtype(c)}' AS dtype, avg(({c} IS NULL)::INTEGER) AS missing_rate, count(DISTINCT {c}) AS nunique, "
        f"count(*) AS n FROM b" for c in cols)
    return with_fixtures("app", extra={
        "b": "SELECT * EXCLUDE (split, TARGET) FROM app",
        "st": f"SELECT feature, dtype, missing_rate, nunique, (nunique::DOUBLE / greatest(n, 1) <= 1e-8 OR nunique <= 1) "
              f"AS near_constant, (missing_rate > 0.98) AS high_missing FROM ({stats})",
        "mm": f"SELECT {mism} FROM b",
        "pm": f"SELECT * FROM (VALUES {pv}) t(i, col, prev)",
        "ml": f"SELECT * FROM (SELECT * FROM mm UNPIVOT (mis FOR k IN ({', '.join(f'm{i}' for i in range(len(pairs)))})))",
        "eq": "SELECT pm.col, pm.prev FROM ml JOIN pm ON ml.k = 'm' || pm.i WHERE ml.mis = 0",
        "dup": "SELECT DISTINCT eq.col FROM eq JOIN st a ON a.feature = eq.col JOIN st p ON p.feature = eq.prev "
               "WHERE NOT (a.near_constant OR a.high_missing) AND NOT (p.near_constant OR p.high_missing)",
    }) + ("SELECT st.*, (dup.col IS NOT NULL) AS duplicate FROM st LEFT JOIN dup ON st.feature = dup.col")


def stage0_sql() -> str:
    return canon(stage0_body(), ["feature", "dtype", "missing_rate", "nunique", "near_constant", "high_missing", "duplicate"],
                 {"nunique", "near_constant", "high_missing", "duplicate"}, strings={"feature", "dtype"})


def screening_run_sql() -> str:
    """Q13: the metrics of the passing features, where stage 1 has seen the columns that stage 0 keeps only."""
    return stage1_sql(f"SELECT feature FROM ({stage0_body()}) WHERE NOT (near_constant OR high_missing OR duplicate)",
                      "WHERE pass_stage1 = 1")


def stage1_sql(kept: str | None = None, where: str = "") -> str:
    """Q12: per feature missing rate, OOF single-feature AUC, binned MI, |Spearman|, pass flag."""
    from .application_sql import APP_COLS
    num = [c for c in APP_COLS if c not in LABELS]
    cats = list(LABELS)
    numc = ", ".join(f"{c}::DOUBLE AS {c}" for c in num)
    catlist = ", ".join(f"'{c}'" for c in cats)
    probs = ", ".join(f"{i}::DOUBLE / 10" for i in range(1, 10))
    rank = "rank() OVER (PARTITION BY {p} ORDER BY {o}) + (count(*) OVER (PARTITION BY {p}, {o}) - 1) / 2.0"
    body = (f"WITH f AS ({folds_sql()}), app AS ({APPLICATION}), "
            f"tr AS (SELECT a.*, f.fold FROM app a JOIN f USING (SK_ID_CURR) WHERE a.split = 'train'), "
            f"ln AS (SELECT * FROM (SELECT SK_ID_CURR, TARGET, fold, {numc} FROM tr) "
            f"  UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(num)}))), "
            f"lc AS (SELECT * FROM (SELECT SK_ID_CURR, TARGET, fold, {', '.join(cats)} FROM tr) "
            f"  UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(cats)}))), "
            # numeric OOF scores
            f"med_f AS (SELECT ln.feature, k.fold, quantile_cont(ln.value, 0.5) AS m FROM ln "
            f"  JOIN (SELECT DISTINCT fold FROM f) k ON ln.fold <> k.fold GROUP BY ln.feature, k.fold), "
            f"fl AS (SELECT ln.feature, ln.fold, ln.TARGET, coalesce(ln.value, med_f.m) AS v FROM ln "
            f"  LEFT JOIN med_f ON ln.feature = med_f.feature AND ln.fold = med_f.fold), "
            f"sn AS (SELECT feature, TARGET, ({rank.format(p='feature, fold', o='v')}) / "
            f"  count(*) OVER (PARTITION BY feature, fold) AS s FROM fl WHERE v IS NOT NULL), "
            # categorical OOF frequency scores
            f"cv AS (SELECT feature, fold, TARGET, coalesce(v, '__MISSING__') AS v FROM lc), "
            f"per AS (SELECT feature, fold, v, count(*) AS cf FROM cv GROUP BY ALL), "
            f"tot AS (SELECT feature, v, sum(cf) AS cvv FROM per GROUP BY ALL), "
            f"nf AS (SELECT feature, fold, count(*) AS n_f FROM cv GROUP BY ALL), "
            f"na AS (SELECT feature, count(*) AS n_a FROM cv GROUP BY ALL), "
            f"enc_c AS (SELECT per.feature, per.fold, per.v, (tot.cvv - per.cf)::DOUBLE / greatest(na.n_a - nf.n_f, 1) AS s "
            f"  FROM per JOIN tot USING (feature, v) JOIN nf USING (feature, fold) JOIN na USING (feature)), "
            f"sc AS (SELECT cv.feature, cv.TARGET, coalesce(enc_c.s, 0.0) AS s FROM cv LEFT JOIN enc_c "
            f"  ON cv.feature = enc_c.feature AND cv.fold = enc_c.fold AND cv.v = enc_c.v), "
            f"sall AS (SELECT * FROM sn UNION ALL SELECT * FROM sc), "
            f"ra AS (SELECT feature, TARGET, {rank.format(p='feature', o='s')} AS ar FROM sall), "
            f"auc0 AS (SELECT feature, (sum(CASE WHEN TARGET = 1 THEN ar ELSE 0 END) - sum(TARGET) * (sum(TARGET) + 1) / 2.0)"
            f"  / (sum(TARGET)::DOUBLE * (count(*) - sum(TARGET))) AS a FROM ra GROUP BY feature), "
            f"auc AS (SELECT feature, greatest(a, 1 - a) AS auc_single FROM auc0), "
            # encoded values: numeric as is, categorical as sorted codes over train + test
            f"allc AS (SELECT * FROM (SELECT {', '.join(cats)} FROM app) UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(cats)}))), "
            f"codes AS (SELECT feature, v, (dense_rank() OVER (PARTITION BY feature ORDER BY v) - 1)::DOUBLE AS code "
            f"  FROM (SELECT DISTINCT feature, coalesce(v, '__MISSING__') AS v FROM allc)), "
            f"enc AS (SELECT feature, TARGET, value FROM ln UNION ALL SELECT lc.feature, lc.TARGET, codes.code FROM lc "
            f"  JOIN codes ON lc.feature = codes.feature AND coalesce(lc.v, '__MISSING__') = codes.v), "
            f"med AS (SELECT feature, quantile_cont(value, 0.5) AS m FROM enc WHERE value IS NOT NULL GROUP BY feature), "
            f"dec AS (SELECT feature, quantile_cont(value, [{probs}]) AS e FROM enc WHERE value IS NOT NULL GROUP BY feature), "
            f"xb AS (SELECT enc.feature, enc.TARGET, CASE WHEN enc.feature IN ({catlist}) THEN coalesce(enc.value, med.m) "
            f"  ELSE len(list_filter(dec.e, lambda q: q < coalesce(enc.value, med.m)))::DOUBLE END AS x "
            f"  FROM enc LEFT JOIN med USING (feature) LEFT JOIN dec USING (feature)), "
            f"jx AS (SELECT feature, x, TARGET, count(*) AS nxy FROM xb GROUP BY ALL), "
            f"kx AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, x) AS nx, sum(nxy) OVER (PARTITION BY feature, TARGET) AS ny, "
            f"  sum(nxy) OVER (PARTITION BY feature) AS n FROM jx), "
            f"mi AS (SELECT feature, sum((nxy::DOUBLE / n) * ln(nxy::DOUBLE * n / (nx::DOUBLE * ny))) AS mi FROM kx GROUP BY feature), "
            f"rr AS (SELECT feature, {rank.format(p='feature', o='value')} AS rx, {rank.format(p='feature', o='TARGET')} AS ry "
            f"  FROM enc WHERE value IS NOT NULL AND TARGET IS NOT NULL), "
            f"rho AS (SELECT feature, abs(CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END) AS spearman_abs "
            f"  FROM rr GROUP BY feature), "
            f"both_l AS (SELECT * FROM (SELECT {', '.join(f'({c} IS NULL)::DOUBLE AS {c}' for c in APP_COLS)} FROM app) "
            f"  UNPIVOT (isn FOR feature IN ({', '.join(APP_COLS)}))), "
            f"miss AS (SELECT feature, avg(isn) AS missing_rate FROM both_l GROUP BY feature), "
            f"types AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{'cat' if c in cats else 'num'}')" for c in APP_COLS)}) t(feature, type)), "
            f"m AS (SELECT types.feature, types.type, miss.missing_rate, auc.auc_single, mi.mi, rho.spearman_abs FROM types "
            f"  LEFT JOIN miss USING (feature) LEFT JOIN auc USING (feature) LEFT JOIN mi USING (feature) "
            f"  LEFT JOIN rho USING (feature){f' WHERE types.feature IN ({kept})' if kept else ''}), "
            f"thr AS (SELECT quantile_cont(mi, 0.6) AS t FROM m) "
            f"SELECT m.*, (coalesce(auc_single >= 0.51, false) OR coalesce(mi >= thr.t, false) "
            f"  OR coalesce(spearman_abs >= 0.05, false))::INTEGER AS pass_stage1 FROM m, thr")
    return canon(body, ["feature", "type", "missing_rate", "auc_single", "mi", "spearman_abs", "pass_stage1"],
                 {"pass_stage1"}, strings={"feature", "type"}) + f" {where}"


def onehot_sparse_sql() -> str:
    """Median-filled numerics, then the sorted categories of each column (missing is one), side by side."""
    first, slots, extra = str(len(NUM_COLS)), [], {}
    for i, c in enumerate(LABELS):
        extra[f"d{i}"] = (f"SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce({c}, {MISSING}) AS v FROM app)")
        slots.append(f"({first} + (SELECT code FROM d{i} WHERE v = coalesce(app.{c}, {MISSING})))::BIGINT")
        first += f" + (SELECT count(*) FROM d{i})"
    total = " + ".join(f"coalesce({c}, (SELECT median({c}) FROM app))::DOUBLE" for c in NUM_COLS)
    body = with_fixtures("app", extra=extra) + (
        f"SELECT SK_ID_CURR, {first} AS width, concat_ws(',', {', '.join(slots)}) AS slots, {total} AS total FROM app")
    return canon(body, ["SK_ID_CURR", "width", "slots", "total"], {"SK_ID_CURR", "width"}, strings={"slots"})


def region_sql() -> str:
    addr = ["REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
            "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"]
    s = " + ".join(f"coalesce({c}, 0)" for c in addr)
    body = with_fixtures("app") + (f"SELECT SK_ID_CURR, REGION_RATING_CLIENT - REGION_RATING_CLIENT_W_CITY AS "
                                   f"REGION_RATING_DIFF, {s} AS ADDR_MISMATCH_SUM, DAYS_BIRTH / -365.0 AS YEARS_BIRTH FROM app")
    return canon(body, ["SK_ID_CURR", "REGION_RATING_DIFF", "ADDR_MISMATCH_SUM", "YEARS_BIRTH"],
                 {"SK_ID_CURR", "REGION_RATING_DIFF", "ADDR_MISMATCH_SUM"})


def value_counts_sql() -> str:
    body = with_fixtures("app") + "SELECT NAME_TYPE_SUITE, count(*) AS count FROM app GROUP BY NAME_TYPE_SUITE"
    return canon(body, ["NAME_TYPE_SUITE", "count"], {"count"}, strings={"NAME_TYPE_SUITE"})


def csv_scan_sql() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return canon(f"SELECT {', '.join(cols)} FROM orders", cols, {"o_orderkey", "o_custkey"}, strings={"o_orderstatus", "o_orderpriority"})
