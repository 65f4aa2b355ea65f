"""SQL twin of the fitted scorecard: the whole fit and the decisions made with it, as CTEs for DuckDB.

Every fold's medians, edges, WoE, scaling, Newton steps (normal equations eliminated row by row in a
recursive CTE) and Platt steps are computed from the tables, so the comparison covers the fitted
numbers and what is made of them. All CTEs are materialised; names begin with ``sc_``.
"""

from __future__ import annotations

from .. import schema as S
from ..functions import rules
from ..functions import scorecard as SC
from ..operators import binning, woe
from ..operators.explain import (HIGHER_FACTOR, LOWER_FACTOR, MIN_IMPROVEMENT, MUTABLE_FEATURES)
from .scorecard import FLAT, MISSING, RIDGE, SQL_NEWTON, SQL_PLATT

NUMERIC = S.NUMERIC_FEATURES + S.DERIVED_FEATURES
K = S.CV_FOLDS
_FOLDS = f"generate_series(0, {K - 1})"


def _cte(name: str, body: str) -> str:
    return f"{name} AS MATERIALIZED ({body})"


def sql_fit(apps: str, label: str, split: str) -> list[str]:
    """CTEs of the fit. ``apps``: applications with derived features; ``split``: id, label, split."""
    s = repr(float(S.WOE_SMOOTHING))
    hash_ = f"CAST('0x' || substr(md5(CAST(application_id AS VARCHAR) || ':{S.SEED}'), 1, 15) AS BIGINT)"
    out = [
        _cte("sc_train", f"SELECT a.* FROM {apps} a JOIN {split} s USING (application_id) WHERE s.split = 'train'"),
        woe.sql_woe_table("sc_train", label, NUMERIC, S.CATEGORICAL_FEATURES),
        _cte("sc_feat", f"SELECT feature FROM ({woe.sql_iv_table()}) WHERE iv >= {S.IV_THRESHOLD!r}"),
        _cte("sc_fold", f"SELECT application_id, y, " + " + ".join(
            f"CASE WHEN r >= floor({j} * n / {K}) THEN 1 ELSE 0 END" for j in range(1, K)) + " AS fold FROM ("
            f"SELECT application_id, {label} AS y, row_number() OVER (PARTITION BY {label} ORDER BY {hash_}) - 1 AS r, "
            f"count(*) OVER (PARTITION BY {label}) AS n FROM {split} WHERE split IN ('train', 'val'))"),
        _cte("sc_num", "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT application_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {apps}" for c in NUMERIC)
            + ") WHERE feature IN (SELECT feature FROM sc_feat)"),
        _cte("sc_catl", "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT application_id, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), '{MISSING}') AS b FROM {apps}"
            for c in S.CATEGORICAL_FEATURES) + ") WHERE feature IN (SELECT feature FROM sc_feat)"),
        _cte("sc_med", "SELECT g, feature, quantile_cont(v, 0.5) AS med FROM sc_num JOIN sc_fold USING (application_id), "
             f"{_FOLDS} t(g) WHERE fold <> g AND v IS NOT NULL GROUP BY g, feature"),
        _cte("sc_imp", "SELECT g, application_id, feature, coalesce(v, med) AS v FROM sc_num JOIN sc_med USING (feature)"),
        _cte("sc_long", "SELECT g || ':' || feature AS feature, v AS value FROM sc_imp JOIN sc_fold USING (application_id) "
             "WHERE fold <> g"),
        _cte("sc_edges", "SELECT CAST(split_part(feature, ':', 1) AS BIGINT) AS g, split_part(feature, ':', 2) AS feature, "
             f"edges[2:len(edges) - 1] AS e FROM ({binning.sql_quantile_edges('sc_long', binning.n_quantile_bins())})"),
        _cte("sc_bin", "SELECT g, application_id, feature, true AS num, "
             "CAST(len(list_filter(e, lambda x: x <= v)) AS VARCHAR) AS b FROM sc_imp JOIN sc_edges USING (g, feature) "
             f"UNION ALL SELECT g, application_id, feature, false, b FROM sc_catl, {_FOLDS} t(g)"),
        _cte("sc_cnt", "SELECT g, feature, num, b, count(*) AS n, sum(y) AS n_ev FROM sc_bin JOIN sc_fold USING (application_id) "
             "WHERE fold <> g GROUP BY ALL"),
        _cte("sc_tot", "SELECT *, sum(n_ev) OVER w AS ev, sum(n - n_ev) OVER w AS nev, "
             f"{s} * (count(*) OVER w + CASE WHEN num THEN 0 ELSE 1 END) AS size FROM sc_cnt WINDOW w AS (PARTITION BY g, feature)"),
        _cte("sc_woe", f"SELECT *, ln(((n_ev + {s}) / (ev + size)) / ((n - n_ev + {s}) / (nev + size))) AS woe FROM sc_tot"),
        _cte("sc_mean", "SELECT g, feature, sum(n * woe) / sum(n) AS mean FROM sc_woe GROUP BY g, feature"),
        _cte("sc_ms", "SELECT g, feature, mean, CASE WHEN sd < " + repr(FLAT) + " THEN 1e0 ELSE sd END AS scale FROM ("
             "SELECT g, feature, any_value(mean) AS mean, sqrt(sum(n * (woe - mean) * (woe - mean)) / sum(n)) AS sd "
             "FROM sc_woe JOIN sc_mean USING (g, feature) GROUP BY g, feature)"),
        _cte("sc_z", "SELECT b.g, b.application_id, b.feature, (coalesce(w.woe, 0e0) - m.mean) / m.scale AS z FROM sc_bin b "
             "JOIN sc_ms m USING (g, feature) LEFT JOIN sc_woe w ON w.g = b.g AND w.feature = b.feature AND w.b = b.b"),
        _cte("sc_x", "SELECT g, application_id, list_concat([1e0], list(z ORDER BY feature)) AS x FROM sc_z GROUP BY g, application_id"),
        _cte("sc_rows", "SELECT g, x, y FROM sc_x JOIN sc_fold USING (application_id) WHERE fold <> g"),
        _cte("sc_i", "SELECT unnest(range(1, (SELECT count(*) FROM sc_feat) + 2)) AS i"),
        _cte("sc_b0", f"SELECT g, (SELECT list(0e0) FROM sc_i) AS beta FROM {_FOLDS} t(g)"),
    ]
    for t in range(1, SQL_NEWTON + 1):
        out += [
            _cte(f"sc_p{t}", f"SELECT g, x, y, 1e0 / (1e0 + exp(-list_dot_product(x, beta))) AS p FROM sc_rows JOIN sc_b{t - 1} USING (g)"),
            _cte(f"sc_h{t}", "SELECT g, r.i AS i, c.i AS j, sum(p * (1e0 - p) * x[r.i] * x[c.i]) AS h "
                 f"FROM sc_p{t}, sc_i r, sc_i c GROUP BY g, r.i, c.i"),
            _cte(f"sc_g{t}", f"SELECT g, i, sum((y - p) * x[i]) AS d FROM sc_p{t}, sc_i GROUP BY g, i"),
            _cte(f"sc_r{t}", f"SELECT h.g, h.i, list_concat(list(h.h + CASE WHEN h.i = h.j AND h.i > 1 THEN {RIDGE!r} ELSE 0e0 END ORDER BY h.j), "
                 f"[any_value(d.d) - CASE WHEN h.i > 1 THEN {RIDGE!r} * any_value(b.beta[h.i]) ELSE 0e0 END]) AS row "
                 f"FROM sc_h{t} h JOIN sc_g{t} d ON d.g = h.g AND d.i = h.i JOIN sc_b{t - 1} b ON b.g = h.g GROUP BY h.g, h.i"),
            f"sc_e{t}(g, s, m) AS (SELECT g, CAST(1 AS BIGINT), list(row ORDER BY i) FROM sc_r{t} GROUP BY g UNION ALL "
            "SELECT g, s + 1, list_transform(m, lambda q, i: CASE WHEN i = s THEN list_transform(q, lambda v: v / m[s][s]) "
            "ELSE list_transform(q, lambda v, j: v - q[s] / m[s][s] * m[s][j]) END) "
            f"FROM sc_e{t} WHERE s <= len(m))",
            _cte(f"sc_b{t}", "SELECT e.g, list_transform(b.beta, lambda v, i: v + e.m[i][len(e.m) + 1]) AS beta "
                 f"FROM sc_e{t} e JOIN sc_b{t - 1} b ON b.g = e.g WHERE e.s = len(e.m) + 1"),
        ]
    beta = f"sc_b{SQL_NEWTON}"
    out += [
        _cte("sc_lg", f"SELECT g, application_id, list_dot_product(x, beta) AS lg FROM sc_x JOIN {beta} USING (g)"),
        _cte("sc_raw", "SELECT g, application_id, 1e0 / (1e0 + exp(-lg)) AS f FROM sc_lg"),
        _cte("sc_held", "SELECT g, f, CASE WHEN y = 1 THEN (pos + 1e0) / (pos + 2e0) ELSE 1e0 / (neg + 2e0) END AS t FROM ("
             "SELECT g, f, y, sum(y) OVER w AS pos, sum(1 - y) OVER w AS neg FROM sc_raw JOIN sc_fold USING (application_id) "
             "WHERE fold = g WINDOW w AS (PARTITION BY g))"),
        _cte("sc_ab0", "SELECT g, 0e0 AS a, ln((sum(1 - y) + 1e0) / (sum(y) + 1e0)) AS b FROM sc_fold JOIN "
             f"{_FOLDS} t(g) ON fold = g GROUP BY g"),
    ]
    for t in range(1, SQL_PLATT + 1):
        out.append(_cte(f"sc_ab{t}", "SELECT g, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a, "
                        "b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM (SELECT g, any_value(a) AS a, any_value(b) AS b, "
                        "sum((t - q) * f) AS ga, sum(t - q) AS gb, sum(q * (1 - q) * f * f) AS haa, sum(q * (1 - q) * f) AS hab, "
                        f"sum(q * (1 - q)) AS hbb FROM (SELECT h.*, a, b, 1e0 / (1e0 + exp(a * f + b)) AS q FROM sc_held h "
                        f"JOIN sc_ab{t - 1} USING (g)) GROUP BY g)"))
    out += [
        _cte("sc_cal", f"SELECT g, a, b FROM sc_ab{SQL_PLATT}"),
        _cte("sc_prob", "SELECT application_id, sum(1e0 / (1e0 + exp(a * f + b))) / " + f"{float(K)!r}"
             " AS p FROM sc_raw JOIN sc_cal USING (g) GROUP BY application_id"),
        _cte("sc_coef", f"SELECT g, feature, beta[i + 1] AS c FROM {beta}, (SELECT feature, row_number() OVER (ORDER BY feature) AS i FROM sc_feat)"),
    ]
    return out


def sql_parameters() -> str:
    """Fold, term and value of the fitted numbers."""
    return (f"SELECT CAST(g AS INTEGER) AS fold, '(intercept)' AS term, round(beta[1], 6) AS value FROM sc_b{SQL_NEWTON} "
            "UNION ALL SELECT CAST(g AS INTEGER), feature, round(c, 6) FROM sc_coef "
            "UNION ALL SELECT CAST(g AS INTEGER), '(sigmoid a)', round(a, 6) FROM sc_cal "
            "UNION ALL SELECT CAST(g AS INTEGER), '(sigmoid b)', round(b, 6) FROM sc_cal")


def sql_decisions(apps: str, columns, version: str = "scorecard-v1") -> str:
    """P15 with the fitted probability."""
    from ..functions.validation import sql_validation_errors
    return (f"SELECT application_id, round(p, 6) AS default_probability, {SC.sql_score('p')} AS risk_score, "
            f"{SC.sql_prob_decision('p')} AS decision, {SC.sql_confidence('p')} AS confidence, '{version}' AS model_version "
            f"FROM {apps} JOIN sc_prob USING (application_id) WHERE len({sql_validation_errors(columns)}) = 0")


def sql_impacts(top_n: int = 5) -> list[str]:
    """CTE ``sc_attr``: the ``top_n`` additive effects on the mean logit of every application."""
    return [_cte("sc_base", f"SELECT sum(beta[1]) / {float(K)!r} AS base_value FROM sc_b{SQL_NEWTON}"),
            _cte("sc_attr", "SELECT application_id, CAST(row_number() OVER (PARTITION BY application_id ORDER BY abs(impact) DESC, "
                 "feature) AS INTEGER) AS rank, feature, impact, CASE WHEN impact > 0 THEN 'increases_risk' ELSE 'decreases_risk' END "
                 f"AS direction, base_value FROM (SELECT application_id, feature, sum(z * c) / {float(K)!r} AS impact FROM sc_z "
                 f"JOIN sc_coef USING (g, feature) GROUP BY application_id, feature), sc_base QUALIFY rank <= {top_n}")]


# --- counterfactual ------------------------------------------------------------------------
LEVERS = [f for f, _ in MUTABLE_FEATURES]
TOUCHED = LEVERS + [d for d in S.DERIVED_FEATURES if any(i in LEVERS for i in rules.derived_inputs(d))]


def touched_by(lever: str) -> list[str]:
    """Features whose points change with a lever: itself and what is derived from it."""
    return [lever] + [d for d in S.DERIVED_FEATURES if lever in rules.derived_inputs(d)]


def _value(name: str, get) -> str:
    if name not in S.DERIVED_FEATURES:
        return get(name)
    a, b = (get(i) for i in rules.derived_inputs(name))
    return f"({a}) * ({b})" if name == "rate_x_dti" else f"({a}) / CASE WHEN ({b}) < 1 THEN 1e0 ELSE ({b}) END"


def _points(name: str, value: str) -> str:
    """Points of a value in all folds (a list), from the one-row model."""
    return (f"list_transform(range(1, {K + 1}), lambda g: q_{name}[g][1 + len(list_filter(e_{name}[g], "
            f"lambda x: x <= coalesce({value}, d_{name}[g])))])")


def _probability(logits: str) -> str:
    return (f"list_sum(list_transform({logits}, lambda z, g: 1e0 / (1e0 + exp(sa[g] * (1e0 / (1e0 + exp(-z))) + sb[g])))) / {float(K)!r}")


def sql_counterfactual(apps: str, max_changes: int = 4, target: str = "APPROVE") -> list[str]:
    """CTEs ``sc_cf`` and ``sc_cf_changes``: the greedy rounds on fold logits, changed by the points of what a lever touches."""
    def dec(p):
        return SC.sql_prob_decision(p)
    one = ", ".join(f"coalesce(any_value({c}) FILTER (feature = '{f}'), {empty}) AS {n}_{f}" for f in TOUCHED for c, n, empty in (
        ("e", "e", f"(SELECT list(CAST([] AS DOUBLE[])) FROM {_FOLDS})"), ("q", "q", f"(SELECT list([0e0]) FROM {_FOLDS})"),
        ("d", "d", f"(SELECT list(0e0) FROM {_FOLDS})")))
    out = [
        _cte("sc_pts", "SELECT e.g, e.feature, any_value(e.e) AS e, any_value(m.med) AS d, list(((coalesce(w.woe, 0e0) - s.mean) / s.scale) * c.c "
             "ORDER BY r.b) AS q FROM (SELECT *, unnest(range(0, len(e) + 1)) AS b FROM sc_edges) r JOIN sc_edges e USING (g, feature) "
             "JOIN sc_med m USING (g, feature) JOIN sc_ms s USING (g, feature) JOIN sc_coef c USING (g, feature) "
             "LEFT JOIN sc_woe w ON w.g = r.g AND w.feature = r.feature AND w.b = CAST(r.b AS VARCHAR) GROUP BY e.g, e.feature"),
        _cte("sc_model", f"SELECT {one}, (SELECT list(a ORDER BY g) FROM sc_cal) AS sa, (SELECT list(b ORDER BY g) FROM sc_cal) AS sb "
             "FROM (SELECT feature, list(e ORDER BY g) AS e, list(q ORDER BY g) AS q, list(d ORDER BY g) AS d FROM sc_pts GROUP BY feature)"),
        _cte("sc_l", "SELECT application_id, list(lg ORDER BY g) AS lg FROM sc_lg GROUP BY application_id"),
    ]
    start = [f"CAST({f} AS DOUBLE) AS cf_{f}, CAST({f} AS DOUBLE) AS o_{f}" for f in LEVERS]
    points = [f"{_points(f, _value(f, lambda n: f'CAST({n} AS DOUBLE)'))} AS pt_{f}" for f in TOUCHED]
    out.append(_cte("sc_c0", "SELECT *, coalesce(" + dec("p_cur") + f" = '{target}', false) AS done FROM (SELECT application_id, "
                    f"total_accounts, {', '.join(start)}, {', '.join(points)}, lg, {_probability('lg')} AS p_start, "
                    f"{_probability('lg')} AS p_cur, CAST([] AS VARCHAR[]) AS changes FROM {apps} JOIN sc_l USING (application_id), sc_model)"))
    fixed = ["application_id", "total_accounts", "p_start"] + [f"o_{f}" for f in LEVERS]
    prev = "sc_c0"
    for r in range(1, max_changes + 1):
        new, logits, deltas = [], [], []
        for i, (f, direction) in enumerate(MUTABLE_FEATURES):
            factor = LOWER_FACTOR if direction == "lower" else HIGHER_FACTOR
            value = f"(coalesce(cf_{f}, 0.0) * {factor!r})"

            def get(n, f=f, value=value):
                return value if n == f else (f"cf_{n}" if n in LEVERS else n)
            new += [f"{_points(d, _value(d, get))} AS n{i}_{d}" for d in touched_by(f)]
            logits.append("list_transform(lg, lambda z, g: z + (" + " + ".join(f"(n{i}_{d}[g] - pt_{d}[g])" for d in touched_by(f)) + f")) AS l{i}")
            deltas.append(f"CASE WHEN NOT list_contains(changes, '{f}') AND round((p_cur - {_probability(f'l{i}')}) * 1e12) / 1e12 > 0 "
                          f"THEN round((p_cur - {_probability(f'l{i}')}) * 1e12) / 1e12 END AS d{i}")
        best = "greatest(" + ", ".join(f"d{i}" for i in range(len(LEVERS))) + ")"
        pick = "CASE " + " ".join(f"WHEN d{i} = bd THEN {i}" for i in range(len(LEVERS))) + " END"
        out += [
            _cte(f"sc_c{r}n", f"SELECT *, {', '.join(new)} FROM {prev}, sc_model"),
            _cte(f"sc_c{r}l", f"SELECT *, {', '.join(logits)} FROM sc_c{r}n"),
            _cte(f"sc_c{r}d", f"SELECT *, {', '.join(deltas)} FROM sc_c{r}l"),
            _cte(f"sc_c{r}b", f"SELECT *, {pick} AS bi, (NOT done AND bd IS NOT NULL AND bd >= {MIN_IMPROVEMENT!r}) AS go "
                 f"FROM (SELECT *, {best} AS bd FROM sc_c{r}d)"),
        ]
        keep = list(fixed)
        for i, (f, direction) in enumerate(MUTABLE_FEATURES):
            factor = LOWER_FACTOR if direction == "lower" else HIGHER_FACTOR
            keep.append(f"CASE WHEN go AND bi = {i} THEN coalesce(cf_{f}, 0.0) * {factor!r} ELSE cf_{f} END AS cf_{f}")
        for d in TOUCHED:
            arms = " ".join(f"WHEN go AND bi = {i} THEN n{i}_{d}" for i, f in enumerate(LEVERS) if d in touched_by(f))
            keep.append(f"CASE {arms} ELSE pt_{d} END AS pt_{d}")
        arms = " ".join(f"WHEN go AND bi = {i} THEN l{i}" for i in range(len(LEVERS)))
        names = "[" + ", ".join(f"'{f}'" for f in LEVERS) + "]"
        out += [
            _cte(f"sc_c{r}u", f"SELECT {', '.join(keep)}, CASE {arms} ELSE lg END AS lg, p_cur AS p_old, done AS was, go, sa, sb, "
                 f"CASE WHEN go THEN list_append(changes, {names}[bi + 1]) ELSE changes END AS changes FROM sc_c{r}b"),
            _cte(f"sc_c{r}", "SELECT * EXCLUDE (p_old, was, go, p_new, sa, sb), CASE WHEN go THEN p_new ELSE p_old END AS p_cur, "
                 f"was OR NOT go OR coalesce({dec('(CASE WHEN go THEN p_new ELSE p_old END)')} = '{target}', false) AS done "
                 f"FROM (SELECT *, {_probability('lg')} AS p_new FROM sc_c{r}u)"),
        ]
        prev = f"sc_c{r}"
    out.append(_cte("sc_cf", f"SELECT application_id, round(p_start * 10000.0) / 10000.0 AS start_probability, {dec('p_start')} AS decision, "
                    "CAST(len(changes) AS INTEGER) AS n_changes, array_to_string(changes, ';') AS changed_features, "
                    f"round(p_cur * 10000.0) / 10000.0 AS counterfactual_probability, {dec('p_cur')} AS counterfactual_decision, "
                    f"coalesce({dec('p_cur')} = '{target}', false) AS achievable FROM {prev}"))

    def of_change(what):
        return "CASE changes[step] " + " ".join(f"WHEN '{f}' THEN {what(f, d)}" for f, d in MUTABLE_FEATURES) + " END"
    out.append(_cte("sc_cf_changes", "SELECT application_id, CAST(step AS INTEGER) AS step, changes[step] AS feature, "
                    + of_change(lambda f, d: f"'{d}'") + " AS direction, round("
                    + of_change(lambda f, d: f"coalesce(o_{f}, 0.0)") + " * 10000.0) / 10000.0 AS current_value, round("
                    + of_change(lambda f, d: f"cf_{f}") + f" * 10000.0) / 10000.0 AS suggested_value FROM {prev}, "
                    f"range(1, {max_changes + 1}) r(step) WHERE step <= len(changes)"))
    return out
