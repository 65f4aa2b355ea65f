"""Registered queries: one Spark job per inventory ID plus its DuckDB twin.

Each query takes ``(spark, sf_dir)``, reads the driver's tables (through the
fixture views, which Spark derives from them) and returns a lazy DataFrame.
The oracle text for the same key runs in DuckDB over the raw tables, with
the fixture views inlined as CTEs. Doubles are rounded to 6 dp on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions import rules
from .functions.numeric import round_dp
from .operators import binning, woe
from .sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TARGET = FX.TARGET
WOE_NUMERIC = S.NUMERIC_FEATURES + S.DERIVED_FEATURES
WOE_CATEGORICAL = S.CATEGORICAL_FEATURES


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c):
    return round_dp(F.col(c) if isinstance(c, str) else c, 6)


def _derived_apps(spark, sf_dir) -> DataFrame:
    return rules.add_derived_features(FX.applications(spark, sf_dir))


_SQL_DERIVED_APPS = f"apps_d AS (SELECT *, {rules.sql_derived_features()} FROM applications)"


def _oracle(views, ctes: list[str], final: str) -> str:
    """DuckDB text: fixture views, then extra CTEs, then the final SELECT."""
    parts = [FX._duck(f"{n} AS ({sql}\n)") for n, sql in FX.view_ctes(*views)] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + final


# --- A6 / flagship: IV table over the application fixture ----------------------
def q_iv_table(spark, sf_dir):
    """Edges pass (collected, bounded) + one lazy long-format aggregate -> IV table."""
    df = _derived_apps(spark, sf_dir)
    tbl = woe.woe_table_df(df, TARGET, WOE_NUMERIC, WOE_CATEGORICAL)
    return woe.iv_table(tbl)


register("a6_iv_table", _oracle(["applications"], [
    _SQL_DERIVED_APPS, woe.sql_woe_table("apps_d", TARGET, WOE_NUMERIC, WOE_CATEGORICAL)],
    woe.sql_iv_table()))(q_iv_table)


def q_woe_table(spark, sf_dir):
    df = _derived_apps(spark, sf_dir)
    t = woe.woe_table_df(df, TARGET, WOE_NUMERIC, WOE_CATEGORICAL)
    return t.select("feature", "kind", "bin", "category", "is_missing", r6("lo").alias("lo"),
                    r6("hi").alias("hi"), "n", "n_ev", "n_nev", r6("woe").alias("woe"),
                    r6("iv_part").alias("iv_part"))


_SQL_WOE = woe.sql_woe_table("apps_d", TARGET, WOE_NUMERIC, WOE_CATEGORICAL)
register("a2_a5_woe_table", _oracle(["applications"], [_SQL_DERIVED_APPS, _SQL_WOE],
         "SELECT feature, kind, bin, category, is_missing, round(lo, 6) AS lo, round(hi, 6) AS hi, "
         "n, n_ev, n_nev, round(woe, 6) AS woe, round(iv_part, 6) AS iv_part FROM woe_tbl"))(q_woe_table)


def q_bin_labels(spark, sf_dir):
    """the label and WoE of every numeric bin."""
    t = woe.woe_table_df(_derived_apps(spark, sf_dir), TARGET, WOE_NUMERIC, [])
    label = F.when(F.col("is_missing"), "MISSING").otherwise(binning.bin_label(F.col("lo"), F.col("hi")))
    return t.select("feature", "bin", label.alias("label"), r6("woe").alias("woe"))


register("f5_bin_labels", _oracle(["applications"], [_SQL_DERIVED_APPS, _SQL_WOE],
         f"SELECT feature, bin, CASE WHEN is_missing THEN 'MISSING' ELSE {binning.sql_bin_label('lo', 'hi')} END AS label, "
         "round(woe, 6) AS woe FROM woe_tbl WHERE kind = 'numeric'"))(q_bin_labels)


def q_quantile_edges(spark, sf_dir):
    df = _derived_apps(spark, sf_dir)
    e = binning.quantile_edges(df, WOE_NUMERIC, binning.n_quantile_bins())
    return e.select("feature", F.posexplode("edges").alias("edge_idx", "edge")).select(
        "feature", "edge_idx", r6("edge").alias("edge"))


register("a1_quantile_edges", _oracle(["applications"], [
    _SQL_DERIVED_APPS, _SQL_WOE],
    "SELECT feature, CAST(generate_subscripts(edges, 1) - 1 AS INTEGER) AS edge_idx, "
    "round(unnest(edges), 6) AS edge FROM w_edges"))(q_quantile_edges)


def q_select_by_iv(spark, sf_dir):
    return woe.select_features_by_iv(q_iv_table(spark, sf_dir)).select("feature", "iv")


register("p9_select_features_by_iv", _oracle(["applications"], [
    _SQL_DERIVED_APPS, _SQL_WOE, f"ivt AS ({woe.sql_iv_table()})"],
    f"SELECT feature, iv FROM ivt WHERE iv >= {S.IV_THRESHOLD!r}"))(q_select_by_iv)


def q_dropped_by_iv(spark, sf_dir):
    return woe.dropped_features_by_iv(q_iv_table(spark, sf_dir)).select("feature", "iv")


register("u3_dropped_features", _oracle(["applications"], [
    _SQL_DERIVED_APPS, _SQL_WOE, f"ivt AS ({woe.sql_iv_table()})"],
    f"SELECT feature, iv FROM ivt WHERE iv < {S.IV_THRESHOLD!r}"))(q_dropped_by_iv)


def q_woe_transform(spark, sf_dir):
    """J1 + J2: every application's 23 features replaced by their WoE."""
    df = _derived_apps(spark, sf_dir)
    model = woe.fit_woe(df, TARGET, WOE_NUMERIC, WOE_CATEGORICAL)
    out = model.transform(df, keep=["application_id"])
    return out.select("application_id", *[r6(c).alias(c) for c in WOE_NUMERIC + WOE_CATEGORICAL])


def _sql_woe_transform() -> str:
    num = ",\n".join(
        f"coalesce((SELECT w.woe FROM woe_tbl w WHERE w.feature = '{c}' AND "
        f"((a.{c} IS NULL AND w.is_missing) OR (a.{c} IS NOT NULL AND NOT w.is_missing AND w.bin = "
        f"{binning.sql_bin_index('a.' + c, '(SELECT edges FROM w_edges WHERE feature = ' + repr(c) + ')')}))), 0.0) AS {c}"
        for c in WOE_NUMERIC)
    cat = ",\n".join(
        f"coalesce((SELECT w.woe FROM woe_tbl w WHERE w.feature = '{c}' AND NOT w.is_missing AND w.category = a.{c}), "
        f"(SELECT w.woe FROM woe_tbl w WHERE w.feature = '{c}' AND w.is_missing), 0.0) AS {c}"
        for c in WOE_CATEGORICAL)
    return f"woe_x AS (SELECT a.application_id,\n{num},\n{cat}\nFROM apps_d a)"


register("j1_j2_woe_transform", _oracle(["applications"], [
    _SQL_DERIVED_APPS, _SQL_WOE, _sql_woe_transform()],
    "SELECT application_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in WOE_NUMERIC + WOE_CATEGORICAL)
    + " FROM woe_x"))(q_woe_transform)


# --- evaluation over the scored fixture ---------------------------------------
from .functions import scorecard as SC  # noqa: E402
from .operators import evaluation as EV  # noqa: E402


def _scored(spark, sf_dir):
    return FX.scored(spark, sf_dir)


def _sql_bin(p: str, edges, last_closed=True) -> str:
    idx = " + ".join(f"CAST({p} >= {e!r} AS INTEGER)" for e in edges[1:-1])
    hi = f"{p} <= {edges[-1]!r}" if last_closed else f"{p} < {edges[-1]!r}"
    return f"CASE WHEN {p} >= {edges[0]!r} AND {hi} THEN {idx} END"


def _sql_rank(src: str, label: str, prob: str, name: str) -> str:
    return (f"{name}_bs AS (SELECT {prob} AS p, sum({label}) AS pos, sum(1 - {label}) AS neg FROM {src} GROUP BY 1),\n"
            f"{name}_cm AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS cum_pos, "
            f"sum(neg) OVER (ORDER BY p DESC) AS cum_neg, sum(pos) OVER () AS PP, sum(neg) OVER () AS NN FROM {name}_bs),\n"
            f"{name} AS (SELECT sum(pos * (NN - cum_neg) + 0.5 * pos * neg) / (any_value(PP) * any_value(NN)) AS auc_roc, "
            f"2 * sum(pos * (NN - cum_neg) + 0.5 * pos * neg) / (any_value(PP) * any_value(NN)) - 1 AS gini, "
            f"max(abs(cum_pos / PP - cum_neg / NN)) AS ks_statistic, "
            f"sum(pos / PP * cum_pos / (cum_pos + cum_neg)) AS average_precision FROM {name}_cm)")


def q_ranking(spark, sf_dir):
    m = EV.ranking_metrics(EV.cumulative_frame(EV.score_frame(_scored(spark, sf_dir), TARGET, "default_prob")))
    return m.select(*[r6(c).alias(c) for c in m.columns])


register("w1_w3_ks_auc_gini_ap", _oracle(["scored"], [_sql_rank("scored", TARGET, "default_prob", "rk")],
         "SELECT round(auc_roc, 6) AS auc_roc, round(gini, 6) AS gini, round(ks_statistic, 6) AS ks_statistic, "
         "round(average_precision, 6) AS average_precision FROM rk"))(q_ranking)


def q_calibration_curve(spark, sf_dir):
    c = EV.calibration_curve(_scored(spark, sf_dir), TARGET, "default_prob")
    return c.select(r6("bin_center").alias("bin_center"), r6("mean_predicted").alias("mean_predicted"),
                    r6("fraction_positive").alias("fraction_positive"), "count")


_CURVE_SQL = (f"curve AS (SELECT b, avg(default_prob) AS mean_predicted, avg(CAST({TARGET} AS DOUBLE)) AS fraction_positive, "
              f"count(*) AS count FROM (SELECT *, {_sql_bin('default_prob', EV.PROB_EDGES_10, False)} AS b FROM scored) "
              "WHERE b IS NOT NULL GROUP BY b)")
_CENTERS = "[" + ", ".join(repr((a + b) / 2) for a, b in zip(EV.PROB_EDGES_10[:-1], EV.PROB_EDGES_10[1:])) + "]"
register("a19_calibration_curve", _oracle(["scored"], [_CURVE_SQL],
         f"SELECT round({_CENTERS}[b + 1], 6) AS bin_center, round(mean_predicted, 6) AS mean_predicted, "
         "round(fraction_positive, 6) AS fraction_positive, count FROM curve"))(q_calibration_curve)


def q_ece(spark, sf_dir):
    return EV.expected_calibration_error(_scored(spark, sf_dir), TARGET, "default_prob").select(r6("ece").alias("ece"))


register("a18_ece", _oracle(["scored"], [_CURVE_SQL],
         "SELECT round(coalesce(sum(count * abs(fraction_positive - mean_predicted)) / "
         "(SELECT count(*) FROM scored), 0), 6) AS ece FROM curve"))(q_ece)


def q_brier(spark, sf_dir):
    return EV.brier_score(_scored(spark, sf_dir), TARGET, "default_prob").select(r6("brier_score").alias("brier_score"))


register("a20_brier_score", _oracle(["scored"], [],
         f"SELECT round(avg((default_prob - {TARGET}) * (default_prob - {TARGET})), 6) AS brier_score FROM scored"))(q_brier)


_THR_VALUES = ", ".join(f"({i}, {t!r})" for i, t in enumerate(EV.COST_THRESHOLDS))
_SWEEP_SQL = (f"thr(threshold_idx, threshold) AS (VALUES {_THR_VALUES}),\n"
              "sweep AS (SELECT t.threshold_idx, t.threshold, "
              f"sum(CASE WHEN s.{TARGET} = 1 AND s.default_prob < t.threshold THEN 1 ELSE 0 END) AS fn, "
              f"sum(CASE WHEN s.{TARGET} = 0 AND s.default_prob >= t.threshold THEN 1 ELSE 0 END) AS fp, "
              f"sum(CASE WHEN s.{TARGET} = 1 AND s.default_prob >= t.threshold THEN 1 ELSE 0 END) AS tp, "
              f"sum(CASE WHEN s.{TARGET} = 0 AND s.default_prob < t.threshold THEN 1 ELSE 0 END) AS tn "
              "FROM thr t, scored s GROUP BY t.threshold_idx, t.threshold),\n"
              f"sweep_c AS (SELECT *, fn * {S.COST_FN!r} + fp * {S.COST_FP!r} AS cost FROM sweep),\n"
              "best AS (SELECT * FROM sweep_c ORDER BY cost, threshold_idx LIMIT 1)")


def q_cost_sweep(spark, sf_dir):
    s = EV.cost_sweep(_scored(spark, sf_dir), TARGET, "default_prob")
    return s.select("threshold_idx", r6("threshold").alias("threshold"), "fn", "fp", "tp", "tn",
                    r6("cost").alias("cost"))


register("a23_cost_sweep", _oracle(["scored"], [_SWEEP_SQL],
         "SELECT threshold_idx, round(threshold, 6) AS threshold, fn, fp, tp, tn, round(cost, 6) AS cost "
         "FROM sweep_c"))(q_cost_sweep)


def _rates_sql(src: str) -> str:
    return (f"SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, "
            f"round(fn * {S.COST_FN!r} + fp * {S.COST_FP!r}, 6) AS total_cost, "
            f"round((fn * {S.COST_FN!r} + fp * {S.COST_FP!r}) / (tn + fp + fn + tp), 6) AS cost_per_decision, "
            "round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision, "
            "round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall, "
            "round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 "
            f"FROM {src}")


_RATE_COLS = ["tn", "fp", "fn", "tp", "total_cost", "cost_per_decision", "precision", "recall", "f1"]


def _round_all(df):
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_optimal_threshold(spark, sf_dir):
    best = EV.optimal_threshold(EV.cost_sweep(_scored(spark, sf_dir), TARGET, "default_prob"))
    out = EV.with_cost_and_rates(best, keep=[F.col("threshold").alias("optimal_threshold")])
    return _round_all(out)


register("a23_optimal_threshold", _oracle(["scored"], [_SWEEP_SQL],
         _rates_sql("best").replace("SELECT ", "SELECT round(threshold, 6) AS optimal_threshold, ", 1)))(q_optimal_threshold)


def q_confusion(spark, sf_dir):
    """A21 + A22 at the served probability rule (predict default when p >= 0.5)."""
    df = _scored(spark, sf_dir)
    return _round_all(EV.confusion_at(df, TARGET, F.col("default_prob") >= 0.5))


register("a21_a22_confusion_f1", _oracle(["scored"], [
    "cmx AS (SELECT "
    f"sum(CASE WHEN {TARGET} = 0 AND default_prob < 0.5 THEN 1 ELSE 0 END) AS tn, "
    f"sum(CASE WHEN {TARGET} = 0 AND default_prob >= 0.5 THEN 1 ELSE 0 END) AS fp, "
    f"sum(CASE WHEN {TARGET} = 1 AND default_prob < 0.5 THEN 1 ELSE 0 END) AS fn, "
    f"sum(CASE WHEN {TARGET} = 1 AND default_prob >= 0.5 THEN 1 ELSE 0 END) AS tp FROM scored)"],
    _rates_sql("cmx")))(q_confusion)


def q_score_stats(spark, sf_dir):
    return _round_all(EV.score_statistics(_scored(spark, sf_dir), "default_prob"))


register("a24_score_statistics", _oracle(["scored"], [f"sc AS (SELECT {SC.sql_score('default_prob')} AS s FROM scored)"],
         "SELECT round(avg(s), 6) AS score_mean, round(stddev_pop(s), 6) AS score_std, "
         "CAST(min(s) AS INTEGER) AS score_min, CAST(max(s) AS INTEGER) AS score_max FROM sc"))(q_score_stats)


def _drift_split(df):
    ref = df.where(F.col("applied_at") < F.lit(FX.DRIFT_CUTOFF).cast("timestamp_ntz"))
    cur = df.where(F.col("applied_at") >= F.lit(FX.DRIFT_CUTOFF).cast("timestamp_ntz"))
    return ref, cur


def _sql_psi(exp_src: str, act_src: str, prob: str) -> str:
    b = _sql_bin(prob, EV.PROB_EDGES_10, True)
    eps = repr(S.PSI_EPSILON)
    return (f"pe AS (SELECT b, count(*) AS n FROM (SELECT {b} AS b FROM {exp_src}) GROUP BY b),\n"
            f"pa AS (SELECT b, count(*) AS n FROM (SELECT {b} AS b FROM {act_src}) GROUP BY b),\n"
            f"pj AS (SELECT coalesce(pe.b, pa.b) AS b, coalesce(pe.n, 0) / (SELECT count(*) FROM {exp_src}) AS e, "
            f"coalesce(pa.n, 0) / (SELECT count(*) FROM {act_src}) AS a FROM pe FULL OUTER JOIN pa ON pe.b = pa.b "
            "WHERE coalesce(pe.b, pa.b) IS NOT NULL),\n"
            f"psi_t AS (SELECT coalesce(sum((CASE WHEN a = 0 THEN {eps} ELSE a END - CASE WHEN e = 0 THEN {eps} ELSE e END) * "
            f"ln(CASE WHEN a = 0 THEN {eps} ELSE a END / CASE WHEN e = 0 THEN {eps} ELSE e END)), 0) AS psi FROM pj)")


_SPLIT_SQL = [f"sref AS (SELECT * FROM scored WHERE applied_at < TIMESTAMP '{FX.DRIFT_CUTOFF}')",
              f"scur AS (SELECT * FROM scored WHERE applied_at >= TIMESTAMP '{FX.DRIFT_CUTOFF}')"]


def q_score_psi(spark, sf_dir):
    ref, cur = _drift_split(_scored(spark, sf_dir))
    return EV.score_psi(ref, "default_prob", cur, "default_prob").select(r6("psi").alias("psi"))


register("a13_score_psi", _oracle(["scored"], _SPLIT_SQL + [_sql_psi("sref", "scur", "default_prob")],
         "SELECT round(psi, 6) AS psi FROM psi_t"))(q_score_psi)


def q_champion_challenger(spark, sf_dir):
    out = EV.champion_vs_challenger(_scored(spark, sf_dir), TARGET, "default_prob", "challenger_prob")
    return _round_all(out)


register("j4_champion_vs_challenger", _oracle(["scored"], [
    _sql_rank("scored", TARGET, "default_prob", "ca"), _sql_rank("scored", TARGET, "challenger_prob", "cb")],
    "SELECT round(ca.auc_roc, 6) AS champion_auc, round(ca.ks_statistic, 6) AS champion_ks, "
    "round(cb.auc_roc, 6) AS challenger_auc, round(cb.ks_statistic, 6) AS challenger_ks, "
    "round(ca.auc_roc - cb.auc_roc, 6) AS auc_delta, "
    "CASE WHEN ca.auc_roc - cb.auc_roc >= 0 THEN 'champion' ELSE 'challenger' END AS winner FROM ca, cb"))(q_champion_challenger)


def q_evaluation_report(spark, sf_dir):
    """test = current period, reference probabilities = earlier period (for PSI)."""
    ref, cur = _drift_split(_scored(spark, sf_dir))
    return _round_all(EV.evaluation_report(cur, TARGET, "default_prob", train=ref, train_prob="default_prob"))


def _sql_report() -> str:
    cur = "scur"
    ctes = _SPLIT_SQL + [
        _sql_rank(cur, TARGET, "default_prob", "rk"),
        f"base AS (SELECT count(*) AS n_samples, avg(CAST({TARGET} AS DOUBLE)) AS default_rate, "
        f"avg((default_prob - {TARGET}) * (default_prob - {TARGET})) AS brier_score FROM {cur})",
        (f"curve AS (SELECT b, avg(default_prob) AS mp, avg(CAST({TARGET} AS DOUBLE)) AS fp_, count(*) AS c "
         f"FROM (SELECT *, {_sql_bin('default_prob', EV.PROB_EDGES_10, False)} AS b FROM {cur}) WHERE b IS NOT NULL GROUP BY b)"),
        f"ece_t AS (SELECT coalesce(sum(c * abs(fp_ - mp)) / (SELECT count(*) FROM {cur}), 0) AS ece FROM curve)",
        _SWEEP_SQL.replace("FROM thr t, scored s", f"FROM thr t, {cur} s"),
        f"rates AS ({_rates_sql('best').replace('SELECT ', 'SELECT threshold AS optimal_threshold, ', 1)})",
        f"sc AS (SELECT {SC.sql_score('default_prob')} AS s FROM {cur})",
        "sst AS (SELECT avg(s) AS score_mean, stddev_pop(s) AS score_std, CAST(min(s) AS INTEGER) AS score_min, "
        "CAST(max(s) AS INTEGER) AS score_max FROM sc)",
        _sql_psi("sref", cur, "default_prob"),
    ]
    final = ("SELECT round(rk.auc_roc, 6) AS auc_roc, round(rk.gini, 6) AS gini, round(rk.ks_statistic, 6) AS ks_statistic, "
             "round(rk.average_precision, 6) AS average_precision, base.n_samples, round(base.default_rate, 6) AS default_rate, "
             "round(base.brier_score, 6) AS brier_score, round(ece_t.ece, 6) AS ece, round(rates.optimal_threshold, 6) AS optimal_threshold, "
             "rates.tn, rates.fp, rates.fn, rates.tp, rates.total_cost, rates.cost_per_decision, rates.precision, rates.recall, rates.f1, "
             "round(sst.score_mean, 6) AS score_mean, round(sst.score_std, 6) AS score_std, sst.score_min, sst.score_max, "
             "round(psi_t.psi, 6) AS psi FROM rk, base, ece_t, rates, sst, psi_t")
    return _oracle(["scored"], ctes, final)


register("a30_evaluation_report", _sql_report())(q_evaluation_report)


# --- drift over the application fixture -----------------------------------------
from .operators import drift as DR  # noqa: E402

_APP_SPLIT_SQL = [f"aref AS (SELECT * FROM applications WHERE applied_at < TIMESTAMP '{FX.DRIFT_CUTOFF}')",
                  f"acur AS (SELECT * FROM applications WHERE applied_at >= TIMESTAMP '{FX.DRIFT_CUTOFF}')"]
_DRIFT_SQL = _APP_SPLIT_SQL + DR.sql_drift_report("aref", "acur", S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES)


def _app_split(spark, sf_dir):
    return _drift_split(FX.applications(spark, sf_dir))


def q_drift_report(spark, sf_dir):
    ref, cur = _app_split(spark, sf_dir)
    rep = DR.drift_report(ref, cur, S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES)
    return rep.select("feature", r6("psi").alias("psi"), "status", "n_reference", "n_current")


register("a16_drift_report", _oracle(["applications"], _DRIFT_SQL,
         "SELECT feature, round(psi, 6) AS psi, status, n_reference, n_current FROM drift_rep "
         "ORDER BY psi DESC, feature"))(q_drift_report)


def q_drift_rollup(spark, sf_dir):
    ref, cur = _app_split(spark, sf_dir)
    return DR.drift_rollup(DR.drift_report(ref, cur, S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES))


register("a17_drift_rollup", _oracle(["applications"], _DRIFT_SQL, DR.sql_drift_rollup()))(q_drift_rollup)


def q_numeric_psi(spark, sf_dir):
    ref, cur = _app_split(spark, sf_dir)
    return DR.numeric_psi(ref, cur, S.NUMERIC_FEATURES).select("feature", r6("psi").alias("psi"))


register("a14_numeric_psi", _oracle(["applications"], _DRIFT_SQL,
         "SELECT feature, round(psi, 6) AS psi FROM dr_num"))(q_numeric_psi)


def q_categorical_psi(spark, sf_dir):
    ref, cur = _app_split(spark, sf_dir)
    return DR.categorical_psi(ref, cur, S.CATEGORICAL_FEATURES).select("feature", r6("psi").alias("psi"))


register("a15_j3_categorical_psi", _oracle(["applications"], _DRIFT_SQL,
         "SELECT feature, round(psi, 6) AS psi FROM dr_cat"))(q_categorical_psi)


def q_category_union(spark, sf_dir):
    ref, cur = _app_split(spark, sf_dir)
    return DR.category_union(ref, cur, "grade")


register("u2_category_union", _oracle(["applications"], _APP_SPLIT_SQL,
         "SELECT DISTINCT category FROM (SELECT grade AS category FROM aref UNION SELECT grade FROM acur) "
         "WHERE category IS NOT NULL"))(q_category_union)


def q_category_unions(spark, sf_dir):
    """U2 over every categorical column."""
    ref, cur = _app_split(spark, sf_dir)
    return DR.category_unions(ref, cur, S.CATEGORICAL_FEATURES)


register("u2_category_union_all", _oracle(["applications"], _APP_SPLIT_SQL, " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS feature, category FROM (SELECT {c} AS category FROM aref UNION SELECT {c} FROM acur) "
    "WHERE category IS NOT NULL" for c in S.CATEGORICAL_FEATURES)))(q_category_unions)


# --- prediction-log reports -------------------------------------------------------
from pyspark.sql import types as T  # noqa: E402

from .operators import logreports as LR  # noqa: E402

_LOG_COLS = ["id", "application_id", "timestamp", "default_prob", "decision", "model_version",
             "latency_ms", "features_json"]
_ASOF = "(SELECT max(timestamp) FROM prediction_log)"


def _log(spark, sf_dir):
    return FX.prediction_log(spark, sf_dir)


def _in_window(hours: int) -> str:
    return f"timestamp >= {_ASOF} - INTERVAL {hours} HOUR"


def q_recent(spark, sf_dir):
    return LR.recent(_log(spark, sf_dir), 24).select(*_LOG_COLS)


register("p12_o2_recent_24h", _oracle(["prediction_log"], [],
         f"SELECT {', '.join(_LOG_COLS)} FROM prediction_log WHERE {_in_window(24)} "
         "ORDER BY timestamp DESC, id DESC"))(q_recent)

LOG_FEATURE_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def q_log_features(spark, sf_dir):
    return LR.read_log_features(_log(spark, sf_dir), LOG_FEATURE_SCHEMA, 168)


register("s6_log_features_168h", _oracle(["prediction_log"], [],
         "SELECT id, application_id, CAST(json_extract(features_json, '$.k') AS BIGINT) AS k "
         f"FROM prediction_log WHERE {_in_window(168)} AND json_valid(features_json)"))(q_log_features)


def q_decision_counts(spark, sf_dir):
    return LR.decision_counts(_log(spark, sf_dir), 24)


register("a25_decision_counts_24h", _oracle(["prediction_log"], [],
         f"SELECT decision, count(*) AS cnt FROM prediction_log WHERE {_in_window(24)} GROUP BY decision"))(q_decision_counts)


def _sql_pct(src: str) -> str:
    return (f"SELECT coalesce(list_sort(list(latency_ms))[CAST(least(floor(0.5 * count(*)), count(*) - 1) AS BIGINT) + 1], 0.0) AS p50, "
            f"coalesce(list_sort(list(latency_ms))[CAST(least(floor(0.95 * count(*)), count(*) - 1) AS BIGINT) + 1], 0.0) AS p95, "
            f"coalesce(list_sort(list(latency_ms))[CAST(least(floor(0.99 * count(*)), count(*) - 1) AS BIGINT) + 1], 0.0) AS p99 "
            f"FROM {src}")


def q_latency_pct(spark, sf_dir):
    return LR.latency_percentiles(_log(spark, sf_dir), 1)


register("w4_latency_percentiles_1h", _oracle(["prediction_log"], [
    f"l1 AS (SELECT * FROM prediction_log WHERE {_in_window(1)})"], _sql_pct("l1")))(q_latency_pct)


def q_total_count(spark, sf_dir):
    return LR.total_count(_log(spark, sf_dir))


register("a27_log_row_count", _oracle(["prediction_log"], [],
         "SELECT count(*) AS total_predictions FROM prediction_log"))(q_total_count)


def q_operational_metrics(spark, sf_dir):
    return LR.operational_metrics(_log(spark, sf_dir))


register("a26_operational_metrics", _oracle(["prediction_log"], [
    f"l1 AS (SELECT * FROM prediction_log WHERE {_in_window(1)})",
    f"l24 AS (SELECT *, {SC.sql_score('default_prob')} AS s FROM prediction_log WHERE {_in_window(24)})",
    f"pct AS ({_sql_pct('l1')})",
    "m AS (SELECT count(*) AS n24, sum(CASE WHEN decision = 'APPROVE' THEN 1 ELSE 0 END) AS n_app, "
    "sum(CASE WHEN decision = 'REVIEW' THEN 1 ELSE 0 END) AS n_rev, sum(CASE WHEN decision = 'DECLINE' THEN 1 ELSE 0 END) AS n_dec, "
    "avg(default_prob) AS avg_p, avg(s) AS avg_s, avg(latency_ms) AS avg_l FROM l24)"],
    "SELECT (SELECT count(*) FROM prediction_log) AS total_predictions, (SELECT count(*) FROM l1) AS predictions_last_hour, "
    "CASE WHEN n24 > 0 THEN round(n_app / n24, 4) ELSE 0.0 END AS approval_rate, "
    "CASE WHEN n24 > 0 THEN round(n_rev / n24, 4) ELSE 0.0 END AS review_rate, "
    "CASE WHEN n24 > 0 THEN round(n_dec / n24, 4) ELSE 0.0 END AS decline_rate, "
    "coalesce(round(avg_p, 4), 0.0) AS avg_default_probability, coalesce(round(avg_s, 1), 0.0) AS avg_risk_score, "
    "coalesce(round(avg_l, 2), 0.0) AS avg_latency_ms, pct.p95 AS p95_latency_ms, pct.p99 AS p99_latency_ms "
    "FROM m, pct"))(q_operational_metrics)


# --- scalar rules -----------------------------------------------------------------
from .functions import validation as VA  # noqa: E402
from .functions.sqlfuncs import register_sql_functions  # noqa: E402
from .plans import scoring as SCO  # noqa: E402

_APP_COLS = ["application_id"] + S.ALL_FEATURES


def q_derived(spark, sf_dir):
    df = _derived_apps(spark, sf_dir)
    return df.select("application_id", *[r6(c).alias(c) for c in S.DERIVED_FEATURES])


register("p1_derived_features", _oracle(["applications"], [_SQL_DERIVED_APPS],
         "SELECT application_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in S.DERIVED_FEATURES)
         + " FROM apps_d"))(q_derived)


def q_select_columns(spark, sf_dir):
    """Keep the listed columns that exist (unknown names are ignored)."""
    return rules.select_columns(FX.applications(spark, sf_dir),
                                ["application_id", "grade", "no_such_column", "debt_to_income"])


register("p2_select_columns", _oracle(["applications"], [],
         "SELECT application_id, grade, debt_to_income FROM applications"))(q_select_columns)


def q_validate(spark, sf_dir):
    v = VA.validate_applications(FX.applications(spark, sf_dir).select(*_APP_COLS))
    return v.select("application_id", F.size("errors").alias("n_errors"),
                    F.array_join("errors", ";").alias("errors"), "is_valid")


register("p3_validate_applications", _oracle(["applications"], [
    f"va AS (SELECT application_id, {VA.sql_validation_errors(_APP_COLS)} AS errs FROM applications)"],
    "SELECT application_id, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(errs, ';') AS errors, "
    "len(errs) = 0 AS is_valid FROM va"))(q_validate)


def q_violation_counts(spark, sf_dir):
    return VA.violation_counts(FX.applications(spark, sf_dir).select(*_APP_COLS))


register("p3_rule_violation_counts", _oracle(["applications"], [
    f"va AS (SELECT unnest({VA.sql_validation_errors(_APP_COLS)}) AS rule FROM applications)"],
    "SELECT rule, count(*) AS n FROM va GROUP BY rule"))(q_violation_counts)


def _sql_broken() -> str:
    """Applications of which each breaks one bound, domain or requirement, chosen by its key."""
    breaks: list[tuple[str, str]] = []
    for name, required, lo, lo_inc, hi, _, integer in VA.NUMERIC_RULES:
        breaks += [(name, "CAST(NULL AS DOUBLE)")] * required
        breaks += [(name, f"{lo}e0 - 1e0"), (name, f"{lo}e0")]
        breaks += [] if hi is None else [(name, f"{hi}e0 + 1e0"), (name, f"{hi}e0")]
        breaks += [(name, f"{lo}e0 + 0.5e0")] * integer
    for name, _ in VA.ENUM_RULES:
        breaks += [(name, "CAST(NULL AS VARCHAR(20))"), (name, "'none of these'")]
    cols = ["application_id"]
    for c in S.ALL_FEATURES:
        arms = " ".join(f"WHEN {i} THEN {v}" for i, (name, v) in enumerate(breaks) if name == c)
        cols.append(f"CASE k % {len(breaks) + 1} {arms} ELSE {c} END AS {c}" if arms else c)
    return f"SELECT {', '.join(cols)} FROM applications"


def _broken(spark, sf_dir) -> DataFrame:
    return FX._spark_view(spark, sf_dir, FX._APPLICATIONS_CTES + [("broken", _sql_broken())], "broken",
                          ["lineitem", "orders", "customer"]).select(*_APP_COLS)


def q_validate_broken(spark, sf_dir):
    """P3 on applications that break every rule somewhere."""
    v = VA.validate_applications(_broken(spark, sf_dir))
    return v.select("application_id", F.size("errors").alias("n_errors"),
                    F.array_join("errors", ";").alias("errors"), "is_valid")


def q_broken_counts(spark, sf_dir):
    return VA.violation_counts(_broken(spark, sf_dir))


_BROKEN_SQL = [f"broken AS ({_sql_broken()})",
               f"vb AS (SELECT application_id, {VA.sql_validation_errors(_APP_COLS)} AS errs FROM broken)"]
register("p3_validate_broken_applications", _oracle(["applications"], _BROKEN_SQL,
         "SELECT application_id, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(errs, ';') AS errors, "
         "len(errs) = 0 AS is_valid FROM vb"))(q_validate_broken)
register("p3_broken_rule_counts", _oracle(["applications"], _BROKEN_SQL,
         "SELECT rule, count(*) AS n FROM (SELECT unnest(errs) AS rule FROM vb) GROUP BY rule"))(q_broken_counts)


def q_assign_id(spark, sf_dir):
    df = FX.applications(spark, sf_dir).select("k")
    return rules.assign_application_id(df, ["k"])


register("p4_assign_application_id", _oracle(["applications"], [],
         "SELECT k, concat('REQ-', upper(substr(md5(CAST(k AS VARCHAR)), 1, 12))) AS application_id "
         "FROM applications"))(q_assign_id)


def q_scorecard(spark, sf_dir):
    """P5-P8 over the scored fixture."""
    df = _scored(spark, sf_dir)
    s = SC.probability_to_score(F.col("default_prob"))
    return df.select("application_id", s.alias("risk_score"),
                     SC.score_to_decision(s).alias("score_decision"),
                     SC.probability_to_decision(F.col("default_prob")).alias("decision"),
                     SC.decision_confidence(F.col("default_prob")).alias("confidence"))


register("p5_p8_scorecard_rules", _oracle(["scored"], [
    f"s1 AS (SELECT *, {SC.sql_score('default_prob')} AS risk_score FROM scored)"],
    f"SELECT application_id, risk_score, {SC.sql_score_decision('risk_score')} AS score_decision, "
    f"{SC.sql_prob_decision('default_prob')} AS decision, {SC.sql_confidence('default_prob')} AS confidence "
    "FROM s1"))(q_scorecard)


def q_risk_logit(spark, sf_dir):
    df = FX.applications(spark, sf_dir)
    return df.select("application_id", r6(rules.risk_probability()).alias("risk_probability"))


register("p13_expert_risk_probability", _oracle(["applications"], [],
         f"SELECT application_id, round({rules.sql_risk_probability()}, 6) AS risk_probability "
         "FROM applications"))(q_risk_logit)


def q_score_applications(spark, sf_dir):
    df = FX.applications(spark, sf_dir).select(*_APP_COLS)
    return SCO.score_applications(df)


register("p15_score_applications", _oracle(["applications"], [],
         SCO.sql_score_applications("applications", _APP_COLS)))(q_score_applications)


def q_sql_functions(spark, sf_dir):
    """The rules called by name from Spark SQL."""
    register_sql_functions(spark)
    return spark.sql(
        "SELECT application_id, risk_score(default_prob) AS risk_score, "
        "score_decision(risk_score(default_prob)) AS score_decision, prob_decision(default_prob) AS decision, "
        "decision_confidence(default_prob) AS confidence FROM {scored}", scored=_scored(spark, sf_dir))


register("e2_sql_functions", ORACLE["p5_p8_scorecard_rules"])(q_sql_functions)


# --- preparation --------------------------------------------------------------------
from .operators import prepare as PR  # noqa: E402


def _apps(spark, sf_dir):
    return FX.applications(spark, sf_dir)


def q_class_balance(spark, sf_dir):
    return _round_all(PR.class_balance(_apps(spark, sf_dir), TARGET))


register("a8_class_balance", _oracle(["applications"], [],
         f"SELECT sum({TARGET}) AS n_pos, sum(1 - {TARGET}) AS n_neg, "
         f"round(sum(1 - {TARGET}) / greatest(sum({TARGET}), 1), 6) AS class_weight_ratio FROM applications"))(q_class_balance)


def q_profile(spark, sf_dir):
    df = _apps(spark, sf_dir).select(*_APP_COLS, TARGET)
    return PR.dataset_profile(df, TARGET)


register("a9_dataset_profile", _oracle(["applications"], [],
         f"SELECT count(*) AS n_rows, {len(_APP_COLS)} AS n_features, round(avg({TARGET}), 4) AS default_rate "
         "FROM applications"))(q_profile)


def q_missing(spark, sf_dir):
    return PR.missing_summary(_apps(spark, sf_dir).select(*_APP_COLS))


register("a10_missing_summary", _oracle(["applications"], [
    "ms AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS share "
                                    f"FROM applications" for c in _APP_COLS) + ")"],
    "SELECT column_name, round(share, 4) AS missing_pct FROM ms WHERE share > 0"))(q_missing)


def q_medians(spark, sf_dir):
    return PR.fit_medians(_apps(spark, sf_dir), S.NUMERIC_FEATURES).select("feature", r6("median").alias("median"))


_MED_SQL = ("med AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS median FROM applications"
                                            for c in S.NUMERIC_FEATURES) + ")")
register("a11_impute_medians", _oracle(["applications"], [_MED_SQL],
         "SELECT feature, round(median, 6) AS median FROM med"))(q_medians)


def q_imputed(spark, sf_dir):
    df = _apps(spark, sf_dir)
    med = {r["feature"]: r["median"] for r in PR.fit_medians(df, S.NUMERIC_FEATURES).collect()}
    out = PR.impute(df.select(*_APP_COLS), med, S.CATEGORICAL_FEATURES)
    return out.select("application_id", *[r6(c).alias(c) for c in S.NUMERIC_FEATURES], *S.CATEGORICAL_FEATURES)


register("a11_imputed_frame", _oracle(["applications"], [_MED_SQL],
         "SELECT application_id, " + ", ".join(
             f"round(coalesce({c}, (SELECT median FROM med WHERE feature = '{c}')), 6) AS {c}" for c in S.NUMERIC_FEATURES)
         + ", " + ", ".join(f"coalesce({c}, 'MISSING') AS {c}" for c in S.CATEGORICAL_FEATURES)
         + " FROM applications"))(q_imputed)


def q_scaler(spark, sf_dir):
    st = PR.fit_scaler(_apps(spark, sf_dir), S.NUMERIC_FEATURES)
    return st.select("feature", r6("mean").alias("mean"), r6("scale").alias("scale"))


register("a12_standardise_stats", _oracle(["applications"], [
    "st AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS sd FROM applications"
                                    for c in S.NUMERIC_FEATURES) + ")"],
    "SELECT feature, round(mean, 6) AS mean, round(CASE WHEN sd = 0 THEN 1.0 ELSE sd END, 6) AS scale FROM st"))(q_scaler)

_VIF3 = ["interest_rate", "debt_to_income", "credit_utilization_ratio"]


def q_vif3(spark, sf_dir):
    return PR.compute_vif(_apps(spark, sf_dir), _VIF3)


def _sql_vif3() -> tuple[str, str]:
    a, b, c = _VIF3
    cte = (f"cc AS (SELECT corr({a}, {b}) AS r_ab, corr({a}, {c}) AS r_ac, corr({b}, {c}) AS r_bc "
           f"FROM applications WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL)")

    def vif(rij, rik, rjk):
        r2 = f"(({rij} * {rij} + {rik} * {rik} - 2 * {rij} * {rik} * {rjk}) / (1 - {rjk} * {rjk}))"
        return f"round(1 / (1 - {r2}), 2)"
    final = (f"SELECT '{a}' AS feature, {vif('r_ab', 'r_ac', 'r_bc')} AS vif FROM cc UNION ALL "
             f"SELECT '{b}', {vif('r_ab', 'r_bc', 'r_ac')} FROM cc UNION ALL "
             f"SELECT '{c}', {vif('r_ac', 'r_bc', 'r_ab')} FROM cc")
    return cte, final


register("a28_vif_three_columns", _oracle(["applications"], [_sql_vif3()[0]], _sql_vif3()[1]))(q_vif3)


def q_vif_all(spark, sf_dir):
    """A28 over every numeric and derived feature (k x k inverse on the driver)."""
    return PR.compute_vif(_derived_apps(spark, sf_dir), WOE_NUMERIC)


_VIF_SQL = [_SQL_DERIVED_APPS.replace("AS (", "AS MATERIALIZED (", 1),
            *PR.sql_vif_rounds("apps_d", "application_id", WOE_NUMERIC)]
_VIF_ROUNDS = range(1, len(WOE_NUMERIC) + 1)


def _vif_oracle(final: str) -> str:
    return _oracle(["applications"], _VIF_SQL, final).replace("WITH ", "WITH RECURSIVE ", 1)


register("a28_vif_all_numeric", _vif_oracle("SELECT feature, vif FROM vif_v1"))(q_vif_all)


def q_vif_prune(spark, sf_dir):
    """Features kept after dropping the worst VIF until all <= 10."""
    df = _derived_apps(spark, sf_dir)
    kept, dropped, v = PR.drop_high_vif(df, WOE_NUMERIC)
    rows = [(c, "kept", round(float(v[c]), 2)) for c in kept] + [(c, "dropped", None) for c in dropped]
    return spark.createDataFrame(rows, "feature string, status string, vif double")


register("a29_vif_pruning", _vif_oracle(" UNION ALL ".join(
    f"SELECT feature, 'dropped' AS status, CAST(NULL AS DOUBLE) AS vif FROM vif_w{t} UNION ALL "
    f"SELECT feature, 'kept', vif FROM vif_v{t} WHERE NOT EXISTS (SELECT 1 FROM vif_w{t})" for t in _VIF_ROUNDS)))(q_vif_prune)


def q_vif_rounds(spark, sf_dir):
    """Rows complete in the round's columns, the column it drops and its VIF."""
    rounds, _, _ = PR.vif_rounds(_derived_apps(spark, sf_dir), WOE_NUMERIC)
    rows = [(i, n, c, None if v is None else round(float(v), 2)) for i, (n, c, v) in enumerate(rounds, 1)]
    return spark.createDataFrame(rows, "round int, n_rows long, dropped string, vif double")


register("a29_vif_rounds", _vif_oracle(" UNION ALL ".join(
    f"SELECT {t} AS round, (SELECT count(*) FROM vif_c{t}) AS n_rows, (SELECT feature FROM vif_w{t}) AS dropped, "
    f"(SELECT vif FROM vif_w{t}) AS vif WHERE EXISTS (SELECT 1 FROM vif_f{t - 1})" for t in _VIF_ROUNDS)))(q_vif_rounds)

_SPLIT_HASH_SQL = "CAST('0x' || substr(md5(CAST(application_id AS VARCHAR) || ':42'), 1, 15) AS BIGINT)"
_SPLIT_SQL_CTE = (
    f"sp_h AS (SELECT application_id, {TARGET}, {_SPLIT_HASH_SQL} AS h, "
    f"row_number() OVER (PARTITION BY {TARGET} ORDER BY {_SPLIT_HASH_SQL}) - 1 AS r, "
    f"count(*) OVER (PARTITION BY {TARGET}) AS n FROM applications),\n"
    "sp AS (SELECT application_id, dflt, CASE WHEN r < ceil(0.2 * n) THEN 'test' "
    "WHEN r < ceil(0.2 * n) + ceil(0.125 * (n - ceil(0.2 * n))) THEN 'val' ELSE 'train' END AS split, r, n FROM sp_h)")


def q_split(spark, sf_dir):
    return PR.stratified_split(_apps(spark, sf_dir).select("application_id", TARGET), TARGET)


register("w6_stratified_split", _oracle(["applications"], [_SPLIT_SQL_CTE],
         "SELECT application_id, dflt, split FROM sp"))(q_split)


def q_split_shares(spark, sf_dir):
    s = PR.stratified_split(_apps(spark, sf_dir).select("application_id", TARGET), TARGET)
    return s.groupBy("split", TARGET).agg(F.count(F.lit(1)).alias("n"))


register("w6_split_class_counts", _oracle(["applications"], [_SPLIT_SQL_CTE],
         "SELECT split, dflt, count(*) AS n FROM sp GROUP BY ALL"))(q_split_shares)


def q_folds(spark, sf_dir):
    return PR.stratified_folds(_apps(spark, sf_dir).select("application_id", TARGET), 5, TARGET)


register("w8_stratified_folds", _oracle(["applications"], [_SPLIT_SQL_CTE],
         "SELECT application_id, dflt, CAST(" + " + ".join(
             f"CASE WHEN r >= floor({j} * n / 5) THEN 1 ELSE 0 END" for j in range(1, 5))
         + " AS INTEGER) AS fold FROM sp"))(q_folds)


def q_train_val(spark, sf_dir):
    s = PR.stratified_split(_apps(spark, sf_dir).select("application_id", TARGET), TARGET)
    return PR.train_val(s)


register("u1_train_union_val", _oracle(["applications"], [_SPLIT_SQL_CTE],
         "SELECT application_id, dflt, split FROM sp WHERE split IN ('train', 'val')"))(q_train_val)


def q_sample(spark, sf_dir):
    return PR.uniform_sample(_apps(spark, sf_dir).select("application_id", "grade"), 500)


register("o4_reference_sample_500", _oracle(["applications"], [],
         f"SELECT application_id, grade FROM applications ORDER BY {_SPLIT_HASH_SQL}, application_id LIMIT 500"))(q_sample)


# --- sources -------------------------------------------------------------------------
from .sources import files as FI  # noqa: E402
from .sources import predlog as PL  # noqa: E402


def q_read_dataset(spark, sf_dir):
    """The reader on a given table (parquet by extension), every column and row."""
    return FI.read_dataset(spark, f"{sf_dir}/orders.parquet")


register("s1_read_dataset", _oracle([], [], "SELECT * FROM orders")
         .replace("WITH \n", ""))(q_read_dataset)


def q_enforce_schema(spark, sf_dir):
    """Applications as text (as a CSV gives them) plus a leakage column -> typed frame."""
    df = FX.applications(spark, sf_dir)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in _APP_COLS],
                     F.col(TARGET).cast("string").alias("default"), F.lit("0.5").alias("default_probability_true"))
    out = FI.enforce_schema(text)
    return out.select("application_id", *[r6(c).alias(c) for c in S.NUMERIC_FEATURES], *S.CATEGORICAL_FEATURES,
                      "default")


register("s2_enforce_schema", _oracle(["applications"], [],
         "SELECT application_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in S.NUMERIC_FEATURES) + ", "
         + ", ".join(S.CATEGORICAL_FEATURES) + f", CAST({TARGET} AS INTEGER) AS \"default\" FROM applications"))(q_enforce_schema)


def q_log_rows(spark, sf_dir):
    """The log row shape for scored applications (features as JSON text)."""
    df = FX.applications(spark, sf_dir).select(*_APP_COLS, "applied_at")
    scored_df = SCO.score_applications(df, only_valid=False).join(df.select("application_id", "applied_at", "grade",
                                                                          "loan_purpose"), "application_id")
    rows = PL.log_rows(scored_df, ["grade", "loan_purpose"], "default_probability", F.col("model_version"),
                       ts=F.col("applied_at"))
    return rows.select("application_id", "timestamp", "default_prob", "risk_score", "decision", "confidence",
                       "model_version", "features_json")


register("s5_prediction_log_rows", _oracle(["applications"], [
    f"sa AS (SELECT application_id, applied_at, grade, loan_purpose, round({SCO.sql_imputed_probability('applications')}, 6) AS p "
    "FROM applications)"],
    f"SELECT application_id, applied_at AS timestamp, p AS default_prob, {SC.sql_score('p')} AS risk_score, "
    f"{SC.sql_prob_decision('p')} AS decision, {SC.sql_confidence('p')} AS confidence, "
    "'expert-logit-v1' AS model_version, to_json(struct_pack(grade := grade, loan_purpose := loan_purpose)) AS features_json "
    "FROM sa"))(q_log_rows)


# --- models (rows-only checks: fits are iterative) ------------------------------------
from .plans import models as MO  # noqa: E402
from .session import cut_lineage, persisted  # noqa: E402


def _model_frames(spark, sf_dir):
    """train+val and test rows of the application fixture (W6 split), lineage cut once."""
    with persisted(FX.applications(spark, sf_dir).withColumn(TARGET, F.col(TARGET).cast("double"))) as df:
        s = cut_lineage(PR.stratified_split(df, TARGET))
    return PR.train_val(s), s.where(F.col("split") == "test")


def _test_report(model, test):
    scored_test = cut_lineage(model.transform(test).select(TARGET, MO.PROB_COL))  # read by every metric
    return _round_all(EV.evaluation_report(scored_test, TARGET, MO.PROB_COL))


def q_feature_pipeline(spark, sf_dir):
    """M1: derive -> impute -> WoE -> scale, fitted on train+val, applied to every row."""
    from pyspark.ml import Pipeline
    from .plans.stages import DerivedFeatureAdder
    tv, _ = _model_frames(spark, sf_dir)
    stages, _vec = MO.feature_stages(MO.MODEL_FEATURES, TARGET)
    pm = Pipeline(stages=[DerivedFeatureAdder()] + stages[:-1]).fit(tv)
    out = pm.transform(FX.applications(spark, sf_dir))
    return out.select("application_id", *[r6(f"{c}__z").alias(c) for c in MO.MODEL_FEATURES])


register("m1_feature_pipeline")(q_feature_pipeline)


def q_scorecard_model(spark, sf_dir):
    """M3 (transparent scorecard): WoE + logistic regression, test-set report."""
    tv, test = _model_frames(spark, sf_dir)
    return _test_report(MO.fit_plain(tv, TARGET, kind="logistic"), test)


register("m3_woe_logistic_scorecard")(q_scorecard_model)


def q_calibrated_scorecard(spark, sf_dir):
    """M4: 5-fold sigmoid-calibrated ensemble of the scorecard pipeline."""
    tv, test = _model_frames(spark, sf_dir)
    return _test_report(MO.fit_calibrated(tv, TARGET, kind="logistic", method="sigmoid", parallelism=5), test)


register("m4_sigmoid_calibrated_scorecard")(q_calibrated_scorecard)


def q_isotonic_scorecard(spark, sf_dir):
    """M5: the same ensemble with isotonic calibrators."""
    tv, test = _model_frames(spark, sf_dir)
    return _test_report(MO.fit_calibrated(tv, TARGET, kind="logistic", method="isotonic", parallelism=5), test)


register("m5_isotonic_calibrated_scorecard")(q_isotonic_scorecard)


def q_champion_booster(spark, sf_dir):
    """M2: boosted trees with the fixed defaults (300 trees, depth 4, lr .05, subsample .8)
    and the class weight n_neg / n_pos, test-set report."""
    tv, test = _model_frames(spark, sf_dir)
    bal = PR.class_balance(tv, TARGET).first()
    model = MO.fit_plain(tv, TARGET, kind="champion", class_weight_ratio=bal["class_weight_ratio"])
    return _test_report(model, test)


register("m2_champion_booster")(q_champion_booster)


def q_batch_scoring(spark, sf_dir):
    """M8 + P15: score every application with the fitted scorecard model."""
    tv, _ = _model_frames(spark, sf_dir)
    model = MO.fit_plain(tv, TARGET, kind="logistic")
    apps = FX.applications(spark, sf_dir).select(*_APP_COLS)
    scored_df = model.transform(apps)
    return scored_df.select("application_id", r6(MO.PROB_COL).alias("default_probability"),
                            SC.probability_to_score(F.col(MO.PROB_COL)).alias("risk_score"),
                            SC.probability_to_decision(F.col(MO.PROB_COL)).alias("decision"),
                            SC.decision_confidence(F.col(MO.PROB_COL)).alias("confidence"))


register("m8_batch_scoring_scorecard")(q_batch_scoring)


def q_latest_versions(spark, sf_dir):
    """Registry rows derived from the log (version, first/last use); newest per role."""
    log = _log(spark, sf_dir)
    reg = (log.groupBy("model_version").agg(F.min("timestamp").alias("created_at"),
                                            F.max("timestamp").alias("last_used"),
                                            F.count(F.lit(1)).alias("n_predictions"))
           .withColumn("role", F.when(F.col("model_version").startswith("v_"), "champion").otherwise("other"))
           .withColumnRenamed("model_version", "version"))
    return MO.latest_models(reg, "role", "created_at", None, "version")


register("w7_latest_model_version", _oracle(["prediction_log"], [
    "rg AS (SELECT model_version AS version, min(timestamp) AS created_at, max(timestamp) AS last_used, "
    "count(*) AS n_predictions, CASE WHEN starts_with(model_version, 'v_') THEN 'champion' ELSE 'other' END AS role "
    "FROM prediction_log GROUP BY model_version)"],
    "SELECT version, created_at, last_used, n_predictions, role FROM rg "
    "QUALIFY row_number() OVER (PARTITION BY role ORDER BY created_at DESC, version DESC) = 1"))(q_latest_versions)


# --- explanations ------------------------------------------------------------------------
from .operators import explain as XP  # noqa: E402


def q_attribution(spark, sf_dir):
    apps = _apps(spark, sf_dir)
    a = XP.expert_attribution(apps, 5, medians=SCO.optional_medians(apps))
    return a.select("application_id", "rank", "feature", r6("impact").alias("impact"), "direction",
                    r6("base_value").alias("base_value"))


_SQL_ATTR = XP.sql_attribution("applications", 5, optional=SCO.OPTIONAL)
_SQL_CF = XP.sql_counterfactual("applications", optional=SCO.OPTIONAL)
register("x1_w5_o3_top5_attribution", _oracle(["applications"], _SQL_ATTR,
         "SELECT application_id, rank, feature, round(impact, 6) AS impact, direction, "
         "round(base_value, 6) AS base_value FROM attr"))(q_attribution)


def _counterfactual(spark, sf_dir):
    apps = _apps(spark, sf_dir)
    return XP.counterfactual(apps, XP.imputing_scorer(SCO.optional_medians(apps)))


def q_counterfactual(spark, sf_dir):
    return _counterfactual(spark, sf_dir).drop("change_values")


register("x3_counterfactual", _oracle(["applications"], _SQL_CF, "SELECT * FROM cf_out"))(q_counterfactual)


def q_counterfactual_changes(spark, sf_dir):
    """One row per suggested change, with the current and the suggested value."""
    return _counterfactual(spark, sf_dir).select("application_id", F.inline("change_values"))


register("x3_counterfactual_changes", _oracle(["applications"], _SQL_CF,
         "SELECT * FROM cf_changes"))(q_counterfactual_changes)


def q_explanation_table(spark, sf_dir):
    apps = _apps(spark, sf_dir)
    t = XP.explanation_table(apps, medians=SCO.optional_medians(apps))
    return t.select(
        "application_id", "default_probability", "decision", r6("base_value").alias("base_value"),
        F.array_join(F.col("top_factors.feature"), ";").alias("top_factors"),
        r6(F.get("top_factors.impact", F.lit(0))).alias("top_impact"), "n_changes",
        F.array_join(F.col("change_values.feature"), ";").alias("changed_features"),
        "counterfactual_probability", "counterfactual_decision", "achievable")


register("x4_explanation_table", _oracle(["applications"], [*_SQL_ATTR, *_SQL_CF,
    f"xp AS (SELECT application_id, round({SCO.sql_imputed_probability('applications')}, 6) AS default_probability "
    "FROM applications)",
    "xf AS (SELECT application_id, string_agg(feature, ';' ORDER BY rank) AS top_factors, "
    "round(max(base_value), 6) AS base_value, round(max(CASE WHEN rank = 1 THEN impact END), 6) AS top_impact "
    "FROM attr GROUP BY application_id)"],
    "SELECT application_id, default_probability, decision, base_value, top_factors, top_impact, n_changes, "
    "changed_features, counterfactual_probability, counterfactual_decision, achievable "
    "FROM xp JOIN xf USING (application_id) JOIN cf_out USING (application_id)"))(q_explanation_table)


# --- streaming (run with availableNow, sink read back) ---------------------------------
from .streaming import streams as ST  # noqa: E402


def q_stream_score(spark, sf_dir):
    """Equals the batch P15 result once the stream has consumed every file."""
    path = ST.stream_score(spark, sf_dir)
    return spark.read.parquet(path).select("application_id", "default_probability", "risk_score", "decision",
                                           "confidence", "model_version")


register("t1_stream_score", ORACLE["p15_score_applications"])(q_stream_score)


def q_stream_metrics(spark, sf_dir):
    """Closed sliding windows; equals the batch windows ending <= max(ts) - 1 h."""
    return spark.read.parquet(ST.stream_metrics(spark, sf_dir))


def q_stream_metrics_1h(spark, sf_dir):
    """T2 with tumbling windows of one hour."""
    return spark.read.parquet(ST.stream_metrics(spark, sf_dir, size="1 hour"))


def _sql_window_metrics(hours: int = 24) -> str:
    return _oracle(["prediction_log"], [
        "wl AS (SELECT l.*, date_trunc('hour', l.timestamp) - to_hours(r.k) AS ws "
        f"FROM prediction_log l, range(0, {hours}) r(k))",
        f"wm AS (SELECT ws, count(*) AS n, sum(CASE WHEN decision = 'APPROVE' THEN 1 ELSE 0 END) AS n_app, "
        "sum(CASE WHEN decision = 'REVIEW' THEN 1 ELSE 0 END) AS n_rev, "
        "sum(CASE WHEN decision = 'DECLINE' THEN 1 ELSE 0 END) AS n_dec, avg(default_prob) AS avg_p, "
        f"avg({SC.sql_score('default_prob')}) AS avg_s, avg(latency_ms) AS avg_l FROM wl GROUP BY ws)"],
        f"SELECT ws AS window_start, ws + INTERVAL {hours} HOUR AS window_end, n, "
        "round(n_app / n, 4) AS approval_rate, round(n_rev / n, 4) AS review_rate, round(n_dec / n, 4) AS decline_rate, "
        "round(avg_p, 4) AS avg_default_probability, round(avg_s, 1) AS avg_risk_score, round(avg_l, 2) AS avg_latency_ms "
        f"FROM wm WHERE ws + INTERVAL {hours} HOUR <= {_ASOF} - INTERVAL 1 HOUR")


register("t2_stream_window_metrics", _sql_window_metrics())(q_stream_metrics)
register("t2_stream_window_metrics_1h", _sql_window_metrics(1))(q_stream_metrics_1h)


def q_stream_drift(spark, sf_dir):
    """Drift report written by foreachBatch (168 h current window vs the older log)."""
    rep = spark.read.parquet(ST.stream_drift(spark, sf_dir))
    return rep.select("feature", r6("psi").alias("psi"), "status", "n_reference", "n_current")


_LOG_SPLIT = [
    "lg AS (SELECT id, timestamp, CAST(json_extract(features_json, '$.k') AS BIGINT) AS k FROM prediction_log "
    "WHERE json_valid(features_json))",
    f"lref AS (SELECT k FROM lg WHERE timestamp < {_ASOF} - INTERVAL 168 HOUR)",
    f"lcur AS (SELECT k FROM lg WHERE timestamp >= {_ASOF} - INTERVAL 168 HOUR)"]
register("t3_stream_drift", _oracle(["prediction_log"], _LOG_SPLIT + DR.sql_drift_report("lref", "lcur", ["k"], []),
         "SELECT feature, round(psi, 6) AS psi, status, n_reference, n_current FROM drift_rep"))(q_stream_drift)


def q_local_surrogate(spark, sf_dir):
    """500 perturbed samples per application, ridge weights, top 8."""
    return XP.local_surrogate(_apps(spark, sf_dir), n_samples=500, top_n=8)


register("x2_local_surrogate_top8")(q_local_surrogate)


def q_tree_attribution(spark, sf_dir):
    """X1(b) + W5 + O3: path attribution of the champion booster (fixed defaults, class weight)
    for every application; top 5 per application; additive to the margin."""
    from .plans.stages import DerivedFeatureAdder
    tv, _ = _model_frames(spark, sf_dir)
    bal = PR.class_balance(tv, TARGET).first()
    model = MO.fit_plain(tv, TARGET, kind="champion", class_weight_ratio=bal["class_weight_ratio"])
    pm = model.folds[0]
    feats = pm.transform(DerivedFeatureAdder().transform(FX.applications(spark, sf_dir)))
    att = XP.tree_attribution(feats, pm.stages[-1], "features0", MO.MODEL_FEATURES, top_n=5)
    return att.select("application_id", "rank", "feature", r6("impact").alias("impact"), "direction",
                      r6("base_value").alias("base_value"), r6("margin").alias("margin"))


register("x1b_tree_attribution_top5")(q_tree_attribution)


# --- the fitted scorecard on the decision path (M3, M4, M8, P15, X1, X3, X4, T1) -------------------
from .plans import scorecard as SCF  # noqa: E402
from .plans import scorecard_sql as SCQ  # noqa: E402

_SCORECARDS: dict[tuple[str, str], SCF.Scorecard] = {}


def scorecard_of(spark, sf_dir) -> SCF.Scorecard:
    """The scorecard fitted to the applications of ``sf_dir``, once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SCORECARDS:
        _SCORECARDS[key] = SCF.fit_scorecard(FX.applications(spark, sf_dir), TARGET)
    return _SCORECARDS[key]


_SCF_CTES = [_SQL_DERIVED_APPS.replace("AS (", "AS MATERIALIZED (", 1),
             _SPLIT_SQL_CTE.replace("sp AS (", "sp AS MATERIALIZED ("), *SCQ.sql_fit("apps_d", TARGET, "sp")]


def _scf_oracle(extra: list[str], final: str) -> str:
    return _oracle(["applications"], _SCF_CTES + extra, final).replace("WITH ", "WITH RECURSIVE ", 1)


def q_scorecard_parameters(spark, sf_dir):
    """M3 + M4: the fitted numbers of every fold: intercept, coefficients, sigmoid."""
    m = scorecard_of(spark, sf_dir)
    rows = [(g, t, float(v)) for g in range(m.folds) for t, v in [
        ("(intercept)", m.intercepts[g]), *m.coefficients[g].items(), ("(sigmoid a)", m.sigmoids[g][0]),
        ("(sigmoid b)", m.sigmoids[g][1])]]
    return _round_all(spark.createDataFrame(rows, "fold int, term string, value double"))


register("m4_scorecard_parameters", _scf_oracle([], SCQ.sql_parameters()))(q_scorecard_parameters)


def q_scorecard_test_report(spark, sf_dir):
    """M4 + A30: the calibrated scorecard on the test split."""
    m = scorecard_of(spark, sf_dir)
    with persisted(FX.applications(spark, sf_dir).select("application_id", TARGET, *S.ALL_FEATURES)) as apps:  # read by each pass of the split
        test = PR.stratified_split(apps, TARGET).where("split = 'test'")
        scored_test = cut_lineage(m.transform(test).select("application_id", TARGET, MO.PROB_COL))  # read by every metric
    return _round_all(EV.evaluation_report(scored_test, TARGET, MO.PROB_COL))


def _sql_scorecard_report() -> str:
    ctes = [f"scored AS MATERIALIZED (SELECT application_id, {TARGET}, p AS default_prob FROM sp JOIN sc_prob USING (application_id) "
            "WHERE split = 'test')", _sql_rank("scored", TARGET, "default_prob", "rk"),
            f"base AS (SELECT count(*) AS n_samples, avg(CAST({TARGET} AS DOUBLE)) AS default_rate, "
            f"avg((default_prob - {TARGET}) * (default_prob - {TARGET})) AS brier_score FROM scored)",
            _CURVE_SQL, "ece_t AS (SELECT coalesce(sum(count * abs(fraction_positive - mean_predicted)) / "
            "(SELECT count(*) FROM scored), 0) AS ece FROM curve)", _SWEEP_SQL,
            f"rates AS ({_rates_sql('best').replace('SELECT ', 'SELECT threshold AS optimal_threshold, ', 1)})",
            f"scs AS (SELECT {SC.sql_score('default_prob')} AS s FROM scored)",
            "sst AS (SELECT avg(s) AS score_mean, stddev_pop(s) AS score_std, CAST(min(s) AS INTEGER) AS score_min, "
            "CAST(max(s) AS INTEGER) AS score_max FROM scs)"]
    return _scf_oracle(ctes, "SELECT round(rk.auc_roc, 6) AS auc_roc, round(rk.gini, 6) AS gini, "
                       "round(rk.ks_statistic, 6) AS ks_statistic, round(rk.average_precision, 6) AS average_precision, "
                       "base.n_samples, round(base.default_rate, 6) AS default_rate, round(base.brier_score, 6) AS brier_score, "
                       "round(ece_t.ece, 6) AS ece, round(rates.optimal_threshold, 6) AS optimal_threshold, rates.tn, rates.fp, "
                       "rates.fn, rates.tp, rates.total_cost, rates.cost_per_decision, rates.precision, rates.recall, rates.f1, "
                       "round(sst.score_mean, 6) AS score_mean, round(sst.score_std, 6) AS score_std, sst.score_min, sst.score_max, -1e0 AS psi "
                       "FROM rk, base, ece_t, rates, sst")


register("m4_scorecard_test_report", _sql_scorecard_report())(q_scorecard_test_report)


def q_score_fitted(spark, sf_dir):
    """P15 + M8 on the fitted scorecard: one projection."""
    m = scorecard_of(spark, sf_dir)
    return SCO.score_applications(FX.applications(spark, sf_dir).select(*_APP_COLS), model=m, model_version=m.version)


register("p15_score_applications_fitted", _scf_oracle([], SCQ.sql_decisions("apps_d", _APP_COLS)))(q_score_fitted)


def q_scorecard_attribution(spark, sf_dir):
    """X1 + W5 + O3 on the fitted scorecard."""
    a = XP.scorecard_attribution(_apps(spark, sf_dir), scorecard_of(spark, sf_dir))
    return _round_all(a)


register("x1_scorecard_attribution", _scf_oracle(SCQ.sql_impacts(),
         "SELECT application_id, rank, feature, round(impact, 6) AS impact, direction, round(base_value, 6) AS base_value "
         "FROM sc_attr"))(q_scorecard_attribution)


def q_scorecard_counterfactual(spark, sf_dir):
    """X3 on the fitted scorecard."""
    return XP.scorecard_counterfactual(_apps(spark, sf_dir), scorecard_of(spark, sf_dir)).drop("change_values")


def q_scorecard_changes(spark, sf_dir):
    """One row per change suggested by the fitted scorecard."""
    found = XP.scorecard_counterfactual(_apps(spark, sf_dir), scorecard_of(spark, sf_dir))
    return found.select("application_id", F.inline("change_values"))


_SCF_CF = SCQ.sql_counterfactual("apps_d")
register("x3_scorecard_counterfactual", _scf_oracle(_SCF_CF, "SELECT * FROM sc_cf"))(q_scorecard_counterfactual)
register("x3_scorecard_changes", _scf_oracle(_SCF_CF, "SELECT * FROM sc_cf_changes"))(q_scorecard_changes)


def q_scorecard_explanation(spark, sf_dir):
    """X4 on the fitted scorecard."""
    t = XP.scorecard_explanation_table(_apps(spark, sf_dir), scorecard_of(spark, sf_dir))
    return t.select(
        "application_id", "default_probability", "decision", r6("base_value").alias("base_value"),
        F.array_join(F.col("top_factors.feature"), ";").alias("top_factors"),
        r6(F.get("top_factors.impact", F.lit(0))).alias("top_impact"), "n_changes", "changed_features",
        "counterfactual_probability", "counterfactual_decision", "achievable")


register("x4_scorecard_explanation_table", _scf_oracle([*SCQ.sql_impacts(), *_SCF_CF,
    "xf AS (SELECT application_id, string_agg(feature, ';' ORDER BY rank) AS top_factors, "
    "round(max(base_value), 6) AS base_value, round(max(CASE WHEN rank = 1 THEN impact END), 6) AS top_impact "
    "FROM sc_attr GROUP BY application_id)"],
    "SELECT application_id, round(p, 6) AS default_probability, decision, base_value, top_factors, top_impact, n_changes, "
    "changed_features, counterfactual_probability, counterfactual_decision, achievable "
    "FROM sc_prob JOIN xf USING (application_id) JOIN sc_cf USING (application_id)"))(q_scorecard_explanation)


def q_stream_score_fitted(spark, sf_dir):
    """T1 with the fitted scorecard; equals its batch form once every file is consumed."""
    path = ST.stream_score(spark, sf_dir, model=scorecard_of(spark, sf_dir))
    return spark.read.parquet(path).select("application_id", "default_probability", "risk_score", "decision",
                                           "confidence", "model_version")


register("t1_stream_score_fitted", ORACLE["p15_score_applications_fitted"])(q_stream_score_fitted)


def q_log_rows_all(spark, sf_dir):
    """S5 + S6: log rows of the fitted scorecard with all features and the attribution as JSON, read back from that JSON."""
    m = scorecard_of(spark, sf_dir)
    apps = _apps(spark, sf_dir).select(*_APP_COLS, "applied_at")
    wide = m.transform(XP.scorecard_arrays(apps, m, 5, keep=apps.columns))
    wide = wide.withColumn("default_probability", round_dp(MO.PROB_COL, 6))
    factors = F.transform("top", lambda t: F.struct(t["feature"].alias("feature"), t["impact"].alias("impact")))
    log = PL.log_rows(wide, S.ALL_FEATURES, "default_probability", m.version, ts=F.col("applied_at"), attribution=factors)
    schema = T.StructType([T.StructField(c, T.DoubleType() if c in S.NUMERIC_FEATURES else T.StringType()) for c in S.ALL_FEATURES])
    kept = ("application_id", "timestamp", "default_prob", "risk_score", "decision", "confidence", "model_version", "shap_json")
    back = LR.read_log_features(log, schema, hours=None, keep=kept)
    return back.select(*kept[:-1], F.get_json_object("shap_json", "$[0].feature").alias("top_factor"),
                       *[r6(c).alias(c) for c in S.NUMERIC_FEATURES], *S.CATEGORICAL_FEATURES)


register("s5_log_rows_all_features", _scf_oracle(SCQ.sql_impacts(),
    f"SELECT application_id, applied_at AS timestamp, p AS default_prob, {SC.sql_score('p')} AS risk_score, "
    f"{SC.sql_prob_decision('p')} AS decision, {SC.sql_confidence('p')} AS confidence, 'scorecard-v1' AS model_version, top_factor, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in S.NUMERIC_FEATURES) + ", " + ", ".join(S.CATEGORICAL_FEATURES)
    + " FROM (SELECT a.*, round(s.p, 6) AS p, t.feature AS top_factor FROM apps_d a JOIN sc_prob s USING (application_id) "
    "JOIN sc_attr t USING (application_id) WHERE t.rank = 1)"))(q_log_rows_all)
