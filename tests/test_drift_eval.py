"""Drift and evaluation properties (the reference's drift tests + brute force)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import drift as DR
from loanlens.operators import evaluation as EV


def _normal(spark, n, mu, seed):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(float(v), "a" if v > mu else "b") for v in rng.normal(mu, 1.0, n)],
                                 "x double, c string")


def test_same_distribution_is_not_alert(spark):
    ref, cur = _normal(spark, 500, 0.0, 1), _normal(spark, 100, 0.0, 2)
    st = {r.feature: r.status for r in DR.drift_report(ref, cur, ["x"], ["c"]).collect()}
    assert st["x"] in ("stable", "monitor")


def test_shift_is_alert(spark):
    ref, cur = _normal(spark, 500, 0.0, 1), _normal(spark, 100, 5.0, 2)
    st = {r.feature: r.status for r in DR.drift_report(ref, cur, ["x"], []).collect()}
    assert st["x"] == "alert"
    roll = DR.drift_rollup(DR.drift_report(ref, cur, ["x"], [])).first()
    assert roll.overall_status == "alert" and roll.n_alerts == 1


def test_psi_self_is_zero(spark):
    ref = _normal(spark, 300, 0.0, 3)
    assert DR.numeric_psi(ref, ref, ["x"]).first().psi == pytest.approx(0.0)


def test_fixture_drift_values(spark):
    from loanlens import catalog as C
    rep = {r.feature: r.psi for r in C.q_drift_report(spark, "/root/testdata/sf0.01").collect()}
    assert rep["months_since_last_delinq"] == pytest.approx(6.9044, abs=1e-4)
    assert rep["annual_income"] == pytest.approx(0.0008, abs=1e-4)


def _auc_brute(y, p):
    pos = [a for a, b in zip(p, y) if b == 1]
    neg = [a for a, b in zip(p, y) if b == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_ks_against_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 300).tolist()
    p = [round(float(v), 2) for v in np.clip(rng.normal(0.4, 0.2, 300) + 0.2 * np.array(y), 0, 1)]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    m = EV.ranking_metrics(EV.cumulative_frame(EV.score_frame(df, "y", "p"))).first()
    assert m.auc_roc == pytest.approx(_auc_brute(y, p))
    inv = df.withColumn("p", F.lit(1.0) - F.col("p"))
    m2 = EV.ranking_metrics(EV.cumulative_frame(EV.score_frame(inv, "y", "p"))).first()
    assert m2.auc_roc == pytest.approx(1 - m.auc_roc)
    # KS on distinct scores
    ps = sorted(set(p), reverse=True)
    P, N = sum(y), len(y) - sum(y)
    best = 0.0
    for t in ps:
        tp = sum(1 for a, b in zip(p, y) if a >= t and b == 1)
        fp = sum(1 for a, b in zip(p, y) if a >= t and b == 0)
        best = max(best, abs(tp / P - fp / N))
    assert m.ks_statistic == pytest.approx(best)


def test_ece_excludes_p_one(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.05), (1, 0.95)], "y int, p double")
    curve = EV.calibration_curve(df, "y", "p").collect()
    assert sum(r["count"] for r in curve) == 2


def test_cost_threshold_recorded_value():
    assert EV.COST_THRESHOLDS[21] == 0.15499999999999997


def test_null_scores_are_not_ranked(spark):
    df = spark.createDataFrame([(0.9, 1), (None, 1), (0.1, 0), (0.5, 0)], "p double, y int")
    with pytest.raises(Exception, match="p is NULL"):
        EV.score_frame(df, "y", "p").collect()


def test_percentiles_with_outliers_and_clusters(spark):
    import numpy as np

    from loanlens.operators import ranking
    rng = np.random.default_rng(7)
    groups = {"tail": np.append(rng.random(3000), 1e9), "narrow": 0.5 + rng.random(3000) / 1000,
              "ties": np.repeat([1.0, 2.0, 5.0], 700), "one": np.array([3.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("tail", None)],
                               "g string, v double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {r.g: r.q for r in ranking.percentiles(df, "v", probs, "g").collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, probs), rtol=1e-12)
    p99 = ranking.value_at_ranks(df.where("g = 'tail'"), "v", {"p99": 0.99, "top": 1.0}).first()
    ordered = np.sort(groups["tail"])
    assert p99.p99 == ordered[int(0.99 * len(ordered))] and p99.top == 1e9
    assert ranking.value_at_ranks(df.where("false"), "v", {"p": 0.5}).first().p is None


def test_ranking_metrics_of_clustered_scores(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    p = np.where(rng.random(2000) < 0.99, 0.5 + rng.random(2000) / 1000, rng.random(2000)).round(7)
    y = (rng.random(2000) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int").repartition(5)
    m = EV.ranking_metrics(EV.cumulative_frame(EV.score_frame(df, "y", "p"))).first()
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert m.auc_roc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    cuts = np.unique(p)
    assert m.ks_statistic == pytest.approx(max(abs((pos >= c).mean() - (neg >= c).mean()) for c in cuts), abs=1e-12)


def test_vif_rounds_take_the_rows_complete_in_their_columns(spark):
    """Moments by null pattern give, in every round, what numpy gives on the rows complete in its columns."""
    import numpy as np
    from loanlens.operators import prepare
    rng = np.random.default_rng(7)
    x = rng.standard_normal((600, 4)) * [1, 50, 1e-3, 1] + [0, 1e6, 0, 5]
    x = np.column_stack([x, x[:, 0] + 0.05 * rng.standard_normal(600), x[:, 1] - 30 * x[:, 3] + rng.standard_normal(600)])
    names = [f"c{i}" for i in range(6)]
    gone = rng.random(x.shape) < [0.0, 0.1, 0.0, 0.05, 0.3, 0.0]
    rows = [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gone)] + [(float("nan"),) * 6, (None,) * 6]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    rounds, kept, final = prepare.vif_rounds(df, names)
    cols, want = list(range(6)), []
    while True:
        full = ~gone[:, cols].any(1)
        inv = np.diag(np.linalg.inv(np.corrcoef(x[full][:, cols].T)))
        worst = max(range(len(cols)), key=lambda i: (round(inv[i], 2), names[cols[i]]))
        if round(inv[worst], 2) <= 10:
            want.append((int(full.sum()), None))
            break
        want.append((int(full.sum()), names[cols[worst]]))
        cols.pop(worst)
    assert [(n, c) for n, c, _ in rounds] == want and len(want) == 3 and want[0][0] < want[-1][0]
    assert kept == [names[i] for i in cols]
    assert all(abs(final[names[c]] - v) < 1e-6 for c, v in zip(cols, inv))


def test_unions_of_categories(spark):
    from loanlens.operators import drift
    a = spark.createDataFrame([("x", "p"), (None, "q"), ("x", None)], "g string, h string")
    b = spark.createDataFrame([("y", "p")], "g string, h string")
    assert sorted(tuple(r) for r in drift.category_unions(a, b, ["g", "h"]).collect()) == [
        ("g", "x"), ("g", "y"), ("h", "p"), ("h", "q")]
