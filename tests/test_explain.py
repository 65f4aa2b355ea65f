"""Explanation properties: additivity, counterfactual never raises probability, surrogate reproducible."""

import pytest
from pyspark.sql import functions as F

from loanlens.functions import rules
from loanlens.plans.stages import DerivedFeatureAdder
from loanlens.operators import explain as XP
from loanlens.sources import fixtures as FX


def test_attribution_additive(spark, sf_dir):
    apps = FX.applications(spark, sf_dir)
    a = XP.expert_attribution(apps, top_n=10)
    tot = a.groupBy("application_id").agg(F.sum("impact").alias("s"), F.first("base_value").alias("b"),
                                          F.count("*").alias("n"))
    lg = apps.select("application_id", rules.risk_logit().alias("logit"))
    rows = tot.join(lg, "application_id").where("n = 10").collect()
    assert rows
    assert all(r.s + r.b == pytest.approx(r.logit, abs=1e-9) for r in rows)


def test_counterfactual_never_raises_probability(spark, sf_dir):
    apps = FX.applications(spark, sf_dir)
    rows = XP.counterfactual(apps).where(F.col("counterfactual_probability").isNotNull()).collect()
    assert rows
    assert all(r.counterfactual_probability <= r.start_probability for r in rows)
    assert all(r.n_changes == 0 for r in rows if r.decision == "APPROVE")
    assert all(r.n_changes <= 4 for r in rows)


def test_counterfactual_values_and_no_null_decisions(spark, sf_dir):
    from loanlens.plans import scoring
    apps = FX.applications(spark, sf_dir)
    cf = XP.counterfactual(apps, XP.imputing_scorer(scoring.optional_medians(apps)))
    rows = cf.collect()
    assert rows and all(r.decision is not None and r.start_probability is not None for r in rows)
    factor = {"lower": XP.LOWER_FACTOR, "higher": XP.HIGHER_FACTOR}
    changes = [c for r in rows for c in r.change_values]
    assert changes
    for r in rows:
        assert [c.step for c in r.change_values] == list(range(1, r.n_changes + 1))
        assert ";".join(c.feature for c in r.change_values) == r.changed_features
    for c in changes:
        assert dict(XP.MUTABLE_FEATURES)[c.feature] == c.direction
        assert c.suggested_value == pytest.approx(c.current_value * factor[c.direction], abs=2e-4)


def test_surrogate_reproducible(spark, sf_dir):
    apps = FX.applications(spark, sf_dir).limit(20)
    a = sorted(XP.local_surrogate(apps, n_samples=100).collect())
    b = sorted(XP.local_surrogate(apps, n_samples=100).collect())
    assert a == b and len(a) == 20 * 8


def test_surrogate_in_batches_equals_columns(spark, sf_dir):
    # rows with NULLs, a NULL id, an id that comes twice with other values, and logarithms out of range
    cols = XP.SURROGATE_FEATURES
    rows = [(f"A{i}", 0.1 + i / 100, 0.5 - i / 90, 9.0 + i, float(i % 3), float(i % 4), 50000.0 + 997 * i, float(i % 9),
             30.0 - i, "ABCDEFG"[i % 7]) for i in range(12)]
    rows += [("A3", 0.4, 0.9, 20.0, 2.0, 1.0, 20000.0, 1.0, 5.0, None), (None, *rows[1][1:]), (None, *rows[5][1:]),
             ("N", *[None] * 9), ("L", 0.2, 0.3, 12.0, -9.0, 1.0, -9e9, -50.0, -400.0, "C"),
             ("S", 0.2, 0.3, 12.0, -0.9, 1.0, 1.0, 0.0, 0.0, "C")]
    df = spark.createDataFrame(rows, "application_id string, " + ", ".join(f"{c} double" for c in cols) + ", grade string")
    by_columns = XP.local_surrogate(df, lambda c: XP.expert_scorer(c), n_samples=60)
    batches = XP.local_surrogate(df, n_samples=60)
    plan = batches._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sequence" not in plan  # no row per sample

    def of(d):
        return sorted(((r.application_id or "", r.feature), r.weight) for r in d.collect())
    a, b = of(by_columns), of(batches)
    assert len(a) == 16 * 8 and [x[0] for x in a] == [x[0] for x in b]
    assert [x[1] for x in b] == pytest.approx([x[1] for x in a], abs=1.01e-4, nan_ok=True)
    assert sum(x[1] != y[1] and x[1] == x[1] for x, y in zip(a, b)) <= 1  # at most a weight on the edge of rounding
    filled = {"num_derog_records": 1.0}
    for subset in (["interest_rate", "annual_income"], ["num_derog_records"]):
        for scorer in (XP.expert_scorer, XP.imputing_scorer(filled)):
            want = of(XP.local_surrogate(df, lambda c: scorer(c), subset, n_samples=40))
            got = of(XP.local_surrogate(df, scorer, subset, n_samples=40))
            assert [x[0] for x in got] == [x[0] for x in want]
            assert [x[1] for x in got] == pytest.approx([x[1] for x in want], abs=1.01e-4, nan_ok=True)


def test_tree_attribution_additive(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from loanlens.plans import models as M
    apps = FX.applications(spark, sf_dir).withColumn("dflt", F.col("dflt").cast("double"))
    m = M.fit_plain(apps, "dflt", kind="champion", params={"n_estimators": 5})
    pm = m.folds[0]
    feats = pm.transform(DerivedFeatureAdder().transform(apps))
    att = XP.tree_attribution(feats, pm.stages[-1], "features0", M.MODEL_FEATURES, top_n=len(M.MODEL_FEATURES))
    tot = att.groupBy("application_id").agg(F.sum("impact").alias("s"), F.first("base_value").alias("b"),
                                            F.first("margin").alias("m"))
    raw = feats.select("application_id", vector_to_array("raw0")[1].alias("r"))
    rows = tot.join(raw, "application_id").collect()
    assert rows
    assert all(r.s + r.b == pytest.approx(r.m, abs=1e-9) for r in rows)
    assert all(r.m == pytest.approx(r.r, abs=1e-9) for r in rows)


def test_tree_attribution_ranks_in_batches(spark):
    # against a plain walk: a leaf above the last level, a feature twice on a path, unused ones (equal
    # impacts rank by name), NaN values, a NULL id, an id that comes twice, and more rows than a step
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    def row(i):
        x = [float(i % 7), float(i % 5), 1.0, float(i * 37 % 101)]
        if i % 50 == 3:
            x[i % 4] = float("nan")
        return (None if i == 5 else f"A{i % 3000}", Vectors.dense(x), float(x[0] > 2 and x[3] < 40 or i % 11 == 0))
    rows = [row(i) for i in range(5000)]
    df = spark.createDataFrame(rows, ["application_id", "v", "y"]).coalesce(1)
    model = GBTClassifier(featuresCol="v", labelCol="y", maxIter=4, maxDepth=5, minInstancesPerNode=20, seed=1).fit(
        spark.createDataFrame([r for r in rows if not any(v != v for v in r[1])], df.schema).coalesce(1))
    names = ["d", "b", "c", "a"]
    t = XP.tree_tables(model, spark)

    def walk(x):
        impacts, margin, base = [0.0] * 4, 0.0, 0.0
        for pred, left, right, feat, thr, w in zip(*(t[c] for c in ("pred", "left", "right", "feat", "thr", "weights"))):
            node, base = 0, base + w * pred[0]
            while left[node] >= 0:
                to = left[node] if x[feat[node]] <= thr[node] else right[node]
                impacts[feat[node]] += w * (pred[to] - pred[node])
                node = to
            margin += w * pred[node]
        return sorted(zip([-abs(v) for v in impacts], names, impacts))[:3], base, margin

    att = XP.tree_attribution(df, model, "v", names, top_n=3)
    plan = att._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sort_array" not in plan  # ranked where it is attributed
    got = sorted(((r.application_id or "", r.rank, r.feature, r.impact, r.base_value, r.margin) for r in att.collect()),
                 key=lambda r: (r[0], r[5], r[1]))
    want = []
    for app, x, _ in rows:
        top, base, margin = walk(x)
        want += [(app or "", i, f, v, base, margin) for i, (_, f, v) in enumerate(top, 1)]
    want.sort(key=lambda r: (r[0], r[5], r[1]))
    assert len(got) == len(want) == 3 * 5000 and {r[2] for r in got} > {"d", "a"}
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((r[0], r[1], r[2]) for r in want)
    assert [v for r in got for v in r[3:]] == pytest.approx([v for r in want for v in r[3:]], abs=1e-12)
    assert all(r.direction == ("increases_risk" if r.impact > 0 else "decreases_risk") for r in att.collect())
