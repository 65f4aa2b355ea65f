"""Stages persist, calibrated models score in one chain, the training run completes (small data)."""

import os
import tempfile

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from loanlens.plans import models as M
from loanlens.plans.stages import DerivedFeatureAdder
from loanlens.sources import fixtures as FX


@pytest.fixture(scope="module")
def apps(spark, sf_dir):
    return FX.applications(spark, sf_dir).withColumn("dflt", F.col("dflt").cast("double")).cache()


def test_stages_roundtrip(spark, apps):
    stages, _ = M.feature_stages(M.MODEL_FEATURES, "dflt")
    pm = Pipeline(stages=[DerivedFeatureAdder()] + stages).fit(apps)
    d = tempfile.mkdtemp(prefix="ll-pm-")
    pm.write().overwrite().save(d + "/pm")
    back = PipelineModel.load(d + "/pm")
    a = pm.transform(apps).select("application_id", "features").orderBy("application_id").collect()
    b = back.transform(apps).select("application_id", "features").orderBy("application_id").collect()
    assert a == b


def test_calibrated_scorecard_save_load(spark, apps):
    m = M.fit_calibrated(apps, "dflt", kind="logistic", method="sigmoid", cv=3, parallelism=3)
    p = m.transform(apps).select("application_id", M.PROB_COL)
    vals = [r[1] for r in p.collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert M.auc_of(m.transform(apps), "dflt") > 0.8
    d = tempfile.mkdtemp(prefix="ll-cal-")
    m.save(d + "/m")
    back = M.CalibratedModel.load(d + "/m")
    a = sorted(m.transform(apps).select("application_id", M.PROB_COL).collect())
    b = sorted(back.transform(apps).select("application_id", M.PROB_COL).collect())
    assert [round(x[1], 12) for x in a] == [round(x[1], 12) for x in b]


def test_isotonic_is_monotone(spark, apps):
    m = M.fit_calibrated(apps, "dflt", kind="logistic", method="isotonic", cv=2, parallelism=2)
    scored = m.transform(apps, keep_raw=True)
    for i, c in enumerate(m.calibrators):
        rows = c.transform(scored).select(f"p_raw{i}", f"p_cal{i}").orderBy(f"p_raw{i}", f"p_cal{i}").collect()
        assert all(0.0 <= r[1] <= 1.0 for r in rows)
        assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:])) and len({r[1] for r in rows}) > 2


def test_calibrated_booster_small(spark, apps):
    m = M.fit_calibrated(apps, "dflt", kind="champion", params={"n_estimators": 5}, cv=2,
                         class_weight_ratio=3.0, parallelism=2)
    assert M.auc_of(m.transform(apps), "dflt") > 0.7


def test_training_run_small(spark, apps):
    out = M.train_run(apps, "dflt", champion_kind="logistic", challenger_kind="forest", cv=2,
                      model_dir=tempfile.mkdtemp(prefix="ll-run-"))
    rep = out["champion_report"].first()
    assert 0.5 < rep["auc_roc"] <= 1.0
    assert out["comparison"].first()["winner"] in ("champion", "challenger")
    assert len(out["selected_features"]) > 0


def test_search_samples_are_seeded():
    assert M.sample_params(3, 42) == M.sample_params(3, 42)
    p = M.sample_params(50, 42)
    assert all(100 <= t["n_estimators"] <= 600 and 3 <= t["max_depth"] <= 6 for t in p)


def test_latest_models(spark):
    reg = spark.createDataFrame([("champion", "v1", 1, False), ("champion", "v2", 2, False),
                                 ("champion", "latest", 0, True), ("challenger", "c1", 5, False)],
                                "role string, version string, created_at int, is_latest boolean")
    got = {r.role: r.version for r in M.latest_models(reg).collect()}
    assert got == {"champion": "latest", "challenger": "c1"}


def test_booster_input_is_held_in_few_partitions(spark, sf_dir, monkeypatch):
    apps = FX.applications(spark, sf_dir).withColumn("dflt", F.col("dflt").cast("double"))
    cores = spark.sparkContext.defaultParallelism
    seen = []
    fit = M.GBTClassifier.fit

    def spied(self, dataset, *more):
        seen.append((dataset.rdd.getNumPartitions(), dataset.count(), sorted(dataset.columns)))
        return fit(self, dataset, *more)
    monkeypatch.setattr(M.GBTClassifier, "fit", spied)
    params = {"n_estimators": 3}
    M.fit_plain(apps.repartition(5 * cores), "dflt", kind="champion", params=params, class_weight_ratio=3.0)
    assert seen == [(cores, apps.count(), sorted(["features0", "dflt", M.WEIGHT_COL]))]
    # the same trees as from one pipeline, where the partitions are few anyway
    few = M.with_class_weight(M.DerivedFeatureAdder().transform(apps.coalesce(1)), "dflt", 1.0)
    stages, vec = M.feature_stages(M.MODEL_FEATURES, "dflt", "0")
    whole = M.Pipeline(stages=stages + [M.classifier("champion", "0", vec, "dflt", params)]).fit(few)
    got = M.fit_plain(apps.coalesce(1), "dflt", kind="champion", params=params).folds[0]
    assert got.stages[-1].toDebugString.split("\n", 1)[1] == whole.stages[-1].toDebugString.split("\n", 1)[1]
    assert len(got.stages) == len(whole.stages)


def test_folds_share_one_look_up(spark, apps):
    from loanlens import catalog
    # a column without values, NULLs, a category that comes in no fold and one (in the column's place) that is NULL
    rows = M.DerivedFeatureAdder().transform(apps)
    train = rows.withColumn("revolving_balance", F.lit(None).cast("double"))
    m = M.fit_calibrated(train.drop(*M.S.DERIVED_FEATURES), "dflt", kind="logistic", method="sigmoid", cv=3, parallelism=3)
    odd = F.expr("hash(application_id) % 5 = 0")
    score = (train.withColumn("age", F.when(odd, None).otherwise(F.col("age")))
             .withColumn("debt_to_income", F.when(odd, float("nan")).otherwise(F.col("debt_to_income")))
             .withColumn("grade", F.when(odd, "unseen").otherwise(F.col("grade")))
             .withColumn("loan_purpose", F.when(odd, None).otherwise(F.col("loan_purpose"))))
    chain = score
    for i, pm in enumerate(m.folds):
        chain = pm.transform(chain).withColumn(f"p{i}", M.vector_to_array(F.col(f"prob{i}"))[1])
    got = m.transform(score, keep_raw=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # one Python worker a task, not one a fold
    assert got.columns == [*score.columns, M.PROB_COL, "p_raw0", "p_raw1", "p_raw2"]
    a = sorted(tuple(r) for r in chain.select("application_id", "p0", "p1", "p2").collect())
    b = sorted(tuple(r) for r in got.select("application_id", *m.raw_columns()).collect())
    assert a == b and len({r[1] for r in a}) > 100
    # the rows are scored once for all metrics
    report = catalog._test_report(m, score.drop(*M.S.DERIVED_FEATURES))
    assert "ArrowEvalPython" not in report._jdf.queryExecution().executedPlan().toString()
    assert report.first()["n_samples"] == apps.count()
