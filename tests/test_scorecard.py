"""The fitted scorecard: its compiled forms agree, its fit is the minimum it claims, and odd rows are scored."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens import catalog
from loanlens.operators import binning, explain
from loanlens.plans import scorecard as SCF
from loanlens.sources import fixtures as FX


@pytest.fixture(scope="module")
def apps(spark, sf_dir):
    return FX.applications(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return catalog.scorecard_of(spark, sf_dir)


def test_column_and_transform_agree_on_odd_rows(spark, apps, model):
    odd = apps.limit(40).withColumn("debt_to_income", F.lit(None).cast("double")).withColumn(
        "grade", F.lit("no such grade")).withColumn("home_ownership", F.lit(None).cast("string")).withColumn(
        "annual_income", F.lit(1e12))
    both = apps.unionByName(odd)
    got = model.transform(both.withColumn("column", model.probability())).select("column", "probability_default").collect()
    assert all(0 < r[0] < 1 and math.isclose(r[0], r[1], rel_tol=1e-12) for r in got)
    assert len({round(r[1], 9) for r in got}) > 100
    assert model.transform(apps.where("false")).count() == 0


def test_save_and_load(spark, model, tmp_path):
    model.save(spark, str(tmp_path / "m"))
    assert SCF.Scorecard.load(spark, str(tmp_path / "m")) == model


def test_points_are_centred_and_impacts_add_up(spark, apps, model):
    frame = explain.scorecard_arrays(apps, model, len(model.features))
    want = {r[0]: sum(r[1]) / model.folds for r in apps.select("application_id", model.logits()).collect()}
    for r in frame.collect():
        assert math.isclose(sum(t["impact"] for t in r["top"]) + r["base_value"], want[r["application_id"]], abs_tol=1e-9)
        assert [t["k1"] for t in r["top"]] == sorted(t["k1"] for t in r["top"])


def test_newton_finds_the_ridge_minimum(spark):
    """Gradients of a small made-up problem, by differences of the penalised log-likelihood."""
    rng = np.random.default_rng(3)
    n, k = 400, 2
    idx, fold = rng.integers(0, 3, (n, 2 * k)), rng.integers(0, k, n)
    y = (rng.random(n) < 0.3 + 0.2 * (idx[:, 0] == 1)).astype(int)
    tables = [[rng.standard_normal(3), rng.standard_normal(3)] for _ in range(k)]
    df = spark.createDataFrame([(int(f), int(t), [int(v) for v in row]) for f, t, row in zip(fold, y, idx)],
                               "fold int, y int, idx array<int>").repartition(3)
    beta = SCF._newton(df, SCF._designer(tables, k), 3, k, 1.0)

    def loss(g, b):
        use = fold != g
        x = np.column_stack([np.ones(n), tables[g][0][idx[:, 2 * g]], tables[g][1][idx[:, 2 * g + 1]]])[use]
        z = x @ b
        return np.sum(np.log1p(np.exp(z)) - y[use] * z) + 0.5 * np.sum(b[1:] ** 2)
    for g in range(k):
        for j in range(3):
            step = np.eye(3)[j] * 1e-4
            assert abs(loss(g, beta[g] + step) - loss(g, beta[g] - step)) / 2e-4 < 1e-6


def test_platt_finds_the_minimum(spark):
    rng = np.random.default_rng(4)
    f = rng.random(300)
    y = (rng.random(300) < f).astype(int)
    g = rng.integers(0, 2, 300)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(g, f, y)], "g int, f double, y int")
    for i, (a, b) in enumerate(SCF._platt(df, 2)):
        u, t = f[g == i], y[g == i]
        pos, neg = t.sum(), len(t) - t.sum()
        target = np.where(t == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))

        def loss(a, b, u=u, target=target):
            z = a * u + b
            return np.sum(target * np.log1p(np.exp(z)) + (1 - target) * np.log1p(np.exp(-z)))
        assert a < 0 and all(loss(a, b) <= loss(a + da, b + db) for da in (-1e-3, 0, 1e-3) for db in (-1e-3, 0, 1e-3))


def test_one_class_fails(apps):
    with pytest.raises(Exception, match="both classes"):
        SCF.fit_scorecard(apps.withColumn("dflt", F.lit(0)), "dflt")


def test_counterfactual_steps_are_the_best_single_changes(spark, apps, model):
    """Every suggested step is replayed with the single Column form; no other lever does better."""
    rows = explain.scorecard_counterfactual(apps, model).where("n_changes > 0").collect()
    assert rows
    some = apps.join(spark.createDataFrame([(r["application_id"], r["change_values"][0]["feature"], r["counterfactual_probability"],
                                             [c["feature"] for c in r["change_values"]]) for r in rows[:25]],
                                           "application_id string, first string, final double, all array<string>"), "application_id")
    score, start = model.scorer(), model.probability()
    moved = {}
    for f, d in explain.MUTABLE_FEATURES:
        factor = explain.LOWER_FACTOR if d == "lower" else explain.HIGHER_FACTOR
        moved[f] = F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * factor
    drops = [(start - score({f: moved[f]})).alias(f"d_{f}") for f in moved]
    final = score({f: F.when(F.array_contains("all", f), moved[f]).otherwise(F.col(f).cast("double")) for f in moved})
    for r in some.select("first", "final", final.alias("replayed"), *drops).collect():
        best = max(r[f"d_{f}"] for f in moved)
        assert r[f"d_{r['first']}"] >= best - 1e-9 and best >= explain.MIN_IMPROVEMENT
        assert abs(r["replayed"] - r["final"]) < 6e-5


def test_bin_labels(spark):
    values = [0.0, 1.0, -12.345678, 123.4, 1234.4, 12345.6, 0.00012345678, 0.000012345678, 999960.0, 0.5, 100.0, -0.25]
    df = spark.createDataFrame([(v, 2 * v) for v in values], "lo double, hi double")
    got = [r[0] for r in df.select(binning.bin_label(F.col("lo"), F.col("hi"))).collect()]
    assert got == [f"({v:.4g}, {2 * v:.4g}]" for v in values]


