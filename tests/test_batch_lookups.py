"""Bins, counts and points come from one search per value in Arrow batches, and odd values keep their places."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import explain, woe
from loanlens.plans import scorecard as SCF

ROWS = [(1.0, "a", 1), (2.0, None, 0), (None, "a", None), (float("nan"), "b", 1), (5.0, "b", 0), (-0.0, "c", None), (9.0, "a", 1)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_odd_rows_without_long_rows(spark):
    df = spark.createDataFrame(ROWS, "x double, s string, y int").repartition(3)
    counts = woe.woe_counts(df, "y", ["x"], ["s"], {"x": [-1.0, 0.0, 2.0, 5.0, 9.0]})
    assert "Generate" not in plan(counts) and "MapInArrow" in plan(counts)
    got = {tuple(r)[:4]: tuple(r)[4:] for r in counts.collect()}
    assert got == {("x", "numeric", 1, None): (2, 1), ("x", "numeric", 2, None): (1, 0), ("x", "numeric", 3, None): (3, 2),
                   ("x", "numeric", None, None): (1, None), ("s", "categorical", None, "a"): (3, 2),
                   ("s", "categorical", None, "b"): (2, 1), ("s", "categorical", None, "c"): (1, None),
                   ("s", "categorical", None, None): (1, 0)}
    assert woe.woe_counts(df.where("false"), "y", ["x"], ["s"], {"x": [0.0, 1.0]}).count() == 0


def test_lookup_of_odd_rows_in_batches(spark):
    df = spark.createDataFrame(ROWS, "x double, s string, y int").where("y is not null")
    m = woe.fit_woe(df, "y", ["x"], ["s"], exclude=())
    other = spark.createDataFrame([(v, s) for v in (-1e9, 2.0, 1e9, float("nan"), None) for s in ("a", None, "new")], "x double, s string")
    got = m.transform(other, keep=[])
    assert "ArrowEvalPython" in plan(got) and got.columns == ["x", "s"]
    numeric, cats, missing = m._maps()
    interior = m.edges["x"][1:-1]

    def want(v):
        if v is None:
            return missing.get("x", 0.0)
        return numeric["x"].get(len(interior) if math.isnan(v) else sum(e <= v for e in interior), 0.0)
    assert [r["x"] for r in got.collect()] == [want(r["x"]) for r in other.collect()]
    assert {r["s"] for r in got.collect()} == {cats["s"]["a"], missing["s"]}
    assert m.transform(other.select("s")).select("x").distinct().collect()[0][0] == 0.0


@pytest.fixture
def card():
    names = ["age", "grade", "annual_income"]
    return SCF.Scorecard(
        features=names, numeric=["age", "annual_income"], medians={"age": [30.0, 50.0], "annual_income": [1.0, 2.0]},
        edges={"age": [[20.0, 40.0], [35.0]], "annual_income": [[], []]},
        points={"age": [[-1.0, 0.5, 2.0], [0.25, -0.25]], "annual_income": [[0.5], [-0.5]]},
        categories={"grade": [{"A": 1.0, "MISSING": 0.125}, {"B": -2.0}]}, unseen={"grade": [0.0, 0.75]},
        coefficients=[{}, {}], intercepts=[-1.0, 0.5], sigmoids=[[-4.0, 2.0], [-3.0, 1.0]])


def test_scores_and_ranks_of_odd_rows_in_batches(spark, card):
    rows = [(i, v, g, 5.0) for i, (v, g) in enumerate((v, g) for v in (20.0, 34.9, 35.0, 1e9, float("nan"), None) for g in ("A", "B", "Z", None))]
    df = spark.createDataFrame(rows, "application_id int, age double, grade string, annual_income double")
    scored = card.transform(df.withColumn("column", card.probability()))
    assert "ArrowEvalPython" in plan(scored)
    assert all(math.isclose(r["column"], r["probability_default"], rel_tol=1e-14) for r in scored.collect())
    top = explain.scorecard_arrays(df, card, 2).collect()
    for r, (_, v, g, _) in zip(top, rows, strict=True):
        x = [card.medians["age"][k] if v is None or math.isnan(v) else v for k in (0, 1)]
        place = [int(np.searchsorted(card.edges["age"][k], x[k], "right")) for k in (0, 1)]
        impact = {"age": sum(card.points["age"][k][place[k]] for k in (0, 1)) / 2, "annual_income": 0.0,
                  "grade": sum(card.categories["grade"][k].get(g or "MISSING", card.unseen["grade"][k]) for k in (0, 1)) / 2}
        want = sorted((-abs(i), c, i) for c, i in impact.items())[:2]
        assert [(t["k1"], t["feature"], t["impact"]) for t in r["top"]] == want
    assert explain.scorecard_arrays(df.where("false"), card, 2).count() == 0 and card.transform(df.where(F.lit(False))).count() == 0
