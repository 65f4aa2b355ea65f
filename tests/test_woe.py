"""WoE / IV edge rules on hand-worked frames."""

import math

import pytest

from loanlens.functions import rules
from loanlens.operators import woe


def test_woe_handworked(spark):
    # x: 1,2,3,4 with y 0,0,1,1 and one NULL with y=1; two quantile bins requested
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1), (None, 1), (2.5, 0)], "x double, y int")
    m = woe.fit_woe(df, "y", ["x"], [], max_bins=2, min_bin_pct=0.5)
    rows = {(r.bin if not r.is_missing else "M"): r for r in m.woe_rows}
    n_ev, n_nev, s, b = 3, 3, 0.5, 2
    # edges [1, 2.5, 4]: bin0 = {1, 2} (0 ev, 2 nev), bin1 = {2.5, 3, 4} (2 ev, 1 nev)
    w0 = math.log(((0 + s) / (n_ev + s * b)) / ((2 + s) / (n_nev + s * b)))
    assert rows[0].woe == pytest.approx(w0)
    wm = math.log(((1 + s) / (n_ev + s)) / ((0 + s) / (n_nev + s)))
    assert rows["M"].woe == pytest.approx(wm)
    iv = m.iv_table().first()
    assert iv.n_bins == 3 and iv.iv >= 0


def test_one_class_guard(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, y int")
    with pytest.raises(ValueError):
        woe.fit_woe(df, "y", ["x"], [])


def test_transform_unseen_and_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", 0), (None, 1)], "c string, y int")
    m = woe.fit_woe(df, "y", [], ["c"])
    miss = [r.woe for r in m.woe_rows if r.is_missing][0]
    new = spark.createDataFrame([("zzz",), (None,), ("a",)], "c string")
    out = [r.c for r in m.transform(new).collect()]
    assert out[0] == pytest.approx(miss) and out[1] == pytest.approx(miss) and out[2] != miss


def test_derived_features_null_guard(spark):
    df = spark.createDataFrame([(100.0, None, 2.0, 0.5, 3.0, 0.0, 1.0, 10.0)],
                               "loan_amount double, annual_income double, num_derog_records double, "
                               "total_accounts double, num_open_accounts double, interest_rate double, "
                               "debt_to_income double, revolving_balance double")
    r = rules.add_derived_features(df).first()
    assert r.loan_to_income is None          # null in -> null out (no floor at 1)
    assert r.derog_rate == 2.0               # denominator floored at 1
    assert r.rate_x_dti == 0.0


def test_many_categories_by_the_same_plan(spark):
    from loanlens.plans.stages import WoEEncoder
    n = 50_000
    df = spark.range(2 * n).selectExpr(f"concat('c', id % {n}) AS c", f"cast(id % 3 = 0 AS int) AS y")
    m = WoEEncoder(inputCols=["c"], outputCols=["w"], labelCol="y").fit(df)
    out = m.transform(df)
    assert out.columns == ["c", "y", "w"]
    want = {r.category: r.woe for r in woe.fit_woe(df, "y", [], ["c"]).woe_rows}
    assert len(want) == n
    got = out.select("c", "w").distinct().collect()
    assert len(got) == n and all(r.w == want[r.c] for r in got)


def test_one_class_fails_in_the_lazy_table(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, y int")
    with pytest.raises(Exception, match="both classes"):
        woe.woe_table_df(df, "y", ["x"], []).collect()
