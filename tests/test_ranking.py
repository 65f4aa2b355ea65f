"""Order statistics from sketch brackets against sorted lists, also where the sketch errs or brackets are cut."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loanlens.operators import ranking


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, h long").repartition(4)


def rows_of(seed=1):
    rng = random.Random(seed)
    rows = [("uniform", rng.random(), rng.getrandbits(62)) for _ in range(4000)]
    rows += [("clustered", 0.1 + 1e-12 * rng.random(), 7) for _ in range(2000)] + [("clustered", 0.9, 9)] * 1500
    rows += [("one", 5.0, -(1 << 62))] + [("ties", float(rng.randrange(3)), rng.randrange(-3, 3)) for _ in range(500)]
    rows += [("ends", x, h) for x, h in ((float("-inf"), -(1 << 63)), (float("inf"), (1 << 63) - 1), (0.0, 0), (-0.0, 1))]
    rows += [("nulls", None, None), (None, 3.0, 3), ("nans", float("nan"), 1), ("nans", float("nan"), 2), ("nans", 1.0, 3)]
    return rows


def expected(rows, column, fractions):
    out = {}
    for g in {r[0] for r in rows if r[0] is not None}:
        vs = sorted((r[column] for r in rows if r[0] == g and r[column] is not None), key=lambda v: (v != v, v))
        if vs:
            out[g] = [vs[min(int(p * len(vs)), len(vs) - 1)] for p in fractions] + [len(vs)]
    return out


@pytest.mark.parametrize("margin,limit", [(ranking.MARGIN, ranking.LIMIT), (1e-9, ranking.LIMIT), (0.2, 40)])
@pytest.mark.parametrize("value,column", [("v", 1), ("h", 2)])
def test_ranks_by_group(spark, monkeypatch, margin, limit, value, column):
    monkeypatch.setattr(ranking, "MARGIN", margin)
    monkeypatch.setattr(ranking, "LIMIT", limit)
    fractions = [0.0, 0.01, 0.5, 0.505, 0.95, 1.0]
    rows = rows_of()
    got = ranking.value_at_ranks(frame(spark, rows), value, {f"p{i}": p for i, p in enumerate(fractions)}, group="g", count="n")
    assert got.columns == ["g", *(f"p{i}" for i in range(6)), "n"]
    found = {r["g"]: list(r)[1:] for r in got.collect()}
    want = expected(rows, column, fractions)
    assert set(found) == set(want)
    for g, w in want.items():
        assert all(a == b or (a != a and b != b) for a, b in zip(found[g], w, strict=True)), g


def test_without_group_and_empty(spark):
    df = frame(spark, rows_of()).where("g = 'uniform'")
    vs = sorted(r["v"] for r in df.collect())
    assert ranking.value_at_ranks(df, "v", {"m": 0.5}).first()["m"] == vs[len(vs) // 2]
    none = ranking.value_at_ranks(df.where("false"), "v", {"m": 0.5}, ranks={"k": lambda n: n - 1}, count="n").collect()
    assert [tuple(r) for r in none] == [(None, None, 0)]
    assert ranking.value_at_ranks(df.where("false"), "v", {"m": 0.5}, group="g").count() == 0


def test_percentiles_equal_the_builtin(spark):
    df = frame(spark, rows_of()).where("g in ('uniform', 'clustered', 'ties', 'one')")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in ranking.percentiles(df, "v", probs, "g").collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()
    assert set(got) == {r["g"] for r in want}
    assert all(math.isclose(a, b, rel_tol=0, abs_tol=1e-15) for r in want for a, b in zip(got[r["g"]], r["q"], strict=True))


def test_values_are_not_shuffled_whole(spark):
    """Only a few hundredths of a continuous column leave the map tasks."""
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.rand(3).alias("v"))
    got = ranking.value_at_ranks(df, "v", {"p25": 0.25, "p50": 0.5}, group="g")
    vs = sorted(r["v"] for r in df.collect())
    assert tuple(got.first())[1:] == (vs[50_000], vs[100_000])
    placed, _ = ranking._inside(df, {"a": [(vs[49_000], vs[51_000]), (vs[99_000], vs[101_000])]},
                                ranking._Kind(df.schema["v"].dataType), df.schema["g"].dataType)
    assert placed.count() < 5_000
