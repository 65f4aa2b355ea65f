"""Order statistics of many columns and of folds, against sorted lists."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import binning, prepare, ranking


def rows_of(n=700, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        wide = rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300)
        near = 0.1 + 1e-15 * rng.randrange(5)
        odd = rng.choice([None, None, float("nan"), 0.0, -0.0, float("inf"), float("-inf"), 2.0])
        out.append((i % 5, wide, near, float(rng.randrange(3)), odd, None))
    return out


SCHEMA = "fold int, wide double, near double, ties double, odd double, none double"
COLUMNS = SCHEMA.replace(" double", "").replace("fold int, ", "").split(", ")


def present(rows, j, g=None):
    return sorted(r[j] for r in rows if r[j] is not None and r[j] == r[j] and (g is None or r[0] != g))


@pytest.mark.parametrize("cells", [ranking.CELLS, 50])
def test_ranks_of_columns_and_folds(spark, monkeypatch, cells):
    monkeypatch.setattr(ranking, "CELLS", cells)
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = lambda n, missing: [0, n // 3, n // 2, n - 1, n]
    whole, folds = ranking.column_ranks(df, COLUMNS, wanted), ranking.column_ranks(df, COLUMNS, wanted, "fold", 5)
    for j, c in enumerate(COLUMNS, 1):
        for got, vs in [(whole[c, 0], present(rows, j)), *((folds[c, g], present(rows, j, g)) for g in range(5))]:
            assert got[0] == len(vs)
            assert got[2] == [vs[r] if 0 <= r < len(vs) else None for r in wanted(len(vs), 0)]


def test_percentiles_of_filled_values(spark):
    rng = random.Random(5)
    rows = [(i % 3, rng.choice([None, rng.random(), 0.5, rng.randrange(9) / 8]), None if i % 10 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "fold int, a double, b double")
    probs = [i / 10 for i in range(11)]
    medians, edges = ranking.filled_percentiles(df, ["a", "b"], probs, "fold", 3)
    for j, c in ((1, "a"), (2, "b")):
        for g in range(3):
            train = [r[j] for r in rows if r[0] != g]
            m = float(np.quantile([v for v in train if v is not None], 0.5))
            assert medians[c][g] == pytest.approx(m, abs=1e-12)
            assert edges[c][g] == pytest.approx(np.quantile([m if v is None else v for v in train], probs), abs=1e-9)


def test_edges_and_medians_do_not_make_rows_long(spark, monkeypatch):
    """The exact forms count wide rows: no row per row and column."""
    def never(*_, **__):
        raise AssertionError("rows made long")
    monkeypatch.setattr(binning, "long_values", never)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    assert {r["feature"]: r["median"] for r in prepare.fit_medians(df, ["x", "y"]).collect()} == {"x": 499.5, "y": 3.0}
    assert binning.collect_edges(binning.quantile_edges(df, ["x"], 2)) == {"x": [0.0, 499.5, 999.0]}
