"""The fitted scorecard of the decision path (M3, M4, M8, P15, X1, X3): one Column from k calibrated folds.

``fit_scorecard`` fits the k fold models of a calibrated weight-of-evidence scorecard together:
medians and quantile edges of all folds come from the same counting passes over the wide rows, the WoE counts
from one more; the scaling follows from the counts; every Newton step of the k ridge-penalised logistic
regressions is one pass that sums k small normal equations inside the tasks; and Platt's sigmoid is
fitted on the held-out fold's probabilities in the same way. Nothing but numbers per (fold, feature, bin)
reaches the driver.

A ``Scorecard`` is those numbers. Scaling, coefficient and WoE of a bin collapse into the *points*
it adds to a fold's logit. ``transform`` finds the bins of an Arrow batch by binary search over the
folds' merged edges, reads the points of all folds from a table and sums them: narrow work over a
batch or a stream. ``probability`` is the same as a single Column, usable wherever a ``Scorer`` is.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .. import schema as S
from ..functions import rules
from ..operators import binning, prepare, ranking
from ..operators import woe as W
from ..session import cut_lineage, persisted

#: Ridge penalty on the coefficients of the scaled WoE values (the intercept is free).
RIDGE = 1.0
NEWTON_STEPS, PLATT_STEPS, TOLERANCE = 30, 30, 1e-12
#: Standard deviations below this are those of a constant column.
FLAT = 1e-12
MISSING = "MISSING"
#: Rounds the SQL twin unrolls; both sides have converged by then.
SQL_NEWTON, SQL_PLATT = 10, 20


@dataclass
class Scorecard:
    """Fitted numbers; lists are by fold. ``features`` is the order in which points are added."""
    features: list[str]
    numeric: list[str]
    medians: dict[str, list[float]]
    edges: dict[str, list[list[float]]]              # interior edges
    points: dict[str, list[list[float]]]             # by bin
    categories: dict[str, list[dict[str, float]]]    # points by category
    unseen: dict[str, list[float]]                   # points of a category that the fold did not see
    coefficients: list[dict[str, float]]
    intercepts: list[float]
    sigmoids: list[list[float]]                      # Platt's a, b
    version: str = "scorecard-v1"
    meta: dict = field(default_factory=dict)

    @property
    def folds(self) -> int:
        return len(self.intercepts)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Scorecard:
        return cls(**json.loads(text))

    def save(self, spark, path: str) -> None:
        """The model as one JSON row."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> Scorecard:
        return cls.from_json(spark.read.text(path, wholetext=True).first()[0])

    # -- compiled columns ---------------------------------------------------------------
    def value(self, name: str, get: Callable[[str], Column]) -> Column:
        """A feature's value from the columns that ``get`` gives; derived ones are computed."""
        return rules.derived_value(name, get) if name in S.DERIVED_FEATURES else get(name)

    def _places(self, name: str) -> tuple[list, list[list[float]]]:
        """What a feature's value is looked up in, and the points of all folds by place.

        Numeric: the folds' merged edges, a row per interval and one for a missing value. Categorical: the known
        categories, after a row for all others."""
        k = range(self.folds)
        if name in self.numeric:
            keys = sorted({e for fold in self.edges[name] for e in fold})

            def at(g, v):
                return self.points[name][g][bisect_right(self.edges[name][g], v)]
            rows = [[at(g, v) for g in k] for v in [-math.inf, *keys]] + [[at(g, self.medians[name][g]) for g in k]]
        else:
            keys = sorted({c for fold in self.categories[name] for c in fold})
            rows = [self.unseen[name]] + [[self.categories[name][g].get(c, self.unseen[name][g]) for g in k] for c in keys]
        return keys, rows

    def _table(self, name: str) -> tuple[list, Column]:
        """``_places`` with the points as a literal array of arrays."""
        keys, rows = self._places(name)
        return keys, F.expr("array(" + ", ".join(f"array({', '.join(f'{p!r}D' for p in row)})" for row in rows) + ")")

    def points_of(self, name: str, value: Column) -> Column:
        """Points that a feature's value adds in all folds, as an array (compact: one search, one look-up)."""
        keys, table = self._table(name)
        if name not in self.numeric:
            return F.get(table, F.array_position(F.lit(keys), F.coalesce(value.cast("string"), F.lit(MISSING))).cast("int"))
        v = value.cast("double")
        place = F.lit(0)
        if keys:
            place = F.size(F.filter(F.expr(f"array({', '.join(f'{e!r}D' for e in keys)})"), lambda e: e <= v))
        return F.get(table, F.when(v.isNull() | F.isnan(v), F.lit(len(keys) + 1)).otherwise(place))

    def with_points(self, df: DataFrame, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
        """``df`` with a column for each of ``wanted`` (name -> feature and its value): points in all folds, as an array.

        The bins of all numeric values are found by one ``Bucketizer``."""
        before, values, splits, found = df.columns, {}, [], {}
        for out, (name, value) in wanted.items():
            keys, table = self._table(name)
            if name in self.numeric and keys:
                values[out] = F.coalesce(value.cast("double"), F.lit(float("nan")))  # kept as a bucket after the others
                splits.append([-math.inf, *keys, math.inf])
                found[out] = F.get(table, F.col(f"_b_{out}").cast("int"))
            else:
                found[out] = self.points_of(name, value)
        if splits:
            staged = df.select("*", *(v.alias(f"_v_{out}") for out, v in values.items()))
            df = Bucketizer(splitsArray=splits, inputCols=[f"_v_{out}" for out in values],
                            outputCols=[f"_b_{out}" for out in values], handleInvalid="keep").transform(staged)
        return df.select(*before, *(c.alias(out) for out, c in found.items()))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability_default``, as the calibrated models of ``plans.models``."""
        looks, inputs, k, place = self.looked_up(), self.inputs(), self.folds, self.placing()
        start, sigmoids = np.array(self.intercepts), np.array(self.sigmoids)

        def score(*values: pa.Array) -> pa.Array:
            z = np.tile(start, (len(values[0]), 1))
            for v, (keys, points) in zip(values, looks, strict=True):
                z += points[place(v, keys)]
            with np.errstate(over="ignore"):
                q = 1 / (1 + np.exp(sigmoids[:, 0] * (1 / (1 + np.exp(-z))) + sigmoids[:, 1]))
            total = q[:, 0].copy()
            for g in range(1, k):
                total += q[:, g]
            return pa.array(total / k)
        return df.withColumn("probability_default", arrow_udf(score, "double")(*inputs))

    @staticmethod
    def placing() -> Callable:
        """Function of an Arrow column and its keys: the place of every value (a closure, as tasks may not have this module).

        Numbers: by binary search over the ascending keys, missing ones and NaN after them. Text: by a dictionary, else 0."""
        def place(v: pa.Array, keys) -> np.ndarray:
            if isinstance(keys, dict):
                coded = v.dictionary_encode()
                known = np.array([keys.get(c, 0) for c in coded.dictionary.to_pylist()], np.int64)
                return known[coded.indices.to_numpy(zero_copy_only=False)]
            x = v.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            return np.where(np.isnan(x), len(keys) + 1, np.searchsorted(keys, x, "right"))
        return place

    def inputs(self) -> list[Column]:
        """Values of the features in order: numbers, and text with ``MISSING`` for NULL."""
        return [self.value(c, F.col).cast("double") if c in self.numeric else F.coalesce(self.value(c, F.col).cast("string"), F.lit(MISSING))
                for c in self.features]

    def looked_up(self) -> list[tuple]:
        """For each feature what ``placing`` looks a value up in, and the points of all folds by place."""
        out = []
        for c in self.features:
            keys, rows = self._places(c)
            out.append((np.array(keys, np.float64) if c in self.numeric else {v: i + 1 for i, v in enumerate(keys)}, np.array(rows)))
        return out

    def sums(self, point: Callable[[str, int], Column]) -> list[Column]:
        """Logits of the folds from the points that ``point`` gives for a feature and a fold."""
        out = []
        for g in range(self.folds):
            z = F.lit(self.intercepts[g])
            for c in self.features:
                z = z + point(c, g)
            out.append(z)
        return out

    def logits(self, get: Callable[[str], Column] = F.col) -> Column:
        """The folds' logits as one array column."""
        points = F.array(*(self.points_of(c, self.value(c, get)) for c in self.features))
        start = F.expr(f"array({', '.join(f'{b!r}D' for b in self.intercepts)})")
        return F.aggregate(points, start, lambda total, p: F.zip_with(total, p, lambda x, y: x + y))

    def calibrated(self, logits: list[Column]) -> Column:
        """Mean of the folds' calibrated probabilities."""
        total = None
        for z, (a, b) in zip(logits, self.sigmoids, strict=True):
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
            q = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(a) * p + F.lit(b)))
            total = q if total is None else total + q
        return total / F.lit(float(self.folds))

    def probability(self, get: Callable[[str], Column] = F.col) -> Column:
        """Calibrated probability of default."""
        return self.calibrated_array(self.logits(get))

    def calibrated_array(self, logits: Column) -> Column:
        """``calibrated`` of an array column: a few nodes, where many probabilities stand in one projection."""
        a, b = (F.expr(f"array({', '.join(f'{v[i]!r}D' for v in self.sigmoids)})") for i in (0, 1))
        one = F.lit(1.0)
        each = F.transform(logits, lambda z, g: one / (one + F.exp(
            F.get(a, g) * (one / (one + F.exp(-z))) + F.get(b, g))))
        return F.aggregate(each, F.lit(0.0), lambda total, q: total + q) / F.lit(float(self.folds))

    def scorer(self) -> Callable[[dict[str, Column]], Column]:
        """``Scorer`` of the explanations: probability with some columns substituted."""
        return lambda cols: self.probability(lambda n: cols[n] if n in cols else F.col(n))

    def impact(self, points: Column) -> Column:
        """Additive effect on the mean logit of a feature's points in all folds. Points are centred on the fold's
        training rows, so this is coefficient x (value - mean) and the effects sum to logit minus mean intercept."""
        total = points[0]
        for g in range(1, self.folds):
            total = total + points[g]
        return total / F.lit(float(self.folds))

    @property
    def base_value(self) -> float:
        return sum(self.intercepts) / self.folds


# --- fit ---------------------------------------------------------------------------------
def select_features(df: DataFrame, label: str, numeric: list[str], categorical: list[str],
                    threshold: float = S.IV_THRESHOLD) -> list[str]:
    """Names of the features whose information value reaches the threshold, sorted."""
    table = W.iv_table(W.woe_table_df(df, label, numeric, categorical))
    return sorted(r["feature"] for r in W.select_features_by_iv(table, threshold).collect())


def _categories(rows: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories of each column, NULL as ``MISSING``."""
    out: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("category"))
                          for c in columns))
        for r in rows.select(F.inline(pairs)).distinct().collect():
            out[r["feature"]].append(r["category"])
    return {c: sorted(v) for c, v in out.items()}


def _bin_counts(binned: DataFrame, m: int, k: int) -> DataFrame:
    """``(pos, b, n, n_ev)``: rows and events by place ``pos`` = fold x m + feature and bin ``b``, of the fold's training rows.

    Every task counts its own rows first and ships a row per place and bin."""
    def count(batches):
        found: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            y, fold = batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            idx = np.asarray(batch.column("idx").flatten(), np.int64).reshape(batch.num_rows, k * m)
            for g in range(k):
                train = fold != g
                t = y[train]
                for pos in range(g * m, g * m + m):
                    b = idx[train, pos]
                    n, n_ev = np.bincount(b), np.bincount(b, weights=t)
                    for at in np.nonzero(n)[0]:
                        cell = found.setdefault((pos, int(at)), [0, 0])
                        cell[0] += int(n[at])
                        cell[1] += int(n_ev[at])
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.int32()),
            pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
            names=["pos", "b", "n", "n_ev"])
    return binned.mapInArrow(count, "pos int, b int, n long, n_ev long").groupBy("pos", "b").agg(
        F.sum("n").alias("n"), F.sum("n_ev").alias("n_ev"))


def _woe_by_fold(counts: list, k: int, names: list[str], numeric: list[str], smoothing: float):
    """``woe[name][fold][bin]``, mean and scale of the training rows, from the counts."""
    woe: dict[str, list[dict]] = {c: [{} for _ in range(k)] for c in names}
    n_of = {c: [{} for _ in range(k)] for c in names}
    for r in counts:
        n_of[names[r["pos"] % len(names)]][r["pos"] // len(names)][r["b"]] = (r["n"], r["n_ev"])
    stats: dict[str, list[tuple[float, float]]] = {c: [] for c in names}
    for c in names:
        for g in range(k):
            groups = n_of[c][g]
            ev = sum(e for _, e in groups.values())
            nev = sum(n - e for n, e in groups.values())
            if not ev or not nev:
                raise ValueError("target must contain both classes (0 and 1) in every fold")
            size = smoothing * (len(groups) + (c not in numeric))
            for b, (n, e) in groups.items():
                woe[c][g][b] = math.log(((e + smoothing) / (ev + size)) / ((n - e + smoothing) / (nev + size)))
            total = ev + nev
            mean = math.fsum(n * woe[c][g][b] for b, (n, _) in groups.items()) / total
            sd = math.sqrt(math.fsum(n * (woe[c][g][b] - mean) ** 2 for b, (n, _) in groups.items()) / total)
            stats[c].append((mean, sd if sd >= FLAT else 1.0))
    return woe, stats


def _designer(tables: list[list[np.ndarray]], k: int):
    """Function of a batch and a fold: ones and the scaled WoE values of its rows under that fold."""
    m = len(tables[0])

    def design(batch: pa.RecordBatch, g: int) -> np.ndarray:
        idx = np.asarray(batch.column("idx").flatten(), np.int64).reshape(batch.num_rows, k * m)
        cols = [tables[g][j][idx[:, g * m + j]] for j in range(m)]
        return np.column_stack([np.ones(batch.num_rows), *cols])
    return design


def _newton(binned: DataFrame, design, m: int, k: int, ridge: float) -> np.ndarray:
    """Coefficients (folds x ``m``, the intercept first) of the k penalised logistic regressions."""
    beta = np.zeros((k, m))
    penalty = np.full(m, ridge)
    penalty[0] = 0.0
    for _ in range(NEWTON_STEPS):
        def sums(batches, beta=beta):
            total = np.zeros((k, m, m + 1))
            for batch in batches:
                y, fold = np.asarray(batch.column("y"), np.float64), np.asarray(batch.column("fold"))
                for g in range(k):
                    x, t = design(batch, g)[fold != g], y[fold != g]
                    p = 1 / (1 + np.exp(-(x @ beta[g])))
                    total[g, :, :m] += x.T @ (x * (p * (1 - p))[:, None])
                    total[g, :, m] += x.T @ (t - p)
            g, i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(a.ravel().astype(np.int32)) for a in (g, i, j)]
                                             + [pa.array(total.ravel())], names=["g", "i", "j", "v"])
        got = binned.mapInArrow(sums, "g int, i int, j int, v double").groupBy("g", "i", "j").agg(
            F.sum("v").alias("v")).collect()                 # k x features^2 numbers
        h = np.zeros((k, m, m + 1))
        for r in got:
            h[r["g"], r["i"], r["j"]] = r["v"]
        step = np.linalg.solve(h[:, :, :m] + np.diag(penalty), (h[:, :, m] - penalty * beta)[..., None])[..., 0]
        beta = beta + step
        if np.abs(step).max() < TOLERANCE:
            break
    return beta


def _platt(held: DataFrame, k: int) -> list[list[float]]:
    """Platt's (a, b) of every fold from ``held(g, f, y)``, by Newton steps over all folds at once."""
    sizes = {r["g"]: (r["pos"], r["n"] - r["pos"]) for r in held.groupBy("g").agg(
        F.sum("y").alias("pos"), F.count("*").alias("n")).collect()}
    ab = np.array([[0.0, math.log((sizes[g][1] + 1) / (sizes[g][0] + 1))] for g in range(k)])

    def by_fold(values):
        out = F.when(F.col("g") == 0, F.lit(float(values[0])))
        for g in range(1, k):
            out = out.when(F.col("g") == g, F.lit(float(values[g])))
        return out
    t = F.when(F.col("y") == 1, by_fold([(sizes[g][0] + 1) / (sizes[g][0] + 2) for g in range(k)])).otherwise(
        by_fold([1 / (sizes[g][1] + 2) for g in range(k)]))
    rows = held.withColumn("t", t)
    for _ in range(PLATT_STEPS):
        q = F.lit(1.0) / (F.lit(1.0) + F.exp(by_fold(ab[:, 0]) * F.col("f") + by_fold(ab[:, 1])))
        w = F.col("q") * (F.lit(1.0) - F.col("q"))
        got = rows.withColumn("q", q).groupBy("g").agg(
            F.sum((F.col("t") - F.col("q")) * F.col("f")).alias("ga"), F.sum(F.col("t") - F.col("q")).alias("gb"),
            F.sum(w * F.col("f") * F.col("f")).alias("haa"), F.sum(w * F.col("f")).alias("hab"),
            F.sum(w).alias("hbb")).collect()
        step = np.zeros((k, 2))
        for r in got:
            step[r["g"]] = np.linalg.solve([[r["haa"], r["hab"]], [r["hab"], r["hbb"]]], [r["ga"], r["gb"]])
        ab = ab - step
        if np.abs(step).max() < TOLERANCE * max(1.0, np.abs(ab).max()):
            break
    return ab.tolist()


def fit_scorecard(df: DataFrame, label: str = S.TARGET_COL, id_col: str = S.ID_COL, k: int = S.CV_FOLDS,
                  iv_threshold: float = S.IV_THRESHOLD, ridge: float = RIDGE, smoothing: float = S.WOE_SMOOTHING,
                  max_bins: int = S.WOE_MAX_BINS, min_bin_pct: float = S.WOE_MIN_BIN_PCT,
                  version: str = "scorecard-v1") -> Scorecard:
    """Select features by IV on the train split, then fit and calibrate k folds of train and validation rows."""
    frame = rules.add_derived_features(df)
    numeric = [c for c in S.NUMERIC_FEATURES + S.DERIVED_FEATURES if c in frame.columns]
    categorical = [c for c in S.CATEGORICAL_FEATURES if c in frame.columns]
    with persisted(frame.select(id_col, label, *numeric, *categorical)) as whole:     # read by each pass of the split
        split = cut_lineage(prepare.stratified_split(whole, label, id_col))
    features = select_features(split.where("split = 'train'"), label, numeric, categorical, iv_threshold)
    if not features:
        raise ValueError("no feature reaches the information value threshold")
    numeric, categorical = [c for c in features if c in numeric], [c for c in features if c in categorical]
    rows = cut_lineage(prepare.stratified_folds(prepare.train_val(split).select(id_col, label, *features), k, label, id_col)
                       .select("fold", F.col(label).cast("int").alias("y"), *features))

    n_bins = binning.n_quantile_bins(max_bins, min_bin_pct)
    medians: dict[str, list] = {}
    edges: dict[str, list] = {}
    if numeric:
        medians, raw = ranking.filled_percentiles(rows, numeric, [i / n_bins for i in range(n_bins + 1)], "fold", k)
        edges = {c: [binning.merged_edges(e) for e in raw[c]] for c in numeric}

    # every feature's place under every fold: bins by binary search, categories by their number among all of them
    names = _categories(rows, categorical)
    splits = {(g, c): [-math.inf, *edges[c][g][1:-1], math.inf] for g in range(k) for c in numeric}
    m = len(features)
    keys = [{v: i for i, v in enumerate(names[c])} if c in categorical else
            [(np.array(edges[c][g][1:-1], np.float64), medians[c][g]) for g in range(k)] for c in features]
    place = Scorecard.placing()

    def placed(batches):
        for batch in batches:
            idx = np.zeros((batch.num_rows, k * m), np.int32)
            for j, key in enumerate(keys):
                v = batch.column(j + 2)
                if isinstance(key, dict):
                    idx[:, j::m] = place(v, key)[:, None]
                    continue
                x = v.fill_null(float("nan")).to_numpy(zero_copy_only=False)
                for g, (cut, median) in enumerate(key):
                    idx[:, g * m + j] = np.searchsorted(cut, np.where(np.isnan(x), median, x), "right")
            ends = np.arange(0, idx.size + 1, k * m, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(idx.ravel()))],
                                             names=["fold", "y", "idx"])
    values = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) if c in categorical else F.col(c).cast("double") for c in features]
    binned = cut_lineage(rows.select(F.col("fold").cast("int"), "y", *(v.alias(f"v{j}") for j, v in enumerate(values)))
                         .mapInArrow(placed, "fold int, y int, idx array<int>"))
    counts = _bin_counts(binned, m, k).collect()
    woe, stats = _woe_by_fold(counts, k, features, numeric, smoothing)

    # scaled WoE by place; a category that a fold did not see has a WoE of zero, as have all others (one place more)
    tables: list[list[np.ndarray]] = []
    for g in range(k):
        row = []
        for c in features:
            mean, scale = stats[c][g]
            size = len(names[c]) + 1 if c in categorical else max(1, len(splits[g, c]) - 1)
            row.append(np.array([(woe[c][g].get(b, 0.0) - mean) / scale for b in range(size)]))
        tables.append(row)
    design = _designer(tables, k)
    beta = _newton(binned, design, len(features) + 1, k, ridge)

    def raw(batches):
        for batch in batches:
            fold, y = np.asarray(batch.column("fold")), np.asarray(batch.column("y"))
            f = np.zeros(batch.num_rows)
            for g in range(k):
                f[fold == g] = 1 / (1 + np.exp(-(design(batch, g)[fold == g] @ beta[g])))
            yield pa.RecordBatch.from_arrays([pa.array(fold), pa.array(f), pa.array(y)], names=["g", "f", "y"])
    sigmoids = _platt(cut_lineage(binned.mapInArrow(raw, "g int, f double, y int")), k)

    scaled = {c: [(tables[g][j] * beta[g, j + 1]).tolist() for g in range(k)] for j, c in enumerate(features)}
    return Scorecard(
        features=features, numeric=numeric, medians=medians,
        edges={c: [e[1:-1] for e in edges[c]] for c in numeric},
        points={c: scaled[c] for c in numeric},
        categories={c: [{names[c][b]: scaled[c][g][b] for b in woe[c][g]} for g in range(k)] for c in categorical},
        unseen={c: [scaled[c][g][-1] for g in range(k)] for c in categorical},
        coefficients=[dict(zip(features, map(float, beta[g, 1:]))) for g in range(k)],
        intercepts=beta[:, 0].tolist(), sigmoids=sigmoids, version=version)
