"""Dataset preparation.

Row-level work is one projection or one aggregate each; the only driver-side
step is VIF, which inverts a k x k correlation matrix (k = number of numeric
columns, ~20) produced by ONE aggregate of pairwise population covariances.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.numeric import round_dp
from . import binning
from .ranking import column_percentiles, value_at_ranks


# --- A8 / A9 / A10 ------------------------------------------------------------------
def class_balance(df: DataFrame, target: str = S.TARGET_COL) -> DataFrame:
    y = F.col(target).cast("long")
    agg = df.agg(F.sum(y).alias("n_pos"), F.sum(F.lit(1) - y).alias("n_neg"))
    return agg.select("n_pos", "n_neg",
                      (F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))).alias("class_weight_ratio"))


def dataset_profile(df: DataFrame, target: str = S.TARGET_COL, drop_id: bool = False) -> DataFrame:
    """Rows, features (id counts when kept), default rate (4 dp)."""
    n_features = len([c for c in df.columns if c != target and not (drop_id and c == S.ID_COL)])
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  round_dp(F.avg(F.col(target).cast("double")), 4).alias("default_rate")).select(
        "n_rows", F.lit(n_features).alias("n_features"), "default_rate")


def missing_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A10: null share per column (4 dp), only columns with some nulls; one aggregate + unpivot."""
    cols = columns or df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "share")
    return long.where(F.col("share") > 0).select("column_name", round_dp("share", 4).alias("missing_pct"))


# --- A11 impute --------------------------------------------------------------------
def fit_medians(df: DataFrame, numeric_cols: list[str], method: str = "exact") -> DataFrame:
    """(feature, median): mean of the two middle values (linear percentile 0.5)."""
    if method == "exact":
        return df.sparkSession.createDataFrame([(c, q[0]) for c, q in column_percentiles(df, numeric_cols, [0.5]).items()],
                                               "feature string, median double")
    long = binning.long_values(df, numeric_cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("feature").agg(F.percentile_approx("value", 0.5, 100_000).alias("median"))


def impute(df: DataFrame, medians: dict[str, float], categorical_cols: list[str],
           fill_value: str = "MISSING") -> DataFrame:
    """Numeric NULL -> fitted median; categorical NULL -> constant."""
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(m)) if m is not None else F.lit(None))
             for c, m in medians.items() if c in df.columns}
    fills.update({c: F.coalesce(F.col(c).cast("string"), F.lit(fill_value))
                  for c in categorical_cols if c in df.columns})
    return df.withColumns(fills)


# --- A12 standardise ------------------------------------------------------------------
def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, scale): population std; zero std -> 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m__{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"),
                        F.when(F.col(f"s__{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s__{c}")).alias("scale"))
               for c in cols]
    return wide.select(F.inline(F.array(*entries)))


def scale(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in stats.items() if c in df.columns})


# --- A28 / A29 VIF ----------------------------------------------------------------------
def pattern_moments(df: DataFrame, cols: list[str]) -> list[tuple[list[bool], int, np.ndarray, np.ndarray]]:
    """Count, means and population covariances of the rows of every null pattern, in one aggregate.

    A pattern says which of the columns a row holds (NaN counts as NULL). Rows complete in *any* subset of
    the columns are the union of the patterns that hold it, so one scan serves every subset. The
    driver gets a row per pattern that occurs.
    """
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]
    k, rows = len(cols), df.select(*values)
    held = F.concat(*(F.when(F.col(f"x{i}").isNull(), "0").otherwise("1") for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.groupBy(held.alias("held")).agg(
        F.count("*").alias("n"), F.array(*(F.avg(f"x{i}") for i in range(k))).alias("mean"),
        F.array(*(F.covar_pop(f"x{i}", f"x{j}") for i, j in pairs)).alias("cov")).collect()
    out = []
    for r in found:
        cov = np.zeros((k, k))
        for (i, j), v in zip(pairs, r["cov"]):
            cov[i, j] = cov[j, i] = 0.0 if v is None else v
        out.append(([b == "1" for b in r["held"]], r["n"], np.array([m or 0.0 for m in r["mean"]]), cov))
    return out


def complete_covariance(moments, keep: list[int]) -> tuple[np.ndarray, int]:
    """Covariances of the rows complete in the columns ``keep``: their patterns' moments put together."""
    parts = [(n, mean[keep], cov[np.ix_(keep, keep)]) for held, n, mean, cov in moments if all(held[i] for i in keep)]
    total = sum(n for n, _, _ in parts)
    if not total:
        return np.zeros((len(keep), len(keep))), 0
    mean = sum(n * m for n, m, _ in parts) / total
    return sum(n * (c + np.outer(m - mean, m - mean)) for n, m, c in parts) / total, total


def vif_from_cov(cov: np.ndarray, cols: list[str]) -> dict[str, float]:
    """VIF_i = 1 / (1 - R_i^2) = diag(inv(corr)); constant columns 1.0; singular -> inf."""
    out: dict[str, float] = {}
    var = np.diag(cov)
    live = [i for i in range(len(cols)) if var[i] > 0]
    for i in range(len(cols)):
        if i not in live:
            out[cols[i]] = 1.0
    if len(live) == 1:
        out[cols[live[0]]] = 1.0
    elif live:
        sub = cov[np.ix_(live, live)]
        d = np.sqrt(np.diag(sub))
        corr = sub / np.outer(d, d)
        try:
            if np.linalg.cond(corr) > 1e15:
                raise np.linalg.LinAlgError
            inv = np.linalg.inv(corr)
            for j, i in enumerate(live):
                r2 = 1.0 - 1.0 / inv[j, j]
                out[cols[i]] = float(1.0 / (1.0 - r2)) if r2 < 1.0 else math.inf
        except np.linalg.LinAlgError:
            for i in live:
                out[cols[i]] = math.inf
    return out


def compute_vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """Feature, vif (2 dp), VIF descending, of the rows complete in all columns."""
    cov, _ = complete_covariance(pattern_moments(df, cols), list(range(len(cols))))
    rows = [(c, round(float(x), 2) if math.isfinite(x) else float(x)) for c, x in vif_from_cov(cov, cols).items()]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double").orderBy(F.desc("vif"), "feature")


def vif_rounds(df: DataFrame, cols: list[str], threshold: float = S.VIF_THRESHOLD):
    """Drop the worst column until all VIF are at most ``threshold``; one Spark pass in total.

    Every round takes the rows complete in the columns it still has, so rows may come back when a
    column goes (SURVEY H7). Returns (rounds, kept columns, final VIF): a round is (rows, dropped
    column, its VIF); the last one drops nothing."""
    moments = pattern_moments(df, cols)
    keep, rounds = list(range(len(cols))), []
    while keep:
        names = [cols[i] for i in keep]
        cov, n = complete_covariance(moments, keep)
        v = vif_from_cov(cov, names)
        worst = max(names, key=lambda c: (round(v[c], 2), c))
        if round(v[worst], 2) <= threshold:
            rounds.append((n, None, None))
            return rounds, names, v
        rounds.append((n, worst, v[worst]))
        keep = [i for i in keep if cols[i] != worst]
    return rounds, [], {}


def drop_high_vif(df: DataFrame, cols: list[str], threshold: float = S.VIF_THRESHOLD):
    """(kept columns, dropped columns, final VIF dict)."""
    rounds, kept, v = vif_rounds(df, cols, threshold)
    return kept, [c for _, c, _ in rounds if c is not None], v


def sql_vif_rounds(src: str, id_col: str, cols: list[str], threshold: float = S.VIF_THRESHOLD) -> list[str]:
    """SQL twin: CTEs ``vif_v<t>`` (feature, vif of round t), ``vif_c<t>`` (its rows) and ``vif_w<t>`` (what it drops).

    A correlation matrix is inverted row by row in a recursive CTE; once nothing is dropped, later rounds are empty."""
    def cte(name, body):
        return f"{name} AS MATERIALIZED ({body})"
    names = ", ".join(f"'{c}'" for c in cols)
    out = [cte("vif_l", "SELECT * FROM (" + " UNION ALL ".join(
               f"SELECT {id_col} AS id, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)
               + ") WHERE v IS NOT NULL AND NOT isnan(v)"),
           cte("vif_f0", f"SELECT unnest([{names}]) AS feature")]
    for t in range(1, len(cols) + 1):
        out += [
            cte(f"vif_c{t}", f"SELECT id FROM vif_l JOIN vif_f{t - 1} USING (feature) GROUP BY id "
                f"HAVING count(*) = (SELECT count(*) FROM vif_f{t - 1})"),
            cte(f"vif_x{t}", f"SELECT id, feature, v FROM vif_l JOIN vif_f{t - 1} USING (feature) JOIN vif_c{t} USING (id)"),
            cte(f"vif_o{t}", f"SELECT feature, row_number() OVER (ORDER BY feature) AS i, count(*) OVER () AS k FROM ("
                f"SELECT feature FROM vif_x{t} GROUP BY feature HAVING stddev_pop(v) > 0)"),
            cte(f"vif_r{t}", "SELECT i, list(r ORDER BY j) || list_transform(range(1, any_value(k) + 1), lambda q: CASE WHEN q = i THEN 1e0 "
                f"ELSE 0e0 END) AS row FROM (SELECT p.i, q.i AS j, any_value(p.k) AS k, corr(a.v, b.v) AS r FROM vif_x{t} a JOIN vif_x{t} b USING (id) "
                f"JOIN vif_o{t} p ON p.feature = a.feature JOIN vif_o{t} q ON q.feature = b.feature GROUP BY p.i, q.i) GROUP BY i"),
            f"vif_e{t}(s, m) AS (SELECT CAST(1 AS BIGINT), list(row ORDER BY i) FROM vif_r{t} HAVING count(*) > 0 UNION ALL "
            "SELECT s + 1, list_transform(m, lambda q, i: CASE WHEN i = s THEN list_transform(q, lambda v: v / m[s][s]) "
            f"ELSE list_transform(q, lambda v, j: v - q[s] / m[s][s] * m[s][j]) END) FROM vif_e{t} WHERE s <= len(m))",
            cte(f"vif_v{t}", f"SELECT f.feature, CASE WHEN o.i IS NULL THEN 1e0 ELSE round(e.m[o.i][len(e.m) + o.i], 2) END AS vif "
                f"FROM vif_f{t - 1} f LEFT JOIN vif_o{t} o USING (feature) LEFT JOIN vif_e{t} e ON e.s = len(e.m) + 1"),
            cte(f"vif_w{t}", f"SELECT feature, vif FROM vif_v{t} WHERE vif > {threshold!r} ORDER BY vif DESC, feature DESC LIMIT 1"),
            cte(f"vif_f{t}", f"SELECT feature FROM vif_f{t - 1}, (SELECT feature AS gone FROM vif_w{t}) WHERE feature <> gone"),
        ]
    return out


# --- W6 / W8 / U1 / O4 -------------------------------------------------------------------
def split_hash(id_col: str, seed: int = S.SEED) -> Column:
    """60-bit unsigned hash of ``id:seed`` (same number in Spark and DuckDB)."""
    key = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def stratified_split(df: DataFrame, target: str = S.TARGET_COL, id_col: str = S.ID_COL,
                     test_size: float = S.TEST_SIZE, val_size: float = S.VAL_SIZE,
                     seed: int = S.SEED, stratify: bool = True) -> DataFrame:
    """Adds ``split`` in {train, val, test}; per class the ``ceil(test n_c)`` smallest
    hashes are test, then ``ceil(val/(1-test) * rest)`` are val.

    The per-class cut-offs come from the ranged order statistics (no window
    over a whole class, which would put half the table in one task).
    """
    val_frac = val_size / (1.0 - test_size)
    h = df.withColumn("_h", split_hash(id_col, seed))
    grp = target if stratify else None
    if not stratify:
        h = h.withColumn("_all", F.lit(0))
        grp = "_all"

    def n_test(n):
        return F.ceil(F.lit(test_size) * n)

    cuts = value_at_ranks(h, "_h", group=grp, ranks={
        "cut_test": lambda n: n_test(n) - 1,
        "cut_val": lambda n: n_test(n) + F.ceil(F.lit(val_frac) * (n - n_test(n))) - 1,
    })
    j = h.join(F.broadcast(cuts), grp, "left")  # one row per class
    split = (F.when(F.col("_h") <= F.col("cut_test"), "test")
             .when(F.col("_h") <= F.col("cut_val"), "val").otherwise("train"))
    out = j.withColumn("split", split).drop("_h", "cut_test", "cut_val")
    return out.drop("_all") if not stratify else out


def stratified_folds(df: DataFrame, k: int = S.CV_FOLDS, target: str = S.TARGET_COL,
                     id_col: str = S.ID_COL, seed: int = S.SEED) -> DataFrame:
    """Fold in 0..k-1, contiguous blocks of the hash order within each class."""
    h = df.withColumn("_h", split_hash(id_col, seed))
    ranks = {f"cut{j}": (lambda n, j=j: F.floor(F.lit(j) * n / F.lit(k))) for j in range(1, k)}
    cuts = value_at_ranks(h, "_h", group=target, ranks=ranks)
    j = h.join(F.broadcast(cuts), target, "left")
    fold = F.lit(0)
    for i in range(1, k):
        fold = fold + F.when(F.col("_h") >= F.col(f"cut{i}"), 1).otherwise(0)
    return j.withColumn("fold", fold.cast("int")).drop("_h", *ranks)


def train_val(df_with_split: DataFrame) -> DataFrame:
    """Train and validation rows together (a filter, no copy)."""
    return df_with_split.where(F.col("split").isin("train", "val"))


def uniform_sample(df: DataFrame, n: int = 500, id_col: str = S.ID_COL, seed: int = S.SEED) -> DataFrame:
    """min(n, rows) rows with the smallest hash: a top-k, no full sort."""
    return df.withColumn("_h", split_hash(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")
