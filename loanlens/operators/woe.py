"""Weight-of-evidence fit and lookup, information value.

Plan shape of ``fit_woe`` (one pass over the rows after the edge pass):

  scan -> Arrow batches: every numeric column's bins by one binary search over
  its edges, counted by task; categories counted by batch -> shuffle of
  (#features x #bins) rows per task and a row per batch and category -> final
  aggregate -> tiny table.

Rows never become long, and no generated method holds a comparison per column
and edge (such a method is too large to be compiled by the JVM).

No key of that aggregate can be hot in a way that matters: every map task
pre-aggregates, so a bin holding a third of all rows still ships one row per
task. The fitted tables are bounded by the number of bins and categories, not
by the data; they are collected once to build the lookup expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .. import schema as S
from ..functions.numeric import round_dp
from ..session import persisted
from ..functions.scorecard import iv_strength, sql_iv_strength
from . import binning

WOE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("bin", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("is_missing", T.BooleanType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("n_ev", T.LongType()),
    T.StructField("n_nev", T.LongType()),
    T.StructField("woe", T.DoubleType()),
    T.StructField("iv_part", T.DoubleType()),
])


@dataclass
class WoeModel:
    """Fitted encoder: edges per numeric feature and the long WoE table."""
    numeric_cols: list[str]
    categorical_cols: list[str]
    edges: dict[str, list[float]]
    woe_rows: list = field(default_factory=list)  # collected rows of ``woe_table``
    spark: SparkSession | None = None

    # -- tables -------------------------------------------------------------
    def woe_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.woe_rows, WOE_SCHEMA)

    def iv_table(self) -> DataFrame:
        return iv_table(self.woe_table())

    # -- lookup (J1, J2) ----------------------------------------------------
    def _maps(self):
        numeric: dict[str, dict[int, float]] = {c: {} for c in self.numeric_cols}
        cats: dict[str, dict[str, float]] = {c: {} for c in self.categorical_cols}
        missing: dict[str, float] = {}
        for r in self.woe_rows:
            if r["is_missing"]:
                missing[r["feature"]] = r["woe"]
            elif r["kind"] == "numeric":
                numeric[r["feature"]][r["bin"]] = r["woe"]
            else:
                cats[r["feature"]][r["category"]] = r["woe"]
        return numeric, cats, missing

    def woe_columns(self, columns, woes: str = "__woes") -> dict[str, Column]:
        """One column per fitted feature over the result of ``with_woes``; absent columns give 0.0."""
        _, cats, missing = self._maps()
        place = {c: j for j, c in enumerate(c for c in self.numeric_cols if c in columns)}
        out: dict[str, Column] = {c: F.get(F.col(woes), F.lit(place[c])) if c in place else F.lit(0.0) for c in self.numeric_cols}
        for c in self.categorical_cols:
            if c not in columns:
                out[c] = F.lit(0.0)
                continue
            miss = F.lit(missing.get(c, 0.0))
            out[c] = F.coalesce(F.col(f"__w_{c}"), miss) if cats[c] else miss
        return out

    def numeric_woes(self, columns, filled: dict[str, tuple[str, float | None]] | None = None) -> Column:
        """WoE of every numeric column of ``columns``, as an array: one binary search a value, in Arrow batches.

        ``filled``: of a column that is another one with a value in place of NULL, that one and the value.
        """
        numeric, _, missing = self._maps()
        present = [c for c in self.numeric_cols if c in columns]
        source = {c: (filled or {}).get(c, (c, None)) for c in present}
        looks = []
        for c in present:
            interior = np.array(self.edges.get(c, [])[1:-1], np.float64)
            looks.append((interior, np.array([numeric[c].get(b, 0.0) for b in range(len(interior) + 1)] + [missing.get(c, 0.0)]),
                          source[c][1]))

        def find(*values: pa.Array) -> pa.Array:
            out = np.empty((len(values[0]), len(looks)))
            for j, (v, (interior, woes, fill)) in enumerate(zip(values, looks, strict=True)):
                at = np.searchsorted(interior, v.fill_null(0.0 if fill is None else fill).to_numpy(zero_copy_only=False), "right")
                if fill is None:
                    at[v.is_null().to_numpy(zero_copy_only=False)] = len(interior) + 1
                out[:, j] = woes[at]
            ends = np.arange(0, out.size + 1, len(looks), dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
        return arrow_udf(find, "array<double>")(*(F.col(source[c][0]).cast("double") for c in present))

    def with_woes(self, df: DataFrame) -> DataFrame:
        """``with_categories`` and the array ``__woes`` of the numeric columns' WoE."""
        wide = self.with_categories(df)
        return wide.withColumn("__woes", self.numeric_woes(df.columns)) if any(c in df.columns for c in self.numeric_cols) else wide

    def with_categories(self, df: DataFrame) -> DataFrame:
        """The WoE of each categorical column ``c`` as ``__w_c``, by a join with its fitted table.

        The tables are local relations, so Spark knows their sizes: it broadcasts those under its
        threshold and shuffles for larger ones.
        """
        _, cats, _ = self._maps()
        for c in self.categorical_cols:
            if c in df.columns and cats[c]:
                fitted = df.sparkSession.createDataFrame(pa.table(
                    {f"__k_{c}": pa.array(list(cats[c]), pa.string()),
                     f"__w_{c}": pa.array(list(cats[c].values()), pa.float64())}))
                df = df.join(fitted, F.col(c).cast("string") == F.col(f"__k_{c}"), "left").drop(f"__k_{c}")
        return df

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Replace feature values by their WoE."""
        keep = [k for k in (keep or []) if k in df.columns]
        cols = self.woe_columns(set(df.columns))
        return self.with_woes(df).select(*keep, *[v.alias(k) for k, v in cols.items()])


def _feature_lists(df: DataFrame, target: str, numeric_cols, categorical_cols, exclude):
    excl = set(exclude) | {target}
    if numeric_cols is None:
        numeric_cols = S.numeric_columns(df, exclude=excl)
    if categorical_cols is None:
        categorical_cols = S.categorical_columns(df, exclude=excl)
    return list(numeric_cols), list(categorical_cols)


def woe_counts(df: DataFrame, target: str, numeric_cols: list[str], categorical_cols: list[str],
               edges: dict[str, list[float]]) -> DataFrame:
    """Long ``(feature, kind, bin, category, n, n_ev)`` counts in one aggregation."""
    cuts = [np.array(edges.get(c, [])[1:-1], np.float64) for c in numeric_cols]
    rows = df.select(F.col(target).cast("long").alias("y"),
                     *(F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(numeric_cols)),
                     *(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical_cols)))
    n_cat = len(categorical_cols)

    def cells(at, size, known, y):
        """Rows, rows with a label and the sum of the labels by place."""
        return np.stack([np.bincount(at, minlength=size), np.bincount(at, known, size), np.bincount(at, y, size)]).astype(np.int64)

    def table(column, kind, places, categories, found):
        n, known, ev = found
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), column, np.int32)), pa.array([kind] * len(n), pa.string()), pa.array(places, pa.int32()),
             categories, pa.array(n), pa.array(ev, mask=known == 0)], names=["i", "kind", "bin", "category", "n", "n_ev"])

    def count(batches):
        sums = [np.zeros((3, len(cut) + 2), np.int64) for cut in cuts]     # the last place is a missing value
        for batch in batches:
            label = batch.column("y")
            known = label.is_valid().to_numpy(zero_copy_only=False).astype(np.float64)
            y = label.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            for i, cut in enumerate(cuts):
                v = batch.column(f"v{i}")
                at = np.searchsorted(cut, v.fill_null(0.0).to_numpy(zero_copy_only=False), "right")
                at[v.is_null().to_numpy(zero_copy_only=False)] = len(cut) + 1
                sums[i] += cells(at, len(cut) + 2, known, y)
            for i in range(n_cat):
                coded = batch.column(f"c{i}").dictionary_encode("encode")   # NULL is a category here
                size = len(coded.dictionary)
                if size:
                    at = coded.indices.to_numpy(zero_copy_only=False)
                    yield table(i, "categorical", [None] * size, coded.dictionary.cast(pa.string()), cells(at, size, known, y))
        for i, cut in enumerate(cuts):
            there = np.nonzero(sums[i][0])[0]
            if len(there):
                places = [int(b) if b <= len(cut) else None for b in there]
                yield table(i, "numeric", places, pa.nulls(len(there), pa.string()), sums[i][:, there])
    names = F.when(F.col("kind") == "numeric", F.get(F.lit(numeric_cols or [""]), F.col("i"))).otherwise(
        F.get(F.lit(categorical_cols or [""]), F.col("i")))
    return (rows.mapInArrow(count, "i int, kind string, bin int, category string, n long, n_ev long")
            .groupBy(names.alias("feature"), "kind", "bin", "category")
            .agg(F.sum("n").alias("n"), F.sum("n_ev").alias("n_ev")))


def woe_from_counts(counts: DataFrame, edges_df: DataFrame | None,
                    smoothing: float = S.WOE_SMOOTHING, guard: bool = False) -> DataFrame:
    """WoE and IV part per group; totals and group counts per feature by a second, map-side combined aggregate.

    A feature of many categories is so never gathered in one task; the totals are a row per feature.
    ``guard``: a target of one class fails when the table is computed (A7).
    """
    s = F.lit(float(smoothing))
    missing = F.when(F.col("kind") == "numeric", F.col("bin").isNull()).otherwise(F.col("category").isNull())
    t = counts.withColumn("n_nev", F.col("n") - F.col("n_ev")).withColumn("is_missing", missing)
    totals = t.groupBy("feature").agg(F.sum("n_ev").alias("tot_ev"), F.sum("n_nev").alias("tot_nev"),
                                      F.sum(F.when(F.col("is_missing"), 0).otherwise(1)).alias("n_groups"))
    t = t.join(F.broadcast(totals), "feature")
    if guard:
        one_class = (F.col("tot_ev") == 0) | (F.col("tot_nev") == 0)
        t = t.withColumn("tot_ev", F.when(one_class, F.raise_error("target must contain both classes (0 and 1)")
                                          .cast("long")).otherwise(F.col("tot_ev")))
    b = F.when(F.col("kind") == "numeric", F.col("n_groups")).otherwise(F.col("n_groups") + 1)
    den_ev = F.when(F.col("is_missing"), F.col("tot_ev") + s).otherwise(F.col("tot_ev") + s * b)
    den_nev = F.when(F.col("is_missing"), F.col("tot_nev") + s).otherwise(F.col("tot_nev") + s * b)
    t = (t.withColumn("dist_ev", (F.col("n_ev") + s) / den_ev)
          .withColumn("dist_nev", (F.col("n_nev") + s) / den_nev)
          .withColumn("woe", F.ln(F.col("dist_ev") / F.col("dist_nev")))
          .withColumn("iv_part", F.when(F.col("is_missing"), F.lit(0.0))
                      .otherwise((F.col("dist_ev") - F.col("dist_nev")) * F.col("woe"))))
    if edges_df is not None:
        e = edges_df.select(F.col("feature").alias("_f"), "edges")
        t = t.join(F.broadcast(e), t["feature"] == e["_f"], "left")
        lo = F.get(F.col("edges"), F.col("bin"))
        hi = F.coalesce(F.get(F.col("edges"), F.col("bin") + 1), F.element_at("edges", -1))
    else:
        lo = hi = F.lit(None).cast("double")
    return t.select("feature", "kind", F.col("bin").cast("int").alias("bin"), "category",
                    "is_missing", lo.cast("double").alias("lo"), hi.cast("double").alias("hi"),
                    F.col("n").cast("long").alias("n"), F.col("n_ev").cast("long").alias("n_ev"),
                    F.col("n_nev").cast("long").alias("n_nev"), "woe", "iv_part")


def fit_woe(df: DataFrame, target: str = S.TARGET_COL, numeric_cols=None, categorical_cols=None,
            exclude=(S.ID_COL,), smoothing: float = S.WOE_SMOOTHING,
            max_bins: int = S.WOE_MAX_BINS, min_bin_pct: float = S.WOE_MIN_BIN_PCT,
            quantiles: str = "exact", persist=False) -> WoeModel:
    """Fit WoE bins for every feature: two passes over the data in total."""
    with persisted(df, persist):
        return _fit_woe(df, target, numeric_cols, categorical_cols, exclude, smoothing, max_bins,
                        min_bin_pct, quantiles)


def _fit_woe(df, target, numeric_cols, categorical_cols, exclude, smoothing, max_bins, min_bin_pct,
             quantiles) -> WoeModel:
    numeric_cols, categorical_cols = _feature_lists(df, target, numeric_cols, categorical_cols, exclude)
    n_bins = binning.n_quantile_bins(max_bins, min_bin_pct)
    spark = df.sparkSession
    if numeric_cols:
        edges_df = binning.quantile_edges(df, numeric_cols, n_bins, quantiles)
        edges = binning.collect_edges(edges_df)
        edges_df = spark.createDataFrame([(k, v) for k, v in edges.items()],
                                         "feature string, edges array<double>")
    else:
        edges, edges_df = {}, None
    counts = woe_counts(df, target, numeric_cols, categorical_cols, edges)
    rows = woe_from_counts(counts, edges_df, smoothing).collect()
    if rows:
        r0 = [r for r in rows if r["feature"] == rows[0]["feature"]]
        n_ev = sum(r["n_ev"] for r in r0)
        n_nev = sum(r["n_nev"] for r in r0)
    else:
        n_ev = n_nev = 0
    if n_ev == 0 or n_nev == 0:  # A7: one-class guard
        raise ValueError("target must contain both classes (0 and 1)")
    return WoeModel(numeric_cols, categorical_cols, edges, rows, spark)


def woe_table_df(df: DataFrame, target: str, numeric_cols, categorical_cols,
                 smoothing: float = S.WOE_SMOOTHING, max_bins: int = S.WOE_MAX_BINS,
                 min_bin_pct: float = S.WOE_MIN_BIN_PCT, quantiles: str = "exact") -> DataFrame:
    """The fitted WoE table as a lazy DataFrame (edges joined, no collect)."""
    n_bins = binning.n_quantile_bins(max_bins, min_bin_pct)
    edges_df = binning.quantile_edges(df, numeric_cols, n_bins, quantiles) if numeric_cols else None
    edges = binning.collect_edges(edges_df) if edges_df is not None else {}
    if edges_df is not None:  # the collected edges, not their plan a second time
        edges_df = df.sparkSession.createDataFrame(list(edges.items()), "feature string, edges array<double>")
    counts = woe_counts(df, target, numeric_cols, categorical_cols, edges)
    return woe_from_counts(counts, edges_df, smoothing, guard=True)


def iv_table(woe_table: DataFrame) -> DataFrame:
    """Feature, iv (4 dp), strength (on unrounded iv), n_bins (+1 MISSING), IV desc."""
    agg = (woe_table.groupBy("feature")
           .agg(F.sum("iv_part").alias("iv_raw"),
                F.sum(F.when(F.col("is_missing"), 0).otherwise(1)).alias("n_occ")))
    return (agg.select("feature", round_dp("iv_raw", 4).alias("iv"),
                       iv_strength(F.col("iv_raw")).alias("strength"),
                       (F.col("n_occ") + 1).cast("int").alias("n_bins"))
            .orderBy(F.desc("iv"), "feature"))


def select_features_by_iv(iv_tbl: DataFrame, threshold: float = S.IV_THRESHOLD) -> DataFrame:
    """Features whose rounded IV is at least ``threshold``."""
    return iv_tbl.where(F.col("iv") >= threshold)


def dropped_features_by_iv(iv_tbl: DataFrame, threshold: float = S.IV_THRESHOLD) -> DataFrame:
    """The complement of P9."""
    return iv_tbl.where(F.col("iv") < threshold)


# --- DuckDB twins ---------------------------------------------------------------
def sql_woe_table(source: str, target: str, numeric_cols, categorical_cols,
                  smoothing: float = S.WOE_SMOOTHING, n_bins: int = 10) -> str:
    """CTE list (without WITH) ending in ``woe_tbl``; ``source`` is a relation name."""
    s = repr(float(smoothing))
    num_union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST({target} AS BIGINT) AS y FROM {source}"
        for c in numeric_cols)
    cat_union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, CAST({target} AS BIGINT) AS y FROM {source}"
        for c in categorical_cols)
    parts = []
    groups = []
    if numeric_cols:
        parts.append(f"w_num AS ({num_union})")
        parts.append(f"w_edges AS ({binning.sql_quantile_edges('w_num', n_bins)})")
        parts.append("w_nbin AS (SELECT n.feature, 'numeric' AS kind, "
                     f"{binning.sql_bin_index('n.value', 'e.edges')} AS bin, CAST(NULL AS VARCHAR) AS category, n.y "
                     "FROM w_num n LEFT JOIN w_edges e ON n.feature = e.feature)")
        groups.append("SELECT feature, kind, bin, category, y FROM w_nbin")
    if categorical_cols:
        parts.append(f"w_cat AS ({cat_union})")
        groups.append("SELECT feature, 'categorical' AS kind, CAST(NULL AS INTEGER) AS bin, category, y FROM w_cat")
    parts.append("w_cnt AS (SELECT feature, kind, bin, category, count(*) AS n, sum(y) AS n_ev FROM ("
                 + " UNION ALL ".join(groups) + ") GROUP BY ALL)")
    parts.append(
        "w_tot AS (SELECT *, n - n_ev AS n_nev, "
        "CASE WHEN kind = 'numeric' THEN bin IS NULL ELSE category IS NULL END AS is_missing, "
        "sum(n_ev) OVER (PARTITION BY feature) AS tot_ev, "
        "sum(n - n_ev) OVER (PARTITION BY feature) AS tot_nev, "
        "sum(CASE WHEN (CASE WHEN kind = 'numeric' THEN bin IS NULL ELSE category IS NULL END) THEN 0 ELSE 1 END) "
        "OVER (PARTITION BY feature) AS n_groups FROM w_cnt)")
    parts.append(
        "w_dist AS (SELECT *, "
        f"(n_ev + {s}) / CASE WHEN is_missing THEN tot_ev + {s} ELSE tot_ev + {s} * "
        "(CASE WHEN kind = 'numeric' THEN n_groups ELSE n_groups + 1 END) END AS dist_ev, "
        f"(n_nev + {s}) / CASE WHEN is_missing THEN tot_nev + {s} ELSE tot_nev + {s} * "
        "(CASE WHEN kind = 'numeric' THEN n_groups ELSE n_groups + 1 END) END AS dist_nev FROM w_tot)")
    edges_join = "LEFT JOIN w_edges e ON d.feature = e.feature" if numeric_cols else ""
    lo = "e.edges[d.bin + 1]" if numeric_cols else "CAST(NULL AS DOUBLE)"
    hi = "coalesce(e.edges[d.bin + 2], e.edges[-1])" if numeric_cols else "CAST(NULL AS DOUBLE)"
    parts.append(
        "woe_tbl AS (SELECT d.feature, d.kind, d.bin, d.category, d.is_missing, "
        f"{lo} AS lo, {hi} AS hi, d.n, d.n_ev, d.n_nev, "
        "ln(d.dist_ev / d.dist_nev) AS woe, "
        "CASE WHEN d.is_missing THEN 0.0 ELSE (d.dist_ev - d.dist_nev) * ln(d.dist_ev / d.dist_nev) END AS iv_part "
        f"FROM w_dist d {edges_join})")
    return ",\n".join(parts)


def sql_iv_table(woe_tbl: str = "woe_tbl") -> str:
    return ("SELECT feature, round(iv_raw, 4) AS iv, "
            f"{sql_iv_strength('iv_raw')} AS strength, CAST(n_occ + 1 AS INTEGER) AS n_bins FROM ("
            "SELECT feature, sum(iv_part) AS iv_raw, "
            f"sum(CASE WHEN is_missing THEN 0 ELSE 1 END) AS n_occ FROM {woe_tbl} GROUP BY feature) "
            "ORDER BY iv DESC, feature")
