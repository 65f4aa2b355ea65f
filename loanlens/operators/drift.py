"""Feature drift: PSI per feature, report and rollup.

All numeric features go through one long ``(feature, value)`` pass per side;
all categorical features through another. Each side is aggregated on its own
(partial aggregation, so a hot category costs one row per map task) and the
two small distributions meet in a full outer join on ``(feature, bin)`` (J3).
The decile edges of the reference are the only thing collected: at most
``n_bins + 1`` numbers per feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scorecard import psi_status, sql_psi_status
from . import binning
from .ranking import percentiles

MIN_CURRENT_ROWS = 10
WARN_CURRENT_ROWS = 30


def drift_columns(reference: DataFrame, current: DataFrame, numeric_cols=None,
                  categorical_cols=None, id_cols=(S.ID_COL,)):
    """Explicit lists or by type; ids removed; columns absent from current skipped."""
    num = list(numeric_cols) if numeric_cols is not None else S.numeric_columns(reference)
    cat = list(categorical_cols) if categorical_cols is not None else S.categorical_columns(reference)
    num = [c for c in num if c not in id_cols and c in current.columns]
    cat = [c for c in cat if c not in id_cols and c in current.columns]
    return num, cat


def compare_distributions(ref_counts: DataFrame, cur_counts: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two count tables; an absent side counts 0."""
    r = ref_counts.withColumnRenamed("n", "n_ref")
    c = cur_counts.withColumnRenamed("n", "n_cur")
    return (r.join(c, keys, "full")
            .select(*keys, F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
                    F.coalesce("n_cur", F.lit(0)).alias("n_cur")))


def _psi_terms(shares: DataFrame, epsilon: float) -> Column:
    eps = F.lit(float(epsilon))
    e = F.when(F.col("e") == 0, eps).otherwise(F.col("e"))
    a = F.when(F.col("a") == 0, eps).otherwise(F.col("a"))
    return (a - e) * F.ln(a / e)


def reference_edges(reference: DataFrame, cols: list[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Deciles of the reference's non-null values, exact duplicates removed."""
    if not cols:
        return {}
    probs = [i / n_bins for i in range(n_bins + 1)]
    long = binning.long_values(reference, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    e = percentiles(long, "value", probs, "feature").select("feature", F.array_distinct("q").alias("edges"))
    return binning.collect_edges(e)


def hist_bin(v: Column, edges: list[float]) -> Column:
    """Histogram bin: ``[e_i, e_i+1)``, last bin closed, NULL outside or for < 2 edges."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    inside = (v >= F.lit(float(edges[0]))) & (v <= F.lit(float(edges[-1])))
    out = F.when(~inside | v.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:-1]):
        out = out.when(v < F.lit(float(e)), F.lit(i))
    return out.otherwise(F.lit(len(edges) - 2))


def _binned_counts(df: DataFrame, cols: list[str], edges: dict[str, list[float]]) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("feature"),
                        F.col(c).cast("double").alias("value"),
                        hist_bin(F.col(c).cast("double"), edges.get(c, [])).alias("bin"))
               for c in cols]
    long = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull() & ~F.isnan("value"))
    # ``bin`` NULL = valid value outside the reference range: no bin, but in the total.
    return long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def numeric_psi(reference: DataFrame, current: DataFrame, cols: list[str], n_bins: int = 10,
                epsilon: float = S.PSI_EPSILON) -> DataFrame:
    """(feature, psi) for numeric columns."""
    spark = reference.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, psi double")
    edges = reference_edges(reference, cols, n_bins)
    dist = compare_distributions(_binned_counts(reference, cols, edges),
                                 _binned_counts(current, cols, edges), ["feature", "bin"])
    w = Window.partitionBy("feature")  # tiny table: features x bins
    shares = (dist.withColumn("t_ref", F.sum("n_ref").over(w)).withColumn("t_cur", F.sum("n_cur").over(w))
              .where(F.col("bin").isNotNull())
              .withColumn("e", F.col("n_ref") / F.col("t_ref"))
              .withColumn("a", F.col("n_cur") / F.col("t_cur")))
    per = (shares.groupBy("feature")
           .agg(F.sum(_psi_terms(shares, epsilon)).alias("psi_raw"),
                F.min("t_ref").alias("t_ref"), F.min("t_cur").alias("t_cur")))
    valid = (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    names = spark.createDataFrame([(c,) for c in cols], "feature string")
    return (names.join(per, "feature", "left")
            .select("feature", F.when(valid, F.col("psi_raw")).otherwise(F.lit(0.0)).alias("psi")))


def _category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("feature"),
                        F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("category"))
               for c in cols]
    return df.select(F.inline(F.array(*entries))).groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("n"))


def categorical_psi(reference: DataFrame, current: DataFrame, cols: list[str],
                    epsilon: float = S.PSI_EPSILON) -> DataFrame:
    """A15 (+U2: the category union is the full outer join)."""
    spark = reference.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, psi double")
    dist = compare_distributions(_category_counts(reference, cols), _category_counts(current, cols),
                                 ["feature", "category"])
    # totals are a row per feature, so a feature of many categories is never gathered in one task
    totals = dist.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    shares = (dist.join(F.broadcast(totals), "feature").withColumn("e", F.col("n_ref") / F.col("t_ref"))
              .withColumn("a", F.col("n_cur") / F.col("t_cur")))
    return shares.groupBy("feature").agg(F.sum(_psi_terms(shares, epsilon)).alias("psi"))


def category_union(reference: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Distinct categories seen on either side."""
    return (reference.select(F.col(col).cast("string").alias("category"))
            .union(current.select(F.col(col).cast("string").alias("category")))
            .where(F.col("category").isNotNull()).distinct())


def category_unions(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """U2 for several columns: (feature, category) seen on either side, by one aggregate over both."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])
    both = reference.select(F.inline(entries)).union(current.select(F.inline(entries)))
    return both.where("category is not null").distinct()


def drift_report(reference: DataFrame, current: DataFrame, numeric_cols=None,
                 categorical_cols=None, n_bins: int = 10, epsilon: float = S.PSI_EPSILON) -> DataFrame:
    """Feature, psi, status, n_reference, n_current; PSI descending."""
    num, cat = drift_columns(reference, current, numeric_cols, categorical_cols)
    psi = numeric_psi(reference, current, num, n_bins, epsilon).unionByName(
        categorical_psi(reference, current, cat, epsilon))
    n_ref = reference.agg(F.count(F.lit(1))).scalar()
    n_cur = current.agg(F.count(F.lit(1))).scalar()
    return (psi.select("feature", "psi", psi_status(F.col("psi")).alias("status"),
                       n_ref.alias("n_reference"), n_cur.alias("n_current"))
            .orderBy(F.desc("psi"), "feature"))


def drift_rollup(report: DataFrame) -> DataFrame:
    """Counts and the worst status; guard on the current sample size."""
    agg = report.agg(
        F.count(F.lit(1)).alias("n_features_checked"),
        F.sum(F.when(F.col("status") == "alert", 1).otherwise(0)).alias("n_alerts"),
        F.sum(F.when(F.col("status") == "monitor", 1).otherwise(0)).alias("n_monitor"),
        F.max("n_current").alias("n_current"))
    overall = (F.when(F.col("n_current") < MIN_CURRENT_ROWS, "insufficient_data")
               .when(F.col("n_alerts") > 0, "alert")
               .when(F.col("n_monitor") > 0, "monitor").otherwise("stable"))
    return agg.select(overall.alias("overall_status"),
                      F.col("n_features_checked").cast("long").alias("n_features_checked"),
                      F.col("n_alerts").cast("long").alias("n_alerts"),
                      F.col("n_monitor").cast("long").alias("n_monitor"),
                      (F.col("n_current") < WARN_CURRENT_ROWS).alias("low_sample_warning"))


# --- DuckDB twins ----------------------------------------------------------------
def sql_drift_report(ref: str, cur: str, numeric_cols, categorical_cols, n_bins: int = 10,
                     epsilon: float = S.PSI_EPSILON) -> list[str]:
    """CTE list ending in ``drift_rep``."""
    eps = repr(float(epsilon))
    probs = ", ".join(repr(i / n_bins) for i in range(n_bins + 1))

    def longv(src):
        return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}"
                                  for c in numeric_cols)

    def longc(src):
        return " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM {src}"
                                  for c in categorical_cols)
    bin_expr = ("CASE WHEN len(e.edges) >= 2 AND l.value >= e.edges[1] AND l.value <= e.edges[-1] "
                "THEN len(list_filter(e.edges[2:len(e.edges)-1], lambda x: x <= l.value)) END")
    psi = (f"(CASE WHEN a = 0 THEN {eps} ELSE a END - CASE WHEN e = 0 THEN {eps} ELSE e END) * "
           f"ln(CASE WHEN a = 0 THEN {eps} ELSE a END / CASE WHEN e = 0 THEN {eps} ELSE e END)")
    if categorical_cols:
        cat_ctes = [
            f"dr_cr AS (SELECT feature, category, count(*) AS n FROM ({longc(ref)}) GROUP BY ALL)",
            f"dr_cc AS (SELECT feature, category, count(*) AS n FROM ({longc(cur)}) GROUP BY ALL)",
            "dr_cj AS (SELECT coalesce(r.feature, c.feature) AS feature, coalesce(r.n, 0) AS n_ref, "
            "coalesce(c.n, 0) AS n_cur FROM dr_cr r FULL OUTER JOIN dr_cc c ON r.feature = c.feature AND r.category = c.category)",
            f"dr_cat AS (SELECT feature, sum({psi}) AS psi FROM (SELECT feature, n_ref / sum(n_ref) OVER (PARTITION BY feature) AS e, "
            "n_cur / sum(n_cur) OVER (PARTITION BY feature) AS a FROM dr_cj) GROUP BY feature)",
        ]
    else:
        cat_ctes = ["dr_cat AS (SELECT CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS psi WHERE false)"]
    return [
        f"dr_lr AS ({longv(ref)})", f"dr_lc AS ({longv(cur)})",
        f"dr_e AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges "
        "FROM dr_lr WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature)",
        f"dr_br AS (SELECT l.feature, {bin_expr} AS bin, count(*) AS n FROM dr_lr l LEFT JOIN dr_e e "
        "ON l.feature = e.feature WHERE l.value IS NOT NULL AND NOT isnan(l.value) GROUP BY ALL)",
        f"dr_bc AS (SELECT l.feature, {bin_expr} AS bin, count(*) AS n FROM dr_lc l LEFT JOIN dr_e e "
        "ON l.feature = e.feature WHERE l.value IS NOT NULL AND NOT isnan(l.value) GROUP BY ALL)",
        "dr_j AS (SELECT coalesce(r.feature, c.feature) AS feature, coalesce(r.bin, c.bin) AS bin, "
        "coalesce(r.n, 0) AS n_ref, coalesce(c.n, 0) AS n_cur FROM dr_br r FULL OUTER JOIN dr_bc c "
        "ON r.feature = c.feature AND r.bin IS NOT DISTINCT FROM c.bin)",
        "dr_s AS (SELECT feature, bin, n_ref / sum(n_ref) OVER (PARTITION BY feature) AS e, "
        "n_cur / sum(n_cur) OVER (PARTITION BY feature) AS a, sum(n_ref) OVER (PARTITION BY feature) AS t_ref, "
        "sum(n_cur) OVER (PARTITION BY feature) AS t_cur FROM dr_j)",
        f"dr_num AS (SELECT feature, CASE WHEN min(t_ref) > 0 AND min(t_cur) > 0 THEN coalesce(sum({psi}) "
        "FILTER (WHERE bin IS NOT NULL), 0) ELSE 0 END AS psi FROM dr_s GROUP BY feature)",
        *cat_ctes,
        f"drift_rep AS (SELECT feature, psi, {sql_psi_status('psi')} AS status, "
        f"(SELECT count(*) FROM {ref}) AS n_reference, (SELECT count(*) FROM {cur}) AS n_current "
        "FROM (SELECT * FROM dr_num UNION ALL SELECT * FROM dr_cat))",
    ]


def sql_drift_rollup(rep: str = "drift_rep") -> str:
    return (f"SELECT CASE WHEN max(n_current) < {MIN_CURRENT_ROWS} THEN 'insufficient_data' "
            "WHEN sum(CASE WHEN status = 'alert' THEN 1 ELSE 0 END) > 0 THEN 'alert' "
            "WHEN sum(CASE WHEN status = 'monitor' THEN 1 ELSE 0 END) > 0 THEN 'monitor' ELSE 'stable' END AS overall_status, "
            "CAST(count(*) AS BIGINT) AS n_features_checked, "
            "CAST(sum(CASE WHEN status = 'alert' THEN 1 ELSE 0 END) AS BIGINT) AS n_alerts, "
            "CAST(sum(CASE WHEN status = 'monitor' THEN 1 ELSE 0 END) AS BIGINT) AS n_monitor, "
            f"max(n_current) < {WARN_CURRENT_ROWS} AS low_sample_warning FROM {rep}")
