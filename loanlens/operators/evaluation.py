"""Model evaluation as distributed aggregates.

Everything ranks probabilities, so it starts from one shared frame:
``groupBy(p)`` -> (p, pos, neg). Ties collapse there, and the partial
aggregate removes any hot value before the shuffle.

Cumulative sums in descending ``p`` (KS, AUC, AP) are a *two-phase prefix
sum* (SURVEY H1): the distinct probabilities are dealt into sorted ranges of
like size (``ranking.ordered_parts``), wherever in [0, 1] they lie; the totals of
the ranges (one row per shuffle partition) give each range's offset, and a window
partitioned by range gives the running sum inside it. No window ever runs over
the whole table in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scorecard import probability_to_score
from .ranking import ordered_parts

# Bin edges exactly as numpy's linspace produces them (0.30000000000000004 etc.).
PROB_EDGES_10 = [float(x) for x in np.linspace(0.0, 1.0, 11)]
# Decision thresholds of the cost sweep: 181 values from 0.05 to 0.95 (linspace).
COST_THRESHOLDS = [float(x) for x in np.linspace(0.05, 0.95, 181)]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_frame(df: DataFrame, label: str, prob: str) -> DataFrame:
    """(p, pos, neg): one row per distinct probability. A NULL probability has no rank: it fails the job."""
    y, p = F.col(label).cast("long"), F.col(prob).cast("double")
    p = F.when(p.isNull(), F.raise_error(f"{prob} is NULL in a row to be ranked").cast("double")).otherwise(p)
    return (df.select(p.alias("p"), y.alias("y"))
            .groupBy("p").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))


def cumulative_frame(by_score: DataFrame) -> DataFrame:
    """Adds cum_pos / cum_neg (rows with score >= p) and totals P / N."""
    b = ordered_parts(by_score, "p")
    totals = b.groupBy("part").agg(F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"))
    w_all = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition at most: a single-task window here is bounded by construction.
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("b_pos").over(w_all), F.lit(0)).alias("off_pos"),
        F.coalesce(F.sum("b_neg").over(w_all), F.lit(0)).alias("off_neg"),
        F.sum("b_pos").over(Window.partitionBy()).alias("tot_pos"),
        F.sum("b_neg").over(Window.partitionBy()).alias("tot_neg"))
    offsets = offsets.withColumnRenamed("part", "o_part")
    w_in = (Window.partitionBy("part").orderBy(F.desc("p"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = b.select("part", "p", "pos", "neg",
                       F.sum("pos").over(w_in).alias("run_pos"),
                       F.sum("neg").over(w_in).alias("run_neg"))
    j = running.join(F.broadcast(offsets), running["part"] == offsets["o_part"])
    return j.select("part", "p", "pos", "neg",
                    (F.col("run_pos") + F.col("off_pos")).alias("cum_pos"),
                    (F.col("run_neg") + F.col("off_neg")).alias("cum_neg"), "tot_pos", "tot_neg")


def ranking_metrics(cum: DataFrame) -> DataFrame:
    """One row: auc_roc, gini, ks_statistic, average_precision."""
    P, N = F.col("tot_pos").cast("double"), F.col("tot_neg").cast("double")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    agg = cum.agg(
        F.max(F.abs(F.col("cum_pos") / P - F.col("cum_neg") / N)).alias("ks"),
        F.sum(pos * (N - F.col("cum_neg")) + F.lit(0.5) * pos * neg).alias("auc_num"),
        F.sum(pos / P * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("ap"),
        F.first("tot_pos").alias("tot_pos"), F.first("tot_neg").alias("tot_neg"))
    auc = F.col("auc_num") / (F.col("tot_pos").cast("double") * F.col("tot_neg").cast("double"))
    return agg.select(auc.alias("auc_roc"), (F.lit(2.0) * auc - F.lit(1.0)).alias("gini"),
                      F.col("ks").alias("ks_statistic"), F.col("ap").alias("average_precision"))


def prob_bin(p: Column, edges=PROB_EDGES_10, last_closed: bool = True) -> Column:
    """Index of the equal-width bin of ``p``: ``[e_i, e_i+1)``; NULL outside.

    ``last_closed`` puts p == 1.0 in the last bin (histogram rule); without
    it p == 1.0 falls in no bin (calibration rule).
    """
    lo, hi = edges[0], edges[-1]
    inside = (p >= lo) & ((p <= hi) if last_closed else (p < hi))
    out = F.when(~inside | p.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:-1]):
        out = out.when(p < F.lit(e), F.lit(i))
    return out.otherwise(F.lit(len(edges) - 2))


def calibration_curve(df: DataFrame, label: str, prob: str, n_bins: int = 10) -> DataFrame:
    """bin_center, mean_predicted, fraction_positive, count; empty bins left out."""
    edges = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]
    centers = F.array(*[F.lit((a + b) / 2) for a, b in zip(edges[:-1], edges[1:])])
    p = F.col(prob).cast("double")
    binned = df.select(prob_bin(p, edges, last_closed=False).alias("bin"), p.alias("p"),
                       F.col(label).cast("double").alias("y")).where(F.col("bin").isNotNull())
    return (binned.groupBy("bin")
            .agg(F.avg("p").alias("mean_predicted"), F.avg("y").alias("fraction_positive"),
                 F.count(F.lit(1)).alias("count"))
            .select(F.get(centers, F.col("bin")).alias("bin_center"), "mean_predicted",
                    "fraction_positive", "count", "bin"))


def expected_calibration_error(df: DataFrame, label: str, prob: str, n_bins: int = 10) -> DataFrame:
    """Sum over bins of n_b / N * |acc_b - conf_b| (N counts every row)."""
    curve = calibration_curve(df, label, prob, n_bins)
    n_all = df.agg(F.count(F.lit(1))).scalar()
    return (curve.agg(F.sum(F.col("count") * F.abs(F.col("fraction_positive") - F.col("mean_predicted")))
                      .alias("ece_num"))
            .select(F.coalesce(F.col("ece_num") / n_all, F.lit(0.0)).alias("ece")))


def brier_score(df: DataFrame, label: str, prob: str) -> DataFrame:
    """A20."""
    d = F.col(prob).cast("double") - F.col(label).cast("double")
    return df.agg(F.avg(d * d).alias("brier_score"))


def threshold_bucket(p: Column, thresholds=COST_THRESHOLDS) -> Column:
    """Number of thresholds <= p, found by arithmetic plus two exact checks."""
    n = len(thresholds)
    t0, step = thresholds[0], (thresholds[-1] - thresholds[0]) / (n - 1)
    arr = F.array(*[F.lit(t) for t in thresholds])
    j = F.least(F.greatest(F.floor((p - F.lit(t0)) / F.lit(step)), F.lit(-1)), F.lit(n - 1)).cast("int")
    # k = j + 1 if t_j <= p < t_{j+1}; fix the rare off-by-one from rounding.
    tj = F.when(j >= 0, F.get(arr, j))
    tn = F.when(j + 1 <= n - 1, F.get(arr, j + 1))
    k = (j + 1
         - F.when(tj.isNotNull() & (p < tj), 1).otherwise(0)
         + F.when(tn.isNotNull() & (p >= tn), 1).otherwise(0))
    return k


def cost_sweep(df: DataFrame, label: str, prob: str, cost_fn: float = S.COST_FN,
               cost_fp: float = S.COST_FP, thresholds=COST_THRESHOLDS) -> DataFrame:
    """Cost at each threshold: (threshold_idx, threshold, fn, fp, cost). 181 rows."""
    spark = df.sparkSession
    n = len(thresholds)
    p = F.col(prob).cast("double")
    y = F.col(label).cast("long")
    per_k = (df.select(threshold_bucket(p, thresholds).alias("k"), y.alias("y"))
             .groupBy("k").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))
    grid = spark.range(0, n + 1).select(F.col("id").cast("int").alias("k"))
    full = grid.join(F.broadcast(per_k), "k", "left").fillna(0, ["pos", "neg"])
    # n + 2 rows: bounded single-task window.
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy()
    cum = full.select("k", F.sum("pos").over(w).alias("fn"), F.sum("neg").over(w).alias("cum_neg"),
                      F.sum("pos").over(tot).alias("tot_pos"), F.sum("neg").over(tot).alias("tot_neg"))
    arr = F.array(*[F.lit(t) for t in thresholds])
    out = cum.where(F.col("k") < n).select(
        F.col("k").alias("threshold_idx"), F.get(arr, F.col("k")).alias("threshold"),
        F.col("fn"), (F.col("tot_neg") - F.col("cum_neg")).alias("fp"),
        (F.col("tot_pos") - F.col("fn")).alias("tp"), F.col("cum_neg").alias("tn"))
    return out.withColumn("cost", F.col("fn") * F.lit(cost_fn) + F.col("fp") * F.lit(cost_fp))


def optimal_threshold(sweep: DataFrame) -> DataFrame:
    """Least cost, lowest threshold on ties."""
    best = sweep.agg(F.min_by("threshold_idx", F.struct("cost", "threshold_idx")).alias("best"))
    return sweep.join(best, sweep["threshold_idx"] == best["best"]).drop("best")


def confusion_at(df: DataFrame, label: str, pred: Column, cost_fn: float = S.COST_FN,
                 cost_fp: float = S.COST_FP) -> DataFrame:
    """A21 + A22 for a 0/1 prediction column."""
    y = F.col(label).cast("int")
    pr = pred.cast("int")
    agg = df.agg(
        F.sum(F.when((y == 0) & (pr == 0), 1).otherwise(0)).alias("tn"),
        F.sum(F.when((y == 0) & (pr == 1), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((y == 1) & (pr == 0), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((y == 1) & (pr == 1), 1).otherwise(0)).alias("tp"),
        F.count(F.lit(1)).alias("n"))
    return with_cost_and_rates(agg, cost_fn, cost_fp)


def with_cost_and_rates(agg: DataFrame, cost_fn=S.COST_FN, cost_fp=S.COST_FP, keep=()) -> DataFrame:
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    total = fn * F.lit(cost_fn) + fp * F.lit(cost_fp)
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn), F.lit(0.0))
    n = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("double")
    return agg.select(
        *keep, F.col("tn").cast("long").alias("tn"), F.col("fp").cast("long").alias("fp"),
        F.col("fn").cast("long").alias("fn"), F.col("tp").cast("long").alias("tp"),
        total.alias("total_cost"), (total / n).alias("cost_per_decision"),
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def score_statistics(df: DataFrame, prob: str, **score_params) -> DataFrame:
    """A24 on the P5 score of ``prob``."""
    s = probability_to_score(F.col(prob), **score_params).cast("double")
    return df.agg(F.avg(s).alias("score_mean"), F.stddev_pop(s).alias("score_std"),
                  F.min(s).cast("int").alias("score_min"), F.max(s).cast("int").alias("score_max"))


def score_psi(expected: DataFrame, exp_prob: str, actual: DataFrame, act_prob: str,
              n_bins: int = 10, epsilon: float = S.PSI_EPSILON) -> DataFrame:
    """Equal-width bins on [0,1], last closed, shares over all rows, 0 -> epsilon."""
    edges = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]
    e = expected.select(F.lit(1).alias("side"), prob_bin(F.col(exp_prob).cast("double"), edges).alias("bin"))
    a = actual.select(F.lit(2).alias("side"), prob_bin(F.col(act_prob).cast("double"), edges).alias("bin"))
    counts = (e.unionByName(a).groupBy("bin")
              .agg(F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("n_e"),
                   F.sum(F.when(F.col("side") == 2, 1).otherwise(0)).alias("n_a")))
    tot = Window.partitionBy()  # <= n_bins + 1 rows
    shares = counts.select(
        "bin", (F.col("n_e") / F.sum("n_e").over(tot)).alias("e"),
        (F.col("n_a") / F.sum("n_a").over(tot)).alias("a")).where(F.col("bin").isNotNull())
    eps = F.lit(float(epsilon))
    ee = F.when(F.col("e") == 0, eps).otherwise(F.col("e"))
    aa = F.when(F.col("a") == 0, eps).otherwise(F.col("a"))
    return shares.agg(F.coalesce(F.sum((aa - ee) * F.ln(aa / ee)), F.lit(0.0)).alias("psi"))


def evaluation_report(df: DataFrame, label: str, prob: str, train: DataFrame | None = None,
                      train_prob: str | None = None, cost_fn: float = S.COST_FN,
                      cost_fp: float = S.COST_FP) -> DataFrame:
    """Every metric of one model as one row. The pieces are one-row aggregates."""
    rank = ranking_metrics(cumulative_frame(score_frame(df, label, prob)))
    base = df.agg(F.count(F.lit(1)).alias("n_samples"),
                  F.avg(F.col(label).cast("double")).alias("default_rate"),
                  F.avg((F.col(prob) - F.col(label)) * (F.col(prob) - F.col(label))).alias("brier_score"))
    ece = expected_calibration_error(df, label, prob)
    best = optimal_threshold(cost_sweep(df, label, prob, cost_fn, cost_fp)).select(
        F.col("threshold").alias("optimal_threshold"), "tn", "fp", "fn", "tp")
    best = with_cost_and_rates(best, cost_fn, cost_fp, keep=["optimal_threshold"])
    stats = score_statistics(df, prob)
    out = rank.join(base).join(ece).join(best).join(stats)
    if train is not None:
        out = out.join(score_psi(train, train_prob or prob, df, prob))
    else:
        out = out.withColumn("psi", F.lit(-1.0))
    return out


def champion_vs_challenger(df: DataFrame, label: str, champion: str, challenger: str) -> DataFrame:
    """Both probabilities on the same rows; AUC delta and winner."""
    a = ranking_metrics(cumulative_frame(score_frame(df, label, champion))).select(
        F.col("auc_roc").alias("champion_auc"), F.col("ks_statistic").alias("champion_ks"))
    b = ranking_metrics(cumulative_frame(score_frame(df, label, challenger))).select(
        F.col("auc_roc").alias("challenger_auc"), F.col("ks_statistic").alias("challenger_ks"))
    d = F.col("champion_auc") - F.col("challenger_auc")
    return a.join(b).select("*", d.alias("auc_delta"),
                            F.when(d >= 0, "champion").otherwise("challenger").alias("winner"))


def compare_on_id(champ: DataFrame, chall: DataFrame, id_col: str, label: str,
                  champ_prob: str = "champion_prob", chall_prob: str = "challenger_prob") -> DataFrame:
    """J4 when the two models' outputs are separate frames: equi-join on the id."""
    j = champ.select(id_col, label, F.col(champ_prob)).join(chall.select(id_col, F.col(chall_prob)), id_col)
    return champion_vs_challenger(j, label, champ_prob, chall_prob)
