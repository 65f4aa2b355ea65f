"""Explanations as batch jobs.

The scorer is a Column-building function ``feature name -> Column`` ->
probability Column (the expert logit P13 by default), so attribution and
counterfactual search are per-row projections: no explode, no shuffle, no
driver loop. Ranking factors within an application sorts a 10-element array
inside the row instead of a window over the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from .. import schema as S
from ..functions import rules
from ..functions import scorecard as SC
from ..functions.numeric import round_dp
from ..session import cut_lineage

# --- fixed values: counterfactual levers (feature, direction) ---------------------------
MUTABLE_FEATURES = [
    ("debt_to_income", "lower"), ("credit_utilization_ratio", "lower"), ("interest_rate", "lower"),
    ("num_derog_records", "lower"), ("num_credit_inquiries", "lower"), ("annual_income", "higher"),
    ("employment_length_years", "higher"), ("months_since_last_delinq", "higher"),
    ("loan_amount", "lower"), ("revolving_balance", "lower"),
]
LOWER_FACTOR, HIGHER_FACTOR = 0.75, 1.30
MIN_IMPROVEMENT = 0.001
# ------------------------------------------------------------------------------------------

Scorer = Callable[[dict[str, Column]], Column]


def _filled(get, medians: dict[str, float] | None):
    """``get`` with the median in place of a NULL optional field."""
    def out(name: str) -> Column:
        fill = (medians or {}).get(name)
        return get(name) if fill is None else F.coalesce(get(name).cast("double"), F.lit(float(fill)))
    return out


def expert_scorer(cols: dict[str, Column], medians: dict[str, float] | None = None) -> Column:
    """P13 evaluated on substituted feature columns."""
    return rules.risk_probability(_filled(lambda n: cols[n] if n in cols else F.col(n), medians))


expert_scorer.on_arrays, expert_scorer.inputs = rules.risk_on_arrays(), rules.RISK_INPUTS


def imputing_scorer(medians: dict[str, float]) -> Scorer:
    """P13 with the given medians for NULL optional fields: every valid application is decided."""
    def scorer(cols):
        return expert_scorer(cols, medians)
    scorer.on_arrays, scorer.inputs = rules.risk_on_arrays(medians), rules.RISK_INPUTS
    return scorer


# --- X1 / W5 / O3 ---------------------------------------------------------------------------
def attribution_arrays(df: DataFrame, top_n: int = 5, id_col: str = S.ID_COL, keep=(),
                       medians: dict[str, float] | None = None) -> DataFrame:
    """(id, ``keep``, base_value, top: array<struct<k1, feature, impact, value>>) - ranked inside the row.

    ``value`` is the scaled driver that the impact comes from; ``medians`` fill NULL optional fields."""
    terms = rules.risk_terms(_filled(F.col, medians))
    # data means as scalar subqueries (merged into one aggregate by the optimizer)
    mean = {k: df.agg(F.avg(t)).scalar() for k, t in terms.items()}
    j = df
    entries = []
    for k, w in rules.LOGIT_WEIGHTS.items():
        imp = F.lit(w) * (terms[k] - mean[k])
        # key: |impact| descending, then name; NULL impacts sort last
        entries.append(F.struct(F.coalesce(-F.abs(imp), F.lit(float("inf"))).alias("k1"),
                                F.lit(k).alias("feature"), imp.alias("impact"), terms[k].alias("value")))
    base = F.lit(rules.LOGIT_INTERCEPT)
    for k, w in rules.LOGIT_WEIGHTS.items():
        base = base + F.lit(w) * mean[k]
    return j.select(F.col(id_col), *[c for c in keep if c != id_col], base.alias("base_value"),
                    F.slice(F.sort_array(F.array(*entries)), 1, top_n).alias("top"))


def expert_attribution(df: DataFrame, top_n: int = 5, id_col: str = S.ID_COL,
                       medians: dict[str, float] | None = None) -> DataFrame:
    """X1 + W5 + O3: additive effect of each logit driver on the margin, centred on the data
    mean: impact_k = w_k * (term_k - mean_k), so the impacts sum to logit - base_value.
    One row per application and ranked driver (rank <= top_n)."""
    ranked = attribution_arrays(df, top_n, id_col, medians=medians)
    out = (ranked.select(id_col, "base_value", F.posexplode("top").alias("pos", "e"))
           .where(F.col("e.impact").isNotNull()))
    return out.select(id_col, (F.col("pos") + 1).alias("rank"), F.col("e.feature").alias("feature"),
                      F.col("e.impact").alias("impact"),
                      F.when(F.col("e.impact") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"),
                      "base_value")


def linear_attribution(df: DataFrame, coefs: dict[str, float], means: dict[str, float],
                       top_n: int = 5, id_col: str = S.ID_COL) -> DataFrame:
    """X1(a) for a fitted linear scorecard: coef_j * (z_j - mean_j), ranked per row."""
    entries = [F.struct((-F.abs(F.lit(c) * (F.col(f) - F.lit(means[f])))).alias("k1"), F.lit(f).alias("feature"),
                        (F.lit(c) * (F.col(f) - F.lit(means[f]))).alias("impact")) for f, c in coefs.items()]
    ranked = df.select(id_col, F.slice(F.sort_array(F.array(*entries)), 1, top_n).alias("top"))
    out = ranked.select(id_col, F.posexplode("top").alias("pos", "e"))
    return out.select(id_col, (F.col("pos") + 1).alias("rank"), F.col("e.feature").alias("feature"),
                      F.col("e.impact").alias("impact"),
                      F.when(F.col("e.impact") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"))


# --- X3 counterfactual ------------------------------------------------------------------------
def counterfactual(df: DataFrame, scorer: Scorer = expert_scorer, max_changes: int = 4,
                   target: str = "APPROVE", id_col: str = S.ID_COL,
                   threshold_approve: float = S.PROB_APPROVE, threshold_decline: float = S.PROB_DECLINE,
                   materialize: bool = True, keep=()) -> DataFrame:
    """Greedy recourse: up to ``max_changes`` rounds, each trying every unchanged lever.

    Each round is one projection: the ten candidate probabilities are columns,
    the best is the max of (delta, -lever index) structs (largest drop, first
    lever on ties). Rows already at the target are not searched; rows whose best
    drop is below 0.001 keep their values. ``change_values`` lists the changes in the
    order made: feature, direction, current value (NULL counts as 0) and suggested value.
    ``keep``: columns of ``df`` carried along.

    The result is checkpointed (``materialize``): a filter pushed through the
    rounds would inline every earlier round into its condition.
    """
    feats = [f for f, _ in MUTABLE_FEATURES]
    cur = {f: F.col(f).cast("double") for f in feats}
    state = df.select(*df.columns, *[cur[f].alias(f"cf_{f}") for f in feats],
                      F.lit(False).alias("done"), F.array().cast("array<string>").alias("changes"))

    def cols_now(over=None):
        m = {c: F.col(c) for c in df.columns}
        m.update({f: F.col(f"cf_{f}") for f in feats})
        if over:
            m.update(over)
        return m

    def decision(p):
        return SC.probability_to_decision(p, threshold_approve, threshold_decline)

    p0 = scorer(cols_now())
    state = state.withColumn("p_start", p0).withColumn("p_cur", F.col("p_start"))
    state = state.withColumn("done", F.coalesce(decision(F.col("p_cur")) == target, F.lit(False)))
    for _ in range(max_changes):
        cands = []
        for i, (f, direction) in enumerate(MUTABLE_FEATURES):
            factor = LOWER_FACTOR if direction == "lower" else HIGHER_FACTOR
            val = F.coalesce(F.col(f"cf_{f}"), F.lit(0.0)) * F.lit(factor)
            p_new = scorer(cols_now({f: val}))
            # deltas equal to 1e-12 are ties (engines differ in the last bits of ln/exp)
            delta = F.round((F.col("p_cur") - p_new) * F.lit(1e12), 0) / F.lit(1e12)
            ok = ~F.col("done") & ~F.array_contains(F.col("changes"), F.lit(f)) & (delta > 0)
            cands.append(F.when(ok, F.struct(delta.alias("delta"), F.lit(-i).alias("neg_i"),
                                             F.lit(f).alias("feature"), val.alias("value"))))
        best = F.greatest(*cands)  # NULLs skipped; codegen'd (no lambda)
        state = state.select("*", best.alias("_best"))
        go = (~F.col("done")) & F.col("_best").isNotNull() & (F.col("_best.delta") >= MIN_IMPROVEMENT)
        moved = [f"cf_{f}" for f in feats] + ["changes"]
        state = state.select(
            *[c for c in state.columns if c not in moved],
            *[F.when(go & (F.col("_best.feature") == f), F.col("_best.value")).otherwise(F.col(f"cf_{f}"))
              .alias(f"cf_{f}") for f in feats],
            F.when(go, F.array_append("changes", F.col("_best.feature"))).otherwise(F.col("changes")).alias("changes"),
            go.alias("_go"))
        p_new = F.when(F.col("_go"), scorer(cols_now())).otherwise(F.col("p_cur"))
        rest = [c for c in state.columns if c not in ("p_cur", "done", "_best", "_go")]
        state = state.select(*rest, p_new.alias("p_cur"),
                             (F.col("done") | ~F.col("_go") |
                              F.coalesce(decision(p_new) == target, F.lit(False))).alias("done"))
    # one entry per lever, NULL where it was not moved; sorting by the step puts NULLs last
    step = {f: F.array_position("changes", F.lit(f)) for f in feats}
    moved_by = F.array(*[F.when(step[f] > 0, F.struct(
        step[f].cast("int").alias("step"), F.lit(f).alias("feature"), F.lit(direction).alias("direction"),
        round_dp(F.coalesce(cur[f], F.lit(0.0)), 4).alias("current_value"),
        round_dp(F.col(f"cf_{f}"), 4).alias("suggested_value"))) for f, direction in MUTABLE_FEATURES])
    out = state.select(
        id_col, *[c for c in keep if c != id_col], F.sort_array(F.array_compact(moved_by)).alias("change_values"),
        round_dp(F.col("p_start"), 4).alias("start_probability"),
        decision(F.col("p_start")).alias("decision"),
        F.size("changes").alias("n_changes"), F.array_join("changes", ";").alias("changed_features"),
        round_dp(F.col("p_cur"), 4).alias("counterfactual_probability"),
        decision(F.col("p_cur")).alias("counterfactual_decision"),
        (F.coalesce(decision(F.col("p_cur")) == target, F.lit(False))).alias("achievable"))
    return cut_lineage(out) if materialize else out


# --- X4 -----------------------------------------------------------------------------------------
def explanation_table(df: DataFrame, top_n: int = 5, id_col: str = S.ID_COL,
                      medians: dict[str, float] | None = None) -> DataFrame:
    """Decision, base value, top attributions and counterfactual per application, in one projection.

    The local surrogate has a row per factor and a table of its own (``local_surrogate``)."""
    score = imputing_scorer(medians or {})
    wide = attribution_arrays(df, top_n, id_col, keep=df.columns, medians=medians)
    wide = wide.withColumn("default_probability", round_dp(score({}), 6)).withColumnRenamed("top", "top_factors")
    return counterfactual(wide, score, id_col=id_col, keep=["default_probability", "base_value", "top_factors"])


# --- the same for a fitted scorecard (plans.scorecard) -----------------------------------------
def scorecard_arrays(df: DataFrame, model, top_n: int = 5, id_col: str = S.ID_COL, keep=()) -> DataFrame:
    """X1 + W5 + O3 of a fitted scorecard: (id, ``keep``, base_value, top: array<struct<k1, feature, impact>>).

    An impact is coefficient x (value - training mean), averaged over the folds; all of them sum to the
    mean logit minus ``base_value``."""
    looks = [(keys, points[:, 0].copy(), points) for keys, points in model.looked_up()]
    for _, total, points in looks:       # a place's impact, its points added in the order of the folds
        for g in range(1, model.folds):
            total += points[:, g]
        total /= model.folds
    order = sorted(range(len(looks)), key=lambda j: model.features[j])
    names = pa.array([model.features[j] for j in order])
    place, n_top = model.placing(), min(top_n, len(looks))

    def ranked(*values: pa.Array) -> pa.Array:
        impact = np.stack([looks[j][1][place(values[j], looks[j][0])] for j in order], axis=1)
        best = np.argsort(-np.abs(impact), axis=1, kind="stable")[:, :n_top]     # ties by name
        chosen = np.take_along_axis(impact, best, axis=1).ravel()
        each = pa.StructArray.from_arrays([pa.array(-np.abs(chosen)), names.take(pa.array(best.ravel())), pa.array(chosen)],
                                          names=["k1", "feature", "impact"])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, chosen.size + 1, n_top, dtype=np.int32)), each)
    top = arrow_udf(ranked, "array<struct<k1:double,feature:string,impact:double>>")(*model.inputs())
    return df.select(F.col(id_col), *[c for c in keep if c != id_col], F.lit(model.base_value).alias("base_value"), top.alias("top"))


def scorecard_attribution(df: DataFrame, model, top_n: int = 5, id_col: str = S.ID_COL) -> DataFrame:
    """One row per application and ranked feature of a fitted scorecard."""
    out = scorecard_arrays(df, model, top_n, id_col).select(id_col, "base_value", F.posexplode("top").alias("pos", "e"))
    return out.select(id_col, (F.col("pos") + 1).alias("rank"), F.col("e.feature").alias("feature"),
                      F.col("e.impact").alias("impact"),
                      F.when(F.col("e.impact") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"),
                      "base_value")


def scorecard_counterfactual(df: DataFrame, model, max_changes: int = 4, target: str = "APPROVE",
                             id_col: str = S.ID_COL, threshold_approve: float = S.PROB_APPROVE,
                             threshold_decline: float = S.PROB_DECLINE, materialize: bool = True, keep=()) -> DataFrame:
    """X3 of a fitted scorecard: the rounds of ``counterfactual``, on the folds' logits.

    A lever changes the points of its own feature and of those derived from it, so a candidate costs
    those points and a sum, however many features the model has; rows that are done cost no candidates.
    Columns and ties as there."""
    feats = [f for f, _ in MUTABLE_FEATURES]
    touched = {f: [d for d in [f, *S.DERIVED_FEATURES] if d in model.features
                   and (d == f or (d in S.DERIVED_FEATURES and f in rules.derived_inputs(d)))] for f in feats}
    pts = sorted({d for ds in touched.values() for d in ds})

    def decision(p):
        return SC.probability_to_decision(p, threshold_approve, threshold_decline)

    def probability(logits: str) -> Column:
        return model.calibrated_array(F.col(logits))

    def met(p):
        return F.coalesce(decision(p) == target, F.lit(False))
    state = model.with_points(df, {f"pt_{d}": (d, model.value(d, F.col)) for d in model.features})
    state = state.select(*df.columns, *[F.col(f).cast("double").alias(f"cf_{f}") for f in feats],
                         F.array(*model.sums(lambda c, g: F.col(f"pt_{c}")[g])).alias("_lg"), *[f"pt_{d}" for d in pts],
                         F.array().cast("array<string>").alias("changes"))
    state = state.withColumn("p_start", probability("_lg")).withColumn("p_cur", F.col("p_start"))
    state = state.withColumn("done", met(F.col("p_cur")))
    fixed = state.columns
    for _ in range(max_changes):
        value = {f: F.coalesce(F.col(f"cf_{f}"), F.lit(0.0)) * F.lit(LOWER_FACTOR if d == "lower" else HIGHER_FACTOR)
                 for f, d in MUTABLE_FEATURES}

        def over(f, value=value):
            return lambda n: value[f] if n == f else F.col(f"cf_{n}" if n in feats else n)
        state = model.with_points(state, {f"n{i}_{d}": (d, model.value(d, over(f)))
                                          for i, f in enumerate(feats) for d in touched[f]})

        def moved(i, f):
            change = None
            for d in touched[f]:
                step = F.zip_with(f"n{i}_{d}", f"pt_{d}", lambda new, old: new - old)
                change = step if change is None else F.zip_with(change, step, lambda x, y: x + y)
            logits = F.col("_lg") if change is None else F.zip_with("_lg", change, lambda z, x: z + x)
            return F.when(~F.col("done") & ~F.array_contains("changes", F.lit(f)), logits)  # others are not searched
        state = state.select("*", *[moved(i, f).alias(f"l{i}") for i, f in enumerate(feats)])
        state = state.select("*", *[F.when(F.col(f"l{i}").isNotNull(), F.round((F.col("p_cur") - probability(f"l{i}")) * F.lit(1e12), 0)
                                           / F.lit(1e12)).alias(f"d{i}") for i in range(len(feats))])
        cands = []
        for i, f in enumerate(feats):
            ok = ~F.col("done") & ~F.array_contains("changes", F.lit(f)) & (F.col(f"d{i}") > 0)
            cands.append(F.when(ok, F.struct(F.col(f"d{i}").alias("delta"), F.lit(-i).alias("neg_i"))))
        state = state.select("*", F.greatest(*cands).alias("_best"))
        state = state.select("*", (~F.col("done") & F.col("_best").isNotNull() & (F.col("_best.delta") >= MIN_IMPROVEMENT)).alias("_go"))

        def picked(old, arms):
            out = None
            for i, new in arms:
                hit = F.col("_go") & (F.col("_best.neg_i") == -i)
                out = F.when(hit, new) if out is None else out.when(hit, new)
            return (F.col(old) if out is None else out.otherwise(F.col(old))).alias(old)
        changed = {"_lg": picked("_lg", [(i, F.col(f"l{i}")) for i in range(len(feats))]),
                   "changes": picked("changes", [(i, F.array_append("changes", F.lit(f))) for i, f in enumerate(feats)])}
        changed |= {f"cf_{f}": picked(f"cf_{f}", [(i, value[f])]) for i, f in enumerate(feats)}
        changed |= {f"pt_{d}": picked(f"pt_{d}", [(i, F.col(f"n{i}_{d}")) for i, f in enumerate(feats) if d in touched[f]])
                    for d in pts}
        state = state.select(*[changed.get(c, F.col(c)) for c in fixed], "_go")
        p_new = F.when(F.col("_go"), probability("_lg")).otherwise(F.col("p_cur"))
        state = state.select(*[c for c in fixed if c not in ("p_cur", "done")], p_new.alias("p_cur"),
                             (F.col("done") | ~F.col("_go") | met(p_new)).alias("done")).select(*fixed)
    step = {f: F.array_position("changes", F.lit(f)) for f in feats}
    moved_by = F.array(*[F.when(step[f] > 0, F.struct(
        step[f].cast("int").alias("step"), F.lit(f).alias("feature"), F.lit(direction).alias("direction"),
        round_dp(F.coalesce(F.col(f).cast("double"), F.lit(0.0)), 4).alias("current_value"),
        round_dp(F.col(f"cf_{f}"), 4).alias("suggested_value"))) for f, direction in MUTABLE_FEATURES])
    out = state.select(
        id_col, *[c for c in keep if c != id_col], F.sort_array(F.array_compact(moved_by)).alias("change_values"),
        round_dp(F.col("p_start"), 4).alias("start_probability"), decision(F.col("p_start")).alias("decision"),
        F.size("changes").alias("n_changes"), F.array_join("changes", ";").alias("changed_features"),
        round_dp(F.col("p_cur"), 4).alias("counterfactual_probability"),
        decision(F.col("p_cur")).alias("counterfactual_decision"), met(F.col("p_cur")).alias("achievable"))
    return cut_lineage(out) if materialize else out


def scorecard_explanation_table(df: DataFrame, model, top_n: int = 5, id_col: str = S.ID_COL) -> DataFrame:
    """X4 of a fitted scorecard: decision, base value, top factors and counterfactual per application."""
    wide = scorecard_arrays(df, model, top_n, id_col, keep=df.columns).withColumnRenamed("top", "top_factors")
    wide = model.transform(wide).withColumn("default_probability", round_dp("probability_default", 6))
    return scorecard_counterfactual(wide, model, id_col=id_col, keep=["default_probability", "base_value", "top_factors"])


# --- DuckDB twins ----------------------------------------------------------------------------
def sql_attribution(src: str, top_n: int = 5, id_col: str = S.ID_COL, optional=()) -> list[str]:
    """CTEs ending in ``attr`` (id, rank, feature, impact, direction, base_value); NULLs of the
    ``optional`` fields count as their median."""
    terms = rules.sql_risk_terms({c: f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {src}))" for c in optional})
    t_sel = ", ".join(f"{e} AS t_{k}" for k, e in terms.items())
    means = ", ".join(f"avg(t_{k}) AS m_{k}" for k in terms)
    base = f"{rules.LOGIT_INTERCEPT!r}" + "".join(f" + {w!r} * m_{k}" for k, w in rules.LOGIT_WEIGHTS.items())
    unions = " UNION ALL ".join(
        f"SELECT {id_col}, '{k}' AS feature, {w!r} * (t_{k} - m_{k}) AS impact, base_value FROM at_j"
        for k, w in rules.LOGIT_WEIGHTS.items())
    return [
        f"at_t AS (SELECT {id_col}, {t_sel} FROM {src})",
        f"at_m AS (SELECT {means} FROM at_t)",
        f"at_j AS (SELECT at_t.*, at_m.*, {base} AS base_value FROM at_t, at_m)",
        f"at_l AS (SELECT * FROM ({unions}) WHERE impact IS NOT NULL)",
        f"attr AS (SELECT {id_col}, CAST(row_number() OVER (PARTITION BY {id_col} ORDER BY abs(impact) DESC, feature) AS INTEGER) AS rank, "
        "feature, impact, CASE WHEN impact > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction, base_value "
        f"FROM at_l QUALIFY rank <= {top_n})",
    ]


def sql_counterfactual(src: str, max_changes: int = 4, target: str = "APPROVE",
                       id_col: str = S.ID_COL, optional=()) -> list[str]:
    """CTEs ending in ``cf_out`` and ``cf_changes``: the same greedy rounds as chained per-row projections."""
    feats = [f for f, _ in MUTABLE_FEATURES]
    fill = [f for f in feats if f in optional]
    cur = {f: f"coalesce(cf_{f}, m_{f})" if f in fill else f"cf_{f}" for f in feats}
    fixed = [id_col, "grade"] + [f"o_{f}" for f in feats] + [f"m_{f}" for f in fill]
    fix = ", ".join(fixed)

    def dec(p):
        return SC.sql_prob_decision(p)

    p0 = rules.sql_risk_probability(cur)
    ctes = ["cf_m AS (SELECT count(*) AS m_n" + "".join(f", quantile_cont({f}, 0.5) AS m_{f}" for f in fill)
            + f" FROM {src})",
            f"cf0 AS (SELECT *, {p0} AS p_start, {p0} AS p_cur, coalesce({dec(p0)} = '{target}', false) AS done "
            f"FROM (SELECT {id_col}, grade, " + ", ".join(f"CAST({f} AS DOUBLE) AS cf_{f}" for f in feats)
            + "".join(f", CAST({f} AS DOUBLE) AS o_{f}" for f in feats)
            + f", cf_m.*, CAST([] AS VARCHAR[]) AS changes FROM {src}, cf_m))"]
    carry = fixed + [f"cf_{f}" for f in feats] + ["changes", "p_start", "p_cur", "done"]
    prev = "cf0"
    for r in range(1, max_changes + 1):
        ds = []
        for i, (f, direction) in enumerate(MUTABLE_FEATURES):
            factor = LOWER_FACTOR if direction == "lower" else HIGHER_FACTOR
            val = f"(coalesce(cf_{f}, 0.0) * {factor!r})"
            pn = rules.sql_risk_probability({**cur, f: val})
            dl = f"(round((p_cur - {pn}) * 1e12) / 1e12)"
            ds.append(f"CASE WHEN NOT list_contains(changes, '{f}') AND {dl} > 0 THEN {dl} END AS d{i}")
        ctes.append(f"cf{r}a AS (SELECT {', '.join(carry)}, {', '.join(ds)} FROM {prev})")
        best = "greatest(" + ", ".join(f"d{i}" for i in range(len(feats))) + ")"
        bi = "CASE " + " ".join(f"WHEN d{i} = bd THEN {i}" for i in range(len(feats))) + " END"
        ctes.append(f"cf{r}b AS (SELECT *, {bi} AS bi, (NOT done AND bd IS NOT NULL AND bd >= {MIN_IMPROVEMENT!r}) AS go "
                    f"FROM (SELECT *, {best} AS bd FROM cf{r}a))")
        upd = []
        for i, (f, direction) in enumerate(MUTABLE_FEATURES):
            factor = LOWER_FACTOR if direction == "lower" else HIGHER_FACTOR
            upd.append(f"CASE WHEN go AND bi = {i} THEN coalesce(cf_{f}, 0.0) * {factor!r} ELSE cf_{f} END AS cf_{f}")
        names = "[" + ", ".join(f"'{f}'" for f in feats) + "]"
        ctes.append(f"cf{r}c AS (SELECT {fix}, {', '.join(upd)}, "
                    f"CASE WHEN go THEN list_append(changes, {names}[bi + 1]) ELSE changes END AS changes, "
                    f"p_start, p_cur, done, go FROM cf{r}b)")
        pn = rules.sql_risk_probability(cur)
        ctes.append(f"cf{r} AS (SELECT {fix}, " + ", ".join(f"cf_{f}" for f in feats)
                    + f", changes, p_start, CASE WHEN go THEN {pn} ELSE p_cur END AS p_cur, "
                    f"done OR NOT go OR coalesce({dec(f'(CASE WHEN go THEN {pn} ELSE p_cur END)')} = '{target}', false) AS done "
                    f"FROM cf{r}c)")
        prev = f"cf{r}"
    ctes.append(f"cf_out AS (SELECT {id_col}, round(p_start * 10000.0) / 10000.0 AS start_probability, "
                f"{dec('p_start')} AS decision, CAST(len(changes) AS INTEGER) AS n_changes, "
                "array_to_string(changes, ';') AS changed_features, "
                "round(p_cur * 10000.0) / 10000.0 AS counterfactual_probability, "
                f"{dec('p_cur')} AS counterfactual_decision, coalesce({dec('p_cur')} = '{target}', false) AS achievable "
                f"FROM {prev})")

    def of_change(what):
        return "CASE changes[step] " + " ".join(f"WHEN '{f}' THEN {what(f, d)}" for f, d in MUTABLE_FEATURES) + " END"
    ctes.append(f"cf_changes AS (SELECT {id_col}, CAST(step AS INTEGER) AS step, changes[step] AS feature, "
                + of_change(lambda f, d: f"'{d}'") + " AS direction, round("
                + of_change(lambda f, d: f"coalesce(o_{f}, 0.0)") + " * 10000.0) / 10000.0 AS current_value, round("
                + of_change(lambda f, d: f"cf_{f}") + " * 10000.0) / 10000.0 AS suggested_value "
                f"FROM {prev}, range(1, {max_changes + 1}) r(step) WHERE step <= len(changes))")
    return ctes


# --- X2 local surrogate ------------------------------------------------------------------------
# fixed values: the continuous drivers perturbed by the surrogate
SURROGATE_FEATURES = ["debt_to_income", "credit_utilization_ratio", "interest_rate", "num_derog_records",
                      "num_credit_inquiries", "annual_income", "employment_length_years",
                      "months_since_last_delinq"]


def _gaussian(id_col: str, s: Column, j: int, seed: int) -> Column:
    """Standard normal from two hashed uniforms (Box-Muller); reproducible per (row, sample, feature)."""
    def uni(tag):
        h = F.pmod(F.xxhash64(F.col(id_col), s, F.lit(j), F.lit(seed), F.lit(tag)), F.lit(1 << 52))
        return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.sqrt(F.lit(-2.0) * F.ln(uni(1))) * F.cos(F.lit(2 * 3.141592653589793) * uni(2))


def _sums_by_columns(df: DataFrame, scorer: Scorer, feats: list[str], at: dict[str, Column], sd: dict[str, Column],
                     n_samples: int, width: float, seed: int, id_col: str) -> DataFrame:
    """Normal equations (id, A, b) with a row per sample: for scorers that have no array form."""
    k = len(feats)
    ex = df.select("*", *[at[f].alias(f"at_{f}") for f in feats], *[sd[f].alias(f"sd_{f}") for f in feats],
                   F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("_s"))
    z = {f: F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(_gaussian(id_col, F.col("_s"), j, seed))
         for j, f in enumerate(feats)}
    x_new = {f: F.col(f"at_{f}") + z[f] * F.col(f"sd_{f}") for f in feats}
    samples = ex.select(id_col, *[z[f].alias(f"z_{f}") for f in feats],
                        scorer({**{c: F.col(c) for c in df.columns}, **x_new}).alias("_y"))
    d2 = None
    for f in feats:
        t = F.col(f"z_{f}") * F.col(f"z_{f}")
        d2 = t if d2 is None else d2 + t
    samples = samples.withColumn("_w", F.sqrt(F.exp(-d2 / F.lit(width * width))))
    xs = [F.lit(1.0)] + [F.col(f"z_{f}") for f in feats]
    a_terms = [F.sum(F.col("_w") * xs[i] * xs[j]) for i in range(k + 1) for j in range(i, k + 1)]
    b_terms = [F.sum(F.col("_w") * xs[i] * F.col("_y")) for i in range(k + 1)]
    return samples.groupBy(id_col).agg(F.array(*a_terms).alias("A"), F.array(*b_terms).alias("b"))


def _sums_in_batches(df: DataFrame, scorer: Scorer, feats: list[str], at: dict[str, Column], sd: dict[str, Column],
                     n_samples: int, width: float, seed: int, id_col: str) -> DataFrame:
    """The same (id, A, b) from Arrow batches: a task draws, scores and sums the samples of a few rows
    at a time in NumPy, so no row per sample exists. The draws are those of ``_gaussian``."""
    k = len(feats)
    score = scorer.on_arrays
    given = [c for c in scorer.inputs if c not in feats]
    # a row costs n_samples scores, so few rows make a long task: dealt over all cores whatever their bytes
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    rows = (df.select(F.col(id_col), F.xxhash64(id_col).alias("_h"), *[F.col(f) for f in feats], *given)
            .repartition(tasks)
            .select(id_col, "_h", *[at[f].alias(f"at_{f}") for f in feats], *[sd[f].alias(f"sd_{f}") for f in feats],
                    *given))
    iu, ju = np.triu_indices(k + 1)
    names = [f"A{i}" for i in range(len(iu))] + [f"b{i}" for i in range(k + 1)]
    step = max(1, 1024 // n_samples)  # the arrays of a step stay in a core's own cache

    def sums(batches):
        p1, p2, p3, p5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x27D4EB2F165667C5))
        first = np.uint64((int(p5) + 4) % (1 << 64))
        # rotation and shifts of Spark's xxhash64
        s23, s41, s33, s29, s32 = (np.uint64(v) for v in (23, 41, 33, 29, 32))

        def word(ints):
            return (np.asarray(ints, dtype=np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)) * p1

        def xxhash(h, w):
            """xxhash64 of an int after the hash ``h``; ``w`` is the int's word."""
            h = (h + first) ^ w
            t = h << s23
            h >>= s41
            h |= t
            h *= p2
            h += p3
            for shift, prime in ((s33, p2), (s29, p3), (s32, None)):
                np.right_shift(h, shift, out=t)
                h ^= t
                if prime is not None:
                    h *= prime
            return h

        def uniform(h):
            h &= np.uint64((1 << 52) - 1)
            u = h.astype(np.float64)
            u += 0.5
            u *= 2.0 ** -52
            return u

        w_sample, w_feature = word(range(n_samples)), word(range(k))[:, None]
        w_seed, w_one, w_two = word([seed]), word([1]), word([2])

        def gaussians(h):
            """z[row, feature, sample]; sample 0 is the row itself."""
            h = xxhash(xxhash(xxhash(h[:, None], w_sample)[:, None, :], w_feature), w_seed)
            r = np.log(uniform(xxhash(h, w_one)))
            r *= -2.0
            np.sqrt(r, out=r)
            a = uniform(xxhash(h, w_two))
            a *= 2 * 3.141592653589793
            r *= np.cos(a, out=a)
            r[:, :, 0] = 0.0
            return r

        def numbers(column):
            """Values with NaN for NULL, and where a value (not NULL) is NaN."""
            v = column.to_numpy(zero_copy_only=False).astype(np.float64)
            return v, np.isnan(v) & ~column.is_null().to_numpy(zero_copy_only=False)

        for batch in batches:
            n = batch.num_rows
            nan = np.zeros(n, dtype=bool)
            centre, spread, other = np.empty((n, k)), np.empty((n, k)), {}
            for j, f in enumerate(feats):
                for into, name in ((centre, f"at_{f}"), (spread, f"sd_{f}")):
                    into[:, j], bad = numbers(batch.column(name))
                    nan |= bad
            for c in given:
                if pa.types.is_string(batch.column(c).type) or pa.types.is_large_string(batch.column(c).type):
                    other[c] = batch.column(c).to_numpy(zero_copy_only=False)
                else:
                    other[c], bad = numbers(batch.column(c))
                    nan |= bad
            h = batch.column("_h").to_numpy(zero_copy_only=False).view(np.uint64)
            a, b, scored = np.empty((n, len(iu))), np.empty((n, k + 1)), np.empty(n, dtype=bool)
            for lo in range(0, n, step):
                part = slice(lo, lo + step)
                z = gaussians(h[part])
                x = centre[part, :, None] + z * spread[part, :, None]
                drawn = {f: x[:, j] for j, f in enumerate(feats)}
                with np.errstate(all="ignore"):
                    y = score(lambda c: drawn[c] if c in drawn else other[c][part][:, None])
                wt = np.sqrt(np.exp(-(z * z).sum(axis=1) / (width * width)))
                xs = np.empty((len(z), k + 1, n_samples))
                xs[:, 0], xs[:, 1:] = 1.0, z
                a[part] = (xs * wt[:, None, :] @ xs.transpose(0, 2, 1))[:, iu, ju]
                known = ~np.isnan(y)
                scored[part] = known.any(axis=1)
                b[part] = (xs @ np.where(known, wt * y, 0.0)[:, :, None])[:, :, 0]
            b[nan] = np.nan
            empty = ~scored & ~nan
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col)] + [pa.array(a[:, i]) for i in range(len(iu))]
                + [pa.array(b[:, i], mask=empty) for i in range(k + 1)], names=[id_col, *names])

    out = rows.mapInArrow(sums, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, "
                          + ", ".join(f"{c} double" for c in names))
    total = {c: F.sum(c) for c in names}
    return out.groupBy(id_col).agg(F.array(*[total[c] for c in names[:len(iu)]]).alias("A"),
                                   F.array(*[total[c] for c in names[len(iu):]]).alias("b"))


def local_surrogate(df: DataFrame, scorer: Scorer = expert_scorer, features=None, n_samples: int = 500,
                    top_n: int = 8, alpha: float = 1.0, seed: int = S.SEED, id_col: str = S.ID_COL) -> DataFrame:
    """Distance-weighted ridge fit of the score around each application, top ``top_n`` weights.

    Samples are drawn, scored and reduced to the weighted normal equations inside the
    task that holds the row - in Arrow batches if the scorer has an array form
    (``on_arrays``), else as exploded rows - so only one row per application crosses
    the shuffle. The (k+1)x(k+1) systems are solved in Arrow batches by a pandas UDF.
    """
    feats = list(features or SURROGATE_FEATURES)
    k = len(feats)
    width = 0.75 * (k ** 0.5)
    mu = {f: df.agg(F.avg(F.col(f).cast("double"))).scalar() for f in feats}
    sdev = {f: df.agg(F.stddev_pop(F.col(f).cast("double"))).scalar() for f in feats}
    at = {f: F.coalesce(F.col(f).cast("double"), mu[f]) for f in feats}
    sd = {f: F.when(sdev[f] > 0, sdev[f]).otherwise(F.lit(1.0)) for f in feats}
    batches = hasattr(scorer, "on_arrays") and -(1 << 31) <= seed < 1 << 31
    sums = (_sums_in_batches if batches else _sums_by_columns)(df, scorer, feats, at, sd, n_samples, width, seed,
                                                              id_col)

    iu = np.triu_indices(k + 1)

    @pandas_udf("array<double>")
    def solve(a: pd.Series, b: pd.Series) -> pd.Series:
        n = len(a)
        mats = np.zeros((n, k + 1, k + 1))
        av = np.stack(a.to_numpy())
        mats[:, iu[0], iu[1]] = av
        mats[:, iu[1], iu[0]] = av
        reg = np.eye(k + 1) * alpha
        reg[0, 0] = 0.0  # the intercept is not penalised
        beta = np.linalg.solve(mats + reg, np.stack(b.to_numpy())[..., None])[..., 0]
        return pd.Series(list(beta[:, 1:]))

    coefs = sums.select(id_col, solve("A", "b").alias("beta"))
    entries = F.array(*[F.struct((-F.abs(F.col("beta")[j])).alias("k1"), F.lit(f).alias("feature"),
                                 F.col("beta")[j].alias("weight")) for j, f in enumerate(feats)])
    top = coefs.select(id_col, F.slice(F.sort_array(entries), 1, top_n).alias("top"))
    out = top.select(id_col, F.posexplode("top").alias("pos", "e"))
    return out.select(id_col, (F.col("pos") + 1).alias("rank"), F.col("e.feature").alias("feature"),
                      round_dp(F.col("e.weight"), 4).alias("weight"))


# --- X1(b) tree-ensemble attribution -------------------------------------------------------------
def tree_tables(gbt_model, spark) -> dict:
    """Node arrays of a fitted MLlib tree ensemble, read from its saved model data.

    Bounded by the model (trees x nodes), never by the data; saved under the
    shared checkpoint folder so every executor can be handed the same arrays.
    """
    import uuid

    from ..session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/attr-{uuid.uuid4().hex[:12]}"
    gbt_model.write().overwrite().save(path)
    rows = (spark.read.parquet(f"{path}/data")
            .select("treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("pred"),
                    F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
                    F.col("nodeData.split.featureIndex").alias("feat"),
                    F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("thr")).collect())
    weights = [float(r[2]) for r in spark.read.parquet(f"{path}/treesMetadata").orderBy("_1").collect()]
    n_trees = len(weights)
    n_nodes = max(r["id"] for r in rows) + 1
    pred = np.zeros((n_trees, n_nodes))
    left = -np.ones((n_trees, n_nodes), dtype=np.int64)
    right = -np.ones((n_trees, n_nodes), dtype=np.int64)
    feat = np.zeros((n_trees, n_nodes), dtype=np.int64)
    thr = np.zeros((n_trees, n_nodes))
    for r in rows:
        t, i = r["treeID"], r["id"]
        pred[t, i] = r["pred"]
        left[t, i], right[t, i] = r["left"], r["right"]
        if r["left"] >= 0:
            feat[t, i], thr[t, i] = r["feat"], r["thr"]
    return {"pred": pred, "left": left, "right": right, "feat": feat, "thr": thr,
            "weights": np.array(weights)}


def _paths(t: dict, k: int) -> list[tuple]:
    """Look-up tables of every tree: depth, children, feature and threshold of a node, weighted value
    of a node, and the credit of each feature the tree uses on the path from the root to a node.

    A leaf leads to itself. A row then costs a look-up per level, and one per used feature and tree.
    """
    trees = []
    for pred, left, right, feat, thr, w in zip(*(t[c] for c in ("pred", "left", "right", "feat", "thr", "weights"))):
        credit, kids, used = np.zeros((k, len(pred))), np.repeat(np.arange(len(pred)), 2), set()
        level, depth = [0], 0
        while level := [i for i in level if left[i] >= 0]:
            for i in level:
                used.add(int(feat[i]))
                for j, child in enumerate((right[i], left[i])):
                    kids[2 * i + j] = child
                    credit[:, child] = credit[:, i]
                    credit[feat[i], child] += (pred[child] - pred[i]) * w
            level, depth = [child for i in level for child in (left[i], right[i])], depth + 1
        trees.append((depth, kids, feat.astype(np.intp), thr, w * pred, [(f, credit[f]) for f in sorted(used)]))
    return trees


def tree_attribution(df: DataFrame, gbt_model, features_col: str, feature_names: list[str],
                     top_n: int = 5, id_col: str = S.ID_COL) -> DataFrame:
    """Path attribution on the ensemble margin: each split on a row's path credits its
    feature with the change of node value (times the tree weight). Additive:
    base_value + sum of impacts = margin (= rawPrediction[1]).

    The node arrays are broadcast (model-sized); rows are attributed and ranked in Arrow
    batches with numpy, so only the ``top_n`` entries of a row come back.
    """
    from pyspark.ml.functions import vector_to_array
    spark = df.sparkSession
    t, k = tree_tables(gbt_model, spark), len(feature_names)
    base = float((t["weights"] * t["pred"][:, 0]).sum())
    bc = spark.sparkContext.broadcast(_paths(t, k))
    by_name = np.argsort(np.array(feature_names, dtype=object), kind="stable")  # equal impacts rank by name
    labels = [feature_names[j] for j in by_name]
    step = 2048  # the arrays of a step stay in a core's own cache

    def attribute(batches):
        trees, names = bc.value, pa.array(labels, pa.string())
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, k)
            impacts, margin = np.zeros((k, n)), np.zeros(n)
            for lo in range(0, n, step):
                part = np.ascontiguousarray(x[lo:lo + step].T)
                rows, flat = np.arange(part.shape[1]), part.ravel()
                into, total = impacts[:, lo:lo + step], margin[lo:lo + step]
                for depth, kids, feat, thr, value, credits in trees:
                    node = np.zeros(len(rows), dtype=np.intp)
                    for _ in range(depth):
                        at = feat.take(node)
                        at *= len(rows)
                        at += rows
                        go_left = flat.take(at) <= thr.take(node)
                        node *= 2
                        node += go_left
                        node = kids.take(node)
                    for f, credit in credits:
                        into[f] += credit.take(node)
                    total += value.take(node)
            found = impacts[by_name].T
            order = np.argsort(-np.abs(found), axis=1, kind="stable")[:, :top_n]
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * order.shape[1])
            tops = pa.StructArray.from_arrays(
                [names.take(pa.array(order.ravel())), pa.array(np.take_along_axis(found, order, 1).ravel())],
                names=["feature", "impact"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.full(n, base)), pa.array(margin), pa.ListArray.from_arrays(ends, tops)],
                names=["id", "base_value", "margin", "top"])

    x = df.select(F.col(id_col).cast("string").alias("id"), vector_to_array(features_col).alias("x"))
    out = x.mapInArrow(attribute, "id string, base_value double, margin double, "
                                  "top array<struct<feature: string, impact: double>>")
    ex = out.select(F.col("id").alias(id_col), "base_value", "margin", F.posexplode("top").alias("pos", "e"))
    return ex.select(id_col, (F.col("pos") + 1).alias("rank"), F.col("e.feature").alias("feature"),
                     F.col("e.impact").alias("impact"),
                     F.when(F.col("e.impact") > 0, "increases_risk").otherwise("decreases_risk").alias("direction"),
                     "base_value", "margin")
