"""Batch scoring of applications in one projection (and T1's per-batch body).

validate -> id -> probability -> score -> decision -> confidence -> version.
The probability comes either from a Column expression (the expert logit
P13, or any scorecard) or from a fitted model's ``transform``. Optional
fields that are NULL take the median of the scored rows (or the ``medians``
given), so every valid application gets a probability and a decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_dp
from .. import schema as S
from ..functions import rules
from ..functions import scorecard as SC
from ..functions.validation import NUMERIC_RULES, validation_errors
from ..operators.prepare import fit_medians

#: fields that an application may leave out
OPTIONAL = [rule[0] for rule in NUMERIC_RULES if not rule[1]]


def optional_medians(df: DataFrame) -> dict[str, float]:
    """Median of each optional field (at most one number a field)."""
    present = [c for c in OPTIONAL if c in df.columns]
    return {r["feature"]: r["median"] for r in fit_medians(df, present).collect()} if present else {}


def imputing(medians: dict[str, float]):
    """``get`` argument of the expert logit: a field's value, or its median where it is NULL."""
    def get(name: str) -> Column:
        filled = medians.get(name)
        return F.col(name) if filled is None else F.coalesce(F.col(name).cast("double"), F.lit(float(filled)))
    return get


def sql_imputed_probability(src: str) -> str:
    """SQL twin: the expert probability with medians of ``src`` for NULL fields."""
    return rules.sql_risk_probability({
        c: f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {src}))" for c in OPTIONAL})


def score_applications(df: DataFrame, probability: Column | None = None, model=None,
                       model_version: str = "expert-logit-v1", key_cols=None,
                       only_valid: bool = True, medians: dict[str, float] | None = None) -> DataFrame:
    """``key_cols``: columns that generated ids are made of (default: all but the id)."""
    out = df.withColumn("errors", validation_errors(df.columns))
    if only_valid:
        out = out.where(F.size("errors") == 0)
    keys = key_cols or [c for c in df.columns if c != S.ID_COL]
    out = rules.assign_application_id(out, [c for c in keys if c in df.columns])
    if model is not None:
        out = model.transform(out)
        prob = F.col("probability_default")
    else:
        if probability is None:
            probability = rules.risk_probability(imputing(optional_medians(df) if medians is None else medians))
        out, prob = out.withColumn("_probability", probability), F.col("_probability")
    p = round_dp(prob, 6)
    return out.select(
        "application_id",
        p.alias("default_probability"),
        SC.probability_to_score(prob).alias("risk_score"),
        SC.probability_to_decision(prob).alias("decision"),
        SC.decision_confidence(prob).alias("confidence"),
        F.lit(model_version).alias("model_version"))


def sql_score_applications(src: str, columns, model_version: str = "expert-logit-v1") -> str:
    from ..functions.validation import sql_validation_errors
    prob = sql_imputed_probability(src)
    return (f"SELECT application_id, round({prob}, 6) AS default_probability, "
            f"{SC.sql_score(prob)} AS risk_score, {SC.sql_prob_decision(prob)} AS decision, "
            f"{SC.sql_confidence('(' + prob + ')')} AS confidence, '{model_version}' AS model_version "
            f"FROM {src} WHERE len({sql_validation_errors(columns)}) = 0")


__all__ = ["score_applications", "sql_score_applications", "S"]
