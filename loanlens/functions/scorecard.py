"""Scorecard and decision rules as Column expressions.

All are plain Catalyst expressions, so they fuse into whole-stage codegen with
whatever projection uses them; no Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .numeric import round_dp


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_factor_offset(base_score=S.SCORE_BASE, base_odds=S.SCORE_ODDS, pdo=S.SCORE_PDO):
    factor = pdo / math.log(2)
    offset = base_score - factor * math.log(base_odds)
    return factor, offset


def probability_to_score(p, base_score=S.SCORE_BASE, base_odds=S.SCORE_ODDS, pdo=S.SCORE_PDO,
                         score_min=S.SCORE_MIN, score_max=S.SCORE_MAX) -> Column:
    """PDO scorecard: clip p, log-odds, round half-even, clamp, integer."""
    factor, offset = score_factor_offset(base_score, base_odds, pdo)
    p = _col(p).cast("double")
    pc = F.least(F.greatest(p, F.lit(1e-7)), F.lit(1 - 1e-7))
    raw = F.lit(offset) - F.lit(factor) * F.ln(pc / (F.lit(1.0) - pc))
    clamped = F.least(F.greatest(F.rint(raw), F.lit(float(score_min))), F.lit(float(score_max)))
    return F.when(p.isNull(), F.lit(None)).otherwise(clamped).cast("int")


def score_to_decision(score, threshold_approve=S.SCORE_APPROVE,
                      threshold_decline=S.SCORE_DECLINE) -> Column:
    s = _col(score)
    return (F.when(s >= threshold_approve, "APPROVE")
            .when(s <= threshold_decline, "DECLINE")
            .when(s.isNotNull(), "REVIEW"))


def probability_to_decision(p, threshold_approve=S.PROB_APPROVE,
                            threshold_decline=S.PROB_DECLINE) -> Column:
    """The served rule: low probability approves, high declines."""
    p = _col(p)
    return (F.when(p <= threshold_approve, "APPROVE")
            .when(p >= threshold_decline, "DECLINE")
            .when(p.isNotNull(), "REVIEW"))


def decision_confidence(p, threshold_approve=S.PROB_APPROVE,
                        threshold_decline=S.PROB_DECLINE) -> Column:
    """Distance from the nearest decision boundary, 4 dp."""
    p = _col(p)
    a, d = float(threshold_approve), float(threshold_decline)
    mid, span = (a + d) / 2, (d - a) / 2
    raw = (F.when(p <= a, F.lit(1.0) - p / F.lit(a))
           .when(p >= d, (p - F.lit(d)) / F.lit(1.0 - d))
           .otherwise(F.abs(p - F.lit(mid)) / F.lit(span)))
    return round_dp(raw, 4)


def iv_strength(iv) -> Column:
    """Strength label of an (unrounded) information value."""
    # fixed values: label bands of the information value
    iv = _col(iv)
    return (F.when((iv >= 0.0) & (iv < 0.02), "Useless")
            .when((iv >= 0.02) & (iv < 0.1), "Weak")
            .when((iv >= 0.1) & (iv < 0.3), "Medium")
            .when((iv >= 0.3) & (iv < 0.5), "Strong")
            .when(iv >= 0.5, "Very Strong (check for leakage)")
            .otherwise("Unknown"))


def psi_status(psi, monitor=S.PSI_MONITOR, alert=S.PSI_ALERT) -> Column:
    psi = _col(psi)
    return F.when(psi >= alert, "alert").when(psi >= monitor, "monitor").otherwise("stable")


def psi_stability_text(psi) -> Column:
    """Text variant used by the evaluation report."""
    psi = _col(psi)
    return F.when(psi < 0.1, "Stable").when(psi < 0.2, "Monitor").otherwise("Unstable")


# SQL twins of the rules above, for the DuckDB oracle and for E2.
def sql_score(p: str, base_score=S.SCORE_BASE, base_odds=S.SCORE_ODDS, pdo=S.SCORE_PDO,
              score_min=S.SCORE_MIN, score_max=S.SCORE_MAX, rint="round_even") -> str:
    factor, offset = score_factor_offset(base_score, base_odds, pdo)
    pc = f"least(greatest(({p}), 1e-7), {1 - 1e-7!r})"
    raw = f"({offset!r} - {factor!r} * ln({pc} / (1.0 - {pc})))"
    r = f"round_even({raw}, 0)" if rint == "round_even" else f"rint({raw})"
    return (f"CASE WHEN ({p}) IS NULL THEN NULL ELSE "
            f"CAST(least(greatest({r}, {float(score_min)!r}), {float(score_max)!r}) AS INTEGER) END")


def sql_prob_decision(p: str, a=S.PROB_APPROVE, d=S.PROB_DECLINE) -> str:
    return (f"CASE WHEN {p} <= {a!r} THEN 'APPROVE' WHEN {p} >= {d!r} THEN 'DECLINE' "
            f"WHEN {p} IS NOT NULL THEN 'REVIEW' END")


def sql_score_decision(s: str, a=S.SCORE_APPROVE, d=S.SCORE_DECLINE) -> str:
    return (f"CASE WHEN {s} >= {a} THEN 'APPROVE' WHEN {s} <= {d} THEN 'DECLINE' "
            f"WHEN {s} IS NOT NULL THEN 'REVIEW' END")


def sql_confidence(p: str, a=S.PROB_APPROVE, d=S.PROB_DECLINE) -> str:
    mid, span = (a + d) / 2, (d - a) / 2
    # Scale-then-round: the binary value is rounded in Spark SQL and DuckDB alike.
    return (f"round((CASE WHEN {p} <= {a!r} THEN 1.0 - {p} / {a!r} "
            f"WHEN {p} >= {d!r} THEN ({p} - {d!r}) / {1.0 - d!r} "
            f"ELSE abs({p} - {mid!r}) / {span!r} END) * 10000.0, 0) / 10000.0")


def sql_iv_strength(iv: str) -> str:
    return (f"CASE WHEN {iv} >= 0 AND {iv} < 0.02 THEN 'Useless' "
            f"WHEN {iv} >= 0.02 AND {iv} < 0.1 THEN 'Weak' "
            f"WHEN {iv} >= 0.1 AND {iv} < 0.3 THEN 'Medium' "
            f"WHEN {iv} >= 0.3 AND {iv} < 0.5 THEN 'Strong' "
            f"WHEN {iv} >= 0.5 THEN 'Very Strong (check for leakage)' ELSE 'Unknown' END")


def sql_psi_status(psi: str) -> str:
    return (f"CASE WHEN {psi} >= {S.PSI_ALERT!r} THEN 'alert' "
            f"WHEN {psi} >= {S.PSI_MONITOR!r} THEN 'monitor' ELSE 'stable' END")
