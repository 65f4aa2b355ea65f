"""SQL names for the scorecard rules (SQL UDFs, inlined by Catalyst; no Python per row)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import schema as S
from . import scorecard as SC


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create temporary SQL functions: risk_score, score_decision, prob_decision,
    decision_confidence, psi_status, iv_strength."""
    defs = {
        "risk_score": ("p DOUBLE", "INT", SC.sql_score("p", rint="rint")),
        "score_decision": ("s INT", "STRING", SC.sql_score_decision("s")),
        "prob_decision": ("p DOUBLE", "STRING", SC.sql_prob_decision("p")),
        "decision_confidence": ("p DOUBLE", "DOUBLE", SC.sql_confidence("p")),
        "psi_status": ("psi DOUBLE", "STRING", SC.sql_psi_status("psi")),
        "iv_strength": ("iv DOUBLE", "STRING", SC.sql_iv_strength("iv")),
    }
    for name, (args, ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(defs)


__all__ = ["register_sql_functions", "S"]
