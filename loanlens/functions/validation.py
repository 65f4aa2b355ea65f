"""Application validation (P3): per-row error array, valid / rejected split, counts per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

# --- fixed values: request bounds (field, required, low, low_inclusive, high, high_inclusive, integer)
NUMERIC_RULES = [
    ("age", True, 18, True, 100, True, False),
    ("annual_income", True, 0, False, 10_000_000, True, False),
    ("employment_length_years", False, 0, True, 60, True, False),
    ("loan_amount", True, 0, False, 500_000, True, False),
    ("interest_rate", True, 0, False, 40, True, False),
    ("loan_term_months", True, 12, True, 84, True, True),
    ("num_open_accounts", True, 0, True, 100, True, True),
    ("num_derog_records", False, 0, True, 50, True, True),
    ("num_credit_inquiries", True, 0, True, 50, True, True),
    ("credit_utilization_ratio", True, 0, True, 1, True, False),
    ("debt_to_income", True, 0, True, 2, True, False),
    ("months_since_last_delinq", False, 0, True, 300, True, False),
    ("revolving_balance", False, 0, True, None, True, False),
    ("total_accounts", True, 1, True, 200, True, True),
]
ENUM_RULES = [
    ("home_ownership", S.HOME_OWNERSHIP),
    ("loan_purpose", S.LOAN_PURPOSE),
    ("grade", S.GRADES),
    ("verification_status", S.VERIFICATION),
]
# ------------------------------------------------------------------------------------------


def rule_checks(columns) -> list[tuple[str, Column]]:
    """(rule name, violation condition) pairs for the columns present."""
    checks = []
    for name, required, lo, lo_inc, hi, hi_inc, integer in NUMERIC_RULES:
        c = F.col(name).cast("double") if name in columns else F.lit(None).cast("double")
        if required:
            checks.append((f"{name}:required", c.isNull()))
        bad = (c < lo) if lo_inc else (c <= lo)
        if hi is not None:
            bad = bad | ((c > hi) if hi_inc else (c >= hi))
        checks.append((f"{name}:range", c.isNotNull() & bad))
        if integer:
            checks.append((f"{name}:integer", c.isNotNull() & (c != F.floor(c))))
    for name, domain in ENUM_RULES:
        c = F.col(name) if name in columns else F.lit(None).cast("string")
        checks.append((f"{name}:required", c.isNull()))
        checks.append((f"{name}:enum", c.isNotNull() & ~c.isin(*domain)))
    return checks


def validation_errors(columns) -> Column:
    """array<string> of violated rule names (empty when the row is valid)."""
    return F.filter(F.array(*[F.when(cond, F.lit(n)) for n, cond in rule_checks(columns)]),
                    lambda x: x.isNotNull())


def validate_applications(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", validation_errors(df.columns)).withColumn(
        "is_valid", F.size("errors") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate_applications(df)
    return v.where("is_valid"), v.where(~F.col("is_valid"))


def violation_counts(df: DataFrame) -> DataFrame:
    """Violations per rule: explode the error arrays, count (partial aggregation)."""
    v = validate_applications(df)
    return v.select(F.explode("errors").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def sql_validation_errors(columns) -> str:
    """DuckDB twin: list of violated rules in the same order."""
    parts = []
    for name, required, lo, lo_inc, hi, hi_inc, integer in NUMERIC_RULES:
        c = f"CAST({name} AS DOUBLE)" if name in columns else "CAST(NULL AS DOUBLE)"
        if required:
            parts.append(f"CASE WHEN {c} IS NULL THEN '{name}:required' END")
        bad = f"{c} < {lo}" if lo_inc else f"{c} <= {lo}"
        if hi is not None:
            bad += f" OR {c} > {hi}" if hi_inc else f" OR {c} >= {hi}"
        parts.append(f"CASE WHEN {c} IS NOT NULL AND ({bad}) THEN '{name}:range' END")
        if integer:
            parts.append(f"CASE WHEN {c} IS NOT NULL AND {c} <> floor({c}) THEN '{name}:integer' END")
    for name, domain in ENUM_RULES:
        dom = ", ".join("'" + d + "'" for d in domain)
        parts.append(f"CASE WHEN {name} IS NULL THEN '{name}:required' END")
        parts.append(f"CASE WHEN {name} IS NOT NULL AND {name} NOT IN ({dom}) THEN '{name}:enum' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"
