"""Row-level feature rules."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_at(c: Column, low: float) -> Column:
    """Clip from below keeping NULL (``greatest(NULL, 1)`` would give 1)."""
    return F.when(c.isNull(), F.lit(None)).when(c < low, F.lit(float(low))).otherwise(c)


# (new column, numerator, denominator-or-factor, kind)
_DERIVED = [
    ("loan_to_income", "loan_amount", "annual_income", "ratio"),
    ("revolving_to_income", "revolving_balance", "annual_income", "ratio"),
    ("derog_rate", "num_derog_records", "total_accounts", "ratio"),
    ("open_account_rate", "num_open_accounts", "total_accounts", "ratio"),
    ("rate_x_dti", "interest_rate", "debt_to_income", "product"),
]


def derived_feature_columns(columns) -> dict[str, Column]:
    out = {}
    for name, a, b, kind in _DERIVED:
        if a in columns and b in columns:
            if kind == "ratio":
                out[name] = F.col(a).cast("double") / floor_at(F.col(b).cast("double"), 1.0)
            else:
                out[name] = F.col(a).cast("double") * F.col(b).cast("double")
    return out


def derived_value(name: str, get) -> Column:
    """A derived feature over the columns that ``get`` gives for its inputs."""
    a, b, kind = next(d[1:] for d in _DERIVED if d[0] == name)
    x, y = get(a).cast("double"), get(b).cast("double")
    return x / floor_at(y, 1.0) if kind == "ratio" else x * y


def derived_inputs(name: str) -> tuple[str, str]:
    """The two columns a derived feature is made of."""
    return next((d[1], d[2]) for d in _DERIVED if d[0] == name)


def add_derived_features(df: DataFrame) -> DataFrame:
    """Ratios and an interaction; each only when both inputs exist."""
    cols = derived_feature_columns(df.columns)
    return df.withColumns(cols) if cols else df


def sql_derived_features(prefix: str = "") -> str:
    """SQL select-list fragment equal to ``add_derived_features``."""
    parts = []
    for name, a, b, kind in _DERIVED:
        if kind == "ratio":
            parts.append(f"{prefix}{a} / CASE WHEN {prefix}{b} < 1 THEN 1e0 ELSE {prefix}{b} END AS {name}")
        else:
            parts.append(f"{prefix}{a} * {prefix}{b} AS {name}")
    return ",\n  ".join(parts)


def select_columns(df: DataFrame, columns=None) -> DataFrame:
    """Keep the listed columns that exist (all when ``None``)."""
    if columns is None:
        return df
    return df.select(*[c for c in columns if c in df.columns])


def assign_application_id(df: DataFrame, key_cols, id_col: str = "application_id") -> DataFrame:
    """Keep a given id, else ``REQ-`` + 12 upper hex of a hash of the row key.

    A hash (not a random UUID) so that re-running a job, or re-executing a
    lost task, yields the same id. Rows equal in all key columns share an id. NULL differs from
    empty text, and a separator inside a value from one between values. 48 bits: no unique key.
    """
    def text(c):
        escaped = F.regexp_replace(F.col(c).cast("string"), r"([\\|])", r"\\$1")
        return F.coalesce(escaped, F.lit("\\N"))
    key = F.concat_ws("|", *[text(c) for c in key_cols])
    generated = F.concat(F.lit("REQ-"), F.upper(F.substring(F.md5(key), 1, 12)))
    if id_col in df.columns:
        return df.withColumn(id_col, F.coalesce(F.col(id_col), generated))
    return df.withColumn(id_col, generated)


def format_application_id(n) -> Column:
    """F8: ``APP%07d``."""
    text = (F.col(n) if isinstance(n, str) else n).cast("string")
    # at least seven digits; longer keys keep all of theirs
    return F.concat(F.lit("APP"), F.lpad(text, F.greatest(F.lit(7), F.char_length(text)), F.lit("0")))


def to_number(c) -> Column:
    """text to double, NULL on failure (plain CAST raises under ANSI)."""
    return F.expr(f"try_cast(`{c}` AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


# --- fixed values: expert risk logit ------------------------------------------
GRADE_RISK = {"A": -1.5, "B": -0.8, "C": 0.0, "D": 0.7, "E": 1.3, "F": 2.0}
LOGIT_INTERCEPT = -2.5
LOGIT_WEIGHTS = {"dti": 0.9, "util": 0.8, "grade": 0.7, "derog": 1.2, "inq": 0.4,
                 "rate": 0.5, "income": 0.4, "emp": 0.3, "delinq": 0.3, "interaction": 0.6}
LOGIT_SCALING = {"dti": (0.18, 0.09), "util": (0.40, 0.25), "inq": (1.5, 1.5),
                 "rate": (13.5, 4.5), "income": (10.8, 0.6), "emp": (1.6, 0.8),
                 "delinq": (3.0, 1.0)}
INTERACTION_SCALE = 0.5
RISK_INPUTS = ["debt_to_income", "credit_utilization_ratio", "grade", "num_derog_records", "num_credit_inquiries",
               "interest_rate", "annual_income", "employment_length_years", "months_since_last_delinq"]
# ------------------------------------------------------------------------------


def _grade_risk(c: Column) -> Column:
    expr = None
    for g, v in GRADE_RISK.items():
        expr = (F.when(c == g, F.lit(v)) if expr is None else expr.when(c == g, F.lit(v)))
    return expr.otherwise(F.lit(0.0))


def risk_terms(get=None) -> dict[str, Column]:
    """The scaled drivers of the expert logit (P13); ``get`` maps a name to its Column."""
    get = get or F.col

    def z(col, key, sign=1.0):
        m, s = LOGIT_SCALING[key]
        return F.lit(sign) * (col - F.lit(m)) / F.lit(s)

    def col(n):
        return get(n).cast("double")
    dti = z(col("debt_to_income"), "dti")
    util = z(col("credit_utilization_ratio"), "util")
    return {
        "dti": dti,
        "util": util,
        "grade": _grade_risk(get("grade")),
        "derog": F.log1p(col("num_derog_records")),
        "inq": z(col("num_credit_inquiries"), "inq"),
        "rate": z(col("interest_rate"), "rate"),
        "income": z(F.ln(col("annual_income") + F.lit(1.0)), "income", -1.0),
        "emp": z(F.log1p(col("employment_length_years")), "emp", -1.0),
        "delinq": z(F.log1p(col("months_since_last_delinq")), "delinq", -1.0),
        "interaction": dti * util * F.lit(INTERACTION_SCALE),
    }


def risk_logit(get=None) -> Column:
    terms = risk_terms(get)
    out = F.lit(LOGIT_INTERCEPT)
    for k, w in LOGIT_WEIGHTS.items():
        out = out + F.lit(w) * terms[k]
    return out


def risk_probability(get=None) -> Column:
    """P13 re-aimed as an expert scorecard column: sigmoid of the fixed logit."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-risk_logit(get)))


def risk_on_arrays(medians: dict[str, float] | None = None):
    """``risk_probability`` on NumPy arrays inside a task; ``medians`` fill NULL values.

    The function returned takes ``get``: name -> numbers, NaN for NULL (``grade``: texts). NaN
    stands for a NULL result, also that of a logarithm out of range."""
    weights, scaling, grades = dict(LOGIT_WEIGHTS), dict(LOGIT_SCALING), dict(GRADE_RISK)
    intercept, interaction, fills = LOGIT_INTERCEPT, INTERACTION_SCALE, dict(medians or {})

    def probability(get):
        def col(n):
            fill = fills.get(n)
            return get(n) if fill is None else np.where(np.isnan(get(n)), float(fill), get(n))

        def z(x, key, sign=1.0):
            m, s = scaling[key]
            return sign * (x - m) / s

        def log1p(x):
            return np.log1p(np.where(x > -1.0, x, np.nan))
        dti, util = z(col("debt_to_income"), "dti"), z(col("credit_utilization_ratio"), "util")
        income = col("annual_income") + 1.0
        grade = get("grade")
        terms = {
            "dti": dti,
            "util": util,
            "grade": np.array([grades.get(g, 0.0) for g in grade.ravel()], dtype=float).reshape(grade.shape),
            "derog": log1p(col("num_derog_records")),
            "inq": z(col("num_credit_inquiries"), "inq"),
            "rate": z(col("interest_rate"), "rate"),
            "income": z(np.log(np.where(income > 0.0, income, np.nan)), "income", -1.0),
            "emp": z(log1p(col("employment_length_years")), "emp", -1.0),
            "delinq": z(log1p(col("months_since_last_delinq")), "delinq", -1.0),
            "interaction": dti * util * interaction,
        }
        logit = intercept
        for k, w in weights.items():
            logit = logit + w * terms[k]
        return 1.0 / (1.0 + np.exp(-logit))
    return probability


def sql_risk_terms(sub: dict[str, str] | None = None) -> dict[str, str]:
    """SQL twins of ``risk_terms``; ``sub`` replaces column names by expressions."""
    sub = sub or {}

    def c(n):
        return f"({sub[n]})" if n in sub else n

    def z(expr, key, sign=1.0):
        m, s = LOGIT_SCALING[key]
        return f"({sign!r} * (({expr}) - {m!r}) / {s!r})"
    grade = "CASE " + " ".join(f"WHEN {c('grade')} = '{g}' THEN {v!r}" for g, v in GRADE_RISK.items()) + " ELSE 0.0 END"
    dti = z(c("debt_to_income"), "dti")
    util = z(c("credit_utilization_ratio"), "util")
    return {
        "dti": dti, "util": util, "grade": grade,
        "derog": f"ln(1 + {c('num_derog_records')})",
        "inq": z(c("num_credit_inquiries"), "inq"),
        "rate": z(c("interest_rate"), "rate"),
        "income": z(f"ln({c('annual_income')} + 1.0)", "income", -1.0),
        "emp": z(f"ln(1 + {c('employment_length_years')})", "emp", -1.0),
        "delinq": z(f"ln(1 + {c('months_since_last_delinq')})", "delinq", -1.0),
        "interaction": f"({dti} * {util} * {INTERACTION_SCALE!r})",
    }


def sql_risk_probability(sub: dict[str, str] | None = None) -> str:
    terms = sql_risk_terms(sub)
    logit = f"{LOGIT_INTERCEPT!r}" + "".join(f" + {w!r} * {terms[k]}" for k, w in LOGIT_WEIGHTS.items())
    return f"(1.0 / (1.0 + exp(-({logit}))))"
