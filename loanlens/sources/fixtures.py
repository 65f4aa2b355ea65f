"""Fixture views built from the driver's tables.

The SQL text is shared with the DuckDB oracle: Spark runs it with the table
DataFrames bound as parameters (``{lineitem}``), DuckDB with bare table names.
Integer cents keep the sums exact in both engines; ``e0`` literals are doubles.

Plan shape: ``lineitem`` is aggregated by ``l_orderkey`` (partial + final hash
aggregate), then joined to ``orders`` on the same key, so the aggregate's
hash partitioning is reused; ``customer`` is joined on ``o_custkey`` and AQE
turns that into a broadcast only when its runtime size is under the
broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

_APPLICATIONS_CTES = [
    ("li", """
  SELECT l_orderkey, count(*) AS n,
         sum(CAST(l_quantity AS BIGINT)) AS qty,
         sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS price_c,
         sum(CAST(round(l_discount*100) AS BIGINT)) AS disc_c,
         sum(CAST(round(l_tax*100) AS BIGINT)) AS tax_c,
         sum(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_ret,
         sum(CASE WHEN l_linestatus='F' THEN 1 ELSE 0 END) AS n_fin
  FROM {lineitem} GROUP BY l_orderkey"""),
    ("a", """
  SELECT o_orderkey AS k,
    concat('APP', lpad(CAST(o_orderkey AS VARCHAR(20)), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR(20)))) AS INT), '0')) AS application_id,
    CAST(18+(o_custkey*7+o_orderkey)%63 AS DOUBLE) AS age,
    15000e0+(c_acctbal+1000e0)*12e0 AS annual_income,
    CASE WHEN o_orderkey%17=0 THEN NULL ELSE ((o_orderkey*13)%400)/10e0 END AS employment_length_years,
    o_totalprice/5e0 AS loan_amount,
    5e0+2e0*disc_c/n AS interest_rate,
    CASE WHEN o_orderstatus='F' THEN 60e0 ELSE 36e0 END AS loan_term_months,
    CAST(1+n+o_custkey%10 AS DOUBLE) AS num_open_accounts,
    CASE WHEN o_orderkey%19=0 THEN NULL ELSE CAST(n_ret AS DOUBLE) END AS num_derog_records,
    CAST(n_fin AS DOUBLE) AS num_credit_inquiries,
    qty/(50e0*n) AS credit_utilization_ratio,
    tax_c/(20e0*n) AS debt_to_income,
    CASE WHEN o_orderkey%13=0 THEN NULL
         ELSE CAST((2002-year(o_orderdate))*12-month(o_orderdate) AS DOUBLE) END AS months_since_last_delinq,
    CASE WHEN o_orderkey%23=0 THEN NULL ELSE price_c/1000e0 END AS revolving_balance,
    CAST(2+n*3+o_custkey%20 AS DOUBLE) AS total_accounts,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'OWN' WHEN 'AUTOMOBILE' THEN 'MORTGAGE'
         WHEN 'FURNITURE' THEN 'OTHER' ELSE 'RENT' END AS home_ownership,
    CASE o_orderkey%6 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card'
         WHEN 2 THEN 'home_improvement' WHEN 3 THEN 'other'
         WHEN 4 THEN 'major_purchase' ELSE 'medical' END AS loan_purpose,
    CASE WHEN o_orderkey%25=0 THEN 'F' WHEN o_orderpriority='1-URGENT' THEN 'A'
         WHEN o_orderpriority='2-HIGH' THEN 'B' WHEN o_orderpriority='3-MEDIUM' THEN 'C'
         WHEN o_orderpriority='4-NOT SPECIFIED' THEN 'D' ELSE 'E' END AS grade,
    CASE o_orderstatus WHEN 'F' THEN 'Verified' WHEN 'O' THEN 'Source Verified'
         ELSE 'Not Verified' END AS verification_status,
    o_orderdate AS applied_at
  FROM {orders} JOIN {customer} ON o_custkey=c_custkey JOIN li ON o_orderkey=l_orderkey"""),
    ("r", """
  SELECT a.*,
    100e0*debt_to_income + 20e0*credit_utilization_ratio + 1e0*interest_rate
    + 6e0*coalesce(num_derog_records, 0e0)
    + CASE grade WHEN 'A' THEN -8e0 WHEN 'B' THEN -4e0 WHEN 'C' THEN 0e0
                 WHEN 'D' THEN 4e0 WHEN 'E' THEN 8e0 ELSE 12e0 END AS risk
  FROM a"""),
    ("applications", """
  SELECT r.*, CASE WHEN risk + (k*7919)%41 > 93 THEN 1 ELSE 0 END AS dflt FROM r"""),
]

_SCORED_CTE = ("scored", """
  SELECT application_id, applied_at, dflt,
       round(1e0/(1e0+exp(-(risk-75e0)/9e0)), 6) AS default_prob,
       round(1e0/(1e0+exp(-(risk-interest_rate-65e0)/8e0)), 6) AS challenger_prob
  FROM applications""")

_LOG_CTE = ("prediction_log", """
  SELECT event_id AS id,
       concat('APP', lpad(CAST(user_id AS VARCHAR(20)), CAST(greatest(7, length(CAST(user_id AS VARCHAR(20)))) AS INT), '0')) AS application_id,
       ts AS timestamp,
       round(((event_id*37+user_id*11)%100)/100e0, 6) AS default_prob,
       CASE WHEN (event_id*37+user_id*11)%100 <= 30 THEN 'APPROVE'
            WHEN (event_id*37+user_id*11)%100 >= 70 THEN 'DECLINE' ELSE 'REVIEW' END AS decision,
       concat('v_', event_type) AS model_version,
       value AS latency_ms,
       CASE WHEN event_id%50=0 THEN '{{bad' ELSE props END AS features_json
  FROM {events}""")

# Reference / current split used by drift and score-PSI fixtures.
DRIFT_CUTOFF = "1999-01-01"
TARGET = "dflt"


def _with(ctes, final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def _duck(text: str) -> str:
    """Bind bare table names for DuckDB (the Spark side binds DataFrames)."""
    return text.format(lineitem="lineitem", orders="orders", customer="customer",
                       events="events")


def view_ctes(*views: str) -> list[tuple[str, str]]:
    ctes: list[tuple[str, str]] = []
    if "applications" in views or "scored" in views:
        ctes += _APPLICATIONS_CTES
    if "scored" in views:
        ctes.append(_SCORED_CTE)
    if "prediction_log" in views:
        ctes.append(_LOG_CTE)
    return ctes


def oracle_with(views: list[str], final_sql: str) -> str:
    """DuckDB text: the fixture views as CTEs followed by ``final_sql``."""
    return _duck(_with(view_ctes(*views), final_sql))


def _spark_view(spark: SparkSession, sf_dir: str, ctes, name: str, tables) -> DataFrame:
    dfs = {t: read_table(spark, sf_dir, t) for t in tables}
    return spark.sql(_with(ctes, f"SELECT * FROM {name}"), **dfs)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan application per order that has line items (FIXTURES 3.1)."""
    return _spark_view(spark, sf_dir, _APPLICATIONS_CTES, "applications",
                       ["lineitem", "orders", "customer"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champion / challenger probability per application (FIXTURES 3.2)."""
    return _spark_view(spark, sf_dir, _APPLICATIONS_CTES + [_SCORED_CTE], "scored",
                       ["lineitem", "orders", "customer"])


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log derived from ``events`` (FIXTURES 3.3)."""
    return _spark_view(spark, sf_dir, [_LOG_CTE], "prediction_log", ["events"])


def application_features(df: DataFrame) -> DataFrame:
    """Feature columns of ``applications`` (no id, key, date, risk or target)."""
    from ..schema import ALL_FEATURES
    return df.select(*ALL_FEATURES)
