"""Prediction-log reports.

"Now" is a parameter (``as_of``): when it is not given, the log's own latest
timestamp is used, as a scalar subquery (evaluated once, merged with other
scalar aggregates of the same scan), so a re-run over the same table gives
the same answer. Time predicates are written
against the timestamp column so that they reach the Parquet scan (and the
``date`` partition column, when the log is partitioned by date).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_dp
from ..functions.scorecard import probability_to_score
from .ranking import value_at_ranks

TS = "timestamp"


def _as_of(log: DataFrame, as_of) -> Column:
    """"Now": a literal, or the log's latest timestamp as a scalar subquery (computed once)."""
    if as_of is None:
        return log.agg(F.max(TS)).scalar()
    if isinstance(as_of, (_dt.datetime, str)):
        return F.lit(as_of).cast(log.schema[TS].dataType)
    raise TypeError("as_of must be None, a datetime or an ISO string")


def with_window_flags(log: DataFrame, hours: dict[str, int], as_of=None) -> DataFrame:
    """Adds one boolean column per named look-back window."""
    now = _as_of(log, as_of)
    return log.withColumns({name: F.col(TS) >= now - F.make_dt_interval(F.lit(0), F.lit(h))
                            for name, h in hours.items()})


def in_window(log: DataFrame, hours: int | None, as_of=None) -> DataFrame:
    """Rows of the last ``hours`` (None: all rows). Of a log partitioned by ``date``, only the folders
    from the window's first day on are read."""
    if hours is None:
        return log
    start = _as_of(log, as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    out = log.where(F.col(TS) >= start)
    if "date" in log.columns and isinstance(log.schema["date"].dataType, T.DateType):
        out = out.where(F.col("date") >= F.to_date(start))
    return out


def recent(log: DataFrame, hours: int = 24, as_of=None, limit: int | None = None) -> DataFrame:
    """P12 + O2: rows of the last ``hours``, newest first (id breaks ties)."""
    out = in_window(log, hours, as_of).orderBy(F.col(TS).desc(), F.col("id").desc())
    return out.limit(limit) if limit else out


def read_log_features(log: DataFrame, feature_schema: T.StructType, hours: int | None = 168,
                      as_of=None, keep=("id", "application_id")) -> DataFrame:
    """Parse ``features_json`` of the window; unparseable rows are skipped.

    A struct of NULLs is what bad JSON yields, so the test is on the corrupt
    record column, not on the struct.
    """
    corrupt = "_corrupt_record"
    schema = T.StructType(list(feature_schema.fields) + [T.StructField(corrupt, T.StringType())])
    parsed = F.from_json("features_json", schema, {"mode": "PERMISSIVE",
                                                  "columnNameOfCorruptRecord": corrupt})
    out = in_window(log, hours, as_of).select(*keep, parsed.alias("f")).where(F.col(f"f.{corrupt}").isNull())
    return out.select(*keep, *[F.col(f"f.{f.name}").alias(f.name) for f in feature_schema.fields])


def decision_counts(log: DataFrame, hours: int = 24, as_of=None) -> DataFrame:
    """A25."""
    w = in_window(log, hours, as_of)
    return w.groupBy("decision").agg(F.count(F.lit(1)).alias("cnt"))


def latency_percentiles(log: DataFrame, hours: int = 1, as_of=None) -> DataFrame:
    """Sorted latency at index min(int(p n), n-1); zeros when the window is empty."""
    w = in_window(log, hours, as_of)
    r = value_at_ranks(w, "latency_ms", {"p50": 0.50, "p95": 0.95, "p99": 0.99})
    return r.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("p50", "p95", "p99")])


def total_count(log: DataFrame) -> DataFrame:
    """A27."""
    return log.agg(F.count(F.lit(1)).alias("total_predictions"))


def operational_metrics(log: DataFrame, as_of=None, score: Column | None = None) -> DataFrame:
    """One aggregate over the last 24 hours, W4 over the last hour; of all rows, only their count."""
    if score is None:
        score = (F.col("risk_score") if "risk_score" in log.columns
                 else probability_to_score(F.col("default_prob")))
    hour_ago = _as_of(log, as_of) - F.make_dt_interval(F.lit(0), F.lit(1))
    w = in_window(log.withColumn("_score", score), 24, as_of).withColumn("in_1h", F.col(TS) >= hour_ago)

    def rate(dec):
        return F.count_if(F.col("decision") == dec)

    agg = w.agg(
        F.count_if("in_1h").alias("predictions_last_hour"), F.count(F.lit(1)).alias("n24"),
        rate("APPROVE").alias("n_app"), rate("REVIEW").alias("n_rev"), rate("DECLINE").alias("n_dec"),
        F.avg("default_prob").alias("avg_p"), F.avg("_score").alias("avg_s"), F.avg("latency_ms").alias("avg_l"))
    pct = latency_percentiles(log, 1, as_of)

    def r4(c):
        return F.when(F.col("n24") > 0, round_dp(F.col(c) / F.col("n24"), 4)).otherwise(F.lit(0.0))
    return agg.join(pct).select(
        total_count(log).scalar().cast("long").alias("total_predictions"),
        F.col("predictions_last_hour").cast("long").alias("predictions_last_hour"),
        r4("n_app").alias("approval_rate"), r4("n_rev").alias("review_rate"),
        r4("n_dec").alias("decline_rate"),
        F.coalesce(round_dp("avg_p", 4), F.lit(0.0)).alias("avg_default_probability"),
        F.coalesce(round_dp("avg_s", 1), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(round_dp("avg_l", 2), F.lit(0.0)).alias("avg_latency_ms"),
        F.col("p95").alias("p95_latency_ms"), F.col("p99").alias("p99_latency_ms"))
