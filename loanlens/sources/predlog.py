"""Prediction log sink (S5): append scored rows, partitioned by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scorecard as SC


def log_rows(df: DataFrame, feature_cols: list[str], prob: str = "default_probability",
             model_version: str | Column = "unknown", latency: Column | None = None,
             ts: Column | None = None, attribution: Column | None = None) -> DataFrame:
    """Row shape of the log: id, ts, prob, score, decision, confidence, version, latency,
    features as JSON text, optional attribution JSON."""
    p = F.col(prob)
    return df.select(
        "application_id",
        (ts if ts is not None else F.current_timestamp()).alias("timestamp"),
        p.alias("default_prob"),
        SC.probability_to_score(p).alias("risk_score"),
        SC.probability_to_decision(p).alias("decision"),
        SC.decision_confidence(p).alias("confidence"),
        (model_version if isinstance(model_version, Column) else F.lit(model_version)).alias("model_version"),
        (latency if latency is not None else F.lit(0.0)).cast("double").alias("latency_ms"),
        F.to_json(F.struct(*feature_cols)).alias("features_json"),
        (F.to_json(attribution) if attribution is not None else F.lit(None).cast("string")).alias("shap_json"))


def append_predictions(rows: DataFrame, path: str) -> None:
    """Append to a date-partitioned Parquet log (partition pruning on ``date``).

    Rows without an ``id`` get a hash of their content: it orders rows of one timestamp in the
    reports, and a task that runs again gives the same. It is no unique key.
    """
    if "id" not in rows.columns:
        rows = rows.withColumn("id", F.xxhash64(*rows.columns))
    (rows.withColumn("date", F.to_date("timestamp"))
     .write.mode("append").partitionBy("date").parquet(path))
