"""Structured Streaming forms of the online path.

* T1 ``stream_score``: an application stream (orders arriving as files, joined
  to static line-item aggregates and customers) -> ``dropDuplicatesWithinWatermark``
  on the request id, by arrival time (so an old application date is never late) ->
  P15 scoring projection -> shuffle by date -> append to a date-partitioned log.
* T2 ``stream_metrics``: log events -> watermark 1 h -> 24 h windows sliding
  by 1 h, or tumbling 1 h windows -> decision rates and means (append mode emits
  closed windows only).
* T3 ``stream_drift``: ``foreachBatch`` writes each micro-batch to its own folder of
  the log table and recomputes the 168 h drift report (A16) over it; a batch that is
  replayed overwrites its own folders only.

Zone-less Parquet timestamps are cast to TIMESTAMP at the source (a watermark
refuses TIMESTAMP_NTZ); the session zone is UTC. Sinks and checkpoints live
under the shared ``spark.checkpoint.dir``, one fresh folder per run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import scorecard as SC
from ..functions.numeric import round_dp
from ..operators import drift as DR
from ..operators import logreports as LR
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources.tables import read_table


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def _stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """File stream over the table: new ``{name}*.parquet`` files arriving in ``sf_dir``
    are picked up batch by batch (a glob, since the file source wants a folder). The files
    present at the start are one batch: with a batch per file, the watermark of one file would
    drop the rows of a later file with earlier event times."""
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema)
            .parquet(f"{sf_dir.rstrip('/')}/{name}*.parquet"))


def _run(query_builder, out: str) -> None:
    q = query_builder.option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# --- T1 ---------------------------------------------------------------------------------
def stream_score(spark: SparkSession, sf_dir: str, out: str | None = None, model=None) -> str:
    """Returns the sink folder (date-partitioned Parquet log).

    ``model``: a fitted ``Scorecard``, or None for the expert logit."""
    out = out or run_dir(spark, "score")
    orders = _stream_table(spark, sf_dir, "orders")
    dfs = {"orders": orders, "lineitem": read_table(spark, sf_dir, "lineitem"),
           "customer": read_table(spark, sf_dir, "customer")}
    apps = spark.sql(FX._with(FX._APPLICATIONS_CTES, "SELECT * FROM applications"), **dfs)
    apps = apps.withColumn("arrived", F.current_timestamp())
    from ..functions import rules
    from ..functions.validation import validation_errors
    from ..plans.scoring import imputing, optional_medians
    prob = F.col("_p")

    def scored(rows: DataFrame) -> DataFrame:
        if model:
            return model.transform(rows).withColumnRenamed("probability_default", "_p")
        return rows.withColumn("_p", rules.risk_probability(imputing(optional_medians(FX.applications(spark, sf_dir)))))
    rows = (scored(apps.where(F.size(validation_errors(apps.columns)) == 0)
                   .withWatermark("arrived", "1 hour")
                   .dropDuplicatesWithinWatermark([S.ID_COL]))
            .select(S.ID_COL, "applied_at",
                    round_dp(prob, 6).alias("default_probability"),
                    SC.probability_to_score(prob).alias("risk_score"),
                    SC.probability_to_decision(prob).alias("decision"),
                    SC.decision_confidence(prob).alias("confidence"),
                    F.lit(model.version if model else "expert-logit-v1").alias("model_version"),
                    F.to_date("applied_at").alias("date")))
    # dealt by date: a file per date and batch, not one per date and task
    _run(rows.repartition("date").writeStream.format("parquet").outputMode("append").partitionBy("date")
         .option("path", f"{out}/data"), out)
    return f"{out}/data"


# --- T2 ---------------------------------------------------------------------------------
def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream_table(spark, sf_dir, "events")
    log = spark.sql(FX._with([FX._LOG_CTE], "SELECT * FROM prediction_log"), events=events)
    return log.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def window_metrics(log: DataFrame, size: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """A26-style aggregates per sliding window (used by the stream and by its batch twin)."""
    score = SC.probability_to_score(F.col("default_prob"))
    g = log.groupBy(F.window("timestamp", size, slide).alias("w"))
    agg = g.agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.when(F.col("decision") == "APPROVE", 1).otherwise(0)).alias("n_app"),
                F.sum(F.when(F.col("decision") == "REVIEW", 1).otherwise(0)).alias("n_rev"),
                F.sum(F.when(F.col("decision") == "DECLINE", 1).otherwise(0)).alias("n_dec"),
                F.avg("default_prob").alias("avg_p"), F.avg(score).alias("avg_s"),
                F.avg("latency_ms").alias("avg_l"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                      round_dp(F.col("n_app") / F.col("n"), 4).alias("approval_rate"),
                      round_dp(F.col("n_rev") / F.col("n"), 4).alias("review_rate"),
                      round_dp(F.col("n_dec") / F.col("n"), 4).alias("decline_rate"),
                      round_dp("avg_p", 4).alias("avg_default_probability"),
                      round_dp("avg_s", 1).alias("avg_risk_score"),
                      round_dp("avg_l", 2).alias("avg_latency_ms"))


def stream_metrics(spark: SparkSession, sf_dir: str, out: str | None = None, size: str = "24 hours",
                   slide: str = "1 hour") -> str:
    """Closed windows (24 h, slide 1 h) with a 1 h watermark, appended to Parquet. Events that arrive
    more than an hour behind the newest one seen are late and not counted."""
    out = out or run_dir(spark, "metrics")
    log = log_stream(spark, sf_dir).withWatermark("timestamp", "1 hour")
    _run(window_metrics(log, size, slide).writeStream.format("parquet").outputMode("append")
         .option("path", f"{out}/data"), out)
    return f"{out}/data"


# --- T3 ---------------------------------------------------------------------------------
LOG_FEATURES = T.StructType([T.StructField("k", T.LongType())])


def drift_of_log(log: DataFrame, hours: int = 168) -> DataFrame:
    """A16 over the log: the last ``hours`` (current) against everything before (reference)."""
    j = LR.read_log_features(LR.with_window_flags(log, {"cur": hours}), LOG_FEATURES, hours=None, keep=("cur",))
    ref, cur = j.where(~F.col("cur")), j.where(F.col("cur"))
    return DR.drift_report(ref.select("k"), cur.select("k"), ["k"], [])


def stream_drift(spark: SparkSession, sf_dir: str, out: str | None = None, hours: int = 168) -> str:
    """foreachBatch keeps a log table; returns the folder of the last batch's drift report."""
    out = out or run_dir(spark, "drift")
    log_path, rep_path = f"{out}/log", f"{out}/report"

    def each(batch: DataFrame, batch_id: int) -> None:
        record_batch(batch, batch_id, log_path, rep_path, hours)
        last.append(batch_id)

    last: list[int] = []
    _run(log_stream(spark, sf_dir).writeStream.foreachBatch(each), out)
    return f"{rep_path}/batch_id={last[-1]}"


def record_batch(batch: DataFrame, batch_id: int, log_path: str, rep_path: str, hours: int = 168) -> None:
    """Write a batch and the report of the log up to it, each to the batch's own folder."""
    batch.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
    full = batch.sparkSession.read.parquet(log_path).where(F.col("batch_id") <= batch_id)
    drift_of_log(full, hours).write.mode("overwrite").parquet(f"{rep_path}/batch_id={batch_id}")
