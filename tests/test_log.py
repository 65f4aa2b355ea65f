"""Prediction-log behaviour on literal rows (the reference's logger tests)."""

import datetime as dt

from pyspark.sql import types as T

from loanlens.operators import logreports as LR


def _log(spark, rows):
    schema = "id bigint, application_id string, timestamp timestamp, default_prob double, decision string, " \
             "model_version string, latency_ms double, features_json string"
    return spark.createDataFrame(rows, schema)


def test_decision_counts_and_total(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(1, "A1", t, 0.1, "APPROVE", "v", 5.0, '{"k": 1}'),
            (2, "A2", t, 0.9, "DECLINE", "v", 7.0, '{"k": 2}'),
            (3, "A3", t, 0.2, "APPROVE", "v", 9.0, "{bad")]
    log = _log(spark, rows)
    got = {r.decision: r.cnt for r in LR.decision_counts(log, 24).collect()}
    assert got == {"APPROVE": 2, "DECLINE": 1}
    assert LR.total_count(log).first()[0] == 3
    feats = LR.read_log_features(log, T.StructType([T.StructField("k", T.LongType())])).collect()
    assert sorted(r.k for r in feats) == [1, 2]


def test_latency_percentiles_rule(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(i, f"A{i}", t, 0.5, "REVIEW", "v", float(v), "{}") for i, v in enumerate([5, 1, 4, 2, 3])]
    r = LR.latency_percentiles(_log(spark, rows), 1).first()
    # sorted [1,2,3,4,5]: index int(0.5*5)=2 -> 3; int(0.95*5)=4 -> 5
    assert (r.p50, r.p95, r.p99) == (3.0, 5.0, 5.0)


def test_empty_window_gives_zeros(spark):
    log = _log(spark, [])
    r = LR.latency_percentiles(log, 1).first()
    assert (r.p50, r.p95, r.p99) == (0.0, 0.0, 0.0)


def test_reports_read_a_written_log(spark, tmp_path):
    """A log written by the sink has ids, and a report with ``as_of`` reads only the days of its window."""
    from loanlens.sources import predlog as PL
    df = spark.createDataFrame([(f"A{i}", 0.1 * i, dt.datetime(2024, 1, 1 + i, 12)) for i in range(8)],
                               "application_id string, default_probability double, at timestamp")
    path = str(tmp_path / "log")
    PL.append_predictions(PL.log_rows(df, ["application_id"], ts=df["at"]), path)
    log, now = spark.read.parquet(path), dt.datetime(2024, 1, 8, 13)
    got = LR.recent(log, 24, as_of=now)
    assert [r.application_id for r in got.collect()] == ["A7"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    schema = T.StructType([T.StructField("application_id", T.StringType())])
    assert LR.read_log_features(log, schema, 48, now, keep=("id",)).count() == 2
    assert LR.read_log_features(log, schema, None, keep=("id",)).count() == 8
    m = LR.operational_metrics(log, as_of=now).first()
    assert (m.total_predictions, m.predictions_last_hour, m.decline_rate) == (8, 1, 1.0)
    assert LR.latency_percentiles(log, 1, now).first().p50 == 0.0
    assert {r.decision: r.cnt for r in LR.decision_counts(log, 24, now).collect()} == {"DECLINE": 1}
