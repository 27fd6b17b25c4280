"""Driver queries for streaming (2.S); each runs the stream to completion with availableNow."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators.select import quantile_map
from vigil.plans.common import rounded
from vigil.plans.queries_jobs import saved_model
from vigil.sources.fixtures import card
from vigil.sources.tables import read_table
from vigil.streaming import stream as ST

ALERT_PERCENTILE = 0.99


def _streamed(spark, sf):
    """The loaded model and the predictions that a stream of the whole event table has written with it."""
    _, _, model = saved_model(spark, sf, batch_stats="fitted")
    live = model.clean(card(spark, sf, events=ST.event_stream(spark, sf)))
    return model, ST.run_to_table(model.predict(live, keep=("row_id",)), "scores")


def q_stream_scores(spark, sf):
    """Stream rows scored by the reconstruction error of a model that was saved and loaded."""
    return rounded(_streamed(spark, sf)[1])


def q_stream_agreement(spark, sf):
    """For every event, whether the stream's score and label are those of the batch."""
    model, out = _streamed(spark, sf)
    batch = model.predict(model.clean(card(spark, sf)), keep=("row_id",))
    j = batch.alias("b").join(out.alias("s"), "row_id", "full")
    return j.select("row_id", (F.abs(F.col("b.anomaly_score") - F.col("s.anomaly_score")) <= 1e-9 * F.col("b.anomaly_score")).alias("same_score"),
                    F.col("b.predicted_fraud").eqNullSafe(F.col("s.predicted_fraud")).alias("same_label"))


def q_stream_window_alerts(spark, sf):
    thr = quantile_map(read_table(spark, sf, "events"), "value", [ALERT_PERCENTILE])[ALERT_PERCENTILE]
    alerts = ST.window_alerts(ST.event_stream(spark, sf), thr)
    return rounded(ST.run_windows(alerts, ["window_start_us", "window_end_us"], ST.windows_path(spark, "window-alerts")))


def q_stream_velocity(spark, sf):
    velocity = ST.sliding_velocity(ST.event_stream(spark, sf))
    return rounded(ST.run_windows(velocity, ["user_id", "window_start_us"], ST.windows_path(spark, "velocity")))


QUERIES = {"stream_scores": q_stream_scores, "stream_agreement": q_stream_agreement, "stream_window_alerts": q_stream_window_alerts,
           "stream_velocity": q_stream_velocity}
