"""Batch-vs-stream equality: the scored stream (S1), windows over many files, restarts and repeated batches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.functions.clean import card_clean_params, clean
from vigil.operators.features import FeatureModel
from vigil.operators.split import split_2way
from vigil.sources.fixtures import card
from vigil.streaming import stream as ST


def test_stream_scores_equal_batch(spark):
    raw = card(spark, SF_SMALL)
    cp = card_clean_params(raw)
    batch = split_2way(clean(raw, cp))
    fitted = FeatureModel(batch_stats="fitted").fit(batch.where(F.col("split") == "train").drop("split"))
    want = {r["row_id"]: r["amount_z_score"] for r in fitted.transform(clean(raw, cp)).collect()}
    live = clean(card(spark, SF_SMALL, events=ST.event_stream(spark, SF_SMALL)), cp)
    got = ST.run_to_table(fitted.transform(live).select("row_id", "amount_z_score"), "test")
    got = {r["row_id"]: r["amount_z_score"] for r in got.collect()}
    assert got == want


START = dt.datetime(2024, 1, 1)


def _events(n, seed):
    """Events in order but for delays of up to half an hour, which the watermark allows."""
    rng = random.Random(seed)
    return [(i, START + dt.timedelta(minutes=7 * i, seconds=rng.randint(-1800, 0)), rng.randint(0, 3), "view", float(rng.randint(0, 100)), None) for i in range(n)]


def _write(spark, rows, path):
    spark.createDataFrame(rows, ST.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_windows_are_complete_over_files_and_restarts(spark, tmp_path):
    events = _events(400, 1)
    src, out = f"{tmp_path}/events", f"{tmp_path}/alerts"
    for lo in (0, 100, 200):
        _write(spark, events[lo: lo + 100], src)
    keys = ["window_start_us", "window_end_us"]
    first = ST.run_windows(ST.window_alerts(_stream(spark, src), 50.0), keys, out).count()
    _write(spark, events[300:], src)
    got = ST.run_windows(ST.window_alerts(_stream(spark, src), 50.0), keys, out).collect()  # goes on with the state
    want = {}
    for _, ts, _, _, value, _ in events:
        day = int((ts - dt.datetime(1970, 1, 1)).total_seconds()) // 86400 * 86400 * 1_000_000
        n, a, total = want.get(day, (0, 0, 0.0))
        want[day] = (n + 1, a + (value > 50), total + (value if value > 50 else 0.0))
    assert {r.window_start_us: (r.n_events, r.n_alerts, r.alert_amount) for r in got} == want
    assert len(got) == len(want) >= first
    again = ST.run_windows(ST.window_alerts(_stream(spark, src), 50.0), keys, out)  # nothing new
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_sliding_windows_hold_every_event_in_each_of_theirs(spark, tmp_path):
    events = _events(200, 2)
    src = f"{tmp_path}/events"
    for lo in (0, 100):
        _write(spark, events[lo: lo + 100], src)
    got = ST.run_windows(ST.sliding_velocity(_stream(spark, src)), ["user_id", "window_start_us"], f"{tmp_path}/velocity").collect()
    want = {}
    for _, ts, user, _, value, _ in events:
        s = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        for k in range(6):
            key = (user, (s // 600 - k) * 600 * 1_000_000)
            n, total = want.get(key, (0, 0.0))
            want[key] = (n + 1, total + value)
    assert {(r.user_id, r.window_start_us): (r.n_events, r.total_value) for r in got} == want
