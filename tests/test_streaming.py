"""The streaming timeline equals the batch timeline: late events, restarts, bounded state."""

import datetime as dt

from conftest import same_rows
from lastmile.plans import silver as S
from lastmile.sources.schemas import DELIVERY_EVENTS
from lastmile.streaming.timeline import read_events, start_timeline_stream, timeline_from_versions

T0 = dt.datetime(2024, 2, 1, 12, 0)


def _after(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def _write(spark, rows, path):
    spark.createDataFrame(rows, DELIVERY_EVENTS).coalesce(1).write.mode("overwrite").json(path)


def _run(spark, base, watermark=None, max_files=None):
    """Start on what the checkpoint knows, take all new files, stop."""
    q = start_timeline_stream(read_events(spark, f"{base}/src/*", max_files_per_trigger=max_files), f"{base}/v", f"{base}/ckpt", watermark)
    q.awaitTermination()
    return q


def test_stream_matches_batch_with_late_event_after_restart(spark, tmp_dir):
    first = [
        (1, 5, "ASSIGNED", T0, 0.0, 0.0),
        (1, 5, "PICKED_UP", _after(10), 0.0, 0.0),
        (2, 6, "ASSIGNED", T0, 0.0, 0.0),
        (3, 7, "ASSIGNED", None, 0.0, 0.0),
    ]
    late = [
        (1, 9, "ASSIGNED", _after(-3), 0.0, 0.0),  # earlier ASSIGNED arrives late
        (2, 6, "DELIVERED", _after(40), 0.0, 0.0),
    ]
    _write(spark, first, f"{tmp_dir}/src/a")
    _run(spark, tmp_dir)
    _write(spark, late, f"{tmp_dir}/src/b")
    q = _run(spark, tmp_dir)
    # The second run read the new file only; the first events came from the state store.
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(late)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) == 3

    streamed = timeline_from_versions(spark, f"{tmp_dir}/v")
    assert same_rows(streamed, S.delivery_timeline(spark.createDataFrame(first + late, DELIVERY_EVENTS)))
    by_order = {r.order_id: r for r in streamed.collect()}
    assert by_order[1].accepted_ts == _after(-3)
    assert by_order[2].delivery_status == "COMPLETED"


def test_all_files_in_one_batch_or_one_each(spark, tmp_dir):
    rows = [(i % 7, i % 3, ("ASSIGNED", "PICKED_UP", "DELIVERED")[i % 3], _after(i * 37 % 100), 0.0, 0.0) for i in range(60)]
    for k in range(5):
        for side in ("one", "each"):
            _write(spark, rows[k::5], f"{tmp_dir}/{side}/src/{k}")
    one, each = _run(spark, f"{tmp_dir}/one"), _run(spark, f"{tmp_dir}/each", max_files=1)
    batches = lambda q: len({p["batchId"] for p in q.recentProgress if p["numInputRows"]})
    assert batches(one) == 1 and batches(each) >= 5
    expected = S.delivery_timeline(spark.createDataFrame(rows, DELIVERY_EVENTS))
    assert same_rows(timeline_from_versions(spark, f"{tmp_dir}/one/v"), expected)
    assert same_rows(timeline_from_versions(spark, f"{tmp_dir}/each/v"), expected)


def test_watermark_drops_old_state_and_keeps_answers(spark, tmp_dir):
    """An order over midnight keeps its events of both days; the state of past days goes."""
    days = [
        [(1, 5, "ASSIGNED", _after(700), 0.0, 0.0), (1, 5, "PICKED_UP", _after(730), 0.0, 0.0)],
        [(2, 5, "ASSIGNED", _after(4 * 1440), 0.0, 0.0)],
        [(3, 5, "ASSIGNED", _after(8 * 1440), 0.0, 0.0)],
        [(4, 5, "ASSIGNED", _after(8 * 1440 + 5), 0.0, 0.0)],
    ]
    for k, rows in enumerate(days):
        _write(spark, rows, f"{tmp_dir}/src/{k}")
        q = _run(spark, tmp_dir, watermark="1 day")
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2
    expected = S.delivery_timeline(spark.createDataFrame(sum(days, []), DELIVERY_EVENTS))
    assert same_rows(timeline_from_versions(spark, f"{tmp_dir}/v"), expected)
