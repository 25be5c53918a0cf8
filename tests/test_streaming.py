"""Streams give the batch result, whatever the restarts, repeats and layout of stored input; late rows are counted."""

from __future__ import annotations

import datetime
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from shop import at

from stockaudit.session import new_folder
from stockaudit.sources.marks import newest_mark
from stockaudit.streaming import events as ev
from stockaudit.streaming import intake
from stockaudit.streaming import ledger as lg
from stockaudit.streaming import lifecycle as lc
from stockaudit.streaming.runs import LateRows, replay_to_table, run_to_table, stored_state, time_slices

STATUS = "entity_id BIGINT, event_id BIGINT, status STRING, ts TIMESTAMP_NTZ"
MOVE = "store_id INT, product_id BIGINT, id BIGINT, kind STRING, delta INT, ts TIMESTAMP_NTZ"


@pytest.fixture
def arrive(spark):
    """Write the rows of each batch as one later file and read them one file per micro-batch."""
    def run(schema, *batches, folder=None):
        folder = folder or new_folder(spark, "in")
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        return folder, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return run


def event(i, minute, user=1, kind="view"):
    return (i, at(minute), user, kind, 1.0, "{}")


def test_late_rows_are_dropped_and_open_hours_wait(arrive):
    _, stream = arrive(
        ev.EVENTS,
        [event(1, 5), event(2, 50)],
        [event(3, 75), event(4, 55)],  # out of order, within the watermark
        [event(5, 200)],  # closes the first two hours
        [event(6, 10), event(7, 210)],  # 6 is far too late
    )
    got = {(r.window_start, r.n) for r in run_to_table(ev.hourly_counts(stream)).collect()}
    assert got == {(at(0), 3), (at(60), 1)}


def test_repeated_events_are_taken_once(arrive):
    _, stream = arrive(ev.EVENTS, [event(1, 0), event(1, 0), event(2, 1)], [event(2, 1), event(3, 2)])
    assert sorted(r.event_id for r in run_to_table(ev.dedup_events(stream)).collect()) == [1, 2, 3]


def test_sessions_close_after_the_gap(arrive):
    _, stream = arrive(ev.EVENTS, [event(1, 0), event(2, 30)], [event(3, 2000), event(4, 9000, user=2)])
    got = sorted((r.user_id, r.session_start, r.n) for r in run_to_table(ev.open_sessions(stream)).collect())
    assert got == [(1, at(0), 2), (1, at(2000), 1)]


def test_resume_equals_one_run(arrive, spark):
    batches = [[event(i * 10 + j, i * 45 + j) for j in range(10)] for i in range(8)]
    _, whole = arrive(ev.EVENTS, *batches)
    expected = sorted(tuple(r) for r in run_to_table(ev.hourly_counts(whole)).collect())
    run = new_folder(spark, "run")
    folder, first = arrive(ev.EVENTS, *batches[:3])
    run_to_table(ev.hourly_counts(first), run)
    _, rest = arrive(ev.EVENTS, *batches[3:], folder=folder)
    assert sorted(tuple(r) for r in run_to_table(ev.hourly_counts(rest), run).collect()) == expected
    assert expected


def test_rejected_moves_leave_the_state(arrive):
    rows = [(1, 1, "pending", at(0)), (1, 2, "delivered", at(1)), (1, 3, "confirmed", at(2)), (1, 4, "delivered", at(3)),
            (2, 5, "confirmed", at(1)), (2, 6, "confirmed", at(4)), (2, 7, "cancelled", at(5))]
    expected = [(1, 1, None, True), (1, 2, "pending", False), (1, 3, "pending", True), (1, 4, "confirmed", True),
                (2, 5, None, True), (2, 6, "confirmed", False), (2, 7, "confirmed", True)]
    # One batch in any order, and the same rows over three batches.
    for batches in ([rows[::-1]], [rows[:2], rows[2:6], rows[6:]]):
        _, stream = arrive(STATUS, *batches)
        got = run_to_table(lc.order_lifecycle(stream, buckets=2)).collect()
        assert sorted((r.entity_id, r.event_id, r.prev_status, r.accepted) for r in got) == expected


def test_old_entities_are_forgotten(arrive):
    days = 24 * 60
    _, stream = arrive(STATUS, [(1, 1, "delivered", at(0))], [(2, 2, "pending", at(5 * days))],
                       [(3, 3, "pending", at(5 * days))], [(1, 4, "confirmed", at(5 * days))])
    got = run_to_table(lc.order_lifecycle(stream, buckets=1)).collect()
    assert {r.event_id: (r.prev_status, r.accepted) for r in got}[4] == (None, True)


def test_deadlines(arrive):
    second = datetime.timedelta(seconds=1)
    batches = [
        [(1, 1, "pending", at(0)),  # never confirmed
         (2, 2, "pending", at(0)), (3, 4, "pending", at(0))],
        [(2, 3, "confirmed", at(19)),  # just in time; never delivered
         (3, 5, "confirmed", at(19) + second)],  # one second late
        [(3, 6, "delivered", at(58))],
        [(4, 7, "pending", at(300))],  # moves the clock; its own deadline is not over
        [(4, 8, "confirmed", at(301))],
    ]
    expected = [(1, "pending", at(19)), (2, "confirmed", at(58)), (3, "pending", at(19))]
    for split in (batches, [sum(batches, [])]):
        _, stream = arrive(STATUS, *split)
        got = run_to_table(lc.sla_timeouts(stream)).collect()
        assert sorted((r.entity_id, r.phase, r.alert_ts) for r in got) == expected


def test_guarded_ledger(arrive):
    rows = [(1, 1, 1, "restock", 30, at(0)), (1, 1, 2, "sale", -8, at(1)), (1, 1, 3, "sale", -3, at(2)),
            (1, 1, 4, "sale", -40, at(3)), (1, 1, 5, "adjustment", -50, at(4)), (1, 1, 6, "return", 2, at(5)),
            (2, 1, 7, "sale", -1, at(6))]
    expected = [(1, 30, "ok", False), (2, 22, "ok", False), (3, 19, "ok", True), (4, 19, "insufficient_stock", False),
                (5, 0, "clamped", False), (6, 2, "ok", False), (7, 0, "insufficient_stock", False)]
    for batches in ([rows[::-1]], [rows[:3], rows[3:4], rows[4:]]):
        _, stream = arrive(MOVE, *batches)
        got = run_to_table(lg.stock_ledger(stream)).collect()
        assert sorted((r.id, r.quantity_after, r.result, r.low_stock) for r in got) == expected


def test_upsert_is_idempotent_and_resumes(arrive, spark):
    folder, stream = arrive(MOVE, [(1, 1, 1, "restock", 5, at(0))], [(1, 1, 2, "sale", -2, at(1)), (1, 2, 3, "restock", 7, at(1))])
    run = new_folder(spark, "upsert")
    first = {tuple(r) for r in lg.upsert_inventory(stream, run).collect()}
    assert first == {(1, 1, 3), (1, 2, 7)}
    _, more = arrive(MOVE, [(1, 2, 4, "sale", -1, at(2))], folder=folder)
    assert {tuple(r) for r in lg.upsert_inventory(more, run).collect()} == {(1, 1, 3), (1, 2, 6)}
    # A replayed batch overwrites its own partition.
    spark.createDataFrame([(1, 2, -1)], "store_id INT, product_id BIGINT, delta BIGINT").write.mode("overwrite").parquet(
        f"{run}/stock/batch_id=2")
    assert {tuple(r) for r in lg.stock_table(spark, run).collect()} == {(1, 1, 3), (1, 2, 6)}


def test_late_rows_can_be_refused(arrive):
    _, stream = arrive(ev.EVENTS, [event(1, 500)], [event(2, 10), event(3, 600)], [event(4, 20)])
    with pytest.raises(LateRows):
        run_to_table(ev.hourly_counts(stream), refuse_late=True)


def stored_by_id(spark, rows, schema, files=4):
    """Rows in files by id, in no order of time."""
    folder = new_folder(spark, "by-id")
    df = spark.createDataFrame(rows, schema)
    df.repartition(files, schema.split()[0] if schema is ev.EVENTS else "event_id").write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_replay_does_not_depend_on_files_or_slices(spark, slices):
    events = [event(i, (i * 37) % 1500, user=i % 3) for i in range(300)]
    df = stored_by_id(spark, events, ev.EVENTS)
    got = {(r.window_start, r.n) for r in replay_to_table(df, "ts", ev.hourly_counts, slices).collect()}
    want: dict = {}
    last = max(e[1] for e in events)
    for e in events:
        hour = e[1].replace(minute=0)
        if hour + datetime.timedelta(minutes=70) <= last:
            want[hour] = want.get(hour, 0) + 1
    assert got == set(want.items())
    assert replay_to_table(df, "ts", ev.dedup_events, slices).count() == 300


@pytest.mark.parametrize("slices", [1, 4])
def test_replayed_lifecycle(spark, slices):
    rows = []
    for e in range(40):
        for k, status in enumerate(("pending", "delivered", "confirmed", "delivered")):
            rows.append((e, e * 10 + k, status, at(e * 3 + k * 20)))
    df = stored_by_id(spark, rows, STATUS)
    got = replay_to_table(df, "ts", lc.order_lifecycle, slices).collect()
    assert sorted((r.event_id, r.accepted) for r in got) == [(e * 10 + k, k != 1) for e in range(40) for k in range(4)]


def test_time_slices_follow_each_other(spark):
    rows = [(i, at(i // 5) if i % 11 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id BIGINT, ts TIMESTAMP_NTZ")
    parts = [p.collect() for p in time_slices(df, "ts", 6)]
    assert sorted(r.id for p in parts for r in p) == list(range(200)) and len(parts) == 6
    times = [[r.ts for r in p if r.ts] for p in parts]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
    assert all(r.ts is not None for p in parts[1:] for r in p)
    assert [p.count() for p in time_slices(df.limit(0), "ts", 3)] == [0]


def test_stock_versions(arrive, spark):
    """A version every two batches; a replayed batch changes nothing."""
    batches = [[(1, 1, i, "restock", i, at(i))] for i in range(1, 6)]
    _, stream = arrive(MOVE, *batches)
    run = new_folder(spark, "versions")
    assert {tuple(r) for r in lg.upsert_inventory(stream, run, compact_after=2).collect()} == {(1, 1, 15)}
    assert {r.upto for r in spark.read.parquet(f"{run}/version").collect()} == {1, 3}
    assert lg.stock_table(spark, run, 2).first().stock == 6
    lg.stock_table(spark, run, 3).write.mode("overwrite").parquet(f"{run}/version/upto=3")
    assert lg.stock_table(spark, run).first().stock == 15


def state_bytes(folder):
    """Bytes of the changes that each micro-batch left in the state store's checkpoint."""
    out: dict = {}
    for f in Path(folder.removeprefix("file://")).glob("checkpoint/state/*/*/**/*.changelog"):
        version = int(f.name.split(".")[0].split("_")[0])
        out[version] = out.get(version, 0) + f.stat().st_size
    return [out[v] for v in sorted(out)]


def test_a_batch_writes_the_pairs_it_moves(arrive, spark):
    """However many pairs there are."""
    written = {}
    for pairs in (50, 2000):
        _, stream = arrive(MOVE, [(1, p, p, "restock", 9, at(0)) for p in range(pairs)], [(1, 7, 9999, "sale", -2, at(1))])
        run = new_folder(spark, "run")
        got = {r.id: r.quantity_after for r in run_to_table(lg.stock_ledger(stream), run).collect()}
        assert got[9999] == 7 and len(got) == pairs + 1
        written[pairs] = state_bytes(run)
    assert written[2000][0] > 5 * written[50][0] and written[2000][1] < 1.5 * written[50][1]


def plain_alerts(rows, end):
    out, known = [], {}
    phases = (("pending", 19), ("confirmed", 58))

    def judge(e, now):
        status, created, n = known[e]
        while n < 2 and created + datetime.timedelta(minutes=phases[n][1]) < now:
            if status == phases[n][0]:
                out.append((e, status, created + datetime.timedelta(minutes=phases[n][1])))
            n += 1
        known[e][2] = n

    for e, _, status, ts in sorted(rows, key=lambda r: (r[3], r[1])):
        if e in known:
            judge(e, ts)
            known[e][0] = status
        elif status == "pending":
            known[e] = [status, ts, 0]
    for e in known:
        judge(e, end)
    return sorted(out)


def test_deadlines_equal_a_fold_over_restarts(arrive, spark):
    """Each file is a run of its own: timers live on in the checkpoint, also between two deadlines of an entity."""
    rng = random.Random(3)
    rows = []
    for e in range(60):
        t = e * 4
        for k, status in enumerate(("pending", "confirmed", "delivered")[:rng.randint(1, 3)]):
            rows.append((e, e * 10 + k, status, at(t)))
            t += rng.choice([3, 18, 19, 20, 45, 70])
    rows.sort(key=lambda r: (r[3], r[1]))
    rows.append((999, 9999, "delivered", at(1000)))  # moves the clock only
    run, folder = new_folder(spark, "run"), None
    for i in range(0, len(rows), 40):
        folder, stream = arrive(STATUS, rows[i:i + 40], folder=folder)
        got = run_to_table(lc.sla_timeouts(stream), run)
    assert sorted((r.entity_id, r.phase, r.alert_ts) for r in got.collect()) == plain_alerts(rows, at(990))


@pytest.mark.parametrize("bits_per_id", [1, 16])
def test_ids_are_taken_once_over_any_distance(arrive, bits_per_id):
    """Against a plain set, with filters that are nearly always wrong too; merges every three batches."""
    rng = random.Random(5)
    batches = [[event(rng.randint(0, 150), b * 50_000 + rng.randint(0, 99), user=rng.randint(1, 5)) for _ in range(40)] for b in range(8)]
    batches[2] += [(None, at(1), 1, "view", 1.0, "{}")] * 3
    batches[6] += [(None, at(1), 1, "view", 1.0, "{}")]
    want, seen = [], set()
    for batch in batches:
        for row in sorted(batch, key=lambda r: (r[1], r[2])):
            if row[0] is None or row[0] not in seen:
                want.append(row)
                seen.add(row[0])
    _, stream = arrive(ev.EVENTS, *batches)
    run = new_folder(stream.sparkSession, "intake")
    got = intake.take_once(stream, run, buckets=4, compact_after=3, bits_per_id=bits_per_id)
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert tuple(newest_mark(stream.sparkSession, f"{run}/marks")) == (7, 5)


def test_a_batch_looks_up_what_the_filters_may_hold(arrive, spark):
    """A repeat from the first of six batches is looked up there and nowhere else."""
    batches = [[event(b * 1000 + i, b * 1000 + i) for i in range(300)] for b in range(6)]
    _, stream = arrive(ev.EVENTS, *batches)
    run = new_folder(spark, "intake")
    assert intake.take_once(stream, run, buckets=4, compact_after=4).count() == 1800
    last = newest_mark(spark, f"{run}/marks")
    fresh = spark.createDataFrame([event(7, 99), event(5007, 99), event(77_777, 99)], ev.EVENTS)
    got = {tuple(r) for r in intake.candidates(fresh, run, "event_id", 4, last).collect()}
    assert got == {(7, 0, 3), (5007, 5, 5)}
    hashes = np.random.Generator(np.random.PCG64(1)).integers(-2**62, 2**62, 40_000)
    bits = intake.bloom(hashes[:20_000])
    assert intake.may_hold(bits, hashes[:20_000]).all() and intake.may_hold(bits, hashes[20_000:]).mean() < 0.002


def stopped(monkeypatch, module, at_batch):
    """Lets the batch stop after all it writes, before its mark."""
    real = module.mark

    def stop(spark, folder, number, version=-1):
        if number == at_batch:
            raise RuntimeError("lost")
        real(spark, folder, number, version)

    monkeypatch.setattr(module, "mark", stop)


def test_a_batch_that_stops_is_not_seen_and_comes_again(arrive, spark, monkeypatch):
    moves = [[(1, 1, i, "restock", i, at(i))] for i in range(1, 6)]
    folder, stream = arrive(MOVE, *moves)
    run = new_folder(spark, "stops")
    with monkeypatch.context() as m:
        stopped(m, lg, 3)  # while it writes a version
        with pytest.raises(StreamingQueryException):
            lg.upsert_inventory(stream, run, compact_after=2)
    assert lg.stock_table(spark, run).first().stock == 6 and (Path(run.removeprefix("file://")) / "version/upto=3").exists()
    assert lg.upsert_inventory(stream, run, compact_after=2).first().stock == 15
    assert lg.stock_table(spark, new_folder(spark, "none")).collect() == []

    batches = [[event(1, 0), event(2, 1)], [event(2, 2), event(3, 3)], [event(3, 4), event(4, 5), event(1, 6)]]
    _, stream = arrive(ev.EVENTS, *batches)
    run = new_folder(spark, "stops")
    with monkeypatch.context() as m:
        stopped(m, intake, 1)
        with pytest.raises(StreamingQueryException):
            intake.take_once(stream, run, buckets=2)
    assert {r.event_id for r in intake.taken(spark, run, stream.schema).collect()} == {1, 2}
    assert sorted(r.event_id for r in intake.take_once(stream, run, buckets=2).collect()) == [1, 2, 3, 4]


def test_a_restart_after_the_expiry_forgets(arrive, spark):
    """49 hours later the entities not seen since have left the state; the store itself is read."""
    run, hours = new_folder(spark, "run"), 60
    first = [(e, e, "pending", at(e)) for e in range(1, 9)] + [(9, 9, "pending", at(40 * hours))]
    folder, stream = arrive(STATUS, first)
    run_to_table(lc.order_lifecycle(stream, buckets=1), run)
    held = lambda: {e for r in stored_state(spark, run).selectExpr("value.groupState.entity AS e").collect() for e in r.e}
    assert held() == set(range(1, 10))
    later = [[(20 + i, 20 + i, "pending", at(49 * hours + i))] for i in range(2)]
    folder, stream = arrive(STATUS, *later, folder=folder)
    run_to_table(lc.order_lifecycle(stream, buckets=1), run)
    assert held() == {9, 20, 21}

    run = new_folder(spark, "run")
    folder, stream = arrive(STATUS, [(1, 1, "pending", at(0)), (2, 2, "pending", at(100)), (3, 3, "delivered", at(5))])
    run_to_table(lc.sla_timeouts(stream), run)
    watched = lambda: {r.e for r in stored_state(spark, run, "watched").selectExpr("key.entity_id AS e").collect()}
    assert watched() == {2}  # the clock stands at 90: both deadlines of 1 have passed, 3 never began
    folder, stream = arrive(STATUS, [(9, 90, "delivered", at(300))], folder=folder)
    run_to_table(lc.sla_timeouts(stream), run)
    assert watched() == set()


def test_deadlines_are_kept_by_bucket(arrive, spark):
    """Two state rows and two timers serve 200 entities; NULL is an entity like others."""
    rows = [(e if e else None, e, "pending", at(e % 5)) for e in range(200)]
    _, stream = arrive(STATUS, rows, [(999, 999, "delivered", at(100))])
    run = new_folder(spark, "run")
    got = run_to_table(lc.sla_timeouts(stream, buckets=2), run).collect()
    assert sorted((r.entity_id or 0, r.phase, r.alert_ts) for r in got) == [(e, "pending", at(e % 5 + 19)) for e in range(200)]

    run = new_folder(spark, "run")
    _, stream = arrive(STATUS, rows)
    run_to_table(lc.sla_timeouts(stream, buckets=2), run)
    raw = spark.read.format("statestore").option("path", f"{run}/checkpoint").option("stateVarName", "watched").load()
    assert raw.count() == 2 and stored_state(spark, run, "watched").count() == 200


def test_ledger_keeps_a_log_by_bucket(arrive, spark):
    """The log of a bucket has the moved pairs of each batch, is written anew when long, and takes NULL as a store or product."""
    batches = [[(1 if p else None, p or None, 100 * b + p, "restock", 1, at(b)) for p in range(40)] for b in range(7)]
    batches.append([(1, 7, 9999, "sale", -9, None), (1, 8, 9998, "sale", -7, at(9))])
    _, stream = arrive(MOVE, *batches)
    run = new_folder(spark, "run")
    got = {r.id: (r.store_id, r.product_id, r.quantity_after, r.result) for r in run_to_table(lg.stock_ledger(stream, buckets=1), run).collect()}
    want = {100 * b + p: (1 if p else None, p or None, b + 1, "ok") for b in range(7) for p in range(40)}
    assert got == want | {9999: (1, 7, 7, "insufficient_stock"), 9998: (1, 8, 0, "ok")}
    entries = stored_state(spark, run, "stock").select("value.*").collect()
    assert 41 <= len(entries) < 2 * 40 + 64 + 41 and {r.product_id for r in entries} == {None, *range(1, 40)}
    assert (1, 8, 0) in {tuple(r) for r in entries}
