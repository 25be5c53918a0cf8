"""The order state machine and its deadlines over a stream of status rows.

Both keep state per hash bucket of entities: one Python call then serves the thousands of entities of a bucket. A bucket of
deadlines has one timer, for the earliest of them. Entities leave the state when they can no longer matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stockaudit.functions.parameters import CONFIRM_LIMIT_MINUTES, DELIVER_LIMIT_MINUTES, STALE_HOURS
from stockaudit.schemas import ALLOWED_TRANSITIONS
from stockaudit.streaming.runs import WATERMARK, keyed_state, zoned

BUCKETS_PER_PARTITION = 16


def default_buckets(df: DataFrame) -> int:
    """Hash buckets in proportion to the cluster: some for each shuffle partition."""
    return BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(*keys: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def in_order(pages: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """The rows a bucket got in this micro-batch; the size of a slice bounds them."""
    return pd.concat(list(pages)).sort_values(order, kind="stable")


def order_lifecycle(
    statuses: DataFrame, moves: tuple[tuple[str, str], ...] = ALLOWED_TRANSITIONS, buckets: int | None = None,
    ttl_hours: int = STALE_HOURS, watermark: str = WATERMARK,
) -> DataFrame:
    """Judge each status row (entity_id, event_id, status, ts) against the last accepted status.

    A rejected row leaves the state as it was. The first row of an entity is always accepted, and an
    entity is forgotten once the watermark is ``ttl_hours`` past its last row.
    """
    legal = frozenset(moves)
    buckets = buckets or default_buckets(statuses)
    ttl_ms = ttl_hours * 3_600_000

    def judge(key, pages, state: GroupState):
        known = {e: (s, ms) for e, s, ms in zip(*state.get, strict=True)} if state.exists else {}
        rows = in_order(pages, ["ms", "event_id"])
        before, verdicts = [], []
        for entity, status, ms in zip(rows["entity_id"].tolist(), rows["status"].tolist(), rows["ms"].tolist(),
                                      strict=True):
            current = known[entity][0] if entity in known else None
            ok = current is None or (current, status) in legal
            before.append(current)
            verdicts.append(ok)
            known[entity] = (status if ok else current, ms)
        oldest = state.getCurrentWatermarkMs() - ttl_ms
        kept = [(e, s, ms) for e, (s, ms) in known.items() if ms >= oldest]
        state.update(tuple(list(column) for column in zip(*kept, strict=True)) if kept else ([], [], []))
        yield pd.DataFrame({"entity_id": rows["entity_id"].to_numpy(), "event_id": rows["event_id"].to_numpy(),
                            "prev_status": before, "status": rows["status"].to_numpy(), "accepted": verdicts})

    rows = zoned(statuses, "ts").withWatermark("ts", watermark).select(
        bucket_of("entity_id", buckets=buckets), "entity_id", "event_id", "status", "ts",
        F.unix_millis("ts").alias("ms"))
    return rows.groupBy("bucket").applyInPandasWithState(
        judge, "entity_id BIGINT, event_id BIGINT, prev_status STRING, status STRING, accepted BOOLEAN",
        "entity ARRAY<BIGINT>, status ARRAY<STRING>, seen ARRAY<BIGINT>", "append", GroupStateTimeout.NoTimeout)


class Deadlines(StatefulProcessor):
    """The entities of a bucket that have a deadline ahead, as columns, and a timer for the earliest of these deadlines."""

    def __init__(self, phases: tuple[tuple[str, int], ...]):
        self.phases = phases  # (status, milliseconds after creation), in the order of the deadlines

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.watched = handle.getValueState(
            "watched", "entity_id ARRAY<BIGINT>, status ARRAY<STRING>, created ARRAY<BIGINT>, judged ARRAY<INT>")

    def _judge(self, entity: int, status: str, created: int, judged: int, now_ms: int) -> tuple[list[Row], int]:
        """Alerts for the deadlines that passed before ``now_ms``, and the number of deadlines judged."""
        alerts = []
        while judged < len(self.phases) and created + self.phases[judged][1] < now_ms:
            if status == self.phases[judged][0]:
                alerts.append(Row(entity_id=entity, phase=status, alert_ms=created + self.phases[judged][1]))
            judged += 1
        return alerts, judged

    def _first(self, known: dict) -> int | None:
        """When the earliest deadline has passed."""
        return min((created + self.phases[judged][1] + 1 for _, created, judged in known.values()), default=None)

    def _fold(self, rows: Iterator[Row], now_ms: int) -> Iterator[Row]:
        """Takes the rows, judges the bucket's entities as of ``now_ms`` and keeps those with a deadline ahead."""
        held = self.watched.get()
        known = {e: rest for e, *rest in zip(*held, strict=True)} if held else {}
        before, timer = {e: tuple(rest) for e, rest in known.items()}, self._first(known)
        seen = {}  # the rows a bucket got in this micro-batch; the size of a slice bounds them
        for r in rows:
            seen.setdefault(r.entity_id, []).append((r.ms, r.event_id, r.status))
        for entity, steps in seen.items():
            now = known.get(entity)
            for ms, _, status in sorted(steps):
                if now is not None:
                    alerts, judged = self._judge(entity, *now, ms)
                    yield from alerts
                    now = (status, now[1], judged)
                elif status == "pending":
                    now = (status, ms, 0)
            if now is not None:
                known[entity] = now
        ahead = {}
        for entity, (status, created, judged) in known.items():
            alerts, judged = self._judge(entity, status, created, judged, now_ms)
            yield from alerts
            if judged < len(self.phases):
                ahead[entity] = (status, created, judged)
        if ahead == before:
            return
        if ahead:
            self.watched.update((list(ahead), *map(list, zip(*ahead.values(), strict=True))))
        else:
            self.watched.clear()
        first = self._first(ahead)
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._fold(rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._fold(iter(()), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def sla_timeouts(
    statuses: DataFrame, confirm_minutes: int = CONFIRM_LIMIT_MINUTES, deliver_minutes: int = DELIVER_LIMIT_MINUTES,
    watermark: str = WATERMARK, buckets: int | None = None,
) -> DataFrame:
    """Alerts for entities still pending, or still confirmed, at their deadline after creation.

    A deadline is judged by the status at that moment, as soon as a later row or the watermark shows that the moment
    has passed: each hash bucket of entities has a timer for its earliest deadline. After its last deadline an entity leaves
    the state.
    """
    minute = 60_000
    rows = zoned(statuses, "ts").withWatermark("ts", watermark).select(
        bucket_of("entity_id", buckets=buckets or default_buckets(statuses)), "entity_id", "event_id", "status", "ts", F.unix_millis("ts").alias("ms"))
    keyed_state(rows.sparkSession)
    alerts = rows.groupBy("bucket").transformWithState(
        Deadlines((("pending", confirm_minutes * minute), ("confirmed", deliver_minutes * minute))),
        "entity_id BIGINT, phase STRING, alert_ms BIGINT", "append", "eventTime")
    return alerts.select("entity_id", "phase", F.timestamp_millis("alert_ms").alias("alert_ts"))
