"""Counts of open windows as per-key state with event-time timers.

The state of a key is a map: at which window end its running count changes, and by how
much. A batch writes only the entries it changes and reads only the keys it touches. A
timer fires when the watermark passes the next window that has something to tell; once
no window can change any more, the state of a key is gone.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wavecount.operators.lateness import FIRST_RANKING

#: Columns of the input beside the key; ``passed`` carries the watermark.
SPANS = "first_end bigint, last_end bigint, n bigint, passed timestamp"


class OpenWindows(StatefulProcessor):
    """Counts per window of one key.

    With ``on_close`` a window's count comes out when the watermark reaches its end plus
    ``first``, and again whenever a later row changes it. Without, it comes out in every
    batch that changes it. A window is forgotten at its end plus ``after``.
    """

    def __init__(self, key: str, size: int, slide: int, after: int, on_close: bool, first: int = FIRST_RANKING):
        self.key, self.size, self.slide, self.after, self.on_close, self.first = key, size, slide, after, on_close, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getMapState("changes", "at bigint", "delta bigint")
        self.told = handle.getValueState("told", "until bigint, timer bigint")  # windows up to here are out; the next timer

    def _reached(self, ms: int) -> int:
        """The largest window end that is not above ``ms``."""
        return (ms - self.size) // self.slide * self.slide + self.size

    def _row(self, key: Any, end: int, count: int, watermark: int) -> Row:
        return Row(**{self.key: key, "window_end": end, "cnt": count, "watermark_ms": watermark})

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        added: dict[int, int] = {}
        spans = set()
        for r in rows:
            if r["n"]:
                first, stop = r["first_end"], r["last_end"] + self.slide
                added[first] = added.get(first, 0) + r["n"]
                added[stop] = added.get(stop, 0) - r["n"]
                spans.add((first, stop))
        if not spans:
            return
        changes = {at[0]: delta[0] for at, delta in self.changes.iterator()} if self.changes.exists() else {}
        for at, delta in added.items():
            changes[at] = changes.get(at, 0) + delta
            if changes[at]:
                self.changes.updateValue((at,), (changes[at],))
            elif self.changes.containsKey((at,)):
                self.changes.removeKey((at,))
                del changes[at]
        watermark = timerValues.getCurrentWatermarkInMs()
        state = self.told.get()
        told, timer = (state[0], state[1]) if state else (None, None)
        touched = sorted({end for first, stop in spans for end in range(first, stop, self.slide)
                          if not self.on_close or (told is not None and end <= told)})
        ends = sorted(changes)
        counts = list(accumulate(changes[at] for at in ends))
        for end in touched:
            place = bisect_right(ends, end) - 1
            yield self._row(key[0], end, counts[place] if place >= 0 else 0, watermark)
        self._wait(changes, told, timer)

    def _wait(self, changes: dict[int, int], told: int | None, timer: int | None) -> None:
        """Have a timer at the next window that has something to tell, or where the last one is forgotten."""
        ends = sorted(changes)
        wanted = ends[-1] - self.slide + self.after
        if self.on_close:
            count = 0
            for at, until in zip(ends, ends[1:], strict=False):
                count += changes[at]
                if count and (told is None or until - self.slide > told):
                    wanted = min(wanted, max(at, at if told is None else told + self.slide) + self.first)
                    break
        if timer is None or wanted < timer:
            self.handle.registerTimer(max(wanted, 1))
            timer = wanted
        self.told.update((told, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if not self.changes.exists():
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        changes = {at[0]: delta[0] for at, delta in self.changes.iterator()}
        state = self.told.get()
        told = state[0] if state else None
        ends = sorted(changes)
        if self.on_close:
            closed, count = self._reached(watermark - self.first), 0
            for at, until in zip(ends, ends[1:], strict=False):
                count += changes[at]
                if count:
                    start = at if told is None else max(at, told + self.slide)
                    for end in range(start, min(until, closed + self.slide), self.slide):
                        yield self._row(key[0], end, count, watermark)
            told = closed if told is None else max(told, closed)
        needed = self._reached(watermark - self.after) + self.slide  # the first window that may still change
        if needed >= ends[-1]:
            self.changes.clear()
            self.told.clear()
            return
        past = [at for at in ends if at <= needed]
        if len(past) > 1:
            left = sum(changes.pop(at) for at in past)
            for at in past:
                self.changes.removeKey((at,))
            if left:
                changes[needed] = left
                self.changes.updateValue((needed,), (left,))
        self._wait(changes, told, None)

    def close(self) -> None:
        pass


def window_counts(spans: DataFrame, key: str, size: int, slide: int, after: int, on_close: bool) -> DataFrame:
    """key, window_end, cnt, watermark_ms from a stream of ``key`` and ``SPANS``."""
    key_type = spans.schema[key].dataType.simpleString()
    return spans.withWatermark("passed", "0 seconds").groupBy(key).transformWithState(
        OpenWindows(key, size, slide, after, on_close), f"{key} {key_type}, window_end bigint, cnt bigint, watermark_ms bigint",
        "update", "eventTime")
