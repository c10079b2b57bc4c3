"""Most requested pages: ten-minute windows every five seconds, with late data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.functions.eventtime import MINUTE, SECOND
from wavecount.operators.filters import keep_page_requests
from wavecount.operators.lateness import (
    ALLOWED_LATENESS,
    BOUNDED_DELAY,
    FIRST_COUNT,
    FIRST_RANKING,
    late_rows,
    lost_after,
    open_spans,
    window_closings,
)
from wavecount.operators.ranking import TOP_N, page_report, top_n
from wavecount.operators.windows import count_spans, sliding_counts

# The window of the page ranking.
SIZE = 10 * MINUTE
SLIDE = 5 * SECOND


def page_counts(requests: DataFrame, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """url, window_end, cnt of all page requests, whenever they arrived."""
    return sliding_counts(keep_page_requests(requests), ["url"], F.unix_millis("ts"), size, slide)


def hot_pages(requests: DataFrame, n: int = TOP_N, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """url, window_end, cnt, row_num: the ``n`` most requested pages of each window."""
    return top_n(page_counts(requests, size, slide), "url", n)


def hot_pages_report(requests: DataFrame, n: int = TOP_N, zone: str = "UTC") -> DataFrame:
    """window_end and the printed text of each window's ranking."""
    return page_report(hot_pages(requests, n), zone)


@dataclass(frozen=True)
class Replay:
    """Counts, rankings and late rows of input that is replayed in arrival order.

    ``stream`` holds every row that moves the watermark, ``rows`` those of them
    that are counted. ``order`` is the arrival order, ``ts_ms`` the event time;
    both exist in either table.
    """

    stream: DataFrame
    rows: DataFrame
    key: str
    order: Column
    ts_ms: Column
    size: int = SIZE
    slide: int = SLIDE
    delay: int = BOUNDED_DELAY
    lateness: int = ALLOWED_LATENESS
    _known: dict[int, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def _closings(self, after: int) -> DataFrame:
        """The closing points, computed once for all outputs that share them."""
        if after not in self._known:
            self._known[after] = window_closings(
                self.stream, self.order, self.ts_ms, self.size, self.slide, self.delay, after)
        return self._known[after]

    def _counts(self, after: int) -> DataFrame:
        spans = open_spans(self.rows, [self.key], self.order, self.ts_ms, self.size, self.slide,
                           self._closings(after))
        return count_spans(spans, [self.key], self.size, self.slide)

    def counts_on_time(self) -> DataFrame:
        """Counts as first emitted, when the watermark passes the window."""
        return self._counts(FIRST_COUNT)

    def counts_final(self) -> DataFrame:
        """Counts after the last refinement."""
        return self._counts(lost_after(self.lateness))

    def top_n_on_time(self, n: int = TOP_N) -> DataFrame:
        """The first ranking of each window; made just after the first counts."""
        return top_n(self._counts(FIRST_RANKING), self.key, n)

    def top_n_final(self, n: int = TOP_N) -> DataFrame:
        """The ranking after the last refinement."""
        return top_n(self.counts_final(), self.key, n)

    def late(self) -> DataFrame:
        """Rows that no window took."""
        return late_rows(self.rows, self.order, self.ts_ms, self.size, self.slide,
                         self._closings(lost_after(self.lateness)))


def replay_requests(requests: DataFrame, order: Column, **settings: int) -> Replay:
    """The page ranking over parsed log rows; dropped requests still move the watermark."""
    return Replay(requests, keep_page_requests(requests), "url", order, F.unix_millis("ts"), **settings)
