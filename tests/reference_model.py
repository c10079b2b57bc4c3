"""Row-by-row models of the contracts, for small fixtures only."""

from __future__ import annotations

from collections import Counter


def window_ends(ts, size, slide):
    """Ends of the windows [start, start + size), start a multiple of slide, that hold ts."""
    start = ts // slide * slide
    ends = []
    while start > ts - size:
        ends.append(start + size)
        start -= slide
    return sorted(ends)


def counts(rows, size, slide):
    """(key, ts) rows -> {(key, end): count}."""
    return Counter((key, end) for key, ts in rows for end in window_ends(ts, size, slide))


def ranked(counted, n):
    """{(key, end): count} -> {(key, end, count, rank)}."""
    result = set()
    for window in {end for _, end in counted}:
        best = sorted((-count, key) for (key, end), count in counted.items() if end == window)
        result |= {(key, window, -minus, rank) for rank, (minus, key) in enumerate(best[:n], 1)}
    return result


def watermarks(rows, delay):
    """(key, ts, arrival, id) rows -> [(row, watermark)] in arrival order."""
    tagged, highest = [], None
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        tagged.append((row, None if highest is None else highest - delay))
        highest = row[1] if highest is None else max(highest, row[1])
    return tagged


def replay(rows, size, slide, delay, after):
    """Counts of the windows that were not yet closed (end + after) when a row came."""
    return Counter(
        (key, end)
        for (key, ts, _, _), wm in watermarks(rows, delay)
        for end in window_ends(ts, size, slide)
        if wm is None or wm < end + after)


def late(rows, size, slide, delay, lateness):
    """Ids of the rows that are lost for their last window."""
    return {
        row[3]
        for row, wm in watermarks(rows, delay)
        if window_ends(row[1], size, slide) and wm is not None
        and wm >= window_ends(row[1], size, slide)[-1] - 1 + lateness}
