"""ANSI SQL for every query, written from the contracts and not from the Spark plans."""

from __future__ import annotations

# Milliseconds are floored; epoch_ms() would round.
_MS = "epoch_us(ts) // 1000"
_K = "cast(regexp_extract(props, '([0-9]+)', 1) as bigint)"
_SEC = f"({_MS}) // 1000"

_BEHAVIOR = f"""
    select event_id as user_id, user_id as item_id, cast({_K} as integer) as category_id,
           case when event_type = 'view' then 'pv' else event_type end as behavior, {_SEC} as ts_sec
    from events
"""

_METHOD = "case when event_type in ('view', 'click') then 'GET' when event_type = 'signup' then 'get' else 'POST' end"
_URL = f"""'/u/' || (user_id % 20) || case {_K} % 6 when 0 then '' when 1 then '.html' when 2 then '.css'
           when 3 then '.js' when 4 then '.png' else '.PNG' end"""

_LOG = f"""
    select event_id, '10.0.0.1' as ip, '-' as user_id, {_SEC} * 1000 as ts_ms, {_METHOD} as method, {_URL} as url
    from events
"""

# Fields out of range carry over: months first, then days, then the time of day.
_ROLLED_LOG = f"""
    select event_id, '10.0.0.1' as ip, '-' as user_id, {_METHOD} as method, {_URL} as url,
           epoch_us(make_timestamp(2012 + {_K} % 9, 1, 1, 0, 0, 0) + to_months(cast(event_id % 29 - 3 as integer))
               + to_days(cast(event_id % 64 - 2 as integer)) + to_hours(user_id % 30) + to_minutes({_K} % 70)
               + to_seconds(user_id % 90)) // 1000 as ts_ms
    from events
"""

_DENSE_LOG = f"""
    select event_id, '10.0.0.1' as ip, '-' as user_id, ({_MS}) // 100 // 1000 * 1000 as ts_ms,
           ({_MS}) // 100 + {_K} * 9000 as arrival_ms, {_METHOD} as method, {_URL} as url
    from events
"""

_DENSE = f"""
    select event_id, user_id % 20 as page, ({_MS}) // 100 as ts_ms,
           ({_MS}) // 100 + {_K} * 9000 as arrival_ms
    from events
"""

_VERY_LATE = f"select event_id, {_MS} as ts_ms, {_MS} + {_K} * 60000 as arrival_ms from events"

_KEPT = "lower(method) = 'get' and not regexp_matches(url, '\\.(css|js|jpg|png|ico)$')"


def _with_watermark(rows: str, delay: int) -> str:
    return f"""
        select *, max(ts_ms) over (order by arrival_ms, event_id
            rows between unbounded preceding and 1 preceding) - {delay} as watermark
        from ({rows})
    """


def _exploded(rows: str, columns: str, size: int, slide: int) -> str:
    return f"""
        select {columns}, unnest(range(ts_ms // {slide} * {slide} + {slide},
                                       ts_ms // {slide} * {slide} + {size} + 1, {slide})) as window_end
        from ({rows})
    """


def _counts(rows: str, key: str, size: int, slide: int, taken: str | None = None) -> str:
    columns = f"{key}, watermark" if taken else key
    where = f"where watermark is null or {taken}" if taken else ""
    return f"""
        select {key}, window_end, count(*) as cnt
        from ({_exploded(rows, columns, size, slide)}) {where}
        group by {key}, window_end
    """


def _top(counts: str, key: str, n: int = 5) -> str:
    return f"""
        select * from (
            select *, cast(row_number() over (partition by window_end order by cnt desc, {key}) as integer) as row_num
            from ({counts})
        ) where row_num <= {n}
    """


_ITEM = "item_id", 3_600_000, 300_000
_PAGE = "url", 600_000, 5_000

_VIEWS = f"select item_id, ts_sec * 1000 as ts_ms from ({_BEHAVIOR}) where behavior = 'pv'"
_ITEM_COUNTS = _counts(_VIEWS, *_ITEM)
_HOT_ITEMS = _top(_ITEM_COUNTS, "item_id")

_PAGE_VIEWS = f"""
    select 'pv' as metric, ts_sec // 3600 * 3600000 + 3600000 as window_end, count(*) as cnt
    from ({_BEHAVIOR}) group by all
"""

_REQUESTS = f"select * from ({_LOG}) where {_KEPT}"
_PAGE_COUNTS = _counts(_REQUESTS, *_PAGE)
_HOT_PAGES = _top(_PAGE_COUNTS, "url")

_DENSE_WM = _with_watermark(_DENSE, 1000)
_DENSE_REQUESTS = f"select * from ({_with_watermark(_DENSE_LOG, 1000)}) where {_KEPT}"

_ON_TIME = "watermark < window_end - 1"
_RANKED_FIRST = "watermark < window_end + 1"
_NOT_LOST = "watermark < window_end - 1 + 60000"
_LATE = "ts_ms // 5000 * 5000 + 600000 - 1 + 60000 <= watermark"


def _report(top: str, line: str, tail: str) -> str:
    return f"""
        select window_end,
               repeat('=', 36) || chr(10) || '窗口结束时间：'
               || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S.0') || chr(10)
               || string_agg('NO ' || row_num || ':' || {line} || chr(10), '' order by row_num)
               || repeat('=', 36) || {tail} as report
        from ({top}) group by window_end
    """


# The dense log with the watermark that the drops before a row's own have left.
_DROPPED = f"""
    with log as (select *, arrival_ms // 2400000 as drop_id from ({_DENSE_LOG})),
    passed as (
        select drop_id, max(max(ts_ms)) over (order by drop_id
            rows between unbounded preceding and 1 preceding) - 1000 as watermark
        from log group by drop_id
    )
    select log.*, watermark from log join passed using (drop_id)
"""
_DROPPED_REQUESTS = f"select * from ({_DROPPED}) where {_KEPT}"


def _changes_by_drop() -> str:
    """What each drop of three days changes in the ranking of all rows so far."""
    return f"""
        with rows as (select item_id, ts_sec * 1000 as ts_ms, ts_sec * 1000 // 259200000 as drop_id
                      from ({_BEHAVIOR}) where behavior = 'pv'),
        drops as (select distinct ts_sec * 1000 // 259200000 as drop_id from ({_BEHAVIOR})),
        numbered as (select drop_id, row_number() over (order by drop_id) - 1 as batch_id from drops),
        windows as (select item_id, drop_id, unnest(range(ts_ms // 300000 * 300000 + 300000,
            ts_ms // 300000 * 300000 + 3600001, 300000)) as window_end from rows),
        counts as (select n.batch_id, item_id, window_end, count(*) as cnt
            from windows w join numbered n on w.drop_id <= n.drop_id group by all),
        ranked as (select *, cast(row_number() over (partition by batch_id, window_end order by cnt desc, item_id) as integer) as row_num
            from counts),
        top as (select * from ranked where row_num <= 5),
        later as (select batch_id + 1 as batch_id, item_id, window_end, cnt, row_num from top
            where batch_id < (select max(batch_id) from numbered)),
        same as (select batch_id, item_id, window_end, cnt, row_num from top)
        select true as insert, * from (select * from same except select * from later)
        union all
        select false as insert, * from (select * from later except select * from same)
    """


# Arrival instant that separates the old from the new snapshot: 2024-01-16 12:00 UTC.
CHANGE_CUT_MS = 1_705_406_400_000


def _changes() -> str:
    rows = f"""
        select user_id as item_id, {_SEC} * 1000 as ts_ms, {_MS} + {_K} * 60000 as arrival_ms
        from events where event_type = 'view'
    """
    old = _top(_counts(f"select * from ({rows}) where arrival_ms <= {CHANGE_CUT_MS}", *_ITEM), "item_id")
    new = _top(_counts(rows, *_ITEM), "item_id")
    return f"""
        with old as ({old}), new as ({new})
        select true as insert, * from (select * from new except select * from old)
        union all
        select false as insert, * from (select * from old except select * from new)
    """


ORACLES: dict[str, str] = {
    "parse_behavior_csv": _BEHAVIOR,
    "parse_access_log": f"select event_id, ip, user_id, ts_ms, method, url from ({_LOG})",
    "parse_access_log_rolling": f"select event_id, ip, user_id, ts_ms, method, url from ({_ROLLED_LOG})",
    "replay_lines": _BEHAVIOR,
    "filter_behavior": f"select item_id, behavior, ts_sec from ({_BEHAVIOR}) where behavior = 'pv'",
    "filter_page_requests": f"select ip, user_id, ts_ms, method, url from ({_LOG}) where {_KEPT}",
    "item_counts_sliding": _ITEM_COUNTS,
    "hot_items_topn": _HOT_ITEMS,
    "hot_items_topn_two_step": _HOT_ITEMS,
    "hot_items_topn_sql": _HOT_ITEMS,
    "hot_items_topn_hop": _HOT_ITEMS,
    "hot_items_report": _report(
        _HOT_ITEMS, "' 商品id = ' || item_id || ' 热门度 = ' || cnt", "chr(10) || chr(10)"),
    "hot_items_changelog": _changes(),
    "page_views_hourly": _PAGE_VIEWS,
    "page_counts_sliding": _PAGE_COUNTS,
    "hot_pages_topn": _HOT_PAGES,
    "hot_pages_report": _report(_HOT_PAGES, "' 热门度 = ' || cnt || ' 被访问url = ' || url", "chr(10)"),
    "late_events": f"""
        select event_id, ts_ms, arrival_ms from ({_with_watermark(_VERY_LATE, 1000)}) where {_LATE}
    """,
    "page_counts_on_time": _counts(_DENSE_WM, "page", 600_000, 5_000, _ON_TIME),
    "page_counts_final": _counts(_DENSE_WM, "page", 600_000, 5_000, _NOT_LOST),
    "hot_pages_topn_on_time": _top(_counts(_DENSE_REQUESTS, *_PAGE, _RANKED_FIRST), "url"),
    "hot_pages_topn_final": _top(_counts(_DENSE_REQUESTS, *_PAGE, _NOT_LOST), "url"),
    "late_page_requests": f"""
        select event_id, arrival_ms, ip, user_id, ts_ms, method, url from ({_DENSE_REQUESTS}) where {_LATE}
    """,
    "hot_pages_from_files": _top(_counts(_DENSE_REQUESTS, *_PAGE, _NOT_LOST), "url"),
    "stream_page_views": _PAGE_VIEWS,
    "stream_hot_items": _HOT_ITEMS,
    "stream_hot_items_changelog": _changes_by_drop(),
    "stream_hot_pages": _top(_counts(_DROPPED_REQUESTS, *_PAGE, _NOT_LOST), "url"),
    "live_hot_pages": _top(_counts(_DENSE_REQUESTS, *_PAGE, _NOT_LOST), "url"),
    "live_hot_pages_one_batch": _top(_counts(_DENSE_REQUESTS, *_PAGE, _NOT_LOST), "url"),
    "live_late_requests": f"select ip, user_id, ts_ms, method, url from ({_DENSE_REQUESTS}) where {_LATE}",
    "live_item_ranking": _HOT_ITEMS,
    "stream_late_events": f"select ip, user_id, ts_ms, method, url from ({_DROPPED_REQUESTS}) where {_LATE}",
}
ORACLES["stream_labelled_outputs"] = f"""
    select 'ranking' as output, * from ({ORACLES["stream_hot_pages"]})
    union all by name
    select 'late' as output, * from ({ORACLES["stream_late_events"]})
"""
