"""The item ranking as SQL text over temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.functions.eventtime import interval
from wavecount.operators.filters import VIEW_BEHAVIOR, keep_behavior
from wavecount.operators.ranking import TOP_N
from wavecount.plans.hot_items import SIZE, SLIDE

COUNTS = """
    select item_id, unix_millis(w.end) as window_end, cnt
    from (
        select item_id, window(ts, '{size}', '{slide}') as w, count(item_id) as cnt
        from {view}
        where behavior = :behavior
        group by item_id, window(ts, '{size}', '{slide}')
    )
"""

RANKED = """
    select * from (
        select *, row_number() over (partition by window_end order by cnt desc, item_id) as row_num
        from {counts}
    )
    where row_num <= :n
"""


# Items per sliding window as a table function, slide first. Rows are counted per slide
# interval; the count rises at the first window of the interval and falls behind its last;
# windows come out last. Blocks of eight sizes bound the rows of one group, as in
# ``operators.windows``; a count that reaches into the next block starts there anew.
HOP = """
    create or replace temporary function {name}(wanted string, slide interval day to second, size interval day to second)
    returns table (item_id bigint, window_end bigint, cnt bigint)
    return
    with timed as (
        select item_id, unix_millis(ts) as ms, {slide} as step, {size} as width from {view} where behavior = wanted
    ), spans as (
        select item_id, step, ceiling(8 * width / step) * step as block, pmod(width, step) as phase,
               ms - width - pmod(ms - width, step) + step + width as rise, ms - pmod(ms, step) + width + step as fall, count(*) as n
        from timed group by all
    ), placed as (
        select *, rise - phase - pmod(rise - phase, block) + phase as own, fall - phase - pmod(fall - phase, block) + phase as next
        from spans where rise < fall
    ), changes as (
        select item_id, step, block, inline(filter(array(
            struct(own as block_start, rise as at, n as delta),
            struct(next as block_start, next as at, if(next > own and fall > next, n, null) as delta),
            struct(next as block_start, fall as at, if(next = own or fall > next, -n, null) as delta)), c -> c.delta is not null))
        from placed
    ), runs as (
        select item_id, step, at, sum(delta) over moments as cnt,
               coalesce(lead(at) over moments, block_start + block) as until
        from changes window moments as (partition by item_id, step, block, block_start order by at)
    )
    select item_id, explode(sequence(at, until - step, step)), cnt from runs where cnt > 0 and until > at
"""


def _millis(name: str) -> str:
    """An argument of the type interval as milliseconds."""
    return f"unix_millis(timestamp'1970-01-01 00:00:00Z' + {name})"


def register_hop(rows: DataFrame, name: str = "hop_counts", view: str = "data_table") -> str:
    """Make ``name(behavior, slide, size)`` available to SQL: item_id, window_end, cnt over item_id, behavior and ts of a table."""
    rows.sparkSession.sql(HOP.format(name=name, view=register(rows, view), slide=_millis("slide"), size=_millis("size")))
    return name


def _literal(ms: int) -> str:
    return f"interval '{ms // 1000}.{ms % 1000:03d}' second"


def hot_items_hop(rows: DataFrame, name: str = "hop_counts", view: str = "data_table", behavior: str = VIEW_BEHAVIOR,
                  n: int = TOP_N, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """The same ranking over the table function."""
    call = f"{register_hop(rows, name, view)}(:behavior, {_literal(slide)}, {_literal(size)})"
    return rows.sparkSession.sql(RANKED.format(counts=call), args={"behavior": behavior, "n": n})


def register(rows: DataFrame, view: str = "data_table") -> str:
    """Make item_id, behavior and ts of a table available to SQL."""
    rows.select("item_id", "behavior", "ts").createOrReplaceTempView(view)
    return view


def hot_items_sql(rows: DataFrame, view: str = "data_table", behavior: str = VIEW_BEHAVIOR, n: int = TOP_N,
                  size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """One nested statement: count per item and window, rank, cut."""
    counts = COUNTS.format(view=register(rows, view), size=interval(size), slide=interval(slide))
    return rows.sparkSession.sql(RANKED.format(counts=f"({counts})"), args={"behavior": behavior, "n": n})


def hot_items_two_step(rows: DataFrame, view: str = "agg", behavior: str = VIEW_BEHAVIOR, n: int = TOP_N,
                       size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """Counts with the DataFrame API, registered as a view, ranked with SQL."""
    counts = (
        keep_behavior(rows.select("item_id", "behavior", "ts"), behavior)
        .groupBy("item_id", F.window("ts", interval(size), interval(slide)).alias("w"))
        .agg(F.count("item_id").alias("cnt"))
        .select("item_id", F.unix_millis("w.end").alias("window_end"), "cnt")
    )
    counts.createOrReplaceTempView(view)
    return rows.sparkSession.sql(RANKED.format(counts=view), args={"n": n})
