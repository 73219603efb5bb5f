"""Assets that arrive as a stream: each content once, and counts by time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_contents(assets: DataFrame, content: str, time: str, late: str = "1 day") -> DataFrame:
    """The first asset of each content. Contents are forgotten when they are older than the watermark, which bounds the state."""
    return assets.withWatermark(time, late).dropDuplicatesWithinWatermark([content])


def arrivals(assets: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, key, n): assets by window of time and key."""
    counts = assets.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), key, "n")


def increments(assets: DataFrame, group: str, content: str, order: str, time: str, last: dict[str, int], keep: str = "30 days") -> DataFrame:
    """(group, content, order, time, index): each new content of a group with the number that it gets, going on from ``last``.

    Of equal contents the first by order in its batch counts; contents that a group has seen get no number again. A
    group's state is its number and the contents it has seen with when it last saw them: those are forgotten ``keep``
    behind the watermark, so that the state is bounded by what comes in that time; its number is never forgotten.
    last: the largest number of each group before the stream (absent: 0). Null groups and contents are left out.
    """
    kinds = {c: assets.schema[c].dataType.simpleString() for c in (group, content, order)}
    late = pd.Timedelta(keep)

    def grow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, names, times = state.get if state.exists else (int(last.get(key[0], 0)), [], [])
        seen = dict(zip(names, times, strict=True))
        mark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values([order, content], kind="stable")
            fresh = rows.drop_duplicates(content)
            fresh = fresh[~fresh[content].astype(str).isin(seen)]
            for name, at in zip(rows[content].astype(str), rows[time], strict=True):
                seen[name] = max(seen.get(name, 0), int(at.timestamp() * 1000))
            out = fresh[[group, content, order, time]].assign(index=range(number + 1, number + 1 + len(fresh)))
            number += len(fresh)
            yield out
        least = (mark - late).timestamp() * 1000
        seen = {name: at for name, at in seen.items() if at >= least}
        state.update((number, list(seen), list(seen.values())))
        if seen:
            state.setTimeoutTimestamp(int(max(mark.timestamp() * 1000, min(seen.values()) + late.total_seconds() * 1000)) + 1)

    some = assets.where(F.col(group).isNotNull() & F.col(content).isNotNull()).select(group, content, order, time).withWatermark(time, keep)
    schema = f"`{group}` {kinds[group]}, `{content}` {kinds[content]}, `{order}` {kinds[order]}, `{time}` timestamp, index long"
    return some.groupBy(group).applyInPandasWithState(grow, schema, "number long, names array<string>, times array<long>", "append", GroupStateTimeout.EventTimeTimeout)
