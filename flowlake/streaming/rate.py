"""Message rate of a stream: for each second the mean of the last ``span`` per-second counts, idle seconds included.

Messages are folded to (key, second, count) inside their tasks, so what is shuffled grows with seconds, not with messages. Each key
has a ring in its state: the counts of the last ``span`` closed seconds, and those of the seconds that may still get messages. A
second is closed, and its rate emitted, once the watermark has passed it. A timer at the next open second makes
a key that has gone quiet emit its idle seconds as soon as other keys, or heartbeats, move the watermark on; it ends when
the rate is down to 0. Sums, counts and the state come back after a restart from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "first long, upto long, seconds array<long>, counts array<long>"


def emitted(seconds: np.ndarray, counts: np.ndarray, first: int, after: int, upto: int, span: int):
    """(second, n, window_count, rate) of all seconds in (after, upto] that are less than ``span`` after a busy one.

    ``seconds`` are busy, ascending, with their ``counts``; while fewer than ``span`` seconds have passed since ``first``
    the mean is over those.
    """
    if not len(seconds):
        return (np.zeros(0, np.int64),) * 4
    start = np.maximum(seconds, after + 1)
    stop = np.minimum(np.minimum(seconds + span, np.r_[seconds[1:], seconds[-1] + span]), upto + 1)
    many = np.maximum(stop - start, 0)
    t = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    sums = np.r_[0, np.cumsum(counts)]
    at = np.searchsorted(seconds, t, "right")
    window = sums[at] - sums[np.searchsorted(seconds, t - span, "right")]
    n = np.where(seconds[at - 1] == t, counts[at - 1], 0)
    return t, n, window, window // np.minimum(span, t - first + 1)


def _ring(span: int, names: list[str]):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, upto, seconds, counts = state.get if state.exists else (None, None, (), ())
        frames = list(frames)  # folded: at most seconds x tasks rows
        fresh = pd.concat(frames) if frames else pd.DataFrame({"second": [], "n": []})
        both = pd.concat([pd.DataFrame({"second": list(seconds), "n": list(counts)}, dtype="int64"), fresh[["second", "n"]].astype("int64")])
        if upto is not None:
            both = both[both["second"] > upto - span]
        folded = both[both["n"] > 0].groupby("second", sort=True)["n"].sum()
        known, n = folded.index.to_numpy(np.int64), folded.to_numpy(np.int64)
        closed = state.getCurrentWatermarkMs() // 1000 - 1  # the last second that gets no more messages
        if len(known) and first is None:
            first = int(known[0])
        elif len(known):
            first = min(first, int(known[0])) if upto is None else first
        out = None
        if first is not None and closed >= first and (upto is None or closed > upto):
            settled = known <= closed
            out = emitted(known[settled], n[settled], first, first - 1 if upto is None else upto, closed, span)
            upto = closed
            keep = known > closed - span
            known, n = known[keep], n[keep]
        if first is not None:
            state.update((first, upto, known.tolist(), n.tolist()))
            if len(known):  # the next second to close: a busy one, or the next idle one that still has a rate
                following = (upto if upto is not None else int(known[0]) - 1) + 1
                state.setTimeoutTimestamp(max((following + 1) * 1000, state.getCurrentWatermarkMs() + 1))
        if out is not None and len(out[0]):
            columns = {k: [v] * len(out[0]) for k, v in zip(names, key)}
            yield pd.DataFrame(columns | dict(zip(["second", "n", "window_count", "rate"], out)))

    return run


def _folded(slim: DataFrame, names: list[str]) -> DataFrame:
    """Counts per key and second of each record batch; the columns of ``slim``, whose ``n`` is added up."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)

    def fold(batches):
        for batch in batches:
            if batch.num_rows:
                summed = pa.Table.from_batches([batch]).group_by([*names, "_at", "second"]).aggregate([("n", "sum")])
                yield from summed.rename_columns([*names, "_at", "second", "n"]).combine_chunks().to_batches()

    return slim.mapInArrow(fold, kinds)


def live_rate(stream: DataFrame, ts: str, delay: str = "10 seconds", span: int = 60, keys: list[str] | None = None,
              heartbeat: Column | None = None) -> DataFrame:
    """``second, n, window_count, rate`` (after ``keys``) as a stream in append mode.

    ``heartbeat`` marks rows that only tell the time and count nothing. Messages that come more than ``delay`` behind the newest
    time may not be counted.
    """
    names = keys or ["_all"]
    at = F.date_trunc("second", F.col(ts).cast("timestamp"))
    beat = F.lit(False) if heartbeat is None else F.coalesce(heartbeat, F.lit(False))
    source = stream if keys else stream.withColumn("_all", F.lit(0))
    slim = source.filter(F.col(ts).isNotNull()).select(
        *names, at.alias("_at"), F.unix_seconds(at).alias("second"), F.when(beat, 0).otherwise(1).cast("long").alias("n"))
    folded = _folded(slim, names).withWatermark("_at", delay)
    fields = ", ".join(f"`{n}` {slim.schema[n].dataType.simpleString()}" for n in names)
    rates = folded.groupBy(*names).applyInPandasWithState(
        _ring(span, names), f"{fields}, second long, n long, window_count long, rate long", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return rates if keys else rates.drop("_all")
