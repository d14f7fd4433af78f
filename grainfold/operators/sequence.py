"""Sequences: differences, gap sessions, gap filling, intervals, frames, jump scans."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.operators.ordered import OrderedGroups
from grainfold.session import stored

JUMP_LOOK_AHEAD = 4


def first_diff(
    df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
    name: str = "diff"
) -> DataFrame:
    """``value`` minus the value on the row before it in its series."""
    rows = OrderedGroups(df, keys, order).previous("_prev", F.col(value)).frame()
    return rows.withColumn(name, F.col(value) - F.col("_prev")).drop("_prev")


def gap_sessions(
    df: DataFrame, at: Column, gap: float, keys: Sequence[str], order: Sequence[str],
    name: str = "session"
) -> DataFrame:
    """Number the runs of rows whose ``at`` stays within ``gap`` of the row before (from 0)."""
    rows = OrderedGroups(df.withColumn("_at", at), keys, order)
    rows.previous("_prev", F.col("_at"))
    jump = F.when(F.abs(F.col("_at") - F.col("_prev")) > gap, 1).otherwise(0).cast("long")
    return rows.running_sum(name, jump).frame().drop("_at", "_prev")


def session_concat(
    df: DataFrame, word: str, keys: Sequence[str], order: Sequence[str],
    min_length: int = 20, name: str = "text",
) -> DataFrame:
    """One text per group: its words in order, kept if longer than ``min_length``.

    The text is the result row itself, so a group is bounded by what one string
    may hold.
    """
    words = F.array_sort(F.collect_list(F.struct(*order, word)))
    text = F.array_join(F.transform(words, lambda w: w[word]), " ")
    return df.groupBy(*keys).agg(text.alias(name)).where(F.length(name) > min_length)


def interpolate_linear(
    df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
    name: str = "filled"
) -> DataFrame:
    """Fill inner gaps on the straight line, by row position, between the known neighbours.

    Gaps at either end of a series stay NULL.
    """
    rows = OrderedGroups(df, keys, order).position("_pos")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(value).alias("v")))
    rows.nearest_known("_lo", known).nearest_known("_hi", known, after=True)
    share = (F.col("_pos") - F.col("_lo.p")) / F.nullif(F.col("_hi.p") - F.col("_lo.p"), F.lit(0))
    line = F.col("_lo.v") + (F.col("_hi.v") - F.col("_lo.v")) * share
    return rows.frame().withColumn(name, F.coalesce(F.col(value), line)).drop("_pos", "_lo", "_hi")


def merge_intervals(
    df: DataFrame, start: str, end: str, keys: Sequence[str]
) -> DataFrame:
    """Union of overlapping or touching intervals per key.

    Equal intervals are merged before the ordered step; a nested interval never
    shortens the one around it.
    """
    spans = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    rows = OrderedGroups(spans, keys, [start]).max_before("_reach", F.col(end))
    fresh = F.when(F.col(start) > F.col("_reach"), 1).otherwise(0).cast("long")
    islands = rows.running_sum("_island", fresh).frame()
    return islands.groupBy(*keys, "_island").agg(
        F.min(start).alias(start), F.max(end).alias(end)
    ).drop("_island")


def _explode_range(df: DataFrame, name: str, low: Column, high: Column, block: int = 4096) -> DataFrame:
    """One row per whole number in [low, high], in two steps so that no array is long."""
    outer = df.withColumn("_lo", low).withColumn("_hi", high)
    outer = outer.where(F.col("_lo") <= F.col("_hi")).withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("_lo") / block), F.floor(F.col("_hi") / block)))
    )
    inner = F.sequence(
        F.greatest(F.col("_lo"), F.col("_block") * block),
        F.least(F.col("_hi"), F.col("_block") * block + block - 1),
    )
    return outer.withColumn(name, F.explode(inner)).drop("_lo", "_hi", "_block")


def label_frames(
    spans: DataFrame, segments: DataFrame, width: float, key: str,
    start: str = "start", end: str = "end"
) -> DataFrame:
    """Label the fixed frames of every file: 1 if segments cover more than half of a frame.

    ``spans`` has one (key, start, end) row per file and gives its frames
    ``[n * width, (n + 1) * width)``. Frames are regular, so a segment's frames
    follow from arithmetic and no range join is needed: after merging, segments of
    a file are disjoint and touch a frame only as often as they start or end in it.
    """
    frames = _explode_range(
        spans, "frame",
        F.floor(F.col(start) / width), F.ceil(F.col(end) / width) - 1,
    ).select(key, "frame")
    merged = merge_intervals(segments, start, end, [key])
    touched = _explode_range(
        merged, "frame", F.floor(F.col(start) / width), F.ceil(F.col(end) / width) - 1
    )
    inside = F.least(F.col(end), (F.col("frame") + 1) * width) - F.greatest(F.col(start), F.col("frame") * width)
    cover = touched.groupBy(key, "frame").agg(F.sum(inside / width).alias("covered"))
    return frames.join(cover, [key, "frame"], "left").select(
        key, "frame",
        F.coalesce("covered", F.lit(0.0)).alias("covered"),
        (F.coalesce("covered", F.lit(0.0)) > 0.5).cast("int").alias("label"),
    )


def halo_blocks(df: DataFrame, index: str, size: int, before: int, after: int) -> DataFrame:
    """Give every row its block number, and copies for neighbour blocks that look at it.

    Block ``b`` owns indexes ``[b * size, (b + 1) * size)`` and also sees ``before``
    rows ahead of it and ``after`` rows past it. Halos must not exceed the block.
    """
    if max(before, after) > size:
        raise ValueError("halo larger than block")
    i, block = F.col(index), F.floor(F.col(index) / size)
    offset = i - block * size
    copies = F.array_compact(F.array(
        block,
        F.when(offset < after, block - 1),
        F.when(offset >= size - before, block + 1),
    ))
    return df.withColumn("block", F.explode(copies))


def _jump_moves(values: np.ndarray, owned: int, last: bool) -> list[tuple]:
    """(leave, still, total) for every way to enter one chunk, by entry offset and, within it, by waiting or not.

    ``values`` holds the chunk's ``owned`` rows and up to four rows of the next;
    ``leave`` is the offset in the next chunk, or -1 if the scan ends here. The next step of every row in either
    state is found for all rows at once; then steps are doubled until all have left the chunk.
    """
    ahead, n = JUMP_LOOK_AHEAD, len(values)
    at = np.arange(owned)
    window = np.concatenate([values, np.full(ahead, -np.inf)])[at[:, None] + np.arange(ahead + 1)]
    here = window[:, 0] >= 0
    good = np.where((window[:, 1:] >= 0).any(1), (window[:, 1:] >= 0).argmax(1) + 1, 0)
    ends = ~here & (good == 0) & last & (at + ahead + 1 >= n)
    # two nodes a row, then those of the rows that a step may land on behind the chunk, then the end
    end = 2 * (owned + ahead + 1)
    step, gain = np.arange(end + 1), np.zeros(end + 1)
    for still in (0, 1):
        best = still + window[:, still:].argmax(1)
        to = 2 * (at + best) + (best == 0)
        won = window[at, best]
        to = np.where(here, 2 * (at + 1), np.where(good > 0, 2 * (at + good), np.where(ends, end, to)))
        step[2 * at + still], gain[2 * at + still] = to, np.where(here, window[:, 0], np.where((good > 0) | ends, 0.0, won))
    while (step[: 2 * owned] < 2 * owned).any():
        gain, step = gain + gain[step], step[step]
    out = []
    for node in range(2 * (ahead + 1)):
        if node >= 2 * owned:
            out.append((-1, False, 0.0))
        else:
            to = int(step[node])
            out.append((-1 if to == end else to // 2 - owned, bool(to % 2) and to != end, float(gain[node])))
    return out


_MOVES = "array<struct<leave: int, still: boolean, total: double>>"


def bounded_jump_score(
    df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str],
    name: str = "score", chunk: int = 10_000, fan: int = 64,
) -> DataFrame:
    """Total collected by the greedy jump scan over each ordered series.

    A value >= 0 is added and the scan steps on. On a negative value it jumps to
    the first value >= 0 among the next four rows. Without one it adds the least
    negative of the current and next four rows and goes there; if that is the
    current row, the next move looks at the four rows after it only. The scan ends
    when no value >= 0 is left inside a look-ahead that reaches the end.

    A scan enters a chunk at one of five offsets and in one of two states, so the
    chunks of a series are worked out independently, for every way to enter them: a chunk of any length
    becomes ten moves. Tables of moves are put together ``fan`` at a time, in as many rounds as the longest series
    needs, so that no task holds more of them.
    """
    keys = list(keys)
    rows = OrderedGroups(df, keys, order).position("_pos").frame()
    rows = rows.select(*keys, (F.col("_pos") - 1).alias("_pos"), F.col(value).cast("double").alias("_v"))
    sizes = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")))

    @F.pandas_udf(_MOVES)
    def moves(values: pd.Series, owned: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([_jump_moves(np.asarray(v), int(o), bool(e)) for v, o, e in zip(values, owned, last)])

    pieces = halo_blocks(rows, "_pos", chunk, 0, JUMP_LOOK_AHEAD).where("block >= 0")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_v")))
    pieces = pieces.groupBy(*keys, "block").agg(
        F.transform(ordered, lambda s: s["_v"]).alias("_values"), F.max("_pos").alias("_end"),
        F.count_if(F.col("_pos") < (F.col("block") + 1) * chunk).alias("_owned"),
    ).join(sizes, keys)
    tables = pieces.select(
        *keys, "block", moves("_values", "_owned", F.col("_end") == F.col("_size") - 1).alias("moves")
    )

    def state(leave: Column, still: Column, total: Column) -> Column:
        return F.struct(leave.cast("int").alias("leave"), still.alias("still"), total.alias("total"))

    def follow(states: Column, step: Column) -> Column:
        """Where each way in leads to behind one more chunk."""

        def move(s: Column) -> Column:
            next_ = F.get(step["moves"], 2 * s["leave"] + s["still"].cast("int"))
            return F.when(s["leave"] < 0, s).otherwise(state(next_["leave"], next_["still"], s["total"] + next_["total"]))

        return F.transform(states, move)

    entries = F.array(*[state(F.lit(i // 2), F.lit(bool(i % 2)), F.lit(0.0)) for i in range(2 * (JUMP_LOOK_AHEAD + 1))])
    blocks = -(-(sizes.agg(F.max("_size")).first()[0] or 1) // chunk)
    while True:
        steps = F.array_sort(F.collect_list(F.struct("block", "moves")))
        tables = tables.groupBy(*keys, F.floor(F.col("block") / fan).alias("block")).agg(F.aggregate(steps, entries, follow).alias("moves"))
        if blocks <= fan:
            return tables.select(*keys, F.col("moves")[0]["total"].alias(name))
        blocks = -(-blocks // fan)
