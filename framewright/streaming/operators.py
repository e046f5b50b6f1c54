"""Streaming operators.

Event time: test tables hold ``TIMESTAMP_NTZ``; ``withWatermark`` needs ``TIMESTAMP``, so
``event_time`` maps an NTZ wall clock to the instant with the same UTC wall clock (through epoch
microseconds, not a cast, so the session time zone plays no part: windows align exactly as in
batch on NTZ, and no two wall-clock times merge in a DST gap), and window bounds map back to NTZ
on output.  ``TIMESTAMP`` inputs are used as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.dates import instant_as_ntz, ntz_as_instant


def _type_of(df: DataFrame, column: str) -> str:
    """The type of a column as Spark resolves the name (case-insensitive, nested paths)."""
    return df.select(column).dtypes[0][1]


def event_time(df: DataFrame, ts: str, name: str = "event_time") -> DataFrame:
    """An event-time column usable by a watermark (see module notes)."""
    if _type_of(df, ts) == "timestamp_ntz":
        return df.withColumn(name, ntz_as_instant(F.col(ts)))
    return df.withColumn(name, F.col(ts).cast("timestamp"))


def flat_window(df: DataFrame, w: str = "window", to_ntz: bool = False) -> DataFrame:
    """Replace a window struct by ``window_start`` / ``window_end`` columns."""
    start, end = F.col(f"{w}.start"), F.col(f"{w}.end")
    if to_ntz:
        start, end = instant_as_ntz(start), instant_as_ntz(end)
    others = [c for c in df.columns if c != w]
    return df.select(start.alias("window_start"), end.alias("window_end"), *others)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Running count per key (complete mode)."""
    return df.groupBy(*keys).count()


def windowed(df: DataFrame, ts: str, size: str, slide: str | None, keys: Sequence[str], *aggs: Column,
             watermark: str | None = None) -> DataFrame:
    """Aggregate per key and tumbling / sliding window; with ``watermark`` append mode
    emits each window once the watermark passes its end.  Window bounds have the input's type
    (NTZ input: NTZ bounds, through the time-zone free mapping of the module notes)."""
    col = ts
    was_ntz = _type_of(df, ts) == "timestamp_ntz"
    if watermark:
        df = event_time(df, ts, "__et").withWatermark("__et", watermark)
        col = "__et"
    w = F.window(F.col(col), size, slide) if slide else F.window(F.col(col), size)
    out = df.groupBy(w.alias("window"), *keys).agg(*aggs)
    return flat_window(out, to_ntz=bool(watermark) and was_ntz)


def session_windows(df: DataFrame, ts: str, gap: str, keys: Sequence[str], *aggs: Column, watermark: str | None = None) -> DataFrame:
    """Aggregate per key and session: rows with less than ``gap`` between neighbours; the window ends ``gap``
    after the last row.  The state of an open session holds its bounds and partial aggregates, and
    sessions that a new row joins are merged, over any number of batches.  With ``watermark`` append
    mode emits a session once the watermark has passed its end.  Bounds have the input's type."""
    was_ntz = _type_of(df, ts) == "timestamp_ntz"
    df = event_time(df, ts, "__et")
    if watermark:
        df = df.withWatermark("__et", watermark)
    out = df.groupBy(F.session_window("__et", gap).alias("window"), *keys).agg(*aggs)
    return flat_window(out, to_ntz=was_ntz)


def deduplicated(df: DataFrame, keys: Sequence[str], ts: str, watermark: str,
                 within_watermark: bool = False) -> DataFrame:
    """Drop repeated (keys, event time) rows; state older than the watermark is dropped.
    ``within_watermark`` uses ``dropDuplicatesWithinWatermark`` (keys only, event time may
    differ between copies)."""
    et = event_time(df, ts, "__et").withWatermark("__et", watermark)
    if within_watermark:
        return et.dropDuplicatesWithinWatermark(list(keys)).drop("__et")
    return et.dropDuplicates([*keys, "__et"]).drop("__et")


def coarser_windows(df: DataFrame, window_col: str, size: str, *aggs: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Q17: a second windowed aggregation over the output of a first one (both stateful, append
    mode under one watermark).  Each first-level window is placed by its event time
    ``window_time`` (its end minus one microsecond)."""
    return df.groupBy(F.window(F.window_time(F.col(window_col)), size).alias("window"), *keys).agg(*aggs)


def time_bounded_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_time: str,
                      right_time: str, within: str, salt: int = 1, left_id: str | None = None) -> DataFrame:
    """Q17: inner stream-stream join on keys where the right event follows the left one by at most
    ``within``.  Both sides need watermarks; the time bound lets Spark drop old join state.

    ``salt`` > 1 spreads each key's join state over ``salt`` partitions: a left row takes one salt
    value from a hash of ``left_id`` (deterministic, so a replayed batch salts the same way), each
    right row is replicated to every salt value, and the salt joins the keys.  Every matching pair
    still meets exactly once; a hot key's state and work are divided by ``salt`` at the price of
    ``salt`` copies of the right side's state."""
    if salt > 1:
        if left_id is None:
            raise ValueError("salting needs a left row id column")
        left = left.withColumn("__salt_l", F.pmod(F.xxhash64(F.col(left_id)), F.lit(salt)))
        right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    cond = None
    for lk, rk in keys:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    if salt > 1:
        cond = cond & (left["__salt_l"] == right["__salt_r"])
    cond = cond & (right[right_time] >= left[left_time]) & \
        (right[right_time] <= left[left_time] + F.expr(f"INTERVAL {within}"))
    out = left.join(right, cond, "inner")
    return out.drop("__salt_l", "__salt_r") if salt > 1 else out
