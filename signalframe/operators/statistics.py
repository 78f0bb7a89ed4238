"""Robust and circular statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Consistency factor of the median absolute deviation; EWMA weight over 30 days.
MAD_SCALE, EWMA_ALPHA = 1.4826, 2 / 31


def percentile(value: Column | str, p: float) -> Column:
    """Linear-interpolated percentile (a single observation gives itself)."""
    return F.percentile(value, F.lit(p))


def array_median(values: Column) -> Column:
    s = F.array_sort(values)
    n = F.size(s)
    at = lambda i: F.element_at(s, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2)


def array_mad(values: Column, median: Column) -> Column:
    """Median absolute deviation of an array from its median, scaled."""
    return array_median(F.transform(values, lambda v: F.abs(v - median))) * MAD_SCALE


def ewma(values: Column, alpha: float = EWMA_ALPHA) -> Column:
    """Exponentially weighted mean of an array, seeded with its first value."""
    rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.when(F.size(values) > 0, F.aggregate(rest, F.element_at(values, 1), lambda a, v: a + (v - a) * alpha))


def array_sd(values: Column) -> Column:
    """Population standard deviation of an array, in one pass (running mean and sum of squares)."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a: Column, v: Column) -> Column:
        mean = a["mean"] + (v - a["mean"]) / (a["n"] + 1)
        return F.struct((a["n"] + 1).alias("n"), mean.alias("mean"), (a["m2"] + (v - a["mean"]) * (v - mean)).alias("m2"))

    return F.aggregate(values, zero, step, lambda a: F.when(a["n"] > 0, F.sqrt(a["m2"] / a["n"])))


def circular_mean(sines: Column, cosines: Column, of: float = 1440.0) -> Column:
    """Mean clock minute from the sums of the sines and cosines of clock angles."""
    return F.atan2(sines, cosines) * (of / (2 * math.pi))


def angle(minutes: Column, of: float = 1440.0) -> Column:
    return minutes.cast("double") * (2 * math.pi / of)


def circular_sd(minutes: Column, mean: Column, of: float = 1440.0) -> Column:
    """Standard deviation of clock minutes around their circular mean, differences taken the short way round.

    ``mean`` is evaluated for each element: pass a column, not an aggregate of the array.
    """
    return array_sd(F.transform(minutes, lambda m: F.pmod(m.cast("double") - mean + of / 2, F.lit(of)) - of / 2))


def nearest_ranks(df: DataFrame, by: list[str], value: str, percents: tuple[int, ...]) -> DataFrame:
    """(by..., n, p, value): nearest-rank quantiles; ranks are rounded half to even. Null values don't count.

    Counted by value before any order: what is sorted are the different values of a group.
    """
    w = Window.partitionBy(*by)
    r = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(F.count("*").alias("__c")).withColumns({"__upto": F.sum("__c").over(w.orderBy("value")), "n": F.sum("__c").over(w)})
    p = r.withColumn("p", F.explode(F.array(*map(F.lit, percents)))).withColumn("__i", F.rint((F.col("n") - 1) * F.col("p") / 100.0).cast("bigint"))
    return p.filter((F.col("__i") < F.col("__upto")) & (F.col("__i") >= F.col("__upto") - F.col("__c"))).select(*by, "n", "p", "value")


#: Windows whose slopes are found together: about 30 MB for 90 days.
WINDOWS_AT_ONCE = 256


def _median_of_rows(x: np.ndarray) -> np.ndarray:
    """Medians of rows without their NaNs, which sort to the end; NaN where there is nothing else."""
    s = np.sort(x, axis=1)
    n = (~np.isnan(s)).sum(axis=1)
    i = np.arange(len(s))
    return np.where(n > 0, (s[i, np.maximum(n - 1, 0) // 2] + s[i, np.minimum(n // 2, s.shape[1] - 1)]) / 2, np.nan)


def window_slopes(days: np.ndarray, values: np.ndarray, ends: np.ndarray, width: int, least: float, widest_gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, widest gap, median slope a day over all pairs) of the ``width`` calendar days up to each of ``ends`` (positions in ``days``)."""
    start = np.searchsorted(days, days[ends] - width + 1)
    n = ends - start + 1
    step = np.diff(days, prepend=days[:1])
    held = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(width - 1, np.int64), step]), width)[ends]
    gap = np.where(np.arange(width) > width - n[:, None], held, 0).max(axis=1)
    slope = np.full(len(ends), np.nan)
    good = np.flatnonzero((n >= least) & (n >= 2) & (gap <= widest_gap))
    a, b = np.triu_indices(width, 1)
    for first in range(0, len(good), WINDOWS_AT_ONCE):
        rows = good[first : first + WINDOWS_AT_ONCE]
        dense = np.full((len(rows), width), np.nan)  # a value at each calendar day of the window
        owner = np.repeat(np.arange(len(rows)), n[rows])
        at = np.arange(n[rows].sum()) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows]) + np.repeat(start[rows], n[rows])
        dense[owner, days[at] - np.repeat(days[ends[rows]] - width + 1, n[rows])] = values[at]
        slope[rows] = _median_of_rows((dense[:, b] - dense[:, a]) / (b - a))
    return n, gap, slope


def theil_sen_windows(keys: int, widths: tuple[tuple[int, int], ...], least_share: float, widest_gap: int):
    """Slopes of the calendar windows of rows (``keys`` columns, shard, day, v, mark, shown), sorted and with whole groups of keys and shard."""

    def group(tab: pa.Table) -> pa.RecordBatch:
        days, values = tab.column("day").to_numpy(), tab.column("v").to_numpy()
        ends = np.flatnonzero(tab.column("shown").to_numpy())
        upto = np.concatenate([[0], np.bitwise_xor.accumulate(tab.column("mark").to_numpy())])
        parts = [(width, *window_slopes(days, values, ends, width, max(least, least_share * width), widest_gap)) for width, least in widths] if len(ends) else []
        at = pa.array(np.tile(ends, len(parts)))
        joined = lambda i, kind: np.concatenate([p[i] for p in parts]).astype(kind) if parts else np.zeros(0, kind)
        slope, n = joined(3, float) * 7, joined(1, np.int64)
        last = np.tile(ends, len(parts))
        return pa.RecordBatch.from_arrays(
            [*[tab.column(i).combine_chunks().take(at) for i in range(keys)], tab.column("day").combine_chunks().take(at), pa.array(np.repeat([p[0] for p in parts], len(ends)).astype(np.int32), pa.int32()), pa.array(n), pa.array(joined(2, np.int64)), pa.array(upto[last + 1] ^ upto[last + 1 - n]), pa.array(slope, mask=np.isnan(slope))],
            names=[*tab.column_names[:keys], "day", "window_days", "n", "max_gap", "marks", "per_week"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            marks = list(zip(*(b.column(i).to_pylist() for i in range(keys + 1)), strict=True))
            cuts = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
            for first, end in zip(cuts, cuts[1:], strict=False):
                if held and marks[first] != last:
                    yield group(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(first, end - first))
                last = marks[first]
        if held:
            yield group(pa.Table.from_batches(held))

    return run
