"""Implausible readings of a source: impossible values, short excursions (Hampel filter), frozen values (run lengths)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .statistics import MAD_SCALE

SHARD_SECONDS = 8 * 86400


@dataclass(frozen=True)
class Rules:
    """What counts as implausible; the defaults are for heart rates.

    ``lowest``, ``highest``: physical bounds. Hampel filter: ``half_window`` readings on each side give the rolling median
    and the scaled median absolute deviation about it; an excursion of up to ``longest`` readings is ``sigmas`` of these
    off, and at least ``least_jump``. A frozen run has at least ``least_run`` readings and ``run_factor`` times the length
    that ``typical_share`` of the source's shorter runs don't exceed.
    """

    lowest: float = 25.0
    highest: float = 240.0
    half_window: int = 12
    sigmas: float = 3.0
    least_jump: float = 12.0
    longest: int = 3
    least_run: int = 7
    run_factor: float = 1.75
    typical_share: float = 0.98

    @property
    def reach(self) -> int:
        """So many plausible readings on each side decide whether a reading is part of an excursion."""
        return self.longest + self.half_window + 1


_OUT = "kind string, sid string, shard bigint, run bigint, edge int, value double, n bigint, id string"
_OUT_SCHEMA = pa.schema([("kind", pa.string()), ("sid", pa.string()), ("shard", pa.int64()), ("run", pa.int64()), ("edge", pa.int32()), ("value", pa.float64()), ("n", pa.int64()), ("id", pa.string())])


def _median(rows: np.ndarray) -> np.ndarray:
    """Row medians without the NaNs (NaN where a row has nothing else)."""
    s = np.sort(rows, axis=1)
    n = (~np.isnan(s)).sum(axis=1)
    i = np.arange(len(s))
    m = (s[i, np.maximum(n - 1, 0) // 2] + s[i, np.minimum(n // 2, s.shape[1] - 1)]) / 2
    return np.where(n > 0, m, np.nan)


def excursions(group: np.ndarray, t: np.ndarray, x: np.ndarray, rules: Rules, halo_us: int | None = None) -> np.ndarray:
    """Mask of the readings of up to ``longest`` that jump out of the rolling median and come back.

    ``group`` marks the source, ``t`` (microseconds) ascends within it. Readings of the group are neighbours however long
    the device was silent between them, unless ``halo_us`` limits it. A stretch is a case if it is outside the Hampel band
    around the rolling median (median absolute deviation about it), and outside both its shoulders (the readings just
    before and after it) by the same margin: what builds up or fades has no such shoulders, and a lasting shift has no
    return.
    """
    n, hit = len(x), np.zeros(len(x), bool)
    if n < 2:
        return hit
    near = np.zeros(n + 1, bool)  # near[i]: reading i - 1 is a neighbour of i
    near[1:n] = group[1:] == group[:-1]
    if halo_us is not None:
        near[1:n] &= t[1:] - t[:-1] <= halo_us
    for length in range(1, rules.longest + 1):
        if n <= length:
            break
        i = np.arange(0, n - length)
        ok = np.ones(len(i), bool)
        for k in range(1, length + 1):
            ok &= near[i + k]
        i = i[ok]
        j = i + length
        seg = np.stack([x[i + k] for k in range(length)])
        before = np.where(near[i], x[np.maximum(i - 1, 0)], x[j])
        up, down = seg.min(0) - np.maximum(before, x[j]), np.minimum(before, x[j]) - seg.max(0)
        out = np.maximum(up, down)
        c = out >= rules.least_jump  # no margin is less
        i, out, sign = i[c], out[c], np.where(up[c] > 0, 1.0, -1.0)
        if not len(i):
            continue
        centre = i + (length - 1) // 2
        at = centre[:, None] + np.arange(-rules.half_window, rules.half_window + 1)
        safe = np.clip(at, 0, n - 1)
        good = (at == safe) & (group[safe] == group[centre][:, None])
        if halo_us is not None:
            good &= np.abs(t[safe] - t[centre][:, None]) <= halo_us
        window = np.where(good, x[safe], np.nan)
        level = _median(window)
        deviation = MAD_SCALE * _median(np.abs(window - level[:, None]))
        margin = np.maximum(rules.least_jump, rules.sigmas * deviation)
        far = np.stack([(x[i + k] - level) * sign for k in range(length)]).min(0)
        case = (out >= margin) & (far >= margin)
        for k in range(length):
            hit[i[case] + k] = True
    return hit


def _scan_groups(c: dict[str, np.ndarray], sid: pa.Array, ids: pa.Array, rules: Rules, halo_us: int | None) -> pa.Table:
    """Whole (source, shard) groups, sorted by group and time: what is impossible, and of readings with an instant the
    excursions, those near the edges, runs at the edges, long runs, and run lengths."""
    within = (c["value"] >= rules.lowest) & (c["value"] <= rules.highest)
    off = np.flatnonzero(~within)
    impossible = pa.table({"kind": pa.array(["impossible"] * len(off), pa.string()), "id": ids.take(pa.array(off))})
    timed = np.flatnonzero(c["timed"])
    if len(timed) < len(within):
        sid, ids, within = sid.take(pa.array(timed)), ids.take(pa.array(timed)), within[timed]
    g, t, x, shard = (c[n][timed] for n in ("g", "t", "value", "shard"))
    p = np.flatnonzero(within)
    hit = np.zeros(len(x), bool)
    hit[p] = excursions(g[p], t[p], x[p], rules, halo_us)
    # what is within reach of an edge is decided with the shards beside it, from twice as many readings of each
    group_heads = np.flatnonzero(np.append(True, g[p][1:] != g[p][:-1])) if len(p) else np.zeros(0, np.int64)
    size = np.diff(np.append(group_heads, len(p)))
    place = np.arange(len(p)) - np.repeat(group_heads, size)
    inward = np.minimum(place, np.repeat(size, size) - 1 - place)
    hit[p[inward < rules.reach]] = False
    shown = inward < 2 * rules.reach
    parts = [pa.concat_tables([_OUT_SCHEMA.empty_table(), impossible], promote_options="default")]

    def rows(kind: str, at: np.ndarray, run=None, edge=None, value=None, n=None, with_id: bool = False) -> None:
        if len(at):
            null = lambda kind_: pa.nulls(len(at), kind_)
            parts.append(pa.Table.from_arrays([
                pa.array([kind]).take(pa.array(np.zeros(len(at), np.int64))), sid.take(pa.array(at)), pa.array(shard[at]), null(pa.int64()) if run is None else pa.array(run), null(pa.int32()) if edge is None else pa.array(edge.astype(np.int32)),
                null(pa.float64()) if value is None else pa.array(value), null(pa.int64()) if n is None else pa.array(n), ids.take(pa.array(at)) if with_id else null(pa.string()),
            ], schema=_OUT_SCHEMA))

    rows("excursion", np.flatnonzero(hit), with_id=True)
    rows("near", p[shown], run=place[shown], edge=inward[shown] < rules.reach, value=x[p[shown]], n=t[p[shown]], with_id=True)
    if len(x):
        new_group = np.ones(len(x), bool)
        new_group[1:] = g[1:] != g[:-1]
        new_run = new_group.copy()
        new_run[1:] |= x[1:] != x[:-1]
        run = np.cumsum(new_run) - 1
        heads = np.flatnonzero(new_run)
        length = np.diff(np.append(heads, len(x)))
        head_group = g[heads]
        first = new_group[heads]
        last = np.ones(len(heads), bool)
        last[:-1] = head_group[1:] != head_group[:-1]
        group_start = np.maximum.accumulate(np.where(first, np.arange(len(heads)), 0))
        number = np.arange(len(heads)) - group_start
        edge = first * 1 + last * 2
        kept = (edge > 0) | (length >= rules.least_run)
        rows("run", heads[kept], run=number[kept], edge=edge[kept], value=x[heads[kept]], n=length[kept])
        member = np.flatnonzero(kept[run])
        rows("member", member, run=number[run[member]], with_id=True)
        inner = edge == 0
        pairs, counts = np.unique(np.stack([group_start[inner], length[inner]]), axis=1, return_counts=True)
        if len(counts):
            rows("length", heads[pairs[0]], run=pairs[1].astype(np.int64), n=counts.astype(np.int64))
    return pa.concat_tables(parts)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of sorted rows in which every group of ``key`` is whole."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(key).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(g != g[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:  # the last group may go on in the next batch
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            held = [b.slice(cut)]
        elif held and held[-1].column(key)[0].as_py() != g[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = [b]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _scan(rules: Rules, halo_us: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in _whole_groups(batches, "g"):
            c = {n: tab.column(n).to_numpy() for n in ("g", "t", "value", "shard", "timed")}
            yield from _scan_groups(c, tab.column("sid").combine_chunks(), tab.column("id").combine_chunks(), rules, halo_us).to_batches(max_chunksize=100_000)

    return scan


def _scan_edges(rules: Rules, halo_us: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The excursions among the readings near the edges of shards, from rows sorted by source, shard and place."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in _whole_groups(batches, "sid"):
            sid = tab.column("sid").combine_chunks().dictionary_encode().indices.to_numpy()
            shard, place = tab.column("shard").to_numpy(), tab.column("run").to_numpy()
            # a new piece starts with a source, and where a shard's readings between its edges are left out
            new = np.ones(len(sid), bool)
            new[1:] = (sid[1:] != sid[:-1]) | ((shard[1:] == shard[:-1]) & (place[1:] != place[:-1] + 1))
            hit = excursions(np.cumsum(new), tab.column("n").to_numpy(), tab.column("value").to_numpy(), rules, halo_us) & (tab.column("edge").to_numpy() == 1)
            yield from tab.select(["id"]).filter(pa.array(hit)).to_batches()

    return scan


def readings_once(df: DataFrame, entity: str, record: str, value: str, instant_us: str) -> DataFrame:
    """(sid, id, value, t): one row for each delivered record with a value; NaN values and null keys don't count."""
    return (
        df.select(F.col(entity).alias("sid"), F.col(record).alias("id"), F.col(value).cast("double").alias("value"), F.col(instant_us).alias("t"))
        .filter("sid is not null and id is not null and value is not null and not isnan(value)")
        .groupBy("sid", "id")
        .agg(F.max("value").alias("value"), F.max("t").alias("t"))
    )


def _frozen_from(lengths: Column, runs: Column, rules: Rules) -> Column:
    """Length from which on the runs of a source are frozen, null if none is; ``lengths`` is its sorted (len, upto, n), ``runs`` their number.

    A length is judged by the shorter runs alone, so that neither the run itself nor other frozen ones raise what counts
    as typical, however few runs there are. What at least half of the runs reach is the source's own way, not frozen;
    a run that is the only one is judged by ``least_run``.
    """

    def stands_out(x: Column) -> Column:
        shorter = x["upto"] - x["n"]
        typical = F.filter(lengths, lambda y: (y["len"] < x["len"]) & (y["upto"] / shorter >= rules.typical_share))
        far = x["len"] >= F.ceil(F.coalesce(F.get(typical, F.lit(0))["len"], F.lit(0)) * rules.run_factor)
        return (x["len"] >= rules.least_run) & (F.greatest(shorter, F.lit(1)) >= runs - shorter) & far

    return F.get(F.filter(lengths, stands_out), F.lit(0))["len"]


def implausible_readings(df: DataFrame, entity: str, record: str, value: str, instant_us: str, *, rules: Rules = Rules(), shard_seconds: int = SHARD_SECONDS, halo_seconds: int | None = None) -> DataFrame:
    """(record, reason) of the readings that are impossible, part of an excursion, or part of a frozen run.

    ``instant_us`` is a column of microseconds; readings without an instant are judged by the bounds alone. A record
    delivered several times counts once. What is near a shard's edges is judged for excursions with the readings of the
    shards beside it, however far off (``halo_seconds`` limits the silence between neighbours, if given), from at most
    4 * ``rules.reach`` rows a shard. Runs may cross shards: runs at a shard's edges are joined through a scan over at most two rows a shard. The length a frozen run must have comes from the run lengths of the whole source (see ``_frozen_from``).
    """
    once = readings_once(df, entity, record, value, instant_us)
    halo_us = None if halo_seconds is None else halo_seconds * 1_000_000
    # readings without an instant are spread by their ids
    shard = F.coalesce(F.floor(F.col("t") / (shard_seconds * 1_000_000)), -(1 << 40) - F.pmod(F.xxhash64("id"), F.lit(256)))
    sharded = once.select("sid", "id", "value", shard.alias("shard"), F.coalesce("t", F.lit(0)).alias("t"), F.col("t").isNotNull().alias("timed")).withColumn("g", F.xxhash64("sid", "shard"))
    found = materialize(sharded.repartition("sid", "shard").sortWithinPartitions("g", "sid", "shard", "t", "id").mapInArrow(_scan(rules, halo_us), _OUT))
    near = found.filter("kind = 'near'").select("sid", "shard", "run", "edge", "value", "n", "id").repartition("sid").sortWithinPartitions("sid", "shard", "run")
    across = near.mapInArrow(_scan_edges(rules, halo_us), "id string").select("id", F.lit("excursion").alias("reason"))

    runs = found.filter("kind = 'run'")
    order = Window.partitionBy("sid").orderBy("shard", "run")
    edges = (
        runs.filter("edge > 0")
        .withColumn("joined", F.coalesce((F.lag("value").over(order) == F.col("value")) & (F.lag("shard").over(order) != F.col("shard")), F.lit(False)))
        .withColumn("chain", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(order))
        .withColumn("total", F.sum("n").over(Window.partitionBy("sid", "chain")))
    )
    lengths = (
        found.filter("kind = 'length'").select("sid", F.col("run").alias("len"), "n")
        .unionByName(edges.groupBy("sid", "chain").agg(F.max("total").alias("len")).select("sid", "len", F.lit(1).cast("bigint").alias("n")))
        .groupBy("sid", "len").agg(F.sum("n").alias("n"))
    )
    by_length = Window.partitionBy("sid").orderBy("len")
    longest = lengths.withColumn("upto", F.sum("n").over(by_length)).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("len", "upto", "n"))).alias("r"), F.sum("n").alias("all"))
    candidates = edges.select("sid", "shard", "run", "total").unionByName(runs.filter("edge = 0").select("sid", "shard", "run", F.col("n").alias("total"))).filter(F.col("total") >= rules.least_run)
    frozen = candidates.join(longest.select("sid", _frozen_from(F.col("r"), F.col("all"), rules).alias("least")), "sid").filter(F.col("total") >= F.col("least")).select("sid", "shard", "run")
    members = found.filter("kind = 'member'").join(frozen, ["sid", "shard", "run"]).select("id", F.lit("frozen").alias("reason"))
    return members.unionByName(across).unionByName(found.filter("kind in ('excursion', 'impossible')").select("id", F.col("kind").alias("reason"))).select(F.col("id").alias(record), "reason")
