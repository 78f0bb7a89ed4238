"""What changed between consecutive full snapshots.

Keys and contents travel as fixed-width numbers (a 128-bit key, a 128-bit content), in many small hash buckets; as many
whole buckets as fit in memory are sorted in numpy together, and neighbouring snapshots are compared with
``searchsorted``. Full key values are fetched only for the keys that differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets, and the rows (about 60 bytes each) from which on the buckets held are compared: one bucket has fewer up to 3 * 10**10 rows.
BUCKETS, ROWS_AT_ONCE = 1 << 16, 500_000
CHANGES = ("added", "removed", "changed")
_COMPACT = ("bucket", "src", "k1", "k2", "snap", "more", "seen", "present", "h1", "h2")
_COMPACT_SCHEMA = "bucket int, src bigint, k1 bigint, k2 bigint, snap int, more boolean, seen bigint, present boolean, h1 bigint, h2 bigint"


def content_words(value: Column) -> tuple[Column, Column]:
    """The two 64-bit halves of a 16-byte value written as hex (any case, dashes, 0x..., x'...', \\x...) or base64.

    Any other text counts by two hashes of its trimmed form; null is a content of its own.
    """
    bare = F.regexp_replace(F.lower(F.trim(value)), r"^(0x|x'|\\\\x|\{)|['}]$|-", "")
    b64 = F.lower(F.hex(F.try_to_binary(F.when(F.trim(value).rlike(r"^[A-Za-z0-9+/]{22}==$"), F.trim(value)), F.lit("base64"))))
    hexed = F.when(bare.rlike("^[0-9a-f]{32}$"), bare).otherwise(b64)
    half = lambda at: F.conv(F.substring(hexed, at, 16), 16, -10).try_cast("long")
    other = F.coalesce(F.trim(value), F.lit("\u0000null"))
    return F.coalesce(half(1), F.xxhash64(other)), F.coalesce(half(17), F.xxhash64(F.lit("second"), other))


def _columns(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    return {n: batch.column(n).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(n).to_numpy() for n in batch.schema.names}


def _latest(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of the rows of a key in one snapshot, the last seen; of those a present one, of those the largest content."""
    order = np.lexsort((c["h2"], c["h1"], c["present"], c["seen"], c["snap"], c["k2"], c["k1"]))
    c = {n: v[order] for n, v in c.items()}
    last = np.ones(len(order), bool)
    last[:-1] = (c["k1"][1:] != c["k1"][:-1]) | (c["k2"][1:] != c["k2"][:-1]) | (c["snap"][1:] != c["snap"][:-1])
    return {n: v[last] for n, v in c.items()}


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the shuffle: repeated rows of a key within a batch become one, so that a hot key stays small."""
    for b in batches:
        if b.num_rows:
            c = _latest(_columns(b))
            yield pa.RecordBatch.from_arrays([pa.array(c[n], type=b.schema.field(n).type) for n in b.schema.names], schema=b.schema)


def diff_bucket(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The differences of one bucket or several: source, key words, later snapshot number and change code of each."""
    c = _latest(c)
    first = np.ones(len(c["k1"]), bool)
    first[1:] = (c["k1"][1:] != c["k1"][:-1]) | (c["k2"][1:] != c["k2"][:-1])
    ident = np.cumsum(first)  # sorted by key: the number of the key is an exact stand-in for its 128 bits
    out: list[dict[str, np.ndarray]] = []
    top = int(c["snap"].max()) if len(ident) else 0
    at = {s: np.flatnonzero((c["snap"] == s) & c["present"]) for s in range(1, top + 1)}

    def emit(rows: np.ndarray, snap: int, code: int) -> None:
        if len(rows):
            out.append({"src": c["src"][rows], "k1": c["k1"][rows], "k2": c["k2"][rows], "snap": np.full(len(rows), snap, np.int32), "change": np.full(len(rows), code, np.int32)})

    none = np.zeros(0, np.int64)
    for s in range(1, top + 1):
        old, new = at[s], at.get(s + 1, none)
        a, b = ident[old], ident[new]  # both sorted
        pos = np.searchsorted(b, a)
        hit = pos < len(b)
        hit[hit] = b[pos[hit]] == a[hit]
        emit(old[~hit & c["more"][old]], s + 1, 1)
        was, now = old[hit], new[pos[hit]]
        emit(now[(c["h1"][was] != c["h1"][now]) | (c["h2"][was] != c["h2"][now])], s + 1, 2)
        if len(b):
            pos = np.searchsorted(a, b)
            hit = pos < len(a)
            hit[hit] = a[pos[hit]] == b[hit]
            emit(new[~hit], s + 1, 0)
    names = ("src", "k1", "k2", "snap", "change")
    return {n: np.concatenate([x[n] for x in out]) if out else np.zeros(0, np.int64) for n in names}


def _diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("src", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("snap", pa.int32()), ("change", pa.int32())])
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        d = diff_bucket(_columns(pa.Table.from_batches(held)))
        return pa.RecordBatch.from_arrays([pa.array(d[n], type=schema.field(n).type) for n in schema.names], schema=schema)

    n = 0
    for b in batches:  # sorted by bucket: what is held may be cut where the bucket changes
        while b.num_rows:
            bucket = b.column("bucket").to_numpy()
            if n >= ROWS_AT_ONCE and bucket[0] != held[-1].column("bucket")[-1].as_py():
                yield flush()
                held, n = [], 0
            cut = len(bucket)
            if n + cut > ROWS_AT_ONCE:  # up to the end of the bucket in which the limit is reached
                cut = int(np.searchsorted(bucket, bucket[max(0, ROWS_AT_ONCE - n - 1)], side="right"))
            held.append(b.slice(0, cut))
            n += cut
            b = b.slice(cut)
    if held:
        yield flush()


def snapshot_changes(records: DataFrame, generations: DataFrame, *, key="physical_record_id", source="source_db_id", generation="last_seen_generation", seen="last_seen_at", status="status", content="content_hash", generation_id="generation_id", scanned="scanned_at", active="ACTIVE") -> DataFrame:
    """(generation_id, key, change_type) of every copy added, removed or changed between consecutive snapshots of its source.

    The snapshots of a source are the generations in which it has any row, by ``scanned`` (then id); the first is
    compared with nothing. Rows of a key in one generation count as the one seen last (ties: a present one first, then
    the largest content); an unreadable ``seen`` counts as earliest. Rows without key, source or a known generation
    don't count. Empty tables give no rows; further columns are not read. ``source`` is an integer column.
    """
    gens = generations.select(F.col(generation_id).alias("gen"), F.col(scanned).alias("scanned")).groupBy("gen").agg(F.min("scanned").alias("scanned"))
    base = records.select(F.col(key).alias("key"), F.col(source).cast("bigint").alias("src"), F.col(generation).alias("gen"), F.col(seen).alias("seen"), F.col(status).alias("status"), F.col(content).alias("content")).dropna(subset=["key", "src", "gen"])
    # one row for each source and generation: tables of fixed size in the number of records
    order = Window.partitionBy("src").orderBy("scanned", "gen")
    snaps = base.select("src", "gen").distinct().join(gens, "gen").withColumn("snap", F.row_number().over(order)).withColumn("more", F.lead("snap").over(order).isNotNull()).select("src", "gen", "snap", "more")
    k1, k2 = F.xxhash64("key", "src"), F.xxhash64(F.lit("second"), "src", "key")
    h1, h2 = content_words(F.col("content"))
    compact = base.join(snaps, ["src", "gen"]).select(
        F.pmod(k1, F.lit(BUCKETS)).cast("int").alias("bucket"), "src", k1.alias("k1"), k2.alias("k2"), "snap", "more",
        F.coalesce(F.unix_micros(F.col("seen").try_cast("timestamp")), F.lit(-(1 << 62))).alias("seen"), F.coalesce(F.col("status") == active, F.lit(False)).alias("present"), h1.alias("h1"), h2.alias("h2"),
    )
    changes = compact.mapInArrow(_combine, _COMPACT_SCHEMA).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_diff, "src bigint, k1 bigint, k2 bigint, snap int, change int")
    named = changes.join(snaps.select("src", "snap", "gen"), ["src", "snap"]).select("src", "k1", "k2", F.col("gen").alias("changed_in"), "change")
    # one row for each key and task before the shuffle, on the join's keys
    names = base.groupBy("src", k1.alias("k1"), k2.alias("k2")).agg(F.min("key").alias("key"))
    return names.join(named, ["src", "k1", "k2"]).select(F.col("changed_in").alias("generation_id"), F.col("key").alias(key), F.element_at(F.array(*map(F.lit, CHANGES)), F.col("change") + 1).alias("change_type"))
