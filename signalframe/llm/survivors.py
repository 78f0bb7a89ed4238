"""Best representative of a group of copies, field by field.

The values of a field are split into tokens and aligned progressively, each with the group's first value (the centre of a
star-shaped guide tree, so that no group has to be in one place); every column of the alignment is decided by a weighted
vote of its tokens, and the existing value closest to that consensus is taken.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that stand for no value, in lower case.
PLACEHOLDERS = ("", "-", "--", "?", "n/a", "na", "nan", "nil", "none", "null", "tbd", "undefined", "unknown")
_TOKEN = re.compile(r"\w+|[^\w\s]").findall
_LAST = (1 << 63) - 1


def tokens_of(value: str) -> list[str]:
    return _TOKEN(value)


def _anchors(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Positions of the longest series, ascending in both, of the tokens that occur exactly once in each."""
    in_a, in_b = Counter(a), Counter(b)
    place = {t: j for j, t in enumerate(b) if in_b[t] == 1}
    pairs = [(i, place[t]) for i, t in enumerate(a) if in_a[t] == 1 and t in place]
    ends: list[int] = []  # the least last position of a series of each length, and which pair that is
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        back.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            at.append(n)
        else:
            ends[k], at[k] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int | None, int | None]]:
    """An alignment of two token sequences: pairs of positions, None for a gap; n log n steps for any length.

    What both begin and end with is aligned, then the tokens that are unique in what is between; between these, tokens
    are taken in their order, and what one side has more of stands against gaps.
    """
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(first)]
    i, j = first, first
    fixed = [(x + first, y + first) for x, y in _anchors(a[first : len(a) - last], b[first : len(b) - last])]
    for x, y in [*fixed, (len(a) - last, len(b) - last)]:
        k = min(x - i, y - j)
        out += [(i + n, j + n) for n in range(k)]
        out += [(n, None) for n in range(i + k, x)]
        out += [(None, n) for n in range(j + k, y)]
        if x < len(a) - last or y < len(b) - last:
            out.append((x, y))
        i, j = x + 1, y + 1
    return out + [(len(a) - n, len(b) - n) for n in range(last, 0, -1)]


def distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Number of columns of their alignment in which two token sequences differ."""
    return sum(i is None or j is None or a[i] != b[j] for i, j in align(a, b))


def columns_of(centre: Sequence[str], tokens: Sequence[str]) -> Iterator[tuple[int, int, str]]:
    """(pos, k, token) of each token in the alignment with the centre: k = 0 for centre token ``pos`` (from 1), else the k-th put in after it."""
    pos = k = 0
    for i, j in align(centre, tokens):
        pos, k = (i + 1, 0) if i is not None else (pos, k + 1)
        if j is not None:
            yield pos, k, tokens[j]


def consensus(values: Sequence[Sequence[str]], weights: Sequence[int]) -> list[str]:
    """Tokens of the weighted consensus of the values of one group, the first being the centre; what the distributed votes give.

    Of equal votes in a column the centre's token wins, then the greatest; a gap loses only to more votes or the centre's.
    """
    votes: dict[tuple[int, int], Counter[str]] = {}
    for tokens, w in zip(values, weights, strict=True):
        for pos, k, t in columns_of(values[0], tokens):
            votes.setdefault((pos, k), Counter())[t] += w
    out = []
    for (pos, k), c in sorted(votes.items()):
        best = max(c, key=lambda t: (c[t], k == 0 and t == values[0][pos - 1], t))
        gap = sum(weights) - sum(c.values())
        if c[best] > gap or (c[best] == gap and k == 0 and best == values[0][pos - 1]):
            out.append(best)
    return out


def representative(values: Sequence[str], weights: Sequence[int]) -> int:
    """Index of the value closest to the weighted token consensus; of equally close ones the first."""
    split = [tokens_of(v) for v in values]
    agreed = consensus(split, weights)
    return min(range(len(values)), key=lambda i: (distance(split[i], agreed), i))


def filled(text: Column) -> Column:
    """The trimmed text, null where it is blank, a placeholder or a zero (also zeros with separators)."""
    t = F.trim(F.regexp_replace(text, r"[\s ]+", " "))
    return F.when(~F.lower(t).isin(*PLACEHOLDERS) & ~t.rlike(r"^[+-]?[0:/.T -]*$"), t)


def json_text(document: Column, name: str) -> Column:
    """A field of a JSON object as text; null where the document can't be read whole."""
    return F.try_variant_get(F.try_parse_json(document), f"$.{name}", "string")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of values by column of the alignment with the centre of their group."""
    names = ("grp", "field", "pos", "k", "token", "central", "w", "total")
    for b in batches:
        out: list[tuple] = []
        for g, f, v, centre, w, total in zip(*(b.column(n).to_pylist() for n in ("grp", "field", "value", "centre", "w", "total")), strict=True):
            c = tokens_of(centre)
            out += [(g, f, pos, k, t, k == 0 and t == c[pos - 1], w, total) for pos, k, t in columns_of(c, tokens_of(v))]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)


def _distances(kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = [distance(tokens_of(v), agreed or []) for v, agreed in zip(b.column("value").to_pylist(), b.column("agreed").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(far, pa.int64())], names=[*kept, "far"])

    return run


def surviving_fields(copies: DataFrame, fields: dict[str, Column], *, group: str, copy: str, order: list[Column], active: Column, weight: Column | None = None) -> DataFrame:
    """(group, field_name, copy): for every field the copy whose value the one surviving record takes.

    ``copies`` has one row for each copy. Only groups of at least two copies count, active or not; a field's values are
    those of its active copies that have it filled (``fields`` give null where not). ``weight`` is what the vote of a
    copy counts (an integer column, null and less than 0 as 0), for instance of its trust, recency and completeness.
    Without it the votes follow ``order`` strictly: the first copy outweighs all others together. ``order`` (integers,
    greatest first, nulls last; then the smallest copy) also gives the centre of the alignment and decides between equally
    close values and equal ones. No row where no copy has a value.

    Values are counted before they are aligned, every value is aligned alone with its group's centre, and the votes are
    summed with partial aggregates: neither a task nor the driver sees a whole group.
    """
    keys = [f"o{i}" for i in range(len(order))]
    ranks = [F.coalesce(F.try_subtract(F.lit(0).cast("bigint"), o.cast("bigint")), F.lit(_LAST)).alias(k) for k, o in zip(keys, order, strict=True)]
    pair = lambda name, value: F.when(active & value.isNotNull(), F.struct(F.lit(name).alias("field"), value.cast("string").alias("value")))
    w = F.lit(1) if weight is None else F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0))
    named = copies.select(F.col(group).cast("string").alias("grp"), F.col(copy).cast("string").alias("copy"), *ranks, w.cast("bigint").alias("w"), F.array_compact(F.array(*[pair(n, v) for n, v in fields.items()])).alias("cells")).filter("grp is not null and copy is not null")
    by, place = ["grp", "field"], F.struct(*keys, "copy")
    values = named.select("*", F.explode("cells").alias("cell")).groupBy("grp", "cell.field", "cell.value").agg(F.min(place).alias("place"), F.sum("w").alias("w"))
    centres = values.groupBy(*by).agg(F.min(F.struct("place", "value")).alias("first"), F.count("*").alias("n"), F.sum("w").alias("total"))
    settled = centres.filter("n = 1").select(*by, F.col("first.place.copy").alias("copy"))
    disputed = values.join(centres.filter("n > 1").select(*by, F.col("first.value").alias("centre"), "total"), by)
    if weight is None:
        disputed = disputed.withColumns({"w": F.when(F.col("value") == F.col("centre"), F.col("total") + 1).otherwise(F.col("w")), "total": F.col("total") * 2 + 1})
    votes = disputed.select(*by, "value", "centre", "w", "total").mapInArrow(_votes, "grp string, field string, pos int, k int, token string, central boolean, w bigint, total bigint")
    slot = [*by, "pos", "k"]
    tokens = votes.groupBy(*slot, "token", "central").agg(F.sum("w").alias("w"), F.max("total").alias("total"))
    columns = tokens.groupBy(*slot).agg(F.max(F.struct("w", "central", "token")).alias("best"), (F.max("total") - F.sum("w")).alias("gap"))
    won = columns.filter((F.col("best.w") > F.col("gap")) | ((F.col("best.w") == F.col("gap")) & F.col("best.central")))
    agreed = won.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "k", F.col("best.token").alias("t")))), lambda x: x["t"]).alias("agreed"))
    kept = [*by, *keys, "copy"]
    near = disputed.select(*by, "value", "place.*").join(agreed, by, "left").mapInArrow(_distances(kept), ", ".join(["grp string", "field string", *[f"{k} bigint" for k in keys], "copy string", "far bigint"]))
    chosen = near.groupBy(*by).agg(F.min(F.struct("far", *keys, "copy"))["copy"].alias("copy"))
    several = named.groupBy("grp").agg(F.count("*").alias("m")).filter("m > 1").select("grp")
    return settled.unionByName(chosen).join(several, "grp", "left_semi").select(F.col("grp").alias(group), F.col("field").alias("field_name"), F.col("copy").alias(copy))
