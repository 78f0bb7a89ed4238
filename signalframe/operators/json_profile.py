"""Which keys JSON texts have, at any depth, also in arrays and in texts that are JSON themselves."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = pa.schema([("path", pa.string()), ("kind", pa.string()), ("n", pa.int64()), ("lowest", pa.float64()), ("highest", pa.float64())])


def walk(value) -> Iterator[tuple[str, object]]:
    """(path, value) of every field inside, containers too; items of arrays share the path ``[]``, JSON in texts ``{json}``."""
    stack = [("", value)]
    while stack:
        at, v = stack.pop()
        if isinstance(v, str) and v[:1] in "{[":
            with suppress(ValueError, RecursionError):
                stack.append((at + "{json}", json.loads(v)))
        elif isinstance(v, dict):
            for k, x in v.items():
                path = f"{at}.{k}" if at else k
                yield path, x
                if isinstance(x, (dict, list)) or (isinstance(x, str) and x):
                    stack.append((path, x))
        elif isinstance(v, list):
            stack += [(f"{at}[]", x) for x in v if isinstance(x, (dict, list)) or (isinstance(x, str) and x)]


KINDS = {bool: "boolean", int: "number", float: "number", str: "string", dict: "object", list: "array"}


def json_keys(df: DataFrame, text: str, pattern: str = "") -> DataFrame:
    """(path, kind, n, lowest, highest) of the fields whose path matches, over all texts; broken texts have none.

    Counted within each batch before the shuffle: what is sent on are key names, not values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(pattern).search
        for b in batches:
            found: dict[tuple[str, str], list] = {}
            for t in b.column(0).to_pylist():
                try:
                    v = json.loads(t) if t else None
                except (ValueError, RecursionError):
                    continue
                if not isinstance(v, (dict, list)):
                    continue
                for path, x in walk(v):
                    if wanted(path):
                        kind = KINDS.get(type(x), "null")
                        e = found.setdefault((path, kind), [0, math.inf, -math.inf])
                        e[0] += 1
                        if kind == "number" and math.isfinite(x):
                            e[1], e[2] = min(e[1], x), max(e[2], x)
            rows = [(p, k, n, a if a <= z else None, z if a <= z else None) for (p, k), (n, a, z) in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA)

    counted = df.select(F.col(text).cast("string")).mapInArrow(run, "path string, kind string, n bigint, lowest double, highest double")
    return counted.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))
