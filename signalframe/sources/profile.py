"""The dated profiles of subjects as a checked table, and tables kept in texts.

Both are read by Spark and checked by rules over columns: what breaks one is listed with its reason, nothing is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identity import digest

#: The fields of a profile, and those of them that are positive numbers.
NUMBERS = ("height_cm", "weight_kg", "sleep_target_min", "max_hr_bpm", "rhr_override_bpm", "waist_cm")
FIELDS = ("timezone", "date_of_birth", "sex", *NUMBERS)
_FILE = "schema_version int, sid string, values array<struct<field: string, value: variant, effective_from: string, effective_to: string>>"


class BadProfile(ValueError):
    """Entries that break a rule, with the rule."""


def read_profiles(spark: SparkSession, *paths: str) -> DataFrame:
    """Entries (sid, field, value, effective_from, effective_to, raw) of JSON files, one subject each; days are day numbers.

    A file without entries gives none. ``sid`` is that of the file, "" in a file without (a single subject's).
    """
    parsed = spark.read.text(list(paths), wholetext=True).select(F.from_json("value", _FILE).alias("p"), "value")
    known = F.when(F.col("p.schema_version") == 1, F.col("p.values"))
    entries = F.coalesce(known, F.array(F.struct(F.lit("?").alias("field"), F.parse_json(F.lit("null")).alias("value"), F.lit(None).cast("string").alias("effective_from"), F.lit(None).cast("string").alias("effective_to"))))
    day = lambda c: F.datediff(F.try_to_date(F.col(f"e.{c}"), "yyyy-MM-dd"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return parsed.select(F.coalesce("p.sid", F.lit("")).alias("sid"), F.explode(entries).alias("e")).select(
        "sid", "e.field", F.try_variant_get("e.value", "$", "string").alias("value"), day("effective_from").alias("effective_from"), day("effective_to").alias("effective_to"),
        F.schema_of_variant("e.value").alias("kind"), (F.col("e.effective_to").isNotNull() & day("effective_to").isNull()).alias("odd_end"),
    )


def problems(entries: DataFrame, zones: list[str]) -> DataFrame:
    """(sid, field, effective_from, problem) of each entry that breaks a rule; overlaps are found by the entry before."""
    w = Window.partitionBy("sid", "field").orderBy("effective_from", F.col("effective_to").asc_nulls_last())
    number = F.when(~F.col("kind").isin("STRING", "BOOLEAN"), F.col("value").try_cast("double"))
    # of all entries before: the last day that any of them holds
    reach = F.max(F.coalesce("effective_to", F.lit((1 << 62)))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rules: dict[str, Column] = {
        "no field of a profile": ~F.coalesce(F.col("field").isin(*FIELDS), F.lit(False)),
        "no value": F.col("value").isNull(),
        "no first day": F.col("effective_from").isNull(),
        "no last day": F.col("odd_end"),
        "ends before it begins": F.col("effective_to") < F.col("effective_from"),
        "no positive number": F.col("field").isin(*NUMBERS) & F.col("value").isNotNull() & ~F.coalesce((number > 0) & (number < float("inf")), F.lit(False)),
        "no time zone": (F.col("field") == "timezone") & F.col("value").isNotNull() & ~F.coalesce(F.col("value").isin(zones), F.lit(False)),
        "no date": (F.col("field") == "date_of_birth") & F.col("value").isNotNull() & F.try_to_date("value", "yyyy-MM-dd").isNull(),
        "overlaps another": F.col("__reach") >= F.col("effective_from"),
    }
    found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return entries.withColumn("__reach", reach).withColumn("problem", F.explode(found)).select("sid", "field", "effective_from", "problem")


def checked(entries: DataFrame, zones: list[str]) -> DataFrame:
    """The entries (sid, field, value, effective_from, effective_to); an error that names some of the problems, if there are any."""
    bad = problems(entries, zones).limit(5).collect()
    if bad:
        raise BadProfile("; ".join(f"{r['sid']} {r['field']} {r['effective_from']}: {r['problem']}" for r in bad))
    return entries.select("sid", "field", "value", "effective_from", "effective_to")


def numbers(entries: DataFrame) -> DataFrame:
    """The entries that are numbers, with ``value`` as one."""
    return entries.filter(F.col("field").isin(*NUMBERS)).withColumn("value", F.col("value").cast("double"))


def revision(entries: DataFrame) -> str:
    """A hash of all entries, in no order; that of no entries for an empty profile."""
    row = digest(*[F.col(c) for c in ("sid", "field", "value", "effective_from", "effective_to")])
    halves = [F.sum(F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16)]
    got = entries.agg(F.count("*").alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(halves)]).select(digest(F.col("n"), F.col("h0"), F.col("h1")))
    return got.first()[0]


#: The columns of the capability table.
TABLE_COLUMNS = ("metric", "project", "algorithm", "required", "available", "coverage", "status", "missing", "notes")


def text_table(lines: DataFrame, statuses: set[str]) -> DataFrame:
    """Rows ``| #id name | ... |`` of nine cells out of lines (column ``value``); a bad row, status or repeated id fails when it is read."""
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = lines.filter(F.col("value").startswith("| #")).select("value", cells.alias("c")).withColumns({"id": F.regexp_extract(F.get("c", F.lit(0)), r"^#(\d+[a-z]?)\s+\S", 1)})
    rows = rows.withColumn("times", F.count("*").over(Window.partitionBy("id")))
    bad = (F.size("c") != len(TABLE_COLUMNS)) | (F.col("id") == "") | (F.col("times") > 1) | ~F.get("c", F.lit(TABLE_COLUMNS.index("status"))).isin(*statuses)
    name = F.regexp_replace(F.get("c", F.lit(0)), r"^#\d+[a-z]?\s+", "")
    guard = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("bad row: "), F.col("value"))).cast("string")).otherwise(F.col("id"))
    return rows.select(guard.alias("id"), name.alias(TABLE_COLUMNS[0]), *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(TABLE_COLUMNS) if i])
