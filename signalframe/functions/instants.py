"""Mixed timestamp spellings to one instant, inside the JVM.

Every spelling is one branch of a single regular expression with named groups. One ``regexp_replace`` rewrites a
text into a fixed row of components (groups of branches that did not match are empty), the ranges of the components
are validated, and the instant is assembled through integer day arithmetic. No text is parsed twice and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: English month abbreviations of the mail date format, in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_CLOCK = r"(?<{p}h>\d{{1,2}}):(?<{p}i>\d{{2}})(?::(?<{p}s>\d{{2}})(?:[.,](?<{p}f>\d{{1,9}}))?)?"
_ZONE = r" ?(?<{p}z>Z|z|UTC|GMT|[+-]\d{{2}}(?::?\d{{2}})?)?(?:\[(?<{p}n>[A-Za-z0-9_+/-]+)\])?"

#: One branch for each spelling; the first letter of a group's name is the branch.
BRANCHES = (
    r"(?<eSec>\d{9,11})(?:\.(?<ef>\d{1,9}))?",
    r"(?<eMil>\d{13})",
    r"(?<eMic>\d{16})",
    r"(?<eNan>\d{19})",
    (r"(?<iy>\d{{4}})[-/](?<im>\d{{1,2}})[-/](?<id>\d{{1,2}})[T ]" + _CLOCK + _ZONE).format(p="i"),
    (r"(?<by>\d{{4}})(?<bm>\d{{2}})(?<bd>\d{{2}})[T ]?(?<bh>\d{{2}})(?<bi>\d{{2}})(?:(?<bs>\d{{2}})(?:[.,](?<bf>\d{{1,9}}))?)?" + _ZONE).format(p="b"),
    (r"(?<dd>\d{{1,2}})\.(?<dm>\d{{1,2}})\.(?<dy>\d{{4}}),?[T ]" + _CLOCK + _ZONE).format(p="d"),
    (r"(?<sa>\d{{1,2}})/(?<sb>\d{{1,2}})/(?<sy>\d{{4}}),?[T ]" + _CLOCK + r"(?: ?(?<sp>[AaPp])\.?[Mm]\.?)?" + _ZONE).format(p="s"),
    (r"(?:[A-Za-z]{{3}},? )?(?<rd>\d{{1,2}})[ -](?<rM>[A-Za-z]{{3}})[a-z]*[ -](?<ry>\d{{4}}) " + _CLOCK + _ZONE).format(p="r"),
)
PATTERN = "^(?:" + "|".join(BRANCHES) + ")$"

#: The row of components: position, and the groups of which at most one matched.
_SLOTS = ("eSec", "ef", "eMil", "eMic", "eNan", "iy by dy sy ry", "im bm dm", "id bd dd rd", "ih bh dh sh rh", "ii bi di si ri", "is bs ds ss rs", "if bf df sf rf", "iz bz dz sz rz", "in bn dn sn rn", "sa", "sb", "sp", "rM")
_ROW = "#" + "|".join("".join("${" + g + "}" for g in slot.split()) for slot in _SLOTS) + "|."


def known_zones(spark: SparkSession) -> list[str]:
    """Every zone id of the JVM; others would make the zone functions fail."""
    ids = spark.sql("select java_method('java.time.ZoneId', 'getAvailableZoneIds')").first()[0]
    return sorted(ids.strip("[]").split(", "))


def zone_or_null(zone: Column, zones: list[str]) -> Column:
    return F.when(zone.isin(zones), zone)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a Gregorian date, in integer arithmetic (years from 1 on)."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    doe = yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy
    return (era * 146097 + doe - 719468).cast("long")


def days_in_month(y: Column, m: Column) -> Column:
    leap = (F.pmod(y, F.lit(4)) == 0) & ((F.pmod(y, F.lit(100)) != 0) | (F.pmod(y, F.lit(400)) == 0))
    return F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(leap, 29).otherwise(28)).otherwise(31)


def components(text: Column) -> Column:
    """Array of components of a text, null where no branch matches the whole text."""
    row = F.regexp_replace(F.trim(text), F.lit(PATTERN), F.lit(_ROW))
    return F.when(F.substring(row, 1, 1) == "#", F.split(F.substring(row, 2, 1 << 20), r"\|"))


def _num(parts: Column, slot: str) -> Column:
    return F.try_element_at(parts, F.lit(_SLOTS.index(slot) + 1)).try_cast("long")


def _text(parts: Column, slot: str) -> Column:
    t = F.try_element_at(parts, F.lit(_SLOTS.index(slot) + 1))
    return F.when(t != "", t)


def _micros(fraction: Column) -> Column:
    """Microseconds of the digits after a decimal point; further digits are cut off."""
    return F.coalesce(F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("long"), F.lit(0))


def with_instant(df, text: str, offset: str | None, zone: str | None, local_date: str | None, out: str = "instant_us"):
    """Add ``out``: microseconds since the epoch of the instant that ``text`` denotes, else null.

    - A text with an offset or Z is taken at it; one without is local wall time at column ``offset`` (seconds), else in
      ``zone`` (unknown zone ids count as null; of two possible instants the earlier), else it denotes no instant.
    - Day and month of slashed dates: with AM/PM month first, else day first; where only one order is a date, or only
      one gives ``local_date`` (ISO), that order.
    - Impossible dates and clock times, blanks, nulls and other texts denote no instant.
    Extra columns stay untouched; helper columns start with ``__instant_`` and are dropped.
    """
    zones = known_zones(df.sparkSession)
    null_long, null_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    plain = F.col(text).rlike(r"^\d{10}$")
    df = df.withColumn("__instant_p_", F.when(~plain, components(F.col(text))))
    p = F.col("__instant_p_")
    seconds_off = F.col(offset).cast("long") if offset else null_long
    zone_col = zone_or_null(F.col(zone), zones) if zone else null_text
    date = F.to_date(F.when(F.col(local_date).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.col(local_date), "yyyy-MM-dd"))) if local_date else F.lit(None).cast("date")
    month_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(_text(p, "rM"))).cast("long")
    parsed = {
        "y": _num(p, _SLOTS[5]), "m": F.coalesce(_num(p, _SLOTS[6]), month_name), "d": _num(p, _SLOTS[7]), "h": _num(p, _SLOTS[8]), "i": _num(p, _SLOTS[9]),
        "s": F.coalesce(_num(p, _SLOTS[10]), F.lit(0)), "us": _micros(_text(p, _SLOTS[11])), "z": _text(p, _SLOTS[12]), "zn": _text(p, _SLOTS[13]),
        "a": _num(p, "sa"), "b": _num(p, "sb"), "ap": F.lower(_text(p, "sp")), "date": date,
        "epoch": F.coalesce(_num(p, "eSec") * 1_000_000 + _micros(_text(p, "ef")), _num(p, "eMil") * 1000, _num(p, "eMic"), F.floor(_num(p, "eNan") / 1000).cast("long")),
    }
    # flat columns, not one struct: the optimizer would copy a struct's fields into each use
    df = df.withColumns({f"__instant_{k}": v for k, v in parsed.items()})
    c = {k: F.col(f"__instant_{k}") for k in parsed}
    y = c["y"]
    fits = lambda m, d: F.coalesce(m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m)), F.lit(False))
    agrees = lambda m, d: F.coalesce((F.year(c["date"]) == y) & (F.month(c["date"]) == m) & (F.dayofmonth(c["date"]) == d), F.lit(False))
    us_order = fits(c["a"], c["b"])
    eu_order = fits(c["b"], c["a"])
    month_first = F.when(us_order & ~eu_order, True).when(eu_order & ~us_order, False).when(agrees(c["a"], c["b"]), True).when(agrees(c["b"], c["a"]), False).otherwise(c["ap"].isNotNull())
    df = df.withColumn("__instant_first_", month_first)
    month_first = F.col("__instant_first_")
    df = df.withColumn("__instant_mo_", F.when(c["a"].isNull(), c["m"]).otherwise(F.when(month_first, c["a"]).otherwise(c["b"])))
    df = df.withColumn("__instant_da_", F.when(c["a"].isNull(), c["d"]).otherwise(F.when(month_first, c["b"]).otherwise(c["a"])))
    hour = F.when(c["ap"].isNull(), c["h"]).when(c["h"].between(1, 12), F.pmod(c["h"], F.lit(12)) + F.when(c["ap"] == "p", 12).otherwise(0))
    valid = fits(F.col("__instant_mo_"), F.col("__instant_da_")) & (y >= 1) & hour.between(0, 23) & c["i"].between(0, 59) & c["s"].between(0, 59)
    local = F.when(valid, days_from_civil(y, F.col("__instant_mo_"), F.col("__instant_da_")) * 86400 + hour * 3600 + c["i"] * 60 + c["s"])
    digits = F.regexp_replace(c["z"], "[^0-9]", "")
    off_h, off_m = F.substring(digits, 1, 2).try_cast("long"), F.coalesce(F.substring(digits, 3, 2).try_cast("long"), F.lit(0))
    own = F.when(c["z"].isNull(), null_long).when(digits == "", 0).when((off_h <= 18) & (off_m <= 59), (off_h * 3600 + off_m * 60) * F.when(F.substring(c["z"], 1, 1) == "-", -1).otherwise(1))
    df = df.withColumn("__instant_l_", local)
    at_zone = lambda z: F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(F.col("__instant_l_")), z))
    named = zone_or_null(c["zn"], zones)
    seconds = (
        F.when(c["z"].isNotNull(), F.col("__instant_l_") - own)
        .when(named.isNotNull(), at_zone(named))
        .when(seconds_off.isNotNull(), F.col("__instant_l_") - seconds_off)
        .when(zone_col.isNotNull(), at_zone(zone_col))
    )
    instant = F.when(plain, F.col(text).try_cast("long") * 1_000_000).when(c["epoch"].isNotNull(), c["epoch"]).otherwise(seconds * 1_000_000 + c["us"])
    # always true, but not to the optimizer: else a filter on the result would carry copies of all of the above below it
    guarded = F.when(F.monotonically_increasing_id() >= 0, instant)
    return df.withColumn(out, guarded).drop("__instant_p_", "__instant_first_", "__instant_mo_", "__instant_da_", "__instant_l_", *[f"__instant_{k}" for k in parsed])
