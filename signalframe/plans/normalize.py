"""Normalization of raw device records into typed tables, by declarative rules for each source table.

A raw record has the columns of the envelope (sid, the subject; source_record_id, source_table, key, time, time_zero,
zone_offset) and ``value``, a JSON text. Rules say which fields of the JSON go where; nothing is parsed twice. Every
normalized row has its subject.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import local_date
from ..functions.numeric import settled, truthy_or

#: Source tables of samples, with the JSON fields of each target column.
SAMPLES = {
    "heart_rate": {"bpm": "bpm"},
    "spo2": {"value": "spo2"},
    "stress": {"value": "stress"},
    "steps": {"steps": "steps:int", "distance": "distance", "calories": "calories"},
    "calories": {"calories": "calories"},
    "intensity": {},
}
#: The column that a sample must have, and the keys of plain heart rate samples.
NEEDED = {"heart_rate": "bpm", "spo2": "value", "stress": "value"}
HEART_RATE_KEYS = ("heart_rate", "single_heart_rate")
EVENT_KEYS = ("low_heart_rate", "high_heart_rate", "abnormal_heart_rate")
#: Daily columns and their JSON fields, by source table ("!" marks fields in which zero is no value).
DAILY = {
    "heart_rate_day": {"resting_hr": "avg_rhr!", "avg_hr": "avg_hr", "min_hr": "min_hr", "max_hr": "max_hr", "abnormal_hr_count": "abnormal_hr_count"},
    "spo2_day": {"avg_spo2": "avg_spo2", "min_spo2": "min_spo2", "max_spo2": "max_spo2", "low_spo2_count": "lack_spo2_count"},
    "stress_day": {"avg_stress": "avg_stress", "min_stress": "min_stress", "max_stress": "max_stress"},
    "steps_day": {"steps": "steps", "distance": "distance", "step_calories": "calories"},
    "calories_day": {"total_calories": "calories"},
    "intensity_day": {"activity_duration_minutes": "duration"},
    "valid_stand_day": {"standing_count": "count"},
    "vitality": {"vitality": "latest_accumulated_vitality"},
    "sleep_day": {
        "sleep_total_minutes": "total_duration", "deep_sleep_minutes": "sleep_deep_duration", "light_sleep_minutes": "sleep_light_duration", "rem_sleep_minutes": "sleep_rem_duration",
        "awake_minutes": "sleep_awake_duration", "nap_minutes": "sleep_nap_duration", "sleep_score": "sleep_score", "breathing_quality": "breath_quality", "avg_hr": "avg_hr", "min_hr": "min_hr",
        "max_hr": "max_hr", "avg_spo2": "avg_spo2", "min_spo2": "min_spo2", "max_spo2": "max_spo2",
    },
}
SLEEP_FIELDS = {
    "duration_minutes": "duration", "deep_minutes": "sleep_deep_duration", "light_minutes": "sleep_light_duration", "rem_minutes": "sleep_rem_duration", "awake_minutes": "sleep_awake_duration", "sleep_score": "sleep_score",
    "sleep_efficiency": "sleep_efficiency", "avg_hr": "avg_hr", "min_hr": "min_hr", "max_hr": "max_hr", "avg_spo2": "avg_spo2", "min_spo2": "min_spo2", "max_spo2": "max_spo2", "avg_respiratory_rate": "avg_breath",
    "breathing_quality": "breath_quality", "awake_count": "awake_count:int",
}
WORKOUT_FIELDS = {
    "duration_seconds": "duration", "avg_hr": "avg_hrm", "min_hr": "min_hrm", "max_hr": "max_hrm", "training_load": "train_load", "recovery_time": "recover_time", "aerobic_effect": "train_effect",
    "anaerobic_effect": "anaerobic_train_effect", "vitality": "vitality",
}
STAGES = {2: "deep", 3: "light", 4: "rem", 5: "awake"}
UNFLATTENED = ("time", "date_time", "start_time", "end_time")
#: Source tables of so many rows that their payload isn't flattened.
HIGH_VOLUME = ("heart_rate", "spo2", "stress", "steps", "calories", "intensity", "sleep", "valid_stand")
DEPTH = 4


@dataclass(frozen=True)
class Json:
    """Guarded access to the fields of a variant."""

    of: Column

    def get(self, path: str, kind: str = "variant") -> Column:
        return F.try_variant_get(self.of, f"$.{path}", kind)

    def kind(self, path: str) -> Column:
        return F.schema_of_variant(self.get(path))

    def real(self, path: str) -> Column:
        """A number, or a text that is one; true and false are no numbers."""
        return F.when(self.kind(path) != "BOOLEAN", self.get(path, "double"))

    def whole(self, path: str) -> Column:
        """An integer: numbers are cut toward zero, texts must be integer literals."""
        text = F.trim(self.get(path, "string"))
        number = F.when((self.kind(path) != "BOOLEAN") & (self.kind(path) != "STRING"), F.when(F.abs(self.get(path, "double")) < 9.2e18, self.get(path, "double").cast("bigint")))
        return F.coalesce(F.when(self.kind(path).startswith("BIGINT"), self.get(path, "bigint")), number, F.when((self.kind(path) == "STRING") & text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")))

    def field(self, spec: str) -> Column:
        if spec.endswith(":int"):
            return self.whole(spec[:-4])
        return F.nullif(self.real(spec[:-1]), F.lit(0.0)) if spec.endswith("!") else self.real(spec)


def number_of(v: Column) -> Column:
    """The number that a variant is, or that its text denotes; true and false are no numbers."""
    return F.when(F.schema_of_variant(v) != "BOOLEAN", F.try_variant_get(v, "$", "double"))


def with_payload(raw: DataFrame) -> DataFrame:
    """Add the parsed payload (null if it isn't a JSON object) and the local date of the record."""
    v = F.try_parse_json("value")
    v = F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    return raw.withColumn("payload", settled(v)).withColumn("local_date", local_date(F.col("time"), F.col("zone_offset"), F.col("time_zero")))


def samples(raw: DataFrame, source_table: str) -> DataFrame:
    """Samples of one source table: time of the payload (zero counts as none) or else of the record, and its values."""
    j = Json(F.col("payload"))
    rows = with_payload(raw.filter(F.col("source_table") == source_table))
    if source_table == "heart_rate":
        rows = rows.filter(F.col("key").isin(*HEART_RATE_KEYS))
    at = truthy_or(j.whole("time"), F.col("time"))
    offset = F.coalesce("zone_offset", F.lit(0))
    out = rows.select("sid", "source_record_id", settled(at).alias("timestamp_utc"), "zone_offset", "key", *[j.field(f).alias(c) for c, f in SAMPLES[source_table].items()])
    out = out.withColumn("local_timestamp", F.col("timestamp_utc") + offset).withColumn("local_date", local_date(F.col("timestamp_utc"), F.col("zone_offset")))
    need = NEEDED.get(source_table)
    return out.filter(F.col("timestamp_utc").isNotNull() & (F.col(need).isNotNull() if need else F.lit(True))).withColumnsRenamed({"zone_offset": "utc_offset_seconds", "key": "kind"})


def _items(path: str) -> Column:
    return F.try_variant_get("payload", f"$.{path}", "array<variant>")


def heart_rate_events(raw: DataFrame) -> DataFrame:
    """Events of low, high or abnormal heart rate: number of items, least and greatest value."""
    j = Json(F.col("payload"))
    values = F.transform(_items("items"), lambda i: F.try_variant_get(i, "$.value", "double"))
    rows = with_payload(raw.filter((F.col("source_table") == "heart_rate") & F.col("key").isin(*EVENT_KEYS)))
    return rows.select(
        "sid", "source_record_id", F.col("key").alias("event_type"), j.whole("start_time").alias("start_timestamp_utc"), truthy_or(j.whole("end_time"), F.col("time")).alias("end_timestamp_utc"), "local_date",
        F.coalesce(F.size(_items("items")), F.lit(0)).alias("sample_count"), F.array_min(values).alias("min_bpm"), F.array_max(values).alias("max_bpm"),
    )


def heart_rate_event_samples(raw: DataFrame) -> DataFrame:
    """Items of the events; items that are no objects are skipped, positions stay."""
    rows = with_payload(raw.filter((F.col("source_table") == "heart_rate") & F.col("key").isin(*EVENT_KEYS)))
    i = Json(F.col("item"))
    rows = rows.select("sid", "source_record_id", F.posexplode(_items("items")).alias("sample_index", "item")).filter(F.schema_of_variant("item").startswith("OBJECT"))
    return rows.select("sid", "source_record_id", "sample_index", i.whole("time").alias("timestamp_utc"), i.real("value").alias("value"))


def standing_intervals(raw: DataFrame) -> DataFrame:
    j = Json(F.col("payload"))
    return with_payload(raw.filter("source_table = 'valid_stand'")).select("sid", "source_record_id", j.whole("start_time").alias("start_timestamp_utc"), j.whole("end_time").alias("end_timestamp_utc"), "local_date", F.col("zone_offset").alias("utc_offset_seconds"))


def sleep_sessions(raw: DataFrame) -> DataFrame:
    """Sessions; one without stages and shorter than four hours is taken for a nap."""
    j = Json(F.col("payload"))
    flag = lambda f: F.coalesce((j.kind(f) == "BOOLEAN") & j.get(f, "boolean"), F.lit(False))
    stages = (flag("has_stage") | (F.coalesce(F.size(_items("items")), F.lit(0)) > 0)).cast("int")
    out = with_payload(raw.filter("source_table = 'sleep'")).select(
        "sid", "source_record_id", truthy_or(j.whole("bedtime"), j.whole("device_bedtime")).alias("sleep_start_utc"), settled(truthy_or(j.whole("wake_up_time"), F.col("time"))).alias("sleep_end_utc"), "local_date",
        F.col("zone_offset").alias("utc_offset_seconds"), *[j.field(f).alias(c) for c, f in SLEEP_FIELDS.items()], stages.alias("has_stages"), flag("has_rem").cast("int").alias("has_rem"),
        F.coalesce(j.get("sleep_algorithm_version", "string"), j.get("version", "string"), F.lit("")).alias("algorithm_version"),
    )
    return out.withColumn("is_nap_inferred", F.coalesce((F.col("has_stages") == 0) & (F.col("duration_minutes") < 240), F.lit(False)).cast("int"))


def sleep_stages(raw: DataFrame) -> DataFrame:
    """Stages with their position; those without bounds are skipped, durations may be negative (checks come later)."""
    i = Json(F.col("item"))
    rows = with_payload(raw.filter("source_table = 'sleep'")).select("sid", "source_record_id", F.posexplode(_items("items")).alias("stage_index", "item")).filter(F.schema_of_variant("item").startswith("OBJECT"))
    rows = rows.select("sid", "source_record_id", "stage_index", i.whole("state").alias("raw_state"), i.whole("start_time").alias("start_timestamp_utc"), settled(i.whole("end_time")).alias("end_timestamp_utc")).dropna(subset=["start_timestamp_utc", "end_timestamp_utc"])
    name = reduce(lambda c, s: c.when(F.col("raw_state") == s, STAGES[s]), list(STAGES)[1:], F.when(F.col("raw_state") == 2, STAGES[2]))
    return rows.withColumn("stage", name.otherwise(F.concat(F.lit("unknown_"), F.coalesce(F.col("raw_state").cast("string"), F.lit("None"))))).withColumn("duration_minutes", (F.col("end_timestamp_utc") - F.col("start_timestamp_utc")) / 60.0)


def workouts(raw: DataFrame, source_table: str) -> DataFrame:
    j = Json(F.col("payload"))
    return with_payload(raw.filter(F.col("source_table") == source_table)).select(
        "sid", "source_record_id", truthy_or(j.whole("start_time"), F.col("time")).alias("start_timestamp_utc"), j.whole("end_time").alias("end_timestamp_utc"), "local_date", F.coalesce("key", F.lit("")).alias("workout_type"),
        F.coalesce(j.get("sport_type", "string"), F.lit("")).alias("sport_type"), truthy_or(j.real("calories"), j.real("total_cal")).alias("calories"), *[j.field(f).alias(c) for c, f in WORKOUT_FIELDS.items()],
    )


def daily_cells(raw: DataFrame) -> DataFrame:
    """(sid, local_date, column_name, value, order...) of every daily value in long form; null values write nothing."""
    keyed = {f"heart_rate/{key}": {c: "bpm!"} for key, c in (("resting_heart_rate", "resting_hr"), ("min_heart_rate", "min_hr"), ("max_heart_rate", "max_hr"))}
    rules = [(kind, [(c, f.rstrip("!"), f.endswith("!")) for c, f in fields.items()]) for kind, fields in (DAILY | keyed).items()]
    known = raw.sparkSession.createDataFrame(rules, "kind string, rules array<struct<column_name: string, field: string, zero_is_none: boolean>>")
    rows = with_payload(raw).withColumn("kind", F.when(F.col("source_table") == "heart_rate", F.concat_ws("/", "source_table", "key")).otherwise(F.col("source_table")))
    rows = rows.join(F.broadcast(known), "kind").filter("payload is not null")  # a row for each kind of daily record
    j = Json(F.col("payload"))
    rows = rows.withColumn("named", j.whole("date_time"))
    dated = F.when(F.col("source_table") == "heart_rate", local_date(truthy_or(F.col("named"), F.col("time")), F.lit(0))).otherwise(F.col("local_date"))
    dated = settled(dated)
    breaths = F.transform(F.filter(F.coalesce(_items("segment_details"), F.array().cast("array<variant>")), lambda i: F.try_variant_get(i, "$.avg_breath", "double").isNotNull()), lambda i: F.try_variant_get(i, "$.avg_breath", "double"))
    breath = F.when(F.size(breaths) > 0, F.aggregate(breaths, F.lit(0.0), lambda a, x: a + x) / F.size(breaths)).otherwise(j.real("avg_breath"))
    names = ("sid", "source_table", "time", "source_record_id")
    rows = rows.select(*names, dated.alias("local_date"), F.try_variant_get("payload", "$", "map<string,variant>").alias("fields"), "rules", F.when(F.col("source_table") == "sleep_day", breath).alias("breath")).filter("local_date is not null")
    cells = rows.select(*names, "local_date", "fields", "breath", F.explode("rules").alias("r"))
    cells = cells.select(*names, "local_date", F.col("r.column_name").alias("column_name"), F.col("r.zero_is_none").alias("zero_is_none"), F.col("fields")[F.col("r.field")].alias("v"))
    cells = cells.select(*names, "local_date", "column_name", "zero_is_none", number_of(F.col("v")).alias("value")).filter(~(F.col("zero_is_none") & (F.col("value") == 0.0))).drop("zero_is_none")
    rates = rows.filter("breath is not null").select(*names, "local_date", F.lit("avg_respiratory_rate").alias("column_name"), F.col("breath").alias("value"))
    return cells.filter("value is not null").unionByName(rates)


def daily_summary(raw: DataFrame) -> DataFrame:
    """One row a subject and day: of each column the value of the greatest (source table, time, record); independent of import order."""
    return pivoted(daily_cells(raw))


def pivoted(cells: DataFrame) -> DataFrame:
    """``daily_summary`` from its cells."""
    names = sorted({c for fields in DAILY.values() for c in fields} | {"avg_respiratory_rate"})
    picked = cells.groupBy("sid", "local_date", "column_name").agg(F.max(F.struct("source_table", "time", "source_record_id", "value"))["value"].alias("value"))
    return picked.groupBy("sid", "local_date").pivot("column_name", names).agg(F.first("value"))


def stage_name(raw_state: Column) -> Column:
    """What features see of a stored state: a known stage, else "unknown"."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv])[raw_state], F.lit("unknown"))


def stage_flags(raw_state: Column) -> Column:
    return F.when(F.coalesce(~raw_state.isin(*STAGES), F.lit(True)), "UNKNOWN_SEMANTICS,VENDOR_DERIVED").otherwise("VENDOR_DERIVED")


def saturation_quality(value: Column) -> Column:
    """Zero and less stand for no measurement, more than 100 can't be; such values stay, marked."""
    return F.when(value.isNull() | F.isnan(value), "MISSING").when(value <= 0, "SENTINEL,INVALID").when(value > 100, "INVALID").otherwise("VALID")


def derived_metrics(raw: DataFrame) -> DataFrame:
    """(sid, source_record_id, source_table, field_path, numeric_value, text_value) of all payloads outside the high-volume tables."""
    rows = with_payload(raw.filter(~F.col("source_table").isin(*HIGH_VOLUME)))
    return flatten(rows, ["sid", "source_record_id", "source_table"], F.col("payload"))


def flatten(df: DataFrame, keep: list[str], payload: Column, *, depth: int = DEPTH) -> DataFrame:
    """(keep..., field_path, numeric_value, text_value) of the scalars of JSON objects down to ``depth`` names.

    Arrays are left out, and top-level time fields; true and false are 1 and 0; nulls stay with both values null.
    """
    level = df.select(*keep, F.lit("").alias("path"), payload.alias("v")).filter(F.schema_of_variant("v").startswith("OBJECT"))
    spark, out = df.sparkSession, None
    names = ", ".join(f"`{k}`" for k in keep)
    for i in range(depth):
        level = spark.sql(f"select {names}, case when path = '' then t.key else concat(path, '.', t.key) end as path, t.value as v from {{level}}, lateral variant_explode({{level}}.v) as t", level=level)
        kind = F.schema_of_variant("v")
        scalar = level.filter(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & ~F.col("path").isin(*UNFLATTENED)).select(
            *keep, F.col("path").alias("field_path"), F.when(kind == "BOOLEAN", F.try_variant_get("v", "$", "boolean").cast("double")).when(kind != "STRING", F.try_variant_get("v", "$", "double")).alias("numeric_value"),
            F.when(kind == "STRING", F.try_variant_get("v", "$", "string")).alias("text_value"),
        )
        out = scalar if out is None else out.unionByName(scalar)
        level = level.filter(kind.startswith("OBJECT"))
    return out
