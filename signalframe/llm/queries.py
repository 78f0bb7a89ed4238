"""The pN_ queries of the problems of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import latest_version
from ..session import materialize
from ..sources.tables import table
from .mixing import mix, shares
from .subjects import learn, subject_areas
from .survivors import filled, json_text, surviving_fields
from .tokens import encode_texts, with_token_counts


FIELDS = ("source_timestamp", "local_date", "bpm", "zone_name")


def copies(spark: SparkSession, d: str) -> DataFrame:
    """The last state of each copy of a record, its fields (null where not filled), and the trust in its source."""
    records = table(spark, d, "physical_records").select(
        "physical_record_id", F.unix_micros(F.col("last_seen_at").try_cast("timestamp")).alias("seen"), "logical_record_id", "source_db_id", "status",
        filled(F.col("source_timestamp").cast("string")).alias("source_timestamp"), filled(F.col("local_date")).alias("local_date"),
        filled(json_text(F.col("value_json"), "bpm")).alias("bpm"), filled(json_text(F.col("row_json"), "zone_name")).alias("zone_name"),
    )
    # the time is the version and, as a copy of it, a column: it ranks the copies too
    state = latest_version(records.withColumn("seen_at", F.col("seen")), "physical_record_id", "seen", "seen_at", "logical_record_id", "source_db_id", "status", *FIELDS)
    trust = table(spark, d, "source_databases").groupBy("source_db_id").agg(F.max("trust_level").alias("trust"))
    return state.join(trust, "source_db_id", "left")


def _survivors(rows: DataFrame, weight: Column | None) -> DataFrame:
    return surviving_fields(rows, {f: F.col(f) for f in FIELDS}, group="logical_record_id", copy="physical_record_id", order=[F.col("trust"), F.col("seen_at")], active=F.col("status") == "ACTIVE", weight=weight)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """For each record held in several copies, the copy that each field of the surviving record comes from: votes by priority."""
    return _survivors(copies(spark, d), None)


def p3_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The same with votes that count more for trusted sources, for complete copies, and twice if seen since the last scan."""
    last = table(spark, d, "source_generations").agg(F.max("scanned_at").alias("last_scan"))
    rows = copies(spark, d).join(F.broadcast(last), F.lit(True))  # one row
    complete = sum((F.col(f).isNotNull().cast("int") for f in FIELDS), F.lit(0))
    recent = F.when(F.col("seen_at") >= F.unix_micros("last_scan"), 2).otherwise(1)
    return _survivors(rows, (1 + F.coalesce("trust", F.lit(0))) * (1 + complete) * recent)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document under byte_bpe_50k."""
    return encode_texts(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def sized_documents(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, source, n_tokens), made once."""
    return materialize(with_token_counts(table(spark, d, "documents", "doc_id", "source", "text"), "doc_id", "text", ("source",)))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixed corpus: its documents and how often each is used."""
    return mix(sized_documents(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of the mixed corpus that each source was to have and has."""
    return shares(sized_documents(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The subject areas that the author of each message writes about."""
    documents = table(spark, d, "documents", "doc_id", "source", "text")
    model = learn(documents, table(spark, d, "subject_labels", "doc_id", "subject"), table(spark, d, "subject_areas", "subject"))
    return subject_areas(documents, model).distinct()


QUERIES = {f.__name__: f for f in (p3_found, p3_consensus, p8_ids, p9_mix, p9_shares, p10_found)}
