"""Record identity: canonical JSON, identity and content hashes, source keys, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "\u0000"
#: Columns of the envelope of a source row, which aren't among its scalars, and those that identify a row without a primary key.
ENVELOPE = ("sid", "key", "time", "value", "zone_offset", "time_zero", "zone_name", "deleted", "isUploaded")
PREFERRED_KEY = ("sid", "key", "time", "project_id", "category", "tag")


def canonical_text(value: Column, kind: T.DataType) -> Column:
    """One text for each nested value: fields and keys sorted, items in order, numbers with 17 digits, bytes by length and hash.

    Null is ``null``. NaN and infinities have no such text: an error.
    """
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(f'"{n}":'), canonical_text(value.getField(n), kind[n].dataType)) for n in sorted(kind.names)]
        text = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.concat_ws(",", F.transform(value, lambda x: canonical_text(x, kind.elementType))), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entry = lambda e: F.concat(canonical_text(e["key"].cast("string"), T.StringType()), F.lit(":"), canonical_text(e["value"], kind.valueType))
        text = F.concat(F.lit("{"), F.concat_ws(",", F.transform(F.array_sort(F.map_entries(value)), entry)), F.lit("}"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        odd = F.isnan(value) | (F.abs(value) == float("inf"))
        text = F.when(odd, F.raise_error(F.lit("only finite numbers can be hashed")).cast("string")).otherwise(F.format_string("%.17g", value.cast("double")))
    elif isinstance(kind, T.BinaryType):
        text = F.concat(F.lit('{"length":'), F.octet_length(value).cast("string"), F.lit(',"sha256":"'), F.sha2(value, 256), F.lit('"}'))
    elif isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = quoted(value.cast("string"))
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def key_columns(schema: T.StructType, primary_key: Sequence[str] = ()) -> list[str]:
    """What identifies a row: its primary key; else the usual columns that it has; else all that aren't bytes."""
    usual = [c for c in PREFERRED_KEY if c in schema.names]
    return list(primary_key) or usual or [f.name for f in schema.fields if not isinstance(f.dataType, T.BinaryType)]


def canonical_payload(text: Column) -> Column:
    """Compact JSON with sorted keys of a text that is JSON, else the text."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def content_hash(schema: T.StructType, *, payload: str = "value") -> Column:
    """Hash of all columns of a row, sorted by name; the payload column counts in canonical form."""
    part = lambda f: canonical_payload(F.col(f.name)) if f.name == payload and isinstance(f.dataType, T.StringType) else canonical_text(F.col(f.name), f.dataType)
    return F.sha2(F.concat(*[F.concat(F.lit(f.name + SEPARATOR), F.coalesce(part(f), F.lit("null")), F.lit(SEPARATOR)) for f in sorted(schema.fields, key=lambda f: f.name)]), 256)


def split_record(schema: T.StructType, *, payload: str = "value") -> dict[str, Column]:
    """A source row in three: ``scalars`` (canonical JSON of what is neither envelope nor payload; bytes by length and hash), ``blobs`` (name and bytes), ``value_json``."""
    rest = [f for f in sorted(schema.fields, key=lambda f: f.name) if f.name not in (*ENVELOPE, payload)]
    scalars = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{f.name}":'), canonical_text(F.col(f.name), f.dataType)) for f in rest]), F.lit("}"))
    none = F.array().cast("array<struct<column_name: string, data: binary>>")
    blobs = [F.when(F.col(f.name).isNotNull(), F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("data"))) for f in schema.fields if isinstance(f.dataType, T.BinaryType)]
    value = canonical_payload(F.col(payload)) if payload in schema.names else F.lit(None).cast("string")
    return {"scalars": scalars, "blobs": F.array_compact(F.array(*blobs)) if blobs else none, "value_json": value}


def canonical_json(columns: dict[str, Column]) -> Column:
    """Compact JSON of the columns, keys sorted, nulls kept."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def digest(*parts: Column) -> Column:
    """Hash of parts with an unambiguous separator; a null part differs from an empty one."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("!")) for p in parts]), 256)


def logical_id(table: Column, key: dict[str, Column]) -> Column:
    """Identity of a record: table and primary key, without path or region, so that regional copies share it."""
    return F.sha2(F.concat(table, F.lit("|"), canonical_json(key)), 256)


def physical_id(source_key: Column, logical: Column) -> Column:
    return F.sha2(F.concat(source_key, F.lit("|"), logical), 256)


def source_key(path: Column) -> Column:
    """``account:<name>:region:<region>`` of DataBase/<name>/<region>/<name>.db, else the relative path (stable when folders move)."""
    account, region, stem = (F.regexp_extract(path, r"(?i)([^/]+)/([a-z]{2})/([^/]+)\.db$", i) for i in (1, 2, 3))
    return F.when((account != "") & (account == stem), F.concat(F.lit("account:"), account, F.lit(":region:"), region)).otherwise(path)


def conflict_copy(path: Column) -> Column:
    """Whether a file is a synchronizer's conflict copy."""
    return F.contains(path, F.lit(".conflict-"))


def fingerprint(inputs: Column, profile_revision: Column, *versions: str) -> Column:
    """Hash of inputs, profile revision and versions; no wall clock."""
    return digest(inputs, profile_revision, *map(F.lit, versions))
