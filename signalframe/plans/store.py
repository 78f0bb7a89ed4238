"""Keeping results: revisions with pointers, atomic publication, state, run log, schema evolution, and what to recompute.

Tables are plain parquet folders; a new version is written aside and becomes visible by one rename of a small pointer file.
Files are reached through the cluster's file systems, never through paths of the driver alone.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session

SCHEMA_VERSION = 3
#: Days after a changed day whose metrics may depend on it, and hours before the last checkpoint that are read again.
HORIZON_DAYS, OVERLAP_HOURS = 90, 48


class Store:
    """Tables below a folder that the whole cluster sees, on whatever file system its path names.

    A table is a row of versions (plain parquet folders); a small pointer names the current one.
    """

    #: Versions that stay readable besides the current one, for reads that go on.
    KEPT = 1

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        version = self.state().get("schema_version", SCHEMA_VERSION)
        if version > SCHEMA_VERSION:
            raise ValueError(f"the store has version {version}; this code knows {SCHEMA_VERSION}")

    def _json(self, name: str) -> dict:
        return json.loads(session.read_text(self.spark, f"{self.root}/{name}") or "{}")

    def state(self) -> dict:
        return self._json("state.json")

    def update_state(self, **values) -> None:
        """Set keys; only after the tables that they speak of are published."""
        session.write_text(self.spark, f"{self.root}/state.json", json.dumps({"schema_version": SCHEMA_VERSION} | self.state() | values, sort_keys=True))

    def table(self, name: str, schema: str | None = None) -> DataFrame:
        """The published version; an empty table of the schema if there is none."""
        at = self._json(f"{name}/current.json").get("version")
        if at:
            return self.spark.read.parquet(f"{self.root}/{name}/{at}")
        return self.spark.createDataFrame([], schema)

    def has(self, name: str) -> bool:
        return "version" in self._json(f"{name}/current.json")

    def stage(self, name: str, df: DataFrame, *, partition_by: tuple[str, ...] = ()) -> str:
        """Write a whole new version aside; nobody sees it yet."""
        version = f"v-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.root}/{name}/{version}")
        return version

    def release(self, name: str, version: str) -> DataFrame:
        """Point to a staged version, and drop versions older than those kept. Reads of the one before go on."""
        now = self._json(f"{name}/current.json")
        earlier = [v for v in (now.get("version"), *now.get("earlier", [])) if v][: self.KEPT]
        session.write_text(self.spark, f"{self.root}/{name}/current.json", json.dumps({"version": version, "earlier": earlier}))
        for old in session.folders_in(self.spark, f"{self.root}/{name}"):
            if old.startswith("v-") and old not in (version, *earlier):
                session.remove(self.spark, f"{self.root}/{name}/{old}")
        return self.table(name)

    def publish(self, name: str, df: DataFrame, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """A new version in one step; a failed write leaves the old one."""
        return self.release(name, self.stage(name, df, partition_by=partition_by))

    def merge_parts(self, name: str, new: DataFrame, key: list[str], part: str) -> None:
        """Merge rows by key into a table kept in parts by a column (a date, say); only the parts that new rows fall in are rewritten.

        A key must keep its part. One job writes all touched parts aside, and one pointer to the version of each part
        makes them visible at once. Replays change nothing.
        """
        label = F.regexp_replace(F.coalesce(F.col(part).cast("string"), F.lit("none")), "[^0-9A-Za-z-]", "_")
        placed = new.withColumn("__part", label)
        touched = sorted(r[0] for r in placed.select("__part").distinct().collect())  # one value a part
        if not touched:
            return
        now = self._json(f"{name}/parts.json")
        known = now.get("parts", {})
        there = [f"{self.root}/{name}/{known[v]}/__part={v}" for v in touched if v in known]
        old = self.spark.read.parquet(*there).withColumn("__part", label) if there else placed.limit(0)
        version = self.stage(name, upsert(old, placed, key), partition_by=("__part",))
        parts = known | dict.fromkeys(touched, version)
        session.write_text(self.spark, f"{self.root}/{name}/parts.json", json.dumps({"parts": parts, "earlier": known}))
        for folder in session.folders_in(self.spark, f"{self.root}/{name}"):
            if folder.startswith("v-") and folder not in {*parts.values(), *known.values()}:
                session.remove(self.spark, f"{self.root}/{name}/{folder}")

    def parts(self, name: str, schema) -> DataFrame:
        """All parts of a table of ``merge_parts``."""
        paths = [f"{self.root}/{name}/{version}/__part={value}" for value, version in sorted(self._json(f"{name}/parts.json").get("parts", {}).items())]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def log_run(self, run_id: str, status: str, started_at: str, finished_at: str | None = None, detail: str | None = None) -> None:
        """Append to the run log; a failed run is logged though its data isn't published."""
        row = self.spark.createDataFrame([(run_id, status, started_at, finished_at, detail)], RUN_LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/run_log")

    def runs(self) -> DataFrame:
        """The last status of each run."""
        if "run_log" not in session.folders_in(self.spark, self.root):
            return self.spark.createDataFrame([], RUN_LOG)
        w = Window.partitionBy("run_id").orderBy(F.col("finished_at").desc_nulls_last())
        return self.spark.read.parquet(f"{self.root}/run_log").withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")

    @contextmanager
    def lock(self, name: str):
        """One run at a time: an error if another holds it. What a dead run left is removed by ``break_lock``."""
        fs, p = session._file_system(self.spark, f"{self.root}/{name}.lock")
        fs.mkdirs(p.getParent())
        if not fs.createNewFile(p):
            raise RuntimeError(f"another run holds {name}")
        try:
            yield
        finally:
            fs.delete(p, False)

    def break_lock(self, name: str) -> None:
        session.remove(self.spark, f"{self.root}/{name}.lock")


RUN_LOG = "run_id string, status string, started_at string, finished_at string, detail string"


def evolve(df: DataFrame, columns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add missing columns (name: type, value for old rows); idempotent."""
    return df.withColumns({c: v.cast(t) for c, (t, v) in columns.items() if c not in df.columns})


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key isn't in it (unknown columns null)."""
    return new.unionByName(old.join(new.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def partial_upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both with the new values where they aren't null: a null never erases."""
    values = [c for c in old.columns if c not in key]
    o, n = old.select(*key, *[F.col(c).alias(f"__o_{c}") for c in values]), new.select(*key, *[F.col(c).alias(f"__n_{c}") for c in values])
    return o.join(n, key, "full_outer").select(*key, *[F.coalesce(f"__n_{c}", f"__o_{c}").alias(c) for c in values])


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Children of the given parents are those of ``new``, also if there are none; others stay."""
    return old.join(parents.select(parent).distinct(), parent, "left_anti").unionByName(new, allowMissingColumns=True)


def add_revisions(revisions: DataFrame, drafts: DataFrame, identity: list[str], number: str = "revision") -> DataFrame:
    """Append drafts that aren't there yet in all ``identity`` columns (nulls equal); revisions are never changed."""
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in identity]
    on = same[0]
    for s in same[1:]:
        on = on & s
    fresh = drafts.dropDuplicates(identity).alias("d").join(revisions.alias("r"), on, "left_anti")
    last = revisions.agg(F.coalesce(F.max(number), F.lit(0)).alias("__last"))
    numbered = fresh.join(F.broadcast(last)).withColumn(number, F.col("__last") + 1).drop("__last")  # one row
    return revisions.unionByName(numbered, allowMissingColumns=True)


def active(revisions: DataFrame, key: list[str], number: str = "revision", *tie: str) -> DataFrame:
    """The revision that each key points to: the latest."""
    w = Window.partitionBy(*key).orderBy(F.col(number).desc(), *[F.col(t).desc() for t in tie])
    return revisions.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def retract(pointers: DataFrame, produced: DataFrame, scope: DataFrame, key: list[str], within: list[str]) -> DataFrame:
    """Pointers without those in ``scope`` (of columns ``within``) that were not produced again; in full runs too."""
    marked = pointers.join(scope.select(*within).distinct().withColumn("__s", F.lit(True)), within, "left").join(produced.select(*key).distinct().withColumn("__p", F.lit(True)), key, "left")
    return marked.filter("__s is null or __p is not null").drop("__s", "__p")


def classify(new: DataFrame, old: DataFrame, key: list[str], content: str) -> DataFrame:
    """New rows with ``change``: new, updated, unchanged by the content of the row of the same key before."""
    o = old.select(*key, F.col(content).alias("__c"), F.lit(True).alias("__known"))
    kind = F.when(F.col("__known").isNull(), "new").when(F.col("__c").eqNullSafe(F.col(content)), "unchanged").otherwise("updated")
    return new.join(o, key, "left").withColumn("change", kind).drop("__c", "__known")


def affected_days(dirty: DataFrame, by: str, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Days whose metrics depend on a changed day: it and the horizon after it. The calendar bounds them."""
    return dirty.select(by, F.explode(F.sequence(F.col("day"), F.col("day") + horizon)).alias("day")).distinct()


def refresh(full: DataFrame, stored: DataFrame, days: DataFrame, by: str) -> DataFrame:
    """Stored metrics with those of the affected days replaced; equals a full run if no other day changed, except for change points (see ``runs``)."""
    return stored.join(days, [by, "day"], "left_anti").unionByName(full.join(days, [by, "day"], "left_semi"))


def unchanged(state: dict, *, deep_at: str | None = None, now: str | None = None, deep_hours: float = 24, **inputs: str) -> bool:
    """Whether a run has nothing to do: all inputs (fingerprints, policy, profile, versions) are those of the last run.

    With ``now`` also that the last deep scan, ``deep_at`` (ISO 8601), is less than ``deep_hours`` ago: quick fingerprints
    see sizes, times and the ends of files, not all of their bytes.
    """
    if now is not None and (deep_at is None or datetime.fromisoformat(now) - datetime.fromisoformat(deep_at) >= timedelta(hours=deep_hours)):
        return False
    return bool(inputs) and all(state.get(k) == v for k, v in inputs.items())


def cutoff(last_timestamp: int, overlap_hours: int = OVERLAP_HOURS) -> int:
    """Start of the day that is ``overlap_hours`` before the last timestamp seen."""
    return (last_timestamp - overlap_hours * 3600) // 86400 * 86400
