"""Sessions of activity between gaps of inactivity, kept in an incrementally merged table.

A batch of events becomes local sessions per (entity, hour); those are compared with the stored sessions
within the gap, bridged ones are merged, and the buckets they lie in are replaced atomically.

Scale: the local step sorts within (entity, hour), so a hot entity is spread over its hours. Two sessions of
one entity lie more than ``gap`` apart, so one entity has at most 3600 / gap + 1 local ones an hour, whatever the
number of events: that bounds every group of the merging step. The number of buckets follows the number of
sessions and is doubled when they outgrow it.

Defined results: events with a null or blank part of the entity, or without a readable time, are in no
session; repeated deliveries of one event (same id and time) count once, in whatever batches they come; equal
times are ordered by id; an empty batch leaves the table as it is; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.runtime import erase, new_path, remove, written

#: slices of time: of local sessions, and of the table of event ids
HOUR_US, MONTH_US = 3_600_000_000, 30 * 86_400_000_000
#: sessions a bucket may hold
MOST = 2_000_000
#: files of a month's ids in one batch
SPREAD = 8


def local_sessions(events: DataFrame, entity: Sequence[str], ts: str, event_id: str, gap_s: int) -> DataFrame:
    """(entity, start, end, n, first_id, last_id) of sessions within one hour; ``ts`` in microseconds."""
    rows = events.select(*entity, F.col(ts).alias("_ts"), F.col(event_id).alias("_id"), F.floor(F.col(ts) / HOUR_US).alias("_slice")).dropna(subset=[*entity, "_ts", "_id"])
    part = [*entity, "_slice"]
    w = Window.partitionBy(*part).orderBy("_ts", "_id")
    prev = F.lag(F.struct("_ts", "_id")).over(w)
    rows = rows.withColumn("_prev", prev).where(F.col("_prev").isNull() | (F.col("_prev._id") != F.col("_id")))
    starts = F.when(F.col("_prev").isNull() | (F.col("_ts") - F.col("_prev._ts") > gap_s * 1_000_000), 1).otherwise(0)
    rows = rows.withColumn("_k", F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*part, "_k").agg(
        F.min("_ts").alias("start"), F.max("_ts").alias("end"), F.count("*").alias("n"),
        F.min(F.struct("_ts", "_id"))["_id"].alias("first_id"), F.max(F.struct("_ts", "_id"))["_id"].alias("last_id"),
    ).drop("_slice", "_k")


def merge_sessions(sessions: DataFrame, entity: Sequence[str], gap_s: int) -> DataFrame:
    """Sessions within the gap of each other joined into one; the input is a union of sessions."""
    w = Window.partitionBy(*entity).orderBy("start", "end", "first_id")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = sessions.withColumn("_new", F.when(reach.isNull() | (F.col("start") - reach > gap_s * 1_000_000), 1).otherwise(0))
    rows = rows.withColumn("_k", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*entity, "_k").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"),
        F.min(F.struct("start", "first_id"))["first_id"].alias("first_id"), F.max(F.struct("end", "last_id"))["last_id"].alias("last_id"),
    ).drop("_k")


class SessionTable:
    """A stored table of sessions in buckets of the entity's hash, and the events it holds.

    Each update writes the buckets it touches to a new folder and then replaces the manifest by one rename, so a
    reader sees either the state before or the state after; folders that neither the new state nor the one before
    it names are deleted. The events lie by month, and an update reads only the months of its batch.
    """

    def __init__(self, spark: SparkSession, entity: Sequence[str], gap_s: int, path: str | None = None, buckets: int = 8):
        """``buckets``: their number in a new table, at least."""
        self.spark, self.entity, self.gap_s, self.least = spark, list(entity), gap_s, buckets
        self.path = path or new_path(spark, "sessions")
        self.schema = None
        jvm = spark.sparkContext._jvm
        self._jpath = jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        self._options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict:
        p = self._jpath(f"{self.path}/manifest.json")
        if not self._fs.exists(p):
            return {"version": 0, "buckets": 0, "most": 0, "folders": {}, "before": {}, "ids": {}}
        stream = self._fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(*self.entity), F.lit(buckets))

    def _commit(self, manifest: dict) -> None:
        tmp = self._jpath(f"{self.path}/manifest.{manifest['version']}.tmp")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        self._context.rename(tmp, self._jpath(f"{self.path}/manifest.json"), self._options)

    def _named(self, folder: str, column: str) -> list[str]:
        """Values of the partition column of a folder."""
        at = self._jpath(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(n[len(column) + 1 :] for n in names if n.startswith(f"{column}="))

    def _write(self, sessions: DataFrame, folder: str, buckets: int) -> list[str]:
        """Written with one file per bucket: the partition of an entity is its bucket."""
        placed = sessions.repartition(buckets, *self.entity).withColumn("_b", self._bucket(buckets))
        placed.write.partitionBy("_b").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return self._named(folder, "_b")

    def _read(self, folders: dict[str, str]) -> list[DataFrame]:
        paths = [f"{self.path}/{v}/_b={b}" for b, v in sorted(folders.items())]
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return [reader.parquet(*paths)] if paths else []

    def _unseen(self, events: DataFrame, known: dict[str, list[str]]) -> DataFrame:
        """Events without those that earlier batches held."""
        if not known:
            return events
        months = [str(r[0]) for r in events.select("_m").distinct().collect()]  # one row a month
        paths = [f"{self.path}/{v}/_m={m}" for m in months for v in known.get(m, ())]
        if not paths:
            return events
        ids = self.spark.read.schema(events.select("_id", "_ts").schema).parquet(*paths)
        return events.join(ids, ["_id", "_ts"], "left_anti")

    def update(self, events: DataFrame, ts: str, event_id: str) -> None:
        """Merge one batch of events: those not held yet are written by month, their local sessions staged, compared
        with the stored sessions of the buckets they lie in, and those buckets replaced."""
        rows = events.select(*self.entity, F.col(ts).alias("_ts"), F.col(event_id).alias("_id"), F.floor(F.col(ts) / MONTH_US).alias("_m")).dropna()
        before = self.manifest()
        version = before["version"] + 1
        fresh = f"ids{version}"
        self._unseen(rows, before["ids"]).repartition("_m", F.pmod(F.hash("_id"), F.lit(SPREAD))).write.partitionBy("_m").option("compression", "zstd").parquet(f"{self.path}/{fresh}")
        months = self._named(fresh, "_m")
        held = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{fresh}")
        local = local_sessions(held, self.entity, "_ts", "_id", self.gap_s)
        self.schema = local.schema
        buckets, folders, most = max(before["buckets"], self.least), before["folders"], before["most"]
        staged = None
        if months:
            staged = written(local, "staged")
            counts = lambda: {str(r.b): r["count"] for r in staged.groupBy(self._bucket(buckets).alias("b")).count().collect()}  # noqa: E731  (one row a bucket)
            touched = counts()
            most += sum(touched.values())
            if most > MOST * buckets:
                while most > MOST * buckets:
                    buckets *= 2
                stored, folders = self._read(folders), {}
            else:
                stored = self._read({b: v for b, v in folders.items() if b in touched})
            both = reduce(DataFrame.unionByName, [staged, *stored]).repartition(buckets, *self.entity)
            new = self._write(merge_sessions(both, self.entity, self.gap_s), f"v{version}", buckets)
            folders = folders | {b: f"v{version}" for b in new}
            erase(staged)
        ids = before["ids"] | {m: [*before["ids"].get(m, []), fresh] for m in months}
        self._commit({"version": version, "buckets": buckets, "most": most, "folders": folders, "before": before["folders"], "ids": ids})
        for b, v in before["before"].items():
            if v not in (folders.get(b), before["folders"].get(b)):
                remove(self.spark, f"{self.path}/{v}/_b={b}")

    def sessions(self) -> DataFrame:
        """The current state; empty before the first update with events. A table opened anew at its path
        reads its schema from the files."""
        found = self._read(self.manifest()["folders"])
        if found:
            return found[0]
        empty = "start bigint, end bigint, n bigint, first_id bigint, last_id bigint"
        return self.spark.createDataFrame([], self.schema or ", ".join(f"{c} string" for c in self.entity) + ", " + empty)
