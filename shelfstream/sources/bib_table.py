"""The incremental title table in hash buckets: a run writes the buckets with a change and points the others to where they are.

Layout below the table's path: ``data/<run>/bucket=K`` holds rows, ``versions/version=N`` names the run that holds each
bucket.  A version is complete or absent, since Spark publishes a table's files only when its job has ended, so readers
and a repeated run see the last complete one.  Versions share the buckets that did not change.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.operators import bibs
from shelfstream.session import materialize

BUCKETS = 64  # a title table of 10^9 rows wants thousands
_VERSION_SCHEMA = "bucket int, run string, buckets int, version int"


def _path(spark: SparkSession, path: str):
    """The path and its file system, in whatever store Spark writes to."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class BibTable:
    """``schema`` holds the rows' columns; rows are keyed by title, or by root and title if they have a root."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    @classmethod
    def open_or_create(cls, spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS) -> BibTable:
        table = cls(spark, path, schema)
        folder, store = _path(spark, f"{table.path}/versions")
        if not store.exists(folder):
            table._publish(0, {}, buckets)
        return table

    # ---- versions ---------------------------------------------------------
    def _publish(self, version: int, places: dict[int, str], buckets: int) -> None:
        rows = [(bucket, run, buckets) for bucket, run in sorted(places.items())] or [(-1, "", buckets)]
        entry = self.spark.createDataFrame(rows, "bucket int, run string, buckets int").coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")

    def state(self) -> tuple[int, dict[int, str], int]:
        """(version, run of every bucket that has rows, number of buckets) of the last complete version."""
        folder, store = _path(self.spark, f"{self.path}/versions")
        done = [
            int(f.getPath().getName().partition("=")[2]) for f in store.listStatus(folder)
            if store.exists(_path(self.spark, f"{f.getPath()}/_SUCCESS")[0])
        ]
        rows = self.spark.read.schema(_VERSION_SCHEMA).parquet(f"{self.path}/versions/version={max(done)}").collect()
        return max(done), {r["bucket"]: r["run"] for r in rows if r["bucket"] >= 0}, rows[0]["buckets"]

    def _rows(self, places: dict[int, str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/data/{run}/bucket={bucket}" for bucket, run in sorted(places.items())]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """The rows of the last complete version."""
        _, places, _ = self.state()
        return self._rows(places)

    # ---- changes ------------------------------------------------------------
    def load(self, rows: DataFrame) -> None:
        """Replace the whole table."""
        version, _, buckets = self.state()
        names = [part.split()[0] for part in self.schema.split(",")]
        self._write(rows.select(*names, self._bucket(buckets)), version, {}, buckets)

    @staticmethod
    def _bucket(buckets: int):
        return F.pmod(F.xxhash64(F.col("biblio_id").cast("long")), F.lit(buckets)).cast("int").alias("bucket")

    def _write(self, rows: DataFrame, version: int, others: dict[int, str], buckets: int) -> None:
        run = f"run-{version + 1}-{uuid.uuid4().hex}"
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{run}")
        folder, store = _path(self.spark, f"{self.path}/data/{run}")
        names = [f.getPath().getName() for f in store.listStatus(folder)]
        written = {int(name.partition("=")[2]): run for name in names if name.startswith("bucket=")}
        self._publish(version + 1, {**others, **written}, buckets)

    def refresh(
        self, active: DataFrame, record_entry: DataFrame, simple_record: DataFrame, record_attr_flat: DataFrame, refreshed_at: str
    ) -> set[int]:
        """Next version by the rules of :func:`bibs.upsert_bibs`; returns the buckets that were written.

        The keys and times of all rows are compared with the records.  What changed (deleted, stale and new titles) is
        written once to the shared folder; from it come the list of buckets, the titles to parse and the rows to leave out.
        """
        version, places, buckets = self.state()
        now = self._rows(places)
        keys = bibs.bib_keys(now)
        records = record_entry.select(F.col("id").alias("biblio_id"), "deleted", "edit_date")
        old = F.coalesce(F.col("last_update") < F.col("edit_date"), F.lit(False)) | F.col("last_update").isNull()
        held = now.select(*keys, "last_update").join(records, "biblio_id", "left").select(
            *keys, F.coalesce("deleted", F.lit(False)).alias("gone"), old.alias("stale")
        )
        wanted = active.select(*keys).distinct().withColumn("active", F.lit(True))
        # A deleted title that still has a circulating copy leaves and comes in again.
        marked = held.join(wanted, keys, "full_outer").select(
            *keys, F.coalesce("gone", F.lit(False)).alias("gone"),
            (F.coalesce("stale", F.lit(False)) & ~F.coalesce("gone", F.lit(False))
             | F.coalesce("active", F.lit(False)) & F.coalesce("gone", F.lit(True))).alias("pending"),
        )
        changes = materialize(marked.filter("gone OR pending").select(*keys, "pending", self._bucket(buckets)), "bib-changes")
        touched = {r["bucket"] for r in changes.select("bucket").distinct().collect()}  # at most as many as there are buckets
        if not touched:
            return set()
        ids = changes.filter("pending").select(F.col("biblio_id").alias("id")).distinct()
        rebuilt = bibs.bib_fields(*(t.join(ids, "id", "left_semi") for t in (record_entry, simple_record, record_attr_flat)))
        stamped = changes.filter("pending").select(*keys).join(rebuilt, "biblio_id", "left").withColumn(
            "last_update", F.lit(refreshed_at).cast("timestamp_ntz")
        )
        kept = self._rows({b: run for b, run in places.items() if b in touched}).join(changes.select(*keys), keys, "left_anti")
        columns = [*keys, *bibs.BIB_COLUMNS[1:], self._bucket(buckets)]
        others = {b: run for b, run in places.items() if b not in touched}
        self._write(kept.select(*columns).unionByName(stamped.select(*columns)), version, others, buckets)
        return touched

    def forget(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions, and the runs that none of them names."""
        last, _, _ = self.state()
        folder, store = _path(self.spark, f"{self.path}/versions")
        stay = set()
        for status in store.listStatus(folder):
            version = int(status.getPath().getName().partition("=")[2])
            if version <= last - keep:
                store.delete(status.getPath(), True)
            elif version <= last:
                rows = self.spark.read.schema(_VERSION_SCHEMA).parquet(f"{self.path}/versions/version={version}").collect()
                stay |= {r["run"] for r in rows}
        folder, store = _path(self.spark, f"{self.path}/data")
        for status in store.listStatus(folder):
            if status.getPath().getName() not in stay:
                store.delete(status.getPath(), True)
