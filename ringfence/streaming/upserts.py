"""A current-state table kept by upserts from a change stream.

Copy on write: rows are hashed by key into a fixed number of buckets, each bucket a folder
of Parquet files.  A batch of changes rewrites the buckets it touches under a new
version; the version's manifest names the folder of every bucket and appears with one
rename, so readers see a batch wholly or not at all.  The manifest also carries the id
of the last batch: a batch that is replayed after a failure changes nothing.

Per key the latest change by ``order`` wins, within a batch and against the table,
so late changes don't undo newer ones.  A delete removes its key from what ``read``
returns and stays as a marker, as an older change may still come; ``vacuum`` drops
folders of versions that are no longer kept.

Rows with a null key form a key of their own.  One stream writes a table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

c = F.col
_MANIFEST = "manifest"


class CurrentTable:
    """The table at ``path`` with rows of ``schema``, which includes the ``key`` and ``order`` columns and the ``deleted`` flag, if any."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: tuple[str, ...] = ("customer_id",),
                 order: tuple[str, ...] = ("updated_at", "change_seq"), deleted: str | None = "__deleted", buckets: int = 16,
                 bucket_of: Column | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order, self.deleted, self.buckets = key, order, deleted, buckets
        # an integer made of the key, instead of its hash: keys that change together (windows of a day) share a bucket
        self.bucket_of = bucket_of
        self._hpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hpath(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- manifest -----------------------------------------------------------
    def versions(self) -> list[int]:
        folder = self._hpath(f"{self.path}/{_MANIFEST}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """``{version, batch_id, buckets: {bucket: folder}, rewritten: [bucket]}``; version 0 is the empty table."""
        have = self.versions()
        if version is None:
            version = have[-1] if have else 0
        if version == 0:
            return {"version": 0, "batch_id": -1, "buckets": {}, "rewritten": []}
        source = self._fs.open(self._hpath(f"{self.path}/{_MANIFEST}/{version}"))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def _switch(self, manifest: dict) -> None:
        """Writes the manifest aside and renames it into place: the one step that makes a version visible."""
        target = self._hpath(f"{self.path}/{_MANIFEST}/{manifest['version']}")
        aside = self._hpath(f"{self.path}/_{_MANIFEST}-{manifest['version']}.tmp")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(aside, target):
            raise RuntimeError(f"version {manifest['version']} of {self.path} exists: another stream writes this table")

    # -- rows ---------------------------------------------------------------
    def _bucket(self) -> Column:
        return self.bucket_of if self.bucket_of is not None else F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _latest(self, df: DataFrame) -> DataFrame:
        """One row per key, the latest: a hash aggregate, so a key's many changes meet as one row per task."""
        names = self.schema.fieldNames()
        newest = F.max_by(F.struct(*names), F.struct(*self.order)).alias("r")
        return df.groupBy(F.struct(*self.key).alias("_key")).agg(newest).select("r.*")

    def _rows(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        folders = sorted({f for b, f in manifest["buckets"].items() if only is None or int(b) in only})
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """Current rows, without deleted keys, at the latest or a given version."""
        rows = self._rows(self.manifest(version))
        return rows if self.deleted is None else rows.filter(F.coalesce(c(self.deleted), F.lit("false")) != "true")

    def merge(self, changes: DataFrame, batch_id: int) -> dict:
        """Applies one batch of changes; returns the manifest in force afterwards."""
        now = self.manifest()
        if batch_id <= now["batch_id"]:
            return now
        latest = self._latest(changes.select(*self.schema.fieldNames())).withColumn("_b", self._bucket()).persist()
        try:
            touched = sorted(r["_b"] for r in latest.select("_b").distinct().collect())  # at most as many rows as there are buckets
            version = now["version"] + 1
            if touched:
                kept = self._rows(now, touched)
                merged = self._latest(kept.unionByName(latest.drop("_b"))).withColumn("_b", self._bucket())
                # the folder has this version's name alone, so a retry overwrites what a lost driver left
                (merged.repartition(max(1, len(touched)), "_b").write.mode("overwrite").partitionBy("_b")
                 .parquet(f"{self.path}/data/{version}"))
        finally:
            latest.unpersist()
        new = {"version": version, "batch_id": batch_id, "rewritten": touched,
               "buckets": {**now["buckets"], **{str(b): f"data/{version}/_b={b}" for b in touched}}}
        self._switch(new)
        return new

    def sink(self):
        """``foreachBatch`` function of the change stream."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.merge(batch, batch_id)
        return write

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes manifests but the last ``keep``, and bucket folders that none of those names; returns the folders."""
        have = self.versions()
        kept = have[-keep:]
        used = {f for v in kept for f in self.manifest(v)["buckets"].values()}
        gone = []
        for v in have[:-keep]:
            for f in self.manifest(v)["buckets"].values():
                if f not in used and f not in gone:
                    self._fs.delete(self._hpath(f"{self.path}/{f}"), True)
                    gone.append(f)
            self._fs.delete(self._hpath(f"{self.path}/{_MANIFEST}/{v}"), False)
        return gone
