"""Caches of scores in buckets of their keys: to look a batch up shuffles the batch, never the cache."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Buckets of a new cache: at 1 GB a bucket good for some 1e10 scores.
BUCKETS = 512
RECORD = "_cache.json"


class ScoreCache:
    """A table of scores under a folder, in as many files for each append as it meets buckets.

    The record of keys, schema and buckets lies in the folder, so any session can go on with a cache; a session
    knows it as an external table. Appends add files; a lost one may leave some of its rows, each of them whole.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.table = "tagmill_cache_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self._fs = self._at("").getFileSystem(spark._jsc.sc().hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _record(self) -> dict | None:
        if not self._fs.exists(self._at(RECORD)):
            return None
        stream = self._fs.open(self._at(RECORD))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _begin(self, schema: StructType) -> None:
        if self._fs.exists(self._at("")) and any(not s.getPath().getName().startswith(("_", ".")) for s in self._fs.listStatus(self._at(""))):
            raise ValueError(f"{self.path} holds files, but no record of a cache: append them to a new one")
        draft = self._at(f".{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(json.dumps({"keys": self.keys, "buckets": self.buckets, "schema": schema.json()}).encode())
        out.close()
        # of two sessions that begin at once the first one's record holds
        if not self._fs.rename(draft, self._at(RECORD)):
            self._fs.delete(draft, False)

    def rows(self) -> DataFrame | None:
        """All scores; None before the first append."""
        record = self._record()
        if record is None:
            return None
        if record["keys"] != self.keys:
            raise ValueError(f"the cache's keys are {record['keys']}")
        columns = StructType.fromJson(json.loads(record["schema"])).toDDL()
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {record['buckets']} BUCKETS LOCATION '{self.path}'")
        # others may have appended
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the cache lacks, each key once; rows go to the buckets of their keys, the cache stays where it is.

        Keys must have the cache's types. A null key is never found, and scored each time.
        """
        cache = self.rows()
        left = rows if cache is None else rows.join(cache.select(*self.keys), self.keys, "left_anti")
        return left.dropDuplicates(self.keys)

    def append(self, scored: DataFrame) -> None:
        """Add scores; columns that the cache does not have are an error."""
        if self._record() is None:
            self._begin(scored.schema)
        have = self.rows().columns
        if set(have) != set(scored.columns):
            raise ValueError(f"the cache's columns are {have}")
        scored.select(*have).write.insertInto(self.table)
