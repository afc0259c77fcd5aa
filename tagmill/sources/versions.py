"""Versions of tables with a log of commits: what is not in the log was never written.

A write puts its files into a folder of its own, whose name no other write uses, and then adds one record to
<root>/_commits, numbered one above the last. The record appears whole or not at all, and its number can be taken
only once. Readers take their files from records alone, so a write that is lost at any step changes nothing for
them and does not stand in the way of the next one; of two writes on top of one version the second starts anew.
Keyed tables are kept in buckets of keys: a merge rewrites the buckets that it touches and keeps the files of all
others, whose places the record lists.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

LOG = "_commits"
#: Rows of a bucket, on average, from which the number of buckets is doubled.
BUCKET_ROWS = 4_000_000
#: Attempts of a merge that others keep overtaking.
ATTEMPTS = 5
_BUCKET = "bucket_"


class Overtaken(RuntimeError):
    """Another write took the number of this one."""


@dataclass(frozen=True)
class Commit:
    """One record of the log. places: folders under the root; of a keyed table by bucket."""

    number: int
    name: str
    places: dict[str, str]
    schema: str | None = None
    keys: list[str] = field(default_factory=list)
    buckets: int = 0
    rows: dict[str, int] = field(default_factory=dict)


class Versions:
    """The versions of a table, or of a set of tables, under a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.sc().hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def _names(self, below: str) -> list[tuple[str, int]]:
        """Names in a folder and when they last changed, in milliseconds."""
        at = self._path(below)
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self._names(LOG) if n.endswith(".json") and n[:-5].isdigit())

    def at(self, number: int) -> Commit:
        stream = self._fs.open(self._path(f"{LOG}/{number:012d}.json"))
        try:
            return Commit(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def latest(self) -> Commit | None:
        have = self.numbers()
        return self.at(have[-1]) if have else None

    def named(self, name: str) -> Commit | None:
        """The last commit of a name."""
        for n in reversed(self.numbers()):
            if (commit := self.at(n)).name == name:
                return commit
        return None

    def logged(self) -> bool:
        return self._fs.exists(self._path(LOG))

    def foreign(self) -> list[str]:
        """Folders of a root without a log that hold no temporary files, nor do their own folders."""
        found = []
        for name, _ in self._names(""):
            inside = [n for n, _ in self._names(name)] if self._fs.getFileStatus(self._path(name)).isDirectory() else ["_temporary"]
            if not name.startswith(("_", ".")) and "_temporary" not in inside and not any(self._fs.exists(self._path(f"{name}/{n}/_temporary")) for n in inside):
                found.append(name)
        return found

    def begin(self) -> None:
        """Make the log, so that what a first write leaves when it is lost is known as such."""
        self._fs.mkdirs(self._path(LOG))

    def taken(self, name: str) -> bool:
        """Whether a folder of this name is there, committed or lost."""
        return self._fs.exists(self._path(name))

    def folder(self, name: str) -> str:
        """A folder for a write, of a name that is never used again."""
        return f"{name}.{uuid.uuid4().hex[:12]}"

    def publish(self, commit: Commit) -> Commit:
        """Add a record to the log; Overtaken if its number is taken."""
        self.begin()
        draft, record = self._path(f"{LOG}/.{uuid.uuid4().hex}.draft"), self._path(f"{LOG}/{commit.number:012d}.json")
        out = self._fs.create(draft, False)
        out.write(json.dumps(asdict(commit)).encode())
        out.close()
        return self._promote(draft, record, commit)

    def _promote(self, draft, record, commit: Commit) -> Commit:
        """Give a written draft its number."""
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        kinds = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kinds, 1)
        how[0] = kinds.NONE
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(record), how)
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            self._fs.delete(draft, False)
            raise Overtaken(f"{commit.name}: number {commit.number} is taken") from e
        return commit

    def read(self, commit: Commit, buckets: list[int] | None = None) -> DataFrame:
        """A committed table; buckets: only these of a keyed one."""
        schema = StructType.fromJson(json.loads(commit.schema))
        places = [p for b, p in commit.places.items() if buckets is None or int(b) in buckets]
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in places])

    def write(self, df: DataFrame, name: str) -> Commit:
        """A whole table as a new version."""
        self.begin()
        last, place = self.latest(), self.folder(name)
        self._files(df, place)
        return self.publish(Commit(last.number + 1 if last else 0, name, {"0": place}, df.schema.json()))

    def _files(self, df: DataFrame, place: str, by: list[str] | None = None) -> None:
        df.write.partitionBy(*by or []).parquet(f"{self.root}/{place}")

    def merge(self, rows: DataFrame, keys: list[str], order: str, name: Callable[[str], str], buckets: int = 64) -> Commit:
        """Merge rows into the keyed table: of each key the row with the largest `order` stays, of equal ones the new.

        name: a version's name from the last one's. Null keys and null orders are values, the null order the
        smallest; of new rows with equal keys and orders any one stays. Columns that one side lacks are null
        there. Only buckets with new rows are read and rewritten, each by one task; their number doubles, and
        all are rewritten, when they hold BUCKET_ROWS rows on average. Without rows nothing is written.
        """
        self.begin()
        for _ in range(ATTEMPTS):
            last = self.latest()
            try:
                done = self._merged(rows, keys, order, name, buckets, last)
            except Overtaken:
                continue
            return done
        raise Overtaken(f"{ATTEMPTS} attempts to merge into {self.root} were overtaken")

    def _merged(self, rows: DataFrame, keys: list[str], order: str, name: Callable[[str], str], buckets: int, last: Commit | None) -> Commit:
        if last is not None and last.keys != keys:
            raise ValueError(f"the table's keys are {last.keys}")
        n, split = (last.buckets, False) if last else (buckets, False)
        while last is not None and sum(last.rows.values()) >= n * BUCKET_ROWS:
            n, split = 2 * n, True
        of = lambda df, m: df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(m)).cast("int"))
        # at most as many numbers as there are buckets
        touched = sorted(r[0] for r in of(rows, n).select(_BUCKET).distinct().collect())
        if not touched and last is not None:
            return last
        both = rows.withColumn("new_", F.lit(1))
        if last is not None:
            old = self.read(last, None if split else touched)
            both = both.unionByName(old.withColumn("new_", F.lit(0)), allowMissingColumns=True)
        schema = both.drop("new_").schema
        # one shuffle: what is dealt by bucket is dealt by bucket and key too
        w = Window.partitionBy(_BUCKET, *keys).orderBy(F.desc_nulls_last(order), F.desc("new_"))
        dealt = of(both, n).repartition(n if split else max(1, len(touched)), _BUCKET)
        merged = dealt.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_", "new_")
        label = name(last.name if last else "")
        place = self.folder(label)
        self._files(merged, place, [_BUCKET])
        written = self.spark.read.schema(StructType([*schema.fields]).add(_BUCKET, IntegerType())).parquet(f"{self.root}/{place}")
        sizes = {str(r[0]): r[1] for r in written.groupBy(_BUCKET).count().collect()}
        kept = {} if last is None or split else {b: p for b, p in last.places.items() if b not in sizes}
        counts = {} if last is None or split else {b: c for b, c in last.rows.items() if b not in sizes}
        places = kept | {b: f"{place}/{_BUCKET}={b}" for b in sizes}
        return self.publish(Commit(last.number + 1 if last else 0, label, places, _nullable(schema), keys, n, counts | sizes))

    def clean(self, keep: int = 1, hours: float = 24) -> list[str]:
        """Delete all but the last `keep` commits, and folders that none of the kept needs; what was deleted.

        Folders and drafts younger than `hours` stay unless an old commit names them: a running write may own them.
        """
        numbers = self.numbers()
        old, kept = numbers[: max(0, len(numbers) - keep)], [self.at(n) for n in numbers[max(0, len(numbers) - keep) :]]
        needed = {p.split("/")[0] for c in kept for p in c.places.values()}
        given_up = {p.split("/")[0] for n in old for p in self.at(n).places.values()} - needed
        before = (time.time() - 3600 * hours) * 1000
        gone = []
        # records first: no reader is sent to a folder that goes
        for n in old:
            self._fs.delete(self._path(f"{LOG}/{n:012d}.json"), False)
        for name, changed in self._names(""):
            if name != LOG and not name.startswith("_") and name not in needed and (name in given_up or changed < before):
                self._fs.delete(self._path(name), True)
                gone.append(name)
        for name, changed in self._names(LOG):
            if name.endswith(".draft") and changed < before:
                self._fs.delete(self._path(f"{LOG}/{name}"), False)
        return sorted(gone)


def _nullable(schema: StructType) -> str:
    """The schema as JSON with every column nullable: files of earlier merges may lack some."""
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]).json()


def write_whole(df: DataFrame, path: str) -> None:
    """Write a table that is at `path` whole or not at all; FileExistsError if something is there already."""
    at = Versions(df.sparkSession, path.rstrip("/").rpartition("/")[0])
    name = path.rstrip("/").rpartition("/")[2]
    if at._fs.exists(at._path(name)):
        raise FileExistsError(path)
    draft = f"_{name}.{uuid.uuid4().hex[:12]}"
    at._files(df, draft)
    if at._fs.exists(at._path(name)) or not at._fs.rename(at._path(draft), at._path(name)):
        raise FileExistsError(path)
