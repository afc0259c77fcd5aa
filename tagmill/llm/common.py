"""Shared helpers: working tables in the cluster's shared folder, Arrow text buffers, packed arrays."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes that one block or slice of work holds, apart from a single longer text.
BLOCK_BYTES = 10_000_000
SLICE_BYTES = 1 << 20
#: Keys that hold more than this part of a table's rows are joined by broadcast or dealt over several tasks.
HEAVY = 4000


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset, one of our own.

    Unset on a local master: a temporary folder of this machine, which driver and executors share there.
    Unset on a cluster: a folder in the warehouse. Our own stays the same for an application.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if context.applicationId not in _own:
        local = context.master.startswith("local")
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tagmill-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tagmill-work"
    return _own[context.applicationId]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tagmill/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def forget(*tables: DataFrame) -> None:
    """Delete working tables that stored() wrote and that no result reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.sc().hadoopConfiguration()).delete(path, True)


def heavy_above(total: int) -> int:
    """The number of rows above which a key is heavy; at most HEAVY keys of `total` rows are."""
    return max(1000, total // HEAVY)


def join_heavy(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """left joined with right, whose keys are unique; heavy: right's rows of heavy keys, at most HEAVY, which are broadcast."""
    hot = left.join(F.broadcast(heavy), key)
    return hot.unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(right, key))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, from one scan."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and the n + 1 offsets between them; null counts as empty."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "" if not pa.types.is_binary(col.type) else b"")
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_slices(bounds: np.ndarray, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Ranges of consecutive texts of about `most` bytes together; a longer text is a range of its own."""
    out, at, n = [], 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        out.append((at, min(to, n)))
        at = out[-1][1]
    return out


def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """An integer array as zstd over byte planes; delta: of the differences, for sorted unsigned values."""
    a = np.ascontiguousarray(values)
    if delta and len(a):
        a = np.diff(a, prepend=a.dtype.type(0))
    planes = a.view(np.uint8).reshape(len(a), -1).T.copy() if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes() if len(a) else b"")


def unpack(blob: bytes, dtype: str | np.dtype, delta: bool = False) -> np.ndarray:
    """What pack() stored."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    kind = np.dtype(dtype)
    a = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()
    return np.cumsum(a, dtype=kind) if delta else a


def pack_all(*arrays: np.ndarray) -> bytes:
    """Several arrays in one blob."""
    parts = [pack(a) for a in arrays]
    return np.array([len(p) for p in parts], np.uint32).tobytes() + b"".join(parts)


def unpack_all(blob: bytes, *kinds: str) -> list[np.ndarray]:
    """What pack_all() stored."""
    sizes = np.frombuffer(blob, np.uint32, len(kinds))
    ends = np.cumsum(sizes) + 4 * len(kinds)
    return [unpack(blob[e - s : e], k) for e, s, k in zip(ends.tolist(), sizes.tolist(), kinds, strict=True)]


def plus(schema: StructType, **kinds: str) -> StructType:
    """A copy of a schema with more fields."""
    out = StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, StructType.fromDDL(f"c {kind}")[0].dataType)
    return out


def fresh(wanted: str, taken: list[str]) -> str:
    """`wanted`, or with underscores before it where a column has that name already."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted
