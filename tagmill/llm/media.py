"""Media columns: bytes kept losslessly as PNG images in a binary column, and perceptual hashes of them.

A payload becomes an 8-bit grey image of 64 columns: a PNG with one filtered scan line per 64 bytes,
deflated, each chunk with its checksum. Reading tests signature, checksums and sizes, inflates, and undoes
the line filters in numpy. The feature is a 64-bit hash from the signs of low-frequency cosine coefficients.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, fresh, plus, text_column, text_slices

WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


class BadMedia(ValueError):
    """Stored bytes that are no intact image of this kind."""


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def padded(data: bytes) -> bytes:
    """data and zero bytes up to a positive multiple of WIDTH."""
    return data + b"\0" * ((-len(data)) % WIDTH or (0 if data else WIDTH))


def encode_png(payload: bytes, filter_type: int = 1) -> bytes:
    """A grey PNG of WIDTH columns; filter_type 0 (none), 1 (left) or 2 (above) for all lines."""
    grid = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.empty((len(grid), WIDTH + 1), np.uint8)
    lines[:, 0] = filter_type
    lines[:, 1:] = grid
    if filter_type == 1:
        lines[:, 2:] -= grid[:, :-1]
    elif filter_type == 2:
        lines[1:, 1:] -= grid[:-1]
    head = struct.pack(">IIBBBBB", WIDTH, len(grid), 8, 0, 0, 0, 0)
    return b"".join([_SIGNATURE, _chunk(b"IHDR", head), _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)), _chunk(b"IEND", b"")])


def _unfilter(lines: np.ndarray) -> np.ndarray:
    """Undo the line filters, runs of one kind at a time."""
    kinds, out = lines[:, 0], lines[:, 1:].copy()
    if len(kinds) and kinds.max() > 4:
        raise BadMedia("unknown line filter")
    cuts = np.r_[0, np.flatnonzero(np.diff(kinds)) + 1, len(kinds)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        kind = kinds[a]
        if kind == 1:
            out[a:b] = np.cumsum(out[a:b], axis=1, dtype=np.uint8)
        elif kind == 2:
            if a:
                out[a] += out[a - 1]
            out[a:b] = np.cumsum(out[a:b], axis=0, dtype=np.uint8)
        elif kind in (3, 4):
            for r in range(a, b):
                above = out[r - 1].tolist() if r else [0] * out.shape[1]
                row, left, corner = out[r].tolist(), 0, 0
                for c, up in enumerate(above):
                    if kind == 3:
                        guess = (left + up) >> 1
                    else:
                        near = left + up - corner
                        guess = min((abs(near - left), 0, left), (abs(near - up), 1, up), (abs(near - corner), 2, corner))[2]
                    left, corner = (row[c] + guess) & 255, up
                    row[c] = left
                out[r] = row
    return out


def decode_png(stored: bytes) -> np.ndarray:
    """The samples of an 8-bit grey image; BadMedia if a test fails."""
    if stored[:8] != _SIGNATURE:
        raise BadMedia("signature")
    at, data, size, ended = 8, [], None, False
    while at + 12 <= len(stored) and not ended:
        (n,) = struct.unpack_from(">I", stored, at)
        kind, body = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + n]
        if len(body) != n or stored[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + body)):
            raise BadMedia("checksum")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended, at = kind == b"IEND", at + 12 + n
    if not ended or size is None or size[2:] != (8, 0, 0, 0, 0):
        raise BadMedia("layout")
    try:
        raw = zlib.decompress(b"".join(data))
    except zlib.error as e:
        raise BadMedia("deflate") from e
    if len(raw) != size[1] * (size[0] + 1):
        raise BadMedia("size")
    return _unfilter(np.frombuffer(raw, np.uint8).reshape(size[1], size[0] + 1))


_COS = np.cos(np.pi / 32 * (np.arange(32) + 0.5) * np.arange(8)[:, None])


def cosine_hash(grid: np.ndarray) -> str:
    """64 bits as hex: which of the 8 x 8 lowest cosine coefficients of a 32 x 32 mean image exceed their median."""
    h, w = grid.shape
    image = grid.astype(np.float64)
    for axis, n in ((0, h), (1, w)):
        edges = np.arange(32) * n // 32
        if n >= 32:
            image = np.add.reduceat(image, edges, axis=axis)
            sizes = np.diff(np.r_[edges, n])
            image /= sizes[:, None] if axis == 0 else sizes
        else:
            image = np.take(image, edges, axis=axis)
    low = (_COS @ image @ _COS.T).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def store_media(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """`docs` with n_bytes (of the text in UTF-8) and the text as an image in a binary column; null counts as empty.

    Texts are stored whole, however long: a task holds a few copies of one text beside its batch. Equal texts and
    repeated rows give equal images; an empty table gives none. New columns whose names are taken get a leading
    underscore.
    """
    names = [fresh("n_bytes", docs.columns), fresh(media, docs.columns)]
    schema = plus(docs.schema, **dict(zip(names, ("long", "binary"), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            for a, b in text_slices(bounds, 4 * SLICE_BYTES):
                part = batch.slice(a, b - a)
                ends = bounds[a : b + 1].tolist()
                raw = data[ends[0] : ends[-1]].tobytes()
                images = [encode_png(padded(raw[x - ends[0] : y - ends[0]])) for x, y in zip(ends, ends[1:])]
                sizes = pa.array(np.diff(bounds[a : b + 1]), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, sizes, pa.array(images, pa.binary())], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


_READ = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "feature": "string", "error": "string"}


def read_media(rows: DataFrame, media: str = "media") -> DataFrame:
    """`rows` with payload_bytes, payload_sha256, tail_crc32, feature and error, all from the stored images alone.

    An image that fails a test, or null, gives its error's name ("missing" for null) and nulls. Repeated
    images give equal values; an empty table gives none. New columns whose names are taken get a leading
    underscore.
    """
    names = {fresh(c, rows.columns): k for c, k in _READ.items()}
    schema = plus(rows.schema, **names)

    def features(stored: bytes | None) -> tuple:
        if stored is None:
            return None, None, None, None, "missing"
        try:
            grid = decode_png(stored)
        except BadMedia as e:
            return None, None, None, None, str(e)
        payload = grid.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), cosine_hash(grid), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            got = [features(m) for m in batch.column(media).to_pylist()]
            new = [pa.array([g[i] for g in got], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return rows.mapInArrow(run, schema)


def media_report(docs: DataFrame) -> DataFrame:
    """Digests of stored and read-back form of every document's text."""
    stored = store_media(docs.select("doc_id", "text")).drop("text")
    return read_media(stored).select(
        "doc_id",
        "n_bytes",
        "payload_bytes",
        "payload_sha256",
        "tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
