"""Fill-in-the-middle: texts as ropes, split at two unit ranks, rearranged around sentinels, and put together again.

A rope is a balanced tree over pieces of a text's bytes. Leaves and inner nodes cache how many units end in
them and how many code points they hold, so a split by either rank walks down one path and shares all other
subtrees; joining is one new node. A unit is a word with the white space before it, or the white space that
ends a text. The form of a row depends on its id and text alone, so a lost task makes the same rows again.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, fresh, plus, text_column, text_slices
from tagmill.llm.wordhash import word_spans

#: Bytes of a leaf, about.
LEAF = 4096
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_NONE = np.empty(0, np.int64)


@dataclass(slots=True)
class Leaf:
    """Bytes of whole code points; ends: where units end in it."""

    data: bytes
    ends: np.ndarray
    units: int
    chars: int


@dataclass(slots=True)
class Node:
    left: Leaf | Node
    right: Leaf | Node
    units: int
    chars: int


Rope = Leaf | Node | None


def code_points(data: bytes) -> int:
    """How many code points valid UTF-8 holds: the bytes that continue none."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def leaf(data: bytes, ends: np.ndarray = _NONE) -> Rope:
    return Leaf(data, ends, len(ends), len(data) if data.isascii() else code_points(data)) if data else None


def join(*parts: Rope) -> Rope:
    """The parts one after the other; None is the empty rope."""
    out: Rope = None
    for p in parts:
        out = p if out is None else out if p is None else Node(out, p, out.units + p.units, out.chars + p.chars)
    return out


def build(data: bytes, ends: np.ndarray = _NONE, size: int = LEAF) -> Rope:
    """A balanced rope of UTF-8 bytes whose units end at `ends`; leaves are cut between code points."""
    if len(data) <= size:
        return leaf(data, ends)
    cuts = [0]
    while len(data) - cuts[-1] > size:
        at = cuts[-1] + size
        while data[at] & 0xC0 == 0x80:
            at -= 1
        cuts.append(at)
    cuts.append(len(data))
    # an end belongs to the leaf that holds the byte before it
    among = np.searchsorted(ends, cuts, side="right").tolist()
    row: list[Rope] = [leaf(data[a:b], ends[u:v] - a) for a, b, u, v in zip(cuts, cuts[1:], among, among[1:])]
    while len(row) > 1:
        row = [join(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return row[0]


def _cut(x: Leaf, at: int) -> tuple[Rope, Rope]:
    k = bisect_right(x.ends, at)
    return leaf(x.data[:at], x.ends[:k]), leaf(x.data[at:], x.ends[k:] - at)


def _place(x: Leaf, rank: int) -> int:
    """Where a leaf's first `rank` code points end."""
    starts = np.flatnonzero((np.frombuffer(x.data, np.uint8) & 0xC0) != 0x80)
    return int(starts[rank]) if rank < len(starts) else len(x.data)


def split(rope: Rope, rank: int, by: str) -> tuple[Rope, Rope]:
    """The rope up to and after its first `rank` units or code points (by: "units" or "chars")."""
    left: list[Rope] = []
    right: list[Rope] = []
    while True:
        if rope is None or rank <= 0:
            right.append(rope)
            break
        if rank > getattr(rope, by):
            left.append(rope)
            break
        if isinstance(rope, Leaf):
            a, b = _cut(rope, int(rope.ends[rank - 1]) if by == "units" else _place(rope, rank))
            left.append(a)
            right.append(b)
            break
        # bytes after the last end of the left part belong to a unit that ends in the right one
        if rank <= getattr(rope.left, by):
            right.append(rope.right)
            rope = rope.left
        else:
            left.append(rope.left)
            rank -= getattr(rope.left, by)
            rope = rope.right
    return join(*left), join(*reversed(right))


def flatten(rope: Rope) -> bytes:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            todo += [x.right, x.left]
        elif x is not None:
            out.append(x.data)
    return b"".join(out)


def rearranged(text: Rope, first: int, second: int, form: str) -> tuple[Rope, int, int]:
    """The text with its units from `first` to `second` last, and the code points of prefix and middle."""
    head, suffix = split(text, second, "units")
    prefix, middle = split(head, first, "units")
    p, s, m = leaf(PREFIX), leaf(SUFFIX), leaf(MIDDLE)
    out = join(p, prefix, s, suffix, m, middle) if form == "psm" else join(s, suffix, p, prefix, m, middle)
    return out, prefix.chars if prefix else 0, middle.chars if middle else 0


def restored(output: bytes, form: str) -> bytes:
    """The text that was rearranged, from its output and form, by splitting the output's rope at the sentinels."""
    if form == "plain":
        return output
    rope, parts = build(output), {}
    marks = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    places = [output.find(mark) for mark in marks]
    if places[0] != 0 or sorted(places) != places:
        raise ValueError(f"no output of form {form}")
    ends = [*places[1:], len(output)]
    for mark, at, end in zip(marks, places, ends, strict=True):
        _, rope = split(rope, len(mark), "chars")
        parts[mark], rope = split(rope, code_points(output[at + len(mark) : end]), "chars")
    return flatten(join(parts[PREFIX], parts[MIDDLE], parts[SUFFIX]))


def choices(seed: int, key: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a row, from the digest of the seed and its id; a null id is an empty one."""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """`docs` with n (units), form, prefix_chars, middle_chars and output.

    Of 100 rows about `rate` are rearranged, of 100 of those about `spm` with the suffix first (spm), the others
    with the prefix first (psm). Null texts count as empty; empty texts and texts that hold a sentinel stay
    plain, with null counts. A text of white space alone is one unit. Texts are taken whole however long they
    are; a task holds one text and some ten times its bytes besides the batch. Equal ids and texts, repeated
    rows among them, get equal results; an empty table gives none. New columns whose names are taken get a
    leading underscore.
    """
    kinds = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    names = [fresh(c, docs.columns) for c in kinds]
    schema = plus(docs.schema, **dict(zip(names, kinds.values(), strict=True)))

    def one(row_key: int | None, raw: bytes, ends: np.ndarray) -> tuple:
        n = len(ends)
        h1, h2, h3, h4 = choices(seed, row_key)
        if not raw or h3 % 100 >= rate or PREFIX in raw or SUFFIX in raw or MIDDLE in raw:
            return n, "plain", None, None, raw
        form = "spm" if h4 % 100 < spm else "psm"
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        out, prefix, middle = rearranged(build(raw, ends), first, second, form)
        return n, form, prefix, middle, flatten(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            keys = batch.column(key).to_pylist()
            for a, b in text_slices(bounds, 4 * SLICE_BYTES):
                edges = bounds[a : b + 1] - bounds[a]
                raw = data[bounds[a] : bounds[b]]
                _, ends, at = word_spans(raw, edges)
                rows, raw = [], raw.tobytes()
                for i, (x, y, u, v) in enumerate(zip(edges.tolist(), edges[1:].tolist(), at.tolist(), at[1:].tolist()), a):
                    own = ends[u:v] - x
                    if y > x and (u == v or own[-1] < y - x):
                        own = np.append(own, y - x)
                    rows.append(one(keys[i], raw[x:y], own))
                part = batch.slice(a, b - a)
                cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                out = pa.array([r[4] for r in rows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, *cols, out], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """`rows` with restored: the text that each output was made of. A null output gives null; repeated rows equal texts."""
    name = fresh("restored", rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, outputs = batch.column(form), batch.column(output)
            for a, b in text_slices(text_column(batch, output)[1], 4 * SLICE_BYTES):
                texts = outputs.slice(a, b - a).to_pylist()
                back = [None if t is None else restored(t.encode(), f.as_py()) for t, f in zip(texts, forms.slice(a, b - a), strict=True)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.binary()).cast(pa.string())], [*part.schema.names, name])

    return rows.mapInArrow(run, plus(rows.schema, **{name: "string"}))


def middle_report(docs: DataFrame) -> DataFrame:
    """Forms, sizes and digests of every document's output and of the text restored from it."""
    made = restore(fill_in_middle(docs.select("doc_id", "text")).drop("text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
c AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::UBIGINT) AS k FROM d),
s AS (
  SELECT *, least(k[1] % (n + 1), k[2] % (n + 1))::BIGINT AS a, greatest(k[1] % (n + 1), k[2] % (n + 1))::BIGINT AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= 50 THEN 'plain'
              WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (
  SELECT *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS x, coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS m,
         coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS y FROM s)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || y || '<M>' || m ELSE '<S>' || y || '<P>' || x || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
