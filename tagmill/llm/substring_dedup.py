"""Removal of passages that occur more than once, by hashes of every fixed-length window of words.

Each block of documents hashes all its windows (Rabin-Karp over 64-bit word hashes), sorts them, and sends each
distinct hash once, with whether it stands there twice already, to the shard of its range. Shards count over all
blocks and answer one bit a hash. Windows whose hash is repeated are then compared by their words: each block
asks again with a cryptographic digest of the window's own text beside the hash, and only a window whose words
are repeated stays. Each block marks all words of its repeated windows; overlapping and touching windows merge
into maximal intervals, which are cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import fresh, pack, plus, text_column, text_slices, unpack
from tagmill.llm.exchange import cuts, in_blocks, n_blocks
from tagmill.llm.wordhash import window_hashes, word_hashes, word_spans

WINDOW = 35
#: Keys that a task sorts at once, about.
SORTED = 1 << 18
#: Kinds of questions, by the number of numbers that make a key.
_HASHES, _DIGESTS = 1, 2
_MESSAGE = "kind int, block long, shard long, payload binary"


def _windows(data: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of all texts, in order."""
    out = [np.empty(0, np.uint64)]
    for a, b in text_slices(bounds):
        words, at = word_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], lower=False)
        out.append(window_hashes(words, at, size)[0])
    return np.concatenate(out)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), count=n).astype(bool)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by `keys`, first key first, and where each run of equal rows starts in it."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    first = np.ones(len(order), bool)
    first[1:] = False
    for k in keys:
        k = k[order]
        first[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(first)


class _Asked:
    """The distinct keys of a block: hashes, or hashes with digests, in order; and how to bring answers back.

    Keys are sorted a run of shards at a time, so that a task holds little more than the keys themselves.
    """

    def __init__(self, shards: int, *keys: np.ndarray) -> None:
        self.shards, self.keys = shards, keys

    def _runs(self):
        """For each run of shards with about SORTED keys: the places of its keys, in order, where equal ones start, and the distinct keys."""
        n, width = len(self.keys[0]), -(-(1 << 64) // self.shards)
        step = max(1, self.shards * SORTED // max(1, n))
        for s in range(0, self.shards, step):
            mine = np.ones(n, bool) if s == 0 else self.keys[0] >= np.uint64(s * width)
            if s + step < self.shards:
                mine &= self.keys[0] < np.uint64((s + step) * width)
            rows = np.flatnonzero(mine)
            order, starts = _groups(*[k[rows] for k in self.keys])
            rows = rows[order]
            yield rows, starts, [k[rows[starts]] for k in self.keys]

    def messages(self, kind: int, block: int) -> pa.Table:
        shards, payload = [], []
        for rows, starts, keys in self._runs():
            twice = np.diff(np.r_[starts, len(rows)]) > 1
            for s, a, b in cuts(keys[0], self.shards):
                parts = [pack(keys[0][a:b], delta=True), *[pack(k[a:b]) for k in keys[1:]], _bits(twice[a:b])]
                payload.append(np.array([b - a, *map(len, parts)], np.uint64).tobytes() + b"".join(parts))
                shards.append(s)
        return _messages(kind, [block] * len(payload), shards, payload)

    def told(self, shards: list[int], blobs: list[bytes]) -> np.ndarray:
        """For each row whether its key is repeated anywhere."""
        answer, out = dict(zip(shards, blobs, strict=True)), np.zeros(len(self.keys[0]), bool)
        for rows, starts, keys in self._runs():
            repeated = np.zeros(len(starts), bool)
            for s, a, b in cuts(keys[0], self.shards):
                repeated[a:b] = _flags(answer[s], b - a)
            out[rows] = np.repeat(repeated, np.diff(np.r_[starts, len(rows)]))
        return out


def _messages(kind: int, blocks: list, shards: list, payload: list[bytes]) -> pa.Table:
    n = len(payload)
    arrays = [pa.array([kind] * n, pa.int32()), pa.array(blocks, pa.int64()), pa.array(shards, pa.int64()), pa.array(payload, pa.binary())]
    return pa.table(arrays, ["kind", "block", "shard", "payload"])


def _answers(table: pa.Table, kind: int) -> tuple[list[int], list[bytes]]:
    rows = zip(*(table.column(c).to_pylist() for c in ("kind", "shard", "payload")), strict=True)
    mine = [(s, p) for k, s, p in rows if k == kind]
    return [s for s, _ in mine], [p for _, p in mine]


def _question(text: str, block: str, size: int, shards: int):
    def ask(part: pa.Table) -> pa.Table:
        data, bounds = text_column(part, text)
        return _Asked(shards, _windows(data, bounds, size)).messages(_HASHES, part.column(block)[0].as_py())

    return ask


def _answer(part: pa.Table) -> pa.Table:
    """One bit for each key of each question: whether it occurs twice or more over all blocks."""
    kind = part.column("kind")[0].as_py()
    questions, twice = [], []
    for q in part.column("payload").to_pylist():
        n, *sizes = np.frombuffer(q, np.uint64, 2 + kind).tolist()
        ends = (np.cumsum(sizes).astype(int) + 8 * (2 + kind)).tolist()
        parts = [q[e - int(m) : e] for e, m in zip(ends, sizes, strict=True)]
        questions.append([unpack(parts[0], "uint64", delta=True), *[unpack(p, "uint64") for p in parts[1:-1]]])
        twice.append(_flags(parts[-1], int(n)))
    # questions are sorted by their first key: ranges of it, alike in all of them, are counted one after the other
    some = [q[0] for q in questions if len(q[0])]
    low, high = (int(f(k[at] for k in some)) if some else 0 for f, at in ((min, 0), (max, -1)))
    ranges = max(1, sum(map(len, some)) // SORTED)
    edges = np.array([low + (high - low) * i // ranges for i in range(1, ranges)], np.uint64)
    places = [[0, *np.searchsorted(q[0], edges).tolist(), len(q[0])] for q in questions]
    for i in range(ranges):
        own = [slice(at[i], at[i + 1]) for at in places]
        order, starts = _groups(*[np.concatenate([k[x] for k, x in zip(same, own, strict=True)]) for same in zip(*questions, strict=True)])
        if not len(order):
            continue
        flags = np.concatenate([t[x] for t, x in zip(twice, own, strict=True)])
        sizes = np.diff(np.r_[starts, len(order)])
        many = np.logical_or.reduceat(flags[order], starts) | (sizes > 1)
        flags[order] = np.repeat(many, sizes)
        ends = np.cumsum([x.stop - x.start for x in own])
        for t, x, e in zip(twice, own, ends.tolist(), strict=True):
            t[x] = flags[e - (x.stop - x.start) : e]
    payload = [_bits(t) for t in twice]
    return _messages(kind, part.column("block").to_pylist(), part.column("shard").to_pylist(), payload)


def _digests(data: np.ndarray, bounds: np.ndarray, hits: np.ndarray, size: int) -> np.ndarray:
    """A digest of the words of each window that `hits` marks, joined by one space, in order."""
    out, done = bytearray(), 0
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        words = data[a:b].tobytes().split()
        m = max(len(words) - size + 1, 0)
        at = np.flatnonzero(hits[done : done + m])
        done += m
        if len(at):
            line = b" ".join(words)
            place = np.r_[0, np.cumsum([len(w) + 1 for w in words])]
            for x, y in zip(place[at].tolist(), (place[at + size] - 1).tolist()):
                out += hashlib.blake2b(line[x:y], digest_size=8).digest()
    return np.frombuffer(out, np.uint64)


def _confirmed(part: pa.Table, answers: pa.Table, text: str, size: int, shards: int) -> tuple[np.ndarray, np.ndarray, _Asked]:
    """All windows' hashes, which of them are candidates, and the second question about these."""
    data, bounds = text_column(part, text)
    hashes = _windows(data, bounds, size)
    hits = _Asked(shards, hashes).told(*_answers(answers, _HASHES))
    return hashes, hits, _Asked(shards, hashes[hits], _digests(data, bounds, hits, size))


def _confirm(text: str, block: str, size: int, shards: int):
    def confirm(part: pa.Table, answers: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _messages(_DIGESTS, [], [], [])
        _, _, asked = _confirmed(part, answers, text, size, shards)
        return asked.messages(_DIGESTS, part.column(block)[0].as_py())

    return confirm


def _removal(covered: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals of covered words."""
    edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _apply(text: str, block: str, size: int, shards: int, names: list[str]):
    def apply(part: pa.Table, answers: pa.Table) -> pa.Table:
        data, bounds = text_column(part, text)
        _, hits, asked = _confirmed(part, answers, text, size, shards)
        hits[hits] = asked.told(*_answers(answers, _DIGESTS))
        n_words, n_removed, kept, spans, done = [], [], [], [], 0
        for a, b in text_slices(bounds):
            raw, inner = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            starts, ends, at = word_spans(raw, inner)
            whole = raw.tobytes()
            for i in range(b - a):
                x, y = int(at[i]), int(at[i + 1])
                n, m = y - x, max(y - x - size + 1, 0)
                own = hits[done : done + m]
                done += m
                words = whole[inner[i] : inner[i + 1]].split()
                cover: list[tuple[int, int]] = []
                if own.any():
                    more = np.zeros(n + 1, np.int64)
                    at_hit = np.flatnonzero(own)
                    more[at_hit] += 1
                    np.add.at(more, at_hit + size, -1)
                    cover = _removal(np.cumsum(more[:n]) > 0)
                    left, rest = 0, []
                    for p, q in cover:
                        rest += words[left:p]
                        left = q
                    words = rest + words[left:]
                n_words.append(n)
                n_removed.append(sum(q - p for p, q in cover))
                kept.append(b" ".join(words))
                spans.append([{"start": p, "end": q} for p, q in cover])
        cols = [part.column(c) for c in part.column_names if c != block]
        new = [
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
        return pa.table([*cols, *new], [*[c for c in part.column_names if c != block], *names])

    return apply


def drop_repeats(docs: DataFrame, text: str = "text", size: int = WINDOW, blocks: int | None = None) -> DataFrame:
    """`docs` with n_words, n_removed, kept_text and removed (intervals of word positions, end exclusive).

    Words are runs of bytes other than space and bytes 9 to 13, unchanged. A word goes if a window of `size`
    words that covers it starts at another place too, in the same or another row. Null or empty texts and texts
    of fewer than `size` words lose nothing; kept_text joins the kept words by one space and is empty for a null
    text. Repeated rows lose all windows they share. An empty table gives none. New columns whose names are
    taken get a leading underscore. Windows count as equal by a 61-bit hash of their words' hashes and a 64-bit
    digest of their words. Rows that are equal in every column go to one block. Texts are taken whole, however
    long: a block holds some 10 MB of text, a longer text alone.
    """
    n = blocks or n_blocks(docs, text)
    dealt, block = in_blocks(docs, n, docs.columns)
    names = [fresh(c, docs.columns) for c in ("n_words", "n_removed", "kept_text", "removed")]
    kinds = ("long", "long", "string", "array<struct<start:long,end:long>>")
    by_block = dealt.groupBy(block)
    found = by_block.applyInArrow(_question(text, block, size, n), _MESSAGE).groupBy("shard").applyInArrow(_answer, _MESSAGE)
    again = by_block.cogroup(found.groupBy("block")).applyInArrow(_confirm(text, block, size, n), _MESSAGE)
    answers = found.union(again.groupBy("shard").applyInArrow(_answer, _MESSAGE))
    schema = plus(docs.schema, **dict(zip(names, kinds, strict=True)))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_apply(text, block, size, n, names), schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and a digest of the kept words of every document."""
    out = drop_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
