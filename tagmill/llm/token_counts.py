"""Token counts: byte-level BPE by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, fresh, plus, text_column, text_slices

#: Fixed pattern of this kind of tokenizer.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Symbols of a sequence that is merged by itself.
LONG = 2048
#: Distinct pre-tokens whose counts a worker remembers.
_REMEMBER = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class HashTable:
    """A fixed map of integers to integers with linear probing, for lookups of whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int) -> None:
        self.bits = max(4, (4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values, self.missing = np.full(size, -1, np.int64), np.full(size, missing, np.int64), missing
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == -1
            put = np.flatnonzero(free)[np.unique(at[free], return_index=True)[1]]
            self.keys[at[put]], self.values[at[put]] = keys[left[put]], values[left[put]]
            stay = np.ones(len(left), bool)
            stay[put] = False
            left, at = left[stay], (at[stay] + (self.keys[at[stay]] != -1)) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        there = self.keys[at]
        out = self.values[at]
        off = np.flatnonzero((there != keys) & (there != -1))
        out[off] = self.missing
        at = at[off]
        while len(off):
            at = (at + 1) % len(self.keys)
            there = self.keys[at]
            same = there == keys[off]
            out[off[same]] = self.values[at[same]]
            go = ~same & (there != -1)
            off, at = off[go], at[go]
        return out


class Merges:
    """Merge rules of a BPE vocabulary over ragged arrays of token ids."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        self.none, self.made = len(made), made
        self.ranked = HashTable(left << 32 | right, np.arange(len(made)), len(made))

    def apply(self, ids: np.ndarray, sizes: np.ndarray, want_ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Sizes, and with want_ids the ids, of all sequences after their last merge; `sizes` are positive.

        Every round applies each sequence's lowest-ranked pair, wherever it stands, in all sequences at once. As
        a round costs the length of what goes on, sequences over LONG are merged by themselves.
        """
        long = sizes > LONG
        if not long.any():
            return self._together(ids, sizes, want_ids)
        ends = np.cumsum(sizes)
        merged = {i: self.alone(ids[ends[i] - sizes[i] : ends[i]]) for i in np.flatnonzero(long).tolist()}
        short_sizes, short = self._together(ids[~np.repeat(long, sizes)], sizes[~long], want_ids)
        out = np.empty(len(sizes), np.int64)
        out[~long], out[long] = short_sizes, [len(merged[i]) for i in sorted(merged)]
        if not want_ids:
            return out, None
        flat = np.empty(int(out.sum()), np.int64)
        mine = np.repeat(long, out)
        flat[~mine], flat[mine] = short, np.concatenate([merged[i] for i in sorted(merged)])
        return out, flat

    def alone(self, ids: np.ndarray) -> np.ndarray:
        """One sequence after its last merge, as apply() does it, in time about proportional to its length.

        Places wait by the rank of the pair that starts there; a round looks only at those of the lowest rank
        and finds new pairs only around what it merged.
        """
        n, ids = len(ids), ids.copy()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, self.none)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def look(at: np.ndarray) -> None:
            right = after[at]
            there = right < n
            rank[at] = self.none
            rank[at[there]] = self.ranked.find(ids[at[there]] << 32 | ids[right[there]])
            at = at[rank[at] < self.none]
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            cut = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cut) if len(at) else []:
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        look(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # in a run such as "aaaa" every second place merges, from the left
            head = np.r_[True, at[1:] != after[at[:-1]]]
            at = at[(np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 0]
            gone = after[at]
            ids[at] = self.made[r]
            rank[gone], ids[gone] = self.none, -1
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            left = before[at]
            look(np.unique(np.concatenate([at, left[left >= 0]])))
        return ids[ids >= 0]

    def _together(self, ids: np.ndarray, sizes: np.ndarray, want_ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        out, seq, done = np.zeros(len(sizes), np.int64), np.arange(len(sizes)), []
        ids = ids.copy()
        while len(seq):
            starts = np.cumsum(sizes) - sizes
            rank = np.full(len(ids), self.none)
            rank[:-1] = self.ranked.find(ids[:-1] << 32 | ids[1:])
            rank[starts + sizes - 1] = self.none
            least = np.minimum.reduceat(rank, starts)
            going = least < self.none
            stay = np.repeat(going, sizes)
            out[seq[~going]] = sizes[~going]
            if want_ids and not going.all():
                done.append((np.repeat(seq[~going], sizes[~going]), ids[~stay]))
            ids, rank, least, sizes, seq = ids[stay], rank[stay], least[going], sizes[going], seq[going]
            at = np.flatnonzero((rank == np.repeat(least, sizes)) & (rank < self.none))
            if not len(at):
                continue
            # in a run such as "aaaa" every second place merges, from the left
            head = np.r_[True, np.diff(at) != 1]
            at = at[(np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 0]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            sizes = sizes - np.add.reduceat(~keep, np.cumsum(sizes) - sizes)
            ids = ids[keep]
        if not want_ids:
            return out, None
        owner = np.concatenate([o for o, _ in done] or [np.empty(0, np.int64)])
        flat = np.concatenate([i for _, i in done] or [np.empty(0, np.int64)])
        return out, flat[np.argsort(owner, kind="stable")]


def read_vocabulary(path: str) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    """The vocabulary, the left, right and resulting id of every merge, and the added tokens of a JSON file."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    vocab = made["model"]["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"]]
    sides = (np.array([vocab[x] for x in side], np.int64) for side in zip(*[(a, b, a + b) for a, b in pairs], strict=True))
    return vocab, *sides, made.get("added_tokens", [])


def _counter(path: str):
    vocab, left, right, made, added = read_vocabulary(path)
    merges, known = Merges(left, right, made), {}
    first = np.array([vocab[c] for c in byte_letters()], np.int64)
    cut = regex.compile("|".join(regex.escape(t["content"]) for t in added)) if added else None

    def count(texts: list[str]) -> list[int]:
        if len(known) > _REMEMBER:
            known.clear()
        split, extra = [], []
        for t in texts:
            n = 0
            if cut and (parts := cut.split(t))[1:]:
                n, found = len(parts) - 1, [x for p in parts for x in _PIECES.findall(p)]
            else:
                found = _PIECES.findall(t)
            split.append(found)
            extra.append(n)
        new = list({x for found in split for x in found if x not in known})
        if new:
            raw = [x.encode() for x in new]
            sizes = np.array([len(x) for x in raw], np.int64)
            left_over, _ = merges.apply(first[np.frombuffer(b"".join(raw), np.uint8)], sizes, want_ids=False)
            known.update(zip(new, left_over.tolist(), strict=True))
        return [n + sum(map(known.__getitem__, found)) for n, found in zip(extra, split, strict=True)]

    return count


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """`docs` with the number of tokens of each whole text.

    tokenizer: path of a byte-level BPE vocabulary in JSON, readable on every machine. No begin, end or
    added tokens are counted, but an added token's string inside a text is one token. A null or empty text
    has 0 tokens; repeated rows count each; an empty table gives none. A new column whose name is taken
    gets a leading underscore.
    """
    name = fresh(out, docs.columns)
    schema = plus(docs.schema, **{name: "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in batches:
            _, bounds = text_column(batch, text)
            for a, b in text_slices(bounds, 4 * SLICE_BYTES):
                part = batch.slice(a, b - a)
                n = count([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def count_report(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    counted = token_counts(docs.select("doc_id", "text"), tokenizer)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
