"""Language-model scores: a Katz back-off n-gram model with Good-Turing discounts, learned from the whole corpus.

Counts live in shards (see exchange.py). Blocks of documents ask for the training counts of their words, then for
those of their bigrams, and so on up to the model's order. Answers bring counts and numbers: a word is told by its letters,
a bigram by its words' numbers, a trigram by its first bigram's and its last word's, so no two n-grams are ever
taken for one. The shards of a context also add up, as integers, what its back-off weight needs: its followers by
their counts at its own order and at the order below. So every weight is exactly
(1 - mass of seen followers) / (1 - their mass at the order below). An n-gram that only one block has is settled
there, without asking on. What scoring needs is stored as a partitioned table, and discounts, known once all counts of
counts are summed, are applied to it token by token, order by order: the n-gram, else its context's weight times
the n-gram one word shorter, down to the word, else a share of the mass of unknown words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import pack, pack_all, shared_dir, unpack, unpack_all
from tagmill.llm.exchange import MOST_PARTITIONS, cuts, n_blocks
from tagmill.llm.language_id import fold
from tagmill.llm.wordhash import hashes_of, lowered, mix64, word_spans

#: Counts above this are not discounted.
TRUST = 5
#: The model's order, unless another is asked for.
ORDER = 2
#: Training tokens of a context that one shard takes; a more frequent context is dealt over several.
CONTEXT_TOKENS = 1_000_000
_MESSAGE = "kind int, block long, shard long, payload binary, stats array<long>"
_FOLLOWERS = 2 * (TRUST + 1)
_STATE = 0
#: A number is a shard and a place in it of so many bits.
_PLACE = 40
#: What stands for a text's start, and its end: no word holds white space.
_START, _END = 0, 1


def _rows(kind: int, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    arrays = [pa.array([kind] * len(rows), pa.int32()), *[pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]]
    return pa.table(arrays, ["kind", "block", "shard", "payload", "stats"])


def _strings(letters: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))])


def _letters(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of strings, one after another, and their sizes."""
    if not len(strings):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    letters = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return letters[at[0] : at[-1]], np.diff(at)


def _hashes(strings: pa.Array) -> np.ndarray:
    letters, sizes = _letters(strings)
    ends = np.cumsum(sizes)
    return hashes_of(letters, ends - sizes, ends)


def _split(numbers: np.ndarray, steps: bool) -> tuple[np.ndarray, np.ndarray]:
    """Shards, and places within them or the steps between these."""
    place = (numbers & ((1 << _PLACE) - 1)).astype(np.uint64)
    return (numbers >> _PLACE).astype(np.uint32), np.diff(place, prepend=np.uint64(0)) if steps else place


def _joined(shard: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (shard.astype(np.int64) << _PLACE) + place.astype(np.int64)


def _numbers(shard: int, places: dict[int, bytes]) -> np.ndarray | int:
    """The numbers that a shard gave; only the shard, where no more questions follow."""
    return (shard << _PLACE) + (unpack(places[shard], "uint64", delta=True).astype(np.int64) if shard in places else 0)


def _counts_of_counts(totals: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(totals, TRUST + 2), minlength=TRUST + 3)[1 : TRUST + 2].tolist()


# Blocks.


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """block, ids, held, sizes, texts: rows dealt to blocks, many in a deflated row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            block = np.asarray(batch.column("block"))
            order = np.argsort(block, kind="stable")
            texts = [(t or "").encode() for t in batch.column("text").take(pa.array(order)).to_pylist()]
            ids, held = batch.column("id").take(pa.array(order)), np.asarray(batch.column("held").to_numpy(zero_copy_only=False), bool)[order]
            at = np.r_[0, np.flatnonzero(np.diff(block[order])) + 1, len(order)] if len(order) else np.zeros(1, np.int64)
            out = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                mine = ids.slice(a, b - a)
                head = pack_all(np.asarray(mine.fill_null(0)), np.asarray(mine.is_null().to_numpy(zero_copy_only=False), np.uint8), held[a:b].astype(np.uint8), np.array([len(t) for t in texts[a:b]], np.int64))
                out.append((int(block[order[a]]), head, z.compress(b"".join(texts[a:b]))))
            blocks, heads, bodies = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], ["block", "head", "body"])

    named = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    return named.mapInArrow(run, "block long, head binary, body binary").repartition(min(n, MOST_PARTITIONS), "block")


class _Level:
    """The n-grams of one order in a block: each token's n-gram, and what is known of each n-gram.

    of: the n-gram at each token, -1 for none. After the answers, total: training count; number: its number
    among all; alone: whether no other block has it. For orders above 1 also, of each context, low: whether it
    has a follower of a low count; sums: its followers' tallies.
    """

    def __init__(self, of: np.ndarray, counts: np.ndarray) -> None:
        self.of, self.counts, self.n = of, counts, len(counts)
        self.total = self.number = self.alone = self.low = self.sums = None


class _Block:
    """The tokens of a block, and its n-grams order by order."""

    def __init__(self, part: pa.Table, shards: int) -> None:
        z = zstandard.ZstdDecompressor()
        heads = [unpack_all(h, "int64", "uint8", "uint8", "int64") for h in part.column("head").to_pylist()]
        self.ids, self.null, self.held, bytes_ = (np.concatenate(x) for x in zip(*heads, strict=True))
        data = np.frombuffer(b"".join([z.decompress(b) for b in part.column("body").to_pylist()]), np.uint8)
        self.shards, self.at = shards, part.column("block")[0].as_py()
        bounds = np.zeros(len(bytes_) + 1, np.int64)
        np.cumsum(bytes_, out=bounds[1:])
        data = lowered(data)
        starts, ends, to = word_spans(data, bounds)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        found = _strings(data[np.cumsum(inside[:-1]) > 0], ends - starts).dictionary_encode()
        words = pa.concat_arrays([pa.array([b" ", b"\n"], pa.large_binary()), found.dictionary])
        # words stand in the order of their hashes, so by shard, and in the order in which shards number them
        hashes = _hashes(words)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.hashes, self.start = words.take(pa.array(order)), hashes[order], int(place[_START])
        self.cuts = cuts(self.hashes, shards)
        n = np.diff(to)
        self.sizes, self.held = n + 1, self.held > 0
        self.ends = np.cumsum(self.sizes)
        token = np.full(len(starts) + len(n), place[_END])
        token[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = place[2:][np.asarray(found.indices)]
        self.train = np.repeat(~self.held, self.sizes)
        self.first = np.zeros(len(token), bool)
        self.first[self.ends - self.sizes] = True
        counts = np.bincount(token[self.train], minlength=len(self.words))
        counts[self.start] = int((~self.held).sum())
        self.token, self.levels = token, [_Level(token, counts)]

    # Words.

    def ask_words(self) -> pa.Table:
        counts, rows = self.levels[0].counts.astype(np.uint32), []
        for s, a, b in self.cuts:
            letters, sizes = _letters(self.words.slice(a, b - a))
            rows.append((self.at, s, pack_all(letters, sizes.astype(np.uint32), counts[a:b]), None))
        return _rows(1, rows)

    def learn_words(self, answers: dict[int, bytes], places: dict[int, bytes]) -> None:
        level = self.levels[0]
        level.total, level.number, level.alone = np.zeros(level.n, np.int64), np.zeros(level.n, np.int64), np.zeros(level.n, bool)
        for s, a, b in self.cuts:
            total, alone = unpack_all(answers[s], "uint64", "uint8")
            level.total[a:b], level.alone[a:b] = total, alone > 0
            level.number[a:b] = _numbers(s, places)

    # N-grams above words.

    def grow(self, tally: bool = False) -> dict:
        """The n-grams of the next order, and how they are dealt over the shards; tally: of contexts too."""
        below, words = self.levels[-1], self.levels[0]
        k = len(self.levels) + 1
        context = np.r_[-1, below.of[:-1]]
        context[self.first] = self.start if k == 2 else -1
        there = np.flatnonzero(context >= 0)
        # nothing follows a context that training does not have
        there = there[below.total[context[there]] > 0]
        pair, at, back = np.unique(context[there] * words.n + self.token[there], return_index=True, return_inverse=True)
        of = np.full(len(self.token), -1)
        of[there] = back
        new = _Level(of, np.bincount(back[self.train[there]], minlength=len(pair)))
        # suffix: the n-gram without its first word
        new.head, new.word, new.suffix = pair // words.n, pair % words.n, below.of[there[at]]
        new.lower = below.total[new.suffix]
        new.total, new.number, new.alone = np.zeros(new.n, np.int64), np.zeros(new.n, np.int64), np.zeros(new.n, bool)
        self.levels.append(new)
        # contexts that only this block has need no shard
        mine = below.alone[new.head]
        own = np.flatnonzero(mine)
        new.total[own], new.alone[own] = new.counts[own], True
        if tally:
            new.low, new.sums = np.zeros(below.n, bool), np.zeros((below.n, _FOLLOWERS), np.int64)
            contexts, low, sums = _tallied(new.head[own], new.counts[own], new.lower[own])
            new.low[contexts], new.sums[contexts] = low, sums
        ask = np.flatnonzero(~mine)
        heads = new.head[ask]
        # a context's followers go to the shard that numbered it; a frequent context's also to the next ones
        home, parts = below.number >> _PLACE, np.clip(-(-below.total // CONTEXT_TOKENS), 1, self.shards)
        shard, hot = home[heads], parts > 1
        wide = np.flatnonzero(hot[heads])
        spread = mix64(self.hashes[new.word[ask[wide]]]) % parts[heads[wide]].astype(np.uint64)
        shard[wide] = (shard[wide] + spread.astype(np.int64)) % self.shards
        order = np.argsort(shard.astype(np.uint16) if self.shards < 1 << 16 else shard, kind="stable")
        rows, shard, heads = ask[order], shard[order], heads[order]
        first = np.ones(len(rows), bool)
        first[1:] = (heads[1:] != heads[:-1]) | (shard[1:] != shard[:-1])
        at = np.flatnonzero(first)
        at_shard, c, sizes = shard[at], heads[at], np.diff(np.r_[at, len(rows)])
        if len(wide):
            # frequent contexts are asked about in all their shards
            full = np.unique(heads[hot[heads]])
            each = np.repeat(full, parts[full])
            sub = np.arange(len(each)) - np.repeat(np.cumsum(parts[full]) - parts[full], parts[full])
            more = ((home[each] + sub) % self.shards) * below.n + each
            more = more[~np.isin(more, at_shard * below.n + c)]
            at_shard, c, sizes = np.r_[at_shard, more // below.n], np.r_[c, more % below.n], np.r_[sizes, np.zeros(len(more), np.int64)]
            by = np.argsort(at_shard, kind="stable")
            at_shard, c, sizes = at_shard[by], c[by], sizes[by]
        # contexts whose followers this block must know
        wanted = hot.copy()
        wanted[context[there[~self.train[there]]]] = True
        return {"rows": rows, "shard": at_shard, "context": c, "sizes": sizes, "wanted": wanted[c], "stats": _counts_of_counts(new.counts[own][new.counts[own] > 0])}

    def _by_shard(self, g: dict) -> Iterator[tuple[int, slice, slice]]:
        edges = np.searchsorted(g["shard"], np.arange(self.shards + 1))
        to = np.r_[0, np.cumsum(g["sizes"])]
        for s, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if x < y:
                yield s, slice(x, y), slice(int(to[x]), int(to[y]))

    def ask(self) -> pa.Table:
        below, words, g = self.levels[-1], self.levels[0], self.grow()
        new, k, rows = self.levels[-1], len(self.levels), []
        for s, cs, ws in self._by_shard(g):
            which = g["rows"][ws]
            heads, last = below.number[g["context"][cs]], words.number[new.word[which]]
            payload = pack_all(
                *_split(heads, steps=True), g["sizes"][cs].astype(np.uint32), g["wanted"][cs].astype(np.uint8), *_split(last, steps=False),
                new.counts[which].astype(np.uint32), new.lower[which].astype(np.uint64),
            )
            rows.append((self.at, s, payload, None))
        return _rows(k, [*rows, (-1 - self.at, 0, b"", g["stats"])])

    def learn(self, answers: dict[int, bytes], places: dict[int, bytes], tally: bool) -> None:
        g = self.grow(tally)
        new = self.levels[-1]
        for s, cs, ws in self._by_shard(g):
            total, alone, low, sums = unpack_all(answers[s], "uint64", "uint8", "uint8", "uint64")
            which, c = g["rows"][ws], g["context"][cs]
            new.total[which], new.alone[which] = total, alone > 0
            new.number[which] = _numbers(s, places)
            if not tally:
                continue
            new.low[c] |= low > 0
            new.sums[c[g["wanted"][cs]]] += sums.reshape(_FOLLOWERS, -1).T.astype(np.int64)


def _tallied(head: np.ndarray, total: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, whether each has a low count, and its tallies, of seen n-grams.

    Tallies: how many followers have counts 1 to TRUST, the sum of higher counts; the same of the counts below.
    """
    seen = total > 0
    contexts, back = np.unique(head[seen], return_inverse=True)
    sums = np.zeros((len(contexts), _FOLLOWERS), np.int64)
    for offset, x in ((0, total[seen]), (TRUST + 1, lower[seen])):
        for r in range(1, TRUST + 1):
            sums[:, offset + r - 1] = np.bincount(back[x == r], minlength=len(contexts))
        sums[:, offset + TRUST] = np.bincount(back, weights=np.where(x > TRUST, x, 0), minlength=len(contexts))
    return contexts, sums[:, :TRUST].any(axis=1), sums


def _known(part: pa.Table, answers: pa.Table, shards: int, upto: int, tally: bool = False) -> _Block:
    """The block with the answers on all orders up to `upto`."""
    block = _Block(part, shards)
    by: dict[int, dict[int, bytes]] = {k: {} for k in range(-upto, upto + 1)}
    for k, s, blob in zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "payload")), strict=True):
        by[k][s] = blob
    block.learn_words(by[1], by[-1])
    for k in range(2, upto + 1):
        block.learn(by[k], by[-k], tally)
    return block


def _ask_words(shards: int):
    return lambda part: _Block(part, shards).ask_words()


def _ask(shards: int, order: int):
    def ask(part: pa.Table, answers: pa.Table) -> pa.Table:
        return _known(part, answers, shards, order - 1).ask() if part.num_rows else _rows(order, [])

    return ask


# Shards.


def _tell_words(part: pa.Table) -> pa.Table:
    words, counts = [], []
    for q in part.column("payload").to_pylist():
        letters, sizes, n = unpack_all(q, "uint8", "uint32", "uint32")
        words.append(_strings(letters, sizes))
        counts.append(n.astype(np.int64))
    found = pa.concat_arrays(words).dictionary_encode()
    back = np.asarray(found.indices).astype(np.int64)
    order = np.argsort(_hashes(found.dictionary), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    totals = np.bincount(back, weights=np.concatenate(counts), minlength=len(order)).astype(np.int64)
    alone = np.bincount(back, minlength=len(order)) == 1
    rows, places, done, shard = [], [], 0, part.column("shard")[0].as_py()
    for at, c in zip(part.column("block").to_pylist(), counts, strict=True):
        mine = back[done : done + len(c)]
        done += len(c)
        rows.append((at, shard, pack_all(totals[mine].astype(np.uint64), alone[mine].astype(np.uint8)), None))
        places.append((at, shard, pack(place[mine].astype(np.uint64), delta=True), None))
    start = found.dictionary.index(pa.scalar(b" ", pa.large_binary())).as_py()
    real = totals > 0
    if start >= 0:
        real[start] = False
    real = totals[real]
    rows.append((-1 - shard, shard, b"", [int(real.sum()), len(real), *_counts_of_counts(real)]))
    return pa.concat_tables([_rows(1, rows), _rows(-1, places)])


def _tell(order: int, top: int):
    def tell(part: pa.Table) -> pa.Table:
        shard, blocks = part.column("shard")[0].as_py(), part.column("block").to_pylist()
        # a block's own counts of counts pass through
        passed = [(b, s, b"", x) for b, s, x in zip(blocks, part.column("shard").to_pylist(), part.column("stats").to_pylist(), strict=True) if b < 0]
        mine = [(b, unpack_all(q, "uint32", "uint64", "uint32", "uint8", "uint32", "uint64", "uint32", "uint64")) for b, q in zip(blocks, part.column("payload").to_pylist(), strict=True) if b >= 0]
        if not mine:
            return _rows(order, passed)
        got = [(_joined(q[0], np.cumsum(q[1], dtype=np.uint64)), q[2], q[3] > 0, _joined(q[4], q[5]), q[6], q[7]) for _, q in mine]
        heads = np.concatenate([np.repeat(g[0], g[1]) for g in got])
        words, counts, lower = (np.concatenate([g[i] for g in got]) for i in (3, 4, 5))
        by = np.lexsort((words, heads))
        h, w = heads[by], words[by]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        starts = np.flatnonzero(first)
        runs = np.diff(np.r_[starts, len(h)])
        totals = np.add.reduceat(counts[by].astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
        contexts, low, sums = _tallied(h[starts], totals, lower[by][starts].astype(np.int64))
        tally = _counts_of_counts(totals[totals > 0])
        told, place, alone = np.empty(len(h), np.uint64), np.empty(len(h), np.uint64), np.empty(len(h), np.uint8)
        told[by] = np.repeat(totals, runs).astype(np.uint64)
        place[by] = np.repeat(np.arange(len(starts)), runs).astype(np.uint64)
        alone[by] = np.repeat(runs == 1, runs)
        rows, places, done = [], [], 0
        for (at, _), g in zip(mine, got, strict=True):
            spot = np.searchsorted(contexts, g[0])
            there = spot < len(contexts)
            there[there] = contexts[spot[there]] == g[0][there]
            flag = np.zeros(len(g[0]), np.uint8)
            flag[there] = low[spot[there]]
            asked = np.flatnonzero(g[2])
            table = np.zeros((len(asked), _FOLLOWERS), np.uint64)
            table[there[asked]] = sums[spot[asked][there[asked]]]
            to = done + len(g[3])
            rows.append((at, shard, pack_all(told[done:to], alone[done:to], flag, table.T.ravel()), None))
            if order < top:
                places.append((at, shard, pack(place[done:to], delta=True), None))
            done = to
        return pa.concat_tables([_rows(order, [*rows, (-1 - shard, shard, b"", tally), *passed]), _rows(-order, places)])

    return tell


# Scores.


def _state_kinds(top: int) -> list[str]:
    each = ["int64", "uint32", "int64", "int64", "uint8", "int64", "uint8", "uint64"]
    return ["int64", "uint8", "uint8", "int64", "int64", "float64", "float64", "int64", *each * (top - 1), "int64"]


def _state(shards: int, top: int):
    """What scores need, without discounts: one row for each block; counts of counts pass through."""

    def gather(part: pa.Table, answers: pa.Table) -> pa.Table:
        if not part.num_rows:
            return answers.select(["kind", "block", "shard", "payload", "stats"])
        b = _known(part, answers, shards, top, tally=True)
        begin = b.ends - b.sizes
        per = lambda x: np.add.reduceat(x, begin)
        words = b.levels[0]
        cw = words.total[b.token]
        ratio, discounted, missing = np.zeros(len(b.token)), [], []
        left = np.arange(len(b.token))
        for k in range(top, 1, -1):
            level, below = b.levels[k - 1], b.levels[k - 2]
            of = level.of[left]
            count = np.zeros(len(of), np.int64)
            count[of >= 0] = level.total[of[of >= 0]]
            # a context without low counts leaves no mass: it counts one more
            base = np.maximum(below.total + ~level.low, 1)
            hit = count > 0
            at = left[hit]
            ratio[at] = np.log10(count[hit]) - np.log10(base[level.head[of[hit]]])
            for r in range(1, TRUST + 1):
                full = np.zeros(len(b.token), np.int64)
                full[at[count[hit] == r]] = 1
                discounted.append(per(full))
            # tokens that back off from a context that training has
            off = left[~hit & (of >= 0)]
            heads, local = np.unique(level.head[level.of[off]], return_inverse=True)
            owner = np.searchsorted(b.ends, off, side="right")
            times = np.diff(np.r_[np.searchsorted(owner, np.arange(len(b.sizes))), len(owner)])
            # the base of the context one word shorter, by which the followers' mass below is measured
            if k > 2:
                shorter = below.suffix[heads]
                lower_total, lower_low = b.levels[k - 3].total[shorter], below.low[shorter]
            else:
                lower_total, lower_low = np.zeros(len(heads), np.int64), np.zeros(len(heads), bool)
            missing += [times, local.astype(np.uint32), below.total[heads], np.array([len(heads)]), level.low[heads].astype(np.uint8), lower_total, lower_low.astype(np.uint8), level.sums[heads].T.ravel().astype(np.uint64)]
            left = left[~hit]
        owner = np.searchsorted(b.ends, left, side="right")
        rest = np.diff(np.r_[np.searchsorted(owner, np.arange(len(b.sizes))), len(owner)])
        payload = pack_all(b.ids, b.null, b.held.astype(np.uint8), b.sizes, per((cw > 0).astype(np.int64)), per(np.log10(cw + 1.0)), per(ratio), np.concatenate(discounted), *missing, np.r_[rest, cw[left]])
        return _rows(_STATE, [(b.at, 0, payload, None)])

    return gather


def discounts(n: list[int]) -> list[float]:
    """Good-Turing discount ratios of counts 1 to TRUST from the numbers of types with counts 1 to TRUST + 1.

    The largest k up to TRUST is used for which all ratios lie between 0 and 1; counts from there to TRUST, if
    any, get an absolute discount, so that every low count leaves some mass.
    """
    off = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    off = min(max(off, 0.1), 0.9)
    for k in range(TRUST, 0, -1):
        if not all(n[: k + 1]):
            continue
        a = (k + 1) * n[k] / n[0]
        d = [((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a) if a < 1 else -1.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return d + [(r - off) / r for r in range(k + 1, TRUST + 1)]
    return [(r - off) / r for r in range(1, TRUST + 1)]


def unseen_types(n: list[int]) -> float:
    """How many words training has not seen, from the numbers of those seen once and twice; 1 at least."""
    return max(1.0, n[0] * (n[0] - 1) / (2 * (n[1] + 1)))


class Model:
    """Discounts of each order and unigram shares, from counts of counts."""

    def __init__(self, tokens: int, types: int, tallies: list[list[int]]) -> None:
        self.tokens, self.types = tokens, types
        self.d = [np.array(discounts(n)) for n in tallies]
        r = np.arange(1, TRUST + 1)
        low = r * np.array(tallies[0][:TRUST])
        left = float((low * (1 - self.d[0])).sum())
        # if every word is frequent, one token more stands for unknown words
        self.base = tokens if left > 0 else tokens + 1
        self.unknown = (left if left > 0 else 1.0) / self.base / unseen_types(tallies[0])

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """The share of a word by its training count; unknown words share what is left among those not seen."""
        d = np.r_[0.0, self.d[0], 1.0][np.minimum(counts, TRUST + 1)]
        return np.where(counts > 0, d * counts / self.base, self.unknown)

    def backoff(self, order: int, context: np.ndarray, low: np.ndarray, base: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The weights of contexts: mass left by seen followers over what they leave at the order below; base: by which that is measured."""
        r = np.arange(1, TRUST + 1)
        table = table.astype(np.float64)
        seen = table[:, :TRUST] @ (r * self.d[order - 1]) + table[:, TRUST]
        under = table[:, TRUST + 1 : -1] @ (r * self.d[order - 2]) + table[:, -1]
        total = np.maximum(context + ~low, 1)
        return (total - seen) / total / np.maximum(1 - under / base, 1e-300)


def katz_scores(docs: DataFrame, train_folds: int = 7, held_fold: int = 2, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from rows whose crc32(key as text) modulo train_folds is not held_fold. Tokens: words (runs of bytes
    other than space and bytes 9 to 13, A-Z in lower case), then one end. A null or empty text is one end token;
    a null key counts as an empty text in the fold; repeated rows count each; an empty table gives none. If no
    row is for training, train_tokens is 0 and scores are those of a model of unknown words only. The key must
    be an integer; other columns of `docs` are not carried. `order` is 2 or more. Rows equal in key and text go to one block.
    Texts are scored whole, however long: a block holds some 10 MB of text, a longer text alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("held", fold("id", train_folds) == held_fold)
    n = n_blocks(rows, "text")
    by_block = _dealt(rows, n).groupBy("block")
    told = by_block.applyInArrow(_ask_words(n), _MESSAGE).groupBy("shard").applyInArrow(_tell_words, _MESSAGE)
    for k in range(2, order + 1):
        asked = by_block.cogroup(told.where("block >= 0").groupBy("block")).applyInArrow(_ask(n, k), _MESSAGE)
        told = told.union(asked.groupBy("shard").applyInArrow(_tell(k, order), _MESSAGE))
    # numbers are for questions only
    state = by_block.cogroup(told.where("kind > 0").groupBy("block")).applyInArrow(_state(n, order), _MESSAGE)
    path = f"{shared_dir(spark)}/tagmill/katz-{np.random.default_rng().integers(1 << 62):x}"
    state.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    table = spark.read.schema(state.schema).parquet(path)

    sums = [[0] * (TRUST + 3)] + [[0] * (TRUST + 1) for _ in range(order - 1)]
    # a few numbers for each order, whatever the input's size
    for r in table.where(f"kind <> {_STATE}").select("kind", F.posexplode("stats")).groupBy("kind", "pos").agg(F.sum("col").alias("n")).collect():
        sums[r["kind"] - 1][r["pos"]] = r["n"]
    model = Model(sums[0][0], sums[0][1], [sums[0][2:], *sums[1:]])

    def scored(blob: bytes) -> list[pa.Array]:
        ids, null, held, sizes, known, base, score, low_counts, *rest = unpack_all(blob, *_state_kinds(order))
        docs_ = np.arange(len(sizes))
        score = score.copy()
        low_counts = low_counts.reshape(order - 1, TRUST, -1)
        for i, k in enumerate(range(order, 1, -1)):
            score += np.log10(model.d[k - 1]) @ low_counts[i]
            times, local, total, _, low, lower_total, lower_low, sums_ = rest[8 * i : 8 * i + 8]
            if len(local):
                under = np.maximum(lower_total + ~(lower_low > 0), 1) if k > 2 else np.full(len(total), model.base)
                weight = np.log10(model.backoff(k, total, low > 0, under, sums_.reshape(_FOLLOWERS, -1).T))
                score += np.bincount(np.repeat(docs_, times), weights=weight[local], minlength=len(sizes))
        last = rest[-1]
        times, counts = last[: len(sizes)], last[len(sizes) :]
        score += np.bincount(np.repeat(docs_, times), weights=np.log10(model.unigram(counts)), minlength=len(sizes))
        base = base - sizes * np.log10(model.tokens + model.types + 1)
        return [pa.array(ids, mask=null > 0), pa.array(held > 0), pa.array(sizes), pa.array(known), pa.array(np.full(len(ids), model.tokens)), pa.array(base), pa.array(score)]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        for batch in batches:
            for blob in batch.column("payload").to_pylist():
                yield pa.RecordBatch.from_arrays(scored(blob), names)

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return table.where(f"kind = {_STATE}").select("payload").mapInArrow(finish, schema).withColumnRenamed("id", key)
