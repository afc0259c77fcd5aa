"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes tokens for every new word of a batch. A proposal is right exactly if each of
its tokens is what BPE makes of that token's own string and if no two neighbours would have merged across
their boundary. Neighbours are tested all at once against tables of the tokens' outer symbols; only words
with a failing pair, or with a token that fails by itself, go through exact merging.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, fresh, plus, text_column, text_slices
from tagmill.llm.token_counts import HashTable, Merges, byte_letters, read_vocabulary

#: Fixed pattern of this kind of tokenizer; white space as Unicode has it.
_SPACE = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_REMEMBER = 250_000
_NEVER = np.int64(1) << 40


class Codec:
    """Encoder and decoder of one vocabulary file with word-end marks."""

    def __init__(self, path: str) -> None:
        vocab, left, right, made, added = read_vocabulary(path)
        with open(path, encoding="utf-8") as f:
            end = json.load(f)["model"]["end_of_word_suffix"] or ""
        self.strings = [""] * (1 + max(*vocab.values(), *[t["id"] for t in added]))
        for s, i in [*vocab.items(), *[(t["content"], t["id"]) for t in added]]:
            self.strings[i] = s
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.merges = Merges(left, right, made)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.exact_words = self.speculated_words = 0
        # Symbols are bytes, and 256 more for a byte that ends its word.
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters] + [vocab[c + end] for c in letters], np.int64)
        self._neighbours(left, right, made)
        self._trie(vocab, {c: b for b, c in enumerate(letters)}, end)

    def _trie(self, vocab: dict[str, int], byte: dict[str, int], end: str) -> None:
        steps: dict[int, int] = {}
        token = [-1]
        for s, t in vocab.items():
            closed = bool(end) and s.endswith(end)
            codes = [byte.get(c, -1) for c in (s[: -len(end)] if closed else s)]
            if not codes or -1 in codes:
                continue
            codes[-1] += 256 * closed
            node = 0
            for c in codes:
                key = node << 9 | c
                if (to := steps.get(key)) is None:
                    to = steps[key] = len(token)
                    token.append(-1)
                node = to
            token[node] = t
        self.steps = HashTable(np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64), -1)
        self.token_at = np.array(token, np.int64)

    def _neighbours(self, left_of: np.ndarray, right_of: np.ndarray, made: np.ndarray) -> None:
        """Outer symbols of each token, from itself inwards, and the rank of the merge that consumes each."""
        n = len(self.strings)
        left, right, born = (np.full(n, -1, np.int64) for _ in range(3))
        _, rank = np.unique(made, return_index=True)
        left[made[rank]], right[made[rank]], born[made[rank]] = left_of[rank], right_of[rank], rank
        self.heads, self.head_ends = self._spine(left, born)
        self.tails, self.tail_ends = self._spine(right, born)
        self.ranked = HashTable(left_of << 32 | right_of, np.arange(len(made)), int(_NEVER))
        # A token is sound if its parts are, and nothing merges across them before they merge.
        t = np.flatnonzero(born >= 0)
        fits = np.ones(n, bool)
        fits[t] = self._apart(left[t], right[t], born[t])
        self.sound = np.ones(n, bool)
        for x in t[np.argsort(born[t])]:
            self.sound[x] = fits[x] and self.sound[left[x]] and self.sound[right[x]]

    @staticmethod
    def _spine(part: np.ndarray, born: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        at, until = np.arange(len(part)), np.full(len(part), _NEVER)
        nodes, ends = [], []
        while (at >= 0).any():
            nodes.append(at)
            ends.append(until)
            inner = np.where(at >= 0, part[at], -1)
            until = np.where(at >= 0, born[at], 0)
            at = inner
        return nodes, ends

    def _apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether a and b stay apart when BPE runs over their joined strings (before the merge `limit`)."""
        ok = np.ones(len(a), bool)
        top = _NEVER if limit is None else limit
        for tails, tail_ends in zip(self.tails, self.tail_ends, strict=True):
            x, x_end = tails[a], np.minimum(tail_ends[a], top)
            go = np.flatnonzero(ok & (x >= 0))
            if not len(go):
                break
            for heads, head_ends in zip(self.heads, self.head_ends, strict=True):
                y = heads[b[go]]
                go = go[y >= 0]
                if not len(go):
                    break
                y = y[y >= 0]
                m = self.ranked.find(x[go] << 32 | y)
                # The merge happens if both symbols are still there; in a tie the pair further left goes first.
                y_end = head_ends[b[go]]
                y_end = np.minimum(y_end, top if limit is None else limit[go] - 1)
                ok[go[(m < x_end[go]) & (m <= y_end)]] = False
        return ok

    def _greedy(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place reached by longest matches, as owners and tokens in order."""
        n = len(codes)
        best, length = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        at, node, depth = np.arange(n), np.zeros(n, np.int64), 0
        stop = np.repeat(np.cumsum(sizes), sizes)
        while len(at):
            node = self.steps.find(node << 9 | codes[at + depth])
            depth += 1
            there = node >= 0
            at, node = at[there], node[there]
            found = self.token_at[node] >= 0
            best[at[found]], length[at[found]] = self.token_at[node[found]], depth
            more = at + depth < stop[at]
            at, node = at[more], node[more]
        owner = np.arange(len(sizes))
        place, last = np.cumsum(sizes) - sizes, np.cumsum(sizes)
        got = []
        while len(owner):
            got.append((owner, best[place]))
            place = place + length[place]
            go = place < last[owner]
            owner, place = owner[go], place[go]
        owners = np.concatenate([o for o, _ in got])
        order = np.argsort(owners, kind="stable")
        return owners[order], np.concatenate([t for _, t in got])[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of all words, in order, and the number of each word's tokens; words are not empty."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        codes = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        codes[np.cumsum(sizes) - 1] += 256
        owner, flat = self._greedy(codes, sizes)
        bad = np.zeros(len(words), bool)
        bad[owner[~self.sound[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        apart = self._apart(pair >> 32, pair & 0xFFFFFFFF)
        bad[owner[inner[~apart[back]]]] = True
        self.exact_words += int(bad.sum())
        self.speculated_words += len(words)
        if bad.any():
            exact_sizes, exact = self.merges.apply(self.first[codes[np.repeat(bad, sizes)]], sizes[bad], want_ids=True)
            keep = ~bad[owner]
            owner = np.concatenate([owner[keep], np.repeat(np.flatnonzero(bad), exact_sizes)])
            order = np.argsort(owner, kind="stable")
            owner, flat = owner[order], np.concatenate([flat[keep], exact])[order]
        return flat, np.bincount(owner, minlength=len(words))

    def learn(self, words: list[str]) -> None:
        """Encode new words and remember their ids and decoded strings."""
        flat, counts = self.encode_words(words)
        raw, strings, at = flat.astype("<u4").tobytes(), list(map(self.strings.__getitem__, flat.tolist())), 0
        for w, n in zip(words, counts.tolist(), strict=True):
            self.known[w] = raw[4 * at : 4 * (at + n)], " ".join(strings[at : at + n]).encode()
            at += n

    def words(self, text: str) -> list[str]:
        """The words of a text; an added token's string stands for itself."""
        if self.cut is None or not (parts := self.cut.split(text))[1:]:
            parts = [text]
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append("\x00" + part)
                continue
            # lower case letter by letter: no special final form of sigma
            part = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
            out += _WORDS.findall(part.lower())
        return out

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8, of each text."""
        if len(self.known) > _REMEMBER:
            self.known.clear()
        split = [self.words(t) for t in texts]
        new = list({w for found in split for w in found if w not in self.known})
        marked = {"\x00" + s: i for s, i in self.special.items()}
        for w in new:
            if w in marked:
                self.known[w] = np.array([marked[w]], "<u4").tobytes(), w[1:].encode()
        if new := [w for w in new if w not in marked]:
            self.learn(new)
        known = self.known
        out = []
        for found in split:
            got = [known[w] for w in found]
            out.append((b"".join([g[0] for g in got]), b" ".join([g[1] for g in got if g[1]])))
        return out


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """`docs` with n_tokens, token_ids (little-endian unsigned 32-bit integers) and decoded text.

    tokenizer: path of a BPE vocabulary in JSON, readable on every machine. No added tokens are put in; an
    added token's string in a text is one token. Decoding joins the tokens' strings by a space, as a
    vocabulary without a decoder does. A null or empty text gives no tokens and an empty decoded text; a
    repeated row gives the same result again; an empty table gives none. New columns whose names are
    taken get a leading underscore.
    """
    names = [fresh(c, docs.columns) for c in ("n_tokens", "token_ids", "decoded")]
    schema = plus(docs.schema, **dict(zip(names, ("long", "binary", "string"), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer)
        for batch in batches:
            _, bounds = text_column(batch, text)
            for a, b in text_slices(bounds, 2 * SLICE_BYTES):
                part = batch.slice(a, b - a)
                got = codec.encode_decode([t or "" for t in part.column(text).to_pylist()])
                new = [
                    pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                    pa.array([i for i, _ in got], pa.binary()),
                    pa.array([d for _, d in got], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def codec_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every document."""
    coded = encode_decode(docs.select("doc_id", "text"), tokenizer)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
