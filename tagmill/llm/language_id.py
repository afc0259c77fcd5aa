"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and 1. A trigram's vector binds its letters' vectors by product, each
permuted (rotated) by its place; a text's vector bundles (sums) its trigrams'; a language's prototype bundles
its training texts. A text gets the language whose prototype has the largest cosine with the text's vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, fresh, plus, text_column, text_slices
from tagmill.llm.wordhash import mix64

DIMENSIONS = 1024
#: Texts that are bundled together, and distinct trigrams of a language that a training task holds, at most.
MOST_TEXTS = 1024
MOST_GRAMS = 500_000
_CODES = 0x110000
_letter: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its letter, in lower case; 0 for all that is no letter."""
    if "table" not in _letter:
        table = np.zeros(_CODES, np.uint32)
        for c in range(_CODES):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letter["table"] = table
    return _letter["table"]


def letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """A random vector of -1 and 1 for each letter, the same on every machine."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    bits = mix64(mix64(letters.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))[:, None] + words)
    return np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """The bound vector of each trigram; a trigram is three code points of 21 bits."""
    out = np.ones((len(grams), dimensions), np.int8)
    for place, shift in enumerate((42, 21, 0)):
        letters, back = np.unique(grams >> np.uint64(shift) & np.uint64(0x1FFFFF), return_inverse=True)
        out *= np.roll(letter_vectors(letters, dimensions), place, axis=1)[back]
    return out.astype(np.float32)


def grams_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of letters (a break before, between and after words), the text each belongs to, and who has letters."""
    n = len(bounds) - 1
    # a break between texts keeps trigrams apart
    joined = b"\n".join([data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])])
    code = letter_table()[np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    # code points before each text: count bytes that start a character
    starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][bounds] + np.arange(n + 1)
    owner = np.repeat(np.arange(n), np.diff(starts))[: len(code)]
    letter = code > 0
    has = np.zeros(n, bool)
    has[owner[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one break after each word
    code, owner = code[keep].astype(np.uint64), owner[keep]
    if not len(code):
        return np.empty(0, np.uint64), np.empty(0, np.int64), has
    code, owner = np.r_[np.uint64(0), code, np.uint64(0)], np.r_[owner[0], owner, owner[-1]]
    grams = code[:-2] << np.uint64(42) | code[1:-1] << np.uint64(21) | code[2:]
    middle = code[1:-1] > 0
    return grams[middle], owner[1:-1][middle], has


def slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of texts of bounded size: the texts from a to b, their trigrams, each one's text after a, and who has letters.

    A longer text comes in several pieces that together have its trigrams.
    """
    for a, b in text_slices(bounds, SLICE_BYTES):
        for x in range(a, b, MOST_TEXTS):
            y = min(x + MOST_TEXTS, b)
            part, inner = data[bounds[x] : bounds[y]], bounds[x : y + 1] - bounds[x]
            if len(part) <= 2 * SLICE_BYTES:
                yield x, y, *grams_of(part, inner)
                continue
            # one long text: cut between code points, with a neighbour on either side for the trigrams at the cut
            begins = np.flatnonzero((part & 0xC0) != 0x80)
            edges = [*range(0, len(begins), SLICE_BYTES // 2), len(begins)]
            place = np.r_[begins, len(part)]
            for u, v in zip(edges[:-1], edges[1:]):
                left, right = max(u - 1, 0), min(v + 1, len(begins))
                piece = part[place[left] : place[right]]
                code = letter_table()[np.frombuffer(piece.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
                grams, owner, has = grams_of(piece, np.array([0, len(piece)]))
                skip, stop = int(left < u and code[0] > 0), len(grams) - int(right > v and code[-1] > 0)
                yield x, y, grams[skip:stop], owner[skip:stop], has


def bundle(grams: np.ndarray, owner: np.ndarray, texts: int, dimensions: int) -> np.ndarray:
    """The sum of the trigrams' vectors of each text; whole numbers, so the order of summing does not matter."""
    distinct, back = np.unique(grams, return_inverse=True)
    out = np.zeros((texts, dimensions))
    order = np.argsort(back, kind="stable")
    back, owner = back[order], owner[order]
    for x in range(0, len(distinct), 4096):
        u, v = np.searchsorted(back, [x, x + 4096])
        width = min(4096, len(distinct) - x)
        counts = np.bincount(owner[u:v] * width + back[u:v] - x, minlength=texts * width).reshape(texts, width)
        out += counts.astype(np.float32) @ gram_vectors(distinct[x : x + 4096], dimensions)
    return out


def _train(rows: DataFrame, text: str, lang: str, dimensions: int) -> dict[str, np.ndarray]:
    """Prototypes: trigram counts in tasks, bundled to one vector for each task and language, then summed."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(back, weights=np.concatenate([n for _, n in parts]), minlength=len(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sums: dict[str, np.ndarray] = {}

        def add(k: str) -> None:
            grams, n = merged(counts.pop(k))
            v = sums.setdefault(k, np.zeros(dimensions))
            for x in range(0, len(grams), 4096):
                v += n[x : x + 4096] @ gram_vectors(grams[x : x + 4096], dimensions)

        for batch in batches:
            data, bounds = text_column(batch, text)
            langs = np.array(batch.column(lang).to_pylist(), object)
            for a, b, grams, owner, _ in slices(data, bounds):
                names, which = np.unique(langs[a:b].astype(str), return_inverse=True)
                for i, k in enumerate(names.tolist()):
                    parts = counts.setdefault(k, [])
                    parts.append(np.unique(grams[which[owner] == i], return_counts=True))
                    if len(parts) > 16:
                        counts[k] = [merged(parts)]
                        if len(counts[k][0][0]) > MOST_GRAMS:
                            add(k)
        for k in list(counts):
            add(k)
        at = np.arange(dimensions, dtype=np.int32)
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * dimensions), pa.array(at), pa.array(v.astype(np.int64))], ["lang", "at", "v"])

    parts = rows.select(text, lang).mapInArrow(run, "lang string, at int, v long")
    # languages x dimensions rows, whatever the input's size
    summed = parts.groupBy("lang", "at").agg(F.sum("v").alias("v")).groupBy("lang")
    found = summed.agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("vs")).collect()
    out = {}
    for row in sorted(found, key=lambda r: r["lang"]):
        v = np.array([x["v"] for x in row["vs"]], np.float64)
        if norm := float(np.linalg.norm(v)):
            out[row["lang"]] = v / norm
    return out


def identify(
    docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, claims: bool = False
) -> DataFrame:
    """`docs` with lang_pred and score, and with `claims` also claim_score.

    Prototypes are learned from rows where `train` holds and `lang` is not null; predictions use the text
    alone. lang_pred is a learned language, or "und" with score 0 if the text is null, empty or has no
    letter, or if nothing could be learned. score is the winning cosine, at least 0. Ties go to the language
    that sorts first. claim_score is the cosine with the language that `lang` names, null if that is null or was
    not learned; it takes no part in the prediction. Repeated rows get equal results; an empty table gives none. New columns whose names
    are taken get a leading underscore. The driver gathers languages x dimensions numbers.
    """
    learned = _train(docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()), text, lang, dimensions)
    names = list(learned)
    protos = np.array([learned[k] for k in names]).reshape(-1, dimensions)
    wanted = ["lang_pred", "score", "claim_score"] if claims else ["lang_pred", "score"]
    new = [fresh(c, docs.columns) for c in wanted]
    schema = plus(docs.schema, **dict(zip(new, ("string", "double", "double"))))
    place = {k: i for i, k in enumerate(names)}

    def told(batch: pa.RecordBatch, at: tuple[int, int], vectors: np.ndarray, has: np.ndarray) -> pa.RecordBatch:
        part, n = batch.slice(at[0], at[1] - at[0]), at[1] - at[0]
        best, score, cosine = np.zeros(n, np.int64), np.zeros(n), np.zeros((n, len(names)))
        if names:
            cosine = vectors @ protos.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(n), best], 0, 1)
        known = has & bool(names)
        pred = pa.array([names[i] if k else "und" for i, k in zip(best.tolist(), known.tolist(), strict=True)], pa.string())
        cols = [pred, pa.array(np.where(known, score, 0.0))]
        if claims:
            own = [place.get(x) for x in part.column(lang).to_pylist()]
            cols.append(pa.array([None if k is None else float(cosine[i, k]) for i, k in enumerate(own)], pa.float64()))
        return pa.RecordBatch.from_arrays([*part.columns, *cols], [*part.schema.names, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            # of a text in several pieces all but the last only add up
            held = None
            for a, b, grams, owner, has in slices(data, bounds):
                vectors = bundle(grams, owner, b - a, dimensions)
                if held is not None and held[0] == (a, b):
                    vectors, has = held[1] + vectors, held[2] | has
                elif held is not None:
                    yield told(batch, *held)
                held = (a, b), vectors, has
            if held is not None:
                yield told(batch, *held)

    return docs.mapInArrow(run, schema)


def fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; every fifth of the ids by checksum is held out."""
    rows = docs.select("doc_id", "text", "lang")
    out = identify(rows, train=fold("doc_id", 5) != 0)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
