"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over characters, so it knows words it has not seen. N-gram counts of a third of all trusted
texts are summed in Spark, sharded by n-gram; lower orders count distinct left neighbours; joins of the counts
with their contexts' sums and with the next lower order, each sharded by key, give every seen n-gram's
interpolated probability and every context's weight. The same joins give the probability of every n-gram that
the texts to be scored hold: blocks of texts send their distinct n-grams to shards, each n-gram is joined order
by order with the model's tables, and blocks sum the answers over each whole text. A text is rejected if its
perplexity lies outside the quantiles of trusted texts in its language: noise lies above, endless repetition
often below.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import SLICE_BYTES, forget, fresh, heavy_above, pack, pack_all, stored, text_column, text_slices, unpack, unpack_all
from tagmill.llm.exchange import MOST_PARTITIONS, n_blocks
from tagmill.llm.wordhash import mix64

ORDER = 5
#: The fold that the model is fitted on: hashes below this, modulo three times this. Neither it nor the thresholds have a bound.
TRAIN_TEXTS = 3000
#: Bins of an octave in which quantiles are looked for.
BINS = 256
#: Trusted texts of a language at which its own quantiles weigh as much as those of all languages.
EVEN = 50
_BITS = 12
_MASK = (1 << _BITS) - 1
#: Code points from here on share the symbols between here and _MASK, by a hash.
_OWN = 2048
_BEGIN, _END = 1, 2


def _symbols(data: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that end at each character and each text's end, and the bounds of texts among them.

    Digits are one symbol; runs of white space are one space. The alphabets up to code point 2047 (Latin, Greek,
    Cyrillic, Hebrew, Arabic) keep a symbol for each letter; all other letters are hashed to 2,047 symbols.
    """
    n = len(bounds) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][bounds]
    s = points.astype(np.int64)
    far = s >= _OWN
    s[far] = _OWN + (s[far] * 2654435761 >> 7) % (_MASK - _OWN)
    s[(s >= 48) & (s <= 57)] = 48
    s[(s <= 32) | (s == 0xA0) | (s == 0x85)] = 32
    owner = np.repeat(np.arange(n), np.diff(starts))
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 32) | (s[:-1] != 32) | (owner[1:] != owner[:-1])
    s, owner = s[keep], owner[keep]
    sizes = np.bincount(owner, minlength=n) + order
    at = np.cumsum(sizes) - sizes
    line = np.full(int(sizes.sum()), _BEGIN, np.int64)
    line[np.arange(len(s)) + owner * order + order - 1] = s
    line[at + sizes - 1] = _END
    key = np.zeros(len(line), np.int64)
    for back in range(order):
        key[back:] |= line[: len(line) - back] << (_BITS * back)
    pads = at[:, None] + np.arange(order - 1)
    real = np.ones(len(line), bool)
    real[pads.ravel()] = False
    counts = sizes - order + 1
    return key[real], np.r_[0, np.cumsum(counts)]


def _gram_counts(texts: DataFrame, text: str, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            for a, b in text_slices(bounds, 8 * SLICE_BYTES):
                keys, n = np.unique(_symbols(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["gram", "n"])

    return texts.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _low_bits(order: int) -> int:
    return (1 << (_BITS * order)) - 1


def train(texts: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """The stored model as rows (order, gram, p, weight): p of a seen n-gram (null for a context's row), weight of a context.

    p interpolates with all lower orders and the uniform distribution over seen symbols and one unseen.
    """
    works: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        works.append(stored(df, name))
        return works[-1]

    counts = {order: kept(_gram_counts(texts, text, order), "grams")}
    for n in range(order - 1, 0, -1):
        counts[n] = counts[n + 1].groupBy(F.col("gram").bitwiseAND(F.lit(_low_bits(n))).alias("gram")).agg(F.count("*").alias("n"))
        counts[n] = kept(counts[n], "grams")
    rows, lower = [], None
    for n in range(1, order + 1):
        here = counts[n]
        # numbers of n-grams with counts 1 to 4; one row, joined to all
        tally = here.agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"t{i}") for i in range(1, 5)], F.count("*").alias("types"))
        y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
        ds = [F.least(F.greatest(F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"t{i + 1}"), F.col(f"t{i}")), F.lit(0.5)), F.lit(0.05)), F.lit(0.95 * i)) for i in (1, 2, 3)]
        tally = kept(tally.select("types", *[d.alias(f"d{i}") for i, d in enumerate(ds, 1)]), "tally")
        here = here.crossJoin(F.broadcast(tally)).withColumn("context", F.shiftright("gram", _BITS))
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        here = here.withColumn("cut", cut)
        # read by the join and by the model, whose plan would repeat the counts' plans of all orders
        sums = kept(here.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")), "contexts")
        part = here.join(sums, "context").withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
        if lower is None:
            probs = part.select("gram", (F.col("own") + F.col("weight") / (F.col("types") + 1)).alias("p"))
            rows.append(tally.select(F.lit(0).alias("order"), F.lit(0).cast("long").alias("gram"), (1 / (F.col("types") + 1)).alias("p"), F.lit(None).cast("double").alias("weight")))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            part = part.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_low_bits(n - 1)))).join(below, "suffix")
            probs = part.select("gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
        lower = probs = kept(probs, "probabilities")
        rows.append(probs.select(F.lit(n).alias("order"), "gram", "p", F.lit(None).cast("double").alias("weight")))
        rows.append(sums.select(F.lit(n).alias("order"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("p"), "weight"))
    model = stored(reduce(DataFrame.union, rows), "model")
    forget(*works)
    return model


def probabilities(needed: DataFrame, model: DataFrame, order: int = ORDER, works: list[DataFrame] | None = None) -> DataFrame:
    """`needed` (gram and other columns, grams distinct) with p, the model's probability of each n-gram's last symbol after the others.

    Order by order, shortest first: an n-gram's own probability, else its context's weight times that of the
    n-gram without its first symbol. `works` gets the tables that the result reads.
    """
    lower = None
    for n in range(1, order + 1):
        here = needed if n == order else needed.select(F.col("gram").bitwiseAND(F.lit(_low_bits(n))).alias("gram")).distinct()
        here = here.withColumns({"context": F.shiftright("gram", _BITS), "suffix": F.col("gram").bitwiseAND(F.lit(_low_bits(n - 1)))})
        grams = model.where((F.col("order") == n) & F.col("p").isNotNull()).select("gram", F.col("p").alias("own"))
        contexts = model.where((F.col("order") == n) & F.col("weight").isNotNull()).select(F.col("gram").alias("context"), "weight")
        known = here.join(grams, "gram", "left").join(contexts, "context", "left")
        if lower is None:
            floor = model.where("order = 0").agg(F.coalesce(F.max("p"), F.lit(1e-6)).alias("below"))
            known = known.crossJoin(F.broadcast(floor))  # one row
        else:
            known = known.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        p = F.coalesce("own", F.coalesce("weight", F.lit(1.0)) * F.col("below")).alias("p")
        lower = known.select(*[c for c in here.columns if c not in ("context", "suffix")], p)
        if n < order:
            lower = stored(lower, "probabilities")
            if works is not None:
                works.append(lower)
    return lower


def digest_of(text: str):
    """A digest of a text, null for null: equal texts are scored alike."""
    return F.md5(F.col(text).cast("binary"))


def _dealt(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """block, head, body: texts dealt to blocks, many in a deflated row each; of equal ones in a batch one, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blocks: dict[int, dict[bytes, list]] = {}
            for block, t in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = t.encode()
                blocks.setdefault(block, {}).setdefault(hashlib.md5(raw).digest(), [raw, 0])[1] += 1
            heads = [pack_all(np.frombuffer(b"".join(x), np.uint8), np.array([[len(t), n] for t, n in x.values()], np.int64).ravel()) for x in blocks.values()]
            bodies = [z.compress(b"".join([t for t, _ in x.values()])) for x in blocks.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], ["block", "head", "body"])

    named = docs.where(F.col(text).isNotNull()).select(F.pmod(F.xxhash64(key, text), F.lit(n)).alias("block"), F.col(text).alias("text"))
    return named.mapInArrow(run, "block long, head binary, body binary").repartition(min(n, MOST_PARTITIONS), "block")


def _texts(part: pa.Table) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """The texts of a block as bytes and bounds, their digests, and how many rows have each."""
    z, digests, sizes, bodies = zstandard.ZstdDecompressor(), [], [], []
    for head, body in zip(part.column("head").to_pylist(), part.column("body").to_pylist(), strict=True):
        d, n = unpack_all(head, "uint8", "int64")
        digests += [d[i : i + 16].tobytes().hex() for i in range(0, len(d), 16)]
        sizes.append(n.reshape(-1, 2))
        bodies.append(z.decompress(body))
    n = np.concatenate(sizes)
    return np.frombuffer(b"".join(bodies), np.uint8), np.r_[0, np.cumsum(n[:, 0])].astype(np.int64), digests, n[:, 1]


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


class _Grams:
    """The distinct n-grams of a block, by shard."""

    def __init__(self, part: pa.Table, shards: int, order: int) -> None:
        self.data, self.bounds, self.digests, self.times = _texts(part)
        self.order, found = order, [np.empty(0, np.int64)]
        for a, b in self.slices():
            found.append(pd.unique(self.symbols(a, b)[0]))
            if len(found) > 8:
                found = [pd.unique(np.concatenate(found))]
        self.keys = np.sort(pd.unique(np.concatenate(found)))
        shard = _shards_of(self.keys, shards)
        self.by = np.argsort(shard, kind="stable")
        at = np.searchsorted(shard[self.by], np.arange(shards + 1))
        self.cuts = [(s, a, b) for s, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if a < b]

    def slices(self) -> list[tuple[int, int]]:
        return text_slices(self.bounds, 2 * SLICE_BYTES)

    def symbols(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        x = self.bounds
        return _symbols(self.data[x[a] : x[b]], x[a : b + 1] - x[a], self.order)


_MESSAGE = "block long, shard long, payload binary"


def _ask(shards: int, order: int):
    def ask(part: pa.Table) -> pa.Table:
        g, at = _Grams(part, shards, order), part.column("block")[0].as_py()
        payload = [pack(g.keys[g.by[a:b]].astype(np.uint64), delta=True) for _, a, b in g.cuts]
        return pa.table([pa.array([at] * len(payload), pa.int64()), pa.array([s for s, _, _ in g.cuts], pa.int64()), pa.array(payload, pa.binary())], ["block", "shard", "payload"])

    return ask


def _needed(part: pa.Table) -> pa.Table:
    """The n-grams that any block asks a shard about, each once."""
    keys = np.unique(np.concatenate([unpack(q, "uint64", delta=True) for q in part.column("payload").to_pylist()])).astype(np.int64)
    return pa.table([pa.array(np.full(len(keys), part.column("shard")[0].as_py())), pa.array(keys)], ["shard", "gram"])


def _tell(part: pa.Table, known: pa.Table) -> pa.Table:
    if not part.num_rows:
        return part.select(["block", "shard", "payload"])
    gram, p = np.asarray(known.column("gram").combine_chunks()), np.asarray(known.column("p").combine_chunks())
    order = np.argsort(gram)
    gram, p = gram[order], np.log2(p[order]).astype(np.float32)
    payload = [pack(p[np.searchsorted(gram, unpack(q, "uint64", delta=True).astype(np.int64))]) for q in part.column("payload").to_pylist()]
    return pa.table([part.column("block"), part.column("shard"), pa.array(payload, pa.binary())], ["block", "shard", "payload"])


def _summed(shards: int, order: int):
    def total(part: pa.Table, answers: pa.Table) -> pa.Table:
        g = _Grams(part, shards, order)
        log2 = np.zeros(len(g.keys))
        told = dict(zip(answers.column("shard").to_pylist(), answers.column("payload").to_pylist(), strict=True))
        for s, a, b in g.cuts:
            log2[g.by[a:b]] = unpack(told[s], "float32")
        out = []
        for a, b in g.slices():
            keys, at = g.symbols(a, b)
            back, distinct = pd.factorize(keys)
            sums, n = np.add.reduceat(log2[np.searchsorted(g.keys, distinct)][back], at[:-1]), np.diff(at)
            blank = (n < 2) | ((n == 2) & (keys[at[:-1]] & _MASK == 32))
            out.append(pa.array(2 ** (-sums / n), pa.float64(), mask=blank))
        return pa.table([pa.array(g.digests, pa.string()), pa.chunked_array(out, pa.float64()), pa.array(g.times)], ["digest", "ppl", "times"])

    return total


def perplexities(docs: DataFrame, model: DataFrame, key: str, text: str, order: int = ORDER) -> DataFrame:
    """digest, ppl, times: of each different text its perplexity for each character, ends counted, and its rows; null for a blank text.

    The key only deals equal texts of different keys to different blocks.
    """
    n = n_blocks(docs, text)
    by_block = _dealt(docs, key, text, n).groupBy("block")
    asked = stored(by_block.applyInArrow(_ask(n, order), _MESSAGE), "asked")
    needed = stored(asked.groupBy("shard").applyInArrow(_needed, "shard long, gram long"), "needed")
    works = [asked, needed]
    known = probabilities(needed, model, order, works)
    told = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_tell, _MESSAGE)
    scored = by_block.cogroup(told.groupBy("block")).applyInArrow(_summed(n, order), "digest string, ppl double, times long")
    out = stored(scored.groupBy("digest").agg(F.first("ppl").alias("ppl"), F.sum("times").alias("times")), "perplexities")
    forget(*works)
    return out


def quantiles(values: DataFrame, group: str, value: str, at: list[float], least: int = 1, always: str | None = None) -> dict[str, list[float]]:
    """The exact quantiles `at`, interpolated, of the positive `value` in each group of `least` rows or more, or `always`.

    Counts of logarithmic bins tell in which bins a quantile's neighbours lie; only their values are ranked.
    """
    binned = values.select(F.col(group).alias("g"), F.col(value).alias("v"), F.floor(F.log2(value) * BINS).alias("bin"))
    # windows over the bins of one group, whose number does not grow with the rows
    own = Window.partitionBy("g")
    bins = binned.groupBy("g", "bin").agg(F.count("*").alias("n"))
    bins = bins.withColumns({"before": F.sum("n").over(own.orderBy("bin")) - F.col("n"), "total": F.sum("n").over(own)}).where((F.col("total") >= least) | F.col("g").eqNullSafe(F.lit(always)))
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), (F.lit(q) * (F.col("total") - 1)).alias("place")) for i, q in enumerate(at)]))
    bins = bins.select("*", places.alias("p")).select("g", "bin", "n", "before", "p.which", "p.place")
    bins = bins.where("before <= floor(place) + 1 AND before + n > floor(place)").drop("n")
    found = binned.join(F.broadcast(bins), ["g", "bin"]).groupBy("g", "which", "place", "bin", "before", "v").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("g", "which", "bin").orderBy("v"))
    found = found.withColumn("upto", upto).groupBy("g", "which", "place").agg(
        F.min(F.expr("if(upto > floor(place), v, NULL)")).alias("lower"), F.min(F.expr("if(upto > floor(place) + 1, v, NULL)")).alias("upper")
    )
    found = found.select("g", "which", (F.col("lower") + (F.col("place") - F.floor("place")) * (F.coalesce("upper", "lower") - F.col("lower"))).alias("q"))
    out: dict[str, list[float]] = {}
    # one row for each group and quantile
    for r in found.orderBy("g", "which").collect():
        out.setdefault(r["g"], []).append(r["q"])
    return out


def assess(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    low: float = 0.001,
    high: float = 0.999,
    slack: float = 1.06,
    source: DataFrame | None = None,
) -> DataFrame:
    """`docs` with perplexity and accepted.

    trusted: a column `key` of rows whose text is trusted; `source` (by default `docs`) holds their texts. The
    model is fitted on every third of them, by a hash of the key, all taken whole; all others are held out. A text is
    accepted if its perplexity lies between the `low` quantile over `slack` and the `high` quantile times `slack`
    of its language. The high one is taken over the trusted texts that the model was not fitted on, the low one
    over all trusted texts: the model finds those it has seen, and their copies, likelier than others, and none
    of them may go for that. A language's quantiles are drawn towards those of all languages, half way at EVEN
    trusted texts, and wholly without any or for a null language. Null texts and texts of white space are
    rejected with a null perplexity. Without trusted texts all others are accepted; without any beside the fitted
    ones there is no high bound. Texts are scored whole, however long; a task holds a block of them, a longer one
    alone. Repeated rows, also of trusted ids, count each, and ties and repeated rows get equal results; an empty
    table gives none. New columns whose names are taken get an underscore. The driver gathers two numbers for
    each language.
    """
    source = docs if source is None else source
    texts = source.where(F.octet_length(text) > 0)
    good = trusted.select(key).distinct()
    h = F.xxhash64(F.col(key).cast("string"))
    # a third; the rest is held out
    best = texts.select(key).where(F.pmod(h, F.lit(3 * TRAIN_TEXTS)) < TRAIN_TEXTS).join(good, key, "left_semi").distinct()
    ids = stored(best, "trained")
    model = train(texts.select(key, text).join(ids, key, "left_semi"), text)
    every = docs.select(key, text) if source is docs else docs.select(key, text).union(source.select(key, text))
    scores = perplexities(every, model, key, text)
    # digests, not texts, are dealt and joined
    known = texts.select(key, F.col(lang).alias("group"), digest_of(text).alias("digest")).join(good, key, "left_semi")
    known = known.join(ids.select(key, F.lit(True).alias("fitted")), key, "left")
    # a group for each language, and one of all; of all trusted texts (t) and of those that were not fitted (h)
    names = lambda side: [F.concat(F.lit(f"{side}l"), "group"), F.lit(f"{side}all")]
    groups = F.explode(F.when(F.col("fitted"), F.array(*names("t"))).otherwise(F.array(*names("t"), *names("h")))).alias("group")
    values = stored(with_scores(known, scores, key).where("ppl IS NOT NULL").select(groups, "ppl").where("group IS NOT NULL"), "trusted")
    per = quantiles(values, "group", "ppl", [low, high])
    n = {r["group"]: r["count"] for r in values.groupBy("group").count().collect()}
    sides = [_drawn(per, n, "t", 0, 0.0), _drawn(per, n, "h", 1, float("inf"))]
    forget(values, ids, model)

    def pick(i: int) -> Column:
        overall, bounds = sides[i]
        own = [F.create_map(*[F.lit(x) for k, v in bounds.items() for x in (k, v)])[F.col(lang)]] if bounds else []
        return F.coalesce(*own, F.lit(overall))

    names = [fresh(c, docs.columns) for c in ("perplexity", "accepted")]
    named = fresh("digest", docs.columns)
    scored = with_scores(docs.withColumn(named, digest_of(text)), scores, key, named, names[0]).drop(named)
    p = F.col(names[0])
    return scored.withColumn(names[1], F.coalesce((p >= pick(0) / slack) & (p <= pick(1) * slack), F.lit(False)))


def _drawn(per: dict[str, list[float]], n: dict[str, int], side: str, which: int, without: float) -> tuple[float, dict[str, float]]:
    """Of one side's quantiles that of all values (`without` if there are none), and each language's, drawn towards it."""
    overall, out = per.get(f"{side}all", [without] * 2)[which], {}
    for g, own in per.items():
        if g.startswith(f"{side}l"):
            w = n[g] / (n[g] + EVEN)
            out[g[2:]] = math.exp(w * math.log(own[which]) + (1 - w) * math.log(overall))
    return overall, out


def with_scores(rows: DataFrame, scores: DataFrame, key: str, digest: str = "digest", name: str = "ppl") -> DataFrame:
    """`rows` with the perplexity of their digest's text as `name`, null where there is none.

    Digests of many rows, at most HEAVY, go by broadcast; their rows, and those without a digest, are dealt by
    their key and meet nothing in the join that follows.
    """
    much = heavy_above(int(scores.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]))
    sure, at, times = (fresh(c, [*rows.columns, name]) for c in ("sure", "at", "times"))
    heavy = scores.where(F.col("times") > much).select(F.col("digest").alias(digest), F.col("ppl").alias(sure), F.lit(True).alias(times))
    marked = rows.join(F.broadcast(heavy), digest, "left")
    alone = F.col(times).isNotNull() | F.col(digest).isNull()
    marked = marked.withColumn(at, F.when(alone, F.concat(F.lit("-"), F.xxhash64(key))).otherwise(F.col(digest)))
    found = marked.join(scores.select(F.col("digest").alias(at), F.col("ppl").alias(name)), at, "left")
    return found.withColumn(name, F.coalesce(sure, name)).select(*rows.columns, name)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, accepted of every document; trusted are those labelled good and not toxic."""
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return assess(docs.select("doc_id", "text", "lang"), trusted).drop("text")
