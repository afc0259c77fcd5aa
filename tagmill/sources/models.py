"""Sources that a model answers: a caller's client or model, held by a task or a worker, called over batches of rows."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Models that this worker process has opened, by name.
_opened: dict[str, Any] = {}


class TokenBucket:
    """Permits at a rate: in any span of t seconds at most burst + rate * t are given."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        """Wait until there is a permit, and use it."""
        while True:
            now = self.clock()
            self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
            if self.tokens >= 1 - 1e-9:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


def patiently(call: Callable[[], Any], retries: int, wait: float, permits: TokenBucket | None = None, sleep: Callable[[float], None] = time.sleep) -> tuple[Any, str | None]:
    """(result, None) of a call or (None, its last error), after repeating it `retries` times.

    Between calls it waits `wait` seconds, twice that, and so on, each times a random number from a half to one and
    a half, so that tasks that failed together do not return together; an error's own retry_after, if longer, is
    kept to. Every call, a repeated one too, takes a permit.
    """
    error = None
    for k in range(retries + 1):
        if permits is not None:
            permits.take()
        try:
            return call(), None
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
            if k < retries:
                sleep(max(wait * (k + 1) * random.uniform(0.5, 1.5), float(getattr(e, "retry_after", 0) or 0)))
    return None, error


def _dealt(rows: DataFrame, parallel: int | None, rate: float | None) -> tuple[DataFrame, float | None]:
    """`rows` over the tasks that call, and each task's share of the rate; all tasks at once keep the whole rate."""
    if rate is not None and parallel is None:
        parallel = rows.sparkSession.sparkContext.defaultParallelism
    return (rows if parallel is None else rows.repartition(parallel)), rate and rate / parallel


def _more(schema: StructType, **kinds: str) -> StructType:
    out = StructType([*schema.fields])
    for name, kind in kinds.items():
        out = out.add(StructType.fromDDL(f"`{name}` {kind}")[0])
    return out


def generated(
    prompts: DataFrame,
    client: Callable[[], Callable[[str], str]],
    prompt: str = "prompt",
    retries: int = 2,
    wait: float = 1.5,
    parallel: int | None = None,
    rate: float | None = None,
    burst: int = 1,
) -> DataFrame:
    """`prompts` with raw (an output, or null), error (a message, or null) and seconds.

    `client` makes a task's own session, a function from a prompt to an output. Failed calls are repeated as
    patiently() says; then the error is kept and the run goes on. A null prompt is not sent. `parallel` deals the
    rows over so many tasks. `rate` is the most calls a second of all tasks together (without `parallel`, of
    Spark's default parallelism): each has a bucket with its share. Tasks that Spark repeats call again.
    """
    dealt, share = _dealt(prompts, parallel, rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, permits = client(), TokenBucket(share, burst) if share else None
        for batch in batches:
            raw, errors, seconds = [], [], []
            for text in batch.column(prompt).to_pylist():
                began = time.monotonic()
                answer, error = patiently(lambda t=text: ask(t), retries, wait, permits) if isinstance(text, str) else (None, "no prompt")
                raw.append(answer)
                errors.append(error)
                seconds.append(time.monotonic() - began)
            new = [pa.array(raw, pa.string()), pa.array(errors, pa.string()), pa.array(seconds, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "raw", "error", "seconds"])

    return dealt.mapInArrow(run, _more(prompts.schema, raw="string", error="string", seconds="double"))


def embedded(
    texts: DataFrame,
    client: Callable[[], Callable[[list[str]], list[list[float]]]],
    text: str = "text",
    out: str = "v",
    batch: int = 32,
    retries: int = 2,
    wait: float = 1.5,
    parallel: int | None = None,
    rate: float | None = None,
    burst: int = 1,
) -> DataFrame:
    """`texts` with a vector of each text as `out`, null for a null text, and <out>_error.

    Texts go in batches of `batch`. A batch that fails after all repetitions is halved, so that one text that
    cannot be embedded costs its batch mates nothing; its own error is kept. Rates are as in generated().
    """
    dealt, share = _dealt(texts, parallel, rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed, permits = client(), TokenBucket(share, burst) if share else None

        def checked(some: list[str]) -> list[list[float]]:
            vectors = [[float(x) for x in v] for v in embed(some)]
            if len(vectors) != len(some):
                raise ValueError(f"{len(vectors)} vectors for {len(some)} texts")
            return vectors

        for rows in batches:
            every = rows.column(text).to_pylist()
            vectors: list = [None] * len(every)
            errors: list = [None] * len(every)
            known = [i for i, t in enumerate(every) if t is not None]
            todo = [known[a : a + batch] for a in range(0, len(known), batch)][::-1]
            while todo:
                at = todo.pop()
                made, error = patiently(lambda: checked([every[i] for i in at]), retries, wait, permits)
                if error is None:
                    for i, v in zip(at, made, strict=True):
                        vectors[i] = v
                elif len(at) == 1:
                    errors[at[0]] = error
                else:
                    todo += [at[len(at) // 2 :], at[: len(at) // 2]]
            new = [pa.array(vectors, pa.list_(pa.float64())), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *new], [*rows.schema.names, out, f"{out}_error"])

    return dealt.mapInArrow(run, _more(texts.schema, **{out: "array<double>", f"{out}_error": "string"}))


def opened(name: str, open_model: Callable[[], Any]) -> Any:
    """The model of a name, opened at the first call in a worker process and kept for its later tasks."""
    if name not in _opened:
        _opened[name] = open_model()
    return _opened[name]


def length_batches(lengths: np.ndarray, batch: int, padded: int) -> Iterator[np.ndarray]:
    """Places of items in batches of like length, longest first: at most `batch` items, and `padded` units with the padding.

    An item longer than `padded` is a batch of its own.
    """
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        n = int(min(batch, max(1, padded // max(1, int(lengths[order[at]])))))
        yield order[at : at + n]
        at += n


def scored_pairs(
    pairs: DataFrame,
    model: Callable[[], Callable[[list[tuple[str, str]]], list[float]]],
    left: str = "query",
    right: str = "body",
    out: str = "score",
    name: str = "pair-model",
    batch: int = 64,
    padded: int = 65_536,
    parts: int | None = None,
) -> DataFrame:
    """`pairs` with the model's score of each (left, right), null where a side is null.

    `model` opens a function from pairs of texts to scores; each worker process opens it once under `name` and
    keeps it for all its tasks. Inside an Arrow batch pairs are grouped by length, so that little is padded:
    a call holds at most `batch` pairs and `padded` characters with the padding. `parts` first deals the pairs
    by length over so many tasks, for tables of very different texts. Repeated pairs are scored each.
    """

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        score = opened(name, model)
        for a, b in batches:
            texts = list(zip(a.to_pylist(), b.to_pylist(), strict=True))
            known = np.array([i for i, (x, y) in enumerate(texts) if x is not None and y is not None], np.int64)
            found, missing = np.zeros(len(texts)), np.ones(len(texts), bool)
            lengths = np.array([len(texts[i][0]) + len(texts[i][1]) for i in known.tolist()], np.int64)
            for some in length_batches(lengths, batch, padded):
                at = known[some]
                found[at], missing[at] = score([texts[i] for i in at.tolist()]), False
            # not a number is a score, and no null
            yield pa.array(found, pa.float64(), mask=missing, from_pandas=False)

    dealt = pairs if parts is None else pairs.repartitionByRange(parts, F.desc(F.length(left) + F.length(right)))
    return dealt.withColumn(out, F.arrow_udf(run, "double")(F.col(left), F.col(right)))


def pair_keys(pairs: DataFrame, query: str = "query") -> DataFrame:
    """`pairs` with qh, the first 16 digits of the query's digest, by which scores are cached together with chunk_id."""
    return pairs.withColumn("qh", F.substring(F.sha2(F.col(query).cast("binary"), 256), 1, 16))


def by_length(texts: DataFrame, text: str = "text", parts: int = 8) -> DataFrame:
    """`texts` dealt and sorted by length, longest first, so that the texts of a model's batch are alike."""
    return texts.repartitionByRange(parts, F.desc(F.length(text))).sortWithinPartitions(F.desc(F.length(text)))


def throughput(answers: DataFrame, seconds: str = "seconds") -> DataFrame:
    """One row: n, the mean and the 95th percentile of latency, and rows for each second of work."""
    s = F.col(seconds)
    return answers.agg(F.count("*").alias("n"), F.avg(s).alias("mean_s"), F.percentile_approx(s, 0.95).alias("p95_s"), F.try_divide(F.count("*"), F.sum(s)).alias("rows_per_s"))
