"""Incremental scoring and stateful logs as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.query import StreamingQuery

from tagmill.sources.models import pair_keys, scored_pairs
from tagmill.sources.tables import Tables
from tagmill.streaming.caches import BUCKETS, ScoreCache


def unseen(rows: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the cache lacks, each key once."""
    return rows.join(cache.select(*keys), keys, "left_anti").dropDuplicates(keys)


def append_scores(rows: DataFrame, cache_path: str, keys: list[str], score: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Score what the cache at `cache_path` lacks and append it; `score` gets only unseen rows.

    A batch that is replayed finds its keys in the cache and adds nothing; of one that was lost midway only the
    rest is scored. buckets: of a cache that is new.
    """
    cache = ScoreCache(rows.sparkSession, cache_path, keys, buckets)
    cache.append(score(cache.unseen(rows)))


def score_pairs(pairs: DataFrame, cache_path: str, model: Callable, query: str = "query", chunk: str = "chunk_id", body: str = "body", out: str = "teacher_logit", slices: int = 16, buckets: int = BUCKETS, **how) -> None:
    """Add the model's scores of pairs that the cache lacks, keyed by the query's digest and the chunk.

    Pairs go in slices by a hash of their key, each appended when it is whole: a run that is interrupted has
    lost one slice, and the next one scores only what is left. Of rows with one key one is scored; how: more
    parameters of scored_pairs().
    """
    keyed = pair_keys(pairs, query)
    place = F.pmod(F.xxhash64("qh", chunk), F.lit(slices))

    def score(todo: DataFrame) -> DataFrame:
        return scored_pairs(todo, model, query, body, out, **how).select("qh", chunk, out)

    for n in range(slices):
        append_scores(keyed.where(place == n), cache_path, ["qh", chunk], score, buckets)


def score_stream(stream: DataFrame, cache_path: str, checkpoint: str, keys: list[str], score: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> StreamingQuery:
    """The same for a stream: each micro-batch scores its unseen keys and appends them."""

    def batch(rows: DataFrame, _: int) -> None:
        append_scores(rows, cache_path, keys, score, buckets)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that a stream has to a log of files, each row once, also over restarts: the sink commits by batch."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _timed(stream: DataFrame, at: str) -> DataFrame:
    """`stream` with `at` as an instant: watermarks refuse times without a zone, which are read in the session's."""
    return stream.withColumn(at, F.col(at).cast("timestamp"))


def first_of_key(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """The first row of each key, forgetting keys once the watermark has passed them by `delay`."""
    return _timed(stream, at).withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, at: str, width: str, delay: str, by: list[str]) -> DataFrame:
    """Counts in tumbling windows; rows later than `delay` are left out."""
    return _timed(stream, at).withWatermark(at, delay).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"))


def last_verdicts(stream: DataFrame, key: str, verdict: str, order: str) -> DataFrame:
    """The running last verdict of each key; an empty verdict deletes it (emitted as null).

    A row without an order comes before all others; of rows with equal orders the first one stays.
    """
    kind = stream.schema[key].dataType.simpleString()

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, said = state.get if state.exists else (None, None)
        for rows in batches:
            for at, v in zip(rows[order].tolist(), rows[verdict].tolist(), strict=True):
                at = -(1 << 63) if pd.isna(at) else int(at)
                if last is None or at > last:
                    last, said = at, v or ""
        if last is None:
            return
        state.update((last, said))
        yield pd.DataFrame({key: [k[0]], verdict: [said or None]})

    return stream.groupBy(key).applyInPandasWithState(
        update, f"{key} {kind}, {verdict} string", "at long, verdict string", "update", GroupStateTimeout.NoTimeout
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; the pattern lets it be one file or a folder."""
    schema = Tables(spark, sf_dir).raw("events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
