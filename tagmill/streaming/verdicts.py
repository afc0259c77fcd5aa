"""Verdicts kept as typed state that expires, can be read back as a table, and is shared between twins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The order of a row that has none: before all others.
FIRST = -(1 << 63)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk and in the checkpoint, which typed state needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _place(at: object) -> int:
    return FIRST if pd.isna(at) else int(at)


class _Last(StatefulProcessor):
    """One value for each key: the order and the text of its last verdict."""

    def __init__(self, key: str, verdict: str, order: str, keep_ms: int | None) -> None:
        self.key, self.verdict, self.order, self.keep_ms = key, verdict, order, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, verdict string", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        last = self.last.get() if self.last.exists() else None
        for batch in rows:
            for at, said in zip(batch[self.order].tolist(), batch[self.verdict].tolist(), strict=True):
                if last is None or _place(at) > last[0]:
                    last = (_place(at), said or "")
        self.last.update(tuple(last))
        yield pd.DataFrame({self.key: [key[0]], self.verdict: [last[1] or None]})

    def close(self) -> None:
        pass


class _Twins(StatefulProcessor):
    """A map for each group of twins: the order and the text of each member's last verdict."""

    def __init__(self, twin: str, key: str, verdict: str, order: str, keep_ms: int | None) -> None:
        self.twin, self.key, self.verdict, self.order, self.keep_ms = twin, key, verdict, order, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = handle.getMapState("members", "member string", "at long, verdict string", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for member, at, said in zip(batch[self.key].tolist(), batch[self.order].tolist(), batch[self.verdict].tolist(), strict=True):
                name = (str(member),)
                if not self.members.containsKey(name) or _place(at) > self.members.getValue(name)[0]:
                    self.members.updateValue(name, (_place(at), said or ""))
        known = {m[0]: (v[0], v[1]) for m, v in self.members.iterator()}
        # the last judged twins; of equal orders the first by name
        judged = sorted((-at, m) for m, (at, said) in known.items() if said)[:2]
        out = []
        for m, (_, said) in known.items():
            other = next((n for _, n in judged if n != m), None)
            out.append((key[0], m, said or (known[other][1] if other else None), not said and other is not None))
        yield pd.DataFrame(out, columns=[self.twin, self.key, self.verdict, "synced"])

    def close(self) -> None:
        pass


def kept_verdicts(stream: DataFrame, key: str, verdict: str, order: str, keep_ms: int | None = None) -> DataFrame:
    """The running last verdict of each key, in update mode; an empty or null one deletes it (emitted as null).

    Rows without an order come before all others; of equal orders the first one stays. keep_ms: a key that
    nobody has judged for so long is forgotten, deletions too; such a stream has a batch for each trigger, so one
    with availableNow never ends. To be started inside rocksdb(), with a sink that can go on from a checkpoint; an
    empty stream emits nothing.
    """
    kind = stream.schema[key].dataType.simpleString()
    mode = "none" if keep_ms is None else "processingTime"
    return stream.groupBy(key).transformWithStateInPandas(_Last(key, verdict, order, keep_ms), f"{key} {kind}, {verdict} string", "update", mode)


def twin_verdicts(stream: DataFrame, twin: str, key: str, verdict: str, order: str, keep_ms: int | None = None) -> DataFrame:
    """twin, key, verdict, synced of each member seen of each group with news: its own verdict, or without one its twin's.

    `twin` names the group, `key` the member, as text in the result. Of several twins the last judged one counts.
    A member whose verdict is deleted takes its twin's again. Groups are small: one is held in memory. The rest
    is as in kept_verdicts().
    """
    kind = stream.schema[twin].dataType.simpleString()
    mode = "none" if keep_ms is None else "processingTime"
    out = f"{twin} {kind}, {key} string, {verdict} string, synced boolean"
    return stream.groupBy(twin).transformWithStateInPandas(_Twins(twin, key, verdict, order, keep_ms), out, "update", mode)


def verdict_table(spark: SparkSession, checkpoint: str, key: str = "id", verdict: str = "verdict") -> DataFrame:
    """key, verdict: what a stream of kept_verdicts() knows, read from its checkpoint; deleted ones are left out."""
    state = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return state.selectExpr(f"key.`{key}` AS `{key}`", f"value.verdict AS `{verdict}`").where(f"`{verdict}` <> ''")
