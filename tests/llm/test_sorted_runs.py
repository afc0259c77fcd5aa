"""Questions of substring_dedup are sorted a run of shards at a time: same answers, and little memory beside the keys."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tagmill.llm import substring_dedup as sd


def _asked(blocks: list[tuple[np.ndarray, ...]], shards: int, kind: int) -> list[np.ndarray]:
    """For each block what it is told about its keys."""
    asked = [sd._Asked(shards, *keys) for keys in blocks]
    questions = pa.concat_tables([a.messages(kind, i) for i, a in enumerate(asked)])
    by = questions.column("shard").to_numpy()
    answers = pa.concat_tables([questions.schema.empty_table(), *[sd._answer(questions.filter(pa.array(by == s))) for s in np.unique(by)]])
    of = lambda i: answers.filter(pa.array(answers.column("block").to_numpy() == i))
    return [a.told(*sd._answers(of(i), kind)) for i, a in enumerate(asked)]


@pytest.mark.parametrize("shards", [1, 7, 300])
@pytest.mark.parametrize("kind", [sd._HASHES, sd._DIGESTS])
def test_answers_of_runs_are_those_of_counting(shards, kind, monkeypatch):
    monkeypatch.setattr(sd, "SORTED", 50)
    rng = np.random.default_rng(3)
    some = rng.integers(0, 1 << 64, 900, np.uint64)
    few = np.r_[rng.choice(some, 500), np.zeros(300, np.uint64), np.full(3, (1 << 64) - 1, np.uint64)]
    firsts = [some, few, np.empty(0, np.uint64), np.full(400, some[5])]
    blocks = [(h,) if kind == sd._HASHES else (h, rng.integers(0, 3, len(h), np.uint64)) for h in firsts]
    pairs = [list(zip(*[k.tolist() for k in keys])) for keys in blocks]
    counts: dict[tuple, int] = {}
    for key in (k for block in pairs for k in block):
        counts[key] = counts.get(key, 0) + 1
    for told, block in zip(_asked(blocks, shards, kind), pairs, strict=True):
        assert told.tolist() == [counts[k] > 1 for k in block]


def test_a_task_holds_little_more_than_its_keys():
    keys = np.random.default_rng(4).integers(0, 1 << 64, 2_000_000, np.uint64)
    asked = sd._Asked(64, keys)
    tracemalloc.start()
    message = asked.messages(sd._HASHES, 0)
    peak = tracemalloc.get_traced_memory()[1]
    # 8 bytes a key are the message itself
    assert message.num_rows == 64 and peak < 24 * len(keys)
    tracemalloc.reset_peak()
    answers = sd._answer(message.set_column(2, "shard", pa.array([0] * 64, pa.int64())))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert answers.num_rows == 64 and peak < 40 * len(keys)
