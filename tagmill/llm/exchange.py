"""Questions from blocks of documents to shards of hashed keys, and their answers.

Documents are dealt to blocks by a hash of their row. Each block asks about its distinct keys: one binary row
for each shard, a shard being a range of hash values, so the sorted keys of a block are cut and never copied
row by row. A shard sees each key once per block, however often a text or a passage occurs, combines all
blocks' questions on a key, and answers each block in the order of its question. Blocks and shards hold a
bounded number of bytes; their number grows with the input. There are never more messages than distinct keys in
all blocks together: where shards outnumber a block's keys, a message holds one key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import BLOCK_BYTES, fresh, text_bytes

#: Shuffle partitions that blocks are dealt to, at most; beyond, a task works through several blocks in turn.
MOST_PARTITIONS = 20_000


def n_blocks(docs: DataFrame, text: str) -> int:
    """Blocks of about BLOCK_BYTES of text; one scan."""
    return max(12, -(-text_bytes(docs, text) // BLOCK_BYTES))


def in_blocks(docs: DataFrame, n: int, by: list[str]) -> tuple[DataFrame, str]:
    """`docs` with a column for the block of each row, dealt by it; and that column's name."""
    name = fresh("block", docs.columns)
    return docs.withColumn(name, F.pmod(F.xxhash64(*by), F.lit(n))).repartition(min(n, MOST_PARTITIONS), name), name


def cuts(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of each shard's non-empty range among sorted 64-bit keys."""
    width = -(-(1 << 64) // shards)
    edges = np.array([i * width for i in range(1, shards)], np.uint64)
    at = np.r_[0, np.searchsorted(keys, edges), len(keys)].tolist()
    return [(s, a, b) for s, (a, b) in enumerate(zip(at, at[1:])) if a < b]
