"""Prompts, chat examples and grammars as columns."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prompts' texts, which consumers expect byte for byte.
TAG_SYSTEM = (
    "You are a comparative religion scholar helping to build a concept index "
    "of mystical texts. For each passage given, score it against every concept "
    "definition provided. Respond ONLY with a valid JSON array (no markdown, "
    "no commentary)."
)
TAG_SCALE = (
    "Rate each concept 0-3 for how strongly this passage expresses it:\n  0 = not present\n"
    "  1 = peripherally present\n  2 = clearly present\n  3 = central theme\n\nConcepts:\n[\n"
)
TAG_TAIL = (
    '\n]\n\nReturn a JSON array of objects for every concept with score >= 1:\n[\n  {\n'
    '    "concept_id": "<id from list above OR a new snake_case id>",\n    "score": <0-3>,\n'
    '    "justification": "<one sentence>",\n    "is_new_concept": <true if not in list>,\n'
    '    "new_concept_def": "<definition if is_new_concept else null>"\n  }\n]\n\n'
    "Return [] if nothing scores >= 1. Output only the JSON array. No preamble, no explanation, no markdown fences. "
    "Start your response with [ and end with ]. Return [] if nothing scores >= 1."
)
PAIR_TAIL = (
    "Classify the relationship between these two passages:\n"
    "  PARALLELS    — genuine conceptual parallel (same insight, different tradition)\n"
    "  CONTRASTS    — genuine conceptual opposition (same theme, opposite position)\n"
    "  surface_only — superficially similar wording but no deep connection\n"
    "  unrelated    — no meaningful connection\n\nRespond with:\n{\n"
    '  "edge_type": "<PARALLELS|CONTRASTS|surface_only|unrelated>",\n  "confidence": <0.0-1.0>,\n'
    '  "justification": "<one to two sentences explaining the relationship>"\n}\n'
)
GRAMMAR_HEAD = r'''root ::= ws "[" ws ( tag ( ws "," ws tag )* ws )? "]" ws
tag ::= "{" ws "\"concept_id\"" ws ":" ws cid ws "," ws "\"score\"" ws ":" ws score ws "," ws "\"justification\"" ws ":" ws string ws "," ws "\"is_new_concept\"" ws ":" ws boolean ws "," ws "\"new_concept_def\"" ws ":" ws ( string | "null" ) ws "}"
score ::= "0" | "1" | "2" | "3"
boolean ::= "true" | "false"
string ::= "\"" ( [^"\\] | "\\" ["\\/bfnrt] )* "\""
ws ::= [ \t\n]*
'''
GRAMMAR_OPEN = 'cid       ::= "\\"" [a-z] [a-z0-9_]* "\\""'


def citation(name: Column, section: Column, chunk_id: Column) -> Column:
    """`name — section`, else the name, else the id."""
    return F.coalesce(F.when(section.isNotNull() & name.isNotNull(), F.concat(name, F.lit(" — "), section)), name, chunk_id)


def concept_block(concepts: DataFrame) -> DataFrame:
    """One row: all concepts as lines of the prompt; definitions are not escaped. The taxonomy is small by nature."""
    line = F.concat(F.lit('  {"id": "'), "concept_id", F.lit('", "definition": "'), "definition", F.lit('"}'))
    listed = F.array_sort(F.collect_list(F.struct("concept_id", line.alias("line"))))
    return concepts.agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("block"))


def passage(label: str, cite: Column, body: Column) -> Column:
    return F.concat(F.lit(f"{label} ("), cite, F.lit('):\n"""\n'), body, F.lit('\n"""\n\n'))


def tag_prompts(passages: DataFrame, concepts: DataFrame) -> DataFrame:
    """chunk_id, citation, body with the tagging prompt; the concept block is one broadcast row."""
    block = F.broadcast(concept_block(concepts))
    text = F.concat(passage("Passage", F.col("citation"), F.col("body")), F.lit(TAG_SCALE), F.col("block"), F.lit(TAG_TAIL))
    return passages.crossJoin(block).withColumn("prompt", text).drop("block")


def pair_prompts(pairs: DataFrame) -> DataFrame:
    """citation_a, body_a, citation_b, body_b with the pair prompt."""
    a = passage("Passage A", F.col("citation_a"), F.col("body_a"))
    b = passage("Passage B", F.col("citation_b"), F.col("body_b"))
    return pairs.withColumn("prompt", F.concat(a, b, F.lit(PAIR_TAIL)))


def review_prompts(pairs: DataFrame, rubric: str) -> DataFrame:
    """A rubric, both passages, and the proposal where there is one."""
    proposal = F.when(F.col("proposal").isNotNull(), F.concat(F.lit("Proposed: "), "proposal", F.lit("\n"))).otherwise(F.lit(""))
    a = passage("A", F.col("citation_a"), F.substring("body_a", 1, 400))
    b = passage("B", F.col("citation_b"), F.substring("body_b", 1, 400))
    return pairs.withColumn("prompt", F.concat(F.lit(rubric + "\n\n"), a, b, proposal))


def grammar(concepts: DataFrame, open_ids: bool = False) -> DataFrame:
    """One row: the output grammar, for any snake_case id or for the taxonomy's ids alone."""
    if open_ids:
        return concepts.limit(1).select(F.lit(GRAMMAR_HEAD + GRAMMAR_OPEN + "\n").alias("grammar"))
    ids = F.array_sort(F.collect_set("concept_id"))
    alternatives = F.array_join(F.transform(ids, lambda c: F.concat(F.lit('"\\"'), c, F.lit('\\""'))), " | ")
    return concepts.agg(F.concat(F.lit(GRAMMAR_HEAD + "cid       ::= "), alternatives, F.lit("\n")).alias("grammar"))


def _serialized(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for tags in batches:
        yield tags.map(
            lambda ts: json.dumps(
                [
                    {
                        "concept_id": t["concept_id"],
                        "score": int(t["score"]),
                        "justification": t["justification"] or "",
                        "is_new_concept": bool(t["is_new_concept"]),
                        "new_concept_def": None,
                    }
                    for t in ts
                ],
                ensure_ascii=False,
            )
        )


def serialized(tags: Column) -> Column:
    """An array of tags as JSON with spaces after separators, a fixed key order and non-ASCII letters kept."""
    return F.pandas_udf(_serialized, "string")(tags)


def sft_messages(passages: DataFrame, tagged: DataFrame, concepts: DataFrame) -> DataFrame:
    """chunk_id and the chat messages (system, user, assistant) of one training example for each tagged chunk."""
    return messages(passages.join(tagged, "chunk_id"), concepts)


def messages(tagged_passages: DataFrame, concepts: DataFrame) -> DataFrame:
    """The same of passages (chunk_id, citation, body) that have their tags: prompts are made last, no shuffle carries them."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    both = tag_prompts(tagged_passages, concepts)
    parts = [message("system", F.lit(TAG_SYSTEM)), message("user", F.col("prompt")), message("assistant", serialized(F.col("tags")))]
    return both.select("chunk_id", F.array(*parts).alias("messages"))
