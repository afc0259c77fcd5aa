"""Fill-in-the-middle against a plain version, SQL and exact round trips; ropes against strings."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagmill.llm import fill_in_middle as fim
from tests.compare import canonical, connect

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _rope(text, size):
    data = text.encode()
    ends = np.cumsum([len(u.encode()) for u in UNIT.findall(text)], dtype=np.int64)
    return fim.build(data, ends, size)


def _sound(rope):
    """Cached counts equal those of the bytes below."""
    if rope is None:
        return
    data = fim.flatten(rope)
    assert rope.chars == len(data.decode())
    if isinstance(rope, fim.Leaf):
        assert rope.units == len(rope.ends) and all(0 < e <= len(rope.data) for e in rope.ends)
    else:
        assert rope.units == rope.left.units + rope.right.units
        _sound(rope.left)
        _sound(rope.right)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\té日😀", max_size=60), st.integers(0, 70), st.integers(4, 12), st.sampled_from(["units", "chars"]))
def test_ropes_split_like_strings(text, rank, size, by):
    rope = _rope(text, size)
    left, right = fim.split(rope, rank, by)
    parts = UNIT.findall(text) if by == "units" else list(text)
    assert fim.flatten(left).decode() == "".join(parts[:rank])
    assert fim.flatten(right).decode() == "".join(parts[rank:])
    for x in (rope, left, right):
        _sound(x)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \né日", min_size=1, max_size=60), st.data(), st.sampled_from(["psm", "spm"]))
def test_rearranging_is_undone(text, data, form):
    n = len(UNIT.findall(text))
    a, b = sorted((data.draw(st.integers(0, n)), data.draw(st.integers(0, n))))
    out, prefix, middle = fim.rearranged(_rope(text, 8), a, b, form)
    assert fim.restored(fim.flatten(out), form).decode() == text
    units = UNIT.findall(text)
    assert (prefix, middle) == (len("".join(units[:a])), len("".join(units[a:b])))


def test_a_large_rope_is_shallow_and_shares_its_subtrees():
    rope = _rope("word " * 200_000, 4096)

    def depth(x):
        return 0 if not isinstance(x, fim.Node) else 1 + max(depth(x.left), depth(x.right))

    def nodes(x):
        return {id(x)} | (nodes(x.left) | nodes(x.right) if isinstance(x, fim.Node) else set())

    left, right = fim.split(rope, 77_777, "units")
    assert depth(rope) <= 9 and depth(left) <= 12 and depth(right) <= 12
    assert len((nodes(left) | nodes(right)) - nodes(rope)) < 40


def test_op12_equals_its_sql(spark):
    from tagmill.llm.queries import oracle_sql, queries

    ours = queries()["op12_fill_in_middle"](spark, SF).toPandas()
    assert canonical(ours).equals(canonical(connect(SF).execute(oracle_sql()["op12_fill_in_middle"]).df()))
    assert set(ours.form) == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd_rows, no_rows):
    rows = fim.restore(fim.fill_in_middle(odd_rows, rate=100)).collect()
    assert len(rows) == odd_rows.count()
    for r in rows:
        assert r.restored == (r.text or "") and r.block == "mine" and r.n == len(UNIT.findall(r.text or ""))
        assert (r.form == "plain") == (not r.text or "<P>" in r.text)
        assert (r.prefix_chars is None) == (r.form == "plain")
    for r in fim.fill_in_middle(odd_rows).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _plain(r.doc_id, r.text)
    assert fim.restore(fim.fill_in_middle(no_rows)).count() == 0
    named = odd_rows.withColumnRenamed("source", "form").withColumnRenamed("lang", "output")
    out = fim.fill_in_middle(named)
    assert {"_form", "_output", "form", "output"} <= set(out.columns)
    assert fim.restore(out, "_output", "_form").where("restored <> coalesce(text, '')").count() == 0


def test_very_long_texts_go_whole(spark):
    texts = ["é " * 1_000_000, "x" * 2_000_000, " " * 300_000, "ab\n" * 500_000 + " "]
    # ids whose texts are rearranged
    ids = [i for i in range(200) if fim.choices(42, i)[2] % 100 < 50][: len(texts)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    for r in fim.restore(fim.fill_in_middle(df)).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _plain(r.doc_id, r.text)
        assert r.form != "plain" and r.restored == r.text


def test_outputs_of_another_form_are_refused():
    with pytest.raises(ValueError):
        fim.restored(b"<P>a<M>b<S>c", "psm")
