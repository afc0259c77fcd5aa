"""Versions with a log of commits: lost writes at every step, merges by bucket, writers that overtake each other."""

from __future__ import annotations

import random
from datetime import UTC, datetime

import pytest
from pyspark.errors import AnalysisException

from tagmill.sources import files, sinks, versions
from tagmill.sources.versions import Overtaken, Versions, write_whole

AT = datetime(2025, 3, 1, tzinfo=UTC)
SCHEMA = "k int, s string, at int"


class Killed(Exception):
    pass


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _kill(monkeypatch, step):
    """Let the next write die: with half its files, with all of them, or with a record that has no number yet."""
    files_of, publish, promote = Versions._files, Versions.publish, Versions._promote

    def half(self, df, place, by=None):
        files_of(self, df.limit(1), place, by)
        (self._fs.mkdirs(self._path(f"{place}/_temporary/0")), self._fs.delete(self._path(f"{place}/_SUCCESS"), False))
        raise Killed

    def dead(*_):
        raise Killed

    monkeypatch.setattr(Versions, *{"files": ("_files", half), "log": ("publish", dead), "number": ("_promote", dead)}[step])
    return lambda: (monkeypatch.setattr(Versions, "_files", files_of), monkeypatch.setattr(Versions, "publish", publish), monkeypatch.setattr(Versions, "_promote", promote))


@pytest.mark.parametrize("step", ["files", "log", "number"])
def test_a_lost_merge_changes_nothing_and_stands_in_no_way(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "table")
    for before in ([], [(1, "a", 1), (2, "b", 1)]):
        if before:
            sinks.upsert(spark, root, _frame(spark, before), ["k"], "at", AT)
        revive = _kill(monkeypatch, step)
        with pytest.raises(Killed):
            sinks.upsert(spark, root, _frame(spark, [(2, "lost", 9), (7, "lost", 9)]), ["k"], "at", AT)
        revive()
        last = Versions(spark, root).latest()
        assert (_rows(Versions(spark, root).read(last)) if last else []) == before
    assert _rows(sinks.upsert(spark, root, _frame(spark, [(2, "c", 2)]), ["k"], "at", AT)) == [(1, "a", 1), (2, "c", 2)]


@pytest.mark.parametrize("step", ["files", "log", "number"])
def test_a_lost_cache_is_made_again(spark, tmp_path, monkeypatch, step):
    root, cache, df = str(tmp_path / "snap"), str(tmp_path / "cache"), _frame(spark, [(1, "a", 1)])
    sinks.snapshot({"t": df}, root, at=AT)
    revive = _kill(monkeypatch, step)
    with pytest.raises(Killed):
        sinks.keyed_by_snapshot(spark, root, cache, lambda: df)
    revive()
    calls = []
    for _ in range(2):
        assert _rows(sinks.keyed_by_snapshot(spark, root, cache, lambda: calls.append(1) or df)) == [(1, "a", 1)]
    assert len(calls) == 1


@pytest.mark.parametrize("step", ["log", "number"])
def test_a_lost_snapshot_is_none(spark, tmp_path, monkeypatch, step):
    root, df = str(tmp_path / "snap"), _frame(spark, [(1, "a", 1)])
    revive = _kill(monkeypatch, step)
    with pytest.raises(Killed):
        sinks.snapshot({"t": df}, root, at=AT)
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, root)
    revive()
    first = sinks.snapshot({"t": df}, root, at=AT)
    assert first == sinks.stamp(AT) + "-1" == files.latest_snapshot(spark, root)
    later = sinks.snapshot({"t": df}, root, at=AT.replace(year=2026))
    revive = _kill(monkeypatch, step)
    with pytest.raises(Killed):
        sinks.snapshot({"t": df}, root, at=AT.replace(year=2027))
    revive()
    assert files.latest_snapshot(spark, root) == later


def test_folders_of_others_with_temporary_files_are_no_snapshots(spark, tmp_path):
    for name, below in (("2024", "t"), ("2025", "_temporary/0"), ("2026", "t/_temporary")):
        (tmp_path / "snap" / name / below).mkdir(parents=True)
    assert files.latest_snapshot(spark, str(tmp_path / "snap")) == "2024"
    (tmp_path / "half" / "2025" / "_temporary").mkdir(parents=True)
    assert _rows(sinks.upsert(spark, str(tmp_path / "half"), _frame(spark, [(1, "a", 1)]), ["k"], "at", AT)) == [(1, "a", 1)]
    cache = tmp_path / "cache"
    (cache / "2024" / "_temporary").mkdir(parents=True)
    assert sinks.keyed_by_snapshot(spark, str(tmp_path / "snap"), str(cache), lambda: spark.range(3)).count() == 3


def test_a_merge_of_one_key_rewrites_one_bucket(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "table"))
    name = lambda last: f"v{int(last[1:] or 0) + 1}" if last else "v1"
    one = v.merge(_frame(spark, [(i, "a", 1) for i in range(200)]), ["k"], "at", name, 16)
    two = v.merge(_frame(spark, [(7, "b", 2)]), ["k"], "at", name)
    changed = [b for b in one.places if one.places[b] != two.places[b]]
    assert len(changed) == 1 and set(one.places) == set(two.places)
    written = list((tmp_path / "table" / two.places[changed[0]].split("/")[0]).rglob("*.parquet"))
    assert len(written) == 1
    assert sum(two.rows.values()) == 200 and two.number == 1
    # readers of the version before keep it
    assert (7, "a", 1) in _rows(v.read(one)) and (7, "b", 2) in _rows(v.read(two))
    assert v.merge(_frame(spark, []), ["k"], "at", name) == two
    with pytest.raises(ValueError):
        v.merge(_frame(spark, [(7, "b", 2)]), ["s"], "at", name)


def test_merging_takes_one_shuffle(spark, tmp_path, monkeypatch):
    plans = []
    real = Versions._files
    monkeypatch.setattr(Versions, "_files", lambda self, df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(self, df, *a))
    root = str(tmp_path / "table")
    for at in (1, 2):
        sinks.upsert(spark, root, _frame(spark, [(1, "a", at)]), ["k"], "at", AT)
    assert all(p.count("Exchange ") == 1 for p in plans)


@pytest.mark.parametrize("bucket_rows", [4_000_000, 6])
def test_random_histories_equal_full_merges(spark, tmp_path, monkeypatch, bucket_rows):
    """Null keys and orders among them; also when buckets are split again and again."""
    monkeypatch.setattr(versions, "BUCKET_ROWS", bucket_rows)
    rng, root, want = random.Random(bucket_rows), str(tmp_path / "table"), {}
    for step in range(5):
        rows = [(rng.choice([None, *range(25)]), f"{step}{i}", rng.choice([None, 1, 2, 3])) for i in range(rng.randint(1, 12))]
        rows = list({(k, at): (k, s, at) for k, s, at in rows}.values())
        for k, s, at in rows:
            if k not in want or (at if at is not None else -1) >= (want[k][2] if want[k][2] is not None else -1):
                want[k] = (k, s, at)
        got = sinks.upsert(spark, root, _frame(spark, rows), ["k"], "at", AT, buckets=2)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.values()))
    n = Versions(spark, root).latest().buckets
    assert n == 2 if bucket_rows > 100 else n > 2


def test_columns_that_come_and_go(spark, tmp_path):
    root = str(tmp_path / "table")
    sinks.upsert(spark, root, spark.createDataFrame([(i, 1) for i in range(9)], "k int, at int"), ["k"], "at", AT, buckets=4)
    got = sinks.upsert(spark, root, spark.createDataFrame([(3, "new", 2)], "k int, note string, at int"), ["k"], "at", AT)
    assert {(r.k, r.note, r.at) for r in got.collect()} == {(i, None, 1) for i in range(9) if i != 3} | {(3, "new", 2)}


def test_a_merge_that_is_overtaken_starts_anew(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    sinks.upsert(spark, root, _frame(spark, [(1, "a", 1)]), ["k"], "at", AT)
    real, other = Versions.publish, [lambda: sinks.upsert(spark, root, _frame(spark, [(2, "other", 1)]), ["k"], "at", AT)]

    def publish(self, commit):
        if other:
            other.pop()()  # another writer is faster, once
        return real(self, commit)

    monkeypatch.setattr(Versions, "publish", publish)
    assert _rows(sinks.upsert(spark, root, _frame(spark, [(1, "mine", 2)]), ["k"], "at", AT)) == [(1, "mine", 2), (2, "other", 1)]
    v = Versions(spark, root)
    assert v.numbers() == [0, 1, 2]
    with pytest.raises(Overtaken):
        real(v, v.latest())
    assert not [n for n, _ in v._names(versions.LOG) if n.endswith(".draft")]


def test_cleaning_keeps_what_readers_and_writers_need(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    for at in (1, 2, 3):
        sinks.upsert(spark, root, _frame(spark, [(1, "a", at), (2, "b", 1)][: 2 if at == 1 else 1]), ["k"], "at", AT, buckets=64)
    revive = _kill(monkeypatch, "files")
    with pytest.raises(Killed):
        sinks.upsert(spark, root, _frame(spark, [(5, "lost", 1)]), ["k"], "at", AT)
    revive()
    v, want = Versions(spark, root), [(1, "a", 3), (2, "b", 1)]
    places = {p.split("/")[0] for p in v.latest().places.values()}
    gone = v.clean(keep=1)  # the lost folder is young
    assert len(gone) == 1 and not set(gone) & places and _rows(v.read(v.latest())) == want
    assert len(v.clean(keep=1, hours=-1)) == 1
    assert {p.name for p in tmp_path.joinpath("table").iterdir() if not p.name.startswith(("_", "."))} == places
    assert _rows(v.read(v.latest())) == want


def test_whole_files_or_none(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), _frame(spark, [(1, "a", 1)])
    revive = _kill(monkeypatch, "files")
    with pytest.raises(Killed):
        write_whole(df, path)
    revive()
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    write_whole(df, path)
    assert _rows(spark.read.parquet(path)) == [(1, "a", 1)]
    with pytest.raises(FileExistsError):
        write_whole(df, path)
