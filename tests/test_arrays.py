"""JSON arrays read in splits give the rows of documents read whole, wherever the bounds fall."""

import json
import random

import pytest

from listwell.plans import lake as L
from listwell.sources.readers import FILE, ORDINAL, broken_json_files, read_json

from .test_splits import rows, small_splits  # noqa: F401 - a fixture

TEXTS = ["", "a", '"', "\\", '\\"', "}", "{", "]}", '"}', "\\}", "я{", "line\nline", "x" * 300, "],[", '{"a": "b"}']


def records(rng: random.Random, n: int) -> list[dict]:
    inner = lambda: rng.choice([rng.choice(TEXTS), 1.5, None, True, [], {}, [{"k": rng.choice(TEXTS)}], {"m": {"k": [rng.choice(TEXTS)]}}])
    return [{key: inner() for key in rng.sample(["a", "b", "c", "d"], rng.randint(0, 4))} for _ in range(n)]


@pytest.mark.parametrize(("seed", "indent"), [(0, None), (1, 2)])
def test_same_rows_as_whole(spark, tmp_path, small_splits, seed, indent):  # noqa: F811
    rng = random.Random(seed)
    for name, n in (("a", 150), ("b", 1), ("c", 0)):
        (tmp_path / f"{name}.json").write_text(" " * seed + json.dumps(records(rng, n), ensure_ascii=bool(seed), indent=indent) + "\n" * seed)
    (tmp_path / "one.json").write_text(json.dumps({"a": [{"b": 1}], "d": "}"}))
    paths = [str(tmp_path / f"{n}.json") for n in ("a", "b", "c", "one")]
    want = read_json(spark, paths, lines=False)
    for size in (61, 997, 1 << 20):
        small_splits(size)
        got = read_json(spark, paths, lines=False, large=tuple(paths))
        assert got.columns == want.columns and rows(got) == rows(want), size
        assert not broken_json_files(spark, paths, lines=False, large=tuple(paths)).head(1)
    assert len(rows(want)) == 152 and len({(r[FILE], r[ORDINAL]) for r in got.collect()}) == 152


BROKEN = ['[{"a":1}', '[{"a":1}]}', '[{"a":1} {"a":2}]', '[{"a":1},]', '[,{"a":1}]', '[{"a":1}, 5]', '[5, {"a":1}]', '[{"a":1}][{"a":2}]', '[{"a":1}]{"a":2}]', '[{"a":[1}]}]', '[{"a":"x}]', '[{"a":1}}, {"b":2}]', "[", "]", '[{"a":1}, [{"a":2}]]', '[{"a":1}] x', '[{"a":01}]']


def test_broken_files_are_found(spark, tmp_path, small_splits):  # noqa: F811
    for i, text in enumerate(BROKEN):
        (tmp_path / f"{i}.json").write_text(text)
    paths = [str(tmp_path / f"{i}.json") for i in range(len(BROKEN))]
    for size in (7, 1 << 20):
        small_splits(size)
        assert broken_json_files(spark, paths, lines=False, large=tuple(paths)).count() == len(BROKEN)
    assert broken_json_files(spark, paths, lines=False).count() == len(BROKEN)


def test_nothing_follows_a_value(spark, tmp_path):
    for i, text in enumerate(['{"a":1}]', '{"a":1}] x', '{"a":1}, {"a":2}', '{"a":1} {"a":2}', '[{"a":1}]] x', '{"a":1}, 0] x', "]"]):
        (tmp_path / f"{i}.json").write_text(text)
    paths = [str(tmp_path / f"{i}.json") for i in range(7)]
    assert broken_json_files(spark, paths, lines=False).count() == 7
    assert broken_json_files(spark, paths, lines=True).count() == 7


def test_the_lake_reads_large_arrays_in_splits(spark, tmp_path, small_splits, monkeypatch):  # noqa: F811
    monkeypatch.setattr(L, "ARRAY_BYTES", 2_000)
    small_splits(900)
    for name, n in (("large", 400), ("small", 20)):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"k": i, "text": f"{name} {{{i}}}"} for i in range(n)]))
    (tmp_path / "odd.json").write_text(json.dumps([{"k": 1, "text": "y"}] * 300)[:-1])
    lake = L.Lake(spark, str(tmp_path / "lake"))
    assert lake.ingest([str(tmp_path)], source="s", archive=False) == {"large.json": "success", "odd.json": "failed", "small.json": "success"}
    got = {(r.text.split(" ")[0], r.k): r.text for r in lake.bronze("s").collect()}
    assert got == {(name, i): f"{name} {{{i}}}" for name, n in (("large", 400), ("small", 20)) for i in range(n)}
