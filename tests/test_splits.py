"""Files read in splits give the rows of files read whole, wherever the bounds fall."""

import csv
import io
import random

import pytest

from listwell.plans import lake as L
from listwell.sources.readers import FILE, ORDINAL, read_csv
from listwell.sources.splits import read_csv_splits


def rows(df):
    """Cells in the order of the file."""
    return [tuple(r)[:-2] for r in sorted(df.collect(), key=lambda r: (r[FILE], r[ORDINAL]))]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in (("spark.sql.files.maxPartitionBytes", n), ("spark.sql.files.openCostInBytes", 0))]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("seed", "end", "encoding"), [(0, "\n", "UTF-8"), (1, "\r\n", "UTF-8"), (2, "\n", "windows-1251")])
def test_same_rows_as_whole(spark, tmp_path, small_splits, seed, end, encoding):
    rng = random.Random(seed)
    cells = ["", "a", 'q"q', "two" + end + "lines", "x, y", "three" + end + end + "lines", '"', "я", " pad ", "long " * 30 + end, "1.5"]
    for k in range(2):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["a", "b" + end + "b", "c"])
        for _ in range(300):
            writer.writerow([rng.choice(cells) for _ in range(rng.choice([3, 3, 3, 2, 4]))])
            if rng.random() < 0.05:
                out.write(end)
        (tmp_path / f"{k}.csv").write_bytes(out.getvalue().encode(encoding))
    paths, names = [str(tmp_path / f"{k}.csv") for k in range(2)], ["a", "b", "c"]
    want = rows(read_csv(spark, paths, names, encoding=encoding))
    assert len(want) == 600
    for size in (137, 1009, 1 << 20):
        small_splits(size)
        got = read_csv_splits(spark, paths, names, encoding=encoding)
        assert rows(got) == want, size
    assert len({(r[FILE], r[ORDINAL]) for r in got.collect()}) == 600


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text('a,b\n1,"' + "line\n" * 400 + '"\n2,y\n3,"open\nto the end')
    path = [str(tmp_path / "x.csv")]
    want = rows(read_csv(spark, path, ["a", "b"]))
    small_splits(200)
    df = read_csv_splits(spark, path, ["a", "b"])
    assert rows(df)[:2] == want[:2] == [("1", "line\n" * 400), ("2", "y")] and len(rows(df)) == len(want)


def test_stray_quotes_are_read_whole(spark, tmp_path, small_splits):
    (tmp_path / "odd.csv").write_text("a,b\n" + "".join(f'{i},{"5 inch"[: i % 7]}{chr(34) if i in (40, 90) else ""}\n' for i in range(150)))
    (tmp_path / "good.csv").write_text("a,b\n" + "".join(f"{i},g\n" for i in range(150)))
    paths = [str(tmp_path / f"{n}.csv") for n in ("odd", "good")]
    want = rows(read_csv(spark, paths, ["a", "b"]))
    small_splits(300)
    assert rows(read_csv_splits(spark, paths, ["a", "b"])) == want and len(want) == 300


def test_the_lake_splits_large_files(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(L, "SPLIT_BYTES", 2_000)
    small_splits(900)
    for name, n in (("large", 400), ("small", 20)):
        (tmp_path / f"{name}.csv").write_text("k,text\n" + "".join(f'{i},"{name}\nline {i}"\n' for i in range(n)))
    lake = L.Lake(spark, str(tmp_path / "lake"))
    assert lake.ingest([str(tmp_path)], source="s", archive=False) == {"large.csv": "success", "small.csv": "success"}
    got = {(r.text.split("\n")[0], r.k): r.text for r in lake.bronze("s").collect()}
    assert got == {(name, i): f"{name}\nline {i}" for name, n in (("large", 400), ("small", 20)) for i in range(n)}
