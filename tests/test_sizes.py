"""Queries where tables are larger than those of the tests: splits without rows, many files, more rows than a file holds."""

import duckdb
import pytest

from listwell import queries as Q
from listwell.operators import export
from listwell.operators.mapping import apply_mapping, parse_mapping
from listwell.sources.manifest import ARCHIVE, archive_raw, file_manifest

SF = "/root/testdata/sf0.01"


def same_rows(spark, name, sf=SF):
    df = Q.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "events"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(Q.ORACLES[name])
    have = [d[0] for d in want.description]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r[c] for c in have) for r in df.collect()), key=key) == sorted(want.fetchall(), key=key)


@pytest.fixture
def small_splits(spark):
    """A row group takes many splits, the first of which have none of its rows."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("name", ["ingest_json", "pruned_scan", "runs_after_failure", "empty_first_file"])
def test_first_split_without_rows(spark, small_splits, name):
    assert same_rows(spark, name)


def test_many_files_need_few_folders(spark, tmp_path):
    Q._supplier_files(spark, SF, str(tmp_path / "in"))
    found = [p for p in (tmp_path / "in").iterdir() if not p.name.startswith((".", "_"))]
    assert len(found) == 100 and all(p.is_file() for p in found)
    assert all(p.read_bytes().startswith(b"id,name\n") and p.read_bytes().count(b"\n") == 2 for p in found)
    (tmp_path / "in" / "empty.CSV").write_bytes(b"")
    assert file_manifest(spark, [str(tmp_path / "in")]).where("bytes = 0 AND suffix = 'csv'").count() == 1


def test_archive_has_no_folder_for_each_content(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    for i in range(6):
        (files / f"{i}.csv").write_text(f"a\n{i % 4}\n")
    new = tmp_path / "new"
    assert archive_raw(spark, [str(files)], str(new)).count() == 4 and archive_raw(spark, [str(files)], str(new)).count() == 0
    (files / "7.csv").write_text("a\n7\n")
    assert archive_raw(spark, [str(files)], str(new)).count() == 1
    held = lambda path: sorted(bytes(r[0]) for r in spark.read.schema(ARCHIVE).parquet(str(path)).where("sha2(content, 256) = content_hash").select("content").collect())
    assert held(new) == [f"a\n{i}\n".encode() for i in (0, 1, 2, 3, 7)]
    assert not [p for p in new.iterdir() if p.is_dir()]
    # an archive of former times
    old = tmp_path / "old"
    spark.read.schema(ARCHIVE).parquet(str(new)).where("content <> cast('a\n7\n' AS binary)").write.partitionBy("content_hash").parquet(str(old))
    assert len(held(old)) == 4 and archive_raw(spark, [str(files)], str(old)).count() == 1 and len(held(old)) == 5


def test_a_customer_in_several_files_counts_once(spark, monkeypatch):
    monkeypatch.setattr(Q, "FILE_ROWS", 700)
    assert same_rows(spark, "change_counts")


def test_files_are_bounded_by_cells(spark, tmp_path):
    Q._csv_files(spark.range(10_000).select("id", *((Q.F.col("id") + i).alias(f"c{i}") for i in range(1, 2000))), str(tmp_path / "in"), "id")
    files = list((tmp_path / "in").glob("part-*"))
    assert len(files) >= 5 and all(sum(1 for _ in p.open()) <= 2001 for p in files)


def test_a_mapping_works_out_each_value_once(spark):
    bronze = spark.range(10).selectExpr("id AS o_orderkey", "id * 1.5D AS o_totalprice", "'F' AS o_orderstatus", "id AS area", "'r' AS _run_id", "'h' AS _content_hash", "timestamp_ntz'2024-01-01' AS _ingested_at", "id AS _row_ordinal")
    mapped = apply_mapping(bronze, parse_mapping(Q._PRICES), "s", run_id="r", now=Q.F.lit("2024-01-01").cast("timestamp_ntz"))
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(38,10)") <= 4


@pytest.mark.parametrize(("name", "least"), [("replayed_files", 15), ("quarantined_rows", 15), ("listing_flow", 8)])
def test_files_follow_the_rows(spark, monkeypatch, name, least):
    """A table's files are written, and read, by as many tasks as its rows ask for."""
    seen = []
    ingest = Q.Lake.ingest
    monkeypatch.setattr(Q, "TASK_ROWS", 1000)
    monkeypatch.setattr(Q.Lake, "ingest", lambda self, *a, **b: seen.append(ingest(self, *a, **b)) or seen[-1])
    assert same_rows(spark, name) and all(len(s) >= least for s in seen)


def test_documents_are_in_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert same_rows(spark, "json_documents")
    found = list((tmp_path / "documents" / "in").glob("*.json"))
    assert len(found) >= 10 and all(p.read_bytes().startswith(b"[\n{") and p.read_bytes().count(b"\n") <= 1002 for p in found)


def test_only_partitions_that_are_there_are_dropped(spark, tmp_path, monkeypatch):
    (tmp_path / "k=1").mkdir()
    (tmp_path / "k=x").mkdir()
    dropped, delete = [], export.delete_folder
    monkeypatch.setattr(export, "delete_folder", lambda spark, path: dropped.append(path) or delete(spark, path))
    export.clear_partitions(spark, str(tmp_path), "k", [str(i) for i in range(1000)])
    export.clear_partitions(spark, str(tmp_path / "none"), "k", ["1"])
    assert len(dropped) == 1 and [p.name for p in tmp_path.iterdir()] == ["k=x"]
