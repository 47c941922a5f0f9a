"""Parts that are divided by key: an update touches its buckets alone, and only what is marked counts."""

from pathlib import Path

from listwell.operators.tables import VersionedTable, bucket_of
from listwell.plans.lake import Lake


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_versions_of_buckets(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    table, root = VersionedTable(spark, str(tmp_path), df.schema), tmp_path / "part=a%23b"
    assert table.buckets("a") is None
    first = table.publish_buckets(df, "a", ["id"], 8, whole=True)
    assert len(first) == 8 and table.read().count() == 1000 and table.buckets("a") == 8
    before = files(tmp_path)
    one = df.where(bucket_of(["id"], 8) == 3).selectExpr("id", "v + 100 AS v")
    second = table.publish_buckets(one, "a", ["id"], 8, whole=False)
    assert {p for p in second if second[p] != first[p]} == {"a#3"}
    assert all(files(tmp_path)[p] == t for p, t in before.items()) and len(files(tmp_path)) == len(before) + 1
    assert table.read(parts=["a#3"]).where("v < 100").count() == 0 and table.read(parts=["a"]).count() == 1000 == table.read(first).where("v < 100").count()
    # a version that was never marked is none
    (root.parent / "part=a" / "v000002" / "_update_8").unlink()
    assert table.snapshot() == first
    # a whole version forgets buckets that have no rows any more; other parts and undivided ones stand beside it
    table.publish_buckets(one, "a", ["id"], 4, whole=True)
    table.publish(df.limit(5), "plain")
    assert table.buckets("a") == 4 and table.read().count() == one.count() + 5 and table.snapshot()["plain"] == 1
    assert VersionedTable(spark, str(tmp_path / "none"), df.schema).read().count() == 0


MAPPING = '[meta]\nexternal_id = "id"\n[fields.price_rub]\ninput = "price"\ncast = "decimal"\n[fields.area_m2]\ninput = "area"\ncast = "decimal"\n'


def test_an_update_of_silver(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), silver_buckets=4)

    def load(name, rows):
        (tmp_path / name).write_text("id,price,area\n" + "".join(f"{i},{p},40\n" for i, p in rows))
        lake.ingest([str(tmp_path / name)], source="s", archive=False)
        assert lake.transform({"s": MAPPING})["s"] in ("success", "partial")

    load("a.csv", [(i, 1000 + i) for i in range(200)])
    before = files(tmp_path / "lake" / "silver")
    load("b.csv", [(7, 9000), (7, 9001), (500, 9002)])
    assert len(files(tmp_path / "lake" / "silver")) <= len(before) + 2
    silver = {r.external_id: int(r.price_rub) for r in lake.silver.read().collect()}
    assert len(silver) == 201 and silver["7"] == 9000 and silver["8"] == 1008 and silver["500"] == 9002
    log = lake.log.read().where("stage = 'transform'").orderBy("started_at").collect()
    assert [(r.rows_inserted, r.rows_updated, r.rows_unchanged, r.rows_deduplicated) for r in log] == [(200, 0, 0, 0), (1, 1, 0, 1)]
    # divided anew, all rows are still there
    lake.silver_buckets = 3
    load("c.csv", [(9, 9)])
    assert lake.silver.buckets("s") == 3 and lake.silver.read().count() == 201
