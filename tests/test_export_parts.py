"""No part of an export is larger than a bound; parts stay in order and are all in the manifest."""

from pyspark.sql import functions as F

from listwell.operators.export import export_dataset, read_manifest


def test_parts_are_bounded(spark, tmp_path):
    df = spark.range(5000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    version = export_dataset(df, str(tmp_path), key="id", part_bytes=20_000)
    head, files = read_manifest(spark, str(tmp_path / version))
    sizes = [r.length for r in files.collect()]
    assert max(sizes) <= 20_000 and len(sizes) > 40 and head["rows"] == 5000
    assert {p.name for p in (tmp_path / version).rglob("part-*") if p.parent.name in ("parquet", "jsonl")} == {r.path.rsplit("/", 1)[-1] for r in files.collect()}
    bounds = spark.read.parquet(str(tmp_path / version / "parquet")).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("f").collect()
    assert all(x.b < y.a for x, y in zip(bounds, bounds[1:], strict=False)) and bounds[-1].b == 4999
