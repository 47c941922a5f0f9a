"""What a load leaves behind: kept schemas, replaced partitions, whole headers, and records for whatever fails."""

import pytest

from listwell.functions.inference import fitting_types, shape_histogram
from listwell.operators.mapping import MappingError, parse_mapping
from listwell.operators.schema import KeptSchema
from listwell.plans.lake import Lake
from listwell.sources.manifest import first_records, record_end
from listwell.sources.readers import broken_json_files, read_csv, read_json


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def held(lake, source):
    """Rows in bronze and in quarantine."""
    return lake.bronze(source).count(), lake.quarantine.read().where(f"source = '{source}'").count()


def test_a_source_may_begin_without_rows(lake, tmp_path):
    assert lake.ingest([put(tmp_path, "a.csv", "k,v\n")], source="s") == {"a.csv": "success"}
    assert lake.bronze_sources() == []
    assert lake.ingest([put(tmp_path, "b.csv", "k,v\n1,xxx\n2,xxx\n")], source="s", max_field_bytes=2) == {"b.csv": "partial"}
    assert held(lake, "s") == (0, 2) and dict(lake.bronze("s").dtypes)["k"] == "bigint"
    assert lake.ingest([put(tmp_path, "c.csv", "k,v\n3,yy\n")], source="s") == {"c.csv": "success"}
    assert held(lake, "s") == (1, 2)
    assert lake.transform({"s": '[fields.rooms]\ninput = "k"\ncast = "bigint"\n'})["s"] in ("partial", "success")
    schemas = [r.schema_json for r in lake.log.read().where("stage = 'ingest'").orderBy("started_at").collect()]
    assert schemas == ['{"s": {"k": "string", "v": "string"}}', '{"s": {"k": "bigint", "v": "string"}}', '{"s": {"k": "bigint", "v": "string"}}']


def test_a_source_without_a_kept_schema(lake, tmp_path):
    lake.ingest([put(tmp_path, "a.csv", "k\n1\n")], source="s", archive=False)
    (tmp_path / "lake" / "bronze" / "s" / "_schema").rename(tmp_path / "gone")
    assert dict(lake.bronze("s").dtypes)["k"] == "bigint"
    assert lake.ingest([put(tmp_path, "b.csv", "k,v\n2,x\n")], source="s", archive=False) == {"b.csv": "success"}
    assert {(r.k, r.v) for r in lake.bronze("s").collect()} == {(1, None), (2, "x")}


def test_a_replay_leaves_nothing_of_the_former_run(lake, tmp_path):
    path = put(tmp_path, "r.csv", "k,v\n1,a\n2,bbbb\n")
    for limit, want in ((3, (1, 1)), (0, (0, 2)), (3, (1, 1)), (100, (2, 0))):
        lake.ingest([path], source="s", max_field_bytes=limit, archive=False)
        assert held(lake, "s") == want
    assert lake.ingest([path], source="s") == {"r.csv": "skipped"}


def test_schema_versions(spark, tmp_path):
    kept = KeptSchema(spark, str(tmp_path / "t"))
    one, two = spark.range(1).schema, spark.createDataFrame([], "id long, x string").schema
    assert kept.read() is None
    for s in (one, one, two):
        kept.write(s)
    assert kept.read() == two and len(list((tmp_path / "t" / "_schema").iterdir())) == 2
    (tmp_path / "t" / "_schema" / "v000003").mkdir()  # what a failed write leaves
    assert kept.read() == two


def test_headers_of_any_length(spark, lake, tmp_path):
    names = [f"n{i:04d}_{'x' * 95}" for i in range(900)]
    wide = put(tmp_path / "w", "wide.CSV", "﻿" + ",".join(names) + "\r\n" + ",".join(map(str, range(900))) + "\r\n")
    quoted = put(tmp_path / "w", "quoted.csv", '"a ""b""\n' + "y" * 200_000 + '","c"\n1,2\n')
    assert lake.ingest([str(tmp_path / "w")]) == {"wide.CSV": "success", "quoted.csv": "success"}
    row = lake.bronze("wide").first()
    assert [row[n] for n in names] == list(range(900)) and lake.bronze("quoted").first()["c"] == 2
    files = {p: "UTF-8" for p in (f"file:{wide}", f"file:{quoted}")}
    assert {p: len(h) for p, h in first_records(spark, files, sample=10).items()} == {f"file:{wide}": 900 * 102 - 1, f"file:{quoted}": 200_014}
    assert [record_end(x) for x in (b"", b"a", b"a\n", b'"a\n"\r\nb\n', b'"a\n', b'"a""\n"\n')] == [-1, -1, 1, 4, -1, 6]
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, [wide], ["", " "])
    assert lake.ingest([put(tmp_path, "blank.csv", "\n1,2\n")]) == {"blank.csv": "failed"}
    assert "no header" in lake.log.read().where("source_file = 'blank.csv'").first().error_message


def test_records_tell_files_of_one_name_apart(lake, tmp_path):
    put(tmp_path / "a", "x.jsonl", "[1]\n")
    put(tmp_path / "b", "x.jsonl", '{"k": 1}\n')
    assert lake.ingest([str(tmp_path / "a"), str(tmp_path / "b")]) == {"x.jsonl": "failed"}
    assert {(r.source_path.split("/")[-2], r.status) for r in lake.log.read().collect()} == {("a", "failed"), ("b", "success")}


def test_one_odd_number_rejects_one_row(lake, tmp_path):
    lake.ingest([put(tmp_path, "n.csv", "id,price,area\n1,1.5,40\n2,1e30,40\n3,-1e300,40\n4,7.0,40\n")], source="n")
    mapping = '[meta]\nexternal_id = "id"\n[fields.price_rub]\ninput = "price"\ncast = "decimal"\nunit_convert = { from = "thousands_rub", to = "rub" }\n[fields.area_m2]\ninput = "area"\ncast = "decimal"\n'
    assert lake.transform({"n": mapping}) == {"n": "partial"}
    assert lake.quarantine.read().where("layer = 'silver' AND reason LIKE 'price_rub%'").count() >= 2
    with pytest.raises(MappingError, match="default"):
        parse_mapping('[fields.rooms]\ncast = "bigint"\ndefault = "many"\n')
    with pytest.raises(ValueError, match="no such table"):
        lake.build_gold(["mart_of_nothing"])


def test_json_documents_in_many_partitions(spark, tmp_path):
    for i in range(40):
        put(tmp_path / "j", f"{i:02d}.json", f'[{{"k": {i}}}, {{"k": {i + 1000}}}]')
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        df = read_json(spark, [str(tmp_path / "j")], lines=False)
        assert df.rdd.getNumPartitions() == 40
        assert {(int(r.k) >= 1000, r._row_ordinal) for r in df.collect()} == {(False, 0), (True, 1)}
        texts = {"one": '{"k": 1}', "none": "[]", "broken": '{"k": 1},{"k": 2}', "torn": '[{"k": 1}', "number": "[1]", "blank": " "}
        paths = {name: put(tmp_path / "k", f"{name}.json", text) for name, text in texts.items()}
        assert {r[0].rsplit("/", 1)[-1] for r in broken_json_files(spark, list(paths.values()), lines=False).collect()} == {"broken.json", "torn.json", "number.json"}
        assert [r.k for r in read_json(spark, [paths["one"], paths["none"]], lines=False).collect()] == ["1"]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


VALUES = """1 -5 007 123456789012345678 9223372036854775807 9223372036854775808 -9223372036854775809 1e5 1E400 1e-400 1_000 1__0 _1 .5 5. +.5e3 e5 T t F yes No TRUE E Z W 2020-01-31
2020-02-30 2021-02-29 0000-01-01 20200131 20201331 20200230 12345678 2020-W05-5 2020-W54-1 2020W05 2020W055 2015-W53-7 2020-01-31T10 2020-01-31T10:61 2020-01-31T24:00 2020-01-31T10:59:60
2020-01-31T10:59:59.123456 2020-01-31T10:59:59,12Z 2020-01-31T10:59:59+03:00 2020-02-30T10:00 2020-01-31T1 2020-01-31x ٣ 1,5 abc nan inf 1d 1.5f 2020-1-1 0x10 +5 --5 2020-01-31Z 20200131T10 text long""".split()


def test_examples_fit_what_their_values_fit(spark):
    values = [*VALUES, " 5", "5 ", "\t5", "true ", "2020-01-31 25:00", "9" * 310, "9" * 300 + ".5", "1" + "0" * 60, "1" * 41, "x" * 50]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(fitting_types(_col("v"))).collect()]
    one = spark.createDataFrame([tuple(values)], [f"c{i}" for i in range(len(values))])
    got = {r["at"]: r["fits"] for r in shape_histogram(one, one.columns).select("at", fitting_types(_col("example")).alias("fits")).collect()}
    assert [got[i] for i in range(len(values))] == want
    many = spark.range(50_000).selectExpr("cast(id % 9973 AS string) AS a", "concat(id % 100, '.5') AS b", "concat('some text ', id) AS c", "cast(date_add(date'2020-01-01', cast(id % 365 AS int)) AS string) AS d")
    n = {r["at"]: r["shapes"] for r in shape_histogram(many, many.columns).groupBy("at").agg({"n": "count"}).withColumnRenamed("count(n)", "shapes").collect()}
    assert n == {0: 4, 1: 2, 2: 1, 3: 365}


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)
