import datetime as dt
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listwell.operators import mapping as M
from listwell.operators.export import export_dataset, next_version, read_manifest
from listwell.operators.quarantine import registry
from listwell.operators.rows import latest_per_key, latest_wins, split_rejects
from listwell.operators.runlog import failed_runs, freshness, latest_status, stage_totals, stale_sources
from listwell.operators.schema import SchemaConflict, added_columns, aligned, merged_schema
from listwell.operators.tables import VersionedTable
from listwell.plans.lake import Lake
from listwell.plans.marts import dynamics_mart, exact_medians, price_area_mart, style_mart
from listwell.sources.manifest import archive_raw, file_manifest

HOUSES = """
[meta]
external_id = "lot"
[fields.price_rub]
input = "asked"
cast = "decimal"
unit_convert = { from = "mln_rub", to = "rub" }
[fields.area_m2]
input = "size"
regex_replace = { pattern = " sqm", replacement = "" }
cast = "decimal"
[fields.rooms]
input = "rooms"
cast = "bigint"
"""


def workbook(path, sheets):
    strings = []
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, rows in enumerate(sheets.values()):
            body = ""
            for n, row in enumerate(rows, 1):
                cells = ""
                for c, v in enumerate(row):
                    if isinstance(v, str):
                        strings.append(v)
                        cells += f'<c r="{chr(65 + c)}{n}" t="s"><v>{len(strings) - 1}</v></c>'
                    elif v is not None:
                        cells += f'<c r="{chr(65 + c)}{n}"><v>{v}</v></c>'
                body += f'<row r="{n}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def put(tmp_path, name, text, encoding="utf-8"):
    (tmp_path / "in").mkdir(exist_ok=True)
    path = tmp_path / "in" / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def test_formats_in_one_batch(lake, tmp_path):
    put(tmp_path, "apartments.csv", 'id;city;area;_note\n1;Москва;45,5;"a ""q""; b"\n2;Казань;60\n3;;1;x;extra\n\n', "cp1251")
    put(tmp_path, "flats.jsonl", '{"id": 1, "location": {"lon": 2, "lat": 1.5}, "balcony": true}\n\n{"id": 2, "rooms": 3, "balcony": false}\n')
    put(tmp_path, "one.json", '[{"a": "x"}, {"a": "", "b": [1, 2]}]')
    put(tmp_path, "single.json", '{"k": "v"}')
    workbook(tmp_path / "in" / "listings.xlsx", {"flats": [[], ["id", "rooms", "price"], [1, 2, "5.5"], [2, None, None], [None, None, None], [3, 4, "6"]], "meta": [["k"], ["v"]], "void": []})
    put(tmp_path, "broken.csv", b"a,b\n\x00\x01\x02")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "badlines.jsonl", '{"a": 1}\n[1]\n')
    put(tmp_path, "notes.txt", "not taken")
    status = lake.ingest([str(tmp_path / "in")])
    assert status == {"apartments.csv": "success", "flats.jsonl": "success", "one.json": "success", "single.json": "success", "listings.xlsx": "success", "broken.csv": "failed", "empty.csv": "failed", "badlines.jsonl": "failed"}
    assert lake.bronze_sources() == ["apartments", "flats", "listings_flats", "listings_meta", "one", "single"]
    csv = lake.bronze("apartments").orderBy("id")
    assert [tuple(r) for r in csv.select("id", "city", "area", "u_note").collect()] == [(1, "Москва", "45,5", 'a "q"; b'), (2, "Казань", "60", None), (3, None, "1", "x")]
    flats = lake.bronze("flats").orderBy("id")
    assert [tuple(r) for r in flats.select("id", "location", "balcony", "rooms").collect()] == [(1, '{"lat":1.5,"lon":2}', True, None), (2, None, False, 3)]
    assert dict(flats.dtypes)["id"] == "bigint" and dict(flats.dtypes)["balcony"] == "boolean"
    assert [tuple(r) for r in lake.bronze("listings_flats").orderBy("id").select("id", "rooms", "price").collect()] == [(1, 2, 5.5), (2, None, None), (3, 4, 6.0)]
    assert [tuple(r) for r in lake.bronze("one").orderBy("_row_ordinal").select("a", "b").collect()] == [("x", None), (None, "[1,2]")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.ingest([str(tmp_path / "nowhere")])


def test_skip_replay_and_late_violation(lake, tmp_path):
    path = put(tmp_path, "v.csv", "val,s\n10,a\n20,b\noops,c\n40,d\n")
    assert lake.ingest([path], infer_rows=2) == {"v.csv": "partial"}
    assert lake.bronze("v").count() == 3 and lake.quarantine.read().count() == 1
    # partial: replayed, nothing is added twice
    assert lake.ingest([path], infer_rows=2) == {"v.csv": "partial"}
    assert lake.bronze("v").count() == 3 and [r.reason for r in lake.quarantine.read().collect()] == ["val: not a bigint"]
    fine = put(tmp_path, "w.csv", "val\n1\n2\n3\n")
    assert lake.ingest([fine]) == {"w.csv": "success"} and lake.ingest([fine]) == {"w.csv": "skipped"}
    assert lake.bronze("w").count() == 3
    for r in lake.log.read().where("status IN ('success', 'partial')").collect():
        assert r.rows_ok + r.rows_quarantined == {"v.csv": 4, "w.csv": 3}[r.source_file]
    assert lake.ingest([put(tmp_path, "x.csv", "val\n5\n")], max_file_bytes=2) == {"x.csv": "failed"}


def test_oversize_and_evolution(lake, tmp_path):
    assert lake.ingest([put(tmp_path, "big.csv", "a,b\n1,x\n2," + "y" * 300_000 + "\n3,z\n")]) == {"big.csv": "partial"}
    reject = lake.quarantine.read().first()
    assert json.loads(reject.raw_record)["_truncated"] is True and "larger" in reject.reason
    (tmp_path / "two").mkdir()
    more = tmp_path / "two" / "big.csv"
    more.write_text("a,b,c\n1.5,q,true\n4,r,false\n")
    assert lake.ingest([str(more)]) == {"big.csv": "partial"}  # the table's bigint holds, 1.5 is a reject
    assert sorted((r.a, r.c) for r in lake.bronze("big").collect()) == [(1, None), (3, None), (4, False)]
    more.write_text("a,b\nword,q\n")
    assert lake.ingest([str(more)]) == {"big.csv": "failed"}
    assert "column a" in lake.log.read().where("status = 'failed'").first().error_message


def test_transform_upsert_rejects_and_reprocess(lake, tmp_path):
    lake.ingest([put(tmp_path, "houses.csv", "lot;asked;size;rooms\n1;8;71 sqm;4\n2;3.1;33.5 sqm;1\n3;0;12 sqm;1\n2;3.2;33.5 sqm;1\n")])
    lake.ingest([put(tmp_path, "other.csv", "id,x\n1,2\n")])
    assert lake.transform({"houses": HOUSES}) == {"houses": "partial", "other": "skipped"}
    rows = lambda: {r.external_id: (r.price_rub, r.area_m2, r.rooms) for r in lake.silver.read().collect()}
    assert rows() == {"1": (Decimal("8000000.00"), Decimal("71.00"), 4), "2": (Decimal("3100000.00"), Decimal("33.50"), 1)}
    assert ["sanity" in r.reason for r in lake.quarantine.read().where("layer = 'silver'").collect()] == [True]
    log = lake.log.read().where("stage = 'transform' AND source_file = 'houses'").first()
    assert (log.rows_ok, log.rows_quarantined, log.rows_deduplicated) == (2, 1, 1)
    assert lake.transform({"houses": HOUSES}, source="houses") == {"houses": "success"}  # nothing pending
    newer = put(tmp_path, "new.csv", "lot;asked;size;rooms\n1;9.5;71 sqm;4\n")
    (tmp_path / "n").mkdir()
    renamed = tmp_path / "n" / "houses.csv"
    renamed.write_bytes(open(newer, "rb").read())
    lake.ingest([str(renamed)])
    assert lake.transform({"houses": HOUSES}, source="houses") == {"houses": "success"}
    assert rows()["1"][0] == Decimal("9500000.00") and len(rows()) == 2
    changed = HOUSES + "\n# edited"
    assert lake.transform({"houses": changed}, source="houses") == {"houses": "failed"}
    pinned = lake.silver.snapshot()
    assert lake.transform({"houses": changed}, source="houses", reprocess=True) == {"houses": "partial"}
    assert lake.quarantine.read().where("layer = 'silver'").count() == 1 and rows()["1"][0] == Decimal("9500000.00")
    assert {r._mapping_config_hash for r in lake.silver.read(pinned).collect()} != {r._mapping_config_hash for r in lake.silver.read().collect()}
    assert lake.transform({"houses": HOUSES.replace('"rooms"\ncast', '"absent"\ncast')}, source="houses", reprocess=True) == {"houses": "failed"}
    assert "absent" in failed_runs(lake.log.read()).first().error_message
    assert {(r.layer, r.n_rejects) for r in registry(lake.quarantine.read()).collect()} == {("silver", 1)}

    counts = lake.build_gold()
    assert counts == {"mart_price_area_by_district": 1, "mart_style_renovation_furniture": 1, "mart_listing_dynamics": 1, "features": 2}
    assert lake.gold("mart_price_area_by_district").first().listing_count == 2
    assert lake.export() == "v001" and lake.export(("parquet",)) == "v002"
    head, files = read_manifest(lake.spark, f"{lake.root}/datasets/v001")
    assert head["rows"] == head["target_nulls"] == 2 and len(head["schema"]) == 26 and files.count() >= 2
    assert head["content"] == read_manifest(lake.spark, f"{lake.root}/datasets/v002")[0]["content"]
    line = json.loads(lake.spark.read.text(f"{lake.root}/datasets/v001/jsonl").orderBy("value").first().value)
    assert line["is_loft"] is None and line["price_rub"] in ("9500000.00", "3100000.00")


def test_empty_lake_builds(lake):
    assert lake.build_gold() == {"mart_price_area_by_district": 0, "mart_style_renovation_furniture": 0, "mart_listing_dynamics": 0, "features": 0}
    assert lake.export() == "v001"


@pytest.mark.parametrize("text", ['[fields.unknown]\ninput="a"', '[fields.rooms]\ncast="int"', '[fields.rooms]\nmagic="x"', '[fields.area_m2]\nunit_convert={from="acre",to="m2"}', '[fields.rooms]\nenum_map="x"', '[fields.rooms]\nregex_replace=["a"]'])
def test_mapping_errors(text):
    with pytest.raises(M.MappingError):
        M.parse_mapping(text)


def test_synthetic_id_default_and_dictionary(spark):
    text = '[fields.price_rub]\ninput="p"\ncast="decimal"\n[fields.area_m2]\ninput="a"\ncast="decimal"\n[fields.has_furniture]\ninput="f"\nenum_map={"Да"=true,"Нет"=false}\n[fields.style]\ninput="s"\ndefault="loft"\n[fields.year_built]\ninput="y"\ncast="bigint"'
    df = spark.createDataFrame([(1.2449167e7, "50", " да", None, 1990), (2.0, "50", "maybe", "x", None), (1.2449167e7, "50", "Да", None, 1990), (1e10, "50", None, None, None)], "p double, a string, f string, s string, y long")
    df = df.selectExpr("*", "'r' as _run_id", "'h' as _content_hash", "timestamp_ntz'2024-01-01' as _ingested_at", "1L as _row_ordinal")
    mapping = M.parse_mapping(text)
    assert M.check_inputs(mapping, [*df.columns, "more"]) == ["column more is not mapped"]
    rows = M.apply_mapping(df, mapping, "s", run_id="t", now=F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz")).select("_reason", "_listing.*").collect()
    assert rows[0].price_rub == Decimal("12449167.00") and rows[0].has_furniture is True and rows[0].style == "loft" and rows[0].id == rows[2].id
    assert rows[1]._reason == "has_furniture: not in dictionary" and "range of its type" in rows[3]._reason


def test_schema_rules(spark):
    s = StructType.fromDDL
    for a, b in [("bigint", "double"), ("double", "bigint"), ("int", "bigint"), ("float", "double")]:
        assert merged_schema(s(f"x {a}"), s(f"x {b}, y string")).simpleString() == f"struct<x:{a},y:string>"
    for a, b in [("bigint", "string"), ("string", "bigint"), ("date", "timestamp"), ("boolean", "bigint")]:
        with pytest.raises(SchemaConflict):
            merged_schema(s(f"x {a}"), s(f"x {b}"))
    assert added_columns(s("a int, b int, c int"), s("b int")) == ["a", "c"] and added_columns(s("a int"), s("a int")) == []
    assert aligned(spark.createDataFrame([("7",)], "x string"), s("x bigint, y string")).collect() == [(7, None)]


def test_latest_wins(spark):
    target = spark.createDataFrame([("e1", 1, "old"), ("e2", 5, "keep")], "k string, t int, v string")
    updates = spark.createDataFrame([("e1", 3, "new"), ("e1", 2, "mid"), ("e2", 5, "equal"), ("e3", 1, "add"), (None, 1, "null key")], "k string, t int, v string")
    got = {r.k: (r.v, r._change) for r in latest_wins(target, updates, ["k"], "t", "v").collect()}
    assert got == {"e1": ("new", "updated"), "e2": ("keep", "unchanged"), "e3": ("add", "inserted"), None: ("null key", "inserted")}
    first = latest_per_key(spark.createDataFrame([("a", 1, 2), ("a", 1, 1), ("b", None, 3)], "k string, t int, o int"), ["k"], "t", "o")
    assert {tuple(r) for r in first.collect()} == {("a", 1, 1), ("b", None, 3)}
    ok, bad = split_rejects(target, [(F.col("t") > 4, "late"), (F.col("v") == "keep", "second rule")])
    assert ok.count() == 1 and [r._reason for r in bad.collect()] == ["late"]


def test_run_log_queries(spark, lake):
    t = dt.datetime(2024, 1, 1)
    lake.log.append([
        {"run_id": "1", "stage": "ingest", "started_at": t, "finished_at": t, "content_hash": "h", "rows_ok": 5, "rows_quarantined": 1, "status": "failed", "error_message": "e"},
        {"run_id": "2", "stage": "ingest", "started_at": t + dt.timedelta(1), "finished_at": t + dt.timedelta(1), "content_hash": "h", "rows_ok": 2, "rows_quarantined": 0, "status": "success"},
        {"run_id": "3", "stage": "transform", "started_at": t, "source_file": "s", "status": "partial", "schema_json": '{"mapping_config_hash": "old"}', "rows_ok": 1, "rows_quarantined": 1},
    ])
    log = lake.log.read()
    assert latest_status(log, "content_hash").where("content_hash = 'h'").first().status == "success"
    assert {tuple(r) for r in stage_totals(log).collect()} == {("ingest", 7, 1), ("transform", 1, 1)}
    assert freshness(log, F.lit(dt.datetime(2024, 1, 2, 0, 1)).cast("timestamp_ntz")).first().age_seconds == 60
    assert failed_runs(log).count() == 1
    assert stale_sources(log, spark.createDataFrame([("s", "new"), ("z", "q")], "source string, fingerprint string")).collect() == [("s", "old", "new")]


def test_marts(spark):
    rows = [("a", "100", "10", " Loft", None, True), ("a", "200", "0", "loft\t", "x", True), (None, "300.01", "3", None, None, None), ("a", None, "7", "LOFT", None, True)]
    df = spark.createDataFrame(rows, "district string, price_rub string, area_m2 string, style string, renovation_style string, has_renovation boolean").selectExpr("* except(price_rub, area_m2)", "cast(price_rub as decimal(12,2)) price_rub", "cast(area_m2 as decimal(8,2)) area_m2", "cast(null as boolean) has_furniture")
    got = {r.district: r for r in price_area_mart(df).collect()}
    assert got["a"].listing_count == 3 and got["a"].median_price_rub == Decimal("150.00") and got["a"].avg_price_per_m2 == Decimal("10.00")
    assert got["unknown"].avg_price_per_m2 == Decimal("100.00")
    styles = {(r.style_norm, r.renovation_style_norm, r.has_renovation): (r.listing_count, r.is_small_sample) for r in style_mart(df, 2).collect()}
    assert styles == {("loft", "none", True): (2, False), ("loft", "x", True): (1, True), ("none", "none", None): (1, True)}
    days = spark.sql("select explode(array(timestamp_ntz'2024-01-01 23:00:00', timestamp_ntz'2024-01-04', timestamp_ntz'2024-01-04 05:00:00', null)) as _ingested_at")
    assert [(str(r[0]), r[1], r[2]) for r in dynamics_mart(days).orderBy("load_date").collect()] == [("2024-01-01", 1, 1), ("2024-01-02", 0, 1), ("2024-01-03", 0, 1), ("2024-01-04", 2, 3)]
    assert {tuple(r) for r in exact_medians(df.fillna("u", ["district"]), ["district"], "price_rub", "m").collect()} == {("a", Decimal("150.00")), ("u", Decimal("300.01"))}


def test_versions_and_export(spark, tmp_path):
    assert [next_version(x) for x in ([], ["v001", "v002", "v003"], ["v001", "v005"], ["v001", "v002", "junk", "v1"], ["v999", "v1000"])] == ["v001", "v004", "v006", "v003", "v1001"]
    table = VersionedTable(spark, str(tmp_path / "t"), StructType.fromDDL("k string, v int"))
    assert table.read().count() == 0
    table.publish(spark.createDataFrame([("a", 1)], "k string, v int"), "src/ä b=1")
    pinned = table.snapshot()
    table.publish(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), "src/ä b=1")
    table.publish(spark.createDataFrame([("c", 4)], "k string, v int"), "other")
    assert sorted(r.v for r in table.read().collect()) == [2, 3, 4] and [r.v for r in table.read(pinned).collect()] == [1]
    df = spark.createDataFrame([(str(i), Decimal("1234.56"), dt.datetime(2024, 1, 1), dt.date(2024, 1, 2)) for i in range(50)], "id string, d decimal(12,2), t timestamp_ntz, day date")
    assert export_dataset(df, str(tmp_path / "d")) == "v001"
    line = json.loads(spark.read.text(str(tmp_path / "d/v001/jsonl")).first().value)
    assert line["d"] == "1234.56" and line["t"].startswith("2024-01-01T00:00:00") and line["day"] == "2024-01-02"
    assert export_dataset(df.limit(0), str(tmp_path / "d")) == "v002"


def test_manifest_and_archive(spark, tmp_path):
    a, b = put(tmp_path, "a.csv", "x\n1\n"), put(tmp_path, "copy of a.csv", "x\n1\n")
    rows = file_manifest(spark, [a, b]).collect()
    assert len(rows) == 2 and len({r.content_hash for r in rows}) == 1
    assert archive_raw(spark, [a, b], str(tmp_path / "raw")).count() == 1 and archive_raw(spark, [a], str(tmp_path / "raw")).count() == 0


def test_publish_goes_on_after_a_failed_write(spark, tmp_path):
    df = spark.range(3)
    table = VersionedTable(spark, str(tmp_path / "t"), df.schema)
    table.publish(df)
    broken = df.select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        table.publish(broken)
    assert table.read().count() == 3
    table.publish(df.limit(1))
    assert table.read().count() == 1


@pytest.mark.parametrize("text", ["[fields", "", "[fields]", "[meta]\nexternal_id='x'", "[fields.rooms]\nenum_map = {}", "fields = 3", "[fields]\nrooms = 1"])
def test_mappings_without_meaning_are_errors(text):
    with pytest.raises(M.MappingError):
        M.parse_mapping(text)


def test_values_of_uncast_fields_are_rejects(lake, tmp_path):
    """Text where a number is due sends its row to quarantine; the run goes on, with a record for each source."""
    put(tmp_path, "a.csv", "id,price,area\n1,5,40\n2,much,40\n3,7,wide\n")
    put(tmp_path, "b.csv", "id,price,area\n1,5,40\n9,9,9\n")
    lake.ingest([str(tmp_path / "in")])
    plain = """
[meta]
external_id = "id"
[fields.price_rub]
input = "price"
unit_convert = { from = "rub", to = "rub" }
[fields.area_m2]
input = "area"
"""
    assert lake.transform({"a": plain, "b": plain.replace('"area"', '"nowhere"')}) == {"a": "partial", "b": "failed"}
    assert lake.silver.read().count() == 1 and lake.quarantine.read().where("layer = 'silver'").count() == 2
    assert {(r.source_file, r.status) for r in lake.log.read().where("stage = 'transform'").collect()} == {("a", "partial"), ("b", "failed")}


def test_a_beginning_may_decide_the_types(lake, tmp_path):
    put(tmp_path, "v.csv", "val\n10\n20\noops\n40\n")
    lake.ingest([str(tmp_path / "in")], infer_rows=2)
    assert lake.bronze("v").count() == 3 and lake.quarantine.read().count() == 1
