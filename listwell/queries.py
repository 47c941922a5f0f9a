"""Registered queries for the lakehouse operators, on the given tables, and the SQL that checks them.

The tables stand in for listings: parts and line items for priced objects, events for an append-only log, customers for a
source of files. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import primitives as P
from .functions.inference import infer_types
from .functions.names import with_clean_names
from .functions.primitives import record_json
from .operators import rows as R
from .operators.dictionary import dictionary, looked_up
from .operators.export import content_fingerprint, export_dataset, read_manifest
from .operators.mapping import Field, field_value
from .operators.quarantine import registry, reject_rows
from .operators.runlog import failed_runs, freshness, latest_status, stage_totals, stale_sources
from .operators.schema import added_columns, aligned, merged_schema
from .operators.tables import VersionedTable, bucket_of
from .plans.features import floor_ratio
from .plans.lake import Lake
from .plans.marts import MONEY, daily_counts, dynamics_mart, exact_medians, price_area_mart, price_per_area, style_mart
from .sources.manifest import ARCHIVE, archive_raw, file_manifest, refusal
from .sources.readers import workbook_rows
from .sources.workbooks import with_workbooks
from .storage import rename_files, scratch_path

SMALL = "decimal(8,2)"
#: Columns that a pivoted table may have.
MOST_COLUMNS = 10_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as listings: price, area, two style texts and two flags."""
    item = _table(spark, sf_dir, "lineitem")
    return item.select(
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("district"),
        F.col("l_extendedprice").cast(MONEY).alias("price_rub"),
        F.col("l_quantity").cast(SMALL).alias("area_m2"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("_ingested_at"),
    )


# -- marts ---------------------------------------------------------------------------------------------------------


def mart_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and area mart, with parts by brand as the listings."""
    part = _table(spark, sf_dir, "part")
    return price_area_mart(part.select(F.col("p_brand").alias("district"), F.col("p_retailprice").alias("price_rub"), F.col("p_size").alias("area_m2")))


def mart_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart over line items: few groups with many rows."""
    return price_area_mart(_listings(spark, sf_dir))


#: Exact in whole cents, halves up, for values that aren't negative.
_RATIO = "(((200 * (p * 100)::BIGINT + (a * 100)::BIGINT) // nullif(2 * (a * 100)::BIGINT, 0))::DOUBLE / 100)::DECIMAL(12,2)"
_MEDIAN = "(floor(quantile_cont((p * 100)::BIGINT::DOUBLE, 0.5) + 0.5) / 100)::DECIMAL(12,2)"


def _summary_sql(rows: str) -> str:
    mean = lambda v, n: f"(((2 * sum(({v} * 100)::BIGINT) + count({v})) // (2 * count({v})))::DOUBLE / 100)::DECIMAL({n},2)"
    return f"""
WITH b AS (SELECT k, p, a, {_RATIO} AS pm FROM ({rows}))
SELECT coalesce(k, 'unknown') AS district, count(*)::BIGINT AS listing_count, {mean("p", 12)} AS avg_price_rub, {_MEDIAN} AS median_price_rub,
       min(p) AS min_price_rub, max(p) AS max_price_rub, {mean("pm", 12)} AS avg_price_per_m2, {mean("a", 8)} AS avg_area_m2
FROM b GROUP BY 1"""


def median_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of large groups: ranges first, ranks within the middle ones."""
    return exact_medians(_listings(spark, sf_dir), ["district"], "price_rub", "median_price_rub")


def mart_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return style_mart(
        orders.select(F.concat(F.lit(" "), "o_orderpriority").alias("style"), F.nullif("o_orderstatus", F.lit("P")).alias("renovation_style"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus") == "F").alias("has_renovation"),
                      (F.year("o_orderdate") >= 2000).alias("has_furniture"), F.col("o_totalprice").alias("price_rub"), F.dayofmonth("o_orderdate").alias("area_m2")),
        small_sample=70,
    )


def mart_dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases above a value by day, without gaps, with the running total."""
    return dynamics_mart(_table(spark, sf_dir, "events").where("event_type = 'purchase' AND value > 100"), "ts")


def daily_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(_table(spark, sf_dir, "events"), "ts")


def panel_selected_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel: the mart of chosen groups, largest first."""
    return mart_large_groups(spark, sf_dir).where(F.col("district").isin("A-F", "N-O")).select("district", "listing_count", "min_price_rub", "max_price_rub").orderBy(F.col("listing_count").desc(), "district")


def distinct_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(F.coalesce("p_brand", F.lit("unknown")).alias("district")).distinct().orderBy("district")


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level features: price for each unit, ratio with a zero guard, untouched target."""
    item = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast(MONEY).alias("price_rub"), F.col("l_quantity").cast(SMALL).alias("area_m2"), F.col("l_linenumber").alias("floor"), (F.col("l_linenumber") % 3).alias("floors_total"))
    return item.select("l_orderkey", "l_linenumber", price_per_area().alias("price_per_m2"), floor_ratio().alias("floor_ratio"), F.lit(None).cast("boolean").alias("is_loft"))


def target_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_rows(spark, sf_dir).agg(F.count_if(F.col("is_loft").isNull()).alias("null_targets"), F.count_if(F.col("floor_ratio").isNull()).alias("null_ratios"))


# -- primitives ----------------------------------------------------------------------------------------------------


def text_primitives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, extract, casts, unit conversion and key normalisation on parts."""
    part = _table(spark, sf_dir, "part")
    price = F.format_string("%.2f", "p_retailprice")
    return part.select(
        "p_partkey",
        P.cast_bigint(P.regex_extract(F.col("p_brand"), r"#(\d+)")[0])[0].alias("brand_no"),
        P.regex_replace(F.col("p_name"), r"(\w+) (\w+)", r"\2-\1")[0].alias("turned"),
        P.unit_convert(P.cast_decimal(price)[0], "thousands_rub", "rub")[0].alias("price_rub"),
        P.cast_bigint(price)[1].alias("not_an_integer"),
        P.text_key(F.concat(F.lit("\t"), "p_type", F.lit(" "))).alias("type_key"),
    )


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    return events.select("event_id", F.try_variant_get("v", "$.k", "string").try_cast("bigint").alias("k"), F.get_json_object("props", "$.k").alias("k_text"))


def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the first rule that they break: range, mandatory field, size."""
    events = _table(spark, sf_dir, "events")
    ok, bad = R.split_rejects(events, [(F.col("value") > 300, "value above 300"), (F.col("value") < 0.1, "value below 0.1"), (F.nullif("event_type", F.lit("error")).isNull(), "event_type is missing"), (R.oversize(["props"], 9), "props too long")])
    every = ok.withColumn(R.REASON, F.lit("valid")).unionByName(bad)
    return every.groupBy(F.col(R.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def dictionary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    value, missed = P.enum_map(F.concat(F.lit(" "), F.lower("o_orderstatus")), {"F": True, "O": False})
    return orders.groupBy(value.alias("finished"), missed.alias("missed")).agg(F.count(F.lit(1)).alias("n"))


def dictionary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of some size as the dictionary of line items: the type of each, or the reason why there is none."""
    entries = dictionary(_table(spark, sf_dir, "part").where("p_size > 10"), "p_partkey", "p_type")
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "R", F.concat(F.lit(" "), F.col("l_partkey").cast("string"))).alias("part"))
    return looked_up(items, "part", entries, name="type").select("l_orderkey", "l_linenumber", "type", F.col(R.REASON).alias("reason"))


def boolean_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    word = F.when(F.col("o_orderstatus") == "F", " Да").when(F.col("o_orderstatus") == "O", "NO").otherwise("y")
    value, failed = P.cast_boolean(word)
    return orders.groupBy("o_orderstatus").agg(F.first(value).alias("value"), F.first(failed).alias("failed"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", P.stable_id(F.col("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("id"))


def synthetic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of rows without an id column, from their fields; a null shows as None."""
    part = _table(spark, sf_dir, "part")
    basis = P.fields_text({"size": F.col("p_size"), "brand": F.col("p_brand"), "name": F.nullif("p_name", F.lit("red widget"))})
    return part.select("p_partkey", basis.alias("basis"), P.stable_id(F.lit("part"), basis).alias("id"))


def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts pivoted by brand, under clean names of the brands, and turned back into rows: a header that the data give."""
    part = _table(spark, sf_dir, "part")
    brands = [r[0] for r in part.select("p_brand").distinct().orderBy("p_brand").limit(MOST_COLUMNS + 1).collect()]  # a header, not rows
    if len(brands) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} brands: too many for columns")
    wide = with_clean_names(part.groupBy().pivot("p_brand", brands).agg(F.count(F.lit(1))))
    return wide.unpivot([], wide.columns, "clean", "n")


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of line items as text, inferred back in one pass."""
    item = _table(spark, sf_dir, "lineitem")
    text = item.select(*((F.date_format(c, "yyyy-MM-dd") if t.startswith("timestamp") else F.col(c).cast("string")).alias(c) for c, t in item.dtypes))
    return spark.createDataFrame(list(infer_types(text).items()), "column_name string, type string")


# -- row operators -------------------------------------------------------------------------------------------------


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest_per_key(_table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later balance wins, an equal version doesn't, an unknown customer is added."""
    base = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.lit(1).alias("version"))
    orders = _table(spark, sf_dir, "orders")
    updates = orders.select((F.col("o_custkey") + F.when(F.col("o_orderstatus") == "P", 1_000_000).otherwise(0)).alias("c_custkey"), F.col("o_totalprice").alias("balance"), F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1).alias("version"), "o_orderkey")
    return R.latest_wins(base, updates, ["c_custkey"], "version", "o_orderkey").select("c_custkey", "balance", "version", F.col("_change").alias("change"))


def pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pending(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), ["doc_id"])


def reconciled_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers aligned to the table of customers: missing columns null, a new one added, existing types kept."""
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    suppliers = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("double").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("nation"))
    schema = merged_schema(customers.schema, suppliers.schema)
    return aligned(customers, schema).unionByName(aligned(suppliers, schema))


# -- run log -------------------------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log: five stages, some failed."""
    events = _table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.col("ts").cast("timestamp_ntz").alias("started_at"), (F.col("ts") + F.expr("interval 5 minutes")).cast("timestamp_ntz").alias("finished_at"),
        F.concat(F.lit("u"), "user_id").alias("source_file"), F.col("user_id").cast("string").alias("content_hash"), k.alias("rows_ok"), (k % 7).alias("rows_quarantined"), F.concat(F.lit('{"mapping_config_hash": "'), (k % 2).cast("string"), F.lit('"}')).alias("schema_json"),
        F.when(k < 20, "failed").when(k % 7 > 0, "partial").otherwise("success").alias("status"), F.when(k < 20, F.concat(F.lit("k="), k.cast("string"))).alias("error_message"),
    )


_LOG_SQL = """(SELECT event_id::VARCHAR AS run_id, event_type AS stage, ts AS started_at, ts + INTERVAL 5 MINUTE AS finished_at, 'u' || user_id AS source_file, user_id::VARCHAR AS content_hash,
 json_extract_string(props, '$.k')::BIGINT AS rows_ok, json_extract_string(props, '$.k')::BIGINT % 7 AS rows_quarantined, (json_extract_string(props, '$.k')::BIGINT % 2)::VARCHAR AS hash,
 CASE WHEN json_extract_string(props, '$.k')::BIGINT < 20 THEN 'failed' WHEN json_extract_string(props, '$.k')::BIGINT % 7 > 0 THEN 'partial' ELSE 'success' END AS status,
 CASE WHEN json_extract_string(props, '$.k')::BIGINT < 20 THEN 'k=' || json_extract_string(props, '$.k') END AS error_message FROM events)"""


def runs_latest_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_status(_log(spark, sf_dir), "stage").select("stage", "status", "finished_at")


def runs_latest_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_status(_log(spark, sf_dir), "content_hash", "stage").select("content_hash", "stage", "run_id", "status")


def runs_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_totals(_log(spark, sf_dir).where("started_at >= timestamp_ntz'2024-01-05' AND started_at <= timestamp_ntz'2024-01-25'"))


def runs_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age at a fixed moment, so that reruns agree."""
    return freshness(_log(spark, sf_dir), F.expr("timestamp_ntz'2024-02-01'"))


def runs_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest 200 failures: a report of fixed length."""
    return failed_runs(_log(spark, sf_dir), 200)


def runs_stale_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("stage", F.lit("transform"))
    current = _table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("source"), F.lit("1").alias("fingerprint")).distinct()
    return stale_sources(log, current)


def quarantine_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn("_content_hash", F.col("user_id").cast("string"))
    _, bad = R.split_rejects(events, [(F.col("value") > 100, "too high")])
    parts = [reject_rows(bad.where(F.col("event_type") == t), ["event_id", "value"], layer=layer, source=t, run_id="r", now=F.col("ts").cast("timestamp_ntz")) for layer, t in (("bronze", "click"), ("silver", "view"))]
    return registry(parts[0].unionByName(parts[1]))


# -- files, versions, flows ----------------------------------------------------------------------------------------


#: Rows, and cells, of a file that a query writes: files stay far below the size from which they are refused.
FILE_ROWS, FILE_CELLS = 500_000, 4_000_000


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ranges of ``key``, as many as there is work: the first range is never empty, however the scan was split,
    so that no file without rows is written."""
    return df.repartitionByRange(key)


#: Rows of a table that one task writes.
TASK_ROWS = 200_000


def _spread(df: DataFrame, key: str, least: int = 2) -> DataFrame:
    """Rows dealt by the hash of ``key`` to tasks that follow their number, ``least`` of them at least: each writes files of
    its own, and each of these is read by a task."""
    return df.repartition(max(least, -(-df.count() // TASK_ROWS)), key)


def _csv_files(df: DataFrame, path: str, key: str | None = None, **options) -> None:
    rows = max(1, min(FILE_ROWS, FILE_CELLS // len(df.columns)))
    (df if key is None else _dealt(df, key)).write.options(header=True, maxRecordsPerFile=rows, **options).csv(path)


def _taken(status: dict[str, str], *allowed: str) -> None:
    """An error if a file was not taken in as it should be."""
    if not status or set(status.values()) - set(allowed or ("success",)):
        raise RuntimeError(f"files not taken in: {status}")


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV files and taken in again as one source: names, types and rows come back."""
    root = scratch_path(spark, "ingest")
    _csv_files(_spread(_table(spark, sf_dir, "customer"), "c_custkey", 3), f"{root}/in")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="customers"))
    return lake.bronze("customers").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines with a nested object, taken in as typed columns."""
    root = scratch_path(spark, "ingest")
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.struct(F.col("user_id").alias("b"), F.lit("x").alias("a")).alias("nested"))
    _dealt(events, "event_id").write.option("maxRecordsPerFile", FILE_ROWS).json(f"{root}/in")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="events", archive=False, json_lines=True))
    return lake.bronze("events").select("event_id", "event_type", "value", "nested")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of 1,000 events, one file each, laid out over several lines: a document is parsed whole."""
    root = scratch_path(spark, "documents")
    events = _table(spark, sf_dir, "events").select((F.col("event_id") / 1000).cast("bigint").alias("file"), F.struct("event_id", "event_type", F.nullif("user_id", F.lit(7)).alias("user_id")).alias("e"))
    arrays = _dealt(events, "file").groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list("e")), lambda e: F.to_json(e)), ",\n").alias("body"))
    # all files are in one folder, and tasks move those that they wrote themselves
    options = {"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    arrays.select(F.concat(F.lit("[\n"), "body", F.lit("\n]")).alias("value")).write.options(**options).text(f"{root}/text")
    rename_files(spark, f"{root}/text", f"{root}/in", "json")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="events", archive=False))
    return lake.bronze("events").select("event_id", "event_type", "user_id")


def csv_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in an old charset, parted by semicolons, with decimal commas, quoted delimiters, line breaks in a quoted name
    of the header, and rows whose cells are all empty: found out from the file, mapped to numbers."""
    root = scratch_path(spark, "dialects")
    customer = _table(spark, sf_dir, "customer")
    filled = F.col("c_custkey") % 10 > 0
    value = lambda c: F.when(filled, c)
    rows = customer.select(
        value(F.col("c_custkey").cast("string")).alias("ключ"), value(F.concat(F.lit("Имя; "), "c_name")).alias("имя\nполное"), value(F.replace(F.format_string("%.2f", "c_acctbal"), F.lit("."), F.lit(","))).alias("остаток")
    )
    lake = Lake(spark, f"{root}/lake")
    _csv_files(rows.repartition(3), f"{root}/in", sep=";", encoding="windows-1251", emptyValue="", quoteAll=False)
    _taken(lake.ingest([f"{root}/in"], source="customers"))
    bronze = lake.bronze("customers")
    key, name, rest = (F.col(f"`{c}`") for c in [c for c in bronze.columns if not c.startswith("_")][:3])
    return bronze.select(key.alias("c_custkey"), name.alias("name"), P.cast_decimal(P.regex_replace(rest, ",", ".")[0])[0].alias("balance"))


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as workbooks of 4,000 rows, made in tasks and read again: shared strings, numbers, booleans, dates by style."""
    orders = _table(spark, sf_dir, "orders")
    numbered = orders.select((F.col("o_orderkey") / 4000).cast("bigint").alias("book"), "o_orderkey", "o_orderpriority", F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).alias("day"), (F.col("o_orderstatus") == "F").alias("done"))
    books = numbered.groupBy("book").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "day", "done"))).alias("rows"))
    cells = workbook_rows(with_workbooks(books))
    below = cells.where("row_no > 1").select(*(F.get("cells", i).alias(c) for i, c in enumerate(("o_orderkey", "priority", "ordered", "done"))))
    return below.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "priority", "ordered", "done")


def file_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each supplier: content hash, size, and why some are refused (binary, too large)."""
    root = scratch_path(spark, "files")
    _supplier_files(spark, sf_dir, f"{root}/in")
    files = file_manifest(spark, [f"{root}/in"], max_bytes=MOST_BYTES)
    return files.withColumn("refusal", refusal(MOST_BYTES)).select("bytes", "content_hash", "refusal")


#: A small limit for the files of suppliers.
MOST_BYTES = 60


def _supplier_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A CSV file for each supplier, all in one folder: a header and a row, bytes as they are."""
    kind = F.col("s_suppkey") % 5
    name = F.when(kind == 1, F.lit("\0")).when(kind == 2, F.lpad("s_name", 80, "x")).otherwise(F.col("s_name"))
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), name.alias("name"))
    # tasks move the files that they wrote themselves: the driver would do so one by one
    options = {"header": True, "maxRecordsPerFile": 1, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    rows.repartitionByRange(max(2, spark.sparkContext.defaultParallelism), "id").write.options(**options).csv(path)


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are archived byte for byte, once for each content, however often they come; archived twice here."""
    root = scratch_path(spark, "archive")
    _supplier_files(spark, sf_dir, f"{root}/in")
    for _ in range(2):
        archive_raw(spark, [f"{root}/in"], f"{root}/raw")
    return spark.read.schema(ARCHIVE).parquet(f"{root}/raw").select("content_hash", F.decode("content", "UTF-8").alias("content"), (F.sha2("content", 256) == F.col("content_hash")).alias("intact"))


_PRICES = """
[meta]
external_id = "o_orderkey"
[fields.price_rub]
input = "o_totalprice"
cast = "decimal"
[fields.area_m2]
input = "area"
cast = "decimal"
default = 50
[fields.district]
input = "o_orderstatus"
enum_map = { F = "finished", O = "open" }
"""


def _price_flow(spark: SparkSession, sf_dir: str, name: str, mapping: str = _PRICES) -> tuple[Lake, str]:
    """(lake, folder of files): orders as files of one source, taken in and transformed. A status of P is in no dictionary,
    every seventh area is missing."""
    root = scratch_path(spark, name)
    area = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey") % 90 + 1)
    _csv_files(_spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", area.alias("area")), "o_orderkey"), f"{root}/in")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="prices"))
    lake.transform({"prices": mapping})
    return lake, f"{root}/in"


def replayed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come again are skipped, and a reprocessed source is as it was: every order once."""
    lake, files = _price_flow(spark, sf_dir, "replay")
    again = lake.ingest([files], source="prices")
    _taken(again, "skipped")
    unchanged = lake.transform({"prices": _PRICES})
    lake.transform({"prices": _PRICES}, source="prices", reprocess=True)
    runs = lake.log.read().groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n")).groupBy().agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "stage", "status"))), ",").alias("seen"))
    rows = lake.bronze("prices").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("in_bronze"))
    silver = lake.silver.read().groupBy(F.col("external_id").cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("area_m2").alias("area_m2"), F.max("district").alias("district"))
    joined = rows.join(silver, F.col("o_orderkey") == F.col("key"), "left").crossJoin(F.broadcast(runs))  # one row
    return joined.select("o_orderkey", "in_bronze", F.coalesce("n", F.lit(0)).alias("in_silver"), "area_m2", "district", "seen", F.lit(unchanged["prices"]).alias("unchanged"))


def replayed_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with rejects come again under another size limit: at first long statuses are rejects, then nothing is, or all is.
    Bronze and quarantine hold each row once after every step."""
    root = scratch_path(spark, "partial")
    status = F.when(F.col("o_orderstatus") == "P", F.repeat("o_orderstatus", F.lit(40))).otherwise(F.col("o_orderstatus"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))
    _csv_files(_spread(orders, "o_orderkey"), f"{root}/in")
    steps = []
    for source, limits in (("to_none", (30, 200_000)), ("to_all", (30, 0))):
        lake = Lake(spark, f"{root}/{source}")
        for at, limit in enumerate(limits):
            _taken(lake.ingest([f"{root}/in"], source=source, max_field_bytes=limit, archive=False), "success", "partial")
            held = lake.bronze(source).agg(F.count(F.lit(1)).alias("in_bronze"), F.count_distinct("o_orderkey").alias("keys"))
            rejects = lake.quarantine.read().agg(F.count(F.lit(1)).alias("in_quarantine"), F.count_distinct("raw_record").alias("records"))
            counted = held.crossJoin(rejects).first()  # one row each
            steps.append((source, at, counted["in_bronze"], counted["in_quarantine"], counted["keys"] + counted["records"] == orders.count()))
    return spark.createDataFrame(steps, "source string, step int, in_bronze long, in_quarantine long, balanced boolean")


def empty_first_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source whose first file is a header alone and whose second has nothing but rejects takes in the third as if it were the first."""
    root = scratch_path(spark, "first")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    _csv_files(orders.limit(0).coalesce(1), f"{root}/header")
    _csv_files(orders.where("o_orderstatus = 'P'"), f"{root}/rejects", "o_orderkey")
    _csv_files(orders, f"{root}/rows", "o_orderkey")
    lake, states = Lake(spark, f"{root}/lake"), []
    for folder, limit in (("header", 200_000), ("rejects", 0), ("rows", 200_000)):
        states += sorted({*lake.ingest([f"{root}/{folder}"], source="orders", max_field_bytes=limit, archive=False).values()})
    rejected = lake.quarantine.read().count()
    return lake.bronze("orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.lit(",".join(states)).alias("states"), F.lit(rejected).alias("rejected"))


#: Columns of a wide file; their names take more than the beginning of a file that is looked at first.
WIDE_COLUMNS, WIDE_NAME = 800, 100


def wide_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a file with so many long column names, some with line breaks, that its header is larger than a sample."""
    root = scratch_path(spark, "wide")
    name = lambda i: f"{'line' + chr(10) + 'break' if i % 100 == 0 else 'column'} {i} {'x' * WIDE_NAME}"
    rows = _table(spark, sf_dir, "supplier").select("s_suppkey", *((F.col("s_suppkey") * i).alias(name(i)) for i in range(1, WIDE_COLUMNS)), F.col("s_name").alias("the last name"))
    _csv_files(rows, f"{root}/in", "s_suppkey", quoteAll=True)
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="suppliers", archive=False))
    bronze = lake.bronze("suppliers")
    columns = [c for c in bronze.columns if not c.startswith("_")]
    total = F.aggregate(F.array(*(F.col(f"`{c}`") for c in columns[1:-1])), F.lit(0).cast("long"), lambda a, x: a + x)
    return bronze.select("s_suppkey", total.alias("total"), F.col("the_last_name").alias("s_name"), F.lit(len(columns)).alias("n_columns"))


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a transform with their records and reasons, after a mapping that rejects other rows was put in its place."""
    lake, _ = _price_flow(spark, sf_dir, "rejects")
    lake.transform({"prices": _PRICES.replace('F = "finished"', 'P = "pending"')}, source="prices", reprocess=True)
    rejects = lake.quarantine.read().where("layer = 'silver'")
    field = lambda name: F.get_json_object("raw_record", f"$.{name}")
    return rejects.select(field("o_orderkey").cast("bigint").alias("o_orderkey"), field("o_orderstatus").alias("status"), field("area").alias("area"), "reason", "source")


def balance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each stage of a flow, rows that came in, were taken, rejected, and taken over by a later row: nothing is lost."""
    lake, _ = _price_flow(spark, sf_dir, "balance")
    totals = lake.log.read().groupBy("stage").agg(F.sum("rows_ok").alias("ok"), F.sum("rows_quarantined").alias("rejected"), F.sum(F.coalesce("rows_deduplicated", F.lit(0))).alias("merged"))
    incoming = F.lit(_table(spark, sf_dir, "orders").count())
    return totals.select("stage", "ok", "rejected", "merged", (F.col("ok") + F.col("rejected") + F.col("merged") == incoming).alias("balanced"))


_BY_CUSTOMER = """
[meta]
external_id = "o_custkey"
[fields.price_rub]
input = "o_totalprice"
cast = "decimal"
[fields.area_m2]
cast = "decimal"
default = 50
[fields.district]
input = "o_orderstatus"
enum_map = { F = "finished", O = "open" }
"""


def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer in two loads, finished ones first: what each transform inserted, updated, merged and rejected."""
    root = scratch_path(spark, "changes")
    orders, lake, steps = _table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"), Lake(spark, f"{root}/lake"), []
    for step, chosen in enumerate((F.year("o_orderdate") < 1996, F.year("o_orderdate") >= 1996)):
        # a customer's orders of a load are in one file
        _csv_files(_spread(orders.where(chosen), "o_custkey"), f"{root}/{step}")
        _taken(lake.ingest([f"{root}/{step}"], source="customers", archive=False))
        before = lake.log.read().select("run_id").distinct()
        seen = {r[0] for r in before.collect()}  # a row for each command
        lake.transform({"customers": _BY_CUSTOMER})
        mine = lake.log.read().where((F.col("stage") == "transform") & ~F.col("run_id").isin(list(seen)))
        steps.append(mine.agg(F.lit(step).alias("step"), *(F.sum(f"rows_{c}").alias(c) for c in ("inserted", "updated", "unchanged")), F.sum("rows_deduplicated").alias("merged"), F.sum("rows_quarantined").alias("rejected"), (F.sum(F.col("rows_ok") + F.col("rows_deduplicated") + F.col("rows_quarantined")) == orders.where(chosen).count()).alias("balanced")))
    return steps[0].unionByName(steps[1])


def touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers divided by nation; the orders of one nation's customers update them, and the files of all other buckets stay."""
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation").where("n_name = 'NATION_7'")
    base = customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("balance"), F.lit(1).alias("version"))
    bought = _table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # one nation
    updates = bought.select("c_custkey", "c_nationkey", F.col("o_totalprice").alias("balance"), F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1).alias("version"), "o_orderkey")
    table, key, n = VersionedTable(spark, scratch_path(spark, "buckets"), base.schema), ["c_nationkey"], 16
    first = table.publish_buckets(base, "all", key, n, whole=True)
    touched = {f"all#{r[0]}" for r in updates.select(bucket_of(key, n)).distinct().collect()}  # n at most
    merged = R.latest_wins(table.read(parts=sorted(touched)), updates, ["c_custkey"], "version", "o_orderkey").drop("_change")
    second = table.publish_buckets(merged, "all", key, n, whole=False)
    kept = {p for p in first if first[p] == second[p]}
    as_they_were = kept == set(first) - touched and len(touched) < len(first)
    return table.read().withColumn("others_stay", F.lit(as_they_were))


def runs_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One broken file, one source without a mapping, one whose mapping names a column that isn't there, one whose mapping is no
    TOML: each has its record, and the good one goes through."""
    root = scratch_path(spark, "failures")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.lit(40).alias("area"))
    lake = Lake(spark, f"{root}/lake")
    for name, status in (("good", "F"), ("unmapped", "O"), ("gone", "P"), ("odd", "P")):
        # one letter F alone would be taken for a boolean
        _csv_files(orders.where(F.col("o_orderstatus") == status).withColumn("o_orderstatus", F.lit("O")).withColumn("tag", F.lit(name)), f"{root}/{name}", "o_orderkey")
        _taken(lake.ingest([f"{root}/{name}"], source=name))
    # the first record of each file is none
    lines = orders.select(F.when(F.monotonically_increasing_id() % (1 << 33) == 0, "[1]").otherwise(F.to_json(F.struct("o_orderkey"))).alias("value"))
    lines.write.text(f"{root}/broken lines.txt")
    rename_files(spark, f"{root}/broken lines.txt", f"{root}/broken lines", "jsonl")
    lake.ingest([f"{root}/broken lines"], source="broken")
    lake.transform({"good": _PRICES, "gone": _PRICES.replace('"area"', '"no_such"'), "odd": "[fields"})
    log = lake.log.read().withColumn("unit", F.when((F.col("stage") == "ingest") & (F.col("status") == "failed"), F.lit("broken")).when(F.col("stage") == "ingest", F.col("target_table")).otherwise(F.col("source_file")))
    return log.groupBy("stage", "unit", "status").agg(F.sum("rows_ok").alias("ok"), F.sum("rows_quarantined").alias("rejected"), F.count_if(F.col("error_message").isNotNull()).cast("boolean").alias("explained"))


def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of some files, by content hash: the scan reads the partitions of those alone."""
    root, orders = scratch_path(spark, "pruned"), _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for rest in range(3):
        _csv_files(orders.where(F.col("o_orderkey") % 3 == rest), f"{root}/in/{rest}", "o_orderkey")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in/*"], source="orders"))
    chosen = [r[0] for r in lake.bronze("orders").where("o_orderkey % 3 = 1").select("_content_hash").distinct().collect()]  # a row for each file
    return lake.bronze("orders", chosen).select("o_orderkey", "o_orderstatus")


def evolved_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was published with fewer columns, read under the schema of today, beside a part that has them all."""
    customer = _table(spark, sf_dir, "customer")
    new = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    old = customer.select("c_custkey", "c_name")
    root = scratch_path(spark, "evolved")
    VersionedTable(spark, root, old.schema).publish(old.where("c_nationkey < 12"), "old")
    table = VersionedTable(spark, root, new.schema)
    table.publish(new.where("c_nationkey >= 12"), "new")
    missing = added_columns(new.schema, old.schema)
    return table.read().withColumn("added", F.lit(",".join(missing)))


def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of an export, and whether each follows the line before it in the order of keys, across all files."""
    root = scratch_path(spark, "ordered")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.to_date("o_orderdate").alias("day"))
    version = export_dataset(orders, root, key="o_orderkey", formats=("parquet", "jsonl"))
    lines = spark.read.text(f"{root}/{version}/jsonl").select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    keyed = lines.withColumn("key", F.get_json_object("value", "$.o_orderkey").cast("bigint"))
    within = Window.partitionBy("file").orderBy("block", "at")
    # a row for each file
    first = keyed.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high")).withColumn("before", F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)))
    placed = keyed.withColumn("last", F.lag("key").over(within)).join(first.select("file", "before"), "file")
    return placed.select("value", (F.col("key") > F.coalesce("last", "before", F.lit(-1))).alias("in_order"))


def guarded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length guard of patterns, time stamps in several ISO forms, defaults, and the JSON record of a row with a size limit."""
    events = _table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 5 == 0, F.repeat(F.lit("ab"), 40)).otherwise(F.col("event_type"))
    replaced, long = F.when(~P.too_long(text, 50), F.regexp_replace(text, "a", "_")), P.too_long(text, 50)
    form = F.col("event_id") % 4
    stamp = F.when(form == 0, F.date_format("ts", "yyyy-MM-dd'T'HH")).when(form == 1, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(form == 2, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.concat(F.date_format("ts", "dd.MM.yyyy")))
    moment, failed = P.cast_timestamp(stamp)
    spec = Field(input="value", cast="decimal", default=1)
    amount, reason = field_value("ceiling_height_m", spec, F.when(F.col("user_id") % 3 > 0, F.format_string("%.1f", (F.col("user_id") % 12).cast("double"))), "decimal(4,2)")
    record = record_json(["event_id", "event_type"], 37)
    return events.select("event_id", replaced.alias("replaced"), long.alias("too_long"), moment.alias("moment"), failed.alias("failed"), amount.alias("amount"), reason.alias("reason"), F.get_json_object(record, "$._original_bytes").cast("bigint").alias("cut_from"))


_FLOW_MAPPING = """
[meta]
external_id = "p_partkey"
[fields.price_rub]
input = "p_retailprice"
cast = "decimal"
unit_convert = { from = "thousands_rub", to = "rub" }
[fields.area_m2]
input = "p_size"
cast = "decimal"
[fields.rooms]
input = "p_brand"
regex_extract = '#(\\d+)'
cast = "bigint"
[fields.district]
input = "p_type"
"""


def listing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts through the whole flow: files, bronze, mapping with sanity ranges, silver, mart."""
    root = scratch_path(spark, "flow")
    _csv_files(_spread(_table(spark, sf_dir, "part"), "p_partkey", spark.sparkContext.defaultParallelism), f"{root}/in")
    lake = Lake(spark, f"{root}/lake")
    _taken(lake.ingest([f"{root}/in"], source="parts"))
    lake.transform({"parts": _FLOW_MAPPING})
    lake.build_gold(["mart_price_area_by_district"])
    return lake.gold("mart_price_area_by_district").drop("_computed_at", "_gold_run_id")


def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pinned snapshot is unmoved by later versions of its parts."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    table = VersionedTable(spark, scratch_path(spark, "versions"), orders.schema)
    for status in ("F", "O", "P"):
        table.publish(orders.where(F.col("o_orderstatus") == status), status)
    pinned = table.snapshot()
    table.publish(orders.where("o_orderstatus = 'F' AND o_totalprice > 100000"), "F")
    return table.read(pinned).withColumn("in_latest", F.lit(False)).unionByName(table.read().withColumn("in_latest", F.lit(True)))


def exported_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset version read back."""
    root = scratch_path(spark, "datasets")
    orders = _table(spark, sf_dir, "orders").withColumn("id", P.stable_id(F.lit("o"), F.col("o_orderkey").cast("string")))
    version = export_dataset(orders, root)
    return spark.read.parquet(f"{root}/{version}/parquet")


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says of a version: rows, null targets, columns, and whether its content is that of the table."""
    root = scratch_path(spark, "datasets")
    orders = _table(spark, sf_dir, "orders").withColumn("target", F.nullif("o_orderstatus", F.lit("P")))
    version = export_dataset(orders, root, key="o_orderkey", target="target", formats=("parquet",))
    head, _ = read_manifest(spark, f"{root}/{version}")
    return spark.createDataFrame([(head["rows"], head["target_nulls"], len(head["schema"]), head["content"] == content_fingerprint(orders)[1])], "n_rows long, target_nulls long, n_columns long, same_content boolean")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        mart_group_summary, mart_large_groups, median_by_rank, mart_styles, mart_dynamics, daily_event_counts, panel_selected_districts, distinct_districts, feature_rows, target_nulls,
        text_primitives, json_fields, reject_split, dictionary_lookup, dictionary_table, boolean_words, stable_ids, synthetic_ids, column_names, inferred_types, latest_event_per_user, upsert_customers,
        pending_documents, reconciled_schema, runs_latest_by_stage, runs_latest_by_content, runs_totals, runs_freshness, runs_failed, runs_stale_mappings, quarantine_registry, ingest_csv,
        ingest_json, json_documents, csv_dialects, workbook_cells, file_admission, raw_archive, replayed_files, replayed_partial, empty_first_file, wide_header, quarantined_rows, balance_check, change_counts, touched_buckets, runs_after_failure, pruned_scan, evolved_silver,
        ordered_export, guarded_values, listing_flow, versioned_orders, exported_orders, dataset_manifest,
    )
}

_ITEMS = "SELECT l_returnflag || '-' || l_linestatus AS k, l_extendedprice::DECIMAL(12,2) AS p, l_quantity::DECIMAL(8,2) AS a FROM lineitem"
_MEAN = lambda v, n: f"(((2 * sum(({v} * 100)::BIGINT) + count({v})) // (2 * count({v})))::DOUBLE / 100)::DECIMAL({n},2)"
_KIND = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "date"}
_LATEST = "row_number() OVER (PARTITION BY {} ORDER BY started_at DESC, run_id DESC)"

_SUPPLIER_FILES = "(SELECT s_suppkey, concat('id,name' || chr(10), s_suppkey, ',', CASE s_suppkey % 5 WHEN 1 THEN chr(0) WHEN 2 THEN lpad(s_name, 80, 'x') ELSE s_name END, chr(10)) AS c FROM supplier)"

ORACLES: dict[str, str] = {
    "mart_group_summary": _summary_sql("SELECT p_brand AS k, p_retailprice::DECIMAL(12,2) AS p, p_size::DECIMAL(8,2) AS a FROM part"),
    "mart_large_groups": _summary_sql(_ITEMS),
    "median_by_rank": f"SELECT k AS district, {_MEDIAN} AS median_price_rub FROM ({_ITEMS}) GROUP BY k",
    "mart_styles": f"""
SELECT lower(trim(o_orderpriority)) AS style_norm, coalesce(lower(nullif(o_orderstatus, 'P')), 'none') AS renovation_style_norm, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus = 'F' END AS has_renovation, year(o_orderdate) >= 2000 AS has_furniture,
       count(*)::BIGINT AS listing_count, {_MEAN("p", 12)} AS avg_price_rub, {_MEDIAN} AS median_price_rub, {_MEAN("a", 8)} AS avg_area_m2, count(*) < 70 AS is_small_sample
FROM (SELECT *, o_totalprice::DECIMAL(12,2) AS p, day(o_orderdate)::DECIMAL(8,2) AS a FROM orders) GROUP BY 1, 2, 3, 4""",
    "mart_dynamics": """
WITH d AS (SELECT ts::DATE AS load_date, count(*) AS n FROM events WHERE event_type = 'purchase' AND value > 100 GROUP BY 1),
s AS (SELECT unnest(generate_series(min(load_date), max(load_date), INTERVAL 1 DAY))::DATE AS load_date FROM d)
SELECT s.load_date, coalesce(n, 0)::BIGINT AS listings_added, (sum(coalesce(n, 0)) OVER (ORDER BY s.load_date))::BIGINT AS listings_added_cumulative FROM s LEFT JOIN d ON s.load_date = d.load_date""",
    "daily_event_counts": "SELECT ts::DATE AS load_date, count(*)::BIGINT AS n FROM events GROUP BY 1",
    "panel_selected_districts": f"SELECT k AS district, count(*)::BIGINT AS listing_count, min(p) AS min_price_rub, max(p) AS max_price_rub FROM ({_ITEMS}) WHERE k IN ('A-F', 'N-O') GROUP BY k ORDER BY listing_count DESC, district",
    "distinct_districts": "SELECT DISTINCT coalesce(p_brand, 'unknown') AS district FROM part",
    "feature_rows": f"SELECT l_orderkey, l_linenumber, {_RATIO} AS price_per_m2, l_linenumber::DOUBLE / nullif(l_linenumber % 3, 0)::DOUBLE AS floor_ratio, NULL::BOOLEAN AS is_loft FROM (SELECT *, l_extendedprice::DECIMAL(12,2) AS p, l_quantity::DECIMAL(8,2) AS a FROM lineitem)",
    "target_nulls": "SELECT count(*)::BIGINT AS null_targets, count(*) FILTER (WHERE l_linenumber % 3 = 0)::BIGINT AS null_ratios FROM lineitem",
    "text_primitives": r"""
SELECT p_partkey, nullif(regexp_extract(p_brand, '#(\d+)', 1), '')::BIGINT AS brand_no, regexp_replace(p_name, '(\w+) (\w+)', '\2-\1', 'g') AS turned,
       (p_retailprice::DECIMAL(12,2) * 1000)::DECIMAL(34,2) AS price_rub, true AS not_an_integer, lower(p_type) AS type_key FROM part""",
    "json_fields": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract_string(props, '$.k') AS k_text FROM events",
    "reject_split": """
SELECT CASE WHEN value > 300 THEN 'value above 300' WHEN value < 0.1 THEN 'value below 0.1' WHEN event_type = 'error' THEN 'event_type is missing' WHEN strlen(props) > 9 THEN 'props too long' ELSE 'valid' END AS reason,
       count(*)::BIGINT AS n, min(event_id) AS first_event FROM events GROUP BY 1""",
    "dictionary_lookup": "SELECT CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS finished, o_orderstatus NOT IN ('F', 'O') AS missed, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2",
    "dictionary_table": "SELECT l_orderkey, l_linenumber, p_type AS type, CASE WHEN l_returnflag <> 'R' AND p_partkey IS NULL THEN 'type: not in dictionary' END AS reason FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10 AND l_returnflag <> 'R'",
    "boolean_words": "SELECT DISTINCT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS value, o_orderstatus NOT IN ('F', 'O') AS failed FROM orders",
    "stable_ids": "SELECT o_orderkey, sha256(concat(length(o_orderpriority), ':', o_orderpriority, ':', o_orderkey)) AS id FROM orders",
    "synthetic_ids": "SELECT p_partkey, basis, sha256(concat('4:part:', basis)) AS id FROM (SELECT p_partkey, concat('brand=', p_brand, ';name=', coalesce(nullif(p_name, 'red widget'), 'None'), ';size=', p_size) AS basis FROM part)",
    "column_names": "SELECT regexp_replace(lower(p_brand), '[^a-z0-9_]', '_', 'g') AS clean, count(*)::BIGINT AS n FROM part GROUP BY 1",
    "inferred_types": " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS type" for c, t in _KIND.items()),
    "latest_event_per_user": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1",
    "upsert_customers": """
WITH u AS (SELECT o_custkey + CASE WHEN o_orderstatus = 'P' THEN 1000000 ELSE 0 END AS c_custkey, o_totalprice AS balance, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version, o_orderkey FROM orders),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC, o_orderkey) AS n FROM u) WHERE n = 1)
SELECT coalesce(c.c_custkey, l.c_custkey) AS c_custkey, CASE WHEN c.c_custkey IS NULL OR l.version > 1 THEN l.balance ELSE c.c_acctbal END AS balance, CASE WHEN c.c_custkey IS NULL OR l.version > 1 THEN l.version ELSE 1 END AS version,
       CASE WHEN c.c_custkey IS NULL THEN 'inserted' WHEN l.version > 1 THEN 'updated' ELSE 'unchanged' END AS change FROM customer c FULL JOIN l ON c.c_custkey = l.c_custkey""",
    "pending_documents": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "reconciled_schema": "SELECT c_custkey, c_name, c_acctbal, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier",
    "runs_latest_by_stage": f"SELECT stage, status, finished_at FROM (SELECT *, {_LATEST.format('stage')} AS n FROM {_LOG_SQL}) WHERE n = 1",
    "runs_latest_by_content": f"SELECT content_hash, stage, run_id, status FROM (SELECT *, {_LATEST.format('content_hash, stage')} AS n FROM {_LOG_SQL}) WHERE n = 1",
    "runs_totals": f"SELECT stage, sum(rows_ok)::BIGINT AS accepted, sum(rows_quarantined)::BIGINT AS rejected FROM {_LOG_SQL} WHERE started_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY stage",
    "runs_freshness": f"SELECT stage, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(finished_at))) // 1000000 AS age_seconds FROM {_LOG_SQL} WHERE status = 'success' GROUP BY stage",
    "runs_failed": f"SELECT started_at, run_id, stage, source_file, error_message FROM {_LOG_SQL} WHERE status = 'failed' ORDER BY started_at DESC, run_id LIMIT 200",
    "runs_stale_mappings": f"SELECT source_file AS source, hash AS was, '1' AS fingerprint FROM (SELECT *, {_LATEST.format('source_file')} AS n FROM {_LOG_SQL} WHERE status <> 'failed') WHERE n = 1 AND hash <> '1'",
    "quarantine_registry": "SELECT CASE event_type WHEN 'click' THEN 'bronze' ELSE 'silver' END AS layer, event_type AS source, count(*)::BIGINT AS n_rejects, max(ts) AS last_rejected_at FROM events WHERE value > 100 AND event_type IN ('click', 'view') GROUP BY 1, 2",
    "ingest_csv": "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "ingest_json": """SELECT event_id, event_type, value, '{"a":"x","b":' || user_id || '}' AS nested FROM events""",
    "json_documents": "SELECT event_id, event_type, nullif(user_id, 7) AS user_id FROM events",
    "csv_dialects": "SELECT CASE WHEN k THEN c_custkey END AS c_custkey, CASE WHEN k THEN 'Имя; ' || c_name END AS name, CASE WHEN k THEN c_acctbal::DECIMAL(38,2) END AS balance FROM (SELECT *, c_custkey % 10 > 0 AS k FROM customer)",
    "workbook_cells": "SELECT o_orderkey, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS ordered, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS done FROM orders",
    "file_admission": f"""
SELECT strlen(c)::BIGINT AS bytes, CASE WHEN strlen(c) <= {MOST_BYTES} THEN sha256(c) END AS content_hash, CASE WHEN strlen(c) > {MOST_BYTES} THEN 'file too large' WHEN s_suppkey % 5 = 1 THEN 'looks binary, not text' END AS refusal FROM {_SUPPLIER_FILES}""",
    "raw_archive": f"SELECT DISTINCT sha256(c) AS content_hash, c AS content, true AS intact FROM {_SUPPLIER_FILES}",
    "replayed_files": """
SELECT o_orderkey, 1::BIGINT AS in_bronze, (o_orderstatus <> 'P')::BIGINT AS in_silver, CASE WHEN o_orderstatus <> 'P' THEN (CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 90 + 1 ELSE 50 END)::DECIMAL(8,2) END AS area_m2,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS district, 'ingest:skipped,ingest:success,transform:partial' AS seen, 'success' AS unchanged FROM orders""",
    "replayed_partial": """
WITH n AS (SELECT count(*)::BIGINT AS n, count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS p FROM orders)
SELECT 'to_none' AS source, 0 AS step, n - p AS in_bronze, p AS in_quarantine, true AS balanced FROM n UNION ALL SELECT 'to_none', 1, n, 0, true FROM n
UNION ALL SELECT 'to_all', 0, n - p, p, true FROM n UNION ALL SELECT 'to_all', 1, 0, n, true FROM n""",
    "empty_first_file": "SELECT o_orderkey, o_totalprice, o_orderstatus, 'success,partial,success' AS states, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')::BIGINT AS rejected FROM orders",
    "wide_header": f"SELECT s_suppkey, (s_suppkey * {WIDE_COLUMNS * (WIDE_COLUMNS - 1) // 2})::BIGINT AS total, s_name, {WIDE_COLUMNS + 1} AS n_columns FROM supplier",
    "quarantined_rows": "SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 7 > 0 THEN (o_orderkey % 90 + 1)::VARCHAR END AS area, 'district: not in dictionary' AS reason, 'prices' AS source FROM orders WHERE o_orderstatus = 'F'",
    "balance_check": """
SELECT 'ingest' AS stage, count(*)::BIGINT AS ok, 0::BIGINT AS rejected, 0::BIGINT AS merged, true AS balanced FROM orders
UNION ALL SELECT 'transform', count(*) FILTER (WHERE o_orderstatus <> 'P'), count(*) FILTER (WHERE o_orderstatus = 'P'), 0, true FROM orders""",
    "change_counts": """
WITH o AS (SELECT *, (year(o_orderdate) >= 1996)::INTEGER AS step, o_orderstatus IN ('F', 'O') AS ok FROM orders),
k AS (SELECT DISTINCT step, o_custkey FROM o WHERE ok),
c AS (SELECT k.step, count(*) FILTER (WHERE b.o_custkey IS NULL)::BIGINT AS inserted, count(b.o_custkey)::BIGINT AS updated, count(*) AS keys FROM k LEFT JOIN k AS b ON b.step < k.step AND b.o_custkey = k.o_custkey GROUP BY k.step)
SELECT o.step, inserted, updated, 0::BIGINT AS unchanged, (count(*) FILTER (WHERE ok) - keys)::BIGINT AS merged, count(*) FILTER (WHERE NOT ok)::BIGINT AS rejected, true AS balanced FROM o JOIN c USING (step) GROUP BY o.step, inserted, updated, keys""",
    "touched_buckets": """
WITH u AS (SELECT c_custkey, o_totalprice AS balance, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC, o_orderkey) AS n FROM u) WHERE n = 1 AND version > 1)
SELECT c.c_custkey, c_nationkey, coalesce(l.balance, c_acctbal) AS balance, coalesce(l.version, 1) AS version, true AS others_stay FROM customer c LEFT JOIN l ON c.c_custkey = l.c_custkey""",
    "runs_after_failure": """
WITH n AS (SELECT count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS f, count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS o, count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS p FROM orders)
SELECT 'ingest' AS stage, 'good' AS unit, 'success' AS status, f AS ok, 0::BIGINT AS rejected, false AS explained FROM n
UNION ALL SELECT 'ingest', 'unmapped', 'success', o, 0, false FROM n UNION ALL SELECT 'ingest', 'gone', 'success', p, 0, false FROM n UNION ALL SELECT 'ingest', 'odd', 'success', p, 0, false FROM n
UNION ALL SELECT 'ingest', 'broken', 'failed', 0, 0, true UNION ALL SELECT 'transform', 'good', 'success', f, 0, false FROM n
UNION ALL SELECT 'transform', 'unmapped', 'skipped', 0, 0, true UNION ALL SELECT 'transform', 'gone', 'failed', 0, 0, true UNION ALL SELECT 'transform', 'odd', 'failed', 0, 0, true""",
    "evolved_silver": "SELECT c_custkey, c_name, CASE WHEN c_nationkey >= 12 THEN c_nationkey END AS c_nationkey, CASE WHEN c_nationkey >= 12 THEN c_acctbal END AS c_acctbal, 'c_nationkey,c_acctbal' AS added FROM customer",
    "ordered_export": """
SELECT concat('{"o_orderkey":', o_orderkey, ',"price":"', o_totalprice::DECIMAL(12,2), '","status":', coalesce('"' || nullif(o_orderstatus, 'P') || '"', 'null'), ',"day":"', strftime(o_orderdate, '%Y-%m-%d'), '"}') AS value, true AS in_order FROM orders""",
    "guarded_values": """
SELECT event_id, CASE WHEN event_id % 5 > 0 THEN replace(event_type, 'a', '_') END AS replaced, event_id % 5 = 0 AS too_long,
       CASE event_id % 4 WHEN 0 THEN date_trunc('hour', ts) WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('day', ts)::TIMESTAMP END AS moment, event_id % 4 = 3 AS failed,
       CASE WHEN user_id % 3 = 0 THEN 1 ELSE user_id % 12 END::DECIMAL(4,2) AS amount, CASE WHEN user_id % 3 = 0 OR user_id % 12 < 1.5 OR user_id % 12 > 10 THEN 'ceiling_height_m: outside sanity range' END AS reason,
       CASE WHEN strlen(event_id::VARCHAR) + strlen(event_type) + 29 > 37 THEN (strlen(event_id::VARCHAR) + strlen(event_type) + 29)::BIGINT END AS cut_from FROM events""",
    "pruned_scan": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 1",
    "listing_flow": _summary_sql("SELECT p_type AS k, (p_retailprice * 1000)::DECIMAL(12,2) AS p, p_size::DECIMAL(8,2) AS a FROM part WHERE nullif(regexp_extract(p_brand, '#([0-9]+)', 1), '')::INTEGER <= 20"),
    "versioned_orders": "SELECT o_orderkey, o_orderstatus, o_totalprice, false AS in_latest FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, true FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 100000",
    "exported_orders": "SELECT *, sha256(concat('1:o:', o_orderkey)) AS id FROM orders",
    "dataset_manifest": "SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS target_nulls, 7::BIGINT AS n_columns, true AS same_content FROM orders",
}
