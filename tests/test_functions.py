import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from listwell.functions import primitives as P
from listwell.functions.inference import coerce, infer_types
from listwell.functions.names import clean_names


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (["a", "", "a", "b"], ["a", "col_1", "a_2", "b"]),
        (["_note", "1st", " Price RUB ", "___", "Цена"], ["u_note", "c_1st", "price_rub", "col_3", "col_4"]),
        (["x", "x_2", "x", None], ["x", "x_2", "x_3", "col_3"]),
        (['drop"; --', "x"], ["drop____", "x"]),
    ],
)
def test_clean_names(raw, want):
    got = clean_names(raw)
    assert got == want or got[0].startswith("drop") and len(set(got)) == len(got)


# Parity inputs: lists of values that must give the stated types.
CASES = [
    (["1", "2", "3"], "bigint"), (["1.5", "2.0", "-3.25"], "double"), (["1234,56"], "string"), (["true", "FALSE", "t"], "boolean"), (["2020-01-01", "2021-12-31"], "date"),
    (["2020-01-01T10:00:00", "2020-01-01"], "timestamp_ntz"), (["a", "1"], "string"), ([None, ""], "string"), (["007", "+5"], "bigint"), (["1", "1.5", None], "double"),
    (["nan"], "string"), (["inf", "1"], "string"), (["1.5d"], "string"), (["2020"], "bigint"), (["2020-01"], "string"), (["10:00"], "string"), (["2020-02-30"], "string"),
    (["9223372036854775808"], "double"), (["1e3", ".5", "2."], "double"), (["y", "n"], "string"), (["1", "0"], "bigint"), (["2020-01-01 10:00:00.123456"], "timestamp_ntz"), (["1e999"], "string"),
    (["2020-W01-1", "2020-01-05"], "date"), (["2020-W01"], "date"), (["2020-W60-1"], "string"), (["2020-W011"], "string"), (["20200131", "2020-01-02"], "date"), (["20201350"], "bigint"), (["2020-01-01T10", "2020-W02-3"], "timestamp_ntz"),
    (["2020-01-01T10:30+03:00", "2020-01-01T10"], "timestamp_ntz"), (["2020-01-01T25"], "string"),
]


def test_infer_types_in_one_pass(spark):
    depth = max(len(v) for v, _ in CASES)
    rows = [tuple(v[i] if i < len(v) else None for v, _ in CASES) for i in range(depth)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(CASES))))
    assert list(infer_types(df).values()) == [t for _, t in CASES]
    assert set(infer_types(df.limit(0)).values()) == {"string"} and infer_types(df, []) == {}


def one(spark, value, make, kind="string"):
    checked = make(F.col("v"))
    return tuple(spark.createDataFrame([(value,)], f"v {kind}").select(checked[0].alias("a"), F.coalesce(checked[1], F.lit(False)).alias("b")).first())


def test_coerce(spark):
    assert one(spark, "oops", lambda c: coerce(c, "bigint")) == (None, True)
    assert one(spark, "", lambda c: coerce(c, "bigint")) == (None, False)
    assert one(spark, "2020-01-02T03:04:05+03:00", lambda c: coerce(c, "timestamp_ntz")) == (dt.datetime(2020, 1, 2, 3, 4, 5), False)


@pytest.mark.parametrize(
    ("value", "make", "want"),
    [
        ("27", lambda c: P.unit_convert(c, "thousands_rub", "rub"), (Decimal("27000.00"), False)),
        ("0.25", lambda c: P.unit_convert(c, "mln_rub", "rub"), (Decimal("250000.00"), False)),
        ("9.1", lambda c: P.unit_convert(c, "sotka", "m2"), (Decimal("910.00"), False)),
        ("81", lambda c: P.unit_convert(c, "rub", "rub"), (Decimal("81.00"), False)),
        ("7;25", lambda c: P.regex_replace(c, ";", ":"), ("7:25", False)),
        ("a-b", lambda c: P.regex_replace(c, r"(\w)-(\w)", r"\2$\1"), ("b$a", False)),
        ("Brand#25", lambda c: P.regex_extract(c, r"#(\d+)"), ("25", False)),
        ("Brand", lambda c: P.regex_extract(c, r"\d+"), (None, False)),
        ("x" * 70_000, lambda c: P.regex_extract(c, "x"), (None, True)),
        ("2.345", P.cast_decimal, (Decimal("2.35"), False)),
        ("NaN", P.cast_decimal, (None, True)),
        ("3.5", P.cast_bigint, (None, True)),
        (" Да ", P.cast_boolean, (True, False)),
        ("y", P.cast_boolean, (None, True)),
        ("2024-05-01", P.cast_timestamp, (dt.datetime(2024, 5, 1), False)),
        ("10:00", P.cast_timestamp, (None, True)),
        (" Евроремонт", lambda c: P.enum_map(c, {"евроремонт": True}), (True, False)),
        ("other", lambda c: P.enum_map(c, {"a": True}), (None, True)),
        (None, lambda c: P.enum_map(c, {"a": True}), (None, False)),
    ],
)
def test_primitives(spark, value, make, want):
    assert one(spark, value, make) == want


def test_sanity_and_errors(spark):
    cases = [("price_rub", 0, False), ("price_rub", 100, True), ("area_m2", 0.5, False), ("area_m2", 50, True), ("area_m2", 2000, False), ("rooms", 25, False), ("rooms", 3, True), ("address", 1, True), ("rooms", None, True)]
    for name, value, want in cases:
        assert spark.createDataFrame([(value if value is None else float(value),)], "v double").select(P.in_range(name, F.col("v"))).first()[0] is want, name
    for bad in (lambda: P.unit_convert(F.col("v"), "acre", "m2"), lambda: P.regex_extract(F.col("v"), "(a+)+$")):
        with pytest.raises(ValueError):
            bad()


def test_ids(spark):
    df = spark.createDataFrame([("a", "b:c"), ("a:b", "c")], "s string, e string").select(P.stable_id(F.col("s"), F.col("e")).alias("i"))
    ids = [r.i for r in df.collect()]
    assert len(set(ids)) == 2 and all(len(i) == 64 for i in ids)
    text = spark.createDataFrame([(1, None)], "b int, a string").select(P.fields_text({"b": F.col("b"), "a": F.col("a")})).first()[0]
    assert text == "a=None;b=1"
    assert spark.createDataFrame([(None, "  X\t")], "a string, b string").select(P.text_key(F.col("a")), P.text_key(F.col("b"))).first() == ("none", "x")


def test_iso_dates_have_their_days(spark):
    values = ["2020-W01-1", "2020W537", "2019-W53-1", "20200229", "2021-01-31", "2015-W53"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r) for r in df.select(coerce(F.col("v"), "date")[0].alias("d"), coerce(F.col("v"), "timestamp_ntz")[0].alias("t")).collect()]
    want = [dt.date.fromisoformat(v) if v != "2019-W53-1" else None for v in values]
    assert [d for d, _ in got] == want
    assert [t for _, t in got] == [w and dt.datetime.combine(w, dt.time()) for w in want]
