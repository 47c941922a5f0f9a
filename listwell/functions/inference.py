"""Types of text columns: inference by the shapes of all values, and coercion that tells failures apart from nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of the boolean type, and patterns of the others.
TRUE_WORDS, FALSE_WORDS = ("true", "t", "yes"), ("false", "f", "no")
INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^\s*[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
WEEK_DAY = r"^([0-9]{4})(-?)W([0-9]{2})(?:\2([1-7]))?$"
COMPACT_DAY = r"^([0-9]{4})([0-9]{2})([0-9]{2})$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"

#: In the order of preference; the text type takes what no other does.
ORDER = ("boolean", "bigint", "double", "date", "timestamp_ntz")
TEXT = "string"


def filled(value: Column) -> Column:
    """Empty text counts as null everywhere."""
    return F.nullif(value, F.lit(""))


def as_boolean(value: Column) -> Column:
    low = F.lower(value)
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)


def as_bigint(value: Column) -> Column:
    return F.when(value.rlike(INTEGER), value.try_cast("bigint"))


def as_double(value: Column) -> Column:
    """Finite numbers only; no decimal comma, no type suffix, no words."""
    number = F.when(value.rlike(NUMBER), F.replace(value, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def _week_date(value: Column) -> Column:
    """The day of an ISO week date: the Monday of the week that holds 4 January, and on from there."""
    part = lambda i: F.regexp_extract(value, WEEK_DAY, i).try_cast("int")
    first = F.date_trunc("week", F.concat(F.regexp_extract(value, WEEK_DAY, 1), F.lit("-01-04")).try_cast("date")).cast("date")
    day = F.date_add(first, 7 * (part(3) - 1) + F.coalesce(part(4), F.lit(1)) - 1)
    # a week that its year doesn't have is no date
    return F.when(F.weekofyear(day) == part(3), day)


def as_date(value: Column) -> Column:
    """ISO dates: 2020-01-31, 20200131, 2020-W05-5."""
    compact = F.regexp_replace(value, COMPACT_DAY, "$1-$2-$3").try_cast("date")
    return F.when(value.rlike(DAY), value.try_cast("date")).when(value.rlike(COMPACT_DAY), compact).when(value.rlike(WEEK_DAY), _week_date(value))


def as_timestamp(value: Column) -> Column:
    """ISO date with an optional time, whole hours included; the wall clock of a zoned time is kept and its zone dropped."""
    plain = F.replace(F.regexp_replace(value, r"(?<=[T ][0-9:.,]{2,15})(Z|[+-][0-9]{2}:?[0-9]{2})$", ""), F.lit(","), F.lit("."))
    whole = F.when(plain.rlike(r"[T ][0-9]{2}$"), F.concat(plain, F.lit(":00"))).otherwise(plain)
    return F.when(value.rlike(MOMENT), whole.try_cast("timestamp_ntz")).otherwise(as_date(value).cast("timestamp_ntz"))


CASTS = {"boolean": as_boolean, "bigint": as_bigint, "double": as_double, "date": as_date, "timestamp_ntz": as_timestamp, TEXT: lambda value: value}


def fitting_types(value: Column) -> Column:
    """Bit set of the types in ``ORDER`` that a value fits: each value takes one branch, chosen by its look."""
    bit = {t: 1 << i for i, t in enumerate(ORDER)}
    number = F.when(as_double(value).isNotNull(), bit["double"]).otherwise(0)
    day = F.when(as_date(value).isNotNull(), bit["date"] | bit["timestamp_ntz"]).otherwise(0)
    whole = F.when(as_bigint(value).isNotNull(), bit["bigint"]).otherwise(0)
    return (
        F.when(value.rlike(COMPACT_DAY), whole.bitwiseOR(number).bitwiseOR(day))
        .when(value.rlike(INTEGER), whole.bitwiseOR(number))
        .when(value.rlike(NUMBER), number)
        .when(value.rlike(DAY) | value.rlike(WEEK_DAY), day)
        .when(value.rlike(MOMENT), F.when(as_timestamp(value).isNotNull(), bit["timestamp_ntz"]).otherwise(0))
        .when(as_boolean(value).isNotNull(), bit["boolean"])
        .otherwise(0)
    )


#: Longest text whose shape is kept; only values of one shape up to that length stand for each other.
SHAPE_LENGTH = 40
_DIGITS, _NINES = "0123456789", "9" * 10
#: Characters of numbers, dates and times; a filled value with another one is a boolean word or text.
_ALPHABET = r"^[0-9eETZW+\-.,:_ \t\n\x0B\f\r]*$"
_CLOCK = r"^.{10}[T ](?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9])?+)?+(?!:)"


def shape(value: Column) -> Column:
    """What a filled text looks like: digits as 9 and signs kept; all other text is its boolean word or ``text``."""
    word = F.lower(value)
    other = F.when(word.isin(*TRUE_WORDS, *FALSE_WORDS), word).otherwise("text")
    # the alphabet's own letter can be a word: T is one, and no number
    return F.when(F.length(value) == 1, F.when(value.rlike("[0-9]"), "9").otherwise(other)).when(value.rlike(_ALPHABET), F.when(F.length(value) <= SHAPE_LENGTH, F.translate(value, _DIGITS, _NINES)).otherwise("long")).otherwise(other)


def probe(value: Column, looks: Column) -> Column:
    """What tells values of one shape apart where their type depends on more than that; null where it doesn't.

    Days are looked at one by one (there are few), times of day by whether the clock has them, numbers that are long or
    have an exponent by the types that they fit.
    """
    fits = F.when(as_bigint(value).isNotNull(), "1").when(as_double(value).isNotNull(), "1.5").otherwise("text")
    month, day = F.substring(value, 5, 2), F.substring(value, 7, 2)
    compact = F.when(month.between("01", "12") & day.between("01", "31"), value)
    moment = F.concat(F.substring(value, 1, 10), F.translate(F.substring(looks, F.lit(11), F.lit(SHAPE_LENGTH)), "9", "0"))
    return (
        F.when(looks.isin("text", *TRUE_WORDS, *FALSE_WORDS), None)
        .when(looks == "99999999", compact)
        .when(looks.startswith("9999-99-99"), F.when(F.length(value) == 10, value).when(value.rlike(_CLOCK), moment))
        .when(looks.contains("W"), value)
        .when(looks.contains("e") | looks.contains("E") | (looks == "long") | (F.length(value) > 18), fits)
    )


def shape_histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """(at, example, n): how many filled values of the column at a place are of one type with an example.

    The example is the shape itself, or a value of it with the same day and a clock that there is, and fits the types that
    the values fit. All columns go through one expression; counts are combined before the shuffle, so what is shuffled
    follows the number of shapes and days, not of rows.
    """
    cells = df.select(F.posexplode(F.array(*(F.col(f"`{c}`").cast("string") for c in columns))).alias("at", "value")).where(filled(F.col("value")).isNotNull())
    looked = cells.withColumn("shape", shape(F.col("value")))
    return looked.withColumn("probe", probe(F.col("value"), F.col("shape"))).groupBy("at", "shape", "probe").agg(F.count(F.lit(1)).alias("n")).select("at", F.coalesce("probe", "shape").alias("example"), "n")


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """The first type in ``ORDER`` that all filled values of a column have, text if none or if the column is empty.

    Every row counts: the type rules run once for each shape of a column's values, by one example that stands for them.
    """
    columns = columns if columns is not None else df.columns
    if not columns:
        return {}
    # the sum of counts keeps the histogram: without it the optimizer would judge every value again
    found = shape_histogram(df, columns).groupBy("at").agg(F.bit_and(fitting_types(F.col("example"))).alias("fits"), F.sum("n").alias("filled"))
    fits = {r["at"]: r["fits"] for r in found.collect()}  # a row for each column
    return {c: next((t for k, t in enumerate(ORDER) if fits.get(i, 0) >> k & 1), TEXT) for i, c in enumerate(columns)}


def coerce(value: Column, kind: str) -> tuple[Column, Column]:
    """(typed value, whether a filled value failed to convert)."""
    text = filled(value)
    typed = CASTS[kind](text)
    return typed, text.isNotNull() & typed.isNull()
