"""Column functions."""

import datetime

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import numbers, records, text, times
from millrace.operators.routing import level, score_route
from millrace.plans.names import name_lengths, name_line


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_names(spark):
    names = spark.createDataFrame([("  vera  ",), ("  kUrT  ",), ("Ingrid ",), ("\td'arc jo-lynn\t",)],
                                  "value string")
    assert [r[0] for r in name_lengths(names).select(name_line()).collect()] == [
        "Name: Vera, Length: 4", "Name: Kurt, Length: 4", "Name: Ingrid, Length: 6", "Name: D'Arc Jo-Lynn, Length: 13"]


@pytest.mark.parametrize("value", ["mIRA vOSS", "TOVE lind", "Sam O.", "d'arc", "x1y2", "  a  b ", "", "été ÉTÉ", "a-b_c"])
def test_title_is_python_title(spark, value):
    assert one(spark, text.title(F.lit(value))) == value.title()


@pytest.mark.parametrize("value", ["2.5", " 2.5 ", "NULL", "", "2.5d", "2f", "inf", "-Infinity", "1e3", "-0.5", "abc", "nan"])
def test_to_double_is_python_float(spark, value):
    try:
        expected = float(value)
    except ValueError:
        expected = None
    got = one(spark, numbers.to_double(F.lit(value)))
    assert got == expected or (got != got and expected != expected)


@pytest.mark.parametrize("value", ["  a b  ", "\t a\r\n", "\u00a0a\u3000", "\x1fa\x85", "", " \t", "\u200ba"])
def test_strip_is_python_strip(spark, value):
    assert one(spark, text.strip(F.lit(value))) == value.strip()


def test_numbers(spark):
    assert one(spark, numbers.whole_part(F.lit(100.99))) == 100
    assert one(spark, numbers.whole_part(F.lit("x"))) is None
    assert one(spark, numbers.to_int(F.lit("220.0"))) is None
    assert one(spark, numbers.comma_decimal(F.lit("12,50"))) == 12.5
    assert [one(spark, numbers.round_half_even(F.lit(x), 0)) for x in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert [one(spark, numbers.fixed_text(F.lit(x), 1)) for x in (187.25, 187.5, 187.35)] == ["187.2", "187.5", "187.4"]
    assert [one(spark, numbers.clamp(F.lit(x), 85, 100)) for x in (80, 90, 101)] == [85, 90, 100]
    assert one(spark, numbers.clamp(F.lit(None).cast("int"), 85, 100)) is None
    assert float(one(spark, numbers.price_with_margin(F.lit(100.0), F.lit(0.25)))) == 125.0


def test_times(spark):
    moment = times.parse_iso(F.lit("2026-04-03T19:00:05Z"))
    assert one(spark, times.clock(moment)) == "19:00:05"
    assert one(spark, times.iso_day(moment)) == "2026-04-03"
    assert one(spark, times.clock(times.plus_seconds(moment, F.lit(70)))) == "19:01:15"
    assert one(spark, times.parse_iso(F.lit("yesterday"))) is None
    assert one(spark, times.parse_timestamp(F.lit("soon"))) is None
    assert one(spark, times.day_of(moment)) == datetime.datetime(2026, 4, 3)
    assert [one(spark, times.lap_of(F.lit(x))) for x in (0.0, 300.0, 300.1, 601.0)] == [1, 1, 2, 3]


def test_text(spark):
    assert one(spark, text.padded_id("T", F.lit(7))) == "T007"
    assert one(spark, text.padded_id("T", F.lit(12345))) == "T12345"
    assert one(spark, text.without_prefix(F.lit("s3://b/k"), "s3://")) == "b/k"
    assert one(spark, text.without_prefix(F.lit("b/k"), "s3://")) == "b/k"
    labels = ["Tarjeta", "Transferencia", "Efectivo", "PayPal"]
    assert [one(spark, text.canonical_label(F.lit(x), labels)) for x in ("tarjeta", "EFECTIVO", "PayPal", "Bono")] == [
        "Tarjeta", "Efectivo", "PayPal", "Bono"]
    assert one(spark, text.as_strings(F.array(F.lit(1), F.lit(22)))) == ["1", "22"]
    assert one(spark, text.field(F.lit("a,b,"), 2)) == "" and one(spark, text.field(F.lit("a,b"), 2)) is None
    assert one(spark, text.trimmed_text(F.lit("  \tx "))) == "\tx"


def test_records(spark):
    assert one(spark, records.map_lookup(F.lit("a"), {"a": 1}, 0)) == 1
    assert one(spark, records.map_lookup(F.lit("b"), {"a": 1}, 0)) == 0
    assert one(spark, records.default_key(F.lit(None), "x")) == "x"
    assert one(spark, records.stable_id(F.lit("r"), F.lit(1.5))) == one(spark, records.stable_id(F.lit("r"), F.lit(1.5)))
    gap = F.lit(None).cast("string")
    assert one(spark, records.stable_id(F.lit("r"), gap, F.lit("x"))) != one(spark, records.stable_id(F.lit("r"), F.lit("x"), gap))
    for missing in (F.lit(None).cast("string"), F.lit("")):
        with pytest.raises(Exception, match="no key here"):
            one(spark, records.required_key(missing, "no key here"))


def test_json_keeps_decimal_numbers_in_integer_fields(spark):
    schema = T.StructType.fromDDL("a INT, b BIGINT, c DOUBLE, d STRING")
    parsed = records.parse_json(F.lit('{"a": 85.3, "b": 9007199254740993, "c": 1, "d": "ñ", "e": 5}'), schema)
    assert one(spark, parsed).asDict() == {"a": 85, "b": 9007199254740993, "c": 1.0, "d": "ñ"}
    missing = one(spark, records.parse_json(F.lit('{"c": null}'), schema))
    assert set(missing.asDict().values()) == {None}


def test_routes(spark):
    route = [one(spark, score_route(F.lit(x), F.lit("pass"), F.lit("fail"))) for x in ("6", "5", None)]
    assert route == ["pass", "fail", "fail"]
    assert [one(spark, level(F.lit(x), 10.0)) for x in (12.8, 0.0, 3.0)] == ["alert", "zero", "normal"]
