"""Column builders: keys, parsing, metrics."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obs_engine.functions import clock, keys, metrics, parsing


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-07-18T00:00:00+02:00", "2026-07-17 22:00:00"),
        ("2026-07-17T22:00:00Z", "2026-07-17 22:00:00"),
        ("2026-07-17T22:00:00.25-0130", "2026-07-17 23:30:00.25"),
        ("2026-07-18T00:00:00", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    parsed = parsing.parse_ts("c")
    row = df.select(keys.wall(parsed.value).cast("string").alias("v"), parsed.bad.alias("b")).first()
    assert (row["v"], row["b"]) == (expected, expected is None)


@pytest.mark.parametrize(
    "text, value, bad",
    [
        ("731.0", Decimal("731"), False),
        ("4.56789", Decimal("4.56789"), False),
        ("1e3", Decimal(1000), False),
        ("", None, False),
        (None, None, False),
        ("NaN", None, True),
        ("-Infinity", None, True),
        ("true", None, True),
        ("many", None, True),
    ],
)
def test_parse_decimal(spark, text, value, bad):
    df = spark.createDataFrame([(text,)], "c string")
    parsed = parsing.parse_decimal("c")
    assert tuple(df.select(parsed.value, parsed.bad).first()) == (value, bad)


@pytest.mark.parametrize(
    "text, value, bad",
    [
        ("2002-03-05", date(2002, 3, 5), False),
        ("2002-03-05T10:00:00", date(2002, 3, 5), False),
        ("2002-13-05", None, True),
        ("05/03/2002", None, True),
        ("", None, False),
        (None, None, False),
    ],
)
def test_parse_date(spark, text, value, bad):
    df = spark.createDataFrame([(text,)], "c string")
    parsed = parsing.parse_date("c")
    assert tuple(df.select(parsed.value, parsed.bad).first()) == (value, bad)


@pytest.mark.parametrize(
    "lon, lat, expected",
    [
        ("2.5", "48.5", (2.5, 48.5, False)),
        (None, None, (None, None, False)),
        ("200", "48", (None, None, True)),
        ("2", "-91", (None, None, True)),
        ("2", None, (None, None, True)),
        ("x", "48", (None, None, True)),
        ("NaN", "48", (None, None, True)),
    ],
)
def test_parse_point(spark, lon, lat, expected):
    df = spark.createDataFrame([(lon, lat)], "lon string, lat string")
    assert tuple(df.select(*parsing.parse_point("lon", "lat")).first()) == expected


@pytest.mark.parametrize(
    "text, value, bad",
    [
        ('{"b": 1.0, "a": [2, "x"]}', '{"a":[2,"x"],"b":1}', False),
        ("[1]", None, True),
        ('"text"', None, True),
        ("{broken", None, True),
        ("", None, False),
        (None, None, False),
    ],
)
def test_canonical_json(spark, text, value, bad):
    df = spark.createDataFrame([(text,)], "c string")
    parsed = parsing.canonical_json("c")
    assert tuple(df.select(parsed.value, parsed.bad).first()) == (value, bad)


def test_json_or_text(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}',), ("24/7",), (None,)], "c string")
    got = [r[0] for r in df.select(parsing.json_or_text("c")).collect()]
    assert got == ['{"a":2,"b":1}', "24/7", None]


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    same = df.select(
        (keys.surrogate_key("x", "y") == F.md5(F.lit("a"))).alias("same")
    ).first()["same"]
    assert same


def test_zoned_key_text_does_not_depend_on_the_zone_spelling(spark):
    df = spark.sql("select timestamp'2026-07-18 00:00:00.50+02:00' as t")
    assert df.select(keys.time_text("t", zoned=True)).first()[0] == "2026-07-17 22:00:00.5+00"


@pytest.mark.parametrize(
    "bikes, capacity, expected",
    [(1, 800, "0.13"), (5, 20, "25.00"), (5, 0, "0.00"), (5, None, "0.00"), (None, 20, None),
     (30, 20, "150.00")],
)
def test_occupancy(spark, bikes, capacity, expected):
    df = spark.createDataFrame([(bikes, capacity)], "b int, c int")
    value = df.select(metrics.occupancy_pct("b", "c")).first()[0]
    assert value == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    "installed, renting, occupancy, label",
    [
        (False, False, "0", "Non installée"),
        (True, False, "0", "Hors service"),
        (True, True, "0", "Vide"),
        (True, True, "90", "Presque pleine"),
        (True, True, "15", "Presque vide"),
        (True, True, "15.01", "Normal"),
        (True, True, None, "Normal"),
    ],
)
def test_station_status_order(spark, installed, renting, occupancy, label):
    df = spark.createDataFrame(
        [(installed, renting, occupancy and Decimal(occupancy))],
        "i boolean, r boolean, o decimal(18,2)",
    )
    assert df.select(metrics.station_status("i", "r", "o")).first()[0] == label


def test_rates_guard_division(spark):
    df = spark.createDataFrame([(5, 0, Decimal("0")), (1455, 1516, Decimal("1.802"))],
                               "n int, d int, s decimal(12,3)")
    got = df.select(metrics.pct("n", "d"), metrics.per_second("d", "s")).collect()
    assert [tuple(map(str, r)) for r in got] == [("0.00", "0.00"), ("95.98", "841.29")]


def test_age_and_freshness_border(spark, utc):
    df = spark.sql("select timestamp'2026-07-17 20:00:00Z' as t")
    now = utc(2026, 7, 17, 22)
    row = df.select(metrics.data_age_minutes("t", now), metrics.is_fresh("t", now)).first()
    assert (row[0], row[1]) == (Decimal("120.00"), True)
    later = utc(2026, 7, 17, 22, 0, 1)
    assert df.select(metrics.is_fresh("t", later)).first()[0] is False


def test_success_pct_is_null_on_empty_input(spark):
    df = spark.createDataFrame([], "ok boolean")
    assert df.agg(metrics.success_pct("ok")).first()[0] is None


def test_months_before_clamps_to_month_end(utc):
    assert clock.months_before(utc(2024, 3, 31, 5), 1) == utc(2024, 2, 29, 5)
    assert clock.months_before(utc(2024, 1, 15), 6) == utc(2023, 7, 15)
    assert clock.first_day_from(datetime(2024, 1, 1)) == date(2024, 1, 1)
    assert clock.first_day_from(datetime(2024, 1, 1, 6)) == date(2024, 1, 2)
