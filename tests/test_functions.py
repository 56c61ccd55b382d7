import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal
from parcelflow.functions import metrics as m


def one(spark, exprs, schema="x timestamp_ntz", row=None):
    df = spark.createDataFrame([row or (None,)], schema)
    return df.select(*exprs).first()


def test_weekday_bases(spark):
    r = one(spark, [cal.iso_weekday("x").alias("iso"), cal.pg_dow("x").alias("dow"), cal.is_weekend("x").alias("we")],
            row=(dt.datetime(2026, 11, 29, 10, 0),))
    assert (r.iso, r.dow, r.we) == (7, 0, True)


def test_iso_week_year_quarter(spark):
    r = one(spark, [cal.iso_week("x").alias("w"), F.year("x").alias("y"), cal.quarter("x").alias("q"),
                    cal.date_key("x").alias("k")], schema="x date", row=(dt.date(2027, 1, 1),))
    assert (r.w, r.y, r.q, r.k) == (53, 2027, 1, 20270101)


def test_hour_attributes(spark):
    hours = [0, 6, 8, 12, 14, 18, 22]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    rows = df.select(
        "h", cal.time_of_day("h").alias("tod"), cal.shift("h").alias("shift"),
        cal.is_business_hour("h").alias("biz"), cal.hour_12_label("h").alias("h12"),
        cal.hour_24_label("h").alias("h24"),
    ).orderBy("h").collect()
    got = {r.h: (r.tod, r.shift, r.biz, r.h12, r.h24) for r in rows}
    assert got[0] == ("Madrugada", "Turno 3", False, "12:00 AM", "00:00")
    assert got[6] == ("Mañana", "Turno 1", False, "06:00 AM", "06:00")
    assert got[8][2] is True
    assert got[12] == ("Tarde", "Turno 1", True, "12:00 PM", "12:00")
    assert got[14][1] == "Turno 2"
    assert got[18] == ("Noche", "Turno 2", False, "06:00 PM", "18:00")
    assert got[22][1] == "Turno 3"


def test_months_by_calendar_ignores_day(spark):
    r = one(spark, [cal.months_by_calendar(dt.date(2026, 3, 1), "x").alias("m")], schema="x date",
            row=(dt.date(2026, 1, 31),))
    assert r.m == 2


def test_months_before_clamps_to_month_end():
    assert cal.months_before(dt.date(2026, 8, 31), 6) == dt.date(2026, 2, 28)
    assert cal.days_before("2001-09-01", 60) == dt.date(2001, 7, 3)


def test_minutes_between_exact_and_signed(spark):
    r = one(spark, [cal.minutes_between("a", "b").alias("m")], schema="a timestamp_ntz, b timestamp_ntz",
            row=(dt.datetime(2026, 1, 1, 10, 0, 30), dt.datetime(2026, 1, 1, 9, 0, 0)))
    assert r.m == D("-60.5")


def test_weekday_name_is_padded_lower_case(spark):
    r = one(spark, [cal.weekday_name_pg("x").alias("d"), cal.month_name("x", "es").alias("mes"),
                    cal.period_label("x").alias("p")], row=(dt.datetime(2001, 9, 3, 8, 0),))
    assert r.d == "monday   "
    assert r.mes == "Septiembre"
    assert r.p == "09 2001"


def test_signature_rule(spark):
    df = spark.createDataFrame([("signed",), ("",), (None,), ("false",)], "s string")
    assert [r.h for r in df.select(m.has_signature("s").alias("h")).collect()] == [True, False, False, True]


def test_cost_rounding_half_even(spark):
    df = spark.createDataFrame(
        [(D("20.05"), D("0.00"), 2), (None, D("0.25"), 2)], "fuel decimal(10,2), toll decimal(10,2), n bigint"
    )
    got = [r.c for r in df.select(m.cost_per_delivery("fuel", "toll", "n").alias("c")).collect()]
    assert got == [D("50125.00"), D("0.12")]


def test_weight_range_is_open(spark):
    df = spark.createDataFrame([(D(x),) if x else (None,) for x in ["0", "0.01", "9999.99", "10000", None]],
                               "w decimal(10,2)")
    kept = [r.w for r in df.where(m.weight_in_range("w")).collect()]
    assert kept == [D("0.01"), D("9999.99")]


def test_zero_divisors_give_null(spark):
    df = spark.createDataFrame([(3, D("0.00"), D("120.00"), D("0.00"))],
                               "n bigint, hours decimal(10,2), km decimal(10,2), fuel decimal(10,2)")
    r = df.select(
        m.deliveries_per_hour("n", m.zero_to_null("hours")).alias("dph"),
        m.fuel_efficiency("km", m.zero_to_null("fuel")).alias("eff"),
    ).first()
    assert r.dph is None and r.eff is None


def test_format_code_never_truncates(spark):
    df = spark.createDataFrame([(1,), (12345,)], "n bigint")
    got = [r.c for r in df.select(m.format_code("EMP", "n", 4).alias("c")).collect()]
    assert got == ["EMP0001", "EMP12345"]
    r = df.select(m.tracking_code(2026, "n").alias("t")).first()
    assert r.t == "FL202600000001"


def test_toll_by_band(spark):
    df = spark.createDataFrame([(D("99.99"),), (D("460.00"),), (D("1050.00"),)], "d decimal(10,2)")
    assert [r.t for r in df.select(m.toll_by_band("d").alias("t")).collect()] == [D("0"), D("60000"), D("150000")]


def test_parse_datetime(spark):
    df = spark.createDataFrame([("2026-11-02 09:10:00",), ("not a date",), (None,)], "s string")
    got = [r.t for r in df.select(cal.parse_datetime("s").alias("t")).collect()]
    assert got == [dt.datetime(2026, 11, 2, 9, 10), None, None]
    r = df.select(cal.parse_datetime(F.lit("02/11/2026 07:00"), "dd/MM/yyyy HH:mm").alias("t")).first()
    assert r.t == dt.datetime(2026, 11, 2, 7, 0)


def test_text_builders(spark):
    df = spark.createDataFrame([("Calle 5 # 10-20", "Cali", "Cambio de aceite", dt.date(2026, 3, 4))],
                               "street string, city string, kind string, day date")
    r = df.select(m.address_text("street", "city").alias("a"),
                  m.maintenance_description("kind", "day").alias("d")).first()
    assert r.a == "Calle 5 # 10-20, Cali"
    assert r.d == "Cambio de aceite programado para 2026-03-04"
