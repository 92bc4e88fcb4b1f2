from __future__ import annotations

import pytest

from brambling.operators import cleaning, revenue
from brambling.session import scratch_path
from brambling.sources import lines as source
from brambling.sources.tables import calendar, read_calendar

LINES = """\
medallion,hack_license,vendor_id,pickup_datetime,payment_type,fare_amount,surcharge,mta_tax,tip_amount,tolls_amount,total_amount
m1,d1,CMT,2013-01-01 00:05:00,CRD,10.0,0.5,0.5,2,0,13.0
m1,d1,CMT,2013-01-01 09:00:00,CSH,5,0,0.5,0,0,5.5
m2,d2,VTS,2013-01-02 10:00:00,CRD,20.00,1,0.5,4.3,0, 25.80 \n\
m3,d3,NULL,2013-01-02 11:00:00,CSH,7,0,0.5,0,0,7.5
m3,NULLX,VTS,2013-01-04 11:00:00,CSH,7,0,0.5,0,0,7.5
m4,d4,VTS,2013/01/03 11:00:00,CSH,7,0,0.5,0,0,7.5
m4,d4,VTS,2013-13-45 99:99:99,CSH,1,0,0,0,0,1
m5,d5,VTS,2013-01-05 11:00:00Z,CSH,3,0,0,0,0,3
m5,d5,VTS,2013-01-05 12:00:00,CSH,-3,0,0,0,0,-3
m5,d5,VTS,2013-01-05 13:00:00,CSH,.5,0,0,0,0,5.
m5,d5,VTS,2013-01-05 14:00:00,CSH,1e2,0,0,0,0,100
m6,d1,VTS,2014-01-01 00:00:00,CRD,9,0,0,0,0,9""".split("\n")
SHORT = ["m7,d7,VTS", "m7,d7,VTS,2013-01-05 13:00:00,CSH,1,0,0,0,0"]


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def trips(spark):
    return cleaning.clean_trips(frame(spark, LINES)).cache()


def test_funnel(spark):
    steps = dict(rows(cleaning.clean_funnel(frame(spark, LINES))))
    assert steps == {"lines": 13, "not_null": 12, "valid_datetime": 10, "valid_money": 7, "exact_amount": 7}


def amounts(spark, *texts):
    lines = [f"m,d{i},V,2013-01-01 00:00:00,C,1,0,0,0,0,{text}" for i, text in enumerate(texts)]
    found = cleaning.clean_trips(frame(spark, lines)).collect()
    return dict(rows(cleaning.clean_funnel(frame(spark, lines)))), {int(r.driver[1:]): f"{r.amount:f}".rstrip("0").rstrip(".") for r in found}


def test_long_and_fine_amounts_stay_exact(spark):
    texts = ["123456789012345", "1234567890123456789012345", "1.00005", "\t7.5\t", "\u00a08\u3000", "0" * 40 + "12.50" + "0" * 40, "9" * 28 + "." + "9" * 10]
    steps, found = amounts(spark, *texts)
    assert steps["valid_money"] == steps["exact_amount"] == len(texts)
    assert found == dict(enumerate(["123456789012345", "1234567890123456789012345", "1.00005", "7.5", "8", "12.5", "9" * 28 + "." + "9" * 10]))


def test_amounts_beyond_the_type_are_counted(spark):
    steps, found = amounts(spark, "1" + "0" * 28, "0.12345678901", "5")
    assert (steps["valid_money"], steps["exact_amount"]) == (3, 1) and found == {2: "5"}


def test_sums_beyond_the_type_are_doubles(spark):
    big = "9" * 28
    lines = [f"m,d1,V,2013-01-0{i % 2 + 1} 00:00:00,C,1,0,0,0,0,{big}" for i in range(40)]
    trips = cleaning.clean_trips(frame(spark, lines))
    assert rows(revenue.revenue_by(trips, "driver")) == [("d1", pytest.approx(40 * float(big)))]
    assert dict(rows(revenue.revenue_by_weekday(trips, calendar(spark, 2013)))) == {d: pytest.approx(20 * float(big)) for d in ("Tuesday", "Wednesday")}


def test_null_lines_pass_no_check(spark):
    df = frame(spark, [None, LINES[1]])
    assert dict(rows(cleaning.clean_funnel(df))) == {"lines": 2, "not_null": 1, "valid_datetime": 1, "valid_money": 1, "exact_amount": 1}
    assert cleaning.drop_null_token(df).count() == cleaning.keep_datetime(df).count() == cleaning.keep_money(df).count() == 1


def test_short_lines_are_rejected(spark):
    steps = dict(rows(cleaning.clean_funnel(frame(spark, LINES + SHORT))))
    assert steps["lines"] == 15 and steps["valid_money"] == 7
    assert cleaning.clean_trips(frame(spark, SHORT)).count() == 0


def test_extra_fields_must_be_numbers(spark):
    good = LINES[1] + ",4"
    assert cleaning.clean_trips(frame(spark, [good, LINES[1] + ",x"])).count() == 1


def test_strict_datetime_rejects_impossible_dates(spark):
    df = frame(spark, LINES)
    assert cleaning.keep_datetime(df).count() - cleaning.keep_datetime(df, strict=True).count() == 1


def test_revenue_by_date(trips):
    by_date = revenue.revenue_by(trips, "date")
    assert rows(by_date.orderBy("revenue")) == [
        ("2013-13-45", 1.0),
        ("2013-01-05", 3.0),
        ("2013-01-04", 7.5),
        ("2014-01-01", 9.0),
        ("2013-01-01", 18.5),
        ("2013-01-02", 25.8),
    ]
    assert [r[0] for r in rows(revenue.smallest(by_date, "date"))][0] == "2013-13-45"
    assert revenue.smallest(by_date, "date").count() == 5


def test_revenue_by_driver(trips):
    by_driver = revenue.revenue_by(trips, "driver")
    assert rows(revenue.largest(by_driver, "driver")) == [
        ("d1", 27.5),
        ("d2", 25.8),
        ("NULLX", 7.5),
        ("d5", 3.0),
        ("d4", 1.0),
    ]


WEEKDAYS = [("Wednesday", 25.8), ("Tuesday", 18.5), ("Friday", 7.5), ("Saturday", 3.0)]


def test_revenue_by_weekday(spark, trips):
    assert rows(revenue.revenue_by_weekday(trips, calendar(spark, 2013))) == WEEKDAYS


def test_calendar_from_a_file_with_header(spark, trips):
    path = scratch_path(spark, "days")
    days = calendar(spark, 2013).selectExpr("concat(date, ',', weekday) AS value")
    source.write_lines(frame(spark, ["Date,WeekDay"]).unionAll(days), path)
    assert rows(revenue.revenue_by_weekday(trips, read_calendar(spark, path))) == WEEKDAYS


def test_repeated_calendar_days_multiply(spark, trips):
    days = calendar(spark, 2013)
    assert rows(revenue.revenue_by_weekday(trips, days.unionAll(days)))[0] == ("Wednesday", 51.6)


def test_calendar_year(spark):
    counts = dict(rows(calendar(spark, 2013).groupBy("weekday").count()))
    assert counts.pop("Tuesday") == 53 and set(counts.values()) == {52}


def test_lines_survive_a_file(spark):
    path = scratch_path(spark, "lines")
    source.write_lines(frame(spark, LINES), path)
    back = source.read_lines(spark, path + "/part-*")
    assert sorted(r[0] for r in back.collect()) == sorted(LINES)
    fields = source.with_fields(back)
    assert fields.columns == list(source.TRIP_FIELDS)
    assert fields.where("total_amount = ' 25.80 '").first().medallion == "m2"


def test_split_keeps_empty_fields(spark):
    df = frame(spark, ["a,,"]).select(source.split_line())
    assert df.first()[0] == ["a", "", ""]
