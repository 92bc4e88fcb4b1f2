"""Trip lines made from ``lineitem``, cleaned and summed."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.operators import cleaning, revenue
from brambling.plans.tables import read
from brambling.session import scratch_path
from brambling.sources import lines as source
from brambling.sources.tables import calendar, read_calendar

# The calendar file covers all years of the line items but for the days of one date of each month.
FIRST_YEAR, LAST_YEAR = 1992, 1998
MISSING_DAY = "-13"


def trip_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One line of 11 fields per line item; some discounts and taxes mark a kind of dirt."""
    discount, tax = F.col("l_discount"), F.col("l_tax")

    def money(name: str):
        return F.col(name).cast("decimal(18,2)").cast("string")

    vendor = (
        F.when(discount == 0.05, "NULL").when(discount == 0.06, "NULLX").otherwise(F.col("l_returnflag"))
    )
    time = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    pickup = F.when(tax == 0.03, F.translate(time, "-", "/")).when(tax == 0.04, F.concat(time, F.lit("Z"))).otherwise(time)
    fare = money("l_extendedprice")
    fare = (
        F.when(discount == 0.07, F.concat(F.lit("-"), fare))
        .when(discount == 0.08, F.concat(fare, F.lit("e1")))
        .otherwise(fare)
    )
    total = money("l_extendedprice")
    total = F.when(tax == 0.05, F.concat(F.lit("  "), total, F.lit(" "))).otherwise(total)
    return read(spark, folder, "lineitem").select(
        F.concat_ws(
            ",",
            F.concat(F.lit("m"), "l_suppkey"),
            F.concat(F.lit("d"), "l_partkey"),
            vendor,
            pickup,
            F.when(F.col("l_linestatus") == "O", "CRD").otherwise("CSH"),
            fare,
            money("l_discount"),
            money("l_tax"),
            F.lit("0"),
            money("l_quantity"),
            total,
        ).alias("value")
    )


@cache
def trip_file(spark: SparkSession, folder: str) -> str:
    """The trip lines as a text file, written once per session."""
    path = scratch_path(spark, "trips")
    source.write_lines(trip_lines(spark, folder), path)
    return path


@cache
def calendar_file(spark: SparkSession) -> str:
    """The calendar as lines under a header, written once per session."""
    path = scratch_path(spark, "calendar")
    days = calendar(spark, FIRST_YEAR, LAST_YEAR).where(~F.col("date").endswith(MISSING_DAY))
    header = spark.createDataFrame([("date,weekday",)], "value string")
    source.write_lines(header.unionAll(days.select(F.concat_ws(",", "date", "weekday").alias("value"))), path)
    return path


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return source.read_lines(spark, trip_file(spark, folder))


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_trips(raw(spark, folder))


def read_delimited_lines(spark: SparkSession, folder: str) -> DataFrame:
    return source.with_fields(raw(spark, folder))


def drop_null_token(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_null_token(raw(spark, folder))


def valid_datetime(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.keep_datetime(raw(spark, folder))


def valid_money(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.keep_money(raw(spark, folder))


def clean_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_funnel(raw(spark, folder))


def revenue_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.revenue_by(trips(spark, folder), "date")


def bottom_k_dates(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.smallest(revenue_by_date(spark, folder), "date")


def revenue_by_driver(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.revenue_by(trips(spark, folder), "driver")


def top_k_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.largest(revenue_by_driver(spark, folder), "driver")


def revenue_by_weekday(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.revenue_by_weekday(trips(spark, folder), read_calendar(spark, calendar_file(spark)))


QUERIES = {
    f.__name__: f
    for f in (
        read_delimited_lines,
        drop_null_token,
        valid_datetime,
        valid_money,
        clean_funnel,
        revenue_by_date,
        bottom_k_dates,
        revenue_by_driver,
        top_k_drivers,
        revenue_by_weekday,
    )
}

LINES = r"""
raw AS (
  SELECT *, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS t, l_extendedprice::DECIMAL(18,2)::VARCHAR AS price
  FROM lineitem),
lines AS (
  SELECT concat_ws(',', 'm' || l_suppkey, 'd' || l_partkey,
    CASE l_discount WHEN 0.05 THEN 'NULL' WHEN 0.06 THEN 'NULLX' ELSE l_returnflag END,
    CASE l_tax WHEN 0.03 THEN replace(t, '-', '/') WHEN 0.04 THEN t || 'Z' ELSE t END,
    CASE WHEN l_linestatus = 'O' THEN 'CRD' ELSE 'CSH' END,
    CASE l_discount WHEN 0.07 THEN '-' || price WHEN 0.08 THEN price || 'e1' ELSE price END,
    l_discount::DECIMAL(18,2)::VARCHAR, l_tax::DECIMAL(18,2)::VARCHAR, '0', l_quantity::DECIMAL(18,2)::VARCHAR,
    CASE WHEN l_tax = 0.05 THEN '  ' || price || ' ' ELSE price END) AS value
  FROM raw),
fields AS (SELECT value, string_split(value, ',') AS f FROM lines),
checks AS (
  SELECT value, f, NOT list_contains(f, 'NULL') AS a,
    regexp_matches(f[4], '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}') AS b,
    len(list_filter(f[6:], lambda x: NOT regexp_full_match(trim(x), '\d+(\.\d+)?'))) = 0 AS c
  FROM fields),
trips AS (
  SELECT string_split(f[4], ' ')[1] AS date, f[2] AS driver, trim(f[11])::DECIMAL(38,10) AS amount
  FROM checks WHERE a AND b AND c)
"""


def oracles() -> dict[str, str]:
    def sql(select: str) -> str:
        return f"WITH {LINES} {select}"

    fields = ", ".join(f"f[{i}] AS {name}" for i, name in enumerate(source.TRIP_FIELDS, 1))
    by_date = "SELECT date, sum(amount)::DOUBLE AS revenue FROM trips GROUP BY date"
    by_driver = "SELECT driver, sum(amount)::DOUBLE AS revenue FROM trips GROUP BY driver"
    return {
        "read_delimited_lines": sql(f"SELECT {fields} FROM fields"),
        "drop_null_token": sql("SELECT value FROM checks WHERE a"),
        "valid_datetime": sql("SELECT value FROM checks WHERE b"),
        "valid_money": sql("SELECT value FROM checks WHERE c"),
        "clean_funnel": sql(
            "SELECT 'lines' AS step, count(*) AS rows_left FROM checks"
            " UNION ALL SELECT 'not_null', count(*) FROM checks WHERE a"
            " UNION ALL SELECT 'valid_datetime', count(*) FROM checks WHERE a AND b"
            " UNION ALL SELECT 'valid_money', count(*) FROM checks WHERE a AND b AND c"
            " UNION ALL SELECT 'exact_amount', count(*) FROM trips"
        ),
        "revenue_by_date": sql(by_date),
        "bottom_k_dates": sql(by_date + " ORDER BY revenue, date LIMIT 5"),
        "revenue_by_driver": sql(by_driver),
        "top_k_drivers": sql(by_driver + " ORDER BY revenue DESC, driver LIMIT 5"),
        "revenue_by_weekday": sql(
            "SELECT dayname(d) AS weekday, sum(amount)::DOUBLE AS revenue FROM trips JOIN"
            f" (SELECT unnest(generate_series(DATE '{FIRST_YEAR}-01-01', DATE '{LAST_YEAR}-12-31', INTERVAL 1 DAY)) AS d)"
            " ON date = strftime(d, '%Y-%m-%d') WHERE day(d) <> 13 GROUP BY weekday"
        ),
    }
