"""Row checks for raw delimited lines, and the row count after each check.

Every check reads the whole line, so it stays inside generated code and the line is split only
once, for the rows that pass. The patterns are possessive: a line that fails is not tried again in
other ways.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.sources.lines import with_fields

# The missing-value token and the two field formats.
NULL_TOKEN = "NULL"
DATETIME = "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
# White space of any script, and the four separators below the blank.
BLANK = r"[\s\x1c-\x1f]"
MONEY = rf"{BLANK}*+[0-9]++(?:\.[0-9]++)?+{BLANK}*+"

# Amounts are kept exact, so that sums do not depend on row order: 28 digits before the point and 10
# behind it, not counting zeros at either end. Lines with longer amounts are a step of the funnel.
WHOLE, FRACTION = 28, 10
AMOUNT = f"decimal({WHOLE + FRACTION},{FRACTION})"
DIGITS = rf"0*+[0-9]{{0,{WHOLE}}}+(?:\.[0-9]{{0,{FRACTION}}}+0*+)?+"
AMOUNT_FIELD = 10


def _sure(check: Column) -> Column:
    """A line that is null passes no check."""
    return F.coalesce(check, F.lit(False))


def has_no_null(line: Column) -> Column:
    """No field is exactly the missing-value token."""
    return _sure(~F.concat(F.lit(","), line, F.lit(",")).contains(f",{NULL_TOKEN},"))


def has_datetime(line: Column, field: int = 3, strict: bool = False) -> Column:
    """Field ``field`` starts with a date and time; ``strict`` also wants it to be a real one."""
    looks_right = _sure(line.rlike(f"^(?:[^,]*+,){{{field}}}{DATETIME}"))
    if not strict:
        return looks_right
    text = F.substring(F.get(F.split(line, ","), field), 1, 19)
    return looks_right & F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()


def has_money(line: Column, first: int = 5, at_least: int = 6) -> Column:
    """Fields ``first`` onwards, at least ``at_least`` of them, are all non-negative plain numbers."""
    return _sure(line.rlike(f"(?U)^(?:[^,]*+,){{{first}}}{MONEY}(?:,{MONEY}){{{at_least - 1},}}+$"))


def holds_amount(line: Column, field: int = AMOUNT_FIELD) -> Column:
    """Field ``field``, a plain number, fits the exact type of amounts as it stands."""
    return _sure(line.rlike(f"(?U)^(?:[^,]*+,){{{field}}}{BLANK}*+{DIGITS}{BLANK}*+(?:,|$)"))


def amount_of(text: Column) -> Column:
    """The exact amount of a plain number that ``holds_amount`` has passed."""
    digits = F.regexp_extract(text, f"(?U)^{BLANK}*+0*+([0-9]*+(?:\\.[0-9]{{0,{FRACTION}}}+)?+)", 1)
    return F.concat(F.lit("0"), digits).try_cast(AMOUNT)


def drop_null_token(lines: DataFrame) -> DataFrame:
    return lines.where(has_no_null(F.col("value")))


def keep_datetime(lines: DataFrame, strict: bool = False) -> DataFrame:
    return lines.where(has_datetime(F.col("value"), strict=strict))


def keep_money(lines: DataFrame) -> DataFrame:
    return lines.where(has_money(F.col("value")))


def clean_trips(lines: DataFrame) -> DataFrame:
    """``(date, driver, amount)`` of the lines that pass all checks."""
    kept = keep_money(keep_datetime(drop_null_token(lines))).where(holds_amount(F.col("value")))
    fields = with_fields(kept)
    return fields.select(
        F.substring_index("pickup_datetime", " ", 1).alias("date"),
        F.col("hack_license").alias("driver"),
        amount_of(F.col("total_amount")).alias("amount"),
    )


def clean_funnel(lines: DataFrame) -> DataFrame:
    """``(step, rows_left)``: all lines and what each check leaves, from one pass."""
    line = F.col("value")
    passed = (
        F.when(~has_no_null(line), 0)
        .when(~has_datetime(line), 1)
        .when(~has_money(line), 2)
        .when(~holds_amount(line), 3)
        .otherwise(4)
    )
    steps = ["lines", "not_null", "valid_datetime", "valid_money", "exact_amount"]
    counts = lines.select(passed.alias("passed")).agg(
        *[F.count_if(F.col("passed") >= i).alias(step) for i, step in enumerate(steps)]
    )
    return counts.unpivot([], steps, "step", "rows_left")
