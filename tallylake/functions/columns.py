"""Column expressions used by several operators; all of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed exactly: 32 digits before the point, 6 after it. Amounts from MOST_MONEY on are no money: their rows
# count as rows, but are left out of totals and means, which so cannot overflow below 10**12 rows.
MONEY = "decimal(38,6)"
MOST_MONEY = 1e20

# Plain decimal or scientific notation. Excludes NaN, Infinity and the d/f suffixes a cast would accept.
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def parse_amount(text: Column) -> Column:
    """Number held by `text`, NULL for anything else."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def parse_event_time(text: Column, pattern: str) -> Column:
    """Timestamp held by ISO-8601 `text`, NULL for anything else; a text without an offset is UTC."""
    zoned = F.when(text.rlike("(Z|[+-][0-9]{2}:[0-9]{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(pattern), zoned.try_cast("timestamp"))


# The next ones take dates and times from the microseconds since 1970, so no session time zone has a say.


def _units(ts: Column, seconds: int) -> Column:
    """Whole units of so many seconds since 1970, rounded down."""
    return block_of(F.unix_micros(ts), seconds * 1_000_000)


def utc_date(ts: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), _units(ts, 86_400).cast("int"))


def utc_hour(ts: Column) -> Column:
    return F.pmod(_units(ts, 3_600), F.lit(24)).cast("int")


def utc_minute(ts: Column) -> Column:
    return F.pmod(_units(ts, 60), F.lit(60)).cast("int")


def iso_text(ts: Column) -> Column:
    millis = F.pmod(block_of(F.unix_micros(ts), 1_000), F.lit(60_000)).cast("string")
    seconds = F.lpad(millis, 5, "0")
    clock = [F.lpad(c.cast("string"), 2, "0") for c in (utc_hour(ts), utc_minute(ts))]
    return F.concat(
        utc_date(ts).cast("string"), F.lit("T"), clock[0], F.lit(":"), clock[1], F.lit(":"), F.substring(seconds, 1, 2),
        F.lit("."), F.substring(seconds, 3, 3), F.lit("Z"),
    )


def date_key(ts: Column) -> Column:
    return key_of_date(utc_date(ts))


def key_of_date(date: Column) -> Column:
    return F.year(date) * 10_000 + F.month(date) * 100 + F.dayofmonth(date)


def codes(rules: Iterable[tuple[str, Column]]) -> Column:
    """Array of the codes whose condition holds, in the given order."""
    return F.filter(
        F.array(*[F.when(condition, F.lit(code)) for code, condition in rules]),
        lambda code: code.isNotNull(),
    )


def money(amount: Column) -> Column:
    """Amount as money; NULL, and so left out of totals and means, from MOST_MONEY on."""
    return F.when(F.abs(amount) < MOST_MONEY, amount.try_cast(MONEY))


def money_sum(amount: Column) -> Column:
    """Order-independent sum of an amount column, as double."""
    return F.sum(money(amount)).cast("double")


def money_mean(amount: Column) -> Column:
    """Order-independent mean of an amount column, as double."""
    return F.sum(money(amount)).cast("double") / F.nullif(F.count(money(amount)), F.lit(0))


def count_if(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not NULL, on an empty input."""
    return F.count(F.when(condition, F.lit(1)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 when the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def block_of(axis: Column, length: int) -> Column:
    """Number of the block of `length` units that a whole number falls into, in exact arithmetic."""
    return F.call_function("div", axis - F.pmod(axis, F.lit(length)), F.lit(length))
