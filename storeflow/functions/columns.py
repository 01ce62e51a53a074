"""Column expressions shared by the operators.  All of them stay in the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeflow.schemas import MONEY

# The mark-up on cost, and the reorder level of a product without its own.
MARK_UP = Decimal("1.2")
DEFAULT_REORDER_LEVEL = 50


def sale_price(cost: Column | str) -> Column:
    """Selling price for a unit cost; decimal arithmetic, half-up to the cent."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    return (cost.cast(MONEY) * F.lit(MARK_UP)).cast(MONEY)


def with_event_time(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Turn a text column into an event time; text that is no time becomes null."""
    return df.withColumn(out or column, F.col(column).try_cast("timestamp_ntz"))


def second_of(ts: str) -> Column:
    """Event time cut to the whole second, without a detour over the session zone."""
    fraction = F.extract(F.lit("SECOND"), ts) - F.second(ts)
    return F.col(ts) - F.make_dt_interval(secs=fraction)


def time_key(ts: Column | str) -> Column:
    """Key of a time row: seconds since 1970-01-01 on the invoice's own clock.

    Built from the clock's parts, so the session time zone cannot shift it.
    """
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return days * 86400 + clock


def day_of(time_id: Column | str) -> Column:
    """The date a time key lies in; see :func:`time_key`."""
    time_id = F.col(time_id) if isinstance(time_id, str) else time_id
    return F.date_from_unix_date(F.floor(time_id / 86400).cast("int"))


def line_key() -> Column:
    """Identity of a sold line: its message and its number there."""
    return F.concat_ws("-", F.col("source_id").cast("string"), F.col("line_no").cast("string"))


def calendar(ts: str) -> list[Column]:
    """Calendar columns of a time row; weekday counts from 1 = Sunday."""
    return [
        F.to_date(ts).alias("date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"),
        F.second(ts).alias("second"),
        F.dayofweek(ts).alias("weekday"),
    ]


def stamped(df: DataFrame, column: str) -> DataFrame:
    """Add the time of writing, in UTC: later rows carry later times, also when a clock goes back."""
    since_1970 = F.make_dt_interval(secs=(F.unix_micros(F.current_timestamp()) / 1_000_000).cast("decimal(18,6)"))
    return df.withColumn(column, F.lit("1970-01-01").cast("timestamp_ntz") + since_1970)


def money_label(amount: Column | str) -> Column:
    """Whole-unit amount with thousands separators, as put above a bar."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.format_number(amount.cast("decimal(25,0)"), 0)


def pct_label(pct: Column | str) -> Column:
    """Percentage with one decimal, as put in a pie slice.

    Takes a decimal: formatting a double would round its printed digits instead.
    """
    pct = F.col(pct) if isinstance(pct, str) else pct
    return F.concat(pct.cast("decimal(5,1)").cast("string"), F.lit("%"))
