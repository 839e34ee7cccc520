"""Column expressions shared by batch and streaming plans.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the fee computation.
SATOSHI_PER_COIN = 100_000_000
FEE_RATE_DIGITS = 2  # fee rate is rounded half-even to 2 digits
PUBLISHED_RATE_DIGITS = 4  # the published mean fee rate keeps 4 digits
WINDOW_DURATION = "2 seconds"
WATERMARK_DELAY = "1 second"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def fee(in_total: str | Column, out_total: str | Column) -> Column:
    """Fee in satoshi: inputs minus outputs (bigint subtraction)."""
    return _col(in_total) - _col(out_total)


def fee_rate(fee_col: str | Column, size: str | Column) -> Column:
    """Satoshi per byte, rounded half-even to 2 digits.

    ``try_divide`` keeps the pre-ANSI behaviour of the original job: a size of 0
    or NULL yields NULL (and the row is later dropped) instead of failing.
    """
    return F.bround(F.try_divide(_col(fee_col), _col(size)), FEE_RATE_DIGITS)


def rate_cents(rate: str | Column) -> Column:
    """A 2-digit fee rate as an exact integer count of hundredths."""
    return F.round(_col(rate) * 100).cast("bigint")


def to_coins(sat: str | Column) -> Column:
    """Satoshi to coins as a double."""
    return _col(sat) / F.lit(float(SATOSHI_PER_COIN))


def coins_text(sat: str | Column) -> Column:
    """Satoshi to an exact decimal string of coins with 8 digits, e.g. "8.43681216".

    Built with integer arithmetic so no binary rounding can creep in.
    """
    s = _col(sat)
    unit = F.lit(SATOSHI_PER_COIN).cast("bigint")
    frac = F.pmod(s, unit)
    whole = F.call_function("div", s - frac, unit)
    return F.format_string("%d.%08d", whole, frac)


def half_up_div(n: str | Column, d: int) -> Column:
    """Integer division of a bigint by a positive constant, rounding halves away from zero."""
    n = _col(n)
    dd = F.lit(d).cast("bigint")
    half = F.lit(d // 2).cast("bigint")
    return F.when(n >= 0, F.call_function("div", n + half, dd)).otherwise(-F.call_function("div", half - n, dd))


def cents_of(price: str | Column) -> Column:
    """A 2-decimal money amount (double) as integer hundredths, rounded half-up."""
    return F.round(_col(price) * 100).cast("bigint")


def discounted_cents_of(price: str | Column, discount: str | Column) -> Column:
    """price * (1 - discount) in hundredths, exactly: integer arithmetic on cents and percent.

    Equal to rounding the exact decimal product half-up, without decimal arithmetic
    in the hot loop.
    """
    pct = F.round(_col(discount) * 100).cast("bigint")
    return half_up_div(cents_of(price) * (F.lit(100).cast("bigint") - pct), 100)


def ntz_to_epoch_seconds(ts: str | Column) -> Column:
    """Seconds since the epoch of a timestamp_ntz read as UTC wall-clock time.

    Independent of the session time zone, unlike ``unix_timestamp``.
    """
    return F.timestamp_diff("SECOND", epoch_ntz(), _col(ts))


def ntz_to_instant(ts: str | Column) -> Column:
    """timestamp_ntz (UTC wall clock) to a TIMESTAMP instant, zone-free.

    Streaming watermarks need TIMESTAMP, not timestamp_ntz.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch_ntz(), _col(ts)))


def instant_to_ntz(ts: str | Column) -> Column:
    """TIMESTAMP instant back to its UTC wall-clock timestamp_ntz, zone-free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch_ntz())


def epoch_to_instant(sec: str | Column) -> Column:
    """Epoch seconds to a TIMESTAMP instant.

    The original job went through ``from_unixtime``, a session-zone string;
    ``timestamp_seconds`` gives the same instant without the zone round trip.
    """
    return F.timestamp_seconds(_col(sec))


def epoch_to_ntz(sec: str | Column) -> Column:
    """Epoch seconds to a UTC wall-clock timestamp_ntz."""
    return F.timestamp_add("SECOND", _col(sec), epoch_ntz())
