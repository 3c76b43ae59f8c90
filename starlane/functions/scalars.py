"""Column expressions shared by every operator (all JVM-side, codegen-able)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "as_col",
    "round_half_away",
    "round2",
    "elapsed_seconds",
    "rounded_at_most",
    "int_rounded",
    "ntz",
    "date_key",
    "time_key",
    "hour_of_key",
    "day_of_week0",
    "SURROGATE_NULL_TOKEN",
    "double_text",
    "surrogate_key",
    "exact_parts",
    "total_of",
    "exact_sum",
    "exact_avg",
    "is_fixed_holiday",
    "FIXED_HOLIDAYS",
]

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(x: ColumnOrName, digits: int = 2) -> Column:
    """Round a double the way the reference engine does.

    The value is scaled in binary and rounded half away from zero, so
    0.145 -> 0.14 (0.145 is 0.14499.. in binary) where ``F.round`` gives
    0.15. Values that have no such digits any more (1e15 and more after
    scaling), NaN and infinities are returned as is: ``floor`` would
    saturate at 2^63.
    """
    x = as_col(x)
    scale = float(10**digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) < F.lit(1e15), rounded).otherwise(x)


def round2(x: ColumnOrName) -> Column:
    return round_half_away(x, 2)


def elapsed_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds between two wall-clock timestamps as a double, fractions kept.

    From the fields of the interval between them: no cast to an instant, so
    the session time zone and its clock changes play no part.
    """
    span = as_col(end) - as_col(start)
    whole = F.extract(F.lit("DAY"), span) * 86400 + F.extract(F.lit("HOUR"), span) * 3600 + F.extract(F.lit("MINUTE"), span) * 60
    micros = whole.cast("long") * 1000000 + (F.extract(F.lit("SECOND"), span) * 1000000).cast("long")
    return micros / F.lit(1e6)


def rounded_at_most(x: ColumnOrName, bound: float, digits: int = 2) -> Column:
    """``round_half_away(x, digits) <= bound`` for x >= 0, without the rounding.

    Rounding gives k / 10^digits with k = floor(x * 10^digits + 0.5), so
    the test is x * 10^digits + 0.5 < K + 1, K the largest k whose quotient
    is still <= bound. Same floating-point steps as ``round_half_away``, so
    it is exact, but the predicate stays small when Catalyst pushes it
    below the projection that computes x.
    """
    import math

    scale = float(10**digits)
    k = math.floor(bound * scale) + 1
    while k / scale > bound:
        k -= 1
    return as_col(x) * F.lit(scale) + F.lit(0.5) < F.lit(float(k + 1))


def int_rounded(x: ColumnOrName, source_type: T.DataType | None) -> Column:
    """``cast(x as integer)`` that rounds fractional input half to even.

    Spark truncates on cast; the reference rounds (1.5 -> 2, 2.5 -> 2).
    """
    x = as_col(x)
    if isinstance(source_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.rint(x).cast("int")
    return x.cast("int")


def ntz(value: date | datetime | str) -> Column:
    """A timestamp_ntz literal (constant-folded, pushable to Parquet)."""
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        text = value.isoformat()
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def date_key(ts: ColumnOrName) -> Column:
    """YYYYMMDD as int, computed arithmetically (no string formatting)."""
    ts = as_col(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: ColumnOrName) -> Column:
    """HHMM as int."""
    ts = as_col(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def hour_of_key(key: ColumnOrName) -> Column:
    """Integer division of an HHMM key by 100."""
    return F.floor(as_col(key) / F.lit(100)).cast("int")


def day_of_week0(d: ColumnOrName) -> Column:
    """Day of week with 0 = Sunday (Spark's ``dayofweek`` has 1 = Sunday)."""
    return (F.dayofweek(as_col(d)) - F.lit(1)).cast("int")


# Fixed value: the text that stands for a NULL key part. It must equal the
# token of the public surrogate-key macro the reference calls, or trip ids
# would not match.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def double_text(x: ColumnOrName) -> Column:
    """Text of a double as the reference engine writes it: plain digits from
    1e-4 up to 1e16 (Spark switches to an exponent outside 1e-3..1e7), and
    beyond them an exponent with sign and at least two digits."""
    x = as_col(x)
    own, size = x.cast("string"), F.abs(x)
    plain = F.rtrim(own.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    digits = F.regexp_replace(F.substring_index(own, "E", 1), r"\.0$", "")
    power = F.substring_index(own, "E", -1).try_cast("int")
    power_text = F.concat(
        F.when(power < 0, "e-").otherwise("e+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string")
    )
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), own)
        .when(F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(digits, power_text))
    )


def surrogate_key(
    cols: Iterable[ColumnOrName],
    null_token: str = SURROGATE_NULL_TOKEN,
    sep: str = "-",
    doubles: Iterable[str] = (),
) -> Column:
    """md5 hex of the parts' text joined by ``sep``; NULL parts become a token.

    Columns named in ``doubles`` are written by ``double_text``; timestamps
    and integers read alike in both engines.
    """
    wide = set(doubles)

    def text(c: ColumnOrName) -> Column:
        own = double_text(c) if isinstance(c, str) and c in wide else as_col(c).cast("string")
        return F.coalesce(own, F.lit(null_token))

    return F.md5(F.concat_ws(sep, *[text(c) for c in cols]))


# An exact sum holds its value in limbs: runs of at most 24 bits, so that a long
# takes 2^39 values (5 * 10^11) of any size in a group.
_BITS = 24
_UNITS = 1e8  # the rest of a hundredth is counted in units of 1e-10
_HELD = 2.0**55
SUM_PARTS = ("cents0", "cents1", "cents2", "units0", "units1", "rest0", "rest1", "other")


def _limbs(x: Column, n: int) -> list[Column]:
    mask = F.lit((1 << _BITS) - 1).cast("long")
    return [(F.shiftright(x, _BITS * i) if i else x).bitwiseAND(mask) for i in range(n - 1)] + [F.shiftright(x, _BITS * (n - 1))]


def exact_parts(x: ColumnOrName) -> dict[str, Column]:
    """Aggregates that together hold the sum of a double column.

    A value under 2^55 (3.6e16) is split into whole hundredths, what is left in
    units of 1e-10, and the rest of a unit in 48 binary places, each summed as
    longs: fixed-width and independent of the order of addition. A double that
    is the nearest one to a number of two places (of ten, under 9e5) counts as
    that number. What lies outside is not dropped: NaN, infinities and larger
    values, and what a value has below 3e-25, go into a sum of doubles. Parts
    of several groups add up part by part.
    """
    x = as_col(x).cast("double")
    held = F.when(F.abs(x) < F.lit(_HELD), x)  # NaN is above all numbers
    whole = held.cast("long")
    inside = held - whole
    cents_inside = F.rint(inside * F.lit(100.0))
    cents = whole * 100 + cents_inside.cast("long")
    left = F.when(cents / F.lit(100.0) == held, F.lit(0.0)).otherwise(inside - cents_inside / F.lit(100.0)) * F.lit(_UNITS * 100)
    units = F.rint(left)
    named = (F.abs(held) < F.lit(9e5)) & ((cents * F.lit(_UNITS) + units) / F.lit(_UNITS * 100) == held)
    rest = F.when(held.isNotNull(), F.when(named, F.lit(0.0)).otherwise(left - units)) * F.lit(2.0 ** (2 * _BITS))
    places = rest.cast("long")
    below = rest - places
    other = F.when(held.isNull(), x).when(below != 0, below * F.lit(2.0 ** (-2 * _BITS)) / F.lit(_UNITS * 100))
    limbs = [*_limbs(cents, 3), *_limbs(units.cast("long"), 2), *_limbs(places, 2)]
    return {name: F.sum(c) for name, c in zip(SUM_PARTS, [*limbs, other])}


def total_of(**parts: Column) -> Column:
    """The sum from its parts; NULL over no values."""

    def joined(name: str, n: int) -> Column:
        # As a decimal, so that limbs of opposite sign lose nothing.
        total = parts[f"{name}0"].cast("decimal(38,0)")
        for i in range(1, n):
            total = total + parts[f"{name}{i}"].cast("decimal(20,0)") * F.lit(1 << (_BITS * i)).cast("decimal(17,0)")
        return total.cast("double")

    cents, units = joined("cents", 3), joined("units", 2) + joined("rest", 2) * F.lit(2.0 ** (-2 * _BITS))
    # Closer to a number of ten places than the sum's own last place: that number.
    near = F.rint(units)
    close = F.abs(units - near) <= F.abs(cents * F.lit(_UNITS) + units) * F.lit(2.0**-51)
    exact = (cents + F.when(close, near).otherwise(units) / F.lit(_UNITS)) / F.lit(100.0)
    other = parts["other"]
    return F.when(parts["cents0"].isNull(), other).when(other.isNull(), exact).otherwise(exact + other)


def exact_sum(x: ColumnOrName) -> Column:
    """Sum of doubles, independent of addition order; NaN stays NaN."""
    return total_of(**exact_parts(x))


def exact_avg(x: ColumnOrName) -> Column:
    """Null-skipping average of doubles; NULL over no values."""
    n = F.count(as_col(x))
    return F.when(n > 0, exact_sum(x) / n)


# The fixed-date holidays flagged in the date dimension
# (month, day): New Year's Day, Independence Day, Veterans Day, Christmas.
FIXED_HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))


def is_fixed_holiday(d: ColumnOrName) -> Column:
    d = as_col(d)
    cond = F.lit(False)
    for month, day in FIXED_HOLIDAYS:
        cond = cond | ((F.month(d) == month) & (F.dayofmonth(d) == day))
    return cond
