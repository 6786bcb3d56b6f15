"""Column expressions shared by every operator.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
none is a Python UDF.  The rounding helpers reproduce the numeric rules of the
SQL engine the original models were written for, see ``dec2`` and
``round_half_away``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- rounding

TWO_POW_52 = 4503599627370496.0


def _nearest_integer_of_nonneg(a: Column) -> Column:
    """Nearest integer to a >= 0, halves up, on the binary value, as DOUBLE.
    floor(a + 0.5) is exact for 0.5 <= a < 2^52 (the sum stays in a binade
    whose spacing divides 0.5); below 0.5 the answer is 0 (the one double
    just under 0.5 would otherwise round up in the addition); from 2^52 on
    every double is already an integer."""
    return (F.when(a >= F.lit(TWO_POW_52), a)
            .when(a < F.lit(0.5), F.lit(0.0))
            .otherwise(F.floor(a + F.lit(0.5)).cast("double")))


def round_half_away(c: ColumnLike, scale: int) -> Column:
    """``round(double, scale)`` as the models expect it: scale the binary
    value, round half away from zero, scale back (1.005 -> 1.0, because
    1.005*100 is 100.49999...).  Plain double arithmetic (no per-row
    BigDecimal); NaN and infinities pass through."""
    f = float(10 ** scale)
    v = col(c) * F.lit(f)
    r = _nearest_integer_of_nonneg(F.abs(v))
    return (F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), v)
            .when(v < 0, F.negative(r)).otherwise(r)) / F.lit(f)


def to_numeric(c: ColumnLike) -> Column:
    """``double::numeric``: DECIMAL(18,3), rounding the binary value x*1000
    half away from zero."""
    return round_half_away(c, 3).cast("decimal(18,3)")


def dec2(c: ColumnLike) -> Column:
    """``round(x::numeric, 2)`` -> DECIMAL(18,2) (two roundings: 3 then 2 dp)."""
    return F.round(to_numeric(c), 2)


def stable(c: ColumnLike, scale: int = 6) -> Column:
    """Round a float aggregate (mean, stddev, z) whose last bits depend on the
    summation order; used only where results are compared across engines."""
    return round_half_away(c, scale)


# ---------------------------------------------------------------- price means

def finite(c: ColumnLike) -> Column:
    """The price; NaN and infinities raise an error instead of turning into a
    number somewhere in a mean."""
    x = col(c)
    odd = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(odd, F.raise_error(F.lit("a price is NaN or infinite")).cast("double")) \
        .otherwise(x)


def micros_parts(c: ColumnLike) -> tuple[Column, Column]:
    """A price as whole units (LONG) plus millionths 0..10^6 (LONG, rounded
    half up on the binary value): exact for prices with up to six decimals,
    with no per-row decimal arithmetic.  Prices must be finite and below 9e12."""
    x = finite(c)
    whole = F.floor(x)
    frac = F.floor((x - whole) * F.lit(1e6) + F.lit(0.5))
    return whole, frac


def price_micros(c: ColumnLike) -> Column:
    """A price as an integer number of millionths (LONG; |price| < 9.2e12)."""
    whole, frac = micros_parts(c)
    return whole * F.lit(1000000) + frac


def exact_avg(c: ColumnLike, window=None) -> Column:
    """Mean of a price column, correctly rounded to a double: whole units and
    millionths are summed as two LONGs (neither can overflow: the whole-unit
    sum would need 9.2e18 currency units in one group), combined exactly once
    per group as DECIMAL, then one IEEE division.

    A floating-point sum depends on the order rows arrive in, and where the
    true mean sits on a rounding boundary (48.8445 at 3 decimals) that noise
    decides the rounded result; this value does not depend on partitioning,
    so reruns and other engines agree.  ``window`` makes it a window
    aggregate."""
    whole, frac = micros_parts(c)
    sw, sf, n = F.sum(whole), F.sum(frac), F.count(col(c))
    if window is not None:
        sw, sf, n = sw.over(window), sf.over(window), n.over(window)
    return mean_of_sums(sw, sf, n)


def mean_of_sums(whole: ColumnLike, frac: ColumnLike, n: ColumnLike) -> Column:
    """The mean of n prices given by their summed ``micros_parts``."""
    total = _total_micros(col(whole), col(frac))
    return F.try_divide(total.cast("double"), col(n).cast("double") * F.lit(1e6))


def weighted_avg(c: ColumnLike, count: ColumnLike) -> Column:
    """``exact_avg`` where every row stands for ``count`` equal prices."""
    whole, frac = micros_parts(c)
    n = F.sum(F.when(col(c).isNotNull(), col(count)))
    return mean_of_sums(F.sum(whole * col(count)), F.sum(frac * col(count)), n)


def _total_micros(whole: Column, frac: Column) -> Column:
    return whole.cast("decimal(38,0)") * F.lit(1000000) + frac.cast("decimal(38,0)")


def rounded_avg(c: ColumnLike, scale: int, count: ColumnLike | None = None) -> Column:
    """Mean of a price column rounded half away from zero at ``scale``
    decimals, decided on the exact sum in integers once per group (642.295
    gives 642.30 whatever doubles make of it).  With ``count`` every row stands
    for that many equal prices."""
    whole, frac = micros_parts(c)
    if count is None:
        sw, sf, n = F.sum(whole), F.sum(frac), F.count(col(c))
    else:
        k = F.when(col(c).isNotNull(), col(count))
        sw, sf, n = F.sum(whole * k), F.sum(frac * k), F.sum(k)
    total = _total_micros(sw, sf)
    unit = n.cast("decimal(20,0)") * F.lit(1000000)
    # floor(|total| * 10^scale / unit + 1/2) with one integer division
    up = F.abs(total) * F.lit(2 * 10 ** scale) + unit
    steps = F.call_function("div", up.cast("decimal(38,0)"), (unit * 2).cast("decimal(38,0)"))
    return F.when(n > 0, F.when(total < 0, -steps).otherwise(steps) / F.lit(float(10 ** scale)))


def exact_median(c: ColumnLike, count: ColumnLike | None = None) -> Column:
    """Interpolated median (percentile 0.5) of a price column, taken over
    the integer millionths (the midpoint of two integers is exact in a
    double) and scaled back with one division.  With ``count`` every row
    stands for that many equal prices: group by the price first and the rows of
    a group are spread before they meet."""
    freq = F.lit(1) if count is None else col(count)
    return F.percentile(price_micros(c), F.lit(0.5), freq) / F.lit(1e6)


def round_binary(c: ColumnLike, scale: int = 2) -> Column:
    """Round the binary value half to even, as ``round(x, 2)`` of the original
    does (2.675 is stored below the tie and gives 2.67).  Times a power of two,
    2^62 below 1 and 2^52 from there to 1024, a double is a whole number (or far
    below any tie), so the division is done in integers; larger values, which
    carry few decimals, use the decimal text."""
    x = col(c)

    def by(bits: int) -> Column:
        unit = F.lit(2 ** bits).cast("decimal(20,0)")
        scaled = ((F.abs(x) * F.lit(float(2 ** bits))).cast("long").cast("decimal(20,0)")
                  * F.lit(10 ** scale)).cast("decimal(38,0)")
        steps = F.call_function("div", scaled, unit)
        rest = (scaled - steps.cast("decimal(18,0)") * unit) * 2
        up = (rest > unit) | ((rest == unit) & (steps % 2 == 1))
        near = (steps + up.cast("long")).cast("double") / F.lit(float(10 ** scale))
        return F.when(x < 0, -near).otherwise(near)

    return (F.when(F.abs(x) < 1, by(62)).when(F.abs(x) < 1024, by(52))
            .otherwise(F.bround(x, scale)))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime (or ISO text), built from
    its text so the session time zone never shifts it."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- prices

def mid_price(min_c: ColumnLike = "min_price", max_c: ColumnLike = "max_price") -> Column:
    """(min + max) / 2.0; NULL when either side is NULL."""
    return (col(min_c) + col(max_c)) / F.lit(2.0)


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole days from ``start`` to ``end`` (dates or timestamps), BIGINT, may
    be negative."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start))).cast("long")


# ---------------------------------------------------------------- buckets
# Days-until-event buckets.  Each entry is
# (strictly greater than this many days, label, order); anything else,
# including negative and NULL day counts, falls in the last bucket (order 7).
DAY_BUCKETS = [
    (60, "60+ days", 1),
    (30, "30-60 days", 2),
    (14, "14-30 days", 3),
    (7, "7-14 days", 4),
    (3, "3-7 days", 5),
    (1, "1-3 days", 6),
]
LAST_BUCKET_ORDER = 7
MART_LAST_LABEL = "day of"
REPORT_LAST_LABEL = "Day of"


def _bucket_chain(days: Column, pick, last):
    expr = None
    for bound, label, order in DAY_BUCKETS:
        cond = days > F.lit(bound)
        value = F.lit(pick(label, order))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(F.lit(last))


def days_bucket(days: ColumnLike, last_label: str = MART_LAST_LABEL) -> Column:
    return _bucket_chain(col(days), lambda label, order: label, last_label)


def bucket_order(days: ColumnLike) -> Column:
    """1..7, INTEGER."""
    return _bucket_chain(col(days), lambda label, order: order, LAST_BUCKET_ORDER)


def bucket_label(order: ColumnLike, last_label: str = MART_LAST_LABEL) -> Column:
    """The label of a bucket number."""
    labels = {number: label for _, label, number in DAY_BUCKETS}
    names = [labels.get(i + 1, last_label) for i in range(LAST_BUCKET_ORDER)]
    return F.get(F.array(*[F.lit(x) for x in names]), col(order).cast("int") - 1)


# ---------------------------------------------------------------- weekdays
# Weekday names, numbered Sunday = 0 ... Saturday = 6.
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_number(d: ColumnLike) -> Column:
    """Sunday = 0 ... Saturday = 6, BIGINT (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(col(d)) - F.lit(1)).cast("long")


def weekday_name(d: ColumnLike) -> Column:
    """Full English day name of a date."""
    return F.date_format(col(d), "EEEE")


def weekday_name_of_number(n: ColumnLike) -> Column:
    """Day name for a 0-based weekday number; NULL outside 0..6."""
    return F.get(F.array(*[F.lit(x) for x in WEEKDAY_NAMES]), col(n).cast("int"))


# ---------------------------------------------------------------- anomalies
SPIKE, DROP, NORMAL = "spike", "drop", "normal"


def anomaly_type(z: ColumnLike, threshold: float = 2.0) -> Column:
    """spike when z >= t, drop when z <= -t, else normal (inclusive edges)."""
    z = col(z)
    return (F.when(z >= F.lit(threshold), F.lit(SPIKE))
            .when(z <= F.lit(-threshold), F.lit(DROP))
            .otherwise(F.lit(NORMAL)))


def z_score(x: ColumnLike, mean: ColumnLike, sd: ColumnLike) -> Column:
    """(x - mean) / sd as DOUBLE; NULL (not an error) when sd is 0 or NULL."""
    return F.try_divide(col(x) - col(mean), col(sd))


# ---------------------------------------------------------------- text

def first_or_null(arr: ColumnLike) -> Column:
    """First element of an array, NULL for NULL or empty arrays (``arr[0]``
    raises on empty arrays in ANSI mode)."""
    return F.get(col(arr), 0)


def blank_if_null(c: ColumnLike) -> Column:
    return F.coalesce(col(c), F.lit(""))


def nonblank(c: ColumnLike) -> Column:
    """Python truthiness of an optional string: NULL and '' are both false."""
    return F.coalesce(col(c) != F.lit(""), F.lit(False))


def py_str_timestamp(ts: ColumnLike) -> Column:
    """``str(datetime)`` of a timestamp: 'YYYY-MM-DD HH:MM:SS' plus
    '.ffffff' when there are microseconds; the text 'None' for NULL."""
    ts = col(ts)
    base = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    text = F.when(micros == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), micros))
    return F.coalesce(text, F.lit("None"))


def py_format_0f(x: ColumnLike) -> Column:
    """Python's ``f"{x:.0f}"``: round half to even, then print without decimals."""
    return F.format_string("%.0f", F.bround(col(x), 0))
