"""Column helpers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks.functions import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money and ratios -------------------------------------------------------


def money_sum(amount: Column | str) -> Column:
    """Sum of a two-decimal amount.

    Adds cents as BIGINT, which stays in Tungsten's long path, where a wide
    decimal sum would allocate an object per row; overflow raises under ANSI.
    """
    cents = F.sum((_col(amount) * 100).cast("bigint"))
    return (cents.cast("decimal(19,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def line_revenue() -> Column:
    """Sum of quantity x unit price over invoice lines, in cents until the end."""
    cents = (F.col("unitprice") * 100).cast("bigint") * F.col("quantity")
    return (F.sum(cents).cast("decimal(19,0)") / F.lit(100).cast("decimal(3,0)")).cast(
        "decimal(18,2)"
    )


def count_sum(count: Column | str) -> Column:
    return F.sum(_col(count).cast("bigint"))


def divide(a: Column | str, b: Column | str) -> Column:
    """a / b in decimals with ten places; NULL when b is 0 or NULL."""
    num = _col(a).cast("decimal(27,2)")
    den = F.nullif(_col(b), F.lit(0)).cast("decimal(27,2)")
    return (num / den).cast("decimal(28,10)")


def ratio2(a: Column | str, b: Column | str) -> Column:
    """a / b rounded half away from zero to 2 places, NULL when b is 0."""
    return F.round(divide(a, b), 2)


def safe_avg(total: Column | str, n: Column | str) -> Column:
    """ratio2, with 0 instead of NULL when there is nothing to divide by."""
    return F.when(_col(n) > 0, ratio2(total, n)).otherwise(F.lit(0).cast("decimal(28,2)"))


def mean(amount: Column | str) -> Column:
    """Average with ten places (Spark's own decimal AVG keeps only four extra)."""
    return divide(money_sum(amount), F.count(_col(amount)))


# --- dates ------------------------------------------------------------------


def date_id(date: Column | str) -> Column:
    """yyyymmdd as an integer."""
    d = _col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(date: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(date)) - 1


def month_key(year: Column | str, month: Column | str) -> Column:
    """'YYYY-MM'."""
    return F.format_string("%d-%02d", _col(year), _col(month))


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The clock of a mart: a fixed day, or today when None."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


# --- keys and labels --------------------------------------------------------


def parse_customer_id(text: Column | str, numeric: bool = False) -> Column:
    """Customer text to BIGINT: '17850.0' -> 17850; missing, empty, junk or beyond BIGINT -> -1.

    The default drops what follows the point; ``numeric`` rounds it instead.
    """
    c = _col(text)
    if numeric:
        value = F.round(c.try_cast("decimal(24,4)"), 0).try_cast("bigint")
    else:
        value = F.nullif(F.substring_index(c, ".", 1), F.lit("")).try_cast("bigint")
    return F.coalesce(value, F.lit(rules.UNKNOWN_CUSTOMER).cast("bigint"))


def is_junk_customer(text: Column | str) -> Column:
    """Customer text that is there but is no number."""
    c = _col(text)
    head = F.nullif(F.substring_index(c, ".", 1), F.lit(""))
    return head.isNotNull() & head.try_cast("bigint").isNull()


def days_of_month() -> Column:
    """Distinct days (column day) of one month as set bits: COUNT(DISTINCT) that adds up map-side."""
    return F.bit_count(F.bit_or(F.expr("shiftleft(1L, day)")))


def known_customer(customer_id: Column | str) -> Column:
    """The -1 sentinel back to NULL, so COUNT(DISTINCT) skips it."""
    return F.nullif(_col(customer_id), F.lit(rules.UNKNOWN_CUSTOMER))


def product_category(stock_code: Column | str) -> Column:
    code = _col(stock_code)
    out = F.lit(rules.DEFAULT_CATEGORY)
    for prefix, label in reversed(rules.CATEGORY_BY_PREFIX):
        out = F.when(code.startswith(prefix), F.lit(label)).otherwise(out)
    return out


def label_from_floor(value: Column | str, floors: Sequence[tuple], below: str) -> Column:
    """Label of the first floor the value reaches."""
    out = F.lit(below)
    for floor, label in reversed(floors):
        out = F.when(_col(value) >= floor, F.lit(label)).otherwise(out)
    return out


def label_to_ceiling(value: Column | str, ceilings: Sequence[tuple], beyond: str) -> Column:
    """Label of the first ceiling the value does not exceed."""
    out = F.lit(beyond)
    for ceiling, label in reversed(ceilings):
        out = F.when(_col(value) <= ceiling, F.lit(label)).otherwise(out)
    return out


def customer_segment(lifetime_value: Column | str) -> Column:
    return label_from_floor(lifetime_value, rules.SEGMENT_FLOORS, rules.LOWEST_SEGMENT)


def recency_bucket(days: Column | str) -> Column:
    return label_to_ceiling(
        days, rules.CUSTOMER_RECENCY_CEILINGS, rules.CUSTOMER_RECENCY_BEYOND
    )


def product_recency(days: Column | str) -> Column:
    return label_to_ceiling(
        days, rules.PRODUCT_RECENCY_CEILINGS, rules.PRODUCT_RECENCY_BEYOND
    )


def spending_level(revenue: Column | str) -> Column:
    return label_from_floor(revenue, rules.SPENDING_FLOORS, rules.LOWEST_SPENDING)


def affinity_level(rank: Column | str, share_pct: Column | str, times: Column | str) -> Column:
    return (
        F.when(_col(rank) <= rules.AFFINITY_TOP3_RANK, rules.AFFINITY_TOP3)
        .when(_col(rank) <= rules.AFFINITY_TOP10_RANK, rules.AFFINITY_TOP10)
        .when(_col(share_pct) >= rules.AFFINITY_MAJOR_SHARE_PCT, rules.AFFINITY_MAJOR)
        .when(_col(times) >= rules.AFFINITY_FREQUENT_TIMES, rules.AFFINITY_FREQUENT)
        .otherwise(rules.AFFINITY_OTHER)
    )
