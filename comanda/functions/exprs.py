"""Column expressions: exact ratios, rounding, tiers, weekday and daypart flags."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def const(value: int | float | str) -> Column:
    """A numeric constant as an exact decimal literal, so that comparisons with it stay exact."""
    return F.lit(value if isinstance(value, int) else Decimal(str(value)))


def half_up(value: Column | str, digits: int) -> Column:
    """Round half up on the decimal text, as a double. Doubles are first taken to six more digits."""
    return F.round(as_col(value).cast(f"decimal(38,{digits + 6})"), digits).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL when den is zero or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def mean(value: Column | str) -> Column:
    """Aggregate mean of an exact (integer or decimal) column: one division of exact totals."""
    value = as_col(value)
    return ratio(F.sum(value), F.count(value))


def sample_std(sum_x: Column, sum_x2: Column, n: Column) -> Column:
    """Sample standard deviation from exact integer totals; NULL for fewer than two observations."""
    spread = sum_x2.cast("decimal(38,0)") * n - sum_x.cast("decimal(38,0)") * sum_x
    return F.when(n > 1, F.sqrt(F.try_divide(spread.cast("double"), (n * (n - 1)).cast("double"))))


def tier(value: Column | str, cuts: Sequence[tuple[str, Column | float, str]], otherwise: str) -> Column:
    """First matching label of `cuts`, each (comparison, bound, label); NULL values get `otherwise`."""
    value = as_col(value)
    compare = {
        "<": lambda b: value < b,
        "<=": lambda b: value <= b,
        ">": lambda b: value > b,
        ">=": lambda b: value >= b,
    }
    out = None
    for op, bound, label in cuts:
        cond = compare[op](bound if isinstance(bound, Column) else const(bound))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


def lookup(key: Column | str, table: dict, default=None) -> Column:
    """Value of a small constant table by key, `default` for keys not listed."""
    key = as_col(key)
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def weekday(date: Column | str) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(as_col(date)).cast("bigint")


def is_weekend(date: Column | str) -> Column:
    """The two peak evenings of the trade, Friday and Saturday."""
    return F.weekday(as_col(date)).isin(4, 5).cast("bigint")


def business_date(ts: Column | str, hours_after_midnight: int = 4) -> Column:
    """Trading date: the hours after midnight belong to the evening before."""
    return (as_col(ts) - F.expr(f"INTERVAL {hours_after_midnight} HOURS")).cast("date")


def business_hour(ts: Column | str, hours_after_midnight: int = 4) -> Column:
    """Hour on the trading date; after midnight it runs on from 24."""
    hour = F.hour(as_col(ts))
    return F.when(hour < hours_after_midnight, hour + 24).otherwise(hour).cast("bigint")


def linear_interp(x: Column | str, points: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear interpolation through sorted points, clamped at both ends; exact at the points."""
    x = as_col(x).cast("double")
    points = sorted(points)
    out = F.when(x <= points[0][0], F.lit(float(points[0][1])))
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        inside = F.lit(y0) + (x - F.lit(x0)) * F.lit((y1 - y0) / (x1 - x0))
        out = out.when(x == F.lit(x1), F.lit(float(y1))).when(x < F.lit(x1), inside)
    return F.when(x.isNotNull(), out.otherwise(F.lit(float(points[-1][1]))))
