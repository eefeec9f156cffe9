"""Column expressions shared by the plans: all built-in functions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# An order's running total inside an array fold; wide enough for any document.
MONEY_SUM = "decimal(28,2)"


def money(c: Column) -> Column:
    """Amounts are stored as doubles with two decimals; sums run on decimals so that
    the result does not depend on the order in which partitions arrive."""
    return c.cast(MONEY)


def money_total(c: Column) -> Column:
    return F.sum(money(c))


def cents(c: Column) -> Column:
    """An amount with two decimals as a whole number of cents. Sums of them are exact, like
    sums of decimals, at the cost of adding longs: no decimal object per row."""
    return F.floor(c * 100.0 + 0.5)


def cents_total(c: Column) -> Column:
    return F.sum(cents(c))


def from_cents(c: Column) -> Column:
    """Summed cents as the nearest double amount."""
    return (c.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("double")


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when the whole is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def code_point(c: Column) -> Column:
    """Code point of the first character: the nation key of a state."""
    return F.ascii(c).cast("bigint")


def initial(c: Column) -> Column:
    return F.substring(c, 1, 1)


def supplier_key(w_id: Column, i_id: Column, suppliers: int) -> Column:
    """Supplier of a stock row: (warehouse * item) modulo the number of suppliers."""
    return (w_id.cast("bigint") * i_id.cast("bigint")) % F.lit(suppliers).cast("bigint")


def ts(text: str) -> Column:
    """Timestamp literal without a time zone, as the documents carry none."""
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970, by the clock the timestamp was written with: no time zone and
    so no repeated or missing hours."""
    return F.timestamp_diff("SECOND", ts("1970-01-01 00:00:00"), c)


def plus_days(c: Column, days: Column | int) -> Column:
    n = days if isinstance(days, Column) else F.lit(days)
    return F.timestamp_add("DAY", n.cast("int"), c)


def months_after(text: str, months: int) -> Column:
    """Literal start date moved by whole months; folded to a constant by Catalyst."""
    return F.timestamp_add("MONTH", F.lit(months), ts(text))


def within(c: Column, start: Column, end: Column) -> Column:
    """Half-open range: start <= c < end."""
    return (c >= start) & (c < end)


def year_range(c: Column, first: int, last: int | None = None) -> Column:
    """Rows of whole years as a range on the raw column, so the scan can prune by it."""
    last = first if last is None else last
    return within(c, ts(f"{first}-01-01 00:00:00"), ts(f"{last + 1}-01-01 00:00:00"))


def shaped(df: DataFrame, columns: str) -> DataFrame:
    """Select and cast to a fixed result schema, e.g. ``shaped(df, "o_id bigint, revenue double")``."""
    picked = []
    for item in columns.split(","):
        name, kind = item.split()
        picked.append(F.col(name).cast(kind).alias(name))
    return df.select(*picked)
