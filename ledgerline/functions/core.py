"""Column-expression helpers shared by every operator.

All helpers return ``Column`` expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.

Numeric conventions
-------------------
* Money is carried as ``DECIMAL(18,2)`` (the reference stores cents) and summed
  exactly; derived money (15 % revenue share, net income) is rounded in the
  decimal domain.  Outputs are cast to DOUBLE at the end of each operator.
* Ratios and percentages are doubles computed by one IEEE division of exact
  inputs and are **not** rounded: rounding is a display concern applied by the
  report sinks (``sinks.display_round``).  This keeps every engine that evaluates
  the same expression bit-identical.
* Averages of doubles (whose summation order varies) are rounded to 6 places.
* Counts are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
REV_SHARE_RATE = "0.15"  # fixed value: revenue-share deduction rate (15 %)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Coerce to the money type; unparseable → null."""
    return col(c).try_cast(MONEY)


def money_sum(c) -> Column:
    """Exact sum of money; all-null → 0 (pandas ``sum`` semantics)."""
    return F.coalesce(F.sum(col(c).cast(MONEY)), F.lit(0).cast(MONEY))


def dbl(c) -> Column:
    return col(c).cast("double")


def round_money(c) -> Column:
    """Round a (≤ 18-digit) decimal product to cents, staying in compact decimals."""
    return F.round(col(c), 2).cast(MONEY)


def rev_share(c) -> Column:
    """15 % revenue-share deduction of a money column, rounded to cents."""
    return F.round(col(c) * F.lit(REV_SHARE_RATE).cast("decimal(4,2)"), 2).cast(MONEY)


def safe_pct(num, den) -> Column:
    """``num / den * 100`` with x/0 → 0 (the documented contract, §8-Q1) and a
    missing numerator → 0 (pandas ``fillna(0)``)."""
    return F.coalesce(F.when(dbl(den) != 0, dbl(num) / dbl(den) * F.lit(100.0)), F.lit(0.0))


def safe_div(num, den) -> Column:
    """``num / den`` as double, 0 when the denominator is 0 or null (or the numerator null)."""
    return F.coalesce(F.when(dbl(den) != 0, dbl(num) / dbl(den)), F.lit(0.0))


def distinct_count(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """Exact distinct count by default; HyperLogLog++ (``approx_count_distinct``,
    one partial-aggregate shuffle, bounded memory) when ``approx`` is set."""
    return (F.approx_count_distinct(col(c), rsd) if approx else F.countDistinct(col(c))).cast("bigint")


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


# ---------------------------------------------------------------------------
# Months as ``yyyy-MM`` strings and as integer indexes (year*12 + month - 1)
# ---------------------------------------------------------------------------

def month_index(m) -> Column:
    m = col(m)
    return (F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 6, 2).cast("int") - 1)


def month_from_index(i) -> Column:
    i = col(i)
    return F.format_string("%04d-%02d", F.floor(i / 12).cast("int"), (F.pmod(i, F.lit(12)) + 1).cast("int"))


def month_of(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def month_start(m) -> Column:
    return F.to_date(F.concat(col(m), F.lit("-01")))


def month_diff(later, earlier) -> Column:
    """Calendar month difference of two ``yyyy-MM`` strings."""
    return month_index(later) - month_index(earlier)


def pretty_month(m) -> Column:
    """``2025-08`` → ``August 2025``."""
    return F.date_format(month_start(m), "MMMM yyyy")


def quarter_label(m) -> Column:
    """``2025-08`` → ``2025Q3`` (pandas Period('Q') label)."""
    m = col(m)
    return F.concat(F.substring(m, 1, 4), F.lit("Q"),
                    (F.floor((F.substring(m, 6, 2).cast("int") - 1) / 3) + 1).cast("string"))


def half_label(d) -> Column:
    """P5: date → ``H1 2025`` / ``H2 2025``."""
    d = col(d)
    return F.concat(F.lit("H"), F.when(F.month(d) <= 6, F.lit("1")).otherwise(F.lit("2")),
                    F.lit(" "), F.year(d).cast("string"))


def half_start(d) -> Column:
    d = col(d)
    return F.make_date(F.year(d), F.when(F.month(d) <= 6, 1).otherwise(7), F.lit(1))


def half_end(d) -> Column:
    d = col(d)
    return F.when(F.month(d) <= 6, F.make_date(F.year(d), F.lit(6), F.lit(30))) \
        .otherwise(F.make_date(F.year(d), F.lit(12), F.lit(31)))


def week_start_friday(d) -> Column:
    """Start (Friday) of the Friday→Thursday week holding ``d``."""
    d = col(d)
    return F.date_sub(d, F.pmod(F.weekday(d) - 4, F.lit(7)).cast("int"))


def last_thursday(d) -> Column:
    """The latest Thursday on or before ``d`` (a Thursday counts itself)."""
    d = col(d)
    return F.date_sub(d, F.pmod(F.weekday(d) - 3, F.lit(7)).cast("int"))


def blank_to_null(c) -> Column:
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)
