"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; nothing is evaluated row by row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as decimal so totals do not depend on row order or on how the rows are
# spread over partitions.  Whatever a decimal of this scale cannot hold (digits beyond the
# eighth, NaN, infinities, amounts of MONEY_LIMIT and more) is summed beside it as double, so
# nothing is rounded away and NaN behaves as in a plain double sum.
MONEY = "decimal(28,8)"
MONEY_LIMIT = 1e18


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(key, salt: str | None = None) -> Column:
    """First 32 bits of md5(key[-salt]) as a non-negative bigint (0 .. 2^32-1).

    Deterministic per row and independent of partitioning, unlike
    ``randomSplit``/``sample`` whose draws depend on the partition layout.
    """
    k = _c(key).cast("string")
    if salt is not None:
        k = F.concat_ws("-", k, F.lit(salt))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def hash_percent(key, salt: str | None = None) -> Column:
    """Stable bucket 0..99 for a row key."""
    return (hash_u32(key, salt) % 100).cast("int")


def money_parts(c) -> tuple[Column, Column]:
    """(decimal, rest): what of an amount fits the decimal, and the remaining double (0.0 for most)."""
    x = _c(c).cast("double")
    fits = (F.abs(x) < F.lit(MONEY_LIMIT)) & ~F.isnan(x)
    dec = F.when(fits, x.cast(MONEY))
    return dec, F.when(fits, x - dec.cast("double")).otherwise(x)


def money_total(dec, rest) -> Column:
    """The double value of two summed parts; null where both are."""
    d, r = _c(dec).cast("double"), _c(rest)
    return F.when(d.isNull(), r).otherwise(d + F.coalesce(r, F.lit(0.0)))


def exact_sum(c) -> Column:
    """Order-independent sum of a money column, as double; null over no amounts."""
    dec, rest = money_parts(c)
    return money_total(F.sum(dec), F.sum(rest))


def exact_mean(c) -> Column:
    """Mean of a money column from its exact sum (nulls ignored; a NaN makes it NaN)."""
    return exact_sum(c) / F.count(_c(c))


def safe_ratio(num, den) -> Column:
    """num / den as double, 0.0 when den is 0 (zero_division = 0)."""
    num, den = _c(num).cast("double"), _c(den).cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def label_text(c="Is_Laundering") -> Column:
    return F.when(_c(c) == 1, F.lit("Fraud")).otherwise(F.lit("Normal"))


def f1_expr(precision, recall) -> Column:
    p, r = _c(precision), _c(recall)
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
