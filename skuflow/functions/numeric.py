"""Column expressions for the two missing-value regimes.

* SQL regime: ``x / 0`` is NULL (``sql_div``).
* pandas regime: ``0 / 0`` is missing, ``x / 0`` is +-inf (``pdiv``).

Both divide in double precision, so decimal money columns stay exact up to the
division and every engine that follows IEEE 754 gets the same ratio.

Given column names (or SQL snippets) the divisions are built as one SQL
expression, one call into the JVM instead of a dozen; wide aggregates build
hundreds of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: ColumnLike) -> Column:
    return col_of(c).cast("double")


def sql_div_sql(numerator: str, denominator: str) -> str:
    return f"try_divide(CAST(({numerator}) AS DOUBLE), CAST(({denominator}) AS DOUBLE))"


def pdiv_sql(numerator: str, denominator: str, inf_as_null: bool = False) -> str:
    n, d = f"CAST(({numerator}) AS DOUBLE)", f"CAST(({denominator}) AS DOUBLE)"
    out = f"CASE WHEN {d} <> 0 THEN {n} / {d}"
    if not inf_as_null:
        out += (f" WHEN {n} > 0 THEN CAST('Infinity' AS DOUBLE)"
                f" WHEN {n} < 0 THEN CAST('-Infinity' AS DOUBLE)")
    return out + " END"


def sql_div(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """SQL division; a zero or NULL denominator gives NULL."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(sql_div_sql(numerator, denominator))
    return F.try_divide(as_double(numerator), as_double(denominator))


def pdiv(numerator: ColumnLike, denominator: ColumnLike, inf_as_null: bool = False) -> Column:
    """pandas division.  ``0/0`` and NULL operands give NULL, ``x/0`` gives +-inf.

    With ``inf_as_null`` a zero denominator always gives NULL (Q10 variant).
    """
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(pdiv_sql(numerator, denominator, inf_as_null))
    n, d = as_double(numerator), as_double(denominator)
    out = F.when(d != 0, n / d)
    if not inf_as_null:
        out = out.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
    return out


def clamp_negative(c: ColumnLike) -> Column:
    """F8: negative values become 0; NULL stays NULL."""
    c = col_of(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def month_index(month: ColumnLike) -> Column:
    """a month string ``YYYY-MM`` as a running month number.

    Only differences of this index are used, so ``year * 12 + month`` stands in
    for the reference's ``(year - min_year) * 12 + month`` without a global
    minimum.
    """
    d = F.to_date(col_of(month), "yyyy-MM")
    return (F.year(d) * 12 + F.month(d)).cast("int")


def band_label(low: float, high: float) -> str:
    """suffix of a band feature, ``'%d_to_%d' % (low*100, high*100)``."""
    return f"{int(low * 100)}_to_{int(high * 100)}"


def clip_at_zero(c: ColumnLike) -> Column:
    """F16 (default form): a negative prediction becomes 0; NULL stays NULL."""
    c = col_of(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)
