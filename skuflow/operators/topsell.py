"""Top-selling SKUs: the smallest leading set reaching 80 % of a category's
trailing sales (L4: W1-W7, F8-F11, O1, O4).

* W1/W2 trailing sums are one range-frame window per SKU (``rangeBetween(-k,
  -1)`` on a period index), not k shifted self-joins.  A SKU group holds one row
  per period, so its size is bounded by the calendar whatever the data volume.
* W3 running sum and W4 category total come from ``running_sum_by_group``,
  which cuts every (period, category) into slices.
* Shares are rounded to 9 places before they meet the 0.8 threshold (Q7), so
  the last digits of DOUBLE sums cannot move a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.numeric import clamp_negative, month_index, pdiv_sql
from skuflow.operators.ranking import running_sum_by_group
from skuflow.session import materialize

# Fixed values of the reference: period column and lookback per mode, Pareto share.
MODES = {"weekly": ("sequentialweek", 12), "monthly": ("month", 3)}
PARETO_SHARE = 0.8
SHARE_PLACES = 9

SKU, CATE3, SALES = "item_sku_id", "item_third_cate_cd", "total_net_sales"
CATEGORY_CODES = ("item_first_cate_cd", "item_second_cate_cd", CATE3)
TRAILING = "total_net_sales_recent_three_months"
CATE_TOTAL = "cate3_total_net_sales_recent_three_months"
CUMULATED = "cumulated_net_sales"
MARK, SHARE = "true_top_saling_mark", "sales_share_recent_three_months"


def mode_spec(mode: str) -> tuple[str, int]:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {sorted(MODES)}")
    return MODES[mode]


def period_index(mode: str) -> Column:
    period, _ = mode_spec(mode)
    return F.col(period).cast("int") if mode == "weekly" else month_index(period)


def trailing_sales(facts: DataFrame, mode: str = "monthly", sales_col: str = SALES,
                   out_col: str = TRAILING) -> DataFrame:
    """Per SKU, the clamped sales of the previous ``lookback`` periods by
    calendar distance (missing periods count 0, the current one is excluded).

    (SKU, period) must be unique (Q12): a repeated one would be counted twice in
    later periods, so it is an error; pre-aggregate with ``one_row_per_period``.
    """
    period, lookback = mode_spec(mode)
    ordered = Window.partitionBy(SKU).orderBy(F.col("_period_index"))
    frame = ordered.rangeBetween(-lookback, -1)
    trailing = F.coalesce(F.sum(clamp_negative(sales_col)).over(frame), F.lit(0))
    return (facts.where(F.col(period).isNotNull())
            .withColumn("_period_index", period_index(mode))
            .withColumn(out_col, F.when(F.count(F.lit(1)).over(ordered.rangeBetween(0, 0)) > 1, F.raise_error(
                F.concat(F.lit("(SKU, period) is not unique: "), F.col(SKU).cast("string"), F.lit(", "),
                         F.col(period).cast("string")))).otherwise(trailing))
            .drop("_period_index"))


def one_row_per_period(facts: DataFrame, mode: str = "monthly") -> DataFrame:
    """Facts summed to one row per category codes, SKU and period (Q12);
    ``rows_summed`` says how many rows each is made of."""
    period, _ = mode_spec(mode)
    keys = [c for c in facts.columns if c in (*CATEGORY_CODES, SKU, period)]
    sums = [c for c in facts.columns if c.startswith("total_")]
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums],
                                    F.count(F.lit(1)).alias("rows_summed"))


def category_trailing_total(trailing: DataFrame, mode: str = "monthly") -> DataFrame:
    """A4: trailing sales summed by (period, third category); NULL keys drop out."""
    period, _ = mode_spec(mode)
    return (trailing.where(F.col(period).isNotNull() & F.col(CATE3).isNotNull())
            .groupBy(period, CATE3).agg(F.sum(TRAILING).alias(CATE_TOTAL)))


def pareto_marks(ranked: DataFrame, share: float = PARETO_SHARE) -> DataFrame:
    """W5-W7 on rows carrying trailing sales, running sum and category total: a
    row is marked if it has a running sum and the share before it is below
    ``share``, that is if it belongs to the smallest leading set that reaches it."""
    own = f"coalesce({pdiv_sql(TRAILING, CATE_TOTAL)}, 0.0D)"
    before = f"round(coalesce({pdiv_sql(f'{CUMULATED} - {TRAILING}', CATE_TOTAL)}, 0.0D), {SHARE_PLACES})"
    reached = f"round(coalesce({pdiv_sql(CUMULATED, CATE_TOTAL)}, 0.0D), {SHARE_PLACES})"
    mark = f"{reached} > 0 AND {before} < {float(share)!r}D"
    return ranked.withColumn(MARK, F.expr(mark)).withColumn(SHARE, F.expr(own))


def top_selling(facts: DataFrame, mode: str = "monthly", keep_columns: bool = False,
                stored: bool = False) -> DataFrame:
    """L4: ``item_third_cate_cd, item_sku_id, <period>, true_top_saling_mark,
    sales_share_recent_three_months`` for every row with non-NULL keys.

    Ties in trailing sales are broken by ascending SKU (Q6).  With
    ``keep_columns`` all input columns are kept as well, which lets the
    discount features use the marks without joining them back.  With ``stored``
    the rows with their trailing sales are written first: slicing reads them
    twice, once for a sample of their order, and would compute them twice.
    """
    period, _ = mode_spec(mode)
    trailing = trailing_sales(facts, mode).where(F.col(CATE3).isNotNull())
    if not keep_columns:  # slicing hands whole rows to Python workers: no column too many
        trailing = trailing.select(CATE3, SKU, period, TRAILING)
    if stored:
        trailing = materialize(trailing, "trailing")
    ranked = running_sum_by_group(trailing, [period, CATE3], TRAILING, SKU, CUMULATED, CATE_TOTAL)
    marked = pareto_marks(ranked)
    if keep_columns:
        return marked
    return marked.select(CATE3, SKU, period, MARK, SHARE)
