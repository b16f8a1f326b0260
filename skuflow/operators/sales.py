"""Sales facts: order lines -> SKU x day -> measures -> SKU x week / month.

Each step of the reference's chain of stored tables is one function here; the
pipeline in ``skuflow.plans.pipelines`` composes them into one lazy plan so
Catalyst sees the whole chain (filters reach the order-line scan, only used
columns are read, narrow steps fuse) and nothing is stored unless asked for.

Scale notes
* A1 aggregates order lines with a map-side partial aggregate before the
  shuffle on (day, SKU); a hot SKU is combined inside each map task.
* J1 joins two big tables on (SKU, day).  Both sides are unique on the key, so
  no key can be hot; the aggregated side is already hash-partitioned on it.
* J2 joins on SKU.  The dimension grows with the catalogue, so it is not
  hinted: adaptive execution broadcasts it when its runtime size is under the
  threshold and otherwise keeps a sort-merge join with skew splitting.
* J3/J4 join the calendar, whose size is bounded by the number of days / weeks.
* A2/A3 are partial+final aggregates; a hot category only adds map-side work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.numeric import sql_div, sql_div_sql
from skuflow.sources.tables import snapshot

# Fixed values of the reference's build.
REFERENCE_HISTORY_START = "2014-07-01"
REFERENCE_SKU_SNAPSHOT = "2017-04-28"
HISTORY_PARTITION = "HISTORY"
CATEGORY_COLUMNS = ("item_first_cate_cd", "item_second_cate_cd", "item_third_cate_cd")
MEASURE_COLUMNS = ("total_net_sales", "total_give_away", "total_gross_sales",
                   "total_synthetic_give_away", "total_synthetic_gross_sales")


def valid_history_lines(order_detail: DataFrame,
                        history_start: str = REFERENCE_HISTORY_START,
                        dp: str = HISTORY_PARTITION) -> DataFrame:
    """S4+P3: history partition, from ``history_start`` on, valid orders only."""
    start = F.lit(history_start)
    return order_detail.where(
        (F.col("dp") == dp) & (F.col("dt") >= start)
        & (F.col("sale_ord_dt") >= start) & (F.col("sale_ord_valid_flag") == 1))


def sales_daily(order_detail: DataFrame,
                history_start: str = REFERENCE_HISTORY_START,
                dp: str = HISTORY_PARTITION) -> DataFrame:
    """A1: order lines -> SKU x day with sums and unit prices (``daily_00``)."""
    lines = valid_history_lines(order_detail, history_start, dp)
    daily = lines.groupBy("sale_ord_dt", "item_sku_id").agg(
        F.sum("after_prefr_amount").alias("net_sales"),
        F.sum("before_prefr_amount").alias("gross_sales"),
        F.sum("sale_qtty").alias("unit_volume"))
    return daily.select(
        "sale_ord_dt", "item_sku_id", "net_sales", "gross_sales", "unit_volume",
        sql_div("net_sales", "unit_volume").alias("net_price"),
        sql_div("gross_sales", "unit_volume").alias("gross_price"))


def lines_of_days(order_detail: DataFrame, days: DataFrame) -> DataFrame:
    """The order lines of the days in ``days`` (column ``date``).

    On lines stored by day (``rebuild_table(..., partition_by=["dt"])``) a filter
    on the calendar, such as its weeks, prunes the lines' partitions when the
    query runs (dynamic partition pruning): other days are not read."""
    wanted = days.select(F.col("date").alias("dt")).distinct()
    return order_detail.join(wanted, "dt").select(*order_detail.columns)


def synthetic_price(source: DataFrame) -> DataFrame:
    """``date, item_sku_id, synthetic_gross_price`` from the raw price table."""
    return source.select("date", F.col("productkey").alias("item_sku_id"),
                         F.col("syntheticgrossprice").alias("synthetic_gross_price"))


def attach_synthetic_price(daily: DataFrame, price: DataFrame) -> DataFrame:
    """J1+P2: left join the synthetic price on (SKU, day) (``daily_01``)."""
    p = price.select(F.col("date").alias("sale_ord_dt"), "item_sku_id", "synthetic_gross_price")
    return daily.join(p, ["sale_ord_dt", "item_sku_id"], "left") \
        .select(*daily.columns, "synthetic_gross_price")


def sku_snapshot(sku_dim: DataFrame, snapshot_dt: str = REFERENCE_SKU_SNAPSHOT) -> DataFrame:
    """P5: the SKU dimension restricted to one snapshot, category columns only."""
    return snapshot(sku_dim, snapshot_dt).select("item_sku_id", *CATEGORY_COLUMNS)


def attach_category(daily: DataFrame, sku_dim: DataFrame,
                    snapshot_dt: str = REFERENCE_SKU_SNAPSHOT) -> DataFrame:
    """Inner join the snapshot's category codes on SKU (``daily_02``)."""
    dim = sku_snapshot(sku_dim, snapshot_dt)
    joined = daily.join(dim, "item_sku_id", "inner")
    return joined.select(*daily.columns, *CATEGORY_COLUMNS)


def sales_measures(daily: DataFrame, dim_date: DataFrame, dim_week: DataFrame) -> DataFrame:
    """J3+J4+F1/F2/F4/F6: calendar keys and derived measures (``daily_03``).

    ``total_synthetic_give_away`` is ``unit_volume * (price - net_price)``,
    written as ``unit_volume * price - net_sales`` so decimal inputs stay
    exact; it is NULL where ``net_price`` is (zero units) and 0 where the
    synthetic price is 0.
    """
    # No hints: adaptive execution broadcasts the calendar from its measured size.
    days = dim_date.select(F.col("date"), F.col("sequentialweek"))
    weeks = dim_week.select(F.col("sequentialweek").alias("_week"), F.col("date").alias("week_start"))
    s = daily.join(days, daily["sale_ord_dt"] == days["date"], "inner")
    s = s.join(weeks, s["sequentialweek"] == weeks["_week"], "left")
    net_price = sql_div_sql("net_sales", "unit_volume")
    categories = [c for c in CATEGORY_COLUMNS if c in daily.columns]
    return s.selectExpr(
        "date", *categories, "item_sku_id", "unit_volume",
        "net_sales AS total_net_sales",
        "gross_sales AS total_gross_sales",
        "unit_volume * synthetic_gross_price AS total_synthetic_gross_sales",
        "gross_sales - net_sales AS total_give_away",
        "CASE WHEN synthetic_gross_price = 0 THEN 0"
        " WHEN unit_volume <> 0 THEN unit_volume * synthetic_gross_price - net_sales END"
        " AS total_synthetic_give_away",
        f"{sql_div_sql('gross_sales - net_sales', 'gross_sales')} AS raw_discount_percentage",
        f"{sql_div_sql(f'CAST(synthetic_gross_price AS DOUBLE) - {net_price}', 'synthetic_gross_price')}"
        " AS synthetic_discount_percentage",
        "sequentialweek", "week_start",
        "substring(sale_ord_dt, 1, 7) AS month")


def _rollup(measures: DataFrame, keys: list[str]) -> DataFrame:
    categories = [c for c in CATEGORY_COLUMNS if c in measures.columns]
    return measures.groupBy(*categories, *keys).agg(*[F.sum(c).alias(c) for c in MEASURE_COLUMNS])


WEEK_KEYS = ["item_sku_id", "sequentialweek", "week_start"]
MONTH_KEYS = ["item_sku_id", "month"]


def sales_weekly(measures: DataFrame) -> DataFrame:
    """A2: SKU x week; a NULL ``week_start`` is its own group.  Measures
    without category columns give the rollup by SKU alone (see
    ``rollup_then_categorise``)."""
    return _rollup(measures, WEEK_KEYS)


def sales_monthly(measures: DataFrame) -> DataFrame:
    """A3: SKU x month."""
    return _rollup(measures, MONTH_KEYS)


def rollup_then_categorise(measures: DataFrame, sku_dim: DataFrame, keys: list[str],
                           snapshot_dt: str = REFERENCE_SKU_SNAPSHOT) -> DataFrame:
    """A2/A3 with J2 moved after the aggregate.

    The category codes are attributes of the SKU in one snapshot, so grouping
    by (SKU, period) and then joining the codes gives the same rows as joining
    the codes to every SKU x day row and grouping by them (a SKU with several
    dimension rows fans out the same way, an unknown SKU drops out the same
    way).  The join then handles one row per SKU and period instead of one per
    SKU and day, and its shuffle, when the dimension cannot be broadcast, is
    that much smaller.
    """
    # Partitioned by SKU once: the rollup, a shuffle join on SKU and the later
    # per-SKU windows all use this partitioning.  A rollup shuffled on (SKU,
    # period) would combine little map-side (a SKU's days sit in different
    # partitions after the daily aggregate) and the join would shuffle again.
    # After the daily aggregate a SKU has one row per day, so no key is hot.
    rolled = _rollup(measures.repartition("item_sku_id"), keys)
    joined = rolled.join(sku_snapshot(sku_dim, snapshot_dt), "item_sku_id", "inner")
    return joined.select(*CATEGORY_COLUMNS, *keys, *MEASURE_COLUMNS)


# Fixed values of the reference's export slice.
REFERENCE_SLICE = {"third": (672,), "first": (1320, 9987, 1319), "second": (1343,)}


def category_slice(facts: DataFrame, third=REFERENCE_SLICE["third"],
                   first=REFERENCE_SLICE["first"], second=REFERENCE_SLICE["second"]) -> DataFrame:
    """Rows in any of the given third / first / second level categories."""
    cond = (F.col("item_third_cate_cd").isin(list(third))
            | F.col("item_first_cate_cd").isin(list(first))
            | F.col("item_second_cate_cd").isin(list(second)))
    return facts.where(cond)
