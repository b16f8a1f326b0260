"""Logical inputs of the reference, derived from the driver's TPC-H-like tables.

The reference reads warehouse tables it never builds (order detail, synthetic
price, SKU dimension, calendar, elasticity estimates).  This module derives
each of them from ``lineitem`` / ``part`` / ``orders`` with Spark so that every
query's work grows with the test data (FIXTURES.md §2).  The DuckDB oracle
spells the same mapping in SQL (``skuflow.plans.oracle``).

Money columns are DECIMAL so that sums are exact and order-independent; ratios
are taken in double precision (``skuflow.functions.numeric``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.sources.tables import read_table

# Fixed values of the fixture mapping (our choices, documented in FIXTURES.md).
HISTORY_START = "1995-01-01"      # stands in for the reference's 2014-07-01 floor
SKU_SNAPSHOT_DT = "2017-04-28"    # snapshot day the sales build selects
OLD_SKU_SNAPSHOT_DT = "2016-12-31"  # second snapshot, codes shifted by 1000
OLD_SNAPSHOT_SHIFT = 1000
ELASTICITY_DT = "2017-06-17"      # snapshot day of the elasticity estimates
WEEK_EPOCH = "1994-12-26"         # Monday that starts week 0
OMITTED_WEEK = 52                 # week left out of the week dimension
ZERO_PRICE_MOD = 19               # parts with a synthetic price of 0
NO_PRICE_MOD = 17                 # parts without a synthetic price row
NULL_SKU_ELASTICITY_MOD = 5       # SKUs whose own elasticity is NULL
NO_BRAND_ROW_THIRD = 3            # category without brand-level rows
NO_CATE_ROW_THIRD = 4             # category without a category-level row
TRAIN_MAX = "2000-12"
TEST_VALUES = ("2001-01",)


def _day(c: str):
    """``yyyy-MM-dd`` of a timestamp (a date cast: no formatter, no time zone)."""
    return F.col(c).cast("date").cast("string")


def order_detail(lineitem: DataFrame) -> DataFrame:
    """Order lines: ``sale_ord_dt, item_sku_id, after/before_prefr_amount, sale_qtty, flags``.

    Amounts are built from whole cents and whole discount points in long
    arithmetic and scaled once, so they are exact DECIMALs that fit a long
    (precision <= 18) and stay on Spark's compact decimal path.
    """
    cents = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    points = "CAST(round(l_discount * 100) AS BIGINT)"
    day = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
    return lineitem.selectExpr(
        f"{day} AS sale_ord_dt",
        "l_partkey AS item_sku_id",
        # 1e-4 currency units: cents x (100 - 3 x discount points)
        f"CAST({cents} * (100 - 3 * {points}) AS DECIMAL(13,0)) * CAST(0.0001 AS DECIMAL(4,4))"
        " AS after_prefr_amount",
        f"CAST({cents} AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(2,2)) AS before_prefr_amount",
        "CAST(l_quantity AS DECIMAL(8,2)) AS sale_qtty",
        "CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS sale_ord_valid_flag",
        "CASE WHEN l_linestatus = 'F' THEN 'HISTORY' ELSE 'ACTIVE' END AS dp",
        f"{day} AS dt")


def synthetic_price_source(lineitem: DataFrame) -> DataFrame:
    """Raw synthetic price table ``date, productkey, syntheticgrossprice``.

    Per (day, part): the highest unit price of the day in whole cents (floor),
    0 for parts divisible by 19, and no row for parts divisible by 17.
    """
    unit_cents = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    per_day = (lineitem.where(F.col("l_partkey") % NO_PRICE_MOD != 0)
               .groupBy(_day("l_shipdate").alias("date"), F.col("l_partkey").alias("productkey"))
               .agg(F.max(unit_cents).alias("cents")))
    price = F.when(F.col("productkey") % ZERO_PRICE_MOD == 0, F.lit(0)).otherwise(F.col("cents"))
    return per_day.select(
        "date", "productkey",
        (price.cast("decimal(14,0)") * F.lit(0.01).cast("decimal(3,2)"))
        .cast("decimal(12,2)").alias("syntheticgrossprice"))


def _third_category(c: str = "p_brand"):
    return F.split_part(F.col(c), F.lit("#"), F.lit(2)).cast("int")


def sku_dimension(part: DataFrame) -> DataFrame:
    """SKU dimension with two snapshots; the sales build must pick one."""
    # One row per product type: the window runs over the distinct type list only.
    types = (part.select("p_type").distinct()
             .withColumn("item_first_cate_cd",
                         F.dense_rank().over(Window.orderBy("p_type")).cast("int")))
    base = part.join(types, "p_type").select(
        F.col("p_partkey").alias("item_sku_id"),
        "item_first_cate_cd",
        F.col("p_size").cast("int").alias("item_second_cate_cd"),
        _third_category().alias("item_third_cate_cd"),
    )
    current = base.withColumn("dt", F.lit(SKU_SNAPSHOT_DT))
    shift = F.lit(OLD_SNAPSHOT_SHIFT)
    older = base.select(
        "item_sku_id",
        (F.col("item_first_cate_cd") + shift).alias("item_first_cate_cd"),
        (F.col("item_second_cate_cd") + shift).alias("item_second_cate_cd"),
        (F.col("item_third_cate_cd") + shift).alias("item_third_cate_cd"),
        F.lit(OLD_SKU_SNAPSHOT_DT).alias("dt"))
    return current.unionByName(older)


def calendar_days(lineitem: DataFrame) -> DataFrame:
    """D3: ``date, sequentialweek`` for whole years spanning the order history."""
    span = lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    first = F.trunc(F.to_date("lo"), "year")
    last = F.date_add(F.add_months(F.trunc(F.to_date("hi"), "year"), 12), -1)
    days = span.select(F.explode(F.sequence(first, last)).alias("d"))
    weeks = F.floor(F.datediff("d", F.to_date(F.lit(WEEK_EPOCH))) / 7).cast("int")
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("date"),
                       weeks.alias("sequentialweek"))


def calendar_weeks(dim_date: DataFrame) -> DataFrame:
    """Week dimension ``sequentialweek, date`` (week start); one week is left out."""
    start = F.date_add(F.to_date(F.lit(WEEK_EPOCH)), F.col("sequentialweek") * 7)
    return (dim_date.select("sequentialweek").distinct()
            .where(F.col("sequentialweek") != OMITTED_WEEK)
            .select("sequentialweek", F.date_format(start, "yyyy-MM-dd").alias("date")))


def sku_elasticity(part: DataFrame) -> DataFrame:
    value = F.when(F.col("p_partkey") % NULL_SKU_ELASTICITY_MOD == 0, F.lit(None).cast("double")) \
        .otherwise(-F.col("p_size").cast("double") / 2.0)
    return part.select(F.col("p_partkey").alias("skuid"), F.col("p_type").alias("brand_code"),
                       _third_category().alias("item_third_cate_cd"), value.alias("e_value"),
                       F.lit(ELASTICITY_DT).alias("dt"))


def brand_elasticity(part: DataFrame) -> DataFrame:
    third = F.col("item_third_cate_cd")
    pairs = part.select(F.col("p_type").alias("brand_code"),
                        _third_category().alias("item_third_cate_cd")).distinct()
    value = F.when(third % 2 == 0, F.lit(None).cast("double")).otherwise(-8.0 - third.cast("double"))
    return (pairs.where(third != NO_BRAND_ROW_THIRD)
            .select("brand_code", "item_third_cate_cd", value.alias("e_value"),
                    F.lit(ELASTICITY_DT).alias("dt")))


def cate_elasticity(part: DataFrame) -> DataFrame:
    third = F.col("item_third_cate_cd")
    cats = part.select(_third_category().alias("item_third_cate_cd")).distinct()
    return (cats.where(third != NO_CATE_ROW_THIRD)
            .select("item_third_cate_cd", (-4.0 - third.cast("double")).alias("e_value"),
                    F.lit(ELASTICITY_DT).alias("dt")))


def monthly_target(sales_monthly: DataFrame) -> DataFrame:
    """Forecast target ``tm_key, item_third_cate_cd, gmv`` from the monthly facts."""
    return (sales_monthly.groupBy(F.col("month").alias("tm_key"), "item_third_cate_cd")
            .agg(F.sum("total_net_sales").alias("gmv")))


def monthly_time_features(orders: DataFrame) -> DataFrame:
    """Time features per month from ``orders``: order count and order value."""
    return (orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("tm_key"))
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("order_value")))


class TestInputs:
    """Lazily derived logical inputs for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        # One DataFrame per table and session: the file listing and footer
        # read happen once, not once per query.
        cache = self.spark.__dict__.setdefault("_skuflow_tables", {})
        key = (self.sf_dir, name)
        if key not in cache:
            cache[key] = read_table(self.spark, self.sf_dir, name)
        return cache[key]

    def order_detail(self) -> DataFrame:
        return order_detail(self.table("lineitem"))

    def synthetic_price_source(self) -> DataFrame:
        return synthetic_price_source(self.table("lineitem"))

    def sku_dim(self) -> DataFrame:
        return sku_dimension(self.table("part"))

    def dim_date(self) -> DataFrame:
        return calendar_days(self.table("lineitem"))

    def dim_week(self) -> DataFrame:
        return calendar_weeks(self.dim_date())

    def sku_elasticity(self) -> DataFrame:
        return sku_elasticity(self.table("part"))

    def brand_elasticity(self) -> DataFrame:
        return brand_elasticity(self.table("part"))

    def cate_elasticity(self) -> DataFrame:
        return cate_elasticity(self.table("part"))

    def time_features(self) -> DataFrame:
        return monthly_time_features(self.table("orders"))
