"""The raw inputs as projections of a star schema of orders.

Stand-ins for the delimited files, so that every operator can run, and be checked, on
tables of any size. Each reads only the columns and joins only the tables it needs;
which side of a join is broadcast is the planner's choice by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schemas import MONEY, WEIGHTS

# The share of a full day on each weekday, Monday to Sunday.
WEEKDAY_WEIGHTS = (1.0, 1.0, 1.0, 1.0, 1.0, 0.55, 0.25)

NBSP = "\u00a0"


# Looking up a table's schema takes a job; each is looked up once.
_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _old_code(part_key: Column) -> Column:
    return F.concat(F.lit("SKU_OLD_"), part_key.cast("string"))


def _current_code(part_key: Column) -> Column:
    return F.concat(F.lit("SKU_"), part_key.cast("string"))


# Parts up to this size were sold under an old code.
RECODED_SIZE = 5


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part and supplier: the columns that sales and stock movements take.

    Store it where several of them are wanted, so that the line items meet the parts once.
    """
    return _supplied(spark, sf_dir).select(
        *[f"l_{c}" for c in ("orderkey", "linenumber", "partkey", "suppkey", "shipdate")],
        *[f"l_{c}" for c in ("quantity", "extendedprice", "returnflag", "linestatus")],
        *["p_size", "p_type", "p_brand", "p_retailprice", "s_name", "s_nationkey"],
    )


def _supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    )


def sales(
    spark: SparkSession, sf_dir: str, with_customer: bool = True, lines: DataFrame | None = None
) -> DataFrame:
    """Line items as sales documents, padded strings and all.

    Tables are joined one after another to the line items: the planner knows the size of
    a table and broadcasts it if that is below its limit, which it could not know of
    tables joined among themselves first.

    The customer comes from the orders by a left join on their unique key, which no other
    column depends on; without it that join, the only one between two large tables, is
    not made. ``lines`` is what :func:`lines` gives, if that is at hand.
    """
    joined = (
        (_supplied(spark, sf_dir) if lines is None else lines)
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    customer = []
    if with_customer:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        joined = joined.join(orders, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        customer = [F.col("o_custkey").alias("customer_id")]
    code = F.when(F.col("p_size") <= RECODED_SIZE, _old_code(F.col("l_partkey"))).otherwise(
        _current_code(F.col("l_partkey"))
    )
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(
        F.col("l_quantity")
    )
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("doc_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit(" "), "r_name", F.lit(" ")).alias("region"),
        F.concat(F.lit("CH"), F.col("n_nationkey").cast("string")).alias("chain_id"),
        F.concat("n_name", F.lit(" ")).alias("chain_name"),
        *customer,
        F.concat(F.lit(NBSP), code).alias("sku_id"),
        F.col("p_type").alias("product_group"),
        quantity.cast(MONEY).alias("qty"),
        F.col("l_extendedprice").cast(MONEY).alias("revenue_byn"),
    )


def plan(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Each month's plan: the quantity sold a year before net of returns, at least 0."""
    sold = sales(spark, sf_dir, with_customer=False, lines=lines)
    month = F.trunc("date", "month").alias("sold_in")
    return (
        sold.groupBy(month, "region", "chain_id", "chain_name", "product_group")
        .agg(F.sum("qty").cast("double").alias("net"))
        .select(
            F.date_format(F.add_months("sold_in", 12), "yyyy-MM").alias("month"),
            "region",
            F.concat("chain_id", F.lit(" ")).alias("chain_id"),
            "chain_name",
            "product_group",
            F.greatest("net", F.lit(0.0)).alias("plan_qty"),
            *[F.lit(w).alias(name) for name, w in zip(WEIGHTS, WEEKDAY_WEIGHTS, strict=True)],
        )
    )


def sku_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One link for each recoded part, valid from and to dates that go by its size."""
    size = F.col("p_size")
    recoded = table(spark, sf_dir, "part").filter(size <= RECODED_SIZE)
    return recoded.select(
        _old_code(F.col("p_partkey")).alias("old_sku_id"),
        _current_code(F.col("p_partkey")).alias("current_sku_id"),
        F.when(size <= 2, F.lit("1996-01-01")).otherwise(F.lit("1998-01-01")).cast("date").alias(
            "valid_from"
        ),
        F.when(size.isin(1, 3), F.lit("1999-12-31")).cast("date").alias("valid_to"),
    )


def sku_link_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links, and for every part a replacement that lasts for half of 1999 only.

    The second link of a part lies within the first where that is open, so links
    overlap, nest and leave gaps.
    """
    links = sku_links(spark, sf_dir)
    stop_gap = F.struct(
        "old_sku_id",
        F.concat("current_sku_id", F.lit("_T")).alias("current_sku_id"),
        F.lit("1999-01-01").cast("date").alias("valid_from"),
        F.lit("1999-06-30").cast("date").alias("valid_to"),
    )
    both = F.array(F.struct(*links.columns), stop_gap)
    return links.select(F.explode(both).alias("link")).select("link.*")


def sku_supersessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link from every part's code to another's, so that links lead on and into circles.

    Parts of small size, but for the first hundred, give way to the part of three times
    their number, the others to that of a third of it; codes beyond the last part, and that of part 0, are no old codes.
    """
    key = F.col("p_partkey").cast("long")
    thrice = (F.col("p_size") <= RECODED_SIZE) & (key > 100)
    return table(spark, sf_dir, "part").filter(key > 0).select(
        _current_code(key).alias("old_sku_id"),
        _current_code(F.when(thrice, key * 3).otherwise(F.expr("p_partkey div 3"))).alias("current_sku_id"),
        F.lit("1996-01-01").cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _current_code(F.col("p_partkey")).alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("product_group"),
        F.col("p_retailprice").alias("base_price_byn"),
    )


def stock_movements(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """Line items as movements of a brand in a supplier's warehouse."""
    operation = (
        F.when(F.col("l_returnflag") == "R", F.lit("adjust"))
        .when(F.col("l_linestatus") == "F", F.lit(" income"))
        .otherwise(F.lit("outcome "))
    )
    return (_supplied(spark, sf_dir) if lines is None else lines).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("WH"), F.col("l_suppkey").cast("string")).alias("warehouse_id"),
        F.concat("s_name", F.lit(" ")).alias("warehouse_name"),
        F.concat(F.lit("SKU_"), "p_brand").alias("sku_id"),
        operation.alias("operation_type"),
        F.col("l_quantity").cast(MONEY).alias("qty"),
        F.col("p_retailprice").cast(MONEY).alias("unit_cost_byn"),
    )
